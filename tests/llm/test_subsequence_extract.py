import random
from html.parser import HTMLParser
from itertools import combinations

import numpy as np

from tidemark.llm.subsequence_extract import best_run, count_kinds, extract, extract_pages, weights_from

BODY = "<p>" + "word " * 60 + "</p><p>More &amp; text&nbsp;here <a href=x>link</a> tail.</p><ul><li>one</li><li>two</li></ul>"
TEXT = "word " * 59 + "word\nMore & text here link tail.\none\ntwo"


def test_templates():
    pages = {
        "main": f"<html><head><title>T</title></head><body><header><h1>Site</h1><a>x</a></header><main><h1>Title</h1>{BODY}"
        "<div class='ad'>Buy now</div><aside>side text</aside><section class='comments'><h2>Comments</h2><p>great post</p></section>"
        "</main><footer>foot words here</footer></body></html>",
        "article": f"<body><nav><ul><li>a</li></ul></nav><article><header><h1>Title</h1><p>By me</p></header><!-- <p>no</p> -->{BODY}"
        "<script>var a='</p>'</script><form><label>mail</label></form><footer>tags</footer></article><p>outside</p></body>",
        "plain": "<html><body><div id='menu'><a>1</a><a>2</a></div><div class='cookie-notice'>We use cookies and so on</div>"
        f"<div class='content'><h1>Title</h1>{BODY}</div><form><input><label>mail me</label></form><div id=sidebar><p>Side</p></div>"
        "<div class=footer>foot</div></body></html>",
    }
    for name, page in pages.items():
        assert extract(page, {}) == "Title\n" + TEXT, name


def test_odd_markup():
    assert extract(None, {}) == extract("", {}) == extract("<p></p>", {}) == ""
    assert extract("<article>a &lt;b&gt; 1 < 2 &#233;&eacute; &am</article>", {}) == "a <b> 1 < 2 éé &am"
    assert extract("<article><p>one two<p>three<br>four <b>five</article>", {}) == "one two\nthree four five"
    assert extract('<article><p title="a>b">x y</p><script>never closed </article>', {}) == "x y"
    assert extract("<ARTICLE><P>Up</P></ARTICLE>", {}) == "Up"
    long = "w " * 200_000
    assert extract(f"<article><p>{long}</p></article>", {}) == long.strip()


def test_best_run_equals_all_runs():
    source = random.Random(4)
    for _ in range(200):
        scores = np.array([source.randint(-4, 3) for _ in range(source.randint(0, 12))], float)
        start, end = best_run(scores)
        best = max([scores[a:b].sum() for a, b in combinations(range(len(scores) + 1), 2)], default=0)
        assert scores[start:end].sum() == max(0, best)


def test_weights_follow_the_labels():
    counts = {("word:article", True): 900, ("word:div", False): 90, ("word:div", True): 2, ("open:li", False): 50, ("open:p", True): 60}
    weights = weights_from(counts)
    assert weights["word:article"] > 0 > weights["word:div"] and weights["open:li"] < weights["open:p"] <= 0


class Articles(HTMLParser):
    """What lies in article elements, for pages without anything else in them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [[]]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.blocks[-1].append(" ") if tag == "br" else tag in ("p", "h1", "article") and self.blocks.append([])

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1].append(data)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        parser = Articles()
        parser.feed(r["html"])
        parser.close()
        want[r["page_id"]] = "\n".join(t for t in (" ".join("".join(b).split()) for b in parser.blocks) if t)
    found = extract_pages(pages).collect()
    assert {r["page_id"]: r["text"] for r in found} == want
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_tables(frame, rows):
    data = [(1, "u", "<article>a b</article>"), (1, "u", "<article>a b</article>"), (2, None, None), (None, "v", "<p>c d</p>")]
    got = rows(extract_pages(frame(data, "page_id long, url string, html string")))
    assert got == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (2, None, "", 0), (None, "v", "c d", 3)], key=repr)
    assert extract_pages(frame([], "page_id long, url string, html string")).collect() == []


def prose_page(body, head="<html><body><nav><a href=x>home</a></nav>"):
    return f"{head}{body}<footer>foot words here</footer></body></html>"


def learned():
    """Weights learned from pages that name their region."""
    total = {}
    for n in range(20):
        body = f"<h1>Head {n}</h1>{BODY}"
        page = prose_page(f"<div class=ad>Buy {n}</div><article>{body}</article><div class=comments><p>nice post</p></div>")
        for counted, inside in zip(count_kinds(page), (True, False), strict=True):
            for kind, n_kind in counted.items():
                total[kind, inside] = total.get((kind, inside), 0) + n_kind
    return weights_from(total)


def test_articles_that_are_not_the_main_text():
    text = f"<div class=content><h1>Title</h1>{BODY}</div>"
    remark = "<article class=comment-body><p>great post, thanks for it</p></article>"
    card = "<article class=card><h3><a href=x>Another story</a></h3><p>what it is about in a few words</p></article>"
    pages = [text + 5 * remark, text + f"<div id=comments>{5 * remark}</div>", text + card, text + 4 * card, 4 * card + text, card + text + card]
    for weights in ({}, learned()):
        for page in pages:
            assert extract(prose_page(page), weights) == "Title\n" + TEXT, page
        assert extract(prose_page(f"<article><h1>Title</h1>{BODY}</article>{4 * card}"), weights) == "Title\n" + TEXT


def test_learned_weights_decide_inside_the_named_region_and_without_one():
    page = prose_page("<div><p>" + "word " * 60 + "</p></div>")
    assert extract(page, {}) == ("word " * 60).strip()
    assert extract(page, {"word:p+": -1.0}) == ""
    # A link list within the region is cut off where learned weights say so.
    page = prose_page("<main><p>" + "word " * 60 + "</p><ul>" + "<li><a href=x>one two</a></li>" * 30 + "</ul></main>")
    assert extract(page, {"word:a": -6.0, "open:li": -1.0}) == ("word " * 60).strip()


def test_remarks_do_not_unname_the_region():
    page = prose_page(f"<article>{BODY}</article><article class=comment><p>nice</p></article>")
    assert count_kinds(page) is not None
    assert count_kinds(prose_page(f"<div>{BODY}{BODY}</div><article><p>a teaser</p></article>")) is None


def test_wrappers_named_like_sidebars_keep_their_text():
    inner = f"<h1>Title</h1>{BODY}"
    for page in (
        f"<html><body class='no-sidebar'><div>{inner}</div></body></html>",
        f"<html class='has-banner'><body><div>{inner}</div></body></html>",
        f"<body class='search modal'><div>{inner}</div></body>",
        f"<body><main class='with-sidebar'>{inner}</main></body>",
        f"<body><main class='sidebar'>{inner}</main></body>",
        f"<body><article class='post social-history'>{inner}</article></body>",
        f"<body><article class='post search tags'>{inner}</article></body>",
        f"<body><div id='page' class='right-sidebar'>{inner}</div></body>",
        f"<body><div class='no-sidebar has-widget'>{inner}</div><div class='widget-area'>side words</div></body>",
        f"<body><div class='sidebar'><div class='social'>{inner}</div><div class='comments'><p>great post</p></div></div></body>",
    ):
        assert extract(page, {}) == extract(page, learned()) == "Title\n" + TEXT, page


def test_hints_still_leave_out_what_is_no_wrapper():
    names = "comment-list sidebar-left right-sidebar site-footer cookie-notice ad ads-300x250 widget-2 share-buttons nav-menu side-bar"
    for name in names.split():
        page = f"<body><div><h1>Title</h1>{BODY}</div><div class='x {name}'><p>{'other ' * 30}</p></div></body>"
        assert extract(page, {}) == extract(page, learned()) == "Title\n" + TEXT, name
    # More remarks than text.
    page = f"<body><div><h1>Title</h1>{BODY}</div><div class=comments>{'<p>great post of the day</p>' * 60}</div></body>"
    assert extract(page, {}) == extract(page, learned()) == "Title\n" + TEXT


def test_main_text_that_only_partly_stands_in_an_article():
    lead, rest = "lead " * 60, "more " * 70
    for other in ("<div class='content'><p>{}</p></div>", "<div class='content'>{}</div>", "<section><p>{}</p></section>"):
        page = prose_page(f"<article><h1>Title</h1><p>{lead}</p></article>{other.format(rest)}")
        for weights in ({}, learned()):
            assert extract(page, weights) == f"Title\n{lead.strip()}\n{rest.strip()}", other


def test_headline_before_several_articles():
    first, second = "one " * 60, "two " * 55
    page = prose_page(f"<h1>Title</h1><article><p>{first}</p></article><article><p>{second}</p></article>")
    for weights in ({}, learned()):
        assert extract(page, weights) == f"Title\n{first.strip()}\n{second.strip()}"


def test_an_article_s_larger_part_is_no_widget():
    first, second = "one " * 50, "two " * 60
    page = prose_page(f"<article><p>{first}</p><div class='widget'><p>{second}</p></div></article>")
    for weights in ({}, learned()):
        assert extract(page, weights) == f"{first.strip()}\n{second.strip()}"
    # Remarks are none of the text, however many there are.
    page = prose_page(f"<article><p>{first}</p><div class='comments'><p>{second}</p></div></article>")
    for weights in ({}, learned()):
        assert extract(page, weights) == first.strip()


def test_blocks_at_the_ends_are_whole():
    text = "word " * 60
    page = prose_page(f"<div><p>{text}</p><p>Source: <a href=x>the full report here</a></p></div>")
    for weights in ({}, learned()):
        assert extract(page, weights) == f"{text.strip()}\nSource: the full report here"
    # Links straight in a container are no part of a block of prose.
    page = f"<body><a href=x>home</a> <a href=y>news</a><p>{text}</p></body>"
    assert extract(page, {}) == text.strip()
