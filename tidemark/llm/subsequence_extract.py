"""Main text of web pages as the maximum-scoring run of page tokens.

A page becomes a sequence of words and tags. Words score positive and tags negative, each by the log-odds that its kind
lies inside the main text, learned from labelled pages: those whose markup names the main region (one article or main
element). One linear scan finds the contiguous run with the largest sum; its words, block by block, are the text.
Article and main elements are evidence added to the weights of words, for or against by the share of the page's prose they
hold: teasers and remarks beside a longer text count against themselves. Elements that never hold article text (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) score by a learned negative weight
and are left out where the run contains them; one that only its class or id names so is no such element if it wraps most
of the page's prose.

Defined results: a null or empty page has an empty text; so has a page without words that score positive. Of several
equally good runs the first counts. Pages are independent, so repeated rows give repeated results and very long pages
are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the HTML standard and common words in class names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|title|xmp"
NEVER = frozenset(
    "head nav footer aside form button select menu dialog object canvas audio video label input fieldset".split()
)
PROSE = frozenset(
    "p b i em strong u s small sub sup mark q cite abbr time br span a h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote "
    "pre code kbd samp figure figcaption img table thead tbody tr td th caption".split()
)
CONTAINERS = frozenset("html body main article section div center address fieldset form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINT = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|sidebar|aside|menu|"
    r"nav\w*|footer|masthead|siteheader|pageheader|comments?|replies|respond|disqus|social|share|sharing|related|"
    r"recommend\w*|breadcrumbs?|newsletter|subscribe|subscription|signup|popup|modal|overlay|widget|pagination|"
    r"skiplink|toolbar|tags|login|search"
)
REMARK = re.compile(r"comments?|reply|replies|respond|disqus")
PAIRS = re.compile(r"\b(side|site|page|skip|sign|pop)[-_](bar|header|link|up)(?![a-z])")
#: Parts that may stand beside a hint in a class token; others (no-sidebar, has-banner, social-history) change its meaning.
NEUTRAL = frozenset(
    "area article author bar block body bottom box button buttons card column container content date entry fixed form "
    "global group header heading icons inner item items large leaderboard left link links list main meta middle mobile "
    "module outer page panel post posts primary reader rectangle right row secondary section site skyscraper slot small "
    "sticky story text thread title tools top unit user wide wrap wrapper".split()
)
ROLE = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|form|menu|menubar|dialog|alert)$", re.I)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<(?P<raw>{RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|$)|<!\[CDATA\[.*?(?:\]\]>|$)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

#: Labelled pages that weights are learned from at most; the rest adds nothing to a few dozen averages.
SAMPLE_PAGES = 2_000
#: Pseudo-tokens per kind, which hold the weight of rare kinds near their prior.
PRIOR = 4.0
#: Weight of what a region the page names says of a word, against at most 3 of its kind.
EVIDENCE = 4.0
#: Words from which on a text is long, and from which on an element may be taken for the wrapper of a page without headline.
LONG = 10
WRAPPED = 50


def _flagged(name: str, attrs: str, inside: bool) -> str | None:
    """``never`` for elements that hold no article text; ``remark`` or ``hint`` if only a class or id says so.

    A header inside the article may hold its headline. html, body and main are never flagged, and an article can only be a
    reader's remark.
    """
    if name in ("html", "body", "main"):
        return None
    if name in NEVER or name == "header" and not inside:
        return "never"
    if "=" not in attrs:
        return None
    hint = remark = False
    for key, a, b, c in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), a or b or c
        if key == "role" and ROLE.match(value) or key == "aria-hidden" and value.lower() == "true":
            return "never"
        if key in ("class", "id"):
            named = value.lower().split()
            hint = hint or any(_hinted(t, REMARK if name == "article" else HINT) for t in named)
            remark = remark or any(_hinted(t, REMARK) for t in named)
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs, re.I):
        return "never"
    return "remark" if remark else "hint" if hint else None


def _hinted(token: str, hint: re.Pattern) -> bool:
    """Whether a whole class token names something else than article text."""
    parts = [p for p in re.split(r"[-_]+", PAIRS.sub(r"\1\2", token)) if p]
    rest = [p for p in parts if not hint.fullmatch(p)]
    return len(rest) < len(parts) and all(p in NEUTRAL or re.fullmatch(r"\d+(?:x\d+)?", p) for p in rest)


def tokens(page: str) -> tuple[list[tuple[str, str]], list[tuple[str, int, int]]]:
    """Kind and text of the page's tokens, and marked elements: what they are, their first token and the one after the last.

    kind is ``word:`` and the closest block element (``word:a`` in a link, ``word:box`` straight in a container), with a
    ``+`` for LONG texts, or ``open:``/``close:`` and a tag's name. No kind tells how a page names its containers, so what
    some pages teach holds on all. Elements are marked as ``never``, ``remark``, ``hint``, ``region`` (article, main) and
    ``title`` (h1).
    """
    stack: list[tuple[str, bool, list[list]]] = []
    found: list[tuple[str, str]] = []
    marks: list[list] = []
    links = header = headings = regions = 0
    blocks = ["body"]
    at = 0

    def text(piece: str) -> None:
        if piece:
            if header and not headings:
                marks.append(["never", len(found), len(found) + 1])
            if links:
                found.append(("word:a", piece))
            else:
                kind = "box" if blocks[-1] in CONTAINERS else blocks[-1]
                found.append((f"word:{kind}{'+' if _words(piece) >= LONG else ''}", piece))

    def pop() -> None:
        nonlocal links, header, headings, regions
        name, bad, own = stack.pop()
        for mark in own:
            mark[2] = len(found)
        regions -= name in ("article", "main")
        links -= name == "a"
        headings -= name in HEADINGS
        header -= name == "header" and not bad
        if name in BLOCKS:
            blocks.pop()

    for match in TOKEN.finditer(page):
        text(page[at : match.start()])
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if match["end"]:
            if any(n == name for n, _, _ in stack):
                while stack[-1][0] != name:
                    pop()
                found.append((f"close:{name}", name))
                pop()
            elif name == "p":
                found.append(("close:p", name))
            continue
        # A new block ends an open paragraph, a new item the open item.
        if stack and stack[-1][0] == "a" and name == "a":
            pop()
        if name in BLOCKS:
            for depth in range(len(stack) - 1, -1, -1):
                open_name = stack[depth][0]
                if open_name == "p" or open_name == name and name in ("li", "dd", "dt", "td", "th", "tr", "option"):
                    while len(stack) > depth:
                        pop()
                    break
                if open_name in BLOCKS:
                    break
        if name not in VOID and not match["attrs"].endswith("/"):
            flag = _flagged(name, match["attrs"], regions > 0)
            what = [flag, "region" if name in ("article", "main") else None, "title" if name == "h1" else None]
            own = [[w, len(found), -1] for w in what if w]
            marks += own
            stack.append((name, bool(flag), own))
            regions += name in ("article", "main")
            links += name == "a"
            headings += name in HEADINGS
            header += name == "header" and not flag
            if name in BLOCKS:
                blocks.append(name)
        found.append((f"open:{name}", name))
    text(page[at:])
    while stack:
        pop()
    return found, [(what, start, end) for what, start, end in marks]


class Page:
    """A page's tokens with what is known of each: words, whether excluded, and what named regions say of it (-1 to 1)."""

    def __init__(self, html: str):
        self.found, marks = tokens(html)
        n = len(self.found)
        self.is_word = np.array([kind.startswith("word:") for kind, _ in self.found], bool)
        self.words = np.array([_words(piece) if word else 1 for (_, piece), word in zip(self.found, self.is_word, strict=True)], np.int64)
        linked = np.array([kind == "word:a" for kind, _ in self.found], bool)
        never = _cover([(a, b) for what, a, b in marks if what == "never"], n)
        prose = np.where(self.is_word & ~linked & ~never, self.words, 0)
        sums = np.concatenate([[0], np.cumsum(prose)])
        titles = np.array([a for what, a, _ in marks if what == "title" and not never[a]], np.int64)

        def wraps(a: int, b: int) -> bool:
            # What holds most of the prose with its headline, or nearly all, wraps the page, whatever it is called.
            here, total = int(sums[b] - sums[a]), int(sums[-1])
            headed = np.searchsorted(titles, b) > np.searchsorted(titles, a)
            return 2 * here > total and bool(headed) or here >= WRAPPED and 10 * (total - here) < here

        regions = [(a, b) for what, a, b in marks if what == "region" and not never[a]]

        def carries(a: int, b: int) -> bool:
            # A named region does not consist of what its class names leave out: who holds more than half of it is its text.
            holders = [(c, d) for c, d in regions if c < a and b <= d]
            return any(2 * int(sums[b] - sums[a]) > int(sums[d] - sums[c]) for c, d in holders)

        hints = [(a, b) for what, a, b in marks if what == "remark" and not wraps(a, b)]
        hints += [(a, b) for what, a, b in marks if what == "hint" and not wraps(a, b) and not carries(a, b)]
        self.excluded = never | _cover(hints, n)
        prose[self.excluded] = 0
        sums = np.concatenate([[0], np.cumsum(prose)])
        named = [(a, b) for what, a, b in marks if what == "region" and not self.excluded[a]]
        outer: list[tuple[int, int]] = []
        for a, b in named:
            if not outer or a >= outer[-1][1]:
                outer.append((a, b))
        self.said = np.zeros(n)
        self.region: tuple[int, int] | None = None
        if outer:
            held = [int(sums[b] - sums[a]) for a, b in outer]
            most = max(held)
            share = most / sums[-1] if sums[-1] else 0.3
            strength = min(1.0, max(-1.0, (share - 0.3) / 0.1))
            # A region much smaller than the largest is a teaser or a remark; several alike say nothing of each other.
            self.said[:] = -max(strength, 0.0)
            for (a, b), own in zip(outer, held, strict=True):
                self.said[a:b] = strength if own == most else 0.0 if 4 * own >= most else -abs(strength)
            # As much is said of long texts between and around regions: where they hold a quarter of what the largest
            # region does, the weights of their words decide.
            long = self.is_word & ~self.excluded & np.array([kind.endswith("+") for kind, _ in self.found], bool)
            held_long = np.concatenate([[0], np.cumsum(np.where(long, self.words, 0))])
            for a, b in zip([0, *(e for _, e in outer)], [*(s for s, _ in outer), n], strict=True):
                if most and 4 * int(held_long[b] - held_long[a]) >= most:
                    places = a + np.flatnonzero(long[a:b])
                    self.said[int(places[0]) : int(places[-1]) + 1] = 0.0
            alike = [(a, b) for (a, b), own in zip(outer, held, strict=True) if 4 * own >= most]
            if len(alike) > 1:
                # Several texts of a page may share a headline that stands before them.
                for a, b in ((a, b) for what, a, b in marks if what == "title" and b <= alike[0][0] and not self.excluded[a]):
                    self.said[a:b] = max(strength, 0.0)
            if len(named) == 1 and strength > 0:
                self.region = outer[0]


def _cover(spans: list[tuple[int, int]], n: int) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    steps = np.zeros(n + 1, np.int64)
    for a, b in spans:
        steps[a] += 1
        steps[b] -= 1
    return np.cumsum(steps)[:n] > 0


def _words(piece: str) -> int:
    return len(piece.split())


def count_kinds(html: str) -> tuple[Counter, Counter] | None:
    """How often each kind is inside and outside the labelled region; None if the page isn't labelled."""
    inside, outside = Counter(), Counter()
    page = Page(html)
    if page.region is None:
        return None
    for i, ((kind, _), word, n, excluded) in enumerate(
        zip(page.found, page.is_word.tolist(), page.words.tolist(), page.excluded.tolist(), strict=True)
    ):
        if n and (word or not excluded):
            (inside if page.region[0] <= i < page.region[1] else outside)["word:out" if excluded else kind] += n
    return inside, outside


def prior_weight(kind: str) -> float:
    if kind.startswith("word:"):
        return {"word:a": -0.5, "word:out": -2.0}.get(kind, 1.0)
    return -0.05 if kind.split(":")[1] in PROSE else -1.0


def learn_weights(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weight by kind from at most ``sample`` labelled pages, those with the smallest hash of their content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                counted = count_kinds(page)
                if counted:
                    total.update({(k, True): n for k, n in counted[0].items()})
                    total.update({(k, False): n for k, n in counted[1].items()})
        yield pa.RecordBatch.from_pydict(
            {"kind": [k for k, _ in total], "inside": [i for _, i in total], "n": list(total.values())},
            schema=pa.schema([("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]),
        )

    labelled = pages.select(F.col(html_col).cast("string").alias("html")).where(
        F.col("html").rlike("(?i)<(article|main)[\\s>]")
    )
    # A first cut by hash, about four times what is wanted of all pages, keeps what meets in one task small.
    share = min(1.0, 4 * sample / max(1, pages.count()))
    few = labelled.where(F.xxhash64("html") <= F.lit(int((share - 0.5) * 2**64) - 1 if share < 1 else 2**63 - 1))
    picked = few.orderBy(F.xxhash64("html")).limit(sample)
    counted = picked.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    # Kinds are tag names: take those that occur often enough to learn from, a bounded number.
    rows = counted.where("n >= 5").orderBy(F.desc("n"), "kind").limit(2_000).collect()
    return weights_from({(r["kind"], r["inside"]): r["n"] for r in rows})


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of lying inside, drawn towards the prior where few tokens were seen and kept in [-3, 3].

    Words keep a positive weight if most of their kind lie inside; tags never score positive, whatever their odds.
    """
    total_in = sum(n for (_, i), n in counts.items() if i) + 1
    total_out = sum(n for (_, i), n in counts.items() if not i) + 1
    weights = {}
    for kind in sorted({k for k, _ in counts}):
        a, b = counts.get((kind, True), 0), counts.get((kind, False), 0)
        odds = math.log((a + 0.5) / total_in) - math.log((b + 0.5) / total_out)
        share = (a + b) / (a + b + PRIOR)
        weight = max(-3.0, min(3.0, share * odds + (1 - share) * prior_weight(kind)))
        if kind.startswith("word:"):
            weights[kind] = max(weight, 0.2) if a > b else weight
        else:
            weights[kind] = -0.02 if a > b else min(weight, -0.3)
    return weights


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum, the first of equals; (0, 0) if none."""
    if not len(scores):
        return 0, 0
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    lowest = np.minimum.accumulate(sums)
    gain = sums[1:] - lowest[:-1]
    end = int(np.argmax(gain))
    if gain[end] <= 1e-12:
        return 0, 0
    start = int(np.flatnonzero(sums[: end + 1] == lowest[end])[-1])
    return start, end + 1


def whole_blocks(found: list[tuple[str, str]], start: int, end: int) -> tuple[int, int]:
    """The run, made longer by what is missing of a paragraph, list item or other block of prose at its ends."""

    def border(i: int) -> bool:
        what, _, name = found[i][0].partition(":")
        return what != "word" and name in BLOCKS

    def prose(i: int) -> bool:
        what, _, name = found[i][0].partition(":")
        return what == "open" and name not in CONTAINERS

    if start == end:
        return start, end
    first, last = start, end - 1
    while first and not border(first):
        first -= 1
    while last and not border(last):
        last -= 1
    # The block that the run ends in begins at its last border; only if that opens a block of prose its rest belongs to it.
    if border(last) and prose(last):
        while end < len(found) and not border(end):
            end += 1
    return (first if border(first) and prose(first) else start), end


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text: white space in a block is one space, blocks are joined by a line feed."""
    if not page:
        return ""
    read = Page(page)
    found, said = read.found, read.said.tolist()
    scores = np.empty(len(found))
    for i, ((kind, _), word, n, excluded) in enumerate(
        zip(found, read.is_word.tolist(), read.words.tolist(), read.excluded.tolist(), strict=True)
    ):
        if excluded and said[i] > 0:
            # Left out of the text anyway, and no reason to end it within the region that holds it.
            scores[i] = -0.01
        elif excluded:
            scores[i] = min(weights.get("word:out", prior_weight("word:out")), -0.5) * n if word else -0.01
        else:
            scores[i] = (weights.get(kind, prior_weight(kind)) + EVIDENCE * said[i] * word) * n
    start, end = whole_blocks(found, *best_run(scores))
    blocks: list[list[str]] = [[]]
    for (kind, piece), excluded in zip(found[start:end], read.excluded[start:end].tolist(), strict=True):
        what, _, name = kind.partition(":")
        if what == "word":
            if not excluded:
                blocks[-1].append(piece)
        elif name in BLOCKS:
            blocks.append([])
        elif name == "br":
            blocks[-1].append(" ")
    lines = (" ".join(entities.unescape("".join(block)).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def extract_pages(
    pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", html_col: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page; weights are learned from the pages if not given."""
    learned = learn_weights(pages, html_col) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, learned) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    url = F.col("url") if "url" in pages.columns else F.lit(None)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), url.cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
