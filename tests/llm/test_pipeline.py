import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import block_anchors, fourier_quality, odd_sketch
from tidemark.llm.common import staged
from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bad = {r["doc_id"] for r in fourier_quality.quality_scores(docs, labels).collect() if not r["predicted"]}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF_DIR), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        assert len(kept[name]) == docs.count()
    assert kept["quality"].keys() == rows.keys() - bad
    last = {}
    for i, r in kept["quality"].items():
        last.setdefault(r["text"].encode().lower(), []).append(i)
    assert kept["exact_copies"].keys() == {max(g) for g in last.values()}
    left = spark.createDataFrame(list(kept["exact_copies"].values()), docs.schema)
    near = {r["doc_id"] for r in odd_sketch.near_duplicates(left).collect() if r["kept"]}
    assert kept["near_copies"].keys() == near
    left = spark.createDataFrame(list(kept["near_copies"].values()), docs.schema)
    cut = {r["doc_id"]: r for r in block_anchors.remove_repeats(left, texts=True).collect()}
    assert kept["repeated_passages"].keys() == near
    for i, r in kept["repeated_passages"].items():
        whole = rows[i]
        text = cut[i]["kept"] if cut[i]["n_removed"] else whole["text"]
        assert (r["text"], r["n_chars"]) == (text, len(text)) and (r["lang"], r["source"]) == (whole["lang"], whole["source"])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {i: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in kept["repeated_passages"].items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    packed = {}
    for p in pieces:
        packed[p["doc_id"]] = packed.get(p["doc_id"], 0) + p["length"]
    assert packed == sizes
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        (p["doc_id"], p["start"], p["length"], p["ids_crc32"]) for p in pieces
    )


def test_rows_without_ids_and_repeated_rows(spark, corpus):
    data = [(i, t, "en", "s", len(t or "")) for i, t in corpus]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = staged(stage(spark, docs, SF_DIR), name)
    left = [r["text"] for r in docs.collect() if r["text"]]
    assert len(left) == len(set(left))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()


DDL = "doc_id long, text string, lang string, source string, n_chars long"


def test_names_that_clash_null_ids_and_empty_tables(spark, corpus):
    """Columns named like those in use inside, with dots and ticks, go through every stage untouched."""
    more = ["_digest", "digest", "digest_", "_id", "_key", "text_key", "kept", "words_removed", "chunk", "a.b", "c`d", "label"]
    data = [(i, t, "en", None, len(t or ""), *(f"{c} of {i}" for c in more)) for i, t in corpus[:120]]
    wide = DDL + ", " + ", ".join(f"`{c.replace('`', '``')}` string" for c in more)
    docs = spark.createDataFrame(data, wide)
    given = {r[0]: r[5:] for r in docs.collect()}
    empty = spark.createDataFrame([], wide)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = staged(stage(spark, docs, SF_DIR), name), staged(stage(spark, empty, SF_DIR), name)
        assert docs.columns == empty.columns == ["doc_id", "text", "lang", "source", "n_chars", *more], name
        assert empty.count() == 0
    rows = docs.collect()
    assert rows and all(tuple(f"{c} of {r[0]}" for c in more) == r[5:] for r in rows) and given
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF_DIR).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= len(rows)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert ORACLE.keys() <= QUERIES.keys()
