"""The registered queries of the corpus operators and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    block_anchors,
    byte_bpe,
    divergence_rules,
    fourier_quality,
    geometric_search,
    mixture_packing,
    multi_index,
    odd_sketch,
    perfect_hash,
    polar_whitening,
    subsequence_extract,
    suffix_dedup,
    warc_salvage,
)
from tidemark.llm.common import table


#: Closes every document in the packed sequences.
END_TOKEN = 2


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return mixture_packing.pack(table(spark, sf_dir, "documents"), path, END_TOKEN, added_tokens=True)


def op3_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_anchors.remove_repeats(table(spark, sf_dir, "documents"))


def op4_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op5_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_salvage.page_records(table(spark, sf_dir, "pages"))


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fourier_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("text_key")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.code_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op9_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, incoming = perfect_hash.split_at_median(table(spark, sf_dir, "documents"))
    return perfect_hash.exact_dedup(history, incoming).drop("historical")


def op10_subsequence_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subsequence_extract.extract_pages(table(spark, sf_dir, "pages"))


def op11_geometric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometric_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_polar_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polar_whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules.quality_verdicts(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_mixture_packing,
        op3_block_anchors,
        op4_odd_sketch,
        op5_warc_salvage,
        op6_multi_index,
        op7_fourier_quality,
        op8_byte_bpe,
        op9_perfect_hash_dedup,
        op10_subsequence_extract,
        op11_geometric_search,
        op12_polar_whitening,
        op13_divergence_rules,
    )
}

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
 h AS (SELECT doc_id, unnest(range(1, n - 98)) AS i,
              unnest(list_transform(range(1, n - 98), lambda k: md5(substr(x, 2 * k - 1, 200)))) AS h FROM b WHERE n >= 100),
 f AS (SELECT h, min(doc_id * 4294967296 + i) AS first_place FROM h GROUP BY h),
 g AS (SELECT doc_id, i FROM h JOIN f USING (h) WHERE first_place < doc_id * 4294967296 + i),
 marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM g),
 numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
 runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 99 AS z FROM numbered GROUP BY doc_id, run),
 parts AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS s, a - 1 AS e FROM runs
           UNION ALL SELECT b.doc_id, coalesce(max(z), 0) + 1, any_value(n) FROM b LEFT JOIN runs USING (doc_id) GROUP BY b.doc_id),
 kept AS (SELECT doc_id, string_agg(substr(x, 2 * s - 1, 2 * (e - s + 1)), '' ORDER BY s) AS x
          FROM parts JOIN b USING (doc_id) GROUP BY doc_id),
 sums AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed FROM runs GROUP BY doc_id)
SELECT b.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.x)) AS kept_sha256
FROM b JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)""",
    "op3_block_anchors": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 h AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i,
              unnest(list_transform(range(1, len(ws) - 48), lambda k: md5(array_to_string(ws[k:k + 49], ' ')))) AS h
       FROM w WHERE len(ws) >= 50),
 f AS (SELECT h, min(doc_id) AS first_id FROM h GROUP BY h),
 gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM h JOIN f USING (h) WHERE first_id < doc_id),
 words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
          FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op4_odd_sketch": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE
              list_distinct(list_transform(range(1, len(ws) - 2), lambda k: array_to_string(ws[k:k + 3], ' '))) END AS sh FROM w),
 u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
 pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id
           GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
 near AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
 reach(doc_id, other) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, n.b FROM reach r JOIN near n ON r.other = n.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(other) AS component_id, s.doc_id = min(other) AS kept
FROM s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, sh""",
    "op5_warc_salvage": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
 d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
 f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first_id < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.digest = d.digest AND d.n >= 100""",
    "op9_perfect_hash_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS digest FROM documents),
 g AS (SELECT digest, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY digest)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.digest AS text_sha256
FROM d JOIN g ON g.digest = d.digest""",
    "op11_geometric_search": r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
 q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
 s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM t WHERE len(ts) > 0),
 m AS (SELECT doc_id, ts, 100 - 90 + ((90 * len(ts) * n_docs) // n_terms) AS m FROM t, s WHERE len(ts) > 0),
 p AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(ts) AS term FROM m) GROUP BY doc_id, m, term),
 w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
       FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
 scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN w USING (term) GROUP BY item_id, doc_id),
 r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
       FROM scores WHERE score > 0)
SELECT * FROM r WHERE rank <= 10""",
    "op13_divergence_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || lang, '') AS g FROM documents),
 w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, regexp_extract_all(lower(t), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ts,
              list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
 v AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i,
              unnest(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))) AS s FROM w WHERE len(ws) > 5),
 twice AS (SELECT doc_id, i FROM v QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
 steps AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step FROM twice),
 repeats AS (SELECT doc_id, CAST(sum(step) AS BIGINT) AS n FROM steps GROUP BY doc_id),
 base AS (SELECT w.*, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
   CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
   CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
   FROM w LEFT JOIN repeats USING (doc_id)),
 b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
   length(regexp_replace(t, '[^a-z]', '', 'g')) AS c0, length(regexp_replace(t, '[^\x20\x09]', '', 'g')) AS c1,
   length(regexp_replace(t, '[^A-Z]', '', 'g')) AS c2, length(regexp_replace(t, '[^\x21\x22\x27\x28\x29\x2C\x2D\x2E\x3A\x3B\x3F]', '', 'g')) AS c3,
   length(regexp_replace(t, '[^\x0A-\x0D]', '', 'g')) AS c4, length(regexp_replace(t, '[^0-9]', '', 'g')) AS c5,
   length(regexp_replace(t, '[^\x23-\x26\x2A\x2B\x2F\x3C-\x3E\x40\x5B-\x60\x7B-\x7E]', '', 'g')) AS c6 FROM base),
 words AS (SELECT doc_id, g, unnest(ts) AS word FROM b),
 held AS (SELECT g, word, count(DISTINCT doc_id) AS n FROM words WHERE length(word) <= 6 GROUP BY g, word),
 common AS (SELECT g, word FROM held QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC, word) <= 24),
 found AS (SELECT doc_id, word, count(*) AS x FROM words JOIN common USING (g, word) GROUP BY doc_id, word),
 counts AS (
   SELECT doc_id, g, base_failed, 'class' AS part, unnest(['0', '1', '2', '3', '4', '5', '6', '7']) AS place,
     unnest([c0, c1, c2, c3, c4, c5, c6, length(t) - c0 - c1 - c2 - c3 - c4 - c5 - c6]) AS x, length(t) AS total FROM b
   UNION ALL SELECT doc_id, g, base_failed, 'word', word, coalesce(x, 0), len(ts) FROM b JOIN common USING (g) LEFT JOIN found USING (doc_id, word)
   UNION ALL SELECT doc_id, g, base_failed, 'word', '', len(ts) - coalesce(y, 0), len(ts)
     FROM b LEFT JOIN (SELECT doc_id, sum(x) AS y FROM found GROUP BY doc_id) USING (doc_id)),
 long AS (SELECT * FROM counts WHERE total >= CASE part WHEN 'class' THEN 200 ELSE 50 END),
 shares AS (SELECT g, part, place, sum(floor(x * 1000000 / total)) AS q, count(*) AS documents FROM long WHERE NOT base_failed GROUP BY g, part, place),
 means AS (SELECT g, part, place, q / sum(q) OVER (PARTITION BY g, part) AS q FROM shares WHERE documents >= 20),
 pairs AS (SELECT doc_id, part, x / total AS p, q FROM long JOIN means USING (g, part, place)),
 apart AS (SELECT doc_id, part, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
     + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS distance FROM pairs GROUP BY doc_id, part),
 far AS (SELECT DISTINCT doc_id FROM apart WHERE distance > CASE part WHEN 'class' THEN 0.22 ELSE 0.35 END)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND f.doc_id IS NULL AS kept
FROM b LEFT JOIN far f ON f.doc_id = b.doc_id""",
}
