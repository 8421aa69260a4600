"""Quality rules: base counts, and the divergence of a document's histograms from references of its language.

Two histograms describe a document: its code points by class, and its words by the common words of its language, with one
place for all others. The references are what documents of a language have on average: every document that passes the base
rules and is long enough counts alike, as whole millionths, so that sums are exact in any order and neither a huge document
nor a long text moves them by more than one row. The Jensen-Shannon distance (base 2, 0 to 1) of each histogram from its
reference must not exceed its limit. A small sample is away from its own distribution by chance: a histogram is judged from
a least number of code points or words on, and against a reference of a least number of documents; else it passes.

All of it is built-in functions. Texts are read twice, once to count the documents that hold a word (combined before the
shuffle) and once for the counts of each document, which are written as a small table. Nothing else depends on the number of
documents, and no document is shuffled: references are few and small and meet the documents in a join that Spark broadcasts
by their size and that is salted if it can't.

Defined results: a null or empty text has no words and fails the base rules (``n_words`` below 10). Every row is judged for
itself: repeated rows and rows without an id get the same verdict, and all of them count in the references. Rows without a
language share one reference of their own. Windows of words are equal if their 64-bit hashes are. An empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.operators.skew import left_join

#: The base rules: least words, and most repeated words in hundredths of all.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
#: Common words of a language and their most code points; the words of a document beyond them share one more place.
COMMON, LONGEST = 24, 6
#: Code points and words from which on a histogram is judged, and documents that make a reference.
LEAST_CHARS, LEAST_TERMS, LEAST_DOCUMENTS = 200, 50, 20
#: Largest Jensen-Shannon distances.
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.22, 0.35
WHOLE = 1_000_000

#: The classes of code points, in the order of the histogram; what is in none of them is the last.
CLASSES = {
    "small": "[a-z]+",
    "blank": r"[\x20\x09]+",
    "capital": "[A-Z]+",
    "mark": r"[\x21\x22\x27\x28\x29\x2C\x2D\x2E\x3A\x3B\x3F]+",
    "line": r"[\x0A-\x0D]+",
    "digit": "[0-9]+",
    "symbol": r"[\x23-\x26\x2A\x2B\x2F\x3C-\x3E\x40\x5B-\x60\x7B-\x7E]+",
}
_BREAKS = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
#: The symbols that the base rules count; all of them are in the class of symbols.
_SYMBOLS = r"[\x23\x24\x25\x26\x2A\x3C\x3E\x7C]+"
_BETWEEN_TERMS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _parts(text: Column, pattern: str) -> Column:
    """What is between the matches of a pattern; empty parts are left out."""
    return F.filter(F.split(text, pattern), lambda part: part != "")


def _none() -> Column:
    return F.lit(0).cast("long")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, _none(), lambda total, x: total + x)


def _fewer(before: str, after: Column | str) -> Column:
    """Code points that are in one text and not in what is left of it."""
    return (F.length(before) - F.length(after)).cast("long")


def base_counts(rows: DataFrame, text: str = "_text") -> DataFrame:
    """Adds n_words, n_dup_lines, n_repeat_words and base_failed.

    Repeated windows are found in time n log n: sorted by hash, equal ones are neighbours. Most texts repeat none, which a
    hash table tells without a sort.
    """
    at = F.sequence(F.lit(0), F.size("_hashes") - WINDOW)
    windows = F.transform(at, lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]))
    ordered = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda x, k: F.coalesce(F.get("_ordered", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("_ordered", lambda x, k: same(x, k + 1) | F.when(k > 0, same(x, k - 1)).otherwise(F.lit(False)))
    covered = F.transform("_places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", k + 1) - p, F.lit(WINDOW))).cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_WORD))
    counted = (
        rows.withColumn("_hashes", F.transform(_parts(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), lambda w: F.xxhash64(w)))
        .withColumn("_lines", lines)
        .withColumn("n_words", F.size("_hashes").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_windows", F.when(F.size("_hashes") > WINDOW, windows))
        .drop("_hashes", "_lines")
        .withColumn("_ordered", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), ordered))
        .drop("_windows")
        .withColumn("_places", F.array_sort(F.transform(twice, lambda x: x["i"])))
        .drop("_ordered")
        .withColumn("n_repeat_words", F.coalesce(_total(covered), _none()))
        .drop("_places")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def class_counts(rows: DataFrame, text: str = "_text") -> DataFrame:
    """Adds ``classes``, the code points of every class, and with them word_chars and n_symbols.

    Each class is taken out of what the ones before it have left, so that only the first is looked for in the whole text.
    """

    def take(frame: DataFrame, found: tuple[int, str]) -> DataFrame:
        i, (name, pattern) = found
        left = f"_left{i - 1}" if i else text
        frame = frame.withColumn(f"_left{i}", F.regexp_replace(left, pattern, "")).withColumn(f"_{name}", _fewer(left, f"_left{i}"))
        if name == "symbol":
            frame = frame.withColumn("n_symbols", _fewer(left, F.regexp_replace(left, _SYMBOLS, "")))
        return frame.drop(left) if i else frame

    frame = reduce(take, enumerate(CLASSES.items()), rows)
    last = f"_left{len(CLASSES) - 1}"
    counts = [f"_{name}" for name in CLASSES]
    return (
        frame.withColumn("classes", F.array(*counts, F.length(last).cast("long")))
        .withColumn("word_chars", F.length(text).cast("long") - F.col("_blank") - F.col("_line"))
        .drop(last, *counts)
    )


def common_words(rows: DataFrame, common: int = COMMON) -> DataFrame:
    """_language and _common, the short words that most of its documents hold, in alphabetical order."""
    terms = _parts(F.lower("_text"), _BETWEEN_TERMS)
    held = rows.select("_language", F.explode(F.array_distinct(terms)).alias("word")).where(F.length("word") <= LONGEST)
    counts = held.groupBy("_language", "word").agg(F.count(F.lit(1)).alias("documents"))
    rank = F.row_number().over(Window.partitionBy("_language").orderBy(F.desc("documents"), "word"))
    first = counts.withColumn("rank", rank).where(F.col("rank") <= common)
    return first.groupBy("_language").agg(F.array_sort(F.collect_list("word")).alias("_common"))


def word_counts(rows: DataFrame) -> DataFrame:
    """Adds ``terms``, how often each common word of the language occurs in the text, and all other words together."""
    each = F.transform("_common", lambda c: (F.size("_found") - F.size(F.array_remove("_found", c))).cast("long"))
    return (
        rows.withColumn("_terms", _parts(F.lower("_text"), _BETWEEN_TERMS))
        .withColumn("_found", F.filter("_terms", lambda t: (F.length(t) <= LONGEST) & F.array_contains("_common", t)))
        .withColumn("terms", F.concat(each, F.array((F.size("_terms") - F.size("_found")).cast("long"))))
        .drop("_terms", "_found")
    )


def references(counted: DataFrame, parts: dict[str, int]) -> DataFrame:
    """Per language the mean histogram ``<part>_reference``, in whole millionths, and ``<part>_documents`` behind it."""
    share = lambda part: F.transform(part, lambda x: F.floor(x * WHOLE / _total(F.col(part))))
    found = None
    for part, least in parts.items():
        own = counted.where(~F.col("base_failed") & (_total(F.col(part)) >= least))
        places = own.select("_language", F.posexplode(share(part)).alias("place", "share"))
        sums = places.groupBy("_language", "place").agg(F.sum("share").alias("share"), F.count(F.lit(1)).alias("documents"))
        in_order = F.array_sort(F.collect_list(F.struct("place", "share")))
        mean = sums.groupBy("_language").agg(in_order["share"].alias(f"{part}_reference"), F.max("documents").alias(f"{part}_documents"))
        found = mean if found is None else found.join(mean, "_language", "full")
    return found


def distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance, in base 2, of two histograms of whole numbers; null if one of them has no entries."""
    share = lambda name: F.transform(name, lambda x: x / F.when(_total(F.col(name)) > 0, _total(F.col(name))))
    half = lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))
    terms = F.zip_with(share(counts), share(reference), lambda p, q: half(p, q) + half(q, p))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda total, x: total + x) / 2, F.lit(0.0)))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, the base counts, base_failed, class_distance, word_distance and kept of every row.

    A distance is null where its histogram is not judged.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
        F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit("")).alias("_language"),
    )
    common = staged(common_words(rows), "common-words")
    known = left_join(rows, common, "_language", spread_by=["_text"])
    known = known.withColumn("_common", F.coalesce("_common", F.array().cast("array<string>")))
    kept = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    counted = word_counts(class_counts(base_counts(known)))
    counted = staged(counted.select("doc_id", "_language", *kept, "classes", "terms"), "quality-counts")
    parts = {"classes": LEAST_CHARS, "terms": LEAST_TERMS}
    means = staged(references(counted, parts), "references")
    judged = left_join(counted, means, "_language", spread_by=["doc_id"])

    def away(part: str, least: int) -> Column:
        enough = (_total(F.col(part)) >= least) & (F.col(f"{part}_documents") >= LEAST_DOCUMENTS)
        return F.when(enough, distance(part, f"{part}_reference"))

    within = lambda name, most: F.coalesce(F.col(name) <= most, F.lit(True))
    passed = within("class_distance", MOST_CLASS_DISTANCE) & within("word_distance", MOST_WORD_DISTANCE)
    return (
        judged.withColumn("class_distance", away("classes", LEAST_CHARS))
        .withColumn("word_distance", away("terms", LEAST_TERMS))
        .select("doc_id", *kept, "class_distance", "word_distance", (~F.col("base_failed") & passed).alias("kept"))
    )
