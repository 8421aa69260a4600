"""Near-duplicates by MinHash bands, odd sketches and exact confirmation.

A document is the set of its distinct 4-word shingles. Documents with one and the same set form a class, which goes on as
one representative. MinHash samples of a representative give bands, whose hashes propose candidates, and are folded into an
odd sketch: a bitmap in which every sample flips one bit. The exclusive-or of two sketches has about as many bits as the
samples differ in, so its population count tells highly similar pairs precisely from others. What passes is confirmed on
the full sets: 100 * intersection >= 80 * union.

Buckets don't give all pairs. Every member is compared with one centre of its buckets first; the links found join most
members. Then members of a bucket are compared across the components that are still apart: two members that are joined
already need no link of their own. In a small bucket all of them are. Full buckets that share members make a group, whose
members are told apart by what differs from the set of shingles that most of them have: a pair whose differences have nothing
in common is similar only if both are similar to the member that differs least, too, and any other similar pair shares some
of its rarest differences, on which it meets (a prefix filter). So no pair is lost, and no group is squared: what is compared
are members with edits in common.

Samples suffice to miss a pair at the threshold with a probability below 1e-7.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; fewer than four
words are one shingle. Links join ids, so rows that share an id are one document. A row without an id is a document of its
own (with its equals) that ranks after all others; a component of such rows alone has no id. Ids are below 2**62. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, discard, mix, staged
from tidemark.llm.components import components
from tidemark.llm.words import LOWER, rolling, word_hashes
from tidemark.operators.skew import left_join

SHINGLE = 4
SAMPLES = 128
BANDS = 32
ROWS = SAMPLES // BANDS
SKETCH_BITS = 512
#: In hundredths of the Jaccard similarity.
THRESHOLD = 80
#: A pair goes to confirmation if its sketches differ in no more bits: what similarity 0.5 leaves on average, about six
#: deviations from what 0.8 does. Of d samples that differ 2 * d bits are flipped, some twice.
MOST_BITS = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - 0.5) / SKETCH_BITS)))
#: Members up to which a bucket is compared in full where members are apart.
SMALL = 64
#: Rows without an id stand in the graph under numbers from here on.
NO_ID = 1 << 62
#: Ids that a broadcast may hold (8 bytes each); beyond it the join shuffles.
FEW_IDS = 1_000_000
STEP = 1 << 18

_FACTORS = mix(np.arange(SAMPLES), 11) | np.uint64(1)
_SHIFTS = mix(np.arange(SAMPLES), 12)


def shingles(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of every document."""
    hashes, words = word_hashes(LOWER[data], offsets)
    rolled = rolling(hashes, SHINGLE, SHINGLE)
    found = []
    for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            found.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            found.append(rolling(hashes[a:b], b - a, b - a))
        else:
            found.append(hashes[:0])
    return found


def samples(own: np.ndarray) -> np.ndarray:
    """The smallest value of a set under each of SAMPLES hash functions."""
    least = np.full(SAMPLES, 2**64 - 1, np.uint64)
    for i in range(0, len(own), 2048):
        least = np.minimum(least, ((own[i : i + 2048, None] ^ _SHIFTS) * _FACTORS).min(axis=0))
    return least


def sketch(least: np.ndarray) -> np.ndarray:
    """The samples folded into parities: SKETCH_BITS bits as signed longs."""
    bit = (mix(least, 13) ^ mix(np.arange(SAMPLES), 14)) % np.uint64(SKETCH_BITS)
    parity = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view("<i8")


def bands(least: np.ndarray) -> np.ndarray:
    """A hash of each band's samples."""
    rows = least.reshape(BANDS, ROWS)
    out = mix(np.arange(BANDS), 15)
    for r in range(ROWS):
        out = mix(out ^ rows[:, r], 16 + r)
    return out


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row and shingles of every document of a batch, worked on in small groups."""
    data, offsets = bytes_of(batch.column("text"))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + STEP, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield from enumerate(shingles(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]), start)
        start = end


def signatures(docs: DataFrame) -> DataFrame:
    """n_shingles, a 128-bit digest of the set, sketch and bands of every row (doc_id, text_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches, banded = [], [], [], []
            for _, own in _each(batch):
                sizes.append(len(own))
                if len(own):
                    least = samples(own)
                    # Sums of mixed hashes don't depend on order and tell sets apart.
                    digests.append(np.array([mix(own, 17).sum(), mix(own, 18).sum()], np.uint64).tobytes())
                    sketches.append(sketch(least).tolist())
                    banded.append(bands(least).astype(np.int64).tolist())
                else:
                    digests.append(None)
                    sketches.append(None)
                    banded.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, longs),
                    pa.array(banded, longs),
                ],
                ["doc_id", "text_key", "n_shingles", "digest", "sketch", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, text_key long, n_shingles long, digest binary, sketch array<long>, bands array<long>")


def _full_sets(docs: DataFrame) -> DataFrame:
    """The full set of every row as packed sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [own.tobytes() for _, own in _each(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def _set_lists(docs: DataFrame) -> DataFrame:
    """The full set of every row as a list, once for rows of one id with equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [own.view(np.int64) for _, own in _each(batch)]
            values = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, values)], ["doc_id", "shingles"])

    rows = docs.mapInArrow(run, "doc_id long, shingles array<long>").withColumn("row", F.xxhash64("shingles"))
    return rows.dropDuplicates(["doc_id", "row"])


def _few_bits(a: str, b: str) -> str:
    """SQL for the population count of the exclusive-or of two sketches."""
    words = SKETCH_BITS // 64
    return " + ".join(f"bit_count({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(words)) + f" <= {MOST_BITS}"


def _alike(a: str, b: str) -> str:
    """What a pair must meet before its sets are looked at: sizes that allow the similarity, and close sketches."""
    sizes = f"100 * least({a}.n_shingles, {b}.n_shingles) >= {THRESHOLD} * greatest({a}.n_shingles, {b}.n_shingles)"
    return f"{sizes} AND {_few_bits(a, b)}"


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the staged pairs (a, b) whose full sets are similar, staged. Only texts in some pair are read again."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    wanted = staged(wanted, "candidates")
    few = F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted
    sets = staged(_full_sets(docs.join(few, "doc_id", "left_semi")), "sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .select("a", "b", "set_a", "set_b")
    )
    found = staged(joined.mapInArrow(run, "a long, b long"), "edges")
    discard(wanted, sets, pairs)
    return found


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n_shingles, digest) and one representative per set (doc_id, n_shingles, digest, sketch, bands)."""
    signed = staged(signatures(docs), "signatures")
    members = signed.select("doc_id", "text_key", "n_shingles", "digest")
    # min of a struct is combined before the shuffle; the id comes first, so the smallest represents the class.
    one = F.min(F.struct("doc_id", "n_shingles", "sketch", "bands")).alias("r")
    representatives = signed.where("digest IS NOT NULL").groupBy("digest").agg(one).select("digest", "r.*")
    return members, staged(representatives, "representatives")


def _similar(pairs: DataFrame, facts: DataFrame, docs: DataFrame) -> DataFrame:
    """The confirmed ones of candidate pairs, whose sizes and sketches are looked at first."""
    near = (
        pairs.join(facts.select(F.col("doc_id").alias("a"), F.struct("n_shingles", "sketch").alias("x")), "a")
        .join(facts.select(F.col("doc_id").alias("b"), F.struct("n_shingles", "sketch").alias("y")), "b")
        .where(_alike("x", "y"))
        .select("a", "b")
    )
    return confirmed(staged(near, "near"), docs)


def links(docs: DataFrame, representatives: DataFrame) -> DataFrame:
    """Labels (doc_id, component) of all representatives that are linked with another."""
    banded = representatives.select("doc_id", F.posexplode("bands").alias("no", "band"))
    # Buckets with company. Map-side combined, so a full bucket is no burden.
    company = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = staged(banded.join(company, "band"), "crowded")
    # Of documents that others were made from, more bands are common: they have most company over all their buckets.
    weight = crowded.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    shared = staged(crowded.join(weight, "doc_id").select("band", "no", "doc_id", "weight"), "buckets")
    discard(crowded)
    facts = representatives.select("doc_id", "n_shingles", "sketch")
    # Each bucket has a centre, the member with most company; each member is compared with one centre of its buckets.
    centre = F.min(F.struct((-F.col("weight")).alias("rank"), "doc_id")).alias("c")
    centres = shared.groupBy("band").agg(centre)
    one = F.min(F.struct("c.rank", "c.doc_id")).alias("c")
    stars = shared.join(centres, "band").where("doc_id <> c.doc_id").groupBy("doc_id").agg(one)
    pairs = stars.select(F.least("doc_id", "c.doc_id").alias("a"), F.greatest("doc_id", "c.doc_id").alias("b")).distinct()
    edges = _similar(pairs, facts, docs)
    labels = components(edges)
    placed = staged(_labelled(shared, labels), "placed")
    discard(shared, labels)
    # Buckets with members apart: their size and the component that most of their members are in.
    counts = placed.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    spread = (F.sum("n").alias("members"), F.max_by("label", F.struct("n", "label")).alias("largest"), F.count(F.lit(1)).alias("labels"))
    apart = staged(counts.groupBy("band").agg(*spread).where("labels > 1").drop("labels"), "apart")
    few = _across_small(placed, apart.where(F.col("members") <= SMALL), representatives)
    full = placed.join(apart.where(F.col("members") > SMALL).select("band"), "band", "left_semi")
    many = _across_full(full, docs)
    found = _similar(staged(few.union(many).distinct(), "across"), facts, docs)
    discard(placed, apart)
    return components(edges.union(found))


def _across_small(placed: DataFrame, apart: DataFrame, representatives: DataFrame) -> DataFrame:
    """Pairs (a, b) of small buckets: the members outside a bucket's largest component with all others.

    A pair meets in the first of its common buckets only.
    """
    open_ = placed.join(apart.select("band", "largest"), "band").join(representatives.select("doc_id", "bands"), "doc_id")
    open_ = staged(open_, "open")
    first = "array_position(zip_with(x.bands, y.bands, (p, q) -> p = q), true) = x.no + 1"
    apart_ = "x.band = y.band AND x.label <> y.label AND (y.label = y.largest OR x.doc_id < y.doc_id)"
    across = open_.where("label <> largest").alias("x").join(open_.alias("y"), F.expr(f"{apart_} AND {first}"))
    return across.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))


def _across_full(full: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of full buckets, given as (band, doc_id, label): all that can be similar and are in two components, or
    as many that joining the similar ones of these joins them all.

    With D the difference of a set from its group's centre and S = 9 * |D| - |set|, two members are similar if and only if
    18 * |D and D'| >= S + S'. The centre decides how many pairs meet, not which are found.
    """
    spark = full.sparkSession
    head = full.groupBy("band").agg(F.min("doc_id").alias("a"))
    if head.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    groups = components(full.join(head, "band").select("a", F.col("doc_id").alias("b")))
    members = full.select("doc_id", "label").distinct().join(groups.withColumnRenamed("component", "group"), "doc_id")
    members = staged(members, "members")
    discard(groups)
    wanted = members.select("doc_id")
    few = F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted
    sets = staged(_set_lists(docs.join(few, "doc_id", "left_semi")), "group-sets")
    members = members.join(sets, "doc_id")
    # The centre: shingles of more than half of a group's members.
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    held = _exploded(members, "shingles").groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("n"))
    centres = held.join(sizes, "group").where("2 * n > members").groupBy("group").agg(F.sort_array(F.collect_list("shingle")).alias("centre"))
    differing = staged(_differences(left_join(members, centres, "group", spread_by=["doc_id"])), "differences")
    discard(sets)
    # The largest component of a group, its least S and the member that has it, and the least S outside that component.
    labels = differing.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("s", "doc_id")).alias("own"))
    per_group = labels.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.min("own").alias("least"))
    outside = labels.join(per_group, "group").where("label <> largest").groupBy("group").agg(F.min("own.s").alias("outside"))
    facts = staged(per_group.join(outside, "group"), "group-facts")
    known = left_join(differing, facts, "group", spread_by=["doc_id"]).where("largest IS NOT NULL")
    by_least = known.where("doc_id <> least.doc_id AND s + least.s <= 0").select(F.col("doc_id").alias("a"), F.col("least.doc_id").alias("b"))
    # Differences by rarity in the group; ties by the hash.
    rare = _exploded(differing, "differs").groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("n"))
    ordered = (
        _exploded(known, "differs", "doc_id", "row", "label", "s", "n_differs", "largest", "least", "outside")
        .join(rare, ["group", "shingle"])
        .groupBy("group", "doc_id", "row", "label", "s", "n_differs", "largest", "least", "outside")
        .agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("ordered"))
    )
    ordered = staged(ordered, "ordered")

    def prefixes(rows: DataFrame, other: str) -> DataFrame:
        """The rarest differences, one of which must be shared for the overlap that a partner with S = other asks for."""
        overlap = F.greatest(F.lit(1), F.ceil((F.col("s") + F.col(other)) / 18)).cast("int")
        longest = F.greatest(F.lit(0), F.col("n_differs") - overlap + 1)
        cut = rows.withColumn("ordered", F.slice("ordered", F.lit(1), longest))
        return cut.select("group", "doc_id", "label", "s", "n_differs", "largest", F.posexplode("ordered").alias("at", "d")).withColumn("shingle", F.col("d.shingle"))

    x = prefixes(ordered.where("label <> largest"), "least.s").alias("x")
    y = prefixes(ordered, "outside").alias("y")
    meet = "x.group = y.group AND x.shingle = y.shingle AND x.label <> y.label AND (y.label = y.largest OR x.doc_id < y.doc_id)"
    # From the first shared difference on, this many can be shared at most.
    reach = "x.s + y.s > 0 AND 18 * least(x.n_differs - x.at, y.n_differs - y.at) >= x.s + y.s"
    sharing = x.join(y, F.expr(f"{meet} AND {reach}")).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
    found = by_least.union(sharing).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = staged(found, "sharing")
    discard(members, differing, facts, ordered)
    return found


def _exploded(rows: DataFrame, lists: str, *others: str) -> DataFrame:
    """(group, shingle) and other columns for every entry of a list."""
    return rows.select("group", *others, F.explode(lists).alias("shingle"))


def _differences(rows: DataFrame) -> DataFrame:
    """doc_id, row, label, group, the difference of every set from the centre, its size and S."""
    centre = F.coalesce("centre", F.array().cast("array<long>"))
    differs = F.concat(F.array_except("shingles", centre), F.array_except(centre, "shingles"))
    found = rows.select("doc_id", "row", "label", "group", F.size("shingles").alias("size"), differs.alias("differs"))
    return found.withColumn("n_differs", F.size("differs")).withColumn("s", (9 * F.col("n_differs") - F.col("size")).cast("long")).drop("size")


def _labelled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with their component, which is their own id as long as they have no link."""
    known = labels.withColumnRenamed("component", "label")
    return shared.join(known, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the smallest id of its component) of every row.

    ``text_key``, a hash of the text, tells rows without an id apart.
    """
    text = F.col(text_col).cast("string")
    stand_in = F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), stand_in).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    members, representatives = _classes(rows)
    labels = links(rows, representatives)
    classes = representatives.select("digest", "doc_id").join(labels, "doc_id", "left")
    classes = classes.select("digest", F.coalesce("component", "doc_id").alias("component"))
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c))
    return (
        members.join(classes, "digest", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .select(
            known("doc_id").alias("doc_id"),
            "text_key",
            "n_shingles",
            known("component").alias("component_id"),
            (F.col("doc_id") == F.col("component")).alias("kept"),
        )
    )
