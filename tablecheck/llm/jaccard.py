"""Exact Jaccard self-join on word shingles by a grouped prefix join.

1. Each text becomes its set of distinct shingles (64-bit hashes), held in a global order: the rarest
   first.  The order uses the commonest shingles of the corpus (a table of at most
   ``common`` entries, counted over all documents); all others tie and are ordered by hash.
   Any fixed order gives the same links; this one keeps common passages out of prefixes.
2. Texts with equal sets form a class; classes with equal prefix and size form a group.
   Two sets that link share a shingle of their prefixes, so groups are joined on prefix shingles, in
   cells of one shingle and one band of sizes.
3. Links are wanted up to their components, so no cell emits all its pairs.  First every group is compared with its
   cell's smallest group, and every member with its group's smallest member (a number of pairs
   linear in the prefixes).  Candidates pass a size filter and a parity bitmap that bounds
   the symmetric difference from below; survivors are verified on the whole sets.
4. Components of these links are computed, and only then all remaining candidate pairs, those
   of one cell whose components differ, are expanded and verified in the same way; two components that meet in many
   cells meet once, with all their members.  Pairs inside one component cannot change it.  The result is exact.

Edge cases: a null text or one without words has no shingles and links with nothing; a text of fewer
words than a shingle is one shingle; a null id links with nothing and has no component; a row that repeats an
id is judged by its own text, under that id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import connected_components, materialise, mix, ragged, shingle_hashes, signed, word_hashes

#: Bits of the smallest sketch; a sketch has about one bit for every two shingles.
LEAST_BITS = 256
#: Members of a component that meet another component's in one part.
PART = 1000


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingles of the lower-cased words (A-Z only)."""
    if not text:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(text.encode("utf-8", "replace").lower().split()), k))


def common_shingles(df: DataFrame, text_col: str, k: int, common: int, block: int = 4_000_000, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The corpus's commonest shingles, sorted, with their places in rising order of frequency.

    Every block of about ``block`` shingles reports those that ``least`` of its documents hold;
    the reports are summed over all blocks, and the ``common`` largest sums are kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held = [], 0

        def report() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= least
            return pa.RecordBatch.from_arrays([pa.array(signed(values[often])), pa.array(counts[often])], names=["h", "n"])

        for batch in batches:
            for text in batch.column(0):
                sets.append(shingle_set(text.as_py(), k))
                held += len(sets[-1])
                if held >= block:
                    yield report()
                    sets, held = [], 0
        if held:
            yield report()

    sums = df.select(text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = sums.orderBy(F.desc("n"), "h").limit(common).toPandas()  # at most `common` rows
    values = rows["h"].to_numpy(np.int64).view(np.uint64)
    place = np.arange(len(values), 0, -1, dtype=np.int64)
    order = np.argsort(values)
    return values[order], place[order]


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def shingle_table(df: DataFrame, id_col: str, text_col: str, k: int, percent: int, common: int) -> DataFrame:
    """``(id, n, set_id, prefix_id, prefix, sketch)`` for every row."""
    shared = df.sparkSession.sparkContext.broadcast(common_shingles(df, text_col, k, common))  # at most `common` entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, place = shared.value
        for batch in batches:
            n, set_ids, prefix_ids, prefixes, sketches = [], [], [], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k)
                n.append(len(s))
                set_ids.append(xxhash.xxh3_128_digest(s.tobytes()))
                if len(values) and len(s):
                    at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                    s = s[np.lexsort((s, np.where(values[at] == s, place[at], 0)))]
                prefix = s[: prefix_length(len(s), percent)] if len(s) else s
                prefixes.append(prefix)
                prefix_ids.append(xxhash.xxh3_128_digest(prefix.tobytes()))
                sketches.append(parity_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(set_ids, pa.binary()), pa.array(prefix_ids, pa.binary()), ragged(signed(np.concatenate(prefixes)), [len(p) for p in prefixes[1:]], pa.int64()), ragged(signed(np.concatenate(sketches)), [len(p) for p in sketches[1:]], pa.int64())],
                names=["id", "n", "set_id", "prefix_id", "prefix", "sketch"],
            )

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, n long, set_id binary, prefix_id binary, prefix array<long>, sketch array<long>")


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Bit b tells whether an odd number of the shingles hash to b; the width, a power of two, grows with the set.

    Shared shingles cancel, so two sketches differ in at most as many bits as their sets have shingles apart.
    Unrelated sets differ in about half the bits, more than a link allows."""
    width = max(LEAST_BITS, 1 << (len(s) // 2).bit_length())
    bits = np.bincount((mix(s) % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def _may_link(percent: int) -> Column:
    """Size and bitmap filters on ``a_n, a_sketch, b_n, b_sketch``: true for every pair that links."""
    a, b = F.col("a_sketch"), F.col("b_sketch")

    def folded(x: Column) -> Column:  # to half the width: bits that meet modulo the smaller width cancel or stay
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
    a, b = F.when(F.size(a) > F.size(b), folded(a)).otherwise(a), F.when(F.size(b) > F.size(a), folded(b)).otherwise(b)
    differ = F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, x: n + x)
    return F.when(_sizes(percent), (100 + percent) * differ <= (100 - percent) * (F.col("a_n") + F.col("b_n"))).otherwise(False)


def _sizes(percent: int) -> Column:
    return 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}" if c in ("n", "sketch") else side if c == "id" else c) for c in df.columns])


def verified(pairs: DataFrame, df: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole shingle sets link.  Only the texts of documents in a pair are turned into sets again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                sets = [shingle_set(t.as_py(), k) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), ragged(signed(np.concatenate(sets)), list(map(len, sets)), pa.int64())], names=["id", "shingles"])

    pairs = materialise(pairs, "pairs")
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    texts = df.select(F.col(id_col).alias("id"), text_col).join(ids, "id", "left_semi")
    kind = df.select(id_col).schema[0].dataType.simpleString()
    sets = materialise(texts.mapInArrow(run, f"id {kind}, shingles array<long>"), "sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    inter = F.size(F.array_intersect("x", "y"))
    return both.where(100 * inter >= percent * (F.size("x") + F.size("y") - inter)).select("a", "b").distinct()


def across(place: DataFrame, inside: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of two components that share a cell and may link, with repeats; ``inside`` holds all members ``(id, n, sketch, c)``, ``place`` those of each cell.

    Copies of one text share most of their cells.  Where the cells of two components hold more pairs than their members make,
    all members meet once instead, so a pair is not made again for every cell.
    """
    # A cell's components meet once each; two that have one member there meet only if their members may link.
    met = place.groupBy("key", "band", "c").agg(F.count("*").alias("m"), F.min(F.struct("n", "sketch")).alias("one"))
    met = materialise(met.select("key", "band", "c", "m", "one.n", "one.sketch"), "met")
    x, y = _side(met, "a").withColumnsRenamed({"c": "x", "m": "mx"}), _side(met, "b").withColumnsRenamed({"c": "y", "m": "my"})
    pairs = x.join(y, ["key", "band"]).where((F.col("x") < F.col("y")) & ((F.col("mx") > 1) | (F.col("my") > 1) | _may_link(percent)))
    pairs = materialise(pairs.select("key", "band", "x", "y", (F.col("mx") * F.col("my")).alias("made")), "meetings")

    size = inside.groupBy("c").agg(F.count("*").alias("m"))
    whole = pairs.groupBy("x", "y").agg(F.sum("made").alias("made"))
    whole = whole.join(size.select(F.col("c").alias("x"), F.col("m").alias("mx")), "x").join(size.select(F.col("c").alias("y"), F.col("m").alias("my")), "y")
    whole = materialise(whole.where(F.col("made") > F.col("mx") * F.col("my")), "whole")
    half = pairs.join(whole, ["x", "y"], "left_anti").select("key", "band", "x", "y").join(_side(place, "a").withColumnRenamed("c", "x"), ["key", "band", "x"])
    by_cell = half.join(_side(place, "b").withColumnRenamed("c", "y"), ["key", "band", "y"]).where(_may_link(percent)).select("a", "b")

    # The smaller component's members go to every part of the larger one.
    flip, parts = F.col("mx") < F.col("my"), F.ceil(F.greatest("mx", "my") / PART)
    ends = whole.select(F.when(flip, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(flip, F.col("x")).otherwise(F.col("y")).alias("y"), parts.alias("parts"))
    large = _side(inside.select("id", "n", "sketch", F.col("c").alias("x")).join(ends.select("x", "parts").distinct(), "x"), "a").withColumn("part", F.pmod(F.xxhash64("a"), "parts"))
    small = _side(inside.select("id", "n", "sketch", F.col("c").alias("y")), "b").join(ends, "y").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    at_once = large.drop("parts").join(small.drop("parts"), ["x", "part"]).where(_may_link(percent)).select("a", "b")
    return by_cell.unionAll(at_once)


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85, common: int = 200_000) -> DataFrame:
    """``(id, n_shingles, component_id)``: rows link when 100 * intersection >= percent * union."""
    table = materialise(shingle_table(df, id_col, text_col, k, percent, common), "shingles")
    full = table.where("n > 0 and id is not null")
    classes = full.groupBy("set_id", "n").agg(F.min("id").alias("id"), F.first("prefix_id").alias("prefix_id"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"))
    groups = classes.groupBy("prefix_id", "n").agg(F.min("id").alias("g"), F.first("prefix").alias("prefix"))
    groups = materialise(groups, "groups")
    members = materialise(classes.drop("prefix").join(groups.drop("prefix"), ["prefix_id", "n"]).select("id", "n", "sketch", "g", "set_id"), "members")
    nodes = members.select("id", "n", "sketch")

    postings = groups.select("g", "n", F.explode("prefix").alias("key"))
    live = postings.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi").select("key")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / (percent - 1)))
    cells = materialise(postings.join(live, "key").select("g", "n", "key", F.explode(F.array(band, band + 1)).alias("band")), "cells")

    first = cells.groupBy("key", "band").agg(F.min(F.struct("g", "n")).alias("first"))
    star = cells.join(first, ["key", "band"]).select(F.col("first.g").alias("a"), F.col("first.n").alias("a_n"), F.col("g").alias("b"), F.col("n").alias("b_n")).where((F.col("a") != F.col("b")) & _sizes(percent)).select("a", "b")
    star = star.unionAll(members.where("id <> g").select(F.col("g").alias("a"), F.col("id").alias("b"))).distinct()
    star = star.join(_side(_as(nodes, "a"), "a"), "a").join(_side(_as(nodes, "b"), "b"), "b").where(_may_link(percent)).select("a", "b").distinct()
    links = materialise(verified(star, df, id_col, text_col, k, percent), "links")

    joined = connected_components(links)
    inside = materialise(members.join(joined.withColumnRenamed("node", "id"), "id", "left").select("id", "n", "sketch", "g", F.coalesce("component", "id").alias("c")), "inside")
    spread = cells.join(inside.select("g", "c").distinct(), "g")
    mixed = spread.groupBy("key", "band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key", "band")
    place = materialise(cells.join(mixed, ["key", "band"]).select("key", "band", "g").join(inside, "g").select("key", "band", "c", "id", "n", "sketch"), "place")
    rest = across(place, inside, percent).distinct()
    # Groups of one prefix and size whose members fell into several components.
    split = inside.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("g")
    within = inside.join(split, "g").select("g", "c", "id", "n", "sketch")
    pairs = within.select("g", F.col("c").alias("ca")).distinct().join(within.select("g", F.col("c").alias("cb")).distinct(), "g").where("ca < cb")
    within = pairs.join(_side(_as(within, "a").withColumnRenamed("c", "ca"), "a"), ["g", "ca"]).join(_side(_as(within, "b").withColumnRenamed("c", "cb"), "b"), ["g", "cb"]).where(_may_link(percent)).select("a", "b")
    more = verified(rest.unionAll(within).distinct(), df, id_col, text_col, k, percent)
    final = connected_components(materialise(links.unionAll(more), "links"))

    owner = members.select("set_id", "id").join(final.withColumnRenamed("node", "id"), "id", "left").groupBy("set_id").agg(F.min(F.coalesce("component", "id")).alias("component"))
    rows = table.select("id", "n", "set_id").join(owner, "set_id", "left")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def _as(nodes: DataFrame, side: str) -> DataFrame:
    return nodes.withColumnRenamed("id", side)
