"""Approximate nearest neighbours by an inverted multi-index (Babenko and Lempitsky, 2012).

1. Vectors are lengthened by one component so that the largest inner product is the smallest Euclidean distance
   (``sqrt(M^2 - |x|^2)``, zero for queries; ``M`` the largest norm), and cut into two halves.
2. Each half has its own centroids, fitted by k-means on a bounded sample; a pair of centroids is a cell, and every vector lies in
   the cell of its nearest pair. There are about ``occupancy`` vectors a cell.
3. A query goes through the cells by summed distance of their two centroids, by a heap over the two sorted
   lists (the multi-sequence algorithm), until the cells passed hold ``share`` of the table, but ``least`` vectors at least. The share
   is calibrated on the sample: that at which ``target`` of the true neighbours of sampled queries are reached. It is small
   for clustered vectors and large for vectors without structure.
4. Cells are dealt into bins of at most ``block`` vectors, neighbouring cells together; a larger cell has several
   bins. A query travels once to each bin that holds one of its cells, and all entries there are reranked by their exact
   inner product.

Skew: equal vectors are one entry, which carries its number of rows only through its smallest ids, so a vector that a third of the rows
hold is combined before the shuffle; centroids follow the density of the sample, so dense regions have many cells.

Bounds: the sample holds at most ``max_sample`` vectors and ``max_floats`` numbers; at most ``max_centroids`` centroids for a half, so the
driver and each task hold at most ``max_centroids ** 2`` cell counts and bins.

Edge cases: a vector that is null, empty, zero or holds a null or a non-finite component takes no part, nor does a null id;
shorter vectors count as ending in zeros; rows that repeat an id and its vector are one row, and of different vectors of one id the one with the
smallest digest takes part; ties go to the smaller id; with fewer candidates all are returned; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_name, materialise

#: Slack for what a matrix product rounds, before the exact inner product decides.
SLACK = 1e-9


def usable(values: list | None) -> np.ndarray | None:
    """The vector in double precision without zeros at its end, or None if it takes no part."""
    if not values or None in values:
        return None
    v = np.asarray(values, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    return v[: np.flatnonzero(v)[-1] + 1] + 0.0  # + 0.0: no negative zeros


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one query with rows, each summed in the order of the components."""
    return np.cumsum(x * q, axis=1)[:, -1]


def _rows(raw: list[bytes], size: int) -> np.ndarray:
    """Vectors of ``size`` components from their bytes."""
    out = np.zeros((len(raw), size))
    for i, r in enumerate(raw):
        v = np.frombuffer(r, np.float64)
        out[i, : len(v)] = v
    return out


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    norms = (centroids**2).sum(1)
    for lo in range(0, len(x), 4096):
        out[lo : lo + 4096] = (norms - 2 * x[lo : lo + 4096] @ centroids.T).argmin(1)
    return out


def k_means(x: np.ndarray, k: int, steps: int = 8, seed: int = 7) -> np.ndarray:
    """``k`` centroids at most, started from different rows."""
    x_distinct = np.unique(x, axis=0)
    centroids = x_distinct[np.random.default_rng(seed).permutation(len(x_distinct))[:k]]
    for _ in range(steps):
        near = _nearest(x, centroids)
        n = np.bincount(near, minlength=len(centroids))
        sums = np.stack([np.bincount(near, x[:, j], len(centroids)) for j in range(x.shape[1])], 1)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


@dataclass
class Index:
    """Centroids of the two halves, the largest norm and, once dealt, each cell's bins."""

    size: int
    norm: float
    halves: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray | None = None
    first_bin: np.ndarray | None = None
    n_bins: np.ndarray | None = None

    def parts(self, x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x**2).sum(1), 0))
        cut = self.size // 2
        return x[:, :cut], np.hstack((x[:, cut:], extra[:, None]))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_nearest(p, c) for p, c in zip(self.parts(x, False), self.halves))
        return a * len(self.halves[1]) + b

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(((p[:, None, :] - c[None]) ** 2).sum(2)[0] for p, c in zip(self.parts(q[None], True), self.halves))

    def traverse(self, q: np.ndarray) -> Iterator[int]:
        """Cells by summed distance of their two centroids."""
        d1, d2 = self.distances(q)
        o1, o2 = d1.argsort(kind="stable"), d2.argsort(kind="stable")
        s1, s2, o1, o2 = d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist()
        width, heap, ahead = len(o2), [(s1[0] + s2[0], 0, 0)], [0] * len(o1)  # ahead: columns done in each row
        while heap:
            _, i, j = heapq.heappop(heap)
            yield o1[i] * width + o2[j]
            ahead[i] = j + 1
            if i + 1 < len(o1) and ahead[i + 1] == j:
                heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
            if j + 1 < width and (i == 0 or ahead[i - 1] > j + 1):
                heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))

    def deal(self, counts: np.ndarray, block: int) -> None:
        """Neighbouring cells into bins of at most ``block`` vectors; larger cells have bins of their own."""
        self.counts, self.first_bin, self.n_bins = counts, np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
        width = len(self.halves[1])
        along = [_line(c) for c in self.halves]
        bin_, held = 0, 0
        for a in along[0]:
            for b in along[1]:
                cell = int(a) * width + int(b)
                n = int(counts[cell])
                if n > block:
                    bin_ += held > 0
                    self.first_bin[cell], self.n_bins[cell] = bin_, -(-n // block)
                    bin_, held = bin_ + int(self.n_bins[cell]), 0
                elif n:
                    if held + n > block:
                        bin_, held = bin_ + 1, 0
                    self.first_bin[cell] = bin_
                    held += n
        self.total_bins = bin_ + (held > 0)

    def visited(self, q: np.ndarray, wanted: int) -> list[int]:
        """Bins of the cells that a query passes until they hold ``wanted`` vectors."""
        found: set[int] = set()
        counts, first, n = self.counts, self.first_bin, self.n_bins
        for cell in self.traverse(q):
            if counts[cell]:
                found.update(range(int(first[cell]), int(first[cell] + n[cell])))
                wanted -= int(counts[cell])
                if wanted <= 0 or len(found) == self.total_bins:
                    break
        return sorted(found)


def _line(centroids: np.ndarray) -> np.ndarray:
    """An order of centroids along the direction in which they differ most."""
    x = centroids - centroids.mean(0)
    return np.argsort(x @ np.linalg.svd(x, full_matrices=False)[2][0], kind="stable")


def calibrate(index: Index, sample: np.ndarray, n_rows: int, top: int, target: float, queries: int = 200) -> float:
    """The share of the table at which ``target`` of the neighbours of sampled queries are reached."""
    if len(sample) < 2:
        return 1.0
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=len(index.halves[0]) * len(index.halves[1]))
    k = max(1, round(top * len(sample) / n_rows))
    reached = []
    for q in range(0, len(sample), max(1, len(sample) // queries)):
        score = sample @ sample[q]
        score[q] = -np.inf
        near = np.argpartition(-score, min(k, len(sample) - 1) - 1)[:k]
        wanted, passed = set(cells[near].tolist()), 0
        at = {}
        for cell in index.traverse(sample[q]):
            passed += int(counts[cell])
            if cell in wanted:
                wanted.remove(cell)
                at[cell] = passed / len(sample)
                if not wanted:
                    break
        reached += [at[c] for c in cells[near].tolist()]
    return float(np.quantile(reached, target))


def fit(entries: DataFrame, n_rows: int, size: int, norm: float, top: int, target: float, occupancy: int, max_sample: int, max_floats: int, max_centroids: int) -> tuple[Index, float]:
    """Centroids and the calibrated share, from a bounded sample of the entries chosen by a hash."""
    wanted = max(2, min(max_sample, max_floats // size))
    chosen = entries.select("vec") if n_rows <= wanted else entries.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 1.1 * wanted / n_rows))).select("vec").limit(wanted)
    sample = _rows([bytes(r[0]) for r in chosen.collect()], size)  # at most max_sample vectors and max_floats numbers
    k = int(np.clip(np.sqrt(n_rows / occupancy), 2, max_centroids))
    index = Index(size, norm, ())
    index.halves = tuple(k_means(p, k) for p in index.parts(sample, False))
    return index, calibrate(index, sample, n_rows, top, target)


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, key, vec, norm)`` of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [usable(v) for v in batch.column(1).to_pylist()]
            at = [i for i, v in enumerate(found) if v is not None]
            raw = [found[i].tobytes() for i in at]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary()), pa.array([float(np.linalg.norm(found[i])) for i in at], pa.float64())], names=["id", "key", "vec", "norm"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.where(F.col(id_col).isNotNull()).select(id_col, vec_col).mapInArrow(run, f"id {kind}, key binary, vec binary, norm double")


def _cell_counts(entries: DataFrame, index: Index) -> np.ndarray:
    shared = entries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.cells(_rows(batch.column(0).to_pylist(), shared.value.size)))], names=["cell"])

    counts = np.zeros(len(index.halves[0]) * len(index.halves[1]), np.int64)
    for cell, n in entries.select("vec").mapInArrow(run, "cell long").groupBy("cell").count().collect():  # at most max_centroids ** 2 cells
        counts[cell] = n
    return counts


def _dealt(entries: DataFrame, index: Index) -> DataFrame:
    """``(bin, id, vec)`` of every entry."""
    shared = entries.sparkSession.sparkContext.broadcast(index)  # at most max_centroids ** 2 cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            raw = batch.column(1).to_pylist()
            cell = index.cells(_rows(raw, index.size))
            part = np.array([xxhash.xxh3_64_intdigest(r) % (1 << 31) for r in raw], np.int64)
            bins = index.first_bin[cell] + part % index.n_bins[cell]
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(0), batch.column(1)], names=["bin", "id", "vec"])

    kind = entries.schema["id"].dataType.simpleString()
    return entries.select("id", "vec").mapInArrow(run, f"bin long, id {kind}, vec binary")


def _routed(asking: DataFrame, index: Index, wanted: int) -> DataFrame:
    """``(bin, id, vec)``: each query once for every bin that it visits."""
    shared = asking.sparkSession.sparkContext.broadcast(index)  # at most max_centroids ** 2 cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                bins = [index.visited(q, wanted) for q in _rows(part.column(1).to_pylist(), index.size)]
                at = pa.array(np.repeat(np.arange(part.num_rows), [len(b) for b in bins]))
                yield pa.RecordBatch.from_arrays([pa.array([b for own in bins for b in own], pa.int64()), part.column(0).take(at), part.column(1).take(at)], names=["bin", "id", "vec"])

    kind = asking.schema["id"].dataType.simpleString()
    return asking.select("id", "vec").mapInArrow(run, f"bin long, id {kind}, vec binary")


def _reranked(rows: DataFrame, size: int, keep: int) -> DataFrame:
    """``(query, entry, score)`` of the best ``keep`` entries of each bin for each query, from rows sorted by ``(bin, is_query, id)``."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, entries, queries = None, [], []
        x = np.empty((0, size))

        def answer() -> pa.RecordBatch:
            ids = pa.concat_arrays([i for i, _ in entries])
            asked, q = pa.concat_arrays([i for i, _ in queries]), _rows([r for _, own in queries for r in own], size)
            score = q @ x.T
            out = []
            for i, s in enumerate(score):  # entries are in the order of their ids
                if len(s) > keep:
                    bound = np.partition(s, len(s) - keep)[len(s) - keep]
                    near = np.flatnonzero(s >= bound - SLACK * max(1.0, abs(bound)))
                else:
                    near = np.arange(len(s))
                exact = inner(q[i], x[near])
                best = np.argsort(-exact, kind="stable")[:keep]
                out.append((np.full(len(best), i), near[best], exact[best]))
            a, b, c = (np.concatenate(p) for p in zip(*out))
            queries.clear()
            return pa.RecordBatch.from_arrays([asked.take(pa.array(a)), ids.take(pa.array(b)), pa.array(c)], names=["query", "entry", "score"])

        for batch in batches:
            bins, asks = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            edges = [0, *(i for i in range(1, batch.num_rows) if bins[i] != bins[i - 1] or asks[i] != asks[i - 1]), batch.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if bins[lo] != here:
                    if queries and entries:
                        yield answer()
                    here, entries, x = int(bins[lo]), [], np.empty((0, size))
                    queries.clear()
                raw = part.column(3).to_pylist()
                if not asks[lo]:
                    entries.append((part.column(2), raw))
                elif entries:
                    if not len(x):
                        x = _rows([r for _, own in entries for r in own], size)
                    for at in range(0, hi - lo, 512):
                        queries.append((part.column(2).slice(at, 512), raw[at : at + 512]))
                        yield answer()

    return rows.mapInArrow(run, f"query {kind}, entry {kind}, score double")


def search(df: DataFrame, asks: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = 20, target: float = 0.97, occupancy: int = 64, least: int = 2000, block: int = 4096, max_sample: int = 20_000, max_floats: int = 4_000_000, max_centroids: int = 1024) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``top`` nearest found rows for every row that ``asks`` (an expression over ``id``) is true of."""
    found = _vectors(df, id_col, vec_col)
    rows = materialise(found.groupBy("id").agg(F.min("key").alias("key")), "ids")  # narrow: of several vectors of an id, one
    same = rows.groupBy("key").agg(F.min("id").alias("low"), F.max(F.coalesce(asks, F.lit(False))).alias("asked"))
    holders = same.select(F.col("low").alias("id"), "key", "asked")
    entries = materialise(found.groupBy("key").agg(F.first("vec").alias("vec"), F.first("norm").alias("norm")).join(holders, "key").select("id", "vec", "norm", "asked"), "entries")
    n_rows, floats, norm = entries.agg(F.count("*"), F.max(F.octet_length("vec")), F.max("norm")).first()
    kind, id_name = rows.schema["id"].dataType.simpleString(), free_name(rows, "vec_id")
    if not n_rows:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias(id_name), F.lit(0.0).alias("score")).limit(0)
    size = max(2, floats // 8)

    index, share = fit(entries, n_rows, size, norm, top, target, occupancy, max_sample, max_floats, max_centroids)
    index.deal(_cell_counts(entries, index), block)
    wanted = max(least, int(np.ceil(share * n_rows)))

    both = _dealt(entries, index).withColumn("is_query", F.lit(False)).unionByName(_routed(entries.where("asked"), index, wanted).withColumn("is_query", F.lit(True)))
    both = both.select("bin", "is_query", "id", "vec").repartition("bin").sortWithinPartitions("bin", "is_query", "id")
    near = _reranked(both, size, top + 1)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    near = materialise(near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= top + 1).select("query", "entry", "score"), "near")

    # Rows: the smallest ids of each entry are enough, as a query leaves out only itself.
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("r") <= top + 1)
    copies = first.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min("id").alias("entry"))  # at most top + 1 ids
    listed = near.join(copies.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("id"))
    best = listed.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("r") <= top + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("list"))  # at most top + 1 entries
    asked = rows.where(asks).join(same.select("key", F.col("low").alias("query")), "key").select(F.col("id").alias("query_id"), "query")
    others = F.slice(F.filter("list", lambda s: s["id"] != F.col("query_id")), 1, top)
    out = asked.join(lists, "query").select("query_id", F.posexplode(others).alias("rank", "one"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("one.id").alias(id_name), F.col("one.score").alias("score"))
