"""Near-duplicate vectors by Euclidean p-stable hashing (Datar et al., 2004).

Vectors are normalised, so cosine >= 0.95 is a Euclidean distance of at most 0.316.  A table's
bucket is a tuple of ``n_hashes`` quantised random projections ``floor((a.v + b) / width)``; with the defaults a
pair at the threshold shares a given bucket with probability 0.26, and at least one of
16 tables with 0.99 (closer pairs with more).  Pairs that share a bucket are checked by
exact cosine in double precision, in matrix blocks, each in the first table they share only.

Skew: equal vectors form one class with a multiplicity, so copies are never paired.  A bucket of more
than ``block`` classes is cut into blocks by hash, and every pair of blocks is its own unit
of work, so no bucket has to fit one task.  A block reports sums of links and a spanning
forest of its links, never its pairs.  Buckets are first counted by their keys alone; a vector, in the numbers it
came in, goes only to buckets that hold another class.

Edge cases: a vector that is null, zero, empty or holds a null or a non-finite component links with nothing; vectors
of different lengths never link; a repeated row counts as another vector; a null id keeps its links
but has no component and counts as kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import connected_components, materialise, mix

ROW = "key binary, copies long, vec binary, codes binary"


def unit(values: list | None) -> np.ndarray | None:
    """The vector at length one in double precision, or None if it cannot be compared."""
    if not values or None in values:
        return None
    v = np.asarray(values, np.float64)
    if not np.isfinite(v).all() or not (top := np.abs(v).max()):
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def units(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors from the bytes of vectors of one length."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def number_type(df: DataFrame, vec_col: str) -> str:
    """How a vector's numbers are stored: in the column's own type."""
    return "<f4" if df.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, key, vec)``: a digest of the unit vector and the bytes of each comparable vector, else null."""
    stored = number_type(df, vec_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            found = [unit(v) for v in rows]
            raw = [None if u is None else np.asarray(v, np.float64).astype(stored).tobytes() for u, v in zip(found, rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if u is None else xxhash.xxh3_128_digest(u.tobytes()) for u in found], pa.binary()), pa.array(raw, pa.binary())], names=["id", "key", "vec"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, vec_col).mapInArrow(run, f"id {kind}, key binary, vec binary")


def coded(classes: DataFrame, n_tables: int, n_hashes: int, width: float, seed: int, stored: str) -> DataFrame:
    """``classes`` with ``codes``: one 32-bit bucket for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple] = {}
        for batch in batches:
            raw = batch.column(2).to_pylist()
            sizes = np.array([len(r) for r in raw])
            codes: list = [None] * len(raw)
            for size in np.unique(sizes):
                if size not in planes:
                    rng = np.random.default_rng([seed, int(size)])
                    planes[size] = rng.standard_normal((size // np.dtype(stored).itemsize, n_tables * n_hashes)), rng.random(n_tables * n_hashes) * width
                a, b = planes[size]
                rows = np.flatnonzero(sizes == size)
                x = units([raw[i] for i in rows], stored)
                q = np.floor((x @ a + b) / width).astype(np.int64).view(np.uint64).reshape(len(rows), n_tables, n_hashes)
                h = np.full((len(rows), n_tables), np.uint64(size))
                with np.errstate(over="ignore"):
                    for i in range(n_hashes):
                        h = mix(h * np.uint64(31) + q[:, :, i])
                for i, code in zip(rows, (h >> np.uint64(32)).astype("<u4")):
                    codes[i] = code.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.binary())], names=["key", "copies", "vec", "codes"])

    return classes.select("key", "copies", "vec").mapInArrow(run, ROW)


def _forest(linked: np.ndarray) -> np.ndarray:
    """Each row's root, the smallest row of its component, over a symmetric boolean matrix."""
    root = np.full(len(linked), -1)
    for i in np.flatnonzero(linked.any(1)):
        if root[i] < 0:
            front = np.array([i])
            root[i] = i
            while len(front):
                front = np.flatnonzero(linked[front].any(0) & (root < 0))
                root[front] = i
    return root


def _block_links(x: np.ndarray, codes: np.ndarray, own: np.ndarray, lo: int, hi: int, table: int, copies: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """``(links, root)`` of each row of a block pair; root -1 where nothing links."""
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    if lo != hi:
        linked &= own[:, None] != own[None, :]
    for t in range(table):
        if not linked.any():
            break
        linked &= codes[:, None, t] != codes[None, :, t]
    return linked @ copies, _forest(linked)


def bucket_links(rows: DataFrame, least: float, stored: str) -> DataFrame:
    """``(key, links, root)`` from rows sorted by ``(tab, bucket, lo, hi)``: sums and a spanning forest for each block pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        out: list[tuple] = []

        def work(part: pa.Table) -> None:
            cells = np.stack([part.column(c).to_numpy() for c in ("tab", "bucket", "lo", "hi")])
            edges = np.flatnonzero(np.concatenate(([True], (cells[:, 1:] != cells[:, :-1]).any(0), [True])))
            keys, copies, own = part.column("key").to_pylist(), part.column("copies").to_numpy(), part.column("own").to_numpy()
            raw, codes = part.column("vec").to_pylist(), part.column("codes").to_pylist()
            for start, stop in zip(edges[:-1], edges[1:]):
                if stop - start == 1:
                    continue
                size = np.array([len(r) for r in raw[start:stop]])
                for s in np.unique(size):
                    at = start + np.flatnonzero(size == s)
                    if len(at) == 1:
                        continue
                    x = units([raw[i] for i in at], stored)
                    code = np.frombuffer(b"".join(codes[i] for i in at), "<u4").reshape(len(at), -1)
                    links, root = _block_links(x, code, own[at], cells[2, start], cells[3, start], cells[0, start], copies[at], least)
                    out.extend((keys[at[i]], int(links[i]), keys[at[root[i]]]) for i in np.flatnonzero(root >= 0))

        def take() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 3
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.binary()))], names=["key", "links", "root"])

        for batch in batches:
            cells = np.stack([batch.column(i).to_numpy() for i in range(4)])
            if held and (np.array([held[-1].column(i)[held[-1].num_rows - 1].as_py() for i in range(4)]) != cells[:, 0]).any():
                work(pa.Table.from_batches(held))
                held = []
            change = np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(0))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                work(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
            if out:
                yield take()
        if held:
            work(pa.Table.from_batches(held))
        yield take()

    return rows.mapInArrow(run, "key binary, links long, root binary")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, n_tables: int = 16, n_hashes: int = 10, width: float = 2.0, block: int = 2048, seed: int = 7) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row."""
    stored, found = number_type(df, vec_col), vectors(df, id_col, vec_col)
    rows = materialise(found.select("id", "key"), "vectors")  # without the vectors, which are written once, by class
    classes = found.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.first("vec").alias("vec"))
    classes = materialise(coded(classes, n_tables, n_hashes, width, seed, stored), "classes")

    code = lambda t: F.conv(F.hex(F.substring("codes", t * 4 + 1, F.lit(4))), 16, 10).cast("long")
    slots = F.explode(F.sequence(F.lit(0), F.lit(n_tables - 1)))
    spread = classes.select("key", slots.alias("tab"), "codes").select("key", "tab", code(F.col("tab")).alias("bucket"))
    # Only keys and buckets are shuffled to find the buckets of several classes; a vector goes to those alone.
    shared = spread.groupBy("tab", "bucket").agg(F.count("*").alias("n")).where("n > 1").select("tab", "bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    places = spread.join(shared, ["tab", "bucket"]).groupBy("key").agg(F.collect_list(F.struct("tab", "bucket", "blocks")).alias("places"))  # at most n_tables entries
    full = classes.join(places, "key").select("key", "copies", "vec", "codes", F.explode("places").alias("place")).select("key", "copies", "vec", "codes", "place.*")
    full = full.withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = full.select("tab", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "key", "copies", "vec", "codes")
    found = materialise(bucket_links(cells.repartition("tab", "bucket", "lo", "hi").sortWithinPartitions("tab", "bucket", "lo", "hi"), least, stored), "links")

    nodes = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
    near = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")).where("a <> b"))
    sums = found.groupBy("key").agg(F.sum("links").alias("links"))
    known = nodes.join(near.withColumnRenamed("node", "key"), "key", "left").join(sums, "key", "left").select("key", "low", F.coalesce("component", "key").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    lowest = known.groupBy("c").agg(F.min("low").alias("low"))
    known = known.drop("low").join(lowest, "c").select("key", "links", "low")
    component = F.when(F.col("id").isNotNull(), F.coalesce("low", "id"))
    return rows.select("id", "key").join(known, "key", "left").select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
