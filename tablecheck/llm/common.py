"""Shared helpers: the cluster's shared folder, word hashing, bounded memo, components.

Intermediate tables are written as Parquet below ``spark.checkpoint.dir`` (the folder
all executors share) and read back: lineage ends there, so a lost executor costs a
re-read and not a recomputation, and a later plan prunes columns of the file.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

U64 = np.uint64
#: ASCII white space as in ``[\\x20\\x09-\\x0D]``, which is what ``bytes.split()`` cuts at.
ASCII_SPACE = b" \t\n\r\x0b\x0c"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only a local master (tests) may leave it unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


class Memo(dict):
    """``memo[key]`` computes and keeps a value; two generations bound its size to ``2 * limit``.

    When the young generation is full it becomes the old one; keys still in use move
    back, so frequent keys survive and rare ones are forgotten.
    """

    def __init__(self, solve: Callable, limit: int = 300_000):
        super().__init__()
        self.solve, self.limit, self.old = solve, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.solve(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def knows(self, key) -> bool:
        return key in self or key in self.old


def byte_alphabet() -> str:
    """The character that byte-level tokenizers show each byte as: itself if it is printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, equal on every worker."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def word_blocks(texts: pa.Array, block_bytes: int = 8_000_000) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """For every block of texts: its distinct words, the number of each word in turn, and where the texts start and the last one stops."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    size, lo = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + block_bytes, "right")))
        split = pc.ascii_split_whitespace(texts.slice(lo, hi - lo))
        found = split.flatten().dictionary_encode()
        words, number = found.dictionary.cast(pa.binary()).to_pylist(), found.indices.to_numpy()
        kept = np.fromiter(map(bool, words), bool, len(words))[number]  # outer white space gives an empty word
        edges = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy())))]
        yield words, number[kept], edges
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (fixed public constants of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; a shorter text that has words is one run, no words give none."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, k)
    out = np.full(n - size + 1, size, U64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix(out * U64(0x9E3779B97F4A7C15) + words[i : n - size + 1 + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def ragged(values: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.Array:
    """A list column whose rows are consecutive runs of ``values``."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(values, kind))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the undirected ``edges (a, b)``.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every step is
    one partially aggregated minimum per node and one join back, so a hub's edges are
    combined before the shuffle and its join partition can be split by AQE.  Each
    step is written to the shared folder; a star forest is reached in a number of steps
    that grows with the logarithm of the longest path.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        edges = materialise(large, name)
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = materialise(small, name)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
