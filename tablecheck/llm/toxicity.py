"""Toxicity as ordinal severity: a cumulative-link (proportional odds) model on sparse text features.

Grades are ordered: 0 clean, 1 mild, 2 severe.  ``P(grade > g) = sigmoid(w.x - threshold[g])``: the weights
are shared by all thresholds, which rise by construction.  The expected severity is the sum
of these probabilities, and a text is toxic when ``P(grade > 0) >= 0.5``.

Features are words and word prefixes of 4 to 6 characters, lower-cased and without ASCII signs at their
ends.  Of the labelled sample's features, those over-represented in toxic rows (a z-score and
a lift, from counts that Spark aggregates) are kept, ``max_features`` at most.  Each gives two
values: whether a text has it, and its occurrences per hundred words.  Labels tell toxic from clean
only, so toxic rows are graded severe when their density of kept features is above the median.

The model is fitted on at most ``max_rows`` labelled rows, chosen by a hash of their id, one row for each id (of several texts that
with the smallest hash); scoring covers every row, in one pass without a shuffle.

Edge cases: a null text is empty; without labels, or with labels of one kind, no text is toxic; repeated
rows get equal scores; labels repeated for one id count by their largest value; an empty table gives no
rows; other columns pass through ``score`` unchanged (a column of the same name is replaced).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from .common import Memo, materialise

SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PREFIXES = (4, 5, 6)
GRADES = 3


def word_features(word: str) -> list[int]:
    """Hashes of a word and of its prefixes, as signed 64-bit integers."""
    word = word.strip(SIGNS)
    if not word:
        return []
    names = [f"w {word}", *(f"p {word[:n]}" for n in PREFIXES if len(word) >= n)]
    return [h - (1 << 64) if (h := xxhash.xxh3_64_intdigest(x)) >> 63 else h for x in names]


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights by feature (presence, density) and rising thresholds."""

    weights: dict[int, tuple[float, float]] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (20.0, 21.0)

    def __getstate__(self):
        return {"weights": self.weights, "thresholds": self.thresholds}

    @cached_property
    def memo(self) -> Memo:
        weights = self.weights
        return Memo(lambda word: tuple(f for f in word_features(word) if f in weights))

    def severity(self, text: str | None) -> np.ndarray:
        """``P(grade > g)`` for each threshold."""
        memo, words = self.memo, words_of(text)
        found = Counter(f for w in words if (own := memo[w]) for f in own)
        score = sum(self.weights[f][0] + self.weights[f][1] * 100 * n / len(words) for f, n in sorted(found.items()))
        return _sigmoid(score - np.array(self.thresholds))


def fit_cumulative(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, ridge: float = 1e-4, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch Adam on the proportional-odds likelihood of sparse rows."""
    n, p = len(grades), np.zeros(n_features + GRADES - 1)
    share = [np.clip((grades > g).mean(), 1e-4, 1 - 1e-4) for g in range(GRADES - 1)]
    start = [np.log((1 - s) / s) for s in share]
    p[n_features] = start[0]
    p[n_features + 1 :] = [np.log(max(b - a, 0.1)) for a, b in zip(start, start[1:])]
    m, v = np.zeros_like(p), np.zeros_like(p)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, cuts = p[:n_features], p[n_features] + np.concatenate(([0], np.cumsum(np.exp(p[n_features + 1 :]))))
        z = np.bincount(rows, values * w[cols], n)[:, None] - cuts
        above = np.hstack((np.ones((n, 1)), _sigmoid(z), np.zeros((n, 1))))  # P(grade >= g)
        slope = above * (1 - above)
        mass = np.maximum(above[at, grades] - above[at, grades + 1], 1e-12)
        by_score = (slope[at, grades] - slope[at, grades + 1]) / mass  # d log-likelihood / d score
        grad = np.zeros_like(p)
        grad[:n_features] = np.bincount(cols, values * by_score[rows], n_features) / n - ridge * w
        by_cut = np.zeros((n, GRADES + 1))
        by_cut[at, grades] -= slope[at, grades] / mass
        by_cut[at, grades + 1] += slope[at, grades + 1] / mass
        cut_grad = by_cut[:, 1:GRADES].sum(0) / n
        grad[n_features] = cut_grad.sum()
        for i in range(1, GRADES - 1):
            grad[n_features + i] = cut_grad[i:].sum() * np.exp(p[n_features + i])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_features], p[n_features] + np.concatenate(([0], np.cumsum(np.exp(p[n_features + 1 :]))))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000, max_features: int = 2048, min_z: float = 5.0, min_lift: float = 4.0) -> Model:
    """Fit on at most ``max_rows`` labelled rows of ``df``."""
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg((F.max(label_col) > 0).alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(max_rows)
    sample = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id")  # at most max_rows ids
    sample = sample.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one row for each id, combined before the shuffle

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(word_features)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                rows = [(Counter(f for w in words for f in memo[w]), len(words)) for t in part.column(1) for words in [words_of(t.as_py())]]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([n for _, n in rows], pa.int64()), pa.array([list(c) for c, _ in rows], pa.list_(pa.int64())), pa.array([list(c.values()) for c, _ in rows], pa.list_(pa.int64()))], names=["id", "y", "n_words", "f", "n"])

    kind = sample.select("id").schema[0].dataType.simpleString()
    sparse = materialise(sample.select("id", "text", "y").mapInArrow(features, f"id {kind}, y boolean, n_words long, f array<long>, n array<long>"), "labelled")
    n_rows, n_toxic = sparse.agg(F.count("*"), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0))).first()
    if not n_toxic or n_toxic == n_rows:
        return Model()
    counts = sparse.select("y", F.explode("f").alias("f")).groupBy("f").agg(F.sum(F.col("y").cast("long")).alias("toxic"), F.count("*").alias("n"))
    p, q = F.col("toxic") / n_toxic, (F.col("n") - F.col("toxic")) / (n_rows - n_toxic)
    share = F.col("n") / n_rows
    z = (p - q) / F.sqrt(share * (1 - share) * (1 / n_toxic + 1 / (n_rows - n_toxic)))
    kept = [r[0] for r in counts.where((F.col("toxic") >= 3) & (F.col("n") < n_rows)).where((z >= min_z) & (p >= min_lift * q)).orderBy(z.desc(), "f").select("f").limit(max_features).collect()]
    if not kept:
        return Model()
    place = {f: i for i, f in enumerate(kept)}
    own = sparse.select("id", "y", F.explode(F.arrays_zip("f", "n")).alias("x"), "n_words").select("id", "y", "x.f", (100 * F.col("x.n") / F.col("n_words")).alias("dense"))
    hits = own.join(F.broadcast(sparse.sparkSession.createDataFrame([(f,) for f in kept], "f long")), "f").orderBy("id", "f").collect()  # kept features of at most max_rows rows
    # Rows without any kept feature are alike: only their numbers count.
    ids: dict = {}
    row = np.array([ids.setdefault((r["id"], r["y"]), len(ids)) for r in hits], np.int64)
    col = np.array([place[r["f"]] for r in hits], np.int64)
    dense = np.array([r["dense"] for r in hits], np.float64)
    toxic = np.array([y for _, y in ids], bool)
    bare = n_toxic - int(toxic.sum())
    toxic = np.concatenate((toxic, np.ones(bare, bool), np.zeros(n_rows - len(toxic) - bare, bool)))
    density = np.bincount(row, dense, len(toxic))
    grades = np.where(toxic, 1 + (density > np.median(density[toxic])), 0)
    w, cuts = fit_cumulative(np.concatenate((row, row)), np.concatenate((col, col + len(kept))), np.concatenate((np.ones(len(row)), dense)), grades, 2 * len(kept))
    return Model({f: (float(w[i]), float(w[i + len(kept)])) for f, i in place.items()}, tuple(map(float, cuts)))


def score(df: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with ``severity``, ``p_toxic``, ``grade`` and ``toxic``, each name after ``prefix``."""
    own = StructType([StructField(prefix + name, kind) for name, kind in (("severity", DoubleType()), ("p_toxic", DoubleType()), ("grade", IntegerType()), ("toxic", BooleanType()))])
    df = df.drop(*own.names)
    shared, at = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text_col)  # at most max_features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            p = np.array([model.severity(t.as_py()) for t in batch.column(at)]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array((p >= 0.5).sum(1), pa.int32()), pa.array(p[:, 0] >= 0.5)], names=[*batch.schema.names, *own.names])

    return df.mapInArrow(run, StructType([*df.schema.fields, *own.fields]))
