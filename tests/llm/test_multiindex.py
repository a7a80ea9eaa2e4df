"""The inverted multi-index (op11) against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablecheck.llm import multiindex, queries


def table(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, id int, key int")


def brute(rows, top=20, step=20):
    found = {}
    for i, v in rows:
        u = multiindex.usable(v)
        if i is not None and u is not None:
            found[i] = u
    size = max(map(len, found.values()), default=1)
    ids = sorted(found)
    x = np.array([np.pad(found[i], (0, size - len(found[i]))) for i in ids]).reshape(len(ids), -1)
    out = {}
    for n, i in enumerate(ids):
        if i % step == 0:
            s = multiindex.inner(x[n], x)
            order = [j for j in np.lexsort((ids, -s)) if j != n][:top]
            out[i] = [(ids[j], float(s[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for own in out.values():
        assert sorted(r for r, *_ in own) == list(range(1, len(own) + 1))
    return {q: [x[1:] for x in sorted(own)] for q, own in out.items()}


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in own}) for q, own in want.items()) / sum(map(len, want.values()))


def clustered(n, dim, seed, scale=False):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((40, dim))
    x = centres[rng.integers(0, 40, n)] + 0.5 * rng.standard_normal((n, dim))
    return x * rng.uniform(0.2, 3, (n, 1)) if scale else x


@pytest.mark.parametrize("block, least", [(4096, 2000), (50, 2000), (40, 30)])
def test_against_brute_force(spark, block, least):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(700, 12, 1, scale=True))]
    same = rng.standard_normal(12).tolist()
    rows += [(1000 + i, same) for i in range(300)] + [(2000 + i, [2 * x for x in same]) for i in range(3)]
    rows += [(3000, None), (3020, []), (3040, [0.0] * 12), (3060, [None] + [1.0] * 11), (3080, [float("nan")] * 12), (3100, [float("inf")] * 12), (3120, [1.0, 2.0]), (-40, [5.0] * 12), (None, [9.0] * 12)]
    df = table(spark, [(i, v, 0, 0) for i, v in rows + rows[:7]]).repartition(3)
    got, want = answers(multiindex.search(df, F.col("id") % 20 == 0, block=block, least=least, occupancy=8)), brute(rows)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in got)
    if least == 2000:
        assert got == want
    else:
        assert recall(got, want) >= 0.95
        score = {(q, i): s for q, own in brute(rows, top=2000).items() for i, s in own}
        assert all(score[q, i] == s for q, own in got.items() for i, s in own)


def test_recall_without_all_entries(spark):
    for x in (clustered(6000, 32, 2), clustered(6000, 32, 4, scale=True), np.random.default_rng(5).standard_normal((6000, 32))):
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        got, want = answers(multiindex.search(table(spark, [(*r, 0, 0) for r in rows]), F.col("id") % 20 == 0, least=100, block=128, occupancy=16)), brute(rows)
        assert recall(got, want) >= 0.9


def test_few_rows(spark):
    assert multiindex.search(table(spark, []), F.col("id") % 20 == 0).collect() == []
    assert multiindex.search(table(spark, [(0, [1.0], 0, 0)]), F.col("id") % 20 == 0).collect() == []
    rows = [(0, [1.0, 1.0]), (20, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [0.0, 2.0])]
    assert answers(multiindex.search(table(spark, [(*r, 0, 0) for r in rows], "float"), F.col("id") % 20 == 0)) == {0: [(3, 2.0), (4, 2.0), (20, 1.0)], 20: [(0, 1.0), (3, 0.0), (4, 0.0)]}
    two = [(0, [1.0], 0, 0), (1, [3.0], 0, 0), (1, [2.0], 0, 0), (1, [2.0], 0, 0)]  # of an id's vectors one takes part
    (own,) = answers(multiindex.search(table(spark, two), F.col("id") % 20 == 0)).values()
    assert own in ([(1, 3.0)], [(1, 2.0)])


def test_traversal_is_by_summed_distance():
    rng = np.random.default_rng(1)
    index = multiindex.Index(4, 5.0, (rng.standard_normal((9, 2)), rng.standard_normal((7, 3))))
    q = rng.standard_normal(4)
    d1, d2 = index.distances(q)
    cells = list(index.traverse(q))
    assert sorted(cells) == list(range(63))
    sums = [d1[c // 7] + d2[c % 7] for c in cells]
    assert sums == sorted(sums)


def test_bins_hold_every_vector_once():
    rng = np.random.default_rng(2)
    index = multiindex.Index(4, 5.0, (rng.standard_normal((6, 2)), rng.standard_normal((6, 3))))
    counts = rng.integers(0, 40, 36)
    counts[7] = 500
    index.deal(counts, 64)
    assert index.n_bins[7] == 8 and (np.delete(index.n_bins, 7) == 1).all()
    load = np.bincount(np.delete(index.first_bin, 7), np.delete(counts, 7), index.total_bins)
    assert load.max() <= 64 and not load[index.first_bin[7] : index.first_bin[7] + 8].any()
    assert sorted(index.visited(rng.standard_normal(4), int(counts.sum()))) == list(range(index.total_bins))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.QUERIES["op11_inverted_multi_index"](spark, sf)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert answers(got) == brute(rows)
