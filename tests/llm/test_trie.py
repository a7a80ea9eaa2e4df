"""The conversation prefix trie (op13) against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablecheck.llm import queries, trie


def brute(rows):
    """Nodes from rebuilt texts; rows are ``(conv, turn, role, text)``."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            pair = (role or "", text or "")
            key = hashlib.sha256(f"{len(pair[0].encode())}:{pair[0]}{pair[1]}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), key, pair))
    own = {c: [p for *_, p in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    through, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            through[turns[:d]].append(c)
        ends[turns].append(c)
    kids = defaultdict(list)
    for node in through:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(through, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(through[node]) - 1) * len(node[-1][1]) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((min(m), len(n), min(through[n[:-1]]) if n else -1, len(m), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in through.items())


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def nodes(df, **options):
    conv = F.col("conv")
    got = trie.prefix_trie(df, head=F.pmod(F.crc32(conv.cast("string")), F.lit(6)), base=conv - conv % 100, max_head=5, **options)
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], *tuple(r)[3:]) for r in got.collect())


def conversations(seed, n=160, long=80):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), *range(200, 215), 305, -7, -250]:  # 300 is absent
        if c in (100, 217):
            continue
        size = long if c == 3 else rng.randrange(1, 9)
        same = rng.random() < 0.5  # half of them are built of a few turns
        rows += [(c, t * 2, rng.choice(("user", "assistant")) if not same else "user", f"t{rng.randrange(3)}" * (1 + t % 3) if same else f"{rng.random()} é漢") for t in range(size)]
    for c in range(400, 440):  # copies
        rows += [(c, t, "user", f"copy {t}") for t in range(7)]
    rows += [(5, None, None, None), (5, None, "user", "x"), (6, 0, "user", "again"), (6, 0, "user", "again"), (None, 1, "user", "nobody"), (7, 50, "", None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_a_plain_trie(spark, seed):
    rows = conversations(seed)
    df = table(spark, rows).repartition(3).selectExpr("*", "1 as conv", "2 as digest", "3 as depth")
    assert nodes(df) == brute(rows)


def test_a_conversation_cut_by_many_partitions(spark):
    rows = [(3, t, "user", f"turn {t % 17}") for t in range(3000)] + [(4, t, "user", f"turn {t % 17}") for t in range(2900)] + [(0, t, "user", f"zero {t}") for t in range(9)]
    df = table(spark, rows)
    cut = trie.prefix_products(trie.turn_rows(df, "conv_id", "turn", "role", "text"), *trie.MODULI[0])
    assert cut.where("conv = 3").select("part").distinct().count() > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = trie.prefix_products(trie.turn_rows(df, "conv_id", "turn", "role", "text"), *trie.MODULI[0])
        assert cut.where("conv = 3").select("part").distinct().count() > 1
        assert nodes(df) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_colliding_fingerprints_are_found(spark):
    rows = conversations(7, 60, 12)
    assert nodes(table(spark, rows), moduli=[(13, 2), (97, 5), *trie.MODULI]) == brute(rows)
    with pytest.raises(RuntimeError):
        nodes(table(spark, rows), moduli=[(13, 2)])


def test_products_compose():
    prime, base = trie.MODULI[0]
    rng = random.Random(1)
    value = lambda s: sum(x * pow(base, i, prime) for i, x in enumerate(s)) % prime
    u, v = ([rng.randrange(prime) for _ in range(n)] for n in (5, 9))
    assert value(u + v) == (value(u) + pow(base, len(u), prime) * value(v)) % prime


def test_small_and_empty(spark, tmp_path):
    assert nodes(table(spark, [])) == []
    rows = [(301, 0, "user", "a")]  # its base is absent
    assert nodes(table(spark, rows)) == brute(rows)
    table(spark, conversations(9, 30, 9)).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.QUERIES["op13_prefix_trie"](spark, str(tmp_path))
    assert dict(got.dtypes) == dict(conv_id="bigint", depth="bigint", parent_conv_id="bigint", n_convs="bigint", n_children="bigint", n_leaves="bigint", saved_tokens="bigint", ends_sha256="string")
