"""Periodic runs (op12) against a definition-level search."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tablecheck.llm import queries, runs
from tests.llm.helpers import ODD, WORD, documents, prose


def brute(words, min_length=24, exponent=3):
    """Every (start, stop, period) straight from the definition."""
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            stop = j + q
            if stop - i >= max(min_length, exponent * q) and not any(all(words[x] == words[x + p] for x in range(i, stop - p)) for p in range(1, q)):
                found.append((i, stop, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_in(texts, min_length=24):
    number, flat = {}, []
    for i, t in enumerate(texts):
        flat += [number.setdefault(w, len(number)) for w in t] + [-1 - i]
    out = [[] for _ in texts]
    for x, s, e, q in runs.find_runs(np.array(flat, np.int64), np.array([len(t) for t in texts], np.int64)):
        if e - s >= max(min_length, 3 * q):
            out[x].append((s, e, q))
    return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def repeated(rng, alphabet, period, length):
    unit = [rng.choice(alphabet) for _ in range(period)]
    return [unit[i % period] for i in range(length)]


@pytest.mark.parametrize("seed", range(30))
def test_against_the_definition(seed):
    rng = random.Random(seed)
    alphabet = "abcdefghijklmnopqrstuvwxyz"[: rng.choice((1, 2, 2, 3, 26))]
    texts = []
    for _ in range(20):
        text = []
        for _ in range(rng.randrange(1, 5)):
            period = rng.choice((1, 2, 3, 5, 6, 7, 11, 12, 16, 23, 24, 25, 40))
            text += repeated(rng, alphabet, period, int(period * rng.choice((2.5, 3, 3.2, 4, 7.5))))
            if rng.random() < 0.5:
                text += [rng.choice("abcxyz") for _ in range(rng.randrange(6))]
        if rng.random() < 0.3:  # runs of runs
            text = (text[:60] * 4)[: rng.randrange(100, 260)]
        texts.append(text)
    assert found_in(texts, 3) == [brute(t, 3) for t in texts]
    assert found_in(texts) == [brute(t) for t in texts]


def test_every_period_at_the_least_length():
    rng = random.Random(5)
    texts = [repeated(rng, "abcdefgh", q, max(24, 3 * q)) for q in range(1, 130)]
    assert found_in(texts) == [brute(t) for t in texts] and all(found_in(texts))


def test_words_of_fibonacci_and_of_one_letter():
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    texts = [list(b), ["x"] * 500, [], ["x"], list("ab" * 300 + "ba" * 300)]
    assert found_in(texts, 3) == [brute(t, 3) for t in texts]


@pytest.mark.parametrize("t", (4, 8, 16))
def test_synchronising_positions_are_local_and_dense(t):
    rng = np.random.default_rng(t)
    words = np.tile(rng.integers(0, 50, 200), 3)
    hashes = words.astype(np.uint64)
    for size in (1, 2, 4, 8):
        if size < t:
            hashes = runs.mix(hashes * np.uint64(31) + np.concatenate((hashes[size:], hashes[:size])))
    at = runs.synchronising(hashes, np.zeros(len(words), bool), t)
    assert set(at[at < 200] + 200) == set(at[(at >= 200) & (at < 400)])  # the same words choose the same positions
    assert np.diff(at).max() <= t


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    own = brute(words)
    keep = [w for i, w in enumerate(words) if not any(s + q <= i < e for s, e, q in own)]
    best = min(own, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(own), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4), sha("".join(f"{s},{e - s},{q}\n" for s, e, q in own)), sha(" ".join(keep)))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [t for t in ODD if len(t or "") < 4000]
    texts += [prose(i, rng.randrange(1, 160)) for i in range(120)] + [" ".join(repeated(rng, ["aa", "b", "é"], q, 5 * q)) + " " + prose(q, 20) for q in range(1, 40)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(None, texts[-1], None, None), (3, texts[-2], "en", "s"), (3, texts[-2], "en", "s"), (-10, "", "en", "s")]
    documents(spark, rows, extra=True).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_synchronising_runs"](spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, (tuple(r)[:8] for r in got.collect()))) == sorted(repr(expected(i, t)) for i, t, *_ in rows)


def test_long_text_and_empty_table(spark):
    long = prose(1, 150_000) + " " + " ".join(f"w{i % 20_011}" for i in range(70_000))
    row = runs.periodic_runs(documents(spark, [long])).first()
    assert [tuple(r) for r in row["runs"]] == [(150_000, 70_000, 20_011)] and row["n_words"] == 220_000
    assert len(row["collapsed"].split()) == 150_000 + 20_011
    assert runs.periodic_runs(documents(spark, [])).collect() == []


