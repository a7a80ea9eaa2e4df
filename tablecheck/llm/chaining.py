"""Fuzzy substring deduplication by collinear chaining of k-mer seeds.

1. Seeds: of the hashes of all runs of ``k`` words, the smallest of every ``window`` consecutive ones (robust
   winnowing), so any ``window + k - 1`` equal words share a seed.
2. Every seed is paired with an earlier holder: the first one (the smallest document id) or, where a block of documents holds
   the key very often, the block's first. Each occurrence meets the holder's first occurrence, and the i-th
   the i-th, so repeated lines pair in order; two matches for each occurrence at most.
3. The matches of a (document, holder) pair are chained: a Fenwick tree over positions in the holder gives the best
   predecessor under a linear gap cost.  Chains are cut at gaps that no passage has; one seed makes a chain. What lies in a
   chain that is a passage for sure (its seeds alone match ``percent`` of its words) is not looked at again.
4. Other text whose seeds stand close enough for a passage is looked up by pairs of seeds at most ``PAIR`` words apart, each pair with
   its own first holder: so a passage is found, edited or not, whose phrases have other first holders.
5. The words around each chain are aligned: equal runs between seeds are taken as they are, other gaps by their longest
   common subsequence, and both ends are extended.  Of the alignment's equal runs, all stretches of at least
   ``min_words`` words with ``percent`` of them matched are reported for the later document; the first holder keeps them.
6. Text whose seeds all have earlier holders, and that is still not reported, is looked up by its runs of
   ``min_words`` words among all such text: every exact run of ``min_words`` words is reported, also where its
   phrases and their pairs have other first holders (but for fewer than ``window`` words at an end, if a reported
   passage of another holder stops there).

Skew: seeds travel as one block for each bucket of keys and block of documents, keys of 40 bits in byte planes; a key that a block
holds over ``HOT`` times is matched inside the block, and only its first holder's occurrences travel, so a bucket has at most
``HOT`` occurrences of a key, or one document's, from each block. Buckets hold the seeds of ``BUCKET_WORDS`` words each, whatever the size of the corpus. A chain group holds at
most one document's seeds.

Edge cases: a null or short text and a null id give no passage; rows that repeat an id with one text are
one document; where an id has several texts, each text is a document, later ones by their hash; an
empty table gives no rows; other columns are ignored by ``passages`` and kept by ``cut_passages``.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import free_name, materialise, mix, shingle_hashes, signed, word_blocks

K, WINDOW, MIN_WORDS, PERCENT = 5, 4, 50, 80
#: Words between two seeds of a chain part, and between two seeds of a pair; words of text for a bucket of seeds.
GAP, PAIR, BUCKET_WORDS = 45, 30, 5_000_000
#: Occurrences of a key in a block, and of a pair in a document, from which they are a common line's.
HOT, REPEATS = 32, 8
LOW = np.uint64((1 << 40) - 1)
GAP_COST = 0.1
#: Words that an edit may replace, on either side, smallest first.
EDITS = sorted(((i, j) for i in range(5) for j in range(5) if i or j), key=lambda e: (max(e), sum(e)))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def to_words(text: str | None) -> bytes:
    """The words as 24-bit checksums."""
    w = words_of(text)
    return np.fromiter(map(zlib.crc32, w), "<u4", len(w)).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def texts_to_words(texts: pa.Array) -> Iterator[bytes]:
    """``to_words`` of every text; each distinct word of a block of texts is summed once."""
    for distinct, number, edges in word_blocks(pc.ascii_lower(texts.cast(pa.string())), 2_000_000):
        sums = np.fromiter(map(zlib.crc32, distinct), "<u4", len(distinct)).view(np.uint8).reshape(-1, 4)[:, :3][number]
        for lo, hi in zip(edges, edges[1:]):
            yield sums[lo:hi].tobytes()


def from_words(raw) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, 3)
    out = np.zeros((len(part), 4), np.uint8)
    out[:, :3] = part
    return out.reshape(-1).view("<u4")


def seeds_of(words: np.ndarray, lengths: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, positions and text numbers of the winnowed seeds of texts laid end to end, each of ``k + window`` words at least.

    A run of ``k`` words is a seed if it is the first smallest one of some ``window`` consecutive runs of its text.
    """
    runs = shingle_hashes(words.astype(np.uint64), k)
    stop = np.cumsum(lengths)
    text = np.repeat(np.arange(len(lengths)), lengths)[: len(runs)]
    inside = np.arange(len(runs)) + k <= stop[text]
    h = np.where(inside, np.maximum(runs, np.uint64(1)), np.uint64(0))  # a zero ends every comparison
    beyond = np.zeros(window - 1, np.uint64)
    wide = np.concatenate((beyond, h, beyond))
    reach = np.zeros(len(h), np.int64)
    for step, beats in ((-1, np.less), (1, np.less_equal)):
        still = np.ones(len(h), bool)
        for d in range(1, window):
            at = window - 1 + step * d
            still &= beats(h, wide[at : at + len(h)])
            reach += still
    chosen = np.flatnonzero((reach >= window - 1) & inside)
    return runs[chosen], chosen - (stop - lengths)[text[chosen]], text[chosen]


def chain(matches: list[tuple[int, int]], k: int = K, cost: float = GAP_COST) -> list[list[tuple[int, int]]]:
    """Best collinear chains of ``(position, position in the holder)``, each match in one chain."""
    matches = sorted(matches)
    if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(matches, matches[1:])):
        return [matches]
    places = {p: i + 1 for i, p in enumerate(sorted({b for _, b in matches}))}
    tree: list[tuple[float, int]] = [(0.0, -1)] * (len(places) + 1)
    score, before, i = [0.0] * len(matches), [-1] * len(matches), 0
    while i < len(matches):
        j = i
        while j < len(matches) and matches[j][0] == matches[i][0]:  # matches of one position don't precede each other
            a, b = matches[j]
            best, x = (0.0, -1), places[b] - 1
            while x > 0:
                best = max(best, tree[x])
                x &= x - 1
            gain = best[0] - cost * (a + b)
            score[j], before[j] = (k + gain, best[1]) if best[1] >= 0 and gain > 0 else (float(k), -1)
            j += 1
        for m in range(i, j):
            a, b = matches[m]
            entry, x = (score[m] + cost * (a + b), m), places[b]
            while x < len(tree):
                tree[x] = max(tree[x], entry)
                x += x & -x
        i = j
    used, chains = [False] * len(matches), []
    for end in sorted(range(len(matches)), key=lambda m: -score[m]):
        own, m = [], end
        while m >= 0 and not used[m]:
            used[m] = True
            own.append(matches[m])
            m = before[m]
        if own:
            chains.append(own[::-1])
    return chains


def cut_chains(chains: list[list[tuple[int, int]]], most: int) -> Iterator[list[tuple[int, int]]]:
    """Parts of chains without a gap over ``most`` words on either side."""
    for own in chains:
        start = 0
        for i in range(1, len(own) + 1):
            if i == len(own) or max(own[i][0] - own[i - 1][0], own[i][1] - own[i - 1][1]) > most:
                yield own[start:i]
                start = i


def common(x: list, y: list) -> list[tuple[int, int, int]]:
    """``(position, position, length)`` of the equal runs of a longest common subsequence."""
    lo = 0
    while lo < len(x) and lo < len(y) and x[lo] == y[lo]:
        lo += 1
    hi = 0
    while hi < len(x) - lo and hi < len(y) - lo and x[-1 - hi] == y[-1 - hi]:
        hi += 1
    runs, m, n = [(0, 0, lo)] if lo else [], len(x) - lo - hi, len(y) - lo - hi
    at: dict = {}
    for j in range(n):
        at[y[lo + j]] = at.get(y[lo + j], 0) | 1 << j
    if m and not at.keys().isdisjoint(x[lo : lo + m]):
        row, rows, full = (1 << n) - 1, [], (1 << n) - 1  # a bit for each word of y: 0 where it makes the subsequence longer
        for i in range(m):
            u = row & at.get(x[lo + i], 0)
            row = (row + u | row - u) & full
            rows.append(row)
        i, j, back = m, n, []
        while i and j:
            if rows[i - 1] >> j - 1 & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> j - 1 & 1:
                    j -= 1
                    back.append((lo + i, lo + j, 1))
        runs += back[::-1]
    return runs + ([(len(x) - hi, len(y) - hi, hi)] if hi else [])


def matched(x: list, y: list) -> int:
    """Words matched by an alignment of ``x`` and ``y`` (their longest common subsequence)."""
    return sum(n for _, _, n in common(x, y))


def extend(x: list, y: list, i: int, j: int, step: int) -> list[tuple[int, int, int]]:
    """Walk from ``(i, j)`` while words match; an edit of up to four words is passed if enough words match after it.  Returns the equal runs, nearest first."""
    out = []

    def runs(a: int, b: int, again: int) -> bool:
        return all(0 <= a + step * t < len(x) and 0 <= b + step * t < len(y) and x[a + step * t] == y[b + step * t] for t in range(again))

    while True:
        n = 0
        while 0 <= i < len(x) and 0 <= j < len(y) and x[i] == y[j]:
            i, j, n = i + step, j + step, n + 1
        if n:
            out.append((i, j, n) if step > 0 else (i + 1, j + 1, n))
            if step > 0:
                out[-1] = (i - n, j - n, n)
        for di, dj in EDITS:
            a, b = i + step * di, j + step * dj
            if 0 <= a < len(x) and 0 <= b < len(y) and x[a] == y[b] and runs(a, b, min(4, max(di, dj) + 1 + (di != dj))):
                i, j = a, b
                break
        else:
            return out


def beyond(x: list, y: list) -> list[tuple[int, int, int]]:
    """Equal runs at the start of two word lists, as long as matched words outnumber the others."""
    runs, score, best, most, i, j = common(x, y), 0, 0, 0, 0, 0
    for m, (a, b, n) in enumerate(runs):
        score += n - max(a - i, b - j)
        if score > most:
            best, most = m + 1, score
        i, j = a + n, b + n
    return runs[:best]


def equal_runs(x: list, y: list, seeds: list[tuple[int, int]], k: int = K, reach: int = MIN_WORDS, whole: bool = False) -> list[tuple[int, int, int]]:
    """``(position, holder's position, length)`` of the equal runs of a chain's alignment, in order and apart; ``whole``: with all that ``reach`` words at its ends have in common."""
    seeds = [(a, b) for a, b in seeds if x[a : a + k] == y[b : b + k]]
    if not seeds:
        return []
    out = [] if whole else extend(x, y, seeds[0][0] - 1, seeds[0][1] - 1, -1)[::-1]
    out.append((*seeds[0], k))
    for (a, b), (c, d) in zip(seeds, seeds[1:]):
        skip = max(k - (c - a), k - (d - b), 0)  # overlapping seeds count their words once
        if not skip:
            out += [(a + k + i, b + k + j, n) for i, j, n in common(x[a + k : c], y[b + k : d])]
        out.append((c + skip, d + skip, k - skip))
    if not whole:
        out += extend(x, y, seeds[-1][0] + k, seeds[-1][1] + k, 1)
    if whole or sum(n for _, _, n in out) > 2 * k:
        (i, j, _), (c, d, n) = out[0], out[-1]
        ends = common if whole else beyond
        left = ends(x[max(0, i - reach) : i][::-1], y[max(0, j - reach) : j][::-1])
        out = [(i - a - m, j - b - m, m) for a, b, m in left[::-1]] + out + [(c + n + a, d + n + b, m) for a, b, m in ends(x[c + n : c + n + reach], y[d + n : d + n + reach])]
    joined = []
    for i, j, n in out:
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            joined[-1] = (*joined[-1][:2], joined[-1][2] + n)
        elif n:
            joined.append((i, j, n))
    return joined


def align(x: list, y: list, seeds: list[tuple[int, int]], k: int = K) -> tuple[int, int, int, int, int]:
    """``(start, stop, holder's start, holder's stop, matched words)`` of a chain's alignment over two word lists."""
    runs = equal_runs(x, y, seeds, k)
    if not runs:
        return 0, 0, 0, 0, 0
    return runs[0][0], runs[-1][0] + runs[-1][2], runs[0][1], runs[-1][1] + runs[-1][2], sum(n for _, _, n in runs)


def segments(runs: list[tuple[int, int, int]], size: int, min_words: int = MIN_WORDS, percent: int = PERCENT) -> list[tuple[int, int, int, int, int]]:
    """Stretches of an alignment with ``min_words`` words and ``percent`` of them matched, as few as hold every such stretch.

    A stretch whose equal runs are shorter than ``min_words`` takes in words beside them, of the ``size`` words there are.
    """
    if not runs or sum(n for _, _, n in runs) * 100 < percent * min_words:
        return []
    i, j, n = (np.array(c) for c in zip(*runs))
    total, best = np.concatenate(([0], np.cumsum(n))), []
    for s in range(len(runs)):  # the longest stretch from each run on
        long = np.maximum(np.maximum(i[s:] + n[s:] - i[s], j[s:] + n[s:] - j[s]), min_words)
        good = np.flatnonzero((total[s + 1 :] - total[s]) * 100 >= percent * long)
        if len(good) and (not best or s + good[-1] > best[-1][1]):
            best.append((s, s + int(good[-1])))
            if best[-1][1] == len(runs) - 1:
                break
    kept = []
    for s, e in best:
        while len(kept) > 1 and s <= kept[-2][1]:  # the one between is held by its neighbours
            kept.pop()
        kept.append((s, e))
    out = []
    for s, e in kept:
        start, stop = int(i[s]), int(i[e] + n[e])
        if stop - start < min_words:
            stop = min(size, start + min_words)
            start = max(0, stop - min_words)
        if stop - start >= min_words:
            out.append((start, stop, int(j[s]), int(j[e] + n[e]), int(total[e + 1] - total[s])))
    return out


def planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers, first bytes first: planes of zeros cost nothing in a shuffle."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(raw, width: int) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :width] = part
    return out.reshape(-1).view("<u8")


def ranks(ids: pa.Array, versions: np.ndarray) -> np.ndarray:
    """Dense ranks of ``(id, version)``."""
    rows = pa.table([ids, pa.array(versions)], names=["id", "v"])
    order = pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("v", "ascending")])
    rows, out = rows.take(order), np.zeros(len(ids), np.int64)
    if len(ids) > 1:
        differ = [pc.not_equal(rows.column(c).slice(1), rows.column(c).slice(0, len(ids) - 1)).to_numpy() for c in ("id", "v")]
        out[order.to_numpy()[1:]] = np.cumsum(differ[0] | differ[1])
    return out


def in_order(key: np.ndarray, rank: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """``np.lexsort((pos, rank, key))``; where rows stand by rank and position already, by two sorts that need not be stable."""
    if not ((rank[1:] > rank[:-1]) | (rank[1:] == rank[:-1]) & (pos[1:] >= pos[:-1])).all():
        return np.lexsort((pos, rank, key))
    order = np.argsort(key)
    sub = key[order]
    places = np.cumsum(np.concatenate((sub[:1] != sub[:1], sub[1:] != sub[:-1])), dtype=np.uint64)
    del sub
    places <<= np.uint64(32)
    places |= order.view(np.uint64)
    places.sort()
    places &= np.uint64((1 << 32) - 1)
    return places.view(np.int64)


def seed_blocks(words: DataFrame, k: int, window: int, buckets: int) -> DataFrame:
    """Seeds as ``(bucket, salt, seeds, pos, doc, ids, versions)``: one row for each bucket of keys and block of documents; ``doc`` is an index into ``ids``.

    A block's occurrences of a key that it holds over ``HOT`` times stay together in a row of the block's own; only those of
    its first document also go to the key's bucket.
    """
    block_words = int(np.clip(64 * buckets, 1_000_000, 8_000_000))

    def block(ids: pa.Array, versions: np.ndarray, salt: int, raw: list) -> pa.RecordBatch:
        lengths = np.array([len(r) // 3 for r in raw])
        key, pos, doc = seeds_of(from_words(b"".join(raw)), lengths, k, window)
        rank = ranks(ids, versions)[doc]
        order = in_order(key, rank, pos)
        key, pos, doc, rank = key[order], pos[order], doc[order], rank[order]
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        n = np.diff(np.append(edge, len(key)))
        hot, first = np.repeat(n > HOT, n), rank == np.repeat(rank[edge], n)
        bucket = ((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        rows, at, lengths = [], [], []

        def row(chosen: np.ndarray, bucket: int, salt: int) -> None:
            own, local = np.unique(doc[chosen], return_inverse=True)
            sub = key[chosen] & LOW
            by = np.argsort(sub, kind="stable")
            rows.append((bucket, salt, planes(np.diff(sub[by], prepend=np.uint64(0)), 5), planes(pos[chosen][by], 4), planes(local[by], 4)))
            at.append(own)
            lengths.append(len(own))

        if hot.any():
            row(np.flatnonzero(hot), -1, salt)
        rest = np.flatnonzero(~hot | first)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket[rest])) + 1, [len(rest)]))
        for lo, hi in zip(cuts, cuts[1:]):
            row(rest[lo:hi], int(bucket[rest[lo]]), 0)
        at, offsets = pa.array(np.concatenate(at)), pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, x.take(at)) for x in (ids, pa.array(versions))]
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 3)
        return pa.RecordBatch.from_arrays([*(pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)), *lists], names=["bucket", "salt", "seeds", "pos", "doc", "ids", "versions"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(2)).to_numpy().astype(np.int64) // 3)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + block_words, "right")))
                part, number = batch.slice(lo, hi - lo), number + 1
                yield block(part.column(0), part.column(1).to_numpy(), number, part.column(2).to_pylist())
                lo = hi

    kind = words.schema["id"].dataType.simpleString()
    return words.select("id", "v", "words").mapInArrow(run, f"bucket long, salt long, seeds binary, pos binary, doc binary, ids array<{kind}>, versions array<long>")


def first_matches(blocks: DataFrame, kind: str) -> DataFrame:
    """``(id, v, ref, ref_v, pos, ref_pos, seed)``: every seed occurrence with its first holder's first occurrence, and the i-th with the i-th; ``seed`` is a part of its key."""

    def run(table: pa.Table) -> pa.Table:
        lists = table.column("ids").combine_chunks()
        ids, versions = lists.flatten(), table.column("versions").combine_chunks().flatten().to_numpy()
        starts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        raw = [table.column(c).to_pylist() for c in ("seeds", "pos", "doc")]
        key = np.concatenate([np.cumsum(from_planes(r, 5)) for r in raw[0]])
        pos = np.concatenate([from_planes(r, 4) for r in raw[1]]).astype(np.int64)
        doc = np.concatenate([from_planes(r, 4).astype(np.int64) + s for r, s in zip(raw[2], starts)])
        rank = ranks(ids, versions)[doc]
        order = np.lexsort((pos, rank, key))
        key, pos, doc, rank = key[order], pos[order], doc[order], rank[order]
        keep = np.concatenate(([True], (key[1:] != key[:-1]) | (rank[1:] != rank[:-1]) | (pos[1:] != pos[:-1])))  # rows that repeat a document
        key, pos, doc, rank = key[keep], pos[keep], doc[keep], rank[keep]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        own = new | np.concatenate(([True], rank[1:] != rank[:-1]))
        nth = np.arange(len(key)) - np.flatnonzero(own)[np.cumsum(own) - 1]
        later = np.flatnonzero(rank != rank[first])
        also = later[nth[later] > 0]
        also = also[first[also] + nth[also] < len(key)]
        also = also[(rank[first[also] + nth[also]] == rank[first[also]]) & (key[first[also] + nth[also]] == key[also])]
        a, b = np.concatenate((later, also)), np.concatenate((first[later], first[also] + nth[also]))
        return pa.table([ids.take(pa.array(doc[a])), pa.array(versions[doc[a]]), ids.take(pa.array(doc[b])), pa.array(versions[doc[b]]), pa.array(pos[a].astype(np.int32)), pa.array(pos[b].astype(np.int32)), pa.array(key[a].astype("<u4").view(np.int32))], names=["id", "v", "ref", "ref_v", "pos", "ref_pos", "seed"])

    return blocks.groupBy("bucket", "salt").applyInArrow(run, f"id {kind}, v long, ref {kind}, ref_v long, pos int, ref_pos int, seed int")


def seed_pairs(pos: np.ndarray, code: np.ndarray, k: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and positions of pairs of seeds at most ``PAIR`` words apart, where seeds stand close enough for a passage.

    A pair that stands over ``REPEATS`` times belongs to repeated lines: its first place is enough.
    """
    edges = np.concatenate(([0], np.flatnonzero(np.diff(pos) > GAP) + 1, [len(pos)]))
    dense = np.zeros(len(pos), bool)
    for lo, hi in zip(edges, edges[1:]):
        if hi - lo > 2 and pos[hi - 1] + k - pos[lo] >= min_words // 2:
            dense[lo:hi] = True
    pos, code = pos[dense], code[dense]
    keys, at, step = [], [], 1
    while step < len(pos):
        apart = pos[step:] - pos[:-step]
        if not (apart <= PAIR).any():
            break
        take = (apart <= PAIR) & (apart >= k)
        with np.errstate(over="ignore"):
            keys.append(mix(code[:-step][take] * np.uint64(0x9E3779B97F4A7C15) + code[step:][take]))
        at.append(pos[:-step][take])
        step += 1
    keys, at = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.int64), *at])
    if not len(keys):
        return keys, at
    order = np.lexsort((at, keys))
    keys, at = keys[order], at[order]
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    n = np.diff(np.append(edge, len(keys)))
    keep = np.repeat(n <= REPEATS, n)
    keep[edge] = True
    return keys[keep], at[keep]


def document_chains(refs: list, pos: np.ndarray, ref_pos: np.ndarray, k: int, min_words: int, percent: int) -> tuple[list[tuple], list[tuple[int, int]]]:
    """``(ref, positions, holder's positions)`` of the parts of chains that need an alignment, and the spans that are passages for sure.

    Occurrences of one seed that each stand alone become one row with the holder's position repeated.
    """
    by: dict = {}
    for m, r in enumerate(refs):
        by.setdefault(r, []).append(m)
    a, b = pos.tolist(), ref_pos.tolist()
    parts, alone = [], []
    for r, own in by.items():
        if len(own) == 1:
            alone.append((r, [(a[own[0]], b[own[0]])]))
            continue
        for part in cut_chains(chain([(a[m], b[m]) for m in own], k), GAP):
            (parts if len(part) > 1 else alone).append((r, part))
    parts.sort(key=lambda x: x[1][0][0] - x[1][-1][0])
    sure: list[tuple[int, int]] = []
    rows = []
    for r, part in parts:
        lo, hi = part[0][0], part[-1][0] + k
        if any(s <= lo and hi <= e for s, e in sure):
            continue
        if hi - lo >= min_words:
            words = k + sum(min(k, c - x) for (x, _), (c, _) in zip(part, part[1:]))
            if 100 * words >= percent * max(hi - lo, part[-1][1] + k - part[0][1]) and all(c - x >= k or c - x == d - y for (x, y), (c, d) in zip(part, part[1:])):
                sure.append((lo, hi))
        rows.append((r, [x for x, _ in part], [y for _, y in part]))
    lines: dict = {}
    for r, [(x, y)] in alone:
        if not any(s <= x and x + k <= e for s, e in sure):
            lines.setdefault((r, y), []).append(x)
    for (r, y), places in lines.items():
        places.sort()
        start = 0
        for i in range(1, len(places) + 1):  # one row for places that are close, and not for too many words
            if i == len(places) or places[i] - places[i - 1] > 2 * GAP or places[i] - places[start] > 4096:
                rows.append((r, places[start:i], [y] * (i - start)))
                start = i
    return rows, sure


def _chained(hits: DataFrame, kind: str, k: int, window: int, min_words: int, percent: int, again: bool) -> DataFrame:
    """``(id, v, ref, ref_v, a, b, keys)``: parts of chains; without ``ref``, pairs of seeds (``keys`` at ``a``) and the starts and stops of text whose seeds all have earlier holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield work(batch.slice(at, 256))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, refs, versions, keys = [], [], [], []
        ref, ref_v, *of_all = batch.column(2).flatten().flatten()
        all_names, of_all = list(zip(ref.to_pylist(), ref_v.to_pylist())), [c.to_numpy() for c in of_all]
        stops = np.cumsum(batch.column(2).value_lengths().to_numpy())
        for i, (lo, hi) in enumerate(zip([0, *stops], stops)):
            names, (pos, ref_pos, seed) = all_names[lo:hi], (c[lo:hi] for c in of_all)
            chains, sure = document_chains(names, pos, ref_pos, k, min_words, percent)
            for (r, v), a, b in chains:
                rows.append((i, a, b))
                refs.append(r)
                versions.append(v)
                keys.append(None)
            if not again:
                continue
            at, one = np.unique(pos.astype(np.int64), return_index=True)
            code = mix(seed[one].view(np.uint32).astype(np.uint64) + np.uint64(1))
            left = np.ones(len(at), bool)
            for s, e in sure:
                left &= (at < s) | (at + k > e)
            pairs, places = seed_pairs(at[left], code[left], k, min_words)
            edges = np.concatenate(([0], np.flatnonzero(np.diff(at) > window) + 1, [len(at)]))
            spans = [(max(0, int(at[lo]) - window + 1), int(at[hi - 1]) + k + window - 1) for lo, hi in zip(edges, edges[1:])]
            spans = [(s, e) for s, e in spans if e - s >= min_words and not any(x <= s + window and e - window <= y for x, y in sure)]
            for a, b, own in ((places.tolist(), [], signed(pairs).tolist()), ([s for s, _ in spans], [e for _, e in spans], None)):
                if a:
                    rows.append((i, a, b))
                    refs.append(None)
                    versions.append(None)
                    keys.append(own)
        at = pa.array([r[0] for r in rows], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(refs, batch.column(0).type), pa.array(versions, pa.int64()), *(pa.array([r[c] for r in rows], pa.list_(pa.int32())) for c in (1, 2)), pa.array(keys, pa.list_(pa.int64()))], names=["id", "v", "ref", "ref_v", "a", "b", "keys"])

    grouped = hits.groupBy("id", "v").agg(F.collect_list(F.struct("ref", "ref_v", "pos", "ref_pos", "seed")).alias("m"))  # at most one document's seeds
    return grouped.mapInArrow(run, f"id {kind}, v long, ref {kind}, ref_v long, a array<int>, b array<int>, keys array<long>")


def alike(x: list, y: list, min_words: int) -> list[int]:
    """Starts of the stretches of ``min_words`` words of ``x`` that may lie in a passage: seven in ten of their words are in ``y`` (a passage of four in five has such a stretch)."""
    held = list(map(set(y).__contains__, x))
    least = -(-7 * min_words // 10)
    if sum(held) < least:
        return []
    total = [0, *accumulate(held)]
    size = min(min_words, len(x))
    return [i for i in range(len(x) - size + 1) if total[i + size] - total[i] >= least]


def align_row(x: np.ndarray, y: np.ndarray, a: list[int], b: list[int], k: int, min_words: int, percent: int) -> list[tuple[int, int, int, int, int]]:
    """Passages around one chain, or around each of the places ``a`` of one seed."""
    reach = max(GAP, min_words + 14)
    lines = len(a) > 1 and b[0] == b[-1]
    x, there = x.tolist(), y.tolist()
    starts = alike(x, there, min_words) if lines or len(a) < 3 else [0]
    if not starts:
        return []

    held = Counter(there)

    def too_few(here: list) -> bool:  # no alignment matches more words than both have
        return 100 * (Counter(here) & held).total() < percent * min_words

    if too_few(x):
        return []

    def passages_at(here: list, seeds: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
        if lines and too_few(here):
            return []
        runs = equal_runs(here, there, seeds, k, min_words)
        good = segments(runs, len(here), min_words, percent)
        if not good and sum(n for _, _, n in runs) > 2 * k:
            good = segments(equal_runs(here, there, seeds, k, min_words, True), len(here), min_words, percent)
        return good

    if not lines:
        return passages_at(x, list(zip(a, b)))
    out, known = [], {}
    for place in a:
        if out and out[-1][0] <= place and place + k <= out[-1][1]:
            continue
        i = bisect_left(starts, place - reach)
        if i == len(starts) or starts[i] > place + reach:
            continue
        at = max(0, place - reach)
        here = x[at : place + k + reach]
        name = (place - at, *here)  # repeated lines have the same words around them
        if name not in known:
            known[name] = passages_at(here, [(place - at, b[0])])
        out += [(s + at, e + at, t, f, n) for s, e, t, f, n in known[name]]
    return out


def _aligned(chains: DataFrame, words: DataFrame, kind: str, k: int, min_words: int, percent: int) -> DataFrame:
    reach = max(GAP, min_words + 14)

    def around(first, last):  # the words a chain can reach, and where they start
        lo = F.greatest(F.lit(0), first - reach)
        return lo, F.substring("words", lo * 3 + 1, (last + k + reach - lo) * 3)

    lo, part = around(F.array_min("b"), F.array_max("b"))
    near = chains.join(words.select(F.col("id").alias("ref"), F.col("v").alias("ref_v"), "words"), ["ref", "ref_v"]).select("id", "v", "ref", "ref_v", "a", "b", lo.alias("b_lo"), part.alias("y"))
    lo, part = around(F.col("a")[0], F.element_at("a", -1))
    near = near.join(words, ["id", "v"]).select("id", "v", "ref", "ref_v", "a", "b", "b_lo", "y", lo.alias("a_lo"), part.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            a, b, b_lo, y, a_lo, x = (batch.column(i) for i in range(4, 10))
            b_lo, a_lo = b_lo.to_numpy(), a_lo.to_numpy()
            n = a.value_lengths().to_numpy()  # as many as in b
            stop = np.cumsum(n).tolist()
            a, b = ((c.flatten().to_numpy() - np.repeat(lo, n)).tolist() for c, lo in ((a, a_lo), (b, b_lo)))
            for i, (lo, hi, p, q) in enumerate(zip([0, *stop], stop, a_lo.tolist(), b_lo.tolist())):
                good = align_row(from_words(x[i].as_buffer()), from_words(y[i].as_buffer()), a[lo:hi], b[lo:hi], k, min_words, percent)
                rows += [(i, s + p, e + p, t + q, f + q, n) for s, e, t, f, n in good]
            at = pa.array([r[0] for r in rows], pa.int64())
            c = [pa.array([r[j] for r in rows], pa.int64()) for j in range(1, 6)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), c[0], c[1], batch.column(2).take(at), c[2], c[3], c[4]], names=["id", "v", "start", "stop", "ref_id", "ref_start", "ref_stop", "matched"])

    return near.mapInArrow(run, f"id {kind}, v long, start long, stop long, ref_id {kind}, ref_start long, ref_stop long, matched long")


def _long_runs(spans: DataFrame, kind: str, min_words: int, all_of_them: bool) -> DataFrame:
    """``(run, id, v, pos)``: hashes of the runs of ``min_words`` words in the given text; those within reported passages only if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = from_words(batch.column(4)[i].as_buffer()).astype(np.uint64)
                bare = np.ones(len(words), np.int64)
                for s in batch.column(5)[i].as_py() or () if not all_of_them else ():
                    bare[s["start"] : s["stop"]] = 0
                bare = np.concatenate(([0], np.cumsum(bare)))
                for lo, hi in zip(batch.column(2)[i].as_py(), batch.column(3)[i].as_py()):
                    hi = min(hi, len(words))
                    at = np.arange(lo, hi - min_words + 1)
                    at = at[bare[at + min_words] > bare[at]]
                    if len(at):
                        keys = shingle_hashes(words[lo:hi], min_words)[at - lo]
                        own = pa.array(np.full(len(at), i))
                        yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), batch.column(0).take(own), batch.column(1).take(own), pa.array(at.astype(np.int32))], names=["run", "id", "v", "pos"])

    return spans.select("id", "v", "a", "b", "words", "spans").mapInArrow(run, f"run long, id {kind}, v long, pos int")


def _first_held(rows: DataFrame, asking: DataFrame, key: str) -> DataFrame:
    """``(id, v, ref, ref_v, pos, ref_pos)``: each asking row with its key's first holder, another document; by a partial minimum, so a common key is combined before the shuffle."""
    first = rows.groupBy(key).agg(F.min(F.struct("id", "v", "pos")).alias("first"), F.min("v").alias("lo"), F.max(F.struct("id", "v")).alias("last"))
    first = first.where("first.id <> last.id or first.v <> last.v").select(key, "first")
    held = asking.join(first, key).where("first.id <> id or first.v <> v")
    return held.select("id", "v", F.col("first.id").alias("ref"), F.col("first.v").alias("ref_v"), "pos", F.col("first.pos").alias("ref_pos"), F.lit(0).alias("seed")).distinct()


def _outermost(found: DataFrame, kind: str) -> DataFrame:
    """Without passages that lie in another one of their document; of equal ones the first holder's stays."""
    columns = ["start", "stop", "ref_id", "ref_start", "ref_stop", "matched"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, own in enumerate(batch.column(2).to_pylist()):
                end = -1
                for r in sorted(own, key=lambda r: (r["start"], -r["stop"], r["ref_id"], r["ref_start"])):
                    if r["stop"] > end:
                        rows.append((i, r))
                        end = r["stop"]
            of, at = batch.schema.field(2).type.value_type, pa.array([i for i, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *(pa.array([r[c] for _, r in rows], of.field(c).type) for c in columns), batch.column(1).take(at)], names=["id", *columns, "version"])

    grouped = found.groupBy("id", "v").agg(F.collect_list(F.struct(*columns)).alias("own"))  # at most one document's chains
    return grouped.mapInArrow(run, f"id {kind}, start long, stop long, ref_id {kind}, ref_start long, ref_stop long, matched long, version long")


def versioned(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``df`` with ``name``: 0, or the hash of the row's text where its id has several texts."""
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    several = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(f"{name}_of")).agg(F.min(text).alias("lo"), F.max(text).alias("hi")).where("lo <> hi").select(f"{name}_of")
    n = several.count()
    if not n:
        return df.withColumn(name, F.lit(0).cast("long"))
    several = F.broadcast(several) if n <= 10_000 else several  # few ids with several texts
    return df.join(several, F.col(id_col) == F.col(f"{name}_of"), "left").withColumn(name, F.when(F.col(f"{name}_of").isNotNull(), text).otherwise(F.lit(0))).drop(f"{name}_of")


def passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(id, start, stop, ref_id, ref_start, ref_stop, matched, version)``: word ranges (stop exclusive) that an earlier document holds; ``version`` as ``versioned`` gives it."""
    docs = versioned(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", "v").select("id", "v", "text")
    kind = docs.schema["id"].dataType.simpleString()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                raw = list(texts_to_words(part.column(2)))
                at = pa.array([i for i, r in enumerate(raw) if len(r) >= 3 * min_words], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array([r for r in raw if len(r) >= 3 * min_words], pa.binary())], names=["id", "v", "words"])

    rows = materialise(docs.mapInArrow(coded, f"id {kind}, v long, words binary"), "words")
    n_words = (rows.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // 3
    hits = first_matches(seed_blocks(rows, k, window, 1 + n_words // BUCKET_WORDS), kind)
    both = materialise(_chained(hits, kind, k, window, min_words, percent, True), "chains")

    # Text whose seeds have other first holders: pairs of seeds, with holders of their own.
    pairs = both.where("keys is not null").select("id", "v", F.explode(F.arrays_zip("keys", "a")).alias("p")).select("id", "v", F.col("p.keys").alias("key"), F.col("p.a").alias("pos"))
    more = _chained(_first_held(pairs, pairs, "key"), kind, k, window, min_words, percent, False)
    chains = materialise(both.where("ref is not null").unionAll(more).select("id", "v", "ref", "ref_v", "a", "b").distinct(), "all-chains")

    one = lambda rows: rows.groupBy("id", "v").agg(F.first("words").alias("words"))  # noqa: E731  rows that repeat a document

    def of(ids: DataFrame) -> DataFrame:  # the words of some documents; a list of half a million is broadcast
        few = ids.count() <= 500_000
        return one(rows.join(F.broadcast(ids) if few else ids, ["id", "v"], "left_semi"))

    words = one(rows)
    found = materialise(_aligned(chains, words, kind, k, min_words, percent), "found")

    cover = found.groupBy("id", "v").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # at most one document's chains
    spans = both.where("ref is null and keys is null").select("id", "v", "a", "b").join(cover, ["id", "v"], "left")
    left = F.exists(F.arrays_zip("a", "b"), lambda s: ~F.exists(F.coalesce("spans", F.array()), lambda c: (c["start"] <= s["a"] + window) & (s["b"] - window <= c["stop"])))
    spans = materialise(spans.withColumn("open", left), "spans")
    if not spans.where("open").limit(1).count():
        return _outermost(found, kind).withColumnRenamed("id", id_col)
    spans = materialise(spans.join(of(spans.select("id", "v")), ["id", "v"]), "span-words")
    bare = materialise(_long_runs(spans.where("open"), kind, min_words, False), "bare")
    held = _long_runs(spans, kind, min_words, True).join(bare.select("run").distinct(), "run", "left_semi")
    more = materialise(_chained(_first_held(held, bare, "run"), kind, k, window, min_words, percent, False), "more")
    both_sides = more.select("id", "v").unionAll(more.select(F.col("ref").alias("id"), F.col("ref_v").alias("v"))).distinct()
    found = found.unionAll(_aligned(more.drop("keys"), of(both_sides), kind, k, min_words, percent))
    return _outermost(found, kind).withColumnRenamed("id", id_col)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words in ``spans`` and the white space after them."""
    at = [m.start() for m in WORD.finditer(text)] + [len(text)]
    out, last = [], 0
    for start, stop in sorted(spans):
        start, stop = max(start, last), min(stop, len(at) - 1)
        if start < stop:
            out.append(text[at[last] if last else 0 : at[start]])
            last = stop
    return "".join(out) + text[at[last] if last else 0 :]


def cut_passages(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with every found passage cut from the later document; rows whose text loses all its words go."""
    cut_id, cut_v, cuts, version = (free_name(df, n) for n in ("cut_id", "cut_v", "cut", "version"))
    spans = found.groupBy(F.col(id_col).alias(cut_id), F.col("version").alias(cut_v)).agg(F.collect_list(F.struct("start", "stop")).alias(cuts))  # at most one document's chains
    rows = versioned(df, id_col, text_col, version)
    rows = rows.join(spans, (F.col(id_col) == F.col(cut_id)) & (F.col(version) == F.col(cut_v)), "left").select(*df.columns, cuts)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for text, cut in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                texts.append(without(text, [(s["start"], s["stop"]) for s in cut]) if cut and text else text)
                gone.append(bool(cut) and not WORD.search(texts[-1] or ""))
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(pa.array([not g for g in gone]))

    return rows.mapInArrow(run, df.schema)
