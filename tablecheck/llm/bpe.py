"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary's byte strings (hash and displace,
Belazzougui et al., 2009).  A pre-token that is a vocabulary entry is resolved by one
probe and one comparison.  Tier two: any other pre-token is merged with a heap of
candidate pairs over a linked list of byte spans, in O(n log n) for n bytes, so one very
long pre-token stays cheap.

Texts are cut into chunks before a white space character that follows a non-space: the
pattern's matches never cross such a place and never look behind it, so chunks are encoded
apart.  Each worker keeps a bounded memo of chunks; the tiers run once per distinct chunk.

Edge cases: a null text is empty and gives no ids; repeated rows give repeated results;
ids that are not in the vocabulary make ``decode`` fail; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import Memo

#: White space other than space and newline (fixed values: Unicode White_Space).
OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x85\xa0  -     　]").search
#: Characters of a text that are encoded at once; bounds what a long text needs.
PIECE = 1 << 20


def chunks(text: str, split: re.Pattern | regex.Pattern) -> Iterable[str]:
    """Runs of a text that pre-tokenise apart: cuts lie before white space that follows a non-space."""
    if OTHER_SPACE(text):
        return _general_chunks(text, split)
    parts = text.replace("\n", " \n").split(" ")
    if "" in parts or "\n" in parts:
        return _general_chunks(text, split)
    return [parts[0], *[x if x[0] == "\n" else " " + x for x in parts[1:]]]


def _general_chunks(text: str, split: regex.Pattern) -> list[str]:
    return split.findall(text)


#: A chunk: white space, then non-spaces; White_Space as the pre-tokeniser's pattern sees it.
CHUNK = regex.compile(r"\s*\S+|\s+")


class PerfectHash:
    """Minimal perfect hash of byte strings: ``find`` gives an entry's place or -1."""

    def __init__(self, keys: list[bytes], load: int = 2):
        n = len(keys)
        self.n, self.m = max(n, 1), max(1, n // load)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        groups: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            groups.setdefault(h % self.m, []).append(i)
        self.shift = [0] * self.m
        self.keys: list[bytes | None] = [None] * self.n
        self.at: list[int] = [-1] * self.n
        free = iter(range(self.n))
        for g, own in sorted(groups.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:  # alone in its group: it takes any free place, named directly
                slots = [next(s for s in free if self.keys[s] is None)]
                self.shift[g] = -1 - slots[0]
            else:
                d = 0
                while True:
                    slots = [self._slot(hashes[i], d) for i in own]
                    if all(self.keys[s] is None for s in slots) and len(set(slots)) == len(own):
                        break
                    d += 1
                self.shift[g] = d
            for s, i in zip(slots, own):
                self.keys[s], self.at[s] = keys[i], i

    def _slot(self, h: int, d: int) -> int:
        if d < 0:
            return -1 - d
        full = 0xFFFFFFFFFFFFFFFF
        x = (h + d * 0x9E3779B97F4A7C15) & full
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & full
        return (x ^ (x >> 32)) % self.n

    def find(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        s = self._slot(h, self.shift[h % self.m])
        return self.at[s] if self.keys[s] == key else -1


class Vocabulary:
    """Merge ranks of byte strings, as a rank file lists them; a string's rank is its id."""

    def __init__(self, tokens: list[bytes], ids: list[int], pattern: str):
        self.tokens, self.ids, self.pattern = tokens, ids, pattern

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        return cls([base64.b64decode(a) for a, _ in rows], [int(b) for _, b in rows], pattern)

    def __getstate__(self):
        return self.tokens, self.ids, self.pattern

    def __setstate__(self, state):
        self.tokens, self.ids, self.pattern = state

    @cached_property
    def hash(self) -> PerfectHash:
        return PerfectHash(self.tokens)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return dict(zip(self.tokens, self.ids))

    @cached_property
    def strings(self) -> dict[int, bytes]:
        return dict(zip(self.ids, self.tokens))

    @cached_property
    def split(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the lowest-ranked adjacent pair merges first, the leftmost of equals."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]  # 0: this span has been swallowed by the one before
            if not middle or middle >= n or end[middle] != stop:
                continue
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def encode_chunk(self, chunk: str) -> list[int]:
        out, find, ids = [], self.hash.find, self.ids
        for token in self.split.findall(chunk):
            piece = token.encode("utf-8", "replace")
            if (at := find(piece)) >= 0:
                out.append(ids[at])
            else:
                out += self.merge(piece)
        return out

    @cached_property
    def memo(self) -> Memo:
        """A chunk's ids as little-endian unsigned 32-bit integers; a worker keeps it across its tasks."""
        return Memo(lambda chunk: np.array(self.encode_chunk(chunk), "<u4").tobytes(), 400_000)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        memo = self.memo
        if len(text) <= PIECE:
            return b"".join([memo[c] for c in chunks(text, CHUNK)])
        return b"".join(memo[c] for c in long_chunks(text))

    def decode(self, ids: bytes) -> bytes:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()])


def long_chunks(text: str) -> Iterator[str]:
    """Chunks of a long text one at a time; the list of all is never held."""
    return (m.group() for m in CHUNK.finditer(text))


def encode_decode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)``: ids as little-endian unsigned 32-bit integers, and the bytes they decode to."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # the size of a vocabulary, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids = [v.encode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([v.decode(x) for x in ids], pa.binary())], names=[id_col, "ids", "decoded"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded binary")
