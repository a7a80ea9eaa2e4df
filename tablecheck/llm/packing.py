"""Packing documents into fixed windows by minimum bin slack.

Every task tokenises its documents and packs them in blocks of bounded size.  A document
longer than a window gives whole windows and a remainder.  The remainders of a block form a
multiset of lengths; for each window the longest is placed first, and a subset-sum program
over a bitset (one bit per fill, lengths in falling order, counts split into powers of
two) finds the multiset of others that comes closest to the capacity.  Backtracking through
the kept bitsets gives how often each length is taken, and the same multiset is
used again as long as the counts last.

A window that cannot be filled to within ``max_slack`` tokens is not padded: what would go
into it is laid end to end with its like and cut at the window's edge.  What then remains,
less than one window, joins the task's next block; the last remainders of up to 512
tasks are packed once more together, so only one window in about 512 tasks is padded.

Edge cases: a null text is empty and still holds the end id; a null document id is carried as
it is; repeated rows are packed as separate documents; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import Memo, byte_alphabet, materialise, word_blocks

#: A word whose letters and trailing ASCII signs are separate pre-tokens.
LETTERS_SIGNS = re.compile(r"([^\W\d_]+)([!-&(-/:-;=?@\[-`{}~]*)").fullmatch
SIGNS = bytes(c for c in range(33, 127) if LETTERS_SIGNS("a" + chr(c)) and not chr(c).isalpha())

#: Bytes of text whose words are looked up together.
BLOCK_BYTES = 8_000_000


class WordEncoder:
    """Ids of a text by a ``tokenizers`` file whose pre-tokeniser drops white space.

    No pre-token, normalisation or special string crosses ASCII white space, so words are
    encoded apart and kept in a bounded memo.
    """

    def __init__(self, path: str, end_id: int):
        with open(path, encoding="utf-8") as f:
            self.config, self.end_id = f.read(), end_id

    def __getstate__(self):
        return self.config, self.end_id

    def __setstate__(self, state):
        self.config, self.end_id = state

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_str(self.config)

    @cached_property
    def alphabet(self) -> dict[int, str]:
        return dict(enumerate(byte_alphabet()))

    @cached_property
    def parts(self) -> Memo:
        return Memo(self._part, 400_000)

    @cached_property
    def words(self) -> Memo:
        return Memo(self._word, 300_000)

    def _part(self, part: bytes) -> bytes:
        """Ids of one normalised pre-token; printable ASCII stands for itself in the byte alphabet."""
        shown = part.decode() if part.isascii() else part.decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        letters = word.rstrip(SIGNS)
        if letters.isalpha():  # ASCII letters only
            signs = word[len(letters) :]
            return self.parts[letters.lower()] + self.parts[signs] if signs else self.parts[letters.lower()]
        text = word.decode("utf-8", "replace")
        found = LETTERS_SIGNS(text)
        if not found or not text.isascii() and ("Σ" in text or "İ" in text or not is_normalized("NFC", text)):
            return self._encode(text)
        letters, signs = found.groups()
        letters = letters.lower()
        if not letters.isalpha() or not is_normalized("NFC", letters):
            return self._encode(text)
        return self.parts[letters.encode()] + (self.parts[signs.encode()] if signs else b"")

    def __call__(self, text: str | None) -> bytes:
        words = self.words
        return b"".join([words[w] for w in (text or "").encode("utf-8", "replace").split()]) + self.end_id.to_bytes(4, "little")

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """``self(text)`` of every text; a word is looked up once for each block of texts."""
        words, end = self.words, self.end_id.to_bytes(4, "little")
        for distinct, number, edges in word_blocks(texts, BLOCK_BYTES):
            ids = [words[w] for w in distinct]
            length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            n = length[number]
            stop = np.concatenate(([0], np.cumsum(n)))
            out = np.frombuffer(b"".join(ids), "<u4")[np.arange(stop[-1]) + np.repeat((np.cumsum(length) - length)[number] - stop[:-1], n)]
            edges = stop[edges]
            for lo, hi in zip(edges, edges[1:]):
                yield out[lo:hi].tobytes() + end


def fill(counts: Counter, room: int) -> tuple[int, Counter]:
    """The largest sum of at most ``room`` that lengths in ``counts`` can make, and how often each is taken."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((x for x in counts if 0 < x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    best = at = reach.bit_length() - 1
    taken: Counter = Counter()
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += take
            at -= length * take
    return best, taken


def pack_lengths(counts: Counter, capacity: int, max_slack: int) -> Iterator[tuple[Counter, int, bool]]:
    """``(lengths of a window, how many such windows, whether it is full)`` until ``counts`` is used up."""
    counts = Counter({k: v for k, v in counts.items() if v})
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        best, taken = fill(counts, capacity - seed)
        counts[seed] += 1
        taken[seed] += 1
        times = min(counts[k] // n for k, n in taken.items())
        for k, n in taken.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        yield taken, times, capacity - best - seed <= max_slack


class Packer:
    """Packs pieces ``(document, start, ids, document tokens)``; ``rows`` collects what is placed."""

    def __init__(self, capacity: int, max_slack: int, first_id: int):
        self.capacity, self.max_slack, self.next_id = capacity, max_slack, first_id
        self.waiting: list[tuple] = []
        self.tokens = 0
        self.rows: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._place((doc, start, ids[4 * start : 4 * (start + self.capacity)], total), 0)
            self.next_id += 1
        if total > whole:
            self.put((doc, whole, ids[4 * whole :], total))

    def put(self, piece: tuple) -> None:
        self.waiting.append(piece)
        self.tokens += len(piece[2]) // 4

    def _place(self, piece: tuple, offset: int) -> None:
        doc, start, ids, total = piece
        self.rows.append((doc, start, len(ids) // 4, ids, total, self.next_id, offset))

    def pack(self) -> None:
        """Place what waits; less than one window stays waiting."""
        by_length = defaultdict(list)
        for piece in self.waiting:
            by_length[len(piece[2]) // 4].append(piece)
        loose = []
        for taken, times, full in pack_lengths(Counter({k: len(v) for k, v in by_length.items()}), self.capacity, self.max_slack):
            for _ in range(times):
                pieces = [by_length[k].pop() for k, n in sorted(taken.items(), reverse=True) for _ in range(n)]
                if not full:
                    loose += pieces
                    continue
                for piece, offset in zip(pieces, accumulate((len(p[2]) // 4 for p in pieces), initial=0)):
                    self._place(piece, offset)
                self.next_id += 1
        self.waiting, self.tokens, offset, window = [], 0, 0, []
        for doc, start, ids, total in loose:
            while ids:
                part = ids[: 4 * (self.capacity - offset)]
                window.append(((doc, start, part, total), offset))
                offset += len(part) // 4
                start += len(part) // 4
                ids = ids[len(part) :]
                if offset == self.capacity:
                    for piece, at in window:
                        self._place(piece, at)
                    self.next_id += 1
                    offset, window = 0, []
        for piece, _ in window:
            self.put(piece)

    def flush(self) -> None:
        """Place what still waits into one padded window."""
        offset = 0
        for piece in self.waiting:
            self._place(piece, offset)
            offset += len(piece[2]) // 4
        self.next_id += bool(self.waiting)
        self.waiting, self.tokens = [], 0

    def taken(self, schema: pa.Schema, task: int) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        for lo in range(0, len(rows), 2000):
            columns = list(zip(*rows[lo : lo + 2000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns, [task] * len(columns[0])], schema)], schema=schema)


def pack(df: DataFrame, encode: WordEncoder, capacity: int = 4096, max_slack: int = 16, block_tokens: int = 3_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, start, length, ids, doc_tokens, sequence_id, offset)``, one row for each piece.

    ``ids`` are little-endian unsigned 32-bit integers.  The placement is written once to the
    shared folder: sequence ids come from the task that made them.
    """
    shared = df.sparkSession.sparkContext.broadcast(encode)  # the size of a vocabulary, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own = TaskContext.get().partitionId(), shared.value
        packer, schema = Packer(capacity, max_slack, task << 32), None
        for batch in batches:
            schema = schema or _schema(batch.schema.field(0).type, id_col)
            for doc, ids in zip(batch.column(0), own.texts(batch.column(1))):
                packer.add(doc.as_py(), ids)
                if packer.tokens >= block_tokens:
                    packer.pack()
                if len(packer.rows) >= 4000:
                    yield from packer.taken(schema, task)
        packer.pack()
        rest = packer.waiting
        if schema:
            yield from packer.taken(schema, task)
            packer.rows = [(doc, start, len(ids) // 4, ids, total, None, None) for doc, start, ids, total in rest]
            yield from packer.taken(schema, task)

    def run_rest(table: pa.Table) -> pa.Table:
        schema = _schema(table.schema.field(0).type, id_col)
        task = table.column("task")[0].as_py()
        packer = Packer(capacity, max_slack, 1 << 62 | task // 512 << 32)
        for row in zip(*(table.column(i).to_pylist() for i in (0, 1, 3, 4))):
            packer.put(row)
        packer.pack()
        packer.flush()
        return pa.Table.from_batches(list(packer.taken(schema, task)), schema)

    kind = df.select(id_col).schema[0].dataType.simpleString()
    out = f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, task long"
    first = materialise(df.select(id_col, text_col).mapInArrow(run, out), "packed")
    rest = first.where("sequence_id is null").groupBy(F.expr("task div 512")).applyInArrow(run_rest, out)
    return first.where("sequence_id is not null").unionByName(rest).drop("task")


def _schema(kind: pa.DataType, id_col: str) -> pa.Schema:
    return pa.schema([(id_col, kind), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("task", pa.int64())])
