"""Token counts with a whole-token shortcut.

``prove_whole`` encodes every vocabulary string by itself, once, and keeps those that
come back as exactly one token.  A pre-token in that set counts one; only the others
are merged by the tokenizer.  Special strings inside a text are cut out first, one token
each, as the library does by default.

Chunks (see ``bpe.chunks``) are counted once per worker and kept in a bounded memo.  A chunk
with characters outside the ranges every Unicode version classes alike is given to the
library whole, so the result never depends on this module's pre-tokeniser there.

Edge cases: a null text is empty, with no bytes and no tokens; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .bpe import CHUNK, PIECE, chunks, long_chunks
from .common import Memo, byte_alphabet

#: Latin, Greek and Cyrillic blocks, assigned since early Unicode versions.
COMMON = re.compile("[\x00-ȳͰ-ϿЀ-ӿ]*").fullmatch


class Counter:
    """Counts tokens as ``tokenizers`` does for a byte-level BPE file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            self.config, self.pattern = f.read(), pattern
        self.whole = self.prove_whole()

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_str(self.config)

    @cached_property
    def alphabet(self) -> dict[int, str]:
        return dict(enumerate(byte_alphabet()))

    @cached_property
    def split(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    @cached_property
    def special(self) -> re.Pattern:
        own = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        return re.compile("|".join(map(re.escape, sorted(own, key=len, reverse=True))) or "(?!)")

    def __getstate__(self):
        return self.config, self.pattern, self.whole

    def __setstate__(self, state):
        self.config, self.pattern, self.whole = state

    def prove_whole(self) -> frozenset[str]:
        """Vocabulary strings that are one pre-token and encode alone as exactly one token."""
        decode, split = self.tokenizer.decoder.decode, self.split
        texts = [decode([t]) for t in self.tokenizer.get_vocab(with_added_tokens=False)]
        texts = [t for t in texts if COMMON(t) and "�" not in t and split.findall(t) == [t]]
        return frozenset(t for t, e in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False)) if len(e.ids) == 1)

    def count_chunk(self, chunk: str) -> int:
        if not COMMON(chunk):
            return len(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        whole, merge, total = self.whole, self.tokenizer.model.tokenize, 0
        for token in self.split.findall(chunk):
            total += 1 if token in whole else len(merge(token.encode().decode("latin-1").translate(self.alphabet)))
        return total

    @cached_property
    def memo(self) -> Memo:
        """Counts of chunks; a worker keeps it across its tasks."""
        return Memo(self.count_chunk, 600_000)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        memo, total = self.memo, 0
        if "<" in text and (found := self.special.findall(text)):
            total, parts = len(found), self.special.split(text)
        else:
            parts = [text]
        for part in parts:
            if part:
                total += sum(map(memo.__getitem__, chunks(part, CHUNK) if len(part) <= PIECE else long_chunks(part)))
        return total


def count_tokens(df: DataFrame, counter: Counter, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for every row."""
    shared = df.sparkSession.sparkContext.broadcast(counter)  # the size of a vocabulary, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            texts = batch.column(1)
            n = [c.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
