"""Quality rules run as a short-circuit cascade.

The base counts of a document are always computed.  The further rules are independent
predicates, so their conjunction does not depend on the order they run in; only the time
does.  ``plan_cascade`` times every rule on a bounded sample of rows, takes the share of
rows it rejects, and puts the rules in falling order of rejection per unit of cost (the
optimal order for independent predicates).  ``apply_rules`` then runs them in that order
and stops at a document's first rejection.

Edge cases: a null text counts as empty; a text without words fails the base rules
(under ten words); repeated rows give repeated results; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ASCII_SPACE, shingle_hashes, word_hashes

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))


@dataclass(frozen=True)
class Document:
    """What a rule may look at: the UTF-8 text, its words and the base counts."""

    raw: bytes
    words: list[bytes]
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


def _kept_chars(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


#: Thresholds are shares of the document, in whole numbers so that every engine agrees.
RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > d.word_chars),
    Rule("dup_lines", lambda d: 10 * d.n_dup_lines > 3 * d.n_lines),
    Rule("shouting", lambda d: 2 * _kept_chars(d.raw, UPPER) > _kept_chars(d.raw, LETTERS)),
    Rule("exclaiming", lambda d: 10 * d.raw.count(b"!") > 3 * len(d.words)),
    Rule("word_length", lambda d: not 2 * len(d.words) <= d.word_chars <= 20 * len(d.words)),
)


def read_document(text: str | None) -> Document:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip(ASCII_SPACE)]
    return Document(raw, words, len(text) - _kept_chars(raw, ASCII_SPACE), _kept_chars(raw, SYMBOLS), len(lines), len(lines) - len(set(lines)))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds at least twice."""
    n = len(words)
    if n <= window:
        return 0
    runs = shingle_hashes(word_hashes(words), window)
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def plan_cascade(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 400) -> list[Rule]:
    """``rules`` in falling order of rejected share per second, from at most ``sample_rows`` rows."""
    sample = [read_document(r[0]) for r in df.select(F.col(text_col)).where(F.pmod(F.xxhash64(text_col), F.lit(8)) == 0).limit(sample_rows).collect()]

    def worth(rule: Rule) -> float:
        began = time.perf_counter()
        rejected = sum(map(rule.rejects, sample))
        return rejected / max(time.perf_counter() - began, 1e-9)

    return sorted(rules, key=lambda r: (-worth(r), r.name))


def apply_rules(df: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts and the verdict of every document; ``rules`` run in the order given until one rejects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                d = read_document(text.as_py())
                n, repeated = len(d.words), repeat_words(d.words)
                failed = n < 10 or 100 * repeated > 20 * n
                rows.append((n, d.word_chars, d.n_symbols, d.n_dup_lines, repeated, failed, not (failed or any(r.rejects(d) for r in rules))))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.bool_()) for c in columns[5:])], names=names)

    kind = df.select(id_col).schema[0].dataType.simpleString()
    names = [id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 400) -> DataFrame:
    return apply_rules(df, plan_cascade(df, text_col, rules, sample_rows), id_col, text_col)
