"""Byte BPE, token counts and packing against the libraries (op4, op9, op2)."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tablecheck.llm import bpe, common, packing, queries, token_counts
from tests.llm.helpers import ODD, documents, prose

ALPHABET = ["a", " ", "\n", "\t", "  ", "!", "1", "é", "ß", "漢", "\x1c", "\x85", "\xa0", " ", "'s", "'S", "<|endoftext|>", "́", "😀", "İ", "ⅷ", "²", "<|", "the", " the", "Σ", "ª가"]
TEXTS = [t for t in ODD if t] + ["".join(random.Random(i).choices(ALPHABET, k=i % 25)) for i in range(1500)]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact(vocabulary):
    table = vocabulary.hash
    assert sorted(table.at) == list(range(len(vocabulary.tokens)))
    assert all(table.find(t) == i for i, t in enumerate(vocabulary.tokens))
    assert all(table.find(x) == -1 for x in (b"", b"no such token at all", b"\xff\xff\xff\xff"))


def test_encode_is_the_library_s(vocabulary, reference):
    for text in TEXTS:
        ids = np.array(reference.encode_ordinary(text), "<u4").tobytes()
        assert vocabulary.encode(text) == ids, text
        assert vocabulary.decode(ids) == text.encode()


def test_long_text_goes_in_pieces(vocabulary, reference, monkeypatch):
    text = prose(3, 400) + "\n\n  " + prose(4, 400) + " \t" + "y" * 2000
    monkeypatch.setattr(bpe, "PIECE", 100)
    assert vocabulary.encode(text) == np.array(reference.encode_ordinary(text), "<u4").tobytes()


def test_encode_decode_rows(spark, vocabulary, reference):
    rows = bpe.encode_decode(documents(spark, [*ODD, (None, "x", None, None), (0, "again", "en", "s")], extra=True), vocabulary).collect()
    assert len(rows) == len(ODD) + 2
    want = Counter((i, "" if t is None else t) for i, t in [*enumerate(ODD), (None, "x"), (0, "again")])
    assert Counter((r[0], bytes(r["decoded"]).decode()) for r in rows) == want
    assert all(bytes(r["ids"]) == np.array(reference.encode_ordinary(bytes(r["decoded"]).decode()), "<u4").tobytes() for r in rows)
    assert bpe.encode_decode(documents(spark, []), vocabulary).collect() == []


def test_counts_are_the_library_s(spark):
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in list(counter.whole)[::500])
    for text in TEXTS:
        assert counter.count(text) == count(text), text
    for r in token_counts.count_tokens(documents(spark, ODD, extra=True), counter, limit=100).collect():
        text = ODD[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), count(text), count(text) > 100)
    assert token_counts.count_tokens(documents(spark, []), counter).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_fill_finds_the_best_sum(seed):
    rng = random.Random(seed)
    counts = Counter(rng.choices(range(3, 40), k=rng.randint(0, 12)))
    room = rng.randint(1, 120)
    sums = {0}
    for length, n in counts.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= room}
    best, taken = packing.fill(counts, room)
    assert best == max(sums) == sum(k * n for k, n in taken.items())
    assert all(counts[k] >= n for k, n in taken.items())


def test_word_encoder_is_the_library_s():
    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text in TEXTS:
        assert np.frombuffer(encode(text), "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 2], text


def _check_pieces(rows, texts, capacity):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids, at = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_window.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_window)


def test_pack_rows(spark):
    texts = [*ODD, *(prose(i, 20 + 37 * i % 900) for i in range(150)), *["same text of one length"] * 60]
    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    pieces = packing.pack(documents(spark, texts, extra=True).repartition(4), encode, capacity=512, block_tokens=5000)
    rows = pieces.selectExpr("doc_id", "start", "length", "crc32(ids) ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    windows = _check_pieces(rows, dict(enumerate(texts)), 512)
    assert sum(r["length"] for r in rows) > 0.96 * 512 * (windows - 1)
    assert packing.pack(documents(spark, []), encode).collect() == []


def test_equal_lengths_are_cut_and_not_padded():
    packer = packing.Packer(100, 1, 0)
    for i in range(50):
        packer.add(i, b"\1\0\0\0" * 60)
    packer.pack()
    packer.flush()
    assert len({r[5] for r in packer.rows}) == 30 and sum(r[2] for r in packer.rows) == 3000


def test_query_digests(spark):
    row = queries.op4_byte_bpe(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {row['doc_id']}").first()["text"]
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["n_tokens"] > 0


def test_texts_are_encoded_by_blocks(monkeypatch):
    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    texts = [*ODD, " outer \x0b space\n", "Ünï’s it's DON'T!!! x́y a\x1cb c\x85d Word... WORD,", *(f"again and again {i}" for i in range(500))]
    want = [b"".join(int(i).to_bytes(4, "little") for i in [*encode.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for t in texts]
    looked = []
    monkeypatch.setattr(common.Memo, "__getitem__", lambda self, key: looked.append(key) or dict.__getitem__(self, key), raising=False)
    for size in (1, 200, 8_000_000):
        monkeypatch.setattr(packing, "BLOCK_BYTES", size)
        looked.clear()
        assert list(encode.texts(pa.array(texts, pa.string()))) == want
    assert looked.count(b"again") == 1  # a thousand times in the texts
    assert list(encode.texts(pa.array([None, None]))) == [b"\2\0\0\0"] * 2 and not list(encode.texts(pa.array([], pa.string())))
