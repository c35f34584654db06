"""Trie BPE and range-coded token files against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rillmart.llm import bpe_trie, rans
from rillmart.llm.queries import QUERIES
from tests.llm.conftest import ODD


def test_trie_equals_library_on_odd_texts(odd, word_bpe):
    library = Tokenizer.from_file(word_bpe)
    got = sorted((r.doc_id or 0, bytes(r.ids), r.decoded) for r in bpe_trie.encode_decode(odd, word_bpe).collect())
    expected = []
    for i, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i or 0, np.array(ids, dtype="<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected)


def test_trie_equals_library_on_given_texts(spark, small, word_bpe):
    library = Tokenizer.from_file(word_bpe)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in bpe_trie.encode_decode(docs, word_bpe).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_trie_equals_plain_merging_on_random_words(word_bpe):
    bpe, rng = bpe_trie.WordBpe(word_bpe), random.Random(3)
    words = {"".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 14))) for _ in range(2000)}
    marked = {w[:-1] + chr(256 + ord(w[-1])) for w in words}
    assert all(ids == bpe.merge(word) for word, ids in bpe.encode_words(marked).items())


def test_memory_limit_changes_nothing(word_bpe, byte_bpe, monkeypatch):
    texts = [f"word{k} other{k % 7} Same." for k in range(200)]
    a, b = bpe_trie.WordBpe(word_bpe), rans.Tokens(byte_bpe)
    whole = a.encode(texts), b.encode(texts, 0)
    monkeypatch.setattr(bpe_trie, "KNOWN", 5)
    monkeypatch.setattr(rans, "KNOWN", 5)
    a, b = bpe_trie.WordBpe(word_bpe), rans.Tokens(byte_bpe)
    assert whole == ([a.encode([t])[0] for t in texts], [b.encode([t], 0)[0] for t in texts])


def test_chunks_equal_library_on_white_space_and_collisions(byte_bpe, monkeypatch):
    rng, library = random.Random(2), Tokenizer.from_file(byte_bpe)
    parts = [" ", "  ", "\n", " \n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u3000", "word", "Été", "it's", "12", "…", "“", "日本", "𝔘", "<|endoftext|>", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 12]))) for _ in range(400)]
    expected = [np.array([*library.encode(t, add_special_tokens=False).ids, 0], dtype="<u4").tobytes() for t in texts]
    assert rans.Tokens(byte_bpe).encode(texts, 0) == expected
    monkeypatch.setattr(rans, "SLICE", 40)
    assert rans.Tokens(byte_bpe).encode(texts, 0) == expected
    hashes = rans.word_hashes
    monkeypatch.setattr(rans, "word_hashes", lambda *x: hashes(*x) & np.uint64(3))  # only four different hashes
    assert rans.Tokens(byte_bpe).encode(texts, 0) == expected


def test_files_are_read_without_their_writer(spark, byte_bpe, tmp_path):
    path = f"file://{tmp_path}/files"
    rows = [(2, "two words"), (1, "one " * 300_000), (3, None)]
    rans.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, byte_bpe)
    library = Tokenizer.from_file(byte_bpe)
    got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rans.read_tokens(spark, path).collect()}
    assert got == {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}


def test_empty_tables(empty, word_bpe, byte_bpe):
    assert bpe_trie.encode_decode(empty, word_bpe).count() == 0
    assert rans.round_trip(empty, byte_bpe).count() == 0


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 300_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    tokens = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32)
    table = rans.Frequencies(np.bincount(tokens, minlength=50_257))
    assert int(table.freq.sum()) == 1 << rans.SCALE_BITS
    data = rans.pack(table, np.array([4]), np.array([n]), tokens, 17)
    block = rans.Block(data)
    assert block.offset == 17 and (block.tokens(table) == tokens).all()
    # any checkpoint can be decoded alone
    last = block.segment(table, block.segments - 1)
    begin = (block.segments - 1) * rans.INTERVAL * block.lanes
    assert (last[: n - begin] == tokens[begin:]).all()
    with pytest.raises(ValueError):
        rans.Block(data[:-1] + bytes([data[-1] ^ 1]))


def test_files_give_back_the_library_ids(spark, odd, byte_bpe):
    library = Tokenizer.from_file(byte_bpe)
    got = [(r.start, r.doc_id, bytes(r.ids)) for r in rans.round_trip(odd, byte_bpe).collect()]
    expected = []
    for i, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        expected.append((i, np.array(ids, dtype="<u4").tobytes()))
    expected.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    start = 0
    for (at, doc, ids), (i, own) in zip(sorted(got, key=lambda x: x[0]), expected, strict=True):
        assert (at, doc, ids) == (start, i, own)
        start += len(own) // 4


def test_token_query(spark, small, byte_bpe):
    library = Tokenizer.from_file(byte_bpe)
    texts = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    got = {r.doc_id: r for r in QUERIES["op8_rans"](spark, small).collect()}
    start = 0
    for i, text in texts:
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        assert tuple(got[i])[:4] == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
