"""Operators 7 and 9: byte-pair encoding and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brute import clashing, documents  # noqa: F401  fixtures
from loomwork.llm import bpe, packing, pieces

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
# Odd texts: special tokens, contractions, white space of all kinds, combining marks, final sigma, other alphabets.
ODD = ["", " ", "\n\n  a", "It's 'tis we'll DON'T", "''s x'S", "a<|endoftext|>b <|startoftext|>c<|endoftext", "123 45٣ ²½Ⅷ",
       "é Å ﬁ İi ΣΑΣ ΟΔΟΣ ß", "日本語 テスト 한국어", "x y z　w\x1cq", "aaaaaaaaaaaaaaaa", "#*$%&|<>!!", "🙂🙂 ok",
       "tab\tnew\r\nline\x0b\x0c", "über Straße ñandú Ç", "<|", "the the The THE", "‍­z", "a'lle re've"]


def library(path, text):
    tokenizer = Tokenizer.from_file(path)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def sample(spark, sf, n=60):
    rows = spark.read.parquet(f"{sf}/documents.parquet").limit(n).collect()
    return [r["text"] for r in rows]


def test_pair_index_equals_library(spark, sf, documents, clashing):
    texts = ODD + [None] + sample(spark, sf)
    rows = bpe.encode_decode(clashing(documents(texts)), WORDS, content=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, shown = library(WORDS, texts[r["doc_id"]])
        assert (r["ids"], r["decoded"], r["n_tokens"]) == (ids, shown, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(shown.encode()).hexdigest()


def test_ascii_pattern_cuts_alike():
    """op9: texts of ASCII take the faster engine and fall into the same pieces."""
    cutter = pieces.Cutter({}, pieces.BYTE_LEVEL_PATTERN, ascii_pattern=pieces.BYTE_LEVEL_ASCII)
    slow = pieces.Cutter({}, pieces.BYTE_LEVEL_PATTERN)
    draw = random.Random(9)
    parts = [chr(c) for c in range(128)] + ["'s", "'re", "'ll", " '", "  ", "\n ", "word", "12", "'S", "\r\n"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randrange(30)))
        assert cutter.pieces(text) == slow.pieces(text)
        assert cutter.find_ascii.__self__ is not slow.find.__self__ and slow.find_ascii is slow.find
    assert cutter.pieces("é 1") == ["é", " 1"]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN", 5)
    encoder = bpe.Encoder(pieces.read_vocabulary(WORDS))
    texts = ["the cat sat on the mat", "another text with other words", "the cat again"]
    for text in texts:
        (raw, shown), = encoder.encode([text])
        assert (np.frombuffer(raw, "<u4").tolist(), shown) == library(WORDS, text)


def test_byte_encoder_equals_library(spark, sf, monkeypatch):
    monkeypatch.setattr(packing, "_KNOWN", 50)
    encoder = packing.ByteEncoder(pieces.read_vocabulary(BYTES))
    for text in ODD + sample(spark, sf, 25):
        assert encoder.encode(text).tolist() == library(BYTES, text)[0]


@pytest.mark.parametrize("capacity,window", [(1024, 1 << 20), (16, 64)])
def test_packing(spark, sf, documents, clashing, capacity, window):
    texts = ODD + [None] + sample(spark, sf, 40)
    docs = clashing(documents(texts)).repartition(3, "doc_id")
    rows = packing.pack(docs, BYTES, capacity=capacity, window=window).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert len(by_doc) == len(texts)
    for doc, own in by_doc.items():
        ids = np.array([*library(BYTES, texts[doc])[0], 0], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    unfilled = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        unfilled += at < capacity
    assert unfilled <= 3      # the last sequence of each task


def test_balance_spreads_cost():
    draw = random.Random(1)
    sizes = [draw.randrange(1, 1024) for _ in range(400)]
    made = packing.balance([packing.Piece(i, 0, np.zeros(n, "<u4"), n) for i, n in enumerate(sizes)], 1024)
    filled = [sum(len(p.ids) for p in s) for s in made]
    assert sum(filled) == sum(sizes) and all(n == 1024 for n in filled[:-1])
    cost = [sum(len(p.ids) + len(p.ids) ** 2 / 512 for p in s) for s in made[:-1]]
    assert np.std(cost) / np.mean(cost) < 0.3


def test_empty_table(documents):
    none = documents(["a"]).limit(0)
    assert packing.pack(none, BYTES).collect() == [] and bpe.encode_decode(none, WORDS).collect() == []
