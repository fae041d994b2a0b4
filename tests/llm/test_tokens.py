"""Token files: exact round trip, ids of the plain tokenizer, and the byte code."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arenamart.llm import token_output as t


def plain():
    own = Tokenizer.from_file(public_tokenizers.path(t.TOKENIZER))
    own.encode_special_tokens = True
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def expected(rows):
    ids_of, at, out = plain(), 0, []
    for doc_id, text in rows:
        ids = [*ids_of(text), 0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    assert sorted(tuple(r) for r in t.op8_tokens(spark, SF).collect()) == expected(rows)


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_edges(spark, edge, nothing, monkeypatch, size):  # noqa: F811
    monkeypatch.setattr(t, "BLOCK_IDS", size)
    monkeypatch.setattr(t, "PART_IDS", 20 * size)
    got = sorted((tuple(r) for r in t.token_files(edge).collect()), key=lambda r: r[1])
    ids_of = plain()
    order = [(r[0] is not None, r[0]) for r in got]
    assert order == sorted(order, key=lambda x: (x[0], x[1] or 0))
    assert [r[1] for r in got] == list(np.cumsum([0, *[r[2] for r in got]])[:-1])
    want = sorted(((r.doc_id, 1 + len(ids_of(r.text)), zlib.crc32(np.array([*ids_of(r.text), 0], "<u4").tobytes())) for r in edge.collect()), key=str)
    assert sorted(((r[0], r[2], r[3]) for r in got), key=str) == want
    assert t.token_files(nothing).count() == 0


SPACES = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​"]
PARTS = [*SPACES, "a", "The", "123", "!", "...", "'s", "'ll", "é", "é", "中文", "😀", "<|endoftext|>", "\x00", "﻿", "word"]


def test_pieces_give_the_ids_of_whole_texts():
    encoder, ids_of, rnd = t.Encoder(public_tokenizers.path(t.TOKENIZER)), plain(), random.Random(4)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(25))) for _ in range(1500)]
    texts += [" ".join(rnd.choice(PARTS[12:]) for _ in range(30)) for _ in range(500)]
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == [ids_of(x) for x in texts]
    assert encoder.encode([]) == []


def test_known_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(t, "PIECES", 10)
    encoder, ids_of = t.Encoder(public_tokenizers.path(t.TOKENIZER)), plain()
    for k in range(5):
        text = " ".join(f"w{k}x{i}" for i in range(20))
        assert encoder.encode([text])[0].tolist() == ids_of(text)
    assert len(encoder.known) <= 40


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=50))
def test_byte_code(ranks):
    control, data = t.encode_ranks(np.array(ranks, np.int64))
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
    assert t.decode_ranks(control, data, len(ranks)).tolist() == ranks


def test_frequent_ids_take_one_byte(spark, tmp_path):
    docs = spark.createDataFrame([(i, "the the the cat") for i in range(5)], "doc_id bigint, text string")
    t.write_tokens(docs, str(tmp_path / "f"))
    known = spark.read.parquet(str(tmp_path / "f/vocabulary")).orderBy("rank").collect()
    assert [r.n for r in known] == sorted((r.n for r in known), reverse=True)
    blocks = spark.read.parquet(str(tmp_path / "f/blocks")).collect()
    assert sum(len(b.data) for b in blocks) == sum(b.n for b in blocks)


def test_added_tokens_get_the_ids_of_the_loaded_tokenizer(spark):
    own, rnd = Tokenizer.from_file(public_tokenizers.path(t.TOKENIZER)), random.Random(6)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|><|endoftext|>\nb c", "<|endoftext| >", "plain words"]
    texts += ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(25))) for _ in range(1500)]
    texts += [" ".join(rnd.choice(PARTS[12:]) for _ in range(30)) for _ in range(500)]
    want = [own.encode(x, add_special_tokens=False).ids for x in texts]
    assert 50256 in want[0]
    for _ in range(2):
        assert [x.tolist() for x in t.encoder(public_tokenizers.path(t.TOKENIZER)).encode(texts)] == want
    got = sorted(tuple(r) for r in t.token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect())
    starts = np.cumsum([0, *[len(x) + 1 for x in want]]).tolist()
    assert got == [(i, starts[i], len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for i, x in enumerate(want)]


def test_slices_are_bounded_by_bytes_and_rows(monkeypatch):
    monkeypatch.setattr(t, "SLICE_BYTES", 100)
    monkeypatch.setattr(t, "SLICE_ROWS", 4)
    texts = pa.array(["x" * 250, "é" * 30, "y" * 40, "z", None, "", "", "", "w" * 101, "v" * 100])
    assert list(t._slices(texts)) == [(0, 1), (1, 2), (3, 4), (7, 1), (8, 1), (9, 1)]
    assert list(t._slices(pa.array([], pa.string()))) == []


def test_remembered_pieces_take_little_room():
    own, r = t.Encoder(public_tokenizers.path(t.TOKENIZER)), random.Random(5)
    texts = ["x " + " ".join(str(r.randrange(10**9)) for _ in range(1000)) for _ in range(150)]
    assert list(map(list, own.encode(texts))) == list(map(plain(), texts))
    assert len(own.known) > 1 << 16  # the first room was too small
    assert own.lengths.itemsize == own.ids.itemsize == 4
    more = t._grown(np.arange(4), 3, 5)
    assert len(more) == 8 and list(more[:3]) == [0, 1, 2] and t._grown(more, 3, 8) is more
