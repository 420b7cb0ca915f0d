import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quantloom.llm import bpe
from quantloom.llm.packing import LowerWordEncoder, binary_pieces, pack, write_buckets
from quantloom.llm.token_counts import read_cache, token_counts
from quantloom.llm.tokenizers import PieceEncoder, load
from quantloom.llm.words import HashIndex, split_pieces, split_words

from . import cases

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = st.sampled_from(list("aabtheing  \t\n'.,!019éßÄİΣç漢  ́\x1c\x85<|>") + ["<|endoftext|>", "<|startoftext|>", "'ll", "the", "K"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=1, max_size=20)


def library(path, texts):
    return [e.ids for e in load(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def parts(values, counts):
    return [x.tolist() for x in np.split(values, np.cumsum(counts)[:-1])]


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton.compile(BYTES)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_pieces_are_those_of_the_texts(texts):
    words = split_words(pa.array(texts), lower=False)
    assert words.take(np.arange(len(words))) == [w for t in texts for w in t.encode().split()]
    assert words.counts.tolist() == [len(t.encode().split()) for t in texts]
    pieces = split_pieces(pa.array(texts))
    assert b"".join(pieces.take(np.arange(len(pieces)))) == "".join(texts).encode()


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_piece_and_word_encoders_equal_the_library(texts):
    assert parts(*PieceEncoder(BYTES).ids(pa.array(texts))) == library(BYTES, texts)
    assert parts(*LowerWordEncoder(WORDS).ids(pa.array(texts))) == library(WORDS, texts)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_automaton_equals_the_library(automaton, texts):
    assert parts(*bpe.Encoder(automaton, public_tokenizers.PATTERN).ids(pa.array(texts))) == library(BYTES, texts)


def test_gadgets_on_repeated_letters(tmp_path):
    """With the one merge (a, a), runs are paired from the left."""
    spec = {"added_tokens": [], "model": {"vocab": {"a": 0, "b": 1, "aa": 2}, "merges": ["a a"]}}
    (tmp_path / "t.json").write_text(__import__("json").dumps(spec))
    tiny = bpe.Automaton.compile(str(tmp_path / "t.json"))
    assert [x.tolist() for x in tiny.encode([b"aaa", b"aaaa", b"baab", b""])] == [[2, 0], [2, 2], [1, 2, 1], []]


def test_bpe_round_trip(spark, automaton):
    rows = cases.awkward_rows()
    found = bpe.decode(bpe.encode(cases.table(spark, rows), automaton, public_tokenizers.PATTERN), automaton)
    want = [(i, len(ids), bytearray(np.array(ids, "<u4").tobytes()), t or "") for (i, t), ids in zip(rows, library(BYTES, [t for _, t in rows]))]
    cases.same(found, want)
    assert bpe.encode(cases.empty(spark), automaton, public_tokenizers.PATTERN).collect() == []


def test_decoding_bytes_that_are_no_text(spark, automaton):
    ids = np.array([automaton.labels.index(b"\xff"), automaton.labels.index(b"a")], "<u4").tobytes()
    coded = spark.createDataFrame([(1, 2, ids)], "doc_id long, n_tokens long, ids binary")
    assert bpe.decode(coded, automaton).first().decoded == "�a"


def test_counts_and_cache(spark, tmp_path):
    rows, cache = cases.awkward_rows(), str(tmp_path / "cache")
    want = [(i, len((t or "").encode()), len(ids), len(ids) > 512) for (i, t), ids in zip(rows, library(BYTES, [t for _, t in rows]))]
    cases.same(token_counts(cases.table(spark, rows[:9]), BYTES, cache), want[:9])
    first = read_cache(spark, cache).count()
    assert first == len({t or "" for _, t in rows[:9]})
    cases.same(token_counts(cases.table(spark, rows), BYTES, cache), want)
    stored = read_cache(spark, cache)
    assert stored.count() == len({t or "" for _, t in rows}) == stored.select("content").distinct().count()
    cases.same(token_counts(cases.table(spark, rows), WORDS, cache).select("doc_id", "n_tokens"),
               [(i, len(ids)) for (i, _), ids in zip(rows, library(WORDS, [t for _, t in rows]))])
    assert token_counts(cases.empty(spark), BYTES).collect() == []


@given(st.integers(1, 100_000))
def test_pieces_are_powers_of_two_that_add_up(n):
    pieces = binary_pieces(n, 2048)
    assert sum(pieces) == n and all(p & (p - 1) == 0 and p <= 2048 for p in pieces)


def test_packing_is_a_partition_of_every_document(spark, tmp_path):
    rows = cases.awkward_rows()
    packed = pack(cases.table(spark, rows), WORDS)
    found = sorted(packed.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.start))
    assert len({r.sequence_id for r in found}) == len(found)
    for r in found:
        assert r.offset == 0 and r.length == r.bucket == len(r.input_ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.input_ids, "<u4").tobytes())
    want = {(i, tuple(ids + [1])) for (i, _), ids in zip(rows, library(WORDS, [t for _, t in rows]))}
    once = [r for r in found if r.doc_id != 15]  # 15 is there twice
    got: dict = {}
    for r in once:
        assert r.start == len(got.setdefault(r.doc_id, []))
        got[r.doc_id] += r.input_ids
        assert r.doc_tokens >= len(got[r.doc_id])
    assert {(i, tuple(ids)) for i, ids in got.items()} == {w for w in want if w[0] != 15}
    assert sum(r.length for r in found if r.doc_id == 15) == 2 * len(next(w[1] for w in want if w[0] == 15))
    write_buckets(packed, str(tmp_path / "buckets"))
    assert spark.read.parquet(str(tmp_path / "buckets")).count() == len(found)
    assert pack(cases.empty(spark), WORDS).collect() == []
    with pytest.raises(ValueError):
        pack(cases.empty(spark), WORDS, longest=100)


def test_index_with_colliding_slots():
    index = HashIndex(10)
    hashes = np.array([random.Random(i).getrandbits(40) * 1024 + 5 for i in range(300)], np.uint64)
    index.add(hashes, 0)
    assert index.find(hashes).tolist() == list(range(300))
    assert (index.find(hashes + np.uint64(1)) == -1).all()
