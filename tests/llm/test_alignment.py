"""Alignment of two public tokenizers against whole-text encodings and plain loops."""

import collections
import hashlib
import random

import pyarrow as pa
import public_tokenizers
import pytest

from quantloom.llm import alignment
from quantloom.llm.alignment import align

from .cases import awkward_rows, empty, prose, same, table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
# parts of texts that tokenizers treat in ways of their own
PARTS = [*"abct e  \n\r\t.,;:)({}12'’éß漢𝕏▁\xa0　\x0b\x0c\x1c\x85 \0<>|", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "'s", " the", "ing", "\r\n", "();\r"]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    labels = alignment.ByteSide(A).labels

    def tokens(text):
        piece = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
        a = [(i, labels[i]) for i in first.encode(" " + text, add_special_tokens=False).ids]
        return a, [(i, piece(i)) for i in second.encode(text)]

    return tokens


def hostile(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def brute(rows, tokens):
    docs = []
    for i, text in rows:
        a, b = tokens(text) if text else ([], [])
        if text and any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
            a, b = [], []
        groups, at, k = [], 0, 0
        ends = lambda side: [sum(len(x) for _, x in side[:j + 1]) for j in range(len(side))]
        ea, eb = ends(a), ends(b)
        for end in sorted(set(ea) & set(eb)):
            x, y = ea.index(end) + 1, eb.index(end) + 1
            groups.append(([t for t, _ in a[at:x]], [t for t, _ in b[k:y]]))
            at, k = x, y
        docs.append((i, len(a), len(b), groups))
    count = collections.Counter(p for *_, groups in docs for p in {(x, y) for g in groups for x in g[0] for y in g[1]})
    top = collections.defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for i, na, nb, groups in docs:
        found = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((i, na, nb, len(groups), len(found), sum(count[p] == top[p[0]] for p in found), sum(count[p] for p in found),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def test_tokens_equal_whole_texts(plain):
    texts = [t for t in hostile(1500)]
    spaced = pa.array([" " + t for t in texts])
    for side, own in ((alignment.ByteSide(A), 0), (alignment.PieceSide(B), 1)):
        ids, counts = side.tokens(spaced)
        at = 0
        for text, n in zip(texts, counts.tolist()):
            found = ids[at:at + n].tolist()
            at += n
            wanted = plain(text)[own]
            spelled = b"".join(x for _, x in wanted) == (" " + text).encode()
            assert (-1 not in found) == spelled
            assert not spelled or found == [i for i, _ in wanted]


def test_align_equals_plain_loops(spark, plain):
    short = [(i, t if t is None or len(t) < 5000 else prose(i or 0, 300)) for i, t in awkward_rows()]
    rows = short + [(100 + i, t) for i, t in enumerate(hostile(150, 7))] + [(400, "the same"), (400, "the same"), (401, "a▁b")]
    same(align(table(spark, rows), A, B), brute(rows, plain))


def test_small_chunks_and_large_groups_change_nothing(spark, plain, monkeypatch):
    rows = [(i, t) for i, t in enumerate(hostile(40, 9))] + [(90, "漢字" * 40 + "é" * 30), (91, prose(3, 200))]
    monkeypatch.setattr(alignment, "CHUNK", 64)
    monkeypatch.setattr(alignment, "_LARGE", 3)
    monkeypatch.setattr(alignment, "_LINKS", 5)
    same(align(table(spark, rows), A, B), brute(rows, plain))


def test_empty_and_tokenless(spark):
    assert align(empty(spark), A, B).count() == 0
    same(align(table(spark, [(1, None), (2, ""), (None, "▁")]), A, B), [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, None)])
