"""Byte-pair encoding as an automaton: merges become gadgets, words are encoded by its transitions, ids decoded by its arc labels."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import lean, small_batches, text_of
from .tokenizers import apart_in_words, split_finely
from .words import HashIndex, Lexicon, mix, slices, split_pieces, sums

_NEVER = np.int32(2**31 - 1)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Automaton:
    """Token automaton of a merge list, built by one gadget per merge.

    At first one state loops on every byte. The gadget of the merge (u, v) -> w, in order of the merges, (1) adds an arc w beside
    every arc u after which v can follow, ending where v ends, and (2) lets all arcs u end in a copy of their state without the arc v. Its
    paths are then exactly the token sequences that the merges produce. Since all arcs of one token end in one state, a
    state is known by the token before it; what each gadget cut is kept with its number, so that the arcs of a state can be read
    off the parts of the two tokens. Arcs are entered in a transition table when a text first asks for them.
    """

    def __init__(self, labels: list[bytes], specials: dict[str, int], left, right, born, usable, cuts):
        self.labels, self.specials = labels, specials
        self.left, self.right, self.born, self.usable, self.cuts = left, right, born, usable, cuts
        self._tables()

    @classmethod
    def compile(cls, path: str) -> "Automaton":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet, vocabulary = byte_alphabet(), spec["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocabulary.values(), *specials.values()]) + 1
        labels = [b""] * size
        for token, i in vocabulary.items():
            labels[i] = bytes(alphabet[c] for c in token)
        for content, i in specials.items():
            labels[i] = content.encode("utf-8")
        left, right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        born = np.full(size, -1, np.int32)
        usable = np.zeros(size, bool)
        for token, i in vocabulary.items():
            usable[i] = len(token) == 1
        cuts: dict[tuple[int, int], int] = {}

        def follows(u: int, v: int) -> bool:
            """Whether the state after u still has an arc v."""
            x, until_x = u, _NEVER
            while x >= 0:
                y, until_y = v, _NEVER
                while y >= 0:
                    cut = cuts.get((x, y))
                    if cut is not None and cut < until_x and cut <= until_y:
                        return False
                    y, until_y = int(left[y]), born[y]
                x, until_x = int(right[x]), born[x]
            return True

        for number, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            u, v, w = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if usable[u] and usable[v] and not usable[w] and follows(u, v):
                left[w], right[w], born[w], usable[w] = u, v, number, True
                cuts[u, v] = number
        return cls(labels, specials, left, right, born, usable, cuts)

    def _tables(self) -> None:
        pairs = np.array(list(self.cuts), np.int64).reshape(-1, 2)
        self.cut_numbers = np.array(list(self.cuts.values()), np.int32)
        self.cut_index = HashIndex(max(4, (2 * len(pairs)).bit_length() + 1))
        self.cut_index.add(self._pair(pairs[:, 0], pairs[:, 1]), 0)
        # trie of the labels of usable tokens
        nodes: dict[bytes, int] = {b"": 0}
        edges: list[tuple[int, int]] = []
        ends = [-1]
        for i in np.flatnonzero(self.usable).tolist():
            label = self.labels[i]
            for n in range(1, len(label) + 1):
                if label[:n] not in nodes:
                    nodes[label[:n]] = len(ends)
                    edges.append((nodes[label[:n - 1]], label[n - 1]))
                    ends.append(-1)
            ends[nodes[label]] = i
        self.ends = np.array(ends, np.int32)
        self.trie = HashIndex((4 * len(edges)).bit_length())
        keys = np.array(edges, np.int64).reshape(-1, 2)
        self.trie.add(self._pair(keys[:, 0], keys[:, 1]), 1)
        self.sizes = np.array([len(x) for x in self.labels], np.int32)
        self.arcs, self.known = HashIndex(22), 0

    @staticmethod
    def _pair(a, b) -> np.ndarray:
        return mix((np.asarray(a, np.uint64) << np.uint64(32)) + np.asarray(b, np.uint64) + np.uint64(1))

    def _follows(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """For arrays of tokens: whether the state after u has an arc v."""
        out = np.ones(len(u), bool)
        x, until_x = u.copy(), np.full(len(u), _NEVER)
        while (x >= 0).any():
            y, until_y = v.copy(), np.full(len(u), _NEVER)
            while True:
                some = np.flatnonzero((x >= 0) & (y >= 0) & out)
                if not len(some):
                    break
                row = self.cut_index.find(self._pair(x[some], y[some]))
                hit = row >= 0
                at, cut = some[hit], self.cut_numbers[row[hit]]
                out[at[(cut < until_x[at]) & (cut <= until_y[at])]] = False
                until_y = np.where(y >= 0, self.born[y], _NEVER)
                y = np.where(y >= 0, self.left[y], -1)
            until_x = np.where(x >= 0, self.born[x], _NEVER)
            x = np.where(x >= 0, self.right[x], -1)
        return out

    def allowed(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The transition table: whether an arc v leaves the state after u. New arcs are worked out once."""
        keys = self._pair(u, v)
        row = self.arcs.find(keys)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            fresh, first = np.unique(keys[missing], return_index=True)
            if self.known + len(fresh) > 2_000_000 and self.known:
                self.arcs, self.known = HashIndex(22), 0
                return self.allowed(u, v)
            if len(fresh) > 2_000_000:
                return self._follows(u, v)
            at = missing[first]
            answer = self._follows(u[at], v[at])
            for value in (0, 1):
                some = fresh[answer == bool(value)]
                self.arcs.add_constant(some, value)
            self.known += len(fresh)
            row[missing] = self.arcs.find(keys[missing])
        return row == 1

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The token ids of each word, words of one length at a time."""
        out: list = [np.zeros(0, np.int32)] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for length, members in by_length.items():
            step = max(1, (1 << 20) // max(1, length))
            for at in range(0, len(members) if length else 0, step):
                group = members[at:at + step]
                rows, counts = self._encode_equal(np.frombuffer(b"".join(words[i] for i in group), np.uint8).reshape(len(group), length))
                for i, ids in zip(group, np.split(rows, np.cumsum(counts)[:-1])):
                    out[i] = ids
        return out

    def _encode_equal(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every prefix has one path; ``last`` holds the token by which it ends."""
        n, length = text.shape
        last = np.full((n, length + 1), -1, np.int32)
        for i in range(length):
            rows, node = np.arange(n), np.zeros(n, np.int64)
            for j in range(i, length):
                node = self.trie.find(self._pair(node, text[rows, j]))
                on = node >= 0
                rows, node = rows[on], node[on]
                if not len(rows):
                    break
                token = self.ends[node]
                some = np.flatnonzero(token >= 0)
                if len(some):
                    at, token = rows[some], token[some]
                    if i:
                        fits = self.allowed(last[at, i], token)
                        at, token = at[fits], token[fits]
                    last[at, j + 1] = token
        # walk back from the end
        steps = []
        place, live = np.full(n, length), np.arange(n)
        while len(live):
            token = last[live, place[live]]
            steps.append((live, token))
            place[live] -= self.sizes[token]
            live = live[place[live] > 0]
        owner = np.concatenate([s[0] for s in reversed(steps)])
        ids = np.concatenate([s[1] for s in reversed(steps)])
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)

    def state(self) -> tuple:
        return self.labels, self.specials, self.left, self.right, self.born, self.usable, self.cuts


class Encoder:
    """Texts to ids: pieces between white space, then pre-words by the vocabulary's pattern, then the automaton."""

    def __init__(self, automaton: Automaton, pattern: str):
        self.automaton, self.pattern = automaton, regex.compile(pattern)
        names = sorted(automaton.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.apart = apart_in_words([label for i, label in enumerate(automaton.labels) if automaton.usable[i]])
        self.lexicon = Lexicon(self._encode)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words: dict[bytes, int] = {}
        plan: list[list[int]] = []
        for piece in pieces:
            text, mine = piece.decode("utf-8"), []
            parts = self.special.split(text) if self.special and "<" in text else [text]
            for part in parts:
                if part in self.automaton.specials:
                    mine.append(-1 - self.automaton.specials[part])
                else:
                    mine += [words.setdefault(w.encode("utf-8"), len(words)) for w in self.pattern.findall(part)]
            plan.append(mine)
        coded = self.automaton.encode(list(words))
        whole = [coded[i] if i >= 0 else np.array([-1 - i], np.int32) for mine in plan for i in mine]
        sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        lengths = sums(sizes, np.fromiter(map(len, plan), np.int64, len(plan)))
        return np.concatenate(whole) if whole else np.zeros(0, np.int32), lengths

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # a special string must not be cut
        held = any(pc.any(pc.match_substring(texts, name)).as_py() for name in self.automaton.specials)
        words = split_pieces(texts) if held else split_finely(texts, self.apart)
        ids, lengths = self.lexicon.gather(self.lexicon.rows(words))
        return ids.astype("<u4"), sums(lengths, words.counts)


def _encode_rows(shared, pattern: str):
    @lean
    def run(batches):
        encoder = Encoder(Automaton(*shared.value), pattern)
        for batch in batches:
            # each length of words and each place in them is one step for a whole slice, so slices are large
            for part in slices(batch, limit=4 << 20):
                ids, counts = encoder.ids(part.column("text"))
                raw, ends = ids.tobytes(), np.cumsum(counts)
                blobs = [raw[4 * (e - n):4 * e] for n, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return run


def _decode_rows(shared):
    @lean
    def run(batches):
        labels = shared.value
        sizes = np.array([len(x) for x in labels], np.int64)
        starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(labels), np.uint8)
        for batch in batches:
            for part in slices(batch, "ids"):
                blobs = [b or b"" for b in part.column("ids").to_pylist()]
                ids = np.frombuffer(b"".join(blobs), "<u4")
                lengths = sizes[ids]
                ends = np.cumsum(lengths)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[ids] - (ends - lengths), lengths)
                raw = flat[at].tobytes()
                per_doc = np.cumsum(sums(lengths, np.array([len(b) // 4 for b in blobs], np.int64)))
                texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip([0, *per_doc[:-1].tolist()], per_doc.tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, automaton: Automaton, pattern: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers).

    Whole texts are encoded as by the tokenizers file the automaton was compiled from: no tokens added, no truncation, special
    strings inside a text are their token. ``pattern`` splits texts into pre-words. Null and empty texts have no ids. Repeated rows
    each give a row; null ids stay null; an empty table gives none; other columns are ignored. One map over the rows, no
    shuffle; the automaton's size is that of the vocabulary.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(automaton.state())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(_encode_rows(shared, pattern), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, automaton: Automaton) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the text that its ids' arc labels spell; bytes that are no UTF-8 become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(automaton.labels)
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(_decode_rows(shared), "doc_id long, n_tokens long, ids binary, decoded string")
