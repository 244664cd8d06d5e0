"""SentencePiece encoding by one Viterbi pass over an Aho-Corasick automaton, and decoding.

The automaton holds all ordinary pieces. As it reads a text, its state and the output
links from there name every piece that ends at the current position; each relaxes the
best score of that position. The stretches of many texts take each step side by side, in
numpy. Characters that are no piece of their own may also be
written as bytes. Equal scores go to the longest piece, the first that the links name.

No ordinary piece of a SentencePiece vocabulary has a blank after another character, so
the best path splits at such blanks: stretches between them are encoded apart, each once
in a batch of texts. A vocabulary that has such
pieces is noticed, and its texts are encoded whole.

The stored scores of a BPE vocabulary are ranks, not log-probabilities; by default the
score of a piece is minus the logarithm of its rank, as Zipf's law has it.

Defined results: a blank goes before a text and is taken off again, so every text is
restored exactly when the vocabulary has byte pieces; the mark U+2581 itself is written
as bytes and survives; a null text has null ids, an empty one none; any length is encoded
whole. Tokenizers are only read, never trained.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.arrays import mix
from filmgrain.llm.shipping import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters read side by side.
PIECE = 1 << 18
#: Stretches whose ids are kept from one batch of texts to the next, at most, and their longest.
KEPT, LONGEST = 1 << 16, 32
_STRETCH = re.compile(r" *[^ ]+| +")


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces (id, text with blanks, score), ids of the 256 byte pieces, unknown id, size."""

    pieces: tuple[tuple[int, str, float], ...]
    bytes_: tuple[int, ...] | None
    unknown: int
    size: int


def read_vocabulary(path: str = MODEL, by_rank: bool = True) -> Vocabulary:
    """Read a SentencePiece model file on the driver; a vocabulary is small and travels by broadcast."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    ordinary = [i for i in ids if not (
        model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    score = {i: model.get_score(i) for i in ordinary}
    if by_rank:
        ranked = sorted(ordinary, key=lambda i: (-score[i], i))
        score = {i: -math.log(rank + 2) for rank, i in enumerate(ranked)}
    by_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
    return Vocabulary(
        tuple((i, model.id_to_piece(i).replace(MARK, " "), score[i]) for i in ordinary),
        tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else None, model.unk_id(), len(ids))


class Automaton:
    """Aho-Corasick over texts, as arrays that step many stretches at once.

    States are numbered by depth. ``back`` is where a state falls back; ``ends`` lists
    the entries that end in a state, its own and those of its output links, longest first.
    """

    def __init__(self, entries: list[str]) -> None:
        trie: list[dict[str, int]] = [{}]
        own: list[int] = [-1]
        for number, text in enumerate(entries):
            state = 0
            for char in text:
                if char not in trie[state]:
                    trie[state][char] = len(trie)
                    trie.append({})
                    own.append(-1)
                state = trie[state][char]
            own[state] = number
        self.back = np.zeros(len(trie), dtype=np.int64)
        ends: list[list[int]] = [[] for _ in trie]
        queue = deque([0])
        while queue:  # by depth: what a state falls back to is complete
            state = queue.popleft()
            ends[state] = ([own[state]] if own[state] >= 0 else []) + (ends[self.back[state]] if state else [])
            for char, child in trie[state].items():
                queue.append(child)
                at = int(self.back[state]) if state else -1
                while at >= 0 and char not in trie[at]:
                    at = int(self.back[at]) if at else -1
                self.back[child] = trie[at][char] if at >= 0 else 0
        self.many = np.array([len(e) for e in ends])
        self.ends = np.full((len(trie), max(1, int(self.many.max()))), -1, dtype=np.int32)
        for state, some in enumerate(ends):
            self.ends[state, :len(some)] = some
        # transitions in a table with open addresses
        edges = [(state << 21 | ord(char), child) for state, row in enumerate(trie) for char, child in row.items()]
        self.bits = max(4, (4 * len(edges)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.to = np.zeros(1 << self.bits, dtype=np.int64)
        for (key, child), slot in zip(edges, self._slots(np.array([k for k, _ in edges], dtype=np.int64)).tolist()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.to[slot] = key, child

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _child(self, states: np.ndarray, points: np.ndarray) -> np.ndarray:
        """The trie's transition, or -1."""
        keys = states << 21 | points
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.to[slots], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.to[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def step(self, states: np.ndarray, points: np.ndarray) -> np.ndarray:
        """The states after reading ``points``."""
        out = self._child(states, points)
        lost = np.flatnonzero(out < 0)
        at = states[lost]
        while len(lost):
            up = at > 0
            out[lost[~up]] = 0
            lost, at = lost[up], self.back[at[up]]
            found = self._child(at, points[lost])
            out[lost[found >= 0]] = found[found >= 0]
            lost, at = lost[found < 0], at[found < 0]
        return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        pieces = vocabulary.pieces
        self.automaton = Automaton([p for _, p, _ in pieces])
        self.ids = np.array([i for i, _, _ in pieces] or [0], dtype=np.int32)
        self.lengths = np.array([len(p) for _, p, _ in pieces] or [1], dtype=np.int64)
        self.scores = np.array([s for _, _, s in pieces] or [0.0])
        self.byte_score = min((s for _, _, s in pieces), default=0.0) - 1.0
        self.splits = not any(re.search(r"[^ ] ", p) for _, p, _ in pieces)
        self.kept: dict[str, bytes] = {}
        self.raw = [b"\xef\xbf\xbd"] * vocabulary.size
        for i, piece, _ in pieces:
            self.raw[i] = piece.encode()
        for byte, i in enumerate(vocabulary.bytes_ or ()):
            self.raw[i] = bytes([byte])

    def best(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of the best path through each stretch after a blank, as 32-bit numbers; all are read side by side."""
        stretches = sorted(stretches, key=len, reverse=True)
        length = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches)) + 1
        points = np.frombuffer((" " + " ".join(stretches)).encode("utf-32-le", "surrogatepass"),
                               dtype=np.uint32).astype(np.int64)
        start = np.cumsum(length) - length
        # By place in the text: the score of the best path that ends there, and its last piece.
        score = np.zeros(len(points))
        piece = np.full(len(points), -1, dtype=np.int32)
        width = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
        state = np.zeros(len(stretches), dtype=np.int64)
        for t in range(int(length[0])):
            live = int(np.searchsorted(-length, -t, side="left"))  # stretches longer than t
            at = start[:live] + t
            state = self.automaton.step(state[:live], points[at])
            top, last = np.full(live, -np.inf), np.full(live, -1, dtype=np.int32)
            many, whole = self.automaton.many[state], False
            for k in range(int(many.max())):  # one more output link at a time
                rows = np.flatnonzero(many > k)
                entry = self.automaton.ends[state[rows], k]
                n = self.lengths[entry]
                s = np.where(n > t, 0.0, score[np.maximum(at[rows] - n, 0)]) + self.scores[entry]
                better = s > top[rows]
                top[rows[better]], last[rows[better]] = s[better], entry[better]
            # A character that is no piece of its own may be spelled in bytes.
            shortest = self.automaton.ends[state, np.maximum(many - 1, 0)]
            strange = np.flatnonzero((many == 0) | (self.lengths[shortest] > 1))
            if len(strange):
                s = (score[at[strange] - 1] if t else 0.0) + self.byte_score * width[at[strange]]
                better = s > top[strange]
                top[strange] = np.where(better, s, top[strange])
                last[strange[better]] = -1
            score[at], piece[at] = top, last
        # Back from the ends: the places at which a piece of the best path ends.
        used = np.zeros(len(points), dtype=bool)
        at, first = start + length - 1, start
        while len(at):
            used[at] = True
            entry = piece[at]
            at = at - np.where(entry >= 0, self.lengths[entry], 1)
            go = at >= first
            at, first = at[go], first[go]
        places = np.flatnonzero(used)
        ids = self.ids[piece[places]]
        spelled = np.flatnonzero(piece[places] < 0)
        times = np.ones(len(places), dtype=np.int64)
        if len(spelled):
            bytes_ = self.vocabulary.bytes_
            texts = [chr(points[p]).encode("utf-8", "replace") for p in places[spelled].tolist()]
            if bytes_:
                times[spelled] = [len(t) for t in texts]
            ids = np.repeat(ids, times)
            where = (np.cumsum(times) - times)[spelled]
            if bytes_:
                flat = np.concatenate([np.arange(w, w + len(t)) for w, t in zip(where.tolist(), texts)])
                ids[flat] = [bytes_[b] for t in texts for b in t]
            else:
                ids[where] = self.vocabulary.unknown
        end = np.zeros(len(stretches), dtype=np.int64)
        np.add.at(end, np.searchsorted(start, places, side="right") - 1, times)
        cut = [0, *(np.cumsum(end) * 4).tolist()]
        packed = ids.astype("<i4").tobytes()
        return {s: packed[a:b] for s, a, b in zip(stretches, cut, cut[1:])}

    def stretches(self, text: str) -> list[str]:
        """What follows each blank of ``text`` after its first one is put before it; blanks in a row stay together."""
        if not text:
            return []
        if not self.splits:
            return [text]
        parts = text.split(" ")
        return [s[1:] for s in _STRETCH.findall(" " + text)] if "" in parts else parts

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; a stretch that several of them hold is read once, short ones of earlier batches not again."""
        split = [self.stretches(t) for t in texts]
        known: dict[str, bytes] = {}
        some: list[str] = []
        size = 0
        for stretch in set().union(*split):
            ids = self.kept.get(stretch)
            if ids is not None:
                known[stretch] = ids
                continue
            some.append(stretch)
            size += len(stretch)
            if size >= PIECE:
                known.update(self.best(some))
                some, size = [], 0
        if some:
            known.update(self.best(some))
        if len(self.kept) + len(known) > KEPT:
            self.kept.clear()  # those of this batch stay, as far as there is room
        self.kept.update(itertools.islice(((s, i) for s, i in known.items() if len(s) <= LONGEST), KEPT))
        return [np.frombuffer(b"".join(map(known.__getitem__, s)), dtype="<i4") for s in split]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Shared:
    """A vocabulary as it is broadcast. Its codec is made once in each process and goes with it, so that a worker that
    turns to other work does not keep it."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary}

    @functools.cached_property
    def codec(self) -> Codec:
        return Codec(self.vocabulary)


def encode(spark: SparkSession, vocabulary: Vocabulary, text: Column) -> Column:
    """A column of piece ids, array<int>."""
    shared = ship(spark).sparkContext.broadcast(Shared(vocabulary))

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        own = shared.value.codec
        plain = texts.to_pylist()
        rows = [None if t is None else ids for t, ids in zip(plain, own.encode_all([t or "" for t in plain]))]
        ends = np.cumsum([0] + [0 if r is None else len(r) for r in rows]).astype(np.int32)
        flat = np.concatenate([r for r in rows if r is not None] or [np.zeros(0, np.int32)])
        missing = pa.array([r is None for r in rows], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=missing)

    return ids(text)


def decode(spark: SparkSession, vocabulary: Vocabulary, ids: Column) -> Column:
    """The text of a column of piece ids."""
    shared = ship(spark).sparkContext.broadcast(Shared(vocabulary))

    @F.arrow_udf("string")
    def texts(rows: pa.Array) -> pa.Array:
        own = shared.value.codec
        return pa.array([None if not r.is_valid else own.decode(r.values.to_numpy().tolist()) for r in rows], pa.string())

    return texts(ids)
