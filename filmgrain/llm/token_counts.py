"""Token counts under a byte-level BPE vocabulary, merged rank by rank in ragged numpy arrays.

A text is cut at the special tokens of the vocabulary and then into pre-tokens. The distinct
pre-tokens of a batch lie one after another in one array of symbols. Every round finds each
sequence's lowest-ranked pair of neighbours and merges all its places at once, from the
left where they overlap, so that all sequences advance side by side; a sequence without a
ranked pair is finished, and what is left of it are its tokens. No round looks ranks up
again but beside the places it merged.

Each merge of the vocabulary makes a symbol of its own, so that a pair that holds a merged
symbol always ranks after the pair that made it, and merging by rank gives the same tokens
as merging one place at a time; a vocabulary of another kind is refused.

Defined results: a null text counts as an empty one, which has no tokens; a special token's
string inside a text is one token; texts of any length are read whole, in stretches that end
where no pre-token can cross (a blank after something else); repeated rows are rows of their
own; an empty table gives an empty result; other columns are not read. A pre-token without
end (a text without blanks and of one kind of character) costs one round for each rank that
it holds, over as many symbols as are left.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.shipping import ship

#: The pre-token pattern of byte-level BPE (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters read at once.
STRETCH = 1 << 18
#: Symbols merged side by side.
SYMBOLS = 1 << 20
#: Counts a worker remembers, and the longest pre-token among them.
REMEMBERED, LONGEST = 1 << 18, 64
_NONE = np.iinfo(np.int32).max


@dataclass(frozen=True)
class Vocabulary:
    """Symbols of the 256 bytes, the merges (left, right) -> result by rank, special strings."""

    of_byte: tuple[int, ...]
    merges: tuple[tuple[int, int, int], ...]
    special: tuple[str, ...]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def read_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library on the driver; it travels by broadcast."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, before = told["model"], told["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or told["normalizer"]:
        raise ValueError("not a plain byte-level BPE vocabulary")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]) or model.get("ignore_merges"):
        raise ValueError("special tokens that take their surroundings, or merges that are passed over, are not counted")
    ids = model["vocab"]
    merges = tuple((ids[a], ids[b], ids[a + b]) for a, b in model["merges"])
    made: set[int] = set()
    for a, b, to in merges:
        if to in made:
            raise ValueError("two merges make the same symbol")
        made.add(to)
    letters = byte_letters()
    return Vocabulary(tuple(ids[c] for c in letters), merges, tuple(t["content"] for t in told["added_tokens"]))


class Counter:
    """Counts tokens under one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.of_byte = np.array(vocabulary.of_byte, dtype=np.int64)
        table = np.array(vocabulary.merges, dtype=np.int64).reshape(-1, 3)
        self.base = int(max(self.of_byte.max(), table.max(initial=0))) + 1
        keys = table[:, 0] * self.base + table[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = table[:, 2]
        words = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, words))) if words else None
        self.known: dict[str, int] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE) if len(self.keys) else np.full(len(key), _NONE, np.int32)

    def merged(self, texts: list[bytes]) -> np.ndarray:
        """The symbols left of each sequence of bytes, none of which is empty."""
        out = np.zeros(len(texts), dtype=np.int64)
        length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        symbol = self.of_byte[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        name = np.arange(len(texts))  # of the sequences that are not finished
        last = np.cumsum(length) - 1
        rank = np.full(len(symbol), _NONE, dtype=np.int32)  # of the pair that starts here
        rank[:-1] = self._ranks(symbol[:-1], symbol[1:])
        rank[last] = _NONE
        while len(name):
            first = last - length + 1
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == _NONE
            if done.any():
                out[name[done]] = length[done]
                stay = np.repeat(~done, length)
                symbol, rank = symbol[stay], rank[stay]
                name, length, lowest = name[~done], length[~done], lowest[~done]
                last = np.cumsum(length) - 1
                if not len(name):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, length))
            # Of places that overlap (a run of one symbol) every other one is merged, from the left.
            new_run = np.diff(at, prepend=-2) != 1
            start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
            symbol[at] = self.made[rank[at]]
            rank[at] = _NONE
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            owner = np.searchsorted(last, at)
            length = length - np.bincount(owner, minlength=len(length))
            symbol, rank = symbol[stay], rank[stay]
            at = at - np.arange(len(at))  # where the merged symbols lie now
            last = np.cumsum(length) - 1
            touched = np.concatenate([at, at - 1])
            touched = touched[touched >= 0]
            inside = np.ones(len(symbol), dtype=bool)
            inside[last] = False
            touched = touched[inside[touched]]
            rank[touched] = self._ranks(symbol[touched], symbol[touched + 1])
            rank[last] = _NONE
        return out

    def learn(self, words: set[str]) -> dict[str, int]:
        """Tokens of each of ``words``."""
        out, some, size = {}, [], 0

        def flush() -> None:
            nonlocal some, size
            if some:
                out.update(zip(some, self.merged([w.encode("utf-8", "replace") for w in some]).tolist()))
            some, size = [], 0

        for word in words:
            some.append(word)
            size += 4 * len(word)
            if size >= SYMBOLS:
                flush()
        flush()
        return out

    def stretches(self, text: str) -> Iterator[str | None]:
        """Parts of ``text`` that can be cut into pre-tokens apart; ``None`` stands for a special token."""
        at = 0
        for hit in self.special.finditer(text) if self.special else ():
            yield from _blocks(text, at, hit.start())
            yield None
            at = hit.end()
        yield from _blocks(text, at, len(text))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        total = [0] * len(texts)
        open_: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in self.stretches(text):
                if part is None:
                    total[i] += 1
                    continue
                open_.append((i, _WORDS.findall(part)))
                size += len(part)
                if size >= STRETCH:
                    self._settle(open_, total)
                    open_, size = [], 0
        self._settle(open_, total)
        return total

    def _settle(self, open_: list[tuple[int, list[str]]], total: list[int]) -> None:
        fresh = set().union(*(words for _, words in open_)).difference(self.known)
        found = self.learn(fresh)
        if len(self.known) + len(found) > REMEMBERED:
            found = self.learn(set().union(*(words for _, words in open_)))
            self.known = {}
        long_ = [w for w in found if len(w) > LONGEST]
        self.known.update(found)
        for i, words in open_:
            total[i] += sum(map(self.known.__getitem__, words))
        for word in long_:
            del self.known[word]


_WORDS = regex.compile(PATTERN)
_EDGE = regex.compile(r"(?<=\S)\s")


def _blocks(text: str, start: int, end: int) -> Iterator[str]:
    """``text[start:end]`` in parts of about ``STRETCH`` characters, cut before white space that follows something else."""
    while end - start > STRETCH:
        edge = _EDGE.search(text, start + STRETCH, end)
        if not edge:
            break
        yield text[start:edge.start()]
        start = edge.start()
    if start < end:
        yield text[start:end]


@functools.lru_cache(maxsize=2)
def counter(vocabulary: Vocabulary) -> Counter:
    """One per process and vocabulary."""
    return Counter(vocabulary)


def count(spark: SparkSession, vocabulary: Vocabulary, text: Column) -> Column:
    """A column of the number of tokens, bigint."""
    shared = ship(spark).sparkContext.broadcast(vocabulary)

    @F.arrow_udf("bigint")
    def tokens(texts: pa.Array) -> pa.Array:
        return pa.array(counter(shared.value).count([t or "" for t in texts.to_pylist()]), pa.int64())

    return tokens(text)
