"""Personal data by patterns and a linear-chain conditional random field.

The patterns find e-mail addresses, IP addresses, card numbers and international phone
numbers exactly. The field finds what is written around them: local phone numbers,
masked addresses, cards in other groupings. Its features are the shapes of a word and
its neighbours (letters and marks as runs, every digit counted), its weights are trained
on a small labelled table, and it decodes whole texts by Viterbi over numpy batches of
sentences. What it proposes must pass the check of its kind and never touches a span of
the patterns.

Defined results: a null text has no spans; offsets are code points, end exclusive; spans
are ordered by kind as in ``KINDS``, then start; a text of any length is one input, its
sentences are decoded in full; an empty labelled table adds no spans.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.arrays import Powers, mix
from filmgrain.llm.shipping import ship

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
#: Characters decoded together.
PIECE = 1 << 18
#: Rows of a labelled table that are read, at most; a larger one is an error.
MOST_LABELLED = 200_000

# --- the patterns -------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive: a digit run that fails is not tried again from its middle.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _octets(parts) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, in time linear in the text."""
    free, at = 0, text.find("@")  # before `free`, characters belong to a match or to an earlier @
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four patterns, by kind, then start."""
    out = [("email", *s) for s in emails(text)]
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _octets(m.groups())]
        for m in _CARD.finditer(text):
            number = _digits(m[0]) if m.end() - m.start() <= 38 else ""  # 19 digits, 18 separators
            if 16 <= len(number) <= 19 and luhn(number):
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# --- checks of what the field proposes ------------------------------------------------

_MASKED = re.compile(r"[\w.%+-]+\s?[\[({]\s?at\s?[\])}]\s?[\w-]+(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\.)[\w-]+)+", re.I)
_MASKED_IP = re.compile(r"([0-9]+)(?:\[\.\]|\(\.\)|\.)([0-9]+)(?:\[\.\]|\(\.\)|\.)([0-9]+)(?:\[\.\]|\(\.\)|\.)([0-9]+)")
_GROUPED = re.compile(r"[0-9]{4}([. -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([. -])[0-9]{6}\2[0-9]{5}")
_LOCAL_PHONE = re.compile(r"(?:1[-. ])?(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}")
_PATTERNS = {"email": _MASKED, "ip": _MASKED_IP, "card": _GROUPED, "phone": _LOCAL_PHONE}
_NUMBER = re.compile(r"[^0-9]?[0-9]++")


def _accepted(kind: str, piece: str, free: Callable[[int, int], bool] = lambda a, b: True) -> Iterator[tuple[int, int]]:
    """All parts of a proposed piece that pass the check of their kind and are ``free``, from the left.

    Each match is checked by itself. After a card or phone that fails, the search goes on
    behind its first number, so that it hides none that begins inside it.
    """
    at = 0
    while m := _PATTERNS[kind].search(piece, at):
        begin, end = m.span()
        # a longer number is something else
        edges = piece[max(0, begin - 1):begin] + piece[end:end + 1]
        if (kind == "ip" and not _octets(m.groups())) or (kind == "card" and not luhn(_digits(m[0]))) or (
                kind != "email" and any(c.isalnum() for c in edges)) or not free(begin, end):
            at = _NUMBER.match(piece, begin).end() if kind in ("card", "phone") else end
        else:
            yield begin, end
            at = end


# --- shapes ---------------------------------------------------------------------------

_CODES = np.full(128, 9, dtype=np.uint8)
_CODES[[0x20, *range(0x09, 0x0E)]] = 0
_CODES[ord("a"):ord("z") + 1] = 1
_CODES[ord("A"):ord("Z") + 1] = 2
_CODES[ord("0"):ord("9") + 1] = 3
for _i, _c in enumerate(".,@-_()[]:+/#$%\"'=&*!?;{}<>"):
    _CODES[ord(_c)] = 10 + _i
_VALUE = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = Powers()
_STOPS = np.array([ord(c) for c in ".!?"], dtype=np.uint32)
#: What follows a word and is no part of its shape, and what may stand before it.
_AFTER = np.array([ord(c) for c in ".,;:!?\"'"], dtype=np.uint32)
_BEFORE = np.array([ord(c) for c in "\"'"], dtype=np.uint32)
#: Brackets around a word, or on one side of it; an area code in brackets, of up to so many characters, keeps them.
_BRACKETS, _AREA = ((ord("("), ord(")")), (ord("["), ord("]"))), 5
#: Marks after a word that are looked through, at most.
_MARKS = 3


@dataclass
class Sentences:
    """Words of a text: bounds, shape hashes, and the sentences they form."""

    starts: np.ndarray
    ends: np.ndarray
    shapes: np.ndarray
    first: np.ndarray  # word that opens each sentence
    length: np.ndarray


def sentences(text: str) -> Sentences:
    """A sentence ends at a line break or after a word ending in a stop.

    Quotes and brackets around a word and stops and commas behind it are not part of its
    shape, so that a value has one shape wherever it stands in a sentence.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.where(points < 128, _CODES[np.minimum(points, 127)], 1).astype(np.uint8)
    inside = np.zeros(len(code) + 2, dtype=np.int8)
    inside[1:-1] = code != 0
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return Sentences(none, none, none.astype(np.uint64), none, none)
    keep = np.ones(len(code), dtype=bool)  # runs count once, but each digit counts
    keep[1:] = (code[1:] != code[:-1]) | (code[1:] == 3)
    keep &= code != 0
    last = ends - 1
    for _ in range(_MARKS):
        mark = (last > starts) & np.isin(points[last], _AFTER)
        keep[last[mark]] = False
        last = last - mark
    follows = code[np.minimum(starts + 1, ends - 1)]
    follows = (follows >= 1) & (follows <= 3) & (last > starts)
    keep[starts[np.isin(points[starts], _BEFORE) & follows]] = False
    for left, right in _BRACKETS:
        opened, closed = (np.concatenate([[0], np.cumsum(points == p)]) for p in (left, right))
        opened, closed = opened[ends] - opened[starts], closed[ends] - closed[starts]
        around = (points[starts] == left) & (points[last] == right) & (last - starts > _AREA)
        keep[last[(points[last] == right) & (last > starts) & (around | (opened == 0))]] = False
        keep[starts[(points[starts] == left) & follows & (around | (closed == 0))]] = False
    upto = np.cumsum(keep)
    begin = upto[starts] - keep[starts]
    place = np.arange(int(upto[-1])) - np.repeat(begin, np.diff(begin, append=upto[-1]))
    terms = _VALUE[code[keep]] * _POWERS.upto(int(place.max()) + 1)[place]
    shapes = mix(np.add.reduceat(terms, begin))
    line = np.cumsum(points == 10)[starts]
    close = np.isin(points[ends - 1], _STOPS)
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = close[:-1] | (line[1:] != line[:-1])
    first = np.flatnonzero(opens)
    return Sentences(starts, ends, shapes, first, np.diff(first, append=len(starts)))


# --- the field ------------------------------------------------------------------------

@dataclass(frozen=True)
class Field:
    """Known shapes (sorted) and weights: emission by own, previous and next shape; transitions."""

    shapes: np.ndarray
    emit: np.ndarray  # (3, shapes + 2, labels); row 0: any other shape, last: no word
    move: np.ndarray  # (labels, labels)
    open: np.ndarray  # (labels,)

    def ids(self, shapes: np.ndarray) -> np.ndarray:
        if not len(self.shapes):
            return np.zeros(len(shapes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.shapes, shapes), len(self.shapes) - 1)
        return np.where(self.shapes[at] == shapes, at + 1, 0)

    def neighbours(self, s: Sentences) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own, none = self.ids(s.shapes), len(self.shapes) + 1
        before, after = np.roll(own, 1), np.roll(own, -1)
        before[s.first] = none
        after[s.first + s.length - 1] = none
        return own, before, after

    def decode(self, s: Sentences) -> np.ndarray:
        """The best label of every word, by Viterbi over all sentences at once."""
        labels = np.zeros(len(s.starts), dtype=np.int8)
        if not len(labels):
            return labels
        own, before, after = self.neighbours(s)
        k = len(LABELS)
        emit = (self.emit[0][own] + self.emit[1][before] + self.emit[2][after]).T.copy()  # (labels, words)
        order = np.argsort(-s.length, kind="stable")
        first, length = s.first[order], s.length[order]
        back = np.zeros((k, len(labels)), dtype=np.int8)
        live = len(first)
        score = emit[:, first] + self.open[:, None]
        last = score.copy()  # each sentence's scores at its end
        for t in range(1, int(length[0])):
            live = int(np.searchsorted(-length, -t, side="left"))  # sentences longer than t
            at = first[:live] + t
            new = np.empty((k, live), dtype=score.dtype)
            for j in range(k):
                best, arg = score[0, :live] + self.move[0, j], np.zeros(live, dtype=np.int8)
                for i in range(1, k):
                    other = score[i, :live] + self.move[i, j]
                    arg[other > best] = i
                    np.maximum(best, other, out=best)
                new[j] = best + emit[j, at]
                back[j, at] = arg
            score = new
            last[:, :live] = new
        label = last.argmax(axis=0).astype(np.int8)
        for t in range(int(length[0]) - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, side="left"))
            at = first[:live] + t
            labels[at] = label[:live]
            label[:live] = back[label[:live], at]
        return labels

    def spans(self, text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Checked spans that the field adds to the ``known`` ones."""
        s = sentences(text)
        return _merge(text, s, self.decode(s), known)


def _merge(text, s, labels, known) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    hit = np.flatnonzero(labels)
    if not len(hit):
        return out
    taken = _union([(*k, True) for k in known])  # disjoint, ascending
    starts = [a for a, _, _ in taken]

    def free(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return not before or taken[before - 1][1] <= a

    opens = np.zeros(len(labels), dtype=bool)
    opens[s.first] = True
    cut = np.flatnonzero((np.diff(hit) > 1) | (labels[hit[1:]] != labels[hit[:-1]]) | opens[hit[1:]]) + 1
    for run in np.split(hit, cut):
        begin, end = int(s.starts[run[0]]), int(s.ends[run[-1]])
        kind = LABELS[labels[run[0]]]
        for a, b in _accepted(kind, text[begin:end], lambda a, b: free(begin + a, begin + b)):
            out.append((kind, begin + a, begin + b))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def train(rows: list[tuple[int, int, str, str]], turns: int = 200, rate: float = 0.2, penalty: float = 1e-3) -> Field:
    """Maximum likelihood from (sentence, position, word, label), by full-batch Adam; deterministic."""
    by: dict[int, list] = {}
    for sentence, position, word, label in rows:
        by.setdefault(sentence, []).append((position, word, label))
    seqs = [sorted(v) for _, v in sorted(by.items())]
    k = len(LABELS)
    if not seqs:
        return Field(np.zeros(0, np.uint64), np.zeros((3, 2, k), np.float32), np.zeros((k, k), np.float32),
                     np.zeros(k, np.float32))
    text = " ".join(w for seq in seqs for _, w, _ in seq)
    s = sentences(text)
    length = np.array([len(seq) for seq in seqs])
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    s = Sentences(s.starts, s.ends, s.shapes, first, length)
    gold = np.array([LABELS.index(x) for seq in seqs for _, _, x in seq])
    vocabulary = np.unique(s.shapes)
    ids = Field(vocabulary, np.zeros(0), np.zeros(0), np.zeros(0)).neighbours(s)
    shapes, top = (3, len(vocabulary) + 2, k), int(length.max())
    w = [np.zeros(shapes), np.zeros((k, k)), np.zeros(k)]
    mean, var = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    order = np.argsort(-length, kind="stable")
    begin, long_ = first[order], length[order]
    live = [int((long_ > t).sum()) for t in range(top)]
    log = lambda x, axis: np.log(np.exp(x - (m := x.max(axis, keepdims=True))).sum(axis)) + m.squeeze(axis)
    pair = np.ones(len(gold), dtype=bool)
    pair[first] = False
    for turn in range(1, turns + 1):
        emit = w[0][0][ids[0]] + w[0][1][ids[1]] + w[0][2][ids[2]]
        ahead, behind = np.zeros((len(gold), k)), np.zeros((len(gold), k))
        ahead[begin] = emit[begin] + w[2]
        for t in range(1, top):
            at = begin[:live[t]] + t
            ahead[at] = emit[at] + log(ahead[at - 1][:, :, None] + w[1][None], 1)
        for t in range(top - 1, 0, -1):
            at = begin[:live[t]] + t
            behind[at - 1] = log(w[1][None] + (emit[at] + behind[at])[:, None, :], 2)
        norm = np.empty(len(gold))
        norm[:] = np.repeat(log(ahead[first + length - 1], 1), length)
        prob = np.exp(ahead + behind - norm[:, None])
        at = np.flatnonzero(pair)
        joint = np.exp(ahead[at - 1][:, :, None] + w[1][None] + (emit[at] + behind[at])[:, None, :] - norm[at, None, None])
        wrong = prob.copy()
        wrong[np.arange(len(gold)), gold] -= 1
        grad = [np.zeros(shapes), joint.sum(0), wrong[first].sum(0)]
        for g in range(3):
            np.add.at(grad[0][g], ids[g], wrong)
        np.add.at(grad[1], (gold[at - 1], gold[at]), -1)
        for i in range(3):
            d = grad[i] / len(seqs) + penalty * w[i]
            mean[i] = 0.9 * mean[i] + 0.1 * d
            var[i] = 0.999 * var[i] + 0.001 * d * d
            w[i] = w[i] - rate * (mean[i] / (1 - 0.9**turn)) / (np.sqrt(var[i] / (1 - 0.999**turn)) + 1e-8)
    return Field(vocabulary, *(x.astype(np.float32) for x in w))


def fit(labelled: DataFrame) -> Field:
    """Train on a labelled table (sentence long, position int, word string, label string)."""
    rows = [tuple(r) for r in labelled.select("sentence", "position", "word", "label").limit(MOST_LABELLED + 1).collect()]
    if len(rows) > MOST_LABELLED:
        raise ValueError(f"the labelled table has more than {MOST_LABELLED} rows")
    return train(rows)


def labelled_table(spark: SparkSession, sentences_: int = 1800, seed: int = 3) -> DataFrame:
    """A small labelled table from rules: fillers around values of each kind, and look-alikes.

    Values stand inside and at the end of sentences, bare, in brackets and in quotes; octets
    come in every combination of lengths.
    """
    rng = np.random.default_rng(seed)
    pick = lambda *a: a[rng.integers(len(a))]
    num = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    word = lambda: "".join(rng.choice(list("aeiorstnlm"), rng.integers(2, 9)))
    octets = itertools.cycle(itertools.product((1, 2, 3), repeat=4))
    octet = lambda n: str(rng.integers((0, 10, 100)[n - 1], (10, 100, 256)[n - 1]))
    sides = lambda: pick(("", ""), ("", ""), ("", ""), ("", ""), ("", ""), ("(", ")"), ("[", "]"), ('"', '"'))

    def card(groups, sep):
        body = pick("4", "5", "37") if groups[0] == 4 else "4"
        body += num(sum(groups) - len(body) - 1)
        body += next(str(d) for d in range(10) if luhn(body + str(d)))
        parts, at = [], 0
        for g in groups:
            parts.append(body[at:at + g])
            at += g
        return sep.join(parts)

    def value(kind):
        if kind == "email":
            at, dot = pick(("[at]", "[dot]"), ("(at)", "(dot)"), ("{at}", "{dot}"))
            gap = pick("", " ")
            return pick(f"{word()}{gap}{at}{gap}{word()}{gap}{dot}{gap}{word()}", f"{word()}@{word()}.{word()}",
                        f"{word()}.{word()}@{word()}.{word()}", f"{word()}{at}{word()}.{word()}")
        if kind == "ip":
            return pick(".", "[.]", "(.)").join(octet(n) for n in next(octets))
        if kind == "card":
            return card(*pick(((4, 4, 4, 4), " "), ((4, 4, 4, 4), "-"), ((4, 4, 4, 4), "."),
                              ((4, 6, 5), " "), ((4, 6, 5), "-")))
        a, b, c = num(3), num(3), num(4)
        return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"({a}){b}-{c}", f"+1 ({a}) {b}-{c}")

    def other():
        return pick(f"20{num(2)}-{num(2)}-{num(2)}", f"{num(2)}.{num(2)}.20{num(2)}", f"{num(1)}.{num(1)}.{num(1)}",
                    f"${num(1)},{num(3)}.{num(2)}", f"#{num(5)}", f"{num(2)}:{num(2)}", num(int(rng.integers(1, 20))),
                    f"{num(3)}-{num(4)}", f'"{num(3)}{word()}{num(5)}"', f"({word()})", f"[{word()}]", f"{num(4)}-{num(4)}",
                    f"{num(3)}/{num(3)}", f"{num(2)}%", f"{num(3)}", f"({num(3)})", f"{num(4)}")

    out = []
    for i in range(sentences_):
        at = 0

        def add(text, label, i=i):
            nonlocal at
            for w in text.split(" "):
                out.append((i, at, w, label))
                at += 1

        plain = lambda: pick(word(), word(), word(), word().capitalize(), word() + ",", word().upper())
        for _ in range(rng.integers(0, 5)):
            add(plain(), "O")
        for _ in range(rng.integers(0, 3)):
            if rng.random() < 0.6:
                kind = pick(*KINDS, "ip")
                left, right = sides()
                for more in range(pick(0, 0, 0, 1, 2), -1, -1):  # a list now and then
                    add(left + value(kind) + right + (pick("", ",") if more else pick("", "", ",", ";", ":")), kind)
            else:
                add(other() + pick("", "", ",", ";"), "O")
            for _ in range(rng.integers(1, 4)):
                add(plain(), "O")
        if rng.random() < 0.5:  # a value or a look-alike at the end
            kind = pick(*KINDS, "ip", "O", "O")
            left, right = sides()
            add((other() if kind == "O" else left + value(kind) + right) + pick("", ".", "!", "?"), kind)
        else:
            add(plain() + pick("", ".", "!", "?"), "O")
    return spark.createDataFrame(out, "sentence long, position int, word string, label string")


# --- columns --------------------------------------------------------------------------

def _batches(texts: list[str | None]) -> Iterator[list[int]]:
    """Indices of texts decoded together, about PIECE characters at a time."""
    some, size = [], 0
    for i, t in enumerate(texts):
        if t:
            some.append(i)
            size += len(t)
            if size >= PIECE:
                yield some
                some, size = [], 0
    if some:
        yield some


def find_all(texts: list[str | None], field: Field) -> list[list[tuple[str, int, int, bool]]]:
    out: list[list] = [[] for _ in texts]
    for some in _batches(texts):
        s = sentences("\n".join(texts[i] for i in some))  # a line break ends a sentence
        labels, at, word = field.decode(s), 0, 0
        for i in some:
            text = texts[i]
            upto = int(np.searchsorted(s.starts, at + len(text)))
            known = base_spans(text)
            added = []
            if labels[word:upto].any():
                inner = (s.first >= word) & (s.first < upto)
                own = Sentences(s.starts[word:upto] - at, s.ends[word:upto] - at, s.shapes[word:upto],
                                s.first[inner] - word, s.length[inner])
                added = _merge(text, own, labels[word:upto], known)
            spans = [(*x, True) for x in known] + [(*x, False) for x in added]
            out[i] = sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))
            at, word = at + len(text) + 1, upto
    return out


def find(spark: SparkSession, field: Field, text: Column) -> Column:
    """A column of all spans of a text."""
    shared = ship(spark).sparkContext.broadcast(field)  # some hundred shapes
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        found = find_all(texts.to_pylist(), shared.value)
        return pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in row] for row in found], kind)

    return spans(text)


def redact(spark: SparkSession, field: Field, text: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans, their union."""
    shared = ship(spark).sparkContext.broadcast(field)

    @F.arrow_udf("string")
    def hidden(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        for i, spans in enumerate(find_all(rows, shared.value)):
            if spans:
                out, at = [], 0
                for begin, end, name in _union(spans):
                    out += [rows[i][at:begin], f"<{name}>"]
                    at = end
                rows[i] = "".join(out) + rows[i][at:]
        return pa.array(rows, pa.string())

    return hidden(text)


def _union(spans) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for kind, begin, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), out[-1][2])
        else:
            out.append((begin, end, kind))
    return out
