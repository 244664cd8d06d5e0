"""Language identification by bit-sliced Bloom filters over character n-grams.

One filter serves all languages: each of its positions holds a bitmask with a bit per
language, in as many machine words as their number needs, so that the conjunction of an n-gram's positions is the mask of all languages
that contain it, in as many reads as there are hash functions. A language contains an
n-gram if its rate there is at least ``RIVAL`` of the highest rate in any language. A
document's popcounts per language, less the false positives that the filter's filling
makes certain on average, decide.

Fitting reads the labels, lengths and hashes of all labelled texts, and the n-grams of a
sample bounded by ``sample_chars`` per language: stretches of ``STRETCH`` characters of the
distinct texts, drawn by a hash of text and offset, at a rate of ``sample_chars`` by the
language's distinct characters. So a language reaches its sample however long its texts are,
and one that is smaller than that is read whole. The driver holds the n-grams of the samples,
at most ``sample_chars`` a language, and the masks: positions x languages bits.

Defined results: text that is null or without letters is ``und`` with score 0; so is all
text if nothing was learned. Ties go to the language first in code points. Documents
without a label or text are not learned from; repeated texts count once. Texts of any length
are read whole in a prediction, in pieces of ``PIECE`` characters. Any number of languages
may occur. An empty table teaches nothing; other columns are not read. The score
is the corrected share of the document's n-grams that the language contains.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.arrays import mix
from filmgrain.llm.shipping import ship

N = 4
#: Characters per language that the filter is fitted on, about.
SAMPLE_CHARS = 2_000_000
STRETCH = 10_000
RIVAL = 0.1
LOG2_POSITIONS = 21
HASHES = 2
PIECE = 1 << 20
UNKNOWN = "und"

_ODD = np.random.default_rng(11).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER: np.ndarray | None = None


def _letters(points: np.ndarray) -> np.ndarray:
    """Letters and the marks that belong to them."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.array([unicodedata.category(chr(i))[0] in "LM" for i in range(0x10000)])
    out = _LETTER[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        out[i] = unicodedata.category(chr(points[i]))[0] in "LM"
    return out


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of ``text``: lower case, all between words one blank, padded."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters(points)
    if not letter.any():
        return
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.where(letter, points, 32)[keep]
    points = np.concatenate([[32, 32], points, [32, 32]]).astype(np.uint64)
    for at in range(0, len(points) - N + 1, PIECE):
        part = points[at:at + PIECE + N - 1]
        n = len(part) - N + 1
        total = part[:n] * _ODD[0]
        for j in range(1, N):
            total += part[j:j + n] * _ODD[j]
        yield total ^ (total >> np.uint64(29))


def positions(gram: np.ndarray) -> Iterator[np.ndarray]:
    for j in range(HASHES):
        yield (mix(gram * _ODD[N + j]) >> np.uint64(64 - LOG2_POSITIONS)).astype(np.int64)


@dataclass(frozen=True)
class Filter:
    """Languages, the masks of all positions (positions x words), and the filled share per language."""

    languages: tuple[str, ...]
    masks: np.ndarray
    filled: np.ndarray

    @property
    def word(self) -> int:
        """Languages in one word of a mask."""
        return 8 * self.masks.itemsize

    def masks_of(self, gram: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram, false positives included."""
        first, *rest = (self.masks[p] for p in positions(gram))
        for more in rest:
            first = first & more
        return first

    def decide(self, text: str | None) -> tuple[str, float]:
        total, found = 0, np.zeros(len(self.languages))
        for gram in grams(text or ""):
            mask = self.masks_of(gram)
            total += len(gram)
            for i in range(len(found)):
                found[i] += np.count_nonzero(mask[:, i // self.word] & _bit(self.masks, i))
        if not total or not len(found):
            return UNKNOWN, 0.0
        false = self.filled ** HASHES
        share = np.clip((found / total - false) / np.maximum(1 - false, 1e-9), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def _bit(masks: np.ndarray, language: int) -> np.unsignedinteger:
    return masks.dtype.type(1 << language % (8 * masks.itemsize))


def build(languages: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray) -> Filter:
    """A filter from n-gram counts; ``lang`` holds indices into ``languages``."""
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    width = 8 * np.dtype(kind).itemsize
    masks = np.zeros((1 << LOG2_POSITIONS, max(1, -(-len(languages) // width))), dtype=kind)
    totals = np.bincount(lang, weights=count, minlength=len(languages))
    keys, where = np.unique(gram, return_inverse=True)
    rate = count / np.maximum(totals, 1)[lang]
    top = np.zeros(len(keys))
    np.maximum.at(top, where, rate)
    own = rate >= RIVAL * top[where]
    for p in positions(gram[own]):
        np.bitwise_or.at(masks, (p, lang[own] // width), kind(1) << (lang[own] % width).astype(kind))
    filled = np.array([np.count_nonzero(masks[:, i // width] & _bit(masks, i)) for i in range(len(languages))]) / len(masks)
    return Filter(tuple(languages), masks, filled)


def fit(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang",
        sample_chars: int = SAMPLE_CHARS) -> Filter:
    """Learn the filter from rows whose label and text are not null."""
    spark = ship(labelled.sparkSession)
    rows = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL").withColumn("key", F.xxhash64("text"))
    once = rows.groupBy("lang", "key").agg(F.max(F.char_length("text")).alias("n"))
    sizes = {r.lang: r.n for r in once.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(sizes)  # Python compares strings by code point
    if not languages:
        return build([], np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0))
    rates = spark.createDataFrame(
        [(name, i, min(1.0, sample_chars / max(sizes[name], 1))) for i, name in enumerate(languages)],
        "lang string, nth int, rate double")
    draw = F.shiftrightunsigned(F.xxhash64("key", "at"), 11) / float(1 << 53)
    last = F.expr(f"(char_length(text) - 1) div {STRETCH}")
    cut = rows.join(F.broadcast(rates), "lang").filter("text != ''").withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    sample = cut.filter(draw < F.col("rate")).select(
        "nth", "key", "at", F.substring("text", F.col("at") * STRETCH + 1, F.lit(STRETCH)).alias("text"),
    ).dropDuplicates(["nth", "key", "at"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth, text in zip(batch.column("nth").to_pylist(), batch.column("text").to_pylist()):
                for gram in grams(text):
                    keys, n = np.unique(gram, return_counts=True)
                    yield pa.record_batch({
                        "nth": np.full(len(keys), nth, np.int32), "gram": keys.view(np.int64), "n": n.astype(np.int64)})

    counted = sample.mapInArrow(count, "nth int, gram long, n long").groupBy("nth", "gram").agg(
        F.sum("n").alias("n")).toArrow()
    lang, gram, n = (counted[c].to_numpy() for c in ("nth", "gram", "n"))
    return build(languages, lang.astype(np.int64), gram.view(np.uint64), n.astype(float))


def predict(spark: SparkSession, model: Filter, text: Column) -> Column:
    """A column struct<lang, score>. The filter is broadcast; its size is a parameter."""
    shared = ship(spark).sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def decide(texts: pa.Array) -> pa.Array:
        found = [shared.value.decide(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang", "score"])

    return decide(text)
