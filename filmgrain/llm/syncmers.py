"""Document fingerprints from closed syncmers.

A k-mer of code points is chosen if its smallest s-mer (by hash) is its first or its
last. The choice depends on the k-mer alone, so an edit changes only the anchors it
touches, and equal passages have equal anchors wherever they stand. The fingerprint is
all chosen k-mers at all their positions, so it grows with the text: ``position:hash``
joined by commas, in order of position.

Likeness matches anchors by hash, each at most once: first those at the same position,
then those with the same next anchor at the same distance, then the rest, the m-th of a
hash with the m-th. Of the matches, those count that agree in position: whose shift is
nought or is shared by another match. Likeness is their share in the anchors of both
texts together, matched ones once.

Defined results: null and empty texts have an empty fingerprint, like each other (1) and
unlike all else (0); a text without a chosen k-mer is one anchor, its own hash; equal
texts have equal fingerprints and likeness 1; long texts are read piece by piece, whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.arrays import Powers, mix, sliding_min
from filmgrain.llm.packing import packing
from filmgrain.llm.shipping import ship
from filmgrain.workspace import cut

K, S = 20, 8
PIECE = 1 << 20
#: Characters of results that leave a task together, about.
BATCH_CHARS = 1 << 23
_BASE = np.uint64(0xD6E8FEB86659FD93)
_UP = Powers(_BASE)
_DOWN = Powers(np.uint64(pow(int(_BASE), -1, 1 << 64)))
_ODD = np.uint64(0x9FB21C651E98DF25)
_HEX = np.array([list(b"%02x" % i) for i in range(256)], dtype=np.uint8)

#: Positions, ascending, and their hashes of 40 bits.
Anchors = tuple[np.ndarray, np.ndarray]


def anchors(text: str) -> Anchors:
    """Positions and hashes of all closed syncmers of ``text``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    where, what = [], []
    for at in range(0, max(len(points) - K + 1, 0), PIECE):
        part = points[at:at + PIECE + K - 1].astype(np.uint64)
        n = len(part)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((part + np.uint64(1)) * _UP.upto(n), out=sums[1:])
        down = _DOWN.upto(n)
        small = mix((sums[S:] - sums[:-S]) * down[:n - S + 1])
        low = sliding_min(small, K - S + 1)
        chosen = np.flatnonzero((small[:len(low)] == low) | (small[K - S:] == low))
        where.append(chosen + at)
        what.append(mix((sums[chosen + K] - sums[chosen]) * down[chosen]))
    if not where:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(where), np.concatenate(what)


def sketch(text: str) -> Anchors:
    """All anchors of the fingerprint."""
    where, what = anchors(text)
    if text and not len(where):
        whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        where, what = np.zeros(1, dtype=np.int64), np.array([int.from_bytes(whole, "big")], dtype=np.uint64)
    return where, what >> np.uint64(24)


def written(kept: Anchors) -> str:
    """Positions ascend, so those with equally many digits lie together and are written as one block."""
    where, what = kept
    out, at, digits = [], 0, 1
    while at < len(where):
        upto = int(np.searchsorted(where, 10**digits))
        if upto > at:
            block = np.empty((upto - at, digits + 12), dtype=np.uint8)
            for j in range(digits):
                block[:, j] = where[at:upto] // 10**(digits - 1 - j) % 10 + 48
            block[:, digits] = ord(":")
            block[:, digits + 1:digits + 11] = _HEX[
                what[at:upto].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]].reshape(-1, 10)
            block[:, -1] = ord(",")
            out.append(block.tobytes())
        at, digits = upto, digits + 1
    return b"".join(out)[:-1].decode("ascii")


def _nth(keys: np.ndarray) -> np.ndarray:
    """``keys`` made distinct: the m-th occurrence of a key is a key of its own."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    if new.all():
        return keys
    at = np.arange(len(keys))
    out = np.empty_like(keys)
    out[order] = sorted_ + (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64) * _ODD
    return out


def _followed(where: np.ndarray, what: np.ndarray) -> np.ndarray:
    """A hash of each anchor, the next one and their distance; the last one has no next."""
    after, gap = np.zeros_like(what), np.zeros_like(what)
    after[:-1], gap[:-1] = what[1:], np.diff(where)
    return mix(what + mix(after + gap * _ODD))


def likeness(a: Anchors, b: Anchors) -> float:
    if len(a[0]) == len(b[0]) and np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    (p, h), (q, g) = a, b
    both = len(p) + len(q)
    own, other = np.arange(len(p)), np.arange(len(q))  # not matched yet
    common = np.isin(h, g)
    if not common.any():
        return 0.0
    own, other = own[common], other[np.isin(g, h)]
    follow, follow_b = _followed(p, h), _followed(q, g)
    shifts = []
    for x, y in ((mix(h + p.astype(np.uint64) * _ODD), mix(g + q.astype(np.uint64) * _ODD)), (follow, follow_b), (h, g)):
        _, i, j = np.intersect1d(_nth(x[own]), _nth(y[other]), assume_unique=True, return_indices=True)
        shifts.append(p[own[i]] - q[other[j]])
        own, other = np.delete(own, i), np.delete(other, j)
        if not len(own) or not len(other):
            break
    shift = np.concatenate(shifts)
    values, often = np.unique(shift, return_counts=True)
    return float(often[(values == 0) | (often > 1)].sum()) / (both - len(shift))


def fingerprint(spark: SparkSession, text: Column) -> Column:
    """The fingerprint of a text column."""
    ship(spark)

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([written(sketch(t.as_py() or "")) for t in texts], pa.string())

    return made(text)


# --- each document beside the next ----------------------------------------------------

RESULT = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def _compare(ident, text: str, own: Anchors, following: str, other: Anchors) -> tuple:
    tail = len(text) // 4
    edited = text[:len(text) - tail] + following[:tail]
    changed = sketch(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (ident, len(text), digest, written(own), written(changed), likeness(own, changed), likeness(own, other))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)


def against_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 partitions: int | None = None) -> DataFrame:
    """Every document compared with its edited text and with the next one in order of id.

    The edited text ends with the next document's first quarter. Order: id (null last),
    then a hash of the text; after the last document comes the first. One range shuffle
    brings neighbours together; only the two ends of each partition are matched apart.
    """
    spark = ship(docs.sparkSession)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    zstd = packing(docs.select(F.col(text_column).alias("text")))

    def unpacked(packed: bytes) -> str:
        return zstd.unpack(packed).decode("utf-8", "surrogatepass")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zstd.pack(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            yield pa.record_batch([batch.column("id"), batch.column("tie"), pa.array(packed, pa.binary())],
                                  names=["id", "tie", "packed"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("tie"),
                       F.coalesce(text_column, F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.col("tie").asc()]
    # Kept in the shared folder: which rows are a partition's ends must not change between the two reads.
    ordered = cut(rows.mapInArrow(pack, "id long, tie long, packed binary").repartitionByRange(
        partitions, *order).sortWithinPartitions(*order))

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out, chars = None, [], 0
        for batch in batches:
            for ident, packed in zip(batch.column("id").to_pylist(), batch.column("packed")):
                text = unpacked(packed.as_py())
                now = (ident, text, sketch(text))
                if before:
                    out.append(_compare(*before, *now[1:]))
                    chars += len(out[-1][3]) + len(out[-1][4])
                    if len(out) >= 500 or chars >= BATCH_CHARS:
                        yield _batch(out)
                        out, chars = [], 0
                before = now
        if out:
            yield _batch(out)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first or batch.slice(0, 1)
                last = batch.slice(batch.num_rows - 1, 1)
        for place, row in (("first", first), ("last", last)):
            if row:
                yield pa.record_batch([row.column("id"), row.column("packed"), row.column("part"), pa.array([place])],
                                      names=["id", "packed", "part", "place"])

    edge = cut(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(
        ends, "id long, packed binary, part int, place string"))  # two rows a partition
    parts = sorted(r.part for r in edge.filter("place = 'first'").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    pairs = edge.filter("place = 'last'").join(follows, "part").join(
        edge.filter("place = 'first'").select(F.col("part").alias("next_part"), F.col("packed").alias("next")),
        "next_part").select("id", "packed", "next")

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, packed, following in zip(*(batch.column(c).to_pylist() for c in ("id", "packed", "next"))):
                text, after = unpacked(packed), unpacked(following)
                yield _batch([_compare(ident, text, sketch(text), after, sketch(after))])

    found = ordered.select("id", "packed").mapInArrow(inner, RESULT).unionByName(pairs.mapInArrow(outer, RESULT))
    return found.withColumnRenamed("id", id_column)
