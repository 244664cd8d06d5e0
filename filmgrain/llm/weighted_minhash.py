"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document's shingles are its runs of five words, weighted by count times inverse
document frequency. Frequencies are counted over all documents in a table of fixed size,
by hash: a rare shingle gets the mean of its slot, which tells it from what many
documents share at any scale. Weights lie within a factor of two, so that a large group
of copies does not turn its own text into common text.

Each of the consistent weighted samples picks a shingle and a level such that two
documents agree in a sample with the probability of their weighted Jaccard similarity.
Bands of samples bring candidates into buckets, and in a bucket the whole texts decide:
pairs whose weighted Jaccard similarity reaches the threshold are linked.

Scale: documents with equal words are one document from the start. Buckets with the same
members are compared once. A bucket is compared by growing groups: a member is compared
with those not yet linked to its group, so every pair is either verified or already in
one group, no pair is written, and memory is the bucket's. A bucket of more than
``BLOCK_WORDS`` words is cut into blocks, each two of which meet in a task of their own.

Defined results: a document of fewer than five words is one shingle; one without words
(null, empty) is like none and forms a class of its own; the class id is the smallest
document id of the class (null only if all are); repeated rows are copies; an empty
table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.arrays import mix, run_hashes, word_hashes, words
from filmgrain.llm.graph import components
from filmgrain.llm.shipping import ship
from filmgrain.workspace import cut

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 4
#: Slots of the frequency table; its size does not depend on the data.
SLOTS = 1 << 18
CHUNKS = 16
#: Words of a bucket that are compared in one task.
BLOCK_WORDS = 1_000_000

_SAMPLES = BANDS * ROWS
_RNG = np.random.default_rng(41)
_STEPS = 1 << 16
#: Random numbers of the sampling, drawn by a hash of shingle and sample.
_R = _RNG.gamma(2.0, 1.0, _STEPS).astype(np.float32)
_R_INVERSE = (1 / _R).astype(np.float32)
_LOG_C = np.log(_RNG.gamma(2.0, 1.0, _STEPS)).astype(np.float32)
_BETA = _RNG.uniform(0, 1, _STEPS).astype(np.float32)
_ODD = _RNG.integers(1, 2**63, _SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_REPEAT = np.uint64(0x9FB21C651E98DF25)


def plain_words(text: str | None) -> bytes:
    """The words, split at ASCII white space, joined by one blank."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def digest(plain: bytes) -> bytes | None:
    return hashlib.blake2b(plain, digest_size=16).digest() if plain else None


def shingles(plain: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles of ``plain`` and how often each occurs."""
    own = word_hashes(*words(plain))
    return np.unique(run_hashes(own, min(SHINGLE, len(own))), return_counts=True)


def slots(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(3)).astype(np.int64) & (SLOTS - 1)


def idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    """Weights from 1 (in all documents) to 2 (in one)."""
    return (1 + np.log((1 + documents) / (1 + frequency)) / np.log(2 + documents)).astype(np.float32)


def samples(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingle and the level of each consistent weighted sample."""
    log_w = np.log(weights).astype(np.float32)
    step = max(1, (1 << 18) // len(keys))  # samples drawn together
    chosen, level = np.empty(_SAMPLES, np.int64), np.empty(_SAMPLES, np.int64)
    for j in range(0, _SAMPLES, step):
        at = ((keys[None, :] * _ODD[j:j + step, None]) >> np.uint64(48)).astype(np.int32)
        beta = _BETA[at]
        t = np.floor(log_w * _R_INVERSE[at] + beta)
        best = (_LOG_C[at] - _R[at] * (t - beta + 1)).argmin(axis=1)
        chosen[j:j + step] = best  # equal values: the smallest key, in every document alike
        level[j:j + step] = t[np.arange(len(best)), best]
    return keys[chosen], level


def bands(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band."""
    what, level = samples(keys, weights)
    each = mix(what + level.astype(np.uint64) * _REPEAT).reshape(BANDS, ROWS)
    return mix((each * _ODD[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per slot, and documents; tasks add up tables of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = np.zeros(SLOTS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                plain = plain_words(text.as_py())
                if plain:
                    table[np.unique(slots(shingles(plain)[0]))] += 1
                    n += 1
        if n:
            parts = table.astype("<i8").reshape(CHUNKS, -1)
            yield pa.record_batch([pa.array(range(CHUNKS), pa.int32()), pa.array([n] + [0] * (CHUNKS - 1), pa.int64()),
                                   pa.array([p.tobytes() for p in parts], pa.binary())], names=["chunk", "n", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        n: dict[int, int] = {}
        for batch in batches:
            for chunk, some, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "n", "counts"))):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, "<i8")
                n[chunk] = n.get(chunk, 0) + some
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([n[c] for c in sums], pa.int64()),
                                   pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                  names=["chunk", "n", "counts"])

    schema = "chunk int, n long, counts binary"
    parts = rows.select("text").mapInArrow(count, schema).repartition(CHUNKS, "chunk").mapInArrow(add, schema).collect()
    if not parts:
        return np.zeros(SLOTS, dtype=np.int64), 0
    whole = {p.chunk: np.frombuffer(p.counts, "<i8") for p in parts}
    return np.concatenate([whole[c] for c in range(CHUNKS)]), sum(p.n for p in parts)


def _linked(group: list[tuple[int, bytes]], weight: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links within a bucket, as pairs of keys."""
    features, sizes = [], []
    for _, packed in group:
        keys, n = shingles(zstandard.decompress(packed))
        if n.max(initial=1) > 1:  # the m-th occurrence of a shingle is a feature of its own
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys = np.repeat(keys, n)
        else:
            nth = np.zeros(len(keys), dtype=np.int64)
        features.append((keys, nth))
        sizes.append(len(keys))
    keys, nth = (np.concatenate(x) for x in zip(*features))
    weights = weight[slots(keys)].astype(np.float64)
    _, ident = np.unique(keys + nth.astype(np.uint64) * _REPEAT, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(sizes)])
    total = np.add.reduceat(weights, start[:-1])
    marked = np.zeros(int(ident.max()) + 1)
    rest = np.arange(len(group))  # not in any group yet
    # their features, side by side
    flat, lengths = ident, np.array(sizes)
    while len(rest) > 1:
        todo = [int(rest[0])]
        rest, flat, lengths = rest[1:], flat[lengths[0]:], lengths[1:]
        while todo and len(rest):
            at = todo.pop()
            own = ident[start[at]:start[at + 1]]
            marked[own] = weights[start[at]:start[at + 1]]
            common = np.add.reduceat(marked[flat], np.cumsum(lengths) - lengths)
            marked[own] = 0
            near = common >= threshold * (total[at] + total[rest] - common) - 1e-9
            if near.any():
                for other in rest[near]:
                    todo.append(int(other))
                    yield group[at][0], group[other][0]
                flat = flat[np.repeat(~near, lengths)]
                rest, lengths = rest[~near], lengths[~near]


def classes(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id",
            text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (id, digest) of all documents; groups (digest, class_id, keeper).

    ``keeper`` is the digest of the text that stays for the class, that of ``class_id``.
    A row without words has a null digest and is in no group.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    frequency, n = _frequencies(rows)
    shared = spark.sparkContext.broadcast(idf(frequency, n))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, seen = zstandard.ZstdCompressor(level=3), set()
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text"):
                plain = plain_words(text.as_py())
                mark = digest(plain)
                if mark is None or mark in seen:  # a copy within the task: its text has gone ahead
                    out.append((mark, None, None, None))
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(mark)
                keys, times = shingles(plain)
                signature = bands(keys, times * shared.value[slots(keys)])
                out.append((mark, plain.count(b" ") + 1, signature.view(np.int64), squeeze.compress(plain)))
            kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            yield pa.record_batch(
                [batch.column("id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))] if out
                else [batch.column("id"), *(pa.array([], k) for k in kinds)],
                names=["id", "digest", "n_words", "bands", "packed"])

    kind = rows.schema["id"].dataType.simpleString()
    signed = cut(rows.mapInArrow(sign, f"id {kind}, digest binary, n_words long, bands array<long>, packed binary"))
    keyed = signed.withColumn("key", F.monotonically_increasing_id())
    texts = cut(keyed.filter("bands IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("key", "n_words", "bands")).alias("t")).select("digest", "t.*"))

    buckets = texts.select("key", "n_words", F.posexplode("bands").alias("band", "h")).select(
        "key", "n_words", F.xxhash64("band", "h").alias("bucket"))
    stats = buckets.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("n_words").alias("words"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y")).filter("n > 1")
    # Buckets of the same members, by count and a 128-bit sum, are compared once.
    once = cut(stats.groupBy("n", "x", "y", "words").agg(F.min("bucket").alias("bucket")).select("bucket", "words"))
    met = buckets.join(once, "bucket").withColumn("blocks", F.expr(f"int((words + {BLOCK_WORDS - 1}) div {BLOCK_WORDS})"))
    met = met.withColumn("own", F.expr("int(pmod(xxhash64(key, 2), blocks))")).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _buckets(batches):
            pairs = list(_linked(group, shared.value, threshold))
            if pairs:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["a", "b"])

    edges = met.join(keyed.select("key", "packed"), "key").repartition("bucket", "i", "j").sortWithinPartitions(
        "bucket", "i", "j", "key").mapInArrow(compare, "a long, b long")
    component = components(edges)

    known = signed.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("missing"), F.col("id"))).alias("first"))
    placed = cut(texts.select("digest", "key").join(component.withColumnRenamed("id", "key"), "key", "left").select(
        "digest", F.coalesce("component", "key").alias("component")).join(known, "digest"))
    lead = placed.groupBy("component").agg(F.min(F.struct("first.missing", "first.id", "digest")).alias("lead"))
    groups = cut(placed.join(cut(lead), "component").select(
        "digest", F.col("lead.id").alias("class_id"), F.col("lead.digest").alias("keeper")))
    return signed.select("id", "digest"), groups


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    key, group = None, []
    for batch in batches:
        for *now, ident, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j", "key", "packed"))):
            if now != key:
                if len(group) > 1:
                    yield group
                key, group = now, []
            group.append((ident, packed))
    if len(group) > 1:
        yield group


def label(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, class_id, and whether the row's text stays for its class."""
    rows, groups = classes(docs, threshold, id_column, text_column)
    return rows.join(groups, "digest", "left").select(
        F.col("id").alias(id_column),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("digest").isNull() | ((F.col("digest") == F.col("keeper")) & F.col("id").eqNullSafe(F.col("class_id")))
         ).alias("kept"))


def _digests(spark: SparkSession, text: Column) -> Column:
    ship(spark)

    @F.arrow_udf("binary")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([digest(plain_words(t.as_py())) for t in texts], pa.binary())

    return made(text)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class; rows without words all stay. Columns are unchanged."""
    _, groups = classes(docs, threshold, id_column, text_column)
    keepers = groups.filter("digest = keeper").select(F.col("class_id").alias("keeper_id"), F.col("keeper").alias("keeper_digest"))
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))  # no name can clash
    marked = packed.select("row", F.col(f"row.{id_column}").alias("id"),
                           _digests(docs.sparkSession, F.col(f"row.{text_column}")).alias("digest"))
    chosen = marked.join(keepers, (F.col("digest") == F.col("keeper_digest")) & F.col("id").eqNullSafe(F.col("keeper_id")),
                         "left_semi").dropDuplicates(["id", "digest"])
    return chosen.select("row.*").union(marked.filter("digest IS NULL").select("row.*"))
