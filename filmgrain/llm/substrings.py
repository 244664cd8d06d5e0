"""Removing passages that an earlier document holds: seed and extend on winnowed anchors.

Seeds: of every ``WIDTH`` consecutive runs of ``SEED`` words, the one with the smallest
hash is an anchor, so two documents that share ``LENGTH`` words share an anchor inside
them. Anchors are brought together by hash; those of two documents or more are seeds.

Extension: a seed reaches ``LENGTH - SEED`` words to either side. Of the windows of
``LENGTH`` words there, those whose own anchor it is are looked up among the windows
around the same seed elsewhere, by a 96-bit hash; a window that an earlier document
(smaller id) also has is covered. Covered windows that touch are joined into maximal
repeats, which are removed. A window whose anchor is no seed occurs in one document only
and is never written.

Scale: exact copies of whole documents are settled by a digest first and leave the join,
so a group of copies, however large, has one member in it. What a batch of documents settles
by itself is not brought together: of an anchor that several of its documents hold, one
witness goes to the others, and of a window the rows of its smallest id, so a passage that a
third of all documents share is one row a batch in its group. Anchors and windows are sorted
by hash and read as a stream: a group needs no memory, and no pairs are made. Texts are
packed and shuffled once, to where all later joins find them.

Windows are compared by 96 bits made of 64-bit word hashes, whose multipliers are random by
place; texts are not compared again.

Defined results: null texts have no words; a null id is never earlier or later than
another, so such a document keeps everything; documents with the same id do not remove
each other's words; repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.llm.arrays import mix, run_hashes, sliding_min, word_hashes, words
from filmgrain.llm.packing import Packing, packing
from filmgrain.llm.shipping import ship
from filmgrain.workspace import cut

LENGTH, SEED = 13, 5
WIDTH = LENGTH - SEED + 1
#: A group of copies meets its first document in so many parts.
SALTS = 16
#: Rows of an anchor or window: stands for several ids; waits for the others; decided within its batch.
WITNESS, OPEN, SETTLED = 0, 1, 2
RESULT = ("id long, n_words long, n_removed long, repeats array<struct<start:int,end:int>>, "
          "kept_sha256 string, kept string")


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """The position of the smallest hash (the last, of equals) in each run of ``width``."""
    low = sliding_min(hashes, width)
    at = np.zeros(len(low), dtype=np.int64)
    for j in range(width):
        at = np.where(hashes[j:j + len(low)] == low, np.arange(j, j + len(low)), at)
    return at


def _tag(plain: bytes) -> tuple[bytes, int]:
    digest = hashlib.blake2b(plain, digest_size=16).digest()
    return digest, int.from_bytes(digest[:8], "big", signed=True)


def _plain(text: pa.Scalar) -> bytes:
    return b" ".join((text.as_py() or "").encode("utf-8", "surrogatepass").split())  # ASCII white space


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = [_plain(t) for t in batch.column("text")]
        digests, tags = zip(*map(_tag, plain)) if plain else ((), ())
        long_ = [p.count(b" ") + 1 >= LENGTH for p in plain]
        yield pa.record_batch([batch.column("id"), pa.array(digests, pa.binary()), pa.array(tags, pa.int64()),
                               pa.array(long_, pa.bool_())], names=["id", "digest", "tag", "long"])


def _prepare(zstd: Packing):
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = [_plain(t) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("id"), pa.array([_tag(p)[1] for p in plain], pa.int64()),
                 pa.array([p.count(b" ") + 1 if p else 0 for p in plain], pa.int64()),
                 pa.array([zstd.pack(p) for p in plain], pa.binary())],
                names=["id", "tag", "n_words", "packed"])

    return prepare


def _anchors(zstd: Packing):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, places = [], [], []
            for ident, tag, packed, copies in zip(*(batch.column(c) for c in ("id", "tag", "packed", "copies"))):
                if not ident.is_valid or (copies.is_valid and tag.as_py() in copies.as_py()):
                    continue
                runs = run_hashes(word_hashes(*words(zstd.unpack(packed.as_py()))), SEED)
                if len(runs) < WIDTH:
                    continue
                at = np.unique(smallest(runs, WIDTH))
                keys.append(runs[at].view(np.int64))
                ids.append(np.full(len(at), ident.as_py(), dtype=np.int64))
                places.append(at.astype(np.int32))
            if keys:
                yield pa.record_batch(_witnessed(*map(np.concatenate, (keys, ids, places))), names=["anchor", "kind", "id", "pos"])

    return anchors


def _spread(ids: np.ndarray) -> np.ndarray:
    """Keys that send settled rows to any task, by id."""
    return mix(ids.view(np.uint64) + np.uint64(1)).view(np.int64)


def _witnessed(keys: np.ndarray, ids: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """Anchors of a batch; those of several ids are seeds already and leave a witness in their group."""
    order = np.lexsort((ids, keys))
    keys, ids, places = keys[order], ids[order], places[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(start, append=len(keys))
    several = ids[start] != ids[start + size - 1]
    settled = np.repeat(several, size)
    told = start[several]
    return [np.concatenate([np.where(settled, _spread(ids), keys), keys[told]]),
            np.concatenate([np.where(settled, SETTLED, OPEN), np.full(len(told), WITNESS)]).astype(np.int8),
            np.concatenate([ids, ids[told]]), np.concatenate([places, np.full(len(told), -1)]).astype(np.int32)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of anchors sorted by (anchor, kind, id), those of two ids or more; settled ones pass. Without kinds all are open."""
    held: pa.RecordBatch | None = None  # the last anchor so far, while only its first id has come
    key = ident = None  # the last anchor and its first id
    several = False
    for batch in batches:
        kinds = batch.column("kind").to_numpy() if "kind" in batch.schema.names else np.full(batch.num_rows, OPEN)
        if (kinds == SETTLED).any():
            yield batch.filter(pa.array(kinds == SETTLED)).select(["id", "pos"])
            batch = batch.filter(pa.array(kinds != SETTLED))
            kinds = kinds[kinds != SETTLED]
        if not batch.num_rows:
            continue
        keys, ids = batch.column("anchor").to_numpy(), batch.column("id").to_numpy()
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        stop = np.append(start[1:], len(keys))
        first = ids[start].copy()
        many = (ids[stop - 1] != first) | (kinds[start] == WITNESS)
        if key is not None and keys[0] == key:
            first[0] = ident
            many[0] |= several or ids[stop[0] - 1] != ident
            if many[0] and held is not None:
                yield held.select(["id", "pos"])
                held = None
        else:
            held = None
        out = np.repeat(many, stop - start) & (kinds != WITNESS)
        tail = batch.slice(int(start[-1])) if not many[-1] else None
        if out.any():
            yield batch.filter(pa.array(out)).select(["id", "pos"])
        if tail is None:
            held = None
        elif held is not None and len(start) == 1:  # the same anchor and id go on; bounded by one document
            held = pa.Table.from_batches([held, tail]).combine_chunks().to_batches()[0]
        else:
            held = tail
        key, ident, several = keys[-1], first[-1], bool(many[-1])


def _windows(zstd: Packing):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows around the seeds of each document."""
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for ident, mark, packed, seeds in zip(*(batch.column(c) for c in ("id", "mark", "packed", "seeds"))):
                if not seeds.is_valid:
                    continue
                own = word_hashes(*words(zstd.unpack(packed.as_py())))
                if len(own) < LENGTH:
                    continue
                at = smallest(run_hashes(own, SEED), WIDTH)
                known = np.zeros(len(own), dtype=bool)
                places = seeds.values.to_numpy()
                known[places[places < len(own)]] = True  # an id that occurs twice has the seeds of both texts
                begin = np.flatnonzero(known[at])
                a = run_hashes(own, LENGTH, 1)[begin]
                a, once = np.unique(a, return_index=True)  # a window that a document repeats is looked up once
                begin = begin[once]
                b = run_hashes(own, LENGTH, 2)[begin]
                for col, x in zip(cols, (
                        a.view(np.int64), (b >> np.uint64(32)).astype(np.uint32).view(np.int32),
                        np.full(len(begin), ident.as_py(), np.int64), np.full(len(begin), mark.as_py(), np.int64),
                        begin.astype(np.int32))):
                    col.append(x)
            if cols[0]:
                h, g, ids, marks, places = map(np.concatenate, cols)
                # Of a window in several documents of the batch, only those with the smallest id are not settled.
                order = np.lexsort((ids, g, h))
                h, g, ids, marks, places = (c[order] for c in (h, g, ids, marks, places))
                opens = np.ones(len(h), dtype=bool)
                opens[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                start = np.flatnonzero(opens)
                settled = ids > np.repeat(ids[start], np.diff(start, append=len(h)))
                yield pa.record_batch([
                    np.where(settled, _spread(ids), h), g, np.where(settled, SETTLED, OPEN).astype(np.int8), ids, marks, places],
                    names=["h", "g", "kind", "id", "mark", "pos"])

    return windows


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by (h, g, id), those whose group began with a smaller id; settled ones pass."""
    key, ident = None, 0
    for batch in batches:
        settled = batch.column("kind").to_numpy() == SETTLED
        if settled.any():
            yield batch.filter(pa.array(settled)).select(["id", "mark", "pos"])
            batch = batch.filter(pa.array(~settled))
        if not batch.num_rows:
            continue
        h, g, ids = (batch.column(c).to_numpy() for c in ("h", "g", "id"))
        opens = np.ones(len(h), dtype=bool)
        opens[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        start = np.flatnonzero(opens)
        first = ids[start].copy()
        if key == (h[0], g[0]):
            first[0] = ident
        later = ids > np.repeat(first, np.diff(start, append=len(h)))
        key, ident = (h[-1], g[-1]), first[-1]
        if later.any():
            yield batch.filter(pa.array(later)).select(["id", "mark", "pos"])


def _kept(zstd: Packing, with_text: bool):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ident, tag, mark, count, packed, copies, covered in zip(*(
                    batch.column(c) for c in ("id", "tag", "mark", "n_words", "packed", "copies", "covered"))):
                plain, n = zstd.unpack(packed.as_py()), count.as_py()
                tag = tag.as_py()
                if copies.is_valid and tag in copies.as_py():
                    plain, removed, spans = b"", n, [{"start": 0, "end": n}]
                elif covered.is_valid:
                    pairs = covered.values
                    at = pairs.field("pos").to_numpy()[pairs.field("mark").to_numpy() == mark.as_py()]
                    runs = run_hashes(word_hashes(*words(plain)), LENGTH, 1)
                    at = np.flatnonzero(np.isin(runs, runs[at]))  # wherever the document repeats them
                    cover = np.zeros(n + 1, dtype=np.int32)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.minimum(at + LENGTH, n), -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
                    spans = [{"start": int(a), "end": int(b)}
                             for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
                    removed = int(gone.sum())
                    if removed:
                        own = plain.split(b" ")
                        plain = b" ".join(own[i] for i in np.flatnonzero(~gone))
                else:
                    removed, spans = 0, []
                out.append((ident.as_py(), n, removed, spans, hashlib.sha256(plain).hexdigest(),
                            plain.decode("utf-8", "surrogatepass") if with_text else None))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(),
                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                      names=["id", "n_words", "n_removed", "repeats", "kept_sha256", "kept"])

    return kept


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   with_text: bool = True, partitions: int | None = None) -> DataFrame:
    """Per row: id, n_words, n_removed, repeats (removed spans of words), kept_sha256 and, on demand, kept."""
    spark = ship(docs.sparkSession)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    zstd = packing(rows)
    # One exchange: the plan below reads it at each of its three joins by id.
    packed = rows.mapInArrow(_prepare(zstd), "id long, tag long, n_words long, packed binary").repartition(partitions, "id")

    # Whole copies: every window starts in the first document already.
    named = cut(rows.filter("id IS NOT NULL").mapInArrow(_digests, "id long, digest binary, tag long, long boolean"))
    long_ = named.filter("long")
    firsts = long_.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter(
        "first < last").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("last")
    copies = long_.withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS))).join(firsts, ["digest", "salt"]).filter(
        F.col("id") > F.col("first")).groupBy("id").agg(F.collect_set("tag").alias("copies"))
    # Only an id that occurs more than once needs its tag beside it.
    often = named.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    notes = cut(copies.join(often, "id", "full").select("id", "copies", F.col("n").isNotNull().alias("often")))

    # All columns and left joins throughout, so that the exchange is the same and is made once.
    whole = ["id", "tag", "n_words", "packed"]
    mark = F.when(F.coalesce("often", F.lit(False)), F.col("tag")).otherwise(0).alias("mark")
    seeds = packed.join(notes, "id", "left").select(*whole, "copies").mapInArrow(
        _anchors(zstd), "anchor long, kind tinyint, id long, pos int").repartition(partitions, "anchor").sortWithinPartitions(
        "anchor", "kind", "id").mapInArrow(_shared, "id long, pos int").groupBy("id").agg(F.collect_list("pos").alias("seeds"))
    windows = packed.join(seeds, "id", "left").join(notes, "id", "left").select(*whole, mark, "seeds").mapInArrow(
        _windows(zstd), "h long, g int, kind tinyint, id long, mark long, pos int")
    covered = windows.repartition(partitions, "h", "g").sortWithinPartitions("h", "g", "id").mapInArrow(
        _covered, "id long, mark long, pos int").groupBy("id").agg(
        F.collect_list(F.struct("mark", "pos")).alias("covered"))
    told = packed.join(notes, "id", "left").join(covered, "id", "left").select(
        *whole, mark, "copies", "covered")
    return told.mapInArrow(_kept(zstd, with_text), RESULT).withColumnRenamed("id", id_column)
