"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Iterative quantisation: unit vectors of a bounded sample are centred and projected onto
their principal axes, and a rotation is learned that alternately takes the nearest
binary codes and the rotation that fits them best. Several rotations from different
starts give a code of as many parts. The thresholds are the sample's medians, so each
bit is balanced.

The code is cut into ``tables`` substrings. Vectors of one group (equal label, equal
dimension) that agree in a substring meet in that table's bucket, where the original
vectors are compared in double precision. A pair is counted in the first table in which
it meets, so no pair is ever written: tasks return the links of each vector as numbers
and a spanning forest of what they found.

Scale: equal vectors are one vector with a multiplicity, counted at once. A bucket of
more than ``block`` vectors is cut into blocks of about that many, and every two blocks
meet in a task of their own, so memory is bounded and nothing is capped. Longer codes
with more bits in a substring make buckets smaller for larger groups.

Defined results: vectors that are null, empty, zero, or hold null or non-finite parts, and
rows with a null label, have no links and are their own component; a null id takes no
part; repeated rows link with each other; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.llm.graph import components
from filmgrain.llm.shipping import ship
from filmgrain.workspace import cut

THRESHOLD = 0.98
#: Bits of a table where there are few vectors, and what two linked vectors may miss each other by in all tables.
LEAST_BITS, MISSED = 8, 1e-4
#: Vectors a rotation is learned on, at most.
SAMPLE = 20_000
TURNS = 30
BLOCK = 1024
#: Groups of up to so many rows are compared many at once.
FEW = 64


@dataclass(frozen=True)
class Quantiser:
    """Per dimension: the centre and the stacked rotations (bits, dim) with their thresholds."""

    bits: int
    models: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(n, bits) of 0 and 1."""
        dim = unit.shape[1]
        if dim not in self.models:  # a dimension the sample did not hold: random axes, still all compared
            axes = np.random.default_rng(dim).standard_normal((self.bits, dim))
            self.models[dim] = (np.zeros(dim), axes, np.zeros(self.bits))
        centre, axes, cuts = self.models[dim]
        return ((unit - centre) @ axes.T > cuts).astype(np.uint8)


def learn(unit: np.ndarray, bits: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, (bits, dim) axes and thresholds from unit vectors (n, dim)."""
    rng = np.random.default_rng(seed)
    centre = unit.mean(axis=0)
    x = unit - centre
    _, vectors = np.linalg.eigh(x.T @ x)
    axes = []
    dim = x.shape[1]
    while sum(a.shape[1] for a in axes) < bits:
        width = min(dim, bits - sum(a.shape[1] for a in axes))
        # the principal axes first; later parts of the code start from the same ones turned at random
        base = vectors[:, ::-1] if not axes else vectors @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        base = base[:, :width]
        projected = x @ base
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(TURNS):
            near = np.where(projected @ turn >= 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(projected.T @ near)
            turn = u @ vt
        axes.append(base @ turn)
    axes = np.concatenate(axes, axis=1).T
    return centre, axes, np.median(x @ axes.T, axis=0)


def layout(rows: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(tables, bits) for labels of up to ``rows`` vectors.

    A table has about as many buckets as a label has vectors, so a bucket holds few however
    large the label grows. Two unit vectors at the threshold differ in a bit with the
    probability of their angle by pi, for axes in random position; there are as many tables
    as it takes to miss a pair in all of them with probability ``MISSED``.
    """
    bits = max(LEAST_BITS, math.ceil(math.log2(max(rows, 2))))
    meet = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return (math.ceil(math.log(MISSED) / math.log(1 - meet)) if meet < 1 else 1), bits


def _units(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow, no underflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit(vectors: DataFrame, column: str = "embedding", bits: int = 144, sample: int = SAMPLE) -> Quantiser:
    """Learn a quantiser from at most about ``sample`` vectors, chosen by a hash of their values."""
    values = vectors.select(F.col(column).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    n = values.count()
    share = min(1.0, sample / max(n, 1))
    drawn = values.filter(F.shiftrightunsigned(F.xxhash64("v"), 11) / float(1 << 53) < share)
    found = drawn.limit(2 * sample).toArrow()["v"].combine_chunks()
    lengths = found.value_lengths().to_numpy(zero_copy_only=False)
    models = {}
    for dim in np.unique(lengths[lengths > 0]).tolist():
        rows = found.take(pa.array(np.flatnonzero(lengths == dim))).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        rows = np.unique(rows[np.isfinite(rows).all(axis=1) & rows.any(axis=1)], axis=0)  # in an order of their own
        if len(rows):
            models[dim] = learn(_units(rows), bits)
    return Quantiser(bits, models)


def links(vectors: DataFrame, threshold: float = THRESHOLD, tables: int | None = None, bits: int | None = None, block: int = BLOCK,
          id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
          model: Quantiser | None = None) -> DataFrame:
    """Per row: id, n_links and component_id (the smallest id that links reach).

    Unless they are given, ``tables`` and ``bits`` follow from the largest label.
    """
    spark = ship(vectors.sparkSession)
    if tables is None or bits is None:
        sizes = vectors.filter(F.col(label_column).isNotNull()).groupBy(label_column, F.size(vector_column)).count()
        tables, bits = layout(sizes.agg(F.max("count").alias("n")).first().n or 0, threshold)
    model = model or fit(vectors, vector_column, tables * bits)
    shared = spark.sparkContext.broadcast(model)  # bits x dimension numbers
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = cut(rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite
                            & F.exists("v", lambda x: x != 0)).withColumn("v", F.transform("v", lambda x: x + 0.0)))

    # Equal vectors of a label: one vector, the smallest id, and how often it occurs.
    same = sound.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("times"))
    reps = cut(same.select(F.monotonically_increasing_id().alias("key"), "*"))
    copies = reps.filter("times > 1")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits)
        for batch in batches:
            dims = np.diff(batch.column("v").offsets.to_numpy())
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                flat = part.column("v").flatten().to_numpy().reshape(len(at), dim)
                parts = shared.value.codes(_units(flat)).reshape(len(at), tables, bits) @ weights
                yield pa.record_batch(
                    [part.column(c) for c in ("key", "label", "v", "rep", "times")]
                    + [pa.ListArray.from_arrays(np.arange(0, parts.size + 1, tables, dtype=np.int32), parts.astype(np.int64).ravel())],
                    names=["key", "label", "v", "rep", "times", "code"])

    coded = cut(reps.mapInArrow(code, "key long, label string, v array<double>, rep long, times long, code array<long>"))
    narrow = coded.select("key", F.xxhash64("label", F.size("v")).alias("space"), F.posexplode("code").alias("t", "s"))
    sizes = narrow.groupBy("space", "t", "s").agg(F.count("*").alias("n")).filter("n > 1")
    # Blocks of a bucket; a vector of block i meets blocks (i, j) for every j.
    met = narrow.join(cut(sizes), ["space", "t", "s"]).withColumn("blocks", F.expr(f"int((n + {block - 1}) div {block})"))
    met = met.withColumn("own", F.expr("int(pmod(xxhash64(key), blocks))")).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.select("key", "space", "t", "s", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    full = met.join(coded, "key").select(
        "key", "space", "t", "s", "i", "j", "own", "label", "v", "rep", "times", "code")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, starts in _groups(batches, ["space", "t", "s", "i", "j", "label"]):
            yield from _compare(some, starts, threshold)

    order = ["space", "t", "s", "i", "j", "label"]
    found = cut(full.repartition(*order[:5]).sortWithinPartitions(*order, "rep").mapInArrow(
        compare, "key long, n long, a long, b long"))
    counts = found.filter("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n"))
    joined = found.filter("b IS NOT NULL").select("a", "b")
    # Copies link with their representative; each row finds it again by value.
    member = sound.join(copies.select("label", "v", "rep", "times"), ["label", "v"]).select("id", "rep", "label", "times")
    edges = joined.union(member.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    component = components(edges)
    about = sound.select("id", "label", "v").join(reps.select("key", "label", "v", "times"), ["label", "v"]).join(
        counts, "key", "left").select(
        "id", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"))
    # Rows that share an id are one vertex; each keeps its own number of links.
    lone = rows.filter(~(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
                         & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))).select(
        "id", F.lit(0).cast("long").alias("n_links"))
    return about.union(lone).join(component, "id", "left").select(
        F.col("id").alias(id_column), "n_links", F.coalesce("component", "id").alias("component_id"))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of consecutive rows with equal keys, many at a time, with the place where each starts.

    A group is bounded by two blocks, so what is held back for the next batch is too.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks()
        change = np.zeros(rows.num_rows - 1, dtype=bool)
        for k in keys:
            column = rows.column(k).chunk(0)
            change |= np.asarray(pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False))
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        last = int(starts[-1])
        if last:
            yield rows.slice(0, last), starts[:-1]
        held = rows.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held), np.zeros(1, dtype=np.int64)


def _compare(rows: pa.Table, starts: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of every row within its group and spanning forests, counted in the first table in which a pair meets.

    Groups of few rows are compared together, as many at once as have an equal number of rows
    and of dimensions; each of the others is compared by itself.
    """
    rows = rows.combine_chunks()
    column = lambda c: rows.column(c).chunk(0)
    dims = pc.list_value_length(column("v")).to_numpy()
    offsets, flat = np.concatenate([[0], np.cumsum(dims)]), column("v").flatten().to_numpy()
    code = column("code").flatten().to_numpy().reshape(rows.num_rows, -1)
    key, rep, times, own, table, i, j = (column(c).to_numpy() for c in ("key", "rep", "times", "own", "t", "i", "j"))
    size = np.diff(np.append(starts, rows.num_rows))
    links, edges = np.zeros(rows.num_rows, dtype=np.int64), []

    def units(at: np.ndarray) -> np.ndarray:
        return _units(flat[offsets[at][:, None] + np.arange(dims[at[0]])])

    few = (size >= 2) & (size <= FEW) & (i[starts] == j[starts])
    for n, dim in np.unique(np.stack([size[few], dims[starts[few]]], axis=1), axis=0).tolist():
        chosen = starts[few & (size == n) & (dims[starts] == dim)]
        for part in np.array_split(chosen, math.ceil(len(chosen) * n / 4096)):
            at = part[:, None] + np.arange(n)
            unit = units(at.ravel()).reshape(len(part), n, dim)
            near = unit @ unit.transpose(0, 2, 1) >= threshold
            g, a, b = np.nonzero(np.triu(near, 1))
            met = (code[at[g, a]] == code[at[g, b]]).argmax(axis=1) == table[part[g]]
            g, a, b = g[met], a[met], b[met]
            np.add.at(links, at[g, a], times[at[g, b]])
            np.add.at(links, at[g, b], times[at[g, a]])
            near[:] = False
            near[g, a, b] = near[g, b, a] = True
            edges += [_forest(near[x], at[x], at[x]) for x in np.unique(g)]
    for start, n in zip(starts[(size >= 2) & ~few].tolist(), size[(size >= 2) & ~few].tolist()):
        here = np.arange(start, start + n)
        alone = i[start] == j[start]
        left = here if alone else here[own[here] == i[start]]
        right = here if alone else here[own[here] == j[start]]
        if not len(left) or not len(right):
            continue
        near = units(left) @ units(right).T >= threshold
        for t in range(table[start]):
            near &= code[left, t][:, None] != code[right, t][None, :]
        if alone:
            np.fill_diagonal(near, False)
        links[left] += near @ times[right]
        if not alone:
            links[right] += near.T @ times[left]
        edges.append(_forest(near, left, right))
    at = np.flatnonzero(links)
    if not len(at):
        return
    edge = np.concatenate(edges)
    none, some = [None] * len(edge), [None] * len(at)
    yield pa.record_batch([
        pa.array(key[at].tolist() + none, pa.int64()), pa.array(links[at].tolist() + none, pa.int64()),
        pa.array(some + rep[edge[:, 0]].tolist(), pa.int64()), pa.array(some + rep[edge[:, 1]].tolist(), pa.int64()),
    ], names=["key", "n", "a", "b"])


def _forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A spanning forest of the bipartite (or symmetric) links ``near``, as pairs of places."""
    seen_left, seen_right = np.zeros(len(left), bool), np.zeros(len(right), bool)
    same = left is right or (len(left) == len(right) and bool((left == right).all()))
    out: list[tuple[int, int]] = []
    for root in np.flatnonzero(near.any(axis=1)):
        if seen_left[root]:
            continue
        seen_left[root] = True
        if same:
            seen_right[root] = True
        todo = [(root, True)]
        while todo:
            at, is_left = todo.pop()
            new = np.flatnonzero(near[at] & ~seen_right) if is_left else np.flatnonzero(near[:, at] & ~seen_left)
            mine, theirs = (left, right) if is_left else (right, left)
            out += [(mine[at], theirs[x]) for x in new]
            (seen_right if is_left else seen_left)[new] = True
            if same:
                seen_left[new] = True
                todo += [(x, True) for x in new]
            else:
                todo += [(x, not is_left) for x in new]
    return np.array(out, dtype=np.int64).reshape(-1, 2)
