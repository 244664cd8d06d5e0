"""Embedding whitening from polarised variances.

Entries become whole numbers (``floor(256 c)``), so that every sum is exact. The fit list is
each distinct vector once. For every dimension and every sum of two dimensions its squares
about the mean are added up: each value is taken relative to the whole number next to its
mean, squared, and the rest of the mean, less than one, is taken off in exact integers.
Half the difference V(a + b) - V(a) - V(b) is the covariance of a and b; with the variances
the matrix is complete, and eigh gives the components.

A task adds up its rows in numpy and hands on one number for each of the d (d + 1) / 2 sums
of the width d; these and the matrix are all that the driver holds. The fit list is
written once to the shared folder, as the sums must be known before squares are taken.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are
left out, and so are those with an entry beyond 2^62 / 256 in size. Vectors of each width form a
space of their own, with its own components. A component whose eigenvalue is zero to double
precision (at most width x 2^-52 of the largest) does not exist, and has no rows; a space
of equal vectors has none at all. Equal eigenvalues (ties) come in the order eigh
gives them. Repeated vectors count once in the fit and are transformed each. An empty table
gives an empty result. A deviation that no long holds is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm.shipping import ship
from filmgrain.workspace import stage_path

SCALE = 256
COMPONENTS = 4
#: Entries beyond this are not taken; their sums of two still fit 64 bits.
_MOST = 1 << 62
#: Rows squared at once, and the largest value whose squares they can add up in 64 bits.
_ROWS = 1 << 12
_SMALL = 1 << 24


@dataclass(frozen=True)
class Space:
    """Of one width: rows of the fit list, sums of its dimensions, components, and what they explain."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # width x kept
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def whole_numbers(vector: Column) -> Column:
    """``floor(256 c)`` of each entry; null for vectors that are left out."""
    entries = F.transform(vector, lambda c: c.cast("double") * SCALE)
    sound = F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float(_MOST)), F.lit(False)))
    return F.when(sound & (F.size(entries) > 0), F.transform(entries, lambda c: F.floor(c)))


def _fits(x: np.ndarray) -> bool:
    """Can squares of these entries' sums be added up in 64 bits?"""
    return not x.size or max(abs(int(x.min())), abs(int(x.max()))) < _SMALL


def _near(total: int, n: int) -> int:
    """The whole number next to total / n."""
    return (2 * total + n) // (2 * n)


def _squares(x: np.ndarray, sums: list[int]) -> np.ndarray:
    """Sums over the rows of each squared entry, then of each squared sum of two, all relative to whole means."""
    n, *s = sums
    z = x - np.array([_near(v, n) for v in s], dtype=np.int64)
    z = z if _fits(z) else z.astype(object)
    parts = [(z * z).sum(axis=0)]
    for a in range(z.shape[1] - 1):
        both = z[:, a:a + 1] + z[:, a + 1:]
        parts.append((both * both).sum(axis=0))
    return np.concatenate(parts)


def _by_width(rows: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, their rows as a matrix) of the vectors that are not null."""
    widths = np.array([-1 if w is None else w for w in rows.value_lengths().to_pylist()], dtype=np.int64)
    for width in np.unique(widths[widths >= 0]).tolist():
        at = np.flatnonzero(widths == width)
        yield width, at, rows.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), width)


def _added(points: DataFrame, fold: Callable[[int, np.ndarray], np.ndarray]) -> dict[int, list[int]]:
    """width -> the exact sum of ``fold(width, rows)`` over all rows; a task hands on one number per sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, rows in _by_width(batch.column("x")):
                for at in range(0, len(rows), _ROWS):
                    part = fold(width, rows[at:at + _ROWS]).astype(object)
                    total[width] = total[width] + part if width in total else part
        for width, sums in total.items():
            yield pa.record_batch({
                "width": pa.array([width] * len(sums), pa.int32()), "at": pa.array(range(len(sums)), pa.int32()),
                "part": pa.array([str(q) for q in sums], pa.string())})

    parts = points.select("x").mapInArrow(add, "width int, at int, part string").groupBy("width", "at")
    out: dict[int, list[int]] = {}
    for r in sorted(parts.agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("q")).collect(), key=lambda r: (r.width, r.at)):
        out.setdefault(r.width, []).append(int(r.q))
    return out


def _plain_sums(width: int, x: np.ndarray) -> np.ndarray:
    """The number of rows, then the sum of each dimension."""
    return np.append([len(x)], (x if _fits(x) else x.astype(object)).sum(axis=0))


def _variances(points: DataFrame, sums: dict[int, list[int]]) -> dict[int, list[int]]:
    """width -> n^2 x variance of every dimension and then every sum of two, exactly."""
    shared = points.sparkSession.sparkContext.broadcast(sums)
    out = _added(points, lambda width, x: _squares(x, shared.value[width]))
    for width, squares in out.items():
        n, *s = sums[width]
        left = [v - n * _near(v, n) for v in s]  # what the sums about the whole means leave
        left += [left[a] + left[b] for a in range(width) for b in range(a + 1, width)]
        out[width] = [n * q - z * z for q, z in zip(squares, left)]
    return out


def covariance(width: int, n: int, variances: list[int]) -> np.ndarray:
    """The matrix, each entry the nearest double to its exact value."""
    out = np.zeros((width, width))
    at = width
    for a in range(width):
        out[a, a] = Fraction(variances[a], n * n)
        for b in range(a + 1, width):
            out[a, b] = out[b, a] = Fraction(variances[at] - variances[a] - variances[b], 2 * n * n)
            at += 1
    return out


def _space(width: int, n: int, sums: list[int], variances: list[int], components: int) -> Space:
    matrix = covariance(width, n, variances)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    kept = int(np.count_nonzero(values > width * 2.0**-52 * max(values[0], 0.0)))
    trace = float(Fraction(sum(variances[:width]), n * n))
    return Space(n, tuple(sums), vectors[:, :kept].copy(), values[:kept], values[:kept] / (trace or 1.0))


def _error(spark: SparkSession, points: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """Largest absolute entry of (covariance of the whitened fit list - identity), by width."""
    if not spaces:
        return {}
    most = max(s.components.shape[1] for s in spaces.values())
    seen = points.select(F.size("x").alias("width"), transform(spark, spaces, F.col("x")).getField("whitened").alias("w"))
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    rows = seen.groupBy("width").agg(F.lit(0).alias("none"), *(
        F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs)).collect()
    out = {}
    for r in rows:
        kept = spaces[r.width].components.shape[1]
        out[r.width] = max((abs(r[f"c{a}_{b}"] - (a == b)) for a, b in pairs if b < kept), default=0.0)
    return out


def fit(vectors: DataFrame, vector_column: str = "embedding", components: int = COMPONENTS) -> dict[int, Space]:
    """Width -> its space, from all distinct vectors."""
    spark = ship(vectors.sparkSession)
    path = stage_path(spark, "whitening")
    rows = vectors.select(whole_numbers(F.col(vector_column)).alias("x")).filter("x IS NOT NULL").distinct()
    rows.write.parquet(path)
    points = spark.read.schema(rows.schema).parquet(path)
    sums = _added(points, _plain_sums)
    variances = _variances(points, sums)
    spaces = {w: _space(w, n, s, variances[w], components) for w, (n, *s) in sums.items()}
    error = _error(spark, points, spaces)
    return {w: Space(s.n, s.sums, s.components, s.eigenvalues, s.explained, error[w]) for w, s in spaces.items()}


def _deviations(x: np.ndarray, space: Space) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2 of each row."""
    far = max(abs(int(x.min())), abs(int(x.max())))
    most = space.n * far + max(map(abs, space.sums))
    kind = np.int64 if most < 1 << 31 and x.shape[1] * most * most < 1 << 63 else object
    off = x.astype(kind) * space.n - np.array(space.sums, dtype=kind)
    return [d if d < 1 << 63 else None for d in (off * off).sum(axis=1).tolist()]


def transform(spark: SparkSession, spaces: dict[int, Space], x: Column) -> Column:
    """struct<deviation, whitened> of whole-number vectors, whose widths the spaces hold; null stays null."""
    shared = ship(spark).sparkContext.broadcast(spaces)

    @F.arrow_udf("struct<deviation:bigint,whitened:array<double>>")
    def whiten(rows: pa.Array) -> pa.Array:
        deviation: list[int | None] = [None] * len(rows)
        whitened: list[list[float] | None] = [None] * len(rows)
        for width, at, own in _by_width(rows):
            space = shared.value[width]
            scores = _centred(own, space) @ space.components / np.sqrt(space.eigenvalues)
            for i, d, w in zip(at.tolist(), _deviations(own, space), scores.tolist()):
                deviation[i], whitened[i] = d, w
        return pa.StructArray.from_arrays(
            [pa.array(deviation, pa.int64()), pa.array(whitened, pa.list_(pa.float64()))], names=["deviation", "whitened"],
            mask=rows.is_null())

    return whiten(x)


def _centred(x: np.ndarray, space: Space) -> np.ndarray:
    """x - S / n: the whole part is taken off as integers."""
    whole = np.array([s // space.n for s in space.sums], dtype=np.int64)
    rest = np.array([float(Fraction(s % space.n, space.n)) for s in space.sums])
    return (x - whole).astype(np.float64) - rest


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each sound row and component."""
    spark = vectors.sparkSession
    spaces = fit(vectors, vector_column, components)
    rows = vectors.select(F.col(id_column).alias("id"), whole_numbers(F.col(vector_column)).alias("x")).filter("x IS NOT NULL")
    about = spark.createDataFrame(
        [(w, c + 1, s.n, float(s.explained[c]), s.identity_error) for w, s in spaces.items() for c in range(len(s.eigenvalues))],
        "width int, component int, n long, explained double, identity_error double")
    scored = rows.select("id", F.size("x").alias("width"), transform(spark, spaces, F.col("x")).alias("t"))
    each = scored.select("id", "width", F.col("t.deviation").alias("deviation"),
                         F.posexplode("t.whitened").alias("at", "whitened"))
    return each.withColumn("component", F.col("at") + 1).join(F.broadcast(about), ["width", "component"]).select(
        F.col("id").alias(id_column), "component", "n", "deviation", "whitened", "explained", "identity_error")
