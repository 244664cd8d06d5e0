"""K-means over two scaled features.

Years and ratings take few distinct values, so the rows of a genre collapse into
weighted points before the loop; an iteration reads points, not titles. Centroids
(at most a few hundred doubles) travel inside the plan, so assigning a point is a map
step without any join. Sums are decimal: the result does not depend on the order in
which tasks finish.

A run is a (label, k) pair; all runs advance together in one job per iteration, and a
run whose centroids stopped moving is left out of later jobs, as every further
iteration would repeat its state.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.functions.numeric import euclid, min_max
from filmgrain.operators.joins import with_scalars
from filmgrain.operators.selection import bottom_k, sample_rows, spread_key
from filmgrain.workspace import cut

Run = tuple[str, int]
Centroids = dict[int, tuple[float, float]]
ITERATIONS = 100
# 50 centroids x 9 values of k x 5 labels is 1,350; the plan carries no more than this.
MAX_CENTROIDS = 20_000
EXACT = "decimal(38,15)"


def features(title: DataFrame, min_votes: int = 10_000, kind: str = "movie") -> DataFrame:
    """(_id, x, y) of well-voted titles; scaled over all genres together."""
    base = title.where(
        (F.col("type") == kind) & (F.col("numVotes") >= min_votes)
        & F.col("startYear").isNotNull() & F.col("avgRatings").isNotNull()
    ).select(
        F.col("id").alias("_id"), F.col("startYear").cast("double").alias("sx"),
        F.col("avgRatings").cast("double").alias("sy"),
    )
    wide = with_scalars(
        base, x0=F.min("sx"), x1=F.max("sx"), y0=F.min("sy"), y1=F.max("sy")
    )
    c = F.col
    return wide.select(
        "_id", min_max(c("sx"), c("x0"), c("x1")).alias("x"),
        min_max(c("sy"), c("y0"), c("y1")).alias("y"),
    )


def labelled(feats: DataFrame, title_labels: DataFrame) -> DataFrame:
    """(label, _id, x, y): one row per title and label."""
    return title_labels.join(feats, "_id").select("label", "_id", "x", "y")


def weighted_points(feats: DataFrame) -> DataFrame:
    """Distinct points with their number of titles, written once.

    They are few, but each is measured against every centroid of every run, so they
    are spread over all cores.
    """
    points = feats.groupBy("label", "x", "y").agg(F.count("*").alias("w"))
    return cut(points.repartition(feats.sparkSession.sparkContext.defaultParallelism))


def initial(feats: DataFrame, label: str, k: int, seed: int = 0) -> Centroids:
    """``k`` sampled titles of one label, numbered from 1 in drawing order."""
    rows = sample_rows(feats.where(F.col("label") == label).drop("label"), k, "_id", seed)
    drawn = rows.select("x", "y", spread_key("_id", seed).alias("o"), "_id").collect()
    drawn.sort(key=lambda r: (r["o"], r["_id"]))
    return {i: (r["x"], r["y"]) for i, r in enumerate(drawn, 1)}


def initial_all(feats: DataFrame, sizes: dict[str, Iterable[int]], seed: int = 0) -> dict[Run, Centroids]:
    """Starts for many runs: one draw per label, whose first k rows start the run of size k."""
    sizes = {label: list(ks) for label, ks in sizes.items()}
    rows = bottom_k(feats, "label", "_id", {label: max(ks) for label, ks in sizes.items()}, seed).collect()
    return {(label, k): {r["rank"]: (r["x"], r["y"]) for r in rows if r["label"] == label and r["rank"] <= k}
            for label, ks in sizes.items() for k in ks}


def _runs_column(runs: dict[Run, Centroids]) -> Column:
    """The runs of the row's label, parsed once when the plan is optimised."""
    if sum(len(c) for c in runs.values()) > MAX_CENTROIDS:
        raise ValueError("too many centroids for one plan")
    by_label: dict[str, list] = {}
    for (label, k), cents in runs.items():
        by_label.setdefault(label, []).append(
            {"k": k, "c": [{"id": i, "x": x, "y": y} for i, (x, y) in sorted(cents.items())]}
        )
    kind = "map<string,array<struct<k:int,c:array<struct<id:int,x:double,y:double>>>>>"
    return F.element_at(F.from_json(F.lit(json.dumps(by_label)), kind), F.col("label"))


def assign(rows: DataFrame, runs: dict[Run, Centroids]) -> DataFrame:
    """Each row with ``k``, its ``cluster`` and its distance, once per run of its label.

    The closest centroid wins, the earlier one on a tie.
    """
    wide = rows.withColumn("_run", F.explode(_runs_column(runs)))
    return wide.selectExpr(
        "*", "transform(_run.c, c -> sqrt((x - c.x) * (x - c.x) + (y - c.y) * (y - c.y))) AS _d"
    ).selectExpr("*", "array_min(_d) AS _min").selectExpr(
        *rows.columns, "_run.k AS k",
        "element_at(_run.c, cast(array_position(_d, _min) AS int)).id AS cluster", "_min AS dist",
    )


def means(assigned: DataFrame) -> DataFrame:
    """Count and mean position per cluster of weighted rows."""
    total = "cast(sum(cast({0} AS decimal(18,15)) * cast(w AS decimal(15,0))) AS double) / sum(w) AS {0}"
    return assigned.groupBy("label", "k", "cluster").agg(
        F.expr("sum(w) AS n"), F.expr(total.format("x")), F.expr(total.format("y"))
    )


def replacements(feats: DataFrame, label: str, count: int, turn: int) -> list[tuple[float, float]]:
    """Points that take over for empty clusters in iteration ``turn``."""
    rows = feats.where(F.col("label") == label)
    drawn = rows.select("x", "y", spread_key("_id", turn).alias("o"), "_id").orderBy("o", "_id").limit(count)
    return [(r["x"], r["y"]) for r in drawn.collect()]


def advance(
    points: DataFrame, feats: DataFrame, runs: dict[Run, Centroids], turn: int
) -> dict[Run, Centroids]:
    """One iteration of every run. Only one row per cluster reaches the driver."""
    return _advance(points, feats, runs, turn)[0]


def _advance(points, feats, runs, turn) -> tuple[dict[Run, Centroids], set[Run]]:
    """The same, and the runs in which a cluster was empty."""
    refilled: set[Run] = set()
    moved: dict[Run, Centroids] = {run: {} for run in runs}
    for r in means(assign(points, runs)).collect():
        moved[(r["label"], r["k"])][r["cluster"]] = (r["x"], r["y"])
    drawn: dict[tuple[str, int], list] = {}
    for (label, k), cents in runs.items():
        empty = [c for c in sorted(cents) if c not in moved[(label, k)]]
        if empty:
            refilled.add((label, k))
            need = (label, len(empty))
            if need not in drawn:
                drawn[need] = replacements(feats, label, len(empty), turn)
            moved[(label, k)].update(zip(empty, drawn[need]))
    return moved, refilled


def fit(
    points: DataFrame, feats: DataFrame, runs: dict[Run, Centroids], iterations: int = ITERATIONS
) -> tuple[dict[Run, Centroids], dict[Run, Centroids]]:
    """(centroids before the last iteration, centroids after it) of every run.

    A run that did not move is left out from then on, unless a cluster was empty: its
    replacement is drawn anew each turn.
    """
    before, after = dict(runs), dict(runs)
    active = dict(runs)
    for turn in range(1, iterations + 1):
        if not active:
            break
        moved, refilled = _advance(points, feats, active, turn)
        for run, cents in moved.items():
            before[run], after[run] = active[run], cents
        active = {run: c for run, c in moved.items() if c != active[run] or run in refilled}
    return before, after


def inertia(
    points: DataFrame, before: dict[Run, Centroids], after: dict[Run, Centroids]
) -> DataFrame:
    """(label, k, sse): squared distance of each point to its cluster's final centroid.

    Points carry the assignment of the last iteration, centroids have moved after it.
    """
    hit = assign(points, before)
    final = F.filter(
        F.get(F.filter(_runs_column(after), lambda r: r["k"] == F.col("k")), F.lit(0))["c"],
        lambda c: c["id"] == F.col("cluster"),
    )
    c = F.get(final, F.lit(0))
    d = euclid(F.col("x"), F.col("y"), c["x"], c["y"])
    return hit.select("label", "k", (F.col("w") * d * d).alias("d2")).groupBy("label", "k").agg(
        F.sum(F.col("d2").cast(EXACT)).cast("double").alias("sse")
    )


def centroid_rows(spark: SparkSession, runs: dict[Run, Centroids]) -> DataFrame:
    """(label, k, cluster, x, y) as a frame."""
    rows = [(l, k, i, x, y) for (l, k), cs in runs.items() for i, (x, y) in sorted(cs.items())]
    return spark.createDataFrame(rows, "label string, k int, cluster int, x double, y double")


def elbow(feats: DataFrame, labels: Iterable[str], ks: Iterable[int] = range(10, 55, 5),
          iterations: int = ITERATIONS, seed: int = 0) -> DataFrame:
    """SSE curve for every label and k."""
    ks = list(ks)
    feats = cut(feats)
    points = weighted_points(feats)
    runs = initial_all(feats, {label: ks for label in labels}, seed)
    return inertia(points, *fit(points, feats, runs, iterations))


def best(feats: DataFrame, sizes: dict[str, int], members: int = 25,
         iterations: int = ITERATIONS, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For a fixed k per label: (centroids, first members of each cluster, label positions)."""
    feats = cut(feats)
    points = weighted_points(feats)
    runs = initial_all(feats, {label: [k] for label, k in sizes.items()}, seed)
    before, after = fit(points, feats, runs, iterations)
    from pyspark.sql import Window

    w = Window.partitionBy("label", "cluster").orderBy("_id")
    shown = (
        assign(feats, before).withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= members).select("label", "cluster", "rank", "_id", "x", "y")
    )
    place = shown.groupBy("label", "cluster").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    return centroid_rows(feats.sparkSession, after), shown, place
