"""Scaled features and k-means."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.operators import clusters
from filmgrain.operators.joins import with_label
from filmgrain.plans.registry import query
from filmgrain.workspace import cut

C = F.col
LABEL, K = "PROMO", 10
LABELS = ("ECONOMY", "LARGE", "PROMO", "SMALL", "STANDARD")
CURVE = range(10, 55, 5)
BEST = {"ECONOMY": 35, "LARGE": 30, "PROMO": 40, "SMALL": 30, "STANDARD": 50}
DIGITS = 5


def _sum(col: str) -> str:
    return f"sum(CAST({col} AS DECIMAL(18,15)) * w)::DOUBLE / sum(w)"


def views(sizes: list[tuple[str, int]], iterations: int) -> dict[str, str]:
    """SQL for the same runs; ``steps`` holds the centroids after every iteration."""
    runs = ", ".join(f"('{label}', {k})" for label, k in sizes)
    return {
        "scaled": """SELECT id AS _id, (startYear - min(startYear) OVER ()) / (max(startYear) OVER () - min(startYear) OVER ())::DOUBLE AS x,
            (avgRatings - min(avgRatings) OVER ()) / (max(avgRatings) OVER () - min(avgRatings) OVER ()) AS y
            FROM title WHERE type = 'movie' AND numVotes >= 10000 AND startYear IS NOT NULL AND avgRatings IS NOT NULL""",
        "feats": "SELECT genre AS label, _id, x, y FROM scaled JOIN title_genre ON titleid = _id JOIN genre ON genreid = genre.id",
        "pts": "SELECT label, x, y, count(*) AS w FROM feats GROUP BY label, x, y",
        "drawn": "SELECT label, x, y, row_number() OVER (PARTITION BY label ORDER BY md5(concat('0:', _id)), _id) AS c FROM feats",
        "init": f"SELECT r.label, r.k, c, x, y FROM (VALUES {runs}) r(label, k) JOIN drawn d ON d.label = r.label AND c <= r.k",
        "spare": f"""SELECT label, turn, x, y, row_number() OVER (PARTITION BY label, turn ORDER BY md5(concat(turn, ':', _id)), _id) AS pos
            FROM feats CROSS JOIN (SELECT unnest(range(1, {iterations + 1})) AS turn)
            QUALIFY pos <= 50""",
    }


STEPS = """WITH RECURSIVE step AS (
    SELECT 0 AS turn, label, k, c, x, y FROM init
    UNION ALL
    SELECT o.turn + 1, o.label, o.k, o.c, coalesce(o.nx, s.x), coalesce(o.ny, s.y) FROM
      (SELECT old.turn, old.label, old.k, old.c, m.x AS nx, m.y AS ny,
              row_number() OVER (PARTITION BY old.label, old.k, m.x IS NULL ORDER BY old.c) AS gap
       FROM (SELECT * FROM step WHERE turn < {iterations}) old LEFT JOIN
         (SELECT label, k, c, {mx} AS x, {my} AS y FROM
            (SELECT p.label, s.k, p.x, p.y, p.w, (min({{'d': sqrt((p.x-s.x)*(p.x-s.x) + (p.y-s.y)*(p.y-s.y)), 'c': s.c}})).c AS c
             FROM pts p JOIN (SELECT * FROM step WHERE turn < {iterations}) s ON s.label = p.label GROUP BY p.label, s.k, p.x, p.y, p.w)
          GROUP BY label, k, c) m
       ON m.label = old.label AND m.k = old.k AND m.c = old.c) o
      LEFT JOIN spare s ON o.nx IS NULL AND s.label = o.label AND s.turn = o.turn + 1 AND s.pos = o.gap)
"""


def steps(iterations: int) -> str:
    return STEPS.format(iterations=iterations, mx=_sum("x"), my=_sum("y"))


def sse_sql(iterations: int) -> str:
    return steps(iterations) + f"""SELECT a.label, CAST(a.k AS INTEGER) AS k, round(sum(a.w * ((a.x-f.x)*(a.x-f.x) + (a.y-f.y)*(a.y-f.y))), {DIGITS}) AS sse FROM
    (SELECT p.label, s.k, p.x, p.y, p.w, (min({{'d': sqrt((p.x-s.x)*(p.x-s.x) + (p.y-s.y)*(p.y-s.y)), 'c': s.c}})).c AS c
     FROM pts p JOIN step s ON s.label = p.label AND s.turn = {iterations - 1} GROUP BY p.label, s.k, p.x, p.y, p.w) a
    JOIN step f ON f.label = a.label AND f.k = a.k AND f.c = a.c AND f.turn = {iterations} GROUP BY a.label, a.k"""


ONE = views([(LABEL, K)], 100)


def labelled(v):
    tags = with_label(v.title_genre, v.genre, "genreid", "genre").select(
        C("titleid").alias("_id"), C("genre").alias("label")
    )
    return clusters.labelled(clusters.features(v.title), tags)


def start(v):
    feats = cut(labelled(v).where(C("label") == LABEL))
    return feats, {(LABEL, K): clusters.initial(feats, LABEL, K)}


@query("km_features", "SELECT _id, x, y FROM scaled", ONE)
def km_features(v):
    return clusters.features(v.title)


@query("km_init", "SELECT CAST(c AS INTEGER) AS cluster, x, y FROM init", ONE)
def km_init(v):
    _, runs = start(v)
    return clusters.centroid_rows(v.spark, runs).select("cluster", "x", "y")


@query("km_assign", f"""SELECT f._id, CAST((min({{'d': sqrt((f.x-s.x)*(f.x-s.x) + (f.y-s.y)*(f.y-s.y)), 'c': s.c}})).c AS INTEGER) AS cluster
    FROM feats f CROSS JOIN init s WHERE f.label = '{LABEL}' GROUP BY f._id""", ONE)
def km_assign(v):
    feats, runs = start(v)
    return clusters.assign(feats, runs).select("_id", "cluster")


@query("km_update", steps(1) + f"SELECT CAST(c AS INTEGER) AS cluster, round(x, {DIGITS}) AS x, round(y, {DIGITS}) AS y FROM step WHERE turn = 1", ONE)
def km_update(v):
    feats, runs = start(v)
    moved = clusters.advance(clusters.weighted_points(feats), feats, runs, 1)
    return rounded(clusters.centroid_rows(v.spark, moved))


def rounded(df):
    return df.select("cluster", F.round("x", DIGITS).alias("x"), F.round("y", DIGITS).alias("y"))


@query("km_run", steps(100) + f"SELECT CAST(c AS INTEGER) AS cluster, round(x, {DIGITS}) AS x, round(y, {DIGITS}) AS y FROM step WHERE turn = 100", ONE)
def km_run(v):
    feats, runs = start(v)
    _, after = clusters.fit(clusters.weighted_points(feats), feats, runs)
    return rounded(clusters.centroid_rows(v.spark, after))


@query("km_sse", sse_sql(2), views([(LABEL, K)], 2))
def km_sse(v):
    """After two iterations, while centroids still move."""
    feats, runs = start(v)
    points = clusters.weighted_points(feats)
    sse = clusters.inertia(points, *clusters.fit(points, feats, runs, 2))
    return sse.select("label", "k", F.round("sse", DIGITS).alias("sse"))


@query("km_elbow", sse_sql(100), views([(label, k) for label in LABELS for k in CURVE], 100))
def km_elbow(v):
    curve = clusters.elbow(labelled(v), LABELS, CURVE)
    return curve.select("label", "k", F.round("sse", DIGITS).alias("sse"))


@query("km_best", steps(100) + f"""SELECT a.label, CAST(a.c AS INTEGER) AS cluster, round(f.x, {DIGITS}) AS centre_x, round(f.y, {DIGITS}) AS centre_y,
    CAST(a.rank AS INTEGER) AS rank, a._id, round(a.x, {DIGITS}) AS x, round(a.y, {DIGITS}) AS y,
    round(avg(a.x) OVER (PARTITION BY a.label, a.c), {DIGITS}) AS label_x, round(avg(a.y) OVER (PARTITION BY a.label, a.c), {DIGITS}) AS label_y FROM
    (SELECT *, row_number() OVER (PARTITION BY label, c ORDER BY _id) AS rank FROM
      (SELECT p.label, p._id, p.x, p.y, (min({{'d': sqrt((p.x-s.x)*(p.x-s.x) + (p.y-s.y)*(p.y-s.y)), 'c': s.c}})).c AS c
       FROM feats p JOIN step s ON s.label = p.label AND s.turn = 99 GROUP BY p.label, p._id, p.x, p.y)) a
    JOIN step f ON f.label = a.label AND f.c = a.c AND f.turn = 100 WHERE a.rank <= 25""",
       views(list(BEST.items()), 100))
def km_best(v):
    """A row for each of the up to 25 members shown of a cluster, with its centroid and label position."""
    centres, shown, place = clusters.best(labelled(v), BEST)
    r = lambda c, n: F.round(c, DIGITS).alias(n)
    about = centres.select("label", "cluster", r("x", "centre_x"), r("y", "centre_y")).join(
        place.select("label", "cluster", r("x", "label_x"), r("y", "label_y")), ["label", "cluster"])
    return shown.select("label", "cluster", "rank", "_id", r("x", "x"), r("y", "y")).join(about, ["label", "cluster"])
