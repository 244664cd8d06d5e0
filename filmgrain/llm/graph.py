"""Connected components as DataFrames: hooking in a random order, then contraction.

Each round draws a new order of vertices by hash. A vertex points to the first among
itself and its neighbours, pointers are followed twice over (chains are short in a random
order), and edges are rewritten to what their ends point to. On a path about a third of
the vertices come before their neighbours and stay, elsewhere fewer, so rounds grow as
the logarithm of the vertices. In the end each component has one vertex left, and the
smallest id that leads there names it.

Each round's edges and labels are written to the shared folder; no vertex reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.workspace import stage_path


def stored(df: DataFrame) -> DataFrame:
    """Written and read again: unlike a checkpoint, a file carries no constraints on, which would double each round."""
    path = stage_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _follow(point: DataFrame) -> DataFrame:
    far = point.select(F.col("id").alias("to"), F.col("to").alias("far"))
    return point.join(far, "to", "left").select("id", F.coalesce("far", "to").alias("to"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); loops, copies and both directions may occur.

    Edges with a null end are left out, and so are ids that only have a loop.
    """
    pairs = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    both = lambda e: e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = stored(both(pairs).distinct())
    labels, turn = None, 0
    while not links.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        first = links.groupBy("a").agg(F.min(rank("b")).alias("low")).withColumn("own", rank("a"))
        point = first.select(F.col("a").alias("id"), F.least("own", "low").getField("v").alias("to"))
        point = stored(_follow(_follow(stored(point))))
        if labels is None:
            labels = point.select("id", F.col("to").alias("component"))
        else:
            labels = labels.join(point.withColumnRenamed("id", "component"), "component", "left").select(
                "id", F.coalesce("to", "component").alias("component"))
        labels = stored(labels)
        ends = links.filter("a < b")
        for side in ("a", "b"):
            ends = ends.join(point.withColumnRenamed("id", side), side).drop(side).withColumnRenamed("to", side)
        links = stored(both(ends.filter("a != b")).distinct())
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    names = stored(labels.groupBy("component").agg(F.min("id").alias("name")))
    return labels.join(names, "component").select("id", F.col("name").alias("component"))
