"""Choosing rows: distinct, first of a key, ranking, surrogate keys, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmgrain.workspace import cut


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest row of each key by ``order``, then by the remaining columns.

    An aggregate of structs combines before the shuffle, so a key holding most rows
    costs one row per map task; a window would sort them all in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*key).agg(best).select(*[
        F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns
    ])


def top_per_group(df: DataFrame, group: str, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of each group; Spark limits each group before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def dense_ids(labels: DataFrame, label: str, out: str = "id", start: int = 0) -> DataFrame:
    """Consecutive ids in label order for the distinct non-null labels.

    Labels are range-sorted over all tasks and written once; a row's id is its place
    in its partition plus the sizes of the partitions before it. Only one row per
    partition is gathered.
    """
    spark = labels.sparkSession
    ordered = cut(
        labels.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label)
        .withColumn("_m", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("_m", 33)
    place = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("p")).count().orderBy("p").collect()
    total, offsets = start, []
    for row in sizes:
        offsets.append((row["p"], total))
        total += row["count"]
    if not offsets:
        return ordered.select(F.lit(None).cast("bigint").alias(out), label).limit(0)
    base = spark.createDataFrame(offsets, "_p bigint, _base bigint")
    return ordered.join(F.broadcast(base), part == F.col("_p")).select(
        (F.col("_base") + place).alias(out), label
    )


def spread_key(col: str, seed: int) -> Column:
    """A fixed pseudo-random order over ids: an md5 of seed and id, alike in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(col).cast("string")))


def sample_rows(df: DataFrame, k: int, key: str | None = None, seed: int = 0) -> DataFrame:
    """``k`` sampled rows. With ``key`` the draw depends on the ids and the seed only."""
    order = [spread_key(key, seed), F.col(key)] if key else [F.rand(seed)]
    return df.orderBy(*order).limit(k)


def bottom_k(df: DataFrame, group: str, key: str, sizes: dict, seed: int = 0) -> DataFrame:
    """The rows of each group with the ``sizes[group]`` smallest hashes, ranked from 1; all groups in one job.

    Spark keeps the first rows of each group per task before the shuffle, so what is moved
    grows with tasks and samples and not with the data. Groups without a size are left out.
    """
    most = F.lit(None).cast("int")
    for name, k in sizes.items():
        most = F.when(F.col(group) == F.lit(name), F.lit(k)).otherwise(most)
    w = Window.partitionBy(group).orderBy(spread_key(key, seed), F.col(key))
    ranked = df.where(F.col(group).isin(*sizes)).withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= max(sizes.values(), default=0)).where(F.col("rank") <= most)


def groups_with_repeats(df: DataFrame, group: str, pair: Sequence[str]) -> DataFrame:
    """Groups in which some ``pair`` occurs more than once."""
    return df.groupBy(*pair).count().where("count > 1").select(group).distinct()


def without_repeats(df: DataFrame, group: str, pair: Sequence[str]) -> DataFrame:
    """Rows of the groups in which no ``pair`` repeats; a group with most rows is dealt into parts."""
    from filmgrain.operators.joins import join_salted

    counted = df.groupBy(*pair).agg(F.count("*").alias("n"))
    bad = counted.groupBy(group).agg(F.bool_or(F.col("n") > 1).alias("bad")).where("bad").select(group)
    return join_salted(df, bad, [group], "left_anti")
