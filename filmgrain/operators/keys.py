"""Key, reference and length checks, and loading that keeps what fails them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrain.operators.joins import join_salted, with_parents
from filmgrain.workspace import cut


def _best(counted: DataFrame, key: Sequence[str], order: Column) -> DataFrame:
    """The first of each key's counted rows, how many differ (``_rows``), and how many there are with copies (``_copies``)."""
    return counted.groupBy(*key).agg(F.min(order).alias("_best"), F.count("*").alias("_rows"), F.sum("_n").alias("_copies"))


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def split_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(the first row of each key by ``order``, the rows that lost).

    Equal lost rows come once, with their number in ``copies``, so a key that repeats
    endlessly is counted before any shuffle.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    whole = F.struct(*order, *rest)
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    best = _best(counted, key, whole)
    winners = best.select(*[
        F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns
    ])
    left = F.col("_n") - F.when(whole.eqNullSafe(F.col("_best")), 1).otherwise(0)
    several = best.where("_copies > 1").select(*key, "_best", "_rows")
    losers = join_salted(counted, several, key, rows="_rows").withColumn("copies", left).where("copies > 0")
    return winners, losers.select(*df.columns, "copies")


def split_first(df: DataFrame, key: Sequence[str], position: str = "_pos") -> tuple[DataFrame, DataFrame]:
    """(the first row of each key in file order, the rows that lost), both without ``position``.

    Equal lost rows come once, with their number in ``copies``: a key that repeats endlessly
    with few different rows is counted on the map side.
    """
    rest = [c for c in df.columns if c not in key and c != position]
    counted = df.groupBy(*key, *rest).agg(F.count("*").alias("_n"), F.min(position).alias(position))
    whole = F.struct(position, *rest)
    best = _best(counted, key, whole)
    columns = [c for c in df.columns if c != position]
    winners = best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in columns])
    left = F.col("_n") - F.when(F.col(position) == F.col("_first"), 1).otherwise(0)
    several = best.where("_copies > 1").select(*key, F.col(f"_best.{position}").alias("_first"), "_rows")
    losers = join_salted(counted, several, key, rows="_rows").withColumn("copies", left).where("copies > 0")
    return winners, losers.select(*columns, "copies")


def judge_links(
    rows: DataFrame, parents: Mapping[str, tuple[DataFrame, Sequence[str]]], key: Sequence[str]
) -> DataFrame:
    """Distinct links with ``outcome`` and ``copies``: ``kept`` once, further copies as ``repeated``, and links
    with an unknown parent under ``unknown <name>``, the first that is missing.

    ``parents`` maps a name to (rows of known parents, the link's columns that hold its key).
    Links are counted before parents are looked up, so a link that comes endlessly is one row.
    """
    judged = rows.groupBy(*key).agg(F.count("*").alias("_n"))
    fault = F.lit(None).cast("string")
    for name, (known_rows, columns) in parents.items():
        have = known_rows.select(*columns).distinct().withColumn(f"_has_{name}", F.lit(True))
        judged = judged.join(have, list(columns), "left")
    for name in reversed(parents):
        fault = F.when(F.col(f"_has_{name}").isNull(), F.lit(f"unknown {name}")).otherwise(fault)
    one = F.lit(1).cast("bigint")
    told = lambda outcome, copies: F.struct(outcome.alias("outcome"), copies.alias("copies"))
    kept = told(F.lit("kept"), one)
    outcomes = F.when(fault.isNotNull(), F.array(told(fault, F.col("_n")))).when(
        F.col("_n") > 1, F.array(kept, told(F.lit("repeated"), F.col("_n") - 1))).otherwise(F.array(kept))
    return judged.select(*key, F.explode(outcomes).alias("_o")).select(*key, "_o.outcome", "_o.copies")


def split_reference(
    df: DataFrame, parent: DataFrame, key: str, parent_key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(rows whose parent exists, the others)."""
    ids = parent.select(F.col(parent_key).alias(key))
    return df.join(ids, key, "left_semi"), df.join(ids, key, "left_anti")


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than declared, naming the column."""
    hits = [
        F.when(F.length(c) > n, F.struct(F.lit(c).alias("column"), F.length(c).alias("length")))
        for c, n in limits.items()
    ]
    return df.withColumn("_hit", F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull()))).select(
        *df.columns, "_hit.column", "_hit.length"
    )


def split_new(
    df: DataFrame, target: DataFrame, key: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Insert that skips key clashes: (rows to append, rows skipped with reason and copies)."""
    winners, losers = split_key(df, key, order)
    have = target.select(*key)
    fresh = winners.join(have, list(key), "left_anti")
    present = winners.join(have, list(key), "left_semi")
    rejected = losers.withColumn("reason", F.lit("repeated key")).unionByName(
        present.select("*", F.lit(1).cast("bigint").alias("copies"), F.lit("key exists").alias("reason"))
    )
    return fresh, rejected


def settle(*frames: DataFrame) -> tuple[DataFrame, ...]:
    return tuple(cut(f) for f in frames)


def load_relation(
    staged: DataFrame, target: DataFrame, left: DataFrame, left_key: str,
    right: DataFrame, right_key: str,
) -> DataFrame:
    """Staged pairs to insert: distinct, both parents known, not stored yet."""
    pair = [left_key, right_key]
    fresh = staged.select(*pair).dropDuplicates(pair)
    valid = with_parents(fresh, left, left_key, right, right_key)
    return valid.join(target.select(*pair), pair, "left_anti")


def load_triples(
    staged: DataFrame, target: DataFrame, pairs: DataFrame, pair: Sequence[str],
    dictionary: DataFrame, third: str,
) -> DataFrame:
    """Same for triples: the pair must be a stored pair, the third a dictionary id."""
    key = [*pair, third]
    fresh = staged.select(*key).dropDuplicates(key)
    valid = fresh.join(pairs.select(*pair), list(pair), "left_semi").join(
        dictionary.select(F.col("id").alias(third)), third, "left_semi"
    )
    return valid.join(target.select(*key), key, "left_anti").select(*key)


def insert_batch(batch: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """The whole batch, or nothing when any key repeats or is already stored."""
    inner = key_counts(batch, key).select(*key)
    outer = batch.join(target.select(*key), list(key), "left_semi").select(*key)
    clashes = inner.unionByName(outer).limit(1).agg(F.count("*").alias("n")).scalar()
    return batch.where(clashes == 0)
