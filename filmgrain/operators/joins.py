"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of a hot key are dealt, and the rows that make a key hot.
SALTS, HOT_ROWS = 16, 100_000


def join_salted(many: DataFrame, one: DataFrame, key: Sequence[str], how: str = "inner", salts: int = SALTS,
                rows: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``many`` joined to a narrow side that is unique by ``key``, each hot key in ``salts`` parts.

    Adaptive execution splits a skewed join of two fresh shuffles by itself; this is for
    sides that are grouped by the key already, where it cannot. Only keys with ``hot_rows`` rows or
    more are dealt and repeated, so both sides move once. There are at most as many of them as rows
    divided by ``hot_rows``, and they are broadcast. ``rows`` names the column of ``one`` that holds
    the number of rows of ``many``; without it they are counted, which combines before the shuffle.
    """
    counted = one if rows else many.groupBy(*key).agg(F.count("*").alias("_rows"))
    hot = F.broadcast(counted.where(F.col(rows or "_rows") >= hot_rows).select(*key, F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    parts = one.join(hot, list(key), "left").select(*one.columns, F.explode(spread).alias("_salt"))
    # rows without a key meet nothing and may lie anywhere
    apart = reduce(Column.__or__, [F.col(k).isNull() for k in key], F.col("_hot").isNotNull())
    salt = F.when(apart, F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int")).otherwise(0)
    dealt = many.join(hot, list(key), "left").select(*many.columns, salt.alias("_salt"))
    return dealt.join(parts, [*key, "_salt"], how).drop("_salt")


def theta_self(df: DataFrame, key: str, value: str, sizes: DataFrame, block: int) -> DataFrame:
    """Each unordered pair of rows with equal ``key`` once, as (key, value1 < value2).

    ``sizes`` holds the rows ``n`` of each key. Keys of more than ``block`` rows are dealt into parts by hash of the
    value, and their rows repeated for each two parts they belong to, so a key's pairs are formed in many places, about
    ``block`` rows of a part with as many of another. Rows of different parts meet where those two parts do and nowhere
    else. A key that is dealt has more than ``block`` rows, so there are at most as many as rows divided by ``block``,
    and they are broadcast.
    """
    hot = sizes.where(F.col("n") > block).select(key, F.ceil(F.col("n") / block).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = df.join(F.broadcast(hot), key, "left").select(
        key, value, F.pmod(F.xxhash64(value), parts).cast("int").alias("_part"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("_other"),
    )
    cells = dealt.select(key, F.least("_part", "_other").alias("_low"), F.greatest("_part", "_other").alias("_high"),
                         value, "_part")
    sides = [cells.withColumnsRenamed({value: f"{value}{i}", "_part": f"_part{i}"}) for i in (1, 2)]
    # merged, as a side small enough to be broadcast would leave pairs where their first row lies
    return sides[0].join(sides[1].hint("merge"), [key, "_low", "_high"]).where(
        (F.col(f"{value}1") < F.col(f"{value}2")) & ((F.col("_low") == F.col("_high")) | (F.col("_part1") != F.col("_part2")))
    ).select(key, f"{value}1", f"{value}2")


def with_label(links: DataFrame, dictionary: DataFrame, key: str, label: str) -> DataFrame:
    """Links plus the label their dictionary id stands for (inner)."""
    return links.join(dictionary.select(F.col("id").alias(key), label), key)


def encode_label(links: DataFrame, dictionary: DataFrame, label: str, key: str) -> DataFrame:
    """Replace a label by its dictionary id; labels outside the dictionary drop out."""
    return links.join(dictionary.select(F.col("id").alias(key), label), label).drop(label)


def with_parents(
    relation: DataFrame, left: DataFrame, left_key: str, right: DataFrame, right_key: str
) -> DataFrame:
    """Rows whose two parents exist: two semi joins, never a product of the parents."""
    l_ids = left.select(F.col("id").alias(left_key))
    r_ids = right.select(F.col("id").alias(right_key))
    return relation.join(l_ids, left_key, "left_semi").join(r_ids, right_key, "left_semi")


def known(df: DataFrame, parent: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    return df.join(parent.select(F.col(parent_key).alias(key)), key, "left_semi")


def unknown(df: DataFrame, parent: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    return df.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def with_scalars(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Every row plus global aggregates of the same frame, as a scalar subquery.

    The aggregates come from one one-row scan; no join is planned.
    """
    one = df.agg(F.struct(*[a.alias(n) for n, a in aggregates.items()]).alias("s")).scalar()
    out = df.withColumn("_s", one)
    return out.select(*df.columns, *[F.col(f"_s.{n}").alias(n) for n in aggregates])


def lookup_array(
    docs: DataFrame, foreign: DataFrame, local: str, out: str, doc_key: str = "_id"
) -> DataFrame:
    """Foreign rows whose ``_id`` is in the array ``local``, as an array, empty when none.

    A group of the collect is one document, so it holds no more than that
    document's own array did.
    """
    fields = [F.col(f"f.{c}").alias(c) for c in foreign.columns]
    hits = (
        docs.select(doc_key, F.explode(local).alias("_ref")).alias("d")
        .join(foreign.alias("f"), F.col("d._ref") == F.col("f._id"))
        .groupBy(f"d.{doc_key}")
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))
    )
    element = hits.schema[out].dataType
    return docs.join(hits, doc_key, "left").withColumn(
        out, F.coalesce(out, F.array().cast(element))
    )


def lookup_scalar(
    docs: DataFrame, foreign: DataFrame, local: str, out: str
) -> DataFrame:
    """Same with a single key; ``_id`` is unique, so the array has 0 or 1 entries."""
    entry = F.struct(*[F.col(f"f.{c}").alias(c) for c in foreign.columns])
    joined = docs.alias("d").join(
        foreign.alias("f"), F.col(f"d.{local}") == F.col("f._id"), "left"
    )
    empty = F.array().cast(_array_of(foreign))
    hit = F.when(F.col("f._id").isNotNull(), F.array(entry)).otherwise(empty)
    return joined.select("d.*", hit.alias(out))


def _array_of(df: DataFrame):
    from pyspark.sql import types as T

    return T.ArrayType(df.schema)


def attach_names(
    sets: DataFrame, names: DataFrame, columns: Sequence[str], key: str = "id", label: str = "name"
) -> DataFrame:
    """One name column per item column."""
    out = sets
    for col in columns:
        side = names.select(F.col(key).alias(col), F.col(label).alias(f"{col}_name"))
        out = out.join(side, col)
    return out
