"""Nested title documents: building them, matching on their arrays, JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTS = {"genres": "string", "director_id": "bigint", "writer_id": "bigint", "producer_id": "bigint"}


def group_list(links: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """(key, sorted list of values); the list is the group's by definition."""
    return links.groupBy(key).agg(F.sort_array(F.collect_list(value)).alias(out))


def cast_entries(cast: DataFrame, roles: DataFrame, role: DataFrame) -> DataFrame:
    """(titleid, actorid, role list): one row per cast member, null list without a role.

    Cast rows and role rows are stacked and grouped once. Roles of somebody who is
    not in the cast list drop out.
    """
    labels = roles.join(role.select(F.col("id").alias("roleid"), "role"), "roleid").select(
        "titleid", "actorid", "role", F.lit(False).alias("listed")
    )
    listed = cast.select("titleid", "actorid", F.lit(None).cast("string").alias("role"),
                         F.lit(True).alias("listed"))
    grouped = listed.unionByName(labels).groupBy("titleid", "actorid").agg(
        F.sort_array(F.collect_list("role")).alias("role"), F.bool_or("listed").alias("listed")
    )
    return grouped.where("listed").select(
        "titleid", "actorid", F.when(F.size("role") > 0, F.col("role")).alias("role")
    )


def assemble(
    title: DataFrame, lists: Mapping[str, DataFrame],
    cast: tuple[DataFrame, DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """One document per title.

    ``lists`` maps an array field to its (titleid, value) links; ``cast`` holds the
    title-actor links, the actor-title-role links and the role dictionary. Title rows
    and all links are stacked and grouped by title in a single shuffle. Missing lists
    are null.
    """
    base = title.withColumnsRenamed({"avgRatings": "avgRating", "id": "_id"})
    own = [c for c in base.columns if c != "_id"]
    own_type = base.select(F.struct(*own).alias("o")).schema["o"].dataType.simpleString()
    slots = {n: LISTS[n] for n in lists}
    stacked = {n: links.toDF("_id", "_value") for n, links in lists.items()}
    if cast is not None:
        slots["actors"] = "struct<actor:bigint,role:array<string>>"
        stacked["actors"] = cast_entries(*cast).selectExpr("titleid AS _id", "struct(actorid AS actor, role) AS _value")
    heads = base.selectExpr("_id", f"struct({', '.join(own)}) AS _own",
                            *[f"cast(NULL AS {t}) AS _{m}" for m, t in slots.items()])
    rows = [heads] + [df.selectExpr(
        "_id", f"cast(NULL AS {own_type}) AS _own",
        *[f"cast({'_value' if m == n else 'NULL'} AS {t}) AS _{m}" for m, t in slots.items()],
    ) for n, df in stacked.items()]
    out = reduce(DataFrame.unionByName, rows).groupBy("_id").agg(
        F.max("_own").alias("_own"),
        *[F.expr(f"sort_array(collect_list(_{n})) AS {n}") for n in slots],
    )
    return out.where("_own IS NOT NULL").selectExpr(
        "_id", "_own.*", *[f"CASE WHEN size({n}) > 0 THEN {n} END AS {n}" for n in slots]
    )


def heads(docs: DataFrame) -> DataFrame:
    """The titles of the documents, one row each, under the names of the normalised table."""
    lists = [f.name for f in docs.schema if f.dataType.typeName() == "array"]
    return docs.drop(*lists).withColumnsRenamed(
        {"_id": "id", "avgRating": "avgRatings"}
    )


def links(docs: DataFrame, field: str, out: str) -> DataFrame:
    """(titleid, value) for every entry of an array field."""
    return docs.select(F.col("_id").alias("titleid"), F.explode(field).alias(out))


def cast_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((titleid, actorid), (titleid, actorid, role)) from the actors of the documents."""
    entry = docs.select(F.col("_id").alias("titleid"), F.explode("actors").alias("a")).select(
        "titleid", F.col("a.actor").alias("actorid"), F.col("a.role").alias("role")
    )
    return entry.drop("role"), entry.withColumn("role", F.explode("role"))


def unwind(docs: DataFrame, field: str) -> DataFrame:
    """One row per element; documents with a missing or empty array drop out.

    A field that is no array is passed through, without its nulls.
    """
    if docs.schema[field].dataType.typeName() != "array":
        return docs.where(F.col(field).isNotNull())
    return docs.withColumn(field, F.explode(field))


def any_equals(array: str, field: str, value) -> Column:
    return F.exists(array, lambda e: e[field] == F.lit(value))


def any_matches(array: str, field: str, pattern: str) -> Column:
    return F.exists(array, lambda e: e[field].rlike(pattern))


def any_null(array: str, field: str) -> Column:
    """Some element lacks ``field``; an empty array has no such element."""
    return F.exists(array, lambda e: e[field].isNull())


def to_json_document(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """JSON text of each row without its null keys."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("doc"))
