"""Partial updates from enrichment records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.functions.text import drop_markers
from filmgrain.operators.selection import first_per_key

VALUES = ("currency_type", "cost", "distributor", "box_office_revenue", "film_rating")


def rename_enrichment(lines: DataFrame) -> DataFrame:
    return lines.withColumnsRenamed(schemas.ENRICHMENT_FIELDS)


def typed(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {c: F.col(c).try_cast("double") for c in ("cost", "box_office_revenue")}
    )


def by_id(records: DataFrame) -> DataFrame:
    """Records usable by title id: a readable number, not a person; the first of each number.

    Spellings of one number are one id; ids that are no number count as missing.
    """
    usable = records.withColumn("_id", title_number("_id")).where(F.col("_id").isNotNull()).drop("title")
    return typed(first_per_key(usable, ["_id"], ["_pos"])).drop("_pos")


def title_number(column: str) -> Column:
    """The number of a title id; null for people and for what is no number."""
    text = drop_markers(column, "tt")
    return F.when(~F.col(column).contains("nm"), text.try_cast("bigint"))


def by_title(records: DataFrame) -> DataFrame:
    """Records usable by title text, first per title."""
    usable = records.where(F.col("title").isNotNull()).drop("_id")
    return typed(first_per_key(usable, ["title"], ["_pos"])).drop("_pos")


def informative(updates: DataFrame, values: Sequence[str] = VALUES) -> DataFrame:
    """Updates with something beyond the key."""
    filled = [F.col(c).isNotNull().cast("int") for c in values]
    total = filled[0]
    for f in filled[1:]:
        total = total + f
    return updates.where(total > 0)


def _merged(docs: DataFrame, joined: DataFrame, values: Sequence[str]) -> DataFrame:
    keep = [F.col(f"d.{c}").alias(c) for c in docs.columns if c not in values]
    new = [
        (F.coalesce(f"u.{c}", f"d.{c}") if c in docs.columns else F.col(f"u.{c}")).alias(c)
        for c in values
    ]
    return joined.select(*keep, *new)


def replace_by_id(docs: DataFrame, new: DataFrame, key: str = "_id") -> DataFrame:
    """Documents whose key is among ``new`` give way to it, as wholes; other new ones are left out."""
    ids = docs.select(key)
    return docs.join(new.select(key), key, "left_anti").unionByName(new.join(ids, key, "left_semi"))


def set_by_id(docs: DataFrame, updates: DataFrame, values: Sequence[str] = VALUES) -> DataFrame:
    """Documents with the non-null fields of their update set."""
    joined = docs.alias("d").join(updates.alias("u"), F.col("d._id") == F.col("u._id"), "left")
    return _merged(docs, joined, values)


def set_by_title(docs: DataFrame, updates: DataFrame, values: Sequence[str] = VALUES) -> DataFrame:
    """Same by title; of the documents sharing a title only the smallest ``_id`` changes.

    The chosen document is resolved on the update side, so the documents join once,
    on their unique ``_id``.
    """
    return set_by_id(docs, by_chosen_id(docs, updates), values)


def latest_ratings(ratings: DataFrame, key: str = "title_id") -> DataFrame:
    """One rating a movie: the last by ``_pos``, and without positions the one with most votes, then the best."""
    order = ["_pos"] if "_pos" in ratings.columns else ["votes", "ratings"]
    last = ratings.groupBy(key).agg(F.max(F.struct(*order, *[
        c for c in ratings.columns if c not in (key, *order)])).alias("_r")).select(key, "_r.*").drop("_pos")
    return last


def set_ratings(movies: DataFrame, latest: DataFrame, key: str = "title_id") -> DataFrame:
    """Ratings and votes of matching movies replaced, the others untouched; each movie stays one row."""
    joined = movies.alias("d").join(latest.alias("u"), key, "left")
    return joined.select(*[
        F.coalesce(f"u.{c}", f"d.{c}").alias(c) if c in ("ratings", "votes")
        else (F.col(c) if c == key else F.col(f"d.{c}").alias(c))
        for c in movies.columns
    ])


def update_ratings(movies: DataFrame, ratings: DataFrame, key: str = "title_id") -> DataFrame:
    return set_ratings(movies, latest_ratings(ratings, key), key)


def by_chosen_id(docs: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates by title under the ``_id`` they change: the smallest of the documents that share the title."""
    chosen = (
        docs.join(updates.select("title"), "title", "left_semi")
        .groupBy("title").agg(F.min("_id").alias("_id"))
    )
    return updates.join(chosen, "title").drop("title")


def report(records: DataFrame, updates: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """One row of counts: with and without key, repeats, no information, to update, matched."""
    text = F.col(key)
    number = text if key == "title" else title_number(key)
    person = F.lit(False) if key == "title" else F.coalesce(text.contains("nm"), F.lit(False))
    # a row per key with its number of records, rows without a key apart, updates and documents stacked on
    none = F.lit(0).cast("bigint")
    zero = {c: none.alias(c) for c in ("records", "unkeyed", "person", "empty", "useful", "docs")}
    kind = docs.schema[key].dataType
    part = lambda df, k, **own: df.select(k.cast(kind).alias("k"), *[
        own[c].cast("bigint").alias(c) if c in own else zero[c] for c in zero])
    filled = F.coalesce(*[F.col(c).cast("string") for c in VALUES]).isNotNull()
    stacked = part(records, number, records=number.isNotNull(), unkeyed=number.isNull(), person=person).unionByName(
        part(updates, F.col(key), empty=~filled, useful=filled)).unionByName(part(docs, F.col(key), docs=F.lit(True)))
    by_key = stacked.groupBy("k").agg(*[F.sum(c).alias(c) for c in zero])
    known = F.col("docs") > 0
    return by_key.agg(
        F.coalesce(F.sum("records"), none).alias("with_key"), F.coalesce(F.sum("unkeyed"), none).alias("without_key"),
        F.coalesce(F.sum("person"), none).alias("person_key"),
        F.count_if(F.col("records") > 1).alias("repeated_keys"), F.coalesce(F.sum("empty"), none).alias("no_information"),
        F.coalesce(F.sum("useful"), none).alias("to_update"),
        F.coalesce(F.sum(F.when(known, F.col("useful"))), none).alias("matched"),
        F.coalesce(F.sum(F.when(~known, F.col("useful"))), none).alias("unmatched"))
