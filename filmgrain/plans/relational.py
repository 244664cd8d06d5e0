"""Queries over the normalised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrain.operators.joins import with_label


def differs_3vl(a: str, b: str, value: int) -> Column:
    """``a <> value OR b <> value``: a null side is unknown, the other may still decide."""
    return (F.col(a) != value) | (F.col(b) != value)


def missing_roles(title_actor: DataFrame, actor_title_role: DataFrame) -> DataFrame:
    """Title-actor pairs without any role."""
    pair = ["titleid", "actorid"]
    return title_actor.select(*pair).subtract(actor_title_role.select(*pair))


def missing_roles_stored(title_actor: DataFrame, actor_title_role: DataFrame) -> DataFrame:
    """The same from stored links, whose pairs are distinct and not null: an anti join keeps their layout."""
    pair = ["titleid", "actorid"]
    return title_actor.select(*pair).join(actor_title_role.select(*pair), pair, "left_anti")


def living_prefix(
    member: DataFrame, title_actor: DataFrame, title: DataFrame, prefix: str = "Phi", year: int = 2014
) -> DataFrame:
    """Living members by name prefix with a movie that starts or ends in another year."""
    m = member.where(F.col("name").startswith(prefix) & F.col("deathYear").isNull()).select(
        F.col("id").alias("member_id"), "name", "birthYear", "deathYear"
    )
    t = title.where((F.col("type") == "movie") & differs_3vl("startYear", "endYear", year))
    # names are the selective side, so the links meet them first
    cast = title_actor.join(m, F.col("actorid") == F.col("member_id"))
    return cast.join(t, F.col("titleid") == F.col("id")).select(
        "member_id", "name", "birthYear", "deathYear", "titleid", "actorid",
        F.col("id").alias("title_id"), "type", "title", "originalTitle", "startYear", "endYear",
        "runtime", "avgRatings", "numVotes",
    )


def genre_year_producers(
    member: DataFrame, title_producer: DataFrame, title: DataFrame, title_genre: DataFrame,
    genre: DataFrame, part_of_name: str = "Gill", year: int = 2017, kind: str = "Talk-Show",
    keep_count: bool = False,
) -> DataFrame:
    """Producers by part of name with titles of a genre in a year, most productive first."""
    m = member.where(F.col("name").contains(part_of_name)).select(
        F.col("id").alias("producerid"), "name"
    )
    t = title.where((F.col("startYear") == year) | (F.col("endYear") == year)).select(
        F.col("id").alias("titleid")
    )
    # a label is in its dictionary once, so its id can reach the scan of the links
    wanted = genre.where(F.col("genre") == kind).agg(F.max("id").alias("id")).scalar()
    tagged = title_genre.where(F.col("genreid") == wanted).select("titleid")
    counted = (
        # titles first: stored links lie by title, and few of them are left to meet the people
        title_producer.join(t, "titleid").join(tagged, "titleid").join(m, "producerid")
        .groupBy("name").agg(F.count("*").alias("total")).orderBy(F.desc("total"), "name")
    )
    return counted if keep_count else counted.select("name")


def longrun_producers(
    member: DataFrame, title_producer: DataFrame, title: DataFrame, minutes: int = 120
) -> DataFrame:
    """Living producers of long titles with their number of such titles."""
    m = member.where(F.col("deathYear").isNull()).select(F.col("id").alias("producerid"), "name")
    t = title.where(F.col("runtime") > minutes).select(F.col("id").alias("titleid"))
    # counted per producer before names come in: the join then carries one row per producer
    per_person = title_producer.join(t, "titleid").groupBy("producerid").agg(
        F.count("*").alias("n")
    )
    return (
        per_person.join(m, "producerid").groupBy("name")
        .agg(F.sum(F.when(F.col("name").isNotNull(), F.col("n")).otherwise(0)).alias("total"),
             F.sum("n").alias("_all"))
        .orderBy(F.desc("_all"), "name").select("name", "total")
    )


def role_pattern(
    member: DataFrame, actor_title_role: DataFrame, role: DataFrame,
    patterns: tuple[str, ...] = ("jesu%christ", "jesus"), exact: str = "christ",
) -> DataFrame:
    """Living actors of the roles whose lower-cased text matches, ordered by role."""
    text = F.lower("role")
    wanted = text == exact
    for p in patterns:
        wanted = wanted | text.like(p)
    roles = role.where(wanted).select(F.col("id").alias("roleid"), "role")
    m = member.where(F.col("deathYear").isNull()).select(F.col("id").alias("actorid"), "name")
    return (
        actor_title_role.join(roles, "roleid").join(m, "actorid").select("name", "role")
        .orderBy("role", "name")
    )


def credit_rows(
    member: DataFrame, links: DataFrame, title: DataFrame, person: str
) -> DataFrame:
    """member - link - title with all columns, each id under its own name."""
    m, t = member.withColumnRenamed("id", "member_id"), title.withColumnRenamed("id", "title_id")
    return links.join(t, F.col("titleid") == F.col("title_id")).join(
        m, F.col(person) == F.col("member_id")
    )


def producer_genre_rows(
    member: DataFrame, title_producer: DataFrame, title: DataFrame, title_genre: DataFrame,
    genre: DataFrame,
) -> DataFrame:
    """The five-way join behind the genre queries."""
    m = member.select(F.col("id").alias("producerid"), "name")
    t = title.select(F.col("id").alias("titleid"), "startYear")
    g = with_label(title_genre, genre, "genreid", "genre").select("titleid", "genre")
    return title_producer.join(t, "titleid").join(g, "titleid").join(m, "producerid")
