"""From raw dumps to the denormalised and the normalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.functions import text
from filmgrain.operators.joins import encode_label, known
from filmgrain.operators.keys import judge_links, split_first
from filmgrain.operators.selection import dense_ids
from filmgrain.operators.updates import update_ratings

PERSON_TABLES = {"ACTOR": "actors", "ACTRESS": "actors", "DIRECTOR": "directors",
                 "WRITER": "writers", "PRODUCER": "producers"}
CATEGORY_ROUTES = [("ACT", "actors"), ("DIRECT", "directors"), ("WRITE", "writers"), ("PROD", "producers")]
CATEGORIES = {"actor": ("actor", "actress"), "director": ("director",),
              "writer": ("writer",), "producer": ("producer",)}


# denormalised tables

def movies(basics: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(non-adult movies with three genre slots, ratings merged in; lines whose id an earlier line has).

    ``basics`` comes with its position: of the lines of an id the first stays, as in a keyed
    insert in file order.
    """
    rows = basics.where((F.col("titleType") == "movie") & (F.col("isAdult") == "0")).select(
        text.strip_prefix("tconst").alias("title_id"),
        F.col("primaryTitle").alias("primary_title"), F.col("originalTitle").alias("original_title"),
        F.col("startYear").try_cast("int").alias("release_year"),
        F.col("runtimeMinutes").try_cast("int").alias("runtime_minutes"),
        *text.fixed_slots("genres", ["genre_one", "genre_two", "genre_three"]),
        F.lit(None).cast("decimal(3,1)").alias("ratings"), F.lit(None).cast("bigint").alias("votes"), "_pos",
    )
    unique, repeated = split_first(rows, ["title_id"])
    scores = ratings.select(
        text.strip_prefix("tconst").alias("title_id"),
        F.col("averageRating").try_cast("decimal(3,1)").alias("ratings"),
        F.col("numVotes").try_cast("bigint").alias("votes"),
    )
    return update_ratings(unique, scores), repeated


def profession_rows(names: DataFrame) -> DataFrame:
    """One row per person and profession that has a table, with its ``target``; a position is kept."""
    first, last = text.split_name("primaryName")
    jobs = text.drop_second_acting_entry(text.upper_list(text.split_list("primaryProfession")))
    target = F.lit(None).cast("string")
    for job, table in PERSON_TABLES.items():
        target = F.when(F.col("job") == job, F.lit(table)).otherwise(target)
    return (
        names.select(
            text.strip_prefix("nconst").alias("id"), first.alias("first_name"), last.alias("last_name"),
            F.col("birthYear").try_cast("int").alias("birth_year"),
            F.col("deathYear").try_cast("int").alias("death_year"),
            F.explode(jobs).alias("job"), *[c for c in names.columns if c == "_pos"],
        )
        .withColumn("target", target).where(F.col("target").isNotNull()).drop("job")
    )


def people(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all person tables as one frame with ``target``, unique on (target, id); lines that came later)."""
    return split_first(profession_rows(names), ["target", "id"])


def person_table(people_rows: DataFrame, target: str) -> DataFrame:
    return people_rows.where(F.col("target") == target).drop("target")


def movie_ids(basics: DataFrame) -> DataFrame:
    """Ids of the movie table; enough where a link only has to know its title exists."""
    return basics.where((F.col("titleType") == "movie") & (F.col("isAdult") == "0")).select(
        text.strip_prefix("tconst").alias("title_id")
    )


def crew_rows(crew: DataFrame) -> DataFrame:
    """(target, title_id, person_id) for every listed director and writer."""
    lists = "stack(2, 'directors', directors, 'writers', writers) AS (target, ids)"
    return (
        crew.select(text.keep_digits("tconst").try_cast("bigint").alias("title_id"), F.expr(lists))
        .select("target", "title_id", F.explode(text.split_list(text.keep_digits("ids"))).alias("p"))
        .where("p <> ''")
        .select("target", "title_id", F.col("p").try_cast("bigint").alias("person_id"))
    )


def principal_rows(principals: DataFrame) -> DataFrame:
    """The same from principals, routed by the first category marker that occurs."""
    return principals.select(
        text.first_match("category", CATEGORY_ROUTES).alias("target"),
        text.keep_digits("tconst").try_cast("bigint").alias("title_id"),
        text.keep_digits("nconst").try_cast("bigint").alias("person_id"),
    ).where(F.col("target").isNotNull())


def known_links(rows: DataFrame, movies_: DataFrame, people_: DataFrame) -> DataFrame:
    """Links with ``outcome`` and ``copies``: kept once where the movie is known and the person is in the target's table.

    Rows of several dumps are stacked before this, so parents are joined once.
    """
    persons = people_.select("target", F.col("id").alias("person_id"))
    parents = {"title": (movies_, ["title_id"]), "person": (persons, ["target", "person_id"])}
    return judge_links(rows, parents, ["target", "title_id", "person_id"])


# normalised tables

def titles(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Titles and ratings, each kept without the other; adult flag and genres dropped; a position is kept."""
    return basics.join(ratings, "tconst", "full_outer").select(
        text.id_number("tconst", "tt").alias("id"), F.col("titleType").alias("type"),
        F.col("primaryTitle").alias("title"), "originalTitle",
        F.col("startYear").try_cast("int").alias("startYear"),
        F.col("endYear").try_cast("int").alias("endYear"),
        text.to_number("runtimeMinutes").try_cast("int").alias("runtime"),
        F.col("averageRating").try_cast("decimal(3,1)").alias("avgRatings"),
        text.to_number("numVotes").alias("numVotes"), *[c for c in basics.columns if c == "_pos"],
    )


def genres(basics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(genre dictionary, title-genre links)."""
    rows = basics.select(
        text.id_number("tconst", "tt").alias("titleid"),
        F.explode(text.split_list("genres")).alias("genre"),
    ).withColumn("genre", text.null_if_blank("genre")).where("genre IS NOT NULL")
    dictionary = dense_ids(rows, "genre")
    return dictionary, encode_label(rows, dictionary, "genre", "genreid").select("titleid", "genreid")


def members(names: DataFrame) -> DataFrame:
    return names.select(
        text.id_number("nconst", "nm").alias("id"), F.col("primaryName").alias("name"),
        F.col("birthYear").try_cast("int").alias("birthYear"),
        F.col("deathYear").try_cast("int").alias("deathYear"), *[c for c in names.columns if c == "_pos"],
    )


def principal_links(principals: DataFrame) -> DataFrame:
    """Distinct (link, titleid, person), ``link`` being the table of the exact category; one pass for all tables."""
    return principals.select(
        text.exact_match("category", CATEGORIES).alias("link"),
        text.id_number("tconst", "tt").alias("titleid"), text.id_number("nconst", "nm").alias("person"),
    ).where("link IS NOT NULL").distinct()


def role_rows(principals: DataFrame) -> DataFrame:
    """(titleid, actorid, role): one row per listed character."""
    return principals.where(F.col("category").isin(*CATEGORIES["actor"])).select(
        text.id_number("tconst", "tt").alias("titleid"), text.id_number("nconst", "nm").alias("actorid"),
        F.explode(text.split_list(text.strip_chars("characters"))).alias("role"),
    ).withColumn("role", text.null_if_blank("role")).where("role IS NOT NULL")


def roles(principals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(role dictionary, actor-title-role links)."""
    rows = role_rows(principals)
    dictionary = dense_ids(rows, "role")
    links = encode_label(rows, dictionary, "role", "roleid")
    return dictionary, links.select("titleid", "actorid", "roleid")


def valid_links(links: DataFrame, title: DataFrame, member: DataFrame, person: str) -> DataFrame:
    return known(known(links, title, "titleid"), member, person)
