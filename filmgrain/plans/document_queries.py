"""Queries and reports over title documents.

They take titles and (titleid, value) links: from the normalised tables, or from
documents through ``documents.heads`` and ``documents.links``. An array of a document
is only looked at element by element here, so it is never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def producers_with_many(
    title: DataFrame, genres: DataFrame, producers: DataFrame, member: DataFrame,
    year: int = 2017, kind: str = "Talk-Show", pattern: str = ".*Gill.*", least: int = 50,
) -> DataFrame:
    """Producers by name pattern with at least ``least`` titles of a genre and year."""
    period = title.where(F.col("startYear") == year).select(F.col("id").alias("titleid"))
    tagged = genres.where(F.col("genre") == kind).select("titleid")
    named = member.where(F.col("name").rlike(pattern)).select(F.col("id").alias("producerid"), "name")
    return (
        producers.join(named, "producerid").join(period, "titleid").join(tagged, "titleid")
        .groupBy(F.col("producerid").alias("_id"))
        .agg(F.min("name").alias("name"), F.count("*").alias("count"))
        .where(F.col("count") >= least)
    )


def writer_average(
    title: DataFrame, writers: DataFrame, member: DataFrame, pattern: str = ".*Bhardwaj.*",
    kind: str = "movie",
) -> DataFrame:
    """Mean runtime of movies with a writer matching the pattern and a living writer.

    The two writers need not be the same person. No such movie, no row.
    """
    movies = title.where(F.col("type") == kind).select(F.col("id").alias("titleid"), "runtime")
    people = member.select(
        F.col("id").alias("writerid"), F.col("name").rlike(pattern).alias("named"),
        F.col("deathYear").isNull().alias("living"),
    ).where("named OR living")
    per_title = (
        writers.join(movies, "titleid").join(people, "writerid").groupBy("titleid")
        .agg(F.bool_or("named").alias("named"), F.bool_or("living").alias("living"),
             F.max("runtime").alias("runtime"))
    )
    return per_title.where("named AND living").groupBy(
        F.lit(None).cast("string").alias("_id")
    ).agg(F.avg("runtime").alias("avgRuntime"))


def longrun_producer_sets(
    title: DataFrame, producers: DataFrame, member: DataFrame, minutes: int = 120
) -> DataFrame:
    """Long titles with a living producer, counted per set of producers.

    The set itself is the key, so it is built, one array for each title.
    """
    long = title.where(F.col("runtime") >= minutes).select(F.col("id").alias("titleid"))
    people = member.select(F.col("id").alias("producerid"), "name", "deathYear")
    sets = (
        producers.join(long, "titleid").join(people, "producerid").groupBy("titleid")
        .agg(F.array_sort(F.collect_list(F.struct("producerid", "name"))).alias("known"),
             F.bool_or(F.col("deathYear").isNull()).alias("living"))
        .where("living")
    )
    return (
        sets.groupBy(F.col("known.producerid").alias("producers"))
        .agg(F.min("known.name").alias("name"), F.count("*").alias("count"))
        .orderBy(F.desc("count"), "producers")
    )


def director_actor(
    title: DataFrame, genres: DataFrame, directors: DataFrame, cast: DataFrame, roles: DataFrame,
    member: DataFrame, kind: str, director: str, actor: str,
) -> DataFrame:
    """Titles of a genre by one named director with one named actor, one row per match.

    ``roles`` is (titleid, actorid, role).
    """
    tagged = genres.where(F.col("genre") == kind).select("titleid")
    by = member.where(F.col("name") == director).select(F.col("id").alias("directorid"))
    directed = directors.join(by, "directorid", "left_semi").select("titleid")
    named = member.where(F.col("name") == actor).select(F.col("id").alias("actorid"), "name")
    hits = (
        cast.join(named, "actorid").join(directed, "titleid", "left_semi")
        .join(tagged, "titleid", "left_semi")
    )
    # roles of the matching cast entries only
    played = roles.join(hits.select("titleid", "actorid"), ["titleid", "actorid"], "left_semi")
    lists = played.groupBy("titleid", "actorid").agg(F.sort_array(F.collect_list("role")).alias("role"))
    own = title.select(F.col("id").alias("titleid"), "title", "startYear")
    return (
        hits.join(own, "titleid").join(lists, ["titleid", "actorid"], "left")
        .select(F.col("titleid").alias("_id"), "title", "startYear", F.col("actorid").alias("actor"), "name", "role")
    )


def genre_boxplot(title: DataFrame, genres: DataFrame, min_votes: int = 10_000) -> DataFrame:
    """Rating distribution per genre: quartiles, and whiskers at 1.5 quartile ranges.

    Ratings are counted per value before the percentile, which then sees one row per
    distinct rating. Genres without a voted title are listed with null statistics.
    """
    voted = title.where((F.col("numVotes") >= min_votes) & F.col("avgRatings").isNotNull()).select(
        F.col("id").alias("titleid"), F.col("avgRatings").cast("double").alias("rating")
    )
    values = genres.join(voted, "titleid").groupBy("genre", "rating").agg(F.count("*").alias("n"))
    five = values.groupBy("genre").agg(
        F.expr("percentile(rating, array(0.0, 0.25, 0.5, 0.75, 1.0), n) AS q"),
        F.sum("n").alias("titles"),
    ).selectExpr("genre", "titles", "q[0] AS low", "q[1] AS q1", "q[2] AS median", "q[3] AS q3", "q[4] AS high")
    stats = _with_whiskers(five, values)
    return genres.select("genre").distinct().join(stats, "genre", "left")


def _with_whiskers(five: DataFrame, values: DataFrame) -> DataFrame:
    """The farthest values within 1.5 quartile ranges of the quartiles, as conditional minimum and maximum."""
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    ends = values.join(five.select("genre", "q1", "q3"), "genre").groupBy("genre").agg(
        F.min(F.when(F.col("rating") >= F.col("q1") - reach, F.col("rating"))).alias("whisker_low"),
        F.max(F.when(F.col("rating") <= F.col("q3") + reach, F.col("rating"))).alias("whisker_high"))
    return five.join(ends, "genre")


def genre_boxplot_approx(title: DataFrame, genres: DataFrame, min_votes: int = 10_000, accuracy: int = 10_000) -> DataFrame:
    """The same with quartiles from a mergeable sketch, off by a rank of rows / ``accuracy`` at most; opt-in.

    One pass over the links: each task keeps a sketch a genre, whatever the number of values.
    """
    voted = title.where((F.col("numVotes") >= min_votes) & F.col("avgRatings").isNotNull()).select(
        F.col("id").alias("titleid"), F.col("avgRatings").cast("double").alias("rating"))
    rows = genres.join(voted, "titleid").select("genre", "rating")
    five = rows.groupBy("genre").agg(
        F.percentile_approx("rating", [0.25, 0.5, 0.75], accuracy).alias("q"), F.count("*").alias("titles"),
        F.min("rating").alias("low"), F.max("rating").alias("high"),
    ).selectExpr("genre", "titles", "low", "q[0] AS q1", "q[1] AS median", "q[2] AS q3", "high")
    return genres.select("genre").distinct().join(_with_whiskers(five, rows), "genre", "left")


def genre_cast(genres: DataFrame, cast: DataFrame) -> DataFrame:
    """Mean cast size per genre over titles that have a cast."""
    sizes = cast.groupBy("titleid").agg(F.count("*").alias("cast"))
    return genres.join(sizes, "titleid").groupBy("genre").agg(
        (F.sum("cast") / F.count("*")).alias("mean_cast")
    )


def year_count(title: DataFrame) -> DataFrame:
    """Titles per start year."""
    return (
        title.where("startYear IS NOT NULL").groupBy("startYear")
        .agg(F.count("*").alias("titles")).orderBy("startYear")
    )
