"""Scalar and list expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.functions import text
from filmgrain.functions.numeric import euclid, min_max
from filmgrain.operators.joins import with_scalars
from filmgrain.plans.etl import CATEGORIES
from filmgrain.plans.registry import query

C = F.col


@query("fn_strip_prefix", "SELECT tconst, CAST(substr(tconst, 3) AS BIGINT) AS id FROM raw_basics")
def fn_strip_prefix(v):
    return v.raw_basics.select("tconst", text.strip_prefix("tconst").alias("id"))


@query("fn_replace", "SELECT nconst, replace(replace(nconst, 'nm', ''), 'tt', '') AS bare FROM raw_names")
def fn_replace(v):
    return v.raw_names.select("nconst", text.drop_markers("nconst", "nm", "tt").alias("bare"))


@query("fn_keep_digits", """SELECT tconst, regexp_replace(tconst, '[^0-9,]', '', 'g') AS t, regexp_replace(directors, '[^0-9,]', '', 'g') AS d,
    regexp_replace(writers, '[^0-9,]', '', 'g') AS w FROM raw_crew""")
def fn_keep_digits(v):
    return v.raw_crew.select(
        "tconst", text.keep_digits("tconst").alias("t"), text.keep_digits("directors").alias("d"),
        text.keep_digits("writers").alias("w"),
    )


@query("fn_strip_chars", """SELECT tconst, ordering, replace(replace(replace(characters, '[', ''), ']', ''), '"', '') AS roles FROM raw_principals""")
def fn_strip_chars(v):
    return v.raw_principals.select("tconst", "ordering", text.strip_chars("characters").alias("roles"))


@query("fn_split", "SELECT tconst, len(string_split(genres, ',')) AS n, string_split(genres, ',')[1] AS first_genre FROM raw_basics WHERE genres IS NOT NULL")
def fn_split(v):
    parts = text.split_list("genres")
    return v.raw_basics.where("genres IS NOT NULL").select(
        "tconst", F.size(parts).cast("bigint").alias("n"), F.get(parts, F.lit(0)).alias("first_genre")
    )


@query("fn_split_name", """SELECT nconst, split_part(primaryName, ' ', 1) AS first_name,
    CASE WHEN strpos(primaryName, ' ') > 0 THEN substr(primaryName, strpos(primaryName, ' ') + 1) END AS last_name FROM raw_names""")
def fn_split_name(v):
    first, last = text.split_name("primaryName")
    return v.raw_names.select("nconst", first.alias("first_name"), last.alias("last_name"))


@query("fn_upper_lower", "SELECT nconst, upper(primaryProfession) AS jobs, lower(primaryName) AS name FROM raw_names")
def fn_upper_lower(v):
    jobs = F.array_join(text.upper_list(text.split_list("primaryProfession")), ",")
    return v.raw_names.select("nconst", jobs.alias("jobs"), F.lower("primaryName").alias("name"))


@query("fn_try_numeric", "SELECT tconst, TRY_CAST(runtimeMinutes AS BIGINT) AS runtime FROM raw_basics")
def fn_try_numeric(v):
    return v.raw_basics.select("tconst", text.to_number("runtimeMinutes").alias("runtime"))


@query("fn_cast", "SELECT tconst, CAST(averageRating AS DOUBLE) AS rating, CAST(numVotes AS BIGINT) AS votes, CAST(CAST(numVotes AS BIGINT) AS VARCHAR) AS text FROM raw_ratings")
def fn_cast(v):
    return v.raw_ratings.select(
        "tconst", C("averageRating").try_cast("double").alias("rating"),
        C("numVotes").try_cast("bigint").alias("votes"),
        C("numVotes").try_cast("bigint").cast("string").alias("text"),
    )


@query("fn_array_size", "SELECT titleid AS _id, count(*) AS actors FROM title_actor JOIN title ON id = titleid GROUP BY titleid")
def fn_array_size(v):
    from filmgrain.operators.documents import assemble

    docs = assemble(v.title.select("id", "type"), {}, (v.title_actor, v.actor_title_role, v.role))
    return docs.where("actors IS NOT NULL").groupBy("_id").agg(F.sum(F.size("actors")).alias("actors"))


@query("fn_minmax", """SELECT id, (runtime - (SELECT min(runtime) FROM title)) / (SELECT max(runtime) - min(runtime) FROM title)::DOUBLE AS x,
    CASE WHEN runtime IS NOT NULL THEN 0.0::DOUBLE END AS constant FROM title""")
def fn_minmax(v):
    wide = with_scalars(v.title.select("id", "runtime"), lo=F.min("runtime"), hi=F.max("runtime"))
    return wide.select(
        "id", min_max(C("runtime"), C("lo"), C("hi")).alias("x"),
        # a column without spread scales to zero
        min_max(C("runtime"), C("lo"), C("lo")).alias("constant"),
    )


@query("fn_euclid", "SELECT id, round(sqrt((startYear - 1998) * (startYear - 1998) + (avgRatings - 5) * (avgRatings - 5)), 6) AS d FROM title")
def fn_euclid(v):
    d = euclid(C("startYear").cast("double"), C("avgRatings"), F.lit(1998.0), F.lit(5.0))
    return v.title.select("id", F.round(d, 6).alias("d"))


@query("arr_explode", """SELECT tconst, nconst, unnest(string_split(replace(replace(replace(characters, '[', ''), ']', ''), '"', ''), ',')) AS role
    FROM raw_principals WHERE characters IS NOT NULL AND category IN ('actor', 'actress')""")
def arr_explode(v):
    rows = v.raw_principals.where(C("category").isin(*CATEGORIES["actor"]))
    return rows.select(
        "tconst", "nconst", F.explode(text.split_list(text.strip_chars("characters"))).alias("role")
    )


ACTING = """SELECT nconst, primaryName, list_filter(j, lambda x: contains(x, 'ACT')) AS acting, j FROM
    (SELECT nconst, primaryName, string_split(upper(primaryProfession), ',') AS j FROM raw_names)"""


@query("arr_act_dedupe", """SELECT nconst, array_to_string(CASE WHEN len(acting) = 2 THEN
    list_filter(j, lambda x, i: i <> list_position(j, acting[-1])) ELSE j END, ',') AS jobs FROM acting_jobs""", {"acting_jobs": ACTING})
def arr_act_dedupe(v):
    jobs = text.drop_second_acting_entry(text.upper_list(text.split_list("primaryProfession")))
    return v.raw_names.select("nconst", F.array_join(jobs, ",").alias("jobs"))


@query("nul_normalise", """SELECT nconst, birthYear, deathYear, primaryProfession FROM raw_names""")
def nul_normalise(v):
    """Blank, backslash-N and the word None all come back as null."""
    spelled = v.raw_names.select(
        "nconst", "birthYear", F.coalesce("deathYear", F.lit("\\N")).alias("deathYear"),
        F.coalesce("primaryProfession", F.when(C("birthYear") % 2 == 0, F.lit("")).otherwise(F.lit("None"))).alias("primaryProfession"),
    )
    return spelled.select("nconst", *[
        text.null_if_blank(c).alias(c) for c in ("birthYear", "deathYear", "primaryProfession")
    ])


@query("nul_fill_drop", "SELECT id, coalesce(endYear, 0) AS endYear, runtime FROM title WHERE runtime IS NOT NULL")
def nul_fill_drop(v):
    return v.title.select("id", "endYear", "runtime").fillna(0, ["endYear"]).dropna(subset=["runtime"])
