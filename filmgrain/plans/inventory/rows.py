"""Projections, filters, distinct and row choice, sorts, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.functions import text
from filmgrain.operators import selection
from filmgrain.plans import relational
from filmgrain.plans.etl import CATEGORIES, CATEGORY_ROUTES
from filmgrain.plans.registry import query

C = F.col

# projections


@query("proj_select_rename_drop", "SELECT id AS title_id, title AS name, startYear AS year FROM title")
def proj_select_rename_drop(v):
    return (
        v.title.drop("endYear", "avgRatings", "numVotes", "originalTitle", "type", "runtime")
        .withColumnsRenamed({"id": "title_id", "title": "name", "startYear": "year"})
    )


@query("proj_star_join", """SELECT * FROM (SELECT id AS member_id, * EXCLUDE (id), id AS actorid FROM member)
    NATURAL JOIN title_actor NATURAL JOIN (SELECT id AS titleid, id AS title_id, * EXCLUDE (id) FROM title)""")
def proj_star_join(v):
    return relational.credit_rows(v.member, v.title_actor, v.title, "actorid")


@query("proj_literal", "SELECT id, title, 'PROMO' AS genre FROM title")
def proj_literal(v):
    return v.title.select("id", "title", F.lit("PROMO").alias("genre"))


@query("proj_fixed_slots", """SELECT tconst, split_part(genres, ',', 1) AS genre_one,
    nullif(split_part(genres, ',', 2), '') AS genre_two, nullif(split_part(genres, ',', 3), '') AS genre_three
    FROM raw_basics""")
def proj_fixed_slots(v):
    return v.raw_basics.select(
        "tconst", *text.fixed_slots("genres", ["genre_one", "genre_two", "genre_three"])
    )


@query("proj_reorder", "SELECT genreid, titleid FROM title_genre")
def proj_reorder(v):
    return v.title_genre.select("genreid", "titleid")


# filters


@query("flt_eq_and", "SELECT tconst, primaryTitle FROM raw_basics WHERE titleType = 'movie' AND isAdult = '0'")
def flt_eq_and(v):
    return v.raw_basics.where((C("titleType") == "movie") & (C("isAdult") == "0")).select(
        "tconst", "primaryTitle"
    )


@query("flt_or", "SELECT id, startYear, endYear FROM title WHERE startYear = 1997 OR endYear = 1997")
def flt_or(v):
    return v.title.where((C("startYear") == 1997) | (C("endYear") == 1997)).select(
        "id", "startYear", "endYear"
    )


@query("flt_cmp", "SELECT id, runtime FROM title WHERE runtime > 120 AND numVotes >= 10000")
def flt_cmp(v):
    return v.title.where((C("runtime") > 120) & (C("numVotes") >= 10_000)).select("id", "runtime")


@query("flt_range_open", "SELECT id, startYear FROM title WHERE startYear > 1996 AND startYear < 2000")
def flt_range_open(v):
    return v.title.where((C("startYear") > 1996) & (C("startYear") < 2000)).select("id", "startYear")


@query("flt_ne_3vl", "SELECT id, startYear, endYear FROM title WHERE startYear <> 1998 OR endYear <> 1998")
def flt_ne_3vl(v):
    return v.title.where(relational.differs_3vl("startYear", "endYear", 1998)).select(
        "id", "startYear", "endYear"
    )


@query("flt_is_null", "SELECT id, name FROM member WHERE deathYear IS NULL AND birthYear IS NOT NULL")
def flt_is_null(v):
    return v.member.where(C("deathYear").isNull() & C("birthYear").isNotNull()).select("id", "name")


@query("flt_in_not_in", "SELECT id, type FROM title WHERE type NOT IN ('movie', '') AND startYear IN (1996, 1998)")
def flt_in_not_in(v):
    return v.title.where(~C("type").isin("movie", "") & C("startYear").isin(1996, 1998)).select("id", "type")


@query("flt_like_prefix", "SELECT id, name FROM member WHERE name LIKE 'red%'")
def flt_like_prefix(v):
    return v.member.where(C("name").startswith("red")).select("id", "name")


@query("flt_like_contains", "SELECT id, name FROM member WHERE name LIKE '%00001%'")
def flt_like_contains(v):
    return v.member.where(C("name").contains("00001")).select("id", "name")


@query("flt_like_ci", "SELECT id, role FROM role WHERE lower(role) LIKE 'a%f-1' OR lower(role) LIKE 'n-_-2' OR lower(role) = 'r-o-2'")
def flt_like_ci(v):
    low = F.lower("role")
    return v.role.where(low.like("a%f-1") | low.like("n-_-2") | (low == "r-o-2")).select("id", "role")


@query("flt_regex", "SELECT id, name FROM member WHERE regexp_matches(name, '.*(ring|gear).*') OR regexp_matches(name, '^Sup')")
def flt_regex(v):
    return v.member.where(C("name").rlike(".*(ring|gear).*") | C("name").rlike("^Sup")).select("id", "name")


@query("flt_not_contains", "SELECT line, IMDb_ID FROM raw_enrichment WHERE IMDb_ID NOT LIKE '%nm%'")
def flt_not_contains(v):
    return v.raw_enrichment.where(~C("IMDb_ID").contains("nm")).select("line", "IMDb_ID")


@query("flt_route_first_match", """SELECT tconst, nconst, CASE WHEN upper(category) LIKE '%ACT%' THEN 'actors'
    WHEN upper(category) LIKE '%DIRECT%' THEN 'directors' WHEN upper(category) LIKE '%WRITE%' THEN 'writers'
    WHEN upper(category) LIKE '%PROD%' THEN 'producers' END AS target FROM raw_principals""")
def flt_route_first_match(v):
    return v.raw_principals.select(
        "tconst", "nconst", text.first_match("category", CATEGORY_ROUTES).alias("target")
    )


@query("flt_route_exact", """SELECT tconst, nconst, CASE WHEN category IN ('actor', 'actress') THEN 'actor' ELSE category END AS link
    FROM raw_principals WHERE category IN ('actor', 'actress', 'director', 'writer', 'producer')""")
def flt_route_exact(v):
    return v.raw_principals.select("tconst", "nconst", text.exact_match("category", CATEGORIES).alias("link")).where("link IS NOT NULL")


# distinct and row choice


@query("dist_rows", "SELECT DISTINCT t.id, t.title, t.startYear FROM title t JOIN title_genre ON t.id = titleid")
def dist_rows(v):
    return v.title.join(v.title_genre, C("id") == C("titleid")).select("id", "title", "startYear").distinct()


@query("dist_on", """SELECT t.id, t.title, min(g.genre) AS genre FROM title t JOIN title_genre ON t.id = titleid
    JOIN genre g ON genreid = g.id GROUP BY t.id, t.title""")
def dist_on(v):
    from filmgrain.plans.integration import one_genre_each

    return one_genre_each(v.title.select("id", "title"), v.title_genre, v.genre)


@query("dist_on_composite", "SELECT DISTINCT l_orderkey AS titleid, l_partkey AS actorid, l_returnflag AS role FROM lineitem")
def dist_on_composite(v):
    rows = v.lineitem.select(
        C("l_orderkey").alias("titleid"), C("l_partkey").alias("actorid"), C("l_returnflag").alias("role")
    )
    return rows.dropDuplicates(["titleid", "actorid", "role"])


@query("dist_drop_dups", "SELECT DISTINCT tconst, nconst FROM raw_principals")
def dist_drop_dups(v):
    return v.raw_principals.select("tconst", "nconst").dropDuplicates(["tconst", "nconst"])


@query("dist_keep_first", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dist_keep_first(v):
    rows = v.events.select("user_id", "ts", "event_id", "event_type")
    return selection.first_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("dist_unique", "SELECT DISTINCT unnest(string_split(genres, ',')) AS genre FROM raw_basics WHERE genres IS NOT NULL")
def dist_unique(v):
    return v.raw_basics.select(F.explode(text.split_list("genres")).alias("genre")).distinct()


@query("dup_detect_exclude", """SELECT titleid, actorid, roleid FROM actor_title_role WHERE titleid NOT IN
    (SELECT titleid FROM actor_title_role GROUP BY titleid, actorid HAVING count(*) > 1)""")
def dup_detect_exclude(v):
    return selection.without_repeats(v.actor_title_role, "titleid", ["titleid", "actorid"]).select(
        "titleid", "actorid", "roleid"
    )


@query("topn_per_group", """SELECT genreid, titleid, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
    (PARTITION BY genreid ORDER BY titleid) AS rank FROM title_genre) WHERE rank <= 25""")
def topn_per_group(v):
    return selection.top_per_group(v.title_genre, "genreid", ["titleid"], 25).select(
        "genreid", "titleid", "rank"
    )


@query("key_surrogate", "SELECT row_number() OVER (ORDER BY name) - 1 AS id, name FROM (SELECT DISTINCT name FROM member WHERE name IS NOT NULL)")
def key_surrogate(v):
    return selection.dense_ids(v.member, "name")


@query("key_ordinal", """SELECT CAST(row_number() OVER (ORDER BY md5(concat('0:', id)), id) AS INTEGER) AS cluster, id FROM
    (SELECT id FROM title ORDER BY md5(concat('0:', id)), id LIMIT 10)""")
def key_ordinal(v):
    from pyspark.sql import Window

    drawn = selection.sample_rows(v.title.select("id"), 10, "id")
    # ten rows by construction
    w = Window.orderBy(selection.spread_key("id", 0), "id")
    return drawn.select(F.row_number().over(w).alias("cluster"), "id")


# sorts, limits, sampling


@query("sort_desc", "SELECT producerid, count(*) AS titles FROM title_producer GROUP BY producerid ORDER BY 2 DESC, 1")
def sort_desc(v):
    return v.title_producer.groupBy("producerid").agg(F.count("*").alias("titles")).orderBy(
        F.desc("titles"), "producerid"
    )


@query("sort_asc", "SELECT id, role FROM role ORDER BY role")
def sort_asc(v):
    return v.role.select("id", "role").orderBy("role")


@query("limit_n", "SELECT titleid, actorid FROM title_actor ORDER BY titleid, actorid LIMIT 5")
def limit_n(v):
    return v.title_actor.select("titleid", "actorid").orderBy("titleid", "actorid").limit(5)


@query("sample_k", "SELECT id, title FROM title ORDER BY md5(concat('0:', id)), id LIMIT 50")
def sample_k(v):
    return selection.sample_rows(v.title.select("id", "title"), 50, "id")


@query("sample_one", "SELECT id, title FROM title ORDER BY md5(concat('3:', id)), id LIMIT 1")
def sample_one(v):
    return selection.sample_rows(v.title.select("id", "title"), 1, "id", seed=3)


# set operations


@query("set_except", "SELECT titleid, actorid FROM title_actor EXCEPT SELECT titleid, writerid FROM title_writer")
def set_except(v):
    return v.title_actor.select("titleid", "actorid").subtract(v.title_writer.select("titleid", "writerid"))


@query("set_union", "SELECT titleid, actorid AS person FROM title_actor UNION SELECT titleid, writerid FROM title_writer")
def set_union(v):
    return v.title_actor.toDF("titleid", "person").union(v.title_writer).distinct()
