"""Grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.operators.documents import assemble, group_list
from filmgrain.plans.document_queries import genre_boxplot
from filmgrain.plans.inventory.documents import docs_with
from filmgrain.plans.registry import query

C = F.col


@query("agg_count_by", "SELECT type, startYear, count(*) AS titles, count(runtime) AS timed FROM title GROUP BY type, startYear")
def agg_count_by(v):
    return v.title.groupBy("type", "startYear").agg(
        F.count("*").alias("titles"), F.count("runtime").alias("timed")
    )


@query("agg_hidden_count_sort", "SELECT name FROM member JOIN title_producer ON id = producerid GROUP BY name ORDER BY count(*) DESC, name")
def agg_hidden_count_sort(v):
    per_id = v.title_producer.groupBy("producerid").agg(F.count("*").alias("n"))
    return (
        per_id.join(v.member, C("id") == C("producerid")).groupBy("name").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "name").select("name")
    )


@query("agg_having", "SELECT actorid, count(*) AS titles FROM title_actor GROUP BY actorid HAVING count(*) >= 30")
def agg_having(v):
    return v.title_actor.groupBy("actorid").agg(F.count("*").alias("titles")).where("titles >= 30")


@query("agg_global_avg", "SELECT 'all' AS _id, avg(runtime) AS avgRuntime FROM title WHERE type = 'movie' HAVING count(*) > 0")
def agg_global_avg(v):
    # grouped by a constant: no input, no row
    return v.title.where(C("type") == "movie").groupBy(F.lit("all").alias("_id")).agg(
        F.avg("runtime").alias("avgRuntime")
    )


@query("agg_first_by_key", """SELECT producerid AS _id, min(name) AS name, count(*) AS count FROM title_producer
    JOIN member ON id = producerid GROUP BY producerid""")
def agg_first_by_key(v):
    counts = v.title_producer.groupBy(C("producerid").alias("_id")).agg(F.count("*").alias("count"))
    return counts.join(v.member.select(C("id").alias("_id"), "name"), "_id").select("_id", "name", "count")


@query("agg_by_array_key", """SELECT producers, count(*) AS titles FROM (SELECT titleid, string_agg(producerid, ',' ORDER BY producerid) AS producers
    FROM title_producer GROUP BY titleid) GROUP BY producers""")
def agg_by_array_key(v):
    docs = docs_with(v, "producer_id").where("producer_id IS NOT NULL")
    return docs.groupBy(F.array_sort("producer_id").alias("key")).agg(F.count("*").alias("titles")).select(
        F.array_join(C("key").cast("array<string>"), ",").alias("producers"), "titles"
    )


@query("agg_collect_list", "SELECT titleid, string_agg(genre, ',' ORDER BY genre) AS genres FROM title_genre JOIN genre ON genreid = id GROUP BY titleid")
def agg_collect_list(v):
    from filmgrain.operators.joins import with_label

    links = with_label(v.title_genre, v.genre, "genreid", "genre")
    return group_list(links, "titleid", "genre", "genres").select(
        "titleid", F.array_join("genres", ",").alias("genres")
    )


@query("agg_collect_nested", """SELECT a.titleid, string_agg(concat(a.actorid, ':', coalesce(r.roles, '')), ';' ORDER BY a.actorid) AS cast_list
    FROM title_actor a LEFT JOIN (SELECT titleid, actorid, string_agg(role, '|' ORDER BY role) AS roles
        FROM actor_title_role JOIN role ON roleid = id GROUP BY titleid, actorid) r
    ON r.titleid = a.titleid AND r.actorid = a.actorid GROUP BY a.titleid""")
def agg_collect_nested(v):
    docs = assemble(v.title.select("id", "type"), {}, (v.title_actor, v.actor_title_role, v.role))
    text = F.transform("actors", lambda a: F.concat(
        a["actor"].cast("string"), F.lit(":"), F.coalesce(F.array_join(a["role"], "|"), F.lit(""))
    ))
    return docs.where("actors IS NOT NULL").select(
        C("_id").alias("titleid"), F.array_join(text, ";").alias("cast_list")
    )


@query("agg_dup_count", "SELECT title, count(*) AS copies FROM title GROUP BY title HAVING count(*) > 1")
def agg_dup_count(v):
    return v.title.groupBy("title").agg(F.count("*").alias("copies")).where("copies > 1")


@query("agg_min_max", """SELECT min(startYear) AS min_year, max(startYear) AS max_year, min(avgRatings) AS min_rating,
    max(avgRatings) AS max_rating FROM title WHERE numVotes >= 10000""")
def agg_min_max(v):
    return v.title.where("numVotes >= 10000").agg(
        F.min("startYear").alias("min_year"), F.max("startYear").alias("max_year"),
        F.min("avgRatings").alias("min_rating"), F.max("avgRatings").alias("max_rating"),
    )


@query("agg_sum_mean_by_cluster", """SELECT genreid AS cluster, count(*) AS n, round(avg(startYear), 6) AS x, round(avg(avgRatings), 6) AS y
    FROM title JOIN title_genre ON id = titleid WHERE avgRatings IS NOT NULL GROUP BY genreid""")
def agg_sum_mean_by_cluster(v):
    rows = v.title.where("avgRatings IS NOT NULL").join(v.title_genre, C("id") == C("titleid"))
    return rows.groupBy(C("genreid").alias("cluster")).agg(
        F.count("*").alias("n"), F.round(F.avg("startYear"), 6).alias("x"),
        F.round(F.avg("avgRatings"), 6).alias("y"),
    )


@query("agg_sum_sq", "SELECT round(sum(pow(avgRatings - 5.0, 2)), 4) AS sse FROM title")
def agg_sum_sq(v):
    return v.title.agg(F.round(F.sum(F.pow(C("avgRatings") - 5.0, F.lit(2))), 4).alias("sse"))


FIVE = """SELECT g.genre, s.titles, s.low, s.q1, s.median, s.q3, s.high, w.whisker_low, w.whisker_high FROM
    (SELECT DISTINCT genre FROM title_genre JOIN genre ON genreid = id) g LEFT JOIN stats s ON s.genre = g.genre
    LEFT JOIN (SELECT v.genre, min(CASE WHEN r >= q1 - 1.5 * (q3 - q1) THEN r END) AS whisker_low,
        max(CASE WHEN r <= q3 + 1.5 * (q3 - q1) THEN r END) AS whisker_high FROM rated v JOIN stats USING (genre) GROUP BY v.genre) w ON w.genre = g.genre"""
FIVE_VIEWS = {
    "rated": """SELECT genre, avgRatings AS r FROM title JOIN title_genre ON title.id = titleid JOIN genre ON genreid = genre.id
        WHERE numVotes >= 10000 AND avgRatings IS NOT NULL""",
    "stats": """SELECT genre, count(*) AS titles, quantile_cont(r, 0.0) AS low, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median,
        quantile_cont(r, 0.75) AS q3, quantile_cont(r, 1.0) AS high FROM rated GROUP BY genre""",
}


@query("agg_five_number", FIVE, FIVE_VIEWS)
def agg_five_number(v):
    return genre_boxplot(v.title, v.labelled_genre)


@query("agg_ratio", """SELECT type, sum(n) / count(*) AS mean_cast FROM title JOIN
    (SELECT titleid, count(*) AS n FROM title_actor GROUP BY titleid) ON titleid = id GROUP BY type""")
def agg_ratio(v):
    sizes = v.title_actor.groupBy("titleid").agg(F.count("*").alias("n"))
    return v.title.join(sizes, C("id") == C("titleid")).groupBy("type").agg(
        (F.sum("n") / F.count("*")).alias("mean_cast")
    )
