"""Named end-to-end queries and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.operators.joins import with_label
from filmgrain.plans import document_queries as docq
from filmgrain.plans import relational as rel
from filmgrain.plans.inventory.aggregates import FIVE, FIVE_VIEWS
from filmgrain.plans.registry import query


@query("q_missing_roles", """-- an actor of a title has a role there if any of the first five lines says so
    SELECT l_orderkey AS titleid, l_partkey AS actorid FROM lineitem GROUP BY ALL HAVING min(l_linenumber) > 5""")
def q_missing_roles(v):
    return rel.missing_roles_stored(v.stored.title_actor, v.stored.actor_title_role)


@query("q_living_prefix", """WITH film AS (SELECT * FROM title WHERE type = 'movie' AND NOT (startYear = 1998 AND coalesce(endYear, 1998) = 1998)),
    cast_ AS (SELECT l_partkey AS actorid, unnest(list_distinct(list(l_orderkey))) AS titleid FROM lineitem GROUP BY l_partkey)
    SELECT actorid AS member_id, (SELECT name FROM member WHERE id = actorid) AS name, born AS birthYear, NULL::INT AS deathYear,
           titleid, actorid, film.id AS title_id, film.* EXCLUDE (id)
    FROM (SELECT id AS actorid, birthYear AS born FROM member WHERE starts_with(name, 'red') AND deathYear IS NULL)
    NATURAL JOIN cast_ JOIN film ON film.id = titleid""")
def q_living_prefix(v):
    return rel.living_prefix(v.stored.member, v.stored.actor_title, v.stored.title, "red", 1998)


@query("q_genre_year_producers", """SELECT DISTINCT name FROM member WHERE contains(name, '00001') AND id IN (
      SELECT producerid FROM title_producer
      WHERE titleid IN (SELECT titleid FROM title_genre WHERE genreid = (SELECT id FROM genre WHERE genre = 'PROMO'))
        AND titleid IN (SELECT id FROM title WHERE 1997 IN (startYear, endYear)))""")
def q_genre_year_producers(v):
    s = v.stored
    return rel.genre_year_producers(
        s.member, s.title_producer, s.title, s.title_genre, s.genre, "00001", 1997, "PROMO"
    )


@query("q_longrun_producers", """WITH works AS (
      SELECT producerid, count_if(titleid IN (SELECT id FROM title WHERE runtime > 120)) AS n FROM title_producer GROUP BY producerid)
    SELECT name, sum(n)::BIGINT AS total FROM member, works WHERE producerid = id AND deathYear IS NULL AND n > 0 GROUP BY name""")
def q_longrun_producers(v):
    return rel.longrun_producers(v.stored.member, v.stored.title_producer, v.stored.title, 120)


@query("q_role_pattern", """SELECT (SELECT name FROM member WHERE id = actorid) AS name, role FROM (
      SELECT DISTINCT l_orderkey, l_partkey AS actorid, concat_ws('-', l_returnflag, l_linestatus, l_linenumber) AS role
      FROM lineitem WHERE l_linenumber <= 5)
    WHERE regexp_full_match(role, '(a.*f-1)|(n-x-9)|(r-o-2)', 'i') AND actorid IN (SELECT id FROM member WHERE deathYear IS NULL)""")
def q_role_pattern(v):
    return rel.role_pattern(v.stored.member, v.stored.actor_title_role, v.stored.role, ("a%f-1", "n-x-9"), "r-o-2")


@query("q_doc_producers_50", """SELECT m.id AS _id, min(m.name) AS name, count(*) AS count FROM title t JOIN title_genre tg ON tg.titleid = t.id
    JOIN genre g ON g.id = genreid AND g.genre = 'PROMO' JOIN title_producer p ON p.titleid = t.id JOIN member m ON m.id = p.producerid
    WHERE t.startYear = 1997 AND regexp_matches(m.name, '.*00001.*') GROUP BY m.id HAVING count(*) >= 20""")
def q_doc_producers_50(v):
    s = v.stored
    return docq.producers_with_many(
        s.title, s.labelled_genre, s.title_producer, s.member, 1997, "PROMO", ".*00001.*", 20
    )


@query("q_doc_writer_avg", """SELECT CAST(NULL AS VARCHAR) AS _id, avg(runtime) AS avgRuntime FROM title WHERE type = 'movie' AND id IN
    (SELECT titleid FROM title_writer JOIN member ON id = writerid GROUP BY titleid
     HAVING bool_or(regexp_matches(name, '.*ring.*')) AND bool_or(deathYear IS NULL)) HAVING count(*) > 0""")
def q_doc_writer_avg(v):
    return docq.writer_average(v.stored.title, v.stored.title_writer, v.stored.member, ".*ring.*")


@query("q_doc_longrun_sets", """SELECT producers, any_value(names) AS names, count(*) AS count FROM
    (SELECT titleid, string_agg(producerid, ',' ORDER BY producerid) AS producers, string_agg(name, ',' ORDER BY producerid) AS names
     FROM title_producer JOIN member m ON m.id = producerid JOIN title t ON t.id = titleid WHERE t.runtime >= 120
     GROUP BY titleid HAVING bool_or(deathYear IS NULL)) GROUP BY producers""")
def q_doc_longrun_sets(v):
    sets = docq.longrun_producer_sets(v.stored.title, v.stored.title_producer, v.stored.member, 120)
    return sets.select(
        F.array_join(F.col("producers").cast("array<string>"), ",").alias("producers"),
        F.array_join("name", ",").alias("names"), "count",
    )


@query("q_doc_director_actor", """SELECT t.id AS _id, t.title, t.startYear, a.id AS actor, a.name, r.roles AS role FROM title t
    JOIN title_genre ON title_genre.titleid = t.id JOIN genre g ON g.id = genreid AND g.genre = 'PROMO'
    JOIN title_director d ON d.titleid = t.id JOIN member dm ON dm.id = d.directorid AND dm.name = 'Customer#000000044'
    JOIN title_actor ta ON ta.titleid = t.id JOIN member a ON a.id = ta.actorid AND a.name = 'cold gizmo'
    LEFT JOIN (SELECT titleid, actorid, string_agg(role, '|' ORDER BY role) AS roles FROM actor_title_role JOIN role ON role.id = roleid
        GROUP BY titleid, actorid) r ON r.titleid = t.id AND r.actorid = a.id""")
def q_doc_director_actor(v):
    s = v.stored
    roles = with_label(s.actor_title_role, s.role, "roleid", "role").drop("roleid")
    rows = docq.director_actor(
        s.title, s.labelled_genre, s.title_director, s.title_actor, roles, s.member,
        "PROMO", "Customer#000000044", "cold gizmo",
    )
    return rows.withColumn("role", F.array_join("role", "|"))


@query("rpt_genre_boxplot", FIVE, FIVE_VIEWS)
def rpt_genre_boxplot(v):
    return docq.genre_boxplot(v.stored.title, v.stored.labelled_genre)


@query("rpt_genre_cast", """SELECT genre, sum(n) / count(*) AS mean_cast FROM title_genre JOIN genre ON genreid = id
    JOIN (SELECT titleid, count(*) AS n FROM title_actor GROUP BY titleid) c ON c.titleid = title_genre.titleid GROUP BY genre""")
def rpt_genre_cast(v):
    return docq.genre_cast(v.stored.labelled_genre, v.stored.title_actor)


@query("rpt_year_count", "SELECT startYear, count(*) AS titles FROM title WHERE startYear IS NOT NULL GROUP BY startYear")
def rpt_year_count(v):
    return docq.year_count(v.stored.title)
