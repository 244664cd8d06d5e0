"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.functions.numeric import min_max
from filmgrain.operators import clusters, itemsets, joins
from filmgrain.plans import relational
from filmgrain.plans.registry import query

C = F.col


@query("join_inner_equi", """SELECT name, title, startYear FROM (SELECT id AS producerid, name FROM member)
    NATURAL JOIN title_producer NATURAL JOIN (SELECT id AS titleid, title, startYear FROM title)""")
def join_inner_equi(v):
    return relational.credit_rows(v.member, v.title_producer, v.title, "producerid").select(
        "name", "title", "startYear"
    )


@query("join_inner_5way", """WITH labels AS (SELECT titleid, unnest(list(genre)) AS genre FROM title_genre, genre WHERE genreid = id GROUP BY titleid)
    SELECT producerid, (SELECT name FROM member WHERE id = producerid) AS name, titleid,
           (SELECT startYear FROM title WHERE id = titleid) AS startYear, genre
    FROM labels NATURAL JOIN title_producer
    WHERE producerid IN (SELECT id FROM member) AND titleid IN (SELECT id FROM title)""")
def join_inner_5way(v):
    return relational.producer_genre_rows(
        v.member, v.title_producer, v.title, v.title_genre, v.genre
    ).select("producerid", "name", "titleid", "startYear", "genre")


@query("join_full_outer", """SELECT coalesce(b.tconst, r.tconst) AS tconst, primaryTitle, averageRating FROM raw_basics b
    FULL OUTER JOIN raw_ratings r ON b.tconst = r.tconst""")
def join_full_outer(v):
    return v.raw_basics.join(v.raw_ratings, "tconst", "full_outer").select(
        "tconst", "primaryTitle", "averageRating"
    )


@query("join_left", """SELECT t.id, t.title, g.genreid FROM title t LEFT JOIN title_genre g ON t.id = g.titleid""")
def join_left(v):
    return v.title.join(v.title_genre, C("id") == C("titleid"), "left").select("id", "title", "genreid")


@query("join_inner_df", """SELECT id, type, actorid, roleid FROM title JOIN actor_title_role ON id = titleid
    WHERE runtime >= 90 AND type = 'movie'""")
def join_inner_df(v):
    movies = v.title.where("runtime >= 90 AND type = 'movie'").select("id", "type")
    return movies.join(v.actor_title_role, C("id") == C("titleid")).drop("titleid")


@query("join_dict_encode", """SELECT DISTINCT l_orderkey AS titleid, l_partkey AS actorid, id AS roleid FROM lineitem
    JOIN role ON role = concat(l_returnflag, '-', l_linestatus, '-', l_linenumber)""")
def join_dict_encode(v):
    rows = v.lineitem.selectExpr(
        "l_orderkey AS titleid", "l_partkey AS actorid",
        "concat(l_returnflag, '-', l_linestatus, '-', l_linenumber) AS role",
    )
    return joins.encode_label(rows, v.role, "role", "roleid").distinct()


@query("join_semi_exists1", "SELECT titleid, actorid FROM title_actor WHERE EXISTS (SELECT 1 FROM title WHERE id = titleid AND type = 'movie')")
def join_semi_exists1(v):
    movies = v.title.where(C("type") == "movie")
    return joins.known(v.title_actor, movies, "titleid").select("titleid", "actorid")


@query("join_semi_exists2", """SELECT titleid, producerid FROM title_producer i WHERE
    titleid IN (SELECT id FROM title WHERE type = 'movie') AND producerid IN (SELECT id FROM member WHERE deathYear IS NULL)""")
def join_semi_exists2(v):
    movies, alive = v.title.where("type = 'movie'"), v.member.where("deathYear IS NULL")
    return joins.with_parents(v.title_producer, movies, "titleid", alive, "producerid").select(
        "titleid", "producerid"
    )


@query("join_anti_not_exists", "SELECT id, title FROM title t WHERE NOT EXISTS (SELECT 1 FROM title_genre WHERE titleid = t.id)")
def join_anti_not_exists(v):
    return joins.unknown(v.title, v.title_genre, "id", "titleid").select("id", "title")


@query("join_anti_isin", """SELECT titleid, genreid FROM title_genre WHERE titleid NOT IN
    (SELECT titleid FROM title_genre JOIN genre ON genreid = id WHERE genre = 'PROMO')""")
def join_anti_isin(v):
    promo = joins.with_label(v.title_genre, v.genre, "genreid", "genre").where("genre = 'PROMO'")
    return joins.unknown(v.title_genre, promo, "titleid", "titleid").select("titleid", "genreid")


@query("join_theta_self", """SELECT a.item AS item1, b.item AS item2, count(*) AS support FROM baskets a JOIN baskets b
    ON a.basket = b.basket AND a.item < b.item GROUP BY 1, 2 HAVING count(*) > 5""")
def join_theta_self(v):
    return itemsets.joint_support(v.baskets, 5)


@query("join_names_n", """SELECT d.titleid, w.writerid, d.directorid, m1.name AS writerid_name, m2.name AS directorid_name
    FROM title_director d JOIN title_writer w ON d.titleid = w.titleid
    JOIN member m1 ON m1.id = w.writerid JOIN member m2 ON m2.id = d.directorid""")
def join_names_n(v):
    pairs = v.title_director.join(v.title_writer, "titleid")
    return joins.attach_names(pairs, v.member, ["writerid", "directorid"])


LOOKUP = """SELECT d.id AS _id, coalesce(l.names, '') AS names, coalesce(l.n, 0) AS n FROM title d LEFT JOIN
    (SELECT titleid, string_agg(name, ',' ORDER BY member.id) AS names, count(*) AS n FROM {links}
     JOIN member ON member.id = {key} GROUP BY titleid) l ON l.titleid = d.id"""


@query("join_lookup_array", LOOKUP.format(links="title_writer", key="writerid"))
def join_lookup_array(v):
    from filmgrain.operators.documents import assemble

    docs = assemble(v.title.select("id", "title"), {"writer_id": v.title_writer})
    members = v.member.select(C("id").alias("_id"), "name")
    out = joins.lookup_array(docs, members, "writer_id", "writers")
    return out.select(
        "_id", F.array_join(F.transform("writers", lambda w: w["name"]), ",").alias("names"),
        F.size("writers").cast("bigint").alias("n"),
    )


@query("join_lookup_scalar", LOOKUP.format(links="title_director", key="directorid"))
def join_lookup_scalar(v):
    docs = v.title_director.select(C("titleid").alias("_id"), C("directorid").alias("director"))
    members = v.member.select(C("id").alias("_id"), "name")
    out = joins.lookup_scalar(docs, members, "director", "found")
    return out.select(
        "_id", F.array_join(F.transform("found", lambda w: w["name"]), ",").alias("names"),
        F.size("found").cast("bigint").alias("n"),
    )


@query("join_cross_scalar", """SELECT id, (startYear - (SELECT min(startYear) FROM title)) /
    (SELECT max(startYear) - min(startYear) FROM title)::DOUBLE AS x FROM title""")
def join_cross_scalar(v):
    wide = joins.with_scalars(v.title.select("id", "startYear"), lo=F.min("startYear"), hi=F.max("startYear"))
    return wide.select("id", min_max(C("startYear"), C("lo"), C("hi")).alias("x"))


@query("join_cross_nearest", """
    WITH feats AS (SELECT id AS _id, (startYear - min(startYear) OVER ()) / (max(startYear) OVER () - min(startYear) OVER ())::DOUBLE AS x,
             (avgRatings - min(avgRatings) OVER ()) / (max(avgRatings) OVER () - min(avgRatings) OVER ()) AS y
             FROM title WHERE type = 'movie' AND numVotes >= 10000 AND startYear IS NOT NULL AND avgRatings IS NOT NULL),
         cents AS (SELECT row_number() OVER (ORDER BY md5(concat('0:', _id)), _id) AS c, x, y FROM
             (SELECT * FROM feats ORDER BY md5(concat('0:', _id)), _id LIMIT 12)),
         dists AS (SELECT f._id, c.c, sqrt((f.x-c.x)*(f.x-c.x) + (f.y-c.y)*(f.y-c.y)) AS d FROM feats f CROSS JOIN cents c)
    SELECT _id, CAST(c AS INTEGER) AS cluster, round(d, 6) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY _id ORDER BY d, c) AS rn FROM dists) WHERE rn = 1""")
def join_cross_nearest(v):
    feats = clusters.features(v.title).withColumn("label", F.lit("all"))
    runs = {("all", 12): clusters.initial(feats, "all", 12)}
    return clusters.assign(feats, runs).select("_id", "cluster", F.round("dist", 6).alias("dist"))
