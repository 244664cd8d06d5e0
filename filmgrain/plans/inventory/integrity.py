"""Key and reference checks, relation loading, partial updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import keys, updates
from filmgrain.operators.store import Collection
from filmgrain.plans.inventory.sources import stage_enrichment
from filmgrain.plans.registry import query
from filmgrain.sources.readers import read_wrapped_json
from filmgrain.workspace import cut, stage_path

C = F.col


@query("chk_key", """SELECT titleid, personid, line, CASE WHEN rn = 1 THEN 'kept' ELSE 'rejected' END AS outcome, count(*) AS copies FROM
    (SELECT l_orderkey AS titleid, l_suppkey AS personid, l_linenumber AS line, l_partkey AS item,
     row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem)
    GROUP BY titleid, personid, line, item, outcome""")
def chk_key(v):
    rows = v.lineitem.selectExpr(
        "l_orderkey AS titleid", "l_suppkey AS personid", "l_linenumber AS line", "l_partkey AS item"
    )
    kept, lost = keys.split_key(rows, ["titleid", "personid"], ["line", "item"])
    return kept.withColumns({"outcome": F.lit("kept"), "copies": F.lit(1).cast("bigint")}).unionByName(
        lost.withColumn("outcome", F.lit("rejected"))
    ).select("titleid", "personid", "line", "outcome", "copies")


@query("chk_fk", """SELECT titleid, actorid, CASE WHEN actorid IN (SELECT id FROM member WHERE deathYear IS NULL) THEN 'kept' ELSE 'rejected' END AS outcome FROM title_actor""")
def chk_fk(v):
    alive = v.member.where("deathYear IS NULL")
    good, bad = keys.split_reference(v.title_actor, alive, "actorid")
    return good.withColumn("outcome", F.lit("kept")).unionByName(
        bad.withColumn("outcome", F.lit("rejected"))
    ).select("titleid", "actorid", "outcome")


LONG = {
    "title": "SELECT id, type, repeat(title, CAST(id % 70 AS INTEGER)) AS title, repeat(originalTitle, CAST(id % 40 AS INTEGER)) AS originalTitle FROM title",
    "genre": "SELECT id, repeat(genre, CAST(id % 20 AS INTEGER)) AS genre FROM genre",
    "role": "SELECT id, repeat(role, CAST(id * 20 AS INTEGER)) AS role FROM role",
    "member": "SELECT id, repeat(name, CAST(id % 30 AS INTEGER)) AS name FROM member",
}


@query("chk_length", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", id, '{c}' AS "column", CAST(length({c}) AS INTEGER) AS length FROM ({LONG[t]}) WHERE length({c}) > {n}"""
    for t, limits in schemas.TEXT_LIMITS.items() for c, n in limits.items()))
def chk_length(v):
    """Every table against its declared limits; the labels are repeated, so that some are too long."""
    out = None
    for name, limits in schemas.TEXT_LIMITS.items():
        times = {"title": {"title": 70, "originalTitle": 40}, "genre": {"genre": 20}, "member": {"name": 30}}.get(name, {})
        rows = getattr(v, name).withColumns({
            c: F.expr(f"repeat({c}, cast(id % {n} AS int))") for c, n in times.items()} or {
            "role": F.expr("repeat(role, cast(id * 20 AS int))")})
        found = keys.too_long(rows.select("id", *limits), limits).select(F.lit(name).alias("table"), "id", "column", "length")
        out = found if out is None else out.unionByName(found)
    return out


@query("load_relation", """SELECT DISTINCT l_orderkey AS titleid, 1000000000000 + l_suppkey AS producerid FROM lineitem
    WHERE l_orderkey IN (SELECT id FROM title WHERE type = 'movie') AND 1000000000000 + l_suppkey IN (SELECT id FROM member WHERE deathYear IS NULL)
    EXCEPT SELECT l_orderkey, 1000000000000 + l_suppkey FROM lineitem WHERE l_linenumber = 1""")
def load_relation(v):
    staged = v.lineitem.selectExpr("l_orderkey AS titleid", "1000000000000 + l_suppkey AS producerid", "l_linenumber")
    stored = staged.where("l_linenumber = 1").select("titleid", "producerid").distinct()
    return keys.load_relation(
        staged, stored, v.title.where("type = 'movie'"), "titleid",
        v.member.where("deathYear IS NULL"), "producerid",
    ).select("titleid", "producerid")


@query("load_relation3", """SELECT DISTINCT l_orderkey AS titleid, l_partkey AS actorid,
    CAST(ascii(l_returnflag) * 10000 + ascii(l_linestatus) * 100 + l_linenumber AS BIGINT) AS roleid FROM lineitem
    WHERE (l_orderkey, l_partkey) IN (SELECT titleid, writerid FROM title_writer)
      AND ascii(l_returnflag) * 10000 + ascii(l_linestatus) * 100 + l_linenumber IN (SELECT id FROM role WHERE role LIKE 'A%')
    EXCEPT SELECT titleid, actorid, roleid FROM actor_title_role""")
def load_relation3(v):
    staged = v.lineitem.selectExpr(
        "l_orderkey AS titleid", "l_partkey AS actorid",
        "cast(ascii(l_returnflag) * 10000 + ascii(l_linestatus) * 100 + l_linenumber AS bigint) AS roleid",
    )
    pairs = v.title_writer.toDF("titleid", "actorid")
    return keys.load_triples(
        staged, v.actor_title_role, pairs, ["titleid", "actorid"], v.role.where("role LIKE 'A%'"), "roleid"
    )


@query("batch_all_or_nothing", """WITH batches AS (
      SELECT 'clean' AS batch, id FROM title WHERE type = 'movie' UNION ALL SELECT 'repeated', titleid FROM title_actor
      UNION ALL SELECT 'present', id FROM title WHERE type <> 'movie'),
    clashes AS (SELECT batch FROM batches GROUP BY batch, id HAVING count(*) > 1
      UNION SELECT batch FROM batches WHERE id IN (SELECT id FROM title WHERE type = 'short'))
    SELECT batch, id FROM batches WHERE batch NOT IN (SELECT batch FROM clashes)""")
def batch_all_or_nothing(v):
    stored = v.title.where("type = 'short'").select("id")
    clean = v.title.where("type = 'movie'").select("id")
    repeated = v.title_actor.select(C("titleid").alias("id"))
    present = v.title.where("type <> 'movie'").select("id")
    out = None
    for name, batch in (("clean", clean), ("repeated", repeated), ("present", present)):
        kept = keys.insert_batch(batch, stored, ["id"]).select(F.lit(name).alias("batch"), "id")
        out = kept if out is None else out.unionByName(kept)
    return out


MOVIES = """SELECT id AS title_id, CASE WHEN id % 3 = 0 THEN avgRatings END AS ratings, CASE WHEN id % 3 = 0 THEN numVotes END AS votes
    FROM title WHERE type = 'movie'"""


@query("upd_ratings", f"""SELECT m.title_id, coalesce(r.ratings, m.ratings) AS ratings, coalesce(r.votes, m.votes) AS votes FROM ({MOVIES}) m
    LEFT JOIN (SELECT CAST(substr(tconst, 3) AS BIGINT) AS title_id, CAST(averageRating AS DOUBLE) AS ratings, CAST(numVotes AS BIGINT) AS votes FROM raw_ratings) r USING (title_id)""")
def upd_ratings(v):
    movies = v.title.where("type = 'movie'").selectExpr(
        "id AS title_id", "CASE WHEN id % 3 = 0 THEN avgRatings END AS ratings",
        "CASE WHEN id % 3 = 0 THEN numVotes END AS votes",
    )
    ratings = v.raw_ratings.selectExpr(
        "cast(substr(tconst, 3) AS bigint) AS title_id", "cast(averageRating AS double) AS ratings",
        "cast(numVotes AS bigint) AS votes",
    )
    stored = Collection(v.spark, stage_path(v.spark, "movies")).create(movies, "title_id")
    stored.merge(updates.latest_ratings(ratings), updates.set_ratings, "ratings")
    return stored.read()


def enrichment(v):
    lines = read_wrapped_json(v.spark, stage_enrichment(v), position=True)
    return updates.rename_enrichment(lines)


def documents_before(v):
    return v.title.select(
        C("id").alias("_id"), "title",
        F.when(C("id") % 4 == 0, F.lit("EUR")).alias("currency_type"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in (
            ("cost", "double"), ("distributor", "string"), ("box_office_revenue", "double"), ("film_rating", "string"))],
    )


def merged(v, changes, change, batch):
    """The stored documents after ``batch`` has run, and run again."""
    stored = Collection(v.spark, stage_path(v.spark, "documents")).create(documents_before(v))
    changes = cut(changes)
    stored.merge(changes, change, batch)
    stored.merge(changes, change, batch)  # finds its own name
    return stored.read()


UPDATES = {
    "by_id": """SELECT CAST(replace(IMDb_ID, 'tt', '') AS BIGINT) AS _id, CAST(cost AS DOUBLE) AS cost, CAST(box_office AS DOUBLE) AS box_office_revenue,
        box_office_currencyLabel AS currency_type, distributorLabel AS distributor, MPAA_film_ratingLabel AS film_rating FROM
        (SELECT *, row_number() OVER (PARTITION BY TRY_CAST(replace(IMDb_ID, 'tt', '') AS BIGINT) ORDER BY line) AS rn FROM raw_enrichment
         WHERE TRY_CAST(replace(IMDb_ID, 'tt', '') AS BIGINT) IS NOT NULL AND IMDb_ID NOT LIKE '%nm%') WHERE rn = 1""",
    "by_title": """SELECT titleLabel AS title, CAST(cost AS DOUBLE) AS cost, CAST(box_office AS DOUBLE) AS box_office_revenue,
        box_office_currencyLabel AS currency_type, distributorLabel AS distributor, MPAA_film_ratingLabel AS film_rating FROM
        (SELECT *, row_number() OVER (PARTITION BY titleLabel ORDER BY line) AS rn FROM raw_enrichment WHERE titleLabel IS NOT NULL) WHERE rn = 1""",
    "docs": """SELECT id AS _id, title, CASE WHEN id % 4 = 0 THEN 'EUR' END AS currency_type FROM title""",
}
MERGED = """SELECT d._id, d.title, coalesce(u.currency_type, d.currency_type) AS currency_type, u.cost, u.distributor,
    u.box_office_revenue, u.film_rating FROM docs d LEFT JOIN {u} u ON u._id = d._id"""
CHANGED = ["_id", "title", "currency_type", "cost", "distributor", "box_office_revenue", "film_rating"]


@query("upd_partial_by_id", MERGED.format(u="by_id"), UPDATES)
def upd_partial_by_id(v):
    useful = updates.informative(updates.by_id(enrichment(v)))
    return merged(v, useful, updates.set_by_id, "enrichment by id").select(*CHANGED)


@query("upd_partial_by_title", MERGED.format(u="(SELECT t._id, b.* EXCLUDE (title) FROM by_title b JOIN (SELECT title, min(_id) AS _id FROM docs GROUP BY title) t ON t.title = b.title)"), UPDATES)
def upd_partial_by_title(v):
    useful = updates.informative(updates.by_title(enrichment(v)))
    chosen = updates.by_chosen_id(documents_before(v), useful)
    return merged(v, chosen, updates.set_by_id, "enrichment by title").select(*CHANGED)


@query("upd_drop_empty", """SELECT _id, cost, distributor FROM by_id WHERE cost IS NOT NULL OR box_office_revenue IS NOT NULL
    OR currency_type IS NOT NULL OR distributor IS NOT NULL OR film_rating IS NOT NULL""", UPDATES)
def upd_drop_empty(v):
    return updates.informative(updates.by_id(enrichment(v))).select("_id", "cost", "distributor")


@query("upd_replace_by_id", """SELECT id AS _id, title, CASE WHEN type = 'movie' THEN (startYear - 1990) / 20.0::DOUBLE END AS scaled FROM title""")
def upd_replace_by_id(v):
    """Movies are replaced by documents with a derived field; so would be ids that no document has."""
    docs = v.title.select(C("id").alias("_id"), "title", F.lit(None).cast("double").alias("scaled"))
    scaled = ((C("startYear") - 1990) / F.lit(20.0)).alias("scaled")
    movies = v.title.where("type = 'movie'").select(C("id").alias("_id"), "title", scaled)
    absent = movies.withColumn("_id", -C("_id") - 1)
    stored = Collection(v.spark, stage_path(v.spark, "documents")).create(docs)
    stored.merge(movies.unionByName(absent), updates.replace_by_id, "scaled movies")
    return stored.read()


USEFUL = "cost IS NOT NULL OR box_office_revenue IS NOT NULL OR currency_type IS NOT NULL OR distributor IS NOT NULL OR film_rating IS NOT NULL"


@query("upd_report", f"""SELECT (SELECT count(*) FROM raw_enrichment WHERE IMDb_ID NOT LIKE '%nm%') AS with_key,
    (SELECT count(*) FROM raw_enrichment WHERE IMDb_ID IS NULL OR IMDb_ID LIKE '%nm%') AS without_key,
    (SELECT count(*) FROM raw_enrichment WHERE IMDb_ID LIKE '%nm%') AS person_key,
    (SELECT count(*) FROM (SELECT IMDb_ID FROM raw_enrichment WHERE IMDb_ID NOT LIKE '%nm%' GROUP BY IMDb_ID HAVING count(*) > 1)) AS repeated_keys,
    (SELECT count(*) FROM by_id WHERE NOT ({USEFUL})) AS no_information,
    (SELECT count(*) FROM by_id WHERE {USEFUL}) AS to_update,
    (SELECT count(*) FROM by_id WHERE ({USEFUL}) AND _id IN (SELECT id FROM title)) AS matched,
    (SELECT count(*) FROM by_id WHERE ({USEFUL}) AND _id NOT IN (SELECT id FROM title)) AS unmatched""", UPDATES)
def upd_report(v):
    records = enrichment(v)
    return updates.report(records, updates.by_id(records), documents_before(v), "_id")
