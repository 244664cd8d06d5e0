"""Document building and array matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain.operators import documents
from filmgrain.operators.joins import lookup_array
from filmgrain.plans.etl import profession_rows
from filmgrain.plans.registry import query

C = F.col
SCALARS = ("id", "type", "title", "originalTitle", "startYear", "endYear", "runtime", "avgRatings", "numVotes")


def docs_with(v, *fields: str):
    """Documents with the named arrays; ``actors`` brings the cast with its roles."""
    links = {
        "genres": lambda: v.labelled_genre,
        "director_id": lambda: v.title_director,
        "writer_id": lambda: v.title_writer,
        "producer_id": lambda: v.title_producer,
    }
    lists = {f: links[f]() for f in fields if f != "actors"}
    cast = (v.title_actor, v.actor_title_role, v.role) if "actors" in fields else None
    return documents.assemble(v.title.select(*SCALARS), lists, cast)


def people(v):
    return v.member.withColumnRenamed("id", "_id")


def with_writers(v):
    return lookup_array(docs_with(v, "writer_id"), people(v).select("_id", "name", "deathYear"), "writer_id", "writers")


@query("arr_unwind", "SELECT titleid AS _id, genre FROM title_genre JOIN genre ON genreid = id")
def arr_unwind(v):
    docs = documents.unwind(docs_with(v, "genres"), "genres")
    # a plain value passes through
    return documents.unwind(docs, "genres").select("_id", C("genres").alias("genre"))


@query("arr_any_eq", """SELECT DISTINCT titleid AS _id FROM title_writer JOIN member ON id = writerid WHERE name = 'red ring'""")
def arr_any_eq(v):
    return with_writers(v).where(documents.any_equals("writers", "name", "red ring")).select("_id")


@query("arr_any_regex_and_null", """SELECT titleid AS _id FROM title_writer JOIN member ON id = writerid GROUP BY titleid
    HAVING bool_or(regexp_matches(name, '.*ring.*')) AND bool_or(deathYear IS NULL)""")
def arr_any_regex_and_null(v):
    both = documents.any_matches("writers", "name", ".*ring.*") & documents.any_null("writers", "deathYear")
    return with_writers(v).where(both).select("_id")


@query("arr_any_null", "SELECT DISTINCT titleid AS _id FROM title_writer JOIN member ON id = writerid WHERE deathYear IS NULL")
def arr_any_null(v):
    return with_writers(v).where(documents.any_null("writers", "deathYear")).select("_id")


@query("arr_ne_null", "SELECT id AS _id FROM title WHERE id IN (SELECT titleid FROM title_genre)")
def arr_ne_null(v):
    return docs_with(v, "genres").where(C("genres").isNotNull()).select("_id")


@query("arr_contains", "SELECT titleid AS _id FROM title_genre JOIN genre ON genreid = id WHERE genre = 'PROMO'")
def arr_contains(v):
    return docs_with(v, "genres").where(F.array_contains("genres", "PROMO")).select("_id")


@query("arr_explode_route", """SELECT CAST(substr(nconst, 3) AS BIGINT) AS id, CASE WHEN job IN ('ACTOR', 'ACTRESS') THEN 'actors'
    WHEN job = 'DIRECTOR' THEN 'directors' WHEN job = 'WRITER' THEN 'writers' ELSE 'producers' END AS target FROM
    (SELECT nconst, unnest(CASE WHEN len(acting) = 2 THEN list_filter(j, lambda x, i: i <> list_position(j, acting[-1])) ELSE j END) AS job FROM acting_jobs)
    WHERE job IN ('ACTOR', 'ACTRESS', 'DIRECTOR', 'WRITER', 'PRODUCER')""", {"acting_jobs": """SELECT nconst, list_filter(j, lambda x: contains(x, 'ACT')) AS acting, j FROM
    (SELECT nconst, string_split(upper(primaryProfession), ',') AS j FROM raw_names)"""})
def arr_explode_route(v):
    return profession_rows(v.raw_names).select("id", "target")


@query("json_doc_build", """SELECT concat('{"_id":', id, ',"type":"', type, '","title":"', title, '","originalTitle":"', originalTitle, '","startYear":', startYear,
    CASE WHEN endYear IS NOT NULL THEN concat(',"endYear":', endYear) ELSE '' END,
    CASE WHEN runtime IS NOT NULL THEN concat(',"runtime":', runtime) ELSE '' END,
    CASE WHEN avgRatings IS NOT NULL THEN concat(',"avgRatings":', CAST(avgRatings AS DECIMAL(3,1))) ELSE '' END,
    CASE WHEN numVotes IS NOT NULL THEN concat(',"numVotes":', numVotes) ELSE '' END, '}') AS doc FROM title""")
def json_doc_build(v):
    docs = v.title.withColumn("avgRatings", C("avgRatings").cast("decimal(3,1)")).withColumnRenamed("id", "_id")
    return documents.to_json_document(docs)


@query("json_unwrap_rename", """SELECT IMDb_ID AS _id, titleLabel AS title, cost, box_office AS box_office_revenue,
    box_office_currencyLabel AS currency_type, distributorLabel AS distributor, MPAA_film_ratingLabel AS film_rating FROM raw_enrichment""")
def json_unwrap_rename(v):
    from filmgrain.operators.updates import rename_enrichment
    from filmgrain.plans.inventory.sources import stage_enrichment
    from filmgrain.sources.readers import read_wrapped_json

    return rename_enrichment(read_wrapped_json(v.spark, stage_enrichment(v)))


@query("doc_assemble", """SELECT t.id AS _id, t.type, t.title, t.originalTitle, t.startYear, t.endYear, t.runtime, t.avgRatings AS avgRating, t.numVotes, g.genres, d.directors, w.writers, p.producers, a.cast_list FROM title t
    LEFT JOIN (SELECT titleid, string_agg(genre, ',' ORDER BY genre) AS genres FROM title_genre JOIN genre ON genreid = id GROUP BY titleid) g ON g.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(directorid, ',' ORDER BY directorid) AS directors FROM title_director GROUP BY titleid) d ON d.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(writerid, ',' ORDER BY writerid) AS writers FROM title_writer GROUP BY titleid) w ON w.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(producerid, ',' ORDER BY producerid) AS producers FROM title_producer GROUP BY titleid) p ON p.titleid = t.id
    LEFT JOIN (SELECT a.titleid, string_agg(concat(a.actorid, ':', coalesce(r.roles, '')), ';' ORDER BY a.actorid) AS cast_list
        FROM title_actor a LEFT JOIN (SELECT titleid, actorid, string_agg(role, '|' ORDER BY role) AS roles
            FROM actor_title_role JOIN role ON roleid = id GROUP BY titleid, actorid) r
        ON r.titleid = a.titleid AND r.actorid = a.actorid GROUP BY a.titleid) a ON a.titleid = t.id""")
def doc_assemble(v):
    return flat(docs_with(v, "genres", "director_id", "writer_id", "producer_id", "actors"))


def flat(docs):
    """Documents with their arrays as text."""
    ids = lambda c: F.array_join(C(c).cast("array<string>"), ",")
    cast = F.transform("actors", lambda a: F.concat(
        a["actor"].cast("string"), F.lit(":"), F.coalesce(F.array_join(a["role"], "|"), F.lit(""))
    ))
    return docs.select(
        "_id", "type", "title", "originalTitle", "startYear", "endYear", "runtime", "avgRating", "numVotes",
        F.array_join("genres", ",").alias("genres"),
        ids("director_id").alias("directors"), ids("writer_id").alias("writers"),
        ids("producer_id").alias("producers"), F.array_join(cast, ";").alias("cast_list"),
    )
