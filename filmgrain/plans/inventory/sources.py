"""Readers and writers, through files staged from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import dependencies, documents
from filmgrain.plans.registry import query
from filmgrain.sources import readers, writers
from filmgrain.workspace import stage_path


DUMPS = {
    "title.basics": "raw_basics", "title.ratings": "raw_ratings", "name.basics": "raw_names",
    "title.crew": "raw_crew", "title.principals": "raw_principals",
    # dumps in which keys come again, in the order of their lines
    "title.basics.lines": "raw_basics_lines", "name.basics.lines": "raw_names_lines",
}
_staged: dict[tuple[str, str, str], str] = {}


def staged_tsv(v, name: str) -> str:
    """Path of a raw dump as gzipped tab-separated text, a file a task, written once per application and folder."""
    key = (v.spark.sparkContext.applicationId, v.folder, name)
    if key not in _staged:
        path = stage_path(v.spark, name)
        rows = getattr(v, DUMPS[name])
        writers.write_tsv(rows.orderBy("line").drop("line") if "line" in rows.columns else rows, path, "gzip")
        _staged[key] = path
    return _staged[key]


@query("src_tsv", "SELECT tconst, titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtimeMinutes, genres FROM raw_basics")
def src_tsv(v):
    path = staged_tsv(v, "title.basics")
    return readers.read_tsv(v.spark, path, schemas.RAW["title.basics"])


@query("src_tsv_typed", """SELECT tconst, titleType, primaryTitle, originalTitle, CAST(isAdult AS INTEGER) AS isAdult,
    CAST(startYear AS INTEGER) AS startYear, CAST(endYear AS INTEGER) AS endYear,
    TRY_CAST(runtimeMinutes AS BIGINT) AS runtimeMinutes, genres FROM raw_basics""")
def src_tsv_typed(v):
    path = staged_tsv(v, "title.basics")
    return readers.read_tsv_typed(v.spark, path, schemas.TYPED["title.basics"])


@query("src_csv_null", "SELECT id, name AS member_name, birthYear AS born, deathYear AS died FROM member")
def src_csv_null(v):
    path = stage_path(v.spark, "member")
    writers.write_csv_nulls(v.member, path)
    # columns are taken by position, whatever the header calls them
    schema = "id bigint, member_name string, born int, died int"
    return readers.read_csv_table(v.spark, path, schema)


@query("src_csv_cols", "SELECT id, startYear, runtime FROM title")
def src_csv_cols(v):
    path = stage_path(v.spark, "title")
    writers.write_csv_nulls(v.title, path)
    return readers.read_csv_columns(v.spark, path, v.title.schema, ["id", "startYear", "runtime"])


ENRICHED = "line, IMDb_ID, titleLabel, cost, box_office, box_office_currencyLabel, distributorLabel, MPAA_film_ratingLabel"


def stage_enrichment(v) -> str:
    """JSON lines with every cell wrapped, missing cells absent, in event order."""
    key = (v.spark.sparkContext.applicationId, v.folder, "enrichment")
    if key in _staged:
        return _staged[key]
    path = stage_path(v.spark, "enrichment")
    cells = [
        F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("value"))).alias(c)
        for c in schemas.ENRICHMENT_FIELDS
    ]
    # some lines have a key that no schema names
    further = F.when(F.col("line") % 6 == 0, F.struct(F.concat(F.lit("Award "), "line").alias("value"))).alias("awardLabel")
    v.raw_enrichment.orderBy("line").select(F.to_json(F.struct(*cells, further)).alias("value")).write.text(path)
    _staged[key] = path
    return path


@query("src_jsonl_wrapped", """SELECT IMDb_ID, titleLabel, cost, box_office, box_office_currencyLabel,
    distributorLabel, MPAA_film_ratingLabel, CASE WHEN line % 6 = 0 THEN concat('awardLabel=Award ', line) ELSE '' END AS rest FROM raw_enrichment""")
def src_jsonl_wrapped(v):
    """Whole lines: ``rest`` lists the keys that the schema does not name, with their values."""
    lines = readers.read_wrapped_json_whole(v.spark, stage_enrichment(v))
    listed = F.transform(F.array_sort(F.map_entries("rest")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return lines.withColumn("rest", F.array_join(listed, ","))


@query("src_table", "SELECT id, genre FROM genre")
def src_table(v):
    path = stage_path(v.spark, "genre")
    v.genre.write.parquet(path)
    return readers.read_table(v.spark, path)


@query("sink_csv_null", """SELECT CAST(id AS VARCHAR) AS id, coalesce(CAST(endYear AS VARCHAR), 'None') AS endYear,
    coalesce(genres, 'None') AS genres FROM title JOIN (SELECT tconst, genres FROM raw_basics) ON
    tconst = concat('tt', lpad(CAST(id AS VARCHAR), 15, '0'))""")
def sink_csv_null(v):
    path = stage_path(v.spark, "csv")
    out = v.raw_basics.selectExpr(
        "cast(cast(substr(tconst, 3) AS bigint) AS string) AS id", "endYear", "coalesce(genres, '') AS genres"
    )
    writers.write_csv_nulls(out, path)
    return v.spark.read.csv(path, header=True, schema=schemas.all_text("id", "endYear", "genres"))


@query("sink_insert_ignore", """
    WITH incoming AS (SELECT l_orderkey AS title_id, 1000000000000 + l_suppkey AS person_id, l_linenumber AS line, l_partkey AS item,
             row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem
             WHERE l_linenumber > 1),
         stored AS (SELECT DISTINCT l_orderkey AS title_id, 1000000000000 + l_suppkey AS person_id FROM lineitem WHERE l_linenumber = 1)
    SELECT i.title_id, i.person_id, CASE WHEN rn > 1 THEN 'repeated key' WHEN s.title_id IS NOT NULL THEN 'key exists'
        ELSE 'inserted' END AS outcome, count(*) AS copies
    FROM incoming i LEFT JOIN stored s ON s.title_id = i.title_id AND s.person_id = i.person_id
    GROUP BY i.title_id, i.person_id, i.line, i.item, outcome""")
def sink_insert_ignore(v):
    pairs = v.lineitem.selectExpr(
        "l_orderkey AS title_id", "1000000000000 + l_suppkey AS person_id", "l_linenumber AS line", "l_partkey AS item"
    )
    path = stage_path(v.spark, "links")
    pairs.where("line = 1").select("title_id", "person_id").distinct().write.parquet(path)
    incoming = pairs.where("line > 1")
    accepted, rejected = writers.append_new(
        incoming, path, ["title_id", "person_id"], ["line", "item"]
    )
    inserted = accepted.select("*", F.lit(1).cast("bigint").alias("copies"), F.lit("inserted").alias("reason"))
    return inserted.unionByName(rejected).select(
        "title_id", "person_id", F.col("reason").alias("outcome"), "copies"
    )


@query("sink_ctas", """SELECT id AS producer, CAST(count(*) AS BIGINT) AS titles FROM title_producer
    JOIN member ON producerid = id GROUP BY id""")
def sink_ctas(v):
    name = f"snapshot_{uuid.uuid4().hex}"
    folder = stage_path(v.spark, "ctas")
    first = v.title_producer.groupBy(F.col("producerid").alias("producer")).agg(F.count("*").alias("titles"))
    writers.create_table_as(first, name, folder, bucket_by="producer", buckets=8)
    # the table exists by now, so this second definition changes nothing
    return writers.create_table_as(first.withColumn("titles", F.lit(0)), name, folder)


@query("sink_docs", """SELECT t.id AS _id, type, title, originalTitle, startYear, endYear, runtime, avgRatings AS avgRating, numVotes,
    g.genres, d.directors, w.writers, p.producers, a.cast_list FROM title t
    LEFT JOIN (SELECT titleid, string_agg(genre, ',' ORDER BY genre) AS genres FROM title_genre JOIN genre ON genreid = id GROUP BY titleid) g ON g.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(directorid, ',' ORDER BY directorid) AS directors FROM title_director GROUP BY titleid) d ON d.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(writerid, ',' ORDER BY writerid) AS writers FROM title_writer GROUP BY titleid) w ON w.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(producerid, ',' ORDER BY producerid) AS producers FROM title_producer GROUP BY titleid) p ON p.titleid = t.id
    LEFT JOIN (SELECT titleid, string_agg(entry, ';' ORDER BY actorid) AS cast_list FROM
        (SELECT c.titleid, c.actorid, concat(c.actorid, ':', coalesce(string_agg(role, '|' ORDER BY role), '')) AS entry FROM title_actor c
         LEFT JOIN (SELECT titleid, actorid, role FROM actor_title_role JOIN role ON roleid = role.id) r ON r.titleid = c.titleid AND r.actorid = c.actorid
         GROUP BY c.titleid, c.actorid) GROUP BY titleid) a ON a.titleid = t.id""")
def sink_docs(v):
    """Whole documents, arrays and cast included, written as JSON lines and read again."""
    from filmgrain.plans.inventory.documents import docs_with, flat

    path = stage_path(v.spark, "docs")
    writers.write_documents(docs_with(v, "genres", "director_id", "writer_id", "producer_id", "actors"), path)
    return flat(v.spark.read.schema(schemas.DOCUMENT).json(path))


@query("sink_replace", "SELECT id, name FROM member WHERE deathYear IS NULL")
def sink_replace(v):
    path = stage_path(v.spark, "replace")
    writers.replace_all(v.member.select("id", "name"), path)
    writers.replace_all(v.member.where("deathYear IS NULL").select("id", "name"), path)
    return readers.read_table(v.spark, path)


TITLE_COLUMNS = ("id", "type", "title", "originalTitle", "startYear", "endYear", "runtime", "avgRatings", "numVotes")


def _holds(left: str, right: str) -> str:
    """SQL for a dependency: each left value has one right value, which is not null."""
    return (f"SELECT '{left} -> {right}' AS value WHERE NOT EXISTS (SELECT 1 FROM title WHERE {left} IS NOT NULL "
            f"GROUP BY {left} HAVING count(DISTINCT {right}) > 1 OR count({right}) < count(*))")


@query("sink_text", " UNION ALL ".join(_holds(a, b) for a in TITLE_COLUMNS for b in TITLE_COLUMNS if a != b))
def sink_text(v):
    path = stage_path(v.spark, "deps")
    writers.write_dependencies(dependencies.single(v.title.select(*TITLE_COLUMNS)), path)
    return v.spark.read.text(path)
