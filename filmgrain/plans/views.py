"""Catalogue tables derived from the given star-schema tables.

The registered queries run over these: orders are titles, parts, suppliers and
customers are people, line items are the links between them. Every view comes twice,
as a DataFrame and as SQL text for the cross-check. Nulls are put in by arithmetic on
the keys, because the given tables have none.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators.documents import group_list
from filmgrain.operators.joins import encode_label, with_label

E = F.expr


class Catalogue:
    """Given tables and derived views of one data folder, made on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def stored(self):
        """The same catalogue as stored tables."""
        from filmgrain.plans.stored import StoredCatalogue

        return StoredCatalogue(self.spark, self.folder)

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.given("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.given("lineitem")

    @cached_property
    def part(self) -> DataFrame:
        return self.given("part")

    @cached_property
    def events(self) -> DataFrame:
        return self.given("events")

    @cached_property
    def title(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("id"),
            E("CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'O' THEN 'tvSeries' ELSE 'short' END").alias("type"),
            E("concat('Title ', o_orderkey div 2)").alias("title"),
            E("concat('Original ', o_orderkey)").alias("originalTitle"),
            F.year("o_orderdate").alias("startYear"),
            E("CASE WHEN o_orderkey % 7 = 0 THEN year(o_orderdate) + 1 END").alias("endYear"),
            E("CASE WHEN o_orderkey % 11 <> 0 THEN cast(o_orderkey % 180 + 20 AS int) END").alias("runtime"),
            E("CASE WHEN o_orderkey % 13 <> 0 THEN floor(o_totalprice / 5000) / 10.0D END").alias("avgRatings"),
            E("CASE WHEN o_orderkey % 13 <> 0 THEN floor(o_totalprice) END").alias("numVotes"),
        )

    @cached_property
    def genre(self) -> DataFrame:
        return _numbered(self.part.select(F.col("p_type").alias("genre")), "genre")

    @cached_property
    def title_genre(self) -> DataFrame:
        lines = self.lineitem.where("l_linenumber <= 3 AND l_orderkey % 17 <> 0")
        kinds = encode_label(self.part.selectExpr("p_partkey", "p_type AS genre"), self.genre, "genre", "genreid")
        return lines.join(kinds, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("titleid"), "genreid"
        ).distinct()

    @cached_property
    def labelled_genre(self) -> DataFrame:
        return with_label(self.title_genre, self.genre, "genreid", "genre").select("titleid", "genre")

    @cached_property
    def member(self) -> DataFrame:
        part = self.part.selectExpr(
            "p_partkey AS id", "p_name AS name", "1940 + p_size AS birthYear",
            "CASE WHEN p_partkey % 4 = 0 THEN 2000 + p_size % 20 END AS deathYear",
        )
        supplier = self.given("supplier").selectExpr(
            "1000000000000 + s_suppkey AS id", "s_name AS name",
            "cast(1950 + s_suppkey % 40 AS int) AS birthYear",
            "CASE WHEN s_suppkey % 5 = 0 THEN 2010 END AS deathYear",
        )
        customer = self.given("customer").selectExpr(
            "2000000000000 + c_custkey AS id", "c_name AS name", "1960 AS birthYear",
            "cast(NULL AS int) AS deathYear",
        )
        return part.unionByName(supplier).unionByName(customer)

    @cached_property
    def title_actor(self) -> DataFrame:
        return self.lineitem.selectExpr("l_orderkey AS titleid", "l_partkey AS actorid").distinct()

    @cached_property
    def title_producer(self) -> DataFrame:
        return self.lineitem.selectExpr(
            "l_orderkey AS titleid", "1000000000000 + l_suppkey AS producerid"
        ).distinct()

    @cached_property
    def title_director(self) -> DataFrame:
        return self.orders.selectExpr("o_orderkey AS titleid", "2000000000000 + o_custkey AS directorid")

    @cached_property
    def title_writer(self) -> DataFrame:
        return self.lineitem.where("l_linenumber >= 6").selectExpr(
            "l_orderkey AS titleid", "l_partkey AS writerid"
        ).distinct()

    @cached_property
    def role(self) -> DataFrame:
        return _numbered(self.lineitem.select(_role_label().alias("role")), "role")

    @cached_property
    def actor_title_role(self) -> DataFrame:
        rows = self.lineitem.where("l_linenumber <= 5").select(
            F.col("l_orderkey").alias("titleid"), F.col("l_partkey").alias("actorid"), _role_label().alias("role"),
        ).distinct()
        return encode_label(rows, self.role, "role", "roleid").select("titleid", "actorid", "roleid")

    @cached_property
    def baskets(self) -> DataFrame:
        return self.title_producer.toDF("basket", "item")

    # raw dumps, as text

    @cached_property
    def raw_basics(self) -> DataFrame:
        # at most one entry per dictionary genre
        genres = self.labelled_genre.groupBy("titleid").agg(
            F.array_join(F.sort_array(F.collect_list("genre")), ",").alias("genres")
        )
        return self.title.join(genres, F.col("id") == F.col("titleid"), "left").selectExpr(
            "concat('tt', lpad(id, 15, '0')) AS tconst", "type AS titleType",
            "CASE WHEN id % 29 = 0 THEN concat('\"', title) ELSE title END AS primaryTitle",
            "originalTitle", "CASE WHEN id % 19 = 0 THEN '1' ELSE '0' END AS isAdult",
            "cast(startYear AS string) AS startYear", "cast(endYear AS string) AS endYear",
            "CASE WHEN id % 31 = 0 THEN 'Reality-TV' ELSE cast(runtime AS string) END AS runtimeMinutes",
            "genres",
        )

    @cached_property
    def raw_basics_lines(self) -> DataFrame:
        return _lines(self.raw_basics, "primaryTitle")

    @cached_property
    def raw_names_lines(self) -> DataFrame:
        return _lines(self.raw_names, "primaryName")

    @cached_property
    def raw_ratings(self) -> DataFrame:
        v = "cast(floor(o_totalprice / 5000) AS bigint)"
        return self.orders.selectExpr(
            "concat('tt', CASE WHEN o_orderkey % 13 = 0 THEN cast(o_orderkey + 5000000000000 AS string)"
            " ELSE lpad(o_orderkey, 15, '0') END) AS tconst",
            f"concat({v} div 10, '.', {v} % 10) AS averageRating",
            "cast(cast(floor(o_totalprice) AS bigint) AS string) AS numVotes",
        )

    @cached_property
    def raw_names(self) -> DataFrame:
        return self.member.selectExpr(
            "concat('nm', lpad(id, 15, '0')) AS nconst", "name AS primaryName",
            "cast(birthYear AS string) AS birthYear", "cast(deathYear AS string) AS deathYear",
            "CASE WHEN id >= 2000000000000 THEN CASE WHEN id % 2 = 0 THEN 'director' ELSE 'director,miscellaneous' END"
            " WHEN id >= 1000000000000 THEN CASE WHEN id % 3 = 0 THEN 'producer,writer' ELSE 'producer' END"
            " WHEN id % 5 = 0 THEN 'actress,actor,writer' WHEN id % 5 = 1 THEN 'actor'"
            " WHEN id % 5 = 2 THEN 'actor,director' WHEN id % 5 = 3 THEN 'writer,actor,producer' END AS primaryProfession",
            "concat('tt', lpad(id % 1000, 15, '0')) AS knownForTitles",
        )

    @cached_property
    def raw_crew(self) -> DataFrame:
        # a list beyond the bound goes on in a further line of its title
        lists = group_list(self.title_writer, "titleid", "writerid", "ids")
        writers = lists.selectExpr(
            "titleid", "array_join(transform(ids, w -> concat('nm', lpad(w, 15, '0'))), ',') AS writers"
        )
        return self.title_director.join(writers, "titleid", "left").selectExpr(
            "concat('tt', lpad(titleid, 15, '0')) AS tconst",
            "concat('nm', lpad(directorid, 15, '0')) AS directors", "writers",
        )

    @cached_property
    def raw_principals(self) -> DataFrame:
        actors = self.lineitem.selectExpr(
            "l_orderkey AS t", "l_linenumber AS o", "l_partkey AS n",
            "CASE WHEN l_partkey % 2 = 0 THEN 'actor' ELSE 'actress' END AS category",
            "cast(NULL AS string) AS job",
            "CASE WHEN l_linenumber = 1 THEN concat('[\"', l_returnflag, '-', l_linestatus, '-', l_linenumber, '\",\"Self\"]')"
            " WHEN l_linenumber <= 5 THEN concat('[\"', l_returnflag, '-', l_linestatus, '-', l_linenumber, '\"]') END AS characters",
        )
        producers = self.lineitem.selectExpr(
            "l_orderkey AS t", "l_linenumber + 10 AS o", "1000000000000 + l_suppkey AS n", "'producer' AS category",
            "'executive' AS job", "cast(NULL AS string) AS characters",
        )
        directors = self.title_director.selectExpr(
            "titleid AS t", "20 AS o", "directorid AS n", "'director' AS category",
            "cast(NULL AS string) AS job", "cast(NULL AS string) AS characters",
        )
        writers = self.title_writer.selectExpr(
            "titleid AS t", "21 AS o", "writerid AS n", "'writer' AS category",
            "'screenplay' AS job", "cast(NULL AS string) AS characters",
        )
        rows = actors.unionByName(producers).unionByName(directors).unionByName(writers)
        return rows.selectExpr(
            "concat('tt', lpad(t, 15, '0')) AS tconst", "cast(o AS string) AS ordering",
            "concat('nm', lpad(n, 15, '0')) AS nconst", "category", "job", "characters",
        )

    @cached_property
    def raw_enrichment(self) -> DataFrame:
        """Enrichment cells as text, one row per event, ordered by ``line``."""
        return self.events.selectExpr(
            "event_id AS line",
            "CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN concat('nm', event_id)"
            " WHEN 2 THEN concat('tt', event_id + 5000000000000)"
            " ELSE concat('tt', lpad(event_id - event_id % 4, 15, '0')) END AS IMDb_ID",
            "CASE WHEN event_id % 9 <> 0 THEN concat('Title ', event_id div 3) END AS titleLabel",
            "CASE WHEN event_type = 'purchase' THEN cast(event_id * 100 AS string) END AS cost",
            "CASE WHEN event_id % 5 = 3 THEN cast(user_id * 1000 AS string) END AS box_office",
            "CASE WHEN event_id % 5 = 3 THEN 'USD' END AS box_office_currencyLabel",
            "CASE WHEN event_type = 'view' THEN concat('Studio ', user_id) END AS distributorLabel",
            "CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'PG-13' END AS MPAA_film_ratingLabel",
        )


def _numbered(labels: DataFrame, label: str) -> DataFrame:
    """Ids 0, 1, ... in order of the whole labels. Only distinct labels are sorted in one task, a dictionary."""
    return labels.distinct().select(
        (F.row_number().over(Window.orderBy(label)) - 1).cast("bigint").alias("id"), label)


def _lines(dump: DataFrame, label: str) -> DataFrame:
    """A dump with its lines numbered: some keys have a line with another label before, and copies far behind."""
    key = F.substring(dump.columns[0], 3, 15).cast("bigint")
    rows = dump.withColumn("line", 2 * key + 1)
    before = dump.where(key % 23 == 0).withColumn("line", 2 * key).withColumn(label, F.concat(label, F.lit(" (again)")))
    behind = dump.where(key % 46 == 0).withColumn("line", 2 * key + 10**15)
    return rows.unionByName(before).unionByName(behind)


def _role_label():
    return E("concat(l_returnflag, '-', l_linestatus, '-', l_linenumber)")


_V = "CAST(floor(o_totalprice / 5000) AS BIGINT)"
_ROLE = "concat(l_returnflag, '-', l_linestatus, '-', l_linenumber)"


def _lines_sql(dump: str, key: str, label: str) -> str:
    number = f"CAST(substr({key}, 3) AS BIGINT)"
    return (f"SELECT *, 2 * {number} + 1 AS line FROM {dump} UNION ALL "
            f"SELECT * REPLACE (concat({label}, ' (again)') AS {label}), 2 * {number} FROM {dump} WHERE {number} % 23 = 0 UNION ALL "
            f"SELECT *, 2 * {number} + 1000000000000000 FROM {dump} WHERE {number} % 46 = 0")


VIEWS_SQL = {
    "title": """SELECT o_orderkey AS id,
        CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'O' THEN 'tvSeries' ELSE 'short' END AS type,
        concat('Title ', o_orderkey // 2) AS title, concat('Original ', o_orderkey) AS originalTitle,
        CAST(year(o_orderdate) AS INTEGER) AS startYear,
        CASE WHEN o_orderkey % 7 = 0 THEN CAST(year(o_orderdate) + 1 AS INTEGER) END AS endYear,
        CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 180 + 20 AS INTEGER) END AS runtime,
        CASE WHEN o_orderkey % 13 <> 0 THEN floor(o_totalprice / 5000) / 10 END AS avgRatings,
        CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS numVotes
        FROM orders""",
    "genre": "SELECT row_number() OVER (ORDER BY genre) - 1 AS id, genre FROM (SELECT DISTINCT p_type AS genre FROM part)",
    "title_genre": """SELECT DISTINCT l_orderkey AS titleid, genre.id AS genreid
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN genre ON genre.genre = p_type
        WHERE l_linenumber <= 3 AND l_orderkey % 17 <> 0""",
    "member": """SELECT p_partkey AS id, p_name AS name, CAST(1940 + p_size AS INTEGER) AS birthYear,
        CASE WHEN p_partkey % 4 = 0 THEN CAST(2000 + p_size % 20 AS INTEGER) END AS deathYear FROM part
        UNION ALL SELECT 1000000000000 + s_suppkey, s_name, CAST(1950 + s_suppkey % 40 AS INTEGER),
        CASE WHEN s_suppkey % 5 = 0 THEN 2010 END FROM supplier
        UNION ALL SELECT 2000000000000 + c_custkey, c_name, 1960, CAST(NULL AS INTEGER) FROM customer""",
    "title_actor": "SELECT DISTINCT l_orderkey AS titleid, l_partkey AS actorid FROM lineitem",
    "title_producer": "SELECT DISTINCT l_orderkey AS titleid, 1000000000000 + l_suppkey AS producerid FROM lineitem",
    "title_director": "SELECT o_orderkey AS titleid, 2000000000000 + o_custkey AS directorid FROM orders",
    "title_writer": "SELECT DISTINCT l_orderkey AS titleid, l_partkey AS writerid FROM lineitem WHERE l_linenumber >= 6",
    "role": f"SELECT row_number() OVER (ORDER BY role) - 1 AS id, role FROM (SELECT DISTINCT {_ROLE} AS role FROM lineitem)",
    "actor_title_role": f"""SELECT DISTINCT l_orderkey AS titleid, l_partkey AS actorid, role.id AS roleid
        FROM lineitem JOIN role ON role.role = {_ROLE} WHERE l_linenumber <= 5""",
    "baskets": "SELECT DISTINCT l_orderkey AS basket, 1000000000000 + l_suppkey AS item FROM lineitem",
    "raw_basics": """SELECT concat('tt', lpad(CAST(id AS VARCHAR), 15, '0')) AS tconst, type AS titleType,
        CASE WHEN id % 29 = 0 THEN concat('"', title) ELSE title END AS primaryTitle, originalTitle,
        CASE WHEN id % 19 = 0 THEN '1' ELSE '0' END AS isAdult,
        CAST(startYear AS VARCHAR) AS startYear, CAST(endYear AS VARCHAR) AS endYear,
        CASE WHEN id % 31 = 0 THEN 'Reality-TV' ELSE CAST(runtime AS VARCHAR) END AS runtimeMinutes, g.genres
        FROM title LEFT JOIN (SELECT titleid, string_agg(genre, ',' ORDER BY genre) AS genres
            FROM title_genre JOIN genre ON genreid = genre.id GROUP BY titleid) g ON g.titleid = title.id""",
    "raw_basics_lines": _lines_sql("raw_basics", "tconst", "primaryTitle"),
    "raw_names_lines": _lines_sql("raw_names", "nconst", "primaryName"),
    "raw_ratings": f"""SELECT concat('tt', CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey + 5000000000000 AS VARCHAR)
            ELSE lpad(CAST(o_orderkey AS VARCHAR), 15, '0') END) AS tconst,
        concat({_V} // 10, '.', {_V} % 10) AS averageRating,
        CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS numVotes FROM orders""",
    "raw_names": """SELECT concat('nm', lpad(CAST(id AS VARCHAR), 15, '0')) AS nconst, name AS primaryName,
        CAST(birthYear AS VARCHAR) AS birthYear, CAST(deathYear AS VARCHAR) AS deathYear,
        CASE WHEN id >= 2000000000000 THEN CASE WHEN id % 2 = 0 THEN 'director' ELSE 'director,miscellaneous' END
            WHEN id >= 1000000000000 THEN CASE WHEN id % 3 = 0 THEN 'producer,writer' ELSE 'producer' END
            WHEN id % 5 = 0 THEN 'actress,actor,writer' WHEN id % 5 = 1 THEN 'actor'
            WHEN id % 5 = 2 THEN 'actor,director' WHEN id % 5 = 3 THEN 'writer,actor,producer' END AS primaryProfession,
        concat('tt', lpad(CAST(id % 1000 AS VARCHAR), 15, '0')) AS knownForTitles FROM member""",
    "raw_crew": """SELECT concat('tt', lpad(CAST(d.titleid AS VARCHAR), 15, '0')) AS tconst,
        concat('nm', lpad(CAST(directorid AS VARCHAR), 15, '0')) AS directors, w.writers
        FROM title_director d LEFT JOIN (SELECT titleid,
            string_agg(concat('nm', lpad(CAST(writerid AS VARCHAR), 15, '0')), ',' ORDER BY writerid) AS writers
            FROM title_writer GROUP BY titleid) w ON w.titleid = d.titleid""",
    "raw_principals": """SELECT concat('tt', lpad(CAST(t AS VARCHAR), 15, '0')) AS tconst, CAST(o AS VARCHAR) AS ordering,
        concat('nm', lpad(CAST(n AS VARCHAR), 15, '0')) AS nconst, category, job, characters FROM (
        SELECT l_orderkey AS t, l_linenumber AS o, l_partkey AS n,
            CASE WHEN l_partkey % 2 = 0 THEN 'actor' ELSE 'actress' END AS category, NULL AS job,
            CASE WHEN l_linenumber = 1 THEN concat('["', l_returnflag, '-', l_linestatus, '-', l_linenumber, '","Self"]')
                WHEN l_linenumber <= 5 THEN concat('["', l_returnflag, '-', l_linestatus, '-', l_linenumber, '"]') END AS characters
            FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber + 10, 1000000000000 + l_suppkey, 'producer', 'executive', NULL FROM lineitem
        UNION ALL SELECT titleid, 20, directorid, 'director', NULL, NULL FROM title_director
        UNION ALL SELECT titleid, 21, writerid, 'writer', 'screenplay', NULL FROM title_writer)""",
    "raw_enrichment": """SELECT event_id AS line,
        CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN concat('nm', event_id)
            WHEN 2 THEN concat('tt', event_id + 5000000000000)
            ELSE concat('tt', lpad(CAST(event_id - event_id % 4 AS VARCHAR), 15, '0')) END AS IMDb_ID,
        CASE WHEN event_id % 9 <> 0 THEN concat('Title ', event_id // 3) END AS titleLabel,
        CASE WHEN event_type = 'purchase' THEN CAST(event_id * 100 AS VARCHAR) END AS cost,
        CASE WHEN event_id % 5 = 3 THEN CAST(user_id * 1000 AS VARCHAR) END AS box_office,
        CASE WHEN event_id % 5 = 3 THEN 'USD' END AS box_office_currencyLabel,
        CASE WHEN event_type = 'view' THEN concat('Studio ', user_id) END AS distributorLabel,
        CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'PG-13' END AS MPAA_film_ratingLabel FROM events""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it mentions, and the views those mention."""
    known = {**VIEWS_SQL, **(extra or {})}
    needed: list[str] = []

    def visit(text: str, within: str | None = None) -> None:
        for name in known:
            if name == within or name in needed:
                continue
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(known[name], name)
                needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS ({known[n]})" for n in needed)
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body.lstrip()[len('WITH RECURSIVE'):]}"
    if body.lstrip().upper().startswith("WITH"):
        return f"WITH {ctes},\n{body.lstrip()[len('WITH'):]}"
    return f"WITH {ctes}\n{body}"
