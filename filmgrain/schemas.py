"""Explicit schemas; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "decimal(3.1)": T.DecimalType(3, 1),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """Flat schema from ``name kind, ...``; no session is needed to import this."""
    pairs = [c.split() for c in columns.replace("(3,1)", "(3.1)").split(",")]
    return T.StructType([T.StructField(name, _KINDS[k]) for name, k in pairs])


def all_text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw tab-separated dumps: every field is text, backslash-N is null.
RAW = {
    "title.basics": all_text(
        "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
        "startYear", "endYear", "runtimeMinutes", "genres",
    ),
    "title.ratings": all_text("tconst", "averageRating", "numVotes"),
    "name.basics": all_text(
        "nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"
    ),
    "title.crew": all_text("tconst", "directors", "writers"),
    "title.principals": all_text("tconst", "ordering", "nconst", "category", "job", "characters"),
}

# The same dumps as typed frames; text that does not parse becomes null.
TYPED = {
    "title.basics": _struct(
        "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult int,"
        " startYear int, endYear int, runtimeMinutes bigint, genres string"
    ),
    "title.ratings": _struct("tconst string, averageRating double, numVotes bigint"),
    "name.basics": _struct(
        "nconst string, primaryName string, birthYear int, deathYear int,"
        " primaryProfession string, knownForTitles string"
    ),
    "title.crew": _struct("tconst string, directors string, writers string"),
    "title.principals": _struct(
        "tconst string, ordering int, nconst string, category string, job string, characters string"
    ),
}

# Normalised tables.
TABLES = {
    "title": _struct(
        "id bigint, type string, title string, originalTitle string, startYear int, endYear int,"
        " runtime int, avgRatings decimal(3,1), numVotes bigint"
    ),
    "genre": _struct("id bigint, genre string"),
    "role": _struct("id bigint, role string"),
    "member": _struct("id bigint, name string, birthYear int, deathYear int"),
    "title_genre": _struct("titleid bigint, genreid bigint"),
    "title_actor": _struct("titleid bigint, actorid bigint"),
    "title_writer": _struct("titleid bigint, writerid bigint"),
    "title_director": _struct("titleid bigint, directorid bigint"),
    "title_producer": _struct("titleid bigint, producerid bigint"),
    "actor_title_role": _struct("titleid bigint, actorid bigint, roleid bigint"),
}

# Declared text lengths of the normalised tables.
TEXT_LIMITS = {
    "title": {"type": 255, "title": 512, "originalTitle": 512},
    "genre": {"genre": 255},
    "role": {"role": 255},
    "member": {"name": 255},
}

# Declared keys of the normalised tables; of a link, the whole row.
KEYS = {name: ("id",) if "id" in table.names else tuple(table.names) for name, table in TABLES.items()}

# Declared parents: the table whose key a column holds.
PARENTS = {
    name: {"titleid": "title", **{c: "genre" if c == "genreid" else "role" if c == "roleid" else "member"
                                  for c in table.names if c != "titleid"}}
    for name, table in TABLES.items() if "titleid" in table.names
}

# Denormalised movie tables.
MOVIES = _struct(
    "title_id bigint, primary_title string, original_title string, release_year int,"
    " runtime_minutes int, genre_one string, genre_two string, genre_three string,"
    " ratings decimal(3,1), votes bigint"
)
PEOPLE = _struct("id bigint, first_name string, last_name string, birth_year int, death_year int")

# One nested document per title.
_ACTOR = T.StructType(
    [T.StructField("actor", T.LongType()), T.StructField("role", T.ArrayType(T.StringType()))]
)
DOCUMENT = T.StructType(
    _struct(
        "_id bigint, type string, title string, originalTitle string, startYear int, endYear int,"
        " runtime int, avgRating double, numVotes bigint"
    ).fields
    + [
        T.StructField("genres", T.ArrayType(T.StringType())),
        T.StructField("director_id", T.ArrayType(T.LongType())),
        T.StructField("writer_id", T.ArrayType(T.LongType())),
        T.StructField("producer_id", T.ArrayType(T.LongType())),
        T.StructField("actors", T.ArrayType(_ACTOR)),
    ]
)

# Enrichment JSON lines: every cell is {"value": ...}, any field may be missing.
ENRICHMENT_FIELDS = {
    "IMDb_ID": "_id",
    "titleLabel": "title",
    "cost": "cost",
    "box_office": "box_office_revenue",
    "box_office_currencyLabel": "currency_type",
    "distributorLabel": "distributor",
    "MPAA_film_ratingLabel": "film_rating",
}
ENRICHMENT = T.StructType(
    [T.StructField(n, _struct("value string")) for n in ENRICHMENT_FIELDS]
)

# Parquet tables the registered queries read.
GIVEN = {
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "supplier": _struct("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "customer": _struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "events": _struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}
