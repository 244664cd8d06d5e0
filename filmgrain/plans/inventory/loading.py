"""The whole load: cleaning, declared constraints, stored tables and rejects."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.operators import constraints
from filmgrain.plans import loading
from filmgrain.plans.inventory.etl import VIEWS, raw
from filmgrain.plans.registry import query
from filmgrain.workspace import stage_path

LIVING = "SELECT * FROM raw_names_lines WHERE deathYear IS NULL"


def _unique(table: str, rows: str, columns: str) -> str:
    """The first line of an id is kept, all others are not, by their content."""
    return f"""SELECT '{table}' AS "table", CAST(id AS VARCHAR) AS key, CASE WHEN nth = 1 THEN 'kept' ELSE 'id repeated' END AS outcome,
        count(*) AS copies FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY line) AS nth FROM {rows})
        GROUP BY {columns}, nth = 1"""


def _links(table: str, rows: str) -> str:
    key = schemas.KEYS[table]
    faults = " ".join(f"WHEN {c} NOT IN (SELECT id FROM {p}_rows) THEN [{{'outcome': '{c} unknown', 'copies': n}}]"
                      for c, p in schemas.PARENTS[table].items())
    names = ", ".join(key)
    return f"""SELECT '{table}' AS "table", concat_ws(',', {names}) AS key, outcome, copies FROM (SELECT {names}, unnest(CASE {faults}
        WHEN n > 1 THEN [{{'outcome': 'kept', 'copies': 1}}, {{'outcome': '{names} repeated', 'copies': n - 1}}]
        ELSE [{{'outcome': 'kept', 'copies': 1}}] END, recursive := true)
        FROM (SELECT {names}, count(*) AS n FROM ({rows}) GROUP BY {names}))"""


LOAD_VIEWS = {
    **{k: VIEWS[k] for k in ("role_rows", "role_ids")},
    "title_rows": """SELECT CAST(substr(coalesce(b.tconst, r.tconst), 3) AS BIGINT) AS id, titleType AS type, primaryTitle AS title, originalTitle,
        startYear, endYear, TRY_CAST(runtimeMinutes AS INTEGER) AS runtime, averageRating, numVotes, line
        FROM raw_basics_lines b FULL OUTER JOIN raw_ratings r ON r.tconst = b.tconst""",
    "member_rows": f"SELECT CAST(substr(nconst, 3) AS BIGINT) AS id, primaryName AS name, birthYear, deathYear, line FROM ({LIVING})",
    "genre_rows": """SELECT label AS genre, id, id AS line FROM (SELECT label, row_number() OVER (ORDER BY label) - 1 AS id
        FROM (SELECT DISTINCT label FROM genre_links))""",
    "genre_links": "SELECT CAST(substr(tconst, 3) AS BIGINT) AS titleid, unnest(string_split(genres, ',')) AS label FROM raw_basics_lines WHERE genres IS NOT NULL",
    "cast_rows": """SELECT DISTINCT CASE WHEN category IN ('actor', 'actress') THEN 'actor' ELSE category END AS link,
        CAST(substr(tconst, 3) AS BIGINT) AS titleid, CAST(substr(nconst, 3) AS BIGINT) AS person FROM raw_principals""",
}
SQL = " UNION ALL ".join([
    _unique("title", "title_rows", "id, type, title, originalTitle, startYear, endYear, runtime, averageRating, numVotes"),
    _unique("member", "member_rows", "id, name, birthYear, deathYear"),
    _unique("genre", "genre_rows", "id, genre"),
    """SELECT 'role', CAST(id AS VARCHAR), 'kept', 1 FROM role_ids""",
    _links("title_genre", "SELECT titleid, g.id AS genreid FROM genre_links JOIN genre_rows g ON g.genre = label"),
    _links("actor_title_role", "SELECT titleid, actorid, r.id AS roleid FROM role_rows JOIN role_ids r USING (role)").replace("role_rows) THEN", "role_ids) THEN"),
    *[_links(f"title_{link}", f"SELECT titleid, person AS {person} FROM cast_rows WHERE link = '{link}'")
      for link, person in loading.CAST_LINKS.items()],
])


@query("load_catalogue", SQL, LOAD_VIEWS)
def load_catalogue(v):
    """What became of every row of every table: dumps in which ids come again, and people who died left out of them."""
    dumps = {
        "title.basics": raw(v, "title.basics.lines", True), "title.ratings": raw(v, "title.ratings"),
        "name.basics": raw(v, "name.basics.lines", True).where("deathYear IS NULL"),
        "title.principals": raw(v, "title.principals"),
    }
    kept, rejects = loading.load_catalogue(dumps, stage_path(v.spark, "catalogue"))
    out = rejects.drop("row")
    for name, rows in kept.items():
        out = out.unionByName(rows.select(
            F.lit(name).alias("table"), constraints.key_text(loading.RULES[name]).alias("key"),
            F.lit(constraints.KEPT).alias("outcome"), F.lit(1).cast("bigint").alias("copies")))
    return out
