"""Whole cleaning jobs, from staged raw dumps."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmgrain import schemas
from filmgrain.plans import etl
from filmgrain.plans.inventory.sources import staged_tsv
from filmgrain.plans.registry import query
from filmgrain.sources.readers import read_tsv

C = F.col


def raw(v, name, position=False):
    return read_tsv(v.spark, staged_tsv(v, name), schemas.RAW[name.removesuffix(".lines")], position)


VIEWS = {
    "movies": """SELECT CAST(substr(b.tconst, 3) AS BIGINT) AS title_id, primaryTitle AS primary_title, originalTitle AS original_title,
        TRY_CAST(startYear AS INTEGER) AS release_year, TRY_CAST(runtimeMinutes AS INTEGER) AS runtime_minutes,
        split_part(genres, ',', 1) AS genre_one, nullif(split_part(genres, ',', 2), '') AS genre_two, nullif(split_part(genres, ',', 3), '') AS genre_three,
        CAST(averageRating AS DOUBLE) AS ratings, CAST(numVotes AS BIGINT) AS votes
        FROM raw_basics b LEFT JOIN raw_ratings r ON r.tconst = b.tconst WHERE titleType = 'movie' AND isAdult = '0'""",
    "jobs": """SELECT *, unnest(CASE WHEN len(acting) = 2 THEN list_filter(j, lambda x, i: i <> list_position(j, acting[-1])) ELSE j END) AS job
        FROM (SELECT *, list_filter(j, lambda x: contains(x, 'ACT')) AS acting FROM
            (SELECT *, string_split(upper(primaryProfession), ',') AS j FROM raw_names))""",
    "people": """SELECT CASE WHEN job IN ('ACTOR', 'ACTRESS') THEN 'actors' WHEN job = 'DIRECTOR' THEN 'directors'
            WHEN job = 'WRITER' THEN 'writers' ELSE 'producers' END AS target, CAST(substr(nconst, 3) AS BIGINT) AS id,
        split_part(primaryName, ' ', 1) AS first_name,
        CASE WHEN strpos(primaryName, ' ') > 0 THEN substr(primaryName, strpos(primaryName, ' ') + 1) END AS last_name,
        CAST(birthYear AS INTEGER) AS birth_year, CAST(deathYear AS INTEGER) AS death_year
        FROM jobs WHERE job IN ('ACTOR', 'ACTRESS', 'DIRECTOR', 'WRITER', 'PRODUCER')""",
    "movie_lines": """SELECT CAST(substr(b.tconst, 3) AS BIGINT) AS title_id, primaryTitle AS primary_title, originalTitle AS original_title,
        TRY_CAST(startYear AS INTEGER) AS release_year, TRY_CAST(runtimeMinutes AS INTEGER) AS runtime_minutes,
        split_part(genres, ',', 1) AS genre_one, nullif(split_part(genres, ',', 2), '') AS genre_two, nullif(split_part(genres, ',', 3), '') AS genre_three,
        CAST(averageRating AS DOUBLE) AS ratings, CAST(numVotes AS BIGINT) AS votes, line
        FROM raw_basics_lines b LEFT JOIN raw_ratings r ON r.tconst = b.tconst WHERE titleType = 'movie' AND isAdult = '0'""",
    "job_lines": """SELECT *, unnest(CASE WHEN len(acting) = 2 THEN list_filter(j, lambda x, i: i <> list_position(j, acting[-1])) ELSE j END) AS job
        FROM (SELECT *, list_filter(j, lambda x: contains(x, 'ACT')) AS acting FROM
            (SELECT *, string_split(upper(primaryProfession), ',') AS j FROM raw_names_lines))""",
    "people_lines": """SELECT CASE WHEN job IN ('ACTOR', 'ACTRESS') THEN 'actors' WHEN job = 'DIRECTOR' THEN 'directors'
            WHEN job = 'WRITER' THEN 'writers' ELSE 'producers' END AS target, CAST(substr(nconst, 3) AS BIGINT) AS id,
        split_part(primaryName, ' ', 1) AS first_name,
        CASE WHEN strpos(primaryName, ' ') > 0 THEN substr(primaryName, strpos(primaryName, ' ') + 1) END AS last_name,
        CAST(birthYear AS INTEGER) AS birth_year, CAST(deathYear AS INTEGER) AS death_year, line
        FROM job_lines WHERE job IN ('ACTOR', 'ACTRESS', 'DIRECTOR', 'WRITER', 'PRODUCER')""",
    "crew_rows": """SELECT 'directors' AS target, CAST(substr(tconst, 3) AS BIGINT) AS title_id,
            CAST(replace(unnest(string_split(directors, ',')), 'nm', '') AS BIGINT) AS person_id FROM raw_crew
        UNION ALL SELECT 'writers', CAST(substr(tconst, 3) AS BIGINT), CAST(replace(unnest(string_split(writers, ',')), 'nm', '') AS BIGINT)
        FROM raw_crew WHERE writers IS NOT NULL""",
    "principal_rows": """SELECT CASE WHEN category IN ('actor', 'actress') THEN 'actors' ELSE concat(category, 's') END AS target,
        CAST(substr(tconst, 3) AS BIGINT) AS title_id, CAST(substr(nconst, 3) AS BIGINT) AS person_id FROM raw_principals""",
    "role_rows": """SELECT titleid, actorid, role FROM (SELECT CAST(substr(tconst, 3) AS BIGINT) AS titleid, CAST(substr(nconst, 3) AS BIGINT) AS actorid,
        unnest(string_split(replace(replace(replace(characters, '[', ''), ']', ''), '"', ''), ',')) AS role
        FROM raw_principals WHERE characters IS NOT NULL AND category IN ('actor', 'actress')) WHERE role <> ''""",
    "role_ids": "SELECT role, row_number() OVER (ORDER BY role) - 1 AS id FROM (SELECT DISTINCT role FROM role_rows)",
    "genre_rows": "SELECT CAST(substr(tconst, 3) AS BIGINT) AS titleid, unnest(string_split(genres, ',')) AS genre FROM raw_basics WHERE genres IS NOT NULL",
    "genre_ids": "SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS id FROM (SELECT DISTINCT genre FROM genre_rows)",
}


def etl_query(name, sql):
    return query(name, sql, VIEWS)


MOVIE = "title_id, primary_title, original_title, release_year, runtime_minutes, genre_one, genre_two, genre_three"
PERSON = "target, id, first_name, last_name, birth_year, death_year"


@etl_query("etl_movies", f"""SELECT {MOVIE}, CASE WHEN nth = 1 THEN ratings END AS ratings, CASE WHEN nth = 1 THEN votes END AS votes,
    CASE WHEN nth = 1 THEN 'kept' ELSE 'repeated key' END AS outcome, count(*) AS copies FROM
    (SELECT *, row_number() OVER (PARTITION BY title_id ORDER BY line) AS nth FROM movie_lines)
    GROUP BY {MOVIE}, 9, 10, outcome""")
def etl_movies(v):
    """Movies as kept, then the lines that lost to an earlier line of their id, with their number of copies."""
    kept, repeated = etl.movies(raw(v, "title.basics.lines", True), raw(v, "title.ratings"))
    return with_rejects(kept, repeated).withColumn("ratings", C("ratings").cast("double"))


def with_rejects(kept, repeated):
    kept = kept.withColumns({"outcome": F.lit("kept"), "copies": F.lit(1).cast("bigint")})
    return kept.unionByName(repeated.withColumn("outcome", F.lit("repeated key")))


@etl_query("etl_people", f"""SELECT {PERSON}, CASE WHEN nth = 1 THEN 'kept' ELSE 'repeated key' END AS outcome, count(*) AS copies FROM
    (SELECT *, row_number() OVER (PARTITION BY target, id ORDER BY line) AS nth FROM people_lines) GROUP BY {PERSON}, outcome""")
def etl_people(v):
    return with_rejects(*etl.people(raw(v, "name.basics.lines", True))).select(*PERSON.split(", "), "outcome", "copies")


def parents(v):
    return etl.movie_ids(raw(v, "title.basics")), etl.profession_rows(raw(v, "name.basics"))


JUDGED = """SELECT target, title_id, person_id, outcome, copies FROM
    (SELECT target, title_id, person_id, unnest(CASE WHEN title_id NOT IN (SELECT title_id FROM movies) THEN [{{'outcome': 'unknown title', 'copies': n}}]
      WHEN (target, person_id) NOT IN (SELECT target, id FROM people) THEN [{{'outcome': 'unknown person', 'copies': n}}]
      WHEN n > 1 THEN [{{'outcome': 'kept', 'copies': 1}}, {{'outcome': 'repeated', 'copies': n - 1}}]
      ELSE [{{'outcome': 'kept', 'copies': 1}}] END, recursive := true)
     FROM (SELECT target, title_id, person_id, count(*) AS n FROM ({rows}) GROUP BY ALL))"""


@etl_query("etl_crew_links", JUDGED.format(rows="SELECT * FROM crew_rows"))
def etl_crew_links(v):
    """Every link with what became of it."""
    return etl.known_links(etl.crew_rows(raw(v, "title.crew")), *parents(v))


@etl_query("etl_principal_links", JUDGED.format(rows="SELECT * FROM principal_rows UNION ALL SELECT * FROM crew_rows"))
def etl_principal_links(v):
    rows = etl.principal_rows(raw(v, "title.principals")).unionByName(etl.crew_rows(raw(v, "title.crew")))
    return etl.known_links(rows, *parents(v))


@etl_query("etl_titles", """SELECT CAST(substr(coalesce(b.tconst, r.tconst), 3) AS BIGINT) AS id, titleType AS type, primaryTitle AS title, originalTitle,
    TRY_CAST(startYear AS INTEGER) AS startYear, TRY_CAST(endYear AS INTEGER) AS endYear, TRY_CAST(runtimeMinutes AS INTEGER) AS runtime,
    CAST(averageRating AS DOUBLE) AS avgRatings, CAST(numVotes AS BIGINT) AS numVotes
    FROM raw_basics b FULL OUTER JOIN raw_ratings r ON r.tconst = b.tconst""")
def etl_titles(v):
    out = etl.titles(raw(v, "title.basics"), raw(v, "title.ratings"))
    return out.withColumn("avgRatings", C("avgRatings").cast("double"))


@etl_query("etl_genres", """SELECT 'genre' AS "table", NULL::BIGINT AS titleid, id, genre FROM genre_ids
    UNION ALL SELECT 'title_genre', titleid, id, NULL FROM genre_rows JOIN genre_ids USING (genre)""")
def etl_genres(v):
    dictionary, links = etl.genres(raw(v, "title.basics"))
    return dictionary.selectExpr("'genre' AS table", "cast(NULL AS bigint) AS titleid", "id", "genre").unionByName(
        links.selectExpr("'title_genre' AS table", "titleid", "genreid AS id", "cast(NULL AS string) AS genre")
    )


@etl_query("etl_members", """SELECT CAST(substr(nconst, 3) AS BIGINT) AS id, primaryName AS name, CAST(birthYear AS INTEGER) AS birthYear,
    CAST(deathYear AS INTEGER) AS deathYear FROM raw_names""")
def etl_members(v):
    return etl.members(raw(v, "name.basics"))


@etl_query("etl_principals", """SELECT DISTINCT CASE WHEN category IN ('actor', 'actress') THEN 'actor' ELSE category END AS link,
    CAST(substr(tconst, 3) AS BIGINT) AS titleid, CAST(substr(nconst, 3) AS BIGINT) AS person FROM raw_principals""")
def etl_principals(v):
    return etl.principal_links(raw(v, "title.principals"))


@etl_query("etl_roles", """SELECT 'role' AS "table", NULL::BIGINT AS titleid, NULL::BIGINT AS actorid, id, role FROM role_ids
    UNION ALL SELECT 'link', titleid, actorid, id, NULL FROM role_rows JOIN role_ids USING (role)""")
def etl_roles(v):
    dictionary, links = etl.roles(raw(v, "title.principals"))
    return dictionary.selectExpr(
        "'role' AS table", "cast(NULL AS bigint) AS titleid", "cast(NULL AS bigint) AS actorid", "id", "role"
    ).unionByName(links.selectExpr(
        "'link' AS table", "titleid", "actorid", "roleid AS id", "cast(NULL AS string) AS role"
    ))
