"""Source views, global schema and its queries."""

from __future__ import annotations

import uuid

from filmgrain.plans import integration as gav
from filmgrain.plans.registry import query
from filmgrain.workspace import stage_path

KIND = "PROMO"
PERIOD = {"after": 1996, "before": 2000, "least": 5}

#: One flag per movie and one per actor; every view is a choice by flags.
VIEWS = {
    "film": f"""SELECT id, title, startYear, coalesce(runtime, 0) >= 75 AS full_length, id IN (
          SELECT titleid FROM title_genre WHERE genreid = (SELECT id FROM genre WHERE genre = '{KIND}')) AS comic
        FROM title WHERE type = 'movie'""",
    "player": "SELECT actorid, bool_or(comic) AS ever_comic FROM title_actor JOIN film ON titleid = film.id GROUP BY actorid",
    "labelled": f"""SELECT film.*, CASE WHEN comic THEN '{KIND}' ELSE first_label END AS genre FROM film JOIN (
          SELECT titleid, min(genre) AS first_label FROM title_genre, genre WHERE genreid = genre.id GROUP BY titleid)
        ON titleid = film.id WHERE full_length""",
}
PERSON = "id, name, birthYear, deathYear"


def view_query(name, sql):
    return query(name, sql, VIEWS)


def sources(v):
    return gav.sources(
        v.member, v.title, v.title_genre, v.genre, v.title_actor, KIND
    )


def schema(v):
    return gav.over_tables(
        v.member, v.title, v.title_genre, v.genre, v.title_actor, KIND
    )


@view_query("view_comedy_movie", "SELECT id, title, startYear FROM film WHERE full_length AND comic")
def view_comedy_movie(v):
    return sources(v).comedy_movie


@view_query("view_non_comedy_movie", "SELECT id, title, startYear FROM film WHERE full_length AND NOT comic")
def view_non_comedy_movie(v):
    return sources(v).non_comedy_movie


@view_query("view_comedy_actor", f"SELECT {PERSON} FROM member WHERE id IN (SELECT actorid FROM player WHERE ever_comic)")
def view_comedy_actor(v):
    return sources(v).comedy_actor


@view_query("view_non_comedy_actor", f"SELECT {PERSON} FROM member WHERE id IN (SELECT actorid FROM player WHERE NOT ever_comic)")
def view_non_comedy_actor(v):
    return sources(v).non_comedy_actor


@view_query("view_acted_in", "SELECT titleid, actorid FROM title_actor WHERE titleid IN (SELECT id FROM film)")
def view_acted_in(v):
    return sources(v).acted_in


@view_query("view_all_movie", "SELECT id, title, startYear, genre FROM labelled")
def view_all_movie(v):
    return gav.all_movie(sources(v), v.title_genre, v.genre, KIND)


@view_query("view_all_actor", f"SELECT {PERSON} FROM member WHERE id IN (SELECT actorid FROM player)")
def view_all_actor(v):
    return gav.all_actor(sources(v))


@view_query("view_all_movie_actor", "SELECT titleid, actorid FROM title_actor WHERE titleid IN (SELECT id FROM film)")
def view_all_movie_actor(v):
    return gav.all_movie_actor(sources(v))


@view_query("view_virtual", "SELECT id, title FROM film WHERE full_length AND comic AND startYear = 1997")
def view_virtual(v):
    prefix = f"view_{uuid.uuid4().hex}_"
    gav.register({"comedy_movie": sources(v).comedy_movie}, prefix)
    return v.spark.sql(f"SELECT id, title FROM {prefix}comedy_movie WHERE startYear = 1997")


@view_query("view_materialised", "SELECT id, name FROM member WHERE id IN (SELECT actorid FROM player WHERE NOT ever_comic)")
def view_materialised(v):
    prefix, folder = f"mat_{uuid.uuid4().hex}_", stage_path(v.spark, "views")
    return gav.materialise(sources(v), prefix, folder).non_comedy_actor.select("id", "name")


def prolific_sql(movies: str) -> str:
    """Living people with five titles or more among ``movies`` of the years 1997 to 1999."""
    return f"""SELECT id, name, birthYear, movies FROM member JOIN (
          SELECT actorid, count(*) AS movies FROM title_actor
          WHERE titleid IN (SELECT id FROM {movies} WHERE full_length AND startYear BETWEEN 1997 AND 1999)
          GROUP BY actorid HAVING count(*) >= 5) ON actorid = id WHERE deathYear IS NULL"""


@view_query("q_gav_prolific", prolific_sql("labelled"))
def q_gav_prolific(v):
    return gav.prolific(schema(v), **PERIOD)


@view_query("q_gav_prolific_opt", prolific_sql("film"))
def q_gav_prolific_opt(v):
    return gav.prolific(gav.without_genres(v.member, v.title, v.title_actor), **PERIOD)


PREFIX = f"""SELECT {PERSON} FROM (SELECT * FROM member WHERE starts_with(name, 'sm'))
    JOIN title_actor ON actorid = id WHERE titleid IN (SELECT id FROM labelled WHERE NOT comic)"""


@view_query("q_gav_prefix", PREFIX)
def q_gav_prefix(v):
    return gav.prefix_actors(schema(v), KIND, "sm")


@view_query("q_gav_prefix_opt", f"""SELECT {PERSON} FROM (SELECT * FROM member WHERE starts_with(name, 'sm'))
    JOIN title_actor ON actorid = id WHERE titleid IN (SELECT id FROM film WHERE full_length AND NOT comic)
      AND id IN (SELECT actorid FROM player WHERE NOT ever_comic)""")
def q_gav_prefix_opt(v):
    return gav.prefix_actors_short(sources(v), "sm")


# The same two queries over the global schema as it is defined, a union of source views:
# unfolded by the optimiser, or read from the views as they were stored.


def defined(v, views):
    return gav.over_views(views, v.title_genre, v.genre, KIND)


@view_query("q_gav_prolific_view", prolific_sql("labelled"))
def q_gav_prolific_view(v):
    return gav.prolific(defined(v, sources(v)), **PERIOD)


@view_query("q_gav_prolific_stored", prolific_sql("labelled"))
def q_gav_prolific_stored(v):
    return gav.prolific(defined(v.stored, v.stored.source_views(KIND)), **PERIOD)


@view_query("q_gav_prefix_view", PREFIX)
def q_gav_prefix_view(v):
    return gav.prefix_actors(defined(v, sources(v)), KIND, "sm")


@view_query("q_gav_prefix_stored", PREFIX)
def q_gav_prefix_stored(v):
    return gav.prefix_actors(defined(v.stored, v.stored.source_views(KIND)), KIND, "sm")
