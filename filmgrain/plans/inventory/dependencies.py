"""Functional dependencies."""

from __future__ import annotations

from filmgrain.operators import dependencies as fd
from filmgrain.plans.registry import query

COLUMNS = ["movieId", "type", "startYear", "runtimeMinutes", "averageRating", "memberId",
           "genre_id", "genre", "birthYear", "role"]

RELATION = """SELECT t.id AS movieId, t.type, t.startYear, t.runtime AS runtimeMinutes, t.avgRatings AS averageRating,
    c.actorid AS memberId, g.genreid AS genre_id, g.genre, m.birthYear, r.role
    FROM title t JOIN (SELECT * FROM actor_title_role WHERE titleid NOT IN
        (SELECT titleid FROM actor_title_role GROUP BY titleid, actorid HAVING count(*) > 1)) c ON c.titleid = t.id
    LEFT JOIN (SELECT titleid, genreid, genre FROM title_genre JOIN genre ON genreid = genre.id) g ON g.titleid = t.id
    LEFT JOIN member m ON m.id = c.actorid LEFT JOIN role r ON r.id = c.roleid
    WHERE t.runtime >= 90 AND t.type = 'movie'"""


def _holds(lhs: str) -> str:
    tests = ", ".join(
        f"coalesce(bool_and(n_{y} = 1 AND c_{y} = n), true) AS {y}" for y in COLUMNS if y != lhs
    )
    inner = ", ".join(f"count(DISTINCT {y}) AS n_{y}, count({y}) AS c_{y}" for y in COLUMNS if y != lhs)
    return (
        f"SELECT '{lhs}' AS lhs, rhs FROM (UNPIVOT (SELECT {tests} FROM (SELECT count(*) AS n, {inner} FROM flat"
        f" WHERE {lhs} IS NOT NULL GROUP BY {lhs})) ON COLUMNS(*) INTO NAME rhs VALUE ok) WHERE ok"
    )


VIEWS = {"flat": RELATION, "deps": " UNION ALL ".join(_holds(c) for c in COLUMNS)}


def relation(v):
    return fd.flat_relation(
        v.title, v.actor_title_role, v.title_genre, v.genre, v.member, v.role
    )


@query("fd_relation", f"SELECT {', '.join(COLUMNS)} FROM flat", VIEWS)
def fd_relation(v):
    return relation(v)


@query("fd_classes", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({'CAST(averageRating AS DECIMAL(3, 1))' if c == 'averageRating' else c} AS VARCHAR) AS value,"
    f" count(*) AS rows FROM flat WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in COLUMNS
), VIEWS)
def fd_classes(v):
    # a rating has one decimal; as a double its text form differs between engines
    rows = relation(v)
    return fd.classes(rows.withColumn("averageRating", rows["averageRating"].cast("decimal(3,1)")), COLUMNS)


@query("fd_single", "SELECT lhs, rhs FROM deps", VIEWS)
def fd_single(v):
    return fd.single(relation(v))


ORDER = ", ".join(f"('{c}', {i})" for i, c in enumerate(COLUMNS))


@query("fd_implied_pairs", f"""SELECT DISTINCT CASE WHEN z.i < l.i THEN z.c ELSE l.c END AS lhs1, CASE WHEN z.i < l.i THEN l.c ELSE z.c END AS lhs2, rhs
    FROM deps JOIN (VALUES {ORDER}) l(c, i) ON l.c = lhs JOIN (VALUES {ORDER}) z(c, i) ON z.c <> lhs AND z.c <> rhs""", VIEWS)
def fd_implied_pairs(v):
    return fd.implied_pairs(fd.single(relation(v)), COLUMNS)


def _pair_holds(x: str, z: str) -> str:
    others = [y for y in COLUMNS if y not in (x, z)]
    inner = ", ".join(f"min({y}) IS NOT DISTINCT FROM max({y}) AND count({y}) = count(*) AS {y}" for y in others)
    tests = ", ".join(f"bool_and({y}) AS {y}" for y in others)
    return (
        f"SELECT '{x}' AS lhs1, '{z}' AS lhs2, rhs FROM (UNPIVOT (SELECT {tests} FROM (SELECT {inner} FROM flat"
        f" WHERE {x} IS NOT NULL AND {z} IS NOT NULL GROUP BY {x}, {z}) HAVING count(*) > 0)"
        f" ON COLUMNS(*) INTO NAME rhs VALUE ok) WHERE ok"
    )


@query("fd_minimal_pairs", "SELECT lhs1, lhs2, rhs FROM pairs WHERE (lhs1, rhs) NOT IN (SELECT lhs, rhs FROM deps)"
       " AND (lhs2, rhs) NOT IN (SELECT lhs, rhs FROM deps)",
       {**VIEWS, "pairs": " UNION ALL ".join(_pair_holds(x, z) for i, x in enumerate(COLUMNS) for z in COLUMNS[i + 1:])})
def fd_minimal_pairs(v):
    """Found from stripped partitions, not implied by a single column."""
    return fd.minimal_pairs(relation(v))
