"""Functional dependencies, from single columns and from pairs of columns.

X -> Y holds when every non-null value of X goes with exactly one Y value and never
with a null Y. Rows with a null X say nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.operators.joins import join_salted, with_label
from filmgrain.workspace import cut


def flat_relation(
    title: DataFrame, actor_title_role: DataFrame, title_genre: DataFrame, genre: DataFrame,
    member: DataFrame, role: DataFrame, min_runtime: int = 90, kind: str = "movie",
) -> DataFrame:
    """Ten-column relation: long movies with their roles, genres and cast.

    Titles in which a (title, actor) pair repeats are left out as a whole.
    """
    from filmgrain.operators.selection import without_repeats

    movies = title.where((F.col("runtime") >= min_runtime) & (F.col("type") == kind)).select(
        F.col("id").alias("titleid"), "type", "startYear",
        F.col("runtime").alias("runtimeMinutes"), F.col("avgRatings").alias("averageRating"),
    )
    cast = without_repeats(actor_title_role, "titleid", ["titleid", "actorid"])
    genres = with_label(title_genre, genre, "genreid", "genre")
    people = member.select(F.col("id").alias("actorid"), "birthYear")
    roles = role.select(F.col("id").alias("roleid"), "role")
    return (
        join_salted(cast, movies, ["titleid"])
        .join(genres, "titleid", "left")
        .join(people, "actorid", "left")
        .join(roles, "roleid", "left")
        .select(
            F.col("titleid").alias("movieId"), "type", "startYear", "runtimeMinutes",
            "averageRating", F.col("actorid").alias("memberId"),
            F.col("genreid").alias("genre_id"), "genre", "birthYear", "role",
        )
    )


def classes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Equivalence classes of each column as (column, value, rows); nulls form none."""
    columns = list(columns or df.columns)
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    return (
        df.select(cells.alias("c")).where("c.value IS NOT NULL")
        .groupBy("c.column", "c.value").agg(F.count("*").alias("rows"))
    )


#: Pairs are first held against one in so many of their product classes.
FIRST_LOOK = 64

NUMBERS = ("byte", "short", "integer", "long", "float", "double", "boolean", "date", "timestamp")


def _gid(n: int, *positions: int) -> int:
    """Grouping id of the set on these columns of ``n``: every other bit is set."""
    return (1 << n) - 1 - sum(1 << (n - 1 - i) for i in positions)


def single(df: DataFrame) -> DataFrame:
    """All dependencies X -> Y with X and Y different columns, as (lhs, rhs).

    Each X is one grouping set, and a group keeps only the smallest and largest of
    every other column and one bit mask of the columns that were null, so it combines
    before the shuffle and a value of X holding most rows costs no more than any
    other. Text is compared by its 64-bit hash first, which keeps the aggregate a hash
    aggregate; dependencies found that way are confirmed on the text itself.
    """
    df = cut(df)
    cols = df.columns
    n = len(cols)
    exact = {f.name for f in df.schema if f.dataType.typeName() in NUMBERS}
    codes = [f"{c} AS v_{c}" if c in exact else f"xxhash64({c}) AS v_{c}" for c in cols]
    nulls = " + ".join(f"CASE WHEN {c} IS NULL THEN {1 << i}L ELSE 0L END" for i, c in enumerate(cols))
    tests = [
        F.expr(f"min(v_{c}) = max(v_{c}) AND bit_or(nulls) & {1 << i}L = 0 AS ok_{c}")
        for i, c in enumerate(cols)
    ]
    keys = [F.col(c) for c in cols]
    groups = (
        df.selectExpr(*cols, *codes, f"{nulls} AS nulls").groupingSets([[k] for k in keys], *keys)
        .agg(F.grouping_id(*keys).alias("gid"), *tests)
        # a null key says nothing
        .where(F.expr(" OR ".join(f"{c} IS NOT NULL" for c in cols)))
    )
    # one row per column
    held = {r["gid"]: r for r in groups.groupBy("gid").agg(
        F.count("*").alias("values"),
        *[F.expr(f"bool_and(coalesce(ok_{c}, false)) AS ok_{c}") for c in cols],
    ).collect()}
    found, values = [], {}
    for i, lhs in enumerate(cols):
        row = held.get(_gid(n, i))
        values[lhs] = row["values"] if row else 0
        found += [(lhs, rhs) for rhs in cols if rhs != lhs and row and row[f"ok_{rhs}"]]
    kept = [p for p in found if p[1] in exact]
    kept += _confirmed(df, [p for p in found if p[1] not in exact], values)
    return df.sparkSession.createDataFrame(sorted(kept), "lhs string, rhs string")


def _confirmed(
    df: DataFrame, pairs: list[tuple[str, str]], values: dict[str, int]
) -> list[tuple[str, str]]:
    """Those pairs with as many distinct (X, Y) as distinct X; no X goes with a null Y here."""
    if not pairs:
        return []
    cols = sorted({c for p in pairs for c in p})
    keys = [F.col(c) for c in cols]
    at = {p: tuple(sorted(cols.index(c) for c in p)) for p in pairs}
    sets = [[keys[i], keys[j]] for i, j in sorted(set(at.values()))]
    distinct = df.groupingSets(sets, *keys).agg(F.grouping_id(*keys).alias("gid"))
    counts = {r["gid"]: r for r in distinct.groupBy("gid").agg(
        *[F.count(c).alias(c) for c in cols]
    ).collect()}
    return [p for p in pairs if counts[_gid(len(cols), *at[p])][p[0]] == values[p[0]]]


def implied_pairs(deps: DataFrame, columns: Sequence[str]) -> DataFrame:
    """From X -> Y also {X, Z} -> Y for every further column Z, as (lhs1, lhs2, rhs).

    The pair is written in column order; the column list is part of the plan.
    """
    names = F.array(*[F.lit(c) for c in columns])
    return (
        deps.withColumn("z", F.explode(names))
        .where("z <> lhs AND z <> rhs")
        .withColumn("swap", F.array_position(names, F.col("z")) < F.array_position(names, F.col("lhs")))
        .select(
            F.when(F.col("swap"), F.col("z")).otherwise(F.col("lhs")).alias("lhs1"),
            F.when(F.col("swap"), F.col("lhs")).otherwise(F.col("z")).alias("lhs2"),
            "rhs",
        )
        .distinct()
    )


def stripped(df: DataFrame) -> DataFrame:
    """``df`` with each cell replaced by the id of its class in its column, plus ``nulls``, a mask of its null cells.

    A class of one row can break no dependency, so it is stripped: its cell is null, like a
    null cell itself, and only the mask tells the two apart.
    """
    columns = df.columns
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    text = [(F.col(c) + F.lit(0.0) if c in floats else F.col(c)).cast("string").alias(c) for c in columns]  # one zero
    mask = sum((F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(columns)),
               F.lit(0).cast("bigint"))
    rows = df.select(*text).withColumn("nulls", mask)
    # ids are written before they are used, so a task that runs again finds the same ones
    ids = cut(classes(rows, columns).where("rows > 1").withColumn("id", F.monotonically_increasing_id()))
    for c in columns:
        own = ids.where(F.col("column") == c).select(F.col("value").alias(c), F.col("id").alias(f"_id_{c}"))
        rows = rows.join(own, c, "left")
    return rows.select(*[F.col(f"_id_{c}").alias(c) for c in columns], "nulls")


def minimal_pairs(df: DataFrame, deps: DataFrame | None = None) -> DataFrame:
    """Dependencies {X, Z} -> Y that neither X -> Y nor Z -> Y implies, as (lhs1, lhs2, rhs) in column order.

    Every row with X and Z present has a Y, the same in all rows that agree in both; a pair that
    is never present together says nothing. ``deps`` are those of single columns (``single``).

    Partitions of single columns are multiplied: a row takes part in the product of X and Z only
    where both its classes have further rows, and a product class of one row is stripped again.
    Classes are longs, so products are hash aggregates that combine before the shuffle, all pairs
    in one job, first over one class in ``FIRST_LOOK``, so that a broken pair does not move all its rows. Pairs of which one column determines the other are left out, as their product is a
    partition already known. What comes to the driver is a row a pair of columns.
    """
    df = cut(df)
    cols = df.columns
    spark = df.sparkSession
    held = {(r.lhs, r.rhs) for r in (single(df) if deps is None else deps).collect()}
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))
             if (cols[i], cols[j]) not in held and (cols[j], cols[i]) not in held]
    schema = "lhs1 string, lhs2 string, rhs string"
    if not pairs:
        return spark.createDataFrame([], schema)
    parts = cut(stripped(df))
    # null cells beside a present pair, from the distinct masks
    masks = parts.select("nulls").distinct()
    beside = masks.agg(*[
        F.bit_or(F.when(F.expr(f"nulls & {1 << i | 1 << j}L = 0"), F.col("nulls"))).alias(f"p{k}")
        for k, (i, j) in enumerate(pairs)]).first()
    open_pairs = {}
    for k, (i, j) in enumerate(pairs):
        if beside[k] is not None:
            targets = [y for y in range(len(cols)) if y not in (i, j) and not beside[k] >> y & 1
                       and (cols[i], cols[y]) not in held and (cols[j], cols[y]) not in held]
            if targets:
                open_pairs[k] = targets
    if FIRST_LOOK > 1:  # most targets are broken there already; what is left is held against all classes
        open_pairs = unbroken(parts, pairs, open_pairs, FIRST_LOOK)
    found = [(cols[pairs[k][0]], cols[pairs[k][1]], cols[y])
             for k, targets in unbroken(parts, pairs, open_pairs).items() for y in targets]
    return spark.createDataFrame(found, schema)


def unbroken(parts: DataFrame, pairs: Sequence[tuple[int, int]], open_pairs: dict[int, list[int]], one_in: int = 1) -> dict[int, list[int]]:
    """The targets of each pair that none of its product classes breaks; pairs without any are left out.

    ``parts`` are stripped rows, ``open_pairs`` maps the place of a pair to the places of its targets. With
    ``one_in`` only one of so many classes is looked at, each whole, so that what breaks there is broken.
    """
    if not open_pairs:
        return {}
    cols = parts.columns
    entries = F.array(*[
        F.struct(F.lit(k).alias("pair"), F.col(cols[pairs[k][0]]).alias("a"), F.col(cols[pairs[k][1]]).alias("b"))
        for k in open_pairs])
    wanted = sorted({y for targets in open_pairs.values() for y in targets})
    looked = lambda e: F.pmod(F.xxhash64(e["pair"], e["a"], e["b"]), F.lit(one_in)) == 0
    # ids of classes are not negative; a cell without one is alone with its value
    met = parts.select(*[F.coalesce(F.col(cols[y]), F.lit(-1)).alias(f"c{y}") for y in wanted], F.explode(F.filter(
        entries, lambda e: e["a"].isNotNull() & e["b"].isNotNull() & (looked(e) if one_in > 1 else F.lit(True)))).alias("e"))
    same = [F.expr(f"CASE WHEN min(c{y}) = max(c{y}) AND min(c{y}) >= 0 THEN {1 << y}L ELSE 0L END") for y in wanted]
    product = met.groupBy("e.pair", "e.a", "e.b").agg(F.count("*").alias("n"), sum(same[1:], same[0]).alias("ok"))
    kept = {r.pair: r.ok for r in product.where("n > 1").groupBy("pair").agg(F.bit_and("ok").alias("ok")).collect()}
    left = {k: [y for y in targets if kept.get(k, -1) >> y & 1] for k, targets in open_pairs.items()}
    return {k: targets for k, targets in left.items() if targets}
