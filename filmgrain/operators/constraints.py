"""Declared keys, parents and text lengths, all checked while a table is loaded.

The declarations are data (``Rules``): nothing in here knows a table by name. What breaks
one comes back as a row of one reject table, with the declaration it breaks and the number
of equal copies.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrain.operators.joins import join_salted

KEPT = "kept"
POSITION = "_pos"


@dataclass(frozen=True)
class Rules:
    """A table's key, the parent table whose (one-column) key a column holds, and its longest texts."""

    key: tuple[str, ...]
    parents: Mapping[str, str] = field(default_factory=dict)
    limits: Mapping[str, int] = field(default_factory=dict)


def declared(keys: Mapping, parents: Mapping, limits: Mapping) -> dict[str, Rules]:
    return {t: Rules(tuple(keys[t]), parents.get(t, {}), limits.get(t, {})) for t in keys}


def in_order(rules: Mapping[str, Rules]) -> list[str]:
    """Table names, parents before children."""
    done: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"tables are each other's parents: {' > '.join((*path, name))}")
        if name not in done:
            for parent in rules[name].parents.values():
                visit(parent, (*path, name))
            done.append(name)

    for name in rules:
        visit(name, ())
    return done


def judge(rows: DataFrame, rules: Rules, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct rows with ``outcome`` and ``copies``, from one pass over ``rows``.

    The outcome is the first that holds: a key column is null, a text is too long, a parent
    is unknown (a null reference has none to know), an earlier row has the key; else the row
    is kept, once, and its further copies come as a row of their own. Earlier is by
    ``_pos`` where the rows have it, then by their values. Only rows that break nothing else
    can claim a key. ``parents`` maps a table to the keys it kept, as ``id``.

    Equal rows are counted before any join, and a key that most rows hold is claimed by an
    aggregate that combines before the shuffle and joined back salted.
    """
    columns = [c for c in rows.columns if c != POSITION]
    rest = [c for c in columns if c not in rules.key]
    placed = POSITION in rows.columns
    first = [F.min(POSITION).alias(POSITION)] if placed else []
    judged = rows.groupBy(*columns).agg(F.count("*").alias("_n"), *first)
    checks: list[tuple[Column, str]] = [(F.col(c).isNull(), f"{c} is null") for c in rules.key]
    checks += [(F.length(c) > n, f"{c} too long") for c, n in rules.limits.items()]
    for i, (column, parent) in enumerate(rules.parents.items()):
        known = parents[parent].withColumnRenamed("id", column).withColumn(f"_has_{i}", F.lit(True))
        judged = judged.join(known, column, "left")
        checks.append((F.col(column).isNotNull() & F.col(f"_has_{i}").isNull(), f"{column} unknown"))
    fault = F.lit(None).cast("string")
    for broken, name in reversed(checks):
        fault = F.when(broken, F.lit(name)).otherwise(fault)
    judged = judged.select(*columns, *([POSITION] if placed else []), "_n", fault.alias("_fault"))
    wins = F.lit(True)
    if rest:
        order = F.struct(*([POSITION] if placed else []), *rest)
        best = judged.where("_fault IS NULL").groupBy(*rules.key).agg(F.min(order).alias("_best"), F.count("*").alias("_rows"))
        judged = join_salted(judged, best, rules.key, "left", rows="_rows")
        wins = order.eqNullSafe(F.col("_best"))
    told = lambda outcome, copies: F.struct(F.lit(outcome).alias("outcome"), copies.alias("copies"))
    repeated = f"{', '.join(rules.key)} repeated"
    kept = told(KEPT, F.lit(1).cast("bigint"))
    outcomes = F.when(F.col("_fault").isNotNull(), F.array(F.struct(F.col("_fault").alias("outcome"), F.col("_n").alias("copies")))).when(
        ~wins, F.array(told(repeated, F.col("_n")))).when(
        F.col("_n") > 1, F.array(kept, told(repeated, F.col("_n") - 1))).otherwise(F.array(kept))
    return judged.withColumn("_o", F.explode(outcomes)).select(*columns, "_o.outcome", "_o.copies")


def load(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules],
         store: Callable[[str, DataFrame], DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the kept rows of each table, the rejects of all as (table, key, outcome, copies, row)).

    Tables are judged parents first, and children are held against what was kept.
    ``store(name, judged)`` writes a judged table and returns it as read back, so each table
    is worked out once and a lost executor repeats no more than the table at hand.
    """
    kept: dict[str, DataFrame] = {}
    rejects: DataFrame | None = None
    for name in in_order(rules):
        judged = store(name, judge(tables[name], rules[name], {
            p: kept[p].select(F.col(rules[p].key[0]).alias("id")) for p in rules[name].parents.values()}))
        columns = [c for c in judged.columns if c not in ("outcome", "copies")]
        kept[name] = judged.where(F.col("outcome") == KEPT).select(*columns)
        lost = judged.where(F.col("outcome") != KEPT).select(
            F.lit(name).alias("table"), key_text(rules[name]).alias("key"), "outcome", "copies",
            F.to_json(F.struct(*columns)).alias("row"))
        rejects = lost if rejects is None else rejects.unionByName(lost)
    return kept, rejects


def key_text(rules: Rules) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rules.key])
