"""Frequent itemsets over producers that share titles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.operators import itemsets
from filmgrain.plans.registry import query

POPULAR = """SELECT titleid AS basket, producerid AS item FROM title_producer JOIN title ON id = titleid WHERE avgRatings > 5 AND type = 'movie'"""

LEVELS = {
    "occ1": "SELECT basket, item AS a FROM baskets",
    "l1": "SELECT item AS a, count(*) AS support FROM baskets GROUP BY 1 HAVING count(*) > 5",
    "occ2": "SELECT x.basket, x.item AS a, y.item AS b FROM baskets x JOIN baskets y ON x.basket = y.basket AND x.item < y.item",
    "l2": "SELECT a, b, count(*) AS support FROM occ2 GROUP BY 1, 2 HAVING count(*) > 5",
    "occ3": "SELECT o.basket, o.a, o.b, z.item AS c FROM occ2 o JOIN baskets z ON o.basket = z.basket AND o.b < z.item",
    "l3": "SELECT a, b, c, count(*) AS support FROM occ3 GROUP BY 1, 2, 3 HAVING count(*) > 5",
    # every subset of every basket, which only small baskets allow
    "l_any": """SELECT len(items) AS level, items, count(*) AS support FROM (
        WITH RECURSIVE sub AS (SELECT basket, [item] AS items, item AS last FROM baskets
            UNION ALL SELECT s.basket, list_append(s.items, b.item), b.item FROM sub s JOIN baskets b ON s.basket = b.basket AND b.item > s.last)
        SELECT items FROM sub) GROUP BY items HAVING count(*) > 5""",
}
ALL_LEVELS = "SELECT CAST(level AS INTEGER) AS level, array_to_string(items, ',') AS items, support FROM l_any"


def level_query(name, sql):
    return query(name, sql, LEVELS)


def joined(items):
    return F.array_join(items.cast("array<string>"), ",")


@query("fi_baskets", POPULAR)
def fi_baskets(v):
    return itemsets.popular_links(v.title, v.title_producer, "producerid")


@level_query("fi_l1", "SELECT a AS item1, support FROM l1")
def fi_l1(v):
    return itemsets.level_one(v.baskets)


@level_query("fi_l2", "SELECT a AS item1, b AS item2, support FROM l2")
def fi_l2(v):
    return itemsets.level(v.baskets, 2)


@level_query("fi_l3", "SELECT a AS item1, b AS item2, c AS item3, support FROM l3")
def fi_l3(v):
    return itemsets.level(v.baskets, 3)


@query("fi_level_n", """SELECT x.item AS item1, y.item AS item2, count(*) AS support FROM popular x JOIN popular y
    ON x.basket = y.basket AND x.item < y.item GROUP BY 1, 2 HAVING count(*) > 3""", {"popular": POPULAR})
def fi_level_n(v):
    popular = itemsets.popular_links(v.title, v.title_producer, "producerid")
    return itemsets.level(popular, 2, min_support=3)


@level_query("fi_loop", ALL_LEVELS)
def fi_loop(v):
    found = itemsets.levels(v.baskets)
    frames = [
        lv.select(
            F.lit(n).alias("level"),
            joined(F.array(*[c for c in lv.columns if c.startswith("item")])).alias("items"), "support",
        )
        for n, lv in enumerate(found, 1)
    ]
    return reduce(DataFrame.unionByName, frames)


@level_query("fi_last_named", f"""SELECT items, support, string_agg(name, ',' ORDER BY pos) AS names FROM
    (SELECT items, support, unnest(string_split(items, ',')) AS item, generate_subscripts(string_split(items, ','), 1) AS pos
     FROM ({ALL_LEVELS}) WHERE level = (SELECT max(level) FROM ({ALL_LEVELS}))) JOIN member ON id = CAST(item AS BIGINT) GROUP BY items, support""")
def fi_last_named(v):
    named = itemsets.last_level_named(itemsets.levels(v.baskets), v.member.select("id", "name"))
    items = [c for c in named.columns if c.startswith("item") and not c.endswith("_name")]
    items.sort()
    return named.select(
        joined(F.array(*items)).alias("items"), "support",
        F.array_join(F.array(*[f"{c}_name" for c in items]), ",").alias("names"),
    )


@level_query("fi_fpgrowth", f"SELECT items, support FROM ({ALL_LEVELS})")
def fi_fpgrowth(v):
    return itemsets.fp_growth(v.baskets).select(joined(F.col("items")).alias("items"), "support")
