"""Frequent itemsets, level by level, and FP-growth.

Baskets are distinct (basket, item) rows; an itemset is frequent when more than
``min_support`` baskets hold all its items.

A basket adds at most one to the support of a set. So with the ``min_support``
largest baskets set aside, every frequent set still shows up in a basket that is
left, and joins run over those only. What the baskets set aside add is the number of them
that hold all the items, known from a list per item. No pair is formed inside them, so
baskets that hold a third of all rows each cost what their rows cost. That is the one way
at every size; a skewed self-join of what is left is split by adaptive execution.

Pairs are pruned before they are counted: a fixed number of counters over hashed pairs,
added up on the map side, is a sure upper bound of each pair's support, and only pairs
whose counter can reach it are shuffled.

Tasks grow with the pairs that the baskets can form, whatever the session's number of shuffle
partitions and however adaptive execution would merge them by bytes: few bytes of baskets make many pairs.

``joint_support`` has none of this: it joins all baskets with themselves and counts every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.operators import joins
from filmgrain.workspace import cut

#: Counters over hashed pairs; also the bound of what is broadcast.
COUNTERS = 1 << 18
#: Basket cells for each task of a join by basket, and pairs that they form there.
TASK_ROWS, TASK_PAIRS = 500_000, 1_000_000
#: Cells of a basket that are paired in one place, where all its pairs are formed.
BLOCK_ROWS = 500
#: Basket cells for each task of FP-growth that builds trees, and for each group of items that has one tree a task.
TASK_CELLS, GROUP_CELLS = 100_000, 10_000


@dataclass
class Prepared:
    """Rows (basket, item, aside) left for joining; ``aside`` lists the baskets set aside that hold the item."""

    rows: DataFrame
    min_support: int
    set_aside: int
    tasks: int


@contextmanager
def _in_tasks(spark: SparkSession, n: int) -> Iterator[None]:
    """Shuffles of the jobs run inside have ``n`` partitions, which stay apart."""
    held = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, x in held.items():
            spark.conf.set(k, x)
        yield
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


def _cut(df: DataFrame, n: int) -> DataFrame:
    with _in_tasks(df.sparkSession, n):
        return cut(df)


def popular_links(title: DataFrame, links: DataFrame, item: str, min_rating: float = 5,
                  kind: str = "movie") -> DataFrame:
    """(basket, item) of well-rated titles of one kind."""
    good = title.where((F.col("avgRatings") > min_rating) & (F.col("type") == kind)).select(
        F.col("id").alias("titleid")
    )
    return links.join(good, "titleid").select(
        F.col("titleid").alias("basket"), F.col(item).alias("item")
    )


def level_one(baskets: DataFrame, min_support: int = 5) -> DataFrame:
    return (
        baskets.groupBy(F.col("item").alias("item1")).agg(F.count("*").alias("support"))
        .where(F.col("support") > min_support)
    )


def prepare(baskets: DataFrame, min_support: int = 5, l1: DataFrame | None = None) -> Prepared:
    """Keep frequent items and set the ``min_support`` largest baskets aside."""
    if l1 is None:
        l1 = cut(level_one(baskets, min_support))
    cells = l1.agg(F.sum("support")).first()[0] or 0
    items = l1.select(F.col("item1").alias("item"))
    n = cells // TASK_ROWS + 1
    rows = _cut(baskets.join(items, "item", "left_semi").select("basket", "item"), n)
    with _in_tasks(rows.sparkSession, n):
        sizes = rows.groupBy("basket").agg(F.count("*").alias("n"))
        largest = sizes.orderBy(F.desc("n"), "basket").limit(min_support + 1).collect()
    aside = [r["basket"] for r in largest[:min_support]]
    held = rows.where(F.col("basket").isin(aside)).groupBy("item").agg(F.collect_list("basket").alias("aside"))
    left = rows.where(~F.col("basket").isin(aside)).join(held, "item", "left")
    none = F.array().cast(held.schema["aside"].dataType)
    left = _cut(left.select("basket", "item", F.coalesce("aside", none).alias("aside")), n)
    # no basket left has more items than the first of them, and no task less than a row in twenty of TASK_ROWS
    most = largest[min_support]["n"] - 1 if len(largest) > min_support else 0
    tasks = max(n, min(cells * most // 2 // TASK_PAIRS, cells * 20 // TASK_ROWS) + 1)
    return Prepared(left, min_support, len(aside), tasks)


def _pairs(p: Prepared) -> DataFrame:
    """(basket, item1 < item2, aside) over the joinable rows."""
    a = p.rows.select("basket", F.col("item").alias("item1"), F.col("aside").alias("a1"))
    b = p.rows.select("basket", F.col("item").alias("item2"), F.col("aside").alias("a2"))
    return a.join(b, "basket").where("item1 < item2").select(
        "basket", "item1", "item2", F.array_intersect("a1", "a2").alias("aside"))


def _support(occurrences: DataFrame, n: int, min_support: int) -> DataFrame:
    items = [f"item{i}" for i in range(1, n + 1)]
    joint = F.count("*") + F.max(F.size("aside"))
    return occurrences.groupBy(*items).agg(joint.alias("support")).where(
        F.col("support") > min_support
    )


def hopeful_pairs(p: Prepared, counters: int = COUNTERS) -> DataFrame:
    """Occurrences of the pairs whose counter does not rule them out.

    A counter holds the occurrences of all pairs that share its hash, so with the baskets set
    aside it is never below a pair's support. It takes ``counters`` rows a task to shuffle.
    """
    pairs = _pairs(p).withColumn("slot", F.pmod(F.xxhash64("item1", "item2"), F.lit(counters)).cast("int"))
    bound = pairs.groupBy("slot").agg(F.count("*").alias("bound"))
    return pairs.join(F.broadcast(bound), "slot").where(
        F.col("bound") + F.size("aside") > p.min_support).drop("slot", "bound")


def level_two(p: Prepared) -> DataFrame:
    """Pairs with their joint support, written once."""
    return _cut(_support(hopeful_pairs(p), 2, p.min_support), p.tasks)


def joint_support(baskets: DataFrame, min_support: int = 5) -> DataFrame:
    """Pairs with their joint support from the self-join of all baskets, written once.

    No item is pruned, no basket set aside and no pair ruled out before it is counted, so rows that come twice count
    as they do in SQL; rows without basket or item meet nothing.
    """
    rows = cut(baskets.select("basket", "item").where("basket IS NOT NULL AND item IS NOT NULL"))
    sizes = cut(rows.groupBy("basket").agg(F.count("*").alias("n")))
    # both orders of a pair are compared, one is kept
    total = sizes.agg(F.sum("n").alias("cells"), F.sum(F.expr("n * n")).alias("compared")).first()
    tasks = max((total["cells"] or 0) // TASK_ROWS, (total["compared"] or 0) // TASK_PAIRS) + 1
    pairs = joins.theta_self(rows, "basket", "item", sizes, BLOCK_ROWS)
    support = pairs.groupBy("item1", "item2").agg(F.count("*").alias("support"))
    return _cut(support.where(F.col("support") > min_support), tasks)


def pair_occurrences(p: Prepared, l2: DataFrame) -> DataFrame:
    """Baskets of the frequent pairs only, written once."""
    return _cut(hopeful_pairs(p).join(l2.select("item1", "item2"), ["item1", "item2"], "left_semi"), p.tasks)


def extend(occurrences: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """Occurrences of size ``n`` from those of size ``n - 1``: append an item that forms
    a frequent pair with the last one in the same basket."""
    last = f"item{n - 1}"
    step = pairs.select(
        "basket", F.col("item1").alias(last), F.col("item2").alias(f"item{n}"),
        F.col("aside").alias("_a"),
    )
    return occurrences.join(step, ["basket", last]).select(
        "basket", *[f"item{i}" for i in range(1, n + 1)],
        F.array_intersect("aside", "_a").alias("aside"),
    )


def levels(
    baskets: DataFrame, min_support: int = 5, max_level: int | None = None,
) -> list[DataFrame]:
    """Non-empty levels 1, 2, ... until one is empty (or ``max_level`` is reached).

    Each level and the baskets of its sets are written once, so a lost executor
    costs the current level at most.
    """
    l1 = cut(level_one(baskets, min_support))
    if l1.isEmpty():
        return []
    found = [l1]
    if max_level == 1:
        return found
    p = prepare(baskets, min_support, l1)
    current = level_two(p)
    pairs = occurrences = None
    n = 2
    while not current.isEmpty():
        found.append(current)
        if n == max_level:
            break
        items = [f"item{i}" for i in range(1, n + 1)]
        if n == 2:
            pairs = occurrences = pair_occurrences(p, current)
        else:
            occurrences = _cut(occurrences.join(current.select(*items), items, "left_semi"), p.tasks)
        n += 1
        occurrences = extend(occurrences, pairs, n)
        current = _cut(_support(occurrences, n, min_support), p.tasks)
    return found


def level(baskets: DataFrame, n: int, min_support: int = 5) -> DataFrame:
    """Level ``n`` alone; an empty frame of its columns when no such set exists."""
    found = levels(baskets, min_support, n)
    if len(found) == n:
        return found[-1]
    item = baskets.schema["item"].dataType
    empty = [F.lit(None).cast(item).alias(f"item{i}") for i in range(1, n + 1)]
    return baskets.select(*empty, F.lit(0).cast("bigint").alias("support")).limit(0)


def last_level_named(found: list[DataFrame], names: DataFrame) -> DataFrame:
    """The last non-empty level with one name per item."""
    from filmgrain.operators.joins import attach_names

    last = found[-1]
    return attach_names(last, names, [c for c in last.columns if c.startswith("item")])


def fp_growth(baskets: DataFrame, min_support: int = 5) -> DataFrame:
    """The same itemsets from MLlib's FPGrowth, as (items, support).

    FPGrowth takes a basket as one array; it holds the basket's frequent items only, so it is
    at most as long as level one. A task builds a tree for each group of items and looks through
    it as it grows, so tasks and groups grow with the baskets, not with the bytes that cells take.
    """
    from pyspark.ml.fpm import FPGrowth

    items = level_one(baskets, min_support).select(F.col("item1").alias("item"))
    arrays = cut(baskets.join(items, "item", "left_semi").groupBy("basket").agg(F.collect_set("item").alias("items")))
    size = arrays.agg(F.count("*").alias("n"), F.sum(F.size("items")).alias("cells")).first()
    cells = size.cells or 0
    model = FPGrowth(itemsCol="items", minSupport=(min_support + 0.5) / max(size.n, 1),
                     numPartitions=cells // GROUP_CELLS + 1).fit(arrays.repartition(cells // TASK_CELLS + 1))
    return model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("support"))


def as_sets(found: list[DataFrame]) -> DataFrame:
    """All levels as one frame of (items, support)."""
    frames = [
        lv.select(F.array(*[c for c in lv.columns if c.startswith("item")]).alias("items"), "support")
        for lv in found
    ]
    return reduce(DataFrame.unionByName, frames)
