"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents fall into a fixed number of blocks by an md5 of their content, and
its blocks have a seeded order. The quota of a source is the shortest run of blocks that
reaches its target; of the last block only the documents up to the target count, and one
more document, the one that brings the words nearest to the target, tops it up. Where that
would miss the target by the smallest document left or more (a long document stood at the
crossing), the documents that still fit are taken in the same order until none fits, if
the source comes nearer to its target so. A source whose unused documents are all too long
goes on with those that it has taken once: no document is taken more than twice.

The quotas, one number a source and pass, are split among the output shards down a binary
tree: at each node a multivariate-hypergeometric draw gives the left half its share of
every source, so each shard's mixture is a random sample without replacement while the
totals stay exact. A shard then takes the next run of each source's permuted blocks,
disjoint from the others', and orders its rows by a seeded key of their own.

Only (source, words) and the tree's (source, shard) quotas reach the driver. Block sums
are at most sources x 4096 rows; documents are ranked only within one block, so a source
that holds a third of all rows is no longer than any other.

Defined results: a null text has size 0 and documents of size 0 are never needed to reach
a target, nor taken; null sources form a source of their own, last in order; a null id is
a document; repeated rows (same id, source and text) are taken alike, together; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filmgrain.workspace import cut

WORD = r"[^\x20\x09-\x0D]+"
HEX_DIGITS = 3


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words of each source: ``share`` of all by weight, at most ``most`` times its own.

    What a source cannot take is shared again by weight among the others.
    """
    left, open_ = share * sum(sizes), [i for i, n in enumerate(sizes) if n > 0]
    out = [0.0] * len(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def splitting_tree(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """(shards, len(quotas)) block counts whose columns sum to ``quotas``; row sums differ by one at most."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        total = int(have.sum())
        each, more = divmod(total, hi - lo)  # the first `more` shards get one block more
        want = each * (mid - lo) + min(more, mid - lo)
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(have, want, method="marginals") if total else have
        split(lo, mid, left)
        split(mid, hi, have - left)

    split(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Runs of the fill: documents of ``least`` to ``most`` words up to the md5 ``last``.
STEPS = "array<struct<least:long,most:long,last:string>>"


def _frame(spark, values: dict, column: str) -> DataFrame:
    return spark.createDataFrame([(s, v) for s, v in values.items()], f"stratum string, {column}")


def _by_block(blocks: DataFrame, small: DataFrame) -> DataFrame:
    return blocks.select("stratum", "block").join(small, "stratum")


def _in_steps() -> Column:
    return F.coalesce(F.exists("steps", lambda s: F.col("size").between(s["least"], s["most"]) & (
        F.col("ord") <= s["last"])), F.lit(False))


def _nearest(free: DataFrame, blocks: DataFrame, gaps: dict[str, float]) -> dict[str, tuple]:
    """stratum -> (off, md5, least): the free document nearest to the gap, null if none is nearer than nothing,
    by how much the source then misses its target, and the smallest free size."""
    near = free.join(_by_block(blocks, _frame(free.sparkSession, gaps, "gap double")), ["stratum", "block"])
    off = F.abs(F.col("size") - F.col("gap"))
    rows = near.groupBy("stratum").agg(F.min(F.when(off < F.col("gap"), F.struct(off.alias("off"), "ord"))).alias("best"),
                                       F.min("size").alias("least")).collect()
    return {r.stratum: (r.best.off, r.best.ord, r.least) if r.best else (gaps[r.stratum], None, r.least) for r in rows}


def _fill(free: DataFrame, blocks: DataFrame, gaps: dict[str, float]) -> dict[str, list[tuple]]:
    """Runs of the documents that still fit, by source, until none fits; ``gaps`` becomes what is left.

    The first run is over all that fit. Each later one is over the largest fitting sizes
    within a factor of two, of which at most one fits after a run, so runs are twice the
    classes of sizes at most.
    """
    steps: dict[str, list[tuple]] = {s: [] for s in gaps}
    open_, first = set(gaps), True
    inside = Window.partitionBy("stratum", "block").orderBy("ord").rangeBetween(Window.unboundedPreceding, 0)
    upto = Window.partitionBy("stratum").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    while open_:
        state = free.sparkSession.createDataFrame([(s, gaps[s], steps[s]) for s in open_], f"stratum string, gap double, steps {STEPS}")
        fit = free.join(_by_block(blocks, state), ["stratum", "block"]).filter((F.col("size") <= F.col("gap")) & ~_in_steps())
        top = {r.stratum: r.n for r in fit.groupBy("stratum").agg(F.max("size").alias("n")).collect()}
        open_ = set(top)
        if not open_:
            break
        least = {s: 1 if first else 1 << (n.bit_length() - 1) for s, n in top.items()}
        fit = cut(fit.join(_by_block(blocks, _frame(free.sparkSession, least, "least long")), ["stratum", "block"]).filter(
            "size >= least").select("stratum", "block", "ord", "size", "gap"))
        sums = fit.groupBy("stratum", "block", "gap").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
        crossing = cut(sums.filter("upto > gap").groupBy("stratum").agg(
            F.min(F.struct("block", (F.col("upto") - F.col("words")).alias("before"))).alias("c")).select("stratum", "c.*"))
        taken = {r.stratum: ("g", r.n) for r in sums.groupBy("stratum").agg(F.sum("words").alias("n")).collect()}
        taken |= {r.stratum: (r.block, r.before) for r in crossing.collect()}  # up to the block
        part = fit.join(crossing, ["stratum", "block"]).withColumn("upto", F.col("before") + F.sum("size").over(inside))
        taken |= {r.stratum: (r.ord, r.n) for r in part.filter("upto <= gap").groupBy("stratum").agg(
            F.max("ord").alias("ord"), F.max("upto").alias("n")).collect()}
        for s, (last, n) in taken.items():
            if n:
                steps[s].append((least[s], top[s], last))
                gaps[s] -= n
            else:  # only repeated rows are left at the crossing, which do not fit together
                open_.discard(s)
        first = False
    return {s: x for s, x in steps.items() if x}


def _nearer(
    free: DataFrame, blocks: DataFrame, gaps: dict[str, float], tops: dict[str, tuple],
    least: dict[str, int] | None = None, others: DataFrame | None = None,
) -> tuple[dict[str, list[tuple]], dict[str, tuple]]:
    """(runs of the fill for the sources that come nearer to their need by it, topping documents).

    Only sources that lack their smallest free document (``least``) or more are filled;
    ``others`` may top up, too. What the runs take is taken off ``gaps``.
    """
    least = least if least is not None else {s: n for s, (_, _, n) in tops.items() if n is not None}
    steps = _fill(free, blocks, {s: gaps[s] for s, n in least.items() if gaps[s] >= n and tops[s][0] >= n})
    if not steps:
        return steps, tops
    listed = _by_block(blocks, _frame(free.sparkSession, steps, "steps " + STEPS))
    rest = free.join(listed, ["stratum", "block"]).withColumn("filled", _in_steps())
    got = {r.stratum: r.n for r in rest.filter("filled").groupBy("stratum").agg(F.sum("size").alias("n")).collect()}
    pool = rest.filter("NOT filled").select("stratum", "block", "ord", "size")
    pool = pool if others is None else pool.unionByName(others.select("stratum", "block", "ord", "size"))
    left = {s: gaps[s] - got[s] for s in steps}
    after = {s: (gap, None, None) for s, gap in left.items()} | _nearest(pool, blocks, left)
    steps = {s: x for s, x in steps.items() if after[s][0] < tops[s][0]}
    gaps |= {s: left[s] for s in steps}
    return steps, tops | {s: after[s] for s in steps}


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2,
    shards: int = 8, seed: int = 17,
    id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """Every row as (id, source, size, content, source_size, target, takes).

    ``takes`` has an entry (shard, key) for each time the mixture takes the row: the
    shard that gets it and its place in that shard's shuffled order. ``content`` is an
    md5 of the text. ``weights`` repeat over the sources in order of code points.
    """
    if most != 2:
        raise ValueError("a document is taken at most twice")
    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        F.concat(F.when(F.col(source_column).isNull(), "1").otherwise("0"),
                 F.coalesce(source_column, F.lit(""))).alias("stratum"),
        word_count(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias("content"),
    )
    # One random order for both passes: what is taken twice are the first blocks too.
    ident = F.coalesce(F.col("id").cast("string"), F.lit("-"))
    rows = rows.withColumn("ord", F.md5(F.concat(F.lit(f"{seed}:"), ident, F.lit(":"), F.col("content"))))
    rows = cut(rows.withColumn("block", F.substring("ord", 1, HEX_DIGITS)))  # narrow; the texts are read once
    totals = sorted((r.stratum, r.n) for r in rows.groupBy("stratum").agg(F.sum("size").alias("n")).collect())
    sizes = [n for _, n in totals]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(s, n, t, t - n if t > n else t, t > n) for (s, n), t in zip(totals, goal)],
        "stratum string, source_size long, target double, need double, again boolean",
    )

    upto = Window.partitionBy("stratum").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.groupBy("stratum", "block").agg(F.sum("size").alias("words")).join(plan, "stratum")
    blocks = blocks.select(
        "stratum", "block", "need", "again", "source_size", "target", "words",
        (F.sum("words").over(upto) - F.col("words")).alias("before"), F.row_number().over(
            Window.partitionBy("stratum").orderBy("block")).alias("nth"),
    )
    whole = F.col("before") + F.col("words") <= F.col("need")
    part = ~whole & (F.col("before") < F.col("need"))
    blocks = cut(blocks.withColumn("state", F.when(whole, 2).when(part, 1).otherwise(0)))

    inside = Window.partitionBy("stratum", "block").orderBy("ord").rangeBetween(Window.unboundedPreceding, 0)
    drawn = rows.join(blocks, ["stratum", "block"])
    # Only one block a source is cut inside; the others need no order.
    partly = drawn.filter("state = 1").withColumn("upto", F.col("before") + F.sum("size").over(inside))
    chosen = drawn.filter("state != 1").withColumn("extra", F.col("state") == 2).unionByName(
        partly.withColumn("extra", F.col("upto") <= F.col("need")).drop("upto"))
    chosen = cut(chosen.select("id", "source", "stratum", "block", "size", "content", "ord", "extra"))

    # What a source lacks is attached to its blocks, so that no join gathers a whole source.
    taken = {r.stratum: r.n for r in chosen.filter("extra").groupBy("stratum").agg(F.sum("size").alias("n")).collect()}
    gaps = {r.stratum: r.need - taken.get(r.stratum, 0) for r in plan.collect()}
    free = chosen.filter("NOT extra AND size > 0")
    tops = {s: (gap, None, None) for s, gap in gaps.items()} | _nearest(free, blocks, gaps)
    steps, tops = _nearer(free, blocks, gaps, tops)
    if steps:
        listed = _by_block(blocks, _frame(spark, steps, "steps " + STEPS))
        chosen = cut(chosen.join(listed, ["stratum", "block"], "left").withColumn(
            "filled", _in_steps() & ~F.col("extra") & (F.col("size") > 0)).withColumn(
            "extra", F.col("extra") | F.col("filled")).drop("steps"))
        also = chosen.filter("filled").select("stratum", "block").distinct().withColumn("also", F.lit(True))
        blocks = cut(blocks.join(also, ["stratum", "block"], "left"))
    else:
        blocks = blocks.withColumn("also", F.lit(None).cast("boolean"))
    # A source that still lacks words takes documents that it has taken once for a second time.
    once = {r.stratum: gaps[r.stratum] for r in plan.filter("NOT again").collect() if tops[r.stratum][0] > 0}
    seconds = chosen.filter("extra AND size > 0")
    near = _nearest(seconds, blocks, once)
    tops |= {s: t for s, t in near.items() if t[0] < tops[s][0]}
    again, tops = _nearer(seconds, blocks, gaps, tops, {s: t[2] for s, t in near.items()}, chosen.filter("NOT extra AND size > 0"))
    listed = _by_block(blocks, _frame(spark, again, "steps " + STEPS))
    chosen = chosen.join(listed, ["stratum", "block"], "left").withColumn(
        "second", F.col("extra") & (F.col("size") > 0) & _in_steps()).drop("steps")
    used = (F.col("state") > 0) | F.coalesce("also", F.lit(False))
    blocks = blocks.withColumn("used", used).withColumn("nth_used", F.sum(F.col("used").cast("long")).over(upto))
    top = _frame(spark, {s: t for s, (_, t, _) in tops.items()}, "top string")

    # Blocks of each source and pass go to shards in runs, by the tree's quotas.
    counts = {r.stratum: (r.used, r.all) for r in blocks.groupBy("stratum").agg(
        F.sum(F.col("used").cast("long")).alias("used"), F.count("*").alias("all")).collect()}
    quotas = [counts[s][p] for p in (0, 1) for s, _ in totals]
    tree = splitting_tree(quotas, shards, seed).cumsum(axis=0).T if quotas else np.zeros((0, shards), int)
    ends = spark.createDataFrame(
        [(s, tree[i].tolist(), tree[len(totals) + i].tolist()) for i, (s, _) in enumerate(totals)],
        "stratum string, extra_ends array<long>, all_ends array<long>",
    )
    shard = lambda end, nth: F.size(F.filter(end, lambda e: e < F.col(nth))).cast("int")
    last = F.element_at("extra_ends", -1)
    take = lambda end, nth, n: F.struct(
        F.least(shard(end, nth), F.lit(shards - 1)).alias("shard"),
        F.md5(F.concat(F.lit(f"{n}:"), "ord")).alias("key"))
    topped = F.coalesce(F.col("ord") == F.col("top"), F.lit(False))
    both = (F.col("again") & (F.col("size") > 0)) | F.col("second") | (topped & F.col("extra"))
    twice = F.when(both, F.array(take("all_ends", "nth", 0))).otherwise(F.array())
    # A topping document may lie in a block without a quota; it joins the last used block's shard.
    placed = F.when(F.col("used"), take("extra_ends", "nth_used", 1)).otherwise(F.struct(
        F.size(F.filter("extra_ends", lambda e: e < last)).cast("int").alias("shard"),
        F.md5(F.concat(F.lit("1:"), "ord")).alias("key")))
    extra = (F.col("extra") & (F.col("size") > 0)) | topped
    about = blocks.select("stratum", "block", "nth", "used", "nth_used", "again", "source_size", "target").join(
        top, "stratum", "left").join(ends, "stratum")
    return chosen.join(about, ["stratum", "block"]).select(
        F.col("id").alias(id_column), "source", "size", "content", "source_size", "target",
        F.concat(twice, F.when(extra, F.array(placed)).otherwise(F.array())).alias("takes"),
    )


def drawn(docs: DataFrame, mixed: DataFrame, id_column: str = "doc_id", source_column: str = "source",
          text_column: str = "text") -> DataFrame:
    """The mixture itself: a row of ``docs``, all columns unchanged, for each time it is taken.

    Rows come by shard, each shard in its own shuffled order.
    """
    takes = mixed.filter(F.size("takes") > 0).groupBy(
        F.col(id_column).alias("take_id"), F.col("source").alias("take_source"), F.col("content").alias("take_content"),
    ).agg(F.min("takes").alias("takes"))  # repeated rows have equal takes
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))  # no name can clash
    found = rows.withColumn("content", F.md5(F.coalesce(f"row.{text_column}", F.lit("")))).join(
        takes, F.col(f"row.{id_column}").eqNullSafe(F.col("take_id"))
        & F.col(f"row.{source_column}").eqNullSafe(F.col("take_source")) & (F.col("content") == F.col("take_content")))
    placed = found.select("row", F.explode("takes").alias("take"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["take.shard", "take.key"]
    return placed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("row.*")
