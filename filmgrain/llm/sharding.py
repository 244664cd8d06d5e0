"""Proportional stratified interleaving: every shard holds the same mixture of sources.

Rows of a source are put in a seeded pseudo-random order; a row at rank r of n gets the
fraction (2r + 1) / 2n. Sorted by fraction, sources alternate in proportion to their
sizes, and equal cuts of that order are the shards.

Both ranks are counted in two steps, so that no task sees a whole source or the whole
table: rows fall into a fixed number of buckets, rows before a bucket are counted apart,
and only the place inside the bucket needs a sort. A source that holds a third of the
rows is spread over as many buckets as any other.

Defined results: null sources form a source of their own, last in order; a null text has
no bytes; repeated rows are all placed, each in a slot of its own; an empty table gives
an empty result; columns that are not named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the seeded order: the first digits of an md5, so a power of 16.
HEX_DIGITS = 3
#: Buckets of the fractions, of equal width and therefore of equal size.
FRACTIONS = 4096


def interleave(
    docs: DataFrame, shards: int = 8, seed: str = "interleave",
    id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """Rows of ``docs`` as (id, source, size, text_crc32, shard, slot); counts differ by one at most.

    ``size`` is UTF-8 bytes plus one. ``slot`` numbers the rows of a shard from 0.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text, ident = F.col(text_column), F.col(id_column)
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("-"))))
    rows = docs.select(
        ident.alias("id"), F.col(source_column).alias("source"),
        # sorts as sources do, null last, and is never null itself
        F.concat(F.when(F.col(source_column).isNull(), "1").otherwise("0"),
                 F.coalesce(source_column, F.lit(""))).alias("stratum"),
        order.alias("ord"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    ).withColumn("bucket", F.substring("ord", 1, HEX_DIGITS))

    # At most sources x 16^digits rows: rows of the same source in earlier buckets.
    before = Window.partitionBy("stratum").orderBy("bucket")
    starts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n")).select(
        "stratum", "bucket",
        (F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("first"),
        F.sum("n").over(Window.partitionBy("stratum")).alias("rows"),
    )
    place = Window.partitionBy("stratum", "bucket").orderBy("ord", "text_crc32", "size")
    ranked = rows.withColumn("place", F.row_number().over(place)).join(starts, ["stratum", "bucket"])
    odd = 2 * (F.col("first") + F.col("place")) - 1  # 2r + 1
    mixed = ranked.select(
        "id", "source", "stratum", "ord", "size", "text_crc32",
        (odd / (2 * F.col("rows"))).alias("fraction"),
        F.expr(f"(2 * (first + place) - 1) * {FRACTIONS} div (2 * rows)").alias("band"),
    )

    # Rows of a source of n below band b: those with (2r + 1) * FRACTIONS < 2bn.
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n"))
    bands = sizes.select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(FRACTIONS - 1).cast("long"))).alias("band"))
    bands = bands.groupBy("band").agg(
        F.sum(F.expr(f"(2 * band * n + {FRACTIONS - 1}) div {2 * FRACTIONS}")).alias("below"),
        F.sum("n").alias("total"),
    )
    line = Window.partitionBy("band").orderBy("fraction", "stratum", "ord", "text_crc32", "size")
    placed = mixed.withColumn("at", F.row_number().over(line)).join(bands, "band")
    rank = F.col("below") + F.col("at") - 1
    return placed.withColumn("rank", rank).withColumn(
        "shard", F.expr(f"cast(rank * {shards} div total as int)"),
    ).select(
        F.col("id").alias(id_column), "source", "size", "text_crc32", "shard",
        F.expr(f"rank - (shard * total + {shards - 1}) div {shards}").alias("slot"),
    )
