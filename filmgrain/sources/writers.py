"""Writers. Each one is a single distributed write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrain.operators import keys


def write_tsv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Raw dump layout: tabs, header, no quoting, backslash-N for null; ``compression`` as in published dumps."""
    df.write.csv(path, sep="\t", header=True, quote="", escape="", nullValue="\\N", emptyValue="", compression=compression)


def write_csv_nulls(df: DataFrame, path: str, null: str = "None") -> None:
    """CSV with header. Nulls, blanks and backslash-N are all written as ``null``."""
    text = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    clean = {
        c: F.when(F.col(c).isin("", "\\N"), F.lit(None)).otherwise(F.col(c)) for c in text
    }
    df.withColumns(clean).write.csv(path, header=True, nullValue=null, escape='"')


def write_csv_plain(df: DataFrame, path: str) -> None:
    """CSV with header and no null spelling: nulls are empty fields."""
    df.write.csv(path, header=True, escape='"')


def append_new(
    df: DataFrame, path: str, key: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Append rows whose key is new to the Parquet data at ``path``.

    Of rows sharing a key the first by ``order`` wins. Returns (appended, rejected);
    both are read from a written snapshot, so later reads do not see the append.
    """
    spark = df.sparkSession
    accepted, rejected = keys.split_new(df, spark.read.parquet(path), key, order)
    accepted, rejected = keys.settle(accepted, rejected)
    accepted.write.mode("append").parquet(path)
    return accepted, rejected


def create_table_as(
    df: DataFrame, table: str, path: str | None = None,
    bucket_by: str | Sequence[str] = (), buckets: int = 0,
) -> DataFrame:
    """Store a snapshot once; an existing table is kept as it is.

    ``bucket_by`` lays the table out by join key, so that later joins on it need
    no shuffle.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.write.mode("ignore").format("parquet")
        if path:
            writer = writer.option("path", path)
        keys_ = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
        if keys_ and buckets:
            writer = writer.bucketBy(buckets, *keys_).sortBy(*keys_)
        writer.saveAsTable(table)
    return spark.table(table)


def write_documents(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON document per line, null fields left out."""
    df.write.mode(mode).json(path)


def replace_all(df: DataFrame, path: str) -> None:
    """Delete what is stored, then insert."""
    df.write.mode("overwrite").parquet(path)


def write_dependencies(deps: DataFrame, path: str) -> None:
    """One ``left -> right`` line per dependency."""
    deps.select(F.format_string("%s -> %s", "lhs", "rhs").alias("value")).write.text(path)
