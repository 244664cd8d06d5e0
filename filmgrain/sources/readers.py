"""Readers. Schemas are explicit, so no read starts an inference job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmgrain import schemas


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, position: bool = False) -> DataFrame:
    """Tab-separated text with a header, no quoting at all, backslash-N as null.

    ``position=True`` adds ``_pos``, the row's place in the files.
    """
    lines = spark.read.csv(
        path, schema=schema, sep="\t", header=True, quote="", nullValue="\\N",
        encoding="UTF-8", enforceSchema=True, mode="PERMISSIVE",
    )
    return with_position(lines) if position else lines


def read_tsv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same file with typed columns; unreadable values become null."""
    raw = read_tsv(spark, path, schemas.all_text(*schema.fieldNames()))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV whose columns are taken by position, nulls spelled ``None``."""
    return spark.read.csv(
        path, schema=schema, header=True, nullValue="None", escape='"', enforceSchema=True,
    )


def read_csv_columns(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """Only the named columns of such a CSV."""
    return read_csv_table(spark, path, schema).select(*columns)


def read_wrapped_json(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ENRICHMENT, position: bool = False
) -> DataFrame:
    """JSON lines of ``{"field": {"value": ...}}``, unwrapped; missing keys are null.

    ``position=True`` adds ``_pos``, which orders rows as they stand in the files:
    by file name, then by split, then by row within the split.
    """
    lines = spark.read.schema(schema).json(path)
    cells = [F.col(f"{f.name}.value").alias(f.name) for f in schema]
    return with_position(lines).select(*cells, "_pos") if position else lines.select(*cells)


def read_wrapped_json_whole(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ENRICHMENT, rest: str = "rest"
) -> DataFrame:
    """The same, and every key that the schema does not name: ``rest`` maps it to its value.

    Keys need not be known beforehand. A line without further keys has an empty map, a cell
    without a value a null one, and a line that is no JSON object a null map and null cells.
    """
    cells = F.from_json("value", "map<string,struct<value:string>>")
    known = [f.name for f in schema]
    found = spark.read.text(path).select(F.transform_values(cells, lambda _, c: c["value"]).alias("_c"))
    return found.select(
        *[F.element_at("_c", name).alias(name) for name in known],
        F.map_filter("_c", lambda k, _: ~k.isin(*known)).alias(rest))


def with_position(lines: DataFrame) -> DataFrame:
    """``_pos`` added, which orders rows as they stand in the files: by file, split, and row within the split."""
    return lines.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("_pos"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table, or Parquet files when given a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)
