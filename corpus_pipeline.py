"""From raw documents to encoded training text: five stages, each written and reread as Parquet.

1. language: documents without letters, or whose n-grams no learned language contains, go.
2. near_duplicates: of each class of near copies one document stays.
3. personal_data: what is found in a text is replaced by its kind.
4. mixture: documents are drawn to the sources' target weights, up to twice, and shuffled.
5. pieces: texts are encoded; the result adds the piece ids.

Null languages are filled with the predicted one. The first four stages return the columns
they get, in order, whatever further columns there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm import langid, mixing, pieces, pii, weighted_minhash
from filmgrain.workspace import stage_path

#: A document is rejected if less than this share of its n-grams is known to its language.
LEAST_KNOWN = 0.2


def _replace(docs: DataFrame, **changed: Column) -> list[Column]:
    return [changed[c].alias(c) if c in changed else docs[c] for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    named = row.withColumn("found", langid.predict(spark, model, F.col("row.text")))
    if model.languages:
        named = named.filter((F.col("found.lang") != langid.UNKNOWN) & (F.col("found.score") >= LEAST_KNOWN))
    else:  # nothing to compare with: only texts without letters go
        named = named.filter(F.col("row.text").rlike(r"\p{L}"))
    lang = F.coalesce("row.lang", F.nullif("found.lang", F.lit(langid.UNKNOWN)))
    return named.select(*(lang.alias(c) if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weighted_minhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = pii.fit(pii.labelled_table(spark))
    hidden = docs.select(*_replace(docs, text=pii.redact(spark, field, docs["text"])))
    return hidden.select(*_replace(hidden, n_chars=F.char_length(hidden["text"]).cast("long")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn(docs, mixing.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs.withColumn("piece_ids", pieces.encode(spark, pieces.read_vocabulary(), docs["text"]))


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
    ("mixture", mixture), ("pieces", encoded),
]

#: Sampling, fields and piece paths have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = stage_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
