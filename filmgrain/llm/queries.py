"""The registered queries: each runs its operator over a whole table and derives the digest."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrain.llm import (
    chat, itq, langid, mixing, pieces, pii, sharding, substrings, syncmers, token_counts, tries,
    weighted_minhash, whitening,
)
from filmgrain.llm.oracles import SQL  # noqa: F401  re-exported beside QUERIES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op3_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    planted = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{odd}'), (-1L, 1L, 'assistant', '{odd}') AS t(conv_id, turn, role, text)")
    back = chat.read_back(chat.windows(conversations.unionByName(planted)))
    said = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = back.select(
        "conv_id", F.struct("window", said.alias("said"), "loss", F.size("turns").alias("n"), "chars").alias("w"))
    # A digest of a whole conversation needs its text as one value.
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    joined = lambda name: F.array_join(F.col(f"w.{name}"), "")
    total = lambda name: F.aggregate(f"w.{name}", F.lit(0).cast("long"), lambda a, x: a + x)
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))


def op4_seed_and_extend(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"), with_text=False)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return weighted_minhash.label(table(spark, folder, "documents"))


def op6_itq_links(spark: SparkSession, folder: str) -> DataFrame:
    found = itq.links(table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.against_next(table(spark, folder, "documents"))


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("size") * F.size("takes")).alias("taken"))


def op9_viterbi_pieces(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = pieces.read_vocabulary()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = docs.withColumn("ids", pieces.encode(spark, vocabulary, F.col("text")))
    back = coded.withColumn("back", pieces.decode(spark, vocabulary, F.col("ids")))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("back", 256).alias("decoded_sha256"), F.col("back").eqNullSafe(F.col("text")).alias("restored"))


def op10_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.interleave(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op1_crf_pii(spark: SparkSession, folder: str) -> DataFrame:
    field = pii.fit(pii.labelled_table(spark))
    docs = table(spark, folder, "documents").select("doc_id", pii.find(spark, field, F.col("text")).alias("s"))
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("s", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(
        "s", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return docs.select(
        "doc_id", *(count(kind) for kind in pii.KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))


def op2_ngram_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    model = langid.fit(docs.filter(~held_out))
    named = docs.select("doc_id", held_out.alias("held_out"), langid.predict(spark, model, F.col("text")).alias("p"))
    return named.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op11_euler_tour_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.trie(table(spark, folder, "conversations"))


def op12_rank_merged_tokens(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = token_counts.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, folder, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_counts.count(spark, vocabulary, F.col("text")).alias("n_tokens"))
    return docs.withColumn("over_limit", F.col("n_tokens") > 1024)


def op13_polarised_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_crf_pii, op2_ngram_filters, op3_chat_windows, op4_seed_and_extend,
    op5_weighted_minhash, op6_itq_links, op7_syncmer_fingerprints, op8_mix_sources, op9_viterbi_pieces, op10_interleaved_shards,
    op11_euler_tour_trie, op12_rank_merged_tokens, op13_polarised_whitening,
)}
