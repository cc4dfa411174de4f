"""Contract queries: thin adapters that run an operator over its whole table with production
parameters and derive the digest columns from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinscore.llm.common import table


def op1_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.chat_trees import format_paths, masked_text, read_turns, turns_as_trees

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(
        spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], rows.schema)
    )
    found = format_paths(turns_as_trees(rows))
    found = found.withColumns({
        "turns": read_turns(F.col("formatted")), "learnt": masked_text(F.col("formatted"), F.col("loss_mask"))
    })
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return found.select(
        F.col("tree").try_cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.toxicity_pu import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.token_shards import token_shards

    return token_shards(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.sentencepiece_codec import sentencepiece_codec

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec(docs, fields=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.language_id import identify

    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.substring_dedup import substring_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, keep_clean=False).drop("text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.quality_rules import quality_rules

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, keep_clean=False)
    return judged.drop("text")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.source_mixing import plan_mix

    plan = plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    mix = F.col("__mix")
    taken = mix["size"] * F.size(mix["copies"])
    return plan.select(
        "doc_id", mix["size"].alias("size"), mix["source_size"].alias("source_size"),
        mix["target"].alias("target"), taken.cast("long").alias("taken"), mix["copies"]["shard"].alias("shards"),
    )


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.simhash_dedup import simhash_components

    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op10_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.hnsw_search import nearest

    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op11_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.wu_manber import decontaminate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.ns_kmeans import ns_kmeans

    found = ns_kmeans(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kinscore.llm.dialogue_repair import COUNTS, damaged, repair

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    found = repair(damaged(rows, F.crc32(name) % 20), gone="gone")
    whole = F.concat_ws("\n", F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
    return found.select("conv_id", *COUNTS, "audit", F.sha2(whole, 256).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_trees, op2_toxicity_pu, op3_token_shards, op4_sentencepiece, op5_language_id, op6_substring_dedup, op7_quality_rules, op8_source_mixing, op9_simhash_dedup, op10_hnsw_search, op11_wu_manber, op12_ns_kmeans, op13_dialogue_repair)
}
