"""The registered queries of the subpackage: name -> (spark, data folder) -> DataFrame.

Each applies its operator to a whole table and derives the columns of its result from the operator's
output.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from order_analytics.llm import (
    backoff_lm,
    bounded_kmeans,
    byte_bpe,
    byte_dedup,
    merkle,
    packing,
    repeats,
    repetition,
    secrets,
    sharding,
    simhash,
    vector_tree,
    warc,
    word_dedup,
)
from order_analytics.llm.shipping import ship
from order_analytics.operators.staging import new_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, RANKS)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_lm.score(_table(spark, sf_dir, "documents"))
    return scored.withColumns({name: F.round(name, 4) for name in ("log_score", "mean_log")})


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = byte_dedup.remove(_table(spark, sf_dir, "documents"))
    return removed.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = repetition.judge(_table(spark, sf_dir, "documents"))
    return judged.select("row.doc_id", *(name for name in judged.columns if name != "row"))


def op5_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = word_dedup.remove(_table(spark, sf_dir, "documents"))
    return repeats.few_files(removed.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")))


def op6_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_table(spark, sf_dir, "documents"), shingle=3)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = new_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), archives, least_bytes=0)
    damaged = F.raise_error(F.concat(F.lit("payload differs from its digest, page "), F.coalesce(F.col("page_id").cast("string"), F.lit("-"))))
    read = warc.read_archives(spark, archives)
    sound = F.when(F.col("intact") == F.lit(False), damaged.cast("string")).otherwise(F.col("payload_digest"))
    return read.withColumn("payload_digest", sound).drop("intact")


def op9_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=40)


def op10_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return vector_tree.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    changed = merkle.leaf([lowered if name == "text" else F.col(name) for name in merkle.FIELDS])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(_table(spark, sf_dir, "documents"), claimed=F.when(tampered, changed))


def op12_shallot_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = bounded_kmeans.cluster(_table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, seed="2:")
    return clustered.withColumn("centroid_sha256", bounded_kmeans.centroid_digest("centroid")).drop("centroid")


BASE_SECRETS = ("assign", "access", "hex")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of_kinds(*kinds: str) -> Column:
        return F.filter("finds", lambda find: find["kind"].isin(*kinds))

    def listed(finds: Column) -> Column:
        return F.array_join(F.transform(finds, lambda find: F.concat_ws(":", find["kind"], find["start"], find["end"])), ",")

    found = secrets.scan(_table(spark, sf_dir, "documents"))
    counts = [F.size(of_kinds(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_SECRETS]
    base = F.sha2(listed(of_kinds(*BASE_SECRETS)), 256)
    return found.select("row.doc_id", *counts, base.alias("base_sha256"), listed(F.col("finds")).alias("spans"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_backoff_lm": op2_backoff_lm,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_repetition_rules": op4_repetition_rules,
        "op5_suffix_tree_dedup": op5_suffix_tree_dedup,
        "op6_golay_simhash": op6_golay_simhash,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_warc_revisits": op8_warc_revisits,
        "op9_vector_sharding": op9_vector_sharding,
        "op10_vector_tree": op10_vector_tree,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_shallot_clustering": op12_shallot_clustering,
        "op13_secret_scan": op13_secret_scan,
        "pipeline": corpus_pipeline.run,
    }
    return {name: _shipped(query) for name, query in found.items()}
