"""Documents to packed training sequences: quality rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last
return the columns of the documents. Null and repeated values: see each stage and its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from order_analytics.llm import byte_dedup, packing, repetition, simhash
from order_analytics.llm.shipping import ship
from order_analytics.operators.staging import write_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules; null and blank texts do not."""
    return repetition.judge(docs, tuple(docs.columns)).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies by SimHash: that with the smallest doc_id.

    Three-word shingles, fingerprints at most two bits apart. Rows without doc_id come last in their class.
    """
    return simhash.representatives(docs, shingle=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the characters that earlier 100-byte strings repeat; emptied texts go, as do null ones."""
    cut = byte_dedup.remove(docs, tuple(docs.columns), whole_characters=True)
    text = F.decode("kept", "UTF-8")
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    columns = [changed[name].alias(name) if name in changed else F.col(f"row.{name}") for name in docs.columns]
    return cut.filter(F.length("kept") > 0).select(columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bins."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("best-fit packing", best_fit_packing),
]

#: Neither fingerprints, byte strings nor packing can be put in SQL; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written, and read as the next one's."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs, _ = write_table(docs, name.replace(" ", "-"))
    return docs
