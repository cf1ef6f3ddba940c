"""The pipeline against a plain version of its stages, and the registered SQL."""

from __future__ import annotations

import duckdb
import plain
import pytest
from conftest import SMALL
from oracle_check import differences
from test_text_operators import similar_texts

import corpus_pipeline
from order_analytics.llm import oracle, packing, queries, repetition, simhash

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SQL = oracle.oracle_sql()


def plain_stages(rows):
    """Documents that stay, with their text, after the first three stages."""
    kept = [row for row in rows if plain.repetition(row[1], repetition.COVERAGE_PERCENT)["kept"]]
    print_of = lambda row: simhash.fingerprint((row[1] or "").encode(), 3)
    classes = plain.near_classes(kept, print_of)
    first = {}
    for row in sorted(kept):
        first.setdefault(classes[print_of(row)], row)
    return classes, list(first.values())


def test_each_stage_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "repeated passages", "best-fit packing"]
    good = stages["quality rules"](spark, docs, SMALL).cache()
    assert good.columns == docs.columns
    single = stages["near duplicates"](spark, good, SMALL).cache()
    assert single.columns == docs.columns
    _, kept = plain_stages(rows)
    assert sorted(tuple(row) for row in single.select("doc_id", "text").collect()) == sorted(kept)

    cut = stages["repeated passages"](spark, single, SMALL).cache()
    assert cut.columns == docs.columns and dict(cut.dtypes) == dict(docs.dtypes)
    exact = plain.byte_dedup(kept, 100)
    for row in cut.collect():
        n_bytes, n_removed, _, left = exact[row["doc_id"]]
        assert row["n_chars"] == len(row["text"])
        assert len(left) <= len(row["text"].encode()) <= n_bytes
        assert len(row["text"].encode()) - len(left) <= 6 * exact[row["doc_id"]][2]
    gone = set(exact) - {row["doc_id"] for row in cut.collect()}
    assert all(not exact[doc_id][3] for doc_id in gone)

    packed = stages["best-fit packing"](spark, cut, SMALL)
    assert {row["doc_id"] for row in packed.collect()} == {row["doc_id"] for row in cut.collect()}


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    key = lambda frame: sorted(map(str, frame.select("doc_id", "piece", "length").collect()))
    assert key(corpus_pipeline.run(spark, SMALL)) == key(docs)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_rows_and_nothing(spark):
    texts = [text for text in similar_texts(4, 12, 60)] + [None, "", " \n", "short"]
    rows = [(k, text, "en", "s", 0) for k, text in enumerate(texts)]
    rows += [(None, texts[0], None, None, None), (None, texts[0], None, None, None), (0, texts[0], "en", "s", 0), (0, texts[0] + " x", None, None, None)]
    for odd in (rows, []):
        docs = spark.createDataFrame(odd, DOCUMENT)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        found = docs.collect()
        assert bool(found) == bool(odd)
        assert all(row["length"] <= packing.CAPACITY for row in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    assert differences(queries.queries()[name](spark, SMALL), SQL[name], connection) is None


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [name.split("_")[0] for name in names] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
