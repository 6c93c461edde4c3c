"""Registered queries on the smallest given tables: against their SQL, or against plain facts where SQL has no form."""

import os

import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidemark import session
from tidemark.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return check.connect(FOLDER)


def test_names():
    assert [q.split("_")[0] for q in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) and "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert check.compare(spark, duck, FOLDER, name).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op1_decontaminate", "op3_token_counts"}))
def test_one_row_per_document(spark, name):
    got = QUERIES[name](spark, FOLDER).select("doc_id").collect()
    ids = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in ids)


def test_contract_columns(spark):
    assert QUERIES["op2_quality"](spark, FOLDER).dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert QUERIES["op6_language"](spark, FOLDER).dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    told = QUERIES["op6_language"](spark, folder).where("held_out").join(docs, "doc_id").where("lang IS NOT NULL")
    assert told.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97
    graded = QUERIES["op2_quality"](spark, folder).where("held_out").join(labels, "doc_id")
    good = graded.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("share")).collect()
    assert all(r.share > 0.8 for r in good) and len(good) == 2


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = session.cut(stage(spark, docs, FOLDER), name)
        assert kept.columns == docs.columns, name
        assert kept.select("doc_id").exceptAll(docs.select("doc_id")).count() == 0
        docs = kept
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.where("NOT round_trip").count() == 0
    assert out.select("doc_id").distinct().count() == docs.count() > 100
