"""The registered queries over small driver tables, against their SQL or their contracts."""

import os
import zlib

import duckdb
import pytest
from pyspark.sql import Row

import __spark_entry__
import corpus_pipeline
from stallkeep.llm.common import written
from stallkeep.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    relation = connection.sql(ORACLE[name])
    found = QUERIES[name](spark, SF_DIR).select(*relation.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(relation.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["op4_packing", "op5_id_file", "op8_pieces", "op9_near_dedup", "op1_main_text", "op13_personal_data"])
def test_every_row_has_its_result(spark, name):
    source, key = ("pages", "page_id") if name == "op1_main_text" else ("documents", "doc_id")
    wanted = spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key).distinct()
    found = QUERIES[name](spark, SF_DIR)
    assert found.select(key).distinct().exceptAll(wanted).isEmpty() and wanted.exceptAll(found.select(key).distinct()).isEmpty()


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scored = {r.doc_id: r for r in QUERIES["op7_quality"](spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert set(scored) == {r.doc_id for r in documents.select("doc_id").collect()}
    quality = [Row(quality=r.quality, **scored[r.doc_id].asDict()) for r in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in quality)
    held = [r for r in quality if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.85 * len(held)
    language = QUERIES["op10_language"](spark, SF_DIR).join(documents, "doc_id").collect()
    assert len(language) == documents.count()
    held = [r for r in language if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= ids and docs.count() == len(kept)
        if name != "MinHash near-dedup":
            assert len(good & kept) >= 0.97 * len(good & ids)
        ids = kept
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids
