"""Registered corpus queries against their SQL, the pipeline against its stages' own results."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from offerflow.llm import lm, quality, secrets
from offerflow.llm.oracles import ORACLES
from offerflow.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in frame.select(*names).collect()))) == sorted(map(repr, result.fetchall()))


def test_held_out_texts_score_above_the_base(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = lm.scores(docs, settings=lm.Settings(least=3)).where("held_out").collect()
    assert rows
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, results = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(corpus_pipeline.written(stage(spark, results[-1], SF_DIR), name))
    raw, good, single, clean, mix, packed = results
    assert all(r.columns == columns for r in results[:-1])
    judged = quality.judged(raw, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert {r["doc_id"] for r in good.collect()} == {r["key"] for r in judged.where("kept").collect()}
    assert single.select("doc_id").distinct().count() == single.count() <= good.count()
    assert clean.count() == single.count()
    assert secrets.find_secrets(clean).where("size(spans) > 0").count() == 0
    assert clean.where("n_chars <> length(text)").count() == 0
    assert {r["doc_id"] for r in mix.collect()} <= {r["doc_id"] for r in clean.collect()}
    assert packed.where("start = 0").count() == mix.count()
    assert packed.agg({"length": "sum"}).first()[0] == sum(r["doc_tokens"] for r in packed.where("start = 0").collect())
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
