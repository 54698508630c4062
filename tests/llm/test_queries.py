"""Every registered query: runs, its DuckDB twin agrees, the pipeline's stages."""

from __future__ import annotations

import importlib
import os
import re

import duckdb
import pytest

from assetlife.llm.queries import ORACLE, QUERIES
from assetlife.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, duck, name):
    want = duck.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = want.columns[0]
    got, want = (x[sorted(want.columns)].sort_values(key).reset_index(drop=True) for x in (got, want))
    assert (got == want).all().all() and len(got) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_over_the_whole_table(spark, name):
    out = QUERIES[name](spark, SF)
    rows = {"op1": "embeddings", "op3": "conversations", "op10": None, "op11": None, "op12": None}.get(name.split("_")[0], "documents")
    n = out.count()
    if rows == "conversations":
        assert n == spark.read.parquet(f"{SF}/{rows}.parquet").select("conv_id").distinct().count() + 1
    elif rows:
        assert n == spark.read.parquet(f"{SF}/{rows}.parquet").count()


def test_pipeline_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in pipeline.STAGES:
        after = materialize(stage(spark, before, SF), "test-stage")
        if name != "mixing":
            assert after.columns == docs.columns
        gone = before.join(after, "doc_id", "left_anti").count()
        assert after.count() + gone == before.count()
        if name == "secrets":
            assert gone == 0
        before = after
    assert {"size", "source_size", "target", "taken"} <= set(before.columns)
    key = ["doc_id", "size", "taken"]
    again = pipeline.run(spark, SF)
    assert sorted(map(tuple, again.select(key).collect())) == sorted(map(tuple, before.select(key).collect()))


def test_pipeline_takes_odd_rows(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(30).select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(None, None, None, None, None), (1000, "", "en", None, 0), (1001, "same words here", "en", "s", 15), (1001, "same words here", "en", "s", 15)]
    docs = real.unionByName(spark.createDataFrame(rows, columns))
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    for source in (docs, docs.limit(0)):
        before = source
        for _, stage in pipeline.STAGES:
            before = materialize(stage(spark, before, str(tmp_path)), "test-odd")
        assert before.count() <= source.count()
