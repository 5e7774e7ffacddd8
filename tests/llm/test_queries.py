import glob
import os
import sys

import duckdb
import pytest

import corpus_pipeline
from wordloom import workspace
from wordloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"
NATIVE = {"op1_secret_scan", "op2_benchmark_templates", "op8_line_quality", "op9_systematic_mix", "op13_personal_data"}


@pytest.fixture
def handed_off(monkeypatch):
    """Plans of all tables that operators write on their way."""
    plans, write = [], workspace.materialize

    def seen(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args)

    for module in list(sys.modules.values()):
        if getattr(module, "__name__", "").startswith("wordloom.llm") and hasattr(module, "materialize"):
            monkeypatch.setattr(module, "materialize", seen)
    return plans


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name, handed_off):
    df = queries.QUERIES[name](spark, SF_DIR)
    for plan in (df._jdf.queryExecution().executedPlan().toString(), *handed_off):
        for unwanted in ("CartesianProduct", *(("Python", "Arrow", "Pandas") if name in NATIVE else ())):
            assert unwanted not in plan
    assert handed_off or name not in NATIVE
    got = df.toPandas()
    if name not in queries.ORACLE:
        assert len(got) > 0
        return
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(queries.ORACLE[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    got = got[cols].sort_values(cols, ignore_index=True)
    want = want[cols].sort_values(cols, ignore_index=True)
    for col in cols:
        assert ((got[col].values == want[col].values) | (got[col].isna() & want[col].isna())).all(), col


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns
        if name != "mix":
            assert 0.5 * before < docs.count() <= before
            before = docs.count()
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert whole.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert whole.count() == docs.count()
