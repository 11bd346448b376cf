"""The pipeline and the registered queries."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = str(Path(__file__).parent.parent.parent)
sys.path.insert(0, ROOT)

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from sentloom.llm.queries import ORACLES, QUERIES  # noqa: E402
from sentloom.llm.secret_scan import RULES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(map(tuple, cursor.fetchall()))
    assert sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, FOLDER).collect()) == want


def test_stages_keep_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        gone = set(before) - set(after)
        if name == "toxicity":
            assert sum(labels.get(d) == 1 for d in gone) >= 30 and sum(labels.get(d) == 0 for d in gone) <= 5
        elif name == "n-gram Jaccard join":
            exact = {d for d, t in before.items() if t and min(x for x, other in before.items() if other == t) != d}
            assert exact <= gone and len(gone) <= 0.15 * len(before)
        else:
            assert gone == {d for d, t in before.items() if any(len(m[r.group]) >= r.least for r in RULES for m in re.finditer(r.pattern, t or ""))}
        docs, before = spark.createDataFrame(out.collect(), out.schema), after
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()} == set(before)


def test_stages_on_no_documents(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, FOLDER)
        assert docs_out.count() == 0


def test_stages_on_odd_documents(spark, odd_documents):
    docs = odd_documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    assert docs.columns == odd_documents.columns
    assert {r["doc_id"] for r in docs.collect()} == {1, 2, 3, 4, 5, 6, None}
    assert docs.count() == 7
