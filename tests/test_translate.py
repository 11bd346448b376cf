import sys
import time

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sentloom.operators.batches import accepted, assign_batches, pad_batches, quarantined
from sentloom.operators.checks import audit_alignment, run_report
from sentloom.operators.regroup import find_islands, regroup
from sentloom.operators.translate import translate

# The loaders below run in Python workers, which cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "shard long, pos long, id string, input_ids array<int>, attention_mask array<int>, entities map<string,string>"


def tokens(spark, lengths, shard=1):
    rows = [(shard, p, str(p), [10 + p] * n, [1] * n, {"<ID1>": str(p)}) for p, n in enumerate(lengths)]
    return spark.createDataFrame(rows, SCHEMA)


def load_echo():
    return lambda ids, mask: [row[mask[i] == 1] for i, row in enumerate(ids)]


def load_choosy():
    def run(ids, mask):
        if (ids == 12).any():
            raise ValueError("twelve")
        if (ids == 14).any():
            time.sleep(5)
        if (ids == 16).any():
            return [[1]]
        return ids

    return run


def test_padding(spark):
    rows = pad_batches(assign_batches(tokens(spark, [2, 5, 3]), 2)).orderBy("pos").collect()
    assert rows[0]["input_ids"] == [1, 1, 1, 10, 10] and rows[0]["attention_mask"] == [0, 0, 0, 1, 1]
    assert rows[2]["input_ids"] == [12, 12, 12]
    assert {r["status"] for r in rows} == {"ok"}


def test_rejections(spark):
    labelled = pad_batches(assign_batches(tokens(spark, [1, 261, 260, 1, 2]), 2), max_pad=260, devices=2)
    assert [r["status"] for r in labelled.orderBy("pos").collect()] == ["over_length"] * 2 + ["ok"] * 2 + ["ragged"]
    assert accepted(labelled).count() + quarantined(labelled).count() == 5
    assert labelled.where("status = 'over_length' and pos = 0").first()["input_ids"] == [10]


def test_callable_translator(spark):
    df = tokens(spark, [3] * 700).unionByName(tokens(spark, [2] * 300, shard=2))
    out = translate(assign_batches(df, 64), load_echo)
    rows = out.collect()
    assert len(rows) == 1000
    assert all(r["status"] == "ok" and r["output_ids"] == [10 + r["pos"]] * (3 if r["shard"] == 1 else 2) for r in rows)
    assert all(r["entities"] == {"<ID1>": str(r["pos"])} for r in rows)
    report = {(r["shard"], r["status"]): (r["rows"], r["batches"]) for r in run_report(out).collect()}
    assert report == {(1, "ok"): (700, 11), (2, "ok"): (300, 5)}


def test_failures_are_set_aside(spark):
    out = translate(assign_batches(tokens(spark, [1] * 10), 2), load_choosy, deadline_s=1.0)
    rows = out.orderBy("pos").collect()
    assert [r["status"] for r in rows] == ["ok"] * 2 + ["failed"] * 2 + ["timeout"] * 2 + ["failed"] * 2 + ["ok"] * 2
    assert rows[2]["error"] == "ValueError: twelve" and rows[2]["output_ids"] is None
    assert "1 sequences for 2 rows" in rows[6]["error"]


def test_failures_can_end_the_job(spark):
    with pytest.raises(Exception, match="twelve"):
        translate(assign_batches(tokens(spark, [1] * 10), 2), load_choosy, on_error="fail").collect()
    with pytest.raises(ValueError):
        translate(assign_batches(tokens(spark, [1]), 2), load_echo, on_error="ignore")


def test_translated_batches_arrive_whole(spark):
    """A translator sees each batch once, complete and in order, across record batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        def load():
            return lambda ids, mask: np.repeat(ids[:, :1].T, len(ids), axis=0)

        rows = translate(assign_batches(tokens(spark, [1] * 100), 10), load).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(r["output_ids"] == [10 + 10 * r["batch_id"] + k for k in range(10)] for r in rows)


def test_alignment(spark):
    good = tokens(spark, [1, 2])
    bad = good.withColumn("attention_mask", F.when(F.col("pos") == 1, F.array(F.lit(1))).otherwise(F.col("attention_mask")))
    assert audit_alignment(good).first()["ok"] is True
    assert audit_alignment(bad).first()["ok"] is False
    assert audit_alignment(good.withColumn("id", F.lit(None).cast("string"))).first()["ok"] is False


SENT = "shard long, pos long, file_no long, row long, id string, sent_idx long, sentence string"
META = "shard long, ord long, id string, meta struct<id:string,dump:string,url:string,file_path:string>"


def sentences(spark, ids, shard=1):
    return spark.createDataFrame([(shard, p, 0, p, i, 0, f"s{p}") for p, i in enumerate(ids)], SENT)


def meta(spark, rows):
    return spark.createDataFrame([(s, o, i, (i, d, "u", "p")) for s, o, i, d in rows], META)


def test_runs_make_documents(spark):
    m = meta(spark, [(1, 0, "a", "x"), (1, 1, "b", "y"), (1, 2, "a", "z")])
    rows = regroup(sentences(spark, ["a", "a", "b", "a"]), m, "shard").orderBy("island").collect()
    assert [(r["uuid"], r["text"], r["meta"]["dump"]) for r in rows] == [
        ("a", ["s0", "s1"], "z"), ("b", ["s2"], "y"), ("a", ["s3"], "z")
    ]


def test_null_ids_are_a_run(spark):
    islands = find_islands(sentences(spark, [None, None, "a"])).orderBy("pos").collect()
    assert [r["island"] for r in islands] == [0, 0, 1]


def test_missing_metadata(spark):
    sents = sentences(spark, ["a", "b"])
    m = meta(spark, [(1, 0, "a", "x")])
    with pytest.raises(Exception, match="no metadata for document b in shard 1"):
        regroup(sents, m, "shard").collect()
    assert [r["meta"] for r in regroup(sents, m, "shard", strict=False).orderBy("island").collect()][1] is None
    # No metadata at all: the lookup is skipped.
    assert [r["meta"] for r in regroup(sents, m.where("false"), "shard").collect()] == [None, None]


def test_corpus_scope_joins_the_parts(spark):
    rows = [(1, 0, 0, 0, "a", 0, "x"), (1, 1, 0, 1, "b", 0, "y"), (2, 0, 0, 1, "b", 1, "z"), (3, 0, 0, 1, "b", 2, "w")]
    sents = spark.createDataFrame(rows, SENT)
    m = meta(spark, [(1, 0, "a", "x"), (1, 1, "b", "y"), (2, 1, "b", "y"), (3, 1, "b", "y")])
    m = m.withColumns({"file_no": F.lit(0).cast("long"), "row": F.col("ord")})
    got = {r["uuid"]: (r["text"], r["meta"]["dump"], r["shard"]) for r in regroup(sents, m).collect()}
    assert got == {"a": (["x"], "x", 1), "b": (["y", "z", "w"], "y", 1)}
    assert regroup(sents, m, "shard").count() == 4
    with pytest.raises(Exception, match="no metadata for row 1 of file 0"):
        regroup(sents, m.where("row = 0")).collect()
    assert regroup(sents, m.where("row = 0"), strict=False).where("meta is null").count() == 1
    with pytest.raises(ValueError):
        regroup(sents, m, "node")
