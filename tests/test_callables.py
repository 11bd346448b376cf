"""Tokenizers given as functions: only guilty rows are set aside, and they come back."""

import time

import pytest
from pyspark.sql import functions as F

from sentloom.operators.callables import CallableTokenizer, isolated, retokenizable
from sentloom.operators.checks import run_report
from sentloom.plans import jobs
from sentloom.sources.sinks import committed_shards, write_rows

SENT = "shard long, pos long, file_no long, row long, id string, sent_idx long, sentence string"


def sentences(spark, texts, size=100):
    rows = [(1 + i // size, i % size, 0, i, f"d{i}", 0, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SENT).withColumn("entities", F.create_map().cast("map<string,string>"))


def test_only_the_guilty_items_fail():
    calls = []

    def call(items):
        calls.append(len(items))
        if 13 in items or 50 in items:
            raise RuntimeError("bad luck")
        return [x * 2 for x in items]

    out, status, errors = isolated(call, list(range(64)), int)
    assert [i for i, s in enumerate(status) if s != "ok"] == [13, 50]
    assert out == [None if i in (13, 50) else 2 * i for i in range(64)]
    assert errors[13] == "RuntimeError: bad luck" and errors[0] is None
    # Halving asks for few batches: two paths of the height of the tree.
    assert len(calls) <= 4 * 6 + 1
    assert isolated(call, [], int) == ([], [], [])


def test_wrong_counts_and_results_are_failures():
    out, status, errors = isolated(lambda items: items[1:], [1, 2], int)
    assert out == [None, None] and status == ["failed"] * 2 and errors[0] == "ValueError: 0 results for 1 items"
    _, status, _ = isolated(lambda items: items, ["1", "x", "3"], int)
    assert status == ["ok", "failed", "ok"]
    with pytest.raises(ValueError):
        isolated(lambda items: items, ["x"], int, on_error="fail")


def test_late_items_stand_alone():
    def call(items):
        if "slow" in items:
            time.sleep(5)
        return [len(x) for x in items]

    begin = time.time()
    out, status, _ = isolated(call, ["a", "slow", "bb", "ccc"], int, deadline_s=0.2)
    assert out == [1, None, 2, 3] and status[1] == "timeout" and time.time() - begin < 3


def loaders():
    """Made here, so that they travel to the workers by value."""

    def load():
        def encode(texts):
            if any("bad" in t.lower() for t in texts):
                raise RuntimeError("refused")
            return [[4 + len(w) for w in t.split()] for t in texts]

        return encode

    def load_patient():
        return lambda texts: [[4 + len(w) for w in t.split()] for t in texts]

    def load_decode():
        def decode(sequences):
            if any(list(s) == [9] for s in sequences):
                raise RuntimeError("cannot say")
            return [" ".join("x" * (i - 4) for i in s) for s in sequences]

        return decode

    return load, load_patient, load_decode


load, load_patient, load_decode = loaders()


def test_there_and_back(spark, folder):
    texts = ["one two", "bad egg", None, "", "five5", "a b c d e"] * 30
    tokenizer = CallableTokenizer(load, load_decode, batch_size=16, max_length=4)
    tokens = tokenizer.encode(sentences(spark, texts))
    assert tokens.where("token_status <> 'ok'").select("untokenized").distinct().collect()[0][0] == "bad egg"
    assert tokens.where("truncated").count() == 30 and tokens.agg(F.max(F.size("input_ids"))).first()[0] == 4
    translated = jobs.translate_shards(tokens, lambda: lambda ids, mask: [i[m > 0] for i, m in zip(ids, mask)], 32, None)
    assert {(r["status"], r["rows"]) for r in run_report(translated).groupBy("status").agg(F.sum("rows").alias("rows")).collect()} == {("ok", 150), ("untokenized", 30)}
    meta = tokens.select("shard", F.col("row").alias("ord"), "id", "file_no", "row").withColumn(
        "meta", F.struct("id", F.lit("d").alias("dump"), F.lit("u").alias("url"), F.lit("f").alias("file_path"))
    )
    documents = jobs.regroup_shards(translated, meta, tokenizer, "xx", "yy").collect()
    assert len(documents) == 180
    # The refused ones, and those that cannot be decoded.
    assert sum(not r["complete"] for r in documents) == 60
    again = CallableTokenizer(load_patient).encode(retokenizable(tokens))
    assert set(again.columns) == set(tokens.columns)
    assert again.where("token_status = 'ok'").count() == 30
    write_rows(translated, f"{folder}/done", 1)
    assert committed_shards(spark, f"{folder}/done").count() == 0
    assert committed_shards(spark, f"{folder}/done", kept=True).count() == 2


def test_failures_can_end_the_job(spark):
    tokens = CallableTokenizer(load, on_error="fail").encode(sentences(spark, ["bad"]))
    with pytest.raises(Exception, match="refused"):
        tokens.collect()
    with pytest.raises(ValueError):
        CallableTokenizer(load, on_error="ignore")
    with pytest.raises(ValueError, match="load_decode"):
        CallableTokenizer(load).decode(tokens)


def test_as_the_tokenizer_of_prepare(spark):
    docs = spark.createDataFrame([("a", "One two. Bad egg. Three.", "d", "u", "f", 0, 0)], "id string, text string, dump string, url string, file_path string, file_no long, row long")
    prepared = jobs.prepare(docs, "xx", "yy", tokenizer=CallableTokenizer(load))
    assert {(r["pos"], r["token_status"]) for r in prepared.tokens.collect()} == {(0, "ok"), (1, "failed"), (2, "ok")}
