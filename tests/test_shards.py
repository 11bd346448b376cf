import random

import pytest
from pyspark.sql import functions as F

from sentloom.operators.sentences import skip_done
from sentloom.operators.shards import assign_shards, locate, shard_meta, shard_sentences, shard_watermarks

SCHEMA = (
    "file_no bigint, row bigint, id string, dump string, url string, file_path string, "
    "sentences array<string>, n_sentences bigint"
)


def corpus(spark, files):
    """``files``: per file, the number of sentences of each document."""
    rows = [
        (f, r, f"{f}-{r}", "d", f"u{f}-{r}", "p", [f"s{f}.{r}.{k}" for k in range(n)], n)
        for f, counts in enumerate(files)
        for r, n in enumerate(counts)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def simulate(files, size, tail, per_file):
    """Walk the documents in order, filling one buffer: shards, their documents and their watermarks."""
    shards, metas, marks = [], [], []
    buffer, listed, number = [], [], 0
    for f, counts in enumerate(files):
        if per_file:
            buffer, listed, number = [], [], 0
        for r, n in enumerate(counts):
            buffer += [(f, r, k) for k in range(n)]
            listed.append((f, r))
            while len(buffer) >= size:
                shards.append((f, number, buffer[:size]))
                metas.append((f, number, list(listed)))
                marks.append((f, number, r + 1))
                buffer = buffer[size:]
                listed = [listed[-1]] if buffer else []
                number += 1
        last = f == len(files) - 1
        if buffer and tail == "flush" and (per_file or last):
            shards.append((f, number, buffer))
            metas.append((f, number, listed))
            marks.append((f, number, len(counts)))
    return shards, metas, marks


CORPORA = [
    [[3, 0, 2, 5, 0, 0, 1], [4, 4], [4], [0, 8, 0], [0, 0], [], [13, 0, 1], [4, 0, 0]],
    [[random.Random(s).choice([0, 1, 2, 7, 20]) for _ in range(40)] for s in range(3)],
]


@pytest.mark.parametrize("files", CORPORA)
@pytest.mark.parametrize("tail", ["flush", "drop"])
@pytest.mark.parametrize("numbering", ["corpus", "file2500", "file_dense"])
def test_shards_follow_the_buffer(spark, files, tail, numbering):
    size = 4
    shards, metas, marks = simulate(files, size, tail, numbering != "corpus")
    if numbering == "corpus":
        number = {(f, k): k + 1 for f, k, _ in shards}
    elif numbering == "file2500":
        number = {(f, k): f * 2500 + 1 + k for f, k, _ in shards}
    else:
        number = {(f, k): i + 1 for i, (f, k, _) in enumerate(sorted(shards))}
    located = locate(corpus(spark, files), size, numbering, tail, bucket_rows=3)
    got = {}
    for r in shard_sentences(located).orderBy("shard", "pos").collect():
        got.setdefault(r["shard"], []).append((r["pos"], r["file_no"], r["row"], r["sent_idx"]))
        assert r["sentence"] == f"s{r['file_no']}.{r['row']}.{r['sent_idx']}"
    assert got == {number[f, k]: [(p, *s) for p, s in enumerate(rows)] for f, k, rows in shards}
    listed = {}
    for r in shard_meta(located).orderBy("shard", "ord").collect():
        listed.setdefault(r["shard"], []).append(r["id"])
        assert r["meta"]["url"] == "u" + r["id"]
    # A document longer than a shard is listed in every shard it fills.
    assert listed == {number[f, k]: [f"{a}-{b}" for a, b in docs] for f, k, docs in metas}
    assert {r["shard"]: r["row"] for r in shard_watermarks(located).collect()} == {number[f, k]: m for f, k, m in marks}


def test_pieces_of_a_corpus_continue(spark):
    files = [[3, 0, 9], [2, 6]]
    whole = {tuple(r) for r in assign_shards(corpus(spark, files), 4).drop("file_no").collect()}
    first = locate(corpus(spark, files).where("file_no = 0"), 4)
    second = locate(corpus(spark, files).where("file_no = 1"), 4, earlier=(12, 3))
    parts = shard_sentences(first).unionByName(shard_sentences(second)).drop("file_no")
    assert {tuple(r) for r in parts.collect()} == whole
    assert [r[0] for r in second.orderBy("ord").select("ord").collect()] == [3, 4]


def test_too_many_shards_for_a_file(spark):
    docs = corpus(spark, [[2501]])
    with pytest.raises(Exception, match="only 2500 numbers"):
        locate(docs, 1, "file2500")
    assert assign_shards(docs, 1, "file_dense").agg(F.max("shard")).first()[0] == 2501


def test_corpus_without_sentences(spark):
    located = locate(corpus(spark, [[0, 0, 0]]), 4)
    assert shard_sentences(located).count() == 0
    assert shard_meta(located).count() == 0


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        locate(corpus(spark, [[1]]), numbering="other")
    with pytest.raises(ValueError):
        locate(corpus(spark, [[1]]), tail="keep")


def test_resume(spark):
    docs = corpus(spark, [[1] * 5])
    assert skip_done(docs, 3).count() == 2
    assert skip_done(docs, 3, compat=True).count() == 3
    assert skip_done(docs, 0, compat=True).count() == 5



def test_reserved_numbers_suffice_at_any_size(spark, folder, monkeypatch):
    from sentloom.functions import names
    from sentloom.operators import shards
    from sentloom.plans import fixtures
    from sentloom.plans.queries import QUERIES

    for module in (names, shards, fixtures):
        monkeypatch.setattr(module, "SHARDS_PER_FILE", 3, raising=False)
    text = " ".join(f"Sentence number {i} is here." for i in range(400))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"))
    docs.write.parquet(f"{folder}/documents.parquet")
    rows = QUERIES["w2_file_numbering"](spark, folder)
    assert rows.count() == rows.select("shard", "pos").distinct().count() == 16_000
    assert QUERIES["w6_watermarks"](spark, folder).count() == 16
    assert QUERIES["w9_plan_work"](spark, folder).select("shard").distinct().count() > 0
