import json
import time
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sentloom.functions import names as nm
from sentloom.operators.rows import zip_longest, zip_shortest
from sentloom.plans import jobs, work
from sentloom.plans.fixtures import arrive
from sentloom.session import shared_dir, stage
from sentloom.sources import corpus as co
from sentloom.sources import payloads as pl
from sentloom.sources import shards as rd
from sentloom.sources import sinks
from sentloom.sources.schemas import MERGED, TOKENIZED
from sentloom.operators.tokens import flatten_tokens
from sentloom.streaming.drain import drain, drained
from sentloom.streaming.prepare import filled_sentences, prepare_stream

META = {"id": "a", "dump": "d", "url": "u", "file_path": "p"}


def corpus_files(folder, counts, total=None, subset="s"):
    """Numbered Parquet files; document ``f-r`` holds ``counts[f][r]`` sentences."""
    data = Path(folder) / "data" / subset
    data.mkdir(parents=True, exist_ok=True)
    for f, docs in enumerate(counts):
        if not docs:
            continue
        rows = [
            {"id": f"{f}-{r}", "text": "".join(f"w{k}x. " for k in range(n)), "dump": "d", "url": "u", "file_path": "p", "more": 1}
            for r, n in enumerate(docs)
        ]
        pq.write_table(pa.Table.from_pylist(rows), data / f"train-{f:05d}-of-{total or len(counts):05d}.parquet")
    return str(data)


def plain_shard(folder, node, kind, shard, payload):
    path = Path(folder) / str(node) / kind
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{shard}.json").write_text(json.dumps(payload))


def merged(ids, with_meta=True):
    return {
        "text": [[f"{i}.1", f"{i}.2"] for i in ids], "uuid": ids, "row": 1, "shard": 1,
        "meta_data": [{**META, "id": i} for i in ids] if with_meta else [],
    }


def test_numbered_files(spark, folder):
    corpus_files(folder, [[1, 2], [3], [1, 1, 1]])
    docs = co.read_corpus_files(spark, folder, "s", 3)
    assert {(r["file_no"], r["row"], r["id"]) for r in docs.collect()} == {
        (0, 0, "0-0"), (0, 1, "0-1"), (1, 0, "1-0"), (2, 0, "2-0"), (2, 1, "2-1"), (2, 2, "2-2")
    }
    assert co.read_corpus_files(spark, folder, "s", 3, start=2).count() == 3
    assert "more" not in docs.columns


def test_subset_gets_file_numbers(spark, folder):
    path = corpus_files(folder, [[1, 2], [3]])
    rows = co.read_corpus(spark, path).collect()
    assert {(r["file_no"], r["row"], r["id"]) for r in rows} == {(0, 0, "0-0"), (0, 1, "0-1"), (1, 0, "1-0")}


@pytest.mark.parametrize("bound", [0, 1000])
def test_subset_of_many_files_beyond_the_bound(spark, folder, bound, monkeypatch):
    monkeypatch.setattr(co, "BROADCAST_FILES", bound)
    path = corpus_files(folder, [[1]] * 12 + [[2, 1]])
    rows = co.read_corpus(spark, path)
    assert {(r["file_no"], r["row"], r["id"]) for r in rows.collect()} == {
        *((n, 0, f"{n}-0") for n in range(13)), (12, 1, "12-1")
    }
    assert ("BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()) or bound == 0


def test_names(spark):
    paths = ["b/s/3/tokenized/10.json", "b/tokenized/node=3/shard=9/part-00000-x.json", "b/s/3/output/9.json", "b/x.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [tuple(r) for r in df.select(nm.node_of_path("p"), nm.shard_of_path("p")).collect()] == [(3, 10), (3, 9), (3, 9), (None, None)]
    assert spark.range(1).select(nm.zero_padded(F.lit(123456))).first()[0] == "123456"
    assert spark.range(1).select(nm.file_name(F.lit(7), 99)).first()[0] == "train-00007-of-00099.parquet"
    assert nm.dataset_name("s", datetime(2024, 5, 6, 7, 8, 9)) == "s_row_wise_20240506_070809"


def test_plain_layout(spark, folder):
    inputs = [{"batch": {"input_ids": [[1, 5], [6, 7]], "attention_mask": [[0, 1], [1, 1]]}, "placeholder_entity_maps": [{}, {"<ID1>": "9"}]}]
    for shard in (9, 10, 2):
        payload = {"tokenized_inputs": inputs, "ids": [["a", "a"]], "row": 1, "shard": shard, "meta_data": [META]}
        plain_shard(folder, shard % 2, "tokenized", shard, payload)
    assert [r["shard"] for r in rd.list_shards(spark, folder, layout="plain").collect()] == [2, 9, 10]
    assert [r["shard"] for r in rd.list_shards(spark, folder, node=0, layout="plain").collect()] == [2, 10]
    assert rd.list_shards(spark, folder, node=7, layout="plain").count() == 0
    rows = flatten_tokens(rd.read_tokens(spark, folder, node=1, layout="plain")).orderBy("pos").collect()
    assert [(r["shard"], r["id"], r["input_ids"], r["entities"]) for r in rows] == [(9, "a", [1, 5], {}), (9, "a", [6, 7], {"<ID1>": "9"})]
    assert rd.read_tokens(spark, folder, node=5, layout="plain").count() == 0
    with pytest.raises(ValueError):
        rd.read_tokens(spark, folder, layout="flat")


def test_publish_and_node_ranges(spark, folder):
    plain_shard(folder, 0, "output", 4, merged(["a", "b"]))
    plain_shard(folder, 2, "output", 6, merged(["c"], with_meta=False))
    documents = rd.read_documents(spark, folder, 0, 5, layout="plain", ordered=True)
    assert [r["shard"] for r in documents.collect()] == [1, 1]
    rows = pl.document_rows(documents)
    assert {(r["uuid"], r["meta_data"]["id"] if r["meta_data"] else None) for r in rows.collect()} == {("a", "a"), ("b", "b"), ("c", None)}
    assert {r["uuid"] for r in pl.document_rows(documents, compat=True).collect()} == {"a", "b"}
    path = jobs.publish(spark, folder, 0, 2, folder + "/out", "s", datetime(2024, 1, 1), layout="plain")
    assert path.endswith("s_row_wise_20240101_000000") and spark.read.parquet(path).count() == 3
    assert jobs.publish(spark, folder, 1, 1, folder + "/out", "s", layout="plain") is None


def test_nested_round_trip_and_empty_documents(spark, folder):
    corpus_files(folder, [[3, 0, 0, 0, 0, 2]])
    prepared = jobs.prepare(co.read_corpus_files(spark, folder, "s", 1), "xx", "yy", shard_size=4, batch_size=2, total_nodes=2)
    tokens = stage(prepared.tokens, "tokens")
    nested = pl.nest_tokens(tokens, prepared.meta, prepared.watermarks, part_size=2)
    sinks.write_payloads(nested, folder, "tokenized", 2)
    back = rd.read_tokens(spark, folder)
    # The four empty documents do not fit one part, so shard 1 comes in several rows.
    assert back.where("shard = 1").count() > 1
    flat = flatten_tokens(back)
    key = lambda r: (r["shard"], r["pos"], r["id"], tuple(r["input_ids"]))
    assert sorted(map(key, flat.collect())) == sorted(map(key, tokens.collect()))
    listed = sorted((r["shard"], r["id"]) for r in pl.flatten_meta(back).collect())
    assert listed == [(1, f"0-{k}") for k in range(6)] + [(2, "0-5")]
    assert {(r["shard"], r["row"]) for r in back.collect()} == {(1, 6), (2, 6)}


def test_committed_inputs_retire(spark, folder):
    rows = spark.range(40).select((F.col("id") % 4 + 1).alias("shard"), F.col("id").alias("x"))
    sinks.write_payloads(rows, folder, "tokenized", 2)
    sinks.write_rows(rows.where("shard <= 2"), folder + "/done", 2)
    committed = sinks.committed_shards(spark, folder + "/done")
    assert sinks.retire_inputs(spark, folder, "tokenized", committed) == 2
    assert [r["shard"] for r in rd.list_shards(spark, folder).collect()] == [3, 4]


def test_zips(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], ["a", "b", "c"], [True, False]), (2, [1], [], None), (3, [4], ["z"], [True])], "k int, a array<int>, b array<string>, c array<boolean>")
    assert sorted((r["k"], r["a"], r["b"], r["c"]) for r in zip_shortest(df, "a", "b", "c").collect()) == [(1, 1, "a", True), (1, 2, "b", False), (3, 4, "z", True)]
    assert zip_longest(df, "a", "b", "c").count() == 5


def test_planning(spark):
    shards = spark.createDataFrame([(3,), (5,), (9000,)], "shard long")
    done = spark.createDataFrame([(3,), (4,), (3,)], "shard long")
    plan = work.plan_work(shards, 3, done).collect()
    assert {r["shard"] for r in plan} == set(range(5, 9001)) and all((r["shard"] - 3) % 3 == r["worker"] for r in plan)
    assert work.plan_work(shards.where("false"), 3).count() == 0
    assert work.frontier(shards, done).first()["shard"] == 5
    assert work.frontier(shards, shards).first()["shard"] == 9001
    assert {r["shard"] for r in work.pending(shards, done).collect()} == {5, 9000}


def test_shared_folder_comes_from_the_session(spark):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: "hdfs://shared/folder/" if key == "spark.checkpoint.dir" else default)

    assert shared_dir(Session) == "hdfs://shared/folder"
    assert shared_dir(spark) == shared_dir(spark)
    assert stage(spark.range(3), "x").inputFiles()[0].split("/x-")[0].endswith(shared_dir(spark))


def test_drain_sees_newcomers_once(spark, folder):
    source, out, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "checkpoint"))
    seen = []

    def job(batch):
        seen.append(sorted({r["shard"] for r in batch.collect()}))
        return batch.groupBy("shard").agg(F.count("*").alias("n"))

    rows = spark.range(12).select((F.col("id") % 3).alias("shard"))
    schema = rows.schema
    for shard in (0, 1):
        rows.where(f"shard = {shard}").coalesce(1).write.mode("append").parquet(source)
    drain(spark, source, out, checkpoint, job, schema)
    rows.where("shard = 2").coalesce(1).write.mode("append").parquet(source)
    drain(spark, source, out, checkpoint, job, schema)
    drain(spark, source, out, checkpoint, job, schema)
    assert seen == [[0, 1], [2]]
    assert sorted((r["shard"], r["n"]) for r in drained(spark, out).collect()) == [(0, 4), (1, 4), (2, 4)]


def test_an_inbox_has_no_more_files_for_more_rows(spark, folder):
    """Files of whole shards, as many as tasks run at once, however many partitions a shuffle has."""
    name = "spark.sql.shuffle.partitions"
    rows = spark.range(6000).select((F.col("id") % 300).alias("shard"), "id")
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        arrive(rows, f"{folder}/in")
    finally:
        spark.conf.set(name, before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    got = spark.read.parquet(f"{folder}/in").withColumn("file", F.input_file_name())
    assert got.count() == 6000 and got.select("id").distinct().count() == 6000
    assert got.select("file").distinct().count() <= spark.sparkContext.defaultParallelism
    assert got.groupBy("shard").agg(F.countDistinct("file").alias("files")).where("files > 1").isEmpty()


def test_streamed_shards_span_batches(spark, folder):
    source = corpus_files(folder, [[3, 0], [2, 9]])
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
    prepare_stream(spark, source, out, checkpoint, shard_size=4, max_files=1)
    assert filled_sentences(spark, out).count() == 12
    corpus_files(folder, [[], [], [1, 5]])
    prepare_stream(spark, source, out, checkpoint, shard_size=4, max_files=1)
    rows = filled_sentences(spark, out, finished=True)
    per_shard = {r["shard"]: (r["n"], r["top"]) for r in rows.groupBy("shard").agg(F.count("*").alias("n"), F.max("pos").alias("top")).collect()}
    assert per_shard == {k: (4, 3) for k in range(1, 6)}
    assert rows.select("shard", "pos").distinct().count() == 20
    progress = rd.progress(spark, out).orderBy("batch_id").collect()
    assert progress[-1]["sentences"] == 20 and progress[-1]["shard"] == 6 and progress[-1]["row"] == 6
    listed = spark.read.parquet(f"{out}/meta").select("ord").distinct().count()
    assert listed == 6
    assert rd.progress(spark, folder + "/nowhere").count() == 0


def test_drain_can_delete_what_it_has_read(spark, folder):
    source, out, checkpoint = (f"{folder}/{n}" for n in ("in", "out", "checkpoint"))
    rows = spark.range(6).select((F.col("id") % 3).alias("shard"))

    def files():
        return {p.name for p in Path(source).glob("*.parquet")}

    rows.where("shard = 0").coalesce(1).write.parquet(source)
    first = files()
    drain(spark, source, out, checkpoint, lambda b: b, rows.schema, clean="delete")
    rows.where("shard = 1").coalesce(1).write.mode("append").parquet(source)
    drain(spark, source, out, checkpoint, lambda b: b, rows.schema, clean="delete")
    # The cleaner works behind the stream, so the files of the last run may still be there.
    deadline = time.time() + 20
    while first & files() and time.time() < deadline:
        time.sleep(0.5)
    assert not first & files()
    assert drained(spark, out).count() == 4


def test_a_new_checkpoint_over_old_output_is_refused(spark, folder):
    from sentloom.streaming.prepare import prepare_stream

    rows = [("a", "One. Two.", "d", "u", "f")]
    spark.createDataFrame(rows, "id string, text string, dump string, url string, file_path string").write.parquet(f"{folder}/in")
    prepare_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", 10)
    prepare_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", 10)
    with pytest.raises(ValueError, match="another checkpoint"):
        prepare_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/other", 10)


def test_unresolved_shards_are_not_committed(spark, folder):
    rows = [(1, 1, "ok", [5]), (1, 1, "failed", [6]), (1, 2, "ok", None), (1, 3, "failed", None)]
    spark.createDataFrame(rows, "node int, shard long, status string, input_ids array<int>").write.parquet(f"{folder}/done")
    assert [r["shard"] for r in sinks.committed_shards(spark, f"{folder}/done").collect()] == [2]
    assert sorted(r["shard"] for r in sinks.committed_shards(spark, f"{folder}/done", kept=True).collect()) == [1, 2]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from sentloom.session import shared_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master)))


def merged_copy(spark, folder, layout):
    """Merged shards 1 to 6 on nodes 0 to 2 with a document each."""
    if layout == "plain":
        for shard in range(1, 7):
            plain_shard(folder, shard % 3, "output", shard, {**merged([f"d{shard}"]), "shard": shard})
    else:
        rows = [([[f"d{s}"]], [f"d{s}"], 1, s, [(f"d{s}", "d", "u", "f")]) for s in range(1, 7)]
        sinks.write_payloads(spark.createDataFrame(rows, MERGED), folder, "output", 3)


def left(spark, folder, layout):
    return sorted(r["shard"] for r in rd.list_shards(spark, folder, kind="output", layout=layout).collect())


@pytest.mark.parametrize("layout", ["hive", "plain"])
def test_publish_and_retire(spark, folder, layout):
    root, dest = f"{folder}/in", f"{folder}/out"
    merged_copy(spark, root, layout)
    path = jobs.publish_and_retire(spark, root, 0, 1, dest, "s", datetime(2024, 1, 1), layout=layout)
    assert sorted(r["uuid"] for r in spark.read.parquet(path).collect()) == ["d1", "d3", "d4", "d6"]
    assert left(spark, root, layout) == [2, 5]
    # What is finished stays as it is, also where a shard of the same name has come in since.
    merged_copy(spark, f"{folder}/again", layout)
    assert jobs.resume_publish(spark, dest, "s_row_wise_20240101_000000") == path
    assert spark.read.parquet(path).count() == 4 and left(spark, root, layout) == [2, 5]
    assert jobs.publish_and_retire(spark, root, 0, 1, dest, "empty", datetime(2024, 1, 1), layout=layout) is None


@pytest.mark.parametrize("layout", ["hive", "plain"])
@pytest.mark.parametrize("step", ["document_rows", "delete_files"])
def test_publish_and_retire_after_a_crash(spark, folder, layout, step, monkeypatch):
    """Lost before the dataset is written, and after it, before anything is deleted."""
    root, dest, name = f"{folder}/in", f"{folder}/out", "s_row_wise_20240101_000000"
    merged_copy(spark, root, layout)

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(jobs, step, crash)
        with pytest.raises(OSError, match="lost"):
            jobs.publish_and_retire(spark, root, 0, 1, dest, "s", datetime(2024, 1, 1), layout=layout)
    assert left(spark, root, layout) == [1, 2, 3, 4, 5, 6]
    # A shard that arrives meanwhile is neither published nor deleted.
    if layout == "plain":
        plain_shard(root, 0, "output", 9, {**merged(["d9"]), "shard": 9})
    else:
        sinks.write_payloads(spark.createDataFrame([([["d9"]], ["d9"], 1, 9, [])], MERGED), root, "output", 3, mode="append")
    path = jobs.resume_publish(spark, dest, name)
    assert sorted(r["uuid"] for r in spark.read.parquet(path).collect()) == ["d1", "d3", "d4", "d6"]
    assert left(spark, root, layout) == [2, 5, 9]
    assert jobs.resume_publish(spark, dest, "unknown") is None


def test_half_written_micro_batches_are_not_seen(spark, folder, monkeypatch):
    """A job that fails between its writes, replayed from its checkpoint."""
    from sentloom.streaming import prepare as streaming

    source = corpus_files(folder, [[3], [2, 9]])
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(streaming, "shard_meta", crash)
        with pytest.raises(Exception, match="lost"):
            prepare_stream(spark, source, out, checkpoint, shard_size=4, max_files=1)
    assert spark.read.parquet(f"{out}/sentences").count() == 3
    assert filled_sentences(spark, out, finished=True).count() == 0 and streaming.file_progress(spark, out).count() == 0
    prepare_stream(spark, source, out, checkpoint, shard_size=4, max_files=1)
    rows = filled_sentences(spark, out, finished=True)
    assert rows.count() == 14 and rows.select("shard", "pos").distinct().count() == 14
    log = streaming.file_progress(spark, out).orderBy("file_no").collect()
    assert [(r["file_no"], r["done_rows"], r["sentences"]) for r in log] == [(0, 1, 3), (1, 2, 11)]


def test_resume_per_file(spark):
    from sentloom.operators.sentences import skip_done_files

    docs = spark.createDataFrame([(f, r) for f in range(4) for r in range(5)], "file_no long, row long")
    log = spark.createDataFrame([(0, 2, 1), (0, 5, 2), (1, 3, 2), (1, 1, 1), (2, 2, 1)], "file_no long, done_rows long, batch_id long")
    rest = {(r["file_no"], r["row"]) for r in skip_done_files(docs, log).collect()}
    assert rest == {(1, 3), (1, 4), (2, 2), (2, 3), (2, 4), *((3, r) for r in range(5))}
    # The first file that is not finished does its last row again.
    assert {(r["file_no"], r["row"]) for r in skip_done_files(docs, log, compat=True).collect()} == rest | {(1, 2)}
    assert skip_done_files(docs, log.where("false")).count() == 20


def test_entry_leaves_out_operators_whose_library_is_absent():
    import subprocess
    import sys

    code = (
        "import sys, warnings; sys.modules['ahocorasick'] = None\n"
        "with warnings.catch_warnings(record=True) as said:\n"
        "    warnings.simplefilter('always')\n"
        "    import __spark_entry__ as e\n"
        "print(len(e.queries()) >= 97, not any(q.startswith('op') for q in e.queries()), len(said) <= 1)"
    )
    root = Path(__file__).parent.parent
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=False)
    assert run.stdout.split()[-3:] == ["True"] * 3, run.stderr


def test_payloads_and_staged_tables_are_compressed(spark, folder):
    """Padded ids and masks are long and alike; a shard is one small file whose name still tells its number."""
    ids = [[1] * 200 + [7, 8, 9]] * 64
    inputs = [{"batch": {"input_ids": ids, "attention_mask": ids}, "placeholder_entity_maps": [{"a": "b"}] * 64}]
    rows = spark.createDataFrame([{"tokenized_inputs": inputs, "ids": [["a"] * 64], "row": 3, "shard": 5, "meta_data": []}], TOKENIZED)
    sinks.write_payloads(rows, folder, "tokenized", 2)
    (file,) = Path(folder).glob("tokenized/node=1/shard=5/part-*")
    assert file.name.endswith(".json.gz") and file.stat().st_size < 5_000
    (read,) = rd.read_tokens(spark, folder).collect()
    assert read["shard"] == 5 and [list(i) for i in read["tokenized_inputs"][0]["batch"]["input_ids"]] == ids
    assert [tuple(r) for r in rd.list_shards(spark, folder).collect()] == [(1, 5)]
    assert all(".zstd." in f.name for f in Path(stage(rows, "t", f"{folder}/t").inputFiles()[0].removeprefix("file:")).parent.glob("part-*"))
