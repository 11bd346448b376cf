"""The room and the work that shard files take."""

import gzip
import json
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sentloom.operators import lookup
from sentloom.plans.fixtures import fixtures
from sentloom.session import new_path, scratch, shared_dir, stage
from sentloom.sources import shards as rd
from sentloom.sources import sinks
from sentloom.sources.schemas import MERGED


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    staged = stage(spark.range(1000).repartition(3, "id").groupBy(F.col("id") % 7).count(), "counts")
    until = time.time() + 20
    while time.time() < until and shuffle_files(spark) - before:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert staged.count() == 7


def test_scratch_tables_go_and_the_result_stays(spark):
    with scratch(spark):
        inner = stage(spark.range(5), "inner")
        made = Path(inner.inputFiles()[0].removeprefix("file://")).parent
        assert made.exists()
        kept = stage(inner.where("id > 1"), "kept", new_path(spark, "kept", lasting=True))
    assert not made.exists() and kept.count() == 3


def documents(spark, folder):
    rows = [(k, f"Word{k} one. Two word{k % 3}! Three words here.", "en", "web") for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")


def test_tables_of_a_lookup_do_not_stay_beside_its_result(spark, folder, monkeypatch):
    documents(spark, folder)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 3)
    before = set(Path(shared_dir(spark)).iterdir())
    fx = fixtures(spark, folder)
    assert fx.decoded.count() == 90
    new = {p.name.rsplit("-", 1)[0] for p in set(Path(shared_dir(spark)).iterdir()) - before}
    assert new == {"split", "sentences", "vocab", "tokens", "lexicon", "translated", "decoded"}
    # The sentences on the way back carry no second copy of themselves.
    assert set(fx.decoded.columns) == {"shard", "pos", "file_no", "row", "id", "sent_idx", "sentence"}
    assert sorted(map(tuple, fx.documents.select("uuid", F.size("text")).collect())) == sorted((str(k), 3) for k in range(30))


SHARDS = [([["ä\n", "b"]], ["d1"], 4, 1, []), ([["c"]], ["d2"], None, 2, [("d2", "x", None, "z")]), ([], [], 7, None, []), ([["e"]], ["d3"], 5, 1, [])]


def test_shard_files_as_the_writer_of_spark_writes_them(spark, folder):
    rows = spark.createDataFrame(SHARDS, MERGED).coalesce(1)
    sinks.write_payloads(rows, folder, "output", 2)
    rows.withColumn("node", F.pmod("shard", F.lit(2))).write.partitionBy("node", "shard").json(f"{folder}/spark/output")
    ours, theirs = ({tuple(map(str, r)) for r in rd.read_payloads(spark, root, "output").collect()} for root in (folder, f"{folder}/spark"))
    assert ours == theirs and len(ours) == 4
    lines = {}
    for root, opened in ((f"{folder}/output", gzip.open), (f"{folder}/spark/output", open)):
        files = [p for p in Path(root).rglob("part-*")]
        lines[root] = {str(p.parent.relative_to(root)): sorted(opened(p, "rt").read().splitlines()) for p in files}
        assert len(files) == 3
    ours, theirs = lines.values()
    assert ours == theirs and sorted(json.loads(x)["row"] for x in ours["node=1/shard=1"]) == [4, 5]
    # No checksum and no temporary folder; each of them took a process or more.
    assert {p.name[:5] for p in Path(f"{folder}/output").rglob("*") if p.is_file() and "_SUCCESS" not in p.name} == {"part-"}
    assert not Path(f"{folder}/output/_temporary").exists()


def test_modes_of_the_shard_writer(spark, folder):
    one, two = (spark.createDataFrame([([["t"]], ["d"], 1, shard, [])], MERGED) for shard in (1, 2))
    sinks.write_payloads(one, folder, "output", 2)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.write_payloads(two, folder, "output", 2)
    sinks.write_payloads(two, folder, "output", 2, mode="ignore")
    assert [r["shard"] for r in rd.list_shards(spark, folder, kind="output").collect()] == [1]
    for _ in range(2):
        sinks.write_payloads(two, folder, "output", 2, mode="append")
    assert sorted(r["shard"] for r in rd.read_payloads(spark, folder, "output").collect()) == [1, 2, 2]
    sinks.write_payloads(two, folder, "output", 2, mode="overwrite")
    assert [r["shard"] for r in rd.read_payloads(spark, folder, "output").collect()] == [2]


def test_a_failed_write_of_shards_leaves_nothing_to_read(spark, folder):
    rows = spark.range(40, numPartitions=4).select(F.col("id").alias("shard"), F.expr("IF(id = 39, raise_error('lost'), 1L)").alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_payloads(rows, folder, "tokenized", 2)
    assert not [p for p in Path(folder).rglob("part-*")]


def test_folders_are_listed_many_to_a_task(spark, folder):
    sinks.write_payloads(spark.range(240).select(F.col("id").alias("shard"), F.lit(1).alias("row")), folder, "tokenized", 2)
    context = spark.sparkContext
    context.setJobGroup(folder, "listing")
    try:
        assert rd.read_tokens(spark, folder).select("shard").distinct().count() == 240
    finally:
        context._jsc.clearJobGroup()
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(folder) for s in tracker.getJobInfo(j).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages) <= max(32, 4 * context.defaultParallelism)


def test_tasks_retire_the_shards(spark, folder, monkeypatch):
    sinks.write_payloads(spark.range(30).select(F.col("id").alias("shard"), F.lit(1).alias("row")), folder, "tokenized", 3)
    committed = spark.range(5, 40).select(F.pmod("id", F.lit(3)).alias("node"), F.col("id").alias("shard"))
    odd = spark.createDataFrame([(None, 2), (1, None), (0, 1)], "node long, shard long")
    # A shard after the other through the driver takes milliseconds each.
    monkeypatch.setattr(type(committed), "toLocalIterator", None)
    assert sinks.retire_inputs(spark, folder, "tokenized", committed.unionByName(committed).unionByName(odd)) == 25
    assert [r["shard"] for r in rd.list_shards(spark, folder).collect()] == [0, 1, 2, 3, 4]
    assert sinks.retire_inputs(spark, folder, "tokenized", committed) == 0
    assert sinks.retire_inputs(spark, folder, "tokenized", committed.where("false")) == 0
