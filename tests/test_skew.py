"""A third of everything in one place: results stay whole."""

import re

from pyspark.sql import functions as F

from sentloom.operators.lookup import replace_elements
from sentloom.operators.tokens import VocabTokenizer
from sentloom.operators.vocab import build_vocab
from sentloom.operators.regroup import attach_meta
from sentloom.operators.rows import ranked
from sentloom.plans import jobs
from sentloom.session import stage


def hot_corpus(spark):
    """3,000 documents: one file and one id hold a third, copies and empty texts abound, one text is huge."""
    number = F.col("id")
    hot = number % 3 == 0
    text = (
        F.when(number == 1, F.repeat(F.lit("long text here. "), 5000))
        .when(number % 5 == 0, "")
        .when(hot, "the same copy. of a text 12.")
        .otherwise(F.concat(F.lit("word"), number, F.lit(" and more. tail "), number % 7))
    )
    return spark.range(3000).select(
        F.when(hot, 0).otherwise(number % 10 + 1).cast("long").alias("file_no"),
        number.alias("row"),
        F.when(hot, "hot").otherwise(number.cast("string")).alias("id"),
        text.alias("text"),
        F.lit("d").alias("dump"),
        F.concat(F.lit("u"), number).alias("url"),
        F.lit("p").alias("file_path"),
    )


def expected(row):
    n = row["row"]
    if n == 1:
        return ["long text here."] * 5000
    if n % 5 == 0:
        return None
    if n % 3 == 0:
        return ["the same copy.", "of a text 12."]
    return [f"word{n} and more.", f"tail {n % 7}"]


def test_documents_come_back_whole(spark):
    docs = hot_corpus(spark)
    prepared = jobs.prepare(docs, "xx", "yy", shard_size=500, batch_size=64, total_nodes=3, bucket_rows=64)
    tokens = stage(prepared.tokens, "tokens")
    assert tokens.groupBy("shard").count().agg(F.max("count")).first()[0] == 500
    nothing = prepared.tokenizer.vocab.where("false").select(
        F.col("token_id").alias("src_id"), F.col("token_id").alias("tgt_id")
    )
    translated = stage(jobs.translate_shards(tokens, nothing, batch_size=128), "translated")
    assert translated.where("status <> 'ok'").count() == 0
    documents = jobs.regroup_shards(translated, prepared.meta, prepared.tokenizer, "xx", "yy")
    got = {(r["file_no"], r["row"]): r["text"] for r in documents.collect()}
    want = {(r["file_no"], r["row"]): expected(r) for r in docs.select("file_no", "row").collect()}
    assert got == {k: v for k, v in want.items() if v is not None}


def test_lookup_of_a_hot_unknown_key(spark):
    rows = spark.range(6000).select(
        F.lit(1).cast("long").alias("shard"),
        F.col("id").alias("pos"),
        F.array(F.lit("everywhere"), F.concat(F.lit("t"), F.col("id") % 50)).alias("words"),
    )
    table = spark.range(40).select(F.concat(F.lit("t"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    for ship in (True, False):
        out = replace_elements(rows, "words", "ids", table, "k", "v", default=-1, hot=F.col("v") < 10, ship=ship)
        assert out.count() == 6000
        wrong = out.where(
            (F.col("ids")[0] != -1)
            | (F.col("ids")[1] != F.when(F.col("pos") % 50 < 40, F.col("pos") % 50).otherwise(-1))
        )
        assert wrong.count() == 0


def test_tokenizer_is_interchangeable(spark):
    sentences = spark.createDataFrame([(1, 0, "a", "x y x")], "shard long, pos long, id string, sentence string")
    tokenizer = VocabTokenizer.fit(sentences)
    encoded = tokenizer.encode(sentences).withColumnRenamed("input_ids", "output_ids")
    assert tokenizer.decode(encoded).first()["sentence"] == "x y x"
    assert build_vocab(sentences, max_size=1).first()["token"] == "x"


def test_crowded_shard_is_spread(spark):
    """All metadata in one shard, a third of it for one id."""
    listed = spark.range(30_000).select(
        F.greatest(F.lit(1), F.col("id") - 40_000).alias("shard"),  # 1, which the plan cannot know
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").alias("ord"),
        F.struct(F.col("id").alias("n")).alias("meta"),
    )
    documents = spark.createDataFrame([(1, 0, "hot"), (1, 1, "1"), (2, 0, "9"), (1, 2, "hot")], "shard long, island long, uuid string")
    found = attach_meta(documents, listed)
    assert {(r["shard"], r["island"], r["meta"] and r["meta"]["n"]) for r in found.collect()} == {
        (1, 0, 29_997), (1, 1, 1), (1, 2, 29_997), (2, 0, None)
    }
    # No exchange by the shard alone but that of its flag; the metadata are dealt by shard and id.
    dealt = re.findall(r"hashpartitioning\(([^)]*), \d+\)", found._jdf.queryExecution().executedPlan().toString())
    keys = [re.sub(r"#\d+L?", "", k) for k in dealt]
    assert "shard, uuid" in keys and "shard, id" in keys
    assert keys.count("shard") <= 2
    missing = documents.unionByName(spark.createDataFrame([(1, 3, "gone")], documents.schema))
    assert attach_meta(missing, listed, strict=False).where("meta is null").count() == 2
    try:
        attach_meta(missing, listed).collect()
    except Exception as error:  # raised in a task
        assert "no metadata for document gone in shard 1" in str(error)
    else:
        raise AssertionError("a document without metadata passed")


def test_ranks_over_all_tasks(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("value"))
    got = ranked(rows.repartition(7), "value", "rank").collect()
    assert sorted((r["value"], r["rank"]) for r in got) == [(n, n) for n in range(5000)]
    assert ranked(rows.where("false"), "value", "rank").count() == 0


def test_run_log_counts_while_the_job_runs(spark, folder):
    from sentloom.operators.checks import RunLog

    log = RunLog(spark)
    rows = spark.range(10).select(
        "id", F.col("id").alias("pos"), F.when(F.col("id") < 4, "ok").when(F.col("id") < 8, "ragged").alias("status")
    )
    assert log.run("write", rows, lambda df: df.write.parquet(f"{folder}/out"), 4) is None
    try:
        log.run("lost", rows, lambda df: df.select(F.raise_error(F.lit("gone"))).collect())
    except Exception as error:
        assert "gone" in str(error)
    log.run("nothing", rows.where("false"), lambda df: df.collect(), 4)
    first, lost, nothing = log.report().collect()
    assert tuple(first)[:7] == ("write", 10, 4, 6, 3, 1, None) and first["elapsed_s"] > 0 and first["error"] is None
    assert lost["rows"] is None and "gone" in lost["error"] and lost["elapsed_s"] > 0
    assert tuple(nothing)[:6] == ("nothing", 0, 0, 0, 0, 0)
    assert spark.read.parquet(f"{folder}/out").count() == 10


def test_large_lookup_ships_no_table_of_unknown_size(spark):
    rows = spark.range(10_000).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.transform(F.sequence(F.lit(0), F.col("id") % 5), lambda i: F.concat(F.lit("w"), (F.col("id") * 13 + i) % 3000))).alias("words"),
    )
    table = spark.range(2500).select(F.concat(F.lit("w"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    ways = []
    for ship, ship_found in ((True, None), (False, True), (False, False)):
        out = replace_elements(
            rows, "words", "ids", table, "k", "v", default=-1, hot=F.col("v") < 10, ship=ship, ship_found=ship_found, keep_source=False
        )
        assert out.columns == ["id", "ids"]
        ways.append(sorted((r["id"], r["ids"]) for r in out.collect()))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) == 10_000
    assert ways[0][1] == (1, [13, 14]) and ways[0][7] == (7, None) and -1 in ways[0][199][1] + ways[0][198][1]


def test_one_streamed_file_is_split_by_many_tasks(spark, folder, monkeypatch):
    from sentloom.streaming import prepare

    docs = spark.range(400).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("One is here. Two is "), "id", F.lit(" there.")).alias("text"),
        *[F.lit(c).alias(c) for c in ("dump", "url", "file_path")],
    )
    docs.coalesce(1).write.parquet(f"{folder}/in")
    tasks, stage = [], prepare.stage

    def counted(df, name, path=None):
        staged = stage(df.withColumn("task", F.spark_partition_id()), name, path)
        tasks.append(staged.select("task").distinct().count())
        return staged.drop("task")

    monkeypatch.setattr(prepare, "stage", counted)
    prepare.prepare_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", shard_size=100)
    assert tasks == [32]
    assert prepare.filled_sentences(spark, f"{folder}/out", finished=True).count() == 800
    assert [tuple(r)[1:] for r in prepare.file_progress(spark, f"{folder}/out").select("batch_id", "file_no", "done_rows", "sentences").collect()] == [(0, 400, 800)]


def test_rows_that_miss_something_move_with_the_missing_elements_alone(spark, monkeypatch):
    """Their places are the nulls of the values; an element that is null itself stays so."""
    from sentloom.operators import lookup

    staged = {}

    def kept(df, name, path=None):
        staged[name] = stage(df, name, path)
        return staged[name]

    monkeypatch.setattr(lookup, "stage", kept)
    table = spark.createDataFrame([(f"w{i}", i) for i in range(20)], "k string, v int")
    words = [["w1", None, "w15", "none", "w15"], None, [], [None], ["w2"], ["w19", "w3"]]
    rows = spark.createDataFrame(list(enumerate(words)), "pos int, words array<string>").coalesce(1)
    want = [[1, None, 15, -1, 15], None, [], [None], [2], [19, 3]]
    for ship_found in (None, True, False):
        out = replace_elements(rows, "words", "ids", table, "k", "v", default=-1, hot=F.col("v") < 10, ship=False, ship_found=ship_found)
        assert [r["ids"] for r in out.orderBy("pos").collect()] == want
    misses = [r[lookup.MISSES] for r in staged["lookup"].orderBy("pos").collect()]
    assert misses == [[None, "w15", "none", "w15"], [], [], [None], [], ["w19"]]


def test_the_entries_found_are_counted_only_where_an_estimate_is_near_the_bound(spark, monkeypatch):
    from sentloom.operators import lookup

    counted = []
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *args: counted.append(1) or True)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 100)
    found = spark.range(1000).select(F.col("id").alias("chunk"), F.col("id").cast("string").alias("key"), F.col("id").alias("value"))
    assert not lookup._few(found) and not counted
    assert lookup._few(found.where("chunk < 50")) and counted == [1]
