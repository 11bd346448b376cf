"""Time the jobs over the documents table; prints one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sentloom.operators.batches import assign_batches
from sentloom.operators.sentences import sentences as sentences_of
from sentloom.operators.sentences import split_documents
from sentloom.operators.shards import assign_shards
from sentloom.operators.tokens import VocabTokenizer, encode
from sentloom.operators.translate import translate
from sentloom.operators.vocab import build_vocab
from sentloom.plans import jobs, work
from sentloom.plans.fixtures import corpus, lexicon_of, load_reversing
from sentloom.session import build_session, new_path, stage
from sentloom.sources.payloads import nest_documents
from sentloom.sources.sinks import write_payloads, write_rows
from sentloom.streaming.drain import drain

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SHARD_SIZE = 10_000
NODES = 4
SRC, TGT = "eng_Latn", "hin_Deva"


def session() -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{CPUS}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Compute every row and column."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    # Start the JVM code paths and the Python workers before the clock runs.
    run(sentences_of(corpus(spark, SF_DIR)))
    times: dict[str, float] = {}

    def timed(name: str, work_unit: Callable[[], object]) -> object:
        begin = time.perf_counter()
        result = work_unit()
        times[name] = round(time.perf_counter() - begin, 3)
        return result

    timed("split_sentences", lambda: run(sentences_of(corpus(spark, SF_DIR))))
    split = timed("stage_split", lambda: stage(split_documents(corpus(spark, SF_DIR)), "split"))
    timed("assign_shards", lambda: run(assign_shards(split, SHARD_SIZE)))
    sentences = stage(assign_shards(split, SHARD_SIZE), "sentences")
    vocab = timed("build_vocab", lambda: stage(build_vocab(sentences), "vocab"))
    timed("encode", lambda: run(VocabTokenizer(vocab).encode(sentences)))
    # The plan of vocabularies beyond the bound.
    timed("encode_by_join", lambda: run(encode(sentences, vocab, ship=False)))

    def prepare() -> tuple[jobs.Prepared, DataFrame]:
        prepared = jobs.prepare(corpus(spark, SF_DIR), SRC, TGT, SHARD_SIZE, total_nodes=NODES)
        return prepared, stage(prepared.tokens, "tokens")

    prepared, tokens = timed("prepare", prepare)
    lexicon = stage(lexicon_of(prepared.tokenizer.vocab), "lexicon")
    translated = timed(
        "translate_lexicon", lambda: stage(jobs.translate_shards(tokens, lexicon, devices=8), "translated")
    )
    timed("translate_function", lambda: run(translate(assign_batches(tokens), load_reversing, devices=8)))
    for scope in ("corpus", "shard"):
        documents = timed(
            f"regroup_{scope}",
            lambda scope=scope: stage(
                jobs.regroup_shards(translated, prepared.meta, prepared.tokenizer, SRC, TGT, scope), "documents"
            ),
        )
    root = new_path(spark, "bench")
    timed("write_documents", lambda: write_payloads(nest_documents(documents, prepared.watermarks), root, "output", NODES))
    timed("publish", lambda: jobs.publish(spark, root, 0, NODES - 1, f"{root}/published", "bench"))
    timed(
        "plan_work",
        lambda: run(work.plan_work(tokens.select("shard").distinct(), 16, documents.where("shard % 3 = 0").select("shard").distinct())),
    )

    def drain_all() -> None:
        inbox = f"{root}/inbox"
        write_rows(tokens.drop("node"), inbox, NODES)
        schema = tokens.drop("node").schema.add("node", tokens.schema["node"].dataType)
        drain(
            spark, inbox, f"{root}/drained", f"{root}/checkpoint",
            lambda batch: jobs.translate_shards(batch, lexicon, devices=8), schema,
        )

    timed("drain", drain_all)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
