"""Registered queries, one or more per operator, over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.constants import MAX_PAD, MAX_TOKENS, UNK_ID, VOCAB_SIZE
from sentloom.functions import arrays as ar
from sentloom.functions import names as nm
from sentloom.functions import text as tx
from sentloom.operators import batches as ba
from sentloom.operators import callables as ca
from sentloom.operators import checks as ck
from sentloom.operators import regroup as rg
from sentloom.operators import sentences as se
from sentloom.operators import shards as sh
from sentloom.operators import tokens as tk
from sentloom.operators import translate as tr
from sentloom.operators import vocab as vo
from sentloom.operators.lookup import replace_elements
from sentloom.operators.rows import zip_shortest
from sentloom.plans import jobs, work
from sentloom.plans.fixtures import (
    BATCH_SIZE, DEVICES, FILES, NODES, SHARD_SIZE, SMALL_PAD, TOKENIZE_BATCH, arrive, corpus, fixtures, lexicon_of,
    load_faltering, load_measuring, load_refusing, load_reversing, load_spelling,
)
from sentloom.session import new_path, stage
from sentloom.sources import corpus as co
from sentloom.sources import payloads as pl
from sentloom.sources import shards as rd
from sentloom.sources.schemas import TOKENIZED
from sentloom.sources.sinks import committed_shards, publish_rows, retire_inputs, write_payloads, write_rows
from sentloom.streaming.drain import drain, drain_payloads, drained
from sentloom.streaming.prepare import file_progress, filled_sentences, filled_tokens, prepare_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SRC_LANG, TGT_LANG = "eng_Latn", "hin_Deva"
MANY_FILES = 64


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def joined(ids: str) -> Column:
    """Ids of an array as one string."""
    return F.array_join(F.transform(ids, lambda i: i.cast("string")), " ").alias(ids)


def lines(texts: str) -> Column:
    return F.array_join(texts, "\n").alias(texts)


def flat_meta(meta: str = "meta") -> list[Column]:
    return [F.col(f"{meta}.{field}").alias(field) for field in ("dump", "url", "file_path")]


# Scans


@query
def s1_scan_corpus(spark, sf_dir):
    root = fixtures(spark, sf_dir).corpus_root
    return co.read_corpus(spark, f"{root}/data/whole/*").select("id", "text", "dump", "url", "file_path")


@query
def s1_many_files(spark, sf_dir):
    """A subset of many small files, numbered by the sorted names."""
    root = new_path(spark, "files")
    docs = corpus(spark, sf_dir, MANY_FILES).withColumn("part", nm.zero_padded("file_no"))
    placed = docs.drop("file_no").repartition("part").sortWithinPartitions("part", "row")
    placed.drop("row").write.partitionBy("part").parquet(root)
    return co.read_corpus(spark, root).select("file_no", "row", "id", "text")


@query
def s2_numbered_files(spark, sf_dir):
    """Read from numbered files; the name is made from the number again."""
    docs = co.read_corpus_files(spark, fixtures(spark, sf_dir).corpus_root, "whole", FILES)
    return docs.select("row", "id", nm.file_name("file_no", FILES).alias("name"), F.col("file_no").alias("parsed"))


@query
def s3_read_tokens(spark, sf_dir):
    rows = tk.flatten_tokens(rd.read_tokens(spark, fixtures(spark, sf_dir).tokenized_root, node=1))
    return rows.select(
        "shard", "pos", "id", joined("input_ids"), joined("attention_mask"),
        F.element_at("entities", F.col("id")).alias("entity"),
    )


@query
def s4_list_shards(spark, sf_dir):
    return rd.list_shards(spark, fixtures(spark, sf_dir).tokenized_root)


@query
def s5_shard_range(spark, sf_dir):
    outputs = rd.read_outputs(spark, fixtures(spark, sf_dir).translated_root, 3, 1_000_000)
    return pl.flatten_outputs(outputs).select("shard", "pos", "id", joined("output_ids"))


@query
def s5_shard_range_sparse(spark, sf_dir):
    """From the second shard to the last, whose numbers have gaps and exceed the number of shards."""
    root = new_path(spark, "sparse")
    sparse = fixtures(spark, sf_dir).translated.withColumn("shard", F.col("shard") * 2500 + 1)
    write_payloads(pl.nest_outputs(sparse), root, "translated", NODES)
    return pl.flatten_outputs(rd.read_outputs(spark, root, 5000)).select("shard", "pos", "id", joined("output_ids"))


@query
def s7_read_documents(spark, sf_dir):
    merged = rd.read_documents(spark, fixtures(spark, sf_dir).merged_root, 1, 2)
    rows = pl.document_rows(merged)
    return rows.select("uuid", lines("text"), *flat_meta("meta_data"))


@query
def s6_progress(spark, sf_dir):
    """Counts that the last micro-batch of a streamed prepare has recorded."""
    counts = ("row", "sentences", "shard")
    return rd.progress(spark, fixtures(spark, sf_dir).streamed_root).agg(*[F.max(c).alias(c) for c in counts])


@query
def s6_progress_per_file(spark, sf_dir):
    """The log of the files that a streamed prepare has read."""
    log = file_progress(spark, fixtures(spark, sf_dir).streamed_root)
    return log.agg(F.countDistinct("file_path").alias("files"), *[F.sum(c).alias(c) for c in ("done_rows", "sentences")])


# Sinks, read back


@query
def k1_write_shards(spark, sf_dir):
    rows = spark.read.parquet(fixtures(spark, sf_dir).token_rows)
    return rows.groupBy(F.col("node").cast("long").alias("node"), "shard").agg(F.count("*").alias("rows"))


@query
def k1_write_payloads(spark, sf_dir):
    payloads = rd.read_tokens(spark, fixtures(spark, sf_dir).tokenized_root)
    return payloads.select(
        "node", "shard", "row",
        F.size("ids").cast("long").alias("batches"),
        F.size("meta_data").cast("long").alias("listed"),
    )


@query
def k2_write_documents(spark, sf_dir):
    merged = rd.read_payloads(spark, fixtures(spark, sf_dir).merged_root, "output")
    return merged.select("node", "shard", "row", F.size("uuid").cast("long").alias("documents"))


@query
def k2_write_whole_documents(spark, sf_dir):
    """Documents that cross shards, written once as a whole and read back."""
    merged = rd.read_payloads(spark, fixtures(spark, sf_dir).whole_root, "output")
    rows = merged.select("node", "shard", F.posexplode(F.arrays_zip("text", "uuid", "meta_data")).alias("place", "d"))
    return rows.select("node", "shard", "place", F.col("d.uuid").alias("uuid"), F.array_join("d.text", "\n").alias("text"), *flat_meta("d.meta_data"))


@query
def k4_retire_inputs(spark, sf_dir):
    """Shards that remain after those with a finished output are deleted."""
    fx = fixtures(spark, sf_dir)
    root = new_path(spark, "retired")
    write_payloads(rd.read_tokens(spark, fx.tokenized_root).drop("node"), root, "tokenized", NODES)
    finished = fx.done_shards().withColumn("node", nm.node_of("shard", NODES))
    retire_inputs(spark, root, "tokenized", finished)
    return rd.list_shards(spark, root)


@query
def k4_retire_keeps_unresolved(spark, sf_dir):
    """Shards with rows that were set aside are not retired."""
    fx = fixtures(spark, sf_dir)
    root, done = new_path(spark, "retired"), new_path(spark, "done")
    write_payloads(rd.read_tokens(spark, fx.tokenized_root).drop("node"), root, "tokenized", NODES)
    write_rows(fx.uneven.drop("node"), done, NODES)
    retire_inputs(spark, root, "tokenized", committed_shards(spark, done))
    return rd.list_shards(spark, root)


@query
def k5_publish(spark, sf_dir):
    rows = jobs.published_rows(fixtures(spark, sf_dir).documents)
    path = publish_rows(rows, new_path(spark, "published"), "whole", datetime(2024, 1, 1))
    return spark.read.parquet(path).select("uuid", lines("text"), *flat_meta("meta_data"))


# Projections and filters


@query
def p1_metadata(spark, sf_dir):
    return corpus(spark, sf_dir).select(se.doc_meta()).select("meta.*")


@query
def p2_drop_empty(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    return docs.select(
        "id",
        F.size(tx.split_pieces(tx.normalize_text("text"))).cast("long").alias("pieces"),
        F.size(tx.sentence_array("text")).cast("long").alias("sentences"),
    )


@query
def p3_resume_skip(spark, sf_dir):
    docs = corpus(spark, sf_dir, FILES).select("file_no", "row", "id")
    exact = se.skip_done(docs, 20).withColumn("rule", F.lit("exact"))
    return exact.unionByName(se.skip_done(docs, 20, compat=True).withColumn("rule", F.lit("compat")))


@query
def p3_resume_per_file(spark, sf_dir):
    """A log with several rows per file, the newest counts; the last file has none."""
    docs = corpus(spark, sf_dir, FILES)
    counts = docs.groupBy("file_no").agg(F.count("*").alias("n")).where(F.col("file_no") < FILES - 1)
    done = F.when(F.col("batch_id") == 2, F.floor(F.col("n") / (F.col("file_no") + 2))).otherwise(F.lit(1)).cast("long")
    log = counts.select("file_no", "n", F.explode(F.array(F.lit(1), F.lit(2))).alias("batch_id")).withColumn("done_rows", done)
    return se.skip_done_files(docs, log).select("file_no", "row", "id")


@query
def p4_node_filter(spark, sf_dir):
    rows = spark.read.parquet(fixtures(spark, sf_dir).token_rows).where(F.col("node").between(1, 2))
    return rows.select(F.col("node").cast("long").alias("node"), "shard", "pos", "id")


@query
def p5_over_length(spark, sf_dir):
    batched = ba.assign_batches(fixtures(spark, sf_dir).tokens, TOKENIZE_BATCH)
    return ba.pad_batches(batched, SMALL_PAD).select("shard", "pos", "batch_id", "id", "status")


@query
def p6_ragged(spark, sf_dir):
    batched = ba.assign_batches(fixtures(spark, sf_dir).tokens, BATCH_SIZE)
    labelled = ba.pad_batches(batched, MAX_PAD, DEVICES)
    return labelled.select("shard", "pos", "batch_id", "id", "status")


@query
def p7_rows_in_all_lists(spark, sf_dir):
    """Published rows by the compatible rule, with the metadata of odd shards taken away."""
    merged = rd.read_payloads(spark, fixtures(spark, sf_dir).merged_root, "output")
    kept = F.when(F.col("shard") % 2 == 0, F.col("meta_data"))
    rows = pl.document_rows(merged.withColumn("meta_data", kept), compat=True)
    return rows.select("uuid", lines("text"), *flat_meta("meta_data"))


@query
def p8_skip_empty_outputs(spark, sf_dir):
    return ba.accepted(fixtures(spark, sf_dir).uneven).select("shard", "pos", "id")


# Joins


@query
def j1_meta_lookup(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    islands = rg.group_islands(rg.find_islands(fx.sentences)).drop("text")
    return rg.attach_meta(islands, fx.meta).select("shard", "island", "uuid", *flat_meta())


@query
def j1_last_meta_wins(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    later = fx.meta.withColumn("ord", F.col("ord") + 1_000_000).withColumn(
        "meta", F.col("meta").withField("dump", F.lit("later"))
    ).where("ord % 2 = 0")
    return rg.last_meta(fx.meta.unionByName(later)).select("shard", "id", *flat_meta())


@query
def j1_missing_meta(spark, sf_dir):
    """Labels as partial metadata: documents without a label keep a null."""
    fx = fixtures(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("string").alias("id"))
    partial = fx.meta.join(labels.distinct(), "id", "left_semi")
    islands = rg.group_islands(rg.find_islands(fx.sentences)).drop("text")
    return rg.attach_meta(islands, partial, strict=False).select("shard", "uuid", F.col("meta.url").alias("url"))


@query
def j1_crowded_shard(spark, sf_dir):
    """Every document of the corpus has later metadata in the first shard, most of them without sentences there."""
    fx = fixtures(spark, sf_dir)
    crowd = corpus(spark, sf_dir).select(
        F.lit(1).cast("long").alias("shard"), "id", (F.col("row") + 1_000_000).alias("ord"), se.doc_meta()
    )
    crowd = crowd.withColumn("meta", F.col("meta").withField("dump", F.lit("later")))
    islands = rg.group_islands(rg.find_islands(fx.sentences)).drop("text")
    listed = fx.meta.select(*crowd.columns).unionByName(crowd)
    return rg.attach_meta(islands, listed).select("shard", "island", "uuid", *flat_meta())


@query
def j2_pending_shards(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return work.pending(fx.sentences.select("shard").distinct(), fx.done_shards())


@query
def j3_new_shards(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    shards = rd.list_shards(spark, fx.tokenized_root)
    return work.newcomers(shards, shards.where("node in (0, 3)")).select("node", "shard")


@query
def j4_zip_shortest(spark, sf_dir):
    split = fixtures(spark, sf_dir).split
    arrays = split.select(
        "id",
        F.col("sentences").alias("text"),
        F.transform(F.slice("sentences", F.lit(2), F.size("sentences")), lambda s: F.length(s).cast("long")).alias("next_length"),
        F.transform(F.filter("sentences", lambda s: F.length(s) > 30), lambda s: F.concat(F.lit("> "), s)).alias("quoted"),
    )
    return zip_shortest(arrays, "text", "next_length", "quoted")


@query
def j5_token_ids(spark, sf_dir):
    """Looked up without any hot part and with the join that the largest tables take."""
    fx = fixtures(spark, sf_dir)
    words = fx.sentences.select("shard", "pos", tx.whitespace_tokens("sentence").alias("tokens"))
    ids = replace_elements(
        words, "tokens", "ids", fx.vocab, "token", "token_id", default=UNK_ID, ship=False, ship_found=False
    )
    return ids.select("shard", "pos", F.posexplode("ids").alias("place", "token_id")).select(
        "shard", "pos", F.col("place").cast("long").alias("place"), F.col("token_id").cast("long").alias("token_id")
    )


@query
def j6_lexicon_translation(spark, sf_dir):
    return fixtures(spark, sf_dir).uneven.select("shard", "pos", "status", joined("output_ids"))


@query
def j6_lexicon_by_join(spark, sf_dir):
    """The same translation with the shuffle join that large lexicons take."""
    fx = fixtures(spark, sf_dir)
    labelled = ba.pad_batches(ba.assign_batches(fx.tokens, BATCH_SIZE), None, DEVICES)
    return tr.translate_lexicon(labelled, fx.lexicon, ship=False).select(
        "shard", "pos", "status", joined("output_ids")
    )


# Aggregations


@query
def a1_regroup(spark, sf_dir):
    return rg.group_islands(rg.find_islands(fixtures(spark, sf_dir).sentences)).select(
        "shard", "island", "uuid", lines("text")
    )


@query
def a2_sentence_counts(spark, sf_dir):
    return se.sentence_counts(se.split_documents(corpus(spark, sf_dir)))


@query
def a3_batch_lengths(spark, sf_dir):
    return ba.batch_lengths(ba.assign_batches(fixtures(spark, sf_dir).tokens, BATCH_SIZE))


@query
def a4_shard_bounds(spark, sf_dir):
    return work.shard_bounds(fixtures(spark, sf_dir).sentences)


@query
def a5_vocabulary(spark, sf_dir):
    vocab = vo.build_vocab(se.sentences(corpus(spark, sf_dir)))
    return vocab.withColumn("token_id", F.col("token_id").cast("long"))


@query
def a5_vocabulary_top(spark, sf_dir):
    vocab = vo.build_vocab(se.sentences(corpus(spark, sf_dir)), max_size=1000)
    return vocab.withColumn("token_id", F.col("token_id").cast("long"))


@query
def a5_vocabulary_of_pages(spark, sf_dir):
    """Whitespace tokens that occur at least three times in the raw pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.lower("html").alias("html"))
    vocab = vo.build_vocab(pages, min_count=3, column="html")
    return vocab.withColumn("token_id", F.col("token_id").cast("long"))


@query
def a6_alignment_audit(spark, sf_dir):
    return ck.audit_alignment(fixtures(spark, sf_dir).tokens)


@query
def a7_run_report(spark, sf_dir):
    return ck.run_report(fixtures(spark, sf_dir).uneven)


@query
def a7_observed_run(spark, sf_dir):
    """Counts of the steps of a run, taken while they write."""
    fx, log = fixtures(spark, sf_dir), ck.RunLog(spark)
    batched = ba.assign_batches(fx.tokens, BATCH_SIZE)
    translated = tr.translate(batched, fx.lexicon, None, DEVICES)
    written = log.run("translate", translated, lambda df: stage(df, "observed"), BATCH_SIZE)
    decoded = tk.decode(ba.accepted(written), fx.vocab)
    log.run("decode", decoded, lambda df: stage(df, "observed"))
    return log.report().drop("started_at", "elapsed_s")


@query
def a8_total_shards(spark, sf_dir):
    shards = rd.list_shards(spark, fixtures(spark, sf_dir).tokenized_root)
    return shards.agg(F.count("*").alias("shards"))


# Ordered operators


@query
def w1_ordinals(spark, sf_dir):
    located = fixtures(spark, sf_dir).located()
    return located.select("id", "ord", "start", "n_sentences")


@query
def w2_shard_ids(spark, sf_dir):
    return sh.shard_sentences(fixtures(spark, sf_dir).located()).select("shard", "pos", "id", "sent_idx", "sentence")


@query
def w2_file_numbering(spark, sf_dir):
    return sh.shard_sentences(fixtures(spark, sf_dir).located("file2500")).select("shard", "pos", "id", "sent_idx")


@query
def w2_dense_file_numbering(spark, sf_dir):
    return sh.shard_sentences(fixtures(spark, sf_dir).located("file_dense")).select("shard", "pos", "id", "sent_idx")


@query
def w3_tail_dropped(spark, sf_dir):
    rows = sh.shard_sentences(fixtures(spark, sf_dir).located(tail="drop"))
    return rows.groupBy("shard").agg(F.count("*").alias("rows"))


@query
def w3_file_tails_dropped(spark, sf_dir):
    rows = sh.shard_sentences(fixtures(spark, sf_dir).located("file_dense", "drop"))
    return rows.groupBy("shard").agg(F.count("*").alias("rows"))


@query
def w4_islands(spark, sf_dir):
    """Runs of equal roles in conversations, and of documents in shards."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").alias("shard"), F.col("turn").alias("pos"), F.col("role").alias("id")
    )
    rows = fixtures(spark, sf_dir).sentences.select("shard", "pos", "id")
    both = turns.withColumn("source", F.lit("turns")).unionByName(
        rows.withColumn("shard", F.col("shard") + 1_000_000_000).withColumn("source", F.lit("shards"))
    )
    return rg.find_islands(both)


@query
def w5_batches(spark, sf_dir):
    return ba.assign_batches(fixtures(spark, sf_dir).sentences, TOKENIZE_BATCH).select("shard", "pos", "batch_id")


@query
def w6_watermarks(spark, sf_dir):
    return sh.shard_watermarks(fixtures(spark, sf_dir).located("file2500"))


@query
def w7_shard_meta(spark, sf_dir):
    return sh.shard_meta(fixtures(spark, sf_dir).located()).select("shard", "ord", "id", *flat_meta())


@query
def w8_frontier(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return work.frontier(fx.sentences.select("shard").distinct(), fx.done_shards())


@query
def w9_plan_work(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    shards = sh.shard_sentences(fx.located("file2500")).select("shard").distinct()
    return work.plan_work(shards, 3, fx.done_shards())


# Order and set operators


@query
def t1_numeric_order(spark, sf_dir):
    shards = rd.list_shards(spark, fixtures(spark, sf_dir).tokenized_root)
    name = F.concat(F.lit("a/"), F.col("node"), F.lit("/tokenized/"), F.col("shard"), F.lit(".json"))
    return shards.select(name.alias("path")).select(
        "path", nm.shard_of_path("path").alias("shard"), nm.node_of_path("path").alias("node")
    ).orderBy("shard")


@query
def t2_flatten(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return tk.flatten_tokens(rd.read_tokens(spark, fx.tokenized_root)).select("shard", "pos", "id")


@query
def t3_union_of_nodes(spark, sf_dir):
    merged = rd.read_documents(spark, fixtures(spark, sf_dir).merged_root, 0, NODES - 1)
    return pl.document_rows(merged).groupBy("uuid").agg(
        F.count("*").alias("parts"), F.sum(F.size("text")).alias("sentences")
    )


# Text functions


@query
def f1_normalize(spark, sf_dir):
    return corpus(spark, sf_dir).select("id", tx.normalize_text("text").alias("text"))


@query
def f1_normalize_wide(spark, sf_dir):
    """Texts whose letters are written in full width are the plain texts in lower case."""
    wide = F.translate("text", string.ascii_letters, "".join(chr(ord(c) + 0xFEE0) for c in string.ascii_letters))
    return corpus(spark, sf_dir).select("id", tx.normalize_text(wide).alias("text"))


@query
def f2_split_pieces(spark, sf_dir):
    pieces = tx.split_pieces(tx.normalize_text("text"))
    return corpus(spark, sf_dir).select("id", F.posexplode(pieces).alias("place", "piece")).withColumn(
        "place", F.col("place").cast("long")
    )


@query
def f3_strip_symbols(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", tx.strip_symbols("html").alias("html"))


@query
def f4_strip_whitespace(spark, sf_dir):
    return corpus(spark, sf_dir).select("id", F.explode(F.split("text", r"\.")).alias("text")).select(
        "id", tx.strip_whitespace("text").alias("text")
    )


@query
def f5_strip_bullet(spark, sf_dir):
    """Every line of the documents, also behind a bullet or a list number."""
    lined = corpus(spark, sf_dir).select("id", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    mark = F.element_at(
        F.array(*[F.lit(m) for m in ("", " • ", "○", "* ", "- ", "12. ", "3 ")]), (F.col("place") % 7 + 1).cast("int")
    )
    return lined.select("id", F.col("place").cast("long").alias("place"), tx.strip_bullet(F.concat(mark, "line")).alias("line"))


@query
def f6_clean_sentences(spark, sf_dir):
    return se.sentences(corpus(spark, sf_dir)).select("id", "sent_idx", "sentence")


@query
def f6_dedup_sentences(spark, sf_dir):
    return se.sentences(corpus(spark, sf_dir), dedup=True).select("id", "sent_idx", "sentence")


@query
def f6_conversation_sentences(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").alias("file_no"), F.col("turn").alias("row"), F.col("role").alias("id"), "text"
    )
    return se.sentences(turns).select("file_no", "row", "sent_idx", "sentence")


@query
def f7_method(spark, sf_dir):
    """Sentences of a method given by its name."""
    return se.sentences(corpus(spark, sf_dir), method="regex").select("id", "sent_idx", "sentence")


@query
def f8_shard_of_path(spark, sf_dir):
    tokens = fixtures(spark, sf_dir).tokens
    path = F.concat(F.lit("b/n/s/"), F.col("node"), F.lit("/tokenized/"), F.col("shard"), F.lit(".json"))
    return tokens.select("node", "shard").distinct().select(
        path.alias("path"), nm.shard_of_path(path).alias("shard"), nm.node_of_path(path).alias("node")
    )


@query
def f9_file_names(spark, sf_dir):
    docs = corpus(spark, sf_dir).select("row")
    return docs.select("row", nm.file_name("row", 99).alias("name"), nm.zero_padded("row", 3).alias("short"))


@query
def f11_language_tags(spark, sf_dir):
    rows = fixtures(spark, sf_dir).sentences.select("shard", "pos", "sentence")
    tagged = tk.tag_language(rows, SRC_LANG, TGT_LANG).withColumnRenamed("sentence", "tagged")
    return tagged.withColumn("bare", tx.untag_language("tagged", SRC_LANG, TGT_LANG))


@query
def f12_mask_entities(spark, sf_dir):
    rows = fixtures(spark, sf_dir).sentences.select("shard", "pos", "sentence")
    return tk.mask_entities(rows).select(
        "shard", "pos", "sentence",
        F.array_join(F.map_keys("entities"), " ").alias("placeholders"),
        F.array_join(F.map_values("entities"), " ").alias("entities"),
    )


@query
def f12_mask_pages(spark, sf_dir):
    """Addresses of the pages, masked and put back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", F.concat(F.lit("see "), "url", F.lit(" now")).alias("sentence")
    )
    masked = tk.mask_entities(pages).withColumnRenamed("sentence", "masked")
    return masked.select("page_id", "masked", tx.unmask_entities("masked", "entities").alias("sentence"))


@query
def f12_unmask_entities(spark, sf_dir):
    rows = fixtures(spark, sf_dir).sentences.select("shard", "pos", "sentence")
    return tk.unmask_entities(tk.mask_entities(rows)).select("shard", "pos", "sentence")


# Token arrays


@query
def f20_encode(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return tk.encode(fx.sentences, fx.vocab).select("shard", "pos", "id", joined("input_ids"))


@query
def f20_encode_by_join(spark, sf_dir):
    """The same encoding with the shuffle join that large vocabularies take."""
    fx = fixtures(spark, sf_dir)
    return tk.encode(fx.sentences, fx.vocab, ship=False).select("shard", "pos", "id", joined("input_ids"))


@query
def f20_encode_small_vocabulary(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return tk.encode(fx.sentences, vo.build_vocab(fx.sentences, max_size=500), max_length=10).select(
        "shard", "pos", joined("input_ids")
    )


@query
def f21_attention_mask(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return tk.encode(fx.sentences, fx.vocab).select("shard", "pos", joined("attention_mask"))


@query
def f22_left_pad(spark, sf_dir):
    padded = ba.pad_batches(ba.assign_batches(fixtures(spark, sf_dir).tokens, TOKENIZE_BATCH), MAX_PAD)
    return padded.select("shard", "pos", joined("input_ids"), joined("attention_mask"))


@query
def f25_shift_right(spark, sf_dir):
    labels = F.transform("input_ids", lambda i: F.when(i % 5 == 0, F.lit(-100)).otherwise(i))
    return fixtures(spark, sf_dir).tokens.select("shard", "pos", ar.shift_right(labels).alias("shifted")).select(
        "shard", "pos", joined("shifted")
    )


@query
def f26_position_ids(spark, sf_dir):
    padded = ba.pad_batches(ba.assign_batches(fixtures(spark, sf_dir).tokens, TOKENIZE_BATCH), MAX_PAD)
    return padded.select("shard", "pos", ar.position_ids("input_ids").alias("positions")).select(
        "shard", "pos", joined("positions")
    )


@query
def f26_position_ids_inner_pads(spark, sf_dir):
    holed = F.transform("input_ids", lambda i: F.when(i % 3 == 0, F.lit(1)).otherwise(i))
    return fixtures(spark, sf_dir).tokens.select("shard", "pos", ar.position_ids(holed, past=7).alias("positions")).select(
        "shard", "pos", joined("positions")
    )


@query
def f27_mask_positions(spark, sf_dir):
    padded = ba.pad_batches(ba.assign_batches(fixtures(spark, sf_dir).tokens, TOKENIZE_BATCH), MAX_PAD)
    return padded.select("shard", "pos", ar.mask_positions("attention_mask").alias("positions")).select(
        "shard", "pos", joined("positions")
    )


@query
def f28_row_positions(spark, sf_dir):
    return fixtures(spark, sf_dir).tokens.select("shard", "pos", ar.row_positions("input_ids").alias("positions")).select(
        "shard", "pos", joined("positions")
    )


@query
def f30_decode(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return tk.decode(ba.accepted(fx.translated), fx.vocab).select("shard", "pos", "id", "sentence")


@query
def f40_node_route(spark, sf_dir):
    shards = fixtures(spark, sf_dir).sentences.select("shard").distinct()
    return shards.select("shard", nm.node_of("shard", NODES).alias("node"))


@query
def f41_shard_base(spark, sf_dir):
    files = corpus(spark, sf_dir, FILES).select("file_no").distinct()
    return files.select("file_no", nm.shard_base("file_no").alias("first_shard"))


@query
def f42_json_round_trip(spark, sf_dir):
    payloads = rd.read_tokens(spark, fixtures(spark, sf_dir).tokenized_root).drop("node")
    text = F.to_json(F.struct(*payloads.columns))
    back = payloads.select(F.from_json(text, TOKENIZED).alias("payload")).select("payload.*")
    return tk.flatten_tokens(back).select("shard", "pos", "id", joined("input_ids"))


# Translators given as functions


@query
def u1_translate_batches(spark, sf_dir):
    batched = ba.assign_batches(fixtures(spark, sf_dir).tokens, BATCH_SIZE)
    return tr.translate(batched, load_reversing, None, DEVICES).select(
        "shard", "pos", "status", joined("output_ids")
    )


@query
def u2_failed_batches(spark, sf_dir):
    batched = ba.assign_batches(fixtures(spark, sf_dir).tokens, TOKENIZE_BATCH)
    return tr.translate(batched, load_faltering, None).select(
        "shard", "pos", "status", "error", joined("output_ids")
    )


# Tokenizers given as functions


@query
def u3_callable_tokenizer(spark, sf_dir):
    tokens = ca.CallableTokenizer(load_measuring).encode(fixtures(spark, sf_dir).sentences)
    return tokens.select("shard", "pos", "id", joined("input_ids"))


@query
def u2_failed_tokenizing(spark, sf_dir):
    """Only the sentences that are refused are set aside, not their batches."""
    return fixtures(spark, sf_dir).refused.select("shard", "pos", "token_status", "token_error", joined("input_ids"), "untokenized")


@query
def u2_retokenized(spark, sf_dir):
    """What was set aside is encoded again by another tokenizer, and nothing is lost."""
    refused = fixtures(spark, sf_dir).refused
    again = ca.CallableTokenizer(load_measuring).encode(ca.retokenizable(refused))
    kept = ["shard", "pos", "id", joined("input_ids")]
    return refused.where("token_status = 'ok'").select(*kept).unionByName(again.select(*kept))


@query
def u2_untokenized_documents(spark, sf_dir):
    """Every document on the way back, with the sentences that its tokenizer refused counted."""
    fx = fixtures(spark, sf_dir)
    tokenizer = ca.CallableTokenizer(load_refusing, load_spelling)
    translated = jobs.translate_shards(fx.refused, load_reversing, BATCH_SIZE, None)
    documents = jobs.regroup_shards(translated, fx.meta, tokenizer, SRC_LANG, TGT_LANG)
    return documents.select("uuid", "complete", "missing_sentences", F.size("text").alias("sentences"))


# Streams


@query
def x1_drain_payloads(spark, sf_dir):
    """Nested shards in JSON that arrive in two parts, each drained once."""
    fx = fixtures(spark, sf_dir)
    root, out, checkpoint = (new_path(spark, name) for name in ("inbox", "drained", "checkpoint"))
    lexicon = fx.lexicon
    for arrived in ("shard % 2 = 0", "shard % 2 = 1"):
        some = rd.read_tokens(spark, fx.tokenized_root).where(arrived).drop("node")
        write_payloads(some, root, "tokenized", NODES, mode="append")
        drain_payloads(spark, root, "tokenized", out, checkpoint, lambda batch: jobs.translate_shards(batch, lexicon, BATCH_SIZE, None))
    return drained(spark, out).select("shard", "pos", "status", joined("output_ids"))


@query
def x1_drain(spark, sf_dir):
    """Two runs of a drain, the second after more shards have arrived."""
    fx = fixtures(spark, sf_dir)
    source, out, checkpoint = (new_path(spark, name) for name in ("inbox", "drained", "checkpoint"))
    lexicon = fx.lexicon

    def job(batch: DataFrame) -> DataFrame:
        return jobs.translate_shards(batch, lexicon, BATCH_SIZE, None)

    for arrived in ("shard % 2 = 0", "shard % 2 = 1"):
        arrive(fx.tokens.where(arrived), source)
        drain(spark, source, out, checkpoint, job, fx.tokens.schema, max_files=2)
    return drained(spark, out).select("shard", "pos", "status", joined("output_ids"))


@query
def x5_prepare_stream(spark, sf_dir):
    """A corpus that arrives in files, cut into shards across micro-batches.

    Files are numbered as they arrive, so the whole is checked per document.
    """
    rows = filled_sentences(spark, fixtures(spark, sf_dir).streamed_root, finished=True)
    shards = rows.groupBy("shard").agg(F.count("*").alias("rows"), F.max("pos").alias("last"))
    full = shards.agg(
        F.count("*").alias("shards"), F.sum("rows").alias("sentences"),
        F.sum((F.col("rows") == F.col("last") + 1).cast("long")).alias("dense"),
    )
    return full


@query
def x5_streamed_sentences(spark, sf_dir):
    return filled_sentences(spark, fixtures(spark, sf_dir).streamed_root, finished=True).select("id", "sent_idx", "sentence")


@query
def x5_stream_tokens(spark, sf_dir):
    """Tokens of a streamed prepare, whatever the order in which the files arrived."""
    return filled_tokens(spark, fixtures(spark, sf_dir).streamed_tokens_root, finished=True).select("id", "sent_idx", joined("input_ids"))


class OnceLost:
    """A tokenizer whose job is lost at its second micro-batch, once."""

    def __init__(self, tokenizer: tk.Tokenizer):
        self.tokenizer, self.calls = tokenizer, 0

    def encode(self, sentences: DataFrame) -> DataFrame:
        self.calls += 1
        if self.calls == 2:
            raise OSError("lost")
        return self.tokenizer.encode(sentences)


@query
def x3_resume(spark, sf_dir):
    """A streamed prepare that fails between its writes and goes on from its checkpoint: nothing twice, nothing lost."""
    source, out, checkpoint = (new_path(spark, name) for name in ("corpus", "prepared", "checkpoint"))
    corpus(spark, sf_dir).drop("file_no", "row").coalesce(3).write.parquet(source)
    tokenizer = OnceLost(ca.CallableTokenizer(load_measuring))

    def run() -> None:
        prepare_stream(
            spark, source, out, checkpoint, SHARD_SIZE, max_files=1, tokenizer=tokenizer, languages=(SRC_LANG, TGT_LANG),
            batch_size=TOKENIZE_BATCH,
        )

    try:
        run()
    except StreamingQueryException as error:
        if "lost" not in str(error):
            raise
        run()
    return filled_tokens(spark, out, finished=True).select("id", "sent_idx", joined("input_ids"))


@query
def x4_clean_source(spark, sf_dir):
    """Consumed files are archived once a later micro-batch is committed: each row is in the inbox or in the archive."""
    fx = fixtures(spark, sf_dir)
    source, archive, out, checkpoint = (new_path(spark, name) for name in ("inbox", "archive", "drained", "checkpoint"))
    for arrived in ("shard % 2 = 0", "shard % 2 = 1"):
        arrive(fx.tokens.where(arrived), source)
        drain(spark, source, out, checkpoint, lambda batch: batch.select("shard", "pos"), fx.tokens.schema, max_files=1, clean="archive", archive=archive)
    reader = spark.read.schema(fx.tokens.schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    kept = reader.parquet(source, archive).groupBy("shard").agg(F.count("*").alias("kept"))
    done = drained(spark, out).groupBy("shard").agg(F.count("*").alias("drained"))
    return kept.join(done, "shard", "full")


# Jobs


def _prepared(spark: SparkSession, sf_dir: str, max_length: int | None = MAX_TOKENS, max_size: int | None = None) -> jobs.Prepared:
    return jobs.prepare(
        corpus(spark, sf_dir), SRC_LANG, TGT_LANG, SHARD_SIZE, TOKENIZE_BATCH, NODES, bucket_rows=128,
        max_length=max_length, max_size=max_size,
    )


@query
def c1_prepare(spark, sf_dir):
    tokens = _prepared(spark, sf_dir).tokens
    return tokens.select("shard", "node", "pos", "batch_id", "id", joined("input_ids"))


@query
def c1_prepare_bounded(spark, sf_dir):
    """The same with the default bound of the vocabulary."""
    tokens = _prepared(spark, sf_dir, max_size=VOCAB_SIZE).tokens
    return tokens.select("shard", "node", "pos", "batch_id", "id", joined("input_ids"))


@query
def c2_translate(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    lexicon = lexicon_of(prepared.tokenizer.vocab)
    return jobs.translate_shards(prepared.tokens, lexicon, BATCH_SIZE, MAX_PAD, DEVICES).select(
        "shard", "pos", "batch_id", "status", joined("output_ids")
    )


@query
def c3_regroup(spark, sf_dir):
    """All the way back to whole documents through a lexicon that knows nothing."""
    return _returned(spark, sf_dir, 1).select("uuid", lines("text"), *flat_meta())


def _returned(spark: SparkSession, sf_dir: str, devices: int) -> DataFrame:
    prepared = _prepared(spark, sf_dir, max_length=None)
    tokens = stage(prepared.tokens, "tokens")
    silent = lexicon_of(prepared.tokenizer.vocab).where("src_id < 0")
    translated = jobs.translate_shards(tokens, silent, BATCH_SIZE, None, devices)
    return jobs.regroup_shards(translated, prepared.meta, prepared.tokenizer, SRC_LANG, TGT_LANG)


@query
def c3_regroup_incomplete(spark, sf_dir):
    """Every document, with the sentences that were set aside counted."""
    return _returned(spark, sf_dir, DEVICES).select("uuid", "complete", "missing_sentences", F.size("text").alias("sentences"))


@query
def u2_quarantine_replayed(spark, sf_dir):
    """Rows that were set aside are translated later, and nothing is lost."""
    fx = fixtures(spark, sf_dir)
    again = jobs.translate_shards(tr.replayable(fx.uneven), fx.lexicon, BATCH_SIZE, None)
    kept = ["shard", "pos", "id", joined("output_ids")]
    return ba.accepted(fx.uneven).select(*kept).unionByName(ba.accepted(again).select(*kept))


@query
def c3_regroup_shard_scope(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx.documents.select("shard", "island", "uuid", lines("text"), *flat_meta())


@query
def c4_publish(spark, sf_dir):
    root = fixtures(spark, sf_dir).merged_root
    path = jobs.publish(spark, root, 0, 1, new_path(spark, "published"), "part", datetime(2024, 1, 1))
    return spark.read.parquet(path).select("uuid", lines("text"), *flat_meta("meta_data"))


@query
def c4_publish_and_retire(spark, sf_dir):
    """Documents of the published nodes, and those in the files that are left."""
    root, dest = new_path(spark, "merged"), new_path(spark, "published")
    write_payloads(rd.read_payloads(spark, fixtures(spark, sf_dir).merged_root, "output").drop("node"), root, "output", NODES)
    path = jobs.publish_and_retire(spark, root, 0, 1, dest, "part", datetime(2024, 1, 1))
    left = pl.document_rows(rd.read_documents(spark, root, 0, NODES))
    return spark.read.parquet(path).select("uuid", F.lit("published").alias("state")).unionByName(
        left.select("uuid", F.lit("kept").alias("state"))
    )
