from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentloom.functions import arrays as ar
from sentloom.operators import tokens as tk
from sentloom.operators.lookup import replace_elements
from sentloom.operators.vocab import build_vocab

TEXTS = ["a b a c", "b a", "zz　a  b", "d", "c\tc", "x " * 300 + "y"]


@pytest.fixture(scope="module")
def sentences(spark):
    return spark.createDataFrame([(1 + i % 2, i, str(i), t) for i, t in enumerate(TEXTS)], "shard long, pos long, id string, sentence string")


def ranked(texts, min_count=1):
    counts = Counter(t for text in texts for t in text.split())
    return sorted(((-n, t) for t, n in counts.items() if n >= min_count))


def test_vocabulary_ranks(spark, sentences):
    for options in ({}, {"min_count": 2}, {"max_size": 3}):
        got = [(r["token_id"], r["token"], r["n"]) for r in build_vocab(sentences, **options).orderBy("token_id").collect()]
        want = ranked(TEXTS, options.get("min_count", 1))[: options.get("max_size")]
        assert got == [(4 + i, t, -n) for i, (n, t) in enumerate(want)]


def test_large_vocabulary_ranks_over_partitions(spark):
    rows = spark.range(20_000).select(F.concat_ws(" ", F.lit("hot"), F.concat(F.lit("t"), F.col("id") % 7000)).alias("sentence"))
    vocab = build_vocab(rows)
    top = vocab.orderBy("token_id").collect()
    assert [r["token_id"] for r in top] == list(range(4, 7005))
    assert [(r["n"], r["token"]) for r in top] == sorted(((r["n"], r["token"]) for r in top), key=lambda p: (-p[0], p[1]))


def test_both_lookups_encode_alike(spark, sentences):
    vocab = build_vocab(sentences, max_size=4)
    lookup = {r["token"]: r["token_id"] for r in vocab.collect()}
    for ship in (True, False):
        rows = tk.encode(sentences, vocab, ship=ship).orderBy("pos").collect()
        for r, text in zip(rows, TEXTS, strict=True):
            want = [lookup.get(t, 3) for t in text.split()][:256]
            assert r["input_ids"] == want and r["attention_mask"] == [1] * len(want) and r["id"] == str(r["pos"])


def test_lookup_keeps_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, 1, [5, 6]), (1, 2, []), (1, 3, None), (1, 4, [None, 5])], "shard long, pos long, ids array<int>")
    table = spark.createDataFrame([(5, 50), (7, 70)], "k int, v int")
    for ship, hot in ((True, None), (False, None), (False, F.col("k") < 6)):
        out = replace_elements(df, "ids", "out", table, "k", "v", hot=hot, ship=ship).orderBy("pos").collect()
        assert [r["out"] for r in out] == [[50, 6], [], None, [None, 50]]
        assert [r["ids"] for r in out] == [[5, 6], [], None, [None, 5]]


def test_decode_reverses_encode(spark, sentences):
    vocab = build_vocab(sentences)
    ids = tk.encode(sentences, vocab).withColumn("output_ids", F.concat(F.array(F.lit(2), F.lit(1)), "input_ids", F.array(F.lit(2))))
    for ship in (True, False):
        rows = tk.decode(ids, vocab, ship=ship).orderBy("pos").collect()
        assert [r["sentence"] for r in rows] == [" ".join(t.split()[:256]) for t in TEXTS]


def arrays(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<int>")


def column(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_token_arrays(spark):
    df = arrays(spark, [[5, 6, 2], [5, -100, 6], [], [1, 1, 5, 6, 2], [5, 1, 6]])
    assert column(df, ar.shift_right("a")) == [[2, 5, 6], [2, 5, 1], [], [2, 1, 1, 5, 6], [2, 5, 1]]
    assert column(df, ar.position_ids("a"))[3:] == [[1, 1, 2, 3, 4], [2, 1, 3]]
    assert column(df, ar.position_ids("a", past=2))[3:] == [[1, 1, 4, 5, 6], [4, 1, 5]]
    assert column(df, ar.row_positions("a"))[3] == [0, 1, 2, 3, 4]
    assert column(df, ar.strip_special("a"))[3] == [5, 6]
    masks = arrays(spark, [[1, 1, 1], [0, 0, 1, 1], [1, 0, 1], []])
    assert column(masks, ar.mask_positions("a")) == [[0, 1, 2], [-1, -1, 0, 1], [0, 0, 1], []]
    assert column(masks, ar.left_pad("a", 5, 9))[0] == [9, 9, 1, 1, 1]
    with pytest.raises(ValueError):
        ar.shift_right("a", pad=None)


def test_misaligned_payload_is_an_error(spark):
    from sentloom.sources.schemas import TOKENIZED

    bad = [([([[5]], [[1]])], ["x", "y"])]
    rows = spark.createDataFrame(
        [([((a, b), [{"k": "v"}]) for a, b in inputs], [ids], 1, 7, []) for inputs, ids in bad], TOKENIZED
    )
    with pytest.raises(Exception, match="misaligned arrays in shard 7"):
        tk.flatten_tokens(rows).collect()


def test_lookups_agree_on_rows_without_keys(spark):
    df = spark.createDataFrame([([5, 6, 9],), ([5, 6, 9],), ([],), (None,), ([None, 7],)], "ids array<int>")
    table = spark.createDataFrame([(5, 50), (7, 70), (9, 90)], "k int, v int")
    for default in (None, -1):
        ways = []
        for ship, ship_found in ((True, None), (False, True), (False, False)):
            out = replace_elements(df, "ids", "out", table, "k", "v", default=default, hot=F.col("k") < 6, ship=ship, ship_found=ship_found)
            assert out.columns == ["ids", "out"]
            ways.append(sorted((str(r["ids"]), str(r["out"])) for r in out.collect()))
        assert ways[0] == ways[1] == ways[2] and len(ways[0]) == 5


def test_top_of_a_vocabulary_merges_in_no_task(spark, sentences):
    from sentloom.operators.vocab import token_counts

    assert token_counts(sentences).count() > 3
    plan = build_vocab(sentences, max_size=3)
    assert "TakeOrdered" not in plan._jdf.queryExecution().toString() and plan.count() == 3
