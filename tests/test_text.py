import unicodedata

import pytest
from pyspark.sql import functions as F

from sentloom.functions import text as tx

CASES = [
    ("a. b", ["a.", "b"]),
    ("in 2020. The", ["in 2020. the"]),
    ("v1.2.3 ok", ["v1.2.3 ok"]),
    ("wait... what", ["wait.", ".", ".", "what"]),
    ("...", [".", ".", "."]),
    ("1. item\n\n- two\n* three", ["item", "two", "three"]),
    ("  3.  4. b\n", ["4. b"]),
    ("- - a. b", ["a.", "b"]),
    ("@#x$%^&", ["x$%"]),
    ("tail.\n", ["tail."]),
    ("", []),
    ("   ", []),
    ("٣.٤ x. y", ["٣.٤ x.", "y"]),
    ("a b. c", ["a b.", "c"]),
    ("\x1cabc\x1c. d", ["abc\x1c.", "d"]),
    ("x​. y", ["x​.", "y"]),
    ("• bul  x.\n\n\ny?!z|w", ["bul  x.", "y?", "!", "z", "w"]),
    ("İSTANBUL. ΣΑΣ. ﬁ ① x　y.\u0085z", ["i̇stanbul.", "σας.", "fi 1 x y.", "z"]),
    ("नमस्ते। ठीक॥ اردو۔ کیا؟", ["नमस्ते।", "ठीक॥", "اردو۔", "کیا؟"]),
    (None, None),
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_sentences_of_edge_texts(spark):
    df = frame(spark, [t for t, _ in CASES])
    assert values(df, tx.sentence_array("text")) == [expected for _, expected in CASES]


def test_pieces_concatenate_to_the_text(spark):
    texts = [t for t, _ in CASES if t is not None]
    df = frame(spark, texts)
    joined = values(df, F.concat_ws("", tx.split_pieces(tx.normalize_text("text"))))
    assert joined == values(df, tx.normalize_text("text"))


def test_composition_equals_the_standard(spark):
    texts = ["ﬁ①", "é", "Ａ", "½", "가", "क़", "が", "が", "plain", "ÀÿĀſ", "İ", "…", "中文。"]
    texts += [chr(p) for p in range(0x20, 0x3100)]
    df = frame(spark, texts)
    assert values(df, tx.compose_text("text")) == [unicodedata.normalize("NFKC", t) for t in texts]


def test_long_text_without_delimiter(spark):
    df = frame(spark, ["x" * 300_000, "1." * 100_000 + "1", "=" * 200_000 + "x", "a@" * 50_000])
    assert values(df, F.size(tx.sentence_array("text"))) == [1, 1, 1, 1]
    masked = df.withColumn("text", F.lower("text"))
    back = tx.unmask_entities(tx.mask_entities("text"), tx.entity_map("text"))
    assert values(masked, back == F.col("text")) == [True] * 4


def test_unknown_method_is_an_error():
    with pytest.raises(ValueError):
        tx.sentence_array("text", "nltk")


def test_entities_round_trip(spark):
    texts = [
        "call 12 or 12.5 or 1", "mail a.b@c.org now", "see https://x.y/z?q=1 or www.a.b", "", "literal <ID1> and 7",
        "1 11 111 1", "no entity",
    ]
    df = frame(spark, texts)
    assert values(df, tx.unmask_entities(tx.mask_entities("text"), tx.entity_map("text"))) == texts
    assert values(df, tx.mask_entities("text"))[:3] == ["call <ID1> or <ID2> or <ID3>", "mail <ID1> now", "see <ID1> or <ID2>"]
    assert values(df, tx.entity_map("text"))[5] == {"<ID1>": "1", "<ID2>": "11", "<ID3>": "111", "<ID4>": "1"}


def test_unknown_placeholder_stays(spark):
    df = frame(spark, ["<ID1> <ID9>"])
    assert values(df, tx.unmask_entities("text", F.create_map(F.lit("<ID1>"), F.lit("5")))) == ["5 <ID9>"]


def test_language_tags(spark):
    df = frame(spark, ["a b", "", "c"])
    tagged = df.withColumn("text", tx.tag_language("text", "eng_Latn", "hin_Deva"))
    assert values(tagged, "text")[0] == "eng_Latn hin_Deva a b"
    assert values(tagged, tx.untag_language("text", "eng_Latn", "hin_Deva")) == ["a b", "", "c"]
    assert values(df, tx.untag_language("text", "eng_Latn", "hin_Deva")) == ["a b", "", "c"]


def test_entities_have_no_longest_length(spark):
    from sentloom.operators.tokens import mask_entities, unmask_entities

    address, number = "a" * 200 + "@" + "b" * 100 + ".c" * 20, ",".join(["12"] * 60)
    texts = [f"see {address} now", f"sum {number}.", "1,2abc@x.yz", "a" * 1_000_000, "1" * 1_000_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, sentence string")
    masked = mask_entities(df)
    got = {r["i"]: r["sentence"] for r in masked.collect()}
    assert [got[i] for i in (0, 1, 2, 4)] == ["see <ID1> now", "sum <ID1>.", "<ID1><ID2>", "<ID1>"] and got[3] == texts[3]
    assert {r["i"]: r["sentence"] for r in unmask_entities(masked).collect()} == dict(enumerate(texts))
