"""Sentences to token ids and back."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.constants import MAX_TOKENS, UNK_ID
from sentloom.functions import text as tx
from sentloom.functions.arrays import attention_mask, strip_special
from sentloom.operators.lookup import replace_elements
from sentloom.operators.vocab import build_vocab, hot_tokens

UNK_TOKEN = "<unk>"


def mask_entities(df: DataFrame) -> DataFrame:
    """Replace the entities of ``sentence`` by placeholders and keep them in ``entities``."""
    return df.withColumns({"entities": tx.entity_map("sentence"), "sentence": tx.mask_entities("sentence")})


def unmask_entities(df: DataFrame) -> DataFrame:
    return df.withColumn("sentence", tx.unmask_entities("sentence", "entities"))


def tag_language(df: DataFrame, src_lang: str, tgt_lang: str) -> DataFrame:
    return df.withColumn("sentence", tx.tag_language("sentence", src_lang, tgt_lang))


def untag_language(df: DataFrame, src_lang: str, tgt_lang: str) -> DataFrame:
    return df.withColumn("sentence", tx.untag_language("sentence", src_lang, tgt_lang))


def encode(df: DataFrame, vocab: DataFrame, max_length: int | None = MAX_TOKENS, ship: bool | None = None) -> DataFrame:
    """Replace ``sentence`` by ``input_ids`` and ``attention_mask``.

    Truncation comes before the lookup and sets ``truncated``; tokens the vocabulary lacks get the unknown id.
    """
    words = df.withColumn("tokens", tx.whitespace_tokens("sentence")).drop("sentence")
    if max_length is None:
        words = words.withColumn("truncated", F.lit(False))
    else:
        # Both are read off one array, as the split is dear.
        cut = F.struct(F.slice("tokens", 1, max_length).alias("tokens"), (F.size("tokens") > max_length).alias("truncated"))
        words = words.withColumn("cut", cut).drop("tokens").select("*", "cut.*").drop("cut")
    ids = replace_elements(
        words, "tokens", "input_ids", vocab, "token", "token_id", default=UNK_ID, hot=hot_tokens(), ship=ship,
        keep_source=False,
    )
    return ids.withColumn("attention_mask", attention_mask("input_ids"))


def decode(df: DataFrame, vocab: DataFrame, column: str = "output_ids", ship: bool | None = None) -> DataFrame:
    """Replace the ids in ``column`` by ``sentence``; special ids leave no trace."""
    ids = df.withColumn("kept", strip_special(column)).drop(column)
    words = replace_elements(
        ids, "kept", "words", vocab, "token_id", "token", default=UNK_TOKEN, hot=hot_tokens(), ship=ship,
        keep_source=False,
    )
    return words.withColumn("sentence", F.array_join("words", " ")).drop("words")


class Tokenizer(Protocol):
    """What the jobs need from a tokenizer: frames in, frames out."""

    def encode(self, df: DataFrame) -> DataFrame:
        """Replace ``sentence`` by ``input_ids`` and ``attention_mask``."""

    def decode(self, df: DataFrame) -> DataFrame:
        """Replace ``output_ids`` by ``sentence``."""


class VocabTokenizer:
    """Whitespace tokens numbered by a vocabulary table; targets may have their own."""

    def __init__(self, vocab: DataFrame, target_vocab: DataFrame | None = None, max_length: int | None = MAX_TOKENS):
        self.vocab = vocab
        self.target_vocab = vocab if target_vocab is None else target_vocab
        self.max_length = max_length

    @classmethod
    def fit(cls, sentences: DataFrame, max_length: int | None = MAX_TOKENS, **options: int | None) -> VocabTokenizer:
        return cls(build_vocab(sentences, **options), max_length=max_length)

    def encode(self, df: DataFrame) -> DataFrame:
        return encode(df, self.vocab, self.max_length)

    def decode(self, df: DataFrame) -> DataFrame:
        return decode(df, self.target_vocab)


def flatten_tokens(payloads: DataFrame) -> DataFrame:
    """Nested shard payloads to one row per sentence, in the order of the batches.

    Batches and the arrays inside them are joined by position; a difference in length is an error.
    """
    inputs = "tokenized_inputs"
    columns = {
        "id": F.flatten("ids"),
        "input_ids": F.flatten(F.col(f"{inputs}.batch.input_ids")),
        "attention_mask": F.flatten(F.col(f"{inputs}.batch.attention_mask")),
        "entities": F.flatten(F.col(f"{inputs}.placeholder_entity_maps")),
    }
    wide = payloads.select("shard", *[c.alias(name) for name, c in columns.items()])
    sizes = [F.size(name) for name in columns]
    aligned = (sizes[0] == sizes[1]) & (sizes[1] == sizes[2]) & (sizes[2] == sizes[3])
    message = F.concat(F.lit("misaligned arrays in shard "), F.col("shard"))
    zipped = F.when(aligned, F.arrays_zip(*columns)).otherwise(F.raise_error(message))
    return wide.select("shard", F.posexplode(zipped).alias("pos", "item")).select(
        "shard", F.col("pos").cast("long").alias("pos"), "item.*"
    )
