"""Column functions over text: normalise, split, clean, mask entities, tag languages."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sentloom.constants import (
    BULLET, DELIMITERS, ENTITY, ENTITY_HINT, PLACEHOLDER, SYMBOLS, WHITESPACE, WHITESPACE_CLASS,
)
from sentloom.functions.binding import bind

# Blocks without characters that compose with a preceding one, other than combining marks.
_PLAIN_BLOCKS = (
    (0x0000, 0x024F),
    (0x0370, 0x052F),
    (0x2010, 0x2027),
    (0x2030, 0x205E),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FFF),
)


@lru_cache(maxsize=1)
def _stable_text_pattern() -> str:
    """Regex for texts made only of characters that compatibility composition leaves alone."""
    ranges: list[list[int]] = []
    for low, high in _PLAIN_BLOCKS:
        for point in range(low, high + 1):
            char = chr(point)
            if unicodedata.combining(char) or unicodedata.normalize("NFKC", char) != char:
                continue
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    body = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges)
    return rf"\A[{body}]*+\z"


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return texts
    return pa.array([t if t is None else unicodedata.normalize("NFKC", t) for t in texts.to_pylist()], pa.string())


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def compose_text(text: Column | str) -> Column:
    """Unicode compatibility composition (NFKC).

    Spark has no such function. Texts it cannot change are recognised in the JVM and reach the
    Python worker as nulls, so only the others are transferred.
    """
    text = _col(text)
    stable = (F.length(text) == F.octet_length(text)) | F.rlike(text, F.lit(_stable_text_pattern()))
    return F.coalesce(_nfkc(F.when(~stable, text)), text)


def normalize_text(text: Column | str) -> Column:
    """NFKC, then lower case, in that order."""
    return F.lower(compose_text(text))


def split_pieces(text: Column | str, delimiters: str = DELIMITERS) -> Column:
    """Cut after each delimiter, which stays with the piece on its left. No piece is empty."""
    return F.regexp_extract_all(_col(text), F.lit(f"(?s).*?(?:{delimiters})|.+"), F.lit(0))


def strip_symbols(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(SYMBOLS))


def strip_whitespace(text: Column | str) -> Column:
    """Strip Unicode whitespace; ``trim`` alone removes only the space character."""
    return F.btrim(_col(text), F.lit(WHITESPACE))


def strip_bullet(text: Column | str) -> Column:
    """Remove one leading bullet or list number with the whitespace around it."""
    return F.regexp_replace(_col(text), F.lit(BULLET), F.lit(""))


def clean_sentence(text: Column | str) -> Column:
    return strip_whitespace(strip_bullet(strip_whitespace(strip_symbols(text))))


def _regex_sentences(text: Column) -> Column:
    return F.filter(F.transform(split_pieces(text), clean_sentence), lambda s: F.length(s) > 0)


SPLIT_METHODS = {"regex": _regex_sentences}


def sentence_array(text: Column | str, method: str = "regex") -> Column:
    """Clean, non-empty sentences of a text, in order. An unknown method is an error."""
    if method not in SPLIT_METHODS:
        raise ValueError(f"unknown split method {method!r}, expected one of {sorted(SPLIT_METHODS)}")
    return SPLIT_METHODS[method](normalize_text(text))


def whitespace_tokens(text: Column | str) -> Column:
    return F.split(strip_whitespace(text), f"{WHITESPACE_CLASS}+")


def entities(text: Column | str) -> Column:
    """Spans kept out of translation, in order of appearance."""
    return F.regexp_extract_all(_col(text), F.lit(ENTITY), F.lit(0))


def _placeholder(number: Column) -> Column:
    return F.concat(F.lit("<ID"), number.cast("string"), F.lit(">"))


def _may_hold_entity(text: Column) -> Column:
    """A cheap scan that every text with an entity passes; most texts do not."""
    return F.rlike(text, F.lit(ENTITY_HINT))


def mask_entities(text: Column | str) -> Column:
    """Replace the n-th entity by ``<IDn>``."""
    text = _col(text)
    gaps = F.split(text, ENTITY, -1)
    numbered = F.transform(gaps, lambda gap, i: F.when(i == 0, gap).otherwise(F.concat(_placeholder(i), gap)))
    return F.when(_may_hold_entity(text), F.array_join(numbered, "")).otherwise(text)


def entity_map(text: Column | str) -> Column:
    """Map of placeholder to entity for the text before masking."""
    text = _col(text)
    found = entities(text)
    mapped = F.map_from_arrays(F.transform(found, lambda _, i: _placeholder(i + 1)), found)
    none = F.create_map().cast("map<string,string>")
    return F.when(_may_hold_entity(text), mapped).when(text.isNotNull(), none)


def unmask_entities(text: Column | str, placeholders: Column | str) -> Column:
    """Put the entities back. A placeholder the map does not know is left as it stands."""
    text, placeholders = _col(text), _col(placeholders)
    gaps = F.split(text, PLACEHOLDER, -1)
    keys = F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(0))
    values = bind(
        lambda keys, known: F.transform(keys, lambda key: F.coalesce(F.try_element_at(known, key), key)),
        keys=keys,
        known=placeholders,
    )
    pairs = F.zip_with(gaps, values, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))))
    return F.when(F.contains(text, F.lit("<ID")), F.array_join(pairs, "")).otherwise(text)


def tag_language(text: Column | str, src_lang: str, tgt_lang: str) -> Column:
    """Prefix the source and target language as two tokens."""
    return F.concat_ws(" ", F.lit(src_lang), F.lit(tgt_lang), _col(text))


def untag_language(text: Column | str, src_lang: str, tgt_lang: str) -> Column:
    """Remove the two language tokens if they lead the text."""
    text, prefix = _col(text), f"{src_lang} {tgt_lang}"
    bare = F.when(text == prefix, F.lit(""))
    return bare.when(F.startswith(text, F.lit(prefix + " ")), F.substr(text, F.lit(len(prefix) + 2))).otherwise(text)
