"""Column functions over token id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentloom.constants import BOS_ID, EOS_ID, IGNORED_LABEL, PAD_ID, START_ID
from sentloom.functions.binding import bind
from sentloom.functions.text import _col


def left_pad(values: Column | str, length: Column | int, pad: int) -> Column:
    """Pad at the front up to ``length``; longer arrays stay as they are."""
    values = _col(values)
    length = F.lit(length) if isinstance(length, int) else length
    missing = F.greatest(length - F.size(values), F.lit(0)).cast("int")
    return F.concat(F.array_repeat(F.lit(pad), missing), values)


def attention_mask(ids: Column | str) -> Column:
    """One for each real token of an unpadded array."""
    return F.array_repeat(F.lit(1), F.size(_col(ids)))


def strip_special(ids: Column | str) -> Column:
    """Drop the begin, pad and end ids."""
    return F.filter(_col(ids), lambda i: ~i.isin(BOS_ID, PAD_ID, EOS_ID))


def shift_right(ids: Column | str, pad: int | None = PAD_ID, start: int = START_ID) -> Column:
    """Put the start id in front, drop the last id, and turn ignored labels into pads."""
    if pad is None:
        raise ValueError("the pad id must be given")
    ids = _col(ids)
    labels = F.transform(ids, lambda i: F.when(i == IGNORED_LABEL, F.lit(pad)).otherwise(i))
    shifted = F.concat(F.array(F.lit(start)), F.slice(labels, F.lit(1), F.size(ids) - 1))
    return F.when(F.size(ids) <= 0, ids).otherwise(shifted)


def _running_count(flags: Column) -> Column:
    """Running sum of an array of zeros and ones.

    Arrays that are zeros followed by ones, as left padding gives, have a closed form; any other
    mix is folded element by element.
    """
    empty = F.named_struct(F.lit("n"), F.lit(0), F.lit("out"), F.array().cast("array<int>"))

    def step(acc: Column, flag: Column) -> Column:
        total = acc["n"] + flag
        return F.named_struct(F.lit("n"), total, F.lit("out"), F.concat(acc["out"], F.array(total)))

    def count(flags: Column, zeros: Column) -> Column:
        padded = F.forall(F.slice(flags, F.lit(1), zeros), lambda f: f == 0)
        closed = F.transform(flags, lambda _, i: F.greatest(i + 1 - zeros, F.lit(0)))
        return F.when(padded, closed).otherwise(F.aggregate(flags, empty, step)["out"])

    return bind(count, flags=flags, zeros=F.size(F.filter(flags, lambda f: f == 0)))


def position_ids(ids: Column | str, pad: int = PAD_ID, past: int = 0) -> Column:
    """Positions that start after ``pad`` and skip padding, which keeps the pad id."""
    flags = F.transform(_col(ids), lambda i: (i != pad).cast("int"))
    return F.zip_with(_running_count(flags), flags, lambda n, f: (n + past) * f + pad)


def mask_positions(mask: Column | str) -> Column:
    """Zero-based positions from an attention mask."""
    return F.transform(_running_count(_col(mask)), lambda n: n - 1)


def row_positions(ids: Column | str) -> Column:
    """Zero-based positions of an array without a mask."""
    return F.transform(_col(ids), lambda _, i: i)
