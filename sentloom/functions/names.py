"""Column functions for shard numbers, nodes, file names and dataset names."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentloom.constants import SHARDS_PER_FILE
from sentloom.functions.text import _col


def node_of(shard: Column | str, total_nodes: int) -> Column:
    return F.pmod(_col(shard), F.lit(total_nodes)).cast("long")


def shard_base(file_no: Column | str) -> Column:
    """First shard number reserved for a corpus file."""
    return _col(file_no).cast("long") * SHARDS_PER_FILE + 1


def shard_of_path(path: Column | str) -> Column:
    """Shard number of ``…/17.json`` or ``…/shard=17/part-0.json``; null if there is none."""
    path = _col(path)
    stem = F.regexp_extract(path, r"(?:^|/)([0-9]+)\.[A-Za-z]+(?:\.[A-Za-z0-9]+)?$", 1)
    directory = F.regexp_extract(path, r"(?:^|/)shard=([0-9]+)/", 1)
    return F.coalesce(F.nullif(directory, F.lit("")), F.nullif(stem, F.lit(""))).cast("long")


def node_of_path(path: Column | str) -> Column:
    """Node number of ``…/3/tokenized/…`` or ``…/node=3/…``; null if there is none."""
    path = _col(path)
    plain = F.regexp_extract(path, r"/([0-9]+)/(?:tokenized|output)/", 1)
    directory = F.regexp_extract(path, r"/node=([0-9]+)/", 1)
    return F.coalesce(F.nullif(directory, F.lit("")), F.nullif(plain, F.lit(""))).cast("long")


def file_number(name: Column | str) -> Column:
    """Number of a corpus file named ``train-00017-of-00099.parquet``, or of a file in a folder of that name; null if there is none."""
    digits = F.regexp_extract(_col(name), r"train-([0-9]+)-of-[0-9]+\.parquet(?:/[^/]*)?$", 1)
    return F.nullif(digits, F.lit("")).cast("long")


def zero_padded(number: Column | str, width: int = 5) -> Column:
    """Decimal number with leading zeros; numbers that are already wider are not cut."""
    digits = _col(number).cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def file_name(number: Column | str, total: int) -> Column:
    return F.concat(
        F.lit("train-"), zero_padded(number), F.lit("-of-"), zero_padded(F.lit(total)), F.lit(".parquet")
    )


def dataset_name(subset: str, at: datetime | None = None) -> str:
    """Name of a published dataset, stamped with the time of publishing."""
    at = at or datetime.now(timezone.utc)
    return f"{subset}_row_wise_{at:%Y%m%d_%H%M%S}"
