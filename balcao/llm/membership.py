"""Rows whose key may be among wanted ones, before a join that would shuffle all of them.

Hashes of the wanted keys set bits in a bitmap of fixed size, a few thousand small rows that
are broadcast whatever the number of keys. Rows whose bit is not set are certainly not wanted;
a join on the key itself must follow. With far more keys than bits nearly all rows pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB: 2,048 rows of 32,768 bits


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS)) + 1


def likely_members(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``; null is a key like any other."""
    place = _place(F.col(wanted_key))
    bits = wanted.groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bits")
    )
    at = F.bitmap_bit_position(_place(F.col(key)))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (at % 8).cast("int")) == 1
    joined = rows.join(F.broadcast(bits), F.bitmap_bucket_number(_place(F.col(key))) == F.col("__bucket"))
    return joined.where(is_set).select(*[F.col(f"`{c}`") for c in rows.columns])
