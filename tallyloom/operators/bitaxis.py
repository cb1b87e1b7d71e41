"""Very long axes as bitmaps: a set of times is bits, so unions, intersections and counts shuffle words of bits, not times.

A time is the number of its grid point, of a day for dates and of `unit` seconds for timestamps; a time between two points
counts as the one before. A key's numbers are dealt to buckets of 64, each with a word of 64 bits. Tasks make words of
their own rows first, so a key with very many times sends one word a bucket and task, and a key with few times sends no
more than these. Keys may be null, as one key more; null times are times of no axis. A key's column must not be named
`_bucket` or `_bits`; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

#: The bits of a word, and by how many bits a number is shifted for its bucket.
BITS, SHIFT = 64, 6


def packed(axis: DataFrame, key: str, time: str, unit: int = 1) -> DataFrame:
    """(key, _bucket, _bits) of an axis of dates or timestamps, repeats or not."""
    dates = isinstance(axis.schema[time].dataType, DateType)
    number = F.unix_date(time) if dates else F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (unit * 1_000_000))
    rows = axis.filter(F.col(time).isNotNull()).select(key, number.cast("long").alias("_number"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_number").bitwiseAND(F.lit(BITS - 1)).cast("int"))
    bucketed = rows.select(key, F.shiftright("_number", SHIFT).alias("_bucket"), bit.alias("_bit"))
    return bucketed.groupBy(key, "_bucket").agg(F.bit_or("_bit").alias("_bits"))


def merged(axes: list[DataFrame], key: str, mode: str) -> DataFrame:
    """Packed axes of one grid as one: `union`, or `intersect` for the times that all of them have. A key or bucket
    without times is left out."""
    if mode not in ("union", "intersect"):
        raise ValueError(f"unknown way to merge axes: {mode}")
    together = axes[0]
    for axis in axes[1:]:
        together = together.unionByName(axis)
    groups = together.groupBy(key, "_bucket")
    if mode == "union":
        return groups.agg(F.bit_or("_bits").alias("_bits"))
    both = groups.agg(F.bit_and("_bits").alias("_bits"), F.count("*").alias("_n"))
    return both.filter((F.col("_n") == len(axes)) & (F.col("_bits") != 0)).drop("_n")


def sizes(axis: DataFrame, key: str) -> DataFrame:
    """(key, n): the number of times of each key of a packed axis, which no time is unpacked for."""
    return axis.groupBy(key).agg(F.sum(F.bit_count("_bits")).cast("long").alias("n"))


def _numbers(bucket: Column, bits: Column) -> Column:
    """The numbers that a bucket's bits stand for."""
    is_set = lambda b: F.call_function("shiftright", bits, b).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.transform(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), is_set), lambda b: bucket * BITS + b)


def unpacked(axis: DataFrame, key: str, time: str, unit: int | None = None) -> DataFrame:
    """(key, time) of a packed axis, each time once: timestamps on a grid of `unit` seconds, dates without unit."""
    rows = axis.select(key, F.explode(_numbers(F.col("_bucket"), F.col("_bits"))).alias("_number"))
    number = F.col("_number")
    return rows.select(key, (F.date_from_unix_date(number.cast("int")) if unit is None else F.timestamp_micros(number * (unit * 1_000_000))).alias(time))
