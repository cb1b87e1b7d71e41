"""Ranks over all rows, without sorting all of them in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import scan

#: Values that splitters are chosen from, and stretches between them.
SAMPLE, BINS = 16_384, 256


def rows_below(rows: DataFrame, value: str) -> DataFrame:
    """(value, below, total) for every value: how many rows have a lesser one, and how many there are at all.

    Rows are counted by value first. Values are dealt into stretches by splitters out of a sample of them (those with
    the least hashes), so a value far from the others, or a frequent one, makes no stretch large. Only the stretches'
    sums are added up in one place. Values may be of any kind that has an order; null ones have no row, NaN is the
    greatest.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    sample = counts.select("value").orderBy(F.xxhash64("value"), "value").limit(SAMPLE).agg(F.sort_array(F.collect_list("value")).alias("v"))
    step = F.greatest(F.size("v") / F.lit(BINS), F.lit(1.0))
    splitters = F.transform(F.sequence(F.lit(1), F.lit(BINS - 1)), lambda i: F.get("v", F.floor(i * step).cast("int")))
    chosen = sample.select(F.array_compact(splitters).alias("splitters"))
    binned = counts.join(F.broadcast(chosen)).withColumn("bin", F.size(F.filter("splitters", lambda s: s < F.col("value")))).drop("splitters")
    sums = binned.groupBy("bin").agg(F.sum("n").alias("n"))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return binned.join(F.broadcast(starts), "bin").select(F.col("value").alias(value), below.alias("below"), "total")


def _ranked(rows: DataFrame, value: str) -> DataFrame:
    """(row, value, below, total): every row as it is, with what rows_below says of its value."""
    ranks = rows_below(rows, value).select(F.col(value).alias("value"), "below", "total")
    return rows.select(F.col(value).alias("value"), F.struct("*").alias("row")).join(ranks, "value", "left")


def percent_ranked(rows: DataFrame, value: str, out: str) -> DataFrame:
    """rows with the share of the other rows that have a lesser value; null for a null value, 0 of a single row."""
    share = F.coalesce(F.try_divide(F.col("below"), F.col("total") - 1), F.lit(0.0))
    return _ranked(rows, value).select("row.*", F.when(F.col("value").isNotNull(), share).alias(out))


def _tile(place: Column, total: Column, tiles: int) -> Column:
    """1 to tiles for places from 0: the first ones have one row more where they can't be even."""
    size, more = F.floor(total / tiles), total % tiles
    large = more * (size + 1)
    return F.when(place < large, F.floor(place / (size + 1)) + 1).otherwise(F.floor(F.try_divide(place - large, size)) + more + 1).cast("int")


def tiled(rows: DataFrame, value: str, tie: str, tiles: int, out: str, size: int = scan.STRETCH) -> DataFrame:
    """rows with the number of their tile, all rows in order of value and tie cut into `tiles` of equal size; null for a
    null value. Rows of one value are numbered by stretches of tie, if there are many of them."""
    points = rows.select(F.col(value).alias("key"), scan.number_of(rows, tie).alias("at"), F.col(tie).alias("by"), F.struct("*").alias("row"))
    numbered = scan.scanned(points, ["by"], {"place": (F.count, F.lit(1))}, size=size).select(F.col("key").alias("value"), "row", "place")
    ranks = rows_below(rows, value).select(F.col(value).alias("value"), "below", "total")
    place = F.col("below") + F.col("place") - 1
    return numbered.join(ranks, "value", "left").select("row.*", F.when(place.isNotNull(), _tile(place, F.col("total"), tiles)).alias(out))
