"""Running sums and extremes along each key's axis, whatever share of the rows a key has.

A key with many points is cut into stretches of its axis at quantiles, which a sketch finds in one aggregation. Stretches
are scanned by themselves, and what the stretches before add is taken from a table of one row a stretch. A window by key
alone would bring all rows of a key into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Points of a key in a stretch, about. Keys with no more aren't cut.
STRETCH = 1_000_000

#: By the new column's name the aggregate (sum, min, max or count) and what it takes.
Parts = dict[str, tuple[Callable[[Column], Column], Column]]


def number_of(rows: DataFrame, column: str) -> Column:
    """A column as a number in the same order: times in microseconds, dates in days. Other kinds aren't cut: null."""
    kind = rows.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    return F.col(column).cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")


def cuts(points: DataFrame, size: int = STRETCH) -> DataFrame | None:
    """(hot, cuts) for every key with more than `size` points: where its stretches end. None if there is no such key.

    points: key, at. All cuts are a number for each `size` points at most, so they can be broadcast.
    """
    points = points.select("key", "at")
    counted = points.filter("at is not null").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > size)
    counted = counted.select(F.col("key").alias("hot"), "n")
    most = counted.agg(F.max("n")).first()[0]
    if most is None:
        return None
    parts = -(-most // size)
    marks = F.percentile_approx("at", [i / parts for i in range(1, parts)], max(10_000, 10 * parts)).alias("marks")
    hot = points.join(F.broadcast(counted), F.col("key").eqNullSafe(F.col("hot")))
    own = F.ceil(F.col("n") / size)  # a smaller key takes every so manieth mark
    kept = F.transform(F.sequence(F.lit(1).cast("long"), own - 1), lambda i: F.get("marks", (F.floor(i * parts / own) - 1).cast("int")))
    return hot.groupBy("hot", "n").agg(marks).select("hot", F.array_distinct(kept).alias("cuts"))


def drawn(limits: DataFrame) -> DataFrame:
    """The cuts as a table of their own. A sketch comes out otherwise as its parts arrive, and rows and carries must be
    dealt by the same cuts, so these are found once: a number for each million points goes through the driver."""
    return limits.sparkSession.createDataFrame(limits.toArrow(), limits.schema)


def scanned(points: DataFrame, order: Iterable[str], running: Parts, whole: Parts | None = None, size: int = STRETCH, known: DataFrame | None | bool = False) -> DataFrame:
    """points with `running` aggregates over the rows of their key up to and including each, and `whole` ones over all.

    points: key, at (a number, or null for keys that can't be cut) and others; order names the columns that order them,
    at's own order first. Rows that are equal in these come in any order. known: the cuts, if they are there already.
    """
    whole, limits = whole or {}, cuts(points, size) if known is False else known
    along = Window.partitionBy("key", "stretch").orderBy(*order)
    so_far, all_of = along.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("key", "stretch")
    columns = {n: f(c).over(so_far) for n, (f, c) in running.items()} | {n: f(c).over(all_of) for n, (f, c) in whole.items()}
    if limits is None:
        return points.withColumn("stretch", F.lit(0)).withColumns(columns).drop("stretch")
    met = points.join(F.broadcast(drawn(limits)), F.col("key").eqNullSafe(F.col("hot")), "left")
    stretch = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("at"))), F.lit(0))
    placed = met.withColumn("stretch", F.when(F.col("cuts").isNull(), 0).otherwise(stretch)).drop("hot")
    # One row a stretch of the hot keys: what the stretches before it have, and what all have.
    own = placed.filter("cuts is not null").groupBy("key", "stretch").agg(*[f(c).alias(n) for n, (f, c) in (running | whole).items()])
    again = {F.count: F.sum}
    before = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = [again.get(f, f)(F.col(n)).over(before).alias(f"_before_{n}") for n, (f, _) in running.items()]
    total = [again.get(f, f)(F.col(n)).over(Window.partitionBy("key")).alias(f"_before_{n}") for n, (f, _) in whole.items()]
    carries = own.select(F.col("key").alias("_key"), F.col("stretch").alias("_stretch"), *carried, *total)
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("stretch") == F.col("_stretch"))
    both = placed.withColumns(columns).join(F.broadcast(carries), same, "left")
    join: dict = {F.sum: lambda a, b: F.coalesce(a + b, a, b), F.count: lambda a, b: a + F.coalesce(b, F.lit(0)), F.max: F.greatest, F.min: F.least}
    joined = {n: join[f](F.col(n), F.col(f"_before_{n}")) for n, (f, _) in running.items()}
    joined |= {n: F.coalesce(F.col(f"_before_{n}"), F.col(n)) for n in whole}
    return both.withColumns(joined).select(*points.columns, *joined)


def packed(rows: DataFrame, key: str | None, at: str) -> DataFrame:
    """(key, at, by, row): a row's key (one for all without key), its place as a number and as it is, and itself."""
    own = F.col(key) if key else F.lit(0)
    return rows.select(own.alias("key"), number_of(rows, at).alias("at"), F.col(at).alias("by"), F.struct("*").alias("row"))


def positions(axis: DataFrame, key: str, at: str, size: int = STRETCH) -> DataFrame:
    """axis with `index`, counted from 0, and `last`, the greatest index of its key. Null times come first."""
    index, last = (F.count, F.lit(1)), (F.count, F.lit(1))
    found = scanned(packed(axis, key, at), ["by"], {"index": index}, {"last": last}, size)
    columns = [F.col(f"row.{c}").alias(c) for c in axis.columns if c not in ("index", "last")]
    return found.select(*columns, *[(F.col(c) - 1).cast("int").alias(c) for c in ("index", "last")])


def sought(rows: DataFrame, time: str, axis: DataFrame, axis_time: str, key: str | None = None, axis_key: str | None = None, size: int = STRETCH) -> DataFrame:
    """rows with `sought`: the last time of the axis that isn't after theirs, or its first one.

    With key, each key has an axis of its own; a key without one, and a null time, seek nothing: null. Null keys are a
    key like any other. Repeated times of an axis count once; rows may have any columns but `sought`.
    """
    probes = packed(rows, key, time)
    untimed = probes.filter("by is null").select("row.*", F.lit(None).cast(axis.schema[axis_time].dataType).alias("sought"))
    marks = packed(axis, axis_key or key, axis_time).filter("by is not null").select("key", "at", F.col("by").alias("mark")).distinct()
    both = marks.withColumns({"by": F.col("mark"), "probe": F.lit(0)}).unionByName(
        probes.filter("by is not null").withColumn("probe", F.lit(1)), allowMissingColumns=True
    )
    found = scanned(both, ["by", "probe"], {"reached": (F.max, F.col("mark"))}, {"first": (F.min, F.col("mark"))}, size)
    return found.filter("probe = 1").select("row.*", F.coalesce("reached", "first").alias("sought")).unionByName(untimed)


def trailing(rows: DataFrame, key: str, time: str, lower: Column, out: str = "trailing", size: int = STRETCH) -> DataFrame:
    """rows with the number of rows of their key whose time lies from `lower` to their own time, ends included.

    lower is a time that may differ from row to row (a calendar month before, say); where it is null the window has no
    lower end. Two counts of what came before are taken at each window's ends, so a window costs the same whatever it
    holds. A row with a null time has null; null keys are a key like any other.
    """
    base = rows.select(F.col(key).alias("key"), number_of(rows, time).alias("at"), F.unix_micros(lower).alias("low"), F.struct("*").alias("row"))
    timed = base.filter("at is not null")
    windows = timed.select("key", "at", "low").distinct()
    counted = timed.groupBy("key", "at").agg(F.count("*").alias("n")).withColumn("kind", F.lit(1))
    # At equal times a window's lower end comes before the rows, its upper end after them.
    ends = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("low").alias("to")), F.struct(F.lit(2).alias("kind"), F.col("at").alias("to"))))
    asked = windows.select("key", F.col("at").alias("from"), "low", ends.alias("end")).select("key", "from", "low", F.col("end.kind").alias("kind"), F.col("end.to").alias("at"))
    both = counted.unionByName(asked.filter("at is not null").withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    found = scanned(both, ["at", "kind"], {"upto": (F.sum, F.col("n"))}, size=size).filter("kind <> 1")
    upper = F.max(F.when(F.col("kind") == 2, F.col("upto")))
    below = F.max(F.when(F.col("kind") == 0, F.col("upto")))
    held = found.groupBy("key", "from", "low").agg(F.greatest(upper - F.coalesce(below, F.lit(0)), F.lit(0)).alias("held"))
    held = held.select(F.col("key").alias("_k"), "from", F.col("low").alias("_l"), "held")
    same = F.col("key").eqNullSafe(F.col("_k")) & (F.col("at") == F.col("from")) & F.col("low").eqNullSafe(F.col("_l"))
    return base.join(held, same, "left").select("row.*", F.col("held").alias(out))
