"""Time axes: ranges, expressions, set algebra, seeking, cursors and windows.

An axis belongs to a key (a layer, an entity). Operators that look along it take a window by key only where no key has
very many times; else they go by positions, which `scan` counts over stretches of an axis.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import stamps
from tallyloom.functions.binding import let
from tallyloom.functions.periods import MONTHS, add_period, parse_instant, parse_period
from tallyloom.operators import scan


def in_time_of_day(ts: Column, first: str, last: str) -> Column:
    """Is the UTC time of day from first to last, both HH:MM. Minutes count in the bounding hours only."""
    (h, m), (j, k) = (map(int, x.split(":")) for x in (first, last))
    hour, minute = F.hour(ts), F.minute(ts)
    return hour.between(h, j) & ((hour != h) | (minute >= m)) & ((hour != j) | (minute <= k))


#: Instants of a range in one row, at most; a longer one is an error of its row.
LONGEST = 10_000_000


def explode_range(start: Column, end: Column, period: Column, valid: tuple[str, str] | None = None, overflow: bool = True, strict: bool = False) -> Column:
    """Array of instants from start in steps of period, before end, then always end itself.

    Steps add up: a month's step starts from where the last one landed. valid keeps instants within a time of day, but
    not end. Null if one of the three is, or where range_problem says why; with strict, such a row raises an error.
    """
    given = F.struct(start.alias("start"), end.alias("end"), period.alias("period"))

    def whole(x: Column) -> Column:
        why = _problem(x)
        bad = F.raise_error(why).cast("array<timestamp>") if strict else F.lit(None).cast("array<timestamp>")
        return F.when(why.isNotNull(), bad).when(_given(x), _stepped(x["start"], x["end"], x["period"], valid, overflow))

    return let(given, whole)


def explode_range_by_batches(start: Column, end: Column, period: Column, valid: tuple[str, str] | None = None, overflow: bool = True, strict: bool = False) -> Column:
    """explode_range for long ranges: even steps are made and filtered by Arrow batches instead of a lambda.

    It can't stand in a lambda itself. Rows of more than stamps.LONG steps or with months, and all in other time zones
    than UTC, go by explode_range.
    """
    months, fixed = _parts(period)
    step = F.try_multiply(fixed, F.lit(1000000))
    apart = F.try_subtract(F.unix_micros(end), F.unix_micros(start))
    even = (F.current_timezone() == "UTC") & (months == 0) & (step > 0) & apart.isNotNull() & (_steps(start, end, period) <= stamps.LONG)
    minutes = valid and tuple(int(x[:-3]) * 60 + int(x[-2:]) for x in valid)
    return F.coalesce(stamps.stepped(start, end, F.when(even, step), minutes), explode_range(start, end, period, valid, overflow, strict))


def in_phase(rows: DataFrame, start: Column, period: Column) -> DataFrame:
    """rows, sorted within their partitions so that ranges whose even steps land on the same instants stand together, by
    their starts.

    Such ranges are stretches of one series, so that files of what they step through, or of its text, get much smaller.
    Where period has months or no length, or a part is null, rows have no phase and come first.
    """
    months, fixed = _parts(period)
    step = F.try_multiply(fixed, F.lit(1000000))
    # A column first: a sort would work an expression out anew for every comparison.
    placed = rows.withColumn("_phase", F.when((months == 0) & (step > 0), F.pmod(F.unix_micros(start), step)))
    return placed.sortWithinPartitions("_phase", start).drop("_phase")


def range_problem(start: Column, end: Column, period: Column) -> Column:
    """Why a range has no instants, as text; null if it has, or if a part of it is null."""
    return let(F.struct(start.alias("start"), end.alias("end"), period.alias("period")), _problem)


def _given(x: Column) -> Column:
    return x["start"].isNotNull() & x["end"].isNotNull() & x["period"].isNotNull()


def _problem(x: Column) -> Column:
    count = _steps(x["start"], x["end"], x["period"])
    zero = F.lit("a range can't be stepped through by a period of zero")
    return F.when(_given(x), F.when(count.isNull(), zero).when(count > LONGEST, F.lit(f"a range has more than {LONGEST} steps")))


def _parts(period: Column) -> tuple[Column, Column]:
    """(months, seconds) of a period."""
    slot = lambda i: F.get(period, F.lit(i)).cast("long")
    return slot(0) * 12 + slot(1), sum((slot(i) * n for i, n in ((2, 604800), (3, 86400), (4, 3600), (5, 60), (6, 1))), F.lit(0).cast("long"))


def _steps(start: Column, end: Column, period: Column) -> Column:
    """Steps from start to end, at most so many; null for a period of zero with something to step through."""
    months, fixed = _parts(period)
    left = F.coalesce(F.try_subtract(F.unix_micros(end), F.unix_micros(start)), F.lit(2**63 - 1))
    least = F.coalesce(F.try_multiply(F.try_add(F.try_multiply(months, F.lit(28 * 86400)), fixed), F.lit(1000000)), F.lit(2**63 - 1))
    return F.when(left <= 0, F.lit(0).cast("long")).when(least > 0, F.ceil(left / least))


def _stepped(start: Column, end: Column, period: Column, valid: tuple[str, str] | None, overflow: bool) -> Column:
    months, fixed = _parts(period)
    count = _steps(start, end, period)
    before_end = F.timestamp_micros(F.unix_micros(end) - 1)
    even = F.when(count > 0, F.sequence(start, before_end, F.make_dt_interval(secs=fixed.cast("decimal(18,6)")))).otherwise(F.array().cast("array<timestamp>"))
    walked = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(count, F.lit(1))), F.array(start),
        lambda seen, _: F.concat(seen, F.array(add_period(F.element_at(seen, -1), period, overflow=overflow))),
    )
    # Up to the 28th a month's steps land on the same day of every month, so each is reached from start at once.
    most = (MONTHS // 12 - F.year(start)) * 12
    leaps = F.transform(
        F.sequence(F.lit(0).cast("long"), count),
        lambda i: F.timestamp_micros(F.unix_micros(F.add_months(start.cast("date"), F.least(months * i, most).cast("int")).cast("timestamp")) + F.unix_micros(start) - F.unix_micros(F.date_trunc("DAY", start))),
    )
    monthly = F.when((fixed == 0) & (F.dayofmonth(start) <= 28), leaps).otherwise(walked)
    steps = F.when(months > 0, F.filter(monthly, lambda t: t < end)).otherwise(even)
    if valid:
        steps = F.filter(steps, lambda t: in_time_of_day(t, *valid))
    return F.concat(steps, F.array(end))


def parse_interval(text: Column) -> Column:
    """struct(start, end) of `a/b`, `period/b` or `a/period`; an error if there aren't two parts."""
    parts = F.split(text, "/")
    a, b = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    start, end = parse_instant(a), parse_instant(b)
    whole = F.struct(
        F.coalesce(start, add_period(end, parse_period(a, carry=True), -1)).alias("start"),
        F.coalesce(end, add_period(start, parse_period(b, carry=True))).alias("end"),
    )
    return F.when(F.size(parts) == 2, whole).otherwise(F.raise_error(F.concat(F.lit("not a time interval: "), text)).cast("struct<start:timestamp,end:timestamp>"))


#: Fixed value: the period where none is given.
DAILY = "P1D"


def parse_range(text: Column) -> Column:
    """Instants of `start/end/period` or `start/end`, which is in steps of a day; null if a part can't be read, or if the
    period is zero or makes too many steps."""
    cut = F.split(text, "/")
    start, end = parse_instant(F.get(cut, F.lit(0))), parse_instant(F.get(cut, F.lit(1)))
    return explode_range(start, end, parse_period(F.coalesce(F.get(cut, F.lit(2)), F.lit(DAILY)), carry=True))


def parse_times(text: Column) -> Column:
    """Sorted instants of a list of dates and start/end/period ranges; what is neither is left out, ranges that parse_range
    has null for too, repeats stay."""

    def one(part: Column) -> Column:
        single = F.array_compact(F.array(parse_instant(part)))
        return F.when(F.size(F.split(part, "/")) == 3, F.coalesce(parse_range(part), F.array().cast("array<timestamp>"))).otherwise(single)

    return F.sort_array(F.flatten(F.transform(F.split(text, ","), one)))


def axis_from_options(times: Column, interval: Column, period: Column, valid: tuple[str, str] | None = None) -> Column:
    """An axis as its options say: the times expression if there is one, else the interval in steps of the period (a day
    where it is null), else no times."""
    ends = parse_interval(interval)
    ranged = let(ends, lambda x: explode_range(x["start"], x["end"], parse_period(F.coalesce(period, F.lit(DAILY)), carry=True), valid))
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.when(given(times), parse_times(times)).when(given(interval), ranged).otherwise(F.array().cast("array<timestamp>"))


def set_times(old: DataFrame, new: DataFrame, key: str, time: str, mode: str, period: Column | None = None) -> DataFrame:
    """Every key's axis after new times have come: as merge_axes, and keys without an axis yet take the new times in any
    mode. Mode `extremes` gives each key of `new` a regular range between its least and greatest time, by days or by
    period."""
    if mode == "extremes":
        return extremes(new, key, time, period if period is not None else parse_period(F.lit(DAILY)))
    merged = merge_axes(old.select(key, time), new.select(key, time), mode)
    if mode != "intersect":
        return merged
    fresh = new.select(key, time).distinct().join(old.select(key).distinct(), key, "left_anti")
    return merged.unionByName(fresh)


def merge_axes(old: DataFrame, new: DataFrame, mode: str, bag: bool = False) -> DataFrame:
    """New times into an old axis: intersect, union or replace. Both have the same columns (a key and a time).

    Axes are sets; with bag, repeats count: the smaller number of them in an intersection, the larger in a union.
    """
    if mode == "replace":
        return new if bag else new.distinct()
    if mode == "intersect":
        return old.intersectAll(new) if bag else old.intersect(new)
    if mode == "union":
        return old.unionAll(new.exceptAll(old)) if bag else old.union(new).distinct()
    raise ValueError(f"unknown way to merge axes: {mode}")


def extremes(axis: DataFrame, key: str, time: str, period: Column) -> DataFrame:
    """Each key's axis as a regular range from its least to its greatest time."""
    ends = axis.groupBy(key).agg(F.min(time).alias("_low"), F.max(time).alias("_high"))
    return ends.select(key, F.explode(explode_range(F.col("_low"), F.col("_high"), period)).alias(time))


def seek(axis: Column, time: Column) -> Column:
    """The last time of a sorted array that isn't after `time`, or the first one; null for a null time."""
    found = F.filter(axis, lambda t: t <= time)
    return F.when(time.isNotNull(), F.coalesce(F.try_element_at(found, F.lit(-1)), F.get(axis, F.lit(0))))


def seek_join(rows: DataFrame, time: str, axis: DataFrame, axis_time: str, key: str | None = None) -> DataFrame:
    """rows with `sought`, the last axis time that isn't after theirs, or the first of all. Null times seek nothing.

    With key, each row seeks on its key's own axis, and one without an axis seeks nothing.
    """
    return scan.sought(rows, time, axis, axis_time, key)


def _by(key: str, time: str):
    return Window.partitionBy(key).orderBy(time)


def _wide(axis: DataFrame, key: str, time: str) -> bool:
    """Has a key so many times that no task should hold them all?"""
    return scan.cuts(scan.packed(axis, key, time)) is not None


def positions(axis: DataFrame, key: str, time: str) -> DataFrame:
    """axis with `index`, counted from 0, and `last`, the greatest index of its key."""
    return scan.positions(axis, key, time)


def cursor(axis: DataFrame, key: str, time: str, step: int = 1, loop: bool = False, lower: int = 0, upper: int | None = None) -> DataFrame:
    """axis with `index`, its place, and `moved`: the time that a cursor on this one goes to. Beyond a limit it stops
    there, or with loop goes to the opposite limit."""
    if lower == 0 and upper is None and not _wide(axis, key, time):  # the whole axis: a look along it
        whole = _by(key, time).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        far, near = (F.last, F.first) if step > 0 else (F.first, F.last)
        past = (near if loop else far)(time).over(whole)
        ahead = F.lead(time, step) if step > 0 else F.lag(time, -step)
        return axis.select(key, time, (F.row_number().over(_by(key, time)) - 1).alias("index"), F.coalesce(ahead.over(_by(key, time)), past).alias("moved"))
    placed = positions(axis, key, time)
    high = F.least(F.col("last"), F.lit(upper)) if upper is not None else F.col("last")
    to = F.col("index") + step
    to = F.when(to > high, F.lit(lower) if loop else high).when(to < lower, high if loop else F.lit(lower)).otherwise(to)
    moved = placed.select(key, time, "index", F.greatest(F.lit(0), F.least(to, F.col("last"))).alias("_to"))
    target = placed.select(F.col(key).alias("_k"), F.col("index").alias("_i"), F.col(time).alias("moved"))
    return moved.join(target, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_to") == F.col("_i"))).select(key, time, "index", "moved")


def _ahead(step: int, count: int, loop: bool, lower: int, upper: int | None, halt: bool) -> Column:
    """struct(out, ended): the next `count` places from `index` in steps, and whether a limit ended them before. With
    loop, a step over a limit lands on the opposite one; with halt, coming back to the start ends them too."""
    high = F.least(F.col("last"), F.lit(upper)) if upper is not None else F.col("last")
    start = F.named_struct(F.lit("at"), F.col("index"), F.lit("out"), F.array().cast("array<int>"), F.lit("ended"), F.lit(False), F.lit("closed"), F.lit(False))

    def move(acc: Column, _: Column) -> Column:
        to = acc["at"] + step
        beyond = (to > high) | (to < lower)
        landed = F.when(to > high, F.lit(lower)).when(to < lower, high).otherwise(to).cast("int")
        ended = acc["ended"] | (beyond if not loop else F.lit(False))
        closed = acc["closed"] | ended | ((landed == F.col("index")) if halt else F.lit(False))
        out = F.when(closed, acc["out"]).otherwise(F.concat(acc["out"], F.array(landed)))
        return F.named_struct(F.lit("at"), F.when(closed, acc["at"]).otherwise(landed), F.lit("out"), out, F.lit("ended"), ended, F.lit("closed"), closed)

    return F.aggregate(F.sequence(F.lit(1), F.lit(count)), start, move)


def _visited(axis: DataFrame, key: str, time: str, places: Column) -> DataFrame:
    """(key, index, ended, place, rank): a row for each place ahead of each time, one without a place where there is none."""
    placed = positions(axis, key, time).withColumn("places", places)
    return placed.select(key, "index", "places.ended", F.posexplode_outer("places.out").alias("rank", "place"))


def lookahead(
    axis: DataFrame, key: str, time: str, count: int, step: int = 1, loop: bool = False, lower: int = 0, upper: int | None = None
) -> DataFrame:
    """axis with `ahead`: up to `count` times that a cursor moving by `step` comes to. Without loop they end at a limit,
    with it where they come back to the start. (key, time) must be unique unless the plain window does."""
    if step == 1 and not loop and lower == 0 and upper is None and not _wide(axis, key, time):
        return axis.withColumn("ahead", F.collect_list(time).over(_by(key, time).rowsBetween(1, count)))
    spots = _visited(axis, key, time, _ahead(step, count, loop, lower, upper, halt=True))
    placed = positions(axis, key, time)
    met = spots.join(placed.select(key, F.col("index").alias("place"), F.col(time).alias("met")), [key, "place"], "left")
    listed = met.groupBy(key, "index").agg(F.sort_array(F.collect_list(F.when(F.col("place").isNotNull(), F.struct("rank", "met")))).alias("found"))
    return placed.join(listed, [key, "index"]).select(*axis.columns, F.transform("found", lambda x: x["met"]).alias("ahead"))


def ready_ahead(
    axis: DataFrame, key: str, time: str, ready: str, count: int, step: int = 1, loop: bool = False, lower: int = 0, upper: int | None = None
) -> DataFrame:
    """axis with `ready_ahead`: how many of the next `count` are ready; all of them if a limit ends them before."""
    if step == 1 and not loop and lower == 0 and upper is None and not _wide(axis, key, time):
        frame = _by(key, time).rowsBetween(1, count)
        seen = F.count("*").over(frame)
        n = F.coalesce(F.sum(F.col(ready).cast("int")).over(frame), F.lit(0))
        return axis.withColumn("ready_ahead", F.when(seen < count, F.lit(count)).otherwise(n).cast("long"))
    spots = _visited(axis, key, time, _ahead(step, count, loop, lower, upper, halt=False))
    placed = positions(axis, key, time)
    met = spots.join(placed.select(key, F.col("index").alias("place"), F.col(ready).alias("met")), [key, "place"], "left")
    counted = met.groupBy(key, "index").agg(F.count_if("met").alias("n"), F.bool_or("ended").alias("ended"))
    n = F.when(F.col("ended"), F.lit(count)).otherwise(F.col("n")).cast("long")
    return placed.join(counted, [key, "index"]).select(*axis.columns, n.alias("ready_ahead"))


def limited(axis: DataFrame, key: str, time: str, low: Column, high: Column) -> DataFrame:
    """axis between the times that low and high seek, both included. low and high are the same for all rows."""

    def sought(bound: Column) -> Column:
        return F.when(bound.isNotNull(), F.coalesce(F.max(F.when(F.col(time) <= bound, F.col(time))), F.min(time)))

    bounds = axis.groupBy(F.col(key).alias("_key")).agg(sought(low).alias("_low"), sought(high).alias("_high"))
    bound = axis.join(bounds, F.col(key).eqNullSafe(F.col("_key")))
    return bound.filter(F.col(time).between(F.col("_low"), F.col("_high"))).select(*axis.columns)


def trailing_count(rows: DataFrame, key: str, time: str, seconds: int) -> DataFrame:
    """rows with `trailing`: rows of the key from `seconds` before, up to this one's time. Null times have null."""
    if _wide(rows, key, time):
        return scan.trailing(rows, key, time, F.timestamp_micros(F.unix_micros(time) - seconds * 1000000))
    frame = Window.partitionBy(key).orderBy(F.unix_micros(time)).rangeBetween(-seconds * 1000000, 0)
    return rows.withColumn("trailing", F.when(F.col(time).isNotNull(), F.count("*").over(frame)))


def trailing_period(rows: DataFrame, key: str, time: str, period: Column, overflow: bool = True, out: str = "trailing") -> DataFrame:
    """rows with `trailing`: rows of the key from a calendar period before, up to this one's time, ends included.

    period (as parse_period makes it) may differ from row to row; where it is null the window has no lower end. A month
    before the 31st runs over as add_period says. A period that leads beyond what a timestamp can hold has no lower end
    either. Null times have null.
    """
    return scan.trailing(rows, key, time, add_period(F.col(time).cast("timestamp"), period, -1, overflow), out)
