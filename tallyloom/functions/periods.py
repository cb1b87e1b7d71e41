"""ISO-8601 periods and calendar arithmetic as Column expressions.

A period is an array of seven ints: years, months, weeks, days, hours, minutes, seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.binding import let

#: The period grammar, how many of each slot make one of the slot before, and seconds a slot.
GRAMMAR = r"^P((\d+Y)?(\d+M)?(\d+W)?(\d+D)?)?(T(\d+H)?(\d+M)?(\d+S)?)?$"
#: The grammar with what its `$` lets follow, a line's end, and the slots of it in one text.
SLOTS, WHOLE = "$2,$3,$4,$5,$7,$8,$9", GRAMMAR[:-1] + r"(?s:.*)$"
CARRY = (0, 12, 4, 7, 24, 60, 60)
SECONDS = (31104000, 2592000, 604800, 86400, 3600, 60, 1)
#: Months that a step may have, and twelve times the years that an instant may be away from year 0: microseconds hold no more.
MONTHS = 290_000 * 12
WORDS = ("year", "month", "week", "day", "hour", "minute", "second")


def is_period(text: Column) -> Column:
    return F.upper(text).rlike(GRAMMAR)


def parse_period(text: Column, carry: bool = False) -> Column:
    """Seven ints; null if the text is no period or has a number beyond them, zeros if it is empty. With carry, full
    slots move up, from the end; null if they no longer fit then."""
    upper = F.upper(text)
    digits = F.split(F.translate(F.regexp_replace(upper, WHOLE, SLOTS), "YMWDHS", ""), ",")  # all slots by one match
    number = lambda d: F.when(d == "", F.lit(0)).otherwise(d.try_cast("int"))
    slots = F.when(upper == "", F.array(*[F.lit(0)] * 7)).otherwise(F.transform(digits, number))
    found = let(slots, lambda p: F.when(~F.exists(p, F.isnull), p))
    if carry:
        wide = lambda p: let(_all_carried(p.cast("array<long>")), lambda q: F.when(F.array_max(q) < 2**31, q.cast("array<int>")))
        found = let(found, lambda p: F.when(p.isNotNull(), wide(p)))
    return F.when(upper.rlike(GRAMMAR) | (upper == ""), found)


def _all_carried(period: Column) -> Column:
    for i in range(6, 0, -1):
        period = let(period, _carried(i))
    return period


def _carried(i: int) -> Callable[[Column], Column]:
    """From slots to slots with what fills slot i moved up into the one before."""

    def step(p: Column) -> Column:
        slots = [F.get(p, F.lit(k)) for k in range(7)]
        slots[i - 1] = slots[i - 1] + F.floor(slots[i] / CARRY[i])
        slots[i] = slots[i] % CARRY[i]
        return F.array(*slots)

    return step


def period_seconds(period: Column) -> Column:
    """With years of 360 days and months of 30."""
    return sum((F.get(period, F.lit(i)).cast("long") * n for i, n in enumerate(SECONDS)), F.lit(0).cast("long"))


def period_words(period: Column) -> Column:
    """The slots above zero in words."""
    said = [
        F.when(F.get(period, F.lit(i)) == 1, F.lit(f"1 {w}")).when(F.get(period, F.lit(i)) > 1, F.concat(F.get(period, F.lit(i)).cast("string"), F.lit(f" {w}s")))
        for i, w in enumerate(WORDS)
    ]
    return F.concat_ws(" ", *said)


def add_period(ts: Column, period: Column, sign: int = 1, overflow: bool = True) -> Column:
    """ts moved by the slots one after another. With overflow, days that a month lacks run over after the year's and
    after the month's step; without, they are cut to the month's last day. Null where that is no timestamp any more."""

    def months(n: Column) -> Callable[[Column], Column]:
        def step(at: Column) -> Column:
            near = F.when(F.abs(n) <= MONTHS, n).cast("int")
            if not overflow:
                whole = F.add_months(at.cast("date"), near)
            else:
                whole = F.date_add(F.add_months(F.trunc(at.cast("date"), "MM"), near), F.dayofmonth(at) - 1)
            held = let(whole, lambda d: F.when(F.abs(F.year(d)) < MONTHS // 12, d).cast("timestamp"))
            return F.timestamp_micros(F.unix_micros(held) + F.unix_micros(at) - F.unix_micros(F.date_trunc("DAY", at)))

        return step

    def moved(p: Column) -> Column:
        slot = lambda i: F.get(p, F.lit(i)).cast("long") * sign
        at = let(let(ts, months(slot(0) * 12)), months(slot(1)))
        rest = sum((F.get(p, F.lit(i)).cast("long") * SECONDS[i] for i in range(2, 7)), F.lit(0).cast("long"))
        return F.timestamp_micros(F.try_add(F.unix_micros(at), F.try_multiply(rest, F.lit(sign * 1000000))))

    return let(period, moved)


def year_millis(year: Column) -> Column:
    """Milliseconds since 1970 of the first of January, UTC."""
    return F.unix_millis(F.make_timestamp(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")))


def parse_instant(text: Column) -> Column:
    """Timestamp of a date or date and time; null if it is none."""
    return F.try_to_timestamp(F.trim(text))
