"""Arrays of instants, stepped and as text, whole batches at a time."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, TimestampType

#: Instants of a row that are written by batches, at most, so that a batch of 10,000 rows stays within 2 GB; instants
#: written at a time; and days from year 1 to 9999, in which a year has four digits.
LONG, SLICE, FIRST, LAST = 10_000, 500_000, -719_162, 2_932_896


@cache
def _clock() -> np.ndarray:
    """The text of every second of a day."""
    return np.array([f"{s // 3600:02}:{s // 60 % 60:02}:{s % 60:02}" for s in range(86_400)], "S8")


def _written(micros: np.ndarray) -> bytes:
    """Instants of the years 1 to 9999 as text, each followed by a comma."""
    day, second = np.divmod(micros // 1_000_000, 86_400)
    low, high = int(day.min()), int(day.max())
    if high - low > max(len(day), 100_000):
        known, day = np.unique(day, return_inverse=True)
    else:
        known, day = np.arange(low, high + 1), day - low
    dates = np.datetime_as_string(known.astype("datetime64[D]")).astype("S10")
    out = np.empty(len(day), [("date", "S10"), ("space", "S1"), ("time", "S8"), ("comma", "S1")])
    out["date"], out["space"], out["time"], out["comma"] = dates.take(day), b" ", _clock().take(second), b","
    return out.tobytes()


@F.arrow_udf(StringType())
def _texts(lists: pa.Array) -> pa.Array:
    """Null for what is null, too long, holds a null or leaves the years 1 to 9999."""
    micros = lists.flatten().cast(pa.int64())
    empty = np.asarray(micros.is_null())
    values = np.asarray(micros.fill_null(0))
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    bad = empty | (values < FIRST * 86_400_000_000) | (values >= (LAST + 1) * 86_400_000_000)
    fit = np.asarray(lists.is_valid()) & (sizes <= LONG)
    if bad.any():
        odd = np.concatenate([[0], np.cumsum(bad, dtype=np.int64)])
        fit &= odd[ends[1:]] == odd[ends[:-1]]
    # Of a row's text all but the last comma, straight to its place: texts are the largest thing here and held once.
    places = np.concatenate([[0], np.cumsum(np.where(fit, np.maximum(sizes * 20 - 1, 0), 0), dtype=np.int64)])
    text = bytearray(int(places[-1]))
    row = 0
    while row < len(sizes):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + SLICE, "right")) - 1)
        part = values[ends[row] : ends[end]]
        raw = memoryview(_written(np.where(bad[ends[row] : ends[end]], 0, part)) if len(part) else b"")
        at, to = ((ends[row:end] - ends[row]) * 20).tolist(), places[row : end + 1].tolist()
        for a, b, c in zip(at, to, to[1:], strict=False):
            text[b:c] = raw[a : a + c - b]
        row = end
    parts = [pa.array(fit).buffers()[1], pa.array(places, pa.int32()).buffers()[1], pa.py_buffer(text)]
    return pa.Array.from_buffers(pa.string(), len(sizes), parts)


def _stepped_batch(starts: pa.Array, ends: pa.Array, steps: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
    """Null where one of starts, ends and steps (microseconds) is."""
    given = np.logical_and.reduce([np.asarray(x.is_valid()) for x in (starts, ends, steps)])
    start, end = (np.asarray(x.cast(pa.int64()).fill_null(0)) for x in (starts, ends))
    step = np.asarray(steps.fill_null(1))
    lows, highs = np.asarray(first.fill_null(0)), np.asarray(last.fill_null(1439))
    counts = np.where(given, np.maximum(-((start - end) // step), 0), 0)
    until = np.concatenate([[0], np.cumsum(counts)])
    parts, sizes = [np.zeros(0, np.int64)], np.zeros(len(given), np.int64)
    row = 0
    while row < len(given):
        to = max(row + 1, int(np.searchsorted(until, until[row] + SLICE, "right")) - 1)
        some = slice(row, to)
        # One place more in each row, for end itself.
        n = counts[some] + given[some]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        made = np.repeat(start[some], n) + at * np.repeat(step[some], n)
        closing = at == np.repeat(counts[some], n)
        minute = made // 60_000_000 % 1440
        kept = closing | ((minute >= np.repeat(lows[some], n)) & (minute <= np.repeat(highs[some], n)))
        made[closing] = end[some][given[some]]
        parts.append(made[kept])
        sizes[some] = np.bincount(np.repeat(np.arange(to - row), n)[kept], minlength=to - row)
        row = to
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    values = pa.array(np.concatenate(parts), pa.int64()).cast(starts.type)
    return pa.ListArray.from_arrays(offsets, values, mask=pa.array(~given))


#: Not deterministic to Spark, so that a column of these arrays is made once and not again in every use of it.
_stepped = F.arrow_udf(_stepped_batch, ArrayType(TimestampType())).asNondeterministic()


def stepped(start: Column, end: Column, step: Column, minutes: tuple[int, int] | None = None) -> Column:
    """Instants from start in steps of so many microseconds, before end, then end itself; null if one of the three is.

    minutes keeps those within these minutes of the day, UTC, both included, but not end. A row may have LONG steps at
    most, all of a positive length.
    """
    first, last = (F.lit(m).cast("long") for m in minutes or (None, None))
    return _stepped(start, end, step, first, last)


def joined_instants(array: Column) -> Column:
    """The instants of an array as `yyyy-MM-dd HH:mm:ss`, joined by commas, in the session's time zone.

    date_format takes about a microsecond for each. Where the zone is UTC batches are written at once; rows that these
    leave out (see _texts), and all in other zones, go by date_format.
    """
    plain = F.array_join(F.transform(array, lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")), ",")
    return F.coalesce(_texts(F.when(F.current_timezone() == "UTC", array)), plain)
