"""Text and number formatting as Column expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_form(raw: Column) -> Column:
    """Lower case, letters A-Z and apostrophes only. Null stays null."""
    return F.regexp_replace(F.lower(raw), "[^A-Za-z']+", "")


def name_key(form: Column) -> Column:
    """Lookup key: what is left of a name form without non-word characters, carets, digits and white space."""
    return F.regexp_replace(form, r"[\W^0-9\s]+", "")


def title_case(text: Column) -> Column:
    """First letter of every run of letters in capitals, the others small; any other character ends a run."""
    return F.array_join(F.transform(F.split(F.lower(text), r"(?<=[^\p{L}])"), F.initcap), "")


def char_at(text: Column, position: int) -> Column:
    """One character, counted from 1; empty beyond the end."""
    return F.substring(text, position, 1)


def thousands(number: Column) -> Column:
    """A whole number with commas between groups of three digits."""
    return F.format_number(number, 0)


def to_fixed2(number: Column) -> Column:
    """Two decimals of the exact binary value, ties away from zero. Null stays null."""
    value = number.cast("double")
    tie = F.abs(value * 8) % 2 == 1
    return F.when(tie, F.format_string("%.2f", value)).otherwise(F.regexp_replace(F.format_number(value, 2), ",", ""))


def not_in(value: Column, excluded: list) -> Column:
    """NOT IN that keeps rows whose value is null."""
    return ~F.coalesce(value.isin(excluded), F.lit(False))


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(low, value), high)


def half_up(number: Column) -> Column:
    """Rounded to a whole number, halves towards plus infinity."""
    return F.floor(number + 0.5)


def snap_to_step(value: Column, low: Column, high: Column, step: float) -> Column:
    """Clamped, rounded to whole steps above low, then to two decimals."""
    steps = half_up((clamp(value, low, high) - low) / step) * step + low
    return half_up(steps * 100) / 100


def number_or_text(text: Column) -> Column:
    """Two decimals of what is a number; any other text, NaN too, stays as it is."""
    number = text.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), text).otherwise(to_fixed2(number))


def rescale(value: Column, low: Column, high: Column, size: Column) -> Column:
    """Position on a scale of `size` for a value between low and high; null on a scale without length."""
    return F.try_divide(value - low, F.try_divide(high - low, size))


def percent_floor(part: Column, whole: Column) -> Column:
    """Whole percents, rounded down; null of nothing."""
    return F.floor(F.try_divide(part, whole) * 100)


def frames_per_second(milliseconds: Column) -> Column:
    """To one decimal; null for no time."""
    return half_up(F.try_divide(F.lit(10000), milliseconds)) / 10
