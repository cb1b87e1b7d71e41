"""Classifying probes: empty, none, db (known, but without years to show) or found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import name_form, name_key, not_in


def prepared(probes: DataFrame, column: str = "input") -> DataFrame:
    """probes with `form` (keeps apostrophes, decides whether a probe is empty) and `surname` (the lookup key)."""
    return probes.withColumn("form", name_form(F.col(column))).withColumn("surname", name_key(F.col("form")))


def kept_years(kde: DataFrame, excluded: list[int]) -> DataFrame:
    """(surname, years): each name's years but the excluded ones, ascending; null years stay and come first."""
    kept = kde.filter(not_in(F.col("year"), excluded)).groupBy("surname")
    held = F.sort_array(F.collect_list(F.struct("year")))
    return kept.agg(F.transform(held, lambda x: x["year"]).alias("years"))


def status_of(form: Column, years: Column, known: Column) -> Column:
    """empty, found, db or none; a name all of whose years are excluded is db, like one that only the list of names holds."""
    filled = F.when(F.length(form) == 0, "empty").when(F.size(years) > 0, "found").when(known, "db").otherwise("none")
    return F.when(form.isNull(), "empty").otherwise(filled)


def classify(probes: DataFrame, kde: DataFrame, names: DataFrame, excluded: list[int]) -> DataFrame:
    """Prepared probes with `years` and `status`. Every side is cut down to one row a name first, so nothing fans out."""
    years = kept_years(kde, excluded)
    known = kde.select("surname").union(names.select("surname")).distinct().withColumn("known", F.lit(True))
    joined = probes.join(years, "surname", "left").join(known, "surname", "left")
    return joined.withColumn("status", status_of(F.col("form"), F.col("years"), F.col("known"))).drop("known")
