"""The dossier: one row of statistics for each name, each slot cut down to one row a name before it is joined."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import char_at, title_case, to_fixed2

#: The slots in order, and what stands for missing data.
SLOTS = (
    "forenames_hist_f", "forenames_hist_m", "forenames_cont_f", "forenames_cont_m", "parishes", "areas", "oac", "loac",
    "iuc", "ahah", "imd", "bbs", "eee", "imd_std",
)
NO_FORENAMES, NO_DATA, NO_CODE = "No forenames found", "No data", "99"
#: The year axis.
YEARS = (1851, 1861, 1881, 1891, 1901, 1911, *range(1997, 2017))
EXCLUDED_YEARS = (0, 1997, *range(1999, 2006), *range(2007, 2016))


def year_vector(freq: DataFrame, axis: list[int], strict: bool = False) -> DataFrame:
    """(surname, freqs): counts along the axis, 0 where there is none or it is null, the greatest of repeated years.

    Years off the axis are left out; with strict they raise an error.
    """
    year = F.col("year")
    if strict:
        year = F.when(year.isin(axis), year).otherwise(F.raise_error(F.concat(F.lit("year off the axis: "), year.cast("string"))).cast("int"))
    at = [F.coalesce(F.max(F.when(year == y, F.col("freq"))), F.lit(0)) for y in axis]
    return freq.groupBy("surname").agg(F.array(*at).alias("freqs"))


def split_vector(freqs: Column, first: int) -> tuple[Column, Column]:
    """The first positions of a vector, and the rest."""
    return F.slice(freqs, 1, first), F.slice(freqs, F.lit(first + 1), F.greatest(F.size(freqs) - first, F.lit(0)))


def forenames(names: DataFrame) -> DataFrame:
    """(surname, female, male): sorted forenames. A list is empty, not missing, if there are names of the other sex."""
    of = lambda sex: F.sort_array(F.collect_list(F.when(F.col("sex") == sex, F.col("forename"))))
    return names.groupBy("surname").agg(of("F").alias("female"), of("M").alias("male"))


def _least(rows: DataFrame, most: int, *columns: str) -> DataFrame:
    """The first `most` rows of each name in order of these columns: cut down before the shuffle and after it."""
    place = F.row_number().over(Window.partitionBy("surname").orderBy(*columns))
    return rows.select("surname", *columns, place.alias("_place")).filter(F.col("_place") <= most).drop("_place")


def top_places(places: DataFrame, most: int = 5) -> DataFrame:
    """(surname, places): up to `most` distinct pairs of district, in title case, and parish, in alphabetical order."""
    pairs = places.select("surname", title_case(F.col("regcnty")).alias("district"), "parish").distinct()
    listed = F.sort_array(F.collect_list(F.struct("district", "parish")))
    return _least(pairs, most, "district", "parish").groupBy("surname").agg(listed.alias("places"))


def first_match(dimension: DataFrame, key: str) -> DataFrame:
    """One row for each key of a lookup table: the least by its other columns."""
    others = [c for c in dimension.columns if c != key]
    return dimension.groupBy(key).agg(F.min(F.struct(*others)).alias("_x")).select(key, *[F.col(f"_x.{c}").alias(c) for c in others])


def areas(rows: DataFrame, lookup: DataFrame, most: int = 5) -> DataFrame:
    """(surname, areas, areas_missed): up to `most` pairs of district and area, repeats included, by area code; missed
    counts codes that the lookup lacks, beyond the first ones too."""
    met = rows.join(first_match(lookup, "msoa11cd"), "msoa11cd", "left")
    fields = ("msoa11cd", "ladnm", "msoa11nm")
    top = _least(met, most, *fields).select("surname", F.struct(*fields).alias("area"), F.lit(0).cast("long").alias("missed"))
    # The areas' rows are few by now; a row without an area carries each name's count.
    missed = met.groupBy("surname").agg(F.count_if(F.col("ladnm").isNull()).alias("missed"))
    both = top.unionByName(missed, allowMissingColumns=True).groupBy("surname")
    pairs = F.transform(F.sort_array(F.collect_list("area")), lambda x: F.struct(x["ladnm"].alias("ladnm"), x["msoa11nm"].alias("msoa11nm")))
    return both.agg(pairs.alias("areas"), F.sum("missed").alias("areas_missed"))


def first_row(facts: DataFrame, *columns: str, kind: str | None = None) -> DataFrame:
    """One row for each name, the least by its columns; of the rows of one type only, if it is given."""
    rows = facts.filter(F.col("type") == kind) if kind else facts
    return rows.groupBy("surname").agg(F.min(F.struct(*columns)).alias("_x")).select("surname", *[F.col(f"_x.{c}").alias(c) for c in columns])


def classification(facts: DataFrame, groups: DataFrame, texts: DataFrame, code: str, name: str) -> DataFrame:
    """(surname, supergroup, group, supergroup_text, group_text, code, missed) of each name's modal group.

    The supergroup's code is the first character of the group's. missed counts lookups without a match.
    """
    modal = first_row(facts, code, name, kind="mode").select("surname", F.col(code).alias("code"), F.col(name).alias("group"))
    text = first_match(texts.select("code", F.col("desc").alias("text")), "code")
    joined = (
        modal.join(first_match(groups, "groupcd").select(F.col("groupcd").alias("code"), F.col("supergroupnm").alias("supergroup")), "code", "left")
        .withColumn("_top", char_at(F.col("code"), 1))
        .join(text.select(F.col("code").alias("_top"), F.col("text").alias("supergroup_text")), "_top", "left")
        .join(text.select("code", F.col("text").alias("group_text")), "code", "left")
    )
    missed = sum((F.col(c).isNull().cast("int") for c in ("supergroup", "supergroup_text", "group_text")), F.lit(0))
    return joined.select("surname", "supergroup", "group", "supergroup_text", "group_text", "code", missed.alias("missed"))


def described(facts: DataFrame, code: str, name: str, lookup: DataFrame, key: str, text: str) -> DataFrame:
    """(surname, code, name, text, missed): a whole-number code looked up among text codes, compared as text."""
    row = first_row(facts, code, name).withColumn("_key", F.col(code).cast("string"))
    met = row.join(first_match(lookup, key).withColumnRenamed(key, "_key"), "_key", "left")
    return met.select("surname", F.col(code).alias("code"), F.col(name).alias("name"), F.col(text).alias("text"), F.col(text).isNull().cast("int").alias("missed"))


def modal_pick(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): each key's most frequent value, the least of equals. Counted before anything is ranked."""
    counted = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    best = counted.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), value)).alias("_x"))
    return best.select(key, F.col(f"_x.{value}").alias(value), (-F.col("_x.m")).alias("n"))


def top_k(rows: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """(key, value, n, place): each key's k most frequent values, equals in order of value."""
    counted = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))
    return counted.withColumn("place", place).filter(F.col("place") <= k)


def _pair(slot: Column, *fields: str) -> Column:
    return F.array(*[slot[f] for f in fields])


def gathered(parts: dict[str, DataFrame]) -> DataFrame:
    """(surname, one struct for each part): all parts' rows in one table, then one aggregation by name.

    A part has one row a name at most, with surname first; where it has none for a name its struct is null.
    """
    tagged = [df.select("surname", F.struct(*[c for c in df.columns if c != "surname"]).alias(tag)) for tag, df in parts.items()]
    whole = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return whole.groupBy("surname").agg(*[F.any_value(tag, True).alias(tag) for tag in parts])


def assemble(probes: DataFrame, t: dict[str, DataFrame], axis: tuple[int, ...] = YEARS, excluded: tuple[int, ...] = EXCLUDED_YEARS) -> DataFrame:
    """One row a probe: input, surname, status, display, years, freqs and a struct `stats` of all slots.

    Slots are null unless the probe is found. A found probe with a lookup that has no match, a year off the axis or a
    place without district gets the status error, as the whole answer would fail. All facts are gathered by name in one
    pass and joined with the probes once.
    """
    from tallyloom.operators.membership import kept_years, status_of

    known = t["names_kde"].select("surname").union(t["names_all"].select("surname")).distinct()
    off = t["names_frq"].groupBy("surname").agg(F.bool_or(~F.coalesce(F.col("year").isin(list(axis)), F.lit(False))).alias("off"))
    unplaced = t["names_loc_hist"].groupBy("surname").agg(F.bool_or(F.col("regcnty").isNull()).alias("unplaced"))
    oac = {k: classification(t[f"names_{k}21"], t[f"lookup_{k}21"], t[f"lookup_{k}21_desc"], f"{k}cd", f"{k}nm") for k in ("oac", "loac")}
    parts = {
        "known": known.withColumn("known", F.lit(True)), "kept": kept_years(t["names_kde"], list(excluded)),
        "vector": year_vector(t["names_frq"], list(axis)), "off": off, "unplaced": unplaced,
        "hist": forenames(t["names_fns_hist"]), "cont": forenames(t["names_fns_cont"]), "parish": top_places(t["names_loc_hist"]),
        "area": areas(t["names_loc_cont"], t["lookup_loc_cont"]), **oac,
        "iuc": described(t["names_iuc"], "iuccd", "iucnm", t["lookup_iuc"], "iuccd", "iucdesc"),
        "ahah": first_row(t["names_ahah22"], "ahahdec", kind="mode"), "imd": first_row(t["names_imd"], "imddec", kind="mode"),
        "bbs": first_row(t["names_bbs"], "bbsdec", "bbs"), "eee": first_row(t["names_eee"], "code", "eee"), "std": first_row(t["names_imd_std"], "avg", "sd"),
    }
    rows = probes.join(gathered(parts), "surname", "left").withColumn("years", F.col("kept.years"))
    rows = rows.withColumn("status", status_of(F.col("form"), F.col("years"), F.col("known.known")))
    names = lambda c: F.coalesce(F.col(c), F.array(F.lit(NO_FORENAMES)))
    lit = lambda *v: F.array(*[F.lit(x) for x in v])
    pairs = lambda c, a, b: F.coalesce(F.transform(c, lambda x: F.array(x[a], x[b])), F.array(lit(NO_DATA, NO_DATA)))
    group = lambda c: F.when(F.col(c).isNull(), lit(NO_DATA, NO_DATA, "", "", NO_CODE)).otherwise(
        _pair(F.col(c), "supergroup", "group", "supergroup_text", "group_text", "code")
    )
    coded = lambda code, text: F.when(F.col(code).isNull(), lit(NO_CODE, NO_DATA)).otherwise(F.array(F.col(code).cast("string"), F.col(text)))
    slots = (
        names("hist.female"), names("hist.male"), names("cont.female"), names("cont.male"), pairs("parish.places", "district", "parish"),
        pairs("area.areas", "ladnm", "msoa11nm"), group("oac"), group("loac"),
        F.when(F.col("iuc").isNull(), lit(NO_CODE, NO_DATA, "")).otherwise(F.array(F.col("iuc.code").cast("string"), F.col("iuc.name"), F.col("iuc.text"))),
        F.col("ahah.ahahdec"), F.col("imd.imddec"), coded("bbs.bbsdec", "bbs.bbs"), coded("eee.code", "eee.eee"),
        F.when(F.col("std.avg").isNull() & F.col("std.sd").isNull(), lit(NO_DATA, NO_DATA)).otherwise(F.array(to_fixed2(F.col("std.avg")), to_fixed2(F.col("std.sd")))),
    )
    missed = [F.coalesce(c, F.lit(0)) > 0 for c in (F.col("area.areas_missed"), F.col("oac.missed"), F.col("loac.missed"), F.col("iuc.missed"))]
    broken = F.coalesce(F.col("off.off"), F.lit(False)) | F.coalesce(F.col("unplaced.unplaced"), F.lit(False))
    for m in missed:
        broken = broken | m
    found = F.col("status") == "found"
    status = F.when(found & broken, F.lit("error")).otherwise(F.col("status"))
    shown = status == "found"
    zeros = F.array_repeat(F.lit(0), len(axis))
    return rows.select(
        "input", "surname", status.alias("status"),
        F.when(shown, title_case(F.col("form"))).otherwise(status).alias("display"),
        F.when(shown, F.col("years")).alias("years"),
        F.when(shown, F.coalesce(F.col("vector.freqs"), zeros)).alias("freqs"),
        F.when(shown, F.struct(*[s.alias(n) for s, n in zip(slots, SLOTS, strict=True)])).alias("stats"),
    )


def documents(dossiers: DataFrame) -> DataFrame:
    """(input, document): the answer as JSON text; unless found, only the status in place of the name."""
    stats = F.col("stats")
    decile = lambda c: F.coalesce(F.to_json(F.array(stats[c])).substr(F.lit(2), F.length(F.to_json(F.array(stats[c]))) - 2), F.lit(f'["{NO_DATA}"]'))
    entry = lambda n: F.when(stats[n].isNull(), F.lit(f'["{NO_DATA}"]')).otherwise(decile(n)) if n in ("ahah", "imd") else F.to_json(stats[n])
    listed = F.concat(F.lit("["), F.concat_ws(",", *[entry(n) for n in SLOTS]), F.lit("]"))
    head = F.to_json(F.struct(F.col("display").alias("surname"), "years", "freqs"))
    whole = F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"stats":'), listed, F.lit("}"))
    return dossiers.select("input", F.when(F.col("status") == "found", whole).otherwise(F.to_json(F.struct(F.col("display").alias("surname")))).alias("document"))
