"""Axes, layers and dossiers on small cases with known answers."""

import gzip
import json
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import periods, stamps
from tallyloom.operators import bitaxis, codes, dossier, layers, membership, ranking, scan, timeline
from tallyloom.sources import schemas, tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def days(stamps):
    return [f"{s:%m-%d %H}" for s in stamps]


def at(text):
    return F.lit(text).cast("timestamp")


def test_ranges_and_expressions(spark):
    ranged = lambda a, b, p, *v: one(spark, timeline.explode_range(at(a), at(b), periods.parse_period(F.lit(p)), *v))
    assert days(ranged("2020-01-01", "2020-01-04 12:00", "P1D")) == ["01-01 00", "01-02 00", "01-03 00", "01-04 00", "01-04 12"]
    assert days(ranged("2020-01-01", "2020-01-01", "P1D")) == ["01-01 00"]
    assert days(ranged("2020-01-31", "2020-04-30", "P1M")) == ["01-31 00", "03-02 00", "04-02 00", "04-30 00"]
    assert days(ranged("2020-01-01", "2020-01-02", "PT9H", ("08:00", "10:00"))) == ["01-01 09", "01-02 00"]
    assert one(spark, timeline.explode_range(at("2020-01-01"), at("2020-01-02"), periods.parse_period(F.lit("PT0S")))) is None
    with pytest.raises(Exception, match="period of zero"):
        one(spark, timeline.explode_range(at("2020-01-01"), at("2020-01-02"), periods.parse_period(F.lit("PT0S")), strict=True))
    times = one(spark, timeline.parse_times(F.lit("2003-01-01,2001-01-01,junk,2001-01-01")))
    assert [t.year for t in times] == [2001, 2001, 2003]
    assert [t.year for t in one(spark, timeline.parse_times(F.lit("2001-01-01,junk/2020-01-02/P1D,2020-01-01/2020-01-03/P1X")))] == [2001]
    assert one(spark, timeline.parse_range(F.lit("2020-01-01/2020-01-03/P99999999999D"))) is None
    assert days(one(spark, timeline.parse_range(F.lit("2020-01-01/2020-01-03")))) == ["01-01 00", "01-02 00", "01-03 00"]
    options = lambda *v, **k: days(one(spark, timeline.axis_from_options(*[F.lit(x).cast("string") for x in v], **k)))
    assert options("2020-01-02,2020-01-01", "2021-01-01/P1D", None) == ["01-01 00", "01-02 00"]
    assert options(None, "2021-01-01/P2D", None) == ["01-01 00", "01-02 00", "01-03 00"]
    assert options("", "2021-01-01/P1D", "PT9H", valid=("08:00", "10:00")) == ["01-01 09", "01-02 00"] and options(None, None, None) == []
    interval = lambda s: one(spark, timeline.parse_interval(F.lit(s)))
    assert days(interval("P1D/2020-01-05")) == ["01-04 00", "01-05 00"]
    assert days(interval("2020-01-05/PT6H")) == ["01-05 00", "01-05 06"]
    with pytest.raises(Exception, match="not a time interval"):
        interval("2020-01-05")


def test_ranges_by_batches_equal_those_by_lambdas(spark):
    cases = [
        ("2020-01-01", "2020-03-01", "PT31H"), ("2020-01-01 17:30:59", "2020-01-09", "PT7H30M"), ("1899-12-30", "1900-01-03", "PT1H"),
        ("2020-01-01", "2020-01-01", "P1D"), ("2020-01-02", "2020-01-01", "P1D"), ("2020-01-31", "2020-06-30", "P1M"), ("2020-01-01", "2020-02-01", "PT0S"),
        ("2020-01-01", "2020-02-01", None), (None, "2020-01-03", "P1D"), ("2020-01-01", "2020-03-01", "PT5M"), ("1000-01-01", "2020-12-31", "P30DT1S"),
    ]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, b string, p string").repartition(2, "i")
    given = [F.col("a").cast("timestamp"), F.col("b").cast("timestamp"), periods.parse_period(F.col("p"))]
    for valid in (("06:00", "17:30"), ("08:15", "08:45")):
        found = rows.withColumn("x", timeline.explode_range_by_batches(*given, valid)).withColumn("y", timeline.explode_range(*given, valid)).collect()
        assert len(found) == len(cases) and all(r.x == r.y for r in found)
    step = F.when(F.col("i") < 6, 3_600_000_000).cast("long")
    made = {r.i: r.x for r in rows.select("i", stamps.stepped(given[0], given[1], step, (360, 1050)).alias("x")).collect()}
    assert len(made[3]) == 1 and len(made[2]) == 4 * 12 + 1 and made[6] is made[8] is None


def test_ranges_in_phase_stand_together(spark):
    starts = [(i, f"2020-01-{1 + i * 7 % 30:02}", "PT48H") for i in range(30)] + [(30, None, "PT48H"), (31, "2020-01-01", "P1M"), (32, "2020-01-01", "PT0S"), (33, "2020-01-01", None)]
    rows = spark.createDataFrame(starts, "i int, a string, p string").repartition(1)
    given = F.col("a").cast("timestamp"), periods.parse_period(F.col("p"))
    found = timeline.in_phase(rows, *given)
    assert found.columns == rows.columns and "Exchange range" not in found._jdf.queryExecution().toString()
    got = found.collect()
    assert sorted(r.i for r in got) == list(range(34)) and {r.i for r in got[:4]} == {30, 31, 32, 33}
    odd = [(datetime.fromisoformat(r.a) - datetime(1970, 1, 1)).days % 2 for r in got[4:]]
    assert odd == sorted(odd) and [r.a for r in got[4:19]] == sorted(r.a for r in got[4:19]) and [r.a for r in got[19:]] == sorted(r.a for r in got[19:])


def test_axis_algebra_is_bag_or_set(spark):
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "t int")
    a, b = [1, 1, 2, 5], [1, 1, 1, 2, 2, 3]
    merged = lambda mode, bag: sorted(r.t for r in timeline.merge_axes(frame(a), frame(b), mode, bag).collect())
    assert merged("union", True) == sorted((Counter(a) | Counter(b)).elements())
    assert merged("intersect", True) == sorted((Counter(a) & Counter(b)).elements())
    assert merged("union", False) == [1, 2, 3, 5] and merged("intersect", False) == [1, 2] and merged("replace", False) == [1, 2, 3]
    with pytest.raises(ValueError, match="unknown way"):
        merged("other", False)


def test_seek_and_cursor(spark):
    axis = F.array(*[F.lit(x) for x in (10, 20, 30)])
    assert [one(spark, timeline.seek(axis, F.lit(t))) for t in (5, 10, 25, 99)] == [10, 10, 20, 30]
    marks = spark.createDataFrame([("2020-01-02",), ("2020-03-01",)], "t string").select(F.col("t").cast("timestamp"))
    rows = spark.createDataFrame([(1, "2019-01-01"), (2, "2020-02-01"), (3, "2021-01-01"), (4, None)], "i int, x string").select("i", F.col("x").cast("timestamp"))
    got = {r.i: r.sought and f"{r.sought:%m-%d}" for r in timeline.seek_join(rows, "x", marks, "t").collect()}
    assert got == {1: "01-02", 2: "01-02", 3: "03-01", 4: None}
    axis = spark.createDataFrame([(k, t) for k in "ab" for t in (1, 2, 3)], "k string, t int")
    moved = lambda **k: {(r.k, r.t): r.moved for r in timeline.cursor(axis, "k", "t", **k).collect()}
    assert moved()["a", 3] == 3 and moved(loop=True)["a", 3] == 1 and moved(step=-1, loop=True)["b", 1] == 3
    assert moved(upper=1)["a", 2] == 2 and moved(step=-5, lower=1)["a", 3] == 2
    ready = axis.withColumn("ok", F.col("t") != 2)
    assert {r.t: r.ready_ahead for r in timeline.ready_ahead(ready, "k", "t", "ok", 2).collect()} == {1: 1, 2: 2, 3: 2}


def test_set_times_look_ahead_and_ranks(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k string, t timestamp")
    day = lambda d: datetime(2020, 1, d)
    old, new = frame([("a", day(1)), ("a", day(2))]), frame([("a", day(2)), ("a", day(4)), ("b", day(1)), ("b", day(3)), ("b", day(3))])
    got = lambda mode: sorted((r.k, r.t.day) for r in timeline.set_times(old, new, "k", "t", mode).collect())
    assert got("intersect") == [("a", 2), ("b", 1), ("b", 3)] and got("replace") == [("a", 2), ("a", 4), ("b", 1), ("b", 3)]
    assert got("union") == [("a", 1), ("a", 2), ("a", 4), ("b", 1), ("b", 3)] and got("extremes") == [("a", 2), ("a", 3), ("a", 4), ("b", 1), ("b", 2), ("b", 3)]
    axis = spark.createDataFrame([(k, t) for k, n in (("a", 5), ("b", 1)) for t in range(n)], "k string, t int")
    ahead = lambda *v, **k: {(r.k, r.t): r.ahead for r in timeline.lookahead(axis, "k", "t", *v, **k).collect()}
    assert ahead(3, step=2, loop=True)["a", 1] == [3, 0, 2] and ahead(9, step=2, loop=True)["a", 0] == [2, 4] and ahead(2, loop=True)["b", 0] == []
    assert ahead(4, step=-1)["a", 2] == [1, 0] and ahead(4, lower=1, upper=3)["a", 1] == [2, 3]
    ready = lambda *v, **k: {(r.k, r.t): r.ready_ahead for r in timeline.ready_ahead(axis.withColumn("ok", F.col("t") != 3), "k", "t", "ok", *v, **k).collect()}
    assert ready(3, step=2, loop=True)["a", 1] == 2 and ready(3, step=2)["a", 1] == 3 and ready(2, step=-1)["a", 4] == 1
    rng = random.Random(3)
    rows = spark.createDataFrame([(i, rng.choice([1.5, 2.0, 7.25, -3.0]) if i % 3 else rng.random()) for i in range(500)] + [(500, None)], "i int, v double")
    rows.createOrReplaceTempView("ranked_rows")
    want = {r.i: (r.p, r.n) for r in spark.sql("SELECT i, percent_rank() OVER (ORDER BY v) AS p, ntile(7) OVER (ORDER BY v, i) AS n FROM ranked_rows WHERE v IS NOT NULL").collect()}
    got = {r.i: (r.p, r.n) for r in ranking.tiled(ranking.percent_ranked(rows, "v", "p"), "v", "i", 7, "n").collect()}
    assert got.pop(500) == (None, None) and got == want
    few = ranking.tiled(ranking.percent_ranked(rows.limit(1), "v", "p"), "v", "i", 7, "n").first()
    assert (few.p, few.n) == (0, 1) and ranking.tiled(rows.limit(0), "v", "i", 7, "n").count() == 0


def test_documents_are_written_compressed(spark, tmp_path):
    docs = spark.createDataFrame([("a", '{"surname":"db"}'), ("b", '{"surname":"none"}')], "input string, document string")
    tables.write_documents(docs, str(tmp_path / "docs"))
    files = [*(tmp_path / "docs").glob("*.gz")]
    assert files and sorted(x for f in files for x in gzip.open(f, "rt").read().split()) == ['{"surname":"db"}', '{"surname":"none"}']


def test_layers(spark):
    assert [one(spark, layers.fill(F.lit(x))) for x in (0, 3, 9)] == ["#DCDCDC", "#2171b5", None]
    span = F.array(F.lit(10), F.lit(20))
    assert one(spark, layers.overlaps(span, F.lit(20), F.lit(30))) and not one(spark, layers.overlaps(span, F.lit(21), F.lit(30)))
    assert one(spark, layers.overlaps(F.array().cast("array<int>"), F.lit(1), F.lit(2)))
    times, points = F.array(*[F.lit(x) for x in (1, 2, 3, 4)]), F.array(*[F.lit(x) for x in "abcd"])
    assert one(spark, layers.track_slice(times, points, F.lit(1), F.lit(3))) == ["b", "c"]
    assert one(spark, layers.track_slice(times, points, F.lit(4), F.lit(9))) == list("abcd")


def test_masks_of_any_size(spark, monkeypatch):
    rows = spark.createDataFrame([(k, i, [2011] if k != "c" else [1851]) for k in "abc" for i in range(3)], "k string, feature int, years array<int>")
    mask = spark.range(50).select((-F.col("id") - 1).cast("int").alias("feature"))
    want = sorted([(k, i) for k in "abc" for i in range(3)] + [(k, -i - 1) for k in "ab" for i in range(50)])
    for most in (layers.MASK_ROWS, 7):
        monkeypatch.setattr(layers, "MASK_ROWS", most)
        got = layers.with_mask(rows, mask, "k", "years", 2011)
        assert sorted(map(tuple, got.collect())) == want
        assert "CartesianProduct" not in (plan := got._jdf.queryExecution().toString()) and "NestedLoop" not in plan
    assert layers.with_mask(rows, mask.limit(0), "k", "years", 2011).count() == 9 and layers.with_mask(rows.limit(0), mask, "k", "years", 2011).count() == 0


def test_only_the_first_places_of_a_name_are_gathered(spark):
    pairs = [("a", f"p{i:03}", f"d{i % 7}") for i in range(300)] * 2 + [("b", None, "x"), ("b", "p", None)]
    places = spark.createDataFrame(pairs, "surname string, parish string, regcnty string")
    top = dossier.top_places(places)
    got = {r.surname: [tuple(x) for x in r.places] for r in top.collect()}
    assert got == {"a": [("D0", f"p{i:03}") for i in range(0, 35, 7)], "b": [(None, "p"), ("X", None)]}
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()
    rows = spark.createDataFrame([("a", f"E{i % 40:02}") for i in range(400)] + [("b", "E99")], "surname string, msoa11cd string")
    lookup = spark.createDataFrame([(f"E{i:02}", f"A{i}", f"T{i}") for i in range(30)], "msoa11cd string, msoa11nm string, ladnm string")
    met = {r.surname: ([x.msoa11nm for x in r.areas], r.areas_missed) for r in dossier.areas(rows, lookup).collect()}
    assert met == {"a": (["A0"] * 5, 100), "b": ([None], 1)}
    assert dossier.areas(rows.limit(0), lookup).count() == 0 and dossier.top_places(places.limit(0)).count() == 0


def test_trailing_window_keeps_columns(spark):
    rows = spark.sql("SELECT 'a' AS k, timestamp_seconds(id) AS t, id AS _us FROM range(5) UNION ALL SELECT 'a', NULL, 9")
    got = timeline.trailing_count(rows, "k", "t", 2)
    assert {r._us: r.trailing for r in got.collect()} == {0: 1, 1: 2, 2: 3, 3: 3, 4: 3, 9: None} and got.columns == ["k", "t", "_us", "trailing"]


def test_layer_files_are_pruned(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"level": 1, "time": None}, "geometry": {"type": "Polygon", "coordinates": "[[0,1]]"}}
    lines = [json.dumps({"surname": s, "year": y, "type": "FeatureCollection", "features": [feature]}) for s in ("oneil", "smith") for y in (1851, 1911)]
    rows = spark.createDataFrame([(x,) for x in lines], "v string").select(F.from_json("v", f"surname string, year int, {schemas.FEATURES}").alias("x")).select("x.*")
    tables.write_layers(rows, str(tmp_path / "layers"))
    read = tables.read_layers(spark, str(tmp_path / "layers"), "oneil", [1911])
    stamped = read.select(layers.stamped(F.col("features"), F.lit(5).cast("long"), F.lit(0)).alias("f")).first().f
    assert read.count() == 1 and stamped[0].properties.time == 5 and stamped[0].properties.level == 0
    assert "PartitionFilters: [isnotnull(prefix" in read._jdf.queryExecution().toString()


ROWS = {
    "names_all": [("oneil",), ("smith",), ("rare",), ("onlyx",)],
    "names_kde": [("oneil", y, 120) for y in (1851, 1911, 1997, 1998, 2016)] + [("smith", 1881, 500), ("onlyx", 1997, 101), ("onlyx", 0, 100), ("bad", 1851, 1)],
    "names_frq": [("oneil", 1851, 120), ("oneil", 1911, 150), ("oneil", 2016, 1400), ("smith", 1881, 500), ("smith", 1881, None)],
    "names_fns_hist": [("oneil", "mary", "F"), ("oneil", "john", "M"), ("oneil", "anne", "F"), ("smith", "peter", "M")],
    "names_loc_hist": [("oneil", "KING'S LYNN", "North"), ("oneil", "king's lynn", "North"), ("oneil", "STOKE-ON-TRENT", "West")],
    "names_loc_cont": [("oneil", "E02"), ("oneil", "E01"), ("bad", "E77")],
    "lookup_loc_cont": [("E01", "Area One", "Town A"), ("E02", "Area Two", "Town B")],
    "names_oac21": [("oneil", "1a", "Group A", "mode"), ("oneil", "2b", "Group B", "other")],
    "lookup_oac21": [("Super One", "1a")],
    "lookup_oac21_desc": [("1", "super text"), ("1a", "group text")],
    "names_iuc": [("oneil", 4, "Users")],
    "lookup_iuc": [("4", "iuc text"), ("x", "junk")],
    "names_imd": [("oneil", 7, "mode")],
    "names_imd_std": [("oneil", 1.005, 0.125)],
    "names_bbs": [("oneil", "30 Mbit/s", 5)],
    "names_eee": [("oneil", 2, "Group Two")],
}


def test_dossiers(spark):
    t = {n: spark.createDataFrame(ROWS.get(n, []), kind) for n, kind in (schemas.FACTS | schemas.LOOKUPS).items()}
    inputs = ["O'Neil", " SMITH 2", "Rare", "onlyx", "zzz", "'", "12 3", "bad", None]
    probes = membership.prepared(spark.createDataFrame([(x,) for x in inputs], "input string"))
    rows = dossier.assemble(probes, t)
    got = {r.input: r for r in rows.collect()}
    assert [got[x].status for x in inputs] == ["found", "found", "db", "db", "none", "none", "empty", "error", "empty"]
    o = got["O'Neil"]
    assert (o.display, o.years) == ("O'Neil", [1851, 1911, 1998, 2016])
    assert len(o.freqs) == 26 and (o.freqs[0], o.freqs[5], o.freqs[25], sum(o.freqs)) == (120, 150, 1400, 1670)
    s = o.stats
    assert (s.forenames_hist_f, s.forenames_hist_m, s.forenames_cont_f) == (["anne", "mary"], ["john"], ["No forenames found"])
    assert s.parishes == [["King'S Lynn", "North"], ["Stoke-On-Trent", "West"]]
    assert s.areas == [["Town A", "Area One"], ["Town B", "Area Two"]]
    assert s.oac == ["Super One", "Group A", "super text", "group text", "1a"] and s.loac == ["No data", "No data", "", "", "99"]
    assert (s.iuc, s.ahah, s.imd, s.bbs, s.eee, s.imd_std) == (["4", "Users", "iuc text"], None, 7, ["5", "30 Mbit/s"], ["2", "Group Two"], ["1.00", "0.13"])
    assert got[" SMITH 2"].stats.forenames_hist_f == [] and got[" SMITH 2"].stats.forenames_hist_m == ["peter"]
    docs = {r.input: json.loads(r.document) for r in dossier.documents(rows).collect()}
    assert docs["Rare"] == {"surname": "db"} and docs["bad"] == {"surname": "error"}
    assert len(docs["O'Neil"]["stats"]) == 14 and docs["O'Neil"]["stats"][9:11] == [["No data"], 7]
    assert docs["O'Neil"]["years"] == [1851, 1911, 1998, 2016]


def test_limited_gathers_no_key_in_one_row(spark):
    axis = spark.sql("SELECT CASE WHEN id < 90 THEN 'a' WHEN id < 95 THEN 'b' END AS k, timestamp_seconds(id) AS t FROM range(100) UNION ALL SELECT 'a', NULL")
    at = lambda s: F.timestamp_seconds(F.lit(s))
    got = timeline.limited(axis, "k", "t", at(10), at(92))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "Window" not in plan
    want = [("a", i) for i in range(10, 90)] + [("b", i) for i in range(90, 93)] + [(None, 95)]
    assert sorted(((r.k, int(r.s)) for r in got.select("k", F.unix_seconds("t").alias("s")).collect()), key=str) == sorted(want, key=str)
    assert timeline.limited(axis, "k", "t", F.lit(None).cast("timestamp"), at(50)).count() == 0


def test_one_bad_text_touches_its_own_row(spark):
    texts = {
        "2000-01-05,2000-01-01/2000-01-03/P999999999Y": ["01-01 00", "01-03 00", "01-05 00"], "2000-01-05,2000-01-01/2000-01-03/P0D": ["01-05 00"],
        "2000-01-05,1700-01-01/2500-01-01/PT1S": ["01-05 00"], "2000-01-01/2000-01-03/P2147483647DT24H": ["01-01 00", "01-03 00"], "2000-01-01/2000-01-03/P1D": ["01-01 00", "01-02 00", "01-03 00"],
        "2000-01-01/2000-01-02/P2147483647Y2147483647M2147483647W2147483647D": [], "": [],
    }
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", timeline.parse_times(F.col("x")).alias("t")).collect()
    assert {r.x: days(r.t) for r in rows} == texts
    moved = lambda p, **k: one(spark, periods.add_period(at("2000-01-31"), periods.parse_period(F.lit(p)), **k))
    assert all(moved(f"P2147483647{u}", sign=s, overflow=o) is None for u in "YM" for s in (1, -1) for o in (True, False))
    assert moved("P2147483647W") is None and moved("P2147483647W", sign=-1) is None
    assert f"{moved('PT2147483647S'):%Y-%m}" == "2068-02"
    assert sum(x * n for x, n in zip(one(spark, periods.parse_period(F.lit("P2147483647DT24H"), carry=True)), (336, 28, 7, 1), strict=False)) == 2**31
    assert one(spark, periods.parse_period(F.lit("P2147483647YT2147483647H2147483647M"), carry=True)) is None


HOT = "SELECT CASE WHEN id % 10 = 0 THEN concat('k', id % 7) WHEN id % 10 < 9 THEN 'hot' END AS k, timestamp_seconds((id * 7919) % 5000 * 3600) AS t, id AS i, id AS at, id AS stretch, id AS key, id AS row FROM range(6000)"


def test_scans_of_a_hot_key_equal_windows(spark):
    """Nine tenths of the rows have one key or none; cut into stretches they give what a window by key gives."""
    rows = spark.sql(f"{HOT} UNION ALL SELECT 'hot', NULL, -1, 0, 0, 0, 0")
    rows.createOrReplaceTempView("hot_rows")
    plain = spark.sql("SELECT i, count(*) OVER (PARTITION BY k ORDER BY t RANGE BETWEEN INTERVAL 40 DAYS PRECEDING AND CURRENT ROW) AS n, count(*) OVER (PARTITION BY k ORDER BY t) AS m FROM hot_rows WHERE t IS NOT NULL").collect()
    back = F.timestamp_micros(F.unix_micros("t") - 40 * 86400 * 1000000)
    for size in (scan.STRETCH, 150):
        got = {r.i: r.n for r in scan.trailing(rows, "k", "t", back, "n", size).collect()}
        assert got == {r.i: r.n for r in plain} | {-1: None}
        got = scan.trailing(rows, "k", "t", F.lit(None).cast("timestamp"), "n", size)
        assert {r.i: r.n for r in got.collect()} == {r.i: r.m for r in plain} | {-1: None} and got.columns == [*rows.columns, "n"]
        placed = scan.positions(rows.filter("i >= 0").select("k", "t", "i", "at", "stretch").withColumn("u", F.struct("t", "i")), "k", "t", size).collect()
        by_key = {k: sorted((r.t, r["index"]) for r in placed if r.k == k) for k in {r.k for r in placed}}
        assert all([i for _, i in sorted(v, key=lambda x: x[1])] == list(range(len(v))) and [t for t, _ in sorted(v, key=lambda x: x[1])] == sorted(t for t, _ in v) for v in by_key.values())
        assert all(r.last == len(by_key[r.k]) - 1 for r in placed)
    assert "hot" in {r.hot for r in scan.cuts(scan.packed(rows, "k", "t"), 150).collect()} and scan.cuts(scan.packed(rows, "k", "t")) is None


def test_cuts_that_come_out_otherwise_each_time_change_no_scan(spark):
    """As those of a sketch do, whose parts arrive in any order."""
    rows = spark.sql("SELECT 'hot' AS key, id AS at, id AS by, id AS i FROM range(4000)")
    anew = F.udf(lambda: sorted(random.SystemRandom().sample(range(4000), 20)), "array<bigint>").asNondeterministic()
    limits = spark.sql("SELECT 'hot' AS hot").withColumn("cuts", anew())
    for _ in range(2):
        got = scan.scanned(rows, ["by"], {"n": (F.count, F.lit(1)), "most": (F.max, F.col("at"))}, {"first": (F.min, F.col("at"))}, known=limits).collect()
        assert all(r.n == r.i + 1 and r.most == r.i and r.first == 0 for r in got) and len(got) == 4000


def test_no_task_holds_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rows = spark.sql(HOT).filter("k = 'hot'")
        placed = scan.positions(rows.select("k", "t", "i"), "k", "t", 150).withColumn("p", F.spark_partition_id())
        assert max(r["count"] for r in placed.groupBy("p").count().collect()) < rows.count() / 4
        below = ranking.rows_below(spark.range(10_000).select(F.when(F.col("id") == 0, 1e12).otherwise(F.col("id")).alias("v")), "v")
        assert max(r["count"] for r in below.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()) < 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_each_key_seeks_on_its_own_axis(spark):
    rng = random.Random(9)
    stamp = lambda s: None if s is None else datetime.fromtimestamp(s)
    rows = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *range(40)]), i) for i in range(400)]
    marks = [(rng.choice(["a", "a", "b", None, "d"]), rng.choice([None, *range(5, 35)])) for _ in range(60)]
    frame = lambda xs, kind: spark.createDataFrame([(x[0], stamp(x[1]), *x[2:]) for x in xs], kind)
    left, axis = frame(rows, "k string, t timestamp, _part int").withColumn("mark", F.lit(7)), frame(marks, "k string, u timestamp")

    def plain(k, t):
        own = sorted(u for q, u in marks if q == k and u is not None)
        return None if t is None or not own else max((u for u in own if u <= t), default=own[0])

    for size in (scan.STRETCH, 20):
        got = scan.sought(left, "t", axis, "u", "k", size=size)
        assert got.columns == [*left.columns, "sought"]
        assert {r._part: r.sought and int(r.sought.timestamp()) for r in got.collect()} == {i: plain(k, t) for k, t, i in rows}
    assert timeline.seek_join(left.limit(0), "t", axis, "u").count() == 0
    assert {r.sought for r in timeline.seek_join(left, "t", axis.limit(0), "u").collect()} == {None}
    marked = spark.createDataFrame([(1, 1.5), (2, float("nan"))], "total int, v double")
    assert {r.total: r.n for r in ranking.tiled(ranking.percent_ranked(marked, "v", "p"), "v", "total", 2, "n").collect()} == {1: 1, 2: 2}


def test_ranks_of_texts_outliers_and_one_value(spark):
    rng = random.Random(2)
    for kind, values in (("string", ["x" * rng.randrange(5) + rng.choice("abé") for _ in range(300)]), ("double", [1e300, -1e300, float("nan"), *[2.5] * 500, *range(40)]), ("date", [datetime(2020, 1, 1 + i % 28).date() for i in range(90)])):
        rows = spark.createDataFrame([(i, v if kind != "double" else float(v)) for i, v in enumerate(values)] + [(-1, None)], f"i int, v {kind}")
        rows.createOrReplaceTempView("valued")
        want = {r.i: (r.p, r.n) for r in spark.sql("SELECT i, percent_rank() OVER (ORDER BY v) AS p, ntile(7) OVER (ORDER BY v, i) AS n FROM valued WHERE v IS NOT NULL").collect()}
        for size in (scan.STRETCH, 60):
            got = {r.i: (r.p, r.n) for r in ranking.tiled(ranking.percent_ranked(rows, "v", "p"), "v", "i", 7, "n", size).collect()}
            assert got.pop(-1) == (None, None) and got == want


def test_overlaps_of_any_length(spark):
    rng = random.Random(5)
    year = 365 * 86400
    ranged = lambda n: [(i, (a := rng.randrange(-50 * year, 50 * year)), a + rng.choice([0, 1, 60, 86400, year, 30 * year, -100])) for i in range(n)]
    ticks, spans = ranged(60) + [(60, None, 5), (61, 0, None)], ranged(300) + [(300, None, 4), (301, 10, 10), (302, 10, 10)]
    frame = lambda xs, a, b, i: spark.createDataFrame(xs, f"{i} int, {a} long, {b} long").withColumns({a: F.timestamp_seconds(a), b: F.timestamp_seconds(b), "node" if i == "j" else "level": F.lit(1)})
    left, right = frame(ticks, "low", "high", "i"), frame(spans, "first", "last", "j")
    want = sorted((i, j) for i, lo, hi in ticks for j, a, b in spans if None not in (lo, hi, a, b) and a <= hi and b >= lo)
    for seconds in (1.0, 1e6):
        got = layers.overlap_join(left, right, seconds)
        assert sorted((r.i, r.j) for r in got.select("i", "j").collect()) == want and len(got.columns) == 8
    assert layers.overlap_join(left.limit(0), right).count() == 0
    cover = lambda a, b: [tuple(x) for x in one(spark, layers.dyadic_cover(F.lit(a).cast("long"), F.lit(b).cast("long"), 62))]
    for a, b in [(0, 0), (5, 4), (-7, 9), (1, 2**40), (-(2**41), 12345)] + [tuple(sorted((rng.randrange(-99, 99), rng.randrange(-99, 99)))) for _ in range(20)]:
        parts = sorted((n << k, (n + 1) << k) for k, n in cover(a, b))
        assert len(parts) <= 2 * max(b - a + 1, 1).bit_length() and (not parts if b < a else (parts[0][0], parts[-1][1]) == (a, b + 1))
        assert all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))


def test_few_ticks_meet_spans_without_shuffling_them(spark, monkeypatch):
    left = spark.sql("SELECT id AS i, timestamp_seconds(id * 1000) AS low, timestamp_seconds(id * 1000 + 700) AS high FROM range(40)")
    right = spark.sql("SELECT id AS j, timestamp_seconds(id * 37) AS first, timestamp_seconds(id * 37 + id % 5 * 900) AS last FROM range(900)")
    want = sorted((i, j) for i in range(40) for j in range(900) if j * 37 <= i * 1000 + 700 and j * 37 + j % 5 * 900 >= i * 1000)
    for few, small in ((40, 40), (10, 40), (10, 10)):
        monkeypatch.setattr(layers, "FEW", few)
        monkeypatch.setattr(layers, "SMALL", small)
        for ticks, spans, sides in ((left, right, ("i", "j")), (right.toDF("j", "low", "high"), left.toDF("i", "first", "last"), ("i", "j"))):
            got = layers.overlap_join(ticks, spans)
            assert sorted(tuple(r) for r in got.select(*sides).collect()) == want
            assert small == 10 or "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_wanted_layers_prune_folders_and_set_broken_lines_aside(spark, tmp_path):
    feature = '{"type":"Feature","properties":{"level":1},"geometry":{"type":"Point","coordinates":"[1,2]"}}'
    whole = [(f'{{"surname":"{s}","type":"FeatureCollection","features":[{feature}]}}', s[:2], y) for s in ("oneil", "onto", "smith") for y in (1851, 1911)]
    lines = spark.createDataFrame(whole + [('{"surname":"smith","features":[', "sm", 1911), ("junk", "on", 1851)], "value string, prefix string, year int")
    folder = str(tmp_path / "layers")
    lines.write.partitionBy("prefix", "year").text(folder)
    wanted = spark.createDataFrame([("oneil", 1911, 1), ("smith", 1911, 2), ("smith", 1911, 3), ("smith", 1999, 4), ("nobody", 1851, 5), (None, 1851, 6)], "surname string, year int, i int").filter("i > 0")
    got = tables.read_wanted_layers(spark, folder, wanted)
    assert sorted((r.surname, r.year, r.i, len(r.features)) for r in got.collect()) == [("oneil", 1911, 1, 1), ("smith", 1911, 2, 1), ("smith", 1911, 3, 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
    assert sorted((r.prefix, r.year, r.line) for r in tables.broken_layers(spark, folder).collect()) == [("on", 1851, "junk"), ("sm", 1911, '{"surname":"smith","features":[')]
    (tmp_path / "mask.json").write_text(f'{{"type":"FeatureCollection",\n"features":[{feature},\n{feature}]}}')
    mask = tables.read_mask(spark, str(tmp_path / "mask.json")).collect()
    assert [m.feature.geometry.coordinates for m in mask] == ["[1,2]", "[1,2]"]


def test_geometries_are_cut_as_json(spark):
    times = F.array(*[F.lit(x) for x in (1, 2, 3, 4)])
    cut = lambda c, t=times, a=1, b=3: one(spark, layers.geometry_slice(F.lit(c).cast("string"), t, F.lit(a), F.lit(b)))
    assert cut("[[0, 1], [2.5,3],[4,5],[6,7]]") == "[[2.5,3],[4,5]]" and cut("[7, 8]") == "[7,8]"
    assert cut("[[0,1],[2,3]]", F.array().cast("array<int>")) == "[[0,1],[2,3]]" and cut("[[0,1]]", a=9, b=10) is None
    assert cut("no json") is None and cut(None) is None and cut("[]") == "[]"


def test_codes_have_colours(spark):
    rows = spark.createDataFrame([("oac", "1b"), ("oac", "1z"), ("oac", "99"), ("oac", "0a"), ("loac", "G2"), ("iuc", "10"), ("iuc", "12"), ("imd", None), (None, "1"), ("x", "1")], "scheme string, code string")
    got = {(r.scheme, r.code): (r.colour, r.matched) for r in codes.coloured(rows, F.col("scheme"), F.col("code")).collect()}
    assert got == {
        ("oac", "1b"): ("#e4d3b1", "code"), ("oac", "1z"): ("#ccbb99", "group"), ("oac", "99"): ("#dddddd", "code"), ("oac", "0a"): (None, "none"), ("loac", "G2"): ("#D1D1D1", "code"),
        ("iuc", "10"): ("#8470ff", "code"), ("iuc", "12"): (None, "none"), ("imd", None): (None, "none"), (None, "1"): (None, "none"), ("x", "1"): (None, "none"),
    }


def test_dossiers_are_gathered_once(spark):
    t = {n: spark.createDataFrame(ROWS.get(n, []), kind) for n, kind in (schemas.FACTS | schemas.LOOKUPS).items()}
    probes = membership.prepared(spark.createDataFrame([("oneil",)], "input string"))
    plan = dossier.assemble(probes, t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter, (surname#") == 1 and "Union" in plan


def test_bitmap_axes(spark):
    draw = random.Random(5)
    # Instants before and after 1970 and at the edges of buckets, a key of nine tenths of the rows, null keys and times.
    edges = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 65537, -65536]
    key = lambda: None if draw.random() < 0.02 else draw.choice("aaaaaaaaab")
    rows = lambda: [(key(), n, 1) for n in edges + [draw.randrange(-99999, 99999) for _ in range(3000)]] + [("a", None, 1), ("b", None, 1)]
    sides, axes, dated = [rows() + [("c", 7, 1)], rows()], [], []
    for side in sides:
        df = spark.createDataFrame(side + side[:99], "key string, n long, bits long")
        axes.append(bitaxis.packed(df.withColumn("t", F.timestamp_micros(F.col("n") * 60_000_000 + 1_000_000)), "key", "t", 60))
        dated.append(bitaxis.packed(df.select("key", F.date_from_unix_date(F.col("n").cast("int")).alias("d")), "key", "d"))
    sets = [{(k, n) for k, n, _ in side if n is not None} for side in sides]
    for mode, want in (("union", sets[0] | sets[1]), ("intersect", sets[0] & sets[1])):
        got = bitaxis.unpacked(bitaxis.merged(axes, "key", mode), "key", "t", 60).select("key", F.unix_seconds("t") / 60).collect()
        assert len(got) == len(want) and {(k, int(n)) for k, n in got} == want
        got = bitaxis.unpacked(bitaxis.merged(dated, "key", mode), "key", "d").select("key", F.unix_date("d")).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
        counted = {r.key: r.n for r in bitaxis.sizes(bitaxis.merged(axes, "key", mode), "key").collect()}
        assert counted == Counter(k for k, _ in want)
    empty = axes[0].limit(0)
    assert bitaxis.merged([axes[0], empty], "key", "intersect").count() == 0
    assert bitaxis.unpacked(empty, "key", "t", 60).count() == 0
    with pytest.raises(ValueError, match="unknown way"):
        bitaxis.merged(axes, "key", "replace")


def test_an_axis_of_a_few_times_is_a_few_words(spark):
    axis = spark.sql("SELECT id % 50 AS key, timestamp_seconds(id * 1000003) AS t FROM range(100)")
    packed = bitaxis.packed(axis, "key", "t", 60)
    assert dict(packed.dtypes)["_bits"] == "bigint" and packed.count() <= 100


def test_geometry_and_last_points_make_their_rows_once(spark):
    rows = spark.sql("SELECT id, array(id, id + 1) AS points, 7 AS others FROM range(3)").union(spark.sql("SELECT 9L, CAST(array() AS array<bigint>), 8"))
    got = layers.with_last_points(rows, "points")
    assert got.columns == ["id", "points", "others", "last"]
    assert sorted(tuple(map(str, r)) for r in got.collect()) == sorted(
        [(str(i), str([i, i + 1]), "7", "False") for i in range(3)] + [(str(i), str([i + 1]), "7", "True") for i in range(3)] + [("9", "[]", "8", "False")]
    )
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range") == 1
    late = layers.geometry_slice(F.raise_error(F.lit("read")).cast("string"), F.array(F.lit(5)), F.lit(7), F.lit(9))
    assert one(spark, late) is None  # a feature that doesn't show isn't parsed
