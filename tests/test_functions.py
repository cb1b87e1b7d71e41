"""Column functions against fixed cases and against Python's own functions on random text."""

import random
import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tallyloom.functions import periods, stamps, text


def values(spark, rows, kind, expr):
    out = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}").select("i", expr(F.col("x")).alias("y"))
    return [r.y for r in sorted(out.collect(), key=lambda r: r.i)]


def test_names_and_titles_equal_python(spark):
    rng = random.Random(1)
    rows = ["".join(rng.choice("abC'D-9 \t_^.éÉßİK") for _ in range(rng.randrange(12))) for _ in range(500)]
    forms = [re.sub(r"[^A-Za-z']+", "", r.lower()) for r in rows]
    assert values(spark, rows, "string", text.name_form) == forms
    assert values(spark, forms, "string", text.name_key) == [re.sub(r"[\W^0-9^\s]+", "", f) for f in forms]
    plain = ["".join(rng.choice("abC'D-9 .éñ") for _ in range(rng.randrange(12))) for _ in range(500)] + ["king's lynn", "STOKE-ON-TRENT"]
    assert values(spark, plain, "string", text.title_case) == [p.title() for p in plain]
    assert values(spark, [None], "string", text.title_case) == [None]


def test_two_decimals_round_the_exact_value(spark):
    rng = random.Random(2)
    rows = [1.005, 0.125, 2.675, 2.5, 0.0, 0.375, 1234567.125] + [rng.random() * 10 ** rng.randrange(6) for _ in range(500)]
    want = [str(Decimal(r).quantize(Decimal("0.01"), ROUND_HALF_UP)) for r in rows]
    assert values(spark, rows, "double", text.to_fixed2) == want
    assert values(spark, [12345, 7, None], "long", text.thousands) == ["12,345", "7", None]
    assert values(spark, [7.26], "double", lambda x: text.snap_to_step(x, F.lit(0), F.lit(10), 0.1)) == [7.3]
    assert values(spark, [None, 1, 2], "int", lambda x: text.not_in(x, [1])) == [True, False, True]


def test_periods(spark):
    parse = lambda c: lambda x: periods.parse_period(x, carry=c)
    rows = ["P30D", "P4W", "PT90S", "P14M", "p1y2m", "", "P1X", None]
    assert values(spark, rows, "string", parse(True)) == [
        [0, 1, 0, 2, 0, 0, 0], [0, 1, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 1, 30], [1, 2, 0, 0, 0, 0, 0], [1, 2, 0, 0, 0, 0, 0], [0] * 7, None, None,
    ]
    assert values(spark, ["P30D"], "string", parse(False)) == [[0, 0, 0, 30, 0, 0, 0]]
    assert values(spark, ["P1Y2M3DT4H"], "string", lambda x: periods.period_seconds(periods.parse_period(x))) == [36561600]
    assert values(spark, ["P1Y2MT3S"], "string", lambda x: periods.period_words(periods.parse_period(x))) == ["1 year 2 months 3 seconds"]
    move = lambda p, **k: lambda x: F.date_format(periods.add_period(x.cast("timestamp"), periods.parse_period(F.lit(p)), **k), "yyyy-MM-dd HH:mm")
    dates = ["2020-01-31 05:30", "2021-01-30 00:00", "2020-02-29 00:00"]
    assert values(spark, dates, "string", move("P1M")) == ["2020-03-02 05:30", "2021-03-02 00:00", "2020-03-29 00:00"]
    assert values(spark, dates, "string", move("P1Y1M"))[2] == "2021-04-01 00:00"
    assert values(spark, dates, "string", move("P1M", overflow=False))[0] == "2020-02-29 05:30"
    assert values(spark, dates, "string", move("P1DT6H", sign=-1))[0] == "2020-01-29 23:30"
    assert values(spark, [1911], "int", periods.year_millis) == [-1861920000000]


def test_periods_are_read_by_one_match(spark):
    texts = ["P1Y2M3W4DT5H6M7S", "", "P", "P1D\n", "\nP1D", "pt9h", "P1M\r\n", "PT", "P99999999999D", "P1D2", None, "P3M,4"]
    found = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(periods.parse_period(F.col("t")).alias("p")).collect()]
    zero = [0] * 7
    day, hour, month = [0, 0, 0, 1, 0, 0, 0], [0, 0, 0, 0, 9, 0, 0], [0, 1, 0, 0, 0, 0, 0]
    assert found == [[1, 2, 3, 4, 5, 6, 7], zero, zero, day, None, hour, month, zero, None, None, None, None]
    assert spark.range(1).select(periods.parse_period(F.concat(F.lit("P"), F.col("id"), F.lit("D"))))._jdf.queryExecution().analyzed().toString().count("regexp_extract") == 0


def test_instants_by_batches_read_as_one_by_one(spark):
    rows = spark.sql("""SELECT id, CASE id % 7 WHEN 0 THEN transform(sequence(0, id), i -> timestamp_micros(i * 1234567890123 - 5)) WHEN 1 THEN array() WHEN 2 THEN NULL
      WHEN 3 THEN array(timestamp'0001-01-01', timestamp'9999-12-31 23:59:59.999999') WHEN 4 THEN array(timestamp'2000-02-29 12:00:00', NULL) WHEN 5 THEN array(timestamp'9999-12-31' + INTERVAL 40 DAYS)
      ELSE transform(sequence(1, 10001 + id % 2), i -> timestamp_seconds(i)) END AS a FROM range(60)""")
    plain = F.array_join(F.transform("a", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")), ",")
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert rows.select(stamps.joined_instants(F.col("a")).alias("x"), plain.alias("y")).filter("NOT x <=> y").count() == 0
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows.select(stamps.joined_instants(F.col("a")))._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
