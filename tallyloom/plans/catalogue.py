"""Registered queries of the tool's operators, each over whole tables, and DuckDB SQL for the same rows.

Lists come out as text joined by commas or bars, instants as text, so that both engines show them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import periods, stamps, text
from tallyloom.operators import bitaxis, codes, dossier, layers, membership, ranking, timeline
from tallyloom.plans import analogue
from tallyloom.sources import folders, schemas, tables
from tallyloom.sources.tables import table
from tallyloom.streaming import snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: SQL of the derived star, for the queries that start from it.
STAR = r"""
WITH sold AS (SELECT regexp_replace(lower(p_name), '[^a-z]', '', 'g') AS surname, * FROM lineitem JOIN part ON l_partkey = p_partkey),
frq AS (SELECT surname, year(l_shipdate)::INT AS year, count(*)::INT AS freq FROM sold GROUP BY ALL),
kde AS (SELECT * FROM frq WHERE freq >= (SELECT quantile_disc(freq, 0.95) FROM frq)),
known AS (SELECT DISTINCT regexp_replace(lower(p_name), '[^a-z]', '', 'g') AS surname FROM part),
inputs AS (SELECT DISTINCT p_name AS input FROM part UNION ALL SELECT DISTINCT ' ' || upper(replace(p_name, ' ', ''' ')) || ' 2' FROM part
  UNION ALL SELECT unnest(['', '''', '12 3', 'O''Neil', 'zzz'])),
forms AS (SELECT input, regexp_replace(lower(input), '[^a-z'']', '', 'g') AS form FROM inputs),
probes AS (SELECT *, replace(form, '''', '') AS surname FROM forms),
kept AS (SELECT surname, string_agg(year::VARCHAR, ',' ORDER BY year) AS years FROM kde WHERE NOT coalesce(year IN (0, 1996, 1998), false) GROUP BY surname),
classed AS (SELECT p.*, k.years, CASE WHEN form = '' THEN 'empty' WHEN k.years IS NOT NULL THEN 'found'
  WHEN p.surname IN (SELECT surname FROM kde) OR p.surname IN (SELECT surname FROM known) THEN 'db' ELSE 'none' END AS status
  FROM probes p LEFT JOIN kept k ON p.surname = k.surname),
axis AS (SELECT unnest(range(1994, 2002))::INT AS year),
vectors AS (SELECT surname, string_agg(coalesce(freq, 0)::VARCHAR, ',' ORDER BY year) AS freqs
  FROM (SELECT DISTINCT surname FROM frq) CROSS JOIN axis LEFT JOIN frq USING (surname, year) GROUP BY surname),
place AS (SELECT DISTINCT s.surname, upper(r_name) AS regcnty, n_name AS parish, 'E' || n_nationkey AS msoa11cd FROM sold s JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
prio AS (SELECT surname, o_orderpriority FROM sold JOIN orders ON l_orderkey = o_orderkey)
"""
TITLE = r"""array_to_string(list_transform(regexp_extract_all(lower({0}), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def joined(array: Column | str, by: str = ",") -> Column:
    return F.array_join(F.col(array) if isinstance(array, str) else array, by)


def shown(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def instants(array: Column) -> Column:
    return joined(F.transform(array, shown))


def with_times(rows: DataFrame, array: Column) -> DataFrame:
    """(o_orderkey, times) with the instants of long arrays as text; the arrays are a column first, so made once."""
    made = rows.select("o_orderkey", array.alias("times"))
    return made.withColumn("times", stamps.joined_instants(F.col("times")))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.date_trunc("SECOND", F.col("ts").cast("timestamp")))


def order_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their dates and the sorted dates and quantities of their items."""
    items = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("timestamp").alias("t"), "l_linenumber", "l_quantity")
    track = F.sort_array(F.collect_list(F.struct("t", "l_linenumber", "l_quantity")))
    tracks = items.groupBy("l_orderkey").agg(track.alias("track"))
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return orders.join(tracks, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderdate", F.transform("track", lambda x: x["t"]).alias("times"), F.transform("track", lambda x: x["l_quantity"]).alias("points")
    )


def order_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their dates and the last date of their items: order_spans where no track is asked for."""
    last = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_shipdate").cast("timestamp")).alias("last"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return orders.join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderdate", "last")


# --- names, membership, dossier ---------------------------------------------------------------------------------


@query(STAR + f"""SELECT input, status, CASE WHEN status = 'found' THEN {TITLE.format('form')} ELSE status END AS display,
  CASE WHEN status = 'found' THEN years END AS years, CASE WHEN status = 'found' THEN freqs END AS freqs FROM classed LEFT JOIN vectors USING (surname)""")
def dossier_frequency(spark: SparkSession, sf: str) -> DataFrame:
    freq = analogue.frequencies(spark, sf)
    names = table(spark, sf, "part").select(text.name_key(text.name_form(F.col("p_name"))).alias("surname")).distinct()
    probes = membership.prepared(analogue.probes(spark, sf))
    rows = membership.classify(probes, analogue.thresholded(freq), names, list(analogue.EXCLUDED))
    rows = rows.join(dossier.year_vector(freq, list(analogue.AXIS)), "surname", "left")
    found = F.col("status") == "found"
    return rows.select(
        "input", "status", F.when(found, text.title_case(F.col("form"))).otherwise(F.col("status")).alias("display"),
        F.when(found, joined("years")).alias("years"), F.when(found, joined("freqs")).alias("freqs"),
    )


@query(STAR + "SELECT input, form, surname FROM probes")
def normalise_name(spark: SparkSession, sf: str) -> DataFrame:
    return membership.prepared(analogue.probes(spark, sf))


@query(f"SELECT c_custkey, {TITLE.format('c_name || chr(39) || c_mktsegment')} AS title FROM customer")
def title_case(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("c_name", F.lit("'"), "c_mktsegment")
    return table(spark, sf, "customer").select("c_custkey", text.title_case(name).alias("title"))


@query(STAR + "SELECT input, surname, status FROM classed")
def classify_probes(spark: SparkSession, sf: str) -> DataFrame:
    freq = analogue.frequencies(spark, sf)
    probes = membership.prepared(analogue.probes(spark, sf))
    names = table(spark, sf, "part").select(text.name_key(text.name_form(F.col("p_name"))).alias("surname"))
    return membership.classify(probes, analogue.thresholded(freq), names, list(analogue.EXCLUDED)).select("input", "surname", "status")


@query(STAR + "SELECT surname, freqs FROM vectors")
def year_vector(spark: SparkSession, sf: str) -> DataFrame:
    return dossier.year_vector(analogue.frequencies(spark, sf), list(analogue.AXIS)).withColumn("freqs", joined("freqs"))


@query(STAR + """SELECT surname, string_agg(coalesce(freq, 0)::VARCHAR, ',' ORDER BY year) FILTER (year < 1997) AS early,
  string_agg(coalesce(freq, 0)::VARCHAR, ',' ORDER BY year) FILTER (year >= 1997) AS late
  FROM (SELECT DISTINCT surname FROM frq) CROSS JOIN axis LEFT JOIN frq USING (surname, year) GROUP BY surname""")
def vector_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = dossier.year_vector(analogue.frequencies(spark, sf), list(analogue.AXIS))
    early, late = dossier.split_vector(F.col("freqs"), 3)
    return rows.select("surname", joined(early).alias("early"), joined(late).alias("late"))


@query(STAR + "SELECT surname, year::VARCHAR AS year, coalesce(freq, 0) AS freq FROM (SELECT DISTINCT surname FROM frq) CROSS JOIN axis LEFT JOIN frq USING (surname, year)")
def labelled_years(spark: SparkSession, sf: str) -> DataFrame:
    rows = dossier.year_vector(analogue.frequencies(spark, sf), list(analogue.AXIS))
    labels = F.array(*[F.lit(str(y)) for y in analogue.AXIS])
    return rows.select("surname", F.inline(F.arrays_zip(labels.alias("year"), F.col("freqs").alias("freq"))))


@query(STAR + "SELECT surname, years FROM kept")
def kept_years(spark: SparkSession, sf: str) -> DataFrame:
    kde = analogue.thresholded(analogue.frequencies(spark, sf))
    return membership.kept_years(kde, list(analogue.EXCLUDED)).withColumn("years", joined("years"))


@query("SELECT p_partkey, nullif(p_size % 5, 0) AS kind FROM part WHERE NOT coalesce(nullif(p_size % 5, 0) IN (1, 3), false)")
def nulls_kept_not_in(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.nullif(F.col("p_size") % 5, F.lit(0))
    return table(spark, sf, "part").select("p_partkey", kind.alias("kind")).filter(text.not_in(F.col("kind"), [1, 3]))


@query(STAR + """SELECT surname, coalesce(string_agg(forename, '|' ORDER BY forename) FILTER (sex = 'F'), '') AS female,
  coalesce(string_agg(forename, '|' ORDER BY forename) FILTER (sex = 'M'), '') AS male
  FROM (SELECT DISTINCT surname, p_brand AS forename, CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'M' END AS sex FROM sold) GROUP BY surname""")
def forenames_by_sex(spark: SparkSession, sf: str) -> DataFrame:
    sex = F.when(F.col("l_returnflag") == "R", "F").when(F.col("l_returnflag") == "A", "M")
    names = analogue.sales(spark, sf, "p_brand", "l_returnflag").select("surname", F.col("p_brand").alias("forename"), sex.alias("sex")).distinct()
    return dossier.forenames(names).select("surname", joined("female", "|").alias("female"), joined("male", "|").alias("male"))


@query(STAR + f"""SELECT surname, string_agg(pair, '|' ORDER BY pair) AS places FROM (SELECT surname, pair, row_number() OVER (PARTITION BY surname ORDER BY d, parish) AS k
  FROM (SELECT DISTINCT surname, {TITLE.format('regcnty')} AS d, parish, d || '/' || parish AS pair FROM place)) WHERE k <= 5 GROUP BY surname""")
def top_parishes(spark: SparkSession, sf: str) -> DataFrame:
    top = dossier.top_places(analogue.places(spark, sf))
    return top.select("surname", joined(F.transform("places", lambda x: F.concat_ws("/", x["district"], x["parish"])), "|").alias("places"))


@query(STAR + """SELECT surname, string_agg(r_name || '/' || n_name, '|' ORDER BY msoa11cd) AS areas FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY msoa11cd) AS k
  FROM place JOIN nation ON msoa11cd = 'E' || n_nationkey JOIN region ON n_regionkey = r_regionkey) WHERE k <= 5 GROUP BY surname""")
def area_lookup_top5(spark: SparkSession, sf: str) -> DataFrame:
    met = dossier.areas(analogue.places(spark, sf).select("surname", "msoa11cd"), analogue.area_lookup(spark, sf))
    return met.select("surname", joined(F.transform("areas", lambda x: F.concat_ws("/", x["ladnm"], x["msoa11nm"])), "|").alias("areas"))


@query(STAR + """SELECT surname, 'Super ' || o_orderpriority[1] AS supergroup, o_orderpriority AS "group", 'all of ' || o_orderpriority[1] AS supergroup_text,
  'about ' || o_orderpriority AS group_text, o_orderpriority[1] || lower(o_orderpriority[3]) AS code
  FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY n DESC, o_orderpriority) AS k FROM (SELECT surname, o_orderpriority, count(*) AS n FROM prio GROUP BY ALL)) WHERE k = 1""")
def group_classification(spark: SparkSession, sf: str) -> DataFrame:
    code = analogue.priority_code("o_orderpriority")
    facts = analogue.groups(analogue.priorities(spark, sf), "o_orderpriority", code, "oac")
    names, texts = analogue.group_lookups(spark, sf, "orders", "o_orderpriority", code)
    return dossier.classification(facts, names, texts, "oaccd", "oacnm").drop("missed")


@query(STAR + """SELECT surname, code, name, 'size ' || code AS text FROM (SELECT regexp_replace(lower(p_name), '[^a-z]', '', 'g') AS surname, p_size AS code, p_type AS name,
  row_number() OVER (PARTITION BY regexp_replace(lower(p_name), '[^a-z]', '', 'g') ORDER BY p_size, p_type) AS k FROM part) WHERE k = 1""")
def cast_lookup(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").withColumn("surname", text.name_key(text.name_form(F.col("p_name"))))
    lookup = part.select(F.col("p_size").cast("string").alias("size_code"), F.concat(F.lit("size "), "p_size").alias("description")).distinct()
    return dossier.described(part, "p_size", "p_type", lookup, "size_code", "description").drop("missed")


@query(STAR + """SELECT surname, decile, n FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY n DESC, decile) AS k
  FROM (SELECT surname, ceil(p_size / 5.0)::INT AS decile, count(*) AS n FROM sold GROUP BY ALL)) WHERE k = 1""")
def modal_decile(spark: SparkSession, sf: str) -> DataFrame:
    rows = analogue.sales(spark, sf, "p_size").withColumn("decile", analogue.decile("p_size"))
    return dossier.modal_pick(rows, "surname", "decile")


@query(STAR + "SELECT input, coalesce(years, 'No data') AS years, coalesce(freqs, 'No data') AS freqs FROM classed LEFT JOIN vectors USING (surname)")
def default_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    freq = analogue.frequencies(spark, sf)
    years = membership.kept_years(analogue.thresholded(freq), list(analogue.EXCLUDED))
    rows = membership.prepared(analogue.probes(spark, sf)).join(years, "surname", "left").join(dossier.year_vector(freq, list(analogue.AXIS)), "surname", "left")
    return rows.select("input", *[F.coalesce(joined(c), F.lit(dossier.NO_DATA)).alias(c) for c in ("years", "freqs")])


@query(STAR + "SELECT surname, printf('%.2f', avg(l_quantity)) AS mean, printf('%.2f', stddev_samp(l_quantity)) AS sd FROM sold GROUP BY surname")
def mean_sd_fixed(spark: SparkSession, sf: str) -> DataFrame:
    rows = analogue.sales(spark, sf, "l_quantity").groupBy("surname").agg(F.avg("l_quantity").alias("m"), F.stddev("l_quantity").alias("s"))
    return rows.select("surname", text.to_fixed2(F.col("m")).alias("mean"), text.to_fixed2(F.col("s")).alias("sd"))


def _modal(rows: str, value: str) -> str:
    return f"(SELECT surname, {value} FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY n DESC, {value}) AS k FROM (SELECT surname, {value}, count(*) AS n FROM {rows} GROUP BY ALL)) WHERE k = 1)"


def _sexed(value: str, flag: str, female: str, male: str) -> str:
    names = f"(SELECT DISTINCT surname, {value} AS x, {flag} AS s FROM sold)"
    of = lambda s: f"coalesce(list(x ORDER BY x) FILTER (s = '{s}'), [])"
    return f"(SELECT surname, {of(female)} AS f, {of(male)} AS m FROM {names} GROUP BY surname)"


#: The slots in order, each as JSON text.
DOSSIER = STAR + f""", seg AS (SELECT surname, c_mktsegment FROM sold JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
sized AS (SELECT *, ceil(p_size / 5.0)::INT AS decile FROM sold),
parishes AS (SELECT surname, list([d, parish] ORDER BY d, parish) AS x FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY d, parish) AS k FROM (SELECT DISTINCT surname, {TITLE.format('regcnty')} AS d, parish FROM place)) WHERE k <= 5 GROUP BY surname),
areas AS (SELECT surname, list([r_name, n_name] ORDER BY msoa11cd) AS x FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY msoa11cd) AS k FROM place JOIN nation ON msoa11cd = 'E' || n_nationkey JOIN region ON n_regionkey = r_regionkey) WHERE k <= 5 GROUP BY surname),
own AS (SELECT surname, min({{'s': p_size, 't': p_type}}) AS i, min({{'s': p_size, 'b': p_brand}}) AS b FROM (SELECT regexp_replace(lower(p_name), '[^a-z]', '', 'g') AS surname, * FROM part) GROUP BY surname),
std AS (SELECT surname, [printf('%.2f', avg(l_quantity)), printf('%.2f', stddev_samp(l_quantity))] AS x FROM sold GROUP BY surname),
slots AS (SELECT surname, concat_ws(',', to_json(h.f)::VARCHAR, to_json(h.m)::VARCHAR, to_json(c.f)::VARCHAR, to_json(c.m)::VARCHAR, to_json(p.x)::VARCHAR, to_json(a.x)::VARCHAR,
  to_json(['Super ' || o_orderpriority[1], o_orderpriority, 'all of ' || o_orderpriority[1], 'about ' || o_orderpriority, o_orderpriority[1] || lower(o_orderpriority[3])])::VARCHAR,
  to_json(['Super ' || c_mktsegment[1], c_mktsegment, 'all of ' || c_mktsegment[1], 'about ' || c_mktsegment, c_mktsegment[1] || '1'])::VARCHAR,
  to_json([i.s::VARCHAR, i.t, 'size ' || i.s])::VARCHAR, l_linenumber::VARCHAR, decile::VARCHAR, to_json([ceil(b.s / 5.0)::INT::VARCHAR, b.b])::VARCHAR,
  to_json([(length(surname) % 9 + 1)::VARCHAR, 'length ' || length(surname)])::VARCHAR, to_json(std.x)::VARCHAR) AS stats
  FROM {_sexed('p_brand', 'l_returnflag', 'R', 'A')} h JOIN {_sexed('p_type', 'l_linestatus', 'F', 'O')} c USING (surname) JOIN parishes p USING (surname) JOIN areas a USING (surname)
  JOIN {_modal('prio', 'o_orderpriority')} USING (surname) JOIN {_modal('seg', 'c_mktsegment')} USING (surname) JOIN own USING (surname) JOIN {_modal('sold', 'l_linenumber')} USING (surname)
  JOIN {_modal('sized', 'decile')} USING (surname) JOIN std USING (surname)),
off AS (SELECT surname, bool_or(year NOT BETWEEN 1994 AND 2001) AS off FROM frq GROUP BY surname),
settled AS (SELECT *, CASE WHEN status = 'found' AND off THEN 'error' ELSE status END AS state FROM classed LEFT JOIN off USING (surname))
SELECT input, CASE WHEN state <> 'found' THEN '{{"surname":"' || state || '"}}' ELSE '{{"surname":"' || {TITLE.format('form')} || '","years":[' || years || '],"freqs":[' || freqs || '],"stats":[' || stats || ']}}' END AS document
FROM settled LEFT JOIN vectors USING (surname) LEFT JOIN slots USING (surname)"""


@query(DOSSIER)
def dossier_json(spark: SparkSession, sf: str) -> DataFrame:
    probes = membership.prepared(analogue.probes(spark, sf))
    rows = dossier.assemble(probes, analogue.tables(spark, sf), analogue.AXIS, analogue.EXCLUDED)
    return dossier.documents(rows)


def _or(value: str, default: str) -> str:
    return f"coalesce(to_json({value})::VARCHAR, '{default}')"


_BOTH, _FIVE = '["No data","No data"]', '["No data","No data","","","99"]'
#: As DOSSIER, with left joins, defaults and failures, over the star with gaps.
GAPS = DOSSIER.replace("quantile_disc(freq, 0.95)", "quantile_disc(freq, 0.5)").split("slots AS (")[0] + f"""hist AS (SELECT surname, CASE WHEN length(surname) % 5 = 3 THEN [] ELSE f END AS f, m
  FROM {_sexed('p_brand', 'l_returnflag', 'R', 'A')} WHERE length(surname) % 5 <> 2 AND NOT (length(surname) % 5 = 3 AND len(m) = 0)),
cont AS (SELECT * FROM {_sexed('p_type', 'l_linestatus', 'F', 'O')} WHERE length(surname) % 5 <> 2), L AS (SELECT DISTINCT surname, length(surname) AS n FROM sold),
slots AS (SELECT L.surname, i.s % 10 = 3 AS missed, concat_ws(',', {_or('h.f', '["No forenames found"]')}, {_or('h.m', '["No forenames found"]')}, {_or('c.f', '["No forenames found"]')}, {_or('c.m', '["No forenames found"]')},
  {_or('p.x', f'[{_BOTH}]')}, {_or('a.x', f'[{_BOTH}]')},
  CASE WHEN o.surname IS NULL THEN '{_FIVE}' ELSE to_json(['Super ' || o_orderpriority[1], o_orderpriority, 'all of ' || o_orderpriority[1], 'about ' || o_orderpriority, o_orderpriority[1] || lower(o_orderpriority[3])])::VARCHAR END,
  CASE WHEN g.surname IS NULL THEN '{_FIVE}' ELSE to_json(['Super ' || c_mktsegment[1], c_mktsegment, 'all of ' || c_mktsegment[1], 'about ' || c_mktsegment, c_mktsegment[1] || '1'])::VARCHAR END,
  to_json([i.s::VARCHAR, i.t, 'size ' || i.s])::VARCHAR, CASE WHEN n % 3 = 0 THEN '["No data"]' ELSE ah.l_linenumber::VARCHAR END, CASE WHEN n % 3 = 1 THEN '["No data"]' ELSE im.decile::VARCHAR END,
  CASE WHEN n % 4 = 1 THEN '["99","No data"]' ELSE to_json([ceil(b.s / 5.0)::INT::VARCHAR, b.b])::VARCHAR END, CASE WHEN n % 4 = 2 THEN '["99","No data"]' ELSE to_json([(n % 9 + 1)::VARCHAR, 'length ' || n])::VARCHAR END,
  CASE WHEN n % 4 = 0 THEN '{_BOTH}' ELSE to_json(std.x)::VARCHAR END) AS stats
  FROM L LEFT JOIN hist h USING (surname) LEFT JOIN cont c USING (surname) LEFT JOIN parishes p ON p.surname = L.surname AND n % 6 <> 4 LEFT JOIN areas a ON a.surname = L.surname AND n % 6 <> 3
  LEFT JOIN {_modal('prio', 'o_orderpriority')} o ON o.surname = L.surname AND n % 6 <> 5 LEFT JOIN {_modal('seg', 'c_mktsegment')} g ON g.surname = L.surname AND n % 4 <> 3 LEFT JOIN own ON own.surname = L.surname
  LEFT JOIN {_modal('sold', 'l_linenumber')} ah ON ah.surname = L.surname LEFT JOIN {_modal('sized', 'decile')} im ON im.surname = L.surname LEFT JOIN std ON std.surname = L.surname),
settled AS (SELECT *, CASE WHEN status = 'found' AND (length(surname) % 7 = 0 OR (length(surname) % 7 = 1 AND length(surname) % 6 <> 4) OR missed) THEN 'error' ELSE status END AS state FROM classed LEFT JOIN slots USING (surname))
SELECT input, CASE WHEN state <> 'found' THEN '{{"surname":"' || state || '"}}' ELSE '{{"surname":"' || {TITLE.format('form')} || '","years":[' || years || '],"freqs":[' || CASE WHEN length(surname) % 9 = 0 THEN '0,0,0,0,0,0,0,0' ELSE freqs END
  || '],"stats":[' || stats || ']}}' END AS document FROM settled LEFT JOIN vectors USING (surname)"""


@query(GAPS)
def dossier_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with every default there is, and names whose answer fails."""
    probes = membership.prepared(analogue.probes(spark, sf))
    rows = dossier.assemble(probes, analogue.gappy(analogue.tables(spark, sf)), analogue.AXIS, analogue.EXCLUDED)
    return dossier.documents(rows)


@query("SELECT o_orderkey, format('{:,}', (o_totalprice * 100)::BIGINT) AS shown FROM orders")
def thousands(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", text.thousands(F.round(F.col("o_totalprice") * 100).cast("long")).alias("shown"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def anti_join(spark: SparkSession, sf: str) -> DataFrame:
    large = table(spark, sf, "lineitem").filter("l_quantity > 45")
    return table(spark, sf, "part").join(large, F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey", "p_name")


@query(STAR + """SELECT surname, year, surname[1:2] || '/' || surname || '/' || surname || '_' || year || '.json' AS path FROM kde""")
def layer_paths(spark: SparkSession, sf: str) -> DataFrame:
    kde = analogue.thresholded(analogue.frequencies(spark, sf))
    return kde.select("surname", "year", layers.feature_path(F.col("surname"), F.col("year")).alias("path"))


@query("SELECT c_custkey, url_decode(nullif(regexp_extract('theme=dark; token=' || c_mktsegment || '%20x%3By; id=' || c_custkey, 'token=([^;]*)', 1), '')) AS token_text FROM customer")
def cookie_value(spark: SparkSession, sf: str) -> DataFrame:
    cookies = F.concat(F.lit("theme=dark; token="), "c_mktsegment", F.lit("%20x%3By; id="), "c_custkey")
    pairs = F.transform(F.split(cookies, ";"), lambda x: F.trim(x))
    value = F.get(F.filter(pairs, lambda x: F.startswith(x, F.lit("token="))), 0)
    return table(spark, sf, "customer").select("c_custkey", F.url_decode(F.substr(value, F.lit(7))).alias("token_text"))


# --- axes --------------------------------------------------------------------------------------------------------

DAYS = """WITH a AS (SELECT user_id, date_trunc('day', ts)::DATE AS day FROM events WHERE event_type = 'click'), b AS (SELECT user_id, date_trunc('day', ts)::DATE AS day FROM events WHERE event_type = 'view') """


def _days(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return table(spark, sf, "events").filter(F.col("event_type") == kind).select("user_id", F.to_date("ts").alias("day"))


def _merged(mode: str, bag: bool) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return timeline.merge_axes(_days(spark, sf, "click"), _days(spark, sf, "view"), mode, bag).withColumn("day", F.col("day").cast("string"))

    return run


for _name, _mode, _bag, _sql in (
    ("axis_union", "union", False, "SELECT * FROM a UNION SELECT * FROM b"),
    ("axis_intersect", "intersect", False, "SELECT * FROM a INTERSECT SELECT * FROM b"),
    ("axis_replace", "replace", False, "SELECT DISTINCT * FROM b"),
    ("axis_bag_union", "union", True, "SELECT * FROM a UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"),
    ("axis_bag_intersect", "intersect", True, "SELECT * FROM a INTERSECT ALL SELECT * FROM b"),
):
    QUERIES[_name] = _merged(_mode, _bag)
    ORACLES[_name] = f"{DAYS}SELECT user_id, day::VARCHAR AS day FROM ({_sql})"


HOURS = DAYS.replace("date_trunc('day', ts)::DATE AS day", "date_trunc('hour', ts) AS t")


def _bits(mode: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = events(spark, sf)
        axes = [bitaxis.packed(rows.filter(F.col("event_type") == kind), "user_id", "ts", 3600) for kind in ("click", "view")]
        return bitaxis.unpacked(bitaxis.merged(axes, "user_id", mode), "user_id", "t", 3600).withColumn("t", shown("t"))

    return run


for _mode, _sql in (("union", "SELECT * FROM a UNION SELECT * FROM b"), ("intersect", "SELECT * FROM a INTERSECT SELECT * FROM b")):
    QUERIES[f"bitmap_axis_{_mode}"] = _bits(_mode)
    ORACLES[f"bitmap_axis_{_mode}"] = f"{HOURS}SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t FROM ({_sql})"


@query("SELECT l_suppkey, count(DISTINCT d) AS n FROM (SELECT l_suppkey, unnest([l_shipdate::DATE, o_orderdate::DATE]) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE d IS NOT NULL GROUP BY l_suppkey")
def bitmap_axis_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which something of a supplier was ordered or shipped: two axes merged, none unpacked."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("d"))
    ordered = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("d"))
    axes = [bitaxis.packed(rows, "l_suppkey", "d") for rows in (items, items.drop("d").join(ordered, "l_orderkey"))]
    return bitaxis.sizes(bitaxis.merged(axes, "l_suppkey", "union"), "l_suppkey")


def week() -> Column:
    return periods.parse_period(F.lit("P7D"))


@query("""WITH ends AS (SELECT user_id, min(date_trunc('day', ts)) AS low, max(date_trunc('day', ts)) AS high FROM events GROUP BY user_id)
  SELECT DISTINCT user_id, strftime(unnest(list_append(generate_series(low, high - INTERVAL 1 SECOND, INTERVAL 7 DAY), high)), '%Y-%m-%d %H:%M:%S') AS t FROM ends""")
def axis_extremes(spark: SparkSession, sf: str) -> DataFrame:
    axis = events(spark, sf).select("user_id", F.date_trunc("DAY", "ts").alias("t"))
    return timeline.extremes(axis, "user_id", "t", week()).select("user_id", shown("t").alias("t"))


SPANS = "WITH spans AS (SELECT o_orderkey, o_orderdate AS a, max(l_shipdate) AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL), "
LIST = "array_to_string(list_transform({0}, lambda x: strftime(x, '%Y-%m-%d %H:%M:%S')), ',')"
WEEKS = "list_append(CASE WHEN a < b THEN generate_series(a, b - INTERVAL 1 SECOND, INTERVAL 7 DAY) ELSE [] END, b)"


@query(SPANS + f"steps AS (SELECT o_orderkey, {WEEKS} AS t FROM spans) SELECT o_orderkey, {LIST.format('t')} AS times FROM steps")
def explode_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = order_spans(spark, sf)
    return with_times(rows, timeline.explode_range(F.col("o_orderdate"), F.array_max("times"), week()))


@query(SPANS + """steps AS (SELECT o_orderkey, list_append(CASE WHEN a < b THEN list_filter(generate_series(a, b - INTERVAL 1 SECOND, INTERVAL 31 HOUR),
  lambda x: hour(x) BETWEEN 6 AND 17 AND (hour(x) <> 17 OR minute(x) <= 30)) ELSE [] END, b) AS t FROM spans) SELECT o_orderkey, """ + LIST.format("t") + " AS times FROM steps")
def time_of_day_filter(spark: SparkSession, sf: str) -> DataFrame:
    period = periods.parse_period(F.lit("PT31H"))
    # By number: a row of some bytes makes kilobytes of text, so that tasks of so many bytes would be few and long.
    dealt = order_ends(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey", "last")
    rows = timeline.in_phase(dealt, F.col("o_orderdate"), period)
    return with_times(rows, timeline.explode_range_by_batches(F.col("o_orderdate"), F.col("last"), period, ("06:00", "17:30")))


@query(SPANS + f"""steps AS (SELECT o_orderkey, list_sort(list_concat([a - INTERVAL 1 DAY, b], {WEEKS})) AS t FROM spans) SELECT o_orderkey, {LIST.format('t')} AS times FROM steps""")
def times_expression(spark: SparkSession, sf: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    a, b = F.col("o_orderdate"), F.array_max("times")
    said = F.concat(day(b), F.lit(",junk,"), day(a), F.lit("/"), day(b), F.lit("/P7D,"), day(F.date_sub(a, 1)))
    rows = order_spans(spark, sf).select("o_orderkey", said.alias("said"))
    return with_times(rows, timeline.parse_times(F.col("said")))


@query("""SELECT o_orderkey, strftime(CASE o_orderkey % 3 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate - INTERVAL 36 HOUR ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS first,
  strftime(CASE o_orderkey % 3 WHEN 0 THEN o_orderdate + INTERVAL 5 DAY WHEN 1 THEN o_orderdate ELSE o_orderdate + INTERVAL 36 HOUR END, '%Y-%m-%d %H:%M:%S') AS last FROM orders""")
def interval_string(spark: SparkSession, sf: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    at, kind = F.col("o_orderdate"), F.col("o_orderkey") % 3
    said = F.when(kind == 0, F.concat(day(at), F.lit("/"), day(F.date_add(at, 5)))).when(kind == 1, F.concat(F.lit("P1DT12H/"), day(at))).otherwise(F.concat(day(at), F.lit("/PT36H")))
    rows = table(spark, sf, "orders").select("o_orderkey", timeline.parse_interval(said).alias("x"))
    return rows.select("o_orderkey", shown("x.start").alias("first"), shown("x.end").alias("last"))


#: Period texts made of a row's own numbers.
PERIOD_SQL = "'P' || l_linenumber || 'Y' || (l_orderkey % 30) || 'M' || (l_partkey % 9) || 'W' || l_quantity::INT || 'DT' || (l_suppkey % 50) || 'H' || (l_orderkey % 130) || 'M' || (l_partkey % 200) || 'S'"
SLOTS_SQL = "[l_linenumber::BIGINT, l_orderkey % 30, l_partkey % 9, l_quantity::BIGINT, l_suppkey % 50, l_orderkey % 130, l_partkey % 200]"


def _periods(spark: SparkSession, sf: str) -> DataFrame:
    n = lambda e: F.expr(f"cast({e} as bigint)").cast("string")
    said = F.concat(
        F.lit("P"), n("l_linenumber"), F.lit("Y"), n("l_orderkey % 30"), F.lit("M"), n("l_partkey % 9"), F.lit("W"), n("l_quantity"), F.lit("DT"),
        n("l_suppkey % 50"), F.lit("H"), n("l_orderkey % 130"), F.lit("M"), n("l_partkey % 200"), F.lit("S"),
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", said.alias("said"))


@query(f"SELECT l_orderkey, l_linenumber, {PERIOD_SQL} AS said, array_to_string({SLOTS_SQL}, ',') AS slots FROM lineitem")
def period_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _periods(spark, sf).withColumn("slots", joined(periods.parse_period(F.col("said"))))


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, {SLOTS_SQL} AS p FROM lineitem), s AS (SELECT *, p[7] % 60 AS s, p[6] + p[7] // 60 AS m FROM r),
  h AS (SELECT *, m % 60 AS mi, p[5] + m // 60 AS h FROM s), d AS (SELECT *, h % 24 AS ho, p[4] + h // 24 AS d FROM h), w AS (SELECT *, d % 7 AS da, p[3] + d // 7 AS w FROM d),
  o AS (SELECT *, w % 4 AS we, p[2] + w // 4 AS o FROM w) SELECT l_orderkey, l_linenumber, concat_ws(',', p[1] + o // 12, o % 12, we, da, ho, mi, s) AS slots FROM o""")
def period_carry(spark: SparkSession, sf: str) -> DataFrame:
    rows = _periods(spark, sf)
    return rows.select("l_orderkey", "l_linenumber", joined(periods.parse_period(F.col("said"), carry=True)).alias("slots"))


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, {SLOTS_SQL} AS p FROM lineitem) SELECT l_orderkey, l_linenumber,
  p[1] * 31104000 + p[2] * 2592000 + p[3] * 604800 + p[4] * 86400 + p[5] * 3600 + p[6] * 60 + p[7] AS seconds FROM r""")
def period_seconds(spark: SparkSession, sf: str) -> DataFrame:
    rows = _periods(spark, sf)
    return rows.select("l_orderkey", "l_linenumber", periods.period_seconds(periods.parse_period(F.col("said"))).alias("seconds"))


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, {SLOTS_SQL} AS p FROM lineitem) SELECT l_orderkey, l_linenumber, concat_ws(' ', """ + ", ".join(
    f"CASE WHEN p[{i}] = 1 THEN '1 {w}' WHEN p[{i}] > 1 THEN p[{i}] || ' {w}s' END" for i, w in enumerate(periods.WORDS, 1)
) + ") AS words, true AS valid FROM r")
def period_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = _periods(spark, sf)
    said = F.col("said")
    return rows.select("l_orderkey", "l_linenumber", periods.period_words(periods.parse_period(said)).alias("words"), periods.is_period(said).alias("valid"))


#: A row's number made into texts of which some are periods, some nearly.
ODD_PERIODS = ("P{n}D", "P{n}", "{n}D", "PT{n}M", "P{n}M{n}Y", "P{n}DT", "p{n}w", "P-{n}D", "PT{n}D", "P{n}.5D", "", "T{n}H")


@query(f"""SELECT l_orderkey, l_linenumber, replace(list_value({", ".join(f"'{x}'" for x in ODD_PERIODS)})[1 + (l_orderkey + l_linenumber) % {len(ODD_PERIODS)}], '{{n}}', l_partkey::VARCHAR) AS said,
  list_value(true, false, false, true, false, true, true, false, false, false, false, false)[1 + (l_orderkey + l_linenumber) % {len(ODD_PERIODS)}] AS valid FROM lineitem""")
def period_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Which of a row's texts are periods."""
    shapes = F.get(F.array(*[F.lit(x) for x in ODD_PERIODS]), ((F.col("l_orderkey") + F.col("l_linenumber")) % len(ODD_PERIODS)).cast("int"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.replace(shapes, F.lit("{n}"), F.col("l_partkey").cast("string")).alias("said"))
    return rows.withColumn("valid", periods.is_period(F.col("said")))


def _month_moved(months: str, days: int, overflow: bool) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        moved = periods.add_period(F.col("l_shipdate").cast("timestamp"), periods.parse_period(F.lit(months)), days, overflow)
        return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", shown(moved).alias("moved"))

    return run


for _name, _sign, _over, _sql in (
    ("month_overflow_add", 1, True, "date_trunc('month', l_shipdate) + INTERVAL 1 MONTH + to_days(day(l_shipdate)::INT - 1) + (l_shipdate - date_trunc('day', l_shipdate))"),
    ("month_overflow_subtract", -1, True, "date_trunc('month', l_shipdate) - INTERVAL 1 MONTH + to_days(day(l_shipdate)::INT - 1) + (l_shipdate - date_trunc('day', l_shipdate))"),
    ("month_clamp_add", 1, False, "l_shipdate + INTERVAL 1 MONTH"),
):
    QUERIES[_name] = _month_moved("P1M", _sign, _over)
    ORACLES[_name] = f"SELECT l_orderkey, l_linenumber, strftime({_sql}, '%Y-%m-%d %H:%M:%S') AS moved FROM lineitem"


@query("SELECT year, epoch_ms(make_timestamp(year, 1, 1, 0, 0, 0)) AS millis, strftime(make_timestamp(year, 1, 1, 0, 0, 0), '%Y') AS label FROM (SELECT DISTINCT year(o_orderdate) - 90 AS year FROM orders)")
def year_instants(spark: SparkSession, sf: str) -> DataFrame:
    years = table(spark, sf, "orders").select((F.year("o_orderdate").cast("long") - 90).alias("year")).distinct()
    at = periods.year_millis(F.col("year").cast("int"))
    return years.select("year", at.alias("millis"), F.date_format(F.timestamp_millis(at), "yyyy").alias("label"))


@query("""WITH e AS (SELECT event_id, event_type, date_trunc('second', ts) AS ts FROM events), axis AS (SELECT DISTINCT ts AS t FROM e WHERE event_type = 'purchase')
  SELECT event_id, strftime(coalesce(t, (SELECT min(t) FROM axis)), '%Y-%m-%d %H:%M:%S') AS sought FROM e ASOF LEFT JOIN axis ON e.ts >= axis.t""")
def asof_seek(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "ts", "event_type")
    found = timeline.seek_join(rows, "ts", rows.filter("event_type = 'purchase'"), "ts")
    return found.select("event_id", shown("sought").alias("sought"))


AXIS = "WITH axis AS (SELECT DISTINCT user_id, date_trunc('second', ts) AS t FROM events), placed AS (SELECT *, (row_number() OVER w - 1)::INT AS index, (count(*) OVER (PARTITION BY user_id) - 1)::INT AS last FROM axis WINDOW w AS (PARTITION BY user_id ORDER BY t)) "


def user_axis(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("user_id", F.col("ts").alias("t")).distinct()


def _moved(step: int, loop: bool) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return timeline.cursor(user_axis(spark, sf), "user_id", "t", step, loop).select("user_id", shown("t").alias("t"), "index", shown("moved").alias("moved"))

    return run


for _name, _step, _loop in (("next_time_clamp", 3, False), ("next_time_wrap", 3, True), ("previous_time_clamp", -2, False), ("previous_time_wrap", -2, True)):
    _to = f"CASE WHEN index + {_step} > last THEN {'0' if _loop else 'last'} WHEN index + {_step} < 0 THEN {'last' if _loop else '0'} ELSE index + {_step} END"
    QUERIES[_name] = _moved(_step, _loop)
    ORACLES[_name] = AXIS + f"""SELECT p.user_id, strftime(p.t, '%Y-%m-%d %H:%M:%S') AS t, p.index, strftime(q.t, '%Y-%m-%d %H:%M:%S') AS moved
      FROM (SELECT *, {_to} AS target FROM placed) p JOIN placed q ON p.user_id = q.user_id AND q.index = p.target"""


@query(AXIS + """SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, coalesce(array_to_string(list_transform(list(t) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING),
  lambda x: strftime(x, '%Y-%m-%d %H:%M:%S')), ','), '') AS ahead FROM axis""")
def lookahead_list(spark: SparkSession, sf: str) -> DataFrame:
    rows = timeline.lookahead(user_axis(spark, sf), "user_id", "t", 4)
    return rows.select("user_id", shown("t").alias("t"), instants(F.col("ahead")).alias("ahead"))


@query("""WITH axis AS (SELECT user_id, event_id, value > 5 AS ready FROM events) SELECT user_id, event_id, CASE WHEN count(*) OVER w < 5 THEN 5 ELSE coalesce(sum(ready::INT) OVER w, 0) END::BIGINT AS ready_ahead
  FROM axis WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)""")
def lookahead_ready(spark: SparkSession, sf: str) -> DataFrame:
    axis = table(spark, sf, "events").select("user_id", "event_id", (F.col("value") > 5).alias("ready"))
    return timeline.ready_ahead(axis, "user_id", "event_id", "ready", 5).drop("ready")


@query("SELECT user_id, date_trunc('day', ts)::DATE::VARCHAR AS day, bool_and(value > 1) AS all_ready FROM events GROUP BY ALL")
def all_ready(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    return days.groupBy("user_id", "day").agg(F.bool_and(F.col("value") > 1).alias("all_ready"))


@query(AXIS + """, low AS (SELECT user_id, coalesce(max(t) FILTER (t <= TIMESTAMP '2024-01-08'), min(t)) AS a, coalesce(max(t) FILTER (t <= TIMESTAMP '2024-01-20'), min(t)) AS b FROM axis GROUP BY user_id)
  SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t FROM axis JOIN low USING (user_id) WHERE t BETWEEN a AND b""")
def limits_range(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda d: F.lit(d).cast("timestamp")
    return timeline.limited(user_axis(spark, sf), "user_id", "t", at("2024-01-08"), at("2024-01-20")).select("user_id", shown("t").alias("t"))


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW) AS trailing FROM events""")
def trailing_window(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.trailing_count(events(spark, sf), "user_id", "ts", 2 * 86400).select("event_id", "trailing")


@query("""WITH e AS (SELECT event_id, user_id, event_type, date_trunc('second', ts) AS ts FROM events), axis AS (SELECT DISTINCT user_id, ts AS t FROM e WHERE event_type = 'purchase')
  SELECT event_id, strftime(coalesce(t, (SELECT min(t) FROM axis a WHERE a.user_id = e.user_id)), '%Y-%m-%d %H:%M:%S') AS sought FROM e ASOF LEFT JOIN axis ON e.user_id = axis.user_id AND e.ts >= axis.t""")
def asof_seek_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Each event seeks on the axis of its own user's purchases, which may be empty."""
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    found = timeline.seek_join(rows, "ts", rows.filter("event_type = 'purchase'"), "ts", key="user_id")
    return found.select("event_id", shown("sought").alias("sought"))


@query(AXIS + "SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, index, last FROM placed")
def axis_positions(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.positions(user_axis(spark, sf), "user_id", "t").select("user_id", shown("t").alias("t"), "index", "last")


#: A month before, one before the 31st of a short month running over.
MONTH_BEFORE = "date_trunc('month', l_shipdate) - INTERVAL 1 MONTH + to_days(day(l_shipdate)::INT - 1) + (l_shipdate - date_trunc('day', l_shipdate))"


def _shipped(low: str) -> str:
    return f"""WITH l AS (SELECT row_number() OVER () AS rid, l_suppkey, l_orderkey, l_linenumber, l_shipdate AS t, {low} AS low FROM lineitem)
  SELECT a.l_orderkey, a.l_linenumber, count(b.t) AS trailing FROM l a JOIN l b ON a.l_suppkey = b.l_suppkey AND b.t <= a.t AND (a.low IS NULL OR b.t >= a.low) GROUP BY a.rid, a.l_orderkey, a.l_linenumber"""


def _shipments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("t"))


@query(_shipped(MONTH_BEFORE))
def trailing_month(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments of a supplier within a calendar month up to each one."""
    found = timeline.trailing_period(_shipments(spark, sf), "l_suppkey", "t", periods.parse_period(F.lit("P1M")))
    return found.select("l_orderkey", "l_linenumber", "trailing")


@query(_shipped(f"CASE l_linenumber % 4 WHEN 0 THEN l_shipdate - INTERVAL 1 YEAR WHEN 1 THEN l_shipdate - INTERVAL 36 HOUR WHEN 2 THEN {MONTH_BEFORE} END").replace("INTERVAL 1 YEAR", "INTERVAL 365 DAY"))
def trailing_periods_and_open(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that differ from row to row: 365 days, 36 hours, a month, or no lower end."""
    said = F.get(F.array(F.lit("P365D"), F.lit("PT36H"), F.lit("P1M"), F.lit(None).cast("string")), F.col("l_linenumber") % 4)
    found = timeline.trailing_period(_shipments(spark, sf), "l_suppkey", "t", periods.parse_period(said))
    return found.select("l_orderkey", "l_linenumber", "trailing")


STEPPED = AXIS + """, one AS (SELECT *, CASE WHEN index + 2 > last THEN 0 ELSE index + 2 END AS a FROM placed), two AS (SELECT *, CASE WHEN a + 2 > last THEN 0 ELSE a + 2 END AS b FROM one),
  three AS (SELECT *, CASE WHEN b + 2 > last THEN 0 ELSE b + 2 END AS c FROM two), times AS (SELECT user_id, list(t ORDER BY t) AS ts FROM axis GROUP BY user_id) """


@query(STEPPED + """SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, array_to_string(list_transform(CASE index WHEN a THEN [] WHEN b THEN [a] WHEN c THEN [a, b] ELSE [a, b, c] END,
  lambda i: strftime(ts[i + 1], '%Y-%m-%d %H:%M:%S')), ',') AS ahead FROM three JOIN times USING (user_id)""")
def lookahead_loop(spark: SparkSession, sf: str) -> DataFrame:
    rows = timeline.lookahead(user_axis(spark, sf), "user_id", "t", 3, step=2, loop=True)
    return rows.select("user_id", shown("t").alias("t"), instants(F.col("ahead")).alias("ahead"))


@query(STEPPED + """SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, (second(ts[a + 1]) % 3 = 0)::BIGINT + (second(ts[b + 1]) % 3 = 0)::BIGINT + (second(ts[c + 1]) % 3 = 0)::BIGINT AS ready_ahead
  FROM three JOIN times USING (user_id)""")
def lookahead_ready_loop(spark: SparkSession, sf: str) -> DataFrame:
    axis = user_axis(spark, sf).withColumn("ready", F.second("t") % 3 == 0)
    return timeline.ready_ahead(axis, "user_id", "t", "ready", 3, step=2, loop=True).select("user_id", shown("t").alias("t"), "ready_ahead")


@query(AXIS + """, lim AS (SELECT *, least(last, 6) AS high FROM placed), ahead AS (SELECT p.user_id, p.index, p.t, p.high, count(q.t) AS seen, count(q.t) FILTER (second(q.t) % 3 = 0) AS n
  FROM lim p LEFT JOIN lim q ON p.user_id = q.user_id AND q.index < p.index AND q.index >= p.index - 4 AND q.index >= 2 AND p.index - 1 <= p.high GROUP BY ALL)
  SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, CASE WHEN index - 4 < 2 OR index - 1 > high THEN 4 ELSE n END::BIGINT AS ready_ahead FROM ahead""")
def ready_behind_within_limits(spark: SparkSession, sf: str) -> DataFrame:
    axis = user_axis(spark, sf).withColumn("ready", F.second("t") % 3 == 0)
    return timeline.ready_ahead(axis, "user_id", "t", "ready", 4, step=-1, lower=2, upper=6).select("user_id", shown("t").alias("t"), "ready_ahead")


LATE = "WITH a AS (SELECT user_id, date_trunc('day', ts) AS t FROM events WHERE event_type = 'click' AND user_id % 3 <> 0), b AS (SELECT user_id, date_trunc('day', ts) AS t FROM events WHERE event_type = 'view') "


def _set(mode: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        days = lambda kind: table(spark, sf, "events").filter(F.col("event_type") == kind).select("user_id", F.date_trunc("DAY", F.col("ts").cast("timestamp")).alias("t"))
        return timeline.set_times(days("click").filter("user_id % 3 <> 0"), days("view"), "user_id", "t", mode).select("user_id", shown("t").alias("t"))

    return run


for _name, _mode, _sql in (
    ("set_times_intersect", "intersect", "SELECT * FROM a INTERSECT SELECT * FROM b UNION SELECT * FROM b WHERE user_id NOT IN (SELECT user_id FROM a)"),
    ("set_times_union", "union", "SELECT * FROM a UNION SELECT * FROM b"),
    ("set_times_extremes", "extremes", "SELECT user_id, unnest(generate_series(min(t), max(t), INTERVAL 1 DAY)) AS t FROM b GROUP BY user_id"),
):
    QUERIES[_name] = _set(_mode)
    ORACLES[_name] = f"{LATE}SELECT user_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS t FROM ({_sql})"


@query(SPANS + f"""kinds AS (SELECT o_orderkey, a, b, CASE o_orderkey % 4 WHEN 0 THEN [a, b] WHEN 1 THEN generate_series(a, a + INTERVAL 3 DAY, INTERVAL 1 DAY) WHEN 2 THEN [a, a + INTERVAL 36 HOUR, a + INTERVAL 60 HOUR] ELSE [] END AS t FROM spans)
  SELECT o_orderkey, {LIST.format('list_sort(t)')} AS times FROM kinds""")
def axis_options(spark: SparkSession, sf: str) -> DataFrame:
    """A list of times, an interval by days, one with a period, or nothing."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    a, b, kind = F.col("o_orderdate"), F.array_max("times"), F.col("o_orderkey") % 4
    times = F.when(kind == 0, F.concat(day(b), F.lit(","), day(a)))
    interval = F.when(kind == 1, F.concat(day(a), F.lit("/P3D"))).when(kind == 2, F.concat(day(a), F.lit("/PT60H")))
    period = F.when(kind == 2, F.lit("PT36H"))
    return order_spans(spark, sf).select("o_orderkey", instants(timeline.axis_from_options(times, interval, period)).alias("times"))


@query(f"""WITH kinds AS (SELECT o_orderkey, o_orderdate AS a, CASE o_orderkey % 3 WHEN 0 THEN generate_series(a, a + INTERVAL 4 DAY, INTERVAL 1 DAY) WHEN 1 THEN [a, a + INTERVAL 48 HOUR, a + INTERVAL 4 DAY] END AS t FROM orders)
  SELECT o_orderkey, {LIST.format('t')} AS times FROM kinds""")
def range_string(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges by days where no period is given, by one that is, and null for what can't be read."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    a, kind = F.col("o_orderdate"), F.col("o_orderkey") % 3
    ends = F.concat(day(a), F.lit("/"), day(F.date_add(a, 4)))
    said = F.when(kind == 0, ends).when(kind == 1, F.concat(ends, F.lit("/PT48H"))).otherwise(F.concat(ends, F.lit("/P99999999999D")))
    return table(spark, sf, "orders").select("o_orderkey", instants(timeline.parse_range(said)).alias("times"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS times FROM orders")
def times_with_unreadable_ranges(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    said = F.concat(F.lit("junk/2020-01-02/P1D,"), day, F.lit(",2020-01-01/2020-01-03/P1X,2020-13-01,"))
    return table(spark, sf, "orders").select("o_orderkey", instants(timeline.parse_times(said)).alias("times"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 3 WHEN 3 THEN 2 WHEN 5 THEN 1 END AS n, CASE o_orderkey % 6 WHEN 1 THEN 'a range can''t be stepped through by a period of zero'
  WHEN 2 THEN 'a range has more than 10000000 steps' END AS problem FROM orders""")
def range_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of which some have a period of zero, too many steps, a number beyond all bounds, or nothing to step through."""
    kinds = ("2000-01-01/2000-01-03/P1D", "2000-01-01/2000-01-03/P0D", "1700-01-01/2500-01-01/PT1S", "2000-01-01/2000-01-03/P2147483647DT24H", "2000-01-01/junk/P1D", "2000-01-01/2000-01-01/P0D")
    said = F.split(F.get(F.array(*[F.lit(k) for k in kinds]), (F.col("o_orderkey") % 6).cast("int")), "/")
    start, end = (periods.parse_instant(F.get(said, F.lit(i))) for i in (0, 1))
    period = periods.parse_period(F.get(said, F.lit(2)), carry=True)
    return table(spark, sf, "orders").select("o_orderkey", F.size(timeline.explode_range(start, end, period)).alias("n"), timeline.range_problem(start, end, period).alias("problem"))


@query("""WITH ticks AS (SELECT user_id, ts, unnest([date_trunc('day', ts) + INTERVAL 1 DAY, date_trunc('day', ts) + INTERVAL 2 DAY]) AS tick FROM events)
  SELECT strftime(tick, '%Y-%m-%d %H:%M:%S') AS tick, user_id, count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last FROM ticks GROUP BY ALL""")
def ticking_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots.ticking_counts(events(spark, sf), "ts", "user_id", "2 days", "1 day")
    return rows.select(shown("tick").alias("tick"), "user_id", "n", shown("last").alias("last"))


# --- layers ------------------------------------------------------------------------------------------------------

TRACKS = "WITH tracks AS (SELECT o_orderkey, list(l_shipdate ORDER BY l_shipdate, l_linenumber, l_quantity) AS ts, list(l_quantity::INT ORDER BY l_shipdate, l_linenumber, l_quantity) AS ps FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey) "
LOW, HIGH = "1997-06-01", "1998-03-01"


def _window() -> tuple[Column, Column]:
    return F.lit(LOW).cast("timestamp"), F.lit(HIGH).cast("timestamp")


@query(TRACKS + f"SELECT o_orderkey FROM tracks WHERE NOT (ts[1] > TIMESTAMP '{HIGH}' OR ts[-1] < TIMESTAMP '{LOW}')")
def overlap_filter(spark: SparkSession, sf: str) -> DataFrame:
    return order_spans(spark, sf).filter(layers.overlaps(F.col("times"), *_window())).select("o_orderkey")


@query(TRACKS + """, ticks AS (SELECT t - INTERVAL 7 DAY AS low, t AS high FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS t FROM orders))
  SELECT strftime(high, '%Y-%m-%d') AS tick, o_orderkey FROM ticks JOIN tracks ON ts[-1] >= low AND ts[1] <= high""")
def overlap_join(spark: SparkSession, sf: str) -> DataFrame:
    month = table(spark, sf, "orders").select(F.date_trunc("MONTH", F.col("o_orderdate").cast("timestamp")).alias("high")).distinct()
    ticks = month.withColumn("low", F.timestamp_micros(F.unix_micros("high") - 7 * 86400 * 1000000))
    spans = order_spans(spark, sf).select("o_orderkey", F.get("times", F.lit(0)).alias("first"), F.element_at("times", -1).alias("last"))
    return layers.overlap_join(ticks, spans).select(F.date_format("high", "yyyy-MM-dd").alias("tick"), "o_orderkey")


@query(TRACKS + """, ticks AS (SELECT t - INTERVAL 7 DAY AS low, t AS high FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS t FROM orders)),
  spans AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN ts[1] - INTERVAL 9000 DAY WHEN 1 THEN ts[-1] ELSE ts[1] END AS a, CASE o_orderkey % 7 WHEN 2 THEN ts[1] + INTERVAL 40 SECOND ELSE ts[-1] END AS b FROM tracks)
  SELECT strftime(high, '%Y-%m-%d') AS tick, o_orderkey FROM ticks JOIN spans ON b >= low AND a <= high""")
def overlap_join_of_any_length(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of no length, of seconds, of months and of decades against windows of a week."""
    month = table(spark, sf, "orders").select(F.date_trunc("MONTH", F.col("o_orderdate").cast("timestamp")).alias("high")).distinct()
    ticks = month.withColumn("low", F.timestamp_micros(F.unix_micros("high") - 7 * 86400 * 1000000))
    a, b, kind = F.get("times", F.lit(0)), F.element_at("times", -1), F.col("o_orderkey") % 7
    moved = lambda t, seconds: F.timestamp_micros(F.unix_micros(t) + seconds * 1000000)
    first = F.when(kind == 0, moved(a, -9000 * 86400)).when(kind == 1, b).otherwise(a)
    spans = order_spans(spark, sf).select("o_orderkey", first.alias("first"), F.when(kind == 2, moved(a, 40)).otherwise(b).alias("last"))
    return layers.overlap_join(ticks, spans).select(F.date_format("high", "yyyy-MM-dd").alias("tick"), "o_orderkey")


@query(TRACKS + f"""SELECT o_orderkey, array_to_string(list_transform(list_filter(list_zip(ts, ps), lambda x: x[1] <= TIMESTAMP '{HIGH}' AND (x[1] > TIMESTAMP '{LOW}' OR ts[-1] <= TIMESTAMP '{LOW}')), lambda x: x[2]), ',') AS points
  FROM tracks WHERE NOT (ts[1] > TIMESTAMP '{HIGH}' OR ts[-1] < TIMESTAMP '{LOW}')""")
def track_slice(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.transform("points", lambda x: x.cast("int"))
    cut = layers.track_slice(F.col("times"), whole, *_window())
    return order_spans(spark, sf).select("o_orderkey", joined(cut).alias("points")).filter("points is not null")


@query(TRACKS + f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '[' || ps[1] || ',' || len(ps) || ']' ELSE '[' || array_to_string(list_transform(list_filter(list_zip(ts, ps, range(len(ps))),
  lambda x: x[1] <= TIMESTAMP '{HIGH}' AND (x[1] > TIMESTAMP '{LOW}' OR ts[-1] <= TIMESTAMP '{LOW}')), lambda x: '[' || x[2] || ',' || x[3] || ']'), ',') || ']' END AS coordinates
  FROM tracks WHERE NOT (ts[1] > TIMESTAMP '{HIGH}' OR ts[-1] < TIMESTAMP '{LOW}')""")
def geometry_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates as JSON text: lines lose the points outside the window, points stay as they are."""
    line = F.transform("points", lambda p, i: F.concat(F.lit("["), p.cast("int").cast("string"), F.lit(", "), i.cast("string"), F.lit("]")))
    point = F.concat(F.lit("["), F.get("points", F.lit(0)).cast("int").cast("string"), F.lit(","), F.size("points").cast("string"), F.lit("]"))
    text_ = F.when(F.col("o_orderkey") % 3 == 0, point).otherwise(F.concat(F.lit("[ "), joined(line), F.lit("]")))
    cut = layers.geometry_slice(text_, F.col("times"), *_window())
    # A filter on the text would be worked out by itself before it.
    return order_spans(spark, sf).select("o_orderkey", F.explode(F.array_compact(F.array(cut))).alias("coordinates"))


@query(TRACKS + "SELECT o_orderkey, ps[-1] AS point, strftime(ts[-1], '%Y-%m-%d') AS at FROM tracks")
def track_last_point(spark: SparkSession, sf: str) -> DataFrame:
    last = lambda c: F.element_at(c, -1)
    return order_spans(spark, sf).select("o_orderkey", last("points").cast("int").alias("point"), F.date_format(last("times"), "yyyy-MM-dd").alias("at"))


@query(TRACKS + """SELECT o_orderkey, array_to_string(ps, ',') AS points, false AS last FROM tracks UNION ALL SELECT o_orderkey, ps[-1]::VARCHAR, true FROM tracks""")
def track_with_last_point(spark: SparkSession, sf: str) -> DataFrame:
    tracks = order_spans(spark, sf).select("o_orderkey", F.transform("points", lambda x: x.cast("int")).alias("points"))
    return layers.with_last_points(tracks, "points").select("o_orderkey", joined("points").alias("points"), "last")


@query(TRACKS + f"""SELECT o_orderkey, len(t)::INT AS n FROM (SELECT o_orderkey, list_filter(ts, lambda x: x >= TIMESTAMP '1998-01-01') AS t FROM tracks)
  WHERE len(t) = 0 OR NOT (t[1] > TIMESTAMP '{HIGH}' OR t[-1] < TIMESTAMP '{LOW}')""")
def overlap_or_untimed(spark: SparkSession, sf: str) -> DataFrame:
    late = F.filter("times", lambda t: t >= F.lit("1998-01-01").cast("timestamp"))
    rows = order_spans(spark, sf).select("o_orderkey", late.alias("t"))
    return rows.filter(layers.overlaps(F.col("t"), *_window())).select("o_orderkey", F.size("t").alias("n"))


@query("""SELECT user_id, string_agg(event_id || ':' || CASE WHEN event_type = 'click' THEN '7' ELSE '' END || ':0', ',' ORDER BY event_id) AS features FROM events GROUP BY user_id""")
def stamped_features(spark: SparkSession, sf: str) -> DataFrame:
    """A collection for each user from JSON text; every feature gets level 0, those of clicks the time 7."""
    rows = table(spark, sf, "events")
    feature = F.concat(F.lit('{"type":"Feature","properties":{"level":'), F.col("event_id").cast("string"), F.lit(',"time":3},"geometry":{"type":"'), "event_type", F.lit('"}}'))
    parts = F.sort_array(F.collect_list(F.struct("event_id", feature.alias("json"))))
    listed = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform(parts, lambda x: x["json"]), ","), F.lit("]}"))
    read = rows.groupBy("user_id").agg(listed.alias("doc")).select("user_id", F.from_json("doc", schemas.FEATURES).alias("x"))
    ids = F.transform("x.features", lambda f: f["properties"]["level"])
    clicks = layers.stamped(F.filter("x.features", lambda f: f["geometry"]["type"] == "click"), F.lit(7).cast("long"), F.lit(0))
    others = layers.stamped(F.filter("x.features", lambda f: f["geometry"]["type"] != "click"), F.lit(None).cast("long"), F.lit(0))
    kinds = F.transform("x.features", lambda f: f["geometry"]["type"] == "click")
    props = lambda fs: F.get(fs, F.lit(0))["properties"]
    shown_ = lambda p: F.concat(F.coalesce(p["time"].cast("string"), F.lit("")), F.lit(":"), p["level"].cast("string"))
    rows = read.select("user_id", ids.alias("ids"), kinds.alias("kinds"), shown_(props(clicks)).alias("hit"), shown_(props(others)).alias("miss"))
    pairs = F.transform(F.arrays_zip("ids", "kinds"), lambda x: F.concat_ws(":", x["ids"].cast("string"), F.when(x["kinds"], F.col("hit")).otherwise(F.col("miss"))))
    return rows.select("user_id", joined(pairs).alias("features"))


@query("SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'No data' WHEN 1 THEN 'NaN' ELSE printf('%.2f', floor(l_quantity * 12.5 + 0.5) / 100) END AS said FROM lineitem")
def number_or_text(spark: SparkSession, sf: str) -> DataFrame:
    """Eighths, of which every second one lies half-way between two numbers of two decimals."""
    kind = F.col("l_linenumber") % 4
    raw = F.when(kind == 0, "No data").when(kind == 1, "NaN").otherwise((F.col("l_quantity").cast("double") / 8).cast("string"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.number_or_text(raw).alias("said"))


@query("""SELECT l_orderkey, l_linenumber, floor(l_quantity / nullif(l_linenumber - 1, 0) * 100)::BIGINT AS percent, floor(10000 / nullif(l_linenumber - 1, 0) + 0.5) / 10 AS fps,
  l_quantity / nullif((l_linenumber - 1) / 200, 0) AS x FROM lineitem""")
def zero_divisors(spark: SparkSession, sf: str) -> DataFrame:
    q, n = F.col("l_quantity"), F.col("l_linenumber") - 1
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.percent_floor(q, n).alias("percent"), text.frames_per_second(n).alias("fps"), text.rescale(q, F.lit(0), n, F.lit(200)).alias("x"),
    )


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN (props->>'$.k') WHEN 1 THEN (props->>'$.k') || ',7' ELSE '' END AS times FROM events")
def json_property_probe(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 3
    doc = F.when(kind == 0, F.replace("props", F.lit('"k"'), F.lit('"time"'))).when(
        kind == 1, F.concat(F.lit('{"times": ['), F.regexp_extract("props", r"(\d+)", 1), F.lit('], "time": 3}')))
    doc = F.when(kind == 1, F.replace(doc, F.lit("], "), F.lit(", 7], "))).otherwise(F.coalesce(doc, F.lit("{}")))
    shape = "time bigint, times array<bigint>, coordTimes array<bigint>, linestringTimestamps array<bigint>"
    rows = table(spark, sf, "events").select("event_id", F.from_json(doc, shape).alias("p"))
    return rows.select("event_id", joined(layers.feature_times(F.col("p"))).alias("times"))


@query("""WITH a AS (SELECT user_id, list_distinct(list(day(ts))) AS days FROM events GROUP BY user_id) SELECT e.user_id, e.event_id AS feature, (e.event_id % 4)::BIGINT AS level FROM events e
  UNION ALL SELECT user_id, -n_nationkey - 1, 0 FROM a CROSS JOIN nation WHERE list_contains(days, 11)""")
def layer_union_conditional(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events")
    days = rows.groupBy("user_id").agg(F.collect_set(F.dayofmonth("ts")).alias("years"))
    features = rows.select("user_id", F.col("event_id").alias("feature"), (F.col("event_id") % 4).alias("level")).join(days, "user_id")
    mask = table(spark, sf, "nation").select((-F.col("n_nationkey").cast("long") - 1).alias("feature"), F.lit(0).cast("long").alias("level"))
    return layers.with_mask(features, mask, "user_id", "years", 11)


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '#DCDCDC' WHEN 1 THEN '#6baed6' WHEN 2 THEN '#4292c6' WHEN 3 THEN '#2171b5' END AS fill FROM part")
def level_style(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", layers.fill(F.col("p_size") % 5).alias("fill"))


@query("""SELECT l_orderkey, l_linenumber, floor((floor((least(greatest(l_quantity, 2), 40) - 2) / 0.5 + 0.5) * 0.5 + 2) * 100 + 0.5) / 100 AS snapped, floor(l_quantity / 50 * 100)::BIGINT AS percent,
  floor(10000 / (l_quantity * 100) + 0.5) / 10 AS fps, (l_quantity - 1) / (49.0 / 200) AS x FROM lineitem""")
def snap_to_step(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", text.snap_to_step(q, F.lit(2), F.lit(40), 0.5).alias("snapped"), text.percent_floor(q, F.lit(50)).alias("percent"),
        text.frames_per_second(q * 100).alias("fps"), text.rescale(q, F.lit(1), F.lit(50.0), F.lit(200)).alias("x"),
    )


@query("SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS t FROM lineitem")
def feature_times(spark: SparkSession, sf: str) -> DataFrame:
    return order_spans(spark, sf).select(F.explode("times").alias("t")).distinct().select(F.date_format("t", "yyyy-MM-dd").alias("t"))


MASKED = 1997
LAYER_STAR = STAR.replace("quantile_disc(freq, 0.95)", "quantile_disc(freq, 0.5)")


def _written_layers(spark: SparkSession, sf: str) -> str:
    """Layer files of every name and year that is sold, some lines of them broken; as many features as the count's last
    digit says."""
    freq = analogue.frequencies(spark, sf)
    level = lambda i: F.concat(F.lit('{"type":"Feature","properties":{"level":'), (i % 4).cast("string"), F.lit('},"geometry":{"type":"Polygon","coordinates":"[]"}}'))
    features = joined(F.transform(F.sequence(F.lit(1), F.col("freq") % 10 + 1), level))
    line = F.concat(F.lit('{"surname":"'), "surname", F.lit('","type":"FeatureCollection","features":['), features, F.when(F.col("freq") % 11 == 0, "").otherwise("]}"))
    folder = folders.fresh(spark)
    freq.select(line.alias("value"), F.substring("surname", 1, 2).alias("prefix"), "year").repartition("prefix", "year").write.partitionBy("prefix", "year").text(folder)
    return folder


@query(LAYER_STAR + f""", wanted AS (SELECT c.surname, k.year, f.freq FROM (SELECT DISTINCT surname FROM classed WHERE status = 'found') c JOIN kde k ON c.surname = k.surname JOIN frq f ON f.surname = k.surname AND f.year = k.year
    WHERE NOT coalesce(k.year IN (0, 1996, 1998), false)),
  own AS (SELECT surname, year, unnest(range(1, freq % 10 + 2)) % 4 AS level FROM wanted WHERE freq % 11 <> 0)
  SELECT surname, epoch_ms(make_timestamp(year, 1, 1, 0, 0, 0)) AS time, level::INT AS level, count(*) AS features FROM own GROUP BY ALL
  UNION ALL SELECT surname, epoch_ms(make_timestamp({MASKED}, 1, 1, 0, 0, 0)), 9, (SELECT count(*) FROM nation) FROM wanted WHERE year = {MASKED}""")
def layer_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The layers of every found name's kept years from files, with their years' times, and the mask of one year from a
    file of its own."""
    freq = analogue.frequencies(spark, sf)
    names = table(spark, sf, "part").select(text.name_key(text.name_form(F.col("p_name"))).alias("surname")).distinct()
    found = membership.classify(membership.prepared(names, "surname"), analogue.thresholded(freq, 0.5), names, list(analogue.EXCLUDED)).filter("status = 'found'")
    wanted = found.select("surname", F.explode("years").alias("year"))
    read = tables.read_wanted_layers(spark, _written_layers(spark, sf), wanted)
    stamped = read.select("surname", F.explode(layers.stamped(F.col("features"), periods.year_millis(F.col("year")))).alias("feature"))
    mask = folders.fresh(spark)
    feature = F.concat(F.lit('{"type":"Feature","properties":{"level":9},"geometry":{"type":"Point","coordinates":"['), F.col("n_nationkey").cast("string"), F.lit(']"}}'))
    listed = F.array_join(F.collect_list(feature), ",\n")
    table(spark, sf, "nation").agg(F.concat(F.lit('{"type":"FeatureCollection",\n"features":['), listed, F.lit("]}")).alias("value")).coalesce(1).write.text(mask)
    scene = layers.stamped(F.array("feature"), periods.year_millis(F.lit(MASKED)))
    masks = tables.read_mask(spark, mask).select(F.get(scene, F.lit(0)).alias("feature"))
    years = wanted.groupBy("surname").agg(F.collect_list("year").alias("years"))
    both = stamped.unionByName(layers.with_mask(years, masks, "surname", "years", MASKED).filter("feature is not null"))
    return both.groupBy("surname", F.col("feature.properties.time").alias("time"), F.col("feature.properties.level").alias("level")).agg(F.count("*").alias("features"))


@query(STAR + "SELECT surname[1:2] AS prefix, year, count(*) AS broken FROM frq WHERE freq % 11 = 0 GROUP BY ALL")
def broken_layer_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of layer files that are no layer, by folder."""
    return tables.broken_layers(spark, _written_layers(spark, sf)).groupBy("prefix", "year").agg(F.count("*").alias("broken"))


_COLOURS = ", ".join(f"('{s}', '{c}', '{x}')" for s, cs in codes.COLOURS[codes.EDITION].items() for c, x in cs.items())
_SCHEMES = tuple(codes.COLOURS[codes.EDITION])


@query(f"""WITH known(scheme, code, colour) AS (VALUES {_COLOURS}), asked AS (SELECT l_orderkey, l_linenumber, list_value({", ".join(f"'{x}'" for x in _SCHEMES)})[1 + l_orderkey % {len(_SCHEMES)}] AS scheme,
    CASE WHEN l_partkey % 13 = 0 THEN '99' WHEN l_orderkey % {len(_SCHEMES)} = 0 THEN (l_partkey % 10)::VARCHAR || chr((97 + l_suppkey % 4)::INT) WHEN l_orderkey % {len(_SCHEMES)} = 1 THEN chr((65 + l_partkey % 9)::INT) || (l_suppkey % 4)
    WHEN l_partkey % 17 <> 0 THEN (l_partkey % 12)::VARCHAR END AS code FROM lineitem)
  SELECT a.l_orderkey, a.l_linenumber, coalesce(k.colour, g.colour) AS colour, CASE WHEN k.colour IS NOT NULL THEN 'code' WHEN g.colour IS NOT NULL THEN 'group' ELSE 'none' END AS matched
  FROM asked a LEFT JOIN known k ON a.scheme = k.scheme AND a.code = k.code LEFT JOIN known g ON a.scheme = g.scheme AND a.scheme IN ('oac', 'loac') AND a.code <> '99' AND a.code[1] = g.code""")
def code_colours(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of all schemes, some of a group only, some unknown, some null."""
    kind, part, supp = (F.col("l_orderkey") % len(_SCHEMES)).cast("int"), F.col("l_partkey"), F.col("l_suppkey")
    nested = lambda base, n: F.char(base + part % n)
    code = F.when(part % 13 == 0, "99").when(kind == 0, F.concat((part % 10).cast("string"), F.char(97 + supp % 4))).when(kind == 1, F.concat(nested(65, 9), (supp % 4).cast("string")))
    code = code.when(part % 17 != 0, (part % 12).cast("string"))
    scheme = F.get(F.array(*[F.lit(s) for s in _SCHEMES]), kind)
    return codes.coloured(table(spark, sf, "lineitem"), scheme, code).select("l_orderkey", "l_linenumber", "colour", "matched")


# --- what feeds the star ------------------------------------------------------------------------------------------


@query(STAR + "SELECT surname, count(*) AS bearers FROM sold GROUP BY surname HAVING count(*) >= 100")
def suppress_small(spark: SparkSession, sf: str) -> DataFrame:
    return analogue.sales(spark, sf).groupBy("surname").agg(F.count("*").alias("bearers")).filter("bearers >= 100")


@query(STAR + """SELECT surname, p_brand, n, place FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY n DESC, p_brand)::INT AS place FROM (SELECT surname, p_brand, count(*) AS n FROM sold GROUP BY ALL)) WHERE place <= 5""")
def topk_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return dossier.top_k(analogue.sales(spark, sf, "p_brand"), "surname", "p_brand", 5)


@query(STAR + """SELECT surname, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY surname ORDER BY n DESC, o_orderpriority) AS k FROM (SELECT surname, o_orderpriority, count(*) AS n FROM prio GROUP BY ALL)) WHERE k = 1""")
def mode_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return dossier.modal_pick(analogue.priorities(spark, sf), "surname", "o_orderpriority")


@query("""WITH d AS (SELECT o_custkey, ntile(10) OVER (ORDER BY o_totalprice, o_orderkey)::INT AS decile FROM orders)
  SELECT o_custkey, decile, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, decile) AS k FROM (SELECT o_custkey, decile, count(*) AS n FROM d GROUP BY ALL)) WHERE k = 1""")
def ntile_mode(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return dossier.modal_pick(ranking.tiled(rows, "o_totalprice", "o_orderkey", 10, "decile"), "o_custkey", "decile")


@query("""WITH r AS (SELECT o_custkey, percent_rank() OVER (ORDER BY o_totalprice)::DECIMAL(18, 9) AS p FROM orders),
  s AS (SELECT o_custkey, count(*) AS n, sum(p)::DOUBLE AS s, sum(p * p)::DOUBLE AS ss FROM r GROUP BY o_custkey)
  SELECT o_custkey, floor(s / n * 10000 + 0.5) / 10000 AS mean, CASE WHEN n > 1 THEN floor(sqrt(greatest((ss - s * s / n) / (n - 1), 0)) * 10000 + 0.5) / 10000 ELSE 0.0::DOUBLE END AS sd FROM s""")
def percent_rank_avg_sd(spark: SparkSession, sf: str) -> DataFrame:
    rows = ranking.percent_ranked(table(spark, sf, "orders").select("o_custkey", "o_totalprice"), "o_totalprice", "p")
    # Sums of decimals don't depend on the order of rows.
    ranked = rows.withColumn("p", F.col("p").cast("decimal(18,9)")).groupBy("o_custkey")
    sums = ranked.agg(F.count("*").alias("n"), F.sum("p").cast("double").alias("s"), F.sum(F.col("p") * F.col("p")).cast("double").alias("ss"))
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    sd = F.when(n > 1, text.half_up(F.sqrt(F.greatest((ss - s * s / n) / (n - 1), F.lit(0.0))) * 10000) / 10000).otherwise(F.lit(0.0))
    return sums.select("o_custkey", (text.half_up(s / n * 10000) / 10000).alias("mean"), sd.alias("sd"))


@query("SELECT s_suppkey, n_name AS place, n_nationkey * 1.5::DOUBLE AS x, r_regionkey * 2.5::DOUBLE AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def centroid_join(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    centroids = nation.select("n_nationkey", F.col("n_name").alias("place"), (F.col("n_nationkey") * 1.5).alias("x"), (F.col("r_regionkey") * 2.5).alias("y"))
    return table(spark, sf, "supplier").join(centroids, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "place", "x", "y")


@query(STAR + "SELECT surname, year, freq FROM frq")
def yearly_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return analogue.frequencies(spark, sf)
