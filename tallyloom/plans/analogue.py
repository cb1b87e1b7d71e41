"""The star of fact and lookup tables, derived from the given tables: part names stand for surnames, ship years for
years, order priorities and market segments for area groups, nations and regions for places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import name_form, name_key
from tallyloom.operators import dossier
from tallyloom.sources.tables import table

AXIS = tuple(range(1994, 2002))
EXCLUDED = (0, 1996, 1998)
LITERALS = ("", "'", "12 3", "O'Neil", "zzz")


def _key(column: str) -> Column:
    return name_key(name_form(F.col(column)))


def probes(spark: SparkSession, sf: str) -> DataFrame:
    """Every part name as it is and in another spelling, and a few odd inputs."""
    names = table(spark, sf, "part").select(F.col("p_name").alias("input")).distinct()
    spelled = names.select(F.concat(F.lit(" "), F.upper(F.replace("input", F.lit(" "), F.lit("' "))), F.lit(" 2")).alias("input"))
    return names.union(spelled).union(spark.createDataFrame([(x,) for x in LITERALS], "input string"))


def sales(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """lineitem with the surname of its part and the asked columns of either."""
    parts = table(spark, sf, "part").withColumn("surname", _key("p_name"))
    return table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select("surname", *columns)


def frequencies(spark: SparkSession, sf: str) -> DataFrame:
    years = sales(spark, sf, "l_shipdate").withColumn("year", F.year("l_shipdate"))
    return years.groupBy("surname", "year").agg(F.count("*").cast("int").alias("freq"))


def thresholded(freq: DataFrame, share: float = 0.95) -> DataFrame:
    """Rows that reach a quantile of all counts."""
    limit = freq.agg(F.expr(f"percentile_disc({share}) within group (order by freq)").alias("least"))
    return freq.join(F.broadcast(limit), F.col("freq") >= F.col("least")).drop("least")


def places(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    seller = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    sold = sales(spark, sf, "l_suppkey").distinct().join(seller, F.col("l_suppkey") == F.col("s_suppkey"))
    return sold.select("surname", F.upper("r_name").alias("regcnty"), F.col("n_name").alias("parish"), F.concat(F.lit("E"), "n_nationkey").alias("msoa11cd")).distinct()


def area_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nation.select(F.concat(F.lit("E"), "n_nationkey").alias("msoa11cd"), F.col("n_name").alias("msoa11nm"), F.col("r_name").alias("ladnm"))


def priorities(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return sales(spark, sf, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("surname", "o_orderpriority", "o_custkey")


def priority_code(column: str) -> Column:
    return F.concat(F.substring(column, 1, 1), F.lower(F.substring(column, 3, 1)))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return priorities(spark, sf).join(customer, F.col("o_custkey") == F.col("c_custkey")).select("surname", "c_mktsegment")


def groups(rows: DataFrame, value: str, code: Column, prefix: str) -> DataFrame:
    """(surname, <prefix>cd, <prefix>nm, type): every value a name has, the most frequent one as its mode."""
    modal = dossier.modal_pick(rows, "surname", value).select("surname", value, F.lit("mode").alias("type"))
    all_ = rows.select("surname", value).distinct().join(modal, ["surname", value], "left")
    return all_.select("surname", code.alias(f"{prefix}cd"), F.col(value).alias(f"{prefix}nm"), F.coalesce("type", F.lit("other")).alias("type"))


def group_lookups(spark: SparkSession, sf: str, source: str, value: str, code: Column) -> tuple[DataFrame, DataFrame]:
    codes = table(spark, sf, source).select(code.alias("groupcd"), F.col(value).alias("name")).distinct()
    top = F.substring("groupcd", 1, 1)
    names = codes.select(F.concat(F.lit("Super "), top).alias("supergroupnm"), "groupcd")
    texts = codes.select("groupcd", F.concat(F.lit("about "), "name")).union(codes.select(top, F.concat(F.lit("all of "), top))).toDF("code", "desc").distinct()
    return names, texts


def decile(column: str) -> Column:
    return F.ceil(F.col(column) / 5).cast("int")


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All fact and lookup tables by their names."""
    freq = frequencies(spark, sf)
    part = table(spark, sf, "part").withColumn("surname", _key("p_name"))
    sold = sales(spark, sf, "p_brand", "p_type", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "p_size")
    sex = F.when(F.col("l_returnflag") == "R", "F").when(F.col("l_returnflag") == "A", "M")
    status = F.when(F.col("l_linestatus") == "F", "F").when(F.col("l_linestatus") == "O", "M")
    oac, loac = priority_code("o_orderpriority"), F.concat(F.substring("c_mktsegment", 1, 1), F.lit("1"))
    oac_names, oac_texts = group_lookups(spark, sf, "orders", "o_orderpriority", oac)
    loac_names, loac_texts = group_lookups(spark, sf, "customer", "c_mktsegment", loac)
    place = places(spark, sf)
    mode = lambda rows, value, name: dossier.modal_pick(rows, "surname", value).select("surname", F.col(value).cast("int").alias(name), F.lit("mode").alias("type"))
    return {
        "names_frq": freq,
        "names_kde": thresholded(freq),
        "names_all": part.select("surname").distinct(),
        "names_fns_hist": sold.select("surname", F.col("p_brand").alias("forename"), sex.alias("sex")).distinct(),
        "names_fns_cont": sold.select("surname", F.col("p_type").alias("forename"), status.alias("sex")).distinct(),
        "names_loc_hist": place.select("surname", "regcnty", "parish"),
        "names_loc_cont": place.select("surname", "msoa11cd"),
        "names_oac21": groups(priorities(spark, sf), "o_orderpriority", oac, "oac"),
        "names_loac21": groups(segments(spark, sf), "c_mktsegment", loac, "loac"),
        "names_imd": mode(sold.withColumn("decile", decile("p_size")), "decile", "imddec"),
        "names_imd_std": sold.groupBy("surname").agg(F.avg("l_quantity").alias("avg"), F.stddev("l_quantity").alias("sd")),
        "names_ahah22": mode(sold, "l_linenumber", "ahahdec"),
        "names_iuc": part.groupBy("surname").agg(F.min(F.struct("p_size", "p_type")).alias("x")).select("surname", F.col("x.p_size").alias("iuccd"), F.col("x.p_type").alias("iucnm")),
        "names_bbs": part.groupBy("surname").agg(F.min(F.struct("p_size", "p_brand")).alias("x")).select("surname", F.col("x.p_brand").alias("bbs"), F.ceil(F.col("x.p_size") / 5).cast("int").alias("bbsdec")),
        "names_eee": part.select("surname", (F.length("surname") % 9 + 1).alias("code"), F.concat(F.lit("length "), F.length("surname")).alias("eee")).distinct(),
        "lookup_loc_cont": area_lookup(spark, sf),
        "lookup_iuc": part.select(F.col("p_size").cast("string").alias("iuccd"), F.concat(F.lit("size "), "p_size").alias("iucdesc")).distinct(),
        "lookup_oac21": oac_names,
        "lookup_oac21_desc": oac_texts,
        "lookup_loac21": loac_names,
        "lookup_loac21_desc": loac_texts,
    }


def gappy(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with rows left out, by the lengths of the names, so that every default and every failure comes up: years
    off the axis, places without district, a lookup that misses, names without forenames or other facts."""
    size = F.length("surname")
    without = {
        "names_fns_cont": size % 5 == 2, "names_loc_cont": size % 6 == 3, "names_oac21": size % 6 == 5, "names_loac21": size % 4 == 3, "names_ahah22": size % 3 == 0,
        "names_imd": size % 3 == 1, "names_imd_std": size % 4 == 0, "names_bbs": size % 4 == 1, "names_eee": size % 4 == 2,
    }
    off = t["names_all"].filter(size % 7 == 0).select("surname", F.lit(1900).alias("year"), F.lit(1).alias("freq"))
    places = t["names_loc_hist"].filter(size % 6 != 4).withColumn("regcnty", F.when(size % 7 != 1, F.col("regcnty")))
    return t | {n: t[n].filter(~c) for n, c in without.items()} | {
        "names_kde": thresholded(t["names_frq"], 0.5), "names_frq": t["names_frq"].filter(size % 9 != 0).unionByName(off), "names_loc_hist": places,
        "names_fns_hist": t["names_fns_hist"].filter((size % 5 != 2) & ((size % 5 != 3) | (F.col("sex") == "M"))),
        "lookup_iuc": t["lookup_iuc"].filter(F.col("iuccd").cast("int") % 10 != 3),
    }
