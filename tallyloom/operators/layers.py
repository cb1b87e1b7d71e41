"""Map layers: features with times, their styles, snapshots and tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.binding import let

#: Fill colours by contour level.
FILLS = {0: "#DCDCDC", 1: "#6baed6", 2: "#4292c6", 3: "#2171b5"}


def fill(level: Column) -> Column:
    """Colour of a level; null for any other."""
    out = F.when(level == 0, F.lit(FILLS[0]))
    for k in (1, 2, 3):
        out = out.when(level == k, F.lit(FILLS[k]))
    return out


def feature_times(properties: Column) -> Column:
    """Times of a feature: the first property that there is of four names; none if there is none."""
    return F.coalesce(
        properties["coordTimes"], properties["times"], properties["linestringTimestamps"],
        F.when(properties["time"].isNotNull(), F.array(properties["time"])), F.array().cast("array<bigint>"),
    )


def stamped(features: Column, time: Column | None = None, level: Column | None = None) -> Column:
    """Features of a collection with literal properties added."""

    def one(f: Column) -> Column:
        p = f["properties"]
        p = p.withField("time", time) if time is not None else p
        return f.withField("properties", p.withField("level", level) if level is not None else p)

    return F.transform(features, one)


#: Features of a mask that are broadcast, at most; a larger mask is dealt into parts of about as many, its keys too.
MASK_ROWS = 10_000


def with_mask(layers: DataFrame, mask: DataFrame, key: str, years: str, year: int) -> DataFrame:
    """Layers and, for the keys whose years hold `year`, the mask's features, in one table.

    Every such key gets every feature. The mask is counted first: it is broadcast while it is small; a larger one and
    the keys are both dealt into parts of some MASK_ROWS, and each pair of parts meets in a group of its own. A column
    of the mask with the key's name isn't read.
    """
    parts = max(1, -(-mask.count() // MASK_ROWS))
    wanted = layers.filter(F.array_contains(years, year)).select(F.col(key).alias("k")).distinct()
    features = mask.select(F.struct(*[c for c in mask.columns if c != key]).alias("feature"))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    groups = 1 if parts == 1 else max(1, -(-wanted.count() // MASK_ROWS))
    keyed = wanted.withColumn("group", dealt("k", groups)).withColumn("part", all_of(parts))
    copied = features.withColumn("part", dealt("feature", parts)).withColumn("group", all_of(groups))
    met = keyed.join(F.broadcast(copied) if parts == 1 else copied, ["part", "group"])
    added = met.select(F.col("k").alias(key), "feature.*")
    return layers.drop(years).unionByName(added, allowMissingColumns=True)


def overlaps(times: Column, low: Column, high: Column) -> Column:
    """Does a feature show in the closed window: its first and last time overlap it, or it has none."""
    return (F.size(times) == 0) | ~((F.get(times, F.lit(0)) > high) | (F.element_at(times, -1) < low))


def track_slice(times: Column, points: Column, low: Column, high: Column) -> Column:
    """Points whose times lie in (low, high]; all up to high where the last time isn't after low; null outside."""
    at = F.arrays_zip(times.alias("t"), points.alias("p"))
    late = F.filter(at, lambda x: x["t"] > high)
    upto = F.slice(at, 1, F.size(at) - F.size(late))
    after = F.when(F.element_at(times, -1) > low, F.filter(upto, lambda x: x["t"] > low)).otherwise(upto)
    inside = ~((F.get(times, F.lit(0)) > high) | (F.element_at(times, -1) < low))
    return F.when(F.size(times) == 0, points).when(inside, F.transform(after, lambda x: x["p"]))


def geometry_slice(coordinates: Column, times: Column, low: Column, high: Column) -> Column:
    """Coordinates (JSON text) of a feature in the window: of nested ones, as a line has, those that track_slice keeps;
    others, as a point has, whole. Null where the feature doesn't show, or where the text is no JSON."""
    items = F.try_variant_get(F.try_parse_json(coordinates), "$", "array<variant>")
    written = lambda texts: F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))

    def cut(read: Column) -> Column:
        texts = F.transform(read, lambda x: F.to_json(x))
        nested = F.schema_of_variant(F.get(read, F.lit(0))).startswith("ARRAY")
        return F.when(nested, let(texts, lambda t: let(track_slice(times, t, low, high), written))).otherwise(written(texts))

    return F.when(overlaps(times, low, high), let(items, cut))


def with_last_points(tracks: DataFrame, points: str) -> DataFrame:
    """tracks with `last` (false), and for each that has points a row with its last one alone and `last` true."""
    row = lambda kept, last: F.struct(kept.alias("points"), F.lit(last).alias("last"))
    whole = row(F.col(points), False)
    both = F.when(F.size(points) > 0, F.array(whole, row(F.slice(points, -1, 1), True))).otherwise(F.array(whole))
    others = F.struct(*[c for c in tracks.columns if c not in (points, "last")])
    rows = tracks.select(others.alias("others"), F.explode(both).alias("one"))  # tracks are made once for both
    columns = [F.col("one.points").alias(c) if c == points else F.col(f"others.{c}") for c in tracks.columns if c != "last"]
    return rows.select(*columns, F.col("one.last").alias("last"))


def dyadic_cover(low: Column, high: Column, levels: int) -> Column:
    """[(level, node)]: the fewest stretches of 2^level whole numbers, each from node * 2^level on, that make up low to
    high, two a level at most; none if low lies after high."""

    def at(k: Column) -> Column:
        # From the lowest level up: what is left of the range begins and ends between whole nodes of this level.
        first, end = F.call_function("shiftright", low + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k), F.call_function("shiftright", high + 1, k)
        odd = lambda n: n.bitwiseAND(F.lit(1).cast("long")) == 1
        node = lambda n: F.struct(k.alias("level"), n.alias("node"))
        return F.array(F.when((first < end) & odd(first), node(first)), F.when((first < end) & odd(end), node(end - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at)))


#: Rows of the smaller side of a join of ranges that are broadcast, at most, and those compared one by one.
SMALL, FEW = 100_000, 256


def overlap_join(ticks: DataFrame, spans: DataFrame, seconds: float = 1.0) -> DataFrame:
    """Pairs of ticks (low, high) and spans (first, last) that overlap, ends included, whatever their lengths.

    Two ranges overlap if the later begin lies in the other one. A range is covered by stretches of powers of two of
    `seconds`, at most two for each doubling of its length, and a begin looks for the one stretch of each length that
    it lies in; so a pair meets once, and a span of decades is some dozens of rows as one of minutes is. Null ends meet
    nothing; a span whose first time lies after its last one meets ticks that hold both, as such times are compared.

    Both sides are counted first. If one has at most SMALL rows, its stretches and begins are broadcast and the other
    side isn't shuffled; if it has at most FEW, its ranges themselves are, and compared with each range of the other.
    """
    bounded = lambda df, most: df.limit(most + 1).count() <= most
    first, last, low, high = (F.col(c) for c in ("first", "last", "low", "high"))
    side = next((i for i, df in enumerate((ticks, spans)) if bounded(df, SMALL)), None)
    hint = lambda df, i: F.broadcast(df) if i == side else df
    if side is not None and bounded((ticks, spans)[side], FEW):
        left, right = (df.select(F.struct("*").alias(name), a, b) for df, name, a, b in ((ticks, "tick", "low", "high"), (spans, "span", "first", "last")))
        return hint(left, 0).join(hint(right, 1), (first <= high) & (last >= low)).select("tick.*", "span.*")
    unit = int(seconds * 1000000)
    place = lambda c: F.floor(F.unix_micros(c) / unit)
    ranges = lambda df, name, a, b: df.select(F.struct("*").alias(name), F.col(a).alias(a), F.col(b).alias(b), place(F.col(a)).alias("a"), place(F.col(b)).alias("b"))
    left, right = ranges(ticks, "tick", "low", "high"), ranges(spans, "span", "first", "last")

    def met(points: DataFrame, covered: DataFrame, order: tuple[int, int]) -> DataFrame:
        longest = covered.agg(F.max(F.col("b") - F.col("a"))).first()[0]
        levels = max(longest or 0, 0).bit_length()  # no longer stretch is part of a cover
        nodes = covered.withColumn("at", F.explode(dyadic_cover(F.col("a"), F.col("b"), levels))).drop("a", "b")
        begins = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", F.col("a"), k).alias("node")))
        seen = points.withColumn("at", F.explode(begins)).drop("a", "b")
        flat = lambda df: df.withColumns({"level": F.col("at.level"), "node": F.col("at.node")}).drop("at")
        return hint(flat(seen), order[0]).join(hint(flat(nodes), order[1]), ["level", "node"])

    held = met(left, right, (0, 1)).filter((first <= low) & (last >= low) & (first <= high))
    holds = met(right, left, (1, 0)).filter((first > low) & (first <= high) & (last >= low))
    return held.select("tick.*", "span.*").union(holds.select("tick.*", "span.*"))


def feature_path(surname: Column, year: Column) -> Column:
    """Where a name's layer of one year is kept: by its first two letters, its name, its name and year."""
    key = F.regexp_replace(F.lower(surname), r"[\W^0-9\s]+", "")
    return F.concat(F.substring(key, 1, 2), F.lit("/"), key, F.lit("/"), key, F.lit("_"), year.cast("string"), F.lit(".json"))
