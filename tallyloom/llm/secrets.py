"""Secret scans over a trigram inverted index (DataFrame functions only).

Each rule is a regular expression, from which trigrams.derive() makes a Boolean query of trigrams that every match must
hold. postings() lists, for each trigram that some query names, the distinct texts it occurs in; candidates() intersects
and unites a text's postings as the queries say; scan() verifies candidates with the regular expression itself. A rule
without a mandatory trigram has no query and scans every text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import trigrams
from tallyloom.llm.common import cut, let

#: Candidates that are broadcast, at most (some 40 MB); more are joined by a shuffle.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class SecretRule:
    name: str
    regex: str
    #: Group whose length counts, and its least length; shorter matches are dropped.
    group: int
    least: int

    @property
    def query(self) -> trigrams.Query:
        return trigrams.derive(self.regex)


RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # A run is matched whole or not at all, so a least length inside the pattern drops the same matches as one after it.
    SecretRule("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    SecretRule("hex", "[0-9a-f]{24,}", 0, 24),
)


def text_key(text: Column) -> Column:
    """Key of a distinct text: equal texts share their postings, so a group of copies costs one entry."""
    return F.md5(text.cast("binary"))


def postings(texts: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(trigram, text_key) for the trigrams of the rules' queries, each pair once. texts: text_key, text."""
    wanted = sorted(set().union(*(trigrams.named(r.query) for r in rules)))
    low = texts.select("text_key", F.lower("text").alias("_low"))
    found = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in wanted]).cast("array<string>"))
    return low.select("text_key", F.explode(found).alias("trigram")).distinct()


def _met(query: trigrams.Query, held: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(held, query)
    out = _met(query[1][0], held)
    for q in query[1][1:]:
        out = out & _met(q, held) if query[0] == "all" else out | _met(q, held)
    return out


def candidates(index: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(text_key, rules): the texts that meet each rule's Boolean query.

    A text has a posting for each of the queries' trigrams at most, so what is gathered of one text grows with the
    rules only.
    """
    asked = [r for r in rules if r.query is not True]
    held = index.groupBy("text_key").agg(F.collect_set("trigram").alias("held"))
    names = F.array_compact(F.array(*[F.when(_met(r.query, F.col("held")), F.lit(r.name)) for r in asked]).cast("array<string>"))
    return held.select("text_key", names.alias("rules")).filter(F.size("rules") > 0)


def _matches(text: Column, rule: SecretRule, step: int = 128) -> Column:
    """[(start, end)] in code points of the rule's leftmost non-overlapping matches that are long enough.

    What lies between the matches is the text split at them, so running lengths give the positions. Matches are put
    together in stretches of `step`, as a list that grows by one match at a time is copied each time.
    """
    whole = F.transform(F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), F.length)
    counted = F.transform(F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)), F.length)
    between = F.transform(F.split(text, rule.regex, -1), F.length)
    sizes = F.arrays_zip(between.alias("b"), whole.alias("m"), counted.alias("c"))
    kind = "array<struct<start:int,end:int>>"
    start = lambda at, out: F.named_struct(F.lit("at"), at, F.lit("out"), F.array().cast(out))

    def one(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["b"]
        end = begin + F.coalesce(x["m"], F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"))
        found = F.when(x["m"].isNotNull() & (x["c"] >= rule.least), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.named_struct(F.lit("at"), end, F.lit("out"), found)

    def stretch(acc: Column, part: Column) -> Column:
        own = F.aggregate(part, start(acc["at"], kind), one)
        return let(own, lambda o: F.named_struct(F.lit("at"), o["at"], F.lit("out"), F.concat(acc["out"], F.array(o["out"]))))

    def cut_up(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / step).cast("int")), lambda i: F.slice(s, i * step + 1, F.lit(step)))

    return F.flatten(F.aggregate(let(sizes, cut_up), start(F.lit(0), f"array<{kind}>"), stretch)["out"])


def _named(rank: int, kind: str) -> Callable[[Column], Column]:
    """From a (start, end) to the span that sorts by start, then by the rules' order."""
    return lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")
    )


def _spans(text: Column, met: Column, rules: tuple[SecretRule, ...]) -> Column:
    """Sorted [(start, rank, kind, end)] of all rules; met: names of the rules whose query the text meets."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    found = []
    for rank, rule in enumerate(rules):
        worth = text.rlike(rule.regex)
        if rule.query is not True:
            worth = F.coalesce(F.array_contains(met, rule.name), F.lit(False)) & worth
        found.append(F.transform(F.when(worth, _matches(text, rule)).otherwise(none), _named(rank, rule.name)))
    return F.sort_array(F.concat(*found))


def scan(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """(row, text, spans) for every row of docs: row is the row as it came, text its text (null: empty).

    The index holds distinct texts. Candidates are few next to the texts; while there are BROADCAST_ROWS at most, which
    is counted, they go to the texts and no text is moved. Beyond that they are joined on the text's key, which is
    uneven where many rows share a text; adaptive execution splits that, as the candidates have one row a key.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", text_key(F.col("text")))
    if all(r.query is True for r in rules):
        return rows.select("row", "text", _spans(F.col("text"), F.array().cast("array<string>"), rules).alias("spans"))
    met = cut(candidates(postings(rows.select("text_key", "text"), rules), rules))
    met = F.broadcast(met) if met.count() <= BROADCAST_ROWS else met
    return rows.join(met, "text_key", "left").select("row", "text", _spans(F.col("text"), F.col("rules"), rules).alias("spans"))


def listing(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Per document the number of spans of each kind, their digest, and the spans as text.

    Null text counts as empty: no spans, and the digest of nothing. Repeated rows are each returned; other columns
    aren't read, whatever their names. A span that is reported by two rules stands twice.
    """
    found = scan(docs, rules)
    line = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counted = found.select(F.col("row.doc_id").alias("doc_id"), *[count(r.name) for r in rules], line.alias("spans"))
    return counted.withColumn("base_sha256", F.sha2(F.col("spans").cast("binary"), 256))


def _masked(text: Column, spans: Column) -> Column:
    """text with every span replaced; a span that begins inside an earlier one extends it."""
    start = F.named_struct(F.lit("at"), F.lit(0), F.lit("out"), F.lit(""))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        mark = F.concat(F.lit("[secret:"), x["kind"], F.lit("]"))
        out = F.when(x["start"] >= acc["at"], F.concat(acc["out"], gap, mark)).otherwise(acc["out"])
        return F.named_struct(F.lit("at"), F.greatest(acc["at"], x["end"]), F.lit("out"), out)

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text) - acc["at"]))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))


def redacted(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """docs with the secrets in text replaced by [secret:kind] and n_chars, where there is one, counted again.

    Rows without a secret stay as they are, null text included; no row goes.
    """
    found = scan(docs, rules).withColumn("clean", _masked(F.col("text"), F.col("spans")))
    hit = F.size("spans") > 0
    new = {"text": F.when(hit, F.col("clean")).otherwise(F.col("row")["text"])}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(hit, F.length("clean").cast(kind)).otherwise(F.col("row")["n_chars"])
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
