"""Quality rules as a short-circuit cascade (DataFrame functions only).

Each rule is a condition that rejects a document. rank() runs every rule over a bounded sample, measures what it costs
beyond a job without a rule, and orders the rules by rejections per second, counting only what the rules before it let
through; verdict() evaluates them in that order in one CASE expression, which stops at the first rule that rejects. A
document's verdict doesn't depend on the order: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACE, WORD, let

WINDOW = 8


@dataclass(frozen=True)
class Facts:
    """What rules look at: a document's text (never null), its words, and measures that are columns already."""

    text: Column
    words: Column
    known: dict[str, Column] = field(default_factory=dict)

    def __getitem__(self, name: str) -> Column:
        return self.known[name] if name in self.known else MEASURES[name](self)


@dataclass(frozen=True)
class Rule:
    name: str
    #: From a document's facts to a boolean that is never null.
    rejects: Callable[[Facts], Column]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def n_words(facts: Facts) -> Column:
    return F.size(facts.words).cast("long")


def word_chars(facts: Facts) -> Column:
    return F.length(F.array_join(facts.words, "")).cast("long")


def n_symbols(facts: Facts) -> Column:
    return F.length(F.regexp_replace(facts.text, r"[^#*$%&|<>]+", "")).cast("long")


def _wordy_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))


def n_dup_lines(facts: Facts) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_wordy_lines(facts.text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice: windows are hashes in order of position."""
    numbered = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        # s is sorted by hash, so equal windows are neighbours.
        same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
        marked = F.transform(s, lambda x, j: F.when(same(j, j - 1) | same(j, j + 1), x["i"]))
        return F.sort_array(F.filter(marked, lambda x: x.isNotNull()))

    def length(p: Column) -> Column:
        # The union of [p, p + WINDOW): each start adds up to the next start at most.
        gaps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(F.sort_array(numbered), lambda s: let(repeated(s), length))


def n_repeat_words(facts: Facts) -> Column:
    """Words in 8-word windows that are found twice or more in the text, the first occurrence included.

    Windows are compared by 64-bit hashes, put together from those of their words by doubling. Most texts repeat no
    window, which the distinct count of plain longs shows; only the others pay for the sort with positions.
    """

    def doubled(size: int) -> Callable[[Column], Column]:
        def pairs(h: Column) -> Column:
            n = F.size(h) - size
            return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(size + 1), n), lambda a, b: F.xxhash64(a, b))

        return pairs

    def hashes(w: Column) -> Column:
        one = F.transform(w, lambda x: F.xxhash64(x))
        return F.when(F.size(w) >= WINDOW, let(let(let(one, doubled(1)), doubled(2)), doubled(4)))

    def count(h: Column) -> Column:
        none = h.isNull() | (F.size(F.array_distinct(h)) == F.size(h))
        return F.when(none, F.lit(0).cast("long")).otherwise(_covered(h))

    return let(hashes(facts.words), count)


MEASURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}


def _shouts(facts: Facts) -> Column:
    """More than half of the words of three letters or more are in capitals."""
    capitals = F.regexp_count(facts.text, F.lit(r"(?<!\p{L})\p{Lu}{3,}(?!\p{L})"))
    return let(capitals, lambda n: (n > 0) & (2 * n > F.regexp_count(facts.text, F.lit(r"(?<!\p{L})\p{L}{3,}"))))


def _duplicated_lines(facts: Facts) -> Column:
    """More than 40 % of the lines with a word equal an earlier one."""
    return let(facts["n_dup_lines"], lambda n: (n > 0) & (10 * n > 4 * F.size(_wordy_lines(facts.text))))


def _few_letters(facts: Facts) -> Column:
    return 2 * F.length(F.regexp_replace(facts.text, r"[^\p{L}]+", "")) < facts["word_chars"]


#: The two base rules come first only until rank() orders them with the others.
RULES = (
    Rule("few_words", lambda f: f["n_words"] < 20),
    Rule("repeated_windows", lambda f: 100 * f["n_repeat_words"] > 30 * f["n_words"]),
    Rule("symbols", lambda f: 100 * f["n_symbols"] > 10 * f["n_words"]),
    Rule("duplicated_lines", _duplicated_lines),
    Rule("word_length", lambda f: let(f["word_chars"], lambda n: (n < 2 * f["n_words"]) | (n > 14 * f["n_words"]))),
    Rule("few_letters", _few_letters),
    Rule("capitals", _shouts),
)
BASE = ("few_words", "repeated_windows")


def ordered(costs: list[float], rejected: list[list[bool]]) -> list[tuple[int, float]]:
    """(rule, rate) in order of rejections per second: each next rule is the best on what the ones before let through,
    and rate is its share of that; among rules that reject nothing more the cheapest comes first."""
    left, out = list(range(len(rejected))), []
    waiting = list(range(len(costs)))
    while waiting:
        hits = {r: sum(rejected[i][r] for i in left) for r in waiting}
        best = min(waiting, key=lambda r: (-hits[r] / costs[r], costs[r], r))
        out.append((best, hits[best] / max(1, len(left))))
        left = [i for i in left if not rejected[i][best]]
        waiting.remove(best)
    return out


def rank(
    texts: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 500, runs: int = 3, copies: int = 8, known: tuple[str, ...] = ()
) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, rate of rejection), by rejections per second; rate is of what the rules before let through.

    At most sample_rows documents are measured, the first that Spark reads: they decide the order of the rules, that
    is the speed, and never a verdict. Every row is tried `copies` times, so that a job's own time weighs little, and
    the time of a job without a rule is taken off; the least of `runs` counts. A rule's cost holds that of its measures,
    but of those in `known`, which the caller has already. What comes to the driver is a boolean for each rule and
    sampled row. The sample is held in the session's cache for the time of the measurement only. An empty table leaves
    the order as given.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    sample = texts.select(text).limit(sample_rows).select("text", words(F.col("text")).alias("words"))
    facts = Facts(F.col("text"), F.col("words"))
    sample = sample.select("*", *[facts[m].alias(f"known_{m}") for m in known]).cache()
    facts = Facts(F.col("text"), F.col("words"), {m: F.col(f"known_{m}") for m in known})
    try:
        rejected = [list(r) for r in sample.select(*[r.rejects(facts).alias(r.name) for r in rules]).collect()]
        if not rejected:
            return [(r, 0.0, 0.0) for r in rules]
        repeated = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))

        def seconds(condition: Column) -> float:
            took = []
            for _ in range(runs):
                began = time.perf_counter()
                repeated.agg(F.count_if(condition)).collect()
                took.append(time.perf_counter() - began)
            return min(took)

        idle = seconds(F.col("copy") > 0)
        costs = [max(seconds(r.rejects(facts)) - idle, 1e-5) / (copies * len(rejected)) for r in rules]
    finally:
        sample.unpersist()
    return [(rules[i], costs[i], rate) for i, rate in ordered(costs, rejected)]


def verdict(facts: Facts, ranked: list[Rule]) -> Column:
    """Name of the first rule in this order that rejects the text, null if none does. Later rules aren't evaluated."""
    out = F.when(ranked[0].rejects(facts), F.lit(ranked[0].name))
    for rule in ranked[1:]:
        out = out.when(rule.rejects(facts), F.lit(rule.name))
    return out


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with their columns as they are.

    Null and empty texts have no words and are rejected; repeated rows are each kept or not. A text's words are found
    once and all rules use them.
    """
    ranked = [r for r, _, _ in rank(docs, rules)]
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    name = let(words(F.col("text")), lambda w: verdict(Facts(F.col("text"), w), ranked))
    # Through explode the verdict is a column that a filter reads; else the whole expression would move into the filter.
    return rows.select("row", F.explode(F.array(name)).alias("rejected_by")).filter("rejected_by is null").select("row.*")


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document the base measures, base_failed and kept.

    The measures are wanted for every row, so they are columns that the rules read; the cascade then runs the method's
    other rules, in their measured order, on what the base rules leave. Null text counts as empty: no words, not kept.
    Repeated rows are each returned; other columns aren't read, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), words(text).alias("_words"))
    facts = Facts(F.col("_text"), F.col("_words"))
    rows = rows.withColumns({name: facts[name] for name in MEASURES})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    others = [r for r, _, _ in rank(docs, tuple(r for r in rules if r.name not in BASE), known=tuple(MEASURES))]
    facts = Facts(F.col("_text"), F.col("_words"), {name: F.col(name) for name in MEASURES})
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(facts, others).isNull())
    return rows.withColumn("base_failed", failed).withColumn("kept", kept).drop("_text", "_words")
