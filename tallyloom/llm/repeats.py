"""Passages that documents share, by sparse suffix arrays.

Of all suffixes of a text only those are retained that begin at a minimiser: the place of the least hash of HEAD words
within some stretch of as many starts as a passage of LEAST words has. What is retained depends on the words alone, so
a passage of LEAST words retains the same suffixes wherever it stands, at least one of them. Suffixes whose head occurs
in one document only are dropped first, by its hash. The others are sorted by their words across all partitions and
neighbours compared: no suffix shares more words with any other than with one of its neighbours, so that bounds how far
a match can reach right. Within that reach matches are extended left, word by word, over the passages that the suffix is
the minimiser of, and what is equal in words but stands in another document is a match. Matches that overlap or touch
are one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.llm.common import cut
from tallyloom.llm.shingles import mix, windows, words_of

#: Words of a passage, and of the head that suffixes are matched by.
LEAST, HEAD = 50, 16
#: Suffixes with the same head, of one document or many, up to which they are compared in one place.
GROUP = 256
#: Rows of a table that is broadcast, at most (some 40 MB); a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every `width` values in a row, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def retained(words: np.ndarray, least: int = LEAST, head: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """(positions, heads): where the suffixes of a text begin that are retained, and the hashes of their heads."""
    heads = windows(words, head)
    span = least - head + 1
    if len(heads) < span:
        return np.zeros(0, np.int64), heads[:0]
    lows = _slide(heads, span, np.minimum)
    # A position is a minimiser if it holds the least of some stretch around it.
    edge = np.zeros(span - 1, np.uint64)
    tops = _slide(np.concatenate([edge, lows, edge]), span, np.maximum)
    at = np.flatnonzero(heads == tops)
    return at, heads[at]


def _owned(words: np.ndarray, at: np.ndarray, least: int, head: int) -> list[tuple[int, int]]:
    """For each retained position the range of passages that it is the first minimiser of."""
    heads = windows(words, head)
    span = least - head + 1
    lows = _slide(heads, span, np.minimum)
    starts = np.arange(len(lows))
    # The first retained position at or after a passage's start whose head is the least of the passage.
    first = np.searchsorted(at, starts)
    while (wrong := heads[at[first]] != lows).any():
        first[wrong] += 1
    lo, hi = np.searchsorted(first, np.arange(len(at))), np.searchsorted(first, np.arange(len(at)), "right")
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


def _heads(least: int, head: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(retained(w, least, head)[1], return_counts=True) for w in words_of(batch.column("text").to_pylist())]
            sizes = [len(f) for f, _ in found]
            rows = np.repeat(np.arange(len(found)), sizes)
            heads = np.concatenate([f.view(np.int64) for f, _ in found]) if found else np.zeros(0, np.int64)
            times = np.concatenate([n for _, n in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads, pa.int64()), batch.column("doc_id").take(pa.array(rows)), pa.array(times.astype(np.int32), pa.int32())],
                names=["head", "doc_id", "times"],
            )

    return run


#: Columns of a retained suffix: the range of passages that it is the minimiser of, from lo to before hi, and either its
#: words, head first, with those before it, or the passages' 128-bit hashes in two halves.
SUFFIX = {
    "at": ("long", pa.int64()), "lo": ("long", pa.int64()), "hi": ("long", pa.int64()), "head": ("binary", pa.binary()), "right": ("binary", pa.binary()),
    "left": ("binary", pa.binary()), "one": ("array<long>", pa.list_(pa.int64())), "two": ("array<long>", pa.list_(pa.int64())),
}


def _suffixes(least: int, head: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each shared suffix of a document; those with a head in `often` have hashes instead of words."""
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for doc, text, hashes, shared in zip(batch.column("doc_id").to_pylist(), texts, words_of(texts), batch.column("shared").to_pylist(), strict=True):
                at, heads = retained(hashes, least, head)
                if not len(at):
                    continue
                often = {s["head"]: s["often"] for s in shared}
                # bytes have small letters of A-Z alone, and the white space that parts words here
                words = text.encode("utf-8", "replace").lower().split()
                one, two = windows(hashes, least).view(np.int64), None
                out = []
                for p, h, (lo, hi) in zip(at.tolist(), heads.view(np.int64).tolist(), _owned(hashes, at, least, head), strict=True):
                    if h not in often or lo == hi:
                        continue
                    if often[h]:
                        if two is None:
                            two = windows(mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)), least).view(np.int64)
                        out.append((doc, p, lo, hi, None, None, None, one[lo:hi], two[lo:hi]))
                    else:
                        out.append((doc, p, lo, hi, b" ".join(words[p : p + head]), b" ".join([*words[p : hi - 1 + least], b""]), b" ".join(words[lo:p]), None, None))
                if out:
                    kinds = [id_type, *(k for _, k in SUFFIX.values())]
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *SUFFIX])

    return run


def _shared(a: list[bytes], b: list[bytes]) -> int:
    """Words that two suffixes have in common from their start."""
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _extended(rows: list[dict], least: int) -> Iterator[tuple]:
    """Matches among suffixes of one head, which come sorted by their words: (doc_id, first and last passage in a row
    that another document has too, the least doc_id with one of them)."""
    # A space follows every word, so suffixes with the same first words stand together whatever the bytes of the next.
    rights, lefts = [r["right"].split(b" ")[:-1] for r in rows], [r["left"].split(b" ") if r["left"] else [] for r in rows]
    common = [0, *(_shared(a, b) for a, b in itertools.pairwise(rights)), 0]
    ends: dict[bytes, list] = {}
    found: list[list[tuple[int, bytes]]] = []
    for row, right, left, reach in zip(rows, rights, lefts, map(max, common, common[1:]), strict=True):
        at, lo, doc = row["at"], row["lo"], row["doc_id"]
        own = []
        for start in range(lo, min(row["hi"], reach + at - least + 1)):
            passage = b" ".join(left[start - lo :] + right[: start + least - at])
            own.append((start, passage))
            low = ends.setdefault(passage, [doc, doc])
            low[0], low[1] = min(low[0], doc), max(low[1], doc)
        found.append(own)
    for row, own in zip(rows, found, strict=True):
        span = None
        for start, passage in own:
            low, high = ends[passage]
            if low == high:
                continue
            if span and span[2] == start - 1:
                span[2], span[3] = start, min(span[3], low)
            else:
                if span:
                    yield tuple(span)
                span = [row["doc_id"], start, start, low]
        if span:
            yield tuple(span)


def _compared(least: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Matches of suffixes that come sorted by head and words. Rows of one head are held until the next comes."""
        kinds = [id_type, pa.int64(), pa.int64(), id_type]
        rows = (r for b in batches for part in range(0, b.num_rows, 1024) for r in b.slice(part, 1024).to_pylist())
        matches = (m for _, group in itertools.groupby(rows, lambda r: r["head"]) for m in _extended(list(group), least))
        while some := list(itertools.islice(matches, 10_000)):
            columns = [pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "last", "first_doc_id"])

    return run


def _folded(often: DataFrame) -> DataFrame:
    """(doc_id, start, last, first_doc_id) for suffixes of frequent heads, whose passages are compared by 128 bits.

    Suffixes with the same passages around them, as copies have, are one surrounding, folded to its least and greatest
    doc_id before anything is shuffled. Only the surroundings' passages, some dozens each, are rows of their own.
    """
    keyed = often.select("doc_id", "lo", "one", "two", F.xxhash64("one").alias("k"), F.xxhash64("two").alias("j"))
    around = cut(keyed.groupBy("k", "j").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.first("one").alias("one"), F.first("two").alias("two")))
    passages = around.select("k", "j", "low", "high", F.posexplode(F.arrays_zip("one", "two")).alias("i", "p")).select("k", "j", "low", "high", "i", "p.one", "p.two")
    shared = passages.groupBy("one", "two").agg(F.min("low").alias("first_doc_id"), F.max("high").alias("last_doc_id")).filter("first_doc_id < last_doc_id")
    hits = passages.join(shared, ["one", "two"]).select("k", "j", "i", "first_doc_id")
    stretch = F.col("i") - F.row_number().over(Window.partitionBy("k", "j").orderBy("i"))
    spans = hits.withColumn("stretch", stretch).groupBy("k", "j", "stretch").agg(F.min("i").alias("from"), F.max("i").alias("to"), F.min("first_doc_id").alias("first_doc_id"))
    spans = cut(spans.drop("stretch"))
    spans = F.broadcast(spans) if spans.count() <= BROADCAST_ROWS else spans
    # Written by itself, so that adaptive execution can split surroundings that very many documents have.
    return cut(keyed.join(spans, ["k", "j"]).select("doc_id", (F.col("lo") + F.col("from")).alias("start"), (F.col("lo") + F.col("to")).alias("last"), "first_doc_id"))


def repeated_passages(docs: DataFrame, least: int = LEAST, head: int = HEAD, group: int = GROUP) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc_id): the longest stretches of words, from start to before end, all of
    whose passages of `least` words stand in other documents too; first_doc_id is the least doc_id with one of them.

    Stretches that overlap or touch are one. Texts that are null, empty or shorter have none; rows without doc_id
    aren't compared; rows that repeat a doc_id are one document; ids may be of any type, and other columns aren't read.
    Suffixes are sorted and compared in one place if up to `group` of them have the same head; the suffixes of more
    frequent heads are folded by their surroundings first, so no group grows with the data and none is cut short.
    """
    known = docs.filter("doc_id is not null").select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType
    id_type, name = to_arrow_type(kind), kind.simpleString()
    heads = cut(known.mapInArrow(_heads(least, head), f"head long, doc_id {name}, times int"))
    counted = heads.groupBy("head").agg(F.sum("times").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = heads.drop("times").join(counted.filter("low < high").select("head", (F.col("n") > group).alias("often")), "head")
    wanted = shared.groupBy("doc_id").agg(F.collect_set(F.struct("head", "often")).alias("shared"))
    columns = ", ".join(f"{c} {k}" for c, (k, _) in SUFFIX.items())
    rows = cut(known.join(wanted, "doc_id").mapInArrow(_suffixes(least, head, id_type), f"doc_id {name}, {columns}"))

    # One range holds all suffixes of a head; where a head has many, they aren't among these.
    rare = rows.filter("head is not null").select("head", "right", "left", "doc_id", "at", "lo", "hi")
    sorted_ = rare.repartitionByRange("head").sortWithinPartitions("head", "right")
    spans = cut(sorted_.mapInArrow(_compared(least, id_type), f"doc_id {name}, start long, last long, first_doc_id {name}"))
    hits = _folded(rows.filter("head is null"))

    by_doc = Window.partitionBy("doc_id").orderBy("start", "last")
    reached = F.max(F.col("last") + least).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("start") > F.col("reached"), 1).otherwise(0)
    joined = spans.union(hits).withColumn("reached", reached).withColumn("island", F.sum(apart).over(by_doc))
    out = joined.groupBy("doc_id", "island").agg(
        F.min("start").alias("start"), (F.max("last") + least).alias("end"), F.min("first_doc_id").alias("first_doc_id")
    )
    return out.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "first_doc_id")
