"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters may be found with up to k edits, k a fixed share of n. Cut into k + 1 pieces, at least one
piece of it stands unchanged in any such occurrence. An automaton over all pieces finds their exact hits in a
document; each hit says where the item would begin, and Myers' bit-parallel algorithm computes the least edit
distance between the item and any substring there. Texts are compared in lower case, with runs of white space as one
space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Edits allowed for each character of an item.
ERROR_RATE = 0.08
#: Text of items that one pass holds in every task, in bytes; more items are searched in several passes. An automaton
#: takes some tens of bytes for each.
BLOCK_BYTES = 4_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


@dataclass(frozen=True)
class Item:
    id: object
    text: str
    budget: int

    def pieces(self) -> list[tuple[str, int]]:
        """budget + 1 pieces of nearly equal length, with where they begin."""
        n, parts = len(self.text), self.budget + 1
        ends = [n * i // parts for i in range(parts + 1)]
        return [(self.text[a:b], a) for a, b in zip(ends, ends[1:], strict=False)]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def nearest(pattern: str, peq: dict[str, int], text: str) -> tuple[int, int]:
    """(least distance of pattern to a substring of text, where the first such substring ends), by Myers."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, at = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        plus, minus = down | (full & ~(d0 | up)), up & d0
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (full & ~(d0 | plus)), plus & d0
        if score < best:
            best, at = score, j
    return best, at


class Searcher:
    """Finds the items of one block in a text. Built once in every task."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items, self.peq = items, {}
        where: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            for piece, offset in item.pieces():
                where.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item the parts of text, apart from each other, that can hold it."""
        out: dict[int, list[list[int]]] = {}
        for last, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                item = self.items[i]
                begin = last + 1 - size - offset
                out.setdefault(i, []).append([max(0, begin - item.budget), min(len(text), begin + len(item.text) + item.budget)])
        for i, spans in out.items():
            spans.sort()
            apart = [spans[0]]
            for span in spans[1:]:
                if span[0] <= apart[-1][1]:
                    apart[-1][1] = max(apart[-1][1], span[1])
                else:
                    apart.append(span)
            out[i] = apart
        return out

    def find(self, text: str | None) -> list[tuple[object, int]]:
        """(item id, least distance) of the items within their budgets."""
        text = normal(text or "")
        if not text or not self.items:
            return []
        out = []
        for i, spans in self.windows(text).items():
            item = self.items[i]
            peq = self.peq.get(i) or self.peq.setdefault(i, masks(item.text))
            least = min(0 if item.text in (part := text[a:b]) else nearest(item.text, peq, part)[0] for a, b in spans)
            if least <= item.budget:
                out.append((item.id, least))
        return out


def blocks(benchmark: DataFrame, rate: float, block_bytes: int) -> Iterator[list[Item]]:
    """The items with text, in blocks whose size is checked before they are fetched."""
    items = benchmark.select("item_id", "text").filter("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = -(-size // block_bytes)
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).distinct()
        found = [Item(r.item_id, t, int(rate * len(t))) for r in part.collect() if (t := normal(r.text))]
        if found:
            yield found


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance): each item that a document holds within its budget, with its least distance.

    Null and empty texts and items match nothing; repeated documents are each searched, repeated items once; ids of
    any type stay as they are, null too. Narrow for each block of items: documents aren't shuffled, whatever their
    number or length.
    """
    id_kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {id_kind}, item_id {item_kind}, distance long"
    out = docs.sparkSession.createDataFrame([], schema)
    for k, items in enumerate(blocks(benchmark, rate, block_bytes)):
        found = docs.select("doc_id", "text").mapInArrow(_listed(items, to_arrow_type(benchmark.schema["item_id"].dataType)), schema)
        out = out.unionByName(found) if k else found
    return out


def _listed(items: list[Item], id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(items)
        for batch in batches:
            found = [(i, item, d) for i, t in enumerate(batch.column("text")) for item, d in search.find(t.as_py())]
            rows, ids, distances = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(ids, id_type), pa.array(distances, pa.int64())],
                names=["doc_id", "item_id", "distance"],
            )

    return run


def _clean(items: list[Item], column: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(items)
        for batch in batches:
            yield batch.filter(pa.array([not search.find(t.as_py()) for t in batch.column(column)], pa.bool_()))

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the documents that hold an item; the others keep their columns, whatever their names, and null and
    empty texts stay. Repeated rows stay or go together."""
    for items in blocks(benchmark, rate, block_bytes):
        docs = docs.mapInArrow(_clean(items, "text"), docs.schema)
    return docs
