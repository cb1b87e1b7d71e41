"""Fill-in-middle by secondary-sort assembly.

A text is cut into pieces of bounded length, in its own order, each keyed by its row and its place in the output.
repartitionAndSortWithinPartitions brings a row's pieces together in output order, where they stream into a digest and
into a reader of the output, which knows only the form: it emits the pieces of prefix, middle and suffix again, keyed by
their place in the text. The same partitioner sorts those within the partition (no second shuffle) and they stream into
the digest of the restored text. No step holds more of a text than a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a piece, at most, and bytes of text in a partition, about.
PIECE, PARTITION = 65_536, 64_000_000
#: The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Of each form the parts (0 prefix, 1 suffix, 2 middle, as in MARKS) in output order.
ORDERS = {"plain": (), "psm": (0, 1, 2), "spm": (1, 0, 2)}
#: Where a part stands in the text.
IN_TEXT = {0: 0, 2: 1, 1: 2}
FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def planned(doc_id: int | None, text: str, plain: int = 10, spm: int = 20, seed: str = "1:") -> tuple[str, int, int]:
    """(form, where the prefix ends, where the middle ends), drawn from doc_id alone; a null doc_id draws as no digits."""
    drawn = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i : i + 8], 16) for i in range(0, 32, 8)]
    first, second = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 100 - plain:
        return "plain", first, second
    return "spm" if h[3] % 100 < spm else "psm", first, second


def pieces(row: int, doc_id: int | None, text: str | None, **rates) -> Iterator[tuple]:
    """((row, part's place, number), piece), first the facts of the row at a place before all others."""
    text = text or ""
    form, first, second = planned(doc_id, text, **rates)
    cuts = (doc_id, len(text), form, None, None) if form == "plain" else (doc_id, len(text), form, first, second - first)
    yield (row, -1, 0), cuts
    order = ORDERS[form]
    parts = [(0, 0, len(text), "")] if not order else [
        (order.index(p), *span, MARKS[p]) for p, span in ((0, (0, first)), (2, (first, second)), (1, (second, len(text))))
    ]
    for place, start, end, mark in parts:
        if mark:
            yield (row, place, 0), mark
        for k, at in enumerate(range(start, end, PIECE)):
            yield (row, place, k + 1), text[at : min(at + PIECE, end)]


def parts_of(output: Iterator[str], form: str) -> Iterator[tuple[int, str]]:
    """(place in the text, piece) for the pieces of an output, which are read once; marks may lie across pieces."""
    left, now, held = list(ORDERS[form]), 0, ""
    for piece in output:
        held += piece
        while left and (at := held.find(MARKS[left[0]])) >= 0:
            if at:
                yield now, held[:at]
            held = held[at + len(MARKS[left[0]]) :]
            now = IN_TEXT[left.pop(0)]
        keep = len(MARKS[left[0]]) - 1 if left else 0  # a mark's beginning may end the piece
        if len(held) > keep:
            yield now, held[: len(held) - keep]
            held = held[len(held) - keep :]
    if held:
        yield now, held


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _read_back(sorted_pieces: Iterator[tuple]) -> Iterator[tuple]:
    """From a partition's pieces in output order: facts with the output's digest, and pieces keyed by place in the text."""
    for row, group in groupby(sorted_pieces, key=lambda x: x[0][0]):
        facts, sha = next(group)[1], hashlib.sha256()

        def output(group=group, sha=sha) -> Iterator[str]:
            for _, piece in group:
                sha.update(_bytes(piece))
                yield piece

        for k, (place, piece) in enumerate(parts_of(output(), facts[2])):
            yield (row, place, k), piece
        yield (row, -1, 0), (*facts, sha.hexdigest())


def _restored(sorted_pieces: Iterator[tuple]) -> Iterator[tuple]:
    for _, group in groupby(sorted_pieces, key=lambda x: x[0][0]):
        facts, sha = next(group)[1], hashlib.sha256()
        for _, piece in group:
            sha.update(_bytes(piece))
        yield (*facts, sha.hexdigest())


def _whole(sorted_pieces: Iterator[tuple]) -> Iterator[tuple]:
    for _, group in groupby(sorted_pieces, key=lambda x: x[0][0]):
        facts = next(group)[1]
        yield (*facts, "".join(piece for _, piece in group))


def _of_row(key: tuple) -> int:
    """Spreads rows over partitions; one function for both sorts, so that the second finds its rows in place."""
    return (key[0] * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 33


def _sorted(rdd: RDD, parts: int) -> RDD:
    return rdd.repartitionAndSortWithinPartitions(parts, _of_row)


def assembled(docs: DataFrame, **rates) -> tuple[RDD, int]:
    """All rows' pieces in output order, each row in one partition, and the number of partitions, by the texts' bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION))
    rows = docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), "text").rdd
    return _sorted(rows.flatMap(lambda r: pieces(*r, **rates)), parts), parts


def transformed(docs: DataFrame, **rates) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the whole output text of every row.

    rates: of 100 rows, how many stay plain and how many of the others begin with the suffix, and the draws' seed.
    Null text counts as empty; repeated rows stay, each with its own output; other columns aren't read.
    """
    ordered, _ = assembled(docs, **rates)
    return docs.sparkSession.createDataFrame(ordered.mapPartitions(_whole), f"{FACTS}, output string", verifySchema=False)


def digests(docs: DataFrame, **rates) -> DataFrame:
    """As transformed, but with digests of the output and of the text restored from output and form.

    Null text counts as empty; a null doc_id draws as no digits; repeated rows stay; other columns aren't read. A text
    of any length streams through one task, a piece at a time.
    """
    ordered, parts = assembled(docs, **rates)
    again = _sorted(ordered.mapPartitions(_read_back, preservesPartitioning=True), parts)
    schema = f"{FACTS}, output_sha256 string, restored_sha256 string"
    return docs.sparkSession.createDataFrame(again.mapPartitions(_restored), schema, verifySchema=False)
