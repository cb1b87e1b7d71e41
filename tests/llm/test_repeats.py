"""Shared passages against a table of all 50-word windows."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tallyloom.llm import repeats, shingles

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=50):
    where = defaultdict(set)
    docs = [(d, WORDS.findall((t or "").translate(LOW))) for d, t in rows if d is not None]
    for d, w in docs:
        for i in range(len(w) - least + 1):
            where[tuple(w[i : i + least])].add(d)
    hits = defaultdict(dict)
    for d, w in docs:
        for i in range(len(w) - least + 1):
            if len(s := where[tuple(w[i : i + least])]) > 1:
                hits[d][i] = min(s)
    out = []
    for d, starts in hits.items():
        spans = []
        for i in sorted(starts):
            if spans and i <= spans[-1][1]:
                spans[-1][1:] = [i + least, min(spans[-1][2], starts[i])]
            else:
                spans.append([i, i + least, starts[i]])
        out += [(d, a, b, b - a, f) for a, b, f in spans]
    return sorted(out)


def planted():
    rng, rows = random.Random(3), []
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(50)]
    long = [word() for _ in range(300)]
    for i in range(40):
        cut = rng.randrange(0, 250)
        body = [word() for _ in range(rng.randrange(0, 60))] + (passage if i % 3 else passage[:49]) + [word() for _ in range(20)]
        rows.append(" ".join(body + (long[cut : cut + rng.randrange(30, 120)] if i % 2 else [])))
    rows += [rows[4], rows[4].upper(), "", None, "a " * 49, "a " * 50, "a " * 51, "a " * 400, "b " * 70, " ".join(long)]
    return list(enumerate(rows)) + [(None, " ".join(long)), (3, rows[4])]


@pytest.mark.parametrize("group", [2048, 2])
def test_planted_passages(spark, group):
    docs = spark.createDataFrame(planted(), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in repeats.repeated_passages(docs, group=group).collect())
    assert got == brute(planted())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = sorted(tuple(r) for r in repeats.repeated_passages(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_empty_table(spark):
    assert repeats.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_passage_has_one_suffix():
    rng = np.random.default_rng(4)
    for values in (10**9, 3, 1):
        words = shingles.mix(rng.integers(0, values, 500).astype(np.uint64))
        at, heads = repeats.retained(words)
        owned = repeats._owned(words, at, repeats.LEAST, repeats.HEAD)
        assert sorted(i for lo, hi in owned for i in range(lo, hi)) == list(range(451))
        assert all(lo >= p - 34 and hi - 1 <= p for p, (lo, hi) in zip(at.tolist(), owned, strict=True) if hi > lo)


def test_groups_count_occurrences(spark, monkeypatch):
    """A head that few documents hold many times is no group of its own, and the rows stay the same."""
    rows = [(d, f"start{d} " + "junk " * 400 + f"end{d} " + " ".join(f"w{i}" for i in range(60))) for d in (1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = sorted(tuple(r) for r in repeats.repeated_passages(docs, group=10**6).collect())
    real = repeats._extended

    def checked(rows, least):
        assert len(rows) <= 100
        yield from real(rows, least)

    monkeypatch.setattr(repeats, "_extended", checked)
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in repeats.repeated_passages(docs, group=100).collect()) == wanted and len(wanted) >= 6


def test_neighbours_that_hide_a_match(spark):
    """Around one common phrase, documents that share more to the right, or to the left, stand between two that share a
    whole passage."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    phrase, before, after = ([word() for _ in range(n)] for n in (20, 60, 60))
    rows = []
    for i in range(60):
        l, r = rng.randrange(0, 40), rng.randrange(0, 40)
        rows.append(" ".join([word() for _ in range(40)] + before[60 - l :] + phrase + after[:r] + [word() for _ in range(40)]))
    # Words with bytes below the space sort before the end of a shorter word.
    rows += [" ".join([word(), *before[30:], *phrase, *after[:20], last]) for last in ("a", "a\x01", "a\x01b", "\x02")]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for group in (2048, 3):
        got = sorted(tuple(r) for r in repeats.repeated_passages(docs, group=group).collect())
        assert got == brute(rows) and got


def test_text_ids_and_extra_columns(spark):
    rows = [(f"d{i}", t, i, i) for i, t in planted() if i is not None]
    docs = spark.createDataFrame(rows, "doc_id string, text string, head int, start int")
    got = sorted(tuple(r) for r in repeats.repeated_passages(docs).collect())
    assert got == brute([(d, t) for d, t, _, _ in rows])
