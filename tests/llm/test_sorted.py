"""Operators 11 and 12 against brute force in plain Python."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import infill, negatives

EMBEDDED = "vec_id long, label int, embedding array<float>"


def brute(rows, is_anchor, k=5, most=10, low=30, high=90):
    whole = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole[i] = min(whole.get(i, (label, v)), (label, v))
    ints = {i: [math.floor(256 * x) for x in v] for i, (_, v) in whole.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(ints[a], ints[b], strict=False))
    out = []
    for a in (i for i in whole if is_anchor(i)):
        order = sorted((-dot(a, b), b) for b in whole if b != a)
        for down, p in [x for x in order if whole[x[1]][0] == whole[a][0]][:k]:
            far = [(n, d) for d, n in order if whole[n][0] != whole[a][0] and low * -down <= 100 * -d <= high * -down]
            out += [(a, p, r, n, -down, -d) for r, (n, d) in enumerate(far[:most], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, EMBEDDED)
    return sorted(map(tuple, negatives.mined(df, F.col("vec_id") % 10 == 0, **more).collect()))


def test_negatives_equal_brute_force(spark, monkeypatch):
    draw = random.Random(5)
    f = lambda x: float(__import__("numpy").float32(x))
    rows = [(i, draw.choice([0, 0, 1, 2]), [f(draw.gauss(0, 0.3)) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, i % 3, [f(0.25)] * 6) for i in range(60)]  # ties
    rows += [(i, draw.choice([0, 1]), [0.0] * 6) for i in range(400, 431)]  # scores of 0 among positives too
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want and any(r[4] == 0 for r in want)
    assert mined(spark, rows, positives=2, negatives=3, low=50, high=100) == brute(rows, lambda i: i % 10 == 0, 2, 3, 50, 100)
    monkeypatch.setattr(negatives, "STRIPE_ROWS", 20)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(negatives, "STEP", 16)
    assert mined(spark, rows) == want


def test_negatives_of_odd_rows(spark):
    ok = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.0]), (2, 2, [0.5, 0.25]), (3, 2, [0.5])]
    odd = [(None, 1, [1.0, 1.0]), (4, None, [1.0, 1.0]), (5, 1, None), (6, 1, [1.0, None]), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]), (9, 1, [])]
    repeated = [(2, 2, [0.5, 0.25]), (2, 3, [9.0, 9.0]), (10, 7, [0.1, 0.1]), (11, 4, [3e38, -3e38])]
    rows = ok + odd + repeated
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0) and mined(spark, rows)
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1.0])]) == [] and mined(spark, [(0, 1, [1.0])]) == []


def test_very_large_products_are_exact():
    import numpy as np

    a = np.array([[2.0**40, 3.0, 1.0]])
    assert negatives.products(a, np.array([[2.0**20, 5.0, 1.0]])).tolist() == [[2**60 + 16]]
    assert negatives.products(a * 2.0**30, a).tolist() == [[2**63 - 1]]


def plain_infill(doc_id, text):
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h, n, t = [int(d[i : i + 8], 16) for i in range(0, 32, 8)], len(text or ""), text or ""
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= 90:
        return "plain", None, None, t
    return ("spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


TEXTS = ["", None, "a", "é", "<P", "x<P>y", "<<<S", "no <M> here", "\U0001f600 wide\n", "<" * 50, "long text <S " * 20_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("piece", [3, 65_536])
def test_infill_equals_plain_python(spark, monkeypatch, piece):
    texts = TEXTS if piece > 3 else [t if not t or len(t) < 1000 else t[:900] for t in TEXTS]
    rows = [(i * 40 + j if i < 12 else None, t, "x") for i in range(13) for j, t in enumerate(texts)] + [(1, "same", "y")] * 3
    monkeypatch.setattr(infill, "PIECE", piece)
    if piece == 3:  # functions go to the workers by reference, so a small piece is tried here
        for doc_id, text, _ in rows:
            got = list(infill.pieces(0, doc_id, text))
            facts, ordered = got[0][1], [p for _, p in sorted(got[1:], key=lambda x: x[0])]
            form, prefix, middle, output = plain_infill(doc_id, text)
            assert (facts[2:], "".join(ordered)) == ((form, prefix, middle), output)
            back = list(infill.parts_of(iter(ordered), form))
            assert "".join(p for _, p in sorted(back, key=lambda x: x[0])) == (text or "")
        return
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted(map(str, (tuple(r) for r in infill.digests(docs).collect())))
    want = []
    for doc_id, text, _ in rows:
        form, prefix, middle, output = plain_infill(doc_id, text)
        want.append(str((doc_id, len(text or ""), form, prefix, middle, sha(output), sha(text or ""))))
    assert got == sorted(want)
    outputs = {(r.doc_id, r.output) for r in infill.transformed(docs).collect()}
    assert outputs == {(d, plain_infill(d, t)[3]) for d, t, _ in rows}
    assert infill.digests(docs.limit(0)).collect() == []


def test_restoring_sorts_within_partitions(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(20)], "doc_id long, text string")
    ordered, parts = infill.assembled(docs)
    again = infill._sorted(ordered.mapPartitions(infill._read_back, preservesPartitioning=True), parts)
    assert again.toDebugString().decode().count("ShuffledRDD") + again.toDebugString().decode().count("partitionBy") <= 2
    assert {r.form for r in infill.transformed(docs, plain=100).collect()} == {"plain"}
    assert {r.form for r in infill.transformed(docs, plain=0, spm=100).collect()} == {"spm"}
