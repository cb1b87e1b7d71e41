"""The Jaccard join against comparing all pairs of plain Python sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import jaccard, shingles

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    w = WORDS.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """{doc_id: (n, component)} by shared shingles counted over all pairs."""
    sets = [(d, plain_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    where = defaultdict(list)
    for i, (d, s) in enumerate(sets):
        counts = defaultdict(int)
        for g in s:
            for j in where[g]:
                counts[j] += 1
            where[g].append(i)
        for j, inter in counts.items():
            e, t = sets[j]
            if d is not None and e is not None and 100 * inter >= 75 * (len(s) + len(t) - inter):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def groups():
    """Groups around the threshold, a chain, a hot passage, and a group of mostly common text with thin links."""
    rng, rows = random.Random(5), []
    base = [f"w{i}" for i in range(150)]
    rows += [" ".join(edited(base, rng.randrange(0, 9), rng)) for _ in range(150)]
    chain = [f"c{i}" for i in range(400)]
    rows += [" ".join(chain[i * 6 : i * 6 + 100]) for i in range(40)]
    passage = [f"p{i}" for i in range(60)]
    rows += [" ".join(passage + [f"u{j}x{i}" for i in range(rng.randrange(5, 40))]) for j in range(150)]
    rows += [" ".join([f"k{i}" for i in range(5 + j % 7)]) for j in range(30)]
    rows += ["A b C d", "a B c D", "a b c", "", None, "  \t\n", "x " * 50, "x " * 500, "one", "one", "One"]
    rows += ["z\x0bz\x1cz z z z z", "é " * 9, "    a b c d e f"]
    return list(enumerate(rows))


ODD = [(None, "one two three four five six seven"), (None, None), (3, " ".join(f"w{i}" for i in range(150))), (3, "something else entirely here now")]


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows", [groups(), groups()[:60] + [(9000, ""), (None, "one two three")]])
def test_planted_groups(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(jaccard.near_duplicates(docs)) == brute(rows)


def test_large_tiles_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    docs = spark.createDataFrame(groups(), "doc_id long, text string").repartition(3)
    assert result(jaccard.near_duplicates(docs)) == brute(groups())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert result(jaccard.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_repeated_ids_and_empty_table(spark):
    docs = spark.createDataFrame(groups()[:5] + ODD, "doc_id long, text string")
    got = result(jaccard.near_duplicates(docs))
    assert len(got) == 9 and (None, 3, None) in got and (None, 0, None) in got
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_words_of_two_letters_in_opposite_order_differ(spark):
    for n in (8, 64, 65, 1024, 2048, 4096):
        assert shingles.word_hashes(thue_morse(n, "a", "b"))[0] != shingles.word_hashes(thue_morse(n, "b", "a"))[0]
    parts = [np.array([int(c) for c in thue_morse(64, a, b)], np.uint64) for a, b in ("01", "10")]
    assert all((shingles.windows(parts[0], w)[:1] != shingles.windows(parts[1], w)[:1]).all() for w in (2, 5, 32, 50, 64))
    rows = [(1, thue_morse(1024, "a", "b")), (2, thue_morse(1024, "b", "a"))]
    assert result(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_digests_are_drawn_anew_when_two_sets_share_one(spark, monkeypatch):
    rows = [(1, "a b c d e f"), (2, "one two three"), (3, "A b c d e f"), (4, "four"), (5, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = []
    sets = jaccard._sets

    def clashing(seed):
        drawn.append(seed)
        inner = sets(seed)

        def run(batches):
            for b in inner(batches):
                yield b.set_column(3, "k", pa.array([7 if seed == 0 and n else k for k, n in zip(b["k"].to_pylist(), b["n"].to_pylist(), strict=True)], pa.int64()))

        return run

    monkeypatch.setattr(jaccard, "_sets", clashing)
    assert result(jaccard.near_duplicates(docs)) == brute(rows) and drawn == [0, 1]


@pytest.mark.parametrize("block", [2, 5])
def test_tiles_dealt_into_parts(spark, monkeypatch, block):
    """With blocks this small every tile is split by token; the result stays the same."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "GROUP", 3)
    rows = groups()[:60] + groups()[150:260]
    assert result(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_tiles_don_t_depend_on_batches():
    rng = np.random.default_rng(1)
    # A class has one size, so one code within a tile.
    rows = sorted({(int(t), int(k) % 7 + 20, int(k)) for t, k in zip(rng.integers(0, 40, 300), rng.integers(0, 50, 300), strict=True)})
    rows = sorted(rows + rows[::7])
    one = lambda part: pa.RecordBatch.from_pydict({"token": [r[0] for r in part], "k": [r[2] for r in part], "code": [r[1] for r in part]}, pa.schema([(c, pa.int64()) for c in ("token", "k", "code")]))
    run = lambda size: [tuple(x.values()) for b in jaccard._tiled(one(rows[i : i + size]) for i in range(0, len(rows), size)) for x in b.to_pylist()]
    assert run(1) == run(7) == run(len(rows))
    met = {(t, k, c) for t, c, k in rows if len({x[2] for x in rows if x[0] == t}) > 1}
    assert {r[:3] for r in run(7)} == met and len(run(7)) == len(met)
    assert all({(t, h) for h in (a, b, p)} <= {(x[0], x[1]) for x in met} for t, _, _, a, b, p in run(7))


def test_bounds_hold():
    rng = random.Random(2)
    for _ in range(300):
        a = np.unique(np.array([rng.randrange(400) for _ in range(rng.randrange(1, 300))], np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        b = np.unique(np.array([rng.randrange(400) for _ in range(rng.randrange(1, 300))], np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        bound = jaccard.overlap_bound(len(a), jaccard.signature(a), len(b), jaccard.signature(b))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_shingles_of_long_texts_equal_those_of_parts(monkeypatch):
    text = " ".join(f"word{i % 997}é" for i in range(30_000)) + " " + "y" * 3000
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "_STEP", 1000)
    assert np.array_equal(whole, shingles.word_hashes(text))
    assert len(np.unique(whole)) == len(set(WORDS.findall(text)))


def test_one_row_stays_of_a_component_whose_first_id_has_two_texts(spark):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a, "x"), (1, a + " more words", "y"), (2, a, "z"), (3, "something else entirely", "t"), (1, "not linked at all, this one", "u"), (3, "something else entirely", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    for _ in range(2):
        kept = jaccard.one_of_each(docs).collect()
        assert sorted(r.doc_id for r in kept) == [1, 1, 3] and sum("w5 " in r.text for r in kept) == 1


def test_signatures_are_shuffled_packed():
    for n in (1, 40, 700, 3000):
        tokens = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
        sig = jaccard.signature(tokens)
        assert jaccard.unpacked(len(tokens), jaccard.packed(sig)) == sig and (n < 700 or len(jaccard.packed(sig)) < 0.7 * len(sig))
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text_hash": [1, 2], "text": [" ".join(map(str, range(900))), None]})
    (out,) = jaccard._sets(0)(iter([rows]))
    assert len(out["sig"][0].as_py()) < 0.7 * jaccard.signature_bits(896) / 8 and out["sig"][1].as_py() is None
