"""Operator 13 against the tiktoken library, and its fold against merges in plain Python."""

import hashlib
import itertools
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bytebpe

RANKS = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
SPACES = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u2028", "\x1c", "\x85", " \n", "\n "]


def made_up(draw, n):
    parts = ["the", "Haus", "mañana", "é", "x" * 9, "12", "345678", "'s", "'ll", "don't", "--", "…", "中文字", "\U0001f600", "ß", "\u0558", "\U00033000", "e\u0301", "<|endoftext|>"]
    return "".join(draw.choice(parts + SPACES * 2) for _ in range(n))


def test_letters_and_spaces_are_the_librarys():
    own = bytebpe.compiled(PATTERN)
    plain = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    kinds = {r: tiktoken.Encoding("x", pat_str=r, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}) for r in (r"\p{L}", r"\p{N}", r"\s")}
    mine = {r: bytebpe.compiled(r) for r in kinds}
    for c in map(chr, (x for x in range(0x110000) if not 0xD800 <= x < 0xE000)):
        for r, library in kinds.items():
            assert bool(library.encode_ordinary(c)) == bool(mine[r].match(c)), (hex(ord(c)), r)
    assert "".join(own.findall("a b")) == bytes(plain.encode_ordinary("a b")).decode()


def test_cut_texts_have_the_patterns_matches():
    draw = random.Random(3)
    texts = [made_up(draw, draw.randrange(40)) for _ in range(2000)] + [None, "", " ", "  ", " a", "a ", "a  b", "\n a", " \n a "]
    for some in (texts, texts[:1], []):
        codes, counts, sizes, flat, words = bytebpe.numbered(pa.array(some, pa.string()), PATTERN)
        at, ends = 0, [0, *itertools.accumulate(sizes.tolist())]
        for text, n in zip(some, counts.tolist(), strict=True):
            got = [words[w] for c in codes[at : at + n] for w in flat[ends[c] : ends[c + 1]]]
            assert got == bytebpe.compiled(PATTERN).findall(text or "")
            at += n


def plain_merge(ranks, word):
    parts = [word[i : i + 1] for i in range(len(word))]
    if word in ranks:
        return [ranks[word]]
    while True:
        found = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
        if found is None:
            return [ranks[p] for p in parts]
        parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]


@pytest.mark.parametrize("long", [64, 3])
def test_fold_equals_plain_merges(spark, monkeypatch, long):
    """Also with ranks of no training, where a merge can make a pair of lower rank than its own."""
    monkeypatch.setattr(bytebpe, "LONG", long)
    draw = random.Random(7)
    for round in range(3):
        tokens = {"".join(draw.choice("abc") for _ in range(draw.randrange(2, 7))).encode() for _ in range(60)}
        ranks = {t: i for i, t in enumerate(draw.sample(sorted(tokens), len(tokens)))} if round else RANKS
        if round:
            ranks |= {bytes([i]): 1000 + i for i in range(256)}
        words = ["".join(draw.choice("abc") for _ in range(draw.randrange(1, 40))) for _ in range(300)] + ["a" * 200, "ab" * 70, "é" * 33, ""]
        merges = bytebpe.Merges(spark, ranks)
        df = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.get(merges.ids(F.array("w")), 0).alias("ids"))
        assert bool(merges.whole) == bool(round)
        for r in df.collect():
            assert r.ids == (plain_merge(ranks, r.w.encode()) if r.w else []), r.w


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize("most", [0, 40, 500_000])
def test_documents_equal_the_library(spark, monkeypatch, most):
    if most == 40:
        monkeypatch.setattr(bytebpe, "HELD", 20)
    draw = random.Random(1)
    texts = [None, "", " ", "word " * 30_000, "a" * 3000, "ACGT" * 900, "<|endoftext|>"] + [made_up(draw, 30) for _ in range(40)]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, "no id", "z"), (3, "same", "z"), (3, "same", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = sorted(str((i, len(k := LIBRARY.encode_ordinary(t or "")), sha(b"".join(x.to_bytes(4, "little") for x in k)), sha((t or "").encode()))) for i, t, _ in rows)
    assert sorted(str(tuple(r)) for r in bytebpe.digests(docs, RANKS, PATTERN, most).collect()) == want
    ids = bytebpe.encoded(docs, RANKS, PATTERN, most)
    got = {(r.doc_id, tuple(r.ids), bytes(r.t)) for r in ids.withColumn("t", bytebpe.decoded(F.col("ids"), RANKS)).collect()}
    assert got == {(i, tuple(LIBRARY.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in rows}
    assert bytebpe.digests(docs.limit(0), RANKS, PATTERN, most).collect() == []


def test_words_beyond_the_bound_are_left_out_together(spark):
    counts = spark.createDataFrame([("a", 100), ("b", 99), ("c", 7), ("d", 7), ("e", 1), ("w" * 65, 1000)], "word string, n long")
    words = lambda most: {r.word for r in bytebpe.frequent_words(counts, most).collect()}
    assert words(0) == words(1) == set() and words(2) == words(3) == {"a", "b"} and words(4) == {"a", "b", "c", "d"}
    assert words(9) == {"a", "b", "c", "d", "e"}


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bytebpe.digests(docs, RANKS, PATTERN).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids = LIBRARY.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), sha(b"".join(x.to_bytes(4, "little") for x in ids)))


def test_batches_are_cut_in_parts_of_a_bounded_size():
    batch = pa.RecordBatch.from_pydict({"text": [str(i) for i in range(2 * bytebpe.PART + 5)]})
    parts = list(bytebpe._parts(iter([batch])))
    assert [p.num_rows for p in parts] == [bytebpe.PART, bytebpe.PART, 5] and pa.Table.from_batches(parts).to_batches()[2]["text"][4].as_py() == str(2 * bytebpe.PART + 4)


def test_ids_and_bytes_between_other_words_are_made_in_the_batch():
    """So that Spark needn't name every token of a text, only those of words that weren't encoded beforehand."""
    pieces = [b"", b"a", "\u00e9".encode(), b"\xff", b"the"]
    ids = [[], [4], [-1], [-1, 1], [1, -2, 3, 2, -1, -2], [], [2, 4, 0], [-1, -1]]
    for some in (ids, ids[:1], [[-1]], [[], []], []):
        rows = {"doc_id": pa.array(range(len(some)), pa.int64()), "ids": pa.array(some, pa.list_(pa.int32())), "missed": pa.array([["x", "y"]] * len(some), pa.list_(pa.string()))}
        got = bytebpe._parted(pa.RecordBatch.from_pydict(rows), pa.array(pieces, pa.binary()))
        assert [r["others"] for r in got.to_pylist()] == [[-1 - i for i in row if i < 0] for row in some]
        for r, row in zip(got.to_pylist(), some, strict=True):
            runs = [[]]
            for i in row:
                runs = [*runs[:-1], [*runs[-1], i]] if i >= 0 else [*runs, []]
            assert r["numbers"] == [b"".join(i.to_bytes(4, "little") for i in run) for run in runs]
            assert r["pieces"] == [b"".join(pieces[i] for i in run) for run in runs] and r["missed"] == ["x", "y"]
