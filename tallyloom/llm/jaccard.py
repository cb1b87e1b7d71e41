"""Exact Jaccard join of word-shingle sets: size-banded tiles, bitmap signatures, sorted-array intersection.

Two sets with a similarity of at least 3/4 share one of the tokens that come first in each of them, in any order that
is the same for all sets: within n - ceil(3n/4) + 1 tokens of the larger set and n - ceil(6n/7) + 1 of the smaller.
So sets meet in tiles, one for each such token, sorted by size. The order puts tokens that many texts share last,
which keeps common passages out of the tiles. Tiles are worked off twice. First every set is tried with two hubs of
its size band in each tile and with its neighbour by size, which links groups of copies without pairing their members
with each other. Then the tiles that still hold several components are thrown together by their least component and
size band as far as that saves comparisons, cut into blocks, and the bitmap signatures of all pairs of different
components in them compared in place, if the smaller set has one of the tile's tokens among its first ones. Every pair
is bounded by the bits of its signatures, and only what the bound lets through is intersected exactly.

Texts with equal sets are one class from the start, known by half of the set's 128-bit digest. The other half is
compared too; should two sets ever share the first half, all digests are drawn anew.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, drop
from tallyloom.llm.shingles import mix, shingle_sets

#: Tokens that come last in the order, at most: 8 bytes each in every task.
COMMON_TOKENS = 50_000
#: Sets in a block of a tile.
BLOCK = 2048
#: Rows of a table that is broadcast, at most; a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Sets that are intersected with one other in a row.
GROUP = 256
BAND = np.log(4 / 3)


def digest(tokens: np.ndarray, seed: int = 0) -> tuple[int, int]:
    """Class of a set, and a check that two sets of one class are equal, as signed 64-bit numbers."""
    both = hashlib.blake2b(tokens.tobytes(), digest_size=16, salt=seed.to_bytes(8, "little")).digest()
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def signature_bits(n: int) -> int:
    return 1 << min(16, max(6, n.bit_length() + 3))


def signature(tokens: np.ndarray) -> bytes:
    """Bitmap with eight to sixteen bits an element, a power of two from 64 to 65536: few elements share a bit."""
    bits = signature_bits(len(tokens))
    flags = np.zeros(bits, bool)
    flags[(mix(tokens) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def packed(sig: bytes) -> bytes:
    """A signature as it is shuffled and written. At most an eighth of its bits are set, so that entropy coding, which
    Spark's own compression of shuffles lacks, leaves about half."""
    return pa.Codec("zstd").compress(sig, asbytes=True)


def unpacked(n: int, sig: bytes) -> bytes:
    return pa.Codec("zstd").decompress(sig, signature_bits(n) // 8, asbytes=True)


def overlap_bound(n_a: int, sig_a: bytes, n_b: int, sig_b: bytes) -> int:
    """An overlap that two sets can't exceed: each bit that only one has stands for an element the other lacks."""
    a, b = (np.frombuffer(s, np.uint64) for s in (sig_a, sig_b))
    width = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, width)) for x in (a, b))
    return min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))


def similar(overlap: int, n_a: int, n_b: int) -> bool:
    return 100 * overlap >= 75 * (n_a + n_b - overlap)


def _batch(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def _parts(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that only some of its texts stand in memory twice."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def _texts(batch: pa.RecordBatch) -> list[str | None]:
    return batch.column("text").to_pylist()


def _sets(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                found = list(shingle_sets(_texts(part)))
                keys = [digest(s, seed) if len(s) else (None, None) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "text_hash")),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([k for k, _ in keys], pa.int64()),
                        pa.array([c for _, c in keys], pa.int64()),
                        pa.array([packed(signature(s)) if len(s) else None for s in found], pa.binary()),
                    ],
                    names=["doc_id", "text_hash", "n", "k", "check", "sig"],
                )

    return run


def _frequent(batches: Iterator[pa.RecordBatch], chunk: int = 1_000_000, least: int = 3) -> Iterator[pa.RecordBatch]:
    """(token, texts) for tokens that `least` or more different texts of a chunk share."""
    waiting: list[np.ndarray] = []
    seen: set[int] = set()

    def flush() -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(waiting), return_counts=True)
        often = counts >= least
        waiting.clear()
        seen.clear()
        return _batch({"token": (tokens[often].view(np.int64), pa.int64()), "texts": (counts[often], pa.int64())})

    size = 0
    for batch in batches:
        for tokens in shingle_sets(_texts(batch)):
            if len(tokens) and (k := digest(tokens)[0]) not in seen:
                seen.add(k)
                waiting.append(tokens)
                size += len(tokens)
            if size >= chunk:
                yield flush()
                size = 0
    if waiting:
        yield flush()


def common_tokens(docs: DataFrame, most: int = COMMON_TOKENS) -> np.ndarray:
    """The tokens that the most texts share, the most frequent last. They decide the order, so the speed, not the result."""
    counted = docs.select("text").mapInArrow(_frequent, "token long, texts long").groupBy("token").agg(F.sum("texts").alias("texts"))
    top = counted.orderBy(F.desc("texts"), "token").limit(most).collect()
    return np.array([r.token for r in reversed(top)], np.int64).view(np.uint64)


def _tokens(common: np.ndarray, seed: int):
    order = np.argsort(common)
    table = common[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Prefix tokens: token, class, and 2n, plus one if the smaller of a pair would find it too."""
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple[np.ndarray, int, np.ndarray]] = []
            for tokens in shingle_sets(_texts(batch)):
                n = len(tokens)
                if not n or (k := digest(tokens, seed)[0]) in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(k)
                at = np.searchsorted(table, tokens)
                rank = np.where(table[np.minimum(at, len(table) - 1)] == tokens, order[np.minimum(at, len(table) - 1)] + 1, 0) if len(table) else np.zeros(n, int)
                prefix = tokens[np.argsort(rank, kind="stable")[: n - -(-3 * n // 4) + 1]]
                near = np.arange(len(prefix)) < n - -(-6 * n // 7) + 1
                out.append((prefix, k, 2 * n + near))
            if out:
                yield _batch({
                    "token": (np.concatenate([p for p, _, _ in out]).view(np.int64), pa.int64()),
                    "k": (np.repeat([k for _, k, _ in out], [len(p) for p, _, _ in out]), pa.int64()),
                    "code": (np.concatenate([c for _, _, c in out]), pa.int64()),
                })

    return run


def _hubs(k: np.ndarray, segment: np.ndarray, seed: int) -> np.ndarray:
    """For every row the class with the least hash so far in its segment (segments are numbered in order)."""
    # Least so far over all rows, with later segments below all earlier ones, is least so far in each segment.
    rank = mix(k.view(np.uint64) + np.uint64(seed)) >> np.uint64(12)
    order = np.argsort(rank, kind="stable")
    place = np.empty(len(k), np.int64)
    place[order] = np.arange(len(k))
    low = np.minimum.accumulate(place - segment * len(k))
    return k[order[low + segment * len(k)]]


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token, code and class, without repeated ones and those alone in their tile, with three classes
    of the tile that each is tried with: two hubs, each the least so far in its size band by a hash of its own, and the
    row before. Rows stream by: only the last one and its hubs are held until the next come."""
    names = ("token", "k", "code", "hub0", "hub1", "before")
    held: list[np.ndarray] | None = None
    joined = False

    def made(columns: list[np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
        return _batch({name: (v[keep], pa.int64()) for name, v in zip(names, columns, strict=True)})

    for batch in batches:
        token, k, code = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "k", "code"))
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (k[1:] != k[:-1])])[: len(k)]
        if held is not None and len(k) and (held[0][0], held[1][0]) == (token[0], k[0]):
            fresh &= np.cumsum(fresh) > 1
        token, k, code = token[fresh], k[fresh], code[fresh]
        if not len(k):
            continue
        # What was held stands first: its hubs, then the row itself.
        lead = [] if held is None else [(held[0][0], h, held[2][0]) for h in (held[3][0], held[4][0], held[1][0])]
        extra = len(lead)
        if extra:
            token, k, code = (np.concatenate([[x[i] for x in lead], c]) for i, c in enumerate((token, k, code)))
        same = token[1:] == token[:-1]
        band = np.floor(np.log(code >> 1) / BAND).astype(np.int64)
        segment = np.cumsum(np.concatenate([[False], ~same | (band[1:] != band[:-1])]))
        before = np.concatenate([k[:1], np.where(same, k[:-1], k[1:])])
        columns = [token, k, code, _hubs(k, segment, 1), _hubs(k, segment, 2), before]
        if extra:  # the held row as it was, without its hubs
            columns = [np.concatenate([h, c[extra:]]) for h, c in zip(held, columns, strict=True)]
            same = same[extra - 1 :]
        met = np.concatenate([[joined], same])
        keep = (met | np.concatenate([same, [False]]))[:-1]
        yield made([c[:-1] for c in columns], keep)
        held, joined = [c[-1:] for c in columns], bool(met[-1])
    if held is not None and joined:
        yield made(held, np.array([True]))


def tiles(docs: DataFrame, common: np.ndarray, seed: int = 0) -> DataFrame:
    """(token, k, code, hub0, hub1, before) of all tiles with two classes or more."""
    rows = docs.filter("doc_id is not null").select("text").mapInArrow(_tokens(common, seed), "token long, k long, code long")
    dealt = rows.repartition("token").sortWithinPartitions("token", "code", "k")
    return dealt.mapInArrow(_tiled, "token long, k long, code long, hub0 long, hub1 long, before long")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components between blocks i and j of a tile that the bounds of their signatures let through.
    Rows come sorted by tile, part, band, i and j; a group of them has about two blocks' rows at most."""
    rest: pa.Table | None = None
    keys = ("tile", "part", "tile_band", "i", "j")

    def group(t: dict[str, np.ndarray], sigs: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        widths = np.array([len(x) for x in sigs])
        stacked = {int(w): np.stack([sigs[p] for p in np.flatnonzero(widths == w)]) for w in np.unique(widths)}
        where = {w: np.flatnonzero(widths == w) for w in stacked}
        a_out, b_out = [], []
        i, j, band = t["i"][0], t["j"][0], t["tile_band"][0]
        for p in np.flatnonzero(t["block"] == i):
            n = t["n"][p]
            fit = (t["block"] == j) & (t["label"] != t["label"][p]) & (np.minimum(t["band"], t["band"][p]) == band)
            fit &= 4 * np.minimum(t["n"], n) >= 3 * np.maximum(t["n"], n)
            fit &= np.where(t["n"] < n, t["near"], t["near"][p]) > 0
            if i == j:
                fit[: p + 1] = False
            for w, rows in where.items():
                own = fit[rows]
                if not own.any():
                    continue
                at, width = rows[own], min(w, len(sigs[p]))
                x = np.bitwise_or.reduce(sigs[p].reshape(-1, width))
                y = np.bitwise_or.reduce(stacked[w][own].reshape(len(at), -1, width), axis=1)
                m = t["n"][at]
                most = np.minimum(n - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), m - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
                good = t["k"][at[100 * most >= 75 * (n + m - most)]]
                a_out.append(np.minimum(good, t["k"][p]))
                b_out.append(np.maximum(good, t["k"][p]))
        return a_out, b_out

    def made(table: pa.Table) -> pa.RecordBatch:
        t = {c: table.column(c).to_numpy() for c in (*keys, "block", "k", "n", "near", "band", "label")}
        sigs = [np.frombuffer(unpacked(n, x), np.uint64) for n, x in zip(t["n"].tolist(), table.column("sig").to_pylist(), strict=True)]
        change = np.logical_or.reduce([t[c][1:] != t[c][:-1] for c in keys])
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        a_out, b_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            a, b = group({c: v[lo:hi] for c, v in t.items()}, sigs[lo:hi])
            a_out += a
            b_out += b
        return _batch({"a": (np.concatenate(a_out), pa.int64()), "b": (np.concatenate(b_out), pa.int64())})

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        same = np.logical_and.reduce([(v := table.column(c).to_numpy()) == v[-1] for c in keys])
        open_from = int(np.argmax(same))
        if open_from:
            yield made(table.slice(0, open_from))
        rest = table.slice(open_from)
    if rest is not None:
        yield made(rest)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bound allows the similarity."""
    for batch in batches:
        n_a, n_b, s_a, s_b = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "sig_a", "sig_b"))
        good = [similar(overlap_bound(a, unpacked(a, x), b, unpacked(b, y)), a, b) for a, x, b, y in zip(n_a, s_a, n_b, s_b, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _intersected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that are similar. A held set comes first, with no class beside it, then those that it is compared with."""
    own, part, mine = None, None, np.zeros(0, np.uint64)
    for whole in batches:
        for batch in _parts(whole):
            a_out, b_out = [], []
            rows = zip(batch.column("held").to_pylist(), batch.column("part").to_pylist(), batch.column("other").to_pylist(), shingle_sets(_texts(batch)), strict=True)
            for held, salt, other, tokens in rows:
                if other is None:
                    own, part, mine = held, salt, tokens.copy()
                elif (own, part) != (held, salt):
                    raise ValueError("a set is missing")
                elif similar(len(np.intersect1d(mine, tokens, assume_unique=True)), len(mine), len(tokens)):
                    a_out.append(held)
                    b_out.append(other)
            yield _batch({"a": (a_out, pa.int64()), "b": (b_out, pa.int64())})


def _classed(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                found = [digest(s, seed)[0] for s in shingle_sets(_texts(part))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), part.column("rep"), part.column("text")], names=["own", "rep", "text"])

    return run


def _small(df: DataFrame) -> DataFrame:
    """df marked for broadcast if its rows, counted first, are few enough; else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, seed: int = 0) -> DataFrame:
    """The pairs (a, b) of classes that are similar: bounded by signatures first, then intersected. Written.

    For the intersection, of each pair the set that more pairs have is held and those of the others are compared with it,
    in groups of about GROUP: its text goes once into each group, and no task ever needs all of them.
    """
    side = lambda s: classes.select(F.col("k").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
    signed = pairs.join(side("a"), "a").join(side("b"), "b")
    left = cut(signed.mapInArrow(_bounded, "a long, b long"))
    wanted = cut(left.select(F.col("a").alias("k")).union(left.select("b")).distinct().join(classes.select("k", "doc_id"), "k"))
    found = docs.join(_small(wanted.select("doc_id", F.col("k").alias("rep"))), "doc_id").select("rep", "text")
    # doc_ids may repeat with other texts; the class of the text tells which is meant.
    texts = found.mapInArrow(_classed(seed), "own long, rep long, text string").filter("own = rep").dropDuplicates(["rep"])
    texts = cut(texts.select(F.col("rep").alias("k"), "text"))
    # Few sets have many pairs; the rest need no count.
    often = left.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP // 8)
    often = _small(cut(often))
    of = lambda s: often.select(F.col("k").alias(s), F.col("n").alias(f"n_{s}"))
    counted = left.join(of("a"), "a", "left").join(of("b"), "b", "left").withColumn("n", F.greatest("n_a", "n_b", F.lit(1)))
    swap = F.coalesce(F.col("n_b"), F.lit(0)) > F.coalesce(F.col("n_a"), F.lit(0))
    held, other = F.when(swap, F.col("b")).otherwise(F.col("a")), F.when(swap, F.col("a")).otherwise(F.col("b"))
    placed = cut(counted.select(held.alias("held"), F.pmod(F.xxhash64(other), F.ceil(F.col("n") / GROUP)).alias("part"), other.alias("other")))
    heads = placed.select("held", "part").distinct().withColumn("other", F.lit(None).cast("long"))
    both = heads.join(texts, heads["held"] == texts["k"]).unionByName(placed.join(texts, placed["other"] == texts["k"])).drop("k")
    dealt = both.repartition("held", "part").sortWithinPartitions("held", "part", F.col("other").asc_nulls_first())
    similar_pairs = cut(dealt.mapInArrow(_intersected, "a long, b long"))
    drop(left, wanted, texts, placed)
    return similar_pairs


def components(edges: DataFrame) -> DataFrame:
    """(k, root) for every node of edges (a, b): root is the least node of its component, and has no row itself.

    Large-star and small-star steps in turn: each hangs nodes onto the least node around, until every component is a
    star around its least node. Edges stay as many as nodes, groups are only folded to their least member, and every
    round is written.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(now.select("v", F.lit(0), F.lit(1)))
        loose = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 or down = 1 and up = 1")
        if loose.isEmpty():
            return now.select(F.col("u").alias("k"), F.col("v").alias("root"))
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        best = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(best, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        last, now = now, cut(small.union(best.select("u", F.col("m").alias("v"))).distinct())
        drop(last)


def _refined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """roots (k, root) with the components joined that the links `more` lead between."""
    if more.isEmpty():
        return roots
    side = lambda s: roots.select(F.col("k").alias(s), F.col("root").alias(f"root_{s}"))
    between = more.join(side("a"), "a", "left").join(side("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    merged = components(between).select(F.col("k").alias("root"), F.col("root").alias("top"))
    moved = roots.join(merged, "root", "left").select("k", F.coalesce("top", "root").alias("root"))
    return cut(moved.union(merged.select("root", "top")))


def _still_apart(tiled: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes of different components that share a token and that the bounds let through.

    Tiles whose least component is the same hold much the same classes, so they are thrown together, unless they don't:
    where comparing all their classes would take more than comparing tile by tile, they are dealt by token into parts of
    about BLOCK entries. So comparisons stay in proportion to the tiles' entries, times BLOCK. Each class stands once in
    a tile for its own size band and once in the one for the band below, and each pair is compared in the tile of its
    lesser band. Tiles of more than BLOCK rows are cut into blocks, every pair of which is a group of its own.
    """
    near = F.col("code").bitwiseAND(1)
    labelled = tiled.join(labels, "k", "left").select("token", "k", F.shiftright("code", 1).alias("n"), near.alias("near"), F.coalesce("root", "k").alias("label"))
    ends = labelled.groupBy("token").agg(F.min("label").alias("tile"), F.max("label").alias("high"), F.max("near").alias("any")).filter("tile < high and any = 1")
    entries = cut(labelled.join(ends.select("token", "tile"), "token"))
    sizes = entries.groupBy("tile", "k").agg(F.count("*").alias("tokens")).groupBy("tile").agg(F.count("*").alias("rows"), F.sum("tokens").alias("entries"))
    wide = sizes.filter(F.col("rows") * F.col("rows") > 4 * BLOCK * F.col("entries")).select("tile", F.ceil(F.col("entries") / BLOCK).alias("parts"))
    part = F.coalesce(F.pmod(F.xxhash64("token"), F.col("parts")), F.lit(0))
    mixed = entries.join(_small(cut(wide)), "tile", "left").withColumn("part", part).groupBy("tile", "part", "k", "n", "label").agg(F.max("near").alias("near"))
    band = F.floor(F.log(F.col("n").cast("double")) / float(BAND)).cast("long")
    banded = mixed.withColumn("band", band).withColumn("tile_band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    banded = cut(banded)
    own = ["tile", "part", "tile_band"]
    ends = [F.min("label").alias("low"), F.max("label").alias("high"), F.min("band").alias("least"), F.max("near").alias("any")]
    counts = banded.groupBy(*own).agg(F.count("*").alias("rows"), *ends)
    # A tile of a band has pairs only if a class of that very band is in it, and one that the smaller of a pair would find.
    counts = counts.filter("low < high and least = tile_band and any = 1").select(*own, F.ceil(F.col("rows") / BLOCK).alias("blocks"))
    placed = banded.join(_small(cut(counts)), own).withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    signed = met.join(classes.select("k", "sig"), "k").select(*own, "i", "j", "block", "k", "n", "near", "band", "label", "sig")
    dealt = signed.repartition(*own, "i", "j").sortWithinPartitions(*own, "i", "j", "n", "k")
    pairs = cut(dealt.mapInArrow(_compared, "a long, b long").distinct())
    drop(entries, banded)
    return pairs


def _tried(tiled: DataFrame, *others: str) -> DataFrame:
    """Distinct pairs (a, b): b is a row's class, a what a named column holds in most of its tiles. Written.

    That makes one pair a class and column, whatever the number of tiles and the size of the group.
    """

    def pairs(column: str) -> DataFrame:
        counted = tiled.filter(F.col(column) != F.col("k")).groupBy(F.col(column).alias("a"), F.col("k").alias("b")).agg(F.count("*").alias("n"))
        best = counted.groupBy("b").agg(F.max(F.struct("n", "a")).alias("best"))
        return best.select(F.least("best.a", "b").alias("a"), F.greatest("best.a", "b").alias("b"))

    return cut(functools.reduce(DataFrame.union, map(pairs, others)).distinct())


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(sets, least, seed): the set of every document, one row for each class, and the seed of their digests."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    for seed in itertools.count():
        sets = cut(rows.mapInArrow(_sets(seed), f"doc_id {kind}, text_hash long, n long, k long, check long, sig binary"))
        known = sets.filter("k is not null and doc_id is not null").groupBy("k")
        least = cut(known.agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.min("check").alias("check"), F.max("check").alias("other")))
        if least.filter("check <> other").isEmpty():
            return sets.drop("check"), least.select("k", "n", "doc_id"), seed
        drop(sets, least)


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, roots): doc_id, text_hash, n, k of every document; root of every class that is linked to a lesser one."""
    sets, least, seed = _classes(docs)
    tiled = cut(tiles(docs, common_tokens(docs), seed))
    # Only classes that share a token with another one are ever compared.
    known = least.join(tiled.select("k").distinct(), "k", "left_semi")
    classes = cut(known.join(sets.select("doc_id", "k", "sig"), ["doc_id", "k"]).dropDuplicates(["k"]))
    roots = components(links(_tried(tiled, "hub0", "hub1", "before"), docs, classes, seed))
    pairs = _still_apart(tiled, roots, classes)
    roots = _refined(roots, links(pairs, docs, classes, seed))
    drop(tiled, classes, pairs)
    return sets, roots


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, component_id and root (its component, null without words) of every document."""
    sets, roots = linked_classes(docs)
    placed = sets.join(roots, "k", "left").select("doc_id", "text_hash", "n", F.coalesce("root", "k").alias("root"))
    least = placed.filter("root is not null and doc_id is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return placed.join(least, "root", "left").select("doc_id", "text_hash", "n", component.alias("component_id"), "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document.

    component_id is the smallest doc_id that links lead to. Documents without words or text link with nothing and are
    their own component. A null doc_id is never linked and has a null component. Repeated rows are each returned.
    """
    return _placed(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each component, the one with the smallest doc_id, its columns as they are.

    Where several texts of a component have that doc_id, the one with the least hash stays. Documents that link with
    nothing stay, empty ones and those without doc_id too. Of rows that repeat a doc_id and a text one stays. The rows
    to leave out are broadcast while they are few enough, else joined by a shuffle.
    """
    placed = cut(_placed(docs).filter("doc_id is not null").select("doc_id", "text_hash", "component_id", "root"))
    firsts = cut(placed.filter("component_id = doc_id").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n")))
    several = firsts.filter("root is not null").groupBy("root").agg(F.min("text_hash").alias("best"), F.count("*").alias("texts")).filter("texts > 1")
    beside = firsts.join(several, "root").filter("text_hash <> best").select("doc_id", "text_hash")
    gone = placed.filter("component_id <> doc_id").select("doc_id", "text_hash").union(beside).distinct()
    again = cut(firsts.filter("n > 1").select("doc_id", "text_hash"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    kept = rows.join(_small(cut(gone)), ["doc_id", "text_hash"], "left_anti")
    if not again.isEmpty():
        single = kept.join(_small(again), ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
        kept = kept.join(_small(again), ["doc_id", "text_hash"], "left_anti").unionByName(single)
    return kept.select("row.*")
