"""Hard negatives by a secondary-sort shuffle.

Scores of pairs become keys (anchor, descending score, kind, id). repartitionAndSortWithinPartitions brings each anchor's
keys together in that order, and an iterator reads them once: a positive opens a window of scores, a negative is given to
every window open at its score that still wants one, so a task holds a few windows and never an anchor's rows.

Only scores that can come out are shuffled. Rows and anchors are dealt into tiles (a stripe of rows by a block of
anchors, both of bounded size); a tile multiplies them in small blocks and keeps, for each anchor, its best rows of the
same label and then, once the positives are known, the best rows of every window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import cut

#: Rows of a stripe and anchors of a block, at most about; stripes of small tables are more and smaller.
STRIPE_ROWS, BLOCK_ANCHORS, STRIPES = 131_072, 4096, 16
#: Rows multiplied at once, at most.
STEP = 2048
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part: all three there, every component a finite number."""
    label = F.col("label") if label is None else label
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding"
    )


def _read(table: pa.Table):
    """(ids, labels, whole-number vectors): one row an id, the least by label and vector; missing components count 0."""
    import numpy as np

    ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
    lists = table["embedding"].combine_chunks()
    sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
    wide = np.zeros((len(ids), int(sizes.max(initial=0))))
    wide[np.arange(wide.shape[1])[None, :] < sizes[:, None]] = flat
    order = np.lexsort((*wide.T[::-1], labels, ids))
    order = order[np.flatnonzero(np.diff(ids[order], prepend=ids[order][:1] - 1) != 0)] if len(ids) else order
    return ids[order], labels[order], np.floor(256.0 * wide[order])


def products(a, b):
    """Integer inner products of all rows of a and b, held within 64 bits where they are larger."""
    import numpy as np

    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 2.0**53:
        return (a @ b.T).astype(np.int64)  # each sum is exact in a double
    whole = np.frompyfunc(int, 1, 1)
    top = 2**63 - 1
    return np.clip(whole(a) @ whole(b).T, -top, top).astype(np.int64)


class Best:
    """The `most` best (score, id) of each of n anchors: higher scores first, then smaller ids."""

    def __init__(self, n: int, most: int):
        import numpy as np

        self.most, self.least = most, np.full(n, -(2**63) + 1, np.int64)
        self.at = self.score = self.id = np.zeros(0, np.int64)

    def add(self, at, score, id) -> None:
        import numpy as np

        at, score, id = (np.concatenate(x) for x in ((self.at, at), (self.score, score), (self.id, id)))
        order = np.lexsort((id, -score, at))
        at, score, id = at[order], score[order], id[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        self.least[at[place == self.most - 1]] = score[place == self.most - 1]
        kept = place < self.most
        self.at, self.score, self.id = at[kept], score[kept], id[kept]


def _blocks(n: int) -> Iterator[slice]:
    """Small blocks first, so that most of the later ones' rows fall below the best seen."""
    at, size = 0, 64
    while at < n:
        yield slice(at, at + size)
        at, size = at + size, min(STEP, size * 2)


def _same_label(anchors: pa.Table, rows: pa.Table, most: int) -> pa.Table:
    """The best `most` other rows of each anchor's label in this tile."""
    import numpy as np

    (ids, labels, vectors), (others, kinds, theirs) = _read(anchors), _read(rows)
    best = Best(len(ids), most)
    for label in np.unique(labels):
        mine, same = np.flatnonzero(labels == label), np.flatnonzero(kinds == label)
        for part in _blocks(len(same)):
            row = same[part]
            score = products(vectors[mine], theirs[row])
            i, j = np.nonzero((score >= best.least[mine][:, None]) & (ids[mine][:, None] != others[row][None, :]))
            best.add(mine[i], score[i, j], others[row][j])
    return pa.table({"anchor_id": ids[best.at], "score": best.score, "id": best.id})


def _in_windows(anchors: pa.Table, rows: pa.Table, most: int, low: int, high: int) -> pa.Table:
    """The rows of another label that are among the first `most` of this tile in one of their anchor's windows."""
    import numpy as np

    order = anchors.sort_by("vec_id")
    (ids, labels, vectors), (others, kinds, theirs) = _read(order), _read(rows)
    windows = [w.as_py() for w in order["positives"]]
    out = []
    for k in range(max(map(len, windows), default=0)):
        p = np.array([w[k] if k < len(w) else -1 for w in windows], object)  # a negative score has an empty window
        least = np.array([-(-low * x // 100) for x in p], np.int64)
        out.append((Best(len(ids), most), least, np.array([high * x // 100 for x in p], np.int64)))
    for part in _blocks(len(others)):
        score = products(vectors, theirs[part])
        apart = labels[:, None] != kinds[part][None, :]
        for best, least, top in out:
            i, j = np.nonzero(apart & (score >= np.maximum(least, best.least)[:, None]) & (score <= top[:, None]))
            best.add(i, score[i, j], others[part][j])
    found = {x for best, _, _ in out for x in zip(ids[best.at].tolist(), best.score.tolist(), best.id.tolist(), strict=True)}
    names = ("anchor_id", "score", "id")
    return pa.table({n: pa.array([x[i] for x in found], pa.int64()) for i, n in enumerate(names)})


def _tiled(anchors: DataFrame, rows: DataFrame, blocks: int, stripes: int, search: Callable) -> DataFrame:
    """search over every tile: a block of anchors and a stripe of rows, which each meet in a group of their own."""
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = anchors.withColumn("block", dealt(blocks)).withColumn("stripe", all_of(stripes)).groupBy("block", "stripe")
    right = rows.withColumn("stripe", dealt(stripes)).withColumn("block", all_of(blocks)).groupBy("block", "stripe")
    return left.cogroup(right).applyInArrow(search, "anchor_id long, score long, id long")


def _mixed(anchor: int) -> int:
    return (anchor * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 33


def _streamed(keys: Iterator[tuple], most: int, low: int, high: int) -> Iterator[tuple]:
    """Rows of the result, from keys in order. State: the windows of the anchor at hand."""
    at, windows = None, []
    for (anchor, down, kind, id), _ in keys:
        if anchor != at:
            at, windows = anchor, []
        if kind == 0:
            windows.append([id, -down, 0])
            continue
        for window in windows:
            if window[2] < most and low * window[1] <= -100 * down <= high * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], id, window[1], -down


def mined(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, label: Column | None = None
) -> DataFrame:
    """One row for each anchor, positive and negative: anchor_id, positive_id, rank, negative_id and both scores.

    rows have vec_id, label and embedding; anchor says which are anchors; label may stand in for the label. An anchor's
    positives are its best `positives` other rows of the same label, its negatives for each of them the best `negatives`
    rows of another label from `low` to `high` percent of the positive's score, ends included. Ties go by vec_id.

    Rows with a null vec_id, label, vector or component take no part, nor do those with a component that is no finite
    number. Rows with one vec_id count as one, the least by label and vector. Vectors may differ in length: what one
    lacks counts 0. Other columns aren't read. No anchors, or none with a positive, give no rows.
    """
    taken = usable(rows.withColumn("label", F.col("label")), label)
    asked = usable(rows.filter(anchor), label).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("x"))
    asked = asked.select("vec_id", "x.*")
    counted = rows.select(F.count("*"), F.count_if(F.coalesce(anchor, F.lit(False)))).first()
    stripes, blocks = max(STRIPES, -(-counted[0] // STRIPE_ROWS)), max(1, -(-counted[1] // BLOCK_ANCHORS))

    near = _tiled(asked, taken, blocks, stripes, lambda a, r: _same_label(a, r, positives))
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    near = cut(near.withColumn("place", place).filter(F.col("place") <= positives).drop("place"))
    windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list("score"), asc=False).alias("positives"))
    far = _tiled(asked.join(windows, "vec_id"), taken, blocks, stripes, lambda a, r: _in_windows(a, r, negatives, low, high))

    spark = rows.sparkSession
    pairs = near.withColumn("kind", F.lit(0)).unionByName(far.withColumn("kind", F.lit(1)))
    keys = pairs.select("anchor_id", (-F.col("score")).alias("down"), "kind", "id").rdd.map(lambda r: (tuple(r), None))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys.getNumPartitions())
    ordered = keys.repartitionAndSortWithinPartitions(parts, lambda key: _mixed(key[0]))
    return spark.createDataFrame(ordered.mapPartitions(lambda k: _streamed(k, negatives, low, high)), RESULT, verifySchema=False)
