"""Language ID by error-correcting output codes.

Every language has a codeword; for each bit a binary classifier over character n-grams tells the languages whose bit
is 1 from those whose bit is 0. It is a log-likelihood ratio of hashed bigrams and trigrams, fitted on counts over all
labelled rows, in which every language weighs the same. Decoding adds up, for each language, the logistic losses of
the classifiers' margins against its codeword, weighted by how reliable each bit has proved for that language, and
takes the language with the least loss; a small lead over the next marks the text as ambiguous.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS_LOG2 = 13
DIMS = 1 << DIMS_LOG2
#: Added to every n-gram's count, for those that a language never showed.
PRIOR = 0.5
#: A lead below this share of the two least losses' sum is ambiguous.
AMBIGUOUS = 0.1
#: Labelled rows, about, that the bits' reliability is measured on.
CALIBRATION_ROWS = 2000


def _letter_table() -> np.ndarray:
    """True for the code points that are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


LETTERS = _letter_table()


def grams(text: str) -> np.ndarray | None:
    """Hashed bigrams and trigrams of the letters of the whole text in lower case, words parted by one space.

    None if there is no letter.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = LETTERS[codes]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a letter, or the first of what isn't after one
    codes = np.where(letter, codes, np.uint32(32))[keep]
    codes = np.concatenate([np.array([32], np.uint32), codes, np.array([32], np.uint32)])
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (two[:-1] >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + codes[2:] * np.uint32(0xC2B2AE35)
    mixed = np.concatenate([two, three])
    return ((mixed ^ (mixed >> np.uint32(16))) * np.uint32(0x45D9F3B)) >> np.uint32(32 - DIMS_LOG2)


def codebook(languages: int) -> np.ndarray:
    """Codewords of -1 and 1, one row a language: all ways to part up to six languages in two, else the draw of
    random columns with the largest least distance."""
    if languages < 2:
        return np.zeros((languages, 0), int)
    if languages <= 6:
        columns = [c for c in itertools.product((-1, 1), repeat=languages) if c[0] == 1 and -1 in c]
        return np.array(columns, int).reshape(len(columns), languages).T
    bits = 8 * math.ceil(math.log2(languages))
    best, far = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1, 1], (languages, bits))
        code = code[:, np.abs(code.sum(0)) < languages]
        near = (code.shape[1] - code @ code.T) // 2 + np.eye(languages, dtype=int) * bits
        if near.min() > far:
            best, far = code, near.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    #: One column of log-likelihood ratios a bit.
    weights: np.ndarray
    #: Reliability of each bit for each language; every row sums to the number of bits.
    trust: np.ndarray

    def margins(self, ids: np.ndarray) -> np.ndarray:
        summed = self.weights[ids].sum(0) if len(ids) < 2000 else np.bincount(ids, minlength=DIMS) @ self.weights
        return summed / math.sqrt(len(ids))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, is it ambiguous); und, 0 and True if there is no letter or no model."""
        ids = grams(text) if text and self.languages else None
        if ids is None:
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.logaddexp(0, -self.code * self.margins(ids))).sum(1)
        order = np.argsort(loss, kind="stable")
        first, second = loss[order[0]], loss[order[1]]
        score = 1 / np.exp(np.maximum(first - loss, -700)).sum()
        return self.languages[order[0]], float(score), bool(second - first < AMBIGUOUS * (first + second))


def held_out(doc_id: Column) -> Column:
    """The third of the documents that is never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each language's n-grams within the task: at most languages x DIMS rows."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            ids = grams(text.as_py() or "")
            if ids is not None:
                own = counts.setdefault(lang.as_py(), np.zeros(DIMS, np.int64))
                own += np.bincount(ids, minlength=DIMS)
    for lang, own in counts.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())],
            names=["lang", "gram", "n"],
        )


def fit(docs: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """A model from every document that isn't held out and has a lang.

    Counts cover all such rows; what comes to the driver is languages x DIMS numbers. Reliability comes from a sample
    of about calibration_rows of them, chosen by a hash of doc_id. Without a labelled row the model knows no language.
    """
    learn = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    counted = learn.select("lang", "text").mapInArrow(_count, "lang string, gram int, n long")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(rows.lang.unique()))
    code = codebook(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((DIMS, 0)), np.zeros((len(languages), 0)))
    counts = np.full((len(languages), DIMS), PRIOR)
    counts[np.searchsorted(languages, rows.lang), rows.gram] += rows.n
    share = counts / counts.sum(1, keepdims=True)
    side = lambda sign: np.array([share[code[:, b] == sign].mean(0) for b in range(code.shape[1])]).T
    model = Model(languages, code, np.log(side(1) / side(-1)), np.ones(code.shape))

    total = learn.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(1 << 20)) < min(1.0, calibration_rows / max(total, 1)) * (1 << 20)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                ids, name = grams(text.as_py() or ""), lang.as_py()
                if ids is not None:
                    good = np.sign(model.margins(ids)) == code[languages.index(name)]
                    right[name] = right.get(name, 0) + good
                    seen[name] = seen.get(name, 0) + 1
        for name, n in seen.items():
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(right[name]), "bit": [*range(len(right[name]))], "good": right[name].astype(np.int64), "n": [n] * len(right[name])})

    found = learn.filter(part).select("lang", "text").mapInArrow(check, "lang string, bit long, good long, n long")
    trust = np.full(code.shape, 0.5)
    for r in found.groupBy("lang", "bit").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).collect():
        trust[languages.index(r.lang), r.bit] = (r.good + 1) / (r.n + 2)
    return Model(languages, code, model.weights, trust / trust.sum(1, keepdims=True) * code.shape[1])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every document; only text decides. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            lang, score, unsure = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
