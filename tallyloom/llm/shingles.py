"""Words and word shingles of texts as 64-bit hashes, for the operators that compare texts by them.

Words are runs of anything but space and the control characters 9 to 13, with A-Z in lower case. All steps are numpy
over a text's bytes. A word's bytes are taken eight at a time, and every step mixes all bits before the next eight come
in, so no pattern of letters cancels out; words beyond LONG bytes are hashed by BLAKE2. Sequences of words are put
together from shorter ones in the same way. Equal words and sequences have equal hashes; different ones share a hash
with a chance of about 2 to the -64, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes as they are compared: capitals as their small letters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Bytes of a word up to which it is mixed eight by eight.
LONG = 64
#: Keeps the first bytes of eight, by their number.
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bytes, and windows, hashed at a time, so that a text of any length needs little memory besides itself.
_STEP = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all of them (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _then(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of what a and then b are the hashes of."""
    return mix(mix(a + _GOLDEN) ^ b)


def _hash_words(raw: np.ndarray) -> np.ndarray:
    space = _SPACES[raw]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    low = np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)])
    eights = np.ndarray(len(raw) + 1, "<u8", low, strides=(1,))
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64))
    at, left, open_ = starts, sizes, np.arange(len(starts))
    while len(at):
        out[open_] = _then(out[open_], eights[at] & _KEEP[np.minimum(left, 8)])
        more = (left > 8) & (sizes[open_] <= LONG)
        at, left, open_ = at[more] + 8, left[more] - 8, open_[more]
    for i in np.flatnonzero(sizes > LONG).tolist():
        word = low[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return out


def _hash_long(raw: np.ndarray) -> np.ndarray:
    """_hash_words in parts of about _STEP bytes that end between words."""
    out, at = [], 0
    while at < len(raw):
        to = min(len(raw), at + _STEP)
        while to < len(raw) and not _SPACES[raw[to]]:
            gap = np.flatnonzero(_SPACES[raw[to : to + _STEP]])
            to = to + int(gap[0]) if len(gap) else min(len(raw), to + _STEP)
        out.append(_hash_words(raw[at:to]))
        at = to
    return np.concatenate(out)


def _groups(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words' hashes of some texts in a row, where each text's begin and, last, the end). Many short texts are hashed
    at once, which costs about as much as one."""
    held: list[bytes] = []
    size = 0

    def made() -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"\n".join(held), np.uint8)
        begins = np.cumsum([0] + [len(x) + 1 for x in held])
        space = _SPACES[raw]
        first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])[: len(raw)])
        return _hash_words(raw), np.searchsorted(first, begins)

    for text in texts:
        raw = (text or "").encode("utf-8", "replace")
        if held and (size + len(raw) > _STEP or len(raw) > _STEP):
            yield made()
            held, size = [], 0
        if len(raw) > _STEP:
            words = _hash_long(np.frombuffer(raw, np.uint8))
            yield words, np.array([0, len(words)])
        else:
            held.append(raw)
            size += len(raw) + 1
    if held:
        yield made()


def words_of(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The hashes of each text's words; none of a null text."""
    for words, at in _groups(texts):
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield words[lo:hi]


def word_hashes(text: str | None) -> np.ndarray:
    return next(words_of([text]))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` words in a row, by position; none if there are fewer words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    if n > _STEP:
        return np.concatenate([windows(words[at : at + _STEP + size - 1], size) for at in range(0, n, _STEP)])
    # Windows of 1, 2, 4 ... words, and those whose sizes add up to `size` put together.
    out, have, width = None, 0, 1
    while True:
        if size & width:
            out, have = (words[:n] if out is None else _then(out, words[have : have + n])), have + width
        if have == size:
            return mix(out + np.uint64(size))
        words, width = _then(words[: len(words) - width], words[width:]), 2 * width


def shingle_sets(texts: Iterable[str | None], size: int = 5) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles; one of the whole sequence if it has fewer words, none
    without words."""
    for words, at in _groups(texts):
        whole = windows(words, size)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo < size:
                yield windows(words[lo:hi], hi - lo) if hi > lo else words[:0]
                continue
            found = np.sort(whole[lo : hi - size + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    return next(shingle_sets([text], size))
