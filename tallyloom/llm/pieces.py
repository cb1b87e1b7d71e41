"""SentencePiece encoding and decoding: exact merge-type (BPE) encoding by backtracking.

Merging symbol pairs by score until none is left has one result for a text, and a sequence of pieces is that result
exactly when every two neighbours are compatible: merging their joined text again gives the same two pieces. So the
encoder walks the text, takes the longest piece that an Aho-Corasick automaton finds at the position, keeps it if it
is compatible with the piece before, and otherwise tries the next shorter one. A position from which nothing fits is
marked in a bitfield and never tried again: the pieces up to a position are the only encoding of the text so far, so
what fails there once always fails.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: SentencePiece's stand-in for a space.
GAP = "▁"
NORMAL, USER_DEFINED = 1, 4


class Encoder:
    """One model's pieces, ready to encode. Runs inside tasks, once for each Python worker."""

    def __init__(self, model: bytes, cached_words: int = 100_000, cached_pairs: int = 200_000):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        norm, train = spec.normalizer_spec, spec.trainer_spec
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
        if train.model_type != proto.TrainerSpec.BPE or not (plain and norm.escape_whitespaces and train.byte_fallback):
            raise ValueError("needs a BPE model with identity normalisation, a dummy prefix and byte fallback")
        if any(p.type == USER_DEFINED for p in spec.pieces):
            raise ValueError("user-defined pieces aren't supported")
        self.library = SentencePieceProcessor(model_proto=model)
        self.score = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        word = lambda i: i.to_bytes(4, "little")
        self.code = {p.piece: word(i) for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.byte = [word(self.library.piece_to_id(f"<0x{b:02X}>")) for b in range(256)]
        self.begin, self.end = word(self.library.bos_id()), word(self.library.eos_id())
        self.automaton = ahocorasick.Automaton()
        whole = {p for p in self.code if self.merge(p) == [p]}  # others never come out of merging
        for piece in whole:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        #: Of a piece, the longest piece that begins it.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in whole), None) for p in whole}
        if any(GAP in p.lstrip(GAP) for p in self.code):
            raise ValueError("pieces with a space inside aren't supported")
        # No piece reaches over a space or a character that occurs in no longer piece, so what lies between is encoded alone.
        joined = {c for p in self.code if len(p) > 1 for c in p}
        self.alone = "".join(c for c in "\n\t\r" if c not in joined)
        self.words = re.compile(f"{GAP}+[^{GAP}{self.alone}]*|[^{GAP}{self.alone}]+" + (f"|[{self.alone}]" if self.alone else ""))
        self.compatible: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        #: Ids of words, those met lately and those before: when the first is full it takes the other's place.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cached_words, self.cached_pairs = cached_words, cached_pairs

    def merge(self, text: str) -> list[str]:
        """Pieces by merging: the pair with the best score first, the leftmost of equals."""
        score, symbols = self.score, list(text)
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (s := score.get(pair := symbols[a] + symbols[b])) is not None:
                heapq.heappush(queue, (-s, a, b, pair))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while queue:
            _, a, b, pair = heapq.heappop(queue)
            if symbols[a] and symbols[b] and after[a] == b and symbols[a] + symbols[b] == pair:
                symbols[a], symbols[b], after[a] = pair, "", after[b]
                if after[b] >= 0:
                    before[after[b]] = a
                offer(before[a], a)
                offer(a, after[a])
        return [s for s in symbols if s]

    def _fit(self, left: str, right: str) -> bool:
        if self.pairs >= self.cached_pairs:
            self.compatible.clear()
            self.pairs = 0
        self.pairs += 1
        known = self.merge(left + right) == [left, right]
        self.compatible.setdefault(left, {})[right] = known
        return known

    def backtrack(self, text: str) -> list[str]:
        """Pieces of text by longest matches and backtracking."""
        compatible, shorter, size, nothing = self.compatible, self.shorter, len(text), {}
        longest: list[str | None] = [None] * size
        for last, piece in self.automaton.iter(text):
            longest[last - len(piece) + 1] = piece  # a longer one ends later
        failed = bytearray(size // 8 + 1)
        at, out, left = 0, [], ""
        piece = longest[0] or text[:1]
        while at < size:
            while piece:
                to = at + len(piece)
                if not failed[to >> 3] >> (to & 7) & 1:
                    fits = compatible.get(left, nothing).get(piece)
                    if fits or fits is None and (not left or self._fit(left, piece)):
                        break
                piece = shorter.get(piece)
            if piece:
                out.append(piece)
                left, at = piece, to
                if at < size:
                    piece = longest[at] or text[at]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not out:
                    raise ValueError("the pieces can't be chained")
                last = out.pop()
                left, at, piece = out[-1] if out else "", at - len(last), shorter.get(last)
        return out

    def _ids(self, word: str) -> bytes:
        code = self.code
        return b"".join([code[p] if p in code else b"".join(self.byte[b] for b in p.encode()) for p in self.backtrack(word)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, begin and end included."""
        cache, out = self.cache, [self.begin]
        for word in self.words.findall(GAP + text.replace(" ", GAP)) if text else ():
            ids = cache.get(word)
            if ids is None:
                ids = self.older.get(word) or self._ids(word)
                if len(word) < 32:
                    if len(cache) >= self.cached_words:
                        self.older, self.cache = cache, {}
                        cache = self.cache
                    cache[word] = ids
            out.append(ids)
        out.append(self.end)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_encoders: dict[bytes, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


def read_model(path: str) -> bytes:
    """The model's bytes, read by the driver. Half a megabyte; each task gets them with its code."""
    with open(path, "rb") as f:
        return f.read()


def _mapped(docs: DataFrame, model: bytes, schema: str, finish: Callable[[bytes, str], tuple]) -> DataFrame:
    """docs' doc_id and text, text encoded and decoded; finish makes the columns after doc_id from ids and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder = _encoder(model)
        for batch in batches:
            # A few rows at a time: ids and decoded texts of a whole batch need several times its memory.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for text in part.column("text"):
                    ids = encoder.encode(text.as_py() or "")
                    rows.append(finish(ids, encoder.decode(np.frombuffer(ids, "<u4").tolist())))
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out_schema[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=[f.name for f in out_schema])

    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    columns = [c.split(" ") for c in schema.split(", ")]
    id_type = docs.schema["doc_id"].dataType
    out_schema = [pa.field("doc_id", pa.int64()), *[pa.field(n, kinds[k]) for n, k in columns]]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type.simpleString()}, {schema}")


def encoded(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids and the text decoded from them. Null text counts as empty, whose ids are begin and end.

    Narrow: one row in, one row out, whatever the length; repeated rows and null doc_ids stay.
    """
    import numpy as np

    return _mapped(docs, model, "ids array<int>, decoded string", lambda ids, text: (np.frombuffer(ids, "<i4"), text))


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, number of ids, and digests of ids and decoded text.

    Null text counts as empty, whose ids are begin and end; repeated rows and null doc_ids stay; other columns aren't
    read. Narrow, and a worker holds the encoder and bounded caches (some 70 MB) besides the rows at hand.
    """
    sha = lambda b: hashlib.sha256(b).hexdigest()
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, model, schema, lambda ids, text: (len(ids) // 4, sha(ids), sha(text.encode("utf-8", "surrogatepass"))))
