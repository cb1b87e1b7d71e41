"""Byte-level BPE: ranked merges folded over words by Spark's higher-order functions.

A text is cut into words by the tokenizer's pattern. Words are counted over all documents; those that occur most often
are encoded once each, and that table, of bounded size, goes to every task. A word that isn't in it is encoded in its
row, by the same fold. So no token is ever shuffled, only each task's distinct words are.

The fold starts from a word's bytes, each shown as the character of its token, and the ranks of all neighbouring pairs
from a constant map (an array of small maps by hash, as Spark looks maps up from end to end; a scalar subquery holds it,
as the driver keeps every plan's text, literals included). A rank is shown as the
character of the token that the pair merges to, so tokens and ranks are texts of one character a part, which are cheap
to cut and whose order is that of the ranks. A step merges the leftmost pair of the least rank. In a word of more than
LONG parts it merges all pairs of that rank at once, unless a pair made on the way would rank lower still: this is what
single steps come to, as nothing can come between them.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, let

#: Words that are encoded once and sent to all tasks, at most, and bytes of one: some 40 MB in practice.
FREQUENT, WIDEST = 1_000_000, 64
#: Small maps of the literal, and parts of a word above which a step merges all pairs of the least rank.
BUCKETS, LONG = 32_768, 64
#: Distinct words whose counts a task holds before it passes them on, and texts of a batch that are cut at a time: their
#: pieces stand in memory several times.
HELD, PART = 262_144, 2048
#: The rank of what can't be merged, and of a pair that overlaps one that is merged.
NONE, OVERLAPS = "\U0010ffff", "\U0010fffe"
#: Letters and digits of the regex library that are younger than Unicode 16, which the ranks' library knows.
YOUNG_LETTERS = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 \uab6c-\uab6d "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb "
    "\U00011df1 \U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U000187f8-\U000187ff \U00018cd6-\U00018cda "
    "\U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 "
    "\U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de "
    "\U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff "
    "\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
)
YOUNG_DIGITS = "\U00011de0-\U00011de9 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ff4-\U00016ff6"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are their ids, of a file with a base64 token and a rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# --- the fold ----------------------------------------------------------------------------------------------------

def character(id: int) -> str:
    """The character that shows a token."""
    return chr(id + 1 if id + 1 < 0xD800 else id + 0x801)


def _constant(spark: SparkSession, text: str, kind: str) -> Column:
    """JSON as a scalar subquery over one row: tasks get it as they get a literal, but no plan's text holds it."""
    return spark.createDataFrame(pa.table({"text": [text]})).select(F.from_json("text", kind)).scalar()


PAIRS = "array<map<string,string>>"


def _pairs(ranks: dict[bytes, int]) -> str:
    """The ranks of all pairs of tokens, as JSON."""
    buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            if token[:i] in ranks and token[i:] in ranks:
                pair = character(ranks[token[:i]]) + character(ranks[token[i:]])
                hashed = xxhash.xxh64_intdigest(pair.encode(), 42)
                buckets[(hashed - (hashed >> 63 << 64)) % BUCKETS][pair] = character(rank)
    return json.dumps(buckets)


def _folded(start: Column, table: Column) -> Column:
    """What the merges make of a word of at least one part, a character for each part."""

    def rank(pair: Column) -> Column:
        return F.coalesce(F.try_element_at(F.get(table, F.pmod(F.xxhash64(pair), F.lit(BUCKETS))), pair), F.lit(NONE))

    def state(parts: Column, ranks: Column) -> Column:
        """ranks has one for each part, with the part after it."""
        return let(ranks, lambda r: F.struct(parts.alias("parts"), r.alias("ranks"), F.array_min(F.split(r, "")).alias("least")))

    cut = lambda text, at, n: F.substr(text, at, n)

    def one(acc: Column) -> Column:
        """The leftmost pair of the least rank merged; only its neighbours' ranks are looked up."""
        parts, ranks, m = acc["parts"], acc["ranks"], acc["least"]

        def at(i: Column) -> Column:  # counted from 1
            before = F.when(i > 1, rank(F.concat(cut(parts, i - 1, F.lit(1)), m))).otherwise("")
            after = rank(F.concat(m, cut(parts, i + 2, F.lit(1))))
            return state(
                F.concat(F.left(parts, i - 1), m, F.substr(parts, i + 2)),
                F.concat(F.left(ranks, i - 2), before, after, F.substr(ranks, i + 2)),
            )

        return let(F.position(m, ranks), at)

    def every(acc: Column) -> Column:
        """All pairs of the least rank merged, from the left, none overlapping the one before."""
        m = acc["least"]
        found = F.replace(acc["ranks"], F.concat(m, m), F.concat(m, F.lit(OVERLAPS)))
        lists = F.struct(F.split(acc["parts"], "").alias("p"), F.split(acc["ranks"], "").alias("r"), F.split(found, "").alias("t"))

        def put(x: Column) -> Column:
            taken = lambda i: F.coalesce(F.get(x["t"], i) == m, F.lit(False))
            merged = F.transform(x["p"], lambda p, i: F.when(taken(i), m).otherwise(p))
            spots = F.filter(F.sequence(F.lit(0), F.size(x["p"]) - 1), lambda i: (i == 0) | ~taken(i - 1))

            def ranked(p: Column, s: Column) -> Column:
                def of(i: Column, k: Column) -> Column:
                    after = F.get(s, k + 1)
                    pair = F.concat(F.get(p, i), F.coalesce(F.get(p, after), F.lit("")))
                    return F.when(taken(i) | taken(after), rank(pair)).otherwise(F.get(x["r"], after - 1))

                last = F.coalesce(F.get(s, F.size(s) - 1), F.lit(0))
                ranks = F.transform(s, lambda i, k: F.when(i == last, F.lit(NONE)).otherwise(of(i, k)))
                return state(F.array_join(F.transform(s, lambda i: F.get(p, i)), ""), F.array_join(ranks, ""))

            # Between two neighbouring merges the first makes a pair with what the second has not merged yet.
            passing = lambda i: taken(i) & taken(i + 2) & (rank(F.concat(m, F.get(x["p"], i + 2))) < m)
            lower = F.exists(spots, passing)
            return F.when(~lower, let(F.struct(merged.alias("p"), spots.alias("s")), lambda y: ranked(y["p"], y["s"])))

        return let(let(lists, put), lambda x: F.when(x.isNull() | (x["least"] < m), one(acc)).otherwise(x))

    def step(acc: Column, _: Column) -> Column:
        more = F.when(F.length(acc["parts"]) > LONG, every(acc)).otherwise(one(acc))
        return F.when(acc["least"] == NONE, acc).otherwise(more)

    pairs = F.transform(F.sequence(F.lit(1), F.length(start)), lambda i: rank(cut(start, i, F.lit(2))))
    steps = F.sequence(F.lit(1), F.greatest(F.length(start) - 1, F.lit(1)))
    return F.aggregate(steps, state(start, F.array_join(pairs, "")), step, lambda acc: acc["parts"])


class Merges:
    """The merges of a rank file as expressions, made once for a query.

    A token that its own bytes' merges don't come to stands only for a word that it is as a whole, as the library has
    it; these are found by folding all tokens.
    """

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        pairs, all_bytes = _pairs(ranks), [bytes([i]) for i in range(256)]
        self.literal, self.pairs = F.from_json(F.lit(pairs), PAIRS), _constant(spark, pairs, PAIRS)
        self.bytes = "".join(b.decode("latin-1") for b in all_bytes), "".join(character(ranks[b]) for b in all_bytes)
        self.whole: dict[str, int] = {}
        tokens = spark.createDataFrame([(t.decode("latin-1"), r) for t, r in ranks.items()], "token string, rank int").repartition(8)
        ids = let(F.col("pairs"), lambda pairs: self._one(F.col("token"), pairs))
        odd = self.given(tokens).filter(~F.equal_null(ids, F.array("rank"))).select("token", "rank")
        self.whole = {r.token: r.rank for r in odd.collect()}

    def given(self, rows: DataFrame) -> DataFrame:
        """rows with `pairs` for ids. It must be used once and not be kept: the optimizer then puts the constant in its
        place, as subqueries can't be written within higher-order functions."""
        return rows.withColumn("pairs", self.pairs)

    def _one(self, shown: Column, pairs: Column) -> Column:
        """Ids of a word whose bytes are shown as characters."""
        code = lambda c: F.ascii(c) - F.when(F.ascii(c) >= 0xE000, 0x801).otherwise(1)
        merged = let(F.translate(shown, *self.bytes), lambda s: _folded(s, pairs))
        found = F.when(shown == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(merged, ""), code))
        if not self.whole:
            return found
        whole = F.try_element_at(F.from_json(F.lit(json.dumps(self.whole)), "map<string,int>"), shown)
        return let(whole, lambda w: F.when(w.isNotNull(), F.array(w)).otherwise(found))

    def ids(self, words: Column, pairs: Column | None = None) -> Column:
        """Ids of each word of an array of texts: array<array<int>>. pairs is a literal unless the rows have it."""
        shown = lambda w: F.decode(w.cast("binary"), "ISO-8859-1")
        return let(self.literal if pairs is None else pairs, lambda pairs: F.transform(words, lambda w: let(shown(w), lambda s: self._one(s, pairs))))


# --- words -------------------------------------------------------------------------------------------------------


_patterns: dict[str, regex.Pattern] = {}


def compiled(pattern: str) -> regex.Pattern:
    """The pattern with the letters and digits that the ranks' library knows."""
    if pattern not in _patterns:
        classes = {r"\p{L}": YOUNG_LETTERS, r"\p{N}": YOUNG_DIGITS}
        own = regex.sub(r"\\p\{[LN]\}", lambda m: f"[{m[0]}--[{classes[m[0]].replace(' ', '')}]]", pattern)
        _patterns[pattern] = regex.compile(own, regex.V1)
    return _patterns[pattern]


MARKS = frozenset(".,;:!?")


def _pieces_words(pieces: Iterable[str], find: Callable[[str], list[str]], words: dict[str, int]) -> tuple[list[int], list[int]]:
    """(words in each piece, their numbers) of pieces that a space stands before; words gets what is new.

    A run of letters is one word with the space, and a mark after it another, so most pieces need no matching.
    """
    sizes, flat, number = [], [], words.setdefault
    for piece in pieces:
        if piece.isalpha():
            flat.append(number(" " + piece, len(words)))
            sizes.append(1)
        elif piece[-1:] in MARKS and piece[:-1].isalpha():
            flat += number(" " + piece[:-1], len(words)), number(piece[-1], len(words))
            sizes.append(2)
        else:
            found = find(" " + piece)
            flat += [number(w, len(words)) for w in found]
            sizes.append(len(found))
    return sizes, flat


def numbered(texts: pa.Array, pattern: str):
    """(number of each piece of all texts, number of pieces in each text, number of words in each piece, their numbers
    one piece after another, words by number).

    The pattern must begin a match at every space that stands before something other than white space, as those of
    byte-level tokenizers do: texts are cut at spaces, and each piece is matched once. A text with a space before white
    space or at its end is one piece. Null is empty; every text has a piece at least.
    """
    import numpy as np
    import pyarrow.compute as pc

    find, words = compiled(pattern).findall, {}
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, " ")
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(counts) - counts
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().copy()
    # Pieces hold no space, so they come as one text and are parted here.
    pieces = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_py().split(" ") if len(codes) else []
    del lists, coded
    odd = np.array([not p or p[0].isspace() for p in pieces], bool)[codes]
    odd[starts] = False
    whole = np.add.reduceat(odd, starts, dtype=np.int32) > 0 if len(starts) else np.zeros(0, bool)
    # A text's first piece has no space before it; it, or the whole text, gets a number of its own.
    first, own = np.empty(len(starts), np.int32), {}
    for i, code in enumerate(codes[starts].tolist()):
        first[i] = len(pieces) + own.setdefault(texts[i].as_py() if whole[i] else pieces[code], len(own))
    codes[starts] = first
    if whole.any():
        kept = ~np.repeat(whole, counts)
        kept[starts] = True
        codes, counts = codes[kept], np.where(whole, 1, counts)
    used = np.zeros(len(pieces) + len(own), bool)
    used[codes] = True
    sizes = np.zeros(len(used), np.int32)
    spaced = np.flatnonzero(used[: len(pieces)])
    sizes[spaced], flat = _pieces_words(map(pieces.__getitem__, spaced.tolist()), find, words)
    for i, text in enumerate(own, len(pieces)):
        found = find(text)
        sizes[i] = len(found)
        flat += [words.setdefault(w, len(words)) for w in found]
    return codes, counts, sizes, np.array(flat, np.int32), list(words)


def _runs(counts, most: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `most` pieces."""
    import numpy as np

    ends, at = np.cumsum(counts, dtype=np.int64), 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


def _spread(codes, sizes, flat):
    """The items of each code in turn; flat holds those of code 0, then of code 1, and so on."""
    import numpy as np

    starts = np.cumsum(sizes) - sizes
    n = sizes[codes]
    ends = np.cumsum(n)
    return flat[np.arange(int(n.sum())) + np.repeat(starts[codes] - (ends - n), n)]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of PART texts; what Arrow keeps of the last part goes back to the system first."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            pa.default_memory_pool().release_unused()
            yield batch.slice(at, PART)


def word_counts(docs: DataFrame, pattern: str) -> DataFrame:
    """(word, n): how often each word occurs in all texts. A task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: dict[str, int] = {}
        out = lambda: pa.RecordBatch.from_pydict({"word": pa.array(held, pa.string()), "n": pa.array(held.values(), pa.int64())})
        for batch in _parts(batches):
            codes, _, sizes, flat, words = numbered(batch.column("text"), pattern)
            times = np.repeat(np.bincount(codes, minlength=len(sizes)), sizes)
            for w, n in zip(words, np.bincount(flat, times, len(words)).astype(np.int64).tolist(), strict=True):
                held[w] = held.get(w, 0) + n
            if len(held) > HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The words that occur most often, `most` of them at most; words that occur equally often are in or out together,
    and so are counts within a twelfth of a doubling. Very wide words stay out."""
    bin = F.floor(F.log2("n") * 12)
    short = counts.filter(F.octet_length("word") <= WIDEST)
    sizes = sorted(short.groupBy(bin.alias("bin")).count().collect(), reverse=True)  # 12 for each doubling of a count
    least, total = None, 0
    for b, size in sizes:
        total += size
        if total > most:
            break
        least = b
    return short.filter(F.lit(False) if least is None else bin >= least).select("word")


# --- texts -------------------------------------------------------------------------------------------------------


def _located(docs: DataFrame, pattern: str, known: pa.Table, pieces: list[bytes] | None = None) -> DataFrame:
    """doc_id, ids of known words (-1 - k stands for the row's k-th other word) and those other words.

    With the tokens' bytes by id, what _parted makes of ids stands in their place.
    """
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, known.schema) as writer:
        writer.write_table(known.combine_chunks())
    shared = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def located(part, codes, counts, sizes, flat, own, place, lengths, values) -> Iterator[pa.RecordBatch]:
        import numpy as np

        # A word that isn't known has one item, made of its number.
        items = np.where(place < 0, 1, lengths[place]) if len(lengths) else np.ones(len(own), np.int32)
        ids = np.empty(int(items.sum()), np.int32)
        new = np.zeros(len(ids), bool)
        new[(np.cumsum(items) - items)[place < 0]] = True
        ids[new] = -1 - np.flatnonzero(place < 0)
        ids[~new] = _spread(place[place >= 0], lengths, values)
        # Of each piece its ids.
        piece_ids, piece_ends = _spread(flat, items, ids), np.concatenate([[0], np.cumsum(items[flat])])
        ends = piece_ends[np.concatenate([[0], np.cumsum(sizes)])]
        piece_sizes = np.diff(ends)
        at = 0
        for a, b in _runs(counts):
            some = codes[at : at + int(counts[a:b].sum())]
            at += len(some)
            row_ids = _spread(some, piece_sizes, piece_ids)
            offsets = np.concatenate([[0], np.cumsum(piece_sizes[some])])[np.concatenate([[0], np.cumsum(counts[a:b])])]
            # Of each row its other words, each once, in order of their numbers.
            at_other = np.flatnonzero(row_ids < 0)
            rows_of = np.searchsorted(offsets, at_other, "right") - 1
            pairs, place_of = np.unique(rows_of * len(own) - 1 - row_ids[at_other], return_inverse=True)
            firsts = np.searchsorted(pairs, np.arange(b - a + 1) * len(own))
            row_ids[at_other] = firsts[rows_of] - 1 - place_of
            missed = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array([own[k] for k in (pairs % max(1, len(own))).tolist()], pa.string()))
            lists_ = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(row_ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").slice(a, b - a), lists_, missed], names=["doc_id", "ids", "missed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        table = pa.ipc.open_stream(shared.value).read_all()
        words, lists = table["word"].combine_chunks(), table["ids"].combine_chunks()
        shown = None if pieces is None else pa.array(pieces, pa.binary())
        lengths, values = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
        for batch in batches:
            parts = [(part, *numbered(part.column("text"), pattern)) for part in _parts([batch])]
            # All parts' words are looked up at once, as Arrow hashes the known ones anew each time.
            found = pc.index_in(pa.array([w for *_, own in parts for w in own], words.type), value_set=words)
            places = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
            while parts:
                part, codes, counts, sizes, flat, own = parts.pop(0)
                place, places = places[: len(own)], places[len(own) :]
                for rows in located(part, codes, counts, sizes, flat, own, place, lengths, values):
                    yield rows if shown is None else _parted(rows, shown)

    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = "ids array<int>" if pieces is None else "numbers array<binary>, pieces array<binary>, others array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {ids}, missed array<string>")


def _parted(rows: pa.RecordBatch, pieces: pa.Array) -> pa.RecordBatch:
    """_located's rows with three columns for ids: the ids before, between and after a row's other words, as little-endian
    32-bit integers; the bytes that these decode to; and which other word stands at each cut. A row with k cuts has k + 1
    of the first two."""
    import numpy as np
    import pyarrow.compute as pc

    lists = rows.column("ids")
    offsets, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
    cuts = np.flatnonzero(ids < 0)
    known = ids[ids >= 0].astype("<i4")
    shown = pieces.take(pa.array(known))  # the bytes of all tokens stand in it without a gap
    # A part begins with a row and after each cut; the parts follow one another in what is known.
    begins = np.concatenate([offsets[:-1], cuts])
    begins = (begins - np.searchsorted(cuts, begins))[np.argsort(begins, kind="stable")]
    ends = np.append(begins, len(known)).astype(np.int64)
    at_bytes = np.append(0, np.cumsum(pc.binary_length(shown).to_numpy(), dtype=np.int64))[ends]
    before = np.searchsorted(cuts, offsets)
    firsts = pa.array(before + np.arange(len(before)), pa.int32())

    def listed(at, data: pa.Buffer) -> pa.ListArray:
        return pa.ListArray.from_arrays(firsts, pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), data]))

    others = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(-1 - ids[cuts], pa.int32()))
    columns = [rows.column("doc_id"), listed(ends * 4, pa.py_buffer(known)), listed(at_bytes, shown.buffers()[2] or pa.py_buffer(b"")), others, rows.column("missed")]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "numbers", "pieces", "others", "missed"])


def _folded_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int, pieces: list[bytes] | None = None) -> DataFrame:
    """What _located has, with the ids of each of the row's other words for the word."""
    merges, counts = Merges(docs.sparkSession, ranks), cut(word_counts(docs, pattern))
    table = merges.given(frequent_words(counts, most)).select("word", F.get(merges.ids(F.array("word"), F.col("pairs")), 0).alias("ids")).toArrow()
    texts = _located(docs, pattern, table, pieces)
    return merges.given(texts).select(*texts.columns[:-1], merges.ids(F.col("missed"), F.col("pairs")).alias("missed"))


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = FREQUENT) -> DataFrame:
    """doc_id and the text's ids.

    Each match of pattern is encoded by itself. Null text counts as empty, which has no ids; repeated rows and null
    doc_ids stay; other columns aren't read. ranks must hold every single byte. most bounds the words that are encoded
    beforehand, and changes no result.
    """
    whole = F.flatten(F.transform("ids", lambda i: F.when(i >= 0, F.array(i)).otherwise(F.get("missed", -1 - i))))
    return _folded_texts(docs, ranks, pattern, most).select("doc_id", F.when(F.size("missed") == 0, F.col("ids")).otherwise(whole).alias("ids"))


def _listed(names: list[str]) -> Column:
    return F.split(F.lit(",".join(names)), ",")


def _shown(ids: Column, listed: Column) -> Column:
    """The names of ids one after another."""
    return F.array_join(F.transform(ids, lambda i: F.get(listed, i)), "")


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens' bytes by id."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, id in ranks.items():
        pieces[id] = token
    return pieces


def decoded(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The tokens' bytes one after another, as binary."""
    return F.unhex(_shown(ids, _listed([p.hex() for p in _pieces(ranks)])))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, most: int = FREQUENT) -> DataFrame:
    """doc_id, the number of ids, and digests of ids (as little-endian unsigned 32-bit integers) and of the bytes that
    they decode to. Rows as in encoded.

    Known words' ids and bytes come from the Arrow batches as they are; only other words' are put together here.
    """
    pieces = _pieces(ranks)
    names = {"numbers": [id.to_bytes(4, "little").hex() for id in range(len(pieces))], "pieces": [p.hex() for p in pieces]}
    rows = _folded_texts(docs, ranks, pattern, most, pieces)
    rows = rows.withColumns({f"names_of_{k}": _constant(docs.sparkSession, json.dumps(v), "array<string>") for k, v in names.items()})

    def whole(k: str) -> Column:
        def put(other: Column) -> Column:
            part = lambda p, i: F.concat(F.hex(p), F.coalesce(F.get(other, F.get("others", i)), F.lit("")))
            return F.unhex(F.array_join(F.transform(k, part), ""))

        others = let(F.col(f"names_of_{k}"), lambda listed: F.transform("missed", lambda m: _shown(m, listed)))
        return F.when(F.size("missed") == 0, F.get(k, 0)).otherwise(let(others, put))

    texts = rows.select("doc_id", *(whole(k).alias(k) for k in names))
    n = F.expr("octet_length(numbers) div 4").cast("long")
    return texts.select("doc_id", n.alias("n_tokens"), F.sha2("numbers", 256).alias("ids_sha256"), F.sha2("pieces", 256).alias("decoded_sha256"))
