"""Quotation linking on small conversations and odd rows."""

import random
import re
from collections import Counter, defaultdict

from tallyloom.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, links string"
ROWS = [
    (1, 0, "a", "Where is the key? I looked everywhere.\nThe door is shut.", None),
    (1, 1, "b", "On Monday, A wrote:\n> Where is the\n> key? I looked everywhere.\n\nUnder the mat.", None),
    (1, 2, "c", "A new topic here.", None),
    (1, 3, "a", "B wrote:\n> > I looked everywhere.\n> Under the mat.\nFound it, thanks.", None),
    (1, 4, "d", ">The DOOR   is shut.\nThen open it.", None),
    (1, 5, "e", "> never said by anybody\nUnknown quote.", None),
    (1, 6, "c", ">>> Where is the key?\nDeep only.", None),
    (2, 0, "a", "Where is the key?", "x"),
    (2, 0, "a", "Where is the key?", "x"),
    (2, None, "a", "> Where is the key?\nno turn", None),
    (None, 1, "a", "> Where is the key?\nno conversation", None),
    (3, 0, None, None, None),
    (3, 1, "a", "", None),
]


def test_links_levels_and_threads(spark):
    rows = quotes.linked(spark.createDataFrame(ROWS, SCHEMA)).collect()
    got = {(r.conv_id, r.turn): r for r in rows}
    assert len(rows) == len(ROWS)
    one = lambda t: (got[1, t].parent_turn, got[1, t].thread, got[1, t].replies, got[1, t].n_levels, got[1, t].n_levels_linked, got[1, t].text)
    assert one(0)[:5] == (None, 0, 0, 0, 0)
    assert one(1) == (0, 0, 1, 1, 1, "Under the mat.")
    assert one(2)[:5] == (None, 2, 0, 0, 0)
    assert one(3) == (1, 0, 2, 2, 2, "Found it, thanks.")
    assert one(4) == (0, 0, 1, 1, 1, "Then open it.")
    assert one(5) == (None, 5, 0, 1, 0, "Unknown quote.")
    assert one(6) == (0, 0, 1, 1, 1, "Deep only.")
    assert got[2, None].parent_turn is None and got[None, 1].parent_turn is None
    order = [(r.thread, r.turn) for r in sorted(rows, key=lambda r: r.reply_order) if r.conv_id == 1]
    assert order == [(0, 0), (0, 1), (0, 3), (0, 4), (0, 6), (2, 2), (5, 5)]
    assert Counter(r.conv_id for r in rows)[2] == 3


def test_long_chain_and_common_first_turn(spark):
    chain = [(7, 0, "a", "Say number 0 now please.", None)]
    chain += [(7, i, "a", f"> Say number {i - 1} now please.\nSay number {i} now please.", None) for i in range(1, 40)]
    common = [(100 + c, t, "u", "Hello to everybody here." if t == 0 else "> Hello to everybody here.\nHi.", None) for c in range(30) for t in (0, 1)]
    rows = quotes.linked(spark.createDataFrame(chain + common, SCHEMA)).collect()
    assert all(r.parent_turn == r.turn - 1 and r.thread == 0 and r.replies == r.turn for r in rows if r.conv_id == 7 and r.turn)
    assert all(r.parent_turn == 0 for r in rows if r.conv_id >= 100 and r.turn == 1)


def test_table_without_quotes_keeps_its_messages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = {(r.conv_id, r.turn): r.text for r in quotes.linked(table).collect()}
    assert rows == {(r.conv_id, r.turn): r.text.strip(" \n\r\t") for r in table.collect()}
    assert quotes.linked(table.limit(0)).count() == 0


MARKS = re.compile(r"^((?:[ \t]*>)+) ?")
INTRODUCES = re.compile(r"\b(wrote|writes|said|schrieb|écrit|escribió)\b.{0,80}:\s*$", re.I)


def plain_passages(text):
    """[(depth, text)], line by line."""
    lines = []
    for x in (text or "").split("\n"):
        m = MARKS.match(x)
        lines.append([m[1].count(">") if m else 0, x[m.end() :] if m else x])
    for i, (depth, body) in enumerate(lines):
        if depth == 0 and i + 1 < len(lines) and lines[i + 1][0] > 0 and (INTRODUCES.search(body) or not body.strip(" ")):
            lines[i][0] = -1
    out = []
    for i, (depth, body) in enumerate(lines):
        if i and depth == lines[i - 1][0]:
            out[-1][1] += " " + body
        else:
            out.append([depth, body])
    out = [(d, re.sub(r"\s+", " ", t.lower()).strip(" ")) for d, t in out]
    return [(d, t) for d, t in out if d >= 0 and t]


def plain_links(rows):
    """Links and parents, by comparing every quoted sentence with all that was said."""
    first, links = {}, Counter()
    cut = lambda t: [s for s in re.split(r"(?<=[.!?])\s+", t) if s]
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    for conv, turn, _, text, _ in rows:
        for depth, passage in plain_passages(text):
            for s in cut(passage) if depth == 0 else ():
                first[conv, s] = min(first.get((conv, s), turn), turn)
    for conv, turn, _, text, _ in rows:
        for k, (depth, passage) in enumerate(plain_passages(text)):
            for s in cut(passage) if depth else ():
                origin = first.get((conv, s))
                links[conv, turn, k, depth, origin if origin is not None and origin < turn else None] += len(s)
    votes = defaultdict(Counter)
    for (conv, turn, _, depth, origin), n in links.items():
        if origin is not None:
            votes[conv, turn][depth, origin] += n
    parents = {m: max((-d, n, o) for (d, o), n in v.items())[2] for m, v in votes.items()}
    return links, parents


def compared(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    links, parents = plain_links(rows)
    got = quotes.links(quotes.parsed(df)).collect()
    assert Counter({(r.conv_id, r.turn, r.passage, r.depth, r.original): r.quoted for r in got}) == links
    out = quotes.linked(df).collect()
    assert {(r.conv_id, r.turn): r.parent_turn for r in out if r.parent_turn is not None} == parents
    for r in out:
        mine = {(d, o) for (c, t, _, d, o) in links if (c, t) == (r.conv_id, r.turn)}
        assert r.quoted_turns == sorted({o for _, o in mine if o is not None})
        assert (r.n_levels, r.n_levels_linked) == (len({d for d, _ in mine}), len({d for d, o in mine if o is not None}))
    return out


def test_links_equal_plain_python(spark):
    rng, rows = random.Random(4), []
    for conv in range(12):
        said: list[str] = []
        for turn in range(12):
            lines = []
            for _ in range(rng.randrange(1, 6)):
                depth = rng.choice([0, 0, 1, 1, 2, 3])
                old = rng.choice(said) if said and depth else f"Sentence {rng.randrange(40)} of {conv % 3} stands here."
                lines.append("> " * depth + (old if depth else rng.choice([old, "", "On Monday, X wrote:", "same words. Same words!"])))
            said += [x for x in lines if not x.startswith(">") and x]
            rows.append((conv, turn, "a", "\n".join(lines), None))
    compared(spark, rows)
    compared(spark, [r for r in ROWS if r[:2] != (2, 0)])


def test_a_level_may_quote_several_messages(spark):
    rows = [
        (1, 0, "a", "First question here?", None),
        (1, 1, "b", "Second question comes.", None),
        (1, 2, "c", "> First question here?\nYes.\n> Second question comes.\nNo.", None),  # the longer quote wins
        (1, 3, "d", "Abcd efgh.", None),
        (1, 4, "e", "Ijkl mnop.", None),
        (1, 5, "f", "> Abcd efgh.\nHm.\n> Ijkl mnop.\nEqual.", None),  # a tie goes to the later turn
        (1, 6, "g", "> Abcd efgh.\n" + "> Never said. \n" * 300 + "End.", None),
    ]
    out = {r.turn: r for r in compared(spark, rows)}
    assert out[2].quoted_turns == [0, 1] and out[2].parent_turn == 1
    assert out[5].quoted_turns == [3, 4] and out[5].parent_turn == 4
    assert (out[6].parent_turn, out[6].text) == (3, "End.")
