"""Operators 3, 4, 8 and 10 and the pipeline: held-out accuracy, the library's own results, brute force, planted cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tallyloom.llm import jaccard, language, leaks, maintext, pieces, rules

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- 3 ---


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark, docs):
    model = language.fit(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 ### \n"), (None, "the of and"), (5, "\U0001f600" * 5), (6, "é")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert got[None].lang_pred in model.languages and got[6].lang_pred in model.languages
    empty = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.identify(odd, empty).collect()} == {"und"}
    one = language.fit(docs.filter("lang = 'en'"))
    assert one.predict("hello there") == ("en", 1.0, False)


def test_symbols_beyond_the_first_plane_are_no_letters(spark, docs):
    rows = [(5, "\U0001f600" * 5), (6, "123 \U0001f600"), (7, "\U0010ffff"), (8, "\U00020000"), (9, "\U0001d41a")]
    model = language.fit(docs)
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all((got[i].lang_pred, got[i].score, got[i].ambiguous) == ("und", 0, True) for i in (5, 6, 7))
    assert all(got[i].lang_pred in model.languages for i in (8, 9))
    assert (language.grams("the \U0001f600 end") == language.grams("the . end")).all()


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9, 40):
        code = language.codebook(n)
        far = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
        assert code.shape[0] == n and min(far) >= (1 if n < 3 else 2 if n == 3 else 4)


def test_words_of_two_languages_are_flagged(spark):
    model = language.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert any(model.predict(t)[2] for t in ("de", "la", "x", "de la"))
    assert not model.predict("the thing that was of the house and with it")[2]


# --- 4 ---


def test_pieces_equal_the_library(spark, docs):
    rng = random.Random(1)
    odd = ["", None, " ", "\n\n", " a  b   c ", "▁x ▁", "<s> </s> <0x41>", "x" * 5000, "é" * 50, "中文 \U0001f600", "\0", "a" + " " * 300 + "the"]
    odd += ["".join(rng.choice(" abcdeth\nnio.,ABÉ中\t0123") for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)] + [(None, "a")], "doc_id long, text string"))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.read_model(MODEL)
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in pieces.encoded(rows, model).collect():
        assert r.ids == library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.decoded == library.decode(r.ids)
    for r in pieces.digests(rows, model).collect():
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        want = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want
    assert pieces.digests(rows.limit(0), model).count() == 0


def test_backtracking_equals_merging():
    encoder = pieces.Encoder(pieces.read_model(MODEL))
    rng = random.Random(2)
    for _ in range(2000):
        word = "▁" * rng.randrange(4) + "".join(rng.choice("abcdefinorst") for _ in range(rng.randrange(1, 25)))
        assert encoder.backtrack(word) == encoder.merge(word)


# --- 8 ---


PAGE = """<html><head><title>t</title></head><body><div id="cookie-notice"><p>We use cookies to make this long sentence appear.</p></div>
<header><h1>Site</h1></header><div class="sidebar"><ul><li>one<li>two</ul></div><div class="post"><h2>Title</h2><p>Long text of the article with
many words &amp; more&nbsp;things in it, and so on and so on.<p>Short.<p>Another long paragraph <span class="ad">buy now</span> of the article that goes on.</div>
<div id="comments"><p>Reader says: a very long comment that has many words too, indeed quite many.</p></div><form><p>Sign</p></form><footer>c</footer>"""


def test_main_text_of_pages(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    wanted = {}
    for r in pages.collect():
        blocks = re.split(r"</?p>|</?h1>", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        lines = (" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in blocks)
        wanted[r.page_id] = "\n".join(x for x in lines if x)
    got = maintext.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == wanted and all(r.n_chars == len(r.text) for r in got)


def test_main_text_of_odd_pages(spark):
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "plain"), (4, "u", "plain"), (5, "u", "<script>x"), (6, "u", "<p>a" * 3000), (7, "u", "<article><p>x</article><p>y")]
    got = maintext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert text[1].split("\n")[0] == "Title" and "Short." in text[1] and "buy" not in text[1] and "Reader" not in text[1] and "cookies" not in text[1]
    assert (text[2], text[3], text[4], text[5], text[7]) == ("", "", "plain", "", "x") and text[6] == "\n".join("a" * 3000)


LONG = "A sentence of the article that is long enough to be told from a menu. " * 6


def test_main_text_without_end_of_head():
    for start in ("<body>", "<div>", "<b>", "", "<body class='has-sidebar'><article>"):
        assert maintext.main_text(f"<html><head><title>t</title><meta charset=x>{start}{LONG}<p>End.") == f"{LONG.strip()}\nEnd."
    assert maintext.main_text(f"<head><title>t</title><noscript><p>no</p></noscript></head><p>{LONG}") == LONG.strip()


@pytest.mark.parametrize("wrap", (
    'div class="content has-sidebar"', 'article class="post comments-open"', 'div id="page" class="site header-fixed"',
    'article class="widget"', 'main id="search"', 'div class="widget"', 'form id="aspnetForm"', 'div class="right-sidebar"',
))
def test_main_text_in_marked_wrapper(wrap):
    page = f"<html><body><{wrap}><h1>Title</h1><p>{LONG}</p><div class='ad-slot-1'>Buy</div><p>Short.</p><p>{LONG}</p></{wrap.split()[0]}>"
    for mark in ('class="sidebar"', 'id="cookie-notice"', 'class="x site-header"', 'id="comments"', 'class="related-posts"', 'role="search"'):
        page += f"<div {mark}><p>Not of the article.</p></div>"
    assert maintext.main_text(page) == f"Title\n{LONG.strip()}\nShort.\n{LONG.strip()}"


@pytest.mark.parametrize(
    "page, wanted",
    [
        (f"<body><h1>Title</h1><div class=intro><p>Few words.</p></div><div class=body><p>{LONG * 5}</p><p>{LONG * 5}</p></div>", ["Title", "Few words.", LONG * 5, LONG * 5]),
        (f"<body><div><a>Home</a></div><div><a>News</a></div><div id=post><h1>Title</h1><div>By A. Writer</div><div class=text><p>{LONG}</p><p>{LONG}</p></div></div>", ["Title", "By A. Writer", LONG, LONG]),
        *(
            (f"<body><div><h2>Title</h2><p>Before.</p><{tag}>{LONG * 9}</{tag.split('>')[-1].strip('<')}><p>After.</p></div>", ["Title", "Before.", LONG * 9, "After."])
            for tag in ("pre", "ul><li", "table><tr><td", "blockquote", "blockquote><p")
        ),
        (f"<div><p>{LONG * 30}</p></div><div><p>{LONG * 2}</p></div><div><p>{LONG * 30}</p></div>", [LONG * 30, LONG * 2, LONG * 30]),
        (f"<div><a>Home</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div><h3>More</h3><ul><li><a>Another page</a></ul></div>", [LONG, LONG]),
    ],
)
def test_main_text_around_the_innermost_container(page, wanted):
    assert maintext.main_text(page).split("\n") == [w.strip() for w in wanted]


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("<p>Good text one that stays <span class='share'>Share</p><p>Next</p>", ["Good text one that stays", "Next"]),
        ("<p>Good text one that stays <span class='share'>Share<p>Next", ["Good text one that stays", "Next"]),
        ("<p>Good text one that stays <span class='share'>Share", ["Good text one that stays"]),
        ("<p>Before <span class='ad'>buy</span> after <b class='share'>Share", ["Before after"]),
        (f"<section>{LONG}<span class='share'><div>Share</section><p>{LONG}</p>", [LONG, LONG]),
        (f"<section>{LONG}<span class='share'><div>Share</div>", [LONG]),
        (f"<div><p>{LONG}</p><ul><li>One <span class='ad'>buy<li>Two</ul><p>{LONG}</p></div>", [LONG, "One", "Two", LONG]),
        ('<div class="post side-story"><p>long article</p></div>', ["long article"]),
    ],
)
def test_main_text_around_asides_left_open(page, wanted):
    assert maintext.main_text(page).split("\n") == [w.strip() for w in wanted]


def test_main_text_follows_the_ratios(spark, monkeypatch):
    """On pages without article or main, constants in place of the ratios change every result."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    plain = [re.sub("(</?)(article|nav|main)>", r"\1div>", p) for p in pages]
    real = [maintext.main_text(p) for p in plain]
    monkeypatch.setattr(maintext, "smoothed", lambda ratios: [1.0] * len(ratios))
    assert all(maintext.main_text(p) != r for p, r in zip(plain, real, strict=True)) and all(real)


@pytest.mark.parametrize("tag", ("div", "section"))
def test_main_text_without_article_tags(spark, tag):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert len(pages) > 20
    for html in pages:
        assert "<article>" in html
        plain = html.replace("<article>", f"<{tag}>").replace("</article>", f"</{tag}>").replace("<nav>", "<div>").replace("</nav>", "</div>")
        assert maintext.main_text(plain) == maintext.main_text(html)


def test_ratios_choose_among_articles():
    parts = f"<article><h2>One</h2><p>{LONG}</p></article><h2>Between</h2><article><p>Short.</p><p>{LONG * 2}</p></article>"
    wanted = f"One\n{LONG.strip()}\nBetween\nShort.\n{(LONG * 2).strip()}"
    teasers = "<article><h4><a>Other page</a></h4></article>" * 3
    assert maintext.main_text(f"<div><a>Home</a></div>{parts}<div><a>x</a></div>{teasers}") == wanted
    text = "".join(f"<p>{LONG * 2}</p>" for _ in range(4))
    code = f"<script>{'x = 1;' * 9999}</script>"
    outside = maintext.main_text(f"<div>{text}</div>{code}<div><a>a</a></div><div><a>b</a></div>{teasers}")
    assert outside == "\n".join([(LONG * 2).strip()] * 4)
    menu = "<div><a>Home</a></div><div><a>News</a></div><div><a>Mail</a></div>"
    both = maintext.main_text(f"{menu}<section><div><p>{LONG * 3}</p><p>{LONG * 3}</p></div><article><p>{LONG * 3}</p></article></section>{menu}")
    assert both == "\n".join([(LONG * 3).strip()] * 3)


# --- 10 ---


def edit_distance_within(pattern, text):
    """The table of all distances, a row a character of the pattern."""
    chars, places = np.array([*text]) if text else np.zeros(0, "U1"), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, int)
    for i, p in enumerate(pattern, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (chars != p))])
        row = np.minimum.accumulate(new - places) + places  # a step to the right costs one
    return int(row.min())


def test_bit_parallel_distance():
    rng = random.Random(3)
    for _ in range(300):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randrange(lo, 30))) for lo in (1, 0))
        assert leaks.nearest(p, leaks.masks(p), t)[0] == edit_distance_within(p, t)


def edited(text, n, rng):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        out[at : at + rng.randrange(2)] = rng.choice("xyz") * rng.randrange(2)
    return "".join(out)


@pytest.mark.parametrize("block", [16_000_000, 3000])
def test_planted_leaks(spark, docs, block):
    rng = random.Random(4)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: leaks.normal(r.text) for r in bench.collect()}
    texts = [r.text for r in docs.limit(40).collect()]
    planted = [(i, t[:80] + " " + edited(items[i % 40], rng.randrange(0, 30), rng).upper() + "\n" + t[80:]) for i, t in enumerate(texts)]
    rows = planted + [(100, None), (101, ""), (102, "x" * 5000), (None, items[0]), (103, items[1]), (103, items[1])]
    odd = spark.createDataFrame([(900, None), (901, ""), (902, "  ")], bench.schema)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in leaks.matches(frame, bench.union(odd), block_bytes=block).collect()), key=str)
    want = []
    for d, t in rows:
        for i, item in items.items():
            text = leaks.normal(t or "")
            if (least := edit_distance_within(item, text)) <= int(0.08 * len(item)):
                want.append((d, i, least))
    assert got == sorted(want, key=str) and 10 < len(want) < 60
    clean = leaks.decontaminated(frame.withColumn("item_id", frame.doc_id), bench, block_bytes=block)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in rows if str(d) not in {str(g[0]) for g in got})
    assert leaks.matches(frame, bench.limit(0)).count() == 0 and leaks.decontaminated(frame.limit(0), bench).count() == 0


def test_leaks_with_text_ids_in_a_long_text(spark):
    bench = spark.createDataFrame([("x-1", "a question that nobody has asked before today, or ever"), (None, "short item")], "item_id string, text string")
    long = "word " * 60_000 + "A question that nobody  has askd before today, or ever" + " word" * 60_000
    docs = spark.createDataFrame([("d", long, 1), ("e", None, 2), (None, "SHORT\nitem", 3)], "doc_id string, text string, item_id int")
    assert sorted(map(tuple, leaks.matches(docs, bench).collect()), key=str) == [("d", "x-1", 1), (None, None, 0)]
    assert [r.doc_id for r in leaks.decontaminated(docs, bench).collect()] == ["e"]


# --- pipeline ---


def test_pipeline_stages(spark, docs):
    names = docs.columns
    secret = " ".join(f"word{i}" for i in range(30)) + " token=abcdefgh12345"
    odd = spark.createDataFrame([(10**6, None, None, None, None), (None, "w " * 30, None, "s", 60), (10**6 + 1, secret, "en", "s", len(secret))], docs.schema)
    frame = docs.union(odd)
    for label, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert out.columns == names, label
        assert out.count() <= frame.count()
        frame = spark.createDataFrame(out.collect(), docs.schema)
    kept = {r.doc_id: r.text for r in frame.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert kept.pop(10**6 + 1) == secret.replace("token=abcdefgh12345", "[secret:assign]")
    good = {r.doc_id for r in rules.keep_good(docs).collect()}
    component = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs.filter(docs.doc_id.isin(sorted(good)))).collect()}
    leaked = {r.doc_id for r in leaks.matches(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert set(kept) == {d for d in good if component[d] == d and d not in leaked}
    assert sum(kept[d] == text[d] for d in kept) > 50
    last = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    assert {r.doc_id for r in last} == {*kept, 10**6 + 1} and all(r.decoded == kept[r.doc_id] for r in last if r.doc_id in kept)


def test_one_of_each_keeps_odd_rows(spark):
    rows = [(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (2, "other words are here now", "z"), (3, None, None), (4, "", None), (5, "same", "p"), (5, "same", "p"), (None, "a b c d e f", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    got = sorted((str(r.doc_id), str(r.text)) for r in jaccard.one_of_each(frame).collect())
    assert got == sorted([("1", "a b c d e f"), ("2", "other words are here now"), ("3", "None"), ("4", ""), ("5", "same"), ("None", "a b c d e f")])


def test_pipeline_runs_over_a_folder(spark, tmp_path):
    """run() over a small folder against what is planted in it, and over empty tables."""
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi") for b in ("n", "r", "st") for c in ("a", "e", "ing", "o")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item, clean = text(30), [text(60) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(10, clean[0].upper().title()), (11, clean[1] + " more"), (12, clean[2]), (13, "too short"), (14, None), (15, ""), (16, "# " * 90)]
    rows += [(20, f"{text(40)} {item} {text(5)}"), (21, f"{text(40)} password: hunter2hunter2 {text(5)}")]
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    for name, docs_, items in (("planted", frame, bench), ("empty", frame.limit(0), bench.limit(0))):
        docs_.write.parquet(str(tmp_path / name / "documents.parquet"))
        items.write.parquet(str(tmp_path / name / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path / "planted")).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4, 5, 21]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for d, r in got.items():
        want = dict(rows)[d].replace("password: hunter2hunter2", "[secret:assign]")
        assert r.decoded == want and list(r.ids) == library.encode(want, add_bos=True, add_eos=True) and r.n_tokens == len(r.ids)
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
