"""Held-out accuracy, exact base scores, recall and extraction; and the defined results of awkward rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import context_mixing, html_text, multi_index, quality, toxicity
from llm_rows import prose, rows_of


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    r = random.Random(1)
    rows, labels = [], []
    for k in range(500):
        t, toxic, good = prose(k, r.randint(20, 120)), k % 5 == 0, k % 3 != 0
        if toxic:
            w = t.split(" ")
            for x in r.sample(["zorgul", "idiot", "blenkat", "pathetic"], 2):
                w.insert(r.randrange(len(w)), x)
            t = " ".join(w)
        if not good:
            t = " ".join(x + r.choice(["###", "&&&", "%%%"]) for x in t.split(" "))
        rows.append((k, t, "zz", "clash"))
        labels.append((k, int(good), int(toxic)))
    rows += [(1000, None, None, None), (1001, "", None, None), (None, "idiot text", None, None), rows[0]]
    labels += [(1, None, None), (9999, 1, 1), (None, 1, 1), (2, 1, 0)]
    top = tmp_path_factory.mktemp("labelled")
    spark.createDataFrame(rows, "doc_id long, text string, y string, score string").write.parquet(f"{top}/d")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/l")
    return spark.read.parquet(f"{top}/d"), spark.read.parquet(f"{top}/l")


@pytest.mark.parametrize("score,label,folds,held", [(toxicity.score_toxicity, "toxic", 4, 2), (quality.score_quality, "quality", 5, 0)])
def test_held_out_accuracy(spark, labelled, score, label, folds, held):
    docs, labels = labelled
    got = score(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3).astype(int)).all()
    known = got[got.doc_id.notna()]
    assert (known.held_out == known.doc_id.map(lambda i: zlib.crc32(str(int(i)).encode()) % folds == held)).all()
    truth = labels.filter(f"doc_id < 500 and {label} is not null").dropDuplicates(["doc_id"]).toPandas().set_index("doc_id")[label]
    out = known[known.held_out & known.doc_id.isin(truth.index)]
    assert (out.predicted == out.doc_id.map(truth)).mean() > 0.95
    # no labels, no documents
    none = score(docs, labels.limit(0))
    assert none.filter("score < 0 or score > 1 or score is null").count() == 0
    assert score(docs.limit(0), labels).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows_of(quality.score_quality(docs, labels), "doc_id", "score") == rows_of(quality.score_quality(docs, flipped), "doc_id", "score")


def test_isotonic_pools_violators():
    level = quality.isotonic(np.array([4., 0, 4, 4]), np.array([2., 0, 0, 4]))
    assert (np.diff(level) >= 0).all() and level[0] == level[2] < level[3]


def test_label_model_separates_a_good_from_a_bad_voter():
    r = np.random.RandomState(0)
    y = r.rand(4000) < 0.3
    good = [np.where(r.rand(4000) < 0.9, y, ~y).astype(int) for _ in range(3)]
    votes = np.stack([*good, good[0], r.randint(0, 2, 4000)], 1)  # the fourth copies the first
    table, which, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    known = np.zeros((len(table), 2))
    post = toxicity.label_model(table, count.astype(float), known)
    assert ((post[which] > 0.5) == y).mean() > 0.9


def test_voters_read_the_whole_text():
    voters = toxicity.Voters([["blenk*"], []])
    at = {name: k for k, name in enumerate(voters.names)}
    vote = lambda text, name: voters(text)[0][at[name]]
    calm, loud = "some calm words " * 150, "VERY LOUD WÖRDS " * 600
    assert vote(calm + loud, "shouting") == 1 and vote(loud[:2400] + calm * 8, "shouting") == -1
    assert vote("An harmless word: idiot. " + calm + "You idiot", "addressed") == 1
    assert vote("idiotism, idiot here; you are an\n idiot", "addressed") == 1
    assert vote("the blenkat, and they are blenkats too", "addressed") == 1
    assert vote("an idiotism, idiot", "addressed") == -1 and vote("you he idiot", "addressed") == 1
    for text in ("", "Ünï ÇODE 日本 \U0001d400 x\u0301 123", loud, "\ud800A"):
        assert toxicity.case_counts(text) == (sum(map(str.isalpha, text)), sum(map(str.isupper, text)))


def test_base_score_is_exact(spark, docs, docs_rows, empty_docs, monkeypatch):
    monkeypatch.setattr(context_mixing, "FREQUENT", 50)  # the others are joined
    got = context_mixing.score_texts(docs).collect()
    tokens = lambda t: [w.lower() for w in (t or "").encode().split()] + [None]
    count = Counter()
    for d, t, *_ in docs_rows:
        if d is None or zlib.crc32(str(d).encode()) % 10:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    want = sorted(((d, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 4)) for d, t, *_ in docs_rows), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == want
    assert all(r.score < 0 for r in got)
    assert context_mixing.score_texts(empty_docs).count() == 0


def test_code_and_bits_are_a_probability():
    """All first symbols of a word sum to one: the product over bits is a proper distribution."""
    code = context_mixing.Code(np.arange(256) % 7 + 1)
    assert abs((0.5 ** code.length).sum() - 1) < 1e-12
    tables = [np.random.RandomState(k).randn(2, 1 << b).astype(np.float32) for k, b in enumerate(context_mixing.TABLE_BITS)]
    weights = np.full((context_mixing.GATES, 2 * context_mixing.CONTEXTS), 0.2, dtype=np.float32)
    maps = np.random.RandomState(5).rand(context_mixing.GATES, context_mixing.MAP_CELLS)
    model = context_mixing.Model(code, tables, weights, maps)
    one = model.log10([b"a" + bytes([b]) for b in range(256)])
    first = model.log10([b"a"])[0]
    assert abs((10 ** (one - first)).sum() - 1) < 1e-4


def naive_score(model: context_mixing.Model, text) -> float:
    """The text's tokens one by one, each after the word before it."""
    tokens = (text or "").encode().lower().split()
    total = 0.0
    for k, w in enumerate([*(t + b" " for t in tokens), b"\n"]):
        total += model.log10([w], [tokens[k - 1]] if k else None)[0]
    return total


def small_model() -> context_mixing.Model:
    code, r = context_mixing.Code(np.arange(256) % 7 + 1), np.random.RandomState(3)
    tables = [r.randn(2, 1 << b).astype(np.float32) for b in context_mixing.TABLE_BITS]
    weights = r.rand(context_mixing.GATES, 2 * context_mixing.CONTEXTS).astype(np.float32) / 5
    return context_mixing.Model(code, tables, weights, r.rand(context_mixing.GATES, context_mixing.MAP_CELLS))


TEXTS = ["One two three two three.", "", None, "a", " a b a b a b ", "ab abc abcd abcde\tabcdef", "\x00 \x00\x00 é 日本 x\x0by",
         "two three one", "three two one", "x" * 300 + " y"]


def test_tokens_coded_once_score_as_the_whole_text():
    model = small_model()
    words = context_mixing.Words(TEXTS)
    got = np.bincount(words.owner, weights=model.of_words(words), minlength=len(TEXTS))
    assert np.allclose(got, [naive_score(model, t) for t in TEXTS], atol=1e-3)
    assert np.bincount(words.owner, weights=words.coded_bytes()).tolist() == [
        sum(len(w) + 1 for w in (t or "").encode().split()) + 1 for t in TEXTS]


def test_contexts_cross_words():
    """The order of words counts, and what follows a word is a distribution of its own."""
    model = small_model()
    assert abs(naive_score(model, "two three one") - naive_score(model, "three two one")) > 1e-3
    first = {b: model.log10([bytes([k]) for k in range(256)], [b] * 256) for b in (b"one", b"two", b"bone")}
    assert all(abs((10 ** p).sum() - 1) < 1e-4 for p in first.values())
    assert np.abs(first[b"one"] - first[b"two"]).max() > 1e-3 and np.abs(first[b"one"] - first[b"bone"]).max() > 1e-3


def test_a_known_sequence_beats_its_shuffled_words(spark, tmp_path):
    phrase = prose(9, 60).split()
    shuffled = random.Random(1).sample(phrase, len(phrase))
    held = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 10 == 0][:2]
    rows = [(k, " ".join(phrase if k % 2 else [prose(k, 30)])) for k in range(200) if k not in held]
    rows += [(held[0], " ".join(phrase)), (held[1], " ".join(shuffled))]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r for r in context_mixing.score_texts(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got[held[0]].held_out and got[held[1]].held_out
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score, abs=1e-6)
    assert got[held[0]].score > got[held[1]].score + 1


def test_share_weight_is_fitted():
    coded_part, share = np.array([0.5, 0.5, 0.5, 0.001]), np.array([0.01, 0.02, 0.0, 0.3])
    got = context_mixing.fitted_weight(coded_part, share, 0.99, 200)
    tried = np.linspace(0, 1, 1001)[1:-1]
    best = tried[np.argmax(np.log(tried[:, None] * share + (1 - tried[:, None]) * coded_part).sum(1))]
    assert got == pytest.approx(best, abs=0.002)


def test_every_training_document_teaches_the_tables(spark, tmp_path):
    """A word that only documents of the weights' fold hold is in the final tables."""
    apart = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 100 % 10 == context_mixing.MIX_FOLD
             and zlib.crc32(str(k).encode()) % 10][:20]
    rows = [(k, "qzxjv " * 5) for k in apart]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    _, letters = context_mixing.count_tables(docs)
    none = spark.sparkContext.broadcast((np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)))
    model, _ = context_mixing.train_model(docs.limit(0), docs, letters, none, 0.0)
    known = context_mixing.predictors(context_mixing.coded(next(context_mixing.Words(["qzxjv"]).units())[0], model.code)[3], model.tables)[1]
    assert known.min() == context_mixing.CONTEXTS


def test_nearest(spark, tmp_path):
    r = np.random.RandomState(0)
    x = r.normal(size=(600, 8)).round(3)
    rows = [(k, [float(v) for v in x[k]]) for k in range(600)]
    rows += [(600 + k, rows[0][1]) for k in range(150)]  # a hot vector
    rows += [(800, None), (820, [0.0] * 8), (840, [float("nan")] * 8), (860, [None] + [1.0] * 7), (880, []), (900, [1.0]),
             (20, rows[20][1]), (None, rows[5][1])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "e"))
    table = spark.read.parquet(str(tmp_path / "e"))
    got = multi_index.nearest(table, F.col("vec_id") % 20 == 0).toPandas()
    ids = np.array([k for k, v in rows[:750]] + [20])
    vec = np.float32(np.array([v for _, v in rows[:750]] + [rows[20][1]])).astype(float)
    assert set(got.query_id) == {int(i) for i in ids if i % 20 == 0}
    hit = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = (vec * vec[at]).sum(1)
        score[at] = -np.inf
        want = {int(i) for i in ids[np.lexsort((ids, -score))[:20]]}
        mine = got[got.query_id == ids[at]].sort_values("rank")
        assert (mine.score.diff().dropna() <= 0).all()
        hit += len(want & set(mine.vec_id))
        total += len(want)
    assert hit >= 0.9 * total
    # among the hot vector's copies the smallest ids come first
    top = got[got.query_id == 600].sort_values("rank").vec_id.tolist()
    assert top == [0, *range(601, 620)]
    few = multi_index.nearest(table.filter("vec_id < 4"), F.col("vec_id") == 0).count()
    assert few == 3 and multi_index.nearest(table.limit(0), F.col("vec_id") == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div class="ad">Buy now, this advert is quite long and tempting, isn't it?</div><div class="cookie-notice">We use cookies.</div>
%s<aside class=sidebar><p>Related things to read elsewhere</p></aside><form><label>Name</label><button>Go</button></form>
<section id="comments"><article class="comment"><p>First! A reader comment of some length that should not be here.</p></article></section>
<footer>&copy; Someone</footer></body></html>"""
STORY = ("<h1>A  title &amp; more</h1><p><b>First &lt;paragraph&gt;\n with   spaces<br>and a break<p>Short.</p>"
         "<p>A long paragraph of the article, with <a href=x>a link</a> in it, and <i>marks</i>&hellip; going on.</p>"
         "<ul><li>one item</li><li>two</ul><div><p>Last words of the story, told at some length.</p></div>")
TEXT = ("A title & more\nFirst <paragraph> with spaces and a break\nShort.\nA long paragraph of the article, with a link in it, "
        "and marks… going on.\none item\ntwo\nLast words of the story, told at some length.")


@pytest.mark.parametrize("frame", ["<article>%s</article>", "<main>%s</main>", "<div id=story>%s</div>"])
def test_main_text(frame):
    assert html_text.main_text(PAGE % (frame % STORY)) == TEXT


LONG = "A paragraph of the story that is told at great length, with many words and no tags at all in between. " * 3


@pytest.mark.parametrize("block", ["blockquote", "section", "table", "div"])
def test_paragraphs_around_a_large_block_stay(block):
    cell = ("<tr><td>%s</td></tr>" if block == "table" else "%s") % (LONG * 5).strip()
    page = f"<body><nav>Menu</nav><div><p>First. {LONG}</p><{block}>{cell}</{block}><p>Last. {LONG}</p></div></body>"
    want = [f"First. {LONG}".strip(), (LONG * 5).strip(), f"Last. {LONG}".strip()]
    assert html_text.main_text(page).split("\n") == want


def test_every_article_stays():
    page = f"<body><article><p>One. {LONG * 3}</p></article><p>Between.</p><article><p>Two. {LONG}</p></article></body>"
    assert html_text.main_text(page).split("\n") == [f"One. {LONG * 3}".strip(), f"Two. {LONG}".strip()]


@pytest.mark.parametrize("name", ["content with-sidebar", "no-sidebar", "widget", "search results"])
def test_a_name_does_not_bar_the_whole_page(name):
    page = f"<body><nav>Menu</nav><div class='{name}'><h1>Title</h1><p>{LONG}</p><p>Short.</p></div></body>"
    assert html_text.main_text(page).split("\n") == ["Title", LONG.strip(), "Short."]
    page = f"<body><div><div class='article-header'><h1>Title</h1></div><p>{LONG}</p></div><div class='widget'>{LONG}</div></body>"
    assert html_text.main_text(page).split("\n") == ["Title", LONG.strip()]
    page = f"<body><article><p>{LONG}</p></article><div class=comments><p>{LONG * 4}</p></div></body>"
    assert html_text.main_text(page) == LONG.strip()


def test_text_beside_main_stays():
    prose = "Prose of the story that stands beside the main element for some reason of the page's author. " * 3
    page = f"<body><nav>Menu</nav><main><p>{LONG}</p></main><div><p>{prose}</p></div><footer>End</footer></body>"
    assert html_text.main_text(page).split("\n") == [LONG.strip(), prose.strip()]
    page = f"<body><main><p>{LONG}</p></main><p>Short.</p><nav>Menu</nav></body>"
    assert html_text.main_text(page) == LONG.strip()


@pytest.mark.parametrize("odd", ["<![foo[ x ]]>", "<![", "<![[", "<![if IE]>", "<![CDATA[ d ]]>", "<!>", "<!doctype", "<?x", "</>", "</ p>", "<", "&#xFFFFFFFF;",
                                 "<a b='", "<!--", "<script>", "\x00"])
def test_no_page_raises(odd):
    assert html_text.main_text(f"<p>{LONG}</p>{odd}").startswith(LONG.strip()[:200])
    html_text.main_text(f"{odd}<p>{LONG}</p>")
    html_text.main_text(odd * 50)


def test_deep_pages_take_time_in_proportion():
    import time

    def took(page):
        start = time.process_time()
        html_text.main_text(page)
        return time.process_time() - start

    for make in (lambda d: "<div>" * d + "</span>" * d + "text", lambda d: "<li><div>" + "<b>" * d + "<li></li>" * d,
                 lambda d: "<article><header>" + "<i>" * d + "<h1>x</h1>" * d, lambda d: "<p>" * d + "</div>" * d):
        took(make(100))
        assert took(make(40_000)) < 30 * took(make(4_000)) + 0.5


def brute_page(r: random.Random) -> tuple[str, str]:
    """A small page made of known parts, and the text of those that belong to the article."""
    def sentence(n):
        return " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(n))

    body, want = [], []
    for _ in range(r.randint(2, 6)):
        kind, text = r.choice(["p", "p", "p", "h2", "blockquote", "li", "nested"]), sentence(r.randint(25, 60))
        if kind == "h2":
            text = sentence(4)
        want.append(text)
        at = r.randrange(1, len(text.split()))
        first, last = " ".join(text.split()[:at]), " ".join(text.split()[at:])
        inner = r.choice([f"{first} <b>{last}</b>", f"{first}\n  {last}", f"<a href='x'>{first}</a> {last}", f"{first}<br>{last}"])
        body.append({"li": f"<ul><li>{inner}</li></ul>", "nested": f"<div><div><p>{inner}</p></div></div>"}.get(kind, f"<{kind}>{inner}</{kind}>"))
    if all(len(w.split()) < 10 for w in want):
        want.append(sentence(50))
        body.append(f"<p>{want[-1]}</p>")
    chrome = [f"<nav><a href=1>{sentence(2)}</a></nav>", f"<header>{sentence(3)}</header>", f"<footer>{sentence(5)}</footer>",
              f"<aside><p>{sentence(9)}</p></aside>", f"<div class='advert'>{sentence(6)}</div>", f"<form><label>{sentence(2)}</label></form>",
              f"<script>{sentence(30)}</script>", f"<div id='comments'><p>{sentence(12)}</p></div>", f"<!-- {sentence(40)} -->"]
    r.shuffle(chrome)
    frame = r.choice(["<article>%s</article>", "<main>%s</main>", "<div>%s</div>"]) % "".join(body)
    cut = r.randint(0, len(chrome))
    return "<html><head><title>T</title></head><body>" + "".join(chrome[:cut]) + frame + "".join(chrome[cut:]) + "</body></html>", "\n".join(want)


def test_small_pages_of_known_parts():
    r = random.Random(8)
    for k in range(300):
        page, want = brute_page(r)
        assert html_text.main_text(page) == want, k


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE % f"<article>{STORY}</article>", "x"), (2, None, None, "x"), (3, "u", "", "x"),
                                   (4, "u", "just text", "x"), (5, "u", "<nav>menu</nav>", "x"), (None, "u", "<p>a" * 3000, "x")],
                                  "page_id long, url string, html string, text string")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in html_text.extract(pages).collect()}
    assert got[1] == ("u", TEXT, len(TEXT)) and got[2] == (None, "", 0) and got[3][1] == "" and got[5][1] == ""
    assert got[4][1] == "just text" and got[None][1].count("\n") == 2999
    assert html_text.extract(pages.limit(0)).count() == 0
