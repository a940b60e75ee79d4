"""Operators that treat each document by itself: toxicity, quality rules, pages, tokens, packing."""

import html
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tertulia.llm import html_text, packing, quality_rules, registered, token_counts, toxicity
from tertulia.llm.encoding import encoder
from tests.llm import brute


def library_ids(bpe, text):
    return encoder(bpe).library.encode(text or "", add_special_tokens=False).ids


def test_both_encoders_agree_on_every_code_point(bpe):
    own = encoder(bpe)
    assert own.twin is not None
    for low in range(0, 0x110000, 4096):
        texts = [f"a{c}1{c}  {c}!{c}\n{c}a" for c in map(chr, range(low, low + 4096)) if not 0xD800 <= ord(c) < 0xE000]
        for text, found in zip(texts, own.library.encode_batch(texts, add_special_tokens=False)):
            assert found.ids == own.ids(text).tolist()


def test_token_counts(spark, sf, rows, bpe):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in registered.op5_token_counts(spark, sf).collect()}
    for doc, text in rows:
        n = len(library_ids(bpe, text))
        assert found[doc] == (len(text.encode()), n, n > 512)


@pytest.mark.parametrize("chunk,overlap", [(64, 20), (256, 40), (1000, 499)])
def test_spliced_counts_of_hard_texts(spark, bpe, chunk, overlap):
    texts = ["a" * 3000, " " * 2000 + "x", "<|endoftext|> " * 200, "x<|endoftext|>" * 200, "é😀 " * 200, "it's  \n\n 12 ab" * 90, None, ""]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    found = sorted((r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, bpe, chunk=chunk, overlap=overlap).collect())
    assert found == sorted((len((t or "").encode()), len(library_ids(bpe, t))) for t in texts)


def test_packing_holds_every_id_once(spark, sf, rows, bpe):
    found = registered.op7_packing(spark, sf).toPandas()
    filled = found.groupby("sequence_id").length.sum()
    assert filled.max() <= 1024 and 1 - filled.sum() / (1024 * len(filled)) < 0.02
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
    for doc, text in rows:
        ids = np.array([*library_ids(bpe, text), 0], "<u4")
        own = found[found.doc_id == doc].sort_values("start")
        assert own.length.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        for piece in own.itertuples():
            assert piece.ids_crc32 == zlib.crc32(ids[piece.start : piece.start + piece.length].tobytes())


def test_first_fit_takes_the_first_sequence_with_room():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 200):
        lengths = rng.integers(1, 100, n)
        bins, offsets = packing.first_fit_decreasing(lengths, 100)
        room, want = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            b = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            want[i] = (b, 100 - room[b])
            room[b] -= lengths[i]
        assert [want[i] for i in range(n)] == list(zip(bins.tolist(), offsets.tolist()))


def test_packing_of_odd_rows(spark, odd, bpe, tmp_path):
    packing.cut_pieces(odd, bpe).write.parquet(str(tmp_path / "p"))
    pieces = spark.read.parquet(str(tmp_path / "p"))
    assert packing.pack(pieces).count() == pieces.count() >= odd.count()
    assert packing.pack(pieces.limit(0)).count() == 0


def test_pages(spark, sf):
    found = {r.page_id: (r.text, r.n_chars) for r in registered.op4_html_text(spark, sf).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", "\n", inner))
        text = " ".join(html.unescape(inner).split())
        assert found[page.page_id] == (text, len(text))


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<!-- no end <p>x", ""),
        ("<script>'</p>'", ""),
        ("only text &amp; more", "only text & more"),
        ("<body><article><p>x<b>y</b>z</p></article>", "xyz"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<main><p>yes yes yes</p><div class=ad>buy</div><p>more</p></main><div id='comments'><p>what a long comment it is</p></div>", "yes yes yes more"),
        ("<p hidden>no</p><p>yes", "yes"),
        ("<div>" * 5000 + "deep", "deep"),
    ],
)
def test_page_forms(page, text):
    assert html_text.main_text(page) == text


LONG = "Here is a sentence of the article. " * 6


@pytest.mark.parametrize("wrapper", ["div style='overflow:hidden'", "div data-hidden=false", "div title='hidden gems'", "div data-class=ad data-id=menu"])
def test_pages_attributes_are_whole_names(wrapper):
    page = f"<body><nav><a>home</a></nav><{wrapper}><p>{LONG}</p></div></body>"
    assert html_text.main_text(page) == LONG.strip()


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div id=page-with-menu", "div class='post share-enabled'", "form action=x", "div hidden"])
@pytest.mark.parametrize("inside", ["article", "div"])
def test_pages_with_marked_wrappers(wrapper, inside):
    tag = wrapper.split()[0]
    page = f"<{wrapper}><div class=menu-bar>menu</div><{inside}><p>{LONG}</p><p>{LONG}</p></{inside}></{tag}>"
    assert html_text.main_text(f"<body>{page}<div class=site-footer>some words at the end</div></body>") == (LONG * 2).strip()


def _paragraphs(n, length):
    return " ".join(f"<p>{'word ' * (length // 5)}</p>" for _ in range(n))


@pytest.mark.parametrize("outer", ["article", "main", "div", "main><article"])
@pytest.mark.parametrize("heading", ["<h1>A heading of some thirty letters</h1>", "", "<p>A short plain paragraph</p>"])
def test_pages_with_sections(outer, heading):
    links = "<ul>" + "<li><a href=x>some other page</a></li>" * 9 + "</ul>"
    sections = f"<section><h2>A</h2>{_paragraphs(10, 200)}</section><section>{_paragraphs(2, 150)}</section><div><p>end</p></div>"
    found = html_text.main_text(f"<body><nav>{links}</nav>{links}<{outer}>{heading}{sections}</{outer.split('>')[0]}>{links}</body>")
    want = " ".join([re.sub("<.*?>", "", heading), "A", *["word"] * (10 * 40 + 2 * 30), "end"])
    assert found == want.strip()


def test_pages_with_outer_headings_and_more_articles():
    article = f"<article>{_paragraphs(3, 200)}</article>"
    want = " ".join(["word"] * 120)
    assert html_text.main_text(f"<body><div><h1>Outer</h1>{article}</div><div>beside</div></body>") == f"Outer {want}"
    short = "<article><h2>Short</h2><p>short post</p></article>"
    assert html_text.main_text(f"<main>{article}{short}</main>") == f"{want} Short short post"
    assert html_text.main_text(f"<body><div>{article}{short}{short}</div></body>") == f"{want} Short short post Short short post"


def test_pages_drop_comments_that_are_articles():
    page = f"<article><p>{LONG}</p></article><div id=comments><article><p>{LONG * 3}</p></article></div><div hidden><p>{LONG * 9}</p></div>"
    assert html_text.main_text(page) == LONG.strip()
    shared = "<div class='post share-on'><article><p>one</p></article></div>"
    assert html_text.main_text(shared * 3) == "one one one"
    assert html_text.main_text("<div class=post-widget>" + LONG + "</div>" + "<div class=text-widget>" + LONG + "</div>") == (LONG * 2).strip()


def test_pages_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", "old", 9), (1, None, None, None)], "page_id long, html string, text string, n_chars int")
    assert sorted(map(tuple, html_text.extract_text(pages).collect())) == [(1, "", 0), (1, "a", 1)]
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_quality_statistics(spark, sf, rows):
    found = registered.op3_quality_rules(spark, sf).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r.doc_id: tuple(r[n] for n in names) for r in found} == {doc: brute.quality(text) for doc, text in rows}
    assert not any(r.kept and r.base_failed for r in found)


def test_quality_cutoffs_keep_good_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rated = quality_rules.assess(docs, labels).filter("not base_failed").join(labels, "doc_id")

    kept = {r.quality: r.share for r in rated.groupBy("quality").agg(F.avg(rated.kept.cast("int")).alias("share")).collect()}
    assert kept[1] > 0.95 and kept[0] < 0.5


def test_quality_risk_holds_for_all_rules_together(spark):
    # each rule alone rejects 1.5 % of the good documents, other ones than the other rules, and 20 % of the bad ones
    plain = dict(n_words=100, word_chars=500, n_symbols=0, n_dup_lines=0, n_lines=10, n_repeat_words=0)
    marks = [dict(n_symbols=60), dict(n_dup_lines=5), dict(n_repeat_words=16), dict(word_chars=1100), dict(word_chars=220)]
    kinds = [plain | marks[i % 1000 // 15] if i % 1000 < 75 else plain for i in range(12_000)] + [plain | marks[i % 5] for i in range(3_000)]
    names = ["id", "stratum", *plain]
    stats = spark.createDataFrame([(i, "en", *kind.values()) for i, kind in enumerate(kinds)], names)
    labels = spark.createDataFrame([(i, int(i < 12_000)) for i in range(15_000)], "doc_id long, quality int")
    chosen = quality_rules.cutoffs(stats, labels).first().asDict()
    fails = [F.coalesce(F.expr(ratio) > F.lit(chosen[rule]), F.lit(False)) for rule, (ratio, _) in quality_rules.RULES.items()]
    lost = stats.filter(F.array_contains(F.array(*fails), True)).groupBy((F.col("id") < 12_000).alias("good")).count()
    lost = {r.good: r["count"] for r in lost.collect()}
    assert lost[True] <= 0.02 * 12_000 and lost[False] >= 600


def test_upper_bound_is_exact():
    for k, n in ((0, 50), (3, 200), (10, 1000)):
        p = quality_rules.upper_bound(k, n, 0.01)
        import math

        below = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert below == pytest.approx(0.01, rel=1e-6)
    assert quality_rules.upper_bound(5, 5, 0.01) == quality_rules.upper_bound(0, 0, 0.01) == 1.0


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality_rules.assess(odd, labels).count() == odd.count()
    assert quality_rules.assess(odd.limit(0), labels.limit(0)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = registered._held_out()
    texts, toxic = toxicity.sample(docs, labels.filter(~out), "doc_id", "text", "toxic", toxicity.Settings(toxic=400, clean=1200))
    scored = toxicity.score(docs.join(labels.filter(out), "doc_id"), toxicity.fit(texts, toxic)).select("toxic", "score").toPandas()
    ranks = scored.score.rank()
    n1, n0 = (scored.toxic == 1).sum(), (scored.toxic == 0).sum()
    assert (ranks[scored.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.9
    assert (scored.score[scored.toxic == 0] >= 0.5).mean() < 0.05


def test_misspelt_words_share_features():
    texts = [f"one two three {w} four five six seven {i}" for i in range(40) for w in ("horrible", "pleasant")]
    model = toxicity.fit(texts, [1, 0] * 40)
    assert model.score("one two horribble three") > 0.5 > model.score("one two pleasannt three")


def test_toxicity_is_learnt_in_a_task(spark, monkeypatch):
    """The model of the sample, without the sample's texts on the driver; none at all gives the model without texts."""
    rows = [(i, f"you are {'awful trash' if i % 3 == 0 else 'kind and calm'} number {i} of many {i * 7}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(120)], "doc_id long, toxic boolean")
    want = toxicity.fit(*toxicity.sample(docs, labels.filter(~registered._held_out()), "doc_id", "text", "toxic", toxicity.Settings()))
    monkeypatch.setattr(toxicity, "sample", lambda *a: pytest.fail("texts on the driver"))
    got = registered.toxicity_model(docs, labels)
    assert got.table == pytest.approx(want.table) and got.bias == pytest.approx(want.bias)
    assert got.score("awful trash") > 0.5 > got.score("kind and calm")
    assert registered.toxicity_model(docs, labels.limit(0)).score("x") < 0.5


def test_toxicity_of_odd_rows(odd):
    model = toxicity.fit(["bad"], [1])
    scored = toxicity.score(odd, model, into="row")
    assert scored.columns == ["doc_id", "text", "lang", "n_lines", "row"] and scored.filter("row between 0 and 1").count() == odd.count()
    assert toxicity.fit([], []).score(None) < 0.5


def test_long_white_space(spark, bpe):
    """Runs of blanks on which the faster encoder gives up."""
    own = encoder(bpe)
    text = "a" + " " * 2_000_000 + "b"
    want = own.library.encode(text, add_special_tokens=False).ids
    assert own.ids(text).tolist() == want
    docs = spark.createDataFrame([(1, text), (2, "three short words"), (3, "\n\t " * 400_000)], "doc_id long, text string")
    packed = registered.packed(docs).collect()
    assert {r.doc_id: r.doc_tokens for r in packed}[1] == len(want) + 1
    assert sum(r.length for r in packed if r.doc_id == 1) == len(want) + 1


@pytest.mark.parametrize("outside", [
    '<section class="reader-comments">{0}</section>', '<div class="user-comments">{0}</div>', '<div id="cookie-banner">{0}</div>',
    '<div class="x comment-list">{0}</div>', '<div class="site_footer">{0}</div>',
])
@pytest.mark.parametrize("inside", [True, False])
def test_pages_without_reader_comments_and_banners(spark, outside, inside):
    """Named by a compound, with more text than the article, beside it and in it."""
    article = "<p>The short article itself.</p><p>Its second paragraph.</p>"
    other = outside.format("".join(f"<p>Somebody said something long about it, number {i}.</p>" for i in range(20)))
    page = f"<body><article>{article}{other}</article></body>" if inside else f"<body><article>{article}</article>{other}</body>"
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert html_text.extract_text(pages).first().text == "The short article itself. Its second paragraph."


def test_pages_whose_names_only_mention(spark):
    words = "A text of some length that is the article. " * 5
    for name in ("has-sidebar", "page-with-menu", "post share-enabled", "content no-comments"):
        page = f'<body><div class="{name}"><p>{words}</p></div><div class="menu-bar"><p>Home and more</p></div></body>'
        pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
        assert html_text.extract_text(pages).first().text == words.strip()
