"""Operators 7, 8 and 10, and the pipeline."""

import html
import math
import re
import zlib
from collections import Counter

import public_tokenizers as public
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from reviewforge.llm import html_content, language_id, quality_rules
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORD, edge_docs, near_duplicate_components, without_repeats


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, symbols = len(words), sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), n < 20 or 100 * len(repeated) > 30 * n


def test_quality_counts_like_plain_python(spark):
    docs = edge_docs(spark).select("doc_id", "text").unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(-1, "a b c d e f g h " * 5 + "x\ny\ny\n \n"), (-2, " lead trail ")], "doc_id long, text string"))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.judge(docs).collect()), key=str)
    assert got == sorted(((r.doc_id, *counts(r.text)) for r in docs.collect()), key=str)
    assert quality_rules.judge(docs.limit(0)).count() == 0
    plan = quality_rules.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_passing_keeps_what_judge_keeps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.judge(docs).collect() if r.kept}
    assert {r.doc_id for r in quality_rules.passing(docs, tuple(docs.columns)).collect()} == kept
    good = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1").join(docs.where(F.size(F.split("text", " ")) >= 40), "doc_id")
    assert good.count() > 20 and all(r.doc_id in kept for r in good.collect())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Site name</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="loading-area"><article><header><h1>The   head&amp;line</h1></header>
<p>First <b>bo</b>ld sentence of the story, long enough to count.<br>More&nbsp;text.<p>Second paragraph &lt;here&gt;, unclosed
<aside>Related: <a href=/x>other story</a></aside><form><input><button>Send</button>Subscribe now!</form>
<div class="comments"><p>A reader's long comment, with sentences. And more of them, as readers do.</p></div></article></div>
<!-- <p>not this</p> --><div class="sidebar"><p>Popular today, a list of things to read.</p></div><footer>&copy; 2020 Site</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_content.main_text(PAGE) == "The head&line First bold sentence of the story, long enough to count. More text. Second paragraph <here>, unclosed"
    plain = "<body><div>Home</div><div><p>" + "A plain page without any article element still has sentences. " * 5 + "</p></div><div><a href=x>Next</a></div></body>"
    assert html_content.main_text(plain) == ("A plain page without any article element still has sentences. " * 5).strip()
    for odd in (None, "", "<", "<p", "<script>never closed", "<!-- never closed", "&", "<a <b>>", "</p></div>", "<p>" * 3000):
        assert isinstance(html_content.main_text(odd), str)


STORY = "A sentence of the story that is told here, long enough to count as text. " * 6
SIDE = "<div class=sidebar><p>Popular today, a list of things to read.</p></div><footer>Company</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id=aspnetForm><h1>{STORY}</h1><p>{STORY}</p><p>{STORY}</p>{SIDE}</form></body>",
        f"<html class=no-sidebar><body class='single has-sidebar'><h1>{STORY}</h1><div><p>{STORY}</p><p>{STORY}</p></div>{SIDE}</body></html>",
        f"<body><div class='layout has-sidebar'><div><h1>{STORY}</h1><p>{STORY}</p><p>{STORY}</p></div>{SIDE}</div></body>",
        f"<body><aside><article><p>{STORY}</p><p>{STORY}</p><p>{STORY}</p></article></aside>{SIDE}</body>",
        f"<body><form><main><h1>{STORY}</h1><p>{STORY}</p><p>{STORY}</p></main><div class=comments>{f'<p>{STORY}</p>' * 9}</div>{SIDE}</form></body>",
        f"<body><h1>{STORY}</h1><p>{STORY}</p><p>{STORY}</p><div class=comments>{f'<p>{STORY}</p>' * 9}</div><div hidden><article>{STORY}</article></div>{SIDE}</body>",
    ],
)
def test_main_text_in_a_frame_with_a_bad_cue(page):
    assert html_content.main_text(page) == (STORY * 3).strip()


def labels(page):
    """(start of the text, sign of the classifier's score, whether the cut keeps it) of each block."""
    found = html_content.blocks(page)
    gains = [html_content.score(b) for b in found]
    return [(b.text.split()[0], g > 0, kept) for b, g, kept in zip(found, gains, html_content.source_side(gains, html_content.smoothness(found)))]


@pytest.mark.parametrize(
    "page, changed, left_out",
    [
        # no name of the lists occurs: headings and short lines go with the paragraphs around them
        (f"<body><div class=kopf><a href=/>Links home</a></div><div class=inhalt><h2>Heading one</h2><p>{STORY}</p><p>Short line</p><p>{STORY}</p></div><div class=fuss>Company</div></body>", {"Heading", "Short"}, {"Links", "Company"}),
        # a link line within the article, and a list of links within it, which belongs to the menus
        (f"<body><article><p>{STORY}</p><p><a href=x>See also</a></p><p>{STORY}</p><ul><li><a href=x>Other story</a><li><a href=x>Other again</a></ul></article></body>", {"See"}, {"Other"}),
        # a long paragraph of the article under a bad class name, a short advert, and a boxed one however long
        (f"<body><article><p>{STORY}</p><p class=share-price>Shares {STORY * 6}</p><p>{STORY}</p><p class=ad>Buy this now.</p><p>{STORY}</p><div class=ad><p>Boxed {STORY * 90}</p></div><p>{STORY}</p></article></body>", {"Shares"}, {"Buy", "Boxed"}),
    ],
)
def test_the_cut_changes_labels(page, changed, left_out):
    got = labels(page)
    assert {w for w, positive, kept in got if kept != positive} == changed
    assert {w for w, _, kept in got if not kept} == left_out


def test_a_lone_paragraph_between_links_stays():
    page = f"<body><div><a href=/>Home</a></div><p>{STORY[:74]}And some more words to it.</p><div><a href=x>Next</a></div><p hidden>{STORY * 99}</p></body>"
    assert html_content.main_text(page) == STORY[:74] + "And some more words to it."


def test_weights_hold_their_inequalities():
    c = html_content
    longest = c.BASE + c.LONGEST + c.SENTENCE
    assert -2 * c.SIBLING * c.OTHER_PLACE < longest + c.BAD_PLACE < -2 * c.SIBLING * c.STEP * c.OTHER_PLACE
    assert c.BASE + c.LINKED + c.NO_SENTENCE < -c.GOOD_PLACE
    assert c.BASE + c.NO_SENTENCE + c.PER_LENGTH * math.log2(1 + 6 / 20) > c.SIBLING * (c.STEP - 1)
    assert c.BASE + c.SENTENCE + c.PER_LENGTH * math.log2(1 + 100 / 20) > 2 * c.SIBLING * (1 - c.CONTRAST)


def test_whole_articles_of_the_test_data(spark):
    for p in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        want = html.unescape(re.sub(r"<[^>]*>", " ", inside)).split()
        assert "".join(html_content.main_text(p.html).split()) == "".join(want)


def test_minimum_cut_equals_brute_force():
    import itertools
    import random

    r = random.Random(6)
    for _ in range(150):
        n = r.randint(1, 8)
        gains = [r.randint(-4000, 4000) / 1000 for _ in range(n)]
        edges = [(i, j, r.randint(0, 3000) / 1000) for i in range(n) for j in range(i + 1, n) if r.random() < 0.4]

        def cost(side):
            return sum(g for g, s in zip(gains, side) if g > 0 and not s) - sum(g for g, s in zip(gains, side) if g < 0 and s) + sum(w for i, j, w in edges if side[i] != side[j])

        best = min(cost(s) for s in itertools.product((False, True), repeat=n))
        assert cost(html_content.source_side(gains, edges)) == pytest.approx(best)


def test_pages_of_the_test_data(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r.page_id: r for r in html_content.extract(pages).collect()}
    assert len(got) == pages.count()
    for p in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        words = html.unescape(re.sub(r"<[^>]*>", " ", inside)).split()
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].text.split()[:3] == words[:3]
    odd = spark.createDataFrame([(1, None, None, "x"), (1, "u", "", "x"), (None, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in html_content.extract(odd).collect())[:2] == [0, 0]
    assert html_content.extract(odd.limit(0)).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert len(got) == docs.count()
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out for r in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_edge_documents(spark):
    docs = edge_docs(spark)
    model = language_id.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in language_id.identify(docs, model=model).collect()}
    assert {(0, True, True), (1, True, True), (2, True, True), (7, True, True), (8, True, True), (3, False, False), (None, False, False)} <= got
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    one = {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit("en"))).collect()}
    assert one == {"en", "und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    whole = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pred = {r.doc_id: r.lang_pred for r in language_id.identify(whole).collect()}
    left = [(i, t) for i, t, _ in docs if pred[i] != "und"]
    kept = {r.doc_id for r in quality_rules.judge(whole).collect() if r.kept}
    left = [(i, t) for i, t in left if i in kept]
    component, _ = near_duplicate_components(left, corpus_pipeline.SIMILAR)
    left = [(i, t) for i, t in left if component[i] == i]
    removed = without_repeats([t for _, t in left], corpus_pipeline.REPEATED.span)
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in left}
    untouched = [(i, t) for (i, t), w in zip(left, removed) if not w[1]]
    same = {i for i, _ in untouched}
    lib = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    for i, t in untouched:
        assert total[i] == len(lib.encode(t, add_special_tokens=False).ids) + 1
    assert len(same) > 50


def test_stages_on_edge_documents(spark):
    docs = edge_docs(spark).unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60), allowMissingColumns=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
