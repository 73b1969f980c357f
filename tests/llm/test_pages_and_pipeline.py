"""HTML extraction against a plain parser, and the pipeline's stages."""

import html
import re

import pytest

import corpus_pipeline
from quotelift.llm import html_template, sentencepiece_viterbi
from quotelift.llm.common import materialize
from quotelift.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, text string, host string, tokens string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "h", "k") for r in rows], SCHEMA)


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in html_template.extract(pages(spark, rows)).collect()}


def plain(page):
    article = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_test_pages(spark, small):
    rows = spark.read.parquet(f"{small}/pages.parquet")
    want = {r["page_id"]: plain(r["html"]) for r in rows.collect()}
    got = QUERIES["op1_html_template"](spark, small).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


LAYOUT = """<html><head><title>T</title><style>p{{x:y}}</style></head><body class="has-sidebar">
<div id="site-header">Big Site</div><ul class="main-menu"><li><a href=/a>Home</a><li>News {n}</ul>
<div class="cookie-notice">We use cookies</div><article class="post"><header><h1>Title {n} &amp; more</h1></header>
<p>First  line {n}<p>Second <b>bold</b>&nbsp;line &lt;{n}&gt;<br>same block
<p>Share this page with all your friends now</p><script>if (a < b) {{ "</p>" }}</script>
<div class="ad-box">Buy {n}</div></article><aside>Side {n}</aside>
<section id="comments"><article class="comment"><p>Nice {n}</p></article></section>
<form><p>Name {n}</p><input></form><footer>Foot {n}</footer></body></html>"""


def test_named_parts_go_and_all_of_the_article_stays(spark):
    rows = [(i, f"http://h.net/{i}", LAYOUT.format(n=f"n{i}x")) for i in range(12)]
    rows.append((100, "http://other.net/", LAYOUT.format(n="solo")))
    got = texts(spark, rows)
    # nothing of an article is dropped, also not a line that the articles of a host share
    shared = "Share this page with all your friends now"
    for i in range(12):
        assert got[i] == f"Title n{i}x & more\nFirst line n{i}x\nSecond bold line <n{i}x> same block\n{shared}"
    assert got[100].endswith(f"same block\n{shared}")


def test_equal_pages_keep_their_text(spark):
    rows = [(i, f"http://copy.net/{i}", "<body><article><p>All the same words here</p></article></body>") for i in range(20)]
    assert set(texts(spark, rows).values()) == {"All the same words here"}


@pytest.mark.parametrize("differs", ["title", "paragraph"])
@pytest.mark.parametrize("count", [7, 12])
@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_near_copies_keep_shared_paragraphs(spark, element, count, differs):
    shared = ["A first paragraph that all pages have.", "A second one.", "A third one."]

    def blocks(i):
        title, last = (f"Page {i}", "The end") if differs == "title" else ("Page", f"The end of {i}")
        return [title, *shared, last]

    def page(i):
        inner = "".join(f"<p>{b}</p>" for b in blocks(i))
        return f"<body><div><div>Site</div></div><{element}><h1></h1>{inner}</{element}><div><div>Legal</div></div></body>"

    got = texts(spark, [(i, f"http://near.net/{i}", page(i)) for i in range(count)])
    frame = element == "div" and count < html_template.MIN_PAGES
    assert got == {i: "\n".join(["Site", *blocks(i), "Legal"] if frame else blocks(i)) for i in range(count)}


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("just text &am", "just text &am"),
        ("<p>cut <di", "cut"),
        ("<!-- open <p>x", ""),
        ("<p>a<p>b<!-- c --><script>x", "a\nb"),
        ("<nav>menu<article><p>text</p></article>", "text"),
        ("<div><ul><li><a>one</a></li><li><a>two</a></li></ul></div><p>long text of a page</p>", "long text of a page"),
        ('<p title="a > b">in</p>', "in"),
        ("<table><tr><td>a<td>b</table>", "a\nb"),
        ("a < b and c", "a < b and c"),
    ],
)
def test_odd_pages(spark, page, text):
    assert texts(spark, [(1, None, page)]) == {1: text}


@pytest.mark.parametrize(
    "page,text",
    [
        ('<article><section id="related-work"><p>work</p></section><h2 id="notice-period">period</h2></article>', "work\nperiod"),
        ('<article><div class="search-results"><p>found</p></div><p class="notice">note</p></article>', "found\nnote"),
        ('<div class="content has-sidebar"><p>all of it</p></div>', "all of it"),
        ('<div class="overflow-hidden"><p>seen</p></div><p aria-hidden="false">too</p>', "seen\ntoo"),
        ("<p><a href=/a>a paragraph that is one link</a></p>", "a paragraph that is one link"),
        ("<article><ul><li><a href=/a>source</a></ul></article><div>" + "<p>teaser text</p>" * 9 + "</div>", "source" + "\nteaser text" * 9),
        ('<div class="cookieNotice">c</div><div class="post ad">a</div><div id="site-header">h</div><p>x</p>', "x"),
    ],
)
def test_whole_names_tell_parts(page, text):
    _, blocks = html_template.parse(page, html_template._Hashes())
    assert "\n".join(b[0] for b in blocks) == text


def test_long_page_and_no_pages(spark):
    body = "".join(f"<p>word{i}</p>" for i in range(20_000))
    assert texts(spark, [(1, "http://a/", body)])[1].count("\n") == 19_999
    assert html_template.extract(pages(spark, [])).count() == 0
    again = html_template.extract(pages(spark, [(1, "u", "<p>x")] * 3)).collect()
    assert [r["text"] for r in again] == ["x"] * 3


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, small), "test")
        seen.append((name, before, docs))
    good, single, mixed, encoded = (x[2] for x in seen)
    rows = {tuple(r) for r in seen[0][1].collect()}
    assert all(d.columns == seen[0][1].columns for d in (good, single, mixed))
    assert {tuple(r) for r in good.collect()} <= rows and good.count() > 0.7 * len(rows)
    labels = spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1").join(docs_of(seen[0][1]), "doc_id")
    kept = labels.join(docs_of(good), "doc_id", "left_semi").count()
    assert kept >= 0.9 * labels.count()
    classes = {r["doc_id"]: r["class_id"] for r in corpus_pipeline.dart_minhash.classes(good).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, c in classes.items() if i == c)
    count = lambda df: sum(len(r["text"].split()) for r in df.collect())
    assert abs(count(mixed) - 1.5 * count(single)) < 0.1 * count(single)
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in single.collect()}
    vocab = sentencepiece_viterbi.Vocabulary.load()
    back = sorted(sentencepiece_viterbi.decode(r["ids"], vocab) for r in encoded.collect())
    assert back == sorted(r["text"] for r in mixed.collect())


def docs_of(df):
    return df.select("doc_id").distinct()


def test_pipeline_of_nothing_and_of_odd_rows(spark, tmp_path, small):
    source = spark.read.parquet(f"{small}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0), (1, "", None, "a", 0)], source.schema)
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "ids", "n_ids"]
    docs = source.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
