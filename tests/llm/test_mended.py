"""Cases that earlier versions of the operators got wrong: pages with telling class names, ids beside
a null one, many equal rows, long texts, many languages."""

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ampere.llm import html_extract, language_id, packing, token_counts, token_files
from ampere.session import new_path

MAIN = "The main text of this page, which is long enough to be told from its frame."


def texts(spark, pages):
    df = spark.createDataFrame([(k, f"https://h{k}.example/", h) for k, h in enumerate(pages)],
                               "page_id bigint, url string, html string")
    return [r.text for r in html_extract.extract(df).orderBy("page_id").collect()]


@pytest.mark.parametrize("page", [
    f'<main class="no-sidebar"><p>{MAIN}</p></main>',
    f'<html class="has-banner"><body><article><p>{MAIN}</p></article></body></html>',
    f'<body class="single-post has-sidebar nav-closed"><article>{MAIN}</article><aside>x</aside></body>',
    f'<div class="social-science"><p>{MAIN}</p></div>',
    f'<body class="home page has-header menu-open"><div id="content" class="with-comments">{MAIN}</div></body>',
    f'<article class="post widget sidebar"><p>{MAIN}</p></article>',
    f'<div class="site-header">Site</div><div class="main-nav">a b</div><div class="left-sidebar">s</div>{MAIN}'
    '<div id="comments-area"><p>first</p></div><div class="comment-list">x</div><div class="ad-slot">buy</div>'
    '<article id="comment-12" class="comment-body">nice</article><div class="cookie_banner">ok</div>',
    f'<article><header class="entry-header"></header><div class="entry-content">{MAIN}</div></article>',
])
def test_main_text_of_ordinary_pages(spark, page):
    assert texts(spark, [page]) == [MAIN]


def test_main_text_beside_an_article(spark):
    assert texts(spark, [f'<div class="content">{MAIN}</div><article class="teaser">Teaser</article>']) == [
        f"{MAIN}\nTeaser"]
    frame = "Read all of our stories in the app and save ten per cent on your first order today"
    own = lambda k: " ".join(f"word{k}{j}" for j in range(20))
    pages = [(k, "https://one.example/p", f"<div>{frame}</div><div>{own(k)}</div><article>Article {k}. {frame}</article>")
             for k in range(6)]
    got = html_extract.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()
    for r in got:       # the frame goes by coverage, the unique block stays, the article is protected
        assert r.text == f"{own(r.page_id)}\nArticle {r.page_id}. {frame}"


def test_packing_keeps_large_ids_beside_a_null_one(spark):
    big = 2 ** 53 + 1
    df = spark.createDataFrame([(None, "a text"), (big, "another text"), (-big, None)], "doc_id bigint, text string")
    got = packing.pack_documents(df).collect()
    assert {r.doc_id for r in got} == {None, big, -big}


def test_packing_deals_copies_to_all_bundles(spark):
    cut = spark.range(60_000).selectExpr("7L as doc_id", "0L as start", "41L as length", "9L as ids_crc32",
                                         "41L as doc_tokens")
    got = packing.pack(cut, 100, 5000).collect()
    sizes = Counter(r.sequence_id >> 32 for r in got)
    assert len(got) == 60_000 and len(sizes) == 12 and max(sizes.values()) < 6000
    assert len({(r.sequence_id, r.offset) for r in got}) == 60_000


def test_token_files_of_one_id_are_bounded(spark):
    for one in (5, None):
        df = spark.range(6000).select(F.lit(one).cast("long").alias("doc_id"), F.lit("the same words again").alias("text"))
        path = new_path(spark, "one-id")
        token_files.write_files(df, path, file_bytes=10_000)
        index = token_files.write_index(spark, path, new_path(spark, "one-id-index"))
        assert index.count() == 6000 and index.select("path").distinct().count() >= 8


def test_shuffled_read_takes_wanted_bytes_only(spark, monkeypatch):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    paths = []
    for k in range(2):
        paths.append(new_path(spark, "records"))
        token_files.write_files(df.withColumn("doc_id", F.col("doc_id") + 1000 * k), paths[-1], file_bytes=800)
    index = [token_files.write_index(spark, p, new_path(spark, "records-index")) for p in paths]
    both = index[0].unionByName(index[1])
    want = both.where("doc_id % 7 = 0")
    got = {r.doc_id: r.ids for r in token_files.read_records(spark, want).collect()}
    assert set(got) == {r.doc_id for r in want.collect()}
    # the rest of a file may be destroyed: it is not read
    import os
    for r in want.collect():
        at = r.path.removeprefix("file:").replace("//", "/")
        body = open(at, "rb").read()
        keep = {(x.offset, x.bytes) for x in want.where(F.col("path") == r.path).collect()}
        cut = bytearray(len(body))
        for o, n in keep:
            cut[o:o + n] = body[o:o + n]
        with open(at, "wb") as f:
            f.write(cut)
        crc = os.path.join(os.path.dirname(at), f".{os.path.basename(at)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert {r.doc_id: r.ids for r in token_files.read_records(spark, want).collect()} == got


def test_counts_of_text_without_spaces():
    import random
    rng = random.Random(3)
    c = token_counts.counter(token_counts.default_path())
    def letters(n):
        return "".join(rng.choice("abcdefgh12é漢") for _ in range(n))
    for text in (letters(100_000), letters(40_000) + " " + letters(70_000), letters(17_000) + "  x  " * 9000):
        assert c.count([text]) == [len(c.lib.encode(text))]
    text = letters(1_000_000)
    t = time.time()
    want = len(c.lib.encode(text))
    plain = time.time() - t
    t = time.time()
    assert c.count([text]) == [want]
    assert time.time() - t < 10 * plain + 2


def test_a_language_of_long_texts_is_learnt(spark):
    def text(words, n, k):
        return " ".join(words[(k * 7 + j * j) % len(words)] for j in range(n))
    long, short = "zorba lumi kante peru soval midar".split(), "the of and with this that".split()
    rows = [(text(long, 1200, k), "xx") for k in range(20)] + [(text(short, 100, k), "yy") for k in range(20)]
    df = spark.createDataFrame(rows, "text string, lang string")
    got = language_id.with_language(df, language_id.train(df)).collect()
    assert all(r.language.lang == r.lang for r in got)


def test_any_number_of_languages(spark):
    letters = lambda k: "".join(chr(97 + int(d)) for d in f"{k * 7919 % 100003:05}")
    rows = [(" ".join(letters(k * 20 + j) for j in range(20)), f"l{k:03}") for k in range(230)]
    df = spark.createDataFrame(rows, "text string, lang string")
    learnt = language_id.train(df)
    assert len(learnt) == 230
    got = language_id.with_language(df, learnt).collect()
    assert sum(r.language.lang == r.lang for r in got) >= 220
