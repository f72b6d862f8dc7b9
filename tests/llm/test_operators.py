"""Each operator against a brute-force version, and on odd input: nulls, empty and long texts,
ties and repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ampere.llm import (
    bpe,
    fingerprints,
    html_extract,
    jaccard_join,
    language_id,
    packing,
    quality_classifier,
    quality_rules,
    token_counts,
    token_files,
    wordbpe,
)
from ampere.llm.common import keep_rows, read_table
from ampere.llm.components import components
from ampere.llm.html_parse import parse
from ampere.llm.registry import QUERIES
from ampere.session import materialize, new_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = {"_t": "x", "_w": "x", "_h": "x", "score": 1.0, "IDS": "y", "h": 5, "cid": 7, "_counts": "z", "_row": 3}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows(spark):
    return {r.doc_id: r for r in read_table(spark, SF, "documents").collect()}


def odd_rows():
    long = " ".join(f"word{k % 977} other{k % 31}," for k in range(9000))
    clean = " ".join(f"term{k}" for k in range(120))
    return [
        (1, clean, "en", "a", 1), (1, clean, "en", "a", 1), (2, clean, None, None, None), (3, None, "de", "b", 0),
        (4, "", "fr", "b", 0), (5, " \t\n ", "en", "c", 4), (6, "one two", "en", "c", 7), (7, "one two", "en", "c", 7),
        (8, long, "en", "d", 1), (9, "été <|endoftext|> It's 12 ###", "fr", "d", 1), (None, clean, "en", "a", 1),
        (None, None, None, None, None), (9, "same id, other text", "en", "d", 1), (10, "12 34 ###", "es", "e", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    for k, v in EXTRA.items():
        df = df.withColumn(k, F.lit(v))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd_dir(spark, odd):
    d = new_path(spark, "odd")
    odd.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (9, 0, 1), (None, 1, 0), (4, None, 0), (99, 1, 0)],
                          "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    pages = [(1, "http://a.example/1", "<p>x &amp; y"), (1, "http://a.example/1", "<p>x &amp; y"), (None, None, None),
             (2, "bad url", ""), (3, None, "plain < text &lt; here"), (4, "http://a.example/2", "<article>" + "<p>z" * 9000)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn(
        "host", F.lit("clash")).withColumn("h", F.lit(1)).write.parquet(f"{d}/pages.parquet")
    return d


@pytest.fixture(scope="module")
def empty_dir(spark, empty):
    d = new_path(spark, "empty")
    empty.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d


@pytest.mark.parametrize("name", sorted(n for n in QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(n for n in QUERIES))
def test_odd_rows(spark, odd_dir, name):
    got = QUERIES[name](spark, odd_dir).collect()
    key = "page_id" if "html" in name else "doc_id"
    ids = Counter(r[key] for r in got)
    if "html" in name:
        assert ids == Counter({1: 2, None: 1, 2: 1, 3: 1, 4: 1})
    elif name.startswith("op2"):        # rows repeated exactly are one document
        assert ids == Counter({1: 1, 9: 2, None: 2} | {k: 1 for k in (2, 3, 4, 5, 6, 7, 8, 10)})
    elif name.startswith("op5"):
        assert set(ids) == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None}
    else:
        assert ids == Counter({1: 2, 9: 2, None: 2} | {k: 1 for k in (2, 3, 4, 5, 6, 7, 8, 10)})


# 1 ---------------------------------------------------------------------------

def test_language_held_out(spark):
    got = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    sure = [r for r in held if not r.rejected]
    assert len(sure) > 0.9 * len(held) and np.mean([r.lang_pred == lang[r.doc_id] for r in sure]) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_language_defined_results(spark, odd):
    table = {"en": language_id.normal("the quick brown fox and the lazy dog " * 20),
             "de": language_id.normal("der schnelle braune fuchs und der faule hund " * 20)}
    got = language_id.with_language(odd, table).collect()
    for r in got:
        assert (r.language.lang == "und") == (not any(map(str.isalpha, r.text or "")))
        assert r.score == 1.0 and r._t == "x"           # the input's own columns stay
    assert language_id.classify("the dog and the fox", language_id._compressors(tuple(table.items())))[0] == "en"
    assert language_id.classify("abc", [])[0] == "und"


# 2 ---------------------------------------------------------------------------

def test_fingerprints_edited_text_and_likeness(spark, rows):
    got = {r.doc_id: r for r in QUERIES["op2_fingerprints"](spark, SF).collect()}
    order = sorted(rows, reverse=True)
    shingles = lambda t: {tuple(w[i:i + 5]) for w in [WORD.findall(t)] for i in range(len(w) - 4)} or (
        {tuple(WORD.findall(t))} if WORD.findall(t) else set())
    jac = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    off = []
    for k, d in enumerate(order):
        text, after = rows[d].text or "", rows[order[(k + 1) % len(order)]].text or ""
        m = len(text) // 3
        edited = text[:len(text) - m] + after[:m]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].n_chars == len(text)
        off.append(got[d].near_edited - jac(shingles(text), shingles(edited)))
        off.append(got[d].near_next - jac(shingles(text), shingles(after)))
        n = len(shingles(text))
        assert abs(got[d].est_shingles - n) <= (0 if n < 128 else 0.45 * n)
    assert np.abs(off).max() < 0.2 and np.abs(off).mean() < 0.03
    for a in rows.values():
        same = [b.doc_id for b in rows.values() if b.text == a.text]
        assert len({got[d].fingerprint for d in same}) == 1


def test_sketches_merge(spark):
    df = spark.createDataFrame([(list(range(i, 3000, 7)), list(range(0, 3000, 3))) for i in range(5)],
                               "x array<bigint>, y array<bigint>")
    h = lambda c: F.transform(c, lambda v: F.xxhash64(v))
    a, b = fingerprints.bottom(h(F.col("x"))), fingerprints.bottom(h(F.col("y")))
    both = fingerprints.bottom(h(F.concat("x", "y")))
    assert df.where(fingerprints.merge(a, b) != both).count() == 0
    r = df.select(fingerprints.resemblance(a, a).alias("one"), fingerprints.containment(a, both).alias("in")).collect()
    assert all(x.one == 1.0 and x["in"] > 0.75 for x in r)


# 3, 5, 7, 10 -----------------------------------------------------------------

@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(wordbpe.default_path())


def test_words_encode_as_the_library(lib):
    enc = wordbpe.WordEncoder(wordbpe.default_path())
    rng = random.Random(5)
    signs = "abcXYZéÉßñ'’-.,!<|>_ 0159\n\t́中#&\x85 ΣİǅK"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a<|startoftext|>b it'S", None, "", "x" * 5000, "<|end of", "it's we'LL 'd"]
    ids, at = enc.encode(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == lib.encode(t or "", add_special_tokens=False).ids, t
    assert [len(x) for x in enc.encode(pa.array([], pa.string()))] == [0, 1]


def test_bpe_round_trip(spark, rows, lib, odd):
    for r in QUERIES["op10_bpe"](spark, SF).collect():
        ids = lib.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in bpe.with_decoded(bpe.with_ids(odd, "tokens"), "decoded", "tokens").collect():
        assert r.tokens == lib.encode(r.text or "", add_special_tokens=False).ids and r.IDS == "y"
        assert r.decoded == lib.decode(r.tokens, skip_special_tokens=False)


def test_token_files(spark, rows, lib):
    got = sorted(QUERIES["op3_token_files"](spark, SF).collect(), key=lambda r: r.doc_id)
    at = 0
    for r in got:
        ids = lib.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(rows)


def test_token_files_many_files_and_shuffled_reads(spark, odd, lib):
    path, index = new_path(spark, "files"), new_path(spark, "index")
    token_files.write_files(odd, path, file_bytes=20_000)
    got = token_files.write_index(spark, path, index)
    r = got.orderBy("start", "part", "record").collect()
    assert len({x.path for x in r}) > 1 and [x.doc_id for x in r] == sorted(
        [x[0] for x in odd_rows()], key=lambda v: (v is not None, v or 0))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(r, r[1:]))
    picked = token_files.read_records(spark, got.where("doc_id in (8, 2)").select("path", "offset", "bytes"))
    texts = {x[0]: x[1] for x in odd_rows()}
    for x in picked.collect():
        assert x.ids == lib.encode(texts[x.doc_id], add_special_tokens=False).ids + [2]


def test_token_frames_are_checked():
    good = token_files.frame(token_files.serialize(None, np.array([1, 65536]), True)) + b"\n"
    (_, size, payload), = token_files.parse(good)
    assert size == len(good) and token_files.deserialize(payload)[0] is None
    assert token_files.deserialize(payload)[1].tolist() == [1, 65536]
    for k in range(len(good)):
        with pytest.raises(ValueError):
            list(token_files.parse(good[:k] + bytes([good[k] ^ 1]) + good[k + 1:]))
    with pytest.raises(ValueError):
        list(token_files.parse(good[:-1]))


def test_packing(spark, rows, lib):
    got = QUERIES["op5_packing"](spark, SF).collect()
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append(r)
        docs[r.doc_id].append(r)
    for part in seqs.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert docs.keys() == rows.keys()
    for d, part in docs.items():
        ids, at = lib.encode(rows[d].text or "", add_special_tokens=False).ids + [2], 0
        for r in sorted(part, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in got) / (4096 * len(seqs)) > 0.97


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(3)
    for _ in range(30):
        size = rng.choice([1, 7, 64, 100])
        lengths = sorted((rng.randint(1, size) for _ in range(rng.randint(0, 200))), reverse=True)
        where, offset = packing.best_fit(lengths, size)
        room = []
        for n, w, o in zip(lengths, where, offset):
            fit = [r for r in room if r >= n]
            if fit:
                assert room[w] == min(fit) and o == size - room[w]
            else:
                assert w == len(room) and o == 0
                room.append(size)
            room[w] -= n


def test_packing_in_bundles(spark):
    cut = spark.range(500).selectExpr("id as doc_id", "0L as start", "id % 97 + 1 as length", "id as ids_crc32",
                                      "id % 97 + 1 as doc_tokens")
    got = packing.pack(cut, 100, 50).collect()
    assert len(got) == 500 and len({r.sequence_id >> 32 for r in got}) == 10
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 100


def test_token_counts(spark, rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    for r in QUERIES["op7_token_counts"](spark, SF).collect():
        t = rows[r.doc_id].text or ""
        assert (r.n_tokens, r.n_bytes) == (len(sp.encode(t)), len(t.encode()))
        assert r.over_limit == (r.n_tokens > 4096)


def test_token_counts_resynchronise():
    c = token_counts.PieceCounter(token_counts.default_path())
    assert c.proven
    rng = random.Random(1)
    for _ in range(400):
        t = "".join(rng.choice("ab  ▁é\n日<s>xaaaa") for _ in range(rng.randint(0, 500)))
        assert c.count_huge(t, 30, 5) == len(c.lib.encode(t)), t
    for t in ("x" * 20_000, "ab" * 5000 + " " + "é" * 5000, " " * 3000, "▁" * 300 + "a b" * 900):
        assert c.count([t], 500, 20) == [len(c.lib.encode(t))]


# 4 ---------------------------------------------------------------------------

def test_main_text_of_all_pages(spark):
    import html
    page = {r.page_id: r for r in read_table(spark, SF, "pages").collect()}
    got = QUERIES["op4_html_extraction"](spark, SF).collect()
    assert len(got) == len(page)
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|\Z)", page[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:h1|p|b)>|<br>", body))
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text) and r.url == page[r.page_id].url


def test_zones():
    page = parse("""<html><head><title>t</title></head><body><div id="cookie-notice">We use cookies</div>
      <header>Site</header><main><header><h1>A &lt;title&gt;</h1></header><p>One<br>two <b>bold</b>&nbsp;x
      <aside>side</aside><section class="comments"><p>first!</p></section><ul><li>i<li>j</ul>
      <script>if (a < b) { "<p>no" }</script><!-- <p>no --><form>f</form></main><footer>foot""")
    assert [t for z, t, *_ in page.blocks if z == 1] == ["A <title>", "One two bold x", "i", "j"]
    assert {t for z, t, *_ in page.blocks if z == 2} == {"We use cookies", "Site", "side", "first!", "f", "foot"}
    assert parse(None).blocks == [] and parse("<p a='").blocks == []


def test_open_blocks_go_when_the_host_repeats_them(spark):
    same = "Join our list of readers today and never miss a single story again"
    rows = [(k, f"https://h{k % 2}.example/{k}", f"<body><div>{same}</div><div>Unique text number {k} "
             f"tells of {k * 7} things that happened in year {k * 13} there</div></body>") for k in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert all(t.startswith(f"Unique text number {k} ") and same not in t for k, t in whole.items())
    # the same when a host is cut into bundles of about two pages
    cut = html_extract.extract(df, bundle=60).collect()
    assert {r.page_id: r.text for r in cut} == whole
    one = html_extract.extract(df.where("page_id = 3")).first()
    assert one.text.startswith(same)                       # nothing repeats on a single page


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(60):
        s = rng.integers(0, 3, rng.integers(1, 60))
        order, lcp = html_extract.suffix_array(s)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert order.tolist() == want
        for k in range(1, len(s)):
            a, b = s[want[k - 1]:].tolist(), s[want[k]:].tolist()
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == n


def test_covered_tokens_brute_force(spark):
    rng = np.random.default_rng(4)
    pages = [rng.integers(0, 4, rng.integers(0, 40)).astype(np.int64) for _ in range(30)]
    seen = defaultdict(set)
    for k, p in enumerate(pages):
        for i in range(len(p) - 4):
            seen[tuple(p[i:i + 5])].add(k)
    rows = [(k, k, "x", p.astype(np.int32).tobytes(), len(p)) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, h bigint, host string, tokens binary, n bigint")
    for bundle in (10_000, 100):
        for r in html_extract.coverage(df, 5, bundle).collect():
            p, want = pages[r.page_id], np.zeros(len(pages[r.page_id]), bool)
            for i in range(len(p) - 4):
                if len(seen[tuple(p[i:i + 5])]) > 1:
                    want[i:i + 5] = True
            bits = np.unpackbits(np.frombuffer(r.bits, np.uint8))[:len(p)].astype(bool)
            if r.more:
                late = np.zeros(len(p), bool)
                late[r.more] = True
                bits |= html_extract.spread(late, 5)
            assert bits.tolist() == want.tolist()


# 6, 9 ------------------------------------------------------------------------

def test_ranker_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op6_quality_classifier"](spark, sf).collect()}
    held = [(got[r.doc_id], r.quality) for r in read_table(spark, sf, "labels").collect()
            if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(g.held_out for g, _ in held) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())
    right = {q: np.mean([g.predicted == q for g, y in held if y == q]) for q in (0, 1)}
    assert right[0] > 0.97 and right[1] > 0.98


def test_copies_do_not_fill_the_dictionary(spark):
    texts = [f"text number {chr(97 + k // 26)}{chr(97 + k % 26)} of many" for k in range(40)]
    one = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    first = one.orderBy(F.xxhash64("text")).first().text
    rows = one.unionAll(one.where(F.col("text") == first).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("x"))
    assert language_id.train(rows, per_language=20) == language_id.train(one, per_language=20)
    assert len(set(language_id.train(rows, per_language=20)["en"].split(b" of many"))) == 21     # 20 texts and the end


def test_ranker_of_one_class():
    x = np.zeros((3, len(quality_classifier.FEATURES)))
    for y in ([1, 1, 1], [0, 0, 0], []):
        m = quality_classifier.fit(x[:len(y)], np.array(y))
        assert not any(m.weights) and (m.threshold <= -1 if 0 not in y else m.threshold >= 1)


def test_rule_counts(spark, rows):
    for r in QUERIES["op9_quality_rules"](spark, SF).collect():
        t = rows[r.doc_id].text or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i:i + 3])].append(i)
        again = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)}
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(again)
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r.kept and r.base_failed)


def test_ratio_is_the_mean_log_ratio(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None), (2, "c")], "doc_id bigint, text string")
    trusted = spark.createDataFrame([(1,), (None,)], "doc_id bigint")
    got = {(r.doc_id, r.text): r.r for r in quality_rules.with_ratio(
        docs, quality_rules.ratio_table(docs, trusted, buckets=64), "r", buckets=64).collect()}
    hashes = {}
    for g in (("a",), ("b",), ("c",), ("a", "b"), ("b", "a"), ("b", "c")):
        hashes[g] = spark.range(1).select(F.pmod(F.xxhash64(*map(F.lit, g)), F.lit(64))).first()[0]
    grams = lambda t: [hashes[(x,)] for x in t] + [hashes[p] for p in zip(t, t[1:])]
    texts = ["aba", "bc", "", "c"]
    raw, target = Counter(x for t in texts for x in grams(t)), Counter(grams("aba"))
    p = lambda c, b: (c[b] + 1) / (sum(c.values()) + 64)
    for (doc, text), want in zip([(1, "a b a"), (2, "b c"), (3, None), (2, "c")], texts):
        g = grams(want)
        value = sum(np.log(p(target, b) / p(raw, b)) for b in g) / len(g) if g else 0.0
        assert got[(doc, text)] == pytest.approx(value, abs=1e-12)


def test_every_trusted_document_counts(spark):
    docs = spark.range(0, 30_000, 1, 4).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("a b"), (F.col("id") % 50).cast("string")).alias("text"))
    ids = docs.select("doc_id")
    # all are trusted: the target is the raw corpus, so every ratio is exactly 0
    assert not any(quality_rules.ratio_table(docs, ids, buckets=64).first().llr)
    some = ids.where("doc_id % 3 = 0").unionAll(ids.where("doc_id < 9"))
    whole = quality_rules.ratio_table(docs, some, buckets=64).first().llr
    assert any(whole) and quality_rules.ratio_table(docs, some, buckets=64, part=60_000).first().llr == whole


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_clean_documents_without_label_stay(spark, sf):
    d = f"/root/testdata/sf{sf}"
    docs, labels = materialize(read_table(spark, d, "documents").repartition(16), "t"), read_table(spark, d, "labels")
    half = labels.where("quality = 0 or doc_id % 2 = 0")           # the other good ones are clean, and not known as such
    table = materialize(quality_rules.ratio_table(docs, quality_rules.trusted_ids(half)), "t")
    judged = materialize(quality_rules.judge(docs, table, "v").select("doc_id", "lang", "v"), "t")
    seen = judged.join(labels, "doc_id", "left").where("not v.base_failed").groupBy(
        "lang", F.expr("case quality when 1 then if(doc_id % 2 = 0, 'trusted', 'hidden') when 0 then 'bad' else 'none' end")
        .alias("of")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v.kept").cast("int")).alias("kept")).collect()
    share = {(r.lang, r.of): (r.kept, r.n) for r in seen}
    for lang in ("en", "de", "fr", "es"):
        for of, least in (("hidden", 0.97), ("trusted", 0.97), ("none", 0.85)):     # of the last some are junk
            kept, n = share.get((lang, of), (0, 0))
            assert kept >= least * n, (sf, lang, of, kept, n)
    kept, n = (sum(v[k] for (_, of), v in share.items() if of == "bad") for k in (0, 1))
    assert kept <= {"0.001": 0.5, "0.01": 0.4, "0.1": 0.01}[sf] * n, (sf, kept, n)


def test_threshold_leaves_own_counts_out(spark):
    texts = [" ".join(random.Random(k).choices("abcdefgh", k=60)) for k in range(5)]
    docs = spark.createDataFrame([*enumerate(texts), (9, "x y " * 30), (7, "a b")], "doc_id bigint, text string")
    ids = docs.where("doc_id in (0, 1, 2, 7)").select("doc_id")
    got = quality_rules.ratio_table(docs, ids, buckets=32)
    assert got.first().threshold == quality_rules.ratio_table(docs, ids, buckets=32, part=1).first().threshold
    grams = {r.doc_id: r.g for r in docs.select("doc_id", quality_rules._buckets(F.split(F.trim("text"), " "), 32).alias("g")).collect()}
    raw = Counter(x for g in grams.values() for x in g)
    target = Counter(x for k in (0, 1, 2, 7) for x in grams[k])
    p = lambda c, b: (c[b] + 1) / (sum(c.values()) + 32)
    bins = [np.floor(1000 * np.mean([np.log(p(target - Counter(grams[k]), b) / p(raw, b)) for b in grams[k]])) for k in (0, 1, 2)]
    low, mid = np.percentile(bins, [1, 50])
    assert got.first().threshold == pytest.approx((mid - 1.5 * (mid - low)) / 1000, abs=1e-9)
    none = quality_rules.ratio_table(docs, ids.where("doc_id = 7"), buckets=32).first()
    assert none.threshold == -np.inf


def test_many_trusted_ids_meet_texts_in_one_shuffle(spark):
    """Beyond the broadcast bound: null, repeated and hot ids on either side, the same table, and no broadcast of ids."""
    rows = [(k if k % 3 else 7, f"w{k % 5} v{k % 11} " * 30) for k in range(600)] + [(None, "a b"), (None, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = spark.createDataFrame([(k,) for k in [7, 7, 7, 4, 5, 3, 900, None]], "_id bigint")
    few = quality_rules.ratio_table(docs, ids, buckets=32).first()
    many = quality_rules.ratio_table(docs, ids, buckets=32, part=0).first()
    assert (few.llr, few.threshold) == (many.llr, many.threshold) and np.isfinite(few.threshold)
    joined = quality_rules._trusted_words(docs, ids, "text", "doc_id", 0)
    assert joined.count() == sum(k in (7, 4, 5, 3) for k, _ in rows)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert quality_rules._trusted_words(docs, ids.where("false"), "text", "doc_id", 0).count() == 0


def test_filters_compute_once(spark, odd):
    v = quality_rules.with_rule_counts(odd, "v")
    kept = keep_rows(v, F.col("v.n_words") >= 100).drop("v")
    assert kept.columns == odd.columns and kept.count() == 5


# 8 ---------------------------------------------------------------------------

def brute_components(texts, width, percent):
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) or (
            frozenset([tuple(w)]) if w else frozenset())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    where = defaultdict(list)
    for k in sorted(sets):
        shared = Counter(e for s in sets[k] for e in where[s])
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[e]) - n):
                a, b = find(k), find(e)
                root[max(a, b)] = min(a, b)
        for s in sets[k]:
            where[s].append(k)
    return {k: (len(sets[k]), find(k)) for k in sets}


def near_copies():
    rng = random.Random(11)
    base = [[f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 12, 60, 150]))] for _ in range(12)]
    passage = [f"p{k}" for k in range(60)]
    out = {}
    for k in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        if k % 9 == 0:
            w += passage
        out[k] = " ".join(w) if k % 5 else " ".join(w).upper() + "\n"
    out[160], out[161], out[162] = "", None, " \t"
    return out


@pytest.mark.parametrize("percent", [85, 60])
def test_join_against_brute_force(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard_join, "GROUP", 4)
    texts = near_copies()
    want = brute_components(texts, 4, percent)
    got = jaccard_join.near_duplicates(spark.createDataFrame(
        list(texts.items()), "doc_id bigint, text string").repartition(5), 4, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < 120


def test_join_of_all_documents(spark, rows):
    want = brute_components({k: r.text for k, r in rows.items()}, 4, 85)
    got = QUERIES["op8_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_join_defined_results(spark, odd):
    got = jaccard_join.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows())
    comp = defaultdict(set)
    for r in got:
        comp[r.doc_id].add((r.n_shingles, r.component_id))
    assert comp[1] == comp[2] == {(117, 1)} and comp[3] == {(0, 3)} and comp[6] == comp[7] == {(1, 6)}
    assert comp[None] == {(117, None), (0, None)} and len(comp[9]) == 2
    kept = jaccard_join.one_of_each(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        {None: 2, 9: 1} | {k: 1 for k in (1, 3, 4, 5, 6, 8, 10)})


def test_prefixes_of_linked_sets_meet():
    rng = random.Random(2)
    for _ in range(2000):
        a = set(rng.sample(range(60), rng.randint(1, 40)))
        b = set(a)
        for _ in range(rng.randint(0, 6)):
            b.symmetric_difference_update({rng.randrange(80)})
        if b and 100 * len(a & b) >= 85 * len(a | b):
            cut = lambda s: set(sorted(s)[:jaccard_join.prefix_length(len(s), 85)])
            assert cut(a) & cut(b)


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: find(k) for k in root if find(k) != k}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
