"""Vector codes, nearest neighbours and source divergence against brute force, and on odd input."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ampere.llm import ann_collisions, source_divergence, vector_codes
from ampere.llm.common import read_table
from ampere.llm.registry import ORACLES, QUERIES
from ampere.session import new_path

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


# ---- operator 11 --------------------------------------------------------------

def brute_codes(rows, parts=4, entries=256, rounds=4):
    """Codes by full comparison in Python integers; rows are (id, label, vector)."""
    good = [(i, lab, v) for i, lab, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * c) for c in v] for _, _, v in good], np.int64)
    w = x.shape[1] // parts
    first = sorted((k for k in range(len(good)) if good[k][0] is not None),
                   key=lambda k: (good[k][0], good[k][2]))[:entries]
    books = [x[first, p * w:(p + 1) * w].copy() for p in range(parts)]

    def near(p):
        part = x[:, p * w:(p + 1) * w]
        d = np.array([((part - e) ** 2).sum(1) for e in books[p]])
        return d.argmin(0), d.min(0)
    for _ in range(rounds):
        for p in range(parts):
            lab, _ = near(p)
            for e in range(len(books[p])):
                own = x[lab == e, p * w:(p + 1) * w]
                if len(own):
                    books[p][e] = [int(s) // len(own) for s in own.sum(0)]
    found = [near(p) for p in range(parts)]
    codes = ["".join(f"{found[p][0][k]:02x}" for p in range(parts)) for k in range(len(good))]
    errors = [int(sum(found[p][1][k] for p in range(parts))) for k in range(len(good))]
    by = defaultdict(int)
    for (_, lab, _), e in zip(good, errors):
        by[lab] += e
    sha = hashlib.sha256(",".join(str(int(c)) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((i, c, e, by[lab], sha) for (i, lab, _), c, e in zip(good, codes, errors))


def written(spark, rows, kind="array<float>"):
    d = new_path(spark, "vectors")
    df = spark.createDataFrame(rows, f"vec_id bigint, label int, embedding {kind}")
    df.withColumn("code", F.lit("x")).withColumn("_label", F.lit(7)).withColumn("ERROR", F.lit(1)).withColumn(
        "id", F.lit(3)).withColumn("bound", F.lit(2.0)).repartition(3).write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_codes_equal_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.label, r.embedding) for r in read_table(spark, d, "embeddings").collect()]
    got = QUERIES["op11_vector_codes"](spark, d)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    v = lambda: [float(np.float32(x)) for x in rng.integers(-3, 4, 8) / 1024]
    hot = v()
    rows = [(k, k % 3 or None, v()) for k in range(300)]          # few values: ties, equal entries
    rows += [(k, 5, hot) for k in range(1000, 2500)]              # one very common vector
    rows += [(0, 1, v()), (0, 1, v()), (None, None, v()), (7, 7, None), (8, 8, [1.0, None] * 4),
             (9, 9, [NAN] + [0.0] * 7), (10, 1, [INF] + [0.0] * 7), (11, 1, [-0.5] * 8), (12, 2, [30000.0] * 8)]
    got = QUERIES["op11_vector_codes"](spark, written(spark, rows))
    assert Counter(map(tuple, got.collect())) == brute_codes(rows)


def test_codes_of_few_and_of_other_lengths(spark):
    rows = [(3, 1, [1.0, 2.0, 3.0, 4.0]), (1, None, [0.0] * 4), (2, 1, [1.0] * 8), (4, 1, []), (5, 1, [1.0] * 3)]
    got = QUERIES["op11_vector_codes"](spark, written(spark, rows)).collect()
    assert {(r.vec_id, r.code, r.error) for r in got} == {(1, "00000000", 0), (3, "01010101", 0)}
    for none in ([], [(1, 1, None)], [(None, 1, [1.0] * 4)]):
        assert QUERIES["op11_vector_codes"](spark, written(spark, none)).collect() == []
    with pytest.raises(Exception, match="too large"):
        QUERIES["op11_vector_codes"](spark, written(spark, [(1, 1, [1e30] * 4)]))


def test_nodes_are_assigned_as_single_parts():
    rng = np.random.default_rng(2)
    for n, k, spread in ((1, 1, 3), (5, 3, 2), (700, 40, 4), (2048, 256, 900), (1500, 17, 30)):
        points = rng.integers(-spread, spread + 1, (n, 3)) + rng.choice([0, 5 * spread], (n, 1))
        entries = points[rng.integers(0, n, k)] + rng.integers(-1, 2, (k, 3))
        depth = vector_codes.part_depth(n)
        points = points[vector_codes.tree_order(points, depth)]
        tree = vector_codes.Tree(points, vector_codes.spans(n, depth), sums=True)
        label, count, total = vector_codes.assign(points, tree, entries, *vector_codes.entry_tree(entries))
        want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (label == want).all()
        assert (count == np.bincount(want, minlength=k)).all()
        assert all((total[e] == points[want == e].sum(0)).all() for e in range(k))


def test_codes_do_not_depend_on_blocks(spark):
    df = read_table(spark, SF, "embeddings").select("vec_id", "embedding")
    out = set()
    for parts, block in ((1, 64), (7, 2048)):
        blocks, books = vector_codes.fit(df.repartition(parts), "vec_id", "embedding", block=block, rounds=2)
        out.add((vector_codes.digest(books), tuple(sorted(map(tuple, vector_codes.encode(blocks, books).collect())))))
    assert len(out) == 1


# ---- operator 12 --------------------------------------------------------------

def brute_nearest(rows, every=100, k=10):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.array([v for _, v in good])
    out = {}
    for i, q in sorted(((i, v) for i, v in good if i is not None and i % every == 0), key=lambda t: t[0]):
        d = np.sqrt(((x - q) ** 2).sum(1))
        near = sorted({(d[n], j is None, j) for n, (j, _) in enumerate(good) if j != i},
                      key=lambda t: (t[0], t[1], t[2] or 0))
        out[i] = [(s, j) for s, _, j in near[:k]]
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_nearest_found(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, d, "embeddings").collect()]
    want = brute_nearest(rows)
    got = defaultdict(list)
    for r in QUERIES["op12_nearest_neighbours"](spark, d).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(want)
    hit = sum(len({j for _, j in got[i]} & {j for _, j in w}) for i, w in want.items())
    assert hit >= 0.95 * sum(map(len, want.values()))
    exact = {r[0]: np.array(r[1], np.float64) for r in rows}
    for i, found in got.items():
        assert len(found) == len(want[i]) and found == sorted(found)
        assert all(abs(s - np.sqrt(((exact[i] - exact[j]) ** 2).sum())) < 1e-12 for s, j in found)


def test_nearest_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    v = lambda: [float(np.float32(x)) for x in rng.standard_normal(16)]
    hot, far = v(), [1000.0] * 16
    rows = [(k, None, v()) for k in range(1, 200)] + [(k, 1, hot) for k in range(500, 1800)]
    rows += [(0, 1, v()), (300, 1, hot), (400, 1, far), (400, 1, [999.0] * 16), (None, 1, hot), (600, 1, None),
             (700, 1, [0.0] * 16), (800, 1, [NAN] * 16), (900, 1, [None] + [1.0] * 15), (-100, 1, v()), (2, 1, [1.0])]
    d = written(spark, rows)
    got = defaultdict(list)
    for r in QUERIES["op12_nearest_neighbours"](spark, d).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    want = brute_nearest([(i, x) for i, _, x in rows if x is None or len(x) == 16])
    assert set(got) == set(want)
    same = sum(got[i] == want[i] or {j for _, j in got[i]} == {j for _, j in want[i]} for i in want)
    assert same >= 0.8 * len(want)
    assert [j for _, j in got[300]] == list(range(500, 510)) and {s for s, _ in got[300]} == {0.0}


def test_nearest_with_few_rows(spark):
    rows = [(100, 1, [1.0, 0.0]), (1, 1, [1.0, 1.0]), (2, 1, [3.0, 0.0]), (2, 1, [3.0, 0.0]), (None, 1, [1.0, 1.0])]
    got = QUERIES["op12_nearest_neighbours"](spark, written(spark, rows)).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 1.0), (100, 2, None, 1.0), (100, 3, 2, 2.0)]
    for none in ([], [(100, 1, None)], [(100, 1, [1.0])], [(5, 1, [1.0]), (6, 1, [2.0])]):
        assert QUERIES["op12_nearest_neighbours"](spark, written(spark, none)).collect() == []


def test_collisions_decide_what_is_verified():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32))
    lines = ann_collisions.directions(32)
    block = ann_collisions.Block(np.arange(3000), x, lines)
    q = x[:20] + 0.3 * rng.standard_normal((20, 32))
    true = np.sort(np.sqrt(((x[None] - q[:, None]) ** 2).sum(2)), 1)
    for n, (best, off) in enumerate(block.search(np.full(20, -1), q, true[:, 4], lines, 5, ann_collisions.HITS)):
        assert n in best and (off <= true[n, 4]).all() and len(best) <= 5


# ---- operator 13 --------------------------------------------------------------

def brute_audit(rows, least=10, top=10):
    docs = [((la or ""), (so or ""), [w.translate({c: c + 32 for c in range(65, 91)}) for w in
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", tx or "")]) for la, so, tx in rows]
    have, count, groups = defaultdict(Counter), defaultdict(Counter), {(la, so) for la, so, _ in docs}
    for la, so, words in docs:
        have[la].update(set(words))
        count[la, so].update(words)
        count[la].update(words)
    out = set()
    for la, so in groups:
        kept = sorted(t for t, d in have[la].items() if d >= least)

        def p(key):
            n = sum(count[key][t] for t in kept)
            return {t: 1 + math.floor(Fraction(10 ** 9 * (count[key][t] + 2), n + 2 * len(kept))) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        own, whole = p((la, so)), p(la)
        pairs = [(-sum(f(own[t], o[t]) for t in kept), s.encode())
                 for s in {s for l2, s in groups if l2 == la and s != so} for o in [p((la, s))]]
        terms = [(-f(own[t], whole[t]), t.encode()) for t in kept if count[la, so][t] and own[t] > whole[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out |= {(la, so, part, i.decode(), -v, n) for n, (v, i) in enumerate(items, 1)}
    return out


def test_divergence_equals_brute_force(spark):
    rows = [(r.lang, r.source, r.text) for r in read_table(spark, SF, "documents").collect()]
    got = [tuple(r) for r in QUERIES["op13_source_divergence"](spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows)


def test_divergence_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as from '{d}/documents.parquet'")
    got = QUERIES["op13_source_divergence"](spark, d)
    want = con.execute(ORACLES["op13_source_divergence"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_divergence_of_odd_documents(spark):
    common = "Alpha beta, ÉTÉ été Ünder_score x1y Beta"
    rows = [("en", f"s{k % 3}", f"{common} word{'abc'[k % 3]}") for k in range(30)]
    rows += [("en", None, "ALPHA alpha"), ("en", "silent", "12 34 -- \x00"), ("en", "none", None), (None, None, "alpha"),
             (None, "b", ""), ("de", "a", "nur"), ("de", "b", "das"), ("en", "s0", "beta " * 20000),
             ("en", "s0", common), ("en", "s0", common), ("en", "é", "alpha été"), ("en", "z", "alpha été")]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    for name in ("term", "n", "d", "value", "P"):
        df = df.withColumn(name, F.lit("clash"))
    want = brute_audit(rows)
    for held in (3, 200_000):
        assert {tuple(r) for r in source_divergence.audit(df.repartition(3), held=held).collect()} == want
    assert source_divergence.audit(df.limit(0)).collect() == []


def test_translate_table_is_the_contracts_term():
    text = "".join(map(chr, range(0, 300))) + "  Aé\x7fZ"
    want = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
    assert [t.decode() for t in source_divergence.terms(text.encode())] == want
