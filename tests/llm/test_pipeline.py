"""The pipeline against its stages done by hand, on odd rows and on an empty table."""

from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F

from ampere.llm import jaccard_join, packing, quality_classifier, quality_rules
from ampere.llm.common import read_table
from ampere.session import new_path

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = read_table(spark, SF, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    labels = read_table(spark, SF, "labels")
    model = quality_classifier.train(docs, quality_classifier.learnable(labels))
    scores = {r.doc_id: r.s for r in quality_classifier.with_quality(docs, model, "s").collect()}
    ids = {d for d in ids if scores[d] >= 0.7}
    one = cp.materialize(cp.STAGES[0][1](spark, docs, SF), "t")
    assert one.columns == columns and {r.doc_id for r in one.collect()} == ids

    table = quality_rules.ratio_table(one, quality_rules.trusted_ids(labels))
    kept = {r.doc_id for r in quality_rules.judge(one, cp.materialize(table, "t"), "v").collect() if r.v.kept}
    two = cp.materialize(cp.STAGES[1][1](spark, one, SF), "t")
    assert two.columns == columns and {r.doc_id for r in two.collect()} == kept < ids

    near = jaccard_join.near_duplicates(two).collect()
    three = cp.materialize(cp.STAGES[2][1](spark, two, SF), "t")
    assert three.columns == columns
    assert Counter(r.doc_id for r in three.collect()) == Counter({r.component_id: 1 for r in near})

    four = cp.STAGES[3][1](spark, three, SF).collect()
    assert {r.doc_id for r in four} == {r.component_id for r in near}
    whole = Counter()
    for r in four:
        whole[r.doc_id] += r.length
    assert all(whole[r.doc_id] == r.doc_tokens for r in four)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = packing.pieces(three.select("doc_id", "text")).select(names).collect()
    run = cp.run(spark, SF)
    assert Counter(map(tuple, run.select(names).collect())) == Counter(map(tuple, want))


def test_clean_labelled_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    good = labels.where("quality = 1").select("doc_id").join(
        docs.where(F.size(F.split("text", "\\s+")) >= 60), "doc_id").select("doc_id")
    one = cp.materialize(cp.rank_quality(spark, docs, sf), "t")
    two = cp.materialize(cp.apply_rules(spark, one, sf), "t")
    assert good.join(two, "doc_id", "left_anti").count() <= 0.01 * good.count()
    bad = labels.where("quality = 0").join(two, "doc_id", "left_semi")
    assert bad.count() <= 1


def test_near_duplicates_at_five_words_and_four_fifths(spark):
    base = [f"w{k}" for k in range(100)]
    texts = {1: base, 2: base + [f"a{k}" for k in range(20)],       # 96 of 116 shingles of five, 97 of 117 of four
             3: base[:80], 4: base[10:90] + ["z"], 5: [f"v{k}" for k in range(60)], 6: base + [f"b{k}" for k in range(30)]}
    docs = spark.createDataFrame([(k, " ".join(t), "en", "a", 1) for k, t in texts.items()],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    sets = {k: {tuple(t[i:i + 5]) for i in range(len(t) - 4)} for k, t in texts.items()}
    part = {k: k for k in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    part[a] = part[b] = min(part[a], part[b])
    got = {r.doc_id for r in cp.drop_near_duplicates(spark, docs, SF).collect()}
    assert got == set(part.values()) and 2 not in got


def test_odd_and_empty_tables(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    clean = " ".join(f"term{k}" for k in range(120))
    rows = [(1, clean, "en", "a", 1), (1, clean, "en", "a", 1), (2, None, None, None, None), (None, clean, "en", "a", 1),
            (3, "", "en", "b", 0), (4, clean + " end", "en", "b", 0)]
    for data in (rows, []):
        d = new_path(spark, "pipeline-test")
        spark.createDataFrame(data, schema).withColumn("_score", F.lit(1)).withColumn(
            "_verdict", F.lit(2)).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        got = cp.run(spark, d).collect()
        assert Counter(r.doc_id for r in got) == (Counter({1: 1, None: 1}) if data else Counter())
