"""Quality rules: hashed n-gram log-likelihood ratio (operator 9, native).

Every document gets counts of words, symbols, repeated lines and repeated
three-word windows, and the mean over its hashed n-grams (words and word
pairs) of log p_target(bucket) / p_raw(bucket).  The raw multinomial is
counted over every document, the target over all trusted ones (good label).  A
document is kept when no base rule fails and its length-normalised ratio
reaches a threshold that is computed from the two tables: trusted documents of
at least ``MIN_WORDS`` words are scored without their own counts in the target,
as if they were not labelled, and the threshold lies ``REACH`` times as far
below the median of these ratios as their ``LOW`` quantile does (in
thousandths of a nat, so it is exact and counted in a small table).  How far
clean documents outside the target score below those in it depends on the size
of the corpus; the threshold moves along.  The ratio in the result is the plain
one, also of a trusted document.

Plan: one pass counts every document; another finds the trusted texts and
writes their bucket numbers, which give the target's counts and then the ratios
for the threshold.  The trusted ids are broadcast if they are ``PART_BYTES`` at
most; more of them meet the texts in one shuffle join, where Spark's runtime
Bloom filter (bounded by its own settings) may keep texts of other ids out of
the shuffle.  So the number of passes is the same at every size.  Counts are
map-side combined (at most ``buckets`` rows a task are shuffled).  The table of
ratios is one array of ``buckets`` doubles (bounded by the parameter, not by the
data), and one narrow pass scores.
DataFrame functions only; nothing is grouped by source, and only the join of
many trusted ids deals rows by document, so a hot source makes no hot task.

Defined results: null text = no words; a text without words has ratio 0.0 and
fails the base rule; repeated rows count each time and get the same verdict;
without trusted documents, or without words in them, every ratio is 0; without
a trusted document of ``MIN_WORDS`` words no ratio is too low; an empty table
gives an empty result; columns of the input are kept, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import BLANKS, fresh, read_table, whole_text, words_of
from ampere.llm.registry import query
from ampere.session import materialize

SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14      # size of the hashed n-gram space
PRIOR = 1.0            # pseudo-count of every bucket
PART_BYTES = 16 << 20  # trusted ids broadcast at most, as text and 16 bytes each
LOW = 0.01             # quantile of the trusted documents' ratios, each without its own counts
REACH = 1.5            # threshold: so many times the distance from the median to that quantile
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


def _buckets(words: Column, buckets: int) -> Column:
    """Bucket numbers of the words and of the word pairs of a text."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.transform(words, lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(one, _windows_only(two, words, 2))


def _window_hashes(words: Column, width: int) -> Column:
    return _windows_only(F.transform(
        words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)])), words, width)


def _windows_only(values: Column, words: Column, width: int) -> Column:
    """What was computed at the starts of whole windows: the last ``width`` - 1 words start none."""
    return F.slice(values, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))


def with_rule_counts(docs: DataFrame, out: str, text: str = "text", width: int = 3,
                     words: str | None = None) -> DataFrame:
    """``docs`` plus a struct ``out``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    ``words`` names a column with the words of the text, if there is one."""
    t, w, h, s, p, q = fresh(docs, "_t", "_w", "_h", "_s", "_p", "_q")
    # a column of their own, as they are counted twice
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: F.rlike(x, F.lit(f"[^{BLANKS}]")))
    # positions of windows whose hash occurs again: sorted by hash, a neighbour is equal
    at = F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    again = F.filter(F.col(s), lambda x, j: (
        (F.get(F.col(s), j - 1)["h"] == x["h"]) | (F.get(F.col(s), j + 1)["h"] == x["h"])))
    pos = F.sort_array(F.transform(again, lambda x: x["i"]))
    # words covered by the union of these windows
    covered = F.aggregate(
        F.transform(F.col(p), lambda x, j: F.when(
            j > 0, F.least(F.lit(width), x - F.get(F.col(p), j - 1))).otherwise(F.lit(width))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    none = F.array().cast("array<int>")
    return (
        docs.withColumn(t, whole_text(F.col(text)))
        .withColumn(w, words_of(F.col(t)) if words is None else F.col(words))
        .withColumn(h, _window_hashes(F.col(w), width))
        .withColumn(q, lines)
        .withColumn(s, F.when(F.size(F.array_distinct(F.col(h))) < F.size(F.col(h)), F.sort_array(at)))
        .withColumn(p, F.when(F.col(s).isNull(), none).otherwise(pos))
        .withColumn(out, F.struct(
            F.size(F.col(w)).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            (F.size(q) - F.size(F.array_distinct(q))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words")))
        .drop(t, w, h, s, p, q))


def _trusted_words(docs: DataFrame, trusted: DataFrame, text: str, doc_id: str, part: int) -> DataFrame:
    """_w: the words of every row of ``docs`` whose id is one of ``trusted`` (first column)."""
    ids = trusted.select(trusted[trusted.columns[0]].alias("_tid")).where("_tid is not null")
    size = ids.agg(F.sum(F.octet_length(F.col("_tid").cast("string")) + 16)).first()[0] or 0
    return (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
            .join(ids.hint("broadcast" if size <= part else "merge"), F.col("_id") == F.col("_tid"), "left_semi")
            .select(words_of(whole_text(F.col("_t"))).alias("_w")))


def ratio_table(docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id",
                buckets: int = BUCKETS, prior: float = PRIOR, part: int = PART_BYTES) -> DataFrame:
    """One row: ``llr``, log p_target / p_raw of every bucket, and ``threshold``.

    ``trusted`` holds the ids (first column) of the target documents; they are
    broadcast up to ``part`` bytes."""
    # the words are a column of their own: inside a lambda an expression runs once per element
    words = docs.select(words_of(whole_text(F.col(text))).alias("_w"))
    none = F.lit(0).cast("long")
    raw_counts = (words.select(F.explode(_buckets(F.col("_w"), buckets)).alias("_b"))
                  .groupBy("_b").agg(F.count(F.lit(1)).alias("raw"), none.alias("target")))
    own = materialize(_trusted_words(docs, trusted, text, doc_id, part).select(
        F.size("_w").alias("_n"), F.sort_array(_buckets(F.col("_w"), buckets)).alias("_s")), "op9-target")
    target_counts = (own.select(F.explode("_s").alias("_b"))
                     .groupBy("_b").agg(none.alias("raw"), F.count(F.lit(1)).alias("target")))
    # buckets that no document has
    rest = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_b"), none.alias("raw"), none.alias("target"))
    both = (raw_counts.unionAll(target_counts).unionAll(rest)
            .groupBy("_b").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    arr = F.sort_array(F.array_agg(F.struct("_b", "raw", "target")))
    packed = materialize(both.agg(arr.alias("a"), F.sum("raw").alias("nr"), F.sum("target").alias("nt")), "op9-packed")
    mass = F.lit(prior * buckets)
    raw = F.transform("a", lambda x: F.log((x["raw"] + prior) / (F.col("nr") + mass)))
    tables = materialize(packed.select(raw.alias("raw"), F.transform("a", lambda x: x["target"]).alias("target"), "nt"),
                         "op9-tables")
    ratios = _without_own(own, tables, buckets, prior).groupBy("_bin").count()
    found = ratios.agg(F.percentile("_bin", F.array(F.lit(LOW), F.lit(0.5)), F.col("count")).alias("q")).select(
        F.coalesce((F.col("q")[1] - REACH * (F.col("q")[1] - F.col("q")[0])) / 1000, F.lit(float("-inf"))).alias("t"))
    return packed.select(F.transform("a", lambda x: F.when(F.col("nt") == 0, F.lit(0.0)).otherwise(F.log(
        ((x["target"] + prior) / (F.col("nt") + mass)) / ((x["raw"] + prior) / (F.col("nr") + mass))))
    ).alias("llr"), found.scalar().alias("threshold"))


def _without_own(trusted: DataFrame, tables: DataFrame, buckets: int, prior: float) -> DataFrame:
    """_bin: the mean log ratio of each text of the target (_n words, _s: its sorted bucket numbers), its
    own counts taken out of the target, in thousandths and rounded down; null below ``MIN_WORDS`` words."""
    zero = F.struct(F.lit(-1).alias("b"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"))

    # each table is named once: a column named twice would be copied into every row
    def closed(acc: Column) -> Column:
        """The sum with the run of equal buckets that ends here."""
        of = F.log(F.get(F.col("_target"), acc["b"]) - acc["n"] + F.lit(prior)) - F.get(F.col("_raw"), acc["b"])
        return F.when(acc["n"] > 0, acc["sum"] + acc["n"] * of).otherwise(F.lit(0.0))

    def step(acc: Column, x: Column) -> Column:
        same = acc["b"] == x
        return F.struct(x.alias("b"), F.when(same, acc["n"] + 1).otherwise(F.lit(1)).alias("n"),
                        F.when(same, acc["sum"]).otherwise(closed(acc)).alias("sum"))

    size = F.size("_s")
    total = F.aggregate(F.concat(F.col("_s"), F.array(F.lit(-1))), zero, step, lambda acc: acc["sum"])
    mean = total / size - F.log((F.col("_nt") - size + F.lit(prior * buckets)).cast("double"))
    return (trusted.select("_n", "_s", *[tables.select(c).scalar().alias(f"_{c}") for c in ("target", "raw", "nt")])
            .select(F.when(F.col("_n") >= MIN_WORDS, F.floor(mean * 1000).cast("int")).alias("_bin")))


def with_ratio(docs: DataFrame, table: DataFrame, out: str, text: str = "text",
               buckets: int = BUCKETS, words: str | None = None) -> DataFrame:
    """``docs`` plus ``out``: the mean log ratio of a text's n-grams (0.0 without any); ``words`` as above."""
    w, g, m = fresh(docs, "_w", "_g", "_m")
    total = F.aggregate(F.col(g), F.lit(0.0), lambda acc, b: acc + F.get(F.col(m), b))
    return (
        docs.withColumn(w, words_of(whole_text(F.col(text))) if words is None else F.col(words))
        .withColumn(g, _buckets(F.col(w), buckets))
        .withColumn(m, table.select("llr").scalar())
        .withColumn(out, F.when(F.size(F.col(g)) > 0, total / F.size(F.col(g))).otherwise(F.lit(0.0)))
        .drop(w, g, m))


def judge(docs: DataFrame, table: DataFrame, out: str, text: str = "text",
          buckets: int = BUCKETS, threshold: float | None = None) -> DataFrame:
    """``docs`` plus a struct ``out``: the counts, llr, base_failed and kept (by the table's threshold if none is given)."""
    least = table.select("threshold").scalar() if threshold is None else F.lit(threshold)
    c, r, w = fresh(docs, "_counts", "_ratio", "_words")
    split = docs.withColumn(w, words_of(whole_text(F.col(text))))
    df = with_ratio(with_rule_counts(split, c, text, words=w), table, r, text, buckets, words=w).drop(w)
    bad = ((F.col(c)["n_words"] < MIN_WORDS)
           | (100 * F.col(c)["n_repeat_words"] > MAX_REPEAT_PCT * F.col(c)["n_words"]))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return df.withColumn(out, F.struct(
        *[F.col(c)[n].alias(n) for n in names], F.col(r).alias("llr"), bad.alias("base_failed"),
        (~bad & (F.col(r) >= least)).alias("kept"))).drop(c, r)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that ``labels`` marks as good quality."""
    return labels.where("quality = 1").select("doc_id")


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts, n-gram ratio and verdict of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    table = materialize(ratio_table(docs, trusted_ids(read_table(spark, sf_dir, "labels"))), "op9-ratios")
    return judge(docs, table, "v").select(
        "doc_id", "v.n_words", "v.word_chars", "v.n_symbols", "v.n_dup_lines", "v.n_repeat_words",
        "v.base_failed", "v.kept", "v.llr")
