"""Quality classifier: Bradley-Terry pairwise ranking (operator 6).

Preference pairs (a document labelled 1 over one labelled 0) are fitted by
logistic loss on the difference of their features; the utility of a document is
the dot product of the weights with its features.  The accept threshold is a
quantile of the utilities of the training documents, and the reported score is
a logistic curve through 0.7 at that threshold.

Features are shares of character classes and of repeated words of the whole
text, by DataFrame functions, so scoring is one narrow pass.  Only the training
table is gathered: at most ``SAMPLE`` labelled rows (those with the smallest
hash of the id) of a dozen doubles, whatever the size of the corpus.

Defined results: null text = empty; empty texts are scored as any other (all
shares 0); repeated rows get equal scores; labels for unknown ids or with a
null label are not used; a null id is never used for training and is not held
out; with labels of one class only, all utilities are 0 and all documents get
that class, and without labels all are accepted; an empty table gives an empty result; columns of
the input are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import BLANKS, count_chars, fresh, id_remainder, read_table, whole_text, words_of
from ampere.llm.registry import query

SAMPLE = 20_000        # most labelled rows that a model is fitted on
PAIRS = 200_000        # most preference pairs drawn from them
ACCEPT = 0.7           # score at the accept threshold
FEATURES = ("symbols", "shouts", "bars", "upper", "digits", "points", "variety", "log_words", "word_length",
            "lines")


def quality_features(text: Column) -> Column:
    """Struct of the features of a non-null text; shares enter by their square root."""
    w = words_of(text)
    nw = F.size(w)
    ink = F.greatest(F.length(F.translate(text, BLANKS, "")), F.lit(1))
    share = lambda n: F.sqrt(n / ink)
    parts = {
        "symbols": share(count_chars(text, "#*$%&<>")),
        "shouts": share(count_chars(text, "!")),
        "bars": share(count_chars(text, "|")),
        "upper": share(F.regexp_count(text, F.lit("\\p{Lu}"))),
        "digits": share(count_chars(text, "0123456789")),
        "points": share(count_chars(text, ".,;:?")),
        # distinct words against what a text of that length has by Heaps' law
        "variety": F.when(nw > 0, F.least(
            F.lit(2.0), F.size(F.array_distinct(w)) / F.pow(F.greatest(nw, F.lit(1)), 0.85))).otherwise(F.lit(1.0)),
        "log_words": F.log1p(nw.cast("double")) / 10,
        "word_length": F.least(F.lit(3.0), ink / F.greatest(nw, F.lit(1)) / 10),
        "lines": F.sqrt(count_chars(text, "\n") / F.greatest(nw, F.lit(1))),
    }
    return F.struct(*[parts[n].cast("double").alias(n) for n in FEATURES])


@dataclass(frozen=True)
class Ranker:
    weights: tuple[float, ...]
    threshold: float
    scale: float

    def utility(self, f: Column) -> Column:
        return sum((f[n] * w for n, w in zip(FEATURES, self.weights)), F.lit(0.0))

    def score(self, f: Column) -> Column:
        z = (self.utility(f) - self.threshold) / self.scale + float(np.log(ACCEPT / (1 - ACCEPT)))
        return F.lit(1.0) / (1 + F.exp(-F.greatest(F.lit(-500.0), z)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3) -> Ranker:
    """Bradley-Terry weights by Newton steps on drawn pairs, then the quantile threshold."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker((0.0,) * len(FEATURES), 1.0 if len(bad) else -1.0, 1.0)
    rng = np.random.default_rng(7)
    n = min(pairs, max(20_000, 20 * len(y)))
    d = x[rng.choice(good, n)] - x[rng.choice(bad, n)]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))          # chance that the pair is ranked wrongly
        grad = -(d * p[:, None]).mean(0) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / n + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.linalg.norm(step) / 5)
        if np.abs(step).max() < 1e-7:
            break
    u = x @ w
    # the quantile near the share of rejected labels that errs least, each class weighing the same
    levels = np.clip(len(bad) / len(y) * np.linspace(0.5, 1.5, 101), 0, 1)
    cuts = np.unique(np.quantile(u, levels, method="midpoint"))
    err = [(u[good] < c).mean() + (u[bad] >= c).mean() for c in cuts]
    best = np.flatnonzero(np.isclose(err, min(err)))
    cut = float(cuts[best[len(best) // 2]])
    return Ranker(tuple(map(float, w)), cut, max(1e-6, float(np.std(u)) / 4))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          sample: int = SAMPLE) -> Ranker:
    """Fit on the labelled rows with the smallest hash of the id, ``sample`` at most."""
    marks = (labels.where("quality is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("_y"))
             .withColumn("_k", F.xxhash64("doc_id")).orderBy("_k", "doc_id").limit(sample)
             .select(F.col("doc_id").alias("_id"), "_y"))
    rows = (docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_t"))
            .join(F.broadcast(marks), F.col("_doc") == F.col("_id"))     # at most `sample` rows
            .groupBy("_id").agg(F.first("_y").alias("_y"), F.min(quality_features(whole_text(F.col("_t")))).alias("_f"))
            .select("_y", "_f.*").toPandas())
    return fit(rows[list(FEATURES)].to_numpy(float), rows["_y"].to_numpy())


def with_quality(docs: DataFrame, model: Ranker, out: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``out``: the score of the whole text."""
    t, f = fresh(docs, "_t", "_f")
    return (docs.withColumn(t, whole_text(F.col(text))).withColumn(f, quality_features(F.col(t)))
            .withColumn(out, model.score(F.col(f))).drop(t, f))


def learnable(df: DataFrame) -> DataFrame:
    """The labels that may be learnt from: crc32 of the id modulo 4 is not 2."""
    return df.where(id_remainder(F.col("doc_id"), 4) != 2)


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a pairwise ranker."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, learnable(read_table(spark, sf_dir, "labels")))
    return with_quality(docs, model, "score").select(
        "doc_id", F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
