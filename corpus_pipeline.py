"""A corpus pipeline over ``documents``: quality ranker, quality rules, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it
kept, and returns a DataFrame that is written as Parquet and read again for the
next one.  All but the last return the columns of documents; the last returns
the pieces of the packed sequences (doc_id, start, length, ids_crc32,
doc_tokens, sequence_id, offset).

* quality_classifier: documents whose score is below 0.7 go.  The ranker learns
  from the labels of a bounded sample of rows.
* quality_rules: documents go that fail a base rule or whose n-gram ratio is
  below the threshold.  The raw corpus is what the stage is given.
* jaccard_join: of each component of near duplicates the smallest doc_id stays.
  Near is a similarity of 0.8 or more over five-word shingles (op8's own query
  takes four words and 0.85).
* packing: the rest is packed into sequences of at most 4096 tokens.

Null texts count as empty (they fail the base rules); rows without an id link
with nothing and stay; rows repeated exactly are one document after the third
stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm import jaccard_join, packing, quality_classifier, quality_rules
from ampere.llm.common import fresh, keep_rows, read_table
from ampere.session import configure, materialize


def rank_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the pairwise ranker rejects."""
    configure(spark)
    labels = quality_classifier.learnable(read_table(spark, sf_dir, "labels"))
    model = quality_classifier.train(docs, labels)
    score, = fresh(docs, "_score")
    ranked = quality_classifier.with_quality(docs, model, score)
    return keep_rows(ranked, F.col(score) >= quality_classifier.ACCEPT).drop(score)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality rules reject."""
    configure(spark)
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    table = materialize(quality_rules.ratio_table(docs, trusted), "pipeline-ratios")
    verdict, = fresh(docs, "_verdict")
    judged = quality_rules.judge(docs, table, verdict)
    return keep_rows(judged, F.col(verdict)["kept"]).drop(verdict)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component."""
    configure(spark)
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left."""
    configure(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", rank_quality),
    ("quality_rules", apply_rules),
    ("jaccard_join", drop_near_duplicates),
    ("packing", pack),
]

#: Hashing, fitting and tokenizing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
