"""Language ID by compression (operator 1).

A language is a zstandard raw-content dictionary: a bounded sample of training
texts of that language.  A text is normalised (lower case, ASCII signs and
digits to spaces), cut into windows so that the dictionary counts all along a
long text, and each window is compressed with every dictionary; the language
with the smallest total wins.  When the margin to the second is narrow the
prediction is marked as rejected.

Training gathers at most ``PER_LANGUAGE`` texts a language, all different (those
with the smallest hash of text), ``SAMPLE_CHARS`` characters of each at most: a
longer text trains by a window of it.  Limited windows over the distinct hashes
choose them, so each task sends no more than that and the hashes.  With more
than 200 languages each gets fewer texts (``ALL_TEXTS`` in all, one at least), so
any number is learnt.  Prediction is one narrow pass over the whole texts.

Defined results: null texts and texts without a letter are `und` with score
0.0 and rejected; ties go to the language that sorts first; texts shared by
two languages train both; null languages do not train; without any training
text every text is `und`; repeated rows are predicted each; an empty table
gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampere.llm.common import id_remainder, read_table, schema_plus
from ampere.llm.registry import query
from ampere.session import materialize

PER_LANGUAGE = 60         # training texts a language at most
SAMPLE_CHARS = 4_000      # characters of a text that train at most: a window of longer ones
ALL_TEXTS = 12_000        # training texts of all languages at most, but one a language
SALTS = 32                # parts of a language's hashes that are limited first
LEVEL = 5
SPAN = 1_024              # bytes compressed at once
MARGIN = 0.02             # of the smallest size: narrower is rejected
_SIGNS = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def normal(text: str) -> bytes:
    """Lower case, signs and digits to spaces, runs of spaces to one."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_SIGNS).split())


def train(rows: DataFrame, text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionaries by language from (text, lang) rows."""
    df = (rows.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"))
          .where("l is not null and t is not null")
          .where(F.col("t").rlike("\\p{L}")).withColumn("k", F.xxhash64("t")))
    keys = df.select("l", "k").distinct()
    # the limit is applied in each task before the exchange, and among salts before a language's one task
    salted = Window.partitionBy("l", F.pmod("k", F.lit(SALTS))).orderBy("k")
    keys = materialize(keys.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= per_language),
                       "op1-keys").drop("r")
    languages = keys.agg(F.count_distinct("l")).first()[0]
    each = max(1, min(per_language, ALL_TEXTS // max(1, languages)))
    keys = (keys.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("k")))
            .where(F.col("r") <= each))
    # a long text trains by a window whose place its hash tells
    room = F.greatest(F.length("t") - F.lit(sample_chars), F.lit(0)) + 1
    window = F.substring("t", (F.pmod("k", room.cast("long")) + 1).cast("int"), F.lit(sample_chars))
    # texts meet the few hashes chosen; copies are combined in each task, so no other text is shuffled
    chosen = (df.join(F.broadcast(keys), ["l", "k"]).select("l", "r", window.alias("t"))
              .groupBy("l", "r").agg(F.min("t").alias("t"))
              .orderBy("l", F.col("r").desc()).select("l", "t").collect())
    found: dict[str, list[bytes]] = {}
    for r in chosen:
        found.setdefault(r["l"], []).append(normal(r["t"]))
    return {name: b" ".join(texts) for name, texts in found.items()}


@functools.lru_cache(maxsize=2)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]):
    import zstandard as z
    out = []
    for name, raw in dictionaries:
        d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append((name, z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                           write_content_size=False, write_dict_id=False)))
    return out


def classify(text: str | None, compressors, span: int = SPAN) -> tuple[str, float, float]:
    """Language, score and relative margin of one text."""
    if not text or not compressors or not any(map(str.isalpha, text)):
        return "und", 0.0, 0.0
    raw = normal(text) or text.encode("utf-8", "replace")
    parts = [raw[k:k + span] for k in range(0, len(raw), span)]
    sizes = sorted((sum(len(c.compress(p)) for p in parts), name) for name, c in compressors)
    best = sizes[0][0]
    # odds of 2 to the power of an eighth of the difference in bits
    score = 1 / sum(2.0 ** -min(500, s - best) for s, _ in sizes)
    margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
    return sizes[0][1], score if math.isfinite(score) else 0.0, margin


def with_language(docs: DataFrame, dictionaries: dict[str, bytes], out: str = "language",
                  text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` plus a struct ``out``: lang, score, rejected."""
    table = tuple(sorted(dictionaries.items()))
    fields = [f.name for f in docs.schema]

    def run(batches):
        compressors = _compressors(table)
        for b in batches:
            found = [classify(t, compressors) for t in b.column(fields.index(text)).to_pylist()]
            col = pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] < margin for f in found], pa.bool_())], names=["lang", "score", "rejected"])
            yield pa.RecordBatch.from_arrays([*b.columns, col], names=[*fields, out])

    return docs.mapInArrow(run, schema_plus(docs, out, "struct<lang:string,score:double,rejected:boolean>"))


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from four fifths of them."""
    docs = read_table(spark, sf_dir, "documents")
    held = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    learn = docs.where(id_remainder(F.col("doc_id"), 5) != 0).select("text", "lang")
    df = with_language(docs.select("doc_id", "text"), train(learn))
    return df.select("doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                     F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))
