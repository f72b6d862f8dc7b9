"""Source divergence audit: exact term divergence of the sources of each language (operator 13).

Tokens come from a translate table: ``bytes.translate`` lowers A-Z and turns all
other ASCII bytes but letters to blanks in one pass over a text's UTF-8,
``bytes.split`` cuts it, and a Counter a document gives occurrences and the
document's share of document frequencies.  A task adds these up by (language,
source, term) in a table of bounded size, sent on whenever it is full, so no text
is shuffled and a hot source or term arrives as one row a task.

The rest is sparse aggregation on Spark: terms in enough documents of a language
are kept; only counts above zero are stored.  With p = 1 + floor(unit * (count + 2)
/ (N + 2V)) and f(p, q) = floor((p - q)^2 / (p + q)), the divergence of two sources
over all V kept terms is put together from

* V f(p0, q0), p0 and q0 being the probabilities of a term that a source lacks;
* f(p, q0) - f(p0, q0) over the terms of either source; it depends on the count
  alone, so terms are grouped by count first;
* f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) over the terms that both have: an
  equi-join on (language, term) of the counts, each pair of sources once, summed
  by pair in the joining task.  A term has one row a source there, so its pairs
  are bounded by the pairs of sources, which are the result.

All arithmetic is exact: decimals for unit * count, longs after it.

Defined results: null text, language and source are ''; repeated rows count each;
a text without letters adds its group and no term; without kept terms (V = 0)
pairs have value 0 and q is whatever, and there are no term rows; ties in rank go
by the item's UTF-8 bytes; an empty table gives an empty result; other columns
are not read.  Texts are taken as bytes, so very long and malformed ones count.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampere.llm.common import read_table, whole_text
from ampere.llm.registry import query
from ampere.session import materialize

LEAST_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
HELD = 200_000          # (language, source, term) rows a task holds before it sends them

# lower case letters for A-Z, blanks for all other ASCII bytes but a-z; bytes above 127 stay
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_TABLE).split()


def partial_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents): rows to be added up.

    Every document also adds a row with a null term, so that each group occurs."""
    bare = docs.select(*[whole_text(F.col(c).cast("string")).cast("binary").alias(c)
                         for c in ("lang", "source", "text")])
    names = ["lang", "source", "term", "n", "d"]

    def sent(seen: dict, found: dict):
        for key in seen.keys():
            n, d = found.get(key, ({}, {}))
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * (size + 1), pa.binary()), pa.array([key[1]] * (size + 1), pa.binary()),
                 pa.array([*n, None], pa.binary()), pa.array([*n.values(), 0], pa.int64()),
                 pa.array([*map(d.__getitem__, n), seen[key]], pa.int64())], names=names)

    def run(batches):
        seen, found, size = Counter(), {}, 0
        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
                key = lang, source
                seen[key] += 1
                words = terms(text)
                if not words:
                    continue
                n, d = found.setdefault(key, (Counter(), Counter()))
                size -= len(n)
                n.update(words)
                d.update(Counter(words).keys())
                size += len(n)
                if size >= held:
                    yield from sent(seen, found)
                    seen, found, size = Counter(), {}, 0
        yield from sent(seen, found)

    counted = bare.mapInArrow(run, "lang binary, source binary, term binary, n bigint, d bigint")
    return counted.select(*[F.col(c).cast("string").alias(c) for c in names[:3]], "n", "d")


def share(count: Column, total: Column, kept: Column, unit: int = UNIT) -> Column:
    """1 + floor(unit * (count + 2) / (total + 2 kept)); 1 where nothing is kept."""
    over = (total + 2 * kept).cast("decimal(20,0)")
    up = F.lit(unit).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.when(kept > 0, 1 + F.call_function("div", up, over)).otherwise(F.lit(1)).cast("bigint")


def f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, unit: int = UNIT,
          held: int = HELD) -> DataFrame:
    """lang, source, part, item, value, rank of (lang, source, text) rows."""
    added = materialize(
        partial_counts(docs, held).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")),
        "divergence-counts")
    groups = added.where("term is null").select("lang", "source")
    by_lang = (added.where("term is not null").groupBy("lang", "term")
               .agg(F.sum("n").alias("lang_n"), F.sum("d").alias("d")).where(F.col("d") >= least).drop("d"))
    kept = materialize(by_lang, "divergence-kept")
    counts = materialize(added.where("term is not null").drop("d").join(kept, ["lang", "term"]), "divergence-kept-counts")

    # one row a language and one a group: kept terms, occurrences, and the share of an absent term
    langs = groups.select("lang").distinct().join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left")
    sizes = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    zero = F.lit(0).cast("bigint")
    sizes = materialize(sizes.join(langs, "lang").select(
        "lang", "source", F.coalesce("v", zero).alias("v"), F.coalesce("total", zero).alias("total"),
        F.coalesce("lang_total", zero).alias("lang_total"))
        .withColumn("p0", share(zero, F.col("total"), F.col("v"), unit)), "divergence-groups")

    rows = counts.join(sizes, ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("v"), unit),
        "q": share(F.col("lang_n"), F.col("lang_total"), F.col("v"), unit)})
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    numbered = F.row_number().over(best)
    of_terms = (rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                           f(F.col("p"), F.col("q")).alias("value"))
                .withColumn("rank", numbered).where(F.col("rank") <= top))

    g = sizes.select("lang", F.col("source").alias("a"), "v", F.col("p0").alias("a0"))
    h = sizes.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"))
    pairs = g.join(h, "lang").where("a < b")
    base = f(F.col("a0"), F.col("b0"))
    whole = pairs.select("lang", "a", "b", (F.col("v") * base).alias("x"))
    alike = rows.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    single = [pairs.join(alike.withColumnRenamed("source", mine), ["lang", mine]).select(
        "lang", "a", "b", (F.col("terms") * (f(F.col("p"), F.col(other)) - base)).alias("x"))
        for mine, other in (("a", "b0"), ("b", "a0"))]
    here = rows.select("lang", "term", F.col("source").alias("a"), "p", F.col("p0").alias("a0"))
    there = rows.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("p0").alias("b0"))
    p, q, a0, b0 = (F.col(c) for c in ("p", "q", "a0", "b0"))
    both = here.join(there, ["lang", "term"]).where("a < b").select(
        "lang", "a", "b", (f(p, q) - f(p, b0) - f(a0, q) + f(a0, b0)).alias("x"))
    parts = [whole, *single, both]
    sums = [x.groupBy("lang", "a", "b").agg(F.sum("x").alias("x")) for x in parts]   # each summed where it is made
    once = sums[0].unionAll(sums[1]).unionAll(sums[2]).unionAll(sums[3]).groupBy("lang", "a", "b").agg(
        F.sum("x").alias("value"))
    once = materialize(once, "divergence-pairs")
    of_pairs = (once.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
                .unionAll(once.select("lang", "b", F.lit("pair"), "a", "value"))
                .withColumn("rank", numbered))
    return of_pairs.unionAll(of_terms)


# Terms, counts and sums in DuckDB; HUGEINT arithmetic is exact.
SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents),
words AS (SELECT k, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT k) >= 10),
grp AS (
    SELECT g.lang, g.source, coalesce(l.v, 0)::HUGEINT AS v, coalesce(l.n, 0)::HUGEINT AS lang_total,
           coalesce(t.n, 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY lang) l USING (lang)
    LEFT JOIN (SELECT lang, source, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL) t
         USING (lang, source)),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
           1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (g.lang_total + 2 * g.v) AS q
    FROM grp g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
rows_ AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           coalesce(s.value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
               FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
         ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM rows_)
WHERE part = 'pair' OR rank <= 10
"""


@query("op13_source_divergence", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of sources of a language, and each source's most typical terms."""
    return audit(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))
