"""HTML extraction by host suffix arrays (operator 4).

The token streams of a host's pages are concatenated (a separator after each),
a suffix array with longest common prefixes is built over them, and every token
inside a substring of at least ``MIN_RUN`` tokens that occurs on two distinct
pages of the host is covered: boilerplate.  A page's text is then its blocks in
page order without the dropped zones and the covered blocks; what lies in an
article or main element is protected, since passages that pages share inside
their articles are text, not template.

Hosts are dealt into bundles of about ``BUNDLE`` tokens, so a host of any size
has bounded groups.  Runs that repeat only between bundles are found by merging
the bundles' suffixes on their first ``MIN_RUN`` tokens (a grouped count over
the suffixes that their own bundle does not cover, plus one of each covered
kind), so the result is that of one suffix array over the whole host.

Streams, not pages, are shuffled to the bundles; the page itself moves once, to
meet its coverage.

Defined results: null html = empty text; null or odd urls share the host '';
rows repeated exactly are one page and give equal rows; a null page_id is kept;
blocks that neither an article nor a named part of the page holds, beside an
article too, stay unless at least half of their tokens are covered; ties cannot
arise; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import read_table
from ampere.llm.html_parse import KEPT, OPEN, Page, parse
from ampere.llm.registry import query
from ampere.session import materialize

MIN_RUN = 8           # tokens of the shortest run that counts as repeated
BUNDLE = 400_000      # tokens of a suffix array, on average
SALTS = 64            # tasks in which a host's streams learn its number of bundles
COVERED = 0.5         # share of covered tokens from which an open block is boilerplate


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of an integer sequence and the common prefix of each suffix with the one before it.

    Prefix doubling; the ranks of every round give the common prefixes without another sort."""
    n = len(s)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64) + 1
    levels, width = [rank], 1
    order = np.argsort(rank, kind="stable")
    while width < n and rank[order[-1]] < n:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([True], key[order][1:] != key[order][:-1])))
        rank, width = new, 2 * width
        levels.append(rank)
    lcp = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        r = np.append(levels[level], 0)
        ia, ib = np.minimum(a, n), np.minimum(b, n)
        same = (r[ia] == r[ib]) & (ia < n) & (ib < n)
        step = same * (1 << level)
        common, a, b = common + step, a + step, b + step
    lcp[1:] = common
    return order, lcp


def repeated(streams: list[np.ndarray], min_run: int = MIN_RUN):
    """Over the concatenated streams: the positions, their page, which of them start a run of
    ``min_run`` tokens that another page has too, and the group of equal runs each belongs to."""
    joined = []
    for k, s in enumerate(streams):
        s = s.copy()
        breaks = np.flatnonzero(s < 0)
        s[breaks] = -2 - breaks - (k << 32)          # separators equal nothing
        joined += [s, np.array([-1 - (1 << 62) - k])]
    text = np.concatenate(joined) if joined else np.empty(0, np.int64)
    page = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    order, lcp = suffix_array(text)
    group = np.cumsum(lcp < min_run) - 1             # neighbours with a long common prefix
    owner = page[order]
    n = int(group[-1]) + 1 if len(group) else 0
    low, high = np.full(n, len(streams)), np.full(n, -1)
    np.minimum.at(low, group, owner)
    np.maximum.at(high, group, owner)
    starts = np.zeros(len(text), bool)
    starts[order] = (low < high)[group]
    at = np.empty(len(text), np.int64)
    at[order] = group
    return text, page, starts, at


def run_hashes(text: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of the ``min_run`` tokens from each position, and whether they hold no separator."""
    n = len(text)
    if n < min_run:
        return np.zeros(n, np.int64), np.zeros(n, bool)
    h, clean = np.zeros(n - min_run + 1, np.uint64), np.ones(n - min_run + 1, bool)
    for k in range(min_run):
        part = text[k:n - min_run + 1 + k]
        h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        clean &= part >= 0
    pad = np.zeros(min_run - 1, np.int64)
    return np.concatenate((h.view(np.int64), pad)), np.concatenate((clean, pad.astype(bool)))


def streams_of(pages: DataFrame) -> DataFrame:
    """page_id, h (hash of url and html), host, tokens (int32 numbers), n."""
    host = F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select("page_id", F.xxhash64("url", "html").alias("h"),
                        F.coalesce(host, F.lit("")).alias("host"), "html")

    def run(batches):
        for b in batches:
            got = [np.array(parse(x).stream, np.int32) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([g.tobytes() for g in got], pa.binary()),
                 pa.array([len(g) for g in got], pa.int64())], names=["page_id", "h", "host", "tokens", "n"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, h bigint, host string, tokens binary, n bigint")


def coverage(streams: DataFrame, min_run: int = MIN_RUN, bundle: int = BUNDLE) -> DataFrame:
    """page_id, h, bits: which tokens of the page's stream are covered (packed, first token first).

    ``streams`` is read twice: give a written table without repeated pages."""
    sizes = streams.groupBy("host").agg(F.ceil(F.sum("n") / F.lit(float(bundle))).cast("int").alias("bundles"))
    # always a shuffle join, as the hosts may not fit a broadcast; sizes go to each of a host's salts
    salt = F.pmod(F.xxhash64("h", "page_id"), F.lit(SALTS)).cast("int")
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = (streams.withColumn("salt", salt).join(sizes.hint("merge"), ["host", "salt"]).drop("salt")
             .withColumn("bundle", F.pmod(F.xxhash64("page_id", "h"), F.greatest("bundles", F.lit(1))).cast("int")))
    kind = streams.schema["page_id"].dataType.simpleString()

    def run(t: pa.Table) -> pa.Table:
        streams = [np.frombuffer(x, np.int32).astype(np.int64) for x in t["tokens"].to_pylist()]
        text, page, starts, group = repeated(streams, min_run)
        first = np.concatenate(([0], np.cumsum([len(s) + 1 for s in streams])))
        bits = [np.packbits(spread(starts[first[k]:first[k + 1] - 1], min_run)).tobytes()
                for k in range(len(streams))]
        n = len(streams)
        out = {"page_id": t["page_id"].combine_chunks(), "h": t["h"].combine_chunks(), "bits": pa.array(bits, pa.binary()),
               "prefix": pa.nulls(n, pa.int64()), "pos": pa.nulls(n, pa.int64())}
        if t["bundles"][0].as_py() > 1:              # what the other bundles of the host may repeat
            hashes, clean = run_hashes(text, min_run)
            lone = np.flatnonzero(clean & ~starts)
            once = np.flatnonzero(clean & starts)
            once = once[np.unique(group[once], return_index=True)[1]]
            at = np.concatenate((lone, once))
            who = pa.array(page[at])
            more = {"page_id": out["page_id"].take(who), "h": out["h"].take(who),
                    "bits": pa.nulls(len(at), pa.binary()), "prefix": pa.array(hashes[at]),
                    "pos": pa.array(np.concatenate((lone - first[page[lone]], np.full(len(once), -1))))}
            out = {k: pa.concat_arrays([out[k], more[k]]) for k in out}
        size = len(out["h"])
        return pa.table({"host": pa.repeat(t["host"][0], size), "bundle": pa.repeat(t["bundle"][0], size), **out})

    # dealt anew by bundle: the join has left all bundles of a host in one partition
    found = materialize(dealt.repartition("host", "bundle").groupBy("host", "bundle").applyInArrow(
        run, f"host string, bundle int, page_id {kind}, h bigint, bits binary, prefix bigint, pos bigint"),
        "op4-runs")
    suffixes = found.where("prefix is not null")
    between = (suffixes.groupBy("host", "prefix")
               .agg(F.min("bundle").alias("a"), F.max("bundle").alias("b")).where("a < b").select("host", "prefix"))
    late = (suffixes.where("pos >= 0").join(between, ["host", "prefix"])
            .groupBy("page_id", "h").agg(F.array_agg("pos").alias("more")))
    own = found.where("prefix is null").select("page_id", "h", "bits")
    l = late.select(F.col("page_id").alias("p2"), F.col("h").alias("h2"), "more")
    return own.join(l, F.col("page_id").eqNullSafe(F.col("p2")) & (F.col("h") == F.col("h2")), "left").select(
        "page_id", "h", "bits", "more")


def spread(starts: np.ndarray, min_run: int) -> np.ndarray:
    """Tokens inside a run that starts at a marked position."""
    n = len(starts)
    edge = np.zeros(n + min_run + 1, np.int64)
    edge[:n] += starts
    edge[min_run:min_run + n] -= starts
    return np.cumsum(edge)[:n] > 0


def main_text(page: Page, covered: np.ndarray, share: float = COVERED) -> str:
    """The page's blocks without dropped zones and covered blocks."""
    out = []
    for zone, text, lo, hi in page.blocks:
        if zone == KEPT or (zone == OPEN and covered[lo:hi].sum() < share * max(1, hi - lo)):
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame, min_run: int = MIN_RUN, bundle: int = BUNDLE, share: float = COVERED) -> DataFrame:
    """page_id, url, text, frame_tokens (tokens outside articles), covered_tokens of every page."""
    pages = pages.select("page_id", "url", "html")
    streams = materialize(streams_of(pages), "op4-streams")
    if streams.groupBy("page_id", "h").count().where("count > 1").take(1):
        streams = streams.dropDuplicates(["page_id", "h"])
    cover = coverage(streams, min_run, bundle).select(F.col("page_id").alias("p"), F.col("h").alias("k"), "bits", "more")
    keyed = pages.withColumn("h", F.xxhash64("url", "html"))
    both = (keyed.join(cover, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("h") == F.col("k")))
            .select("page_id", "url", "html", "bits", "more"))

    def run(batches):
        for b in batches:
            texts, sizes, counts = [], [], []
            for html, bits, more in zip(*(b.column(k).to_pylist() for k in (2, 3, 4))):
                covered = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
                if more:
                    late = np.zeros(len(covered), bool)
                    late[more] = True
                    covered |= spread(late, min_run)
                page = parse(html)
                texts.append(main_text(page, covered, share))
                sizes.append(len(page.stream))
                counts.append(int(covered.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["page_id", "url", "text", "frame_tokens", "covered_tokens"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return both.mapInArrow(
        run, f"page_id {kind}, url string, text string, frame_tokens bigint, covered_tokens bigint")


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                        "frame_tokens", "covered_tokens")
