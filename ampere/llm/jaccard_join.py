"""N-gram Jaccard join by a token-group matrix (operator 8).

Documents with equal shingle sets are one class.  A class is known by its
prefix: its first |A| - ceil(t |A|) + 1 tokens in an order common to all.
Two sets of similarity at least t share a token of their prefixes, and with k
shared ones their overlap is at most k + ceil(t |A|) - 1, where A is the set
whose prefix ends first; so k is known to be large, about half a prefix, long
before any set is compared.

Classes are partitioned into groups of similar ones: each class is linked,
after an exact check, to the class it shares most prefix tokens with, and linked
classes form a group, cut into parts of about ``GROUP`` classes.  The token-group
matrix has, for each group, the union of its members' prefix tokens.  A class is
a query to the groups of other components that have one of its tokens early
enough (what two prefixes share lies at or after the first token they share).
The number of its prefix tokens in the group's union bounds the number it shares
with any member, and only groups where that number suffices are opened: their
members' tokens are counted one by one, and pairs that still may link are
compared exactly.

No link is lost: the bounds hold for every pair, and pairs inside one component
need no further link, since what is returned is the component.  The order puts
the tokens frequent in a sample of documents last.  It only decides how much
work there is, never a result; the list of frequent tokens is bounded by
``FREQUENT``.

At scale: prefix tokens (15 per cent of the shingles) are shuffled by token;
texts move twice, to meet the few classes whose sets are compared; components
are found by alternating stars.  Nothing is gathered on the driver but the
frequent tokens, and no group is handled as one: classes of copies collapse by
partial aggregation, hot groups are cut.

Defined results: null text = empty; texts without words are linked with
nothing and are their own component; a text of fewer than ``width`` words is one
shingle; rows that share an id but not the text are judged by their own text;
repeated rows each get the same result; a row with a null id has a null
component and links nothing; ties at the threshold link; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampere.llm.common import fresh, read_table
from ampere.llm.components import SALTS, components
from ampere.llm.registry import query
from ampere.llm.shingles import mix, shingle_sets
from ampere.session import materialize

WIDTH = 4
PERCENT = 85           # similarity that links, in hundredths
GROUP = 64             # classes in a group of the matrix, on average
SAMPLE_EVERY = 16      # one document in so many is looked at for frequent tokens
SEEN = 4               # times a token is seen there to count as frequent
FREQUENT = 1 << 18     # frequent tokens at most


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def frequent_tokens(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of the most frequent shingles of a sample of documents."""
    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column(0), width))
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["token"])

    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_EVERY)) == 0).select("text")
    top = (part.mapInArrow(run, "token bigint").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") >= SEEN).orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").toPandas())
    return np.sort(top["token"].to_numpy(np.int64).view(np.uint64))


def set_key(tokens: np.ndarray) -> bytes:
    """128 bits that stand for a set of tokens."""
    a = mix(tokens * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    b = mix(tokens + np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def sketches(docs: DataFrame, width: int, percent: int, late: np.ndarray) -> DataFrame:
    """doc_id, h, n (set size), cls (key of the set), prefix (its first tokens, those in ``late`` last),
    last (place of the last one of these in the order) of (doc_id, text, h) rows."""
    def run(batches):
        for b in batches:
            n, key, sizes, prefix, last = [], [], [], [], []
            for s in shingle_sets(b.column(1), width):
                n.append(len(s))
                key.append(set_key(s))
                k = prefix_length(len(s), percent) if len(s) else 0
                rare = np.ones(len(s), bool)
                if len(late) and k:
                    at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                    rare = late[at] != s
                    s = np.concatenate((s[rare][:k], s[~rare][:max(0, k - int(rare.sum()))]))
                prefix.append(s[:k])
                sizes.append(k)
                # upper half of the order for frequent tokens
                last.append((int(s[k - 1]) >> 1) - (1 << 63 if int(rare.sum()) >= k else 0) if k else 0)
            flat = np.concatenate(prefix) if prefix else np.empty(0, np.uint64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(key, pa.binary()), lists,
                 pa.array(last, pa.int64())], names=["doc_id", "h", "n", "cls", "prefix", "last"])

    return docs.mapInArrow(run, "doc_id bigint, h bigint, n bigint, cls binary, prefix array<bigint>, last bigint")


def token_sets(texts: DataFrame, width: int) -> DataFrame:
    """cid, tokens (sorted) of (cid, cls, text) rows; of rows whose id has several texts, that of the class."""
    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column(2), width))
            keep = [k for k, s in enumerate(sets) if set_key(s) == b.column(1)[k].as_py()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())),
                 pa.array([np.sort(sets[k].view(np.int64)) for k in keep], pa.list_(pa.int64()))], names=["cid", "tokens"])

    return texts.mapInArrow(run, "cid bigint, tokens array<bigint>")


def linking(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sorted token arrays s and t link."""
    def run(batches):
        for b in batches:
            keep = []
            for k in range(len(b)):
                s, t = b.column(2)[k].values.to_numpy(), b.column(3)[k].values.to_numpy()
                few, many = (s, t) if len(s) <= len(t) else (t, s)
                both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                if 100 * both >= percent * (len(s) + len(t) - both):
                    keep.append(k)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, by their whole sets."""
    pairs = materialize(pairs, "op8-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = classes.select("cid", "cls", "top").join(nodes, "cid", "left_semi")
    # always a sort-merge join: whether the ids would fit a broadcast depends on the corpus
    texts = (docs.where("doc_id is not null").select("doc_id", "text")
             .join(wanted.hint("merge"), F.col("doc_id") == F.col("top")).select("cid", "cls", "text"))
    sets = materialize(token_sets(texts, width).dropDuplicates(["cid"]), "op8-sets")
    one = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("s"))
    two = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("t"))
    return linking(pairs.join(one, "a").join(two, "b").select("a", "b", "s", "t"), percent)


def classes_of(sk: DataFrame) -> DataFrame:
    """One row a class: cid (its smallest document id where ids are not repeated), top, n, cls, prefix, last."""
    c = (sk.where("n > 0 and doc_id is not null").groupBy("cls")
         .agg(F.min("doc_id").alias("top"), F.min("n").alias("n"), F.min_by("prefix", "doc_id").alias("prefix"),
              F.min("last").alias("last")))
    c = materialize(c, "op8-classes")
    if c.groupBy("top").count().where("count > 1").take(1):     # one id with several texts
        c = materialize(c.repartitionByRange("top").sortWithinPartitions("top", "cls")
                        .withColumn("cid", F.monotonically_increasing_id()), "op8-numbered")
        return c
    return c.withColumn("cid", F.col("top"))


def _need(n: str, m: str, percent: int):
    """Overlap that sets of n and m tokens must have to link."""
    return F.ceil(percent * (F.col(n) + F.col(m)) / F.lit(100 + percent))


def _rest(n, percent: int):
    """Tokens of a set of n that its prefix does not hold."""
    return F.ceil(percent * n / F.lit(100)) - 1


def _may_link(n: str, m: str, last_n: str, last_m: str, shared: str, percent: int):
    """Whether sets of n and m tokens with that many shared prefix tokens can link."""
    rest = F.when(F.col(last_n) < F.col(last_m), _rest(F.col(n), percent)).when(
        F.col(last_n) > F.col(last_m), _rest(F.col(m), percent)).otherwise(
        _rest(F.greatest(n, m), percent))
    fits = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return fits & (F.col(shared) + rest >= _need(n, m, percent))


def _may_hold(n: str, least: str, most: str, shared, percent: int):
    """Whether a set of n tokens can link with some set of a group with sizes from least to most, in
    whose union it has that many prefix tokens.  What is needed is lowest at either end of the sizes
    that fit; one is taken off for rounding where they differ."""
    small = F.greatest(F.col(least), F.ceil(percent * F.col(n) / F.lit(100)))
    large = F.least(F.col(most), F.floor(100 * F.col(n) / F.lit(percent)))

    def needed(m):
        return (F.ceil(percent * (F.col(n) + m) / F.lit(100 + percent))
                - F.greatest(_rest(F.col(n), percent), _rest(m, percent)))
    off = F.when(small == large, F.lit(0)).otherwise(F.lit(1))
    return (small <= large) & (shared >= F.least(needed(small), needed(large)) - off)


def class_components(docs: DataFrame, sk: DataFrame, width: int, percent: int) -> DataFrame:
    """cls, component (smallest document id) of every class."""
    c = classes_of(sk)
    # left: prefix tokens after this one
    posting = c.select(F.posexplode("prefix").alias("pos", "token"), "cid", "n", "last", F.size("prefix").alias("p"))
    posting = posting.select("token", "cid", "n", "last", (F.col("p") - 1 - F.col("pos")).alias("left"))
    by_token = Window.partitionBy("token").orderBy("cid")
    whole = by_token.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = posting.select(
        "token", "cid", "n", "last", "left", F.first(F.struct("cid", "n", "last")).over(whole).alias("lead"),
        F.lead("cid").over(by_token).alias("after"))
    # tokens of one class only link nothing
    shared = materialize(shared.where("lead.cid <> cid or after is not null").drop("after"), "op8-shared")

    # groups of similar classes: each class and the earlier one it shares most prefix tokens with
    best = (shared.where("lead.cid <> cid").groupBy("cid", "lead")
            .agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"), F.min("last").alias("last"))
            .select("cid", "n", "last", "k", F.col("lead.cid").alias("b"), F.col("lead.n").alias("m"),
                    F.col("lead.last").alias("last_m"))
            .where(_may_link("n", "m", "last", "last_m", "k", percent))
            .groupBy("cid").agg(F.max_by("b", F.struct("k", -F.col("b"))).alias("b")))
    links = materialize(verified(best.select(F.col("cid").alias("a"), "b"), docs, c, width, percent), "op8-links")
    roots = components(links, "op8-groups")
    member = (shared.select("cid").distinct().join(roots, F.col("cid") == F.col("node"), "left")
              .select("cid", F.coalesce("root", "cid").alias("comp")))
    # counted and joined by (component, salt): the classes of a large component stay spread
    member = member.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int"))
    size = (member.groupBy("comp", "salt").agg(F.count(F.lit(1)).alias("k")).groupBy("comp")
            .agg(F.ceil(F.sum("k") / F.lit(GROUP)).cast("int").alias("parts"), F.collect_list("salt").alias("salts"))
            .select("comp", "parts", F.explode("salts").alias("salt")))
    member = materialize(member.join(size, ["comp", "salt"]).select(
        "cid", "comp", F.xxhash64("comp", F.pmod(F.xxhash64("cid"), F.col("parts"))).alias("grp")), "op8-members")

    # the matrix: prefix tokens by group, where a token has several components
    tokens = shared.select("token", "cid", "n", "last", "left").join(member, "cid")
    mixed = tokens.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y")
    tokens = materialize(tokens.join(mixed.select("token"), "token", "left_semi")
                         .select("token", "cid", "n", "last", "left", "comp", "grp"), "op8-mixed")
    matrix = tokens.groupBy("token", "grp", "comp").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("left").alias("room"))
    # the first token that two prefixes share leaves room for all others they share after it
    mine = tokens.select("token", F.col("cid").alias("a"), F.col("n").alias("na"), F.col("last").alias("la"),
                         F.col("left").alias("xa"), F.col("comp").alias("ca"))
    asked = (mine.join(matrix, (mine["token"] == matrix["token"]) & (F.col("ca") < F.col("comp"))
                       & _may_hold("na", "least", "most", 1 + F.least("xa", "room"), percent))
             .select("a", "na", "grp").distinct())
    asked = materialize(asked, "op8-asked")
    held = matrix.select(F.col("token").alias("t"), F.col("grp").alias("g"), "least", "most")
    by_token = mine.select("token", "a").join(asked, "a")
    opened = (by_token.join(held, (F.col("token") == F.col("t")) & (F.col("grp") == F.col("g")))
              .groupBy("a", "na", "grp").agg(F.count(F.lit(1)).alias("k"), F.min("least").alias("least"),
                                             F.max("most").alias("most"))
              .where(_may_hold("na", "least", "most", F.col("k"), percent)).select("a", "grp"))
    opened = materialize(opened, "op8-opened")

    # the members of opened groups, token by token
    theirs = tokens.select("token", "grp", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("last").alias("lb"))
    pairs = (opened.join(mine.select("token", "a", "na", "la"), "a").join(theirs, ["grp", "token"])
             .groupBy("a", "na", "la", "b", "nb", "lb").agg(F.count(F.lit(1)).alias("k"))
             .where(_may_link("na", "nb", "la", "lb", "k", percent)).select("a", "b"))
    more = verified(pairs, docs, c, width, percent)
    final = components(links.unionAll(more), "op8-components")
    named = (c.select("cls", "cid", "top").join(final, F.col("cid") == F.col("node"), "left")
             .select("cls", "top", F.coalesce("root", "cid").alias("root")))
    top = c.select(F.col("cid").alias("root"), F.col("top").alias("component"))
    return named.join(top, "root").select("cls", "component")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, component_id of every row of (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    sk = materialize(sketches(docs, width, percent, frequent_tokens(docs, width)), "op8-sketches")
    comp = class_components(docs, sk, width, percent)
    rows = sk.select("doc_id", "h", F.col("n").alias("n_shingles"), "cls")
    c = comp.select(F.col("cls").alias("k"), "component")
    return rows.join(c, (F.col("cls") == F.col("k")) & (F.col("n_shingles") > 0), "left").select(
        "doc_id", "h", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one document: the smallest id,
    and of several texts with that id the one with the smallest hash.  Rows without an id all stay."""
    near = materialize(near_duplicates(docs, width, percent).where("doc_id is not null"), "op8-near")
    keep = near.groupBy("component_id").agg(F.min(F.struct("doc_id", "h")).alias("k")).select(
        F.col("k.doc_id").alias("_keep_id"), F.col("k.h").alias("_keep_h"))
    i, h = fresh(docs, "_i", "_h")
    rows = docs.withColumn(i, F.col("doc_id").cast("long")).withColumn(h, F.xxhash64("text"))
    kept = rows.join(keep, (F.col(i) == F.col("_keep_id")) & (F.col(h) == F.col("_keep_h")), "left_semi")
    if near.groupBy("doc_id", "h").count().where("count > 1").take(1):      # rows repeated exactly
        kept = kept.dropDuplicates([i, h])
    return kept.unionAll(rows.where(F.col(i).isNull())).drop(i, h)


@query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
