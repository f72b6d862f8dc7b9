"""Approximate nearest neighbours by collision counting over query-centred windows (operator 12).

Every vector is projected on ``PROJECTIONS`` Gaussian directions.  Rows are dealt
by their position in the scan (no value or key) into blocks of about ``BLOCK``; a
block keeps one sorted array of projections for each single direction.  A query
opens a window centred on its own projection in every sorted array.  Its width
stands for a radius: a vector within that radius collides in a direction with a
chance of 0.826 (half width ``HALF`` times the radius).  Virtual rehashing is the
widening of these windows in place, from a third of the bound below up to the
bound, counting only what the wider windows add.  Vectors with ``HITS`` collisions
or more are verified by their true distance; a query is done in a block when the
radius has reached its bound or its k-th verified distance.

The bound is the k-th distance within a sample of ``SAMPLE`` rows (those with the
smallest hashes, 0.5 MB at 64 dimensions as floats, sent with the tasks): an upper
bound of the true k-th distance.  Only what it admits leaves a block, and the
sample's own k best are results too, so a query always gets k where there are k.

Plan: queries are a written table with their bounds.  Rows (block) and queries
(every block) are shuffled to the blocks' tasks and sorted, a block's rows before
the queries; a task holds one block and one batch of queries at a time.  A stated
query set against all rows, in blocks: the pairs are never rows of a table.
Results of the blocks meet by query in a window that keeps k a task first.

Defined results: vectors null, zero, or with null or non-finite components take
no part, nor do vectors not as long as that of the smallest id; rows sharing the
query's id are its own; an id with several vectors asks with the smallest; rows
repeated exactly (id and distance) count once; a null id asks nothing and comes
last in ties; with fewer than k candidates all are returned; ties go to the
smaller id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ampere.llm.common import read_table
from ampere.llm.registry import query
from ampere.llm.vectors import dimension, finite, matrix
from ampere.session import materialize

NEAREST = 10
EVERY = 100
PROJECTIONS = 64
HITS = 44            # of 64: a vector at the radius has 52.9 +- 3.0, one at twice the radius 32 +- 4
HALF = 1.36          # half a window, in radii
GROW = 3 ** 0.5      # radii: bound / 3, bound / sqrt(3), bound
BLOCK = 4_096
SAMPLE = 2_048
_LAST = np.iinfo(np.int64).max      # stands for a null id, after all others


def distances(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - q) ** 2).sum(axis=1))


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False)


def directions(dim: int, m: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(12).standard_normal((dim, m))


class Block:
    """Rows with one sorted array of projections a direction."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, lines: np.ndarray):
        self.ids, self.x = ids, x
        p = (x @ lines).T
        self.order = np.argsort(p, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(p, self.order, axis=1)

    def windows(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end positions by query and direction of what lies within half of at."""
        lo, hi = np.empty(at.shape, np.int64), np.empty(at.shape, np.int64)
        for j, values in enumerate(self.sorted):
            lo[:, j] = np.searchsorted(values, at[:, j] - half, "left")
            hi[:, j] = np.searchsorted(values, at[:, j] + half, "right")
        return lo, hi

    def search(self, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, lines: np.ndarray, k: int, hits: int):
        """For each query positions of verified rows within the bound, k at most, and their distances."""
        at = q @ lines
        slack = 1e-9 * (1 + np.abs(at).max(initial=0) + np.abs(self.sorted).max())   # of rounding in projections
        radii = [bound / GROW ** 2, bound / GROW, bound]
        opened = [self.windows(at, HALF * r + slack) for r in radii]
        for n in range(len(q)):
            count = np.zeros(len(self.ids), np.int64)
            known = np.zeros(len(self.ids), bool)
            best, off = np.empty(0, np.int64), np.empty(0)
            lo = hi = None
            for r, (los, his) in zip(radii, opened):
                if lo is None:
                    cut = [o[a:b] for o, a, b in zip(self.order, los[n], his[n])]
                else:       # only what the wider windows add on either side
                    cut = [o[a:b] for o, a, b in zip(self.order, los[n], lo)]
                    cut += [o[a:b] for o, a, b in zip(self.order, hi, his[n])]
                lo, hi = los[n], his[n]
                count += np.bincount(np.concatenate(cut), minlength=len(count))
                fresh = np.flatnonzero((count >= hits) & ~known)
                known[fresh] = True
                fresh = fresh[self.ids[fresh] != ids[n]]
                d = distances(self.x[fresh], q[n])
                near = d <= bound[n]
                best, off = np.r_[best, fresh[near]], np.r_[off, d[near]]
                if len(best) > k:
                    keep = np.lexsort((self.ids[best], off))[:k]
                    best, off = best[keep], off[keep]
                if len(best) >= k and off.max() <= r[n]:
                    break
            yield best, off


def with_bounds(queries: DataFrame, sample_ids: np.ndarray, sample: np.ndarray, dim: int, k: int) -> DataFrame:
    """``queries`` (id, v) plus ``bound`` (infinite if the sample has not k others) and ``near``,
    the sample's k best as (id, score)."""
    norms = (sample * sample).sum(1)

    def run(batches):
        for b in batches:
            ids, q = ids_of(b.column(0)), matrix(b.column(1), dim)
            bound, found, scores, ends = [], [], [], [0]
            for n in range(len(q)):
                others = np.flatnonzero(sample_ids != ids[n])
                # rough distances choose, true ones of what could be among the k best decide
                rough = norms[others] - 2 * (sample[others] @ q[n])
                kth = np.partition(rough, k - 1)[k - 1] if len(others) > k else np.inf
                scale = 1e-9 * (1 + np.abs(norms).max(initial=0) + (q[n] * q[n]).sum())
                others = others[rough <= kth + scale]
                d = distances(sample[others], q[n])
                keep = np.lexsort((sample_ids[others], d))[:k]
                found += sample_ids[others[keep]].tolist()
                scores += d[keep].tolist()
                bound.append(d[keep[-1]] * (1 + 1e-12) if len(keep) >= k else np.inf)
                ends.append(len(found))
            near = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array([None if x == _LAST else x for x in found], pa.int64()), pa.array(scores, pa.float64())],
                names=["id", "score"]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bound, pa.float64()), near],
                                             names=["id", "v", "bound", "near"])

    kind = queries.schema["v"].dataType.simpleString()
    return queries.mapInArrow(run, f"id bigint, v {kind}, bound double, near array<struct<id:bigint,score:double>>")


def nearest(rows: DataFrame, asked: DataFrame, key: str, vector: str, k: int = NEAREST, block: int = BLOCK,
            hits: int = HITS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, id, score: the k nearest found of each row of ``asked`` among ``rows``.

    Both have a bigint ``key`` and a ``vector``; a query's own rows are those with its key."""
    spark = rows.sparkSession

    def bare(df):
        df = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"))
        return df.where(finite(F.col("v")) & F.exists("v", lambda x: x != 0))

    data = bare(rows)
    dim = dimension(data, "id", "v")
    data = data.where(F.size("v") == dim)
    held = data.orderBy(F.xxhash64("id", "v"), "id").limit(sample).collect()      # SAMPLE rows, bounded
    held_ids = np.array([_LAST if r["id"] is None else r["id"] for r in held], np.int64)
    held_x = np.array([r["v"] for r in held], np.float64).reshape(len(held), dim)
    queries = (bare(asked).where((F.size("v") == dim) & F.col("id").isNotNull())
               .groupBy("id").agg(F.min("v").alias("v")))
    queries = materialize(with_bounds(queries, held_ids, held_x, dim, k), "nearest-queries")

    blocks = max(1, -(-data.count() // block))
    kind = data.schema["v"].dataType
    stream = (data.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block"),
                          F.lit(None).cast("double").alias("bound"), "id", "v")
              .unionAll(queries.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))),
                                       "bound", "id", F.col("v").cast(kind)))
              .repartition(blocks, "block").sortWithinPartitions("block", F.col("bound").asc_nulls_first()))

    def run(batches):
        lines = directions(dim)
        now, ids, parts, index = None, [], [], None
        for b in batches:
            number = b.column(0).to_numpy()
            asks = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((number[1:] != number[:-1]) | (asks[1:] != asks[:-1])) + 1
            for s, e in zip(np.r_[0, change], np.r_[change, len(number)]):
                cut = b.slice(s, e - s)
                if number[s] != now:
                    now, ids, parts, index = number[s], [], [], None
                if not asks[s]:
                    ids.append(ids_of(cut.column(2)))
                    parts.append(matrix(cut.column(3), dim))
                    continue
                if not parts:
                    continue
                if index is None:
                    index = Block(np.concatenate(ids), np.concatenate(parts), lines)
                own = ids_of(cut.column(2))
                found = list(index.search(own, matrix(cut.column(3), dim), cut.column(1).to_numpy(), lines, k, hits))
                rows_ = index.ids[np.concatenate([x for x, _ in found])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, [len(x) for x, _ in found])),
                     pa.array(rows_, pa.int64(), mask=rows_ == _LAST),
                     pa.array(np.concatenate([d for _, d in found]))], names=["query_id", "id", "score"])

    verified = stream.select("block", "bound", "id", "v").mapInArrow(run, "query_id bigint, id bigint, score double")
    sampled = queries.select(F.col("id").alias("query_id"), F.explode("near").alias("n")).select("query_id", "n.*")
    order = Window.partitionBy("query_id").orderBy("score", F.col("id").asc_nulls_last())
    return (verified.unionAll(sampled).distinct().withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "id", "score"))


@query("op12_nearest_neighbours")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings found of every embedding whose id is divisible by 100."""
    df = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = nearest(df, df.where(F.col("vec_id") % EVERY == 0), "vec_id", "embedding")
    return found.withColumnRenamed("id", "vec_id").select("query_id", "rank", "vec_id", "score")
