"""Vector code compression: product codes by dual-tree Lloyd rounds in integers (operator 11).

Vectors become integers floor(scale * x) and are cut into equal parts; each part
position has a codebook of up to 256 entries, started from the smallest ids and
improved by Lloyd rounds (nearest entry, then the floor of the mean).

The rows are kept in blocks of at most ``BLOCK`` vectors, as they come from the
scan: no key decides a block, so copies and hot labels spread like other rows.
In a block every part position has a tree over its parts, halved at the median
of the widest component; it is grown once, and its order is written with the
block.  A round is one narrow pass over that written table.  The entries, a few
kilobytes sent with the tasks, get a tree too, and pairs of nodes are opened
level by level:

* an entry node farther from a part node than some other entry node can be at
  most is left out (distances between bounding boxes);
* a single entry that another one beats in every corner of the box is left out;
* a part node left with one entry is assigned whole, by its cached sum and count;
* parts of leaves left with several entries are compared by integer distances.

All of it is exact (ties to the lower entry), so the result is Lloyd's own for
any blocks, trees and order of rows.  Each task sends one sum a part position,
entry and component; the driver holds these sums and the codebooks, 256 entries
times the dimension.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, and so are rows whose vector is not as long as that of
the smallest id (of a positive multiple of four); null ids are coded but do not
start codebooks; repeated rows are coded each and both may start an entry;
equal ids start in the order of their vectors; equal entries: the lower index
is used; with fewer rows than entries the codebooks are as small; an empty table
gives an empty result; other columns are not read.  Integers whose distances
could pass 62 bits are an error (with 64 dimensions: components beyond 2^27 as
integers, 131,072 as they are).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ampere.llm.common import read_table
from ampere.llm.registry import query
from ampere.llm.vectors import dimension, finite, matrix
from ampere.session import materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256        # two hex digits a part
ROUNDS = 4
BLOCK = 2_048        # vectors a block
LEAF = 16            # parts a leaf of a part tree, at most


# ---- trees ------------------------------------------------------------------

def spans(n: int, depth: int) -> list[np.ndarray]:
    """First positions of the nodes (and n) on the levels 0..depth of a tree halved at positions."""
    return [(np.arange((1 << k) + 1, dtype=np.int64) * n) >> k for k in range(depth + 1)]


def tree_order(points: np.ndarray, depth: int) -> np.ndarray:
    """The order of points in which each node of ``spans`` is halved along its widest component."""
    order = np.arange(len(points))
    for at in spans(len(points), depth)[:-1]:
        p = points[order]
        wide = (np.maximum.reduceat(p, at[:-1]) - np.minimum.reduceat(p, at[:-1])).argmax(1)
        node = np.repeat(np.arange(len(wide)), np.diff(at))
        order = order[np.lexsort((p[np.arange(len(p)), wide[node]], node))]
    return order


class Tree:
    """Bounding boxes (and sums) of the nodes of every level over points in tree order."""

    def __init__(self, points: np.ndarray, levels: list[np.ndarray], sums: bool = False):
        self.at = levels
        self.lo = [np.minimum.reduceat(points, a[:-1]) for a in levels]
        self.hi = [np.maximum.reduceat(points, a[:-1]) for a in levels]
        self.sum = [np.add.reduceat(points, a[:-1]) for a in levels] if sums else []
        # children of node j of a level: nodes first[j] to first[j + 1] of the next
        self.first = [np.searchsorted(b, a) for a, b in zip(levels, levels[1:])]
        self.last = len(levels) - 1


def part_depth(n: int) -> int:
    return max(0, (-(-n // LEAF) - 1).bit_length())


def entry_tree(entries: np.ndarray) -> tuple[Tree, np.ndarray]:
    """Tree whose last level are single entries, and the codebook index of each of these.

    Of equal entries only the lowest can be nearest, so the others stay out."""
    index = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    depth = len(index).bit_length() - 1
    index = index[tree_order(entries[index], depth)]
    return Tree(entries[index], [*spans(len(index), depth), np.arange(len(index) + 1)]), index


def opened(nodes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of nodes, and the position in ``nodes`` each comes from."""
    many = first[nodes + 1] - first[nodes]
    source = np.repeat(np.arange(len(nodes)), many)
    return np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many) + first[nodes][source], source


def assign(points: np.ndarray, parts: Tree, entries: np.ndarray, tree: Tree, index: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of every point, and the points' count and sum by entry."""
    label = np.empty(len(points), np.int64)
    count = np.zeros(len(entries), np.int64)
    total = np.zeros(entries.shape, np.int64)
    a = b = np.zeros(1, np.int64)      # pairs of a part node and an entry node, by part node
    la = lb = 0
    while len(a):
        lo, hi = parts.lo[la][a], parts.hi[la][a]
        elo, ehi = tree.lo[lb][b], tree.hi[lb][b]
        gap = np.maximum(np.maximum(elo - hi, lo - ehi), 0)
        reach = np.maximum(ehi - lo, hi - elo)
        near, far = (gap * gap).sum(1), (reach * reach).sum(1)
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(a)]))
        keep = near <= np.minimum.reduceat(far, start)[group]
        if lb == tree.last:
            # the entry nearest to the middle of the box, against the others at their best corner
            off = 2 * elo - lo - hi
            off = (off * off).sum(1)
            firsts = np.flatnonzero(off == np.minimum.reduceat(off, start)[group])
            best = firsts[np.searchsorted(firsts, start)][group]
            step = elo - elo[best]
            margin = (elo * elo - elo[best] * elo[best] - 2 * np.where(step > 0, hi, lo) * step).sum(1)
            keep &= (margin < 0) | ((margin == 0) & (index[b] <= index[b[best]]))
        a, b = a[keep], b[keep]
        if lb == tree.last:
            start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            many = np.diff(np.r_[start, len(a)])
            node, entry = a[start[many == 1]], index[b[start[many == 1]]]
            at = parts.at[la]
            size = at[node + 1] - at[node]
            np.add.at(count, entry, size)
            np.add.at(total, entry, parts.sum[la][node])
            place, source = opened(node, at)
            label[place] = entry[source]
            unsure = np.repeat(many > 1, many)
            a, b = a[unsure], b[unsure]
            if la == parts.last:
                break
        if la < parts.last:
            a, source = opened(a, parts.first[la])
            order = np.argsort(a, kind="stable")
            a, b, la = a[order], b[source[order]], la + 1
        if lb < tree.last:
            b, source = opened(b, tree.first[lb])
            a, lb = a[source], lb + 1
    cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True]) if len(a) else np.zeros(1, np.int64)
    for s, e in zip(cuts, cuts[1:]):
        x = slice(parts.at[-1][a[s]], parts.at[-1][a[s] + 1])
        open_ = np.sort(index[b[s:e]])
        off = points[x][:, None, :] - entries[open_][None, :, :]
        label[x] = found = open_[(off * off).sum(2).argmin(1)]
        np.add.at(count, found, 1)
        np.add.at(total, found, points[x])
    return label, count, total


# ---- Spark ------------------------------------------------------------------

def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), if all distances between such integers fit in 62 bits."""
    y = np.floor(x * scale)
    if y.size and 4.0 * (np.abs(y).max() + 1) ** 2 * x.shape[1] >= 2.0 ** 62:
        raise ValueError(f"component {np.abs(x).max()} is too large for integer distances")
    return y.astype(np.int64)


def blocks_of(df: DataFrame, vector: str, dim: int, parts: int = PARTS, scale: int = SCALE,
              block: int = BLOCK) -> DataFrame:
    """Blocks of rows: every other column as an array, the integers and the tree orders as bytes."""
    names = [c for c in df.columns if c != vector]
    schema = StructType()
    for c in names:
        schema.add(c, ArrayType(df.schema[c].dataType))
    schema.add("_ints", "binary").add("_orders", "binary")
    width = dim // parts

    def grown(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ints = integers(np.concatenate([matrix(b.column(len(names)), dim) for b in held]), scale)
        orders = [tree_order(ints[:, p * width:(p + 1) * width], part_depth(len(ints))) for p in range(parts)]
        cells = [pa.ListArray.from_arrays(pa.array([0, len(ints)], pa.int32()), t.column(k).combine_chunks())
                 for k in range(len(names))]
        cells += [pa.array([x.astype(kind).tobytes()], pa.binary())
                  for x, kind in ((ints, "<i8"), (np.array(orders), "<i4"))]
        return pa.RecordBatch.from_arrays(cells, names=[*names, "_ints", "_orders"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                cut = b.slice(0, block - n)
                held.append(cut)
                n += cut.num_rows
                b = b.slice(cut.num_rows)
                if n == block:
                    yield grown(held)
                    held, n = [], 0
        if held:
            yield grown(held)

    return df.select(*names, vector).mapInArrow(run, schema)


def _parts_of(ints: bytes, orders: bytes, dim: int, parts: int):
    """Per part position of a block: its order, its parts in that order and their tree."""
    x = np.frombuffer(ints, "<i8").reshape(-1, dim)
    width, depth = dim // parts, part_depth(len(x))
    for p, order in enumerate(np.frombuffer(orders, "<i4").reshape(parts, -1)):
        points = np.ascontiguousarray(x[order, p * width:(p + 1) * width])
        yield p, order, points, Tree(points, spans(len(points), depth), sums=True)


def lloyd_round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, component) after one round over all blocks."""
    parts, entries, width = books.shape

    def run(batches):
        trees = [entry_tree(b) for b in books]
        sums = np.zeros((parts, entries, 1 + width), np.int64)
        for b in batches:
            for ints, orders in zip(b.column(0), b.column(1)):
                for p, _, points, tree in _parts_of(ints.as_py(), orders.as_py(), parts * width, parts):
                    _, count, total = assign(points, tree, books[p], *trees[p])
                    sums[p, :, 0] += count
                    sums[p, :, 1:] += total
        p, e = np.nonzero(sums[:, :, 0])
        flat = sums[p, e].reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * (1 + width), pa.int32()), pa.array(flat))],
            names=["part", "entry", "sums"])

    sent = (blocks.select("_ints", "_orders").mapInArrow(run, "part int, entry int, sums array<bigint>")
            .select("part", "entry", F.posexplode("sums").alias("k", "x"))
            .groupBy("part", "entry", "k").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in sent.collect():               # parts x entries x (1 + width) numbers at most
        found.setdefault((r["part"], r["entry"]), {})[r["k"]] = int(r["x"])
    new = books.copy()
    for (p, e), s in found.items():
        new[p, e] = [s[1 + j] // s[0] for j in range(width)]
    return new


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """The rows of the blocks with ``code`` (two hex digits a part) and ``error``."""
    parts, _, width = books.shape
    names = [c for c in blocks.columns if c not in ("_ints", "_orders")]
    schema = StructType()
    for c in names:
        schema.add(c, blocks.schema[c].dataType.elementType)
    schema.add("code", "string").add("error", "long")

    def run(batches):
        trees = [entry_tree(b) for b in books]
        for b in batches:
            for k in range(b.num_rows):
                code = error = None
                for p, order, points, tree in _parts_of(b.column("_ints")[k].as_py(), b.column("_orders")[k].as_py(),
                                                        parts * width, parts):
                    if code is None:
                        code, error = np.zeros((len(order), parts), np.uint8), np.zeros(len(order), np.int64)
                    label, _, _ = assign(points, tree, books[p], *trees[p])
                    off = points - books[p][label]
                    code[order, p] = label
                    error[order] += (off * off).sum(1)
                text = code.tobytes().hex()
                w = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c)[k].values for c in names),
                     pa.array([text[j:j + w] for j in range(0, len(text), w)], pa.string()), pa.array(error)],
                    names=[*names, "code", "error"])

    return blocks.mapInArrow(run, schema)


def first_books(df: DataFrame, key: str, vector: str, dim: int, parts: int = PARTS, entries: int = ENTRIES,
                scale: int = SCALE) -> np.ndarray:
    """Codebooks from the vectors of the smallest keys, in their order."""
    rows = df.where(F.col(key).isNotNull()).orderBy(key, vector).limit(entries).select(vector).collect()
    x = integers(np.array([r[0] for r in rows], np.float64).reshape(len(rows), dim), scale)
    return np.ascontiguousarray(x.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2))


def fit(df: DataFrame, key: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        scale: int = SCALE, block: int = BLOCK) -> tuple[DataFrame, np.ndarray] | None:
    """Written blocks of the usable rows, and the codebooks after all rounds; None without such rows
    (or without one that has a key)."""
    kept = df.where(finite(F.col(vector)))
    dim = dimension(kept, key, vector, parts)
    kept = kept.where(F.size(vector) == dim)
    if not dim:
        return None
    books = first_books(kept, key, vector, dim, parts, entries, scale)
    if not books.shape[1]:
        return None
    blocks = materialize(blocks_of(kept, vector, dim, parts, scale, block), "vector-blocks")
    for _ in range(rounds):
        books = lloyd_round(blocks, books)
    return blocks, books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


@query("op11_vector_codes")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every usable embedding, and its label's error."""
    df = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    found = fit(df, "vec_id", "embedding")
    if found is None:
        return spark.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    blocks, books = found
    rows = materialize(encode(blocks, books), "vector-codes")
    by_label = materialize(rows.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")), "vector-label-errors")
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
