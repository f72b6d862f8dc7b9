"""Isolation forest per key (K6), after Liu, Ting & Zhou, "Isolation
Forest", ICDM 2008.

Plan, all on the cluster:

1. *Sampling.*  With n rows in the key and psi = min(256, n), a row should
   enter a tree with chance p = 2 psi / n.  One hash a row first keeps the
   share q = min(1, trees * p) of rows; only these are paired with the trees,
   and a pair is chosen when its own uniform hash is below p / q.  So a big
   key expands about 2 psi trees rows, not all of them.  Per (key, tree) the
   psi smallest hashes are kept (a bounded window).  psi (256) and the number
   of trees (100) are the published algorithm's sub-sample and ensemble size.
2. *Growing.*  ``groupBy(key, tree).applyInPandas``: each group holds at
   most psi rows.  Splits pick a random non-constant feature and a
   threshold uniform in (min, max); height limit ceil(log2 psi).  The RNG
   is seeded by (seed, key, tree): the same forest on every run.
3. *Scoring.*  The rows of a key are dealt into groups of about ``GROUP_ROWS``,
   and each group meets its key's trees (at most trees x (2 psi - 1) nodes) in a
   cogroup that walks all trees at once: s = 2 ** (-E[h(x)] / c(psi)).  No node
   passes the driver, and any number of keys is one scan.
4. *Threshold.*  A row is anomalous when -s is below the exact
   ``contamination`` quantile of -s within its key (``exact_quantiles``).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ampere.operators.quantile import exact_quantiles
from ampere.session import materialize
from ampere.operators.attach import attach, small_side

EULER_GAMMA = 0.5772156649015329
GROUP_ROWS = 50_000          # rows of a key scored together

NODE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("psi", T.LongType()),
])


def c_factor(n: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def grow_tree(x: np.ndarray, rng: np.random.Generator, height_limit: int) -> list[tuple]:
    """One isolation tree over the rows of ``x``; returns node tuples
    (node, feature, threshold, left, right, size, depth)."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, 0)]
    nodes.append(None)
    while stack:
        idx, depth, nid = stack.pop()
        sub = x[idx]
        if depth >= height_limit or len(idx) <= 1:
            nodes[nid] = [nid, -1, 0.0, -1, -1, len(idx), depth]
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        varying = np.flatnonzero(hi > lo)
        if len(varying) == 0:
            nodes[nid] = [nid, -1, 0.0, -1, -1, len(idx), depth]
            continue
        f = int(rng.choice(varying))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= thr
        left_id, right_id = len(nodes), len(nodes) + 1
        nodes.extend([None, None])
        nodes[nid] = [nid, f, thr, left_id, right_id, len(idx), depth]
        stack.append((idx[~go_left], depth + 1, right_id))
        stack.append((idx[go_left], depth + 1, left_id))
    return [tuple(n) for n in nodes]


def _builder(features: list[str], seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        key = str(pdf["_key"].iloc[0])
        tree = int(pdf["_tree"].iloc[0])
        psi = int(pdf["_psi"].iloc[0])
        x = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, zlib.crc32(key.encode()), tree])
        height = max(1, math.ceil(math.log2(max(psi, 2))))
        nodes = grow_tree(x, rng, height)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        out.insert(0, "key", key)
        out["psi"] = psi
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32",
                           "right": "int32", "size": "int64", "depth": "int32", "psi": "int64"})
    return build


def fit_forest(df: DataFrame, features: Sequence[str], key: str, row_key: Sequence[str],
               n_trees: int = 100, max_samples: int = 256, seed: int = 42,
               counts: DataFrame | None = None) -> DataFrame:
    """Grow ``n_trees`` isolation trees per key.  Returns the node table.
    ``counts`` (key, _n) may be passed when the caller already has them."""
    features = list(features)
    if counts is None:
        counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = counts.select(F.col(key).cast("string").alias("_key"), "_n")
    d = df.select(F.col(key).cast("string").alias("_key"), *row_key,
                  *[F.col(c).cast("double").alias(c) for c in features])
    d = attach(d, counts, "_key")
    psi = F.least(F.col("_n"), F.lit(max_samples))
    p = F.least(F.lit(1.0), F.lit(2.0) * psi / F.col("_n"))

    def u(t):
        h = F.xxhash64(F.col("_key"), *[F.col(c) for c in row_key], t, F.lit(seed))
        return h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(float(1 << 53))

    # thin first, then expand: rows that enter no tree are dropped by one hash
    q = F.least(F.lit(1.0), F.lit(float(n_trees)) * p)
    s = d.where(u(F.lit(-1)) < q).select(
        "_key", *row_key, *features, "_n",
        F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("_tree"))
    s = s.withColumn("_u", u(F.col("_tree"))).where(F.col("_u") < p / q).withColumn("_psi", psi)
    w = Window.partitionBy("_key", "_tree").orderBy("_u", *row_key)
    s = s.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.col("_psi"))
    s = s.select("_key", "_tree", "_psi", *features)
    return s.groupBy("_key", "_tree").applyInPandas(_builder(features, seed), NODE_SCHEMA)


def _forest_arrays(nodes: pd.DataFrame) -> dict:
    """key -> padded (trees x max_nodes) arrays: feature (-1 = leaf),
    threshold, left, right and the leaf path length depth + c(size); plus
    the normaliser c(psi) and the traversal depth."""
    out = {}
    for key, g in nodes.groupby("key"):
        trees = np.sort(g["tree"].unique())
        tix = np.searchsorted(trees, g["tree"].to_numpy())
        width = int(g["node"].max()) + 1
        shape = (len(trees), width)
        feat = np.full(shape, -1, dtype=np.int64)
        thr = np.zeros(shape)
        left = np.zeros(shape, dtype=np.int64)
        right = np.zeros(shape, dtype=np.int64)
        plen = np.zeros(shape)
        nid = g["node"].to_numpy()
        feat[tix, nid] = g["feature"].to_numpy()
        thr[tix, nid] = g["threshold"].to_numpy()
        left[tix, nid] = np.maximum(g["left"].to_numpy(), 0)
        right[tix, nid] = np.maximum(g["right"].to_numpy(), 0)
        plen[tix, nid] = g["depth"].to_numpy() + c_factor(g["size"].to_numpy())
        psi = int(g["psi"].iloc[0])
        norm = float(c_factor(np.array([psi]))[0]) if psi > 1 else 0.0
        out[key] = (feat, thr, left, right, plen, norm, int(g["depth"].max()))
    return out


def tree_scores(x_all: np.ndarray, forest: tuple) -> np.ndarray:
    """Scores of rows by one key's forest.  The trees' arrays are read as flat ones, and a leaf is
    its own child, so a level is one step for every row and tree."""
    feat, thr, left, right, plen, norm, depth = forest
    trees, width = feat.shape
    at = np.arange(trees * width).reshape(trees, width)
    root, leaf = at[:, 0], feat < 0
    child = np.stack([np.where(leaf, at, root[:, None] + left), np.where(leaf, at, root[:, None] + right)], -1).ravel()
    bound = np.where(leaf, np.inf, thr).ravel()
    column, plen = np.where(leaf, 0, feat).ravel(), plen.ravel()
    out = np.empty(len(x_all))
    for lo in range(0, len(x_all), 500):          # rows x trees numbers at a time
        x = x_all[lo:lo + 500]
        n, wide = x.shape
        x = np.where(np.isnan(x), np.inf, x).ravel()     # a missing value goes right
        first = (np.arange(n) * wide)[:, None]
        node = np.repeat(root[None, :], n, axis=0)
        for _ in range(depth):
            right_of = x.take(first + column.take(node)) > bound.take(node)
            node = child.take(2 * node + right_of)
        eh = plen.take(node).mean(axis=1)
        out[lo:lo + 500] = np.power(2.0, -eh / norm) if norm > 0 else 1.0
    return out


def _scorer(names: list[str], features: list[str]):
    def score(rows: pa.Table, trees: pa.Table) -> pa.Table:
        s = np.full(rows.num_rows, np.nan)
        if trees.num_rows and rows.num_rows:
            forest, = _forest_arrays(trees.drop_columns(["_gk", "_salt"]).to_pandas()).values()
            x = np.column_stack([rows.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features])
            s = tree_scores(x, forest)
        return rows.select(names).append_column("anomaly_score", pa.array(s, pa.float64()))
    return score


def isolation_scores(df: DataFrame, features: Sequence[str] = ("load_mw", "hour_of_day", "day_of_week"),
                     key: str = "iso_code", row_key: Sequence[str] = ("timestamp_utc",),
                     n_trees: int = 100, max_samples: int = 256, seed: int = 42,
                     fit_df: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Add ``anomaly_score`` s in (0, 1] (higher = more isolated).  The
    forest is grown on ``fit_df`` (default ``df``): the same rows, possibly
    a cheaper plan of them."""
    features = list(features)
    fit_df = df if fit_df is None else fit_df
    if fit_df.where(" OR ".join(f"{c} IS NULL" for c in features)).take(1):
        means = fit_df.groupBy(F.col(key).alias("_mk")).agg(*[F.avg(c).alias(f"_m_{c}") for c in features])
        fit_df, df = (_fill(x, means, key, features) for x in (fit_df, df))
    nodes = materialize(fit_forest(fit_df, features, key, row_key, n_trees, max_samples, seed, counts), "forest")
    if counts is None:
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    group_key = F.coalesce(F.col(key).cast("string"), F.lit("\0"))       # no tree has the key of null keys
    sizes = small_side(counts.select(
        group_key.alias("_gk"), F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(GROUP_ROWS))).cast("int").alias("_groups")))
    rows = (df.withColumns({"_gk": group_key, "_draw": F.xxhash64(F.monotonically_increasing_id())})
            .join(sizes, "_gk", "left")
            .withColumn("_salt", F.pmod("_draw", F.coalesce("_groups", F.lit(1))).cast("int")))
    trees = (nodes.join(sizes, F.col("key") == F.col("_gk"))
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).drop("_groups"))
    schema = T.StructType(df.schema.fields + [T.StructField("anomaly_score", T.DoubleType())])
    return (rows.drop("_draw", "_groups").groupBy("_gk", "_salt").cogroup(trees.groupBy("_gk", "_salt"))
            .applyInArrow(_scorer(df.columns, features), schema))


def _fill(df: DataFrame, means: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Missing features take their key's mean."""
    j = attach(df, means, F.col(key) == F.col("_mk"), "left")
    filled = j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}")) for c in features})
    return filled.drop("_mk", *[f"_m_{c}" for c in features])


def isolation_forest_flags(df: DataFrame, contamination: float = 0.05, key: str = "iso_code",
                           features: Sequence[str] = ("load_mw", "hour_of_day", "day_of_week"),
                           row_key: Sequence[str] = ("timestamp_utc",), n_trees: int = 100,
                           max_samples: int = 256, seed: int = 42, fit_df: DataFrame | None = None,
                           counts: DataFrame | None = None) -> DataFrame:
    """K6: ``is_isolation_anomaly`` = -s below the exact ``contamination``
    quantile of -s within the key (as the reference's predict)."""
    # the scored rows feed both the per-key threshold and the final flags:
    # materialise them once instead of running the Python scorer per use
    sc = materialize(isolation_scores(df, features, key, row_key, n_trees, max_samples, seed,
                                      fit_df, counts), "isolation_scores")
    sc = sc.withColumn("_neg", -F.col("anomaly_score"))
    thr = exact_quantiles(sc, key, "_neg", [contamination], ["_thr"]).select(key, "_thr")
    j = attach(sc, thr, key, "left")
    return j.withColumn("is_isolation_anomaly", F.coalesce(F.col("_neg") < F.col("_thr"), F.lit(False))) \
            .drop("_neg", "_thr")
