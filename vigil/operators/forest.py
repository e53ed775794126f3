"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) on Spark.

Every tree sees a subsample of fixed size, so what is gathered per tree is
bounded whatever the size of the training data: Spark draws and deals the
samples, each tree grows in its own task, and scoring is one map-only pass with
the node table broadcast. All random draws are hashes of seed, tree, node and
row key, so the forest does not depend on partitioning or retries.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigil import fixed_values as fv
from vigil.functions.sql import clip01, derive, hash_uniform, num
from vigil.operators.sampling import hash_sample

NODES = "tree int, node int, depth int, size int, feature int, threshold double, path_length double"
ROWS_AT_ONCE = 4096  # rows scored in one go
SPARE = 1.5  # candidates dealt to a tree per row it needs


def expected_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + fv.EULER_GAMMA) - 2.0 * (n - 1.0) / n


def slots_for(trees: int) -> int:
    """Smallest prime >= trees: with a prime, every step size visits distinct slots."""
    n = max(trees, 2)
    while any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def deal_samples(training: DataFrame, key: str, total_rows: int, trees: int, subsample: int, seed: int) -> DataFrame:
    """(tree, key, features): ``subsample`` rows per tree without replacement.

    Few training rows: each goes to several trees. Many: a bounded sample is
    taken first and each sampled row goes to one tree.
    """
    slots = slots_for(trees)
    size = min(subsample, total_rows)
    needed = math.ceil(SPARE * slots * size)
    per_row = min(slots, math.ceil(needed / max(min(total_rows, needed), 1)))
    columns = training.columns
    drawn = hash_sample(training, key, needed, total_rows, seed)
    dealt = derive(drawn, {
        "_first": f"floor(({hash_uniform(seed, 'slot', key, 'copy')}) * {slots})",
        "_step": f"floor(({hash_uniform(seed, 'step', key, 'copy')}) * {slots - 1}) + 1",
        "_turn": f"explode(sequence(0, {per_row - 1}))",
    })
    placed = derive(dealt, {"tree": f"CAST((_first + _turn * _step) % {slots} AS INT)"}).where(f"tree < {trees}")
    ranked = derive(placed, {"_draw": hash_uniform(seed, "rank", "tree", key, "copy")})
    order = W.partitionBy("tree").orderBy("_draw", "copy", *columns)
    return ranked.withColumn("_place", F.row_number().over(order)).where(f"_place <= {size}").select("tree", *columns)


def grow_trees(samples: DataFrame, features: list[str], subsample: int, seed: int) -> DataFrame:
    """One task grows one tree from its at most ``subsample`` rows."""
    deepest = max(1, math.ceil(math.log2(max(subsample, 2))))

    def draw(tree: int, node: int, tag: str) -> float:
        digest = hashlib.md5(f"{seed}:{tree}:{node}:{tag}".encode()).hexdigest()
        return int(digest[:8], 16) / 4294967296.0

    def grow(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        values = sample[features].to_numpy(dtype=float)
        pending, nodes = [(1, 0, values)], []
        while pending:
            node, depth, rows = pending.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            varying = np.flatnonzero(high > low)
            if depth == deepest or len(varying) == 0:
                nodes.append((tree, node, depth, len(rows), -1, None, depth + expected_path(len(rows))))
                continue
            feature = int(varying[int(draw(tree, node, "feature") * len(varying))])
            cut = low[feature] + draw(tree, node, "cut") * (high[feature] - low[feature])
            if cut >= high[feature]:
                cut = low[feature]
            nodes.append((tree, node, depth, len(rows), feature, cut, None))
            goes_left = rows[:, feature] <= cut
            pending += [(2 * node, depth + 1, rows[goes_left]), (2 * node + 1, depth + 1, rows[~goes_left])]
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")])

    return samples.groupBy("tree").applyInPandas(grow, NODES)


def fit_forest(
    training: DataFrame,
    key: str,
    total_rows: int,
    trees: int = fv.FOREST_TREES,
    subsample: int = fv.FOREST_SUBSAMPLE,
    seed: int = fv.FOREST_SEED,
) -> DataFrame:
    """Node table of the forest; node n has children 2n (value <= threshold) and 2n + 1."""
    features = [c for c in training.columns if c != key]
    size = min(subsample, total_rows)
    return grow_trees(deal_samples(training, key, total_rows, trees, subsample, seed), features, size, seed)


def raw_score(nodes: DataFrame, features: list[str], subsample: int) -> Column:
    """Column 2 ** (-mean path / expected path): in (0, 1], higher is stranger.

    Collects the node table, whose size is fixed by the number of trees (200
    trees of at most 511 nodes), and broadcasts it as arrays.
    """
    table = nodes.toPandas()
    deepest = max(1, math.ceil(math.log2(max(subsample, 2))))
    row = table["tree"].rank(method="dense").astype(int).to_numpy() - 1
    shape = (int(row.max()) + 1, 2 ** (deepest + 1))
    split_on = np.zeros(shape, dtype=np.int32)
    cuts = np.full(shape, np.inf)
    paths = np.zeros(shape)
    inner = (table["feature"] >= 0).to_numpy()
    at = table["node"].to_numpy()
    split_on[row[inner], at[inner]] = table["feature"].to_numpy()[inner]
    cuts[row[inner], at[inner]] = table["threshold"].to_numpy()[inner]
    paths[row[~inner], at[~inner]] = table["path_length"].to_numpy()[~inner]
    # an infinite cut always leads left, so a leaf's value is carried down its left edge
    for parent in range(1, 2 ** deepest):
        carried = paths[:, parent] != 0
        paths[carried, 2 * parent] = paths[carried, parent]
    forest = nodes.sparkSession.sparkContext.broadcast((split_on.astype(np.int64), cuts, paths, deepest, expected_path(subsample)))

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        split_on, cuts, paths, deepest, norm = forest.value
        columns = [pc.fill_null(c, np.nan).to_numpy(zero_copy_only=False) for c in batch.flatten()]
        scores = np.empty(len(batch))
        for begin in range(0, len(batch), ROWS_AT_ONCE):
            part = [c[begin:begin + ROWS_AT_ONCE] for c in columns]
            scores[begin:begin + ROWS_AT_ONCE] = np.power(2.0, -(_mean_path(part, split_on, cuts, paths, deepest)) / norm)
        return pa.array(scores)

    return score(F.expr("struct(" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in features) + ")"))


def _mean_path(columns: list[np.ndarray], split_on: np.ndarray, cuts: np.ndarray, paths: np.ndarray, deepest: int) -> np.ndarray:
    """Mean path of some rows through all trees. Rows are few enough for all that a tree looks up to stay in the processor's caches."""
    values = np.stack(columns, axis=1).ravel()
    first = np.arange(len(columns[0]), dtype=np.int64) * len(columns)
    total = np.zeros(len(columns[0]))
    for feature, cut, path in zip(split_on, cuts, paths):
        at = 2 + (columns[feature[1]] > cut[1]).astype(np.int64)  # all rows begin at node 1
        for _ in range(deepest - 1):
            right = values.take(feature.take(at) + first) > cut.take(at)
            at += at
            at += right
        total += path.take(at)
    return total / len(paths)


def normalise_score(raw: str, low: float, high: float) -> str:
    return clip01(f"({raw} - {num(low)}) / {num(max(high - low, fv.TINY))}")
