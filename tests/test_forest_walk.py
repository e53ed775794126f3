"""Paths of rows through the trees of a forest."""

from __future__ import annotations

import numpy as np

from vigil.operators import forest


def test_mean_path_is_that_of_a_plain_walk():
    draw = np.random.default_rng(5)
    trees, deepest, width = 7, 4, 3
    split_on, cuts = draw.integers(0, width, (trees, 32)), draw.random((trees, 32))
    cuts[draw.random(cuts.shape) < 0.2] = np.inf
    paths, rows = draw.random((trees, 32)), draw.random((50, width))
    rows[::9, 1] = np.nan
    plain = []
    for row in rows:
        total = 0.0
        for tree in range(trees):
            at = 1
            for _ in range(deepest):
                at = 2 * at + int(row[split_on[tree, at]] > cuts[tree, at])
            total += paths[tree, at]
        plain.append(total / trees)
    assert forest._mean_path([np.ascontiguousarray(c) for c in rows.T], split_on, cuts, paths, deepest).tolist() == plain
