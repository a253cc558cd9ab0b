"""Gradient-boosted trees over counted cells: few distinct feature vectors with how many rows and positives each has."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = tuple  # (feature, cut, left, right) or (value,)


def _grow(x: np.ndarray, grad: np.ndarray, bend: np.ndarray, rows: np.ndarray, depth: int, least: float) -> Tree:
    g, h = grad[rows].sum(), bend[rows].sum()
    best, gain = None, 1e-6
    if depth:
        for f in range(x.shape[1]):
            values = x[rows, f]
            for cut in np.unique(values)[:-1].tolist():
                left = values <= cut
                gl, hl = grad[rows][left].sum(), bend[rows][left].sum()
                if hl < least or h - hl < least:
                    continue
                now = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                if now > gain:
                    best, gain = (f, cut, left), now
    if best is None:
        return (float(g / (h + 1)),)
    f, cut, left = best
    return f, cut, _grow(x, grad, bend, rows[left], depth - 1, least), _grow(x, grad, bend, rows[~left], depth - 1, least)


def _value(tree: Tree, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    f, cut, left, right = tree
    return np.where(x[:, f] <= cut, _value(left, x), _value(right, x))


def boost(x: np.ndarray, n: np.ndarray, positives: np.ndarray, rounds: int = 20, depth: int = 3, rate: float = 0.3, least: float = 1.0) -> tuple[float, list[Tree]]:
    """Start value and trees of a logistic model; a cell of n rows counts n times, by second-order steps."""
    share = (positives.sum() + 1) / (n.sum() + 2)
    start = float(np.log(share / (1 - share)))
    score, trees = np.full(len(n), start), []
    for _ in range(rounds if len(n) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, positives - n * p, n * p * (1 - p), np.arange(len(n)), depth, least)
        trees.append(tree)
        score = score + rate * _value(tree, x)
    return start, trees


def score_cells(model: tuple[float, list[Tree]], x: np.ndarray, rate: float = 0.3) -> np.ndarray:
    return model[0] + rate * sum((_value(t, x) for t in model[1]), np.zeros(len(x)))


def score_column(model: tuple[float, list[Tree]], features: list[str], rate: float = 0.3) -> Column:
    """The same score as an expression over columns."""

    def column(tree: Tree) -> Column:
        if len(tree) == 1:
            return F.lit(float(tree[0]))
        f, cut, left, right = tree
        return F.when(F.col(features[f]) <= F.lit(int(cut)), column(left)).otherwise(column(right))

    out = F.lit(float(model[0]))
    for tree in model[1]:
        out = out + F.lit(rate) * column(tree)
    return out
