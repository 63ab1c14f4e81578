"""Gradient boosted trees with logistic loss for small tables, and their form as a SQL expression."""

from __future__ import annotations

import math

import numpy as np

Tree = tuple  # (feature, threshold, left, right) or (value,)


def grow(x: np.ndarray, residual: np.ndarray, hessian: np.ndarray, depth: int, least: int, penalty: float) -> Tree:
    value = residual.sum() / (hessian.sum() + penalty)
    if depth == 0 or len(x) < 2 * least:
        return (float(value),)
    best, cut = residual.sum() ** 2 / (hessian.sum() + penalty) + 1e-9, None
    for feature in range(x.shape[1]):
        order = np.argsort(x[:, feature], kind="stable")
        values = x[order, feature]
        r, h = np.cumsum(residual[order]), np.cumsum(hessian[order])
        at = np.flatnonzero(values[:-1] < values[1:])
        at = at[(at + 1 >= least) & (len(x) - at - 1 >= least)]
        if not len(at):
            continue
        gain = r[at] ** 2 / (h[at] + penalty) + (r[-1] - r[at]) ** 2 / (h[-1] - h[at] + penalty)
        i = int(np.argmax(gain))
        if gain[i] > best:
            best, cut = gain[i], (feature, float((values[at[i]] + values[at[i] + 1]) / 2))
    if cut is None:
        return (float(value),)
    left = x[:, cut[0]] <= cut[1]
    return (*cut, grow(x[left], residual[left], hessian[left], depth - 1, least, penalty), grow(x[~left], residual[~left], hessian[~left], depth - 1, least, penalty))


def apply(tree: Tree, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    return np.where(x[:, tree[0]] <= tree[1], apply(tree[2], x), apply(tree[3], x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.4, least: int = 8, penalty: float = 1.0) -> list[Tree]:
    """The first entry is the constant log odds; the others are trees scaled by the learning rate."""
    base = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    score, model = np.full(len(y), base), [(base,)]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = scale(grow(x, y - p, p * (1 - p), depth, least, penalty), rate)
        score = score + apply(tree, x)
        model.append(tree)
    return model


def scale(tree: Tree, rate: float) -> Tree:
    return (tree[0] * rate,) if len(tree) == 1 else (tree[0], tree[1], scale(tree[2], rate), scale(tree[3], rate))


def score(model: list[Tree], x: np.ndarray) -> np.ndarray:
    """Log odds."""
    return sum(apply(tree, x) for tree in model)


def as_sql(model: list[Tree], names: list[str]) -> str:
    """The log odds as SQL over expressions for the features."""

    def node(tree: Tree) -> str:
        if len(tree) == 1:
            return f"{tree[0]:.9e}D"
        return f"IF({names[tree[0]]} <= {tree[1]:.6f}D, {node(tree[2])}, {node(tree[3])})"

    return " + ".join(node(tree) for tree in model)
