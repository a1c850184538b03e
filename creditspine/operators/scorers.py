"""Fitted classifiers as small arrays that a task scores on its own.

Attribution asks for the score of many vectors that differ from each other in
one raw feature. A scorer holds what that takes, a few hundred kilobytes at most,
travels to the tasks with the function that uses it, and gives the scores along
a whole walk at once, so no vector passes through the model pipeline again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession

from creditspine.sources.session import scratch


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


@dataclass(frozen=True)
class LinearScorer:
    """Logistic regression."""

    weights: np.ndarray
    intercept: float

    def walks(self, x: np.ndarray, z: np.ndarray, switched: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Scores after 0..m switches from ``z`` to ``x``, one row per pair.

        ``switched[p, j]`` is the step, from 1, at which pair p takes raw feature
        j from ``x``; ``owner`` names the raw feature of each vector entry.
        """
        pairs, m = switched.shape
        steps = np.zeros((pairs, m + 1))
        steps[:, 0] = z @ self.weights + self.intercept
        change = (x - z) * self.weights
        at = np.arange(pairs)
        for entry, j in enumerate(owner):
            steps[at, switched[:, j]] += change[:, entry]
        return logistic(np.cumsum(steps, axis=1))


@dataclass(frozen=True)
class ForestScorer:
    """A weighted sum of trees, as flat node arrays; ``scale`` leads from the sum to the log odds."""

    feature: np.ndarray  # -1 in a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # of leaves, times the weight of the tree
    roots: np.ndarray
    scale: float = 2.0

    def walks(self, x: np.ndarray, z: np.ndarray, switched: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """As ``LinearScorer.walks``.

        A pair comes by a leaf during one span of steps: from the last switch
        that the path needs to the first one that leaves it. So each tree is
        descended once per pair, with the span narrowed at every node, and a
        leaf's value is added where its span begins and taken back where it ends.
        """
        pairs, m = switched.shape
        change = np.zeros((pairs, m + 2))
        everyone, first, last = np.arange(pairs), np.zeros(pairs, dtype=np.int32), np.full(pairs, m + 1, dtype=np.int32)
        for root in self.roots:
            stack = [(int(root), everyone, first, last)]
            while stack:
                node, at, lo, hi = stack.pop()
                f = self.feature[node]
                if f < 0:
                    change[at, lo] += self.value[node]
                    change[at, hi] -= self.value[node]
                    continue
                low_x, low_z = x[at, f] <= self.threshold[node], z[at, f] <= self.threshold[node]
                step = switched[at, owner[f]]
                for child, from_x, from_z in ((self.left[node], low_x, low_z), (self.right[node], ~low_x, ~low_z)):
                    # without z's side the span begins at the switch, without x's it ends there
                    begin, end = np.where(from_z, lo, np.maximum(lo, step)), np.where(from_x, hi, np.minimum(hi, step))
                    on = (from_x | from_z) & (begin < end)
                    if on.any():
                        stack.append((int(child), at[on], begin[on], end[on]))
        return logistic(self.scale * np.cumsum(change[:, :-1], axis=1))


Scorer = LinearScorer | ForestScorer


def forest(trees: list[list[tuple]], weights: list[float], scale: float = 2.0) -> ForestScorer:
    """Flat arrays from nodes (feature or -1, threshold, left, right, value), one list per tree, root first."""
    rows, roots = [], []
    for nodes, weight in zip(trees, weights):
        base = len(rows)
        roots.append(base)
        rows += [(f, t, base + lo, base + hi, v * weight) for f, t, lo, hi, v in nodes]
    feature, threshold, left, right, value = zip(*rows)
    return ForestScorer(np.array(feature), np.array(threshold, dtype=float), np.array(left), np.array(right),
                        np.array(value, dtype=float), np.array(roots), scale)


def scorer_of(spark: SparkSession, classifier: Model) -> Scorer:
    """The scorer of a fitted classifier, read from the form it is saved in."""
    if hasattr(classifier, "coefficients"):
        return LinearScorer(classifier.coefficients.toArray(), float(classifier.intercept))
    if not isinstance(classifier, GBTClassificationModel):
        raise TypeError(f"no scorer for {type(classifier).__name__}")
    folder = scratch(spark, "model")
    classifier.write().overwrite().save(folder)
    node = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*")
    trees: dict[int, dict[int, tuple]] = {}
    for r in node.select("treeID", "id", "prediction", "leftChild", "rightChild", "split.*").collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = _node(r)
    return forest([[t[i] for i in range(len(t))] for _, t in sorted(trees.items())], classifier.treeWeights)


def _node(r) -> tuple:
    if r["leftChild"] < 0:
        return -1, 0.0, 0, 0, r["prediction"]
    cut = r["leftCategoriesOrThreshold"]
    if r["numCategories"] < 0:
        return r["featureIndex"], cut[0], r["leftChild"], r["rightChild"], 0.0
    # entries of one-hot vectors are 0 or 1; the side of 0 is put on the left
    if r["numCategories"] != 2 or len(cut) != 1:
        raise ValueError("a split over more than two categories")
    children = (r["leftChild"], r["rightChild"]) if cut[0] == 0.0 else (r["rightChild"], r["leftChild"])
    return r["featureIndex"], 0.5, *children, 0.0
