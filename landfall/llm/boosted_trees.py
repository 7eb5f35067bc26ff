"""A quality score from gradient-boosted trees over text statistics.

Trees are grown on histograms: every feature is cut into at most 64 bins, a node's
gradients are summed by bin, and the split with the largest gain is taken. All
trees become arrays that numpy walks for a whole batch of rows at once.

Only labelled rows whose crc32(doc_id as text) mod 5 is not 0 are learnt from, at
most `TRAIN_ROWS` of them, drawn by a hash; every document is scored. Inputs are
ratios and counts of the text alone.

Edge cases: a NULL text is scored as an empty one. A NULL id is not held out and
has no label. Repeated rows get equal scores. With no labelled row every score is
0.5; an empty table gives an empty result. Other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drawn, saved
from .statistics import COUNTS, features, text_counts

TRAIN_ROWS = 20_000
FOLDS = 5
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST_WEIGHT = 2.0
THRESHOLD = 0.3


def inputs(counts: dict[str, np.ndarray]) -> np.ndarray:
    """The ratios and the logarithms of how much text there is."""
    size = [np.log1p(np.asarray(counts[name], float)) for name in ("n_words", "n_lines")]
    return np.column_stack([features(counts), *size])


@dataclass(frozen=True)
class Boosted:
    """Complete trees of one depth: a row a tree, inner nodes in breadth-first order."""

    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        which = np.arange(len(x))
        for feature, split, leaf in zip(self.feature, self.split, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(feature):  # all rows are on one level
                node = 2 * node + 1 + (x[which, feature[node]] > split[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Boosted:
    """Boost trees on the logistic loss."""
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(width)])
    inner, margin = 2**depth - 1, np.full(n, base)
    features_, splits, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        feature, split = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            cut = np.full(count, BINS)
            for j in range(width):
                at = (node - first) * BINS + binned[:, j]
                g = np.bincount(at, gradient, count * BINS).reshape(count, BINS)
                h = np.bincount(at, weight, count * BINS).reshape(count, BINS)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                ga, ha = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                gain[(hl < LEAST_WEIGHT) | (ha - hl < LEAST_WEIGHT)] = -1
                gain[:, len(edges[j]) :] = -1  # there is no edge to cut at
                top = gain.argmax(1)
                better = gain[np.arange(count), top] > best
                best = np.where(better, gain[np.arange(count), top], best)
                cut = np.where(better, top, cut)
                feature[first : first + count][better] = j
            for k in np.flatnonzero(cut < BINS):
                split[first + k] = edges[feature[first + k]][cut[k]]
            chosen = feature[node]
            node = 2 * node + 1 + (x[np.arange(n), chosen] > split[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
        value = RATE * g / (h + RIDGE)
        margin += value[leaf]
        features_.append(feature)
        splits.append(split)
        leaves.append(value)
    return Boosted(np.array(features_), np.array(splits), np.array(leaves), base)


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(False))


def fit_quality(counted: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Boosted | None:
    """Train on at most `train_rows` labelled rows outside the held-out fold."""
    known = labels.select("doc_id", "quality").filter("quality IN (0, 1)").distinct()
    rows = counted.join(known.filter(~held_out()), "doc_id").select("doc_id", "counts.*", "quality")
    sample = drawn(rows, train_rows, "doc_id", "quality", *COUNTS).toPandas()
    if sample.empty:
        return None
    x = inputs({name: sample[name].to_numpy() for name in COUNTS})
    return train(x, sample["quality"].to_numpy(float))


def quality_score(model: Boosted | None, counts: Column) -> Column:
    """Score of a struct of COUNTS, from 0 to 1."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf(returnType=T.DoubleType())
    def score(rows: pa.Array) -> pa.Array:
        columns = dict(zip(COUNTS, map(np.asarray, rows.flatten()), strict=True))
        return pa.array(model.score(inputs(columns)))

    return score(counts)


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every document."""
    counted = saved(documents.select("doc_id", text_counts().alias("counts")), "counts")
    model = fit_quality(counted, labels)
    scored = counted.select(
        "doc_id", held_out().alias("held_out"), quality_score(model, F.col("counts")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
