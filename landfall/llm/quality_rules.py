"""Rules on text statistics, and an isolation forest over what passes them.

Base rules reject a text of fewer than 50 words, or with more than half of its
words in repeated windows of three words. The others are judged by isolation
forests over ratios of the counts: trees of random splits, in which an odd text is
alone after few splits. Each group of ratios has a forest, so that a text odd in one
group is not hidden by the splits on the others; the forests see all ratios between
them. They are grown from labelled texts, and the score of each beyond which a text is
rejected is set where the labelled texts are told apart best while at most its share
of `max_false` of the good ones go.

Edge cases: a NULL text is an empty one and fails the base rules. Rows with a
NULL id are judged like others, but carry no label. Repeated rows get equal
verdicts, as do texts with equal counts; a score equal to the threshold is rejected, and
of thresholds that tell labels apart equally well the highest is taken. A very long text
is counted whole in one task, in memory that grows with that text alone, and its ratios
do not grow with its length. An empty table gives an empty result. Without any labelled text the
base rules alone decide. Other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drawn, saved
from .statistics import COUNTS, FEATURES, features, text_counts

MIN_WORDS = 50
TREES = 100
# Rows a tree is grown from, and of all trees together: the sample has that bound.
TREE_ROWS = 256
SAMPLE_ROWS = 10_000
MAX_FALSE = 0.005
# What each forest looks at: make of words, repetition, kinds of characters and lines.
GROUPS = tuple(
    tuple(map(FEATURES.index, names))
    for names in (
        ("symbols", "short", "upper", "word_length"),
        ("dup_lines", "repeat_words", "most_common", "distinct"),
        ("digits", "punctuation", "stops", "wide", "line_words"),
    )
)
BINS = 2_000
EULER = 0.5772156649015329


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def mean_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of a search that fails in a binary tree of n rows."""
    n = np.asarray(n, float)
    above = np.maximum(n, 2)
    depth = 2 * (np.log(np.maximum(above - 1, 1)) + EULER) - 2 * (above - 1) / above
    return np.where(n > 2, depth, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays, a row a tree: a node's feature (-1: leaf), split, children, path length."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    rows: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, from 0 to 1: 2 to the power of -(mean path / expected path)."""
        out = np.empty(len(x))
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            which = np.arange(len(part))
            total = np.zeros(len(part))
            for feature, split, left, depth in zip(
                self.feature, self.split, self.left, self.depth, strict=True
            ):
                node = np.zeros(len(part), np.int64)
                while (inner := feature[node] >= 0).any():
                    right = part[which, feature[node]] >= split[node]
                    node = np.where(inner, left[node] + right, node)
                total += depth[node]
            out[at : at + 4096] = total / len(self.feature)
        return 2.0 ** (-out / max(float(mean_depth(self.rows)), 1e-9))


def grow_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Each tree splits its own draw of rows at random points of random features."""
    random = np.random.default_rng(seed)
    rows = min(rows, len(x))
    limit = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    grown = []
    for _ in range(trees):
        nodes: list[list[float]] = [[-1, 0.0, 0, 0.0]]
        todo = [(0, x[random.choice(len(x), rows, replace=False)], 0)]
        while todo:
            at, part, depth = todo.pop()
            low, high = part.min(0), part.max(0)
            open_features = np.flatnonzero(high > low)
            if depth == limit or len(part) < 2 or not len(open_features):
                nodes[at][3] = depth + float(mean_depth(len(part)))
                continue
            chosen = int(random.choice(open_features))
            split = random.uniform(low[chosen], high[chosen])
            if split <= low[chosen]:
                split = high[chosen]
            child = len(nodes)
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
            nodes[at][:3] = [chosen, split, child]
            beyond = part[:, chosen] >= split
            todo += [(child, part[~beyond], depth + 1), (child + 1, part[beyond], depth + 1)]
        grown.append(nodes)
    size = max(map(len, grown))
    table = np.zeros((trees, size, 4))
    table[:, :, 0] = -1
    for i, nodes in enumerate(grown):
        table[i, : len(nodes)] = nodes
    return Forest(
        table[:, :, 0].astype(np.int64),
        table[:, :, 1],
        table[:, :, 2].astype(np.int64),
        table[:, :, 3],
        rows,
    )


@dataclass(frozen=True)
class Rules:
    """A forest a group and the score from which it rejects a text; no forests reject nothing."""

    forests: tuple[Forest, ...]
    thresholds: tuple[float, ...]

    def scores(self, counts: Column) -> Column:
        """Score by each forest of a struct of COUNTS."""
        forests = self.forests

        @F.arrow_udf(returnType=T.ArrayType(T.DoubleType()))
        def score(rows: pa.Array) -> pa.Array:
            columns = dict(zip(COUNTS, map(np.asarray, rows.flatten()), strict=True))
            seen = features(columns)
            parts = zip(forests, GROUPS, strict=True)
            scored = np.column_stack([forest.score(seen[:, group]) for forest, group in parts])
            offsets = np.arange(0, scored.size + 1, len(forests), dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scored.ravel()))

        return score(counts)

    def anomaly(self, counts: Column) -> Column:
        """The greatest score in terms of its forest's threshold: rejected from 1 on."""
        if not self.forests:
            return F.lit(0.0)
        limits = F.array(*map(F.lit, self.thresholds))
        return F.array_max(F.zip_with(self.scores(counts), limits, lambda s, limit: s / limit))

    def rejects(self, counts: Column, anomaly: Column) -> Column:
        failed = base_failed(counts["n_words"], counts["n_repeat_words"])
        return failed | (anomaly >= 1.0)


def fit_rules(
    counted: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    max_false: float = MAX_FALSE,
) -> Rules:
    """Grow the forests and set their thresholds.

    `counted` has `doc_id` and `counts`; `labels` has `doc_id` and `quality`. At most
    `sample_rows` labelled rows come to the driver to grow trees from. The thresholds
    look at every labelled row, as histograms of scores.
    """
    known = labels.select("doc_id", "quality").filter("quality IN (0, 1)").distinct()
    counts = F.col("counts")
    rows = counted.select("doc_id", "counts").join(known, "doc_id")
    rows = rows.filter(~base_failed(counts["n_words"], counts["n_repeat_words"]))
    sample = drawn(rows.select("doc_id", "counts.*"), sample_rows, "doc_id", *COUNTS).toPandas()
    if sample.empty:
        return Rules((), ())
    seen = features({name: sample[name].to_numpy() for name in COUNTS})
    forests = tuple(grow_forest(seen[:, group]) for group in GROUPS)
    scores = Rules(forests, ()).scores(counts)
    each = rows.select("quality", F.posexplode(scores).alias("forest", "score"))
    bin_ = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin")
    tally = each.groupBy("forest", bin_, "quality").count().collect()
    histograms = np.zeros((len(GROUPS), 2, BINS + 1))
    for row in tally:
        histograms[row["forest"], row["quality"], row["bin"]] += row["count"]
    share = max_false / len(GROUPS)
    return Rules(forests, tuple(threshold(histogram, share) for histogram in histograms))


def threshold(histogram: np.ndarray, max_false: float) -> float:
    """The score that tells bad (row 0) from good (row 1) best while few good ones reach it.

    A histogram has a bin for scores from each 1 / BINS on, and an empty last one.
    """
    beyond = np.cumsum(histogram[:, ::-1], axis=1)[:, ::-1]  # rows with at least this score
    bad, good = beyond[0] / max(beyond[0, 0], 1), beyond[1] / max(beyond[1, 0], 1)
    gain = np.where(good <= max_false, bad - good, -1.0)
    return float(BINS - np.argmax(gain[::-1])) / BINS


def judge(counted: DataFrame, rules: Rules) -> DataFrame:
    """`doc_id`, base counts, `base_failed`, `kept` and the anomaly for rows with `counts`."""
    counts = F.col("counts")
    scored = counted.select("doc_id", "counts", rules.anomaly(counts).alias("anomaly"))
    return scored.select(
        "doc_id",
        *(f"counts.{name}" for name in ("n_words", "word_chars", "n_symbols")),
        *(f"counts.{name}" for name in ("n_dup_lines", "n_repeat_words")),
        base_failed(counts["n_words"], counts["n_repeat_words"]).alias("base_failed"),
        (~rules.rejects(counts, F.col("anomaly"))).alias("kept"),
        "anomaly",
    )


def count_documents(documents: DataFrame) -> DataFrame:
    """Counts of every text, worked out once and kept in the shared folder."""
    counted = documents.select("doc_id", text_counts().alias("counts"))
    return saved(counted, "counts")


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every document; see the module for edge cases."""
    counted = count_documents(documents)
    return judge(counted, fit_rules(counted, labels))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns as they were."""
    rules = fit_rules(count_documents(documents), labels)
    counts = text_counts()
    return documents.filter(~rules.rejects(counts, rules.anomaly(counts)))
