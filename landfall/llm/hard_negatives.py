"""Hard negatives of anchors, by Fagin's threshold algorithm over blocks of vectors.

Anchors are the rows whose id is divisible by `ANCHOR_EVERY`, and all rows are
candidates. Rows are dealt to parts of about `PART` rows, anchors to blocks of about
`BLOCK`; each block meets each part in a task of its own. A part keeps one list of its
rows for every dimension, sorted by that component. For an anchor the lists are read
from the end that its sign prefers, all to the same depth; rows met for the first time
are scored in whole numbers. No row not yet met can score above the threshold, the sum
of the anchor's components times the components reached in the lists. The search ends
where the threshold is strictly below the last score that each window still wants, so
ties are met in full, or where all rows are met. What the parts found is ranked over
all of them.

Positives come first: an anchor meets the parts of its own label only, with one window
without bounds. Each different score of a positive then makes one window for negatives.

Blocks are taken `ROUND` at a time, each round's result is written down, so that the disk
that shuffles take grows with the rows, not with rows times anchors. A label of any share
of the rows is dealt to as many parts as it needs.

Edge cases: rows without a label or a vector, or with a component that is NULL or not
finite, take no part. A NULL id is no anchor, and comes after all ids in ties. Rows that
repeat an id are rows of their own, anchors too. Shorter vectors count as filled up with
zeros. Components beyond `LARGEST` after quantising count as that. An anchor alone with
its label has no positive, and no row in the result; a positive of negative score has an
empty window. Empty tables give empty results. Other columns are never looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
# A negative scores between these hundredths of its positive's score.
LEAST, MOST = 50, 95
SCALE = 256
LARGEST = 1 << 25
# Anchors of a block, rows of a part, blocks of a round.
BLOCK = 4096
PART = 8192
ROUND = 16
# Sorted access goes to this depth first, then twice as much further each time.
FIRST = 16
WHOLE = 1 << 53


def quantised(vector: Column) -> Column:
    """Whole numbers for the components."""
    top = F.lit(float(LARGEST))
    scaled = F.transform(
        vector.cast("array<double>"), lambda x: F.floor(F.greatest(-top, F.least(top, x * SCALE)))
    )
    return scaled.cast("array<int>")


def prepared(embeddings: DataFrame) -> DataFrame:
    """`uid`, `vec_id`, `label`, `anchor` and `q` of the rows that take part."""
    vector, number = F.col("embedding").cast("array<double>"), F.col("vec_id").cast("long")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.coalesce(number % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    rows = embeddings.filter(label.isNotNull() & vector.isNotNull() & ~odd).select(
        F.monotonically_increasing_id().alias("uid"),
        number.alias("vec_id"),
        moved.alias("label"),
        F.coalesce(number % ANCHOR_EVERY == 0, F.lit(False)).alias("anchor"),
        quantised(F.col("embedding")).alias("q"),
    )
    return saved(rows, "vectors")


class SortedLists:
    """A part's rows, and for each dimension the rows in order of that component."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, axis=0)


def ranked(place, score, windows, most):
    """For each window its best rows (score, then place), and the score that more must reach."""
    order = np.lexsort((place, -score))
    place, score = place[order], score[order]
    chosen, reach = [], []
    for low, high in windows:
        first = int(np.searchsorted(-score, -high, side="left"))
        end = int(np.searchsorted(-score, -low, side="right"))
        full = end - first >= most
        chosen.append(np.arange(first, min(first + most, end)))
        reach.append(score[first + most - 1] if full else low)
    return place, score, chosen, reach


def threshold_search(
    lists: SortedLists,
    anchor: np.ndarray,
    windows: list[tuple[int, int]],
    most: int,
    allowed: np.ndarray,
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For each window (least, greatest score) the places and scores of its best rows; rows scored.

    Rows of equal score are taken in the order of their places.
    """
    n = len(lists.rows)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    unseen = allowed.copy()
    left = int(np.count_nonzero(unseen))
    scored = 0
    place, score = np.zeros(0, np.int64), np.zeros(0, lists.rows.dtype)
    chosen = [np.zeros(0, np.int64)] * len(windows)
    depth, step = 0, FIRST
    while left and windows:
        end = min(n, depth + step)
        met = np.zeros(n, bool)
        if len(up) + len(down):
            met[lists.order[n - end : n - depth, up]] = True
            met[lists.order[depth:end, down]] = True
        else:
            met[:] = True
        new = np.flatnonzero(met & unseen)
        unseen[new] = False
        left -= len(new)
        scored += len(new)
        place = np.concatenate([place, new])
        score = np.concatenate([score, lists.rows[new] @ anchor])
        place, score, chosen, reach = ranked(place, score, windows, most)
        threshold = lists.values[n - end, up] @ anchor[up] + lists.values[end - 1, down] @ anchor[down]
        if all(threshold < least for least in reach):
            break
        kept = np.unique(np.concatenate(chosen))
        chosen = [np.searchsorted(kept, c) for c in chosen]
        place, score = place[kept], score[kept]
        depth, step = end, 2 * step
    return [(place[c], score[c]) for c in chosen], scored


def window_of(positive_score: int) -> tuple[int, int] | None:
    """The scores that negatives of a positive may have."""
    low, high = -(-LEAST * positive_score // 100), MOST * positive_score // 100
    return (low, high) if low <= high else None


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    sizes = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    values = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(starts, sizes)] = values
    return out


def both_matrices(rows: pa.Table, anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of both, as doubles where these hold every score exactly."""
    width = max(len(x) for side in (rows, anchors) for x in side.column("q"))
    a, b = matrix(rows.column("q"), width), matrix(anchors.column("q"), width)
    if width and width * int(np.abs(a).max()) * int(np.abs(b).max()) < WHOLE:
        return a.astype(np.float64), b.astype(np.float64)
    return a, b


FOUND = "a long, wanted long, uid long, vec_id long, score long"
_FOUND = pa.schema([(c, pa.int64()) for c in ("a", "wanted", "uid", "vec_id", "score")])


def best_of_part(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """The best rows of a part for each window of each anchor of a block.

    Anchors with `scores` look for negatives, others for positives.
    """
    if not (rows.num_rows and anchors.num_rows):
        return _FOUND.empty_table()
    rows = rows.sort_by([("vec_id", "ascending"), ("uid", "ascending")])  # NULL comes last
    uid, label = rows.column("uid").to_numpy(), rows.column("label").to_numpy()
    vectors, queries = both_matrices(rows, anchors)
    lists = SortedLists(vectors)
    out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for query, a, of, scores in zip(
        queries,
        anchors.column("uid").to_pylist(),
        anchors.column("label").to_pylist(),
        anchors.column("scores").to_pylist(),
        strict=True,
    ):
        if scores is None:
            wanted, windows, most, allowed = [0], [(-(1 << 62), 1 << 62)], POSITIVES, uid != a
        else:
            bounds = {s: window_of(s) for s in scores}
            wanted = [s for s, w in bounds.items() if w]
            windows, most, allowed = [bounds[s] for s in wanted], NEGATIVES, label != of
        found, _ = threshold_search(lists, query, windows, most, allowed)
        out += [(a, w, *f) for w, f in zip(wanted, found, strict=True)]
    sizes = [len(places) for _, _, places, _ in out]
    taken = np.concatenate([np.zeros(0, np.int64), *(places for _, _, places, _ in out)])
    scores = np.concatenate([np.zeros(0, np.int64), *(s.astype(np.int64) for *_, s in out)])
    return pa.table(
        {
            "a": np.repeat(np.array([x[0] for x in out], np.int64), sizes),
            "wanted": np.repeat(np.array([x[1] for x in out], np.int64), sizes),
            "uid": uid[taken],
            "vec_id": rows.column("vec_id").take(pa.array(taken)),
            "score": scores,
        },
        _FOUND,
    )


def met(rows: DataFrame, anchors: DataFrame, most_blocks: int) -> DataFrame:
    """What each block of anchors finds in each part of the rows of its group.

    Both sides have `group` and the number of its `blocks` and `parts`.
    """
    keys, found = ("group", "block", "part"), []
    dealt = lambda of: F.pmod(F.xxhash64("uid"), F.col(of)).cast("int")
    for base in range(0, most_blocks, ROUND):
        ends = F.least(F.col("blocks"), F.lit(base + ROUND)) - 1
        here = rows.filter(F.col("blocks") > base).select(
            "group",
            F.explode(F.sequence(F.lit(base), ends)).alias("block"),
            dealt("parts").alias("part"),
            *("uid", "vec_id", "label", "q"),
        )
        asked = anchors.withColumn("block", dealt("blocks"))
        # both sides may be of one frame, so one gets columns of its own
        own = (F.col(c).alias(c) for c in ("group", "block", "uid", "label", "q", "scores"))
        asked = asked.filter(F.col("block").between(base, base + ROUND - 1)).select(
            *own, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        )
        both = here.groupBy(*keys).cogroup(asked.groupBy(*keys))
        found.append(saved(both.applyInArrow(best_of_part, FOUND), "found"))
    return reduce(DataFrame.unionByName, found)


def first_of(found: DataFrame, most: int) -> DataFrame:
    """The best of all parts for each anchor and window, with their `rank`."""
    order = (F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    rank = F.row_number().over(Window.partitionBy("a", "wanted").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def shares(rows: Column, anchors: Column) -> tuple[Column, Column]:
    """How many parts and blocks so many rows and anchors make."""
    return (
        F.ceil(rows / PART).cast("int").alias("parts"),
        F.ceil(anchors / BLOCK).cast("int").alias("blocks"),
    )


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
    " negative_score long"
)


def mine(embeddings: DataFrame) -> DataFrame:
    """For each anchor and positive the first negatives of the positive's window."""
    rows = prepared(embeddings)
    counted = F.count("*").alias("n"), F.count_if("anchor").alias("m")
    sizes = rows.groupBy("label").agg(*counted).filter("m > 0")
    total = sizes.agg(F.sum("m").alias("m"), F.max("m").alias("most")).first()
    if not total["m"]:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    n = rows.count()
    own = sizes.select(F.col("label").alias("group"), *shares(F.col("n"), F.col("m")))
    nothing = F.lit(None).cast("array<long>").alias("scores")
    labelled = rows.withColumn("group", F.col("label")).join(own, "group")
    anchors = labelled.filter("anchor").withColumn("scores", nothing)
    positives = first_of(met(labelled, anchors, -(-total["most"] // BLOCK)), POSITIVES)
    positives = saved(
        positives.select(
            "a", F.col("vec_id").alias("positive_id"), F.col("uid").alias("b"), F.col("score").alias("wanted")
        ),
        "positives",
    )
    scores = positives.groupBy(F.col("a").alias("uid")).agg(F.collect_set("wanted").alias("scores"))
    grouped = rows.select("*", F.lit(0).alias("group"), *shares(F.lit(n), F.lit(total["m"])))
    negatives = met(grouped, grouped.filter("anchor").join(scores, "uid"), -(-total["m"] // BLOCK))
    anchor_ids = rows.filter("anchor").select(F.col("uid").alias("a"), F.col("vec_id").alias("anchor_id"))
    return (
        positives.join(first_of(negatives, NEGATIVES), ["a", "wanted"])
        .join(anchor_ids, "a")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("wanted").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
