"""Removal of passages that stand earlier in the corpus, by prefix-partitioned suffix trees.

A word goes if a window of `WINDOW` words that covers it has the same words as a
window that starts earlier, in a document of smaller id or earlier in its own. So of
the corpus' suffix tree only the internal nodes of at least that depth count, and of
each node's suffixes only the first stays.

1. Anchors. Of each window's runs of `ANCHOR` words one is chosen by its hash, so two
   equal windows choose equal runs. Windows whose anchor occurs just once have no
   equal; they make up most of the corpus and are not looked at further.
2. Subtrees. Each task takes its remaining suffixes in parts that fit in memory and
   splits them by prefixes: of 1 word, and of 2, 4, 8, 16 and WINDOW words where a
   group is still too large. A group's suffixes are sorted; those that agree over
   WINDOW words hang below one deep node, of which the first suffix is kept, and
   the others are repeats.
3. The first suffixes of equal nodes of different parts meet in a shuffle by anchor.
   A node is there once a part, however often its words occur: a passage in a third
   of all documents is no hot key.
4. Repeats are gathered by document and their words left out.

Paths are compared by 128 bits of hashes, 64 over the anchor and 64 over all words.

Edge cases: a NULL text has no words; texts below WINDOW words lose none. A NULL id
comes after all others. Rows of equal ids are documents of their own, in the order in
which the table is read. An empty table gives an empty result. Other columns are never
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import joined, mix, saved, text_of, word_hashes, words_of

WINDOW = 20
ANCHOR = 5
# Words of the prefixes that groups of suffixes are split by, one after the other.
DEPTHS = (1, 2, 4, 8, 16, WINDOW)
# Suffixes of a group, of a part, and anchors of a part.
GROUP, PART, ANCHORS = 1 << 16, 1 << 20, 1 << 21


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many words, by joining runs of powers of two."""
    out, taken, power, runs = None, 0, 1, words
    while size:
        if size & power:
            part = runs[taken:]
            out = part if out is None else joined(out[: len(part)], part[: len(out)])
            taken += power
            size -= power
        if size:
            runs = joined(runs[:-power], runs[power:]) if len(runs) > power else runs[:0]
            power *= 2
    return out


def anchors_of(words: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of `anchor` words, and the run that each window chooses."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs = run_hashes(words, anchor)
    width = window - anchor + 1
    least = sliding_window_view(runs, width)[:, ::-1].argmin(axis=1)
    return runs, width - 1 - least + np.arange(len(runs) - width + 1)


def anchors(text: Column) -> Column:
    """Hashes of the runs a text's windows choose, each chosen run once."""

    @F.arrow_udf(returnType="array<bigint>")
    def found(texts: pa.Array) -> pa.Array:
        values = []
        for x in texts:
            runs, chosen = anchors_of(word_hashes(words_of(x.as_py())))
            values.append(runs[np.unique(chosen)].view(np.int64))
        ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *values])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return found(text)


def runs_of(batches: Iterator[pa.RecordBatch], most: int, column: str) -> Iterator[tuple]:
    """Documents in parts of some list values: uid of each value, and the values."""
    ids, values, size = [], [], 0
    for batch in batches:
        lists = batch.column(column)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        counts = np.diff(lists.offsets.to_numpy())
        uid = np.repeat(batch.column("uid").to_numpy(), counts)
        for at in range(0, len(flat), most):
            ids.append(uid[at : at + most])
            values.append(flat[at : at + most])
            size += len(values[-1])
            if size >= most:
                yield np.concatenate(ids), np.concatenate(values)
                ids, values, size = [], [], 0
    if size:
        yield np.concatenate(ids), np.concatenate(values)


def lists_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """The values of equal keys as lists; keys are in order."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else keys
    ends = pa.array(np.append(starts, len(keys)).astype(np.int32))
    return keys[starts], pa.ListArray.from_arrays(ends, pa.array(values))


def repeated_anchors(known: DataFrame) -> DataFrame:
    """`uid` and the hashes of its anchors that occur again somewhere."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, hashes in runs_of(batches, ANCHORS, "anchors"):
            order = np.argsort(hashes, kind="stable")
            uid, hashes = uid[order], hashes[order]
            first = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            starts = np.flatnonzero(first)
            again = np.diff(np.append(starts, len(hashes))) > 1
            n = len(starts)
            # one row of each anchor, to meet those of other parts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[starts]),
                    pa.array(uid[starts]),
                    pa.array(again),
                    pa.nulls(n, pa.list_(pa.int64())),
                ],
                ["key", "uid", "again", "hashes"],
            )
            # anchors known to occur again, by document
            twice = np.repeat(again, np.diff(np.append(starts, len(hashes))))
            order = np.argsort(uid[twice], kind="stable")
            ids, lists = lists_by(uid[twice][order], hashes[twice][order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(ids).view(np.int64)), pa.array(ids), pa.array(np.ones(len(ids), bool)), lists],
                ["key", "uid", "again", "hashes"],
            )

    rows = known.select("uid", "anchors").mapInArrow(
        tally, "key long, uid long, again boolean, hashes array<bigint>"
    )
    alike = Window.partitionBy("key", F.col("hashes").isNull())
    met = rows.withColumn("n", F.count("*").over(alike))
    wanted = met.filter("hashes IS NOT NULL OR (n > 1 AND NOT again)")
    each = F.coalesce("hashes", F.array("key"))
    return wanted.groupBy("uid").agg(F.flatten(F.collect_list(each)).alias("hashes"))


def deep_nodes(paths: dict[int, np.ndarray], group: int = GROUP) -> np.ndarray:
    """For each suffix, in order of its place in the corpus, the first suffix of its deep node.

    `paths` has the hash of each suffix's prefix of so many words. Groups are split by
    longer and longer prefixes until they are small; in each, suffixes are sorted by
    their whole path, which puts those below one node side by side.
    """
    depths = sorted(paths)
    whole = paths[depths[-1]]
    first = np.arange(len(whole))
    todo = [(first, 0)]
    while todo:
        members, level = todo.pop()
        if len(members) > group and level < len(depths) - 1:
            prefix = paths[depths[level]][members]
            order = np.argsort(prefix, kind="stable")
            cuts = np.flatnonzero(prefix[order][1:] != prefix[order][:-1]) + 1
            small: list[np.ndarray] = []  # neighbours that fit in one group share it
            held = 0
            for part in np.split(members[order], cuts) if len(cuts) < len(members) // 64 else [members[order]]:
                if len(part) > group:
                    todo.append((part, level + 1))
                elif held + len(part) > group:
                    todo.append((np.concatenate([*small, part]), len(depths)))
                    small, held = [], 0
                else:
                    small.append(part)
                    held += len(part)
            if small:
                todo.append((np.concatenate(small), len(depths)))
            continue
        order = np.argsort(whole[members], kind="stable")
        path, places = whole[members][order], members[order]
        new = np.concatenate(([True], path[1:] != path[:-1]))
        heads = np.flatnonzero(new)
        lead = np.minimum.reduceat(places, heads) if len(heads) else places
        first[places] = lead[np.cumsum(new) - 1]
    return first


SUFFIXES = "anchor long, id long, uid long, start int, paths array<bigint>, starts array<int>"
_SUFFIXES = ["anchor", "id", "uid", "start", "paths", "starts"]


def prefix_hashes(words: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the runs of 1, 2, 4, 8, 16 and WINDOW words, one made of the others."""
    out = {1: words}
    for depth in DEPTHS[1:-1]:
        half = out[depth // 2]
        out[depth] = joined(half[: -(depth // 2)], half[depth // 2 :])
    rest = out[WINDOW - DEPTHS[-2]][DEPTHS[-2] :]
    out[WINDOW] = joined(out[DEPTHS[-2]][: len(rest)], rest)
    return out


def find_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees of a task's suffixes: each deep node's first suffix, and the repeats by document.

    First suffixes that stand next to each other and have one anchor go in one row,
    with the hash of each one's path.
    """
    parts: list[tuple[int, int, np.ndarray, np.ndarray, dict[int, np.ndarray]]] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal parts, held
        parts.sort(key=lambda part: part[:2])
        sizes = [len(part[2]) for part in parts]
        id_ = np.repeat([part[0] for part in parts], sizes)
        uid = np.repeat([part[1] for part in parts], sizes)
        start = np.concatenate([part[2] for part in parts])
        anchor = np.concatenate([part[3] for part in parts])
        paths = {d: np.concatenate([part[4][d] for part in parts]) for d in DEPTHS}
        keep = deep_nodes(paths) == np.arange(len(start))
        ids, lists = lists_by(uid[~keep], start[~keep].astype(np.int32))
        none = pa.array(np.zeros(len(ids), np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(mix(ids).view(np.int64)),
                none,
                pa.array(ids),
                none.cast(pa.int32()),
                pa.nulls(len(ids), pa.list_(pa.int64())),
                lists,
            ],
            _SUFFIXES,
        )
        id_, uid, start, anchor = id_[keep], uid[keep], start[keep], anchor[keep]
        new = np.ones(len(start), bool)
        new[1:] = (uid[1:] != uid[:-1]) | (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        heads, lists = lists_by(np.cumsum(new), paths[WINDOW][keep].view(np.int64))
        first = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor[first].view(np.int64)),
                pa.array(id_[first]),
                pa.array(uid[first]),
                pa.array(start[first].astype(np.int32)),
                lists,
                pa.nulls(len(first), pa.list_(pa.int32())),
            ],
            _SUFFIXES,
        )
        parts, held = [], 0

    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("id", "uid", "text", "hashes")), strict=True):
            id_, uid, text = (x.as_py() for x in row[:3])
            wanted = np.unique(row[3].values.to_numpy(zero_copy_only=False)).view(np.uint64)
            words = word_hashes(words_of(text))
            runs, chosen = anchors_of(words)
            starts = np.flatnonzero(np.isin(runs, wanted)[chosen])
            hashes = prefix_hashes(words)
            for at in range(0, len(starts), PART):
                piece = starts[at : at + PART]
                paths = {d: path[piece] for d, path in hashes.items()}
                parts.append((id_, uid, piece, runs[chosen[piece]], paths))
                held += len(piece)
                if held >= PART:
                    yield from flush()
    if parts:
        yield from flush()


def repeats(known: DataFrame) -> DataFrame:
    """`uid` and the starts of its windows that stand earlier in the corpus.

    Equal windows have one anchor, so rows are dealt by it, and what is compared
    within an anchor is the hash of the whole path.
    """
    again = saved(repeated_anchors(known), "again")
    suspects = known.select("id", "uid", "text").join(again, "uid")
    suffixes = suspects.select("id", "uid", "text", "hashes").mapInArrow(find_suffixes, SUFFIXES)
    single = suffixes.repartition("anchor").select(
        "anchor", "id", "uid", "start", "starts", F.posexplode_outer("paths").alias("step", "path")
    )
    single = single.withColumn("at", F.col("start") + F.coalesce("step", F.lit(0)))
    node = Window.partitionBy("anchor", "path").orderBy("id", "uid", "at")
    placed = single.withColumn("place", F.row_number().over(node))
    known_again = placed.filter("starts IS NOT NULL OR place > 1")
    each = F.coalesce("starts", F.array("at"))
    return known_again.groupBy("uid").agg(F.flatten(F.collect_list(each)).alias("starts"))


LEFT = "n_words long, n_removed long, kept string"


def covered(n: int, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which of n words the windows at the starts cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0


def words_left(text: Column, starts: Column, digest: bool) -> Column:
    """Words of a text, words removed, and the words left, or their SHA-256."""

    @F.arrow_udf(returnType=LEFT)
    def left(texts: pa.Array, lists: pa.Array) -> pa.Array:
        total, removed, kept = [], [], []
        for x, y in zip(texts, lists, strict=True):
            words = words_of(x.as_py())
            total.append(len(words))
            removed.append(0)
            if y.is_valid:
                gone = covered(len(words), y.values.to_numpy(zero_copy_only=False).astype(np.int64))
                removed[-1] = int(gone.sum())
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            body = b" ".join(words)
            kept.append(hashlib.sha256(body).hexdigest() if digest else body.decode())
        columns = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_removed", "kept"])

    return left(text, starts)


def remove_repeats(documents: DataFrame, digest: bool = False) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed` and `kept`: the words left, or their SHA-256."""
    last = (1 << 63) - 1
    known = saved(
        documents.select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("id"),
            text_of().alias("text"),
            anchors(text_of()).alias("anchors"),
        ),
        "anchors",
    )
    gone = saved(repeats(known), "repeats")
    rows = known.select("uid", "doc_id", "text").join(gone, "uid", "left")
    left = rows.select("doc_id", words_left(F.col("text"), F.col("starts"), digest).alias("left"))
    return left.select("doc_id", "left.*")
