"""Near-duplicates by Order MinHash, verified by banded alignment.

A text's shingles are its runs of `K` words, each told apart from its equals by the
number of its occurrence. Each of `SKETCHES` hash functions picks the `MINIMA`
smallest of them, puts them back in text order and hashes the tuple; so a tuple agrees
in two texts that share the shingles in the same order, at `SIMILARITY` with a chance
of some 0.64. Every pair of neighbouring tuples is a key. Texts that share a key become candidates: each with the key's hub, the
text that meets most others, so a group of any size costs as many pairs as it has texts.
The greatest of a text's hubs is compared first; the others only where that leaves the
two in different groups. Texts of a key that are in different classes after that are
compared with each other, in blocks of bounded size: so any two texts that share a key
are compared, or already in one class. Of two texts the sizes and tuples are looked at
first, as these are narrow: texts are fetched only if one is long enough for the other
and they agree in `AGREEING` tuples, which two that are alike miss with a chance of some
1 in 20,000 beside that of sharing no key, some 1 in 2,000.

A candidate pair counts if the best alignment of the two rows of shingles matches so
many that matches / (all - matches) is at least `SIMILARITY`. The alignment keeps to
the band of offsets outside of which it could not reach that. Classes are the
connected components of the pairs.

Texts of equal words are one text from the start, so copies cost nothing further on.

Edge cases: a NULL text is an empty one; texts without words are copies of each other.
Texts below K words are only alike if their words are equal. A NULL id comes after all
others; rows of equal ids are documents of their own, in the order in which the table
is read. A class goes by the smallest id in it, NULL only if none has an id. An empty
table gives an empty result. Other columns are never looked at, and stay as they are
in `keep_first`.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import joined, mix, saved, within, word_hashes, words_of
from .components import components
from .repeats import run_hashes

K = 5
SIMILARITY = 0.8
SKETCHES = 24
MINIMA = 2
# Tuples in which two texts must agree to be compared.
AGREEING = 6
# Pairs that may be broadcast, at some 50 bytes each.
FEW_PAIRS = 1_000_000
# Hashes worked out at once.
BLOCK = 1 << 20
# Texts and characters of a block; texts of one key are compared two blocks at a time.
TEXTS = 256
CHARACTERS = 8 << 20


def occurrences(shingles: np.ndarray) -> np.ndarray:
    """Shingles hashed with the number of their occurrence, in text order."""
    order = np.argsort(shingles, kind="stable")
    same = shingles[order]
    at = np.arange(len(same))
    start = np.maximum.accumulate(np.where(np.concatenate(([True], same[1:] != same[:-1])), at, 0))
    out = np.empty(len(same), np.uint64)
    out[order] = joined(same, (at - start).astype(np.uint64))
    return out


def order_sketch(items: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA) -> np.ndarray:
    """For each hash function the hash of its smallest items in text order."""
    out = np.empty(sketches, np.uint64)
    step = max(1, BLOCK // max(1, len(items)))
    keep = min(minima, len(items))
    for at in range(0, sketches, step):
        ranks = np.stack([mix(items, j + 1) for j in range(at, min(at + step, sketches))])
        least = np.sort(np.argpartition(ranks, keep - 1, axis=1)[:, :keep], axis=1)
        tuple_ = items[least[:, 0]]
        for column in range(1, keep):
            tuple_ = joined(tuple_, items[least[:, column]])
        out[at : at + step] = tuple_
    return out


SIGNED = "same_a long, same_b long, size long, sketch array<bigint>"


def signed(text: Column) -> Column:
    """A struct: 128 bits that tell whether words are equal, the number of shingles, and the tuples."""

    @F.arrow_udf(returnType=SIGNED)
    def sign(texts: pa.Array) -> pa.Array:
        same, sketches = [], []
        for x in texts:
            words = word_hashes(words_of(x.as_py()))
            place = np.arange(len(words), dtype=np.uint64)
            ordered = joined(words, place)
            shingles = run_hashes(words, K)
            same.append((_sum(ordered), _sum(mix(ordered, 1)) + len(words), len(shingles)))
            if len(shingles):
                sketches.append(order_sketch(occurrences(shingles)).view(np.int64))
            else:
                sketches.append(np.zeros(0, np.int64))
        ends = np.cumsum([0, *map(len, sketches)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *sketches]))
        )
        told = np.array(same, np.uint64).reshape(-1, 3).view(np.int64)
        return pa.StructArray.from_arrays(
            [*(pa.array(told[:, c]) for c in range(3)), lists], ["same_a", "same_b", "size", "sketch"]
        )

    return sign(text)


def _sum(hashes: np.ndarray) -> int:
    return int(np.add.reduce(hashes, dtype=np.uint64)) if len(hashes) else 0


def matches(a: list[int], b: list[int], low: int, high: int) -> int:
    """Most matches of an alignment of two rows whose offsets (b's place - a's) are in a band."""
    places: dict[int, list[int]] = defaultdict(list)
    for j, item in enumerate(b):
        places[item].append(j)
    tails: list[int] = []  # least end in b of an alignment with so many matches
    for i, item in enumerate(a):
        found = places.get(item)
        if found is None:
            continue
        first, end = bisect_left(found, i + low), bisect_left(found, i + high + 1)
        for j in reversed(found[first:end]):
            at = bisect_left(tails, j)
            if at == len(tails):
                tails.append(j)
            else:
                tails[at] = j
    return len(tails)


def needed(both: np.ndarray | int, similarity: float = SIMILARITY) -> np.ndarray:
    """Matches that two rows of so many shingles in all must have."""
    return np.ceil(similarity * both / (1 + similarity) - 1e-9).astype(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity of two rows of shingles, or 0 if it is below the one asked for."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    need = int(needed(n + m, similarity))
    if min(n, m) < need:
        return 0.0
    least = min(n, m)
    unlike = np.flatnonzero(a[:least] != b[:least])
    head = int(unlike[0]) if len(unlike) else least
    rest = least - head
    unlike = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(unlike[0]) if len(unlike) else rest
    a, b = a[head : n - tail], b[head : m - tail]
    alike = head + tail
    # no alignment matches more than both have of each shingle
    values, counts = np.unique(a, return_counts=True)
    others, more = np.unique(b, return_counts=True)
    _, mine, theirs = np.intersect1d(values, others, assume_unique=True, return_indices=True)
    if alike + int(np.minimum(counts[mine], more[theirs]).sum()) < need:
        return 0.0
    # an alignment with enough matches skips at most n - need of a and m - need of b
    alike += matches(a.tolist(), b.tolist(), need - n, m - need)
    return alike / (n + m - alike) if alike >= need else 0.0


def shingles_of(text: str) -> np.ndarray:
    return run_hashes(word_hashes(words_of(text)), K)


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those that are alike."""
    hub, of_hub = None, None
    for batch in batches:
        kept = []
        for row in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b")), strict=True):
            a, b = row[0].as_py(), row[1].as_py()
            if a != hub:
                hub, of_hub = a, shingles_of(row[2].as_py())
            if aligned(of_hub, shingles_of(row[3].as_py())) > 0:
                kept.append((a, b))
        both = np.array(kept, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def shared_counts(rows: list[np.ndarray]) -> np.ndarray:
    """How many items each two rows of distinct items have in common."""
    n = len(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    _, item, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    several = counts > 1
    column = np.cumsum(several) - 1
    owner, column = owner[several[item]], column[item[several[item]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out, step = np.zeros((n, n), np.float32), max(1, (1 << 22) // n)
    for base in range(0, int(several.sum()), step):
        first, end = np.searchsorted(column, [base, base + step])
        part = np.zeros((n, int(column[end - 1]) + 1 - base), np.float32)
        part[owner[first:end], column[first:end] - base] = 1
        out += part @ part.T
    return out.astype(np.int64)


def open_pairs(rows: pa.Table) -> np.ndarray:
    """Which two texts of one or two blocks of a key are still to be compared, by what is narrow.

    They are in different classes, agree in `AGREEING` tuples, are long enough for each
    other, and share no earlier key, to which they would be left.
    """
    root, block, size = (rows.column(c).to_numpy() for c in ("root", "block", "size"))
    sketch = rows.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(root), -1)
    todo = np.triu(root[:, None] != root[None, :], 1)
    if rows.column("low")[0] != rows.column("high")[0]:
        todo &= block[:, None] != block[None, :]
    if not todo.any():
        return todo
    todo &= np.minimum(size[:, None], size[None, :]) >= needed(size[:, None] + size[None, :])
    equal = [column[:, None] == column[None, :] for column in sketch.T]
    agreeing = np.zeros(todo.shape, np.uint8)
    for same in equal:
        agreeing += same
    todo &= agreeing >= AGREEING
    for before in range(rows.column("nth")[0].as_py()):
        todo &= ~(equal[before] & equal[(before + 1) % len(equal)])
    return todo


ASKED = "key long, low int, high int, uid long"


def asked(rows: pa.Table) -> pa.Table:
    """The texts of one or two blocks that have another to be compared with."""
    todo = open_pairs(rows)
    return rows.select(["key", "low", "high", "uid"]).filter(pa.array(todo.any(0) | todo.any(1)))


def compared(rows: pa.Table) -> pa.Table:
    """Links between classes among the texts of one or two blocks of a key.

    The count of shared shingles bounds the matches, so only pairs that may be alike are
    aligned.
    """
    uid, root = rows.column("uid").to_numpy(), rows.column("root").to_numpy()
    a, b = np.nonzero(open_pairs(rows))
    found = []
    if len(a):
        used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = at[: len(a)], at[len(a) :]
        uid, root = uid[used], root[used].tolist()
        shingles = [shingles_of(x) for x in rows.column("text").take(pa.array(used)).to_pylist()]
        sizes = np.array([len(x) for x in shingles])
        least = needed(sizes[a] + sizes[b])
        common = shared_counts([occurrences(x) for x in shingles])[a, b]
        often = np.flatnonzero(common >= least)
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while x in above:
                x = above[x]
            return x

        for k in often[np.argsort(least[often] - common[often], kind="stable")].tolist():
            i, j = int(a[k]), int(b[k])
            one, other = top(root[i]), top(root[j])
            if one != other and aligned(shingles[i], shingles[j]) > 0:
                above[one] = other
                found.append((uid[i], uid[j]))
    both = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": both[:, 0], "b": both[:, 1]})


def body() -> Column:
    return F.coalesce(F.col("document.text").cast("string"), F.lit(""))


def prepared(documents: DataFrame) -> DataFrame:
    """The documents with a number, an order, and what tells candidates, kept in the shared folder."""
    last = (1 << 63) - 1
    rows = documents.select(F.monotonically_increasing_id().alias("uid"), F.struct("*").alias("document"))
    rows = rows.select("*", body().alias("body"))
    rows = rows.select("uid", "document", F.length("body").alias("length"), signed(F.col("body")).alias("sign"))
    return saved(
        rows.select(
            "uid",
            "document",
            "length",
            F.coalesce(F.col("document.doc_id").cast("long"), F.lit(last)).alias("id"),
            "sign.*",
        ),
        "signed",
    )


def shared_keys(rows: DataFrame) -> DataFrame:
    """`key`, `nth`, `uid` and `place` of every key that several texts have.

    A key is two neighbouring tuples, the `nth` and the next. A text's place is the number
    of texts it meets over all its keys, then its number: the greatest place in a family
    of edits is that of a text from its middle.
    """
    after = lambda i: F.get("sketch", (i + 1) % F.size("sketch"))
    keys = F.transform("sketch", lambda x, i: F.xxhash64(x, after(i), i))
    keyed = rows.select("uid", F.posexplode(keys).alias("nth", "key"))
    often = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = saved(keyed.join(often, "key"), "shared")
    met = shared.groupBy("uid").agg(F.sum("n").alias("met"))
    place = F.struct("met", (-F.col("uid")).alias("less")).alias("place")
    return saved(shared.select("key", "nth", "uid").join(met, "uid").select("key", "nth", "uid", place), "places")


def likely(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Of pairs `a`, `b` those that may be alike by their sizes and tuples."""
    of = lambda side: known.select(
        F.col("uid").alias(side), F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}")
    )
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    need = F.ceil(SIMILARITY / (1 + SIMILARITY) * (F.col("size_a") + F.col("size_b")) - 1e-9)
    same = F.zip_with("sketch_a", "sketch_b", lambda x, y: (x == y).cast("int"))
    agreeing = F.aggregate(same, F.lit(0), lambda n, x: n + x)
    return both.filter((F.least("size_a", "size_b") >= need) & (agreeing >= AGREEING)).select("a", "b")


def alike(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Of pairs `a`, `b` those whose texts are alike. Only texts of such pairs are read.

    Few pairs are sent to the texts; the texts then go to those they are compared with.
    """
    pairs = saved(likely(pairs, known), "pairs")
    texts = known.select("uid", body().alias("text"))
    of = lambda side: within(texts, pairs.select(F.col(side).alias("uid"))).select(
        F.col("uid").alias(side), F.col("text").alias(f"text_{side}")
    )
    few = pairs.count() <= FEW_PAIRS
    both = of("b").join(F.broadcast(pairs) if few else pairs, "b").join(of("a"), "a")
    both = both.select("a", "b", "text_a", "text_b")
    return saved(both.mapInArrow(verify, "a long, b long"), "alike")


def links_of(shared: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs `a`, `b` of texts that are alike; any two of one key that are alike are linked by them.

    Each text is compared with the greatest of its hubs first. What this brings together
    needs no more comparing: of the other pairs only those between groups are looked at.
    """
    hubs = shared.groupBy("key").agg(F.max("place").alias("hub"))
    met = shared.join(hubs, "key").filter("place < hub").select(F.col("uid").alias("b"), "hub").distinct()
    met = saved(met, "met")
    a = (-F.col("hub.less")).alias("a")
    first = saved(met.groupBy("b").agg(F.max("hub").alias("hub")).select(a, "b"), "pairs")
    found = alike(first, known)
    # a text's group goes by its hub, or by the hub of that
    above = found.select(F.col("b").alias("a"), F.col("a").alias("higher"))
    top = F.coalesce("higher", "a").alias("top")
    group = saved(found.join(above, "a", "left").select(F.col("b").alias("uid"), top), "groups")
    of = lambda side: group.select(F.col("uid").alias(side), F.col("top").alias(f"top_{side}"))
    rest = met.select(a, "b").join(first, ["a", "b"], "left_anti")
    rest = rest.join(of("b"), "b", "left").join(of("a"), "a", "left")
    rest = rest.filter(F.coalesce("top_a", "a") != F.coalesce("top_b", "b")).select("a", "b")
    found = saved(found.union(alike(rest, known)), "links")
    return found.union(links_between(shared.join(hubs, "key").filter("place < hub"), found, known))


def links_between(rows: DataFrame, found: DataFrame, known: DataFrame) -> DataFrame:
    """Further links out of all pairs of texts of one key, none of them its hub, that are in different classes.

    A key's texts are dealt to blocks, and each two blocks make a group. Groups are formed
    of what is narrow first; texts come only for those that have another to be compared with.
    """
    root = F.coalesce("root", "uid").alias("root")
    size = known.select("uid", "length", "size", "sketch").join(rows.select("uid").distinct(), "uid", "left_semi")
    classed = saved(size.join(components(found), "uid", "left").select(*size.columns, root), "classed")
    rows = saved(rows.select("key", "nth", "uid").join(classed.select("uid", "root", "length"), "uid"), "rooted")
    blocks = F.greatest(F.count("*") / TEXTS, F.sum("length") / CHARACTERS)
    blocks = F.least(F.ceil(blocks), F.count("*")).cast("int").alias("blocks")
    open_ = rows.groupBy("key").agg(blocks, F.min("root").alias("least"), F.max("root").alias("most"))
    open_ = open_.filter("least <> most").select("key", "blocks")
    block = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("block")
    dealt = rows.join(open_, "key").select("key", "nth", "uid", "blocks", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = saved(dealt.select("key", "nth", low, high, "block", "uid"), "dealt")
    group = ("key", "low", "high")
    narrow = dealt.join(classed.select("uid", "root", "size", "sketch"), "uid")
    wanted = saved(narrow.groupBy(*group).applyInArrow(asked, ASKED), "asked")
    texts = within(known.select("uid", body().alias("text")), wanted.select("uid"))
    texts = texts.join(classed.select("uid", "root", "size", "sketch"), "uid")
    whole = dealt.join(wanted, [*group, "uid"]).join(texts, "uid")
    return saved(whole.groupBy(*group).applyInArrow(compared, "a long, b long"), "alike")


def classes(known: DataFrame) -> DataFrame:
    """For each `same_a`, `same_b`: the class's least id `class_id`, and `first`: its least (id, uid)."""
    texts = known.groupBy("same_a", "same_b").agg(
        F.min(F.struct("id", "uid")).alias("first"), F.min("uid").alias("uid")
    )
    texts = saved(texts, "texts")
    shared = shared_keys(within(known.select("uid", "sketch"), texts.select("uid")))
    roots = components(links_of(shared, known))
    rooted = texts.join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(firsts, "root").select("same_a", "same_b", F.col("least").alias("first"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """`doc_id` and `class_id`, the smallest id of the document's class."""
    known = prepared(documents)
    found = saved(classes(known), "classes")
    rows = known.select("document.doc_id", "same_a", "same_b").join(found, ["same_a", "same_b"])
    last = (1 << 63) - 1
    return rows.select("doc_id", F.nullif(F.col("first.id"), F.lit(last)).alias("class_id"))


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each class, the one of the smallest id, with all its columns."""
    known = prepared(documents)
    firsts = classes(known).select(F.col("first.uid").alias("uid")).distinct()
    return within(known.select("uid", "document"), firsts).select("document.*")
