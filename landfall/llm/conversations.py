"""Repair of conversations by the cheapest edits, found by a bidirectional Dijkstra search.

A conversation's rows are first damaged on purpose, by a checksum of their place, then
repaired: each row is kept, given another role or deleted, and turns without text may be
inserted, so that the roles read `(s?(ua)+)?`. The edit lattice has a node for each number
of rows consumed and each state of that expression. One heap searches from the start, one
from the ends. When both tops together cost more than the best meeting known, every
crossing of that cost has been settled from both sides; the repair is the crossing whose
joined letters (K, R, D, I) come first.

Equal costs are settled row by row, and of one node's labels the first by its letters.
That is safe as no two labels of equal cost of one node begin with one another: only
inserts could follow, and a round of these costs something.

Conversations of up to `GROUP_ROWS` rows and `GROUP_BYTES` lie together in one task, one
at a time. Longer ones, of any share of the rows, are cut into segments over the tasks. A
segment gives, for each state it may be entered in and left in, its cheapest edits, by the
same search; segments are then joined in order, and only their letters come together. The
repaired text of a long conversation passes through one task as a stream, since a SHA-256
is made from front to end; no task holds more of it than a segment.

Edge cases: a NULL conv_id is a conversation of its own. A NULL turn, role or text reads
as one space wherever its text counts; turns come NULL first and do not count for gaps.
Rows of equal turn follow by role, then by the MD5 of the text; repeated rows are
duplicates. A role goes by its first character; an empty one has none. Conversations of
which all rows were dropped have zeros, an empty audit, and the hash of an empty text.
Empty tables give empty results. Other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

# What a row's draw does to it, and what edits cost.
DRAWS = 20
DROP, EMPTY, UNSTOP, REPEAT, USER = range(5)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
GROUP_ROWS = 1024
GROUP_BYTES = 8 << 20

# States of the expression: nothing yet, after s, after u, after a; it may end in the first and last.
STATES, ENDS = range(4), (0, 3)
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
# The state after the turn of a user or assistant that fits, and that turn's role.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")

_SOLID = re.compile(r"[^\x20\x09-\x0D]")


class Row(NamedTuple):
    """What the search needs to know of a row."""

    initial: str
    bad: bool  # blank or a duplicate: has to go
    cut: bool  # truncated


# ---------------------------------------------------------------- search


def onward(node: tuple[int, int], rows: list[Row]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """Cost, letter and end of every edge from a node."""
    at, state = node
    yield INSERT, "I", (at, NEXT[state])
    if at < len(rows):
        row = rows[at]
        yield DELETE, "D", (at + 1, state)
        if not row.bad:
            extra = TRUNCATED * row.cut
            yield REROLE + extra, "R", (at + 1, NEXT[state])
            if (state, row.initial) in AFTER:
                yield KEEP + extra, "K", (at + 1, AFTER[state, row.initial])


def back(node: tuple[int, int], rows: list[Row]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """Cost, letter and start of every edge to a node."""
    at, state = node
    for before in STATES:
        if NEXT[before] == state:
            yield INSERT, "I", (at, before)
    if at:
        row = rows[at - 1]
        yield DELETE, "D", (at - 1, state)
        if not row.bad:
            extra = TRUNCATED * row.cut
            for before in STATES:
                if NEXT[before] == state:
                    yield REROLE + extra, "R", (at - 1, before)
                if AFTER.get((before, row.initial)) == state:
                    yield KEEP + extra, "K", (at - 1, before)


def cheapest(rows: list[Row], start: int = 0, ends: Iterable[int] = ENDS) -> tuple[int, str] | None:
    """Cost and letters of the cheapest edits from a state to one of the end states.

    Of equal cost the letters that come first; None if there is no way.
    """
    n = len(rows)
    # per side: heap of (cost, rows from its own end, letters, state), labels, settled nodes
    first = (0, start)
    lasts = [(n, end) for end in ends]
    heaps = [[(0, 0, "", start)], [(0, 0, "", end) for end in ends]]
    labels: list[dict] = [{first: 0}, dict.fromkeys(lasts, 0)]
    settled: list[dict] = [{}, {}]
    best = 0 if first in lasts else None
    while heaps[0] or heaps[1]:
        tops = [h[0][0] if h else None for h in heaps]
        if best is None:
            if None in tops:
                return None
        elif None in tops or tops[0] + tops[1] > best:
            break
        side = 0 if tops[0] <= tops[1] else 1
        cost, far, letters, state = heappop(heaps[side])
        node = (n - far if side else far, state)
        if node in settled[side]:
            continue
        settled[side][node] = (cost, letters)
        mine, others = labels[side], labels[1 - side]
        for more, letter, then in (back if side else onward)(node, rows):
            total = cost + more
            if then in settled[side] or total > mine.get(then, total):
                continue
            mine[then] = total
            if then in others and (best is None or total + others[then] < best):
                best = total + others[then]
            at, where = then
            text = letter + letters if side else letters + letter
            heappush(heaps[side], (total, n - at if side else at, text, where))
    if best is None:
        return None
    ahead, behind = settled
    ahead.setdefault(first, (0, ""))
    for node in lasts:
        behind.setdefault(node, (0, ""))
    found = []
    for node, (cost, letters) in ahead.items():
        if node in behind and cost + behind[node][0] == best:
            found.append(letters + behind[node][1])
        for more, letter, then in onward(node, rows):
            if then in behind and cost + more + behind[then][0] == best:
                found.append(letters + letter + behind[then][1])
    return best, min(found)


def repaired(rows: Iterable[tuple[str, str]], letters: str, state: int = 0) -> list[str]:
    """`role:text` of each row of the repaired conversation, and of inserted ones."""
    out, left = [], iter(rows)
    for letter in letters:
        if letter == "I":
            out.append(f"{ROLE[state]}:")
            state = NEXT[state]
            continue
        role, text = next(left)
        if letter == "K":
            out.append(f"{role}:{text}")
            state = AFTER[state, role[:1]]
        elif letter == "R":
            out.append(f"{ROLE[state]}:{text}")
            state = NEXT[state]
    return out


# ---------------------------------------------------------------- rows


def fault_of(text: str, seen: bool) -> str | None:
    """A row's first fault."""
    solid = None
    for solid in reversed(text):
        if _SOLID.match(solid):
            break
    else:
        return "blank"
    if seen:
        return "duplicate"
    return None if solid in ".!?" else "truncated"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def gaps_of(turns: set[int]) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


def row_of(role: str, fault: str | None) -> Row:
    return Row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)
_KINDS = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def mended(conv_id: int | None, rows: list[tuple[int | None, str, str]]) -> tuple:
    """The result of one whole conversation: rows (turn, role, text) in their order."""
    seen, faults = set(), []
    for _, role, text in rows:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    marked = [row_of(role, fault) for (_, role, _), fault in zip(rows, faults, strict=True)]
    cost, audit = cheapest(marked)
    text = "\n".join(repaired([(role, text) for _, role, text in rows], audit))
    return (
        conv_id,
        gaps_of({turn for turn, _, _ in rows if turn is not None}),
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        illegal_pairs([row.initial for row in marked]),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage; those dropped stay as marks of their conversation."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    place = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    draw = F.crc32(place.cast("binary")) % DRAWS
    text = (
        F.when(draw == EMPTY, F.lit(""))
        .when(draw == UNSTOP, F.regexp_replace(shown("text"), "[.!?]", ""))
        .otherwise(shown("text"))
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(draw == USER, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(draw != DROP, text).alias("text"),
        draw.alias("draw"),
    )
    times = F.when(F.col("draw") == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("copy", F.explode(times))
    return rows.select("conv_id", "turn", "role", "text", F.md5("text").alias("tie"))


ORDER = ("turn", "role", "tie")


def mend_short(rows: DataFrame) -> DataFrame:
    """Conversations that lie together in one task, held one at a time."""
    names = RESULT.replace(" long", "").replace(" string", "").split(", ")
    schema = arrow_schema(RESULT)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, begun = None, [], False
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))
            for conv_id, turn, role, text in zip(*columns, strict=True):
                if begun and conv_id != current:
                    done.append(mended(current, held))
                    held = []
                current, begun = conv_id, True
                if text is not None:
                    held.append((turn, role, text))
            yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema)
        if begun:
            last = dict(zip(names, mended(current, held), strict=True))
            yield pa.RecordBatch.from_pylist([last], schema)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    return ordered.select("conv_id", "turn", "role", "text").mapInArrow(mend, RESULT)


# ---------------------------------------------------------------- long conversations

SEGMENT = (
    "key string, segment long, blank long, duplicate long, truncated long, illegal long, first string,"
    " last string, ways string"
)


def ways_of(rows: list[Row]) -> str:
    """For each state a segment is entered in and left in: cost and letters, as `from,to,cost,letters`."""
    ways = []
    for start in STATES:
        for end in STATES:
            if found := cheapest(rows, start, (end,)):
                ways.append(f"{start},{end},{found[0]},{found[1]}")
    return ";".join(ways)


def segment_of(rows: pa.Table) -> pa.Table:
    """One segment's counts and its ways."""
    rows = rows.sort_by("at")
    faults, initials = rows.column("fault").to_pylist(), rows.column("initial").to_pylist()
    ways = ways_of([row_of(i, f) for i, f in zip(initials, faults, strict=True)])
    found = (
        rows.column("key")[0].as_py(),
        rows.column("segment")[0].as_py(),
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        illegal_pairs(initials),
        initials[0],
        initials[-1],
        ways,
    )
    schema = arrow_schema(SEGMENT)
    return pa.Table.from_pylist([dict(zip(schema.names, found, strict=True))], schema)


PATH = (
    "key string, segment long, state int, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string"
)


def path_of(segments: pa.Table) -> pa.Table:
    """A conversation's result, and for each segment the state it is entered in and its letters."""
    rows = segments.sort_by("segment").to_pylist()
    # state -> cost, letters, and the (state entered, letters) of each segment
    reached: dict[int, tuple[int, str, tuple]] = {0: (0, "", ())}
    for row in rows:
        onward: dict[int, tuple[int, str, tuple]] = {}
        for way in row["ways"].split(";"):
            start, end, cost, letters = way.split(",")
            if (before := reached.get(int(start))) is None:
                continue
            found = (before[0] + int(cost), before[1] + letters, (before[2], int(start), letters))
            if int(end) not in onward or found[:2] < onward[int(end)][:2]:
                onward[int(end)] = found
        reached = onward
    cost, audit, trail = min((reached[s] for s in ENDS if s in reached), key=lambda r: r[:2])
    key, schema = rows[0]["key"], arrow_schema(PATH)
    out = []
    for row in reversed(rows):
        trail, state, letters = trail
        out.append({"key": key, "segment": row["segment"], "state": state, "audit": letters})
    between = illegal_pairs_between(rows)
    counted = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
    counted["illegal"] += between
    out.append({"key": key, "cost": cost, "audit": audit, **counted})
    return pa.Table.from_pylist(out, schema)


def illegal_pairs_between(segments: list[dict]) -> int:
    """Illegal pairs of the last row of a segment and the first of the next."""
    return sum(illegal_pairs([a["last"], b["first"]]) for a, b in zip(segments, segments[1:]))


PIECE = "key string, segment long, piece string"


def piece_of(rows: pa.Table, path: pa.Table) -> pa.Table:
    """A segment's part of the repaired text; NULL if nothing is left of it."""
    rows = rows.sort_by("at")
    way = path.to_pylist()[0]
    texts = zip(rows.column("role").to_pylist(), rows.column("text").to_pylist(), strict=True)
    kept = repaired(texts, way["audit"], way["state"])
    piece = {"key": way["key"], "segment": way["segment"], "piece": "\n".join(kept) if kept else None}
    return pa.Table.from_pylist([piece], arrow_schema(PIECE))


DIGEST = "key string, repaired_sha256 string"


def digested(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's pieces, joined by line feeds, as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, running, empty = arrow_schema(DIGEST), None, None, True
        for batch in batches:
            done = []
            for key, piece in zip(
                batch.column("key").to_pylist(), batch.column("piece").to_pylist(), strict=True
            ):
                if key != current:
                    if current is not None:
                        done.append({"key": current, "repaired_sha256": running.hexdigest()})
                    current, running, empty = key, hashlib.sha256(), True
                if piece is not None:
                    running.update(piece.encode() if empty else b"\n" + piece.encode())
                    empty = False
            yield pa.RecordBatch.from_pylist(done, schema)
        if current is not None:
            done = [{"key": current, "repaired_sha256": running.hexdigest()}]
            yield pa.RecordBatch.from_pylist(done, schema)

    ordered = pieces.repartition("key").sortWithinPartitions("key", "segment")
    return ordered.select("key", "piece").mapInArrow(digest, DIGEST)


def mend_long(rows: DataFrame) -> DataFrame:
    """Conversations of any length, by segments of at most `GROUP_ROWS` rows."""
    held = rows.filter(F.col("text").isNotNull())
    uid = F.monotonically_increasing_id().alias("uid")
    held = saved(held.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("key"), "*", uid), "long")
    # the first of rows that are there several times; keys alone travel
    several = held.groupBy("key", "role", "tie").agg(
        F.count("*").alias("n"), F.min(F.struct("turn", "uid")).alias("first")
    )
    several = several.filter("n > 1").select("key", "role", "tie", F.col("first.uid").alias("first"))
    size = held.count()
    order = ("key", *ORDER, "uid")
    marked = held.join(several, ["key", "role", "tie"], "left")
    ordered = marked.repartitionByRange(1 + size // (16 * GROUP_ROWS), *order).sortWithinPartitions(*order)
    last = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), -1, 1)
    fault = (
        F.when(last == "", "blank")
        .when(F.col("first") != F.col("uid"), "duplicate")
        .when(~last.isin(*".!?"), "truncated")
    )
    ordered = ordered.select(
        "key", "conv_id", "turn", "role", "text", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"),
        F.monotonically_increasing_id().alias("at"),
    )
    ordered = saved(ordered.withColumn("segment", F.expr(f"at div {GROUP_ROWS}")), "ordered")
    narrow = ordered.select("key", "segment", "at", "initial", "fault")
    segments = narrow.groupBy("key", "segment").applyInArrow(segment_of, SEGMENT)
    paths = saved(segments.groupBy("key").applyInArrow(path_of, PATH), "paths")
    ways = paths.filter("segment IS NOT NULL").select("key", "segment", "state", "audit")
    both = ordered.select("key", "segment", "at", "role", "text").groupBy("key", "segment")
    pieces = both.cogroup(ways.groupBy("key", "segment")).applyInArrow(piece_of, PIECE)
    turns = ordered.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"),
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
    )
    found = paths.filter("segment IS NULL").drop("segment", "state")
    found = found.join(turns, "key").join(digested(pieces), "key")
    found = found.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))
    return found.select(*arrow_schema(RESULT).names)


def repair(conversations: DataFrame) -> DataFrame:
    """Faults, cost, letters and the digest of the repaired text of each conversation."""
    rows = damaged(conversations)
    size = F.sum(F.octet_length("text") + F.octet_length("role"))
    sizes = rows.groupBy("conv_id").agg(F.count("text").alias("n"), size.alias("bytes"))
    long = sizes.filter((F.col("n") > GROUP_ROWS) | (F.col("bytes") > GROUP_BYTES)).select("conv_id")
    long = saved(long, "long")
    if long.isEmpty():
        return mend_short(rows)
    is_long = F.col("conv_id").eqNullSafe(F.col("__conv_id"))
    listed = long.select(F.col("conv_id").alias("__conv_id"))
    short = rows.join(listed, is_long, "left_anti")
    return mend_short(short).unionByName(mend_long(rows.join(listed, is_long, "left_semi")))
