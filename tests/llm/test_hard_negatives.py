"""Hard negatives against brute force, ties, odd rows and vectors."""

import duckdb
import numpy as np
import pytest

from landfall.llm import hard_negatives, oracles, queries
from landfall.llm.common import ship

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, uid long, q string, part int"


def brute(rows):
    """All rows of the result, by scoring all pairs."""
    kept = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        whole = [int(np.floor(256 * np.float64(np.float32(x)))) for x in vector]
        kept.append((vec_id, label, whole, place))
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    order = lambda a: lambda b: (-score(a, b), b[0] is None, b[0] or 0, b[3])
    for a in kept:
        if a[0] is None or a[0] % 50:
            continue
        same = sorted((b for b in kept if b[1] == a[1] and b[3] != a[3]), key=order(a))[:5]
        others = sorted((b for b in kept if b[1] != a[1]), key=order(a))
        for b in same:
            p = score(a, b)
            found = [n for n in others if 50 * p <= 100 * score(a, n) <= 95 * p][:3]
            out += [(a[0], b[0], k + 1, n[0], p, score(a, n)) for k, n in enumerate(found)]
    return sorted(out, key=repr)


def mined(spark, rows, *sizes):
    ship(spark)
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in hard_negatives.mine(frame).collect()), key=repr)


def clustered(seed, n, width, spread):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(6, width))
    rows = []
    for i in range(n):
        vector = middles[random.integers(6)] + spread * random.normal(size=width)
        rows.append((i, [float(x) for x in np.round(vector / 4, 2)], int(random.integers(4))))
    return rows


@pytest.mark.parametrize("spread", [0.0, 0.1, 1.0])
def test_brute_force_over_blocks_and_parts(spark, monkeypatch, spread):
    monkeypatch.setattr(hard_negatives, "BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "PART", 40)
    monkeypatch.setattr(hard_negatives, "ROUND", 2)
    rows = clustered(5, 400, 6, spread)
    assert mined(spark, rows) == brute(rows) != []


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, None, 1), (50, [0.0, 0.0], 1), (50, [], 2),
        (100, [1.0], 1), (100, [1.0, None], 1), (150, [inf], 1), (200, [nan, 1.0], 2), (250, [1.0], None),
        (None, [0.5, 0.5], 1), (None, [0.5, 0.5], 3), (None, [0.4, 0.5], 3), (7, [0.7, 0.1], 0),
        (14, [-0.7, 0.1], 0), (3, [0.3, 0.2, 0.9], 2), (4, [0.9], 2), (5, [0.9], 2), (300, [-1.0, -1.0], 9),
        (350, [1e30, 0.5], 5), (6, [-0.9], 9), (8, [-0.5], 4),
    ]
    finite = [r for r in rows if r[0] != 350]
    assert mined(spark, finite) == brute(finite) != []
    # a component beyond the largest counts as that: scores stay exact
    mined(spark, rows)
    assert mined(spark, rows[:0]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(0, [1.0], 1), (2, [1.0], 2)]) == []


def test_hot_vector_and_label(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PART", 64)
    rows = [(i, [1.0, 0.5] if i % 3 else [i / 300, 0.6], 1 if i % 2 else i % 5) for i in range(300)]
    assert mined(spark, rows) == brute(rows) != []


def test_search_stops_early_and_meets_ties():
    random = np.random.default_rng(1)
    rows = np.concatenate([random.integers(-9, 9, (2000, 3)), np.full((40, 3), 9)]).astype(float)
    lists = hard_negatives.SortedLists(rows)
    anchor = np.array([5.0, 4.0, 3.0])
    (found,), scored = hard_negatives.threshold_search(lists, anchor, [(0, 1000)], 3, np.ones(2040, bool))
    assert found[0].tolist() == [2000, 2001, 2002]
    assert scored < 1000
    (found,), _ = hard_negatives.threshold_search(lists, -anchor, [(0, 30)], 5, np.ones(2040, bool))
    scores = rows @ -anchor
    inside = [(-s, i) for i, s in enumerate(scores) if 0 <= s <= 30]
    assert found[0].tolist() == [i for _, i in sorted(inside)[:5]]


def test_large_components_are_scored_in_whole_numbers(spark):
    rows = [(i, [500.0 * i, 90_000.0 - 400 * i, 0.5], i % 3) for i in range(0, 200, 5)]
    assert mined(spark, rows) == brute(rows) != []


def test_equals_sql(spark):
    frame = queries.QUERIES["op11_hard_negatives"](spark, FOLDER)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{FOLDER}/embeddings.parquet')")
    result = duck.execute(oracles.HARD_NEGATIVES)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in frame.select(*names).collect()), key=repr) == expected != []
