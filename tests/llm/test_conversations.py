"""Repair of conversations against brute force over whole tables and made-up rows."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from landfall.llm import conversations, queries
from landfall.llm.common import ship
from landfall.llm.conversations import Row

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, key string, uid long, segment int"
LEGAL = re.compile(r"(s?(ua)+)?")


def brute_best(rows):
    """All ways row by row: of each last role the least cost and letters."""
    best = {"": (0, "")}

    def better(table, roles, way):
        if roles not in table or way < table[roles]:
            table[roles] = way

    def fits(roles, new):
        return (roles, new) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    def inserted(table):
        for _ in range(4):
            for roles, (cost, audit) in list(table.items()):
                for new in "ua":
                    if fits(roles, new):
                        better(table, new, (cost + 2, audit + "I"))
        return table

    best = inserted(best)
    for initial, bad, cut in rows:
        then = {}
        for roles, (cost, audit) in best.items():
            better(then, roles, (cost + 3, audit + "D"))
            if bad:
                continue
            if fits(roles, initial):
                better(then, initial, (cost + cut, audit + "K"))
            for new in "ua":
                if fits(roles, new):
                    better(then, new, (cost + 2 + cut, audit + "R"))
        best = inserted(then)
    return min(best[r] for r in ("", "a") if r in best)


def brute(rows):
    """The result for rows (conv_id, turn, role, text), as the contract states it."""
    groups = {}
    for conv_id, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        groups.setdefault(conv_id, [])
        draw = zlib.crc32(f"{show(conv_id)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub(r"[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        groups[conv_id] += [(turn, role, text)] * (2 if draw == 3 else 1)
    out = []
    for conv_id, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in held:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append(
                "b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        cost, audit = brute_best([(r[1][:1], f in ("b", "d"), f == "t") for r, f in zip(held, faults)])
        roles, lines, left = "", [], iter(held)
        for letter in audit:
            fit = "a" if roles.endswith("u") else "u"
            name = {"u": "user", "a": "assistant"}[fit]
            if letter == "I":
                lines.append(f"{name}:")
            else:
                _, role, text = next(left)
                if letter == "D":
                    continue
                lines.append(f"{role if letter == 'K' else name}:{text}")
                fit = role[0] if letter == "K" else fit
            roles += fit
        assert LEGAL.fullmatch(roles)
        turns = {r[0] for r in held if r[0] is not None}
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:])]
        out.append(
            (
                conv_id,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                faults.count("b"),
                faults.count("d"),
                faults.count("t"),
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                audit,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def results(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def made_up(seed, count, conversations_, turns):
    random = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sys"]
    texts = ["Hi.", "So?", "no end", " ", "", None, "End!\n ", "é漢.\x85", "Hi.", "a.b"]
    pick = lambda values: values[int(random.integers(len(values)))]
    rows = []
    for _ in range(count):
        conv_id, turn = int(random.integers(conversations_)), int(random.integers(turns))
        text = pick(texts)
        if text and random.random() < 0.5:
            text = f"{random.integers(1000)} {text}"
        rows.append((conv_id or None, turn or None, pick(roles), text))
    return rows


def framed(spark, rows):
    ship(spark)
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def test_whole_table_is_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = queries.QUERIES["op13_conversation_repair"](spark, FOLDER)
    assert results(found) == brute([tuple(r) for r in rows.collect()])


def test_odd_rows(spark):
    rows = made_up(1, 1200, 150, 9)
    assert results(conversations.repair(framed(spark, rows))) == brute(rows)
    assert conversations.repair(framed(spark, rows).filter("false")).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    lone = [(dropped, 1, "user", "Hi.")]
    empty = hashlib.sha256(b"").hexdigest()
    assert results(conversations.repair(framed(spark, lone))) == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]


def test_long_conversations_by_segments(spark, monkeypatch):
    monkeypatch.setattr(conversations, "GROUP_ROWS", 7)
    rows = made_up(2, 500, 12, 60) + made_up(3, 200, 60, 5) + [(500, 3, "user", "same.")] * 40
    assert results(conversations.repair(framed(spark, rows))) == brute(rows)
    none = [(None, None, "user", "same."), (None, None, "assistant", "x")] * 20
    assert results(conversations.repair(framed(spark, none))) == brute(none)


def test_long_texts_are_segments_too(spark, monkeypatch):
    monkeypatch.setattr(conversations, "GROUP_BYTES", 10_000)
    rows = [(1, i, "user" if i % 2 else "assistant", f"{i} " * 2000 + ".") for i in range(12)]
    rows += [(2, i, "user", f"{i}") for i in range(5)]
    assert results(conversations.repair(framed(spark, rows))) == brute(rows)


@pytest.mark.parametrize("n", range(5))
def test_search_over_all_small_conversations(n):
    kinds = [Row(i, b, c) for i in "sua" for b, c in ((False, False), (False, True))]
    kinds += [Row("u", True, False), Row("x", False, False)]
    for rows in itertools.product(kinds, repeat=n):
        assert conversations.cheapest(list(rows)) == brute_best(rows)


def test_search_over_longer_conversations():
    random = np.random.default_rng(7)
    for n in (12, 40, 90):
        for _ in range(40):
            rows = [
                Row("suaux"[int(random.integers(5))], random.random() < 0.15, random.random() < 0.2)
                for _ in range(n)
            ]
            rows = [r._replace(cut=False) if r.bad else r for r in rows]
            assert conversations.cheapest(rows) == brute_best(rows)
