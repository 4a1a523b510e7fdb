"""Repair of conversations against brute force over all edits."""

import collections
import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from terrace.llm import auction as A
from terrace.llm import conversations as C

KIND = "conv_id long, turn long, role string, text string"
FOLLOWS = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(turns):
    """``(cost, letters)`` of the best repair of (initial of the role, fault) turns, tried from the end over whole texts."""

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(turns) and state in ("", "a") else []
        if inserted < 4:
            cost, rest = best(i, FOLLOWS[state], inserted + 1)
            ways.append((cost + 2, "I" + rest))
        if i < len(turns):
            first, fault = turns[i]
            cost, rest = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + rest))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                cost, rest = best(i + 1, FOLLOWS[state], 0)
                ways.append((cost + 2 + late, "R" + rest))
                if first and (first == FOLLOWS[state] or (first == "s" and state == "")):
                    cost, rest = best(i + 1, first, 0)
                    ways.append((cost + late, "K" + rest))
        return min(ways) if ways else (10**9, "")

    return best(0, "", 0)


def spelled(kinds, letters):
    """``letters`` with what is inserted behind the last turn."""
    state, turns = A.START, iter(kinds)
    for x in letters:
        if x == "I":
            state = A.FOLLOWS[state]
            continue
        kind = next(turns)
        state = {"R": A.FOLLOWS[state], "K": kind // 4, "D": state}[x]
    return letters + A.TAIL[state]


def test_auction_finds_the_least_letters_of_the_cheapest_repairs():
    rng = random.Random(4)
    names = {A.OTHER: "?", A.SYSTEM: "s", A.USER: "u", A.ASSISTANT: "a"}
    faults = ["sound", "blank", "duplicate", "truncated"]
    for _ in range(1500):
        kinds = [rng.randrange(16) if rng.random() < 0.6 else rng.choice([8, 12]) for _ in range(rng.randrange(11))]
        want = cheapest(tuple((names[k // 4], faults[k % 4]) for k in kinds))[1]
        assert spelled(kinds, A.audit(bytes(kinds))) == want
        # cut into blocks, summed up, and solved between the states found
        size = rng.randrange(1, 5)
        cut = [kinds[i : i + size] for i in range(0, len(kinds), size)]
        way = A.solve([A.transfer([A.turn(*divmod(k, 4)) for k in b]) for b in cut])
        assert spelled(kinds, "".join(A.audit(bytes(b), p, q) for b, p, q in zip(cut, way, way[1:]))) == want


def test_prices_never_exceed_what_an_arc_and_the_next_price_cost():
    kinds = [8, 11, 12, 13, 8, 8, 4, 15]
    steps = [A.turn(*divmod(k, 4)) for k in kinds]
    ends = [2 * len(t) for t in A.TAIL]
    price = A.prices(steps, ends, [A.START])
    for i, (costs, _) in enumerate(steps):
        assert all(price[i][s] <= costs[s][q] + price[i + 1][q] for s in A.STATES for q in A.STATES)
    assert price[0][A.START] == cheapest((("u", ""), ("u", "truncated"), ("a", ""), ("a", "blank"), ("u", ""), ("u", ""), ("s", ""), ("a", "truncated")))[0]


def brute(rows):
    """Every conversation's result by the contract, from plain rows."""
    whole = collections.OrderedDict()
    for conv, turn, role, text in rows:
        kept = whole.setdefault(conv, [])
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text)
        kept += [(turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    out = set()
    for conv, kept in whole.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest()))
        seen, turns = set(), []
        for _, role, text in kept:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "sound"
            seen.add((role, text))
            turns.append((role[:1], fault))
        cost, letters = cheapest(tuple(turns))
        lines, state, at = [], "", iter(kept)
        for x in letters:
            row = None if x == "I" else next(at)
            if x in "IR":
                state = FOLLOWS[state]
                lines.append({"u": "user:", "a": "assistant:"}[state] + (row[2] if row else ""))
            elif x == "K":
                state = row[1][:1]
                lines.append(f"{row[1]}:{row[2]}")
        known = [x[0] for x in kept if x[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        count = collections.Counter(f for _, f in turns)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.add((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters, sha))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]
    texts = ["Hi.", "Bye", " \t ", None, "", "Ω?\n", "z ... "]
    made = []
    for conv in (None, 1, 2, 3, 4, 5):
        for t in range(60 if conv in (None, 2) else 7):
            turn = t // 2 if conv == 3 else None if conv == 5 else rng.choice([t, t, t, None])
            made.append((conv, turn, rng.choice(roles), rng.choice([*texts, f"x {t}.", f"y {t}", "long " * 3000 + "!"])))
    dropped = next(i for i in range(100, 200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return [*made, (dropped, 0, "user", "all of it goes."), *made[-3:], (7, 0, "user", "alone.")]


def test_repair_equals_brute_force(spark, rows):
    """Nulls in every column, empty and long texts, ties, repeated rows, unknown roles, a conversation of which nothing is left."""
    clashing = ", pos long, kind string, part int, letters string"
    conv = spark.createDataFrame([(*r, 1, "k", 2, "l") for r in rows], KIND + clashing).repartition(5)
    got = C.repair(spark, C.damage(conv), conv)
    assert got.columns == ["conv_id", *C.FIGURES, "audit", "repaired_sha256"]
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_long_conversations_are_solved_in_blocks_of_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "TURNS", 4)
    conv = spark.createDataFrame(rows, KIND)
    assert {tuple(r) for r in C.repair(spark, C.damage(conv), conv).collect()} == brute(rows)


def test_an_empty_table_gives_no_row(spark):
    conv = spark.createDataFrame([], KIND)
    assert C.repair(spark, C.damage(conv), conv).collect() == []


def test_equal_rows_of_one_conversation_do_not_meet_in_one_task(spark):
    """The numbering is dealt by ranges that cut through a conversation."""
    from terrace.llm.ranks import ranked

    rows = spark.range(8000).select(F.lit(1).alias("conv_id"), F.lit("same").alias("text")).repartition(8)
    # no small partitions joined, every written file read on its own
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": str(128 << 20)}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        done = ranked(spark, rows, ["conv_id", "text"], [], "n")
        assert done.agg(F.count("n"), F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (8000, 8000, 0, 7999)
        sizes = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert len(sizes) > 4 and max(sizes) < 3000
