"""Conversation repair against an enumeration of all edits, and its hard cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import repair
from strata.llm.queries import damage


def legal(initials):
    text = "".join(initials)
    body = text.removeprefix("s")
    return text == "" or (len(body) >= 2 and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def enumerated(rows):
    """(cost, audit) of the least edits by trying all, with up to two insertions at each place (one in longer conversations)."""
    best = None
    places = []
    for initial, fault in rows:
        more = 5 if fault == "truncated" else 0
        own = [("D", 2, None)]
        if fault != "delete":
            own += [("K", more, initial), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        places.append(own)
    inserts = [x for n in range(3 if len(rows) < 3 else 2) for x in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*places):
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(c for _, c, _ in chosen) + 5 * sum(map(len, added))
            if best and cost > best[0]:
                continue
            said = [*added[0]]
            audit = "I" * len(added[0])
            for (letter, _, role), more in zip(chosen, added[1:], strict=True):
                audit += letter + "I" * len(more)
                said += ([role] if role else []) + [*more]
            if legal(said):
                best = min(best or (cost, audit), (cost, audit))
    return best


def solved(rows, block):
    code = {v: k for k, v in repair.CODES.items()}
    codes = "".join(code[r] for r in rows)
    parts = [repair.solve_block(codes[k : k + block], repair.STATES if k else (0,)) for k in range(0, len(codes), block)]
    cost, path, tail = repair.chain(parts)
    audit = ["".join(next(p for p in part if (p["from"], p["to"]) == step)["edits"]) for part, step in zip(parts, path, strict=True)]
    return cost, "".join(audit) + "I" * tail


def test_least_edits_equal_enumeration():
    draw = random.Random(5)
    for n in (0, 1, 2, 3):
        for _ in range(40 if n < 3 else 6):
            rows = [(draw.choice("suax"), draw.choice(repair.FAULTS)) for _ in range(n)]
            assert solved(rows, 100) == (enumerated(rows) if rows else (0, "")), rows


def test_blocks_of_any_size_give_the_same_edits():
    draw = random.Random(6)
    for _ in range(60):
        rows = [(draw.choice("suuaax"), draw.choices(repair.FAULTS, (6, 1, 1))[0]) for _ in range(draw.randint(1, 40))]
        whole = solved(rows, 100)
        assert all(solved(rows, b) == whole for b in (1, 2, 7, 16))


def test_a_long_conversation_is_linear():
    draw = random.Random(7)
    rows = [(draw.choice("suax"), draw.choices(repair.FAULTS, (6, 1, 1))[0]) for _ in range(20_000)]
    cost, audit = solved(rows, 2048)
    assert cost and len(audit) >= len(rows)


ROWS = [
    (1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "assistant", "x."), (2, None, None, None), (2, 5, "user", ""),
    (None, 3, "user", "q?"), (None, None, "user", "q?"), (None, 3, "user", "q?"), (4, 0, "system", "s."), (5, 2, "", "é"), (5, 2, "user", "z" * 200_000 + "."), (6, None, "user", "a."), (6, None, "assistant", "b! \t"),
]


def test_hard_rows(spark):
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumns({"pos": F.lit(1), "edits": F.lit("x"), "tail": F.lit(2)})
    for block in (1, repair.BLOCK):
        repaired, by_conv = repair.repair(rows, block=block)
        assert repaired.count() == len(ROWS)
        got = {r["conv"]: (r["cost"], r["audit"]) for r in repair.digests(repaired, by_conv).collect()}
        # 2: blank, an assistant alone, blank; 5: a truncated row without role, a user alone; 6: assistant before user.
        assert got == {1: (0, "KK"), 2: (6, "DDD"), None: (6, "DDD"), 4: (2, "D"), 5: (4, "DD"), 6: (2, "RR")}
    empty, none = repair.repair(rows.limit(0))
    assert empty.count() == 0 and repair.digests(empty, none).count() == 0


def test_damage_is_decided_by_conversation_and_turn(spark):
    import zlib

    rows = spark.createDataFrame([(c, t, "assistant", "a. b!") for c in range(40) for t in (0, 1, None)], "conv_id long, turn long, role string, text string")
    got = {}
    for r in damage(rows).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for c in range(40):
        for t in (0, 1, None):
            k = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
            expected = {0: None, 1: [("assistant", "")], 2: [("assistant", "a b")], 3: [("assistant", "a. b!")] * 2, 4: [("user", "a. b!")]}.get(k, [("assistant", "a. b!")])
            assert got.get((c, t)) == expected


@pytest.mark.parametrize("initials, cost, audit", [("uaua", 0, "KKKK"), ("uua", 2, "DKK"), ("au", 2, "RR"), ("u", 2, "D"), ("sua", 0, "KKK"), ("aaua", 1, "RKKK"), ("uau", 2, "KKD"), ("usa", 2, "KDK")])
def test_ties_take_the_ascii_least_audit(initials, cost, audit):
    rows = [(x, "") for x in initials]
    assert solved(rows, 8) == enumerated(rows) == (cost, audit)
