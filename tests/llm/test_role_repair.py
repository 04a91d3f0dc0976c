"""Repairs against a search over whole edit sequences, for damaged and hand-made conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from stratalens.llm import role_repair, turns

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        role = "user" if lot == 4 else role
        out += [(conv, turn, role, text)] * (2 if lot == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, repaired turns) by cheapest-first search over all edit sequences, none merged with another."""
    found = faults(rows)
    todo = [(0, "", 0, "", ())]
    while True:
        cost, audit, at, initials, out = heapq.heappop(todo)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, list(out)
        if not re.fullmatch("s?(ua)*u?", initials):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(todo, (cost + 2, audit + "I", at, initials + role[0], (*out, (role, ""))))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(todo, (cost + 3, audit + "D", at + 1, initials, out))
            if found[at] not in ("blank", "duplicate"):
                more = cost + (found[at] == "truncated")
                if role:
                    heapq.heappush(todo, (more, audit + "K", at + 1, initials + role[0], (*out, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(todo, (more + 2, audit + "R", at + 1, initials + new[0], (*out, (new, text))))


def expected(rows):
    digest = lambda pairs: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in pairs).encode()).hexdigest()
    result = {}
    left = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        found = faults(own)
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, out = cheapest(own)
        result[conv] = (gaps, *(found.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest(out))
    return result


def made(seed, conversations=120):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        number = draw.randrange(3)
        for k in range(draw.randrange(1, 8)):
            role = draw.choice(["user", "assistant"]) if draw.random() < 0.8 else draw.choice(["system", "tool", None, "", "sage", "u"])
            text = draw.choice(["Hello.", "Why?", "cut off", "So!  \n", "", " \t", None, "Ünï 😀.", "done. ", "a:b\nuser:c.", f"own {k}."])
            rows.append((None if conv == 7 else conv, None if draw.random() < 0.05 else number, role, text))
            number += draw.choice([0, 1, 1, 1, 1, 3])
    return rows


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS block", "1 AS kind", "'y' AS digest").repartition(5)
    summaries, turns_ = role_repair.repair(role_repair.damaged(df))
    got = role_repair.with_every_id(df, summaries, role_repair.turns_digest(turns_))
    return {r.conv_id: tuple(r)[1:] for r in got.collect()}


@pytest.mark.parametrize("block", [256, 2])
def test_repairs(spark, monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK_TURNS", block)
    rows = made(block) + [(900, None, None, None), (901, 0, "system", "Be kind."), (902, 0, "user", "cut")] + [(903, 5, "user", "Same.")] * 3
    assert run(spark, rows) == expected(rows)


def test_a_long_conversation_is_chained(spark):
    draw = random.Random(4)
    rows = [(1, i, draw.choice(["user", "assistant"]), draw.choice(["Well.", f"So {i}.", "open"])) for i in range(1500)]
    summaries, repaired = role_repair.repair(spark.createDataFrame(rows, SCHEMA))
    row = summaries.first()
    best = {0: (0, "")}
    for initial, fault in zip((r[2][0] for r in rows), faults(rows)):
        best = role_repair.edit(best, initial, {"": "c", "truncated": "t"}.get(fault, "x"))
    table, _ = role_repair.role_table()
    assert (row.cost, row.audit) == min(v for node, v in role_repair.inserted(best).items() if table.accepts(node))
    out = sorted((r.place, r.role[0]) for r in repaired.collect())
    assert [p for p, _ in out] == list(range(len(out)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r for _, r in out)) and row.duplicate > 400


def test_table_reads_the_role_language():
    table, nodes = role_repair.role_table()
    for length in range(6):
        for k in range(3**length):
            word, at = "", {0}
            for _ in range(length):
                word, k = word + "sua"[k % 3], k // 3
                at = {m for n in at for m in table.moves(n, word[-1])}
            assert any(map(table.accepts, at)) == bool(re.fullmatch("(s?(ua)+)?", word)), word
    assert len(nodes) < 12


def test_ambiguous_grammars_keep_every_stack():
    table = role_repair.LrTable({"x": ("x x", "a")})
    tops = {0}
    for _ in range(3):
        tops = {m for n in tops for m in table.moves(n, "a")}
        assert any(map(table.accepts, tops))
    assert len(tops) > 1


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    summaries, repaired = role_repair.repair(role_repair.damaged(empty))
    assert summaries.count() == repaired.count() == role_repair.with_every_id(empty, summaries, role_repair.turns_digest(repaired)).count() == 0
