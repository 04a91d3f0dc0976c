"""Conversation structure repair by generalised LR parsing over the role grammar.

``LrTable`` makes the states of a grammar of role initials.  Its stacks form one graph: a node is a state on top of
another node, nodes are shared, and equal ones are the same.  ``edit`` reads the turns from left to right and keeps
for every stack top alive the least (cost, audit); each turn can be kept, given another role or deleted, and turns can be
inserted anywhere.  Where several edits lead to equal tops, the least stays.  That is exact: at one place
every audit has one letter per turn read, so of two audits of equal cost none begins the other, and what
follows cannot turn their order round.

A conversation is cut into blocks of turns.  For each block the least edits from every stack top it may
begin with to every one it may end with are worked out apart, and these small tables are chained along the
conversation.  Role grammars must have finitely many stacks between turns, as left-recursive ones do.

Only ids, roles, digests and faults travel to the edits.  Texts are moved once, when the
repaired turns are written.

Defined results: rows of one turn stand by role, then by the MD5 of the text.  Turns without number come
first.  NULL conversation ids are one conversation.  NULL role and text are what the caller makes of
them, else one space.  A role whose initial is not in the grammar can be given another or be deleted.  An empty table
gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .shared import BLANKS
from .turns import arrow_schema, block_heads, block_of, in_order, record_batches, runs

# A conversation may open with a system turn; then user and assistant take turns.
ROLE_GRAMMAR = {"chat": ("", "pairs", "s pairs"), "pairs": ("u a", "pairs u a")}
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
CLEAN, CUT, GONE = "c", "t", "x"
NEIGHBOURS = {"su", "ua", "au"}

BLOCKS = (
    "conv_id long, block long, before long, total long, n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "low long, high long, numbers long, starts array<int>, ends array<int>, costs array<long>, audits array<string>"
)
PIECES = (
    "conv_id long, block long, audit string, placed long, opened boolean, "
    "summary struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>"
)
REPAIRED = "conv_id long, place long, edit string, turn long, role string, text string"


class LrTable:
    """The parser's states, and its stacks as a graph of shared nodes.

    ``grammar`` maps each symbol to its right sides, whose words are symbols or terminals; the first symbol is the start.
    Node 0 is the empty stack.
    """

    def __init__(self, grammar: dict[str, Iterable[str]]):
        start = next(iter(grammar))
        self.rules = [("", (start,))] + [(lhs, tuple(right.split())) for lhs, rights in grammar.items() for right in rights]
        self.symbols = set(grammar)
        self.follow = self._follow(start)
        self._states: dict[frozenset, int] = {}
        self._items: list[frozenset] = []
        self._goto: dict[tuple[int, str], int | None] = {}
        self._state({(0, 0)})
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # (state, node below)
        self._numbers = {self.nodes[0]: 0}
        self._moves: dict[tuple[int, str], tuple[int, ...]] = {}

    def _follow(self, start: str) -> dict[str, set[str]]:
        """The terminals that may stand behind each symbol; '' is the end."""
        first = {s: set() for s in self.symbols}
        follow = {s: set() for s in self.symbols} | {start: {""}}

        def heads(right):
            found = set()
            for x in right:
                own = first[x] if x in self.symbols else {x}
                found |= own - {""}
                if "" not in own:
                    return found
            return found | {""}

        size = -1
        while size != (size := sum(map(len, chain(first.values(), follow.values())))):
            for lhs, right in self.rules[1:]:
                first[lhs] |= heads(right)
                for i, x in enumerate(right):
                    if x in self.symbols:
                        behind = heads(right[i + 1:])
                        follow[x] |= (behind - {""}) | (follow[lhs] if "" in behind else set())
        return follow

    def _state(self, kernel: set) -> int:
        items, todo = set(kernel), list(kernel)
        while todo:
            rule, dot = todo.pop()
            right = self.rules[rule][1]
            if dot < len(right) and right[dot] in self.symbols:
                new = {(i, 0) for i, (lhs, _) in enumerate(self.rules) if lhs == right[dot]} - items
                items |= new
                todo += new
        key = frozenset(items)
        if key not in self._states:
            self._states[key] = len(self._items)
            self._items.append(key)
        return self._states[key]

    def _next(self, state: int, symbol: str) -> int | None:
        if (state, symbol) not in self._goto:
            kernel = {(r, d + 1) for r, d in self._items[state] if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol}
            self._goto[state, symbol] = self._state(kernel) if kernel else None
        return self._goto[state, symbol]

    def _on(self, below: int, symbol: str) -> int | None:
        """The node of ``symbol`` on top of a node, if the grammar allows it."""
        state = self._next(self.nodes[below][0], symbol)
        if state is None:
            return None
        key = (state, below)
        if key not in self._numbers:
            self._numbers[key] = len(self.nodes)
            self.nodes.append(key)
        return self._numbers[key]

    def _reduced(self, node: int, ahead: str) -> set[int]:
        """All nodes that a node becomes by reductions before ``ahead``, itself included."""
        found, todo = {node}, [node]
        while todo:
            top = todo.pop()
            for rule, dot in self._items[self.nodes[top][0]]:
                lhs, right = self.rules[rule]
                if rule and dot == len(right) and ahead in self.follow[lhs]:
                    below = top
                    for _ in right:
                        below = self.nodes[below][1]
                    new = self._on(below, lhs)
                    if new is not None and new not in found:
                        found.add(new)
                        todo.append(new)
        return found

    def moves(self, node: int, terminal: str) -> tuple[int, ...]:
        """The nodes reached when ``terminal`` is read on top of a node."""
        key = (node, terminal)
        if key not in self._moves:
            tops = (self._on(n, terminal) for n in self._reduced(node, terminal))
            self._moves[key] = tuple(sorted({t for t in tops if t is not None}))
        return self._moves[key]

    def accepts(self, node: int) -> bool:
        return any((0, 1) in self._items[self.nodes[n][0]] for n in self._reduced(node, ""))


@lru_cache(None)
def role_table() -> tuple[LrTable, tuple[int, ...]]:
    """The table of the role grammar, and its nodes between turns."""
    table, found, todo = LrTable(ROLE_GRAMMAR), {0}, [0]
    while todo:
        node = todo.pop()
        new = {m for t in "sua" for m in table.moves(node, t)} - found
        found |= new
        todo += new
    return table, tuple(sorted(found))


Best = dict[int, tuple[int, str]]


def _offer(best: Best, node: int, value: tuple[int, str]) -> bool:
    if node not in best or value < best[node]:
        best[node] = value
        return True
    return False


def inserted(best: Best) -> Best:
    """The tops that insertions reach as well, cheapest first."""
    table, _ = role_table()
    best, todo = dict(best), []
    for node, value in best.items():
        heappush(todo, (*value, node))
    while todo:
        cost, audit, node = heappop(todo)
        if best[node] == (cost, audit):
            for role in ROLES:
                for top in table.moves(node, role):
                    if _offer(best, top, (cost + INSERT, audit + "I")):
                        heappush(todo, (cost + INSERT, audit + "I", top))
    return best


def edit(best: Best, initial: str, fault: str) -> Best:
    """The least edits for every top after one more turn."""
    table, _ = role_table()
    after: Best = {}
    for node, (cost, audit) in inserted(best).items():
        _offer(after, node, (cost + DELETE, audit + "D"))
        if fault == GONE:
            continue
        cost += TRUNCATED * (fault == CUT)
        for top in table.moves(node, initial):
            _offer(after, top, (cost + KEEP, audit + "K"))
        for role in ROLES:
            if role != initial:
                for top in table.moves(node, role):
                    _offer(after, top, (cost + REROLE, audit + "R"))
    return after


@lru_cache(50_000)
def routes(signature: str, first: bool) -> tuple[list[int], list[int], list[int], list[str]]:
    """Least edits of a block as (starts, ends, costs, audits); ``signature`` has initial and fault of each turn.

    The first block of a conversation begins with the empty stack only.
    """
    found = ([], [], [], [])
    for start in (0,) if first else role_table()[1]:
        best: Best = {start: (0, "")}
        for at in range(0, len(signature), 2):
            best = edit(best, signature[at], signature[at + 1])
        for end, (cost, audit) in best.items():
            for column, value in zip(found, (start, end, cost, audit)):
                column.append(value)
    return found


def prepared(
    conversations: DataFrame, *, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """(conv_id, block, turn, role, text, digest) of the turns."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(conv_column).cast("long").alias("conv_id"), block_of(F.col(turn_column)).alias("block"), F.col(turn_column).cast("long").alias("turn"),
        text(role_column).alias("role"), text(text_column).alias("text"),
    )
    return rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def _seen_before(rows: DataFrame) -> DataFrame:
    """(conv_id, block, role, digest) of what an earlier block of the conversation holds as well."""
    key = ["conv_id", "role", "digest"]
    each = rows.groupBy(*key, "block").agg(F.count("*").alias("n"))
    first = each.groupBy(*(F.col(c).alias(f"_{c}") for c in key)).agg(F.min("block").alias("first"), F.max("block").alias("last")).where("first < last")
    same = [each[c].eqNullSafe(F.col(f"_{c}")) for c in key]
    return each.join(first, same[0] & same[1] & same[2] & (each["block"] > F.col("first"))).select("conv_id", "block", "role", "digest")


def block_edits(rows: DataFrame) -> DataFrame:
    """One row per block: its counts, and its least edits between stack tops."""
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.right(ended, F.lit(1))
    fault = F.when(ended == "", GONE).when(~last.isin(".", "!", "?"), CUT).otherwise(CLEAN)
    none = lambda kind: F.lit(None).cast(kind)
    small = rows.select("conv_id", "block", F.lit(2).alias("kind"), "turn", "role", "digest", fault.alias("fault"), none("long").alias("before"), none("long").alias("total"))
    marks = _seen_before(rows).select("conv_id", "block", F.lit(1).alias("kind"), none("long").alias("turn"), "role", "digest",
                                      none("string").alias("fault"), none("long").alias("before"), none("long").alias("total"))
    heads = block_heads(rows).select("conv_id", "block", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"),
                                     none("binary").alias("digest"), none("string").alias("fault"), "before", "total")
    ordered = in_order(heads.unionByName(marks).unionByName(small), ["conv_id", "block"], ["kind", "turn", "role", "digest"])
    schema = arrow_schema(BLOCKS)

    def work(batches):
        def blocks():
            for (conv_id, block), found in runs(batches, 2):
                *_, before, total = next(found)
                seen, numbers, signature = set(), set(), []
                counts, illegal, n, opening, previous = defaultdict(int), 0, 0, None, None
                for _, _, kind, turn, role, digest, fault, _, _ in found:
                    if kind == 1:
                        seen.add((role, digest))
                        continue
                    initial = role[:1]
                    if fault == GONE:
                        counts["blank"] += 1
                    elif (role, digest) in seen:
                        fault = GONE
                        counts["duplicate"] += 1
                    else:
                        counts["truncated"] += fault == CUT
                    seen.add((role, digest))
                    numbers.add(turn)
                    if n and previous + initial not in NEIGHBOURS:
                        illegal += 1
                    opening, previous, n = initial if n == 0 else opening, initial, n + 1
                    signature.append((initial if initial in "sua" and initial else "-") + fault)
                numbers.discard(None)
                yield (
                    conv_id, block, before, total, n, counts["blank"], counts["duplicate"], counts["truncated"], illegal, opening, previous,
                    min(numbers, default=None), max(numbers, default=None), len(numbers), *routes("".join(signature), before == 0),
                )

        yield from record_batches(blocks(), schema)

    return materialise(ordered.mapInArrow(work, BLOCKS))


def chained(blocks: DataFrame) -> DataFrame:
    """The least edits of whole conversations: each block's piece of the audit, and a summary at the last block.

    ``placed`` is the number of turns that earlier blocks leave, ``opened`` whether a system turn opens the result.
    """
    schema = arrow_schema(PIECES)

    def work(batches):
        def pieces():
            table, _ = role_table()
            for (conv_id,), found in runs(batches, 1):
                best: Best = {0: (0, "")}
                back, sums, low, high, previous = [], [0] * 5, None, None, None
                for _, block, _, _, n, blank, duplicate, truncated, illegal, opening, last, lo, hi, numbers, *found_routes in found:
                    came, after = {}, {}
                    for start, end, cost, audit in zip(*found_routes):
                        if start in best and _offer(after, end, (best[start][0] + cost, best[start][1] + audit)):
                            came[end] = (start, audit)
                    best = after
                    back.append((block, came))
                    border = previous is not None and previous + opening not in NEIGHBOURS
                    sums = [a + b for a, b in zip(sums, (blank, duplicate, truncated, illegal + border, numbers))]
                    low, high, previous = min((x for x in (low, lo) if x is not None), default=None), max((x for x in (high, hi) if x is not None), default=None), last
                ended = inserted(best)
                (cost, audit), node = min((value, node) for node, value in ended.items() if table.accepts(node))
                # The closing insertions belong to the last block.
                node, closing = min((n, audit[len(a):]) for n, (c, a) in best.items() if audit.startswith(a) and c + INSERT * (len(audit) - len(a)) == cost and set(audit[len(a):]) <= {"I"})
                cut = []
                for block, came in reversed(back):
                    start, piece = came[node]
                    cut.append((block, piece))
                    node = start
                cut.reverse()
                cut[-1] = (cut[-1][0], cut[-1][1] + closing)
                left = len(audit) - audit.count("D")
                gaps = 0 if low is None else high - low + 1 - sums[4]
                placed = 0
                for number, (block, piece) in enumerate(cut, 1):
                    summary = {"gaps": gaps, "blank": sums[0], "duplicate": sums[1], "truncated": sums[2], "illegal": sums[3], "cost": cost, "audit": audit}
                    yield conv_id, block, piece, placed, left % 2 == 1, summary if number == len(cut) else None
                    placed += len(piece) - piece.count("D")

        yield from record_batches(pieces(), schema)

    return materialise(in_order(blocks, ["conv_id"], ["block"]).mapInArrow(work, PIECES))


def repaired_turns(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: (conv_id, place, edit, turn, role, text)."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = pieces.select("conv_id", "block", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"),
                          none("binary").alias("digest"), none("string").alias("text"), "audit", "placed", "opened")
    turns = rows.select("conv_id", "block", F.lit(1).alias("kind"), "turn", "role", "digest", "text",
                        none("string").alias("audit"), none("long").alias("placed"), none("boolean").alias("opened"))
    ordered = in_order(heads.unionByName(turns), ["conv_id", "block"], ["kind", "turn", "role", "digest"])
    schema = arrow_schema(REPAIRED)

    def work(batches):
        def written():
            for (conv_id, _), found in runs(batches, 2):
                *_, audit, place, opened = next(found)
                for letter in audit:
                    turn = role = text = None
                    if letter != "I":
                        _, _, _, turn, role, _, text, *_ = next(found)
                    if letter == "D":
                        continue
                    if letter in "IR":
                        role = ROLES["ua"[(place - opened) % 2]]
                    yield conv_id, place, letter, turn, role, text or ""
                    place += 1

        yield from record_batches(written(), schema)

    return ordered.mapInArrow(work, REPAIRED)


def repair(conversations: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Summaries (conv_id, gaps, faults, cost, audit) of conversations, and their repaired turns."""
    rows = prepared(conversations, **columns)
    pieces = chained(block_edits(rows))
    return pieces.where("summary IS NOT NULL").select("conv_id", "summary.*"), repaired_turns(rows, pieces)


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage: by the CRC-32 of conversation and turn, rows go, lose text or marks, repeat or change role."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), lot.alias("lot")).where("lot <> 0")
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("lot") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def turns_digest(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of ``role:text`` joined by line ends.

    One task streams a conversation from first to last turn, since the sum does; it holds one turn.
    """
    schema = arrow_schema("conv_id long, repaired_sha256 string")

    def work(batches):
        def rows():
            for (conv_id,), found in runs(batches, 1):
                digest, joint = hashlib.sha256(), ""
                for _, _, role, text in found:
                    digest.update(f"{joint}{role}:{text}".encode())
                    joint = "\n"
                yield conv_id, digest.hexdigest()

        yield from record_batches(rows(), schema)

    ordered = in_order(turns.select("conv_id", "place", "role", "text"), ["conv_id"], ["place"])
    return ordered.mapInArrow(work, "conv_id long, repaired_sha256 string")


def with_every_id(conversations: DataFrame, summaries: DataFrame, sums: DataFrame) -> DataFrame:
    """One row per id of ``conversations``; those without a row left have zeros, an empty audit and the sum of nothing."""
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    joined = ids.join(summaries, ids["id"].eqNullSafe(summaries["conv_id"]), "left").drop("conv_id")
    joined = joined.join(sums, joined["id"].eqNullSafe(sums["conv_id"]), "left").drop("conv_id")
    number = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return joined.select(
        F.col("id").alias("conv_id"), *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
