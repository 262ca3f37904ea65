"""Conversation structure repair: the cheapest edits that make a conversation alternate, as one integer minimum.

Method: scalar big-integer weights on a path through a DAG. A node is (rows consumed, state of the pattern
``(s?(ua)+)?``), an edge the edits at one row: up to two insertions and then keep, rerole or delete. The weight of an
edge is one integer. Its high digits are the cost. Its low digits are the letters of its edits, at the place of the row:
every row has a slot of three letters, filled from the left and padded with zeros at its end. The smallest sum of edge weights is
the least cost, and among equal costs the ASCII-least audit: no row's letters are a prefix of another choice of letters
(each ends in its one D, K or R), so padding never decides before a letter does, and insertions after the last row are one
more slot whose padding makes the shorter audit the smaller. A third insertion at one place would only return
to a state that was there before, at a cost. Each state lets follow just one of user and assistant, so the audit
fixes the roles as well.

Scale. Rows are numbered by the skew-proof ordered scan, so a conversation that holds a third of all rows is sorted over many
tasks. It is solved in blocks of ``BLOCK`` rows, each by itself, from every state to every state; the blocks of a conversation meet
as at most 16 small numbers each (cost, and rank of the letters among the block's own 16 paths), which keep the order of the big
integers. Rows and their edits are joined on (conversation, position), which no key can skew.

Defined results: a null role or text is one space; null turns come first; rows with equal turns go by role and text. A null
conversation id is a conversation of its own. Empty and very long texts are rows like others; a role may be any
text, of which the first character counts (an empty role has none and can only be reroled or deleted). Empty table: empty results.
Columns beyond the four named ones are not carried, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, shared_table
from strata.operators.sequence import ordered_scan

BLOCK = 8192
#: Edits in ASCII order; a letter's digit is its place, 0 is padding.
LETTERS = "0DIKR"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED_COST = 5
BITS, SLOT_LETTERS = 3, 3
SLOT = BITS * SLOT_LETTERS
MAX_INSERTS = 2
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES, ACCEPTED = (0, 1, 2, 3), (0, 3)
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}
#: The one of user and assistant that may follow a state.
NEXT = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
FAULTS = ("", "delete", "truncated")


def _digits(letters: str) -> int:
    n = 0
    for c in letters.ljust(SLOT_LETTERS, "0"):
        n = n << BITS | LETTERS.index(c)
    return n


def _follow(state: int) -> int:
    return AFTER[NEXT[state]][state]


def _edges(initial: str, fault: str) -> dict[int, list[tuple[int, int, int]]]:
    """state -> (cost, slot, next state) of all edits at a row."""
    out: dict[int, list[tuple[int, int, int]]] = {q: [] for q in STATES}
    for q in STATES:
        p = q
        for inserts in range(MAX_INSERTS + 1):
            paid, letters = inserts * COST["I"], "I" * inserts
            out[q].append((paid + COST["D"], _digits(letters + "D"), p))
            if fault != "delete":
                more = TRUNCATED_COST if fault == "truncated" else 0
                if p in AFTER[initial]:
                    out[q].append((paid + more + COST["K"], _digits(letters + "K"), AFTER[initial][p]))
                out[q].append((paid + more + COST["R"], _digits(letters + "R"), _follow(p)))
            p = _follow(p)
    return out


#: A row as one character: its initial and its fault.
CODES = {chr(ord("A") + 3 * i + f): (initial, fault) for i, initial in enumerate("suax") for f, fault in enumerate(FAULTS)}
EDGES = {code: _edges(*row) for code, row in CODES.items()}
MAX_COST = MAX_INSERTS * COST["I"] + COST["D"] + TRUNCATED_COST


def least(codes: str, start: int) -> dict[int, int]:
    """State at the end -> least weight of a path through the rows from ``start``."""
    width = SLOT * len(codes)
    high = [c << width for c in range(MAX_COST + 1)]
    best = {start: 0}
    for r, code in enumerate(codes):
        at, new = width - SLOT * (r + 1), {}
        for q, w in best.items():
            for cost, slot, to in EDGES[code][q]:
                v = w + high[cost] + (slot << at)
                if to not in new or v < new[to]:
                    new[to] = v
        best = new
    return best


def slots(digits: int, rows: int) -> list[str]:
    """The letters of each row, from the low digits of a weight."""
    whole = digits.to_bytes(-(-SLOT * rows // 8) or 1, "big")
    bits = bin(int.from_bytes(whole, "big"))[2:].rjust(SLOT * rows, "0")
    return ["".join(LETTERS[int(bits[k : k + BITS], 2)] for k in range(a, a + SLOT, BITS)).strip("0") for a in range(0, SLOT * rows, SLOT)]


def solve_block(codes: str, starts: tuple[int, ...]) -> list[dict]:
    """All paths from the starts: their cost, the rank of their letters, and the letters of each row."""
    width = SLOT * len(codes)
    found = [(q, to, w >> width, w & ((1 << width) - 1)) for q in starts for to, w in least(codes, q).items()]
    rank = {d: k for k, d in enumerate(sorted({d for *_, d in found}))}
    return [{"from": q, "to": to, "cost": c, "rank": rank[d], "edits": slots(d, len(codes))} for q, to, c, d in found]


def chain(blocks: list[list[dict]]) -> tuple[int, list[tuple[int, int]], int]:
    """(cost, the path's states before and after each block, insertions at the end) of the least path through all blocks."""
    best, back = {0: 0}, []
    for paths in blocks:
        new: dict[int, tuple[int, int]] = {}
        for p in paths:
            if p["from"] in best:
                v = best[p["from"]] + (p["cost"] << 16) + p["rank"]
                if p["to"] not in new or v < new[p["to"]][0]:
                    new[p["to"]] = v, p["from"]
        back.append({to: q for to, (_, q) in new.items()})
        # Letters so far become their rank among the states: later digits only count where these are equal.
        rank = {d: k for k, d in enumerate(sorted({v & 0xFFFF for v, _ in new.values()}))}
        best = {to: (v >> 16 << 16) + (rank[v & 0xFFFF] << 8) for to, (v, _) in new.items()}
    ends = []
    for q, w in best.items():
        p = q
        for inserts in range(MAX_INSERTS + 1):
            if p in ACCEPTED:
                ends.append((w + (inserts * COST["I"] << 16) + inserts, inserts, q))
            p = _follow(p)
    total, tail, q = min(ends)
    path = []
    for step in reversed(back):
        path.append((step[q], q))
        q = step[q]
    return total >> 16, path[::-1], tail


_PATHS = "array<struct<`from`:int,`to`:int,cost:long,rank:int,edits:array<string>>>"


def _solve(batches):
    path = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.list_(pa.string()))])
    for batch in batches:
        at, held, solved = 0, 0, []
        codes, blocks = batch.column("codes").to_pylist(), batch.column("block").to_pylist()
        for k, (own, block) in enumerate(zip(codes, blocks, strict=True), 1):
            solved.append(solve_block(own, STATES if block else STATES[:1]))
            held += len(own)
            if held >= BLOCK or k == len(codes):
                part = batch.slice(at, k - at)
                yield pa.RecordBatch.from_arrays([part.column("conv"), part.column("block"), pa.array(solved, pa.list_(path))], names=["conv", "block", "paths"])
                at, held, solved = k, 0, []


def _link(batches):
    step = pa.struct([("block", pa.int64()), ("from", pa.int32()), ("to", pa.int32())])
    for batch in batches:
        costs, steps, tails = [], [], []
        for blocks in batch.column("blocks").to_pylist():
            cost, path, tail = chain([b["paths"] for b in blocks])
            costs.append(cost)
            tails.append(tail)
            steps.append([{"block": b["block"], "from": q, "to": to} for b, (q, to) in zip(blocks, path, strict=True)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(costs, pa.int64()), pa.array(tails, pa.int32()), pa.array(steps, pa.list_(step))], names=["conv", "cost", "tail", "steps"]
        )


def mark(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, turn, role, text, initial, illegal, fault) per row, written once; ``pos`` counts from 0 within a conversation."""
    space = F.lit(" ")
    plain = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
    )
    plain = plain.withColumn("initial", F.substring("role", 1, 1))
    placed = ordered_scan(plain, ["conv"], ["turn", "role", "text"], lags={"before": ("initial", 1)}, running={"pos": F.lit(1)})
    said = F.btrim("text", F.lit(SPACES))
    fault = F.when(said == "", "blank").when(~F.substring(said, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    legal = F.concat("before", "initial").isin("su", "ua", "au")
    marked = placed.select(
        "conv", (F.col("pos") - 1).cast("long").alias("pos"), "turn", "role", "text", "initial",
        ((F.col("pos") > 1) & ~legal).alias("illegal"), fault.alias("fault"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), F.col("text"), F.col("role")).alias("h2"),
    )
    marked = shared_table(marked, "repair-rows")
    # A message said once needs no join; a hot message is reduced before the shuffle.
    again = marked.groupBy("conv", "h1", "h2").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = shared_table(again.select(F.col("conv").alias("c"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first"), "repair-repeated")
    both = marked.join(again, marked["conv"].eqNullSafe(again["c"]) & (marked["h1"] == again["g1"]) & (marked["h2"] == again["g2"]), "left")
    duplicate = F.coalesce(F.col("pos") > F.col("first"), F.lit(False)) & (F.col("fault") != "blank")
    return shared_table(both.select(*marked.columns[:-2], F.when(duplicate, "duplicate").otherwise(F.col("fault")).alias("found")).drop("fault").withColumnRenamed("found", "fault"), "repair-marked")


def edits(marked: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The least edits: (conv, pos, edits, roles) per row, and (conv, cost, tail, rows) per conversation.

    ``edits`` are the letters at a row, ``roles`` the initials that its insertions and its rerole give, ``tail`` the number of
    insertions after the last row.
    """
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    kind = F.when(F.col("fault").isin("blank", "duplicate"), 1).when(F.col("fault") == "truncated", 2).otherwise(0)
    code = F.char(F.lit(ord("A")) + 3 * (F.position(initial, F.lit("suax")) - 1) + kind)
    coded = marked.select("conv", F.col("pos"), F.floor(F.col("pos") / block).alias("block"), code.alias("code"))
    blocks = coded.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows"))  # at most ``block`` characters
    blocks = blocks.select("conv", "block", F.array_join("rows.code", "").alias("codes"))
    kept = marked.schema["conv"].dataType.simpleString()
    solved = shared_table(blocks.mapInArrow(_solve, f"conv {kept}, block long, paths {_PATHS}"), "repair-blocks")
    small = F.transform("paths", lambda p: F.struct(p["from"].alias("from"), p["to"].alias("to"), p["cost"].alias("cost"), p["rank"].alias("rank")))
    linked = solved.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", small.alias("paths")))).alias("blocks"))
    step = "struct<block:long,`from`:int,`to`:int>"
    linked = shared_table(linked.mapInArrow(_link, f"conv {kept}, cost long, tail int, steps array<{step}>"), "repair-paths")
    taken = linked.select(F.col("conv").alias("c"), F.explode("steps").alias("step"))
    own = solved.join(taken, solved["conv"].eqNullSafe(taken["c"]) & (solved["block"] == F.col("step.block")))
    path = F.filter("paths", lambda p: (p["from"] == F.col("step.from")) & (p["to"] == F.col("step.to")))[0]
    by_row = own.select("conv", "block", F.posexplode(path["edits"]).alias("at", "edits"))
    return by_row.select("conv", (F.col("block") * block + F.col("at")).alias("pos"), "edits"), linked.select("conv", "cost", "tail")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The rows with their faults and edits, and the cost and closing insertions of each conversation."""
    marked = mark(rows, conv_col, turn_col, role_col, text_col)
    by_row, by_conv = edits(marked, block)
    by_row = by_row.select(F.col("conv").alias("c"), F.col("pos").alias("p"), "edits")
    return marked.join(by_row, marked["conv"].eqNullSafe(by_row["c"]) & (marked["pos"] == by_row["p"])).drop("c", "p"), by_conv


class Conversation:
    """The repaired messages of one conversation, from its rows in order; only digests and letters are kept."""

    def __init__(self):
        self.state, self.audit, self.sha, self.said = 0, [], hashlib.sha256(), 0

    def say(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.said else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.said += 1

    def edit(self, letter: str, role: str = "", text: str = "") -> None:
        self.audit.append(letter)
        if letter == "D":
            return
        if letter == "K":
            self.state = AFTER[role[0]][self.state]
        else:
            role, self.state = ROLES[NEXT[self.state]], _follow(self.state)
        self.say(role, text)


def _digest(batches):
    """Rows sorted by conversation and position, the last of each with its closing insertions -> one row per conversation."""
    conv, state = None, None

    def done(kind):
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array(["".join(state.audit)]), pa.array([state.sha.hexdigest()])], names=["conv", "audit", "repaired_sha256"])

    kind = None
    for batch in batches:
        kind = batch.column("conv").type
        columns = zip(*(batch.column(c).to_pylist() for c in ("conv", "pos", "edits", "role", "text", "tail")), strict=True)
        for key, own in groupby(columns, key=lambda r: r[0]):
            for _, pos, letters, role, text, tail in own:
                if pos == 0:
                    if state is not None:
                        yield done(kind)
                    conv, state = key, Conversation()
                for letter in letters[:-1]:
                    state.edit(letter)
                state.edit(letters[-1], role, text)
                for _ in range(tail or 0):
                    state.edit("I")
    if state is not None:
        yield done(kind)


def digests(repaired: DataFrame, by_conv: DataFrame) -> DataFrame:
    """(conv, cost, audit, repaired_sha256) per conversation: its rows stream through the digest in order, none are collected."""
    last = repaired.groupBy("conv").agg(F.max("pos").alias("last"))
    ends = by_conv.join(last, by_conv["conv"].eqNullSafe(last["conv"])).select(by_conv["conv"].alias("c"), "last", "tail").where("tail > 0")
    rows = repaired.join(ends, repaired["conv"].eqNullSafe(ends["c"]) & (repaired["pos"] == ends["last"]), "left")
    ordered = rows.select("conv", "pos", "edits", "role", "text", "tail").repartition("conv").sortWithinPartitions("conv", "pos")
    made = ordered.mapInArrow(_digest, f"conv {repaired.schema['conv'].dataType.simpleString()}, audit string, repaired_sha256 string")
    cost = by_conv.select(F.col("conv").alias("c"), "cost")
    return made.join(cost, made["conv"].eqNullSafe(cost["c"])).drop("c")
