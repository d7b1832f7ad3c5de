"""Repair of the turn structure of conversations by Wagner-Fischer alignment with each feasible target.

A sound conversation has role initials ``(s?(ua)+)?``: nothing, or user and assistant in turn, perhaps after a system turn. Turns are kept (cost 0),
given another role (2), deleted (3) or inserted without text (2); blank and duplicate turns must be deleted, and a truncated turn that stays
costs 1. The cheapest edits are wanted, of equally cheap ones those whose initials (D, I, K, R) come first in ASCII order.

1. Rows with the same conversation, turn, role and text become one row with a count, per partition before the shuffle. The first row of
   each role and text of a conversation is found by an aggregation and joined; all others are duplicates. Counts of faults are aggregations, too.
2. Rows are sorted by conversation and turn over all partitions, so a long conversation lies in many. Each partition cuts its rows into chunks of
   one conversation with at most ``CHUNK`` turns that need not be deleted.
3. A chunk is aligned with every target it could have: from each state that it can be entered in (nothing yet, or the role before), the grammar
   gives one alternating string of each length (with and without a system turn at the beginning). Lengths are tried from the nearest on. The cost of the best length so
   far is the incumbent: it bounds the lengths, and the band of cells around the diagonal that Wagner-Fischer fills (Ukkonen). The least audit of
   each length is traced back and compared. What is left is the cheapest cost and least audit for each pair of states.
4. A conversation of one chunk is done then. The chunks of others are put together by a stream over their sorted results: for each
   state the cheapest way and its audit, where what all ways have in common is given out. No two ways with the same cost to one state have audits of which one
   begins with the other, so the least parts make the least whole.

Nothing holds a whole conversation but its audit, which is one value of the result. Digests are computed as a stream over chunks.

Defined results: a null role or text is one space. A null turn comes before all others and counts for no gap; a null conversation id is a
conversation of its own. Rows of one turn are in order of role and text; repeated rows are duplicates of the first. A role is judged by its first
character, case-sensitive; other roles than system, user and assistant must be changed or deleted. ``listed`` ids without rows get zeros and an empty audit.
An empty table gives an empty table. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.llm.common import Scratch

#: Turns of a chunk that need not be deleted, all its rows, and its characters.
CHUNK, ROWS, CHARS = 32, 2048, 1_000_000
#: Costs of edits, white space, ends of a whole text, pairs of initials that may follow each other.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}
#: States: nothing yet, or the initial of the last turn. A conversation ends in one of ``FINAL``.
STATES, FINAL = ("", "s", "u", "a"), ("", "a")
NEVER = 1 << 60


def targets(entry: str, exit_: str) -> Iterator[tuple[int, str]]:
    """Lengths and strings of the grammar, in order of length, that lead from one state to another."""
    for length in range(NEVER):
        found = []
        if not length:
            found = [""] if entry == exit_ else []
        elif entry == "":
            found = [("ua" * length)[:length], "s" + ("ua" * length)[: length - 1]]
        else:
            found = [("ua" * length)[:length] if entry != "u" else ("au" * length)[:length]]
        for t in found:
            if not t or t[-1] == exit_:
                yield length, t
        if not length and exit_ == "" or length == 1 and exit_ == "s":
            return  # nothing leads there later on


def drift(d: int) -> int:
    """The least cost of a difference of ``d`` between target places and turns."""
    return INSERT * d if d > 0 else -DELETE * d


def aligned(turns: str, target: str, limit: int) -> tuple[int, str] | None:
    """Cost and least audit of the edits that make ``turns`` the target, if no more than ``limit``.

    ``turns``: an initial for each turn, in upper case if its text is truncated. Costs are those of what is left, from the ends backwards, so that the
    audit is read forwards.
    """
    n, m = len(turns), len(target)
    width = [d for d in range(-n, m + 1) if drift(d) + drift(m - n - d) <= limit]
    if not width:
        return None
    low, high = width[0], width[-1]
    costs: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        own, below = costs[i], costs[i + 1] if i < n else {}
        initial = turns[i].lower() if i < n else ""
        stays = TRUNCATED if i < n and turns[i] != initial else 0
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = 0 if i == n and j == m else NEVER
            if i < n:
                best = min(best, DELETE + below.get(j, NEVER))
            if j < m:
                if target[j] != "s":
                    best = min(best, INSERT + own.get(j + 1, NEVER))
                if i < n:
                    if initial == target[j]:
                        best = min(best, stays + below.get(j + 1, NEVER))
                    elif target[j] != "s":
                        best = min(best, REROLE + stays + below.get(j + 1, NEVER))
            own[j] = best
    total = costs[0].get(0, NEVER)
    if total > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        here = costs[i][j]
        below = costs[i + 1] if i < n else {}
        if i < n and here == DELETE + below.get(j, NEVER):
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and here == INSERT + costs[i].get(j + 1, NEVER):
            audit.append("I")
            j += 1
        else:  # keep and change lead to the same cell; only one of them is possible
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


@lru_cache(maxsize=1 << 16)
def cheapest(turns: str, entry: str, exits: tuple[str, ...]) -> tuple[int, str, str] | None:
    """Cost, audit and exit of the cheapest edits over all feasible lengths and the given exits."""
    n, best = len(turns), None
    limit = (DELETE + TRUNCATED) * n + 2 * INSERT  # deletes all and inserts two; beyond it only ways that need a system turn
    found = []
    for exit_ in exits:
        for length, target in targets(entry, exit_):
            if length > n and drift(length - n) > limit:
                break
            found.append((abs(length - n), length, target, exit_))
    for _, length, target, exit_ in sorted(found):
        if drift(length - n) <= limit and (a := aligned(turns, target, limit)):
            if best is None or (a[0], a[1]) < best[:2]:
                best, limit = (*a, exit_), a[0]
    return best


def woven(audit: str, forced: list[tuple[bool, int]]) -> str:
    """The audit of all turns: those that must be deleted go as soon as they are met. ``forced``: for each row whether all its copies
    must be deleted, or all but the first, and their number."""
    out, at = [], 0
    for gone, copies in forced:
        if not gone:
            begin = at
            while audit[at] == "I":
                at += 1
            at += 1
            out.append(audit[begin:at])
        out.append("D" * (copies if gone else copies - 1))
    return "".join(out) + audit[at:]


@dataclass
class Chunk:
    """Consecutive rows of one conversation."""

    roles: list[str]
    texts: list[str]
    copies: list[int]
    gone: list[bool]
    cut: list[bool]

    def turns(self) -> str:
        out = []
        for role, gone, cut in zip(self.roles, self.gone, self.cut):
            if not gone:
                initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
                out.append(initial.upper() if cut else initial)
        return "".join(out)

    def illegal(self) -> int:
        initials = [r[:1] for r in self.roles]
        return sum(self.copies) - len(self.copies) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))

    def ways(self, entries: tuple[str, ...], exits: tuple[tuple[str, ...], ...]) -> list[dict]:
        turns, forced = self.turns(), list(zip(self.gone, self.copies))
        must = DELETE * sum(c if g else c - 1 for g, c in forced)
        out = []
        for entry in entries:
            for some in exits:
                if a := cheapest(turns, entry, some):
                    out.append({"entry": entry, "exit": a[2], "cost": a[0] + must, "audit": woven(a[1], forced)})
        return out


WAYS = "array<struct<entry:string,exit:string,cost:long,audit:string>>"
CHUNKS = f"conv long, at long, alone boolean, illegal long, first string, last string, ways {WAYS}, roles array<string>, texts array<string>, copies array<long>"


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int, Chunk, bool]]:
    """Chunks of sorted rows: conversation, number, rows, and whether it is all of a conversation that lies within the partition."""
    number, conv, inside = 0, None, False  # inside: another conversation came before
    held: Chunk | None = None
    alive = chars = 0
    begun = False  # a chunk of this conversation was given before
    for b in batches:
        for c, role, text, copies, gone, cut in zip(*[b.column(k).to_pylist() for k in range(6)]):
            if held is not None and c != conv:
                yield conv, number, held, inside and not begun
                number, held, inside, begun, alive, chars = number + 1, None, True, False, 0, 0
            elif held is not None and (alive + (not gone) > CHUNK or len(held.roles) == ROWS or chars > CHARS):
                yield conv, number, held, False
                number, held, begun, alive, chars = number + 1, None, True, 0, 0
            conv = c
            held = held or Chunk([], [], [], [], [])
            for column, value in zip((held.roles, held.texts, held.copies, held.gone, held.cut), (role, text, copies, gone, cut)):
                column.append(value)
            alive, chars = alive + (not gone), chars + len(text)
    if held is not None:
        yield conv, number, held, False


def chunked(rows: DataFrame) -> DataFrame:
    schema = pa.schema(
        [("conv", pa.int64()), ("at", pa.int64()), ("alone", pa.bool_()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string())]
        + [("ways", pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])))]
        + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("copies", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = TaskContext.get().partitionId() << 40
        out, size = [], 0
        for conv, number, c, alone in chunks_of(batches):
            ways = c.ways(("",), (FINAL,)) if alone else c.ways(STATES, tuple((x,) for x in STATES))
            out.append((conv, before + number, alone, c.illegal(), c.roles[0][:1], c.roles[-1][:1], ways, c.roles, c.texts, c.copies))
            size += 100 + sum(map(len, c.texts))
            if size > CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return rows.select("conv", "role", "text", "copies", "gone", "cut").mapInArrow(run, CHUNKS)


class Joined:
    """The ways through the chunks of one conversation so far: for each state the cheapest, with its audit and the choices it is made of."""

    def __init__(self):
        self.ways: dict[str, tuple[int, str, list[tuple]]] = {"": (0, "", [])}

    def add(self, at: int, ways: list[dict]) -> list[tuple]:
        """Go through a chunk; gives out the choices that all ways begin with."""
        new: dict[str, tuple[int, str, list]] = {}
        for w in ways:
            if w["entry"] in self.ways:
                cost, audit, choices = self.ways[w["entry"]]
                way = (cost + w["cost"], audit + w["audit"])
                if w["exit"] not in new or way < new[w["exit"]][:2]:
                    new[w["exit"]] = (*way, [*choices, (at, w["cost"], w["entry"], w["audit"])])
        self.ways = new
        some = [c for _, _, c in new.values()]
        same = 0
        while same < min(map(len, some)) and all(c[same] == some[0][same] for c in some):
            same += 1
        out = some[0][:same]
        skip = sum(len(choice[-1]) for choice in out)
        self.ways = {x: (cost, audit[skip:], choices[same:]) for x, (cost, audit, choices) in new.items()}
        return out

    def end(self) -> list[tuple]:
        return min((cost, audit, choices) for x, (cost, audit, choices) in self.ways.items() if x in FINAL)[2]


def joined(pieces: DataFrame) -> DataFrame:
    """conv, at, cost, entry, audit, illegal of each chunk of the conversations that have several."""
    kinds = {"conv": pa.int64(), "at": pa.int64(), "cost": pa.int64(), "entry": pa.string(), "audit": pa.string(), "illegal": pa.int64()}
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, last, held = None, None, None

        def given(choices: list[tuple], illegal: int) -> pa.RecordBatch:
            rows = [(conv, *c, 0 if i else illegal) for i, c in enumerate(choices)]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

        waiting = 0  # illegal pairs that are not given out yet
        for b in batches:
            for row in b.to_pylist():
                if held is not None and row["conv"] != conv:
                    yield given(held.end(), waiting)
                    held = None
                if held is None:
                    held, last, waiting = Joined(), None, 0
                conv = row["conv"]
                waiting += row["illegal"] + (last is not None and last + row["first"] not in LEGAL)
                last = row["last"]
                if choices := held.add(row["at"], row["ways"]):
                    yield given(choices, waiting)
                    waiting = 0
        if held is not None:
            yield given(held.end(), waiting)

    pieces = pieces.select("conv", "at", "illegal", "first", "last", "ways").repartition("conv").sortWithinPartitions("conv", "at")
    return pieces.mapInArrow(run, "conv long, at long, cost long, entry string, audit string, illegal long")


def edit(roles: list[str], texts: list[str], copies: list[int], entry: str, audit: str) -> tuple[list[str], list[str]]:
    """Roles and texts of the turns that an audit leaves. ``entry``: the state before them."""
    rows = ((r, t) for r, t, c in zip(roles, texts, copies) for _ in range(c))
    out: tuple[list[str], list[str]] = ([], [])
    state = entry
    for step in audit:
        role, text = next(rows) if step != "I" else ("", "")
        if step != "D":
            if step != "K":  # the grammar has one role that may come next
                role = NAMES["a" if state == "u" else "u"]
            state = role[0]
            out[0].append(role)
            out[1].append(text)
    return out


def edited(chunks: DataFrame) -> DataFrame:
    """conv, at, alone, roles, texts: the turns left of each chunk, from (conv, at, alone, roles, texts, copies, entry, audit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        for b in batches:
            done = [edit(*x) for x in zip(*[b.column(k).to_pylist() for k in range(3, 8)])]
            new = [pa.array([x[k] for x in done], strings) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *new], names=["conv", "at", "alone", "roles", "texts"])

    return chunks.mapInArrow(run, "conv long, at long, alone boolean, roles array<string>, texts array<string>")


@dataclass
class Repaired:
    """``conversations``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. ``turns``: conv, at, alone, roles, texts: the repaired turns,
    in order of ``at``; ``alone`` if the row has all turns of its conversation. Conversations without turns left have empty arrays."""

    conversations: DataFrame
    turns: DataFrame

    def digests(self) -> DataFrame:
        """conv, repaired_sha256: of all ``role:text`` joined by line breaks, as a stream over the rows of long conversations."""
        lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"])), "\n")
        bodies = self.turns.select("conv", "at", "alone", F.size("roles").alias("n"), lines.alias("body"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            conv, held, some = None, None, False
            out = []
            for b in batches:
                for row in zip(*[b.column(k).to_pylist() for k in range(3)]):
                    if held is not None and row[0] != conv:
                        out.append((conv, held.hexdigest()))
                        held = None
                    if held is None:
                        held, some = hashlib.sha256(), False
                    conv = row[0]
                    if row[1]:
                        held.update((b"\n" if some else b"") + row[2].encode())
                        some = True
            if held is not None:
                out.append((conv, held.hexdigest()))
            names, digests = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(digests, pa.string())], names=["conv", "repaired_sha256"])

        parts = bodies.where(~F.col("alone")).repartition("conv").sortWithinPartitions("conv", "at").select("conv", "n", "body")
        one = bodies.where("alone").select("conv", F.sha2("body", 256).alias("repaired_sha256"))
        return one.union(parts.mapInArrow(run, "conv long, repaired_sha256 string"))


def marked(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text, copies, blank, gone (all copies must be deleted), cut (a truncated text) of distinct rows."""

    def said(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    numbers = [F.col(f"`{c}`").cast("long").alias(n) for c, n in ((conv, "conv"), (turn, "turn"))]
    rows = df.select(*numbers, said(role).alias("role"), said(text).alias("text")).groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("key", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    order = F.struct(F.col("turn").isNotNull(), F.col("turn").alias("turn"))
    firsts = rows.groupBy("conv", "key").agg(F.min(order).alias("f")).select(F.col("conv").alias("c"), F.col("key").alias("k"), F.col("f.turn").alias("t"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")) & F.col("turn").eqNullSafe(F.col("t"))
    end = F.rtrim("text", F.lit(WHITE))
    done = rows.join(firsts, same, "left").withColumn("blank", end == "")
    return done.select("conv", "turn", "role", "text", "copies", "blank", (F.col("blank") | F.col("k").isNull()).alias("gone"), (~F.right(end, F.lit(1)).isin(*ENDS)).alias("cut"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", listed: DataFrame | None = None) -> Repaired:
    """The faults of each conversation, its cheapest edits and what they leave. ``listed``: ids, one column, to be listed even if they have no rows."""
    scratch = Scratch(df.sparkSession, "conversations")
    rows = scratch.written(marked(df, conv, turn, role, text), "rows", waves=8)
    per_turn = rows.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("gone"), F.col("copies")).otherwise(F.col("copies") - 1)).alias("duplicate"),
        F.count_if(~F.col("gone") & F.col("cut")).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    facts = per_turn.groupBy("conv").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])

    # No fewer files here: chunks are numbered by partition.
    chunks = scratch.written(chunked(rows.orderBy(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text")), "chunks")
    whole = chunks.where("alone").withColumn("way", F.col("ways")[0])
    choices = scratch.written(joined(chunks.where(~F.col("alone"))), "choices", waves=2)
    alone = whole.select("conv", "illegal", "way.cost", "way.audit")
    pieces = choices.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("at", "audit"))).alias("parts"))
    pieces = pieces.select("conv", "illegal", "cost", F.array_join("parts.audit", "").alias("audit"))
    found = facts.withColumnRenamed("conv", "c").join(alone.union(pieces), F.col("c").eqNullSafe(F.col("conv"))).drop("c")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    done = found.select("conv", *[F.col(c).cast("long").alias(c) for c in names], "audit")
    columns = ["conv", "at", "alone", "roles", "texts", "copies"]
    split = chunks.where(~F.col("alone")).select(*columns).join(choices.select("at", "entry", "audit"), "at").select(*columns, "entry", "audit")
    turns = edited(whole.select(*columns, F.lit("").alias("entry"), "way.audit").union(split))
    if listed is not None:
        ids = listed.toDF("id").select(F.col("id").cast("long")).distinct()
        missing = ids.join(done.select("conv"), F.col("id").eqNullSafe(F.col("conv")), "left_anti")
        done = done.union(missing.select("id", *[F.lit(0).cast("long") for _ in names], F.lit("")))
        empty = F.array().cast("array<string>")
        turns = turns.union(missing.select("id", F.lit(-1).cast("long"), F.lit(True), empty, empty))
    return Repaired(done, turns)
