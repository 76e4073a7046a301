"""Repair of conversations whose rows are blank, repeated, cut off or out of turn.

A repaired conversation is an optional system row followed by pairs of user and assistant.
The cheapest edits are found by a Viterbi pass over the rows with four states: nothing
kept yet (0), after system (1), after user (2), after assistant (3). Of equally cheap edits
the one whose initials are least in ASCII order is meant.

Survivors, the best way into each state, are leaves of a tree of back pointers. A node
counts its children and goes when no survivor descends from it; once all survivors descend
from one child of the root, that child's edit is final: it is emitted and the root moves
on. What is held is the unresolved part only. Survivors that another state undercuts by
more than any continuation could make up for are dropped, so that they do not hold up the
others. Ties are decided by the complete unresolved suffixes: edits of a row never are the
beginning of one another, so the order of two suffixes is that of the survivors they
extend, then that of the new edits, and each survivor carries its rank in that order.

A conversation may be any share of the table, so rows are ordered by range, not grouped:
a task streams the rows of its range. Conversations that begin and end inside are settled
there. The first and the last one of a range may go on elsewhere; for these the pass is
made from every state, with one set of survivors for each, and afterwards the blocks of a
conversation are chained by their costs and ranks, one row of numbers for each block.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tilewright.functions.columns import quoted

from .common import store

BLANKS = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
STATES = range(4)

# What a rerole or an insert leads to, and what a kept initial leads to.
NEXT = (2, 2, 3, 2)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

# Inserts that complete a conversation from each state.
TAILS = ("", "II", "I", "")

# BEHIND[r][t]: at most so much more does any continuation cost from r than from t. From 3 a
# system row that 0 keeps is deleted; from 2 an insert leads to 3; a missing pair costs two.
BEHIND = ((0, 0, 3, 0), (10, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))

ORDER = ("conv_id", "turn", "role", "_start", "_digest")


# One conversation


@lru_cache(maxsize=None)
def moves(initial: str, forced: bool, cut_off: bool) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """For each state, from where, for how much and by which edits one row leads into it."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for origin in STATES:
        state, cost, edits = origin, 0, ""
        for _ in range(3):  # no, one or two inserts before the row's own edit
            ways = [(state, cost + DELETE, edits + "D")]
            if not forced:
                extra = cost + (CUT_OFF if cut_off else 0)
                ways.append((NEXT[state], extra + REROLE, edits + "R"))
                if (state, initial) in KEPT:
                    ways.append((KEPT[state, initial], extra, edits + "K"))
            for target, total, way in ways:
                best[origin, target] = min(best.get((origin, target), (total, way)), (total, way))
            state, cost, edits = NEXT[state], cost + INSERT, edits + "I"
    return tuple(tuple((o, c, e) for (o, t), (c, e) in best.items() if t == target) for target in STATES)


def rows_made(state: int, edits: str) -> str:
    """What edits make from a state on: u and a are inserted rows, ``=`` is the row as it is, U
    and A is the row with another role."""
    made = ""
    for edit in edits.lstrip("D"):
        if edit == "D":
            continue
        if edit == "K":
            made += "="
        else:
            made += ("a" if state == 2 else "u") if edit == "I" else ("A" if state == 2 else "U")
            state = NEXT[state]
    return made


@lru_cache(maxsize=4096)
def _way(state: int, edits: str) -> str:
    return f"{edits}:{rows_made(state, edits)}"


class Node:
    __slots__ = ("children", "edits", "parent", "state")

    def __init__(self, parent: Node | None, state: int, edits: str):
        self.parent, self.state, self.edits = parent, state, edits
        self.children: list[Node] = []


class Survivors:
    """The best ways from one state over the rows so far, as leaves of one tree."""

    def __init__(self, start: int):
        self.root = Node(None, start, "")
        # state: (cost, rank among the survivors, leaf)
        self.leaves: dict[int, tuple[int, int, Node]] = {start: (0, 0, self.root)}

    def step(self, initial: str, forced: int, cut_off: bool) -> list[str]:
        """Go on by one row, or by ``forced`` rows that must be deleted; returns what became final.

        Inserts sort behind deletions, so among several forced rows they stand before the last.
        """
        found = {}
        for target, ways in enumerate(moves(initial, forced > 0, cut_off)):
            options = [
                (self.leaves[origin][0] + cost, self.leaves[origin][1], edits, origin)
                for origin, cost, edits in ways
                if origin in self.leaves
            ]
            if options:
                found[target] = min(options)
        live = [
            t for t, way in found.items() if all(way[0] <= other[0] + BEHIND[r][t] for r, other in found.items())
        ]
        ranks = {t: i for i, t in enumerate(sorted(live, key=lambda t: found[t][1:3]))}
        deleted = "D" * (forced - 1)
        old, leaves = self.leaves, {}
        for t in live:
            cost, _, edits, origin = found[t]
            node = Node(old[origin][2], origin, deleted + edits)
            node.parent.children.append(node)
            leaves[t] = (cost + DELETE * len(deleted), ranks[t], node)
        self.leaves = leaves
        for _, _, node in old.values():
            while not node.children and node.parent:
                node.parent.children.remove(node)
                node = node.parent
        return self._settled()

    def _settled(self) -> list[str]:
        final = []
        # The newest row stays open: if the conversation ends with it, inserts may follow.
        while len(self.root.children) == 1 and self.root.children[0].children:
            self.root = self.root.children[0]
            self.root.parent = None
            final.append(_way(self.root.state, self.root.edits))
        return final

    def open_rows(self, state: int) -> list[str]:
        """The edits that are not final yet, along the way into ``state``."""
        node, ways = self.leaves[state][2], []
        while node.parent:
            ways.append(_way(node.state, node.edits))
            node = node.parent
        return ways[::-1]

    def best_end(self) -> int:
        return min(self.leaves, key=lambda t: (self.leaves[t][0] + INSERT * len(TAILS[t]), self.leaves[t][1]))


def _with_tail(way: str, end: int) -> str:
    edits, made = way.split(":")
    return f"{edits}{TAILS[end]}:{made}{rows_made(end, TAILS[end])}"


class Fragment:
    """The rows of one conversation in one range. ``ready`` holds, for every row that is settled, one
    way, or one for each start, or one for each start and end."""

    def __init__(self, open_start: bool):
        self.open_start = open_start
        self.starts = [Survivors(s) for s in (STATES if open_start else (0,))]
        self.final = [deque() for _ in self.starts]
        self.ready: list[list[str | None]] = []

    def step(self, initial: str, forced: int, cut_off: bool) -> None:
        for start, final in zip(self.starts, self.final):
            final.extend(start.step(initial, forced, cut_off))
        while all(self.final):
            self.ready.append([final.popleft() for final in self.final])

    def close(self) -> None:
        """Choose the end, for a conversation that begins and ends here."""
        end = self.starts[0].best_end()
        rest = self.starts[0].open_rows(end)
        self.ready += [[w] for w in rest]
        self.ready[-1] = [_with_tail(self.ready[-1][0], end)]

    def leave_open(self) -> tuple[list[int | None], list[int | None]]:
        """Costs and ranks for each start and end, for a conversation that may go on elsewhere."""
        costs: list[int | None] = [None] * 16
        ranks: list[int | None] = [None] * 16
        columns: dict[int, list[str]] = {}
        for s, (start, final) in enumerate(zip(self.starts, self.final)):
            for t, (cost, rank, _) in start.leaves.items():
                costs[4 * s + t], ranks[4 * s + t] = cost, rank
                columns[4 * s + t] = [*final, *start.open_rows(t)]
        for i in range(len(next(iter(columns.values())))):
            self.ready.append([columns[c][i] if c in columns else None for c in range(16)])
        return costs, ranks


# Ranges of rows

INPUT = ["conv_id", "initial", "copies", "fault"]
ADDED = [
    pa.field("block", pa.int32()),
    pa.field("place", pa.int64()),
    pa.field("illegal", pa.int64()),
    pa.field("ways", pa.list_(pa.string())),
    pa.field("costs", pa.list_(pa.int64())),
    pa.field("ranks", pa.list_(pa.int64())),
    pa.field("first_initial", pa.string()),
]


def _edit_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range in order, each with its ways. Rows are held until they are settled."""
    block, place = TaskContext.get().partitionId(), 0
    held: deque[pa.RecordBatch] = deque()  # rows not given out yet
    notes: deque[list] = deque()  # what is added to them
    waiting: deque[list] = deque()  # the notes of those that are not settled
    fragment, conv, last_initial, settled = None, None, "", 0

    def settle() -> None:
        nonlocal settled
        for way in fragment.ready:
            waiting.popleft()[3] = way
            settled += 1
        fragment.ready.clear()

    def leave(more_follow: bool) -> None:
        if fragment.open_start or not more_follow:
            notes[-1][4:6] = fragment.leave_open()
            settle()
        else:
            fragment.close()
            settle()

    def given(count: int) -> Iterator[pa.RecordBatch]:
        nonlocal settled
        settled -= count
        while count:
            batch = held.popleft()
            part = batch.slice(0, min(count, batch.num_rows))
            if part.num_rows < batch.num_rows:
                held.appendleft(batch.slice(part.num_rows))
            count -= part.num_rows
            columns = list(zip(*(notes.popleft() for _ in range(part.num_rows))))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, ADDED)]
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *(f.name for f in ADDED)])

    for whole in batches:
        for start in range(0, whole.num_rows, 1000):
            batch = whole.slice(start, 1000)
            held.append(batch)
            for key, initial, copies, fault in zip(*(batch.column(n).to_pylist() for n in INPUT)):
                illegal = copies - 1
                if fragment is None or key != conv:
                    if fragment:
                        leave(True)
                    fragment, conv, first = Fragment(open_start=fragment is None), key, initial
                elif last_initial + initial not in LEGAL:
                    illegal += 1
                notes.append([block, place, illegal, None, None, None, first])
                waiting.append(notes[-1])
                place, last_initial = place + 1, initial
                forced = copies if fault in ("blank", "duplicate") else 0
                fragment.step(initial if initial in ("s", "u", "a") else "", forced, fault == "truncated")
                settle()
            yield from given(settled)
    if fragment:
        leave(False)
        yield from given(settled)


CHOICE = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int32()), ("path", pa.int32()), ("tail", pa.string()), ("illegal", pa.int64())]
)


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """The cheapest chain of starts and ends over the blocks of one conversation."""
    blocks = blocks.sort_values("block")
    leaves: dict[int, tuple[int, int]] = {0: (0, 0)}
    back: list[dict[int, int]] = []
    for costs, ranks in zip(blocks.costs, blocks.ranks):
        found = {}
        for s, (cost, rank) in leaves.items():
            for t in STATES:
                if not pd.isna(costs[4 * s + t]):
                    way = (cost + int(costs[4 * s + t]), rank, int(ranks[4 * s + t]), s)
                    found[t] = min(found.get(t, way), way)
        order = {t: i for i, t in enumerate(sorted(found, key=lambda t: found[t][1:3]))}
        leaves = {t: (way[0], order[t]) for t, way in found.items()}
        back.append({t: way[3] for t, way in found.items()})
    end = last = min(leaves, key=lambda t: (leaves[t][0] + INSERT * len(TAILS[t]), leaves[t][1]))
    paths = []
    for origins in reversed(back):
        paths.append(4 * origins[end] + end)
        end = origins[end]
    tails = [":"] * (len(blocks) - 1) + [_with_tail(":", last)]
    pairs = zip([None, *blocks.last_initial[:-1]], blocks.first_initial)
    illegal = [int(a is not None and a + b not in LEGAL) for a, b in pairs]
    return pd.DataFrame(
        {"conv_id": blocks.conv_id, "block": blocks.block, "path": paths[::-1], "tail": tails, "illegal": illegal}
    )


def repair_conversations(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    blocks: int | None = None,
) -> DataFrame:
    """One row per row of ``df`` with what becomes of it, in a block and place that give the order.

    Columns: conv_id, block, place, turn, role, text, copies, fault (blank, duplicate,
    truncated or null), illegal (pairs with the row before, and among copies, whose roles may
    not follow each other), edits (initials, with those of rows inserted before it and, for a
    conversation's last row, after it), cost, repaired (roles and texts of the rows that take its place).

    Rows lie by turn, null turns first; rows of one turn by role, the text's first 200
    characters and its SHA-256. Rows that agree in all four columns come as at most two: the
    first one, and one that stands for all ``copies`` of it. Null roles and texts are one
    blank; a null id is a conversation of its own. An empty table gives an empty result. Only
    the four named columns are read, so others may have any name. ``blocks`` is the number of
    ranges, which only the cost depends on.
    """
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(" "))
    rows = (
        df.select(
            F.col(quoted(conv_col)).cast("long").alias("conv_id"),
            F.col(quoted(turn_col)).cast("long").alias("turn"),
            F.coalesce(F.col(quoted(role_col)).cast("string"), F.lit(" ")).alias("role"),
            text.alias("text"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("_digest", F.unhex(F.sha2("text", 256)))
    )
    # Texts that a role repeats in several turns, and the first of these turns.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (
        rows.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("_digest").alias("_same"))
        .agg(F.min(turn).alias("_first"), F.count(F.lit(1)).alias("_turns"))
        .where("_turns > 1")
        .drop("_turns")
    )
    seen = (
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & (F.col("role") == F.col("_role"))
        & (F.col("_digest") == F.col("_same"))
    )
    whole = F.rtrim("text", F.lit(BLANKS))
    later = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(turn)
    first_fault = (
        F.when(whole == "", "blank")
        .when(later, "duplicate")
        .when(~F.right(whole, F.lit(1)).isin(".", "!", "?"), "truncated")
    )
    copy_fault = F.when(whole == "", "blank").otherwise("duplicate")
    parts = F.array(
        F.struct(F.lit(0).alias("_copy"), F.lit(1).cast("long").alias("copies"), first_fault.alias("fault")),
        F.struct(F.lit(1).alias("_copy"), (F.col("rows") - 1).alias("copies"), copy_fault.alias("fault")),
    )
    ordered = [*ORDER, "_copy"]
    listed = (
        rows.join(again, seen, "left")
        .select(
            "conv_id", "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"),
            F.left("text", F.lit(200)).alias("_start"), "_digest", "rows", F.inline(parts),
        )
        .where("copies > 0")
        .drop("rows")
    )
    ranged = listed.repartitionByRange(*([blocks] if blocks else []), *ORDER).sortWithinPartitions(*ordered)
    ranged = ranged.drop("_start", "_digest", "_copy")
    edited = store(
        ranged.mapInArrow(
            _edit_range, from_arrow_schema(pa.schema([*to_arrow_schema(ranged.schema), *ADDED]))
        ),
        "conversation-ways",
    )
    # The blocks of conversations that may be in several: one row of costs for each.
    ends = edited.where("costs IS NOT NULL").select(
        "conv_id", "block", "costs", "ranks", "first_initial", F.col("initial").alias("last_initial")
    )
    chosen = ends.groupBy("conv_id").applyInPandas(_chain, from_arrow_schema(CHOICE))
    # Written first, so that its size is known when it is joined.
    chosen = store(chosen.select([F.col(c).alias(f"_{c}") for c in chosen.columns]), "conversation-chains")
    chain = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("block") == F.col("_block"))
    way = F.split(_chosen_way(), ":")
    tail = F.split(F.when(F.col("costs").isNotNull(), F.coalesce("_tail", F.lit(":"))).otherwise(":"), ":")
    between = F.when(F.col("_starts"), F.coalesce("_illegal", F.lit(0))).otherwise(0)
    joined = (
        edited.withColumn("_starts", F.col("place") == F.lit(0))
        .join(chosen, chain, "left")
        .withColumn("edits", F.concat(way[0], tail[0]))
        .withColumn("_made", F.concat(way[1], tail[1]))
    )
    return joined.select(
        "conv_id", "block", "place", "turn", "role", "text", "copies", "fault",
        (F.col("illegal") + between).alias("illegal"), "edits", _cost().alias("cost"), _repaired().alias("repaired"),
    )


def _chosen_way() -> Column:
    """A settled row has one way, one for each start, or one for each start and end."""
    start = F.call_function("div", F.col("_path"), F.lit(4)).cast("int")
    at = F.when(F.size("ways") == 1, 0).when(F.size("ways") == 4, start).otherwise(F.col("_path"))
    return F.get("ways", at)


def _cost() -> Column:
    edits = F.col("edits")
    count = {e: F.length(edits) - F.length(F.replace(edits, F.lit(e))) for e in "DRI"}
    stays = edits.rlike("[KR]") & F.col("fault").eqNullSafe("truncated")
    paid = count["D"] * DELETE + count["R"] * REROLE + count["I"] * INSERT
    return (paid + F.when(stays, CUT_OFF).otherwise(0)).cast("long")


def _repaired() -> Column:
    def row(made: Column) -> Column:
        kept = made.isin("=", "U", "A")
        role = F.when(made == "=", F.col("role")).when(F.lower(made) == "u", "user").otherwise("assistant")
        return F.struct(role.alias("role"), F.when(kept, F.col("text")).otherwise("").alias("text"))

    letters = F.when(F.col("_made") == "", F.array().cast("array<string>")).otherwise(F.split("_made", ""))
    return F.transform(F.filter(letters, lambda c: c != ""), row)


# Damage and digest


def damage(df: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with faults that a checksum of id and turn chooses: 0 of 20 drops
    a row, 1 empties its text, 2 takes the stops out, 3 repeats it and 4 makes it the user's.

    Nulls are one blank, in the checksum too, but for null ids and turns themselves.
    """
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    key = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    fault = F.crc32(key) % 20
    return (
        df.select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"), fault.alias("_f"))
        .where("_f <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_f") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("_f") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_f"),
        )
        .drop("_f")
    )


DIGEST = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def conversation_digests(df: DataFrame, originals: DataFrame, blocks: int | None = None) -> DataFrame:
    """Faults, costs, edits and a checksum of every conversation of ``originals`` after repair of ``df``.

    One row per id, null included; an id without rows in ``df`` has zeros, no edits and the
    checksum of the empty text. The checksum runs over the rows in order, so the repaired
    texts of a conversation pass through one task, block by block and never all at once.
    """
    repaired = repair_conversations(df, blocks=blocks)
    line = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    faults = [
        F.sum(F.when(F.col("fault") == name, F.col("copies")).otherwise(0)).alias(name)
        for name in ("blank", "duplicate", "truncated")
    ]
    piece = F.struct("place", "edits", F.when(F.size(line) > 0, F.array_join(line, "\n")).alias("lines"))
    pieces = F.sort_array(F.collect_list(piece))
    parts = repaired.groupBy("conv_id", "block").agg(
        *faults, F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), pieces.alias("pieces")
    )
    parts = store(
        parts.select(
            "conv_id", "block", "blank", "duplicate", "truncated", "illegal", "cost",
            F.array_join("pieces.edits", "").alias("edits"),
            F.size(F.array_compact("pieces.lines")).alias("n_lines"),
            F.array_join("pieces.lines", "\n").alias("lines"),
        ),
        "conversation-blocks",
    )
    sums = parts.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    )
    digests = (
        parts.select("conv_id", "block", "edits", "n_lines", "lines")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block")
        .mapInArrow(_digest_blocks, from_arrow_schema(DIGEST))
    )
    turns = df.select(F.col("conv_id").cast("long"), F.col("turn").cast("decimal(20,0)")).where("turn IS NOT NULL")
    turns = turns.distinct().groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps")
    )
    # One row per id from each part, brought together without joins on ids that may be null.
    ids = originals.select(F.col("conv_id").cast("long")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    merged = ids
    for part in (turns, sums, digests):
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _digest_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, edits, sha, begun, any_rows = None, [], None, False, False
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, DIGEST)], schema=DIGEST)

    for batch in batches:
        keys, audits, counts = (batch.column(n).to_pylist() for n in ("conv_id", "edits", "n_lines"))
        for key, audit, count, lines in zip(keys, audits, counts, batch.column("lines")):
            if not any_rows or key != conv:
                if any_rows:
                    done.append((conv, "".join(edits), sha.hexdigest()))
                conv, edits, sha, begun, any_rows = key, [], hashlib.sha256(), False, True
            edits.append(audit)
            if count:
                sha.update(b"\n" if begun else b"")
                sha.update(lines.as_py().encode())
                begun = True
        if done:
            yield out()
    if any_rows:
        done.append((conv, "".join(edits), sha.hexdigest()))
        yield out()
