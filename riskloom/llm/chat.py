"""Chat formatting: role repair at least cost, then rendering.

Legal turns follow an automaton: an optional system turn, then user and assistant in turn, the
assistant last. A turn may be kept where its role is legal, merged into the turn before, given a
legal role, or have one empty turn inserted before it; a conversation that ends early gets the
empty turns it lacks. Each of these costs a fixed amount, so what a turn can do is a 4 x 4 table of
costs between states, and a stretch of turns is the (min, +) product of its turns' tables.

That product is associative, so a conversation of any length is never in one task: turns are cut
into blocks by their place in the conversation, blocks into blocks of blocks. Costs are multiplied upwards until a
conversation has one block; then the cheapest path's states are handed down, block by block, to the
turns. Conversations within one block need the last step only; the texts of longer ones are sorted
first, as turns with equal numbers follow by text.

Defined results: role names are compared without case and outer white space; any other role, or
none, must be given a role or merged; a null text renders as empty; a null turn number comes last,
a null ``conv_id`` is a conversation of its own; turns with equal numbers follow by role and text
(any number of them, in as many blocks as it takes); of several cheapest repairs one is chosen by a fixed order; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import numbered
from riskloom.session import stage

BLOCK_BITS = 9
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 1.0, 3.0, 2.0
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"


def _moves(kind: int) -> dict[tuple[int, int], tuple[float, str, tuple[int, ...]]]:
    """For a turn of role ``kind`` (0: another): (from, to) -> cost, action, inserted roles."""
    best: dict[tuple[int, int], tuple[float, str, tuple[int, ...]]] = {}

    def offer(a: int, b: int, cost: float, action: str, inserted: tuple[int, ...] = ()) -> None:
        if (a, b) not in best or cost < best[a, b][0]:
            best[a, b] = (cost, action, inserted)

    for a in LEGAL:
        if a != START:
            offer(a, a, MERGE + (RELABEL if kind != a else 0), "merge")
        for b in LEGAL[a]:
            offer(a, b, 0 if b == kind else RELABEL, "keep" if b == kind else "relabel")
            for c in LEGAL[b]:
                offer(a, c, INSERT + (0 if c == kind else RELABEL), "keep" if c == kind else "relabel", (b,))
    return best


MOVES = [_moves(k) for k in range(4)]
COSTS = np.full((4, 4, 4), np.inf)
for _kind, (_a, _b) in ((k, ab) for k in range(4) for ab in MOVES[k]):
    COSTS[_kind, _a, _b] = MOVES[_kind][_a, _b][0]
# What must follow the last turn, by the state it leaves.
MISSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
FINAL = np.array([INSERT * len(MISSING[s]) for s in range(4)])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def cheapest(tables: list[np.ndarray], entry: int, leave: int | None) -> list[int]:
    """The states of a cheapest path through the tables, ``entry`` first; ``leave`` is the last
    state, or None for whatever ends a conversation cheapest."""
    cost = np.full(4, np.inf)
    cost[entry] = 0.0
    steps = []
    for table in tables:
        through = cost[:, None] + table
        steps.append(through.argmin(axis=0))
        cost = through.min(axis=0)
    state = int((cost + FINAL).argmin()) if leave is None else leave
    path = [state]
    for back in reversed(steps):
        path.append(int(back[path[-1]]))
    return path[::-1]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal leading columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if rows and row[:keys] != key:
                yield key, rows
                rows = []
            key = row[:keys]
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _kind(role: Column) -> Column:
    name, kind = F.lower(F.trim(role)), F.lit(0)
    for i in (SYSTEM, USER, ASSISTANT):
        kind = F.when(name == ROLES[i], i).otherwise(kind)
    return kind


def _above(block: str) -> Column:
    return F.shiftrightunsigned(block, BLOCK_BITS).alias("above")


def _products(rows: DataFrame) -> DataFrame:
    """Rows ``conv_id, above, at, cost`` to ``conv_id, at, cost``: the tables of a block, multiplied."""

    def made(key: tuple, table: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
             pa.array([table.ravel()], pa.list_(pa.float64()))], names=["conv_id", "at", "cost"])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, table = None, None
        for batch in batches:
            for conv, block, _, cost in zip(*[c.to_pylist() for c in batch.columns]):
                own = np.array(cost).reshape(4, 4)
                if table is not None and (conv, block) == key:
                    table = _times(table, own)
                    continue
                if table is not None:
                    yield made(key, table)
                key, table = (conv, block), own
        if table is not None:
            yield made(key, table)

    dealt = rows.select("conv_id", "above", "at", "cost").repartition("conv_id", "above")
    ordered = dealt.sortWithinPartitions("conv_id", "above", "at")
    return ordered.mapInArrow(convert, "conv_id long, at long, cost array<double>")


def _handed_down(parents: DataFrame, children: DataFrame) -> DataFrame:
    """From parents ``conv_id, at, entry, leave, last`` the same of the blocks within."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, _), group in _groups(batches, 2):
            entry, leave, last = group[0][2:]
            path = cheapest([np.array(g[1]).reshape(4, 4) for g in group], entry, leave)
            n = len(group)
            yield pa.RecordBatch.from_arrays([
                pa.array([conv] * n, pa.int64()), pa.array([g[0] for g in group], pa.int64()),
                pa.array(path[:-1], pa.int32()), pa.array(path[1:], pa.int32()),
                pa.array([False] * (n - 1) + [last])], names=["conv_id", "at", "entry", "leave", "last"])

    p = parents.select(F.col("conv_id").alias("p_conv"), F.col("at").alias("p_at"), "entry", "leave", "last")
    within = children.join(p, F.col("conv_id").eqNullSafe(F.col("p_conv")) & (F.col("above") == F.col("p_at")))
    dealt = within.select("conv_id", "above", "at", "cost", "entry", "leave", "last").repartition("conv_id", "above")
    return dealt.sortWithinPartitions("conv_id", "above", "at").mapInArrow(
        convert, "conv_id long, at long, entry int, leave int, last boolean")


def _same(turns: DataFrame, conv: str) -> Column:
    return turns["conv_id"].eqNullSafe(F.col(conv))


def in_blocks(turns: DataFrame, block_bits: int) -> tuple[DataFrame, DataFrame | None]:
    """The turns with ``above``, their block, and ``at``, their order in it; and those of the
    conversations with several blocks alone, or None.

    No block has more than 2^block_bits rows: those of a longer conversation are cut by the row's
    place in it, which a range sort over all such rows gives.
    """
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    several = stage(counts.filter(F.col("n") > 1 << block_bits).select(F.col("conv_id").alias("long_conv")))
    whole = lambda rows: rows.withColumns({"at": F.col("number"), "above": F.lit(0).cast("long")})
    if several.isEmpty():
        return whole(turns), None
    long_ones = turns.join(several, _same(turns, "long_conv"), "left_semi").withColumn("_tie", F.monotonically_increasing_id())
    placed = stage(numbered(long_ones, *map(F.col, ("conv_id", "number", "role", "text", "_tie"))).drop("_tie"))
    first = stage(placed.groupBy(F.col("conv_id").alias("long_conv")).agg(F.min("place").alias("low")))
    at = F.col("place") - F.col("low")
    cut = placed.join(first, _same(placed, "long_conv")).withColumns(
        {"at": at, "above": F.shiftrightunsigned(at, block_bits)}).drop("place", "low", "long_conv")
    rest = turns.join(several, _same(turns, "long_conv"), "left_anti")
    return whole(rest).unionByName(cut), cut


def _block_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, at, entry, leave, last`` per block of conversations with several."""
    tables = F.array(*[F.array(*[F.lit(float(c)) for c in COSTS[k].ravel()]) for k in range(4)])
    base = turns.select("conv_id", "above", "at", F.get(tables, "kind").alias("cost"))
    levels = [stage(_products(base).withColumn("above", _above("at")))]
    while not levels[-1].groupBy("conv_id").count().filter("count > 1").isEmpty():
        levels.append(stage(_products(levels[-1]).withColumn("above", _above("at"))))
    ends = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.struct(
        (F.get("cost", s) + F.get(F.array(*map(F.lit, FINAL.tolist())), s)).alias("c"), s.alias("s")))
    paths = levels[-1].select(
        "conv_id", "at", F.lit(START).alias("entry"), F.array_min(ends)["s"].alias("leave"), F.lit(True).alias("last"))
    for level in reversed(levels[:-1]):
        paths = stage(_handed_down(paths, level))
    return paths


def repair(conversations: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per turn: ``conv_id, turn, role, new_role, action, inserted, cost, rendered``.

    ``inserted`` lists the empty turns before this one (after it, for what ends a conversation, is
    in ``appended``). The ``rendered`` pieces of a conversation, joined in order, are its text.
    """
    number = F.coalesce(F.col("turn").cast("long"), F.lit(2**63 - 1))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
        F.coalesce("text", F.lit("")).alias("text"), number.alias("number"), _kind(F.col("role")).alias("kind"))
    turns, long_ones = in_blocks(turns, block_bits)
    if long_ones is None:
        known = turns.withColumns({"entry": F.lit(START), "leave": F.lit(None).cast("int"), "last": F.lit(True)})
    else:
        p = _block_paths(long_ones).select(F.col("conv_id").alias("p_conv"), F.col("at").alias("p_at"), "entry", "leave", "last")
        joined = turns.join(p, F.col("conv_id").eqNullSafe(F.col("p_conv")) & (F.col("above") == F.col("p_at")), "left")
        known = joined.withColumns({"entry": F.coalesce("entry", F.lit(START)), "last": F.coalesce("last", F.lit(True))})

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {n: [] for n in ("conv_id", "turn", "role", "new_role", "action", "inserted", "appended", "cost", "rendered")}
        held = 0
        for (conv, _), group in _groups(batches, 2):
            entry, leave, last = group[0][4:]
            path = cheapest([COSTS[g[2]] for g in group], entry, leave)
            for i, (turn, role, kind, text, *_) in enumerate(group):
                before, after = path[i], path[i + 1]
                cost, action, inserted = MOVES[kind][before, after]
                appended = MISSING[after] if last and i == len(group) - 1 else ()
                shown = _piece(before, after, action, inserted, text, last and i == len(group) - 1, appended)
                for name, value in zip(out, (
                        conv, turn, role, ROLES[after], action, [ROLES[r] for r in inserted],
                        [ROLES[r] for r in appended], cost + INSERT * len(appended), shown)):
                    out[name].append(value)
                held += len(shown)
            if held > 4_000_000 or len(out["turn"]) > 10_000:
                yield _batch(out)
                out, held = {n: [] for n in out}, 0
        if out["turn"]:
            yield _batch(out)

    rows = known.select("conv_id", "above", "turn", "role", "kind", "text", "entry", "leave", "last", "at")
    dealt = rows.repartition("conv_id", "above").sortWithinPartitions("conv_id", "above", "at", "role", "text").drop("at")
    return dealt.mapInArrow(convert, (
        "conv_id long, turn long, role string, new_role string, action string, inserted array<string>, "
        "appended array<string>, cost double, rendered string"))


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    words = pa.list_(pa.string())
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), words, words, pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds)], names=list(columns))


def _piece(before: int, after: int, action: str, inserted: tuple[int, ...], text: str, end: bool,
           appended: tuple[int, ...]) -> str:
    """A turn's part of the rendering: it closes the turn before unless merged into it, and only
    the last turn closes itself."""
    if action == "merge":
        shown = "\n" + text
    else:
        closed = CLOSE if before != START else ""
        empty = "".join(OPEN.format(ROLES[r]) + CLOSE for r in inserted)
        shown = closed + empty + OPEN.format(ROLES[after]) + text
    if end:
        shown += CLOSE + "".join(OPEN.format(ROLES[r]) + CLOSE for r in appended)
    return shown
