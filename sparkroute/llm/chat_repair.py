"""Chat formatting: repair of role sequences at the least cost, then rendering.

Legal dialogues are an optional system turn, then user and assistant in turn, beginning with
user and ending with assistant. Each turn is kept, relabelled or merged into the turn before it,
and empty turns may be inserted; a dynamic program over the states of the automaton finds the
cheapest repair. A step is a small min-plus matrix, and matrices multiply: long conversations are
cut in blocks of turns by position, each block gives its matrix, the matrices of a conversation's
blocks are multiplied in a tree to find the states between the blocks, and then every block is
repaired alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkroute.llm.common import python_workers, sent_to_all, write_once
from sparkroute.operators.ordering import POSITION_BITS

#: Turns of a block, and blocks of a block above.
BLOCK_TURNS = 256
FAN = 256
#: Ids of conversations of more than a block are sent to all up to here.
LONG_BYTES = 64 << 20
#: Bytes of turns that the driver samples for range bounds.
SAMPLE_BYTES = 64 << 20
_SAMPLE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("system", "user", "assistant")
STATE_OF = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
MERGE, RELABEL, INSERT, UNKNOWN = 1, 3, 2, 1
FAR = 1 << 40
#: Legal next states without insertion.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _routes() -> dict[tuple[int, int], tuple[int, ...]]:
    """For each pair of states the shortest run of inserted states between them."""
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    for start in range(4):
        edge = [(start, ())]
        seen = set()
        while edge:
            after = []
            for state, way in edge:
                for to in LEGAL[state]:
                    if (start, to) not in found:
                        found[start, to] = way
                    if to not in seen:
                        seen.add(to)
                        after.append((to, (*way, to)))
            edge = after
    return found


ROUTES = _routes()


def options(state: int, role: str | None) -> list[tuple[int, int, tuple[int, ...], str]]:
    """(cost, next state, inserted states, action) for a turn of ``role`` after ``state``."""
    own = STATE_OF.get(role)
    found = []
    if state != START:
        same = own == state
        found.append((MERGE if same else MERGE + (UNKNOWN if own is None else RELABEL), state, (), "merge"))
    for to in (SYSTEM, USER, ASSISTANT):
        if (state, to) in ROUTES:
            way = ROUTES[state, to]
            cost = len(way) * INSERT + (0 if own == to else UNKNOWN if own is None else RELABEL)
            found.append((cost, to, way, "keep" if own == to else "relabel"))
    return sorted(found, key=lambda o: (o[0], o[3] != "keep", o[1]))


_OPTIONS = {(s, r): options(s, r) for s in range(4) for r in (*ROLES, None)}


def _role(role) -> str | None:
    name = role.strip().lower() if isinstance(role, str) else None
    return name if name in STATE_OF else None


def matrix(roles: list) -> np.ndarray:
    """Least cost from each state before the turns to each state after them."""
    out = np.full((4, 4), FAR, np.int64)
    for start in range(4):
        cost = {start: 0}
        for role in roles:
            after: dict[int, int] = {}
            for state, c in cost.items():
                for step, to, _, _ in _OPTIONS[state, _role(role)]:
                    after[to] = min(after.get(to, FAR), c + step)
            cost = after
        for state, c in cost.items():
            out[start, state] = c
    return out


def end_cost(state: int) -> int:
    """Cost of ending after ``state``: the dialogue must end with the assistant."""
    return 0 if state == ASSISTANT else (len(ROUTES[state, ASSISTANT]) + 1) * INSERT


def repaired_block(roles: list, texts: list, start: int, end: int) -> list[tuple[str, str | None, str, int]]:
    """(role, text, action, place of the source turn or -1) of the cheapest repair between two states.

    A merge into the block before comes out as an action "merge" at the front.
    """
    costs, ways = [{start: 0}], []
    for role in roles:
        after, way = {}, {}
        for state in sorted(costs[-1]):
            for step, to, inserted, action in _OPTIONS[state, _role(role)]:
                total = costs[-1][state] + step
                if total < after.get(to, FAR):
                    after[to], way[to] = total, (state, inserted, action)
        costs.append(after)
        ways.append(way)
    state, taken = end, []
    for i in range(len(roles) - 1, -1, -1):
        before, inserted, action = ways[i][state]
        taken.append((i, state, inserted, action))
        state = before
    out = []
    for i, state, inserted, action in reversed(taken):
        out += [(ROLES[s - 1], "", "insert", -1) for s in inserted]
        out.append((ROLES[state - 1], texts[i], action, i))
    return out


def repaired(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """Per repaired turn: ``id_col``, block, place, role, text, edits and rendered.

    A block is 256 neighbouring turns of a conversation, by position whatever their numbers.
    ``place`` orders the turns of a block and (block, place) those of a conversation. A merged
    turn's text follows a newline; if the turn it joins stands in the block before, it keeps a
    row of its own with the edit "merge", and joining the rendered rows in order still gives the
    legal dialogue. ``rendered`` is the ChatML form: joined over the rows it is the dialogue.

    Defined results: unknown and null roles may be given any role for a small cost; null texts
    are empty; turns of equal number stand in order of role and text, null turns first; repeated
    rows are turns of their own; rows of a null id are one conversation; other columns are not
    read; an empty table gives no rows.
    """
    python_workers(rows.sparkSession)
    turns = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.col(f"`{role_col}`").alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = write_once(sizes.where(F.col("n") > BLOCK_TURNS), "long")
    total = long.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    if not total["n"]:
        return _short(turns).withColumnRenamed("conv", id_col)
    of_long = sent_to_all(long.select(F.col("conv").alias("of")), row_bytes=16, limit=LONG_BYTES)
    in_long = F.col("conv").eqNullSafe(F.col("of"))
    made = _short(turns.join(of_long, in_long, "left_anti")).unionByName(
        _long(turns.join(of_long, in_long, "left_semi"), total["bytes"] // total["n"]))
    return made.withColumnRenamed("conv", id_col)


def _in_order() -> Column:
    return F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")


def _short(turns: DataFrame) -> DataFrame:
    """The repaired turns of conversations of one block."""

    def repair(batches):
        for batch in filter(len, batches):
            made = []
            for conv, turns_in in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                costs = matrix([t["role"] for t in turns_in]).ravel().tolist()
                for block, start, end, last in _between([{"block": 0, "costs": costs}], START, None, True):
                    made += [(conv, block, *row) for row in _rendered(turns_in, start, end, last)]
            yield _batch(made, _TURNS)

    return turns.groupBy("conv").agg(_in_order()).mapInArrow(repair, _TURNS_DDL)


def _placed(turns: DataFrame, text_bytes: int) -> DataFrame:
    """``turns`` with ``block``, by the place in the conversation, which may lie in many partitions.

    Rows are range-placed, equal ones too (``salt``), and written once; a place is the one in the
    partition plus the rows of the conversation in earlier partitions.
    """
    spark = turns.sparkSession
    order = ["conv", "turn", "role", "text", "salt"]
    turns = write_once(turns.withColumn("salt", F.monotonically_increasing_id()), "turns")
    at = F.monotonically_increasing_id()
    # whole texts are sampled as bounds, three times as many as asked for
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = int(spark.conf.get(_SAMPLE))
    spark.conf.set(_SAMPLE, str(max(1, min(asked, SAMPLE_BYTES // (3 * parts * (text_bytes + 64))))))
    try:
        placed = write_once(turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), "placed")
    finally:
        spark.conf.set(_SAMPLE, str(asked))
    placed = placed.withColumn("part", F.shiftright("at", POSITION_BITS))
    runs = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv").alias("of"), F.col("part").alias("in"), (
        F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("less"))
    runs = sent_to_all(write_once(runs, "runs"), row_bytes=24)
    met = placed.join(runs, F.col("conv").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return met.select("conv", F.floor((F.col("at") + F.col("less")) / BLOCK_TURNS).alias("block"), "turn", "role", "text")


def _groups(level: DataFrame) -> DataFrame:
    """(conv, block, steps): ``FAN`` neighbouring matrices of a conversation in order."""
    return level.groupBy("conv", F.floor(F.col("block") / FAN).alias("over")).agg(
        F.sort_array(F.collect_list(F.struct("block", "costs"))).alias("steps")).withColumnRenamed("over", "block")


def _long(turns: DataFrame, text_bytes: int) -> DataFrame:
    """The repaired turns of conversations of more than one block.

    The matrices of ``FAN`` blocks multiply to the matrix of a block above them, and so on up to
    at most ``FAN`` blocks per conversation; the states between blocks are found from there down.
    """
    blocks = write_once(_placed(turns, text_bytes).groupBy("conv", "block").agg(_in_order()), "blocks")

    def costs(batches):
        for batch in batches:
            made = [matrix(roles).ravel().tolist() for roles in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], _COSTS)

    def above(batches):
        for batch in batches:
            made = [_product(steps).ravel().tolist() for steps in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.int64()))], _COSTS)

    def between(batches):
        for batch in filter(len, batches):
            made = []
            for conv, steps, start, end, last in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                made += [(conv, *way) for way in _between(steps, start, end, last)]
            yield _batch(made, _STATES)

    def repair(batches):
        for batch in filter(len, batches):
            made = []
            for conv, block, turns_in, start, end, last in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                made += [(conv, block, *row) for row in _rendered(turns_in, start, end, last)]
            yield _batch(made, _TURNS)

    roles = blocks.select("conv", "block", F.col("turns.role").alias("roles"))
    levels = [write_once(roles.mapInArrow(costs, _COSTS_DDL), "costs")]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) >= FAN:
        levels.append(write_once(_groups(levels[-1]).mapInArrow(above, _COSTS_DDL), "costs"))
    whole = _groups(levels.pop()).select(
        "conv", "steps", F.lit(START).alias("start"), F.lit(None).cast("int").alias("end"), F.lit(True).alias("last"))
    states = whole.mapInArrow(between, _STATES_DDL)
    for level in reversed(levels):
        inner = _groups(level).join(states, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
        states = inner.select("conv", "steps", "start", "end", "last").mapInArrow(between, _STATES_DDL)
    met = blocks.join(states, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    return met.select("conv", "block", "turns", "start", "end", "last").mapInArrow(repair, _TURNS_DDL)


_STATES = pa.schema([("of", pa.int64()), ("at", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("last", pa.bool_())])
_TURNS = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("role", pa.string()), ("text", pa.string()),
                    ("edits", pa.string()), ("rendered", pa.string())])
_COSTS = ["conv", "block", "costs"]
_COSTS_DDL = "conv long, block long, costs array<long>"
_STATES_DDL = "of long, at long, start int, end int, last boolean"
_TURNS_DDL = "conv long, block long, place int, role string, text string, edits string, rendered string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _product(steps: list[dict]) -> np.ndarray:
    """The matrix of neighbouring blocks together."""
    whole = np.array(steps[0]["costs"]).reshape(4, 4)
    for step in steps[1:]:
        whole = (whole[:, :, None] + np.array(step["costs"]).reshape(1, 4, 4)).min(1)
    return np.minimum(whole, FAR)


def _between(steps: list[dict], start: int, end: int | None, last: bool) -> list[tuple[int, int, int, bool]]:
    """(block, state before, state after, last) of each of the blocks at the least cost.

    ``last``: the blocks end their conversation. Without ``end`` they end where that costs least.
    """
    best, back = np.full(4, FAR), []
    best[start] = 0
    for step in steps:
        total = best[:, None] + np.array(step["costs"]).reshape(4, 4)
        back.append(total.argmin(0))
        best = total.min(0)
    if end is None:
        end = int(np.argmin(best + np.array([FAR, *[end_cost(s) for s in (SYSTEM, USER, ASSISTANT)]])))
    state, ways = end, []
    for step, before in zip(reversed(steps), reversed(back), strict=True):
        ways.append((step["block"], int(before[state]), state, last and step is steps[-1]))
        state = int(before[state])
    return ways


def _rendered(turns: list[dict], start: int, end: int, last: bool) -> list[tuple]:
    """(place, role, text, edits, rendered) of the repaired turns of a block."""
    out: list[list] = []
    for role, text, action, _ in repaired_block([t["role"] for t in turns], [t["text"] for t in turns], start, end):
        if action == "merge" and out:
            out[-1][1] += "\n" + text
            out[-1][2].append(action)
        else:
            out.append([role, text, [action]])
    if last and end != ASSISTANT:
        out += [[ROLES[s - 1], "", ["insert"]] for s in (*ROUTES[end, ASSISTANT], ASSISTANT)]
    rows = []
    for i, (role, text, edits) in enumerate(out):
        joined = i == 0 and edits[0] == "merge"
        head = "\n" if joined else ("" if i == 0 and start == START else "<|im_end|>\n") + f"<|im_start|>{role}\n"
        tail = "<|im_end|>\n" if last and i == len(out) - 1 else ""
        rows.append((i, role, text, ",".join(edits), head + text + tail))
    return rows
