"""Conversation structure repair: the cheapest edits that make the turns a legal dialogue.

A legal dialogue is an optional system turn, then user and assistant turns in pairs, or nothing. The
edit lattice has a node for each place between turns and state of that automaton. Keep costs nothing, a new role or an
inserted empty turn 3, a deletion 4, and a truncated turn that stays 3 more; blank turns and copies must go. Two
heaps search from both ends. When no path over the frontiers can be cheaper or as cheap as the best crossing, all crossings of that cost
are known, and the one whose edits spell the least text wins.

Each letter leads from a node to one other node, so the edits fix the repaired turns, and no
cheapest audit is the beginning of another one. Conversations of more than a block of turns are cut by
position: each block gives the cheapest costs between the states at its ends and the order of their audits, blocks
are combined in a tree, and each block is then searched alone between the states found.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkroute.llm.chat_repair import BLOCK_TURNS, FAN, LONG_BYTES, _placed
from sparkroute.llm.common import python_workers, sent_to_all, write_once

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: The state after a turn whose role has the initial, and the role that may be inserted or given.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
MADE = {s: NEXT[s][WANTED[s][0]] for s in STATES}
MAKERS = {t: [s for s in STATES if MADE[s] == t] for t in STATES}
LEGAL_PAIRS = {"su", "ua", "au"}
LEGAL_ENDS = [START, ASSISTANT]
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
SOUND, BLANK, DUPLICATE, TRUNCATED = "sbdt"
SPACE = " \t\n\v\f\r"
FAR = 1 << 40

Label = tuple[int, str]


def faults(turns: list[dict]) -> str:
    """The first fault of each turn, a letter each. ``seen``: the same role and text stands in an earlier block."""
    seen, out = set(), []
    for turn in turns:
        text, key = turn["text"].strip(SPACE), (turn["role"], turn["text"])
        if not text:
            out.append(BLANK)
        elif turn.get("seen") or key in seen:
            out.append(DUPLICATE)
        else:
            out.append(SOUND if text[-1] in ".!?" else TRUNCATED)
        seen.add(key)
    return "".join(out)


def _after(initials: list[str], marks: str, i: int, s: int, last: bool):
    """(cost, letter, node) of the edits at a node."""
    n = len(initials)
    if i < n or last:
        yield INSERT_COST, INSERT, (i, MADE[s])
    if i < n:
        yield DELETE_COST, DELETE, (i + 1, s)
        if marks[i] in (SOUND, TRUNCATED):
            more = TRUNCATED_COST if marks[i] == TRUNCATED else 0
            yield REROLE_COST + more, REROLE, (i + 1, MADE[s])
            if initials[i] in NEXT[s]:
                yield more, KEEP, (i + 1, NEXT[s][initials[i]])


def _before(initials: list[str], marks: str, i: int, t: int, last: bool):
    """(cost, letter, node) of the edits that lead to a node."""
    if i < len(initials) or last:
        for s in MAKERS[t]:
            yield INSERT_COST, INSERT, (i, s)
    if i:
        yield DELETE_COST, DELETE, (i - 1, t)
        if marks[i - 1] in (SOUND, TRUNCATED):
            more = TRUNCATED_COST if marks[i - 1] == TRUNCATED else 0
            for s in MAKERS[t]:
                yield REROLE_COST + more, REROLE, (i - 1, s)
            for s in STATES:
                if NEXT[s].get(initials[i - 1]) == t:
                    yield more, KEEP, (i - 1, s)


def cheapest(initials: list[str], marks: str, start: int = START, ends: list[int] = LEGAL_ENDS, last: bool = True) -> Label | None:
    """Cost and least audit of the cheapest edits from one state to one of ``ends``; None if there are none.

    Turns may be inserted behind the last one only if ``last``. Nodes leave the heaps by cost and, as keeping
    is free, by the number of turns done, so their labels are final then.
    """
    n = len(initials)
    labels: tuple[dict, dict] = ({(0, start): (0, "")}, {(n, t): (0, "") for t in ends})
    heaps = [[(0, 0, start)], [(0, 0, t) for t in ends]]
    done: tuple[set, set] = (set(), set())
    best = FAR if (0, start) not in labels[1] else 0
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, turns, state = heapq.heappop(heaps[side])
        node = (turns, state) if side == 0 else (n - turns, state)
        if node in done[side]:
            continue
        done[side].add(node)
        mine, other = labels[side], labels[1 - side]
        audit = mine[node][1]
        for more, letter, to in (_after if side == 0 else _before)(initials, marks, *node, last):
            label = cost + more, audit + letter if side == 0 else letter + audit
            if to not in mine or label < mine[to]:
                if to not in mine or label[0] < mine[to][0]:
                    heapq.heappush(heaps[side], (label[0], to[0] if side == 0 else n - to[0], to[1]))
                mine[to] = label
                if to in other:
                    best = min(best, label[0] + other[to][0])
    if best == FAR:
        return None
    few, many = sorted(labels, key=len)
    met = [v for v in few if v in many and few[v][0] + many[v][0] == best]
    return best, min(labels[0][v][1] + labels[1][v][1] for v in met)


def edited(turns: list[dict], audit: str, state: int = START) -> list[tuple[str, str, str]]:
    """(edit, role, text) of each edit of ``audit``, from a state on; deleted turns with what they were."""
    out, i = [], 0
    for letter in audit:
        role, text = (WANTED[state], "") if letter == INSERT else (turns[i]["role"], turns[i]["text"])
        if letter == REROLE:
            role = WANTED[state]
        if letter != DELETE:
            state = MADE[state] if letter != KEEP else NEXT[state][role[0]]
        i += letter != INSERT
        out.append((letter, role, text))
    return out


def block_matrix(initials: list[str], marks: str) -> tuple[list[int], list[int]]:
    """Cheapest costs between all states at the ends of a block, and the order of the audits from each state."""
    costs, ranks = [], []
    for s in STATES:
        found = [cheapest(initials, marks, s, [t], False) for t in STATES]
        order = sorted((f[1], t) for t, f in enumerate(found) if f)
        place = {t: i for i, (_, t) in enumerate(order)}
        costs += [f[0] if f else FAR for f in found]
        ranks += [place.get(t, len(STATES)) for t in STATES]
    return costs, ranks


def between(steps: list[dict], start: int, end: int) -> list[int] | None:
    """The states at the ends of each of some neighbouring blocks on the cheapest, then least way."""
    rest = [[FAR] * 4 for _ in range(len(steps) + 1)]
    rest[-1][end] = 0
    for k in range(len(steps) - 1, -1, -1):
        costs = steps[k]["costs"]
        rest[k] = [min(min(costs[4 * s + t] + rest[k + 1][t] for t in STATES), FAR) for s in STATES]
    if rest[0][start] >= FAR:
        return None
    states = [start]
    for k, step in enumerate(steps):
        s = states[-1]
        fits = [t for t in STATES if step["costs"][4 * s + t] + rest[k + 1][t] == rest[k][s]]
        states.append(min(fits, key=lambda t: step["ranks"][4 * s + t]))
    return states


def product(steps: list[dict]) -> tuple[list[int], list[int]]:
    """The matrix of neighbouring blocks together: audits differ first in the block after which their states differ."""
    costs, ranks = [], []
    for s in STATES:
        ways = {t: way for t in STATES if (way := between(steps, s, t))}
        spelt = {t: [step["ranks"][4 * a + b] for step, a, b in zip(steps, way, way[1:], strict=False)] for t, way in ways.items()}
        order = {t: i for i, t in enumerate(sorted(ways, key=spelt.get))}
        costs += [sum(step["costs"][4 * a + b] for step, a, b in zip(steps, ways[t], ways[t][1:], strict=False)) if t in ways else FAR for t in STATES]
        ranks += [order.get(t, len(STATES)) for t in STATES]
    return costs, ranks


def _end(costs: list[int], ranks: list[int]) -> int:
    """The state behind the last turn of a conversation, before turns are inserted at its end."""
    ending = {START: 0, SYSTEM: 2 * INSERT_COST, USER: INSERT_COST, ASSISTANT: 0}
    return min(STATES, key=lambda t: (costs[t] + ending[t], ranks[t]))


_TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_BLOCK = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("last", pa.bool_()),
                    *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                    ("audit", pa.string()), ("turns", pa.list_(_TURN))])
_BLOCK_DDL = ("conv long, block long, last boolean, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
              "turns array<struct<edit string, role string, text string>>")
_MATRIX = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64()))])
_MATRIX_DDL = "conv long, block long, costs array<long>, ranks array<long>"
_STATES = pa.schema([("of", pa.int64()), ("at", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("last", pa.bool_())])
_STATES_DDL = "of long, at long, start int, end int, last boolean"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)


def _rows(batches):
    """The rows of the batches, a few of whole texts at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _block_row(conv, block, turns, before, start, ends, last) -> tuple:
    initials, marks = [t["role"][:1] for t in turns], faults(turns)
    pairs = zip([before, *initials] if before is not None else initials, initials if before is not None else initials[1:], strict=False)
    cost, audit = cheapest(initials, marks, start, ends, last)
    made = [{"edit": e, "role": r, "text": t} for e, r, t in edited(turns, audit, start)]
    return (conv, block, last, marks.count(BLANK), marks.count(DUPLICATE), marks.count(TRUNCATED),
            sum(a + b not in LEGAL_PAIRS for a, b in pairs), cost, audit, made)


def _repair_whole(batches):
    for row in _rows(batches):
        yield _batch([_block_row(row["conv"], 0, row["turns"], None, START, LEGAL_ENDS, True)], _BLOCK)


def _repair_block(batches):
    for row in _rows(batches):
        ends = LEGAL_ENDS if row["last"] else [row["end"]]
        yield _batch([_block_row(row["conv"], row["block"], row["turns"], row["before"], row["start"], ends, row["last"])], _BLOCK)


def _matrices(batches):
    for row in _rows(batches):
        yield _batch([(row["conv"], row["block"], *block_matrix([t["role"][:1] for t in row["turns"]], faults(row["turns"])))], _MATRIX)


def _products(batches):
    for row in _rows(batches):
        yield _batch([(row["conv"], row["block"], *product(row["steps"]))], _MATRIX)


def _states(batches):
    for row in _rows(batches):
        end = row["end"]
        if end is None:
            costs, ranks = product(row["steps"])
            end = _end(costs[4 * row["start"] :][:4], ranks[4 * row["start"] :][:4])
        way = between(row["steps"], row["start"], end)
        made = [(row["conv"], step["block"], a, b, row["last"] and step is row["steps"][-1])
                for step, a, b in zip(row["steps"], way, way[1:], strict=False)]
        yield _batch(made, _STATES)


def _groups(level: DataFrame) -> DataFrame:
    """(conv, block, steps): ``FAN`` neighbouring matrices of a conversation in order."""
    return level.groupBy("conv", F.floor(F.col("block") / FAN).alias("over")).agg(
        F.sort_array(F.collect_list(F.struct("block", "costs", "ranks"))).alias("steps")).withColumnRenamed("over", "block")


def _same(conv: str = "of") -> Column:
    return F.col("conv").eqNullSafe(F.col(conv))


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation and block of at most 256 turns: conv, block, last, fault counts, cost, audit, turns.

    ``turns`` holds (edit, role, text) of each edit in order: K kept, R new role, I inserted, D deleted. Blocks
    are neighbouring turns by position; those of a conversation in order are its repair, ``last`` marks the
    last one, and costs and counts add up (``illegal`` counts a block's first turn with the turn before it).

    Defined results: null roles and texts are one space; a role counts by its first character, and an empty one is never kept as it is; turns of
    equal number stand in order of role and text, null turns first; repeated rows are turns of their own, copies of one another; rows
    of a null id are one conversation; other columns are not read; an empty table gives no rows.
    """
    short, long = by_length(rows, id_col, turn_col, role_col, text_col)
    return short if long is None else short.unionByName(long)


def by_length(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``repair`` in two: conversations of one block, and those of several, if there are any."""
    python_workers(rows.sparkSession)
    turns = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = write_once(sizes.where(F.col("n") > BLOCK_TURNS), "long")
    total = long.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    in_order = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    if not total["n"]:
        return turns.groupBy("conv").agg(in_order).mapInArrow(_repair_whole, _BLOCK_DDL), None
    of_long = sent_to_all(long.select(F.col("conv").alias("of")), row_bytes=16, limit=LONG_BYTES)
    short = turns.join(of_long, _same(), "left_anti").groupBy("conv").agg(in_order).mapInArrow(_repair_whole, _BLOCK_DDL)
    return short, _long(turns.join(of_long, _same(), "left_semi"), total["bytes"] // total["n"])


def _long(turns: DataFrame, text_bytes: int) -> DataFrame:
    """The repair of conversations of more than one block."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = write_once(_placed(turns, text_bytes).withColumn("same", same), "placed")
    first = placed.groupBy(F.col("conv").alias("of"), F.col("same").alias("is")).agg(F.min("block").alias("first"), F.max("block").alias("final"))
    first = sent_to_all(write_once(first.where("first < final").drop("final"), "copies"), row_bytes=96)
    marked = placed.join(first, _same() & (F.col("same") == F.col("is")), "left")
    seen = F.coalesce(F.col("block") > F.col("first"), F.lit(False)).alias("seen")
    blocks = marked.groupBy("conv", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", seen))).alias("turns"))
    blocks = write_once(blocks, "blocks")
    levels = [write_once(blocks.mapInArrow(_matrices, _MATRIX_DDL), "matrices")]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) >= FAN:
        levels.append(write_once(_groups(levels[-1]).mapInArrow(_products, _MATRIX_DDL), "matrices"))
    whole = _groups(levels.pop()).select(
        "conv", "steps", F.lit(START).alias("start"), F.lit(None).cast("int").alias("end"), F.lit(True).alias("last"))
    states = whole.mapInArrow(_states, _STATES_DDL)
    for level in reversed(levels):
        inner = _groups(level).join(states, _same() & (F.col("block") == F.col("at")))
        states = inner.select("conv", "steps", "start", "end", "last").mapInArrow(_states, _STATES_DDL)
    met = blocks.join(states, _same() & (F.col("block") == F.col("at"))).drop("of", "at")
    last_role = F.substring(F.element_at("turns", -1)["role"], 1, 1)
    before = blocks.select(F.col("conv").alias("of"), (F.col("block") + 1).alias("at"), last_role.alias("before"))
    met = met.join(before, _same() & (F.col("block") == F.col("at")), "left")
    return met.select("conv", "block", "turns", "before", "start", "end", "last").mapInArrow(_repair_block, _BLOCK_DDL)


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
_SUMMARY_DDL = "conv long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SUMMARY = pa.schema([("conv", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digested(batches):
    """Sums, audit and digest of each conversation, whose blocks come one after another and are held one at a time."""
    conv, sums, audits, digest, begun = None, None, [], None, False
    for row in _rows(batches):
        if sums is None or row["conv"] != conv:
            if sums is not None:
                yield _batch([(conv, *sums, "".join(audits), digest.hexdigest())], _SUMMARY)
            conv, sums, audits, digest, begun = row["conv"], [0] * len(_COUNTS), [], hashlib.sha256(), False
        sums = [a + row[c] for a, c in zip(sums, _COUNTS, strict=True)]
        audits.append(row["audit"])
        if row["repaired"] is not None:
            digest.update(("\n" * begun + row["repaired"]).encode())
            begun = True
    if sums is not None:
        yield _batch([(conv, *sums, "".join(audits), digest.hexdigest())], _SUMMARY)


def summaries(short: DataFrame, long: DataFrame | None) -> DataFrame:
    """Per conversation: conv, fault counts, cost, audit, and the SHA-256 of its repaired ``role:text`` lines.

    Conversations of one block need no exchange. Those of several stream through a task in order, a block
    at a time, since a digest cannot be put together from parts.
    """
    left = F.filter("turns", lambda t: t["edit"] != DELETE)
    lines = F.array_join(F.transform(left, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = short.select("conv", *_COUNTS, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    if long is None:
        return whole
    parts = long.select("conv", "block", *_COUNTS, "audit", F.when(F.size(left) > 0, lines).alias("repaired"))
    parts = parts.repartition("conv").sortWithinPartitions("conv", "block").drop("block")
    return whole.unionByName(parts.mapInArrow(_digested, _SUMMARY_DDL))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with damage by the checksum of conversation and turn; nulls are one space."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def damage_report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``conversations``: gaps, faults, cost, audit and digest of the repair of its damaged turns."""
    rows = rows.select("conv_id", "turn", "role", "text")
    left = damaged(rows)
    stays = left.select("conv_id", "turn", F.lit(1).alias("stays")).unionByName(rows.select("conv_id", "turn", F.lit(0).alias("stays")))
    there = F.when(F.col("stays") > 0, F.col("turn"))
    turns = stays.groupBy("conv_id", "turn").agg(F.max("stays").alias("stays")).groupBy("conv_id").agg(
        F.min(there).alias("first"), F.max(there).alias("final"), F.count(there).alias("n"))
    span = F.col("final").cast("decimal(20,0)") - F.col("first") + 1 - F.col("n")
    gaps = F.coalesce(span.try_cast("long"), F.lit(0).cast("long"))
    found = summaries(*by_length(left)).withColumnRenamed("conv", "of")
    met = turns.select("conv_id", gaps.alias("gaps")).join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return met.select("conv_id", "gaps", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
