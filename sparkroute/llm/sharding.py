"""Sharding by histogram sort, in built-in functions only.

Documents are ordered by (hash of the text, id, number of the written row), so equal texts stand
together. Bytes and rows are counted exactly below candidate boundaries, first on the hash, inside
a hash that is too heavy on the id, and among rows that share both on the number; only the cells that hold a boundary are counted again with finer probes,
until each boundary lies within the tolerance of its target. Then the rows are exchanged once.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkroute.functions.keys import ASC
from sparkroute.llm.common import fresh, text_of, write_once
from sparkroute.operators.routing import bisect

INT64_MIN, INT64_MAX = -(1 << 63), (1 << 63) - 1
KEYS = ("h", "d", "u")
FIRST_BITS, NEXT_BITS = 16, 12
PROBES = 4096
TOLERANCE = 0.0005
PART_ROWS = 500_000
MIN_PARTS, MAX_PARTS = 8, 128


class _Boundary:
    """One boundary: its byte target, and the cell that it lies in."""

    def __init__(self, target: float):
        self.target, self.split, self.bytes, self.rows = target, None, 0, 0
        self.held: tuple = ()  # keys that all rows of the cell share

    def settle(self, split: tuple, size: int, rows: int) -> None:
        self.split, self.bytes, self.rows = split, size, rows


def _from(held: tuple, value: int) -> tuple:
    """The lowest key at which rows with the keys ``held`` have ``value`` or more in the next one."""
    if value > INT64_MAX:
        return held + (INT64_MAX,) * (len(KEYS) - len(held))
    return (*held, value) + (INT64_MIN,) * (len(KEYS) - len(held) - 1)


def _narrow(open_: list[_Boundary], cells: dict, width_of, slack: float) -> None:
    """Place each open boundary in the cell of ``cells`` that holds its target, or settle it.

    ``cells`` maps a boundary's cell to sorted (probe, bytes, rows); ``width_of`` gives the
    keys at both ends of a probe, and whether it can be cut further.
    """
    for b in open_:
        size, rows = b.bytes, b.rows
        for probe, cell_bytes, cell_rows in cells.get(b.cell, []):
            if size + cell_bytes > b.target:
                low, high, more = width_of(b, probe)
                under, over = b.target - size, size + cell_bytes - b.target
                if under <= slack or not more and under <= over:
                    b.settle(low, size, rows)
                elif over <= slack or not more:
                    b.settle(high, size + cell_bytes, rows + cell_rows)
                else:
                    b.bytes, b.rows, b.probe = size, rows, probe
                break
            size, rows = size + cell_bytes, rows + cell_rows
        else:  # the target is the end of the cell
            b.settle(b.end, size, rows)


def _counted(keyed: DataFrame, cell: Column, probe: Column) -> dict:
    """Bytes and rows by cell and probe. At most one cell for each boundary, ``PROBES`` probes each."""
    rows = keyed.groupBy(cell.alias("cell"), probe.alias("probe")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    cells: dict = {}
    for r in sorted(rows, key=lambda r: r["probe"]):
        cells.setdefault(r["cell"], []).append((r["probe"], r["bytes"], r["rows"]))
    return cells


def byte_splitters(keyed: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[tuple[int, int, int, int]]:
    """Keys (h, d, u) of ``parts`` - 1 boundaries with equal bytes between them, and the rows below each.

    A boundary is off by at most ``tolerance`` of all bytes, or by one row.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    slack = total * tolerance
    found = [_Boundary(total * i / parts) for i in range(1, parts)]
    shift = 64 - FIRST_BITS
    for b in found:
        b.cell, b.end = 0, _from((), INT64_MAX + 1)
    cells = _counted(keyed, F.lit(0), F.shiftright("h", shift))

    def ends(probe, shift):
        return _from((), probe << shift), _from((), (probe + 1) << shift), True

    _narrow(found, cells, lambda b, p: ends(p, shift), slack)
    while shift and any(b.split is None for b in found):
        todo = [b for b in found if b.split is None]
        step = min(NEXT_BITS, shift)
        for b in todo:
            b.cell, b.end = b.probe, ends(b.probe, shift)[1]
        up = F.shiftright("h", shift)
        shift -= step
        cells = _counted(keyed.where(up.isin(sorted({b.cell for b in todo}))), up, F.shiftright("h", shift))
        _narrow(todo, cells, lambda b, p, s=shift: ends(p, s), slack)

    heavy = [b for b in found if b.split is None]
    for b in heavy:
        b.held = (b.probe,)
    for key in KEYS[1:]:
        _cut_by(keyed, [b for b in heavy if b.split is None], key, slack)
    return [(*b.split, b.rows) for b in found]


def _cut_by(keyed: DataFrame, todo: list[_Boundary], key: str, slack: float) -> None:
    """Settle boundaries among rows that share the keys before ``key`` by the values of ``key``.

    A boundary that one value holds stays open, with that value as one more shared key.
    """
    before = KEYS[: KEYS.index(key)]
    last = key == KEYS[-1]

    def shared(held: tuple) -> Column:
        return reduce(and_, [F.col(k) == v for k, v in zip(before, held, strict=True)])

    if todo:
        rows = keyed.where(reduce(or_, [shared(h) for h in sorted({b.held for b in todo})]))
        spans = {tuple(r[k] for k in before): (r["lo"], r["hi"]) for r in rows.groupBy(*before).agg(
            F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}
        for b in todo:
            b.lo, b.hi = spans[b.held]
    while todo:
        number = {s: i for i, s in enumerate(sorted({(b.held, b.lo, b.hi) for b in todo}))}
        cell, probe, inside = F, F, F.lit(False)
        for (held, lo, hi), i in number.items():
            here = shared(held) & F.col(key).between(lo, hi)
            width = (hi - lo) // PROBES + 1
            cell = cell.when(here, i)
            probe = probe.when(here, F.expr(f"cast((cast({key} as decimal(20,0)) - {lo}) as decimal(20,0)) div {width}"))
            inside = inside | here
        for b in todo:
            b.cell, b.end = number[(b.held, b.lo, b.hi)], _from(b.held, b.hi + 1)
            b.width = (b.hi - b.lo) // PROBES + 1

        def ends(b, p):
            low = b.lo + int(p) * b.width
            return _from(b.held, low), _from(b.held, low + b.width), b.width > 1 or not last

        _narrow(todo, _counted(keyed.where(inside), cell, probe), ends, slack)
        todo = [b for b in todo if b.split is None]
        for b in todo:
            b.lo += int(b.probe) * b.width
            b.hi = min(b.hi, b.lo + b.width - 1)
            if b.width == 1:
                b.held = (*b.held, b.lo)
        todo = [b for b in todo if len(b.held) == len(before)]


def shard_documents(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> tuple[DataFrame, str]:
    """``docs`` (its columns ``keep`` if given) with one more struct column, and its name.

    The struct has size (UTF-8 bytes of the text plus 1), text_crc32, shard and slot, which
    counts from 0 without gaps in each shard. Shards hold nearly equal bytes: each boundary is
    within 0.05 % of all bytes of its place, or at the border of one document. Equal texts stay
    in one shard unless a boundary would miss its tolerance; so do rows of equal text and id. At most ``shards`` * 128 boundaries
    are known to the driver.

    Defined results: a null text is empty and has size 1; a null id sorts first; rows of equal text and id
    take neighbouring slots in any order; an empty table stays empty.
    """
    name = fresh(docs, "place")
    text = text_of(text_col)
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("h"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(INT64_MIN)).alias("d"), F.monotonically_increasing_id().alias("u"))
    keyed = write_once(row, "keyed")
    rows = keyed.count()
    per_shard = min(max(rows // (shards * PART_ROWS), MIN_PARTS), MAX_PARTS)
    splits = byte_splitters(keyed.select(*KEYS, "size"), shards * per_shard)
    below = [0, *[n for *_, n in splits]]
    bounds = [F.array(*[F.lit(s[i]).cast("long") for s in splits]) for i in range(len(KEYS))]
    part = bisect(bounds, len(splits), [(k, ASC) for k in KEYS])
    placed = keyed.withColumn("part", part).withColumn("shard", F.floor(F.col("part") / per_shard).cast("int"))
    first = F.array(*[F.lit(n).cast("long") for n in below])
    within = F.row_number().over(Window.partitionBy("part").orderBy(*KEYS))
    slot = within - 1 + F.get(first, F.col("part")) - F.get(first, F.col("shard") * per_shard)
    return placed.select("row.*", F.struct(
        "size", F.col("crc").alias("text_crc32"), "shard", slot.cast("long").alias("slot")).alias(name)), name
