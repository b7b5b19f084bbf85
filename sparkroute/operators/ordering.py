"""Ordered placement and places within a group, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkroute.operators.routing import CHUNK
from sparkroute.operators.small import broadcast_if_small
from sparkroute.session import freeze

POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def sort_chunks(df: DataFrame, order: list, partitions: int | None = None) -> DataFrame:
    """Total order by chunk and key: a range exchange, then a spilling sort per partition.

    A large chunk spans several consecutive partitions. ``order`` should end in a
    tiebreaker, so that the rows of one hot key can be parted too.
    """
    columns = [F.col(CHUNK), *order]
    if partitions:
        placed = df.repartitionByRange(partitions, *columns)
    else:
        placed = df.repartitionByRange(*columns)
    return placed.sortWithinPartitions(*columns)


def ranked(
    df: DataFrame, order: list, partitions: int | None = None, out: str = "row_no"
) -> DataFrame:
    """Adds the 1-based place of each row in its chunk, in the order of ``order``.

    The sorted rows are written once. Each keeps its position in its partition, so a place
    is that position, less where the chunk starts in the partition, plus the rows of the
    chunk in earlier partitions; the latter is a table of at most partitions + chunks rows.
    """
    at = F.monotonically_increasing_id()
    placed = freeze(sort_chunks(df, order, partitions).withColumn("__at", at))
    placed = placed.withColumn("__part", F.shiftright("__at", POSITION_BITS).cast("int"))
    runs = placed.groupBy(CHUNK, "__part").agg(
        F.min("__at").alias("__start"), F.count("*").alias("__rows")
    )
    earlier = Window.partitionBy(CHUNK).orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    runs = runs.select(CHUNK, "__part", "__start", before.alias("__before"))
    place = F.col("__before") + F.col("__at") - F.col("__start") + 1
    return (
        placed.join(broadcast_if_small(runs), [CHUNK, "__part"])
        .withColumn(out, place.cast("bigint"))
        .drop("__at", "__part", "__start", "__before")
    )


def positioned(df: DataFrame, order: list, out: str) -> DataFrame:
    """Adds the 0-based place of each row in the total order, without one task for all rows.

    Range-placed and sorted rows are written once; a place is the position in the partition
    plus the rows of earlier partitions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = freeze(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", POSITION_BITS)
    placed = placed.withColumn("__part", part)
    rows = placed.groupBy("__part").agg(F.count("*").alias("__rows"))
    # one row per partition
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    offsets = rows.select("__part", before.alias("__before"))
    here = F.col("__at") - F.shiftleft("__part", POSITION_BITS)
    return (
        placed.join(broadcast_if_small(offsets), "__part")
        .withColumn(out, (F.col("__before") + here).cast("bigint"))
        .drop("__at", "__part", "__before")
    )


def spread_slots(df: DataFrame, rows_per_slot: int) -> int:
    """Slots needed so that even one chunk with all rows has about ``rows_per_slot`` in each."""
    return max(1, -(-df.count() // rows_per_slot))


def _slotted(df: DataFrame, spread: Column, slots: int) -> DataFrame:
    """``df`` with its internal group columns: chunk, and slot by the hash ``spread``.

    Neither is ever NULL, so a join on them loses no row and needs no filter that would
    repeat the hash.
    """
    slot = F.pmod(spread, F.lit(slots).cast("bigint")).cast("int")
    return df.withColumn("__slot", F.coalesce(slot, F.lit(0))).withColumn(
        "__chunk", F.coalesce(F.col(CHUNK), F.lit(-1).cast("bigint"))
    )


SLOT = ["__chunk", "__slot"]


def slot_totals(
    df: DataFrame, spread: Column, slots: int, size: Column | None = None
) -> DataFrame:
    """Rows (and bytes, and the largest size) per chunk and slot; combines on the map side."""
    totals = [F.count("*").alias("__rows")]
    if size is not None:
        df = df.withColumn("__size", size)
        totals += [F.sum("__size").alias("__bytes"), F.max("__size").alias("__largest")]
    return _slotted(df, spread, slots).groupBy(*SLOT).agg(*totals)


def numbered(
    df: DataFrame,
    order: list,
    spread: Column,
    slots: int,
    size: Column | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Adds ``row_no`` (and ``bytes_to``, the running bytes) within each chunk.

    For results where rows only need some fixed order in the chunk. Each chunk is parted
    into ``slots`` by the hash ``spread``; the order is slot first, then ``order``. The join
    to the slot totals rides on the exchange of the window (both are by chunk and slot), so
    the rows are shuffled once.
    """
    if totals is None:
        totals = slot_totals(df, spread, slots, size)
    earlier = Window.partitionBy("__chunk").orderBy("__slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = [F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_before")]
    if size is not None:
        before.append(F.coalesce(F.sum("__bytes").over(earlier), F.lit(0)).alias("__bytes_before"))
    offsets = totals.select(*SLOT, *before)

    within = Window.partitionBy(*SLOT).orderBy(*order)
    made = ["row_no"]
    base = df if size is None else df.withColumn("__size", size)
    placed = _slotted(base, spread, slots).withColumn("__row", F.row_number().over(within))
    if size is not None:
        upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = placed.withColumn("__upto", F.sum("__size").over(upto))
    joined = placed.join(offsets.hint("merge"), SLOT)
    joined = joined.withColumn("row_no", (F.col("__rows_before") + F.col("__row")).cast("bigint"))
    if size is not None:
        made.append("bytes_to")
        upto = F.col("__bytes_before") + F.col("__upto")
        joined = joined.withColumn("bytes_to", upto.cast("bigint"))
    return joined.select(*df.columns, *made)


def batches(
    df: DataFrame, order: list, spread: Column, slots: int, rows: int
) -> DataFrame:
    """Adds ``batch_no``: batches of ``rows`` documents per chunk, only the last one short."""
    placed = numbered(df, order, spread, slots)
    number = F.call_function("div", F.col("row_no") - 1, F.lit(rows).cast("bigint"))
    return placed.withColumn("batch_no", number)


def file_plan(
    df: DataFrame, order: list, spread: Column, slots: int, size: Column, limit: int
) -> DataFrame:
    """Adds ``file_no``: files of at most ``limit`` bytes per chunk, numbered per chunk.

    A file starts a new stretch of ``limit`` less the largest document, so the document
    across its edge still fits. The sizes are read twice: for the totals and for the plan.
    """
    totals = freeze(slot_totals(df, spread, slots, size))
    largest = totals.agg(F.max("__largest")).first()[0] or 0
    room = limit - largest
    if room < 1:
        raise ValueError(f"a document of {largest} bytes does not fit files of {limit} bytes")
    placed = numbered(df, order, spread, slots, size, totals)
    start = F.greatest(F.col("bytes_to") - 1, F.lit(0).cast("bigint"))
    return placed.withColumn("file_no", F.call_function("div", start, F.lit(room).cast("bigint")))


SMALL_CLASS = 4
BEYOND = ("fail", "alone")


def size_class(size: Column, limit: int) -> Column:
    """0 for documents above half of ``limit``, 1 above a quarter, ..., ``SMALL_CLASS`` for small ones."""
    found = F.lit(SMALL_CLASS)
    for c in reversed(range(SMALL_CLASS)):
        found = F.when(size > limit >> (c + 1), F.lit(c)).otherwise(found)
    return found


def packed_files(
    df: DataFrame, order: list, spread: Column, size: Column, limit: int, rows_per_slot: int = 1_000_000, beyond: str = "fail"
) -> DataFrame:
    """Adds ``file_no``: files of at most ``limit`` bytes per chunk, numbered per chunk, however large single documents are.

    A document above ``limit`` itself fits no file: it fails the job, or with ``beyond="alone"`` has a file of its own.
    A file holds one document above half of the limit, or two above a quarter, four above an eighth, eight above a
    sixteenth; all smaller ones fill files of their own up to seven eighths at least. So a few large documents do not make the
    files of the others small. Sizes and places are counted on a narrow table that is written once. Each chunk and
    class is cut into slots by ``spread`` as its own count demands, so a chunk's numbering is no single task,
    and few rows make few slots. In a slot the rows stand by ``spread``, then ``order``.
    """
    if beyond not in BEYOND:
        raise ValueError(f"bad way for documents beyond the limit: {beyond}; one of {', '.join(BEYOND)}")
    groups = ["__chunk", "__class"]
    base = df.withColumn("__size", size).withColumn("__spread", spread)
    base = base.withColumn("__chunk", F.coalesce(F.col(CHUNK), F.lit(-1).cast("bigint")))
    base = base.withColumn("__class", size_class(F.col("__size"), limit))
    narrow = freeze(base.select(*groups, "__size", "__spread"))
    largest = narrow.agg(F.max("__size")).first()[0] or 0 if beyond == "fail" else 0
    if largest > limit:
        raise ValueError(f"a document of {largest} bytes does not fit files of {limit} bytes")

    room = limit - (limit >> SMALL_CLASS)
    counts = narrow.groupBy(*groups).agg(F.count("*").alias("__n"), F.sum("__size").alias("__bytes"))
    per_file = F.call_function("shiftleft", F.lit(1), F.col("__class"))
    files = F.when(F.col("__class") < SMALL_CLASS, F.ceil(F.col("__n") / per_file)).otherwise(
        F.call_function("div", F.greatest(F.col("__bytes"), F.lit(1)) - 1, F.lit(room).cast("bigint")) + 1)
    ahead = Window.partitionBy("__chunk").orderBy("__class").rowsBetween(Window.unboundedPreceding, -1)
    slots = F.ceil(F.col("__n") / rows_per_slot).cast("bigint")
    classes = counts.withColumn("__files", files).select(
        *groups, slots.alias("__slots"), F.coalesce(F.sum("__files").over(ahead), F.lit(0)).cast("bigint").alias("__first"))
    classes = broadcast_if_small(freeze(classes))

    slot = F.pmod(F.col("__spread"), F.col("__slots")).alias("__slot")
    totals = narrow.join(classes, groups).select(*groups, slot, "__size").groupBy(*groups, "__slot").agg(
        F.count("*").alias("__rows"), F.sum("__size").alias("__bytes"))
    earlier = Window.partitionBy(*groups).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "__slot", *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("__rows", "__bytes")])
    offsets = broadcast_if_small(freeze(offsets))

    # a sort computes an order's expressions for each comparison, such as the text of a document; the hash settles nearly all
    within = Window.partitionBy(*groups, "__slot").orderBy("__spread", *order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = base.join(classes, groups).withColumn("__slot", slot)
    placed = placed.withColumn("__row", F.row_number().over(within)).withColumn("__upto", F.sum("__size").over(upto))
    placed = placed.join(offsets, [*groups, "__slot"])
    row = F.col("__rows_before") + F.col("__row") - 1
    start = F.col("__bytes_before") + F.col("__upto") - F.col("__size")
    number = F.when(F.col("__class") < SMALL_CLASS, F.floor(row / per_file)).otherwise(
        F.call_function("div", start.cast("bigint"), F.lit(room).cast("bigint")))
    return placed.withColumn("file_no", (F.col("__first") + number).cast("bigint")).select(*df.columns, "file_no")
