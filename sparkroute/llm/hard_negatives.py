"""Hard negatives by segment summaries: vectors that score just below an anchor's positives.

Vectors become whole numbers. Each is cut into segments of 4 components, those into segments of
16, 64 and so on, and each segment's mean and deviation are stored. With ``n`` components, the
inner product of two segments is ``n * mean * mean`` of both, give or take ``n * deviation *
deviation`` (Cauchy and Schwarz), and the sum over the segments bounds a score from both sides. Scores
are bounded from the coarsest segments to the finest; only pairs that may still
matter go on to the next level, and what is left is scored exactly.

Rows are dealt to blocks, packed as matrices and written once. Anchors are packed too, a bounded
number to a block. A bounded number of anchors' blocks at a time goes to all executors, where each meets each block of rows
in the task that reads it, and a task keeps the best five of each anchor. The positives come from a first run, and the windows
below their scores go into a second one. No pair of rows is ever a row of a table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkroute.llm.common import BROADCAST_BYTES, discard, python_workers, write_once
from sparkroute.session import scratch_dir

#: Rows of a block, anchors of a block, and blocks of anchors that a task holds results of.
ROWS = 4096
ANCHORS = 1024
HELD = 16
#: Rows that are compared at once with the anchors of a block.
PIECE = 512
#: Components of a finest segment, and segments of a segment above.
FINE = 4
FAN = 4
BEST = 5
SCALE = 256
#: Bytes of a packed anchor at most: so many a component, and for its numbers and slots.
COMPONENT_BYTES = 12
ANCHOR_BYTES = 256
#: Bounds are widened by this share of the vectors' lengths, far above what rounding can add.
SLACK = 1e-5
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_BLOCK = pa.schema([("rg", pa.int32()), ("dim", pa.int32()), ("n", pa.int32()), ("n_anchors", pa.int64()), ("kind", pa.string()),
                    *[(c, pa.binary()) for c in ("ids", "null_ids", "labels", "uids", "vectors", "means", "spreads", "slots")]])
_BLOCK_DDL = ("rg int, dim int, n int, n_anchors long, kind string, ids binary, null_ids binary, labels binary, uids binary, "
              "vectors binary, means binary, spreads binary, slots binary")
_PACKED = ["dim", "n", "kind", "ids", "null_ids", "labels", "uids", "vectors", "means", "spreads", "slots"]
_ROWS_DDL = "uid long, id long, label long, vector array<double>"
_FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "anchor long, slot int, id long, uid long, score long"


def levels(dim: int) -> list[int]:
    """Components of a segment on each level, coarsest first."""
    sizes = [FINE]
    while sizes[-1] < dim:
        sizes.append(sizes[-1] * FAN)
    return sizes[::-1]


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and spreads of all segments of all levels, weighted so that a product of two rows is a sum over components.

    A spread is a deviation times the root of the number of components.
    """
    rows, dim = vectors.shape
    means, spreads = [], []
    for size in levels(dim):
        starts = np.arange(0, dim, size)
        if not len(starts):
            continue
        n = np.diff(np.append(starts, dim))
        mean = np.add.reduceat(vectors, starts, 1) / n
        rest = vectors - np.repeat(mean, n, 1)
        means.append(mean * np.sqrt(n))
        spreads.append(np.sqrt(np.add.reduceat(rest * rest, starts, 1)))
    if not means:
        return np.zeros((rows, 0), np.float32), np.zeros((rows, 0), np.float32)
    with np.errstate(over="ignore"):  # such vectors are scored without bounds
        return np.hstack(means).astype(np.float32), np.hstack(spreads).astype(np.float32)


def segments(dim: int) -> list[slice]:
    """Where the summaries of each level lie."""
    ends = list(itertools.accumulate(-(-dim // size) for size in levels(dim)))
    return [slice(a, b) for a, b in zip([0, *ends], ends, strict=False)]


def _smallest(vectors: np.ndarray) -> tuple[str, bytes]:
    """The vectors in the narrowest type that holds them exactly."""
    top = np.abs(vectors).max(initial=0)
    kind = "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "f8"
    return kind, vectors.astype(kind).tobytes()


def _packed(ids, null_ids, labels, uids, vectors, slots=b"") -> dict:
    """A block of vectors of one length."""
    means, spreads = summaries(vectors)
    kind, data = _smallest(vectors)
    return {"dim": vectors.shape[1], "n": len(vectors), "kind": kind, "ids": ids.tobytes(), "null_ids": null_ids.tobytes(),
            "labels": labels.tobytes(), "uids": uids.tobytes(), "vectors": data, "means": means.tobytes(),
            "spreads": spreads.tobytes(), "slots": slots}


class Block:
    """The arrays of a packed block."""

    def __init__(self, row: dict):
        self.dim, n = row["dim"], row["n"]
        self.ids, self.labels, self.uids = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "uids"))
        self.null_ids = np.frombuffer(row["null_ids"], bool)
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(n, self.dim).astype(np.float64)
        self.means, self.spreads = (
            np.frombuffer(row[c], np.float32).astype(np.float64).reshape(n, -1 if self.dim else 0) for c in ("means", "spreads"))
        self.top = np.abs(self.vectors).max(initial=0)
        self.lengths = np.sqrt((self.vectors * self.vectors).sum(1))
        #: The score of each positive, the least of its window, and whether there is one.
        self.slots = np.frombuffer(row["slots"], np.int64).reshape(3, n, -1) if row["slots"] else None

    def piece(self, start: int, end: int) -> Block:
        """Neighbouring vectors of the block."""
        part = object.__new__(Block)
        part.dim, part.top, part.slots = self.dim, self.top, None
        for name in ("ids", "labels", "uids", "null_ids", "vectors", "means", "spreads", "lengths"):
            setattr(part, name, getattr(self, name)[start:end])
        return part


def exact(rows: Block, anchors: Block, r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Scores of the pairs; those outside of a bigint become its nearest value."""
    bound = float(rows.top) * float(anchors.top) * max(rows.dim, 1)
    out = np.empty(len(r), np.int64)
    for i in range(0, len(r), 1 << 16):
        part = slice(i, i + (1 << 16))
        x, y = rows.vectors[r[part]], anchors.vectors[a[part]]
        if bound < 1 << 53:
            out[part] = np.einsum("ij,ij->i", x, y)
        elif bound < 1 << 62:
            out[part] = np.einsum("ij,ij->i", x.astype(np.int64), y.astype(np.int64))
        else:
            out[part] = [max(LEAST, min(MOST, sum(int(u) * int(v) for u, v in zip(p, q, strict=True)))) for p, q in zip(x, y, strict=True)]
    return out


def may_matter(rows: Block, anchors: Block, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, anchor) whose score may lie between ``least`` and ``most`` of a slot of the anchor.

    ``allowed`` holds the pairs to look at; ``least`` and ``most`` have a column per slot.
    """
    if float(rows.top) * float(anchors.top) * max(rows.dim, 1) >= 1 << 62:  # beyond bigints no bound is of use
        return np.nonzero(allowed)
    low, high = least.astype(np.float64), most.astype(np.float64)
    low, high = low - np.abs(low) * 1e-12, high + np.abs(high) * 1e-12
    cuts, pairs = segments(rows.dim), None
    for cut in cuts:
        x, dx, y, dy = rows.means[:, cut], rows.spreads[:, cut], anchors.means[:, cut], anchors.spreads[:, cut]
        if pairs is None or len(pairs[0]) * 8 > allowed.size:
            middle, reach = x @ y.T, dx @ dy.T
            reach += SLACK * np.outer(rows.lengths, anchors.lengths)
            keep = np.zeros(allowed.shape, bool)
            for s in range(low.shape[1]):
                keep |= (middle + reach >= low[:, s]) & (middle - reach <= high[:, s])
            if pairs is None:
                keep &= allowed
            else:
                before = np.zeros(allowed.shape, bool)
                before[pairs] = True
                keep &= before
            pairs = np.nonzero(keep)
        else:
            kept = []
            for i in range(0, len(pairs[0]), 1 << 16):
                r, a = pairs[0][i : i + (1 << 16)], pairs[1][i : i + (1 << 16)]
                middle = np.einsum("ij,ij->i", x[r], y[a])
                reach = np.einsum("ij,ij->i", dx[r], dy[a]) + SLACK * rows.lengths[r] * anchors.lengths[a]
                kept.append((((middle + reach)[:, None] >= low[a]) & ((middle - reach)[:, None] <= high[a])).any(1))
            keep = np.concatenate(kept) if kept else np.zeros(0, bool)
            pairs = pairs[0][keep], pairs[1][keep]
    return np.nonzero(allowed) if pairs is None else pairs


class Best:
    """The best five rows of each anchor and slot of a block of anchors, over the blocks of rows so far."""

    def __init__(self, anchors: Block):
        self.anchors, n = anchors, len(anchors.uids)
        if anchors.slots is None:
            self.same, self.most = True, np.full((n, 1), MOST)
            self.least = np.full((n, 1), LEAST)
        else:
            self.same, self.most, self.least = False, anchors.slots[0], anchors.slots[1].copy()
            self.most = np.where(anchors.slots[2] > 0, self.most, LEAST)
            self.least = np.where(anchors.slots[2] > 0, self.least, MOST)
        self.wide = self.least.shape[1]
        #: (anchor * wide + slot, null id, id, uid, score) in order, at most five of each slot.
        self.found = [np.zeros(0, t) for t in (np.int64, bool, np.int64, np.int64, np.int64)]

    def add(self, block: Block) -> int:
        """Takes in a block of rows, piece by piece, as bars rise; the number of pairs that passed all bounds."""
        return sum(self._piece(block.piece(i, i + PIECE)) for i in range(0, len(block.uids), PIECE))

    def _piece(self, rows: Block) -> int:
        anchors = self.anchors
        alike = rows.labels[:, None] == anchors.labels[None, :]
        allowed = alike & (rows.uids[:, None] != anchors.uids[None, :]) if self.same else ~alike
        if self.same:
            self._seed(rows, allowed)
        r, a = may_matter(rows, anchors, allowed, self.least, self.most)
        score = exact(rows, anchors, r, a)
        for s in range(self.wide):
            fits = np.nonzero((score >= self.least[a, s]) & (score <= self.most[a, s]))[0]
            self._keep(a[fits] * self.wide + s, rows, r[fits], score[fits])
        return len(r)

    def _seed(self, rows: Block, allowed: np.ndarray) -> None:
        """A first threshold: the exact scores of the five rows of greatest middle, of which the least is no bar too high."""
        cuts = segments(rows.dim)
        if not cuts or len(rows.uids) < BEST:
            return
        middle = np.where(allowed, rows.means[:, cuts[-1]] @ self.anchors.means[:, cuts[-1]].T, -np.inf)
        r = np.argpartition(middle, -BEST, 0)[-BEST:]
        full = np.take_along_axis(allowed, r, 0).all(0)
        at = np.nonzero(full)[0]
        score = exact(rows, self.anchors, r[:, at].ravel(), np.tile(at, BEST)).reshape(BEST, len(at)).min(0)
        self.least[at, 0] = np.maximum(self.least[at, 0], score)

    def _keep(self, key, rows, r, score) -> None:
        new = [key, rows.null_ids[r], rows.ids[r], rows.uids[r], score]
        key, null, ids, uids, score = (np.concatenate(both) for both in zip(self.found, new, strict=True))
        order = np.lexsort((uids, ids, null, ~score, key))
        key = key[order]
        first = np.searchsorted(key, key, "left")
        place = np.arange(len(key)) - first
        order = order[place < BEST]
        fifth = np.nonzero(place == BEST - 1)[0]
        at = key[fifth]
        self.found = [x[order] for x in (np.concatenate(both) for both in zip(self.found, new, strict=True))]
        last = score[order][np.searchsorted(self.found[0], at, "right") - 1]
        self.least[at // self.wide, at % self.wide] = np.maximum(self.least[at // self.wide, at % self.wide], last)

    def batch(self) -> pa.RecordBatch:
        key, null, ids, uids, score = self.found
        return pa.RecordBatch.from_arrays([
            pa.array(self.anchors.uids[key // self.wide]), pa.array((key % self.wide).astype(np.int32)),
            pa.array(ids, mask=null), pa.array(uids), pa.array(score)], schema=_FOUND)


def _search(batches):
    """The best rows of the anchors of each block that meets blocks of rows."""
    held: dict[tuple, Best] = {}
    uids, block = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["uids"] != uids:  # a block of rows meets its anchors one after another
                uids, block = row["uids"], Block(row)
            key = row["ag"], row["dim"], row["a_uids"]
            if key not in held:
                if len(held) >= HELD:
                    yield held.pop(next(iter(held))).batch()
                held[key] = Best(Block({c: row[f"a_{c}"] for c in _PACKED}))
            held[key].add(block)
    for best in held.values():
        yield best.batch()


def _chunks(batches, columns: list[str], rows: int):
    """Rows of the batches in runs of one value of ``columns``, at most ``rows`` in each."""
    run, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            at = tuple(row[c] for c in columns)
            if run and (at != key or len(run) >= rows):
                yield key, run
                run = []
            key = at
            run.append(row)
    if run:
        yield key, run


def _arrays(run: list[dict], dim: int) -> tuple:
    null = np.array([r["id"] is None for r in run])
    return (np.array([r["id"] or 0 for r in run], np.int64), null, np.array([r["label"] for r in run], np.int64),
            np.array([r["uid"] for r in run], np.int64), np.array([r["vector"] for r in run], np.float64).reshape(len(run), dim))


def _pack_rows(anchor_every: int):
    def pack(batches):
        for (rg, dim), run in _chunks(batches, ["rg", "dim"], ROWS):
            ids, null, labels, uids, vectors = _arrays(run, dim)
            block = _packed(ids, null, labels, uids, np.floor(SCALE * vectors))
            block |= {"rg": rg, "n_anchors": int(((ids % anchor_every == 0) & ~null).sum())}
            yield pa.RecordBatch.from_pylist([block], schema=_BLOCK)

    return pack


def _pick_anchors(anchor_every: int):
    def pick(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                at = np.nonzero((block.ids % anchor_every == 0) & ~block.null_ids)[0]
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.uids[at]), pa.array(block.ids[at]), pa.array(block.labels[at]),
                    pa.array(list(block.vectors[at]), pa.list_(pa.float64()))], ["uid", "id", "label", "vector"])

    return pick


def _pack_anchors(batches):
    for (ag, dim), run in _chunks(batches, ["ag", "dim"], ANCHORS):
        slots = b""
        if "scores" in run[0]:
            scores = [r["scores"] or [] for r in run]
            padded = [[*s, *[0] * (BEST - len(s))] for s in scores]
            least = [[-(-4 * p // 5) for p in s] for s in padded]
            used = [[int(i < len(s)) for i in range(BEST)] for s in scores]
            slots = np.array([padded, least, used], np.int64).tobytes()
        ids, null, labels, uids, vectors = _arrays(run, dim)
        packed = _packed(ids, null, labels, uids, vectors, slots)
        block = {"ag": ag} | {f"a_{c}": packed[c] for c in _PACKED}
        yield pa.RecordBatch.from_pylist([block], schema=_ANCHOR)


_ANCHOR = pa.schema([("ag", pa.int32()), *[(f"a_{c}", _BLOCK.field(c).type) for c in _PACKED]])
_ANCHOR_DDL = "ag int, a_dim int, a_n int, a_kind string, " + ", ".join(f"a_{c} binary" for c in _PACKED[3:])


def _first(found: DataFrame, by: list[str]) -> DataFrame:
    """The best five per group, over all tasks, with their ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)


def _met(blocks: DataFrame, packed: DataFrame) -> DataFrame:
    """What the blocks of anchors ``packed`` find in the blocks of rows, task by task; they go to all executors, the rows stay in place."""
    met = blocks.join(F.broadcast(packed.withColumnRenamed("ag", "a_ag")), F.col("dim") == F.col("a_dim"))
    return met.select(F.col("a_ag").alias("ag"), *_PACKED, *[f"a_{c}" for c in _PACKED]).mapInArrow(_search, _FOUND_DDL)


def _searched(blocks: DataFrame, anchors: DataFrame, groups: int, by: list[str], round_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The best five per group ``by`` of the anchors, with their ``rank``, written once.

    The groups of anchors take turns: as many meet the rows at once as a task holds results of and ``round_bytes``
    allow, by the greatest bytes that were counted in a group. A turn's results are final, since no anchor has two.
    """
    spark = blocks.sparkSession
    packed = anchors.repartition(groups, "ag").sortWithinPartitions("ag", "dim").mapInArrow(_pack_anchors, _ANCHOR_DDL)
    packed = write_once(packed, "anchors")
    size = sum((F.octet_length(f"a_{c}") for c in _PACKED[3:]), F.lit(64)).cast("bigint")
    largest = packed.groupBy("ag").agg(F.sum(size).alias("size")).agg(F.max("size")).first()[0] or 1
    turn = max(1, min(HELD, round_bytes // largest))
    path = scratch_dir(spark, "found")
    for start in range(0, groups, turn):
        best = _first(_met(blocks, packed.where(F.col("ag").between(start, start + turn - 1))), by)
        best.write.mode("append").parquet(path)
    discard(packed)
    return spark.read.schema(best.schema).parquet(path)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = 100, relabel_every: int | None = 7, n_labels: int = 10) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchor_every``; their positives the five best
    other rows of the same label; the negatives of a positive the five best rows of another label that
    score at least 80 % of it and not more than it. Scores are exact inner products of the components times 256, rounded down.

    Defined results: rows with a null label, a null vector, or a null or non-finite component (also
    one whose 256-fold is not finite) take no part; a null id is no anchor and comes last among ties;
    repeated rows are rows of their own, so a copy of an anchor is one of its positives and an anchor too;
    rows of one id and score stand in the order of the table; vectors of different lengths never meet; scores outside of a bigint become
    its nearest value; a negative positive score has no negatives; other columns are not read; an empty
    table gives no rows. Where the id is divisible by ``relabel_every``, the label becomes (label + 1) % ``n_labels``.
    """
    spark = df.sparkSession
    python_workers(spark)
    label = F.col(f"`{label_col}`").cast("long")
    if relabel_every:
        moved = F.pmod(label % n_labels + 1, F.lit(n_labels))
        label = F.when(F.col(f"`{id_col}`") % relabel_every == 0, moved).otherwise(label)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) * SCALE < float("inf"), F.lit(False)) & ~F.isnan(x))
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("id"),
                     label.alias("label"), F.col(f"`{vector_col}`").alias("raw"), vector.alias("vector"), finite.alias("finite"))
    rows = rows.where(F.col("label").isNotNull() & F.col("finite")).select("uid", "id", "label", "raw")
    rows = rows.withColumn("rg", F.pmod(F.xxhash64("uid"), F.lit(spread)).cast("int")).repartition(spread, "rg")
    rows = rows.withColumn("dim", F.size("raw")).sortWithinPartitions("rg", "dim")
    rows = rows.select("uid", "id", "label", F.col("raw").cast("array<double>").alias("vector"), "rg", "dim")
    blocks = write_once(rows.mapInArrow(_pack_rows(anchor_every), _BLOCK_DDL), "blocks")
    anchor_bytes = F.col("n_anchors") * (F.col("dim") * COMPONENT_BYTES + ANCHOR_BYTES)
    n_anchors, n_bytes = blocks.agg(F.coalesce(F.sum("n_anchors"), F.lit(0)), F.coalesce(F.sum(anchor_bytes), F.lit(0))).first()
    groups = max(1, -(-n_anchors // (ANCHORS // 2)), -(-n_bytes // (BROADCAST_BYTES // 2)))
    group = F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int")
    anchors = blocks.where("n_anchors > 0").mapInArrow(_pick_anchors(anchor_every), _ROWS_DDL)
    anchors = anchors.withColumn("dim", F.size("vector")).withColumn("ag", group)
    near = _searched(blocks, anchors, groups, ["anchor"])
    scores = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))
    scores = scores.select(F.col("anchor").alias("uid"), F.col("s.score").alias("scores"))
    found = _searched(blocks, anchors.join(scores, "uid"), groups, ["anchor", "slot"])
    positives = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(positives, ["anchor", "slot"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: The query's rows on ``embeddings`` of one length with distinct ids.
ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
    CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 5
"""
