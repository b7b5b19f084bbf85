"""Quality classifier: ridge regression on random Fourier features of document statistics.

Statistics of a text are standardised and mapped to random cosines, whose inner products
approximate a Gaussian kernel. Each partition sums its share of the normal equations; the summed
equations are solved for ridge scores, and isotonic regression turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sparkroute.llm.common import fresh, python_workers, sent_to_all, write_once
from sparkroute.llm.shingles import mixed, slices, spans, words

FOLDS = 5
MAX_LABELS = 200_000
N_COSINES = 256
WIDTH = 3.0
RIDGE = 1e-3
SEED = 6
SCORE_BINS = 1024
KEEP_FROM = 0.3
TRAIN_PARTITIONS = 16

_CLASSES = ["a-z", "A-Z", "0-9", "blank", ".,;:'\"?()-", "!", "|<>#*$%&{}[]/=_+~^\\@`", "bytes from 128"]
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _class_table() -> np.ndarray:
    table = np.full(256, 6, np.uint8)
    table[97:123], table[65:91], table[48:58], table[128:] = 0, 1, 2, 7
    table[[9, 10, 11, 12, 13, 32]] = 3
    table[[ord(c) for c in _CLASSES[4]]] = 4
    table[ord("!")] = 5
    return table


_CLASS = _class_table()
N_STATISTICS = 21


def statistics(column: pa.Array) -> Iterator[np.ndarray]:
    """A matrix of ``N_STATISTICS`` columns for each piece of ``column``; zeros for empty texts."""
    for _, offsets, data in slices(column):
        n = len(offsets) - 1
        size = np.diff(offsets).astype(float)
        out = np.zeros((n, N_STATISTICS))
        kinds = _CLASS[data]
        for c in range(len(_CLASSES)):
            sums = np.concatenate([[0], np.cumsum(kinds == c)])
            out[:, c] = np.sqrt(np.diff(sums[offsets]) / np.maximum(size, 1))
        starts, ends = spans(offsets, data)
        hashes, owner = words(offsets, data)
        lengths = (ends - starts).astype(float)
        count = np.bincount(owner, minlength=n).astype(float)
        most = np.maximum(count, 1)
        mean = np.bincount(owner, lengths, n) / most
        lines, line_owner = words(offsets, data, _NEWLINE)
        line_count = np.bincount(line_owner, minlength=n)
        pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:]) if len(hashes) else hashes
        at = np.concatenate([[0], np.cumsum(count)]).astype(int)
        line_at = np.concatenate([[0], np.cumsum(line_count)]).astype(int)
        distinct = np.zeros((n, 4))
        for i in range(n):
            a, b = at[i], at[i + 1]
            if b > a:
                _, times = np.unique(hashes[a:b], return_counts=True)
                distinct[i, 0] = len(times) / (b - a)
                distinct[i, 1] = times.max() / (b - a)
                distinct[i, 2] = len(np.unique(pairs[a : b - 1])) / max(b - a - 1, 1)
                distinct[i, 3] = len(np.unique(lines[line_at[i] : line_at[i + 1]])) / max(line_at[i + 1] - line_at[i], 1)
        out[:, 8:12] = distinct
        out[:, 12] = np.log1p(size)
        out[:, 13] = np.log1p(count)
        out[:, 14] = mean
        out[:, 15] = np.sqrt(np.maximum(np.bincount(owner, lengths**2, n) / most - mean**2, 0))
        out[:, 16] = np.log1p(line_count)
        out[:, 17] = np.log1p(size / np.maximum(line_count, 1))
        out[:, 18] = np.bincount(owner, lengths <= 2, n) / most
        out[:, 19] = np.bincount(owner, lengths >= 16, n) / most
        out[:, 20] = np.log1p(most / np.maximum(line_count, 1))
        yield out


class Model:
    """Standardisation, random cosines, ridge weights and calibration; a few kilobytes."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.waves = rng.normal(size=(N_STATISTICS, N_COSINES)) / WIDTH
        self.phases = rng.uniform(0, 2 * np.pi, N_COSINES)
        self.weights = np.zeros(1 + N_STATISTICS + N_COSINES)
        self.steps, self.values = np.zeros(1), np.full(1, 0.5)

    def mapped(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.waves + self.phases) * np.sqrt(2 / N_COSINES)
        return np.hstack([np.ones((len(x), 1)), z, waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.mapped(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a trace of the raw score keeps order inside a level step."""
        raw = self.raw(x)
        level = np.interp(raw, self.steps, self.values)
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-np.clip(4 * (raw - 0.5), -30, 30))), 0, 1)


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Least-squares nondecreasing fit of ``values``: adjacent violators are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _summed(train: DataFrame, function, n_columns: int) -> np.ndarray:
    """Sum over partitions of the matrix that ``function`` makes of (statistics, label)."""

    def part(batches):
        total = None
        for batch in batches:
            x = np.array(batch.column(0).flatten()).reshape(-1, N_STATISTICS)
            got = function(x, np.array(batch.column(1), dtype=float))
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    rows = train.mapInArrow(part, "m binary").collect()
    return sum((np.frombuffer(r[0]).reshape(-1, n_columns) for r in rows), np.zeros((1, n_columns)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labels: int = MAX_LABELS) -> Model:
    """A model of ``labels``, read only where crc32 of the id's text is not divisible by 5.

    At most about ``max_labels`` rows are read, chosen by a hash of the id; of them the ones with
    remainder 1 calibrate and the others fit. All sums are made in the partitions; the driver
    adds at most ``TRAIN_PARTITIONS`` small matrices.
    """
    python_workers(docs.sparkSession)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "id is not null and label in (0, 1)").withColumn("fold", _fold("id")).where("fold <> 0")
    n = usable.count()
    if n > max_labels:
        usable = usable.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int((1 << 30) * max_labels / n))
    usable = usable.groupBy("id", "fold").agg(F.max("label").alias("label"))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        sent_to_all(usable, row_bytes=32), "id")

    def measured(batches):
        for batch in batches:
            parts = list(statistics(batch.column(0)))
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
            size = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * N_STATISTICS)
            x = pa.ListArray.from_arrays(size, pa.array(flat))
            yield pa.RecordBatch.from_arrays([x, batch.column(1), batch.column(2)], ["x", "label", "fold"])

    rows = write_once(found.select("text", "label", "fold").mapInArrow(measured, "x array<double>, label int, fold long"), "labelled")
    rows = rows.coalesce(TRAIN_PARTITIONS)
    train = rows.where("fold <> 1").select("x", "label")

    moments = _summed(train, lambda x, y: np.vstack([np.full(N_STATISTICS, len(x)), x.sum(0), (x**2).sum(0)]), N_STATISTICS)
    if len(moments) < 3 or not moments[0, 0]:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS))
    mean = moments[1] / moments[0]
    scale = np.sqrt(np.maximum(moments[2] / moments[0] - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))
    width = len(model.weights)

    def equations(x, y):
        z = model.mapped(x)
        return np.vstack([z.T @ z, (z.T @ y)[None]])

    sums = _summed(train, equations, width)
    penalty = np.eye(width) * RIDGE * moments[0, 0]
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(sums[:width] + penalty, sums[width])

    def binned(x, y):
        at = np.clip((model.raw(x) + 0.5) * SCORE_BINS / 2, 0, SCORE_BINS - 1).astype(int)
        raw = model.raw(x)
        return np.vstack([np.bincount(at, v, SCORE_BINS) for v in (np.ones(len(x)), raw, y)])

    # one label of each kind at the mean keeps a step from being surer than its rows allow
    bins = _summed(rows.where("fold = 1").select("x", "label"), binned, SCORE_BINS)
    if len(bins) == 3 and bins[0].sum():
        use = bins[0] > 0
        share = bins[2].sum() / bins[0].sum()
        level = pooled(bins[2][use] / bins[0][use], bins[0][use])
        weight = np.array([bins[0][use][level == v].sum() for v in level])
        model.steps = bins[1][use] / bins[0][use]
        model.values = (level * weight + share) / (weight + 1)
        model.values = np.maximum.accumulate(model.values)
    else:
        model.steps, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def _fold(name: str):
    return F.crc32(F.col(f"`{name}`").cast("string").cast("binary")) % FOLDS


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (its columns ``keep`` if given) with a double column of scores, and its name.

    Every whole text is scored where it is read; nothing is shuffled. Defined results: a null
    text is scored as empty; repeated rows get equal scores; an empty table stays empty.
    """
    python_workers(docs.sparkSession)
    kept = keep or docs.columns
    name = fresh(docs, "score")
    text_at = len(kept)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias(fresh(docs, "scored_text")))
    schema = rows.schema
    out = StructType([*schema.fields[:text_at], StructField(name, DoubleType())])

    def scored(batches):
        for batch in batches:
            parts = [model.score(x) for x in statistics(batch.column(text_at))]
            column = pa.array(np.concatenate(parts) if parts else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:text_at], column], [*kept, name])

    return rows.mapInArrow(scored, out), name
