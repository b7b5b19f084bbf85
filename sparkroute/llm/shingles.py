"""Word shingles of whole texts as 64-bit hashes, computed on Arrow buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 300, dtype=np.uint64) | np.uint64(1)
_BYTE = _SEEDS[:256].copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_PLACE, _SHORT = _SEEDS[256:288], _SEEDS[288:]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        factor = _BASE if kind == "up" else np.uint64(pow(int(_BASE), -1, 1 << 64))
        steps = np.full(n, factor, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``column`` in pieces of whole texts: first row, byte offsets, bytes.

    A piece holds at most ``most`` bytes unless a single text is longer. Nulls count as empty.
    """
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    places = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(places, places[first] + most, "right")) - 1)
        last = min(last, n)
        yield first, places[first : last + 1] - places[first], data[places[first] : places[last]]
        first = last


def spans(offsets: np.ndarray, data: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are not ``blank`` and lie in one text."""
    solid = ~blank[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[1:-1]
    before[inner[inner < len(data)]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(data), bool)
    after[:-1] = solid[1:]
    after[-1:] = False
    after[inner[(inner > 0) & (inner <= len(data))] - 1] = False
    return starts, np.flatnonzero(solid & ~after) + 1


def words(offsets: np.ndarray, data: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, and the number of the text that it stands in."""
    starts, ends = spans(offsets, data, blank)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", max(len(data), 1))[starts]
    return mixed(hashes + (ends - starts).astype(np.uint64)), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(column: pa.Array, k: int = 4) -> Iterator[np.ndarray]:
    """For each text of ``column`` its sorted distinct ``k``-word shingles.

    Fewer than ``k`` words are one shingle together; no words, none.
    """
    for _, offsets, data in slices(column):
        hashes, owner = words(offsets, data)
        count = np.bincount(owner, minlength=len(offsets) - 1) if len(owner) else np.zeros(len(offsets) - 1, int)
        ends = np.cumsum(count)
        grams = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
        for i in range(k):
            grams += hashes[i : i + len(grams)] * _PLACE[i]
        grams = mixed(grams)
        for end, n in zip(ends.tolist(), count.tolist(), strict=True):
            if n >= k:
                yield np.unique(grams[end - n : end - k + 1])
            elif n:
                yield mixed((hashes[end - n : end] * _PLACE[:n]).sum(keepdims=True) + _SHORT[n])
            else:
                yield np.zeros(0, np.uint64)
