"""SentencePiece encoding and decoding with sampled segmentations.

Gumbel top-k without replacement: every segmentation of a text has its log probability plus a
Gumbel draw, and the k highest are the sample. They are found by a perturbed A-star search over
the lattice: a set of segmentations that share their first pieces has a perturbed maximum, drawn
below that of the set around it, and this maximum is the exact bound of the set. The search pops
the set of the highest bound, follows it down to its best segmentation, and puts back the sets
of the pieces not taken on the way. So the first k popped are the sample, and the bound of the
next gives the inclusion scores.

The bounds of all sets beside a path need only the path, so numpy handles the words of many
texts at once; no piece crosses a word border, so lattices are made once per distinct word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkroute.llm.common import python_workers
from sparkroute.llm.piece_lattice import FEW, LITERAL, MARK, Lattices, chunks, vocabulary
from sparkroute.llm.shingles import mixed, slices

SEED = 4
BATCH_BYTES = 1 << 20
WALK_STEPS = 4096
LOG_STEPS = float(1 << 28)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def uniform(key: np.ndarray, count: np.ndarray, purpose: int) -> np.ndarray:
    """Draws in (0, 1) that depend on key, count and purpose alone."""
    x = mixed(key + (count.astype(np.uint64) * np.uint64(8) + np.uint64(purpose + 1)) * _GOLDEN)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _below(location: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws around ``location``, none above ``top``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        out = location - np.log(np.exp(location - top) - np.log(u))
    return np.where(np.isfinite(location), np.minimum(out, top), -np.inf)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, in one array."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Paths:
    """One segmentation of each text: its steps, and the bounds of the sets beside them."""

    def __init__(self, state, choice, before, bound, used, offsets, score, top):
        self.state, self.choice = state, choice
        self.before, self.bound, self.used = before, bound, used
        self.offsets, self.score, self.top = offsets, score, top


class Search:
    """The texts of a batch and their lattices."""

    def __init__(self, path: str, texts: list[str], keys: np.ndarray):
        self.vocab = vocabulary(path)
        self.codes, starts, self.words = chunks(texts)
        self.lattices = Lattices(self.vocab, self.codes, starts)
        self.keys = mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(SEED))
        self.first_word = np.cumsum(self.words) - self.words

    def _round_keys(self, round_: int) -> np.ndarray:
        """Keys of the draws of a round. The purposes part the first two; each later round has keys of its own."""
        return self.keys if round_ < 2 else mixed(self.keys ^ np.uint64(round_))

    def _walk(self, states: np.ndarray, keys: np.ndarray, counts: np.ndarray, round_: int) -> tuple:
        """Sample pieces from each of ``states`` to the end of its word.

        Returns steps per walk, and of all steps, in order, state and choice.
        """
        lat = self.lattices
        word_end = lat.end[np.searchsorted(lat.end, states, "right")] if len(states) else states
        active, current, key, count = np.arange(len(states)), states, keys, counts
        steps = np.zeros(len(states), np.int64)
        took = []
        step = 0
        while len(active) > FEW:
            rest = uniform(key + np.uint64((step // 64) % 2**64), count * np.int64(64) + np.int64(step % 64), 4 + round_ % 4)
            choice = lat.first[current]
            rest -= lat.bar[choice]
            open_ = np.flatnonzero(rest >= 0)
            while len(open_):
                choice[open_] += 1
                rest[open_] -= lat.bar[choice[open_]]
                open_ = open_[rest[open_] >= 0]
            took.append((active, current, choice))
            steps[active] += 1
            current = current + lat.length[choice]
            go = np.flatnonzero(current < word_end)
            active, current, word_end, key, count = active[go], current[go], word_end[go], key[go], count[go]
            step += 1
        alone = [(int(w), step, *self._walk_one(*last, step, round_))
                 for w, *last in zip(active, current, word_end, key, count, strict=True)]
        for walk, _, st, _ in alone:
            steps[walk] += len(st)
        at = np.cumsum(steps) - steps
        state = np.empty(steps.sum(), np.int64)
        choice = np.empty(steps.sum(), np.int64)
        for s, (walk, st, ch) in enumerate(took):
            to = at[walk] + s
            state[to], choice[to] = st, ch
        for walk, s, st, ch in alone:
            to = slice(at[walk] + s, at[walk] + s + len(st))
            state[to], choice[to] = st, ch
        return steps, state, choice

    def _walk_one(self, state: int, word_end: int, key: np.uint64, count: int, step: int, round_: int) -> tuple:
        """The rest of one walk, in plain numbers: states and choices from ``step`` on."""
        lat = self.lattices
        first, bar, length = lat.first.item, lat.bar.item, lat.length.item
        state, word_end = int(state), int(word_end)
        states, choices = [], []
        while state < word_end:
            at = np.arange(step, step + min(word_end - state, WALK_STEPS))
            step += len(at)
            for rest in uniform(key + (at // 64).astype(np.uint64), count * np.int64(64) + at % 64, 4 + round_ % 4).tolist():
                choice = first(state)
                rest -= bar(choice)
                while rest >= 0:
                    choice += 1
                    rest -= bar(choice)
                states.append(state)
                choices.append(choice)
                state += length(choice)
                if state >= word_end:
                    break
        return np.array(states, np.int64), np.array(choices, np.int64)

    def _bounds(self, paths: Paths, fixed: np.ndarray, round_: int) -> None:
        """Draw the bounds of the sets beside the steps from ``fixed`` (a place per text) on."""
        n = np.diff(paths.offsets)
        chance = self.lattices.chance[paths.choice]
        log = np.round(self.lattices.log[paths.choice] * LOG_STEPS) / LOG_STEPS  # so sums are exact, whatever texts stand around
        total = np.concatenate([[0.0], np.cumsum(log)])
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(owner)) - paths.offsets[:-1][owner]
        paths.before = total[:-1] - total[paths.offsets[:-1]][owner]
        paths.score = total[paths.offsets[1:]] - total[paths.offsets[:-1]]
        with np.errstate(divide="ignore"):
            location = paths.before + np.log(np.maximum(1 - chance, 0))
        location[1 - chance < 1e-15] = -np.inf
        draw = _below(location, paths.top[owner], uniform(self._round_keys(round_)[owner], place, round_ % 4))
        paths.bound = np.where(place >= fixed[owner], draw, -np.inf)
        paths.used = np.left_shift(1, paths.choice - self.lattices.first[paths.state]).astype(np.int32)

    def first(self) -> Paths:
        """The segmentation of the highest perturbed probability of each text."""
        owner = np.repeat(np.arange(len(self.words)), self.words)
        start = self.lattices.start[self.lattices.type_of]
        count = np.arange(len(owner)) - self.first_word[owner]
        steps, state, choice = self._walk(start, self.keys[owner], count, 0)
        per_text = np.bincount(owner, steps, len(self.words)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per_text)])
        top = -np.log(-np.log(uniform(self.keys, np.zeros(len(self.keys), np.int64), 3)))
        paths = Paths(state, choice, None, None, None, offsets, None, top)
        self.step_word = [np.repeat(count, steps)]
        self._bounds(paths, np.zeros(len(self.words), np.int64), 0)
        return paths

    def next(self, found: list[Paths], alive: np.ndarray) -> tuple[Paths, np.ndarray]:
        """Pop the best set of each text: its best segmentation, and which texts had one."""
        lat, m = self.lattices, self.vocab.longest
        best = np.full((len(found), len(self.words)), -np.inf)
        place = np.zeros(best.shape, np.int64)
        for i, paths in enumerate(found):
            full = np.flatnonzero(np.diff(paths.offsets) > 0)
            if len(full):
                highest = np.maximum.reduceat(paths.bound, paths.offsets[full])
                best[i, full] = highest
                size = np.diff(paths.offsets)[full]
                owner = np.repeat(np.arange(len(full)), size)
                hits = np.flatnonzero(paths.bound == highest[owner])
                text, where = np.unique(owner[hits], return_index=True)
                place[i, full[text]] = hits[where]
        source = best.argmax(0)
        top = best.max(0)
        alive = alive & np.isfinite(top)
        texts = np.flatnonzero(alive)
        round_ = len(found)
        state_of, choice_of, word_of, size = (np.zeros(len(texts), np.int64) for _ in range(4))
        pieces = {}
        for i, paths in enumerate(found):
            mine = np.flatnonzero(source[texts] == i)
            if not len(mine):
                continue
            t = texts[mine]
            at = place[i, t]
            state = paths.state[at]
            local = np.arange(m)
            choices = np.minimum(lat.first[state][:, None] + local, len(lat.chance) - 1)
            free = (local < (lat.first[state + 1] - lat.first[state])[:, None]) & ((paths.used[at][:, None] >> local) & 1 == 0)
            chance = np.where(free, lat.chance[choices], 0.0)
            left = chance.sum(1)
            u = uniform(self._round_keys(round_)[t], at - paths.offsets[t], (round_ + 1) % 4) * left
            over = np.cumsum(chance, 1) > u[:, None]
            column = np.where(over.any(1), over.argmax(1), m - 1 - (chance[:, ::-1] > 0).argmax(1))
            rest = left - chance[np.arange(len(t)), column]
            with np.errstate(divide="ignore"):
                location = np.where(rest > 1e-15, paths.before[at] + np.log(np.maximum(rest, 1e-300)), -np.inf)
            paths.bound[at] = _below(location, top[t], uniform(self._round_keys(round_)[t] + np.uint64(99), at - paths.offsets[t], round_ % 4))
            paths.used[at] |= np.left_shift(1, column).astype(np.int32)
            size[mine] = at - paths.offsets[t]
            state_of[mine], choice_of[mine], word_of[mine] = state, lat.first[state] + column, self.step_word[i][at]
            pieces[i] = (mine, paths.offsets[t])
        # walk to the end of the word in which the paths part, then through the words after it
        follow = state_of + lat.length[choice_of]
        word = self.first_word[texts] + word_of
        inside = follow < lat.end[lat.type_of[word]] if len(texts) else np.zeros(0, bool)
        after = self.words[texts] - word_of - 1
        rest_words = _ranges(word + 1, after)
        owner = np.concatenate([np.flatnonzero(inside), np.repeat(np.arange(len(texts)), after)])
        count = np.concatenate([word_of[inside], rest_words - self.first_word[texts][owner[inside.sum():]]])
        starts = np.concatenate([follow[inside], lat.start[lat.type_of[rest_words]]])
        order = np.argsort(owner, kind="stable")
        owner, count, starts = owner[order], count[order], starts[order]
        steps, state, choice = self._walk(starts, self._round_keys(round_)[texts][owner] + (_GOLDEN if round_ == 1 else np.uint64(0)), count, round_)
        tail = np.bincount(owner, steps, len(texts)).astype(np.int64)
        length = np.zeros(len(self.words), np.int64)
        length[texts] = size + 1 + tail
        offsets = np.concatenate([[0], np.cumsum(length)])
        new = Paths(np.empty(offsets[-1], np.int64), np.empty(offsets[-1], np.int64), None, None, None, offsets, None, top)
        step_word = np.empty(offsets[-1], np.int64)
        base = offsets[texts]
        for i, (mine, begin) in pieces.items():
            to, source_at = _ranges(base[mine], size[mine]), _ranges(begin, size[mine])
            new.state[to], new.choice[to] = found[i].state[source_at], found[i].choice[source_at]
            step_word[to] = self.step_word[i][source_at]
        new.state[base + size], new.choice[base + size], step_word[base + size] = state_of, choice_of, word_of
        to = _ranges(base + size + 1, tail)
        new.state[to], new.choice[to], step_word[to] = state, choice, np.repeat(count, steps)
        self.step_word.append(step_word)
        fixed = np.zeros(len(self.words), np.int64)
        fixed[texts] = size + 1
        self._bounds(new, fixed, round_)
        return new, alive

    def ids(self, paths: Paths) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in one array, and the number of each."""
        found = self.lattices.piece[paths.choice]
        owner = np.repeat(np.arange(len(self.words)), np.diff(paths.offsets))
        spelt = np.flatnonzero(found < 0)
        if not len(spelt):
            return found, np.diff(paths.offsets)
        spelling = [self.vocab.byte_ids[list(_bytes_of(-2 - int(c)))] for c in found[spelt]]
        size = np.ones(len(found), np.int64)
        size[spelt] = [len(s) for s in spelling]
        out = np.repeat(found, size)
        start = np.cumsum(size) - size
        out[_ranges(start[spelt], size[spelt])] = np.concatenate(spelling)
        return out, np.bincount(owner, size, len(self.words)).astype(np.int64)


def _bytes_of(code: int) -> bytes:
    return chr(MARK if code == LITERAL else code).encode("utf-8", "surrogatepass")


def sampled(path: str, texts: list[str], keys: np.ndarray, k: int) -> Iterator[tuple]:
    """For each of up to ``k`` ranks: texts that have it, ids, sizes, log probabilities, inclusion.

    Yields per rank (alive, ids, sizes, log_prob, inclusion).
    """
    search = Search(path, texts, keys)
    found, alive = [search.first()], [np.ones(len(texts), bool)]
    while len(found) < k:
        paths, has = search.next(found, alive[-1] & (search.words > 0))
        found.append(paths)
        alive.append(has)
    limit = np.full(len(texts), -np.inf)
    for paths in found:
        full = np.flatnonzero(np.diff(paths.offsets) > 0)
        if len(full):
            limit[full] = np.maximum(limit[full], np.maximum.reduceat(paths.bound, paths.offsets[full]))
    for paths, has in zip(found, alive, strict=True):
        ids, sizes = search.ids(paths)
        with np.errstate(over="ignore"):
            inclusion = np.where(np.isfinite(limit), -np.expm1(-np.exp(paths.score - limit)), 1.0)
        yield has, ids, sizes, paths.score, inclusion


SAMPLES = "array<struct<ids:array<int>,log_prob:double,inclusion:double>>"


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", k: int = 2) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``samples`` and ``decoded`` (whether all give the text back).

    ``samples`` has up to ``k`` different segmentations of the whole text in the order of the
    search, each with its piece ids, log probability and inclusion score. ``model_path`` is read
    on the executors. Blanks, newlines and characters outside the vocabulary are kept exactly.

    Defined results: a null or empty text has one segmentation without pieces; a text with fewer
    than ``k`` segmentations gives all of them with inclusion 1; rows of equal id and text, null
    ids too, give equal samples; other columns are not read; an empty table gives no rows.
    """
    python_workers(docs.sparkSession)

    def run(batches):
        vocab = vocabulary(model_path)
        table = vocab.bytes
        for batch in batches:
            for first, offsets, _ in slices(batch.column(1), BATCH_BYTES):
                part = batch.slice(first, len(offsets) - 1)
                texts = [t or "" for t in part.column(1).to_pylist()]
                keys = np.array(part.column(2), np.int64)
                ranks, ok = [], np.ones(len(texts), bool)
                for has, ids, sizes, log_prob, inclusion in sampled(model_path, texts, keys, k):
                    ends = np.cumsum(sizes).tolist()
                    begin, flat = 0, ids.tolist()
                    for i, end in enumerate(ends):
                        if has[i]:
                            ok[i] &= b"".join(map(table.__getitem__, flat[begin:end]))[1:] == texts[i].encode("utf-8", "surrogatepass")
                        begin = end
                    ranks.append((has, ids, sizes, log_prob, inclusion))
                yield pa.RecordBatch.from_arrays([part.column(0), _structs(ranks), pa.array(ok)], [id_col, "samples", "decoded"])
                del ranks

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(F.col(f"`{id_col}`")).alias("key"))
    return rows.mapInArrow(run, f"`{id_col}` long, samples {SAMPLES}, decoded boolean")


def _structs(ranks: list[tuple]) -> pa.Array:
    """The samples of each text as a list of structs."""
    n = len(ranks[0][0])
    has = np.array([r[0] for r in ranks])  # rank by text
    # text-major order of the (text, rank) pairs that exist
    text, rank = np.nonzero(has.T)
    begin = np.array([np.cumsum(r[2]) - r[2] for r in ranks])
    shift = np.concatenate([[0], np.cumsum([len(r[1]) for r in ranks])])
    sizes = np.array([r[2] for r in ranks])[rank, text]
    flat = np.concatenate([r[1] for r in ranks]) if ranks else np.zeros(0, np.int32)
    ids = flat[_ranges(begin[rank, text] + shift[rank], sizes)].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))
    scores = pa.array(np.array([r[3] for r in ranks])[rank, text])
    inclusion = pa.array(np.array([r[4] for r in ranks])[rank, text])
    structs = pa.StructArray.from_arrays([lists, scores, inclusion], ["ids", "log_prob", "inclusion"])
    per_text = np.concatenate([[0], np.cumsum(has.sum(0))]).astype(np.int32)
    assert len(per_text) == n + 1
    return pa.ListArray.from_arrays(pa.array(per_text), structs)


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text that the piece ids of ``ids_col`` spell; null ids give null."""
    python_workers(rows.sparkSession)
    schema = StructType([*rows.schema.fields, StructField(out, StringType())])
    names = [*rows.columns, out]
    at = rows.columns.index(ids_col)

    def run(batches):
        table = vocabulary(model_path).bytes
        for batch in batches:
            texts = [
                None if ids is None else b"".join([table[i] for i in ids])[1:].decode("utf-8", "replace")
                for ids in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return rows.mapInArrow(run, schema)
