"""A SentencePiece vocabulary and the lattices of word types over it, as numpy arrays."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import sentencepiece

from sparkroute.llm.shingles import _power, mixed

MARK = 0x2581  # stands for a blank in pieces
LITERAL = 0x110000  # the mark itself in a text
NEWLINE = 10
RANK_SHIFT, ALPHA = 10.0, 0.5
FEW = 4  # up to so many rows plain numbers are faster than arrays
BLOCK = 1 << 16


class Vocabulary:
    """Pieces of a model file with sampling weights.

    A unigram model has log probabilities. A BPE model has only the ranks of its merges; there
    the weight of a piece is (rank + 10) ** -0.5, a flattened Zipf law.
    """

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        scores = np.array([sp.get_score(i) for i in range(n)])
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        self.bytes: list[bytes] = [b""] * n
        plain = {}
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain[piece] = i
                self.bytes[i] = piece.replace(chr(MARK), " ").encode()
        if any(chr(MARK) in p.lstrip(chr(MARK)) or (len(p) > 1 and "\n" in p) for p in plain):
            raise ValueError("pieces cross word borders")
        self.longest = max(map(len, plain))
        ids = np.array(list(plain.values()))
        ranked = np.all(scores[ids] == np.round(scores[ids]))
        rank = np.where(scores > -n - 1, -scores, n)
        weight = (rank + RANK_SHIFT) ** -ALPHA if ranked else np.exp(scores)
        self.byte_weight = (n + RANK_SHIFT) ** -ALPHA if ranked else float(np.exp(scores[ids].min() - 10))
        self._table(plain, weight)

    def _table(self, plain: dict[str, int], weight: np.ndarray) -> None:
        """Hashes of all beginnings of pieces, sorted; which are pieces, and whether more follows."""
        starts: dict[str, list] = {}
        for piece, i in plain.items():
            for k in range(1, len(piece)):
                starts.setdefault(piece[:k], [-1, False])[1] = True
            starts.setdefault(piece, [-1, False])[0] = i
        names = list(starts)
        hashes = np.array([_hash_of(np.array([ord(c) for c in x], np.uint64)) for x in names], np.uint64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces share a hash")
        self.bits = 21
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, slot = hashes[order], slot[order]
        self.ids = np.array([starts[names[i]][0] for i in order], np.int32)
        self.more = np.array([starts[names[i]][1] for i in order])
        self.first = np.searchsorted(slot, np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.weight = weight

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the table, or -1."""
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(hashes), -1, np.int32)
        todo = np.flatnonzero(at < end)
        while len(todo):
            hit = self.hashes[at[todo]] == hashes[todo]
            out[todo[hit]] = at[todo[hit]]
            at[todo] += 1
            todo = todo[~hit & (at[todo] < end[todo])]
        return out


_CHARS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 1 << 12, dtype=np.uint64) | np.uint64(1)


def _char_values(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.int64)
    return _CHARS[codes & 4095] + (codes >> 12).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def _prefix_sums(codes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_char_values(codes) * _power("up", max(len(codes), 1))[: len(codes)], out=sums[1:])
    return sums


def _hash_of(codes: np.ndarray) -> int:
    return int(mixed(_prefix_sums(codes)[-1:] + np.uint64(len(codes)))[0])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def chunks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of ``texts`` as SentencePiece sees them, starts of the words, words per text.

    Every text that is not empty gets a leading blank; words start with their blanks, and a
    newline is a word.
    """
    joined = "".join(" " + t if t else "" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes == MARK, LITERAL, np.where(codes == 32, MARK, codes)).astype(np.uint32)
    ends = np.cumsum([len(t) + 1 if t else 0 for t in texts])
    starts = np.zeros(len(codes) + 1, bool)
    if len(codes):
        mark, line = codes == MARK, codes == NEWLINE
        starts[:-1] = line
        starts[1:-1] |= (mark[1:] & ~mark[:-1]) | line[:-1]
        starts[0] = True
        starts[ends[ends < len(codes)]] = True
    starts = np.flatnonzero(starts[:-1])
    return codes, starts, np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))


class Lattices:
    """All segmentations of the distinct words of a batch.

    A state is a code point of a distinct word; the choices of state s are the pieces that may
    be taken there, ``first[s]`` to ``first[s + 1]``, long ones first. ``chance`` is a choice's
    probability, given that the whole word is segmented with a probability proportional to the
    product of its pieces' weights; ``log`` is its logarithm; ``length`` counts its code points and ``piece`` is its id
    (below -1: -2 minus a code point that is spelt in byte pieces). In ``bar`` the last choice
    of a state is 2, which no draw passes.
    """

    def __init__(self, vocab: Vocabulary, codes: np.ndarray, starts: np.ndarray):
        self.vocab = vocab
        ends = np.append(starts[1:], len(codes))
        sums = _prefix_sums(codes)
        down = _power("down", max(len(codes), 1))
        whole = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        _, first, self.type_of = np.unique(whole, return_index=True, return_inverse=True)
        size = (ends - starts)[first]
        order = np.argsort(-size, kind="stable")  # long words first, so the open ones are always the leading ones
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.type_of = place[self.type_of]
        size, first = size[order], first[order]
        self.end = np.cumsum(size)
        self.start = self.end - size
        pick = np.repeat(starts[first] - self.start, size) + np.arange(size.sum())
        self.codes = codes[pick]
        log_weight = self._edges()
        self._chances(size, log_weight)
        self.bar = self.chance.copy()
        self.bar[self.first[1:] - 1] = 2.0

    def _edges(self) -> np.ndarray:
        """Set ``first``, ``piece`` and ``length`` of the choices; returns the logarithms of their weights."""
        vocab, n, m = self.vocab, len(self.codes), self.vocab.longest
        sums = _prefix_sums(self.codes)
        down = _power("down", max(n, 1))
        at = np.arange(n)
        room = np.repeat(self.end, self.end - self.start) - at
        log_weight = np.log(vocab.weight)
        edges = []
        counts = np.ones(n, np.int64)  # one code point is always a choice
        for k in range(1, m + 1):
            found = vocab.find(mixed((sums[at + k] - sums[at]) * down[at] + np.uint64(k)))
            if k == 1:
                ids = np.where(found >= 0, vocab.ids[found], -1)
                lone = np.flatnonzero(ids < 0)
                code = self.codes[lone].astype(np.int64)
                n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + ((code >= 0x10000) & (code < LITERAL))
                weights = log_weight[ids]
                weights[lone] = np.log(vocab.byte_weight) * np.where(code == LITERAL, 3, n_bytes)
                ids[lone] = -2 - code
                edges.append((at, ids, weights))
                at, found = at[found >= 0], found[found >= 0]
            else:
                at, found = at[found >= 0], found[found >= 0]
                ids = vocab.ids[found]
                whole = ids >= 0
                edges.append((at[whole], ids[whole], log_weight[ids[whole]]))
                counts[edges[-1][0]] += 1
            at = at[vocab.more[found] & (room[at] > k)]
        self.first = np.concatenate([[0], np.cumsum(counts)])
        total = int(self.first[-1])
        self.piece, self.length, out = np.empty(total, np.int32), np.empty(total, np.int8), np.empty(total)
        free = self.first[:-1].copy()
        for k in range(m, 0, -1):
            at, ids, weights = edges.pop()
            to = free[at]
            self.piece[to], self.length[to], out[to] = ids, k, weights
            free[at] += 1
        return out

    def _chances(self, size: np.ndarray, log_weight: np.ndarray) -> None:
        """Set ``log`` and ``chance`` by backward sums, level by level from the words' ends.

        Level d has the states d code points before an end, longest word first. The sums are kept as logarithms.
        """
        n, m = len(self.codes), self.vocab.longest
        deepest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(1, deepest + 1), "right")
        base = np.concatenate([[0], np.cumsum(active)])
        word = np.repeat(np.arange(len(size)), size)
        rank = base[self.end[word] - np.arange(n) - 1] + word
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        counts = np.diff(self.first)
        begin = np.concatenate([[0], np.cumsum(counts[order])])
        pick = np.repeat(self.first[order] - begin[:-1], counts[order]) + np.arange(begin[-1])
        state = np.repeat(np.arange(n), counts)
        after = state + self.length
        follow = np.where(after == self.end[word[state]], n, rank[np.minimum(after, max(n - 1, 0))])
        w, x = log_weight[pick], follow[pick]
        total = np.zeros(n + 1)  # by level; the last entry is a word's end
        level = 0
        while level < deepest and active[level] > FEW:
            low, high = base[level], base[level + 1]
            here = slice(begin[low], begin[high])
            t = w[here] + total[x[here]]
            at = begin[low:high] - begin[low]
            top = np.maximum.reduceat(t, at)
            t -= np.repeat(top, np.diff(begin[low : high + 1]))
            total[low:high] = top + np.log(np.add.reduceat(np.exp(t), at))
            level += 1
        if level < deepest:
            self._few(total, w, x, begin, int(base[level]), int(base[max(level - m, 0)]), n)
        del w, x, pick
        self.log = log_weight + total[follow] - total[rank[state]]
        self.chance = np.exp(self.log)

    def _few(self, total: np.ndarray, w: np.ndarray, x: np.ndarray, begin: np.ndarray, low: int, known: int, n: int) -> None:
        """The sums of the levels with few states, from state ``low`` on; those back to ``known`` are needed."""
        exp, log = math.exp, math.log
        while low < n:
            high = min(low + BLOCK, n)
            first = int(begin[low])
            weights, follow = w[first : begin[high]].tolist(), x[first : begin[high]].tolist()
            ends = (begin[low + 1 : high + 1] - first).tolist()
            sums = total[known:low].tolist()
            i = 0
            for end in ends:
                terms = []
                while i < end:
                    to = follow[i]
                    terms.append(weights[i] if to == n else weights[i] + sums[to - known])
                    i += 1
                if len(terms) == 1:
                    sums.append(terms[0])
                else:
                    top = max(terms)
                    sums.append(top + log(sum([exp(t - top) for t in terms])))
            total[low:high] = sums[low - known :]
            known, low = max(known, high - FEW * (self.vocab.longest + 1)), high
