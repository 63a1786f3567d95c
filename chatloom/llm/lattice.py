"""Merge vocabularies as automata over prefixes, run on many words of one length at once.

A merge tokenizer (BPE) has one encoding for each prefix of a word, and that encoding is known from
its last token: token ``t`` ends prefix ``i`` if ``t`` fits behind the last token of prefix
``i - len(t)``, that is, if no merge of a better rank crosses the seam of the two. So a search over
positions that keeps, for each prefix, the best fitting token and a pointer back gives exactly the
merge encoding. Scores are 1 for a token that fits and 0 for one that does not, so the maximum is
unique.

Symbols are unsigned integers (bytes or code points). Symbols outside the vocabulary are tokens of
their own (-1) that nothing merges with.

Long words are cut into chunks that overlap, and the chunks are run together, each as if a word began
there. What holds at a prefix depends on the text and on the last tokens of as many prefixes before it as
the longest token has symbols. So once a chunk agrees with the states before it on that many prefixes in
a row, it is right from there on. A chunk that never agrees (a period out of step) is run again from the
states that are known; equal chunks with equal states before them are run once.
"""

import heapq

import numpy as np

from chatloom.llm.common import SortedKeys, mix64, ragged

BASE = np.uint64(0x9E3779B97F4A7C15)
#: Symbols that are advanced together.
CELLS = 1 << 16
#: Chunks of a long word that are run together, and that are remembered.
CHUNKS = 256


def merge_word(symbols: tuple, ranks) -> list[tuple]:
    """Plain merging of one word: best rank first, leftmost of equals. ``ranks(a, b)`` or None."""
    parts = [(s,) for s in symbols]
    if len(parts) < 2:
        return parts
    left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
    heap = []

    def offer(i):
        j = right[i]
        if j < len(parts) and (rank := ranks(parts[i], parts[j])) is not None:
            heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if parts[i] is not a or j >= len(parts) or parts[j] is not b:
            continue
        parts[i], parts[j] = a + b, None
        right[i] = right[j]
        if right[j] < len(parts):
            left[right[j]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    return [p for p in parts if p is not None]


def _first_run(same: np.ndarray, size: int) -> int:
    """How far the first ``size`` true values in a row reach; -1 if there are none."""
    if len(same) < size:
        return -1
    wrong = np.concatenate(([0], np.cumsum(~same)))
    found = np.flatnonzero(wrong[size:] == wrong[:-size])
    return int(found[0]) + size if len(found) else -1


class Lattice:
    """``tokens``: symbol tuples by ascending rank, single symbols first; ``pairs``: (left, right,
    joined) indices of every allowed merge; ``halves``: the two tokens that a token's last merge
    joined (itself twice for a single symbol); ``ids``: what to return for each token; ``ranks``: of each
    token, where several may have the same, so that the leftmost merge comes first."""

    def __init__(
        self, tokens: list[tuple], pairs: np.ndarray, halves: np.ndarray, ids: np.ndarray, ranks: np.ndarray | None = None
    ):
        self.ids = ids
        self.ranks = np.arange(len(tokens)) if ranks is None else ranks.astype(np.int64)
        self.left, self.right = halves[:, 0].astype(np.int64), halves[:, 1].astype(np.int64)
        self.seams = SortedKeys(self._seam(pairs[:, 0].astype(np.int64), pairs[:, 1].astype(np.int64)))
        self.joined = self.ranks[pairs[:, 2]]
        self.longest = max(map(len, tokens))
        # New symbols of a chunk, and those it shares with the one before; a power of two keeps step with most periods.
        self.stride = max(256, 1 << (2 * self.longest - 1).bit_length())
        self.powers = np.ones(self.longest + 1, np.uint64)
        self.powers[1:] = np.cumprod(np.full(self.longest, BASE))
        sizes = np.array([len(t) for t in tokens])
        keys = np.zeros(len(tokens), np.uint64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            symbols = np.array([tokens[r] for r in rows], np.uint64)
            keys[rows] = self._keys(self._prefix(symbols)[:, -1], size)
        self.pieces = SortedKeys(keys)
        self.lengths = np.unique(sizes)

    @staticmethod
    def _prefix(symbols: np.ndarray) -> np.ndarray:
        """Rolling hash of each prefix of each row."""
        out = np.zeros((len(symbols), symbols.shape[1] + 1), np.uint64)
        spread = mix64(symbols.astype(np.uint64) + np.uint64(1))
        for i in range(symbols.shape[1]):
            out[:, i + 1] = out[:, i] * BASE + spread[:, i]
        return out

    @staticmethod
    def _keys(hashes, size):
        return mix64(hashes + mix64(np.atleast_1d(size).astype(np.uint64)))

    @staticmethod
    def _seam(first, second):
        return mix64((first << 32 | second).astype(np.uint64))

    def fits(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging ``first`` and ``second`` side by side leaves both as they are.

        Merges are taken back from the latest to the earliest; at each step the two tokens at the
        seam must not be ones that would have merged before the merge taken back.
        """
        out = np.ones(len(first), bool)
        live = np.flatnonzero((first >= 0) & (second >= 0))
        a, b = first[live].astype(np.int64), second[live].astype(np.int64)
        # A merge across the seam comes first if its rank is below this bound.
        bound = np.full(len(live), np.iinfo(np.int64).max)
        while len(live):
            at = self.seams.find(self._seam(a, b))
            bad = (at >= 0) & (self.joined[at] < bound)
            out[live[bad]] = False
            whole_a, whole_b = self.left[a] == a, self.left[b] == b
            more = ~bad & ~(whole_a & whole_b)
            live, a, b, bound = live[more], a[more], b[more], bound[more]
            whole_a, whole_b = whole_a[more], whole_b[more]
            # The later merge has the greater rank; of equal ones the right one came later.
            rank_a, rank_b = self.ranks[a], self.ranks[b]
            take_a = ~whole_a & (whole_b | (rank_a > rank_b))
            bound = np.where(take_a, rank_a, rank_b + 1)
            a, b = np.where(take_a, self.right[a], a), np.where(take_a, b, self.left[b])
        return out

    def _states(self, symbols: np.ndarray, lead: np.ndarray | None = None):
        """For each prefix of each row its last token, where that starts, and the number of tokens.

        ``lead``: the last tokens of the first prefixes, at least ``longest``, of rows that go on inside a word.
        """
        n, size = symbols.shape
        prefix = self._prefix(symbols)
        last = np.full((n, size + 1), -1, np.int32)
        back = np.zeros((n, size + 1), np.int32)
        count = np.zeros((n, size + 1), np.int32)
        known_before = 0 if lead is None else lead.shape[1]
        if known_before:
            last[:, 1 : known_before + 1] = lead
        row = np.arange(n)
        for i in range(known_before + 1, size + 1):
            lengths = self.lengths[self.lengths <= i]
            if not len(lengths) or lengths[0] != 1:
                lengths = np.concatenate(([1], lengths))
            starts = i - lengths
            hashes = prefix[:, i, None] - prefix[:, starts] * self.powers[lengths]
            token = self.pieces.find(self._keys(hashes, lengths))
            rows, cols = np.nonzero(token >= 0)
            before = np.where(starts[cols] > 0, last[rows, starts[cols]], -1)
            score = np.zeros(token.shape, np.int8)
            score[rows, cols] = self.fits(before, token[rows, cols])
            best = score.argmax(axis=1)
            # Without any fitting token the symbol is not in the vocabulary: column 0 is itself.
            known = score[row, best] > 0
            best = np.where(known, best, 0)
            last[:, i] = np.where(known, token[row, best], -1)
            back[:, i] = starts[best]
            count[:, i] = count[row, starts[best]] + 1
        return last, back, count

    def run(self, symbols: np.ndarray, counts_only: bool = False):
        """``symbols``: words of one length, a row each. Tokens row by row and how many each row has."""
        n, size = symbols.shape
        last, back, count = self._states(symbols)
        total = count[:, size]
        if counts_only:
            return None, total
        flat = np.full(int(total.sum()), -1, np.int64)
        place = np.cumsum(total) - 1
        at, rows = np.full(n, size), np.arange(n)
        while len(rows):
            flat[place[rows]] = last[rows, at[rows]]
            place[rows] -= 1
            at[rows] = back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        return flat, total

    def run_long(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens of one word of any length."""
        n, stride, need = len(symbols), self.stride, self.longest
        last, length = np.full(n + 1, -1, np.int32), np.zeros(n + 1, np.int32)
        again: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]] = {}
        firsts = np.arange(0, n, stride)
        done = 0
        for block in range(0, len(firsts), CHUNKS):
            begins = firsts[block : block + CHUNKS]
            # What is missing behind the end of the word is filled up and not read.
            place = begins[:, None] + np.arange(2 * stride)
            chunks, row = np.unique(symbols[np.minimum(place, n - 1)], axis=0, return_inverse=True)
            fresh, back, _ = self._states(chunks)
            taken = np.arange(2 * stride + 1) - back
            for begin, k in zip(begins.tolist(), row.ravel().tolist()):
                end = min(begin + 2 * stride, n)
                if end == done:
                    continue
                states, sizes, right = fresh[k], taken[k], 0
                if begin:
                    same = states[1 : done - begin + 1] == last[begin + 1 : done + 1]
                    right = _first_run(same, need)
                    if right < 0:
                        lead = last[done - need + 1 : done + 1]
                        held = symbols[done - need : end]
                        key = (held.tobytes(), lead.tobytes())
                        if key not in again:
                            if len(again) >= CHUNKS:
                                again.clear()
                            tokens, start, _ = self._states(held[None], lead[None])
                            again[key] = tokens[0], np.arange(len(held) + 1) - start[0]
                        states, sizes = again[key]
                        begin, right = done - need, need
                last[begin + right + 1 : end + 1] = states[right + 1 : end - begin + 1]
                length[begin + right + 1 : end + 1] = sizes[right + 1 : end - begin + 1]
                done = end
        steps, ends, at = length.tolist(), [], n
        while at:
            ends.append(at)
            at -= steps[at]
        return last[ends[::-1]].astype(np.int64)

    def encode(self, symbols: np.ndarray, offsets: np.ndarray, counts_only: bool = False):
        """Tokens (indices, -1: no token) of each run of ``symbols`` and their offsets."""
        sizes = np.diff(offsets)
        counts = np.zeros(len(sizes), np.int64)
        order = np.argsort(sizes, kind="stable")
        edges = np.searchsorted(sizes[order], np.unique(sizes[sizes > 0]), "left")
        parts = []
        for lo, hi in zip(edges, [*edges[1:], len(order)]):
            size = int(sizes[order[lo]])
            if size > 4 * self.stride:
                for row in order[lo:hi]:
                    flat = self.run_long(symbols[offsets[row] : offsets[row + 1]])
                    counts[row] = len(flat)
                    if not counts_only:
                        parts.append((np.array([row]), flat))
                continue
            step = max(1, CELLS // size)
            for at in range(lo, hi, step):
                rows = order[at : min(at + step, hi)]
                words = symbols[offsets[rows][:, None] + np.arange(size)]
                flat, counts[rows] = self.run(words, counts_only)
                parts.append((rows, flat))
        ends = np.concatenate(([0], np.cumsum(counts)))
        if counts_only:
            return None, ends
        out = np.full(int(ends[-1]), -1, np.int64)
        for rows, flat in parts:
            out[ragged(ends[rows], counts[rows])] = flat
        return out, ends
