"""Bidirectional FM-index over a delimited vocabulary, and a one-error search scheme, in numpy.

The text is cyclic: every word is preceded by one delimiter and followed by the
next word's.  Two rank structures are held, of the text and of its reversal;
an interval of suffix ranks is kept for both, so a pattern grows to the left
or to the right by one character at the cost of two rank look-ups.  All
queries of one length move through the index together.
"""

from __future__ import annotations

import numpy as np

BLOCK = 32            # characters between two rows of a rank table
WIDE = 48             # intervals up to this width list their next characters instead of trying all
QUERIES = 4096        # queries that move together: bounds the states in memory


def _rotation_order(codes: np.ndarray, sigma: int) -> np.ndarray:
    """Starts of the rotations of a text in sorted order (prefix doubling; no two rotations are equal)."""
    n = len(codes)
    k = max(1, 62 // max(1, int(sigma).bit_length()))
    key = np.zeros(n, np.int64)
    for j in range(k):
        key = key * sigma + np.roll(codes, -j)
    _, rank = np.unique(key, return_inverse=True)
    while rank.max() + 1 < n:
        _, rank = np.unique(rank.astype(np.int64) * n + np.roll(rank, -k), return_inverse=True)
        k *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


class Ranks:
    """Rotation order of one direction with counts of characters before any place of the last column."""

    def __init__(self, codes: np.ndarray, sigma: int):
        n = len(codes)
        self.order = _rotation_order(codes, sigma)
        last = codes[self.order - 1]
        rows = n // BLOCK + 1
        counts = np.bincount(np.arange(n) // BLOCK * sigma + last, minlength=rows * sigma).reshape(rows, sigma)
        before = np.zeros((rows, sigma), np.int64)
        np.cumsum(counts[:-1], axis=0, out=before[1:])
        self.below = np.zeros((rows, sigma + 1), np.int32)      # characters smaller than c before the block
        np.cumsum(before, axis=1, out=self.below[:, 1:])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(last, minlength=sigma))])
        self.last = np.concatenate([last, np.full(BLOCK, sigma)]).astype(np.int32)

    def counts(self, c: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(characters smaller than c, characters equal to c) among the first i of the last column."""
        row, rest = np.divmod(i, BLOCK)
        seen = self.last[(row * BLOCK)[:, None] + np.arange(BLOCK)]
        seen[np.arange(BLOCK) >= rest[:, None]] = -1
        less = self.below[row, c]
        equal = self.below[row, c + 1] - less
        return less + ((seen < c[:, None]) & (seen >= 0)).sum(1), equal + (seen == c[:, None]).sum(1)

    def step(self, c: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One backward step by c: new low, new width, and how many rotations of the interval had a smaller character."""
        less_a, equal_a = self.counts(c, low)
        less_b, equal_b = self.counts(c, low + width)
        return self.first[c] + equal_a, equal_b - equal_a, less_b - less_a


class BiIndex:
    """Index of distinct words (at least one; none holds the delimiter ``\\0``)."""

    def __init__(self, words: list[str]):
        text = np.frombuffer(("\0" + "\0".join(words)).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(text, return_inverse=True)
        self.sigma, self.n = len(self.alphabet), len(text)
        self.left = Ranks(codes, self.sigma)
        self.right = Ranks(codes[::-1], self.sigma)
        self.ordinal = np.cumsum(codes == 0) - 1            # delimiter -> word behind it
        self.words = len(words)

    def codes(self, words: list[str], length: int) -> np.ndarray:
        """(words, length) codes; characters that the index does not hold are -1."""
        raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)
        at = np.minimum(np.searchsorted(self.alphabet, raw), self.sigma - 1)
        return np.where(self.alphabet[at] == raw, at, -1)

    def _exact(self, c, low, width):
        """Rightward step by c of every state: (states that live on, their low, their width)."""
        live = np.flatnonzero(c >= 0)
        low, width, _ = self.right.step(c[live], low[live], width[live])
        some = width > 0
        return live[some], low[some], width[some]

    def _others(self, c, low, width):
        """Rightward steps by every character but c and the delimiter: (state, low, width)."""
        narrow = np.flatnonzero(width <= WIDE)
        size = width[narrow]
        state = np.repeat(narrow, size)
        offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pairs = np.unique(state * self.sigma + self.right.last[low[state] + offset])
        wide = np.flatnonzero(width > WIDE)
        pairs = np.concatenate([pairs, (wide[:, None] * self.sigma + np.arange(self.sigma)).ravel()])
        state, char = np.divmod(pairs, self.sigma)
        keep = (char != 0) & (char != c[state])
        state, char = state[keep], char[keep]
        low, width, _ = self.right.step(char, low[state], width[state])
        some = width > 0
        return state[some], low[some], width[some]

    def half_exact(self, queries: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word): words that begin with the query's first ``half`` characters and differ from the
        query by exactly one replaced or inserted character behind them.  Each word is found once a query."""
        found = [self._half_exact(queries[i:i + QUERIES], half, i) for i in range(0, len(queries), QUERIES)]
        return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])

    def _half_exact(self, queries, half, base):
        m = queries.shape[1]
        q = np.arange(len(queries))
        low, mirror, width = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.n)
        for j in range(half - 1, -2, -1):                   # the half from its last character, then the delimiter
            c = queries[q, j] if j >= 0 else np.zeros(len(q), np.int64)
            q, low, mirror, width, c = (x[c >= 0] for x in (q, low, mirror, width, c))
            low, width, less = self.left.step(c, low, width)
            mirror = mirror + less
            q, low, mirror, width = (x[width > 0] for x in (q, low, mirror, width))
        one = [[] for _ in range(m + 1)]                    # states with the error behind them, by place
        for j in range(half, m + 1):
            c = queries[q, j] if j < m else np.full(len(q), -1)
            s, a, w = self._others(c, mirror, width)
            one[j].append((q[s], a, w))                     # a character more than the query
            if j < m:
                one[j + 1].append((q[s], a, w))             # another character
                live, mirror, width = self._exact(c, mirror, width)
                q = q[live]
            p, a, w = (np.concatenate(x) for x in zip(*one[j], strict=True))
            c = queries[p, j] if j < m else np.zeros(len(p), np.int64)
            live, a, w = self._exact(c, a, w)
            if j < m:
                one[j + 1].append((p[live], a, w))
        # places of delimiter + word + delimiter, read backwards: the delimiter behind the word comes first
        behind = self.n - 1 - self.right.order[a]
        return base + p[live], (self.ordinal[behind] - 1) % self.words
