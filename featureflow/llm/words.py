"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a maximal run of bytes other than white space (0x20, 0x09-0x0D) in
the UTF-8 text.  Everything below works on a whole Arrow batch at once, without
a Python object per word: texts are one byte buffer, words are (start, end)
pairs, and word hashes come from prefix sums of a polynomial over the bytes
(mod 2**64, per-byte random values, finished with a bijective mixer).
NULL texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - chunks() uses pa.compute

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse mod 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 19                    # bytes hashed at a time: bounds the temporaries
_tables: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on uint64 that spreads every input bit (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int) -> np.ndarray:
    out = np.full(_SLICE, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _table(name: str) -> np.ndarray:
    if name not in _tables:
        if name == "bytes":
            _tables[name] = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        else:
            _tables[name] = _powers(_BASE if name == "powers" else _INVERSE)
    return _tables[name]


class Words:
    """Words of a batch: ``data`` (uint8), ``start``/``end`` per word, and
    ``bounds`` such that document i owns words ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
        if texts.null_count:
            texts = texts.fill_null("")
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=texts.offset + n + 1)[texts.offset:] \
            if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2] if n else None
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None and raw.size \
            else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        solid = ~_SPACE[data]
        starts, ends = solid.copy(), solid.copy()
        if len(data):
            cut = offsets[1:-1]
            cut = cut[(cut > 0) & (cut < len(data))]
            starts[1:] &= ~solid[:-1]
            ends[:-1] &= ~solid[1:]
            starts[cut] |= solid[cut]
            ends[cut - 1] |= solid[cut - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A uint64 for each word; equal words have equal values anywhere."""
        out = np.empty(len(self.start), dtype=np.uint64)
        table, powers, inverse = _table("bytes"), _table("powers"), _table("inverse")
        i, n = 0, len(self.start)
        while i < n:
            low = self.start[i]
            j = int(np.searchsorted(self.end, low + _SLICE, side="right"))
            if j <= i:                      # one word longer than a slice: fold it slice by slice
                out[i] = self._long(int(low), int(self.end[i]))
                i += 1
                continue
            high = self.end[j - 1]
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(table[self.data[low:high]] * powers[:high - low], out=sums[1:])
            a, b = self.start[i:j] - low, self.end[i:j] - low
            out[i:j] = (sums[b] - sums[a]) * inverse[a]
            i = j
        return mix64(out)

    def _long(self, a: int, b: int) -> np.uint64:
        total, shift = 0, 1
        for k in range(a, b, _SLICE):
            part = self.data[k:min(b, k + _SLICE)]
            total += shift * int((_table("bytes")[part] * _table("powers")[:len(part)]).sum(dtype=np.uint64))
            shift = shift * pow(_BASE, _SLICE, 1 << 64) % (1 << 64)
        return np.uint64(total % (1 << 64))

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width``-word shingles of one word-hash sequence.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    if not len(h):
        return h[:0]
    w = min(width, len(h))
    n = len(h) - w + 1
    out = np.full(n, w, dtype=np.uint64)
    for j in range(w):
        out = (out + h[j:j + n]) * np.uint64(0xA24BAED4963EE407)
        out ^= out >> np.uint64(29)
    return mix64(out)


def flat_shingles(h: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all documents of a batch, and the bounds of each document's run."""
    lengths = np.diff(bounds)
    count = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(out_bounds[-1], dtype=np.uint64)
    if len(h) >= width:
        rolled = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for j in range(width):
            rolled = (rolled + h[j:j + len(rolled)]) * np.uint64(0xA24BAED4963EE407)
            rolled ^= rolled >> np.uint64(29)
        rolled = mix64(rolled)
        full = lengths >= width
        total = int(count[full].sum())
        src = np.repeat(bounds[:-1][full] - out_bounds[:-1][full], count[full])
        dst_mask = np.repeat(full, count)
        dst = np.flatnonzero(dst_mask)
        assert len(dst) == total
        out[dst] = rolled[dst + src]
    for i in np.flatnonzero((lengths > 0) & (lengths < width)):
        out[out_bounds[i]] = shingles(h[bounds[i]:bounds[i + 1]], width)[0]
    return out, out_bounds


def chunks(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` of about ``most`` text bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(ends):
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(i, j - i)
        i = j
