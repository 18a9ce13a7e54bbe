"""Correlations of many columns from a Gramian summed over blocks of columns.

One scan.  Every task multiplies its Arrow batches block by block (numpy), so
its partial sums are a few matrices however many rows it reads; they are merged
in two rounds, streaming, so no task holds more than one set of blocks.  Sums
are kept about a shift (a value of the column) and moved to a common one when
merged, so large offsets do not cancel digits.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128                 # columns of a block: a pair of blocks is six matrices of 128 KB
FAN_IN = 512                # groups of tasks merged first
NOISE = 1e-13               # a variance below this share of the second moment is rounding: a constant column
_FIELDS = "bi int, bj int, part int, sums binary"

# the functions that run in tasks travel with the job: executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Pair:
    """Sums over the rows where both columns of a pair are known, for one pair of blocks."""

    def __init__(self, ci, cj, sums):
        self.ci, self.cj, self.sums = ci, cj, sums        # shifts; (6, bi, bj): n, si, sj, qi, qj, p

    @classmethod
    def of(cls, xi, ki, xj, kj, ci, cj):
        a, b = np.where(ki, xi - ci, 0.0), np.where(kj, xj - cj, 0.0)
        m, w = ki.astype(np.float64), kj.astype(np.float64)
        return cls(ci, cj, np.stack([m.T @ w, a.T @ w, m.T @ b, (a * a).T @ w, m.T @ (b * b), a.T @ b]))

    def add(self, other: _Pair) -> None:
        n, si, sj, qi, qj, p = other.sums
        di, dj = (other.ci - self.ci)[:, None], (other.cj - self.cj)[None, :]
        self.sums += np.stack([n, si + n * di, sj + n * dj, qi + 2 * di * si + n * di * di,
                               qj + 2 * dj * sj + n * dj * dj, p + di * sj + dj * si + n * di * dj])

    def pack(self) -> bytes:
        return np.concatenate([self.ci, self.cj, self.sums.ravel()]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes, ni: int, nj: int):
        flat = np.frombuffer(raw)
        return cls(flat[:ni], flat[ni:ni + nj], flat[ni + nj:].reshape(6, ni, nj).copy())

    def correlations(self) -> np.ndarray:
        n, si, sj, qi, qj, p = self.sums
        with np.errstate(invalid="ignore", divide="ignore"):
            vi, vj = qi - si * si / n, qj - sj * sj / n
            out = (p - si * sj / n) / np.sqrt(vi * vj)
            none = (n == 0) | (vi <= NOISE * qi) | (vj <= NOISE * qj)
        return np.where(none, None, np.clip(out, -1.0, 1.0))


def _partial_rows(k: int, block: int):
    edges = [(a, min(k, a + block)) for a in range(0, k, block)]

    def run(batches):
        shift, found, part = None, {}, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(k)[0].as_py()
            known = np.column_stack([batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in range(k)])
            x = np.column_stack([batch.column(i).fill_null(0.0).to_numpy(zero_copy_only=False) for i in range(k)])
            if shift is None:
                first = known.argmax(axis=0)
                shift = np.where(known.any(axis=0), x[first, np.arange(k)], 0.0)
                shift = np.where(np.isfinite(shift), shift, 0.0)
            for i, (a, b) in enumerate(edges):
                for j, (c, d) in enumerate(edges[i:], i):
                    pair = _Pair.of(x[:, a:b], known[:, a:b], x[:, c:d], known[:, c:d], shift[a:b], shift[c:d])
                    if (i, j) in found:
                        found[i, j].add(pair)
                    else:
                        found[i, j] = pair
        for (i, j), pair in found.items():
            yield pa.RecordBatch.from_pylist([{"bi": i, "bj": j, "part": part, "sums": pair.pack()}], schema=_arrow())
    return run


def _arrow() -> pa.Schema:
    return pa.schema([("bi", pa.int32()), ("bj", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())])


def _merged(k: int, block: int, batches):
    found = {}
    for batch in batches:
        for r in batch.to_pylist():
            i, j = r["bi"], r["bj"]
            pair = _Pair.unpack(r["sums"], min(block, k - i * block), min(block, k - j * block))
            if (i, j, r["part"]) in found:
                found[i, j, r["part"]].add(pair)
            else:
                found[i, j, r["part"]] = pair
    return found


def _merge_rows(k: int, block: int):
    def run(batches):
        for (i, j, part), pair in _merged(k, block, batches).items():
            yield pa.RecordBatch.from_pylist([{"bi": i, "bj": j, "part": part, "sums": pair.pack()}], schema=_arrow())
    return run


def _final_rows(names: list[str], block: int):
    k = len(names)

    def run(batches):
        for (i, j, _), pair in _merged(k, block, batches).items():
            corr = pair.correlations()
            a, b, r = [], [], []
            for x in range(corr.shape[0]):
                for y in range(corr.shape[1]):
                    p, q = i * block + x, j * block + y
                    if i == j and p > q:
                        continue
                    for s, t in {(p, q), (q, p)}:
                        a.append(names[s])
                        b.append(names[t])
                        r.append(None if corr[x, y] is None else float(corr[x, y]))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(r, pa.float64())],
                                             ["feature_a", "feature_b", "corr"])
    return run


def correlations(df: DataFrame, columns: Sequence[str], zero_fill: bool = True, block: int = BLOCK,
                 fan_in: int = FAN_IN) -> DataFrame:
    """``(feature_a, feature_b, corr)`` of all pairs of numeric columns, one scan.

    With ``zero_fill`` NULL and NaN count as 0; without it each pair uses the
    rows where both are known (NaN makes its pairs NaN).  A pair with a constant
    column, or without rows, has NULL; an empty table gives no rows.
    """
    names = list(columns)
    number = {c: F.col(c).cast("double") for c in names}
    if zero_fill:
        number = {c: F.nanvl(F.coalesce(x, F.lit(0.0)), F.lit(0.0)) for c, x in number.items()}
    rows = df.select(*[x.alias(f"x{i}") for i, x in enumerate(number.values())],
                     F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_part"))
    parts = rows.mapInArrow(_partial_rows(len(names), block), _FIELDS)
    groups = parts.repartition("bi", "bj", "part").mapInArrow(_merge_rows(len(names), block), _FIELDS)
    whole = groups.withColumn("part", F.lit(0)).repartition("bi", "bj")
    return whole.mapInArrow(_final_rows(names, block), "feature_a string, feature_b string, corr double")
