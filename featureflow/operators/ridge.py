"""Cross-validated ridge regressions from one pass over the rows.

``LinearRegression`` with an L2 penalty solves normal equations: a fit needs the
counts, sums and cross products of its rows and nothing else, and so does the
error of a fitted line.  They are summed per fold in one pass (numpy on Arrow
batches, two merges); a fold's training rows are all rows less its own, and
every penalty is solved from the same sums.  Sums are kept about a shift (the
first row of a task) and moved to a common one, so large offsets do not cancel digits.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_FEATURES = 256             # a fold's sums are (features + 1) ** 2 numbers: half a MB
FAN_IN = 16                     # groups of tasks merged before the driver adds them up
_FIELDS = "fold int, part int, sums binary"

# the functions that run in tasks travel with the job: executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Moments:
    """Rows, sums and cross products about ``shift`` of the columns (features..., label)."""

    def __init__(self, shift, n, s, p):
        self.shift, self.n, self.s, self.p = shift, n, s, p

    @classmethod
    def of(cls, z: np.ndarray, shift: np.ndarray) -> Moments:
        z = z - shift
        return cls(shift, float(len(z)), z.sum(axis=0), z.T @ z)

    def about(self, shift: np.ndarray) -> Moments:
        d = self.shift - shift
        cross = np.outer(d, self.s)
        return Moments(shift, self.n, self.s + self.n * d, self.p + cross + cross.T + self.n * np.outer(d, d))

    def plus(self, other: Moments, sign: float = 1.0) -> Moments:
        o = other.about(self.shift)
        return Moments(self.shift, self.n + sign * o.n, self.s + sign * o.s, self.p + sign * o.p)

    def pack(self) -> bytes:
        return np.concatenate([self.shift, [self.n], self.s, self.p.ravel()]).tobytes()

    @classmethod
    def unpack(cls, raw: bytes, k: int) -> Moments:
        flat = np.frombuffer(raw)
        return cls(flat[:k], float(flat[k]), flat[k + 1:2 * k + 1], flat[2 * k + 1:].reshape(k, k))


def _arrow(found: dict):
    schema = pa.schema([("fold", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())])
    for (fold, part), m in found.items():
        yield pa.RecordBatch.from_pylist([{"fold": fold, "part": part, "sums": m.pack()}], schema=schema)


def _partial(k: int):
    def run(batches):
        found, shift, part = {}, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, fold = batch.column(0), batch.column(1), batch.column(2)
            if x.null_count or y.null_count or fold.null_count:
                raise ValueError("a row without features, label or fold number")
            flat = x.flatten().to_numpy(zero_copy_only=False)
            if len(flat) != (k - 1) * batch.num_rows:
                raise ValueError(f"not every row has {k - 1} features")
            z = np.column_stack([flat.reshape(-1, k - 1), y.to_numpy(zero_copy_only=False)])
            if not np.isfinite(z).all():
                raise ValueError("features and label must be finite")
            if shift is None:
                shift, part = z[0].copy(), batch.column(3)[0].as_py()
            folds = fold.to_numpy(zero_copy_only=False)
            for f in np.unique(folds):
                m = Moments.of(z[folds == f], shift)
                key = (int(f), part)
                found[key] = found[key].plus(m) if key in found else m
        yield from _arrow(found)
    return run


def _merged(k: int):
    def run(batches):
        found = {}
        for batch in batches:
            for r in batch.to_pylist():
                key, m = (r["fold"], r["part"]), Moments.unpack(r["sums"], k)
                found[key] = found[key].plus(m) if key in found else m
        yield from _arrow(found)
    return run


def fold_moments(df: DataFrame, features_col: str, label: str, fold, features: int) -> dict[int, Moments]:
    """{fold: Moments} of all rows in one pass; at most FAN_IN rows a fold reach the driver."""
    k = features + 1
    rows = df.select(vector_to_array(features_col).alias("x"), F.col(label).cast("double").alias("y"),
                     fold.cast("int").alias("fold"), F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("part"))
    parts = rows.mapInArrow(_partial(k), _FIELDS)
    found: dict[int, Moments] = {}
    for r in sorted(parts.repartition("fold", "part").mapInArrow(_merged(k), _FIELDS).collect(), key=lambda r: r["part"]):
        m = Moments.unpack(bytes(r["sums"]), k)
        found[r["fold"]] = found[r["fold"]].plus(m) if r["fold"] in found else m
    return found


def solve(m: Moments, penalty: float) -> tuple[np.ndarray, float]:
    """(coefficients, intercept about the shift) of ``LinearRegression(regParam=penalty)`` after a scaler.

    As there, columns and label are scaled to unit deviation and the penalty is
    divided by the label's; columns without variance get 0.
    """
    mean = m.s / m.n
    cov = m.p / m.n - np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(cov), 0.0))
    beta, used = np.zeros(len(std) - 1), std[:-1] > 0
    if std[-1] > 0 and used.any():
        sx = std[:-1][used]
        r = cov[:-1, :-1][np.ix_(used, used)] / np.outer(sx, sx)
        c = cov[:-1, -1][used] / (sx * std[-1])
        beta[used] = np.linalg.lstsq(r + penalty / std[-1] * np.eye(len(sx)), c, rcond=1e-13)[0] * std[-1] / sx
    return beta, float(mean[-1] - beta @ mean[:-1])


def rmse(m: Moments, beta: np.ndarray, intercept: float) -> float:
    """Root mean squared error of a line (intercept about ``m.shift``) over the rows of ``m``; NaN without rows."""
    if not m.n:
        return float("nan")
    w = np.append(-beta, 1.0)                                   # the error is w . (x, y) - intercept
    sse = w @ m.p @ w - 2 * intercept * (w @ m.s) + m.n * intercept ** 2
    return float(np.sqrt(max(sse, 0.0) / m.n))


def cross_validated_rmse(df: DataFrame, features_col: str, label: str, fold, folds: int, penalties,
                         features: int) -> list[float]:
    """Mean over the folds of each penalty's RMSE on the fold, fitted on the others."""
    found = fold_moments(df, features_col, label, fold, features)
    if any(not 0 <= f < folds for f in found):
        raise ValueError(f"fold numbers must lie between 0 and {folds - 1}, not {sorted(found)}")
    if not found:
        raise ValueError("no rows to learn from")
    shift = next(iter(found.values())).shift
    held = {f: m.about(shift) for f, m in found.items()}
    errors = []
    for f in range(folds):
        own = held.get(f)
        rest = [m for g, m in sorted(held.items()) if g != f]
        if not rest:
            raise ValueError(f"the training data of fold {f} is empty")
        train = rest[0]
        for m in rest[1:]:
            train = train.plus(m)
        errors.append([rmse(own, *solve(train, p)) if own else float("nan") for p in penalties])
    return [float(np.mean(e)) for e in zip(*errors, strict=True)]
