"""Splitting, sampling and repartitioning."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Context, Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash32(key) -> Column:
    """The first 32 bits of md5(key) as a long; a NULL key has a value of its own.

    Independent of partitioning and task retries, so a recomputed partition
    lands every row in the same split.
    """
    k = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(k.cast("string"), F.lit("(null)"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def is_train(key, train_frac: float = 0.8) -> Column:
    """TRUE for about ``train_frac`` of the keys (32-bit resolution), never NULL."""
    if not 0 < train_frac < 1:
        raise ValueError(f"train_frac must lie between 0 and 1, not {train_frac}")
    return hash32(key) < F.lit(int(train_frac * (1 << 32)))


def hash_split(df: DataFrame, key: str, train_frac: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(train, test): every row is in exactly one; rows with a NULL key stay together."""
    flag = is_train(key, train_frac)
    return df.filter(flag), df.filter(~flag)


DRAW_BITS = 60


def draw(keys: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 2**60) drawn from the row's key columns and the seed alone.

    The first 60 bits of md5("seed|key|key..."), NULL keys as "(null)": the same
    row gets the same number in any layout, session or retry.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("(null)")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")


def _below(share: float) -> int:
    """The draws that a share of all draws lies below."""
    return min(1 << DRAW_BITS, max(0, round(share * (1 << DRAW_BITS))))


def poisson_limits(mean: float) -> list[int]:
    """Inverse of the Poisson distribution on 60-bit draws: a draw has as many copies as limits it reaches."""
    if not 0 <= mean <= 100:
        raise ValueError(f"the mean number of copies must lie between 0 and 100, not {mean}")
    with localcontext(Context(prec=60)):
        limits, k, lam = [], 0, Decimal(mean)
        term = cumulated = (-lam).exp()
        while True:
            limit = int((cumulated * (1 << DRAW_BITS)).to_integral_value())
            if limit >= 1 << DRAW_BITS or (k > mean and limits and limit == limits[-1]):
                return limits
            limits.append(limit)
            k += 1
            term *= lam / k
            cumulated += term


def sample_by_key(df: DataFrame, keys: Sequence[str], fraction: float | dict, with_replacement: bool = False,
                  seed: int = 42, strata: str | None = None) -> DataFrame:
    """A sample whose rows depend on nothing but their keys: repeatable on any layout of the table.

    Without replacement a row is taken when its draw lies below ``fraction``
    (Bernoulli); with replacement it is repeated by the inverse Poisson
    distribution of mean ``fraction``, as ``DataFrame.sample`` does by chance.
    Rows with equal keys share their fate; give keys that tell rows apart.
    With ``strata`` the fraction is a dict by the value of that column; rows of
    other values are not taken.  A bounded literal per stratum, no shuffle.
    """
    if (strata is None) == isinstance(fraction, dict):
        raise ValueError("a dict of fractions and a strata column belong together")
    shares = fraction if isinstance(fraction, dict) else {None: fraction}
    if not with_replacement and any(not 0 <= f <= 1 for f in shares.values()):
        raise ValueError("a fraction without replacement lies between 0 and 1")
    u = F.col("_draw")

    def by_stratum(found: list[tuple]) -> Column:
        out = F.lit(None)
        for value, result in found:
            out = F.when(F.col(strata).eqNullSafe(F.lit(value)) if strata else F.lit(True), result).otherwise(out)
        return out

    if not with_replacement:
        # one draw a row, compared with its stratum's limit
        limit = F.coalesce(by_stratum([(v, F.lit(_below(f))) for v, f in shares.items()]), F.lit(0))
        return df.filter(draw(keys, seed) < limit)

    def copies(share: float) -> Column:
        n, limits = F, poisson_limits(share)
        for k, limit in enumerate(limits):                  # the first limit that the draw lies below
            n = n.when(u < F.lit(limit), F.lit(k))
        return n.otherwise(F.lit(len(limits))) if limits else F.lit(0)

    # the draw is a column of its own and no filter asks for it: it is computed once a row
    n = F.coalesce(by_stratum([(v, copies(f)) for v, f in shares.items()]), F.lit(0))
    return df.withColumn("_draw", draw(keys, seed)).select(*df.columns, F.explode(F.array_repeat(F.lit(1), n)).alias("_copy")).drop("_copy")


def random_split(df: DataFrame, train_frac: float = 0.8, seed: int = 42,
                 keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test), disjoint and complete: by the rows' draws when ``keys`` are given (repeatable on
    any layout), else ``randomSplit`` (depends on the input layout)."""
    if keys is not None:
        taken = draw(keys, seed) < F.lit(_below(train_frac))
        return df.filter(taken), df.filter(~taken)
    a, b = df.randomSplit([train_frac, 1.0 - train_frac], seed=seed)
    return a, b


def sample_rows(df: DataFrame, fraction: float, with_replacement: bool = False, seed: int = 42) -> DataFrame:
    """``DataFrame.sample``: which rows are taken depends on the input layout (``sample_by_key``: on their keys)."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def repartition(df: DataFrame, n: int | None = None, *keys: str) -> DataFrame:
    """Hash repartition to ``n`` (or let AQE size it when n is None)."""
    if n is None:
        return df.repartition(*keys) if keys else df
    return df.repartition(n, *keys)


PART_BYTES = 16 << 20           # of input files a task of iterative work: in memory about ten times that


def input_bytes(df: DataFrame) -> int:
    """The sizes of the files that ``df`` reads, by their listing; 0 when it reads none."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders: dict[str, set[str]] = {}
    for name in df.inputFiles():
        folders.setdefault(name.rsplit("/", 1)[0], set()).add(name.rsplit("/", 1)[1])
    total = 0
    for folder, names in folders.items():                       # one listing a folder
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        total += sum(f.getLen() for f in path.getFileSystem(conf).listStatus(path)
                     if f.getPath().toUri().getRawPath().rsplit("/", 1)[1] in names)
    return total


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism) before iterative work such as model fits,
    and over more when its input files are larger than that many times
    ``part_bytes``: what a task reads does not grow with the table.

    An input of that many files is read by as many tasks already and is left as
    it is.  Only the file listing of the plan is asked: nothing is executed.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        target = max(target, -(-input_bytes(df) // part_bytes))
    except Exception:  # noqa: BLE001 - remote sessions: leave sizing to AQE
        return df
    return df if len(df.inputFiles()) >= target else df.repartition(target)
