"""Equi-joins used by the pipeline.

Broadcast only behind a proven size bound: either a bound that holds by
construction (a frequency-threshold table has at most 1/threshold keys) or a
measured number of rows and bytes.  Beyond the bound the join
is a shuffle join; AQE's skew-join split handles a hot key, and
``salt_buckets`` spreads a hot key explicitly when asked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from featureflow.operators.frequent import frequent_counts

# Rows and bytes we are willing to ship to every executor for a dimension/lookup table.
DEFAULT_MAX_BROADCAST_ROWS = 500_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows: a count, one number per task
    (a plain Parquet table answers it from its footers)."""
    return df.count() <= max_rows


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
             max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is within both bounds.

    Columns of fixed width count as 16 bytes; the lengths of the others are
    summed, and only when the number of rows is within its bound.
    """
    rows = df.count()
    if rows > max_rows:
        return False
    fixed = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)
    wide = [F.col(f"`{f.name}`") if isinstance(f.dataType, (StringType, BinaryType)) else
            F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if not isinstance(f.dataType, fixed)]
    used = 16 * rows * (len(df.columns) - len(wide))
    if wide and used <= max_bytes:
        lengths = [F.coalesce(F.sum(F.octet_length(c).cast("long")), F.lit(0)) for c in wide]
        used += sum(df.agg(*lengths).first())
    return used <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    known_bound: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when its size is proven small, else leave it."""
    if known_bound is not None and known_bound <= max_rows:
        return F.broadcast(df)
    return F.broadcast(df) if is_small(df, max_rows) else df


HEAVY_SHARE = 0.001             # a key with more of the fact rows is heavy: at most 1000 keys
BITMAP_BITS = 32_768            # bits of one row of a key bitmap (fixed by Spark's bitmap functions)
MAX_BITMAP_ROWS = 8_192         # rows of 4 KB: 32 MB of bits, the most that is broadcast


def key_bitmap(df: DataFrame, key: str, rows: int) -> DataFrame:
    """(_bucket, _bits): one bit per hash of a key of ``df``, in ``rows`` rows (a power of two) of 4 KB."""
    place = F.xxhash64(key).bitwiseAND(F.lit(rows * BITMAP_BITS - 1)) + F.lit(1)
    return (df.filter(F.col(key).isNotNull()).select(place.alias("_place"))
            .groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")))


def drop_unmatched(fact: DataFrame, dim: DataFrame, key: str, dim_rows: int) -> DataFrame:
    """``fact`` without most rows whose key is not in ``dim`` (none that is), before any shuffle.

    The dimension's keys become a bitmap of 8 to 16 bits a key, broadcast as at most
    MAX_BITMAP_ROWS rows; beyond that ``fact`` is returned as it is.
    """
    rows = 1 << max(0, (8 * dim_rows // BITMAP_BITS).bit_length())
    if rows > MAX_BITMAP_ROWS:
        return fact
    place = F.xxhash64(key).bitwiseAND(F.lit(rows * BITMAP_BITS - 1)) + F.lit(1)
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    held = F.getbit(byte, (bit % 8).cast("int")) == 1
    marked = fact.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    return (marked.join(F.broadcast(key_bitmap(dim, key, rows)), "_bucket").filter(held)
            .drop("_place", "_bucket", "_bits"))


def heavy_keys(fact: DataFrame, key: str, share: float = HEAVY_SHARE) -> list[str]:
    """Values of ``key``, as text, that more than ``share`` of the rows hold (at most 1/share)."""
    return sorted(frequent_counts(fact.select(key), [key], share)[key].values)


def split_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", share: float = HEAVY_SHARE,
               prefilter: bool = True) -> DataFrame:
    """fact JOIN dim USING (key) for a skewed fact and a dimension too large to broadcast.

    * rows of heavy keys (found by a multistage filter) meet a broadcast of only
      those keys' dimension rows, or a salted copy of them if these are many;
    * rows without a key match nothing and are not shuffled;
    * the rest is a plain shuffle join; where unmatched rows are dropped anyway
      (inner, left_semi), they go before the shuffle, by a bitmap of the keys.

    The dimension is copied for heavy keys only.  Column order is that of the
    plain join; joins that keep unmatched dimension rows are refused.
    """
    if how not in SALTED_JOINS:
        raise ValueError(f"a split join cannot be {how!r}, only one of {SALTED_JOINS}")
    found = heavy_keys(fact, key, share)
    kind = fact.schema[key].dataType

    def heavy(df):
        return F.col(key).cast("string").isin(found) if found else F.lit(False)

    some = fact.filter(F.col(key).isNotNull())
    light, rest_dim = some.filter(~heavy(some)), dim.filter(F.col(key).isNotNull() & ~heavy(dim))
    if prefilter and how in ("inner", "left_semi"):
        light = drop_unmatched(light, rest_dim, key, rest_dim.count())
    out = light.join(rest_dim, key, how)
    if found:
        few = dim.filter(heavy(dim))
        part = some.filter(heavy(some))
        joined = part.join(F.broadcast(few), key, how) if is_small(few) else salted_join(part, few, key, how)
        out = out.unionByName(joined)
    if how in ("left", "left_outer", "left_anti"):
        # an empty side: keeps the joined columns and their types
        nothing = F.broadcast(dim.withColumn(key, F.lit(None).cast(kind)).filter(F.lit(False)))
        out = out.unionByName(fact.filter(F.col(key).isNull()).join(nothing, key, how))
    return out


SALTED_JOINS = ("inner", "left", "left_outer", "left_semi", "left_anti")


def salted_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
                buckets: int = 16, salt_from=None) -> DataFrame:
    """Equi-join that spreads every key over ``buckets`` tasks.

    The fact side gets a deterministic salt (a hash of its own columns, so a
    recomputed task after executor loss gets the same salt); the dimension
    side is replicated once per salt value.  Use for a non-broadcastable
    dimension when a few keys hold a large share of the fact rows.  Joins that
    keep unmatched dimension rows are refused: every copy of them would stay.
    """
    if how not in SALTED_JOINS:
        raise ValueError(f"a salted join cannot be {how!r}, only one of {SALTED_JOINS}")
    cols = salt_from or [c for c in fact.columns if c != key]
    salted_fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(buckets)))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_fact.join(salted_dim, on=[key, "_salt"], how=how).drop("_salt")


def join_dimension(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner",
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   salt_buckets: int = 0, heavy_share: float | None = None) -> DataFrame:
    """fact JOIN dim USING (key).  Broadcast when the dimension is proven small;
    otherwise a shuffle join: ``split_join`` with keys above ``heavy_share`` of the
    rows apart, or salted when ``salt_buckets`` > 1."""
    if is_small(dim, max_broadcast_rows):
        return fact.join(F.broadcast(dim), on=key, how=how)
    if heavy_share is not None:
        return split_join(fact, dim, key, how, heavy_share)
    if salt_buckets > 1:
        return salted_join(fact, dim, key, how=how, buckets=salt_buckets)
    return fact.join(dim, on=key, how=how)
