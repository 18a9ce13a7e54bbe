"""Exact top-k inner products by pivot-table elimination.

Vectors are scaled to integers.  For a query q and a row x

    <q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2,

and d(q, x) is at least |d(q, p) - d(x, p)| for every pivot p.  Distances of
all rows to many pivots are computed once (the pivot table); the largest of
the lower bounds gives an upper bound of the score.  Rows are evaluated in
order of that bound, in batches, until the k-th best score so far is above the
next bound: no row left can enter, so the result is exact.  Ties go to the
smaller id, and rows whose bound equals the k-th score are still evaluated.

The pivot table is stored with the vectors.  Rows are dealt to parts and queries
to blocks of bounded bytes; every part meets every block in one task, which
keeps k rows per query, and the best of all parts are taken last.  Nothing but
the pivots and two counts passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import stored

PIVOTS = 32
PART_BYTES = 8 << 20               # components of the rows of a part, on average
BLOCK_BYTES = 4 << 20              # components of the queries of a block, on average
STEP = 256                         # rows evaluated between two looks at the threshold
ROUNDING = 1e-6                    # relative slack of bounds computed in floating point


def integer_vectors(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): v = floor(scale * component) as longs; unusable vectors and NULL ids are left out, equal rows are one."""
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), wide.alias("d"))
            .filter(F.col("id").isNotNull() & F.col("d").isNotNull() & fine)
            .select("id", F.transform("d", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))
            .distinct())


def _matrix(column, n: int, size: int, kind=np.int64) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
                      if isinstance(column, pa.ChunkedArray) else column.flatten().to_numpy(zero_copy_only=False),
                      dtype=kind).reshape(n, size)


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots): distance of every row to every pivot."""
    wide = rows.astype(np.float64)
    return np.sqrt(np.maximum(((wide[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0))


def _pivot_rows(pivots: np.ndarray, size: int):
    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column("v"), batch.num_rows, size)
            table = np.concatenate([pivot_distances(rows[a:a + 1024], pivots) for a in range(0, len(rows), 1024)] or
                                   [np.zeros((0, len(pivots)))])
            flat = pa.array(table.ravel())
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), batch.column("v"),
                                              pa.ListArray.from_arrays(ends, flat)], ["row", "id", "v", "t"])
    return run


def _nearest(ids, rows, table, queries, q_table, k, own):
    """(query, row, score): each query's best k rows by bound order; ``own[i]`` is the query's own place, or -1."""
    wide, q_wide = rows.astype(np.float64), queries.astype(np.float64)
    norms, q_norms = (wide * wide).sum(axis=1), (q_wide * q_wide).sum(axis=1)
    found, evaluated = [], 0
    for i in range(len(queries)):
        low = np.abs(table - q_table[i]).max(axis=1) if table.shape[1] else np.zeros(len(rows))
        bound = (q_norms[i] + norms - low * low) / 2
        bound += ROUNDING * (q_norms[i] + norms) + 1
        able = np.arange(len(rows)) if own[i] < 0 else np.delete(np.arange(len(rows)), own[i])
        able = able[np.argsort(-bound[able], kind="stable")]
        best, scores, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while at < len(able) and not (len(best) == k and bound[able[at]] < scores[-1]):
            some = able[at:at + STEP]
            at += STEP
            evaluated += len(some)
            best, scores = np.concatenate([best, some]), np.concatenate([scores, rows[some] @ queries[i]])
            order = np.lexsort((ids[best], -scores))[:k]
            best, scores = best[order], scores[order]
        found.append((np.full(len(best), i), best, scores))
    merged = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
    return *merged, evaluated


def _block(k: int, size: int, pivots: int):
    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        held, asked = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        rows, queries = (_matrix(t.column("v"), t.num_rows, size) for t in (held, asked))
        near, q_near = (_matrix(t.column("t"), t.num_rows, pivots, np.float64) for t in (held, asked))
        ids, q_ids = held.column("id").to_numpy(), asked.column("id").to_numpy()
        q_rows = asked.column("row").to_numpy()
        place = {int(r): i for i, r in enumerate(held.column("row").to_numpy())}
        own = np.array([place.get(int(r), -1) for r in q_rows], dtype=np.int64)
        q, r, scores, _ = _nearest(ids, rows, near, queries, q_near, k, own)
        return pa.table({"query": pa.array(q_rows[q]), "query_id": pa.array(q_ids[q]), "vec_id": pa.array(ids[r]),
                         "score": pa.array(scores)})
    return run


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products over all other rows.

    ``is_query`` is a Column over ``id``.  Components become
    floor(scale * x), x as double; scores are exact 64-bit integers.  Vectors
    that are NULL or hold a NULL, NaN or infinite component take no part, nor
    do NULL ids.  Rows equal in id and vector are one row; rows that repeat an id
    with another vector are rows of their own, as candidates of each other and
    as queries (each with its own ranks under the same query_id).  Vectors are
    compared with those of their own length only; empty vectors score 0.  Ties
    go to the smaller vec_id.  An empty table gives an empty result; other
    columns are not read.  A row's vector is held whole, however long.
    """
    spark = vectors.sparkSession
    found = stored(integer_vectors(vectors, scale, id_col, vector_col)
                   .withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    schema = "query long, query_id long, vec_id long, score long"
    out = None
    # lengths of the queries' vectors: one in any sane table
    counts = found.groupBy(F.size("v").alias("s")).agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"))
    for size, count, asked in sorted((r["s"], r["n"], r["q"]) for r in counts.filter("q > 0").collect()):
        same = found.filter(F.size("v") == size)
        order = F.xxhash64("id", F.lit("pivot"))
        some = [r["v"] for r in same.orderBy(order, "id", "row").limit(PIVOTS).collect()]
        pivots = np.array(some, dtype=np.float64).reshape(len(some), size)
        rows = stored(same.select("row", "id", "v").mapInArrow(_pivot_rows(pivots, size),
                                                               "row long, id long, v array<long>, t array<double>"), "topk-pivots")
        parts, blocks = -(-8 * size * count // PART_BYTES) or 1, -(-8 * size * asked // BLOCK_BYTES) or 1

        def deal(df, own, others, name, other, flag):
            return df.select(F.pmod(F.xxhash64("row"), F.lit(own)).cast("int").alias(name),
                             F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), "row", "id", "v", "t",
                             F.lit(flag).alias("asks"))

        grid = deal(rows, parts, blocks, "part", "block", False).unionByName(
            deal(rows.filter(is_query), blocks, parts, "block", "part", True))
        best = grid.groupBy("part", "block").applyInArrow(_block(k, size, len(pivots)), schema)
        out = best if out is None else out.unionByName(best)
    if out is None:
        out = spark.createDataFrame([], schema)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
