"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are short and documents may be long, so similarity of whole sets says
nothing; what counts is containment, the share of an item's shingles that a
document holds.  Items are partitioned by the size of their shingle set, and
each keeps a bottom-h MinHash sketch: its h smallest hashes under one
permutation.  h is set per size partition so that a document which contains
the wanted share cannot miss all of them:

* sets of at most ``EXACT_SIZE`` shingles keep floor((1 - share) * size) + 1
  hashes: fewer shingles than that can be absent, so one at least is hit;
* larger sets keep ``LONG_SKETCH`` hashes; each is present with probability
  ``share`` at least, so all miss with (1 - share) ** 64, about 1e-45 at 0.8.

Documents are streamed once past the sorted sketch hashes; a hit names an item
and the pair is verified at once on all shingles of both.  The sketches and
item sets are broadcast in slices of a bounded number of hashes; a benchmark
beyond one slice makes one pass over the documents per slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.words import Words, chunks, flat_shingles, mix64

EXACT_SIZE = 320                   # largest set whose sketch cannot miss (65 hashes at share 0.8)
LONG_SKETCH = 64
SLICE_SHINGLES = 2_000_000         # item shingles (8 bytes each) broadcast at a time


def sketch_size(size: int, percent: int) -> int:
    """Hashes kept for a set of ``size`` shingles."""
    return size * (100 - percent) // 100 + 1 if size <= EXACT_SIZE else LONG_SKETCH


def _item_rows(width: int, percent: int):
    def run(batches):
        for batch in batches:
            w = Words(batch.column("text"), lower=True)
            flat, bounds = flat_shingles(w.hashes(), w.bounds, width)
            sets = [np.unique(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            sketches = [s[np.argsort(mix64(s ^ np.uint64(0x6A09E667F3BCC909)))[:sketch_size(len(s), percent)]]
                        for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sketches], pa.binary())], ["item", "n", "shingles", "sketch"])
    return run


def _matches(items: list, width: int, percent: int):
    """Task function: pairs of a document and an item of one slice."""
    sets = [np.frombuffer(r["shingles"], dtype=np.uint64) for r in items]
    sketches = [np.frombuffer(r["sketch"], dtype=np.uint64) for r in items]
    probe = np.concatenate(sketches)
    owner = np.repeat(np.arange(len(items)), [len(s) for s in sketches])
    order = np.argsort(probe, kind="stable")
    probe, owner = probe[order], owner[order]
    names = [r["item"] for r in items]
    # most shingles of a document are in no sketch: a bit per hash prefix answers for them
    seen = np.zeros(1 << 20, dtype=bool)
    seen[probe >> np.uint64(44)] = True

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                w = Words(part.column("text"), lower=True)
                flat, bounds = flat_shingles(w.hashes(), w.bounds, width)
                maybe = np.flatnonzero(seen[flat >> np.uint64(44)])
                low = np.searchsorted(probe, flat[maybe], side="left")
                high = np.searchsorted(probe, flat[maybe], side="right")
                hit = high > low
                maybe, low, high = maybe[hit], low[hit], high[hit]
                doc = np.searchsorted(bounds, maybe, side="right") - 1
                pairs = {(int(d), int(o)) for d, a, b in zip(doc, low, high, strict=True) for o in owner[a:b]}
                rows = []
                for d, o in sorted(pairs):
                    held = int(np.isin(sets[o], flat[bounds[d]:bounds[d + 1]]).sum())
                    if 100 * held >= percent * len(sets[o]):
                        rows.append((d, o, held))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([names[r[1]] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([len(sets[r[1]]) for r in rows], pa.int64())], ["id", "item_id", "held", "item_shingles"])
    return run


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, held, item_shingles): every pair with 100 * held >= percent * item_shingles.

    Words are runs of non-white-space, A-Z lower-cased, and sets hold distinct
    ``width``-word shingles (an item or document with fewer words: the whole
    sequence).  Items and documents without words, NULL texts included, match
    nothing; items with a NULL id are ignored, documents with a NULL id give
    rows with a NULL id.  Repeated rows give repeated pairs.  Only the named
    columns are read.
    """
    documents = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = documents.schema["id"].dataType.simpleString()
    items = stored(benchmark.select(F.col(item_col).cast("long").alias("item"),
                                    F.col(item_text).cast("string").alias("text")).filter("item IS NOT NULL")
                   .mapInArrow(_item_rows(width, percent), "item long, n long, shingles binary, sketch binary")
                   .filter("n > 0"), "benchmark-items")
    schema = f"id {kind}, item_id long, held long, item_shingles long"
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s")).first()["s"]
    slices = -(-total // SLICE_SHINGLES)
    out = docs.sparkSession.createDataFrame([], schema)
    for k in range(slices):
        # a hash slice has SLICE_SHINGLES shingles on average
        some = items.filter(F.pmod(F.xxhash64("item"), F.lit(slices)) == k).collect()
        if some:
            found = documents.mapInArrow(_matches(some, width, percent), schema)
            out = found if slices == 1 else out.unionByName(found)
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; other rows and all columns stay as they are.

    Rows with a NULL id are judged by their own text as well: they go when it holds an item.
    """
    keyed = docs.withColumn("_row", F.xxhash64(F.col(id_col), F.col(text_col)))
    bad = contained_items(keyed, benchmark, width, percent, "_row", text_col).select(F.col("id").alias("_row")).distinct()
    return keyed.join(bad, "_row", "left_anti").select(*docs.columns)
