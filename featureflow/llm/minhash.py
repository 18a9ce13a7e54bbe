"""Near-duplicate groups by circulant MinHash.

Two fixed permutations of the 2**32 shingle universe generate every signature
coordinate: sigma scatters the shingles once, and coordinate k is the minimum
of pi over the scattered values shifted circularly by k.  Coordinates are
banded (bands of 4, as many as leave a pair at the threshold without a common
band with probability 1e-5: 16 at 0.85, 22 at 0.8) and every link is confirmed
on the full sets.

Groups of copies never meet in one task and never become all pairs:

1. documents with equal shingle sets collapse into one representative (a
   grouped minimum);
2. every bucket links its members to its smallest member only (a star); the
   star's rows are salted so that a group has a bounded number of shingles;
3. members that are not linked to their centre get a new one, the smallest of
   them, and are compared with that; a few rounds of this cover groups that lie
   around a centre which is none of theirs;
4. components of the confirmed links are taken; only members outside their
   star's largest component are compared with all its members, block by block.

Of the links confirmed in a block a spanning forest leaves the task: fewer rows
than the block has members, and the same components.  Any pair that shares a
bucket is either connected before step 4 or compared in it, so no group falls
apart for want of a link, whatever the bucket's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import cut, stored
from featureflow.llm.components import connected_components
from featureflow.llm.words import Words, chunks, flat_shingles, mix64

ROWS = 4                          # coordinates of a band
MISS = 1e-5                       # chance that a pair exactly at the threshold shares no band
BLOCK_SHINGLES = 200_000          # shingles of a block of one star: bounds a task's group
CENTRES = 2                       # further centres that a star tries before its blocks are compared
MAX_BROADCAST_IDS = 500_000       # ids (8 bytes each) that may be broadcast


def _sigma(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0x297A2D39)
    x ^= x >> np.uint32(16)
    return x


def _pi(x: np.ndarray) -> np.ndarray:
    """Permutation applied in place on a fresh array."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(flat: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """uint32 (sets, coordinates): minima of pi over sigma(set) shifted circularly by k."""
    base = _sigma(flat.astype(np.uint32))
    out = np.empty((len(starts), coordinates), dtype=np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(_pi(base + np.uint32(k)), starts)
    return out


def _distinct(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's shingles sorted and without repeats, and the new bounds."""
    parts = [np.unique(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return (np.concatenate(parts) if parts else flat[:0]), np.concatenate([[0], np.cumsum(sizes)])


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for part in chunks(batch, "text", 1 << 20):
        w = Words(part.column("text"), lower=True)
        flat, bounds = flat_shingles(w.hashes(), w.bounds, width)
        yield part.column("id"), *_distinct(flat, bounds)


def _signature_rows(width: int, bands: int, rows: int):
    salts = mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            for ids, flat, bounds in _sets(batch, width):
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                one, two = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
                keys = [None] * len(sizes)
                if len(full):
                    starts = bounds[:-1][full]
                    one[full] = np.add.reduceat(mix64(flat), starts)
                    two[full] = np.add.reduceat(mix64(flat ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    sig = signatures(flat, starts, bands * rows).astype(np.uint64).reshape(-1, bands, rows)
                    band = np.broadcast_to(salts, sig.shape[:2]).copy()
                    for r in range(rows):
                        band = mix64(band + sig[:, :, r])
                    for i, k in zip(full, band.view(np.int64), strict=True):
                        keys[i] = k
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "d1", "d2", "keys"])
    return run


def _set_rows(width: int):
    def run(batches):
        for batch in batches:
            for ids, flat, bounds in _sets(batch, width):
                raw = [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(raw, pa.binary())], ["rep", "shingles"])
    return run


def _block_links(percent: int):
    """A spanning forest of the confirmed links between the queries and the members of one block."""

    def run(table: pa.Table) -> pa.Table:
        reps = table.column("rep").to_numpy()
        asks = table.column("asks").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
        flat = np.concatenate(sets)
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        _, ids = np.unique(flat, return_inverse=True)
        mark = np.zeros(ids.max() + 1, dtype=np.int32)
        members = ~asks
        _, group = np.unique(reps, return_inverse=True)     # a query that is a member too is one node
        found = []
        for q in np.flatnonzero(asks):
            own = ids[starts[q]:starts[q] + sizes[q]]
            mark[own] = 1
            both = np.add.reduceat(mark[ids], starts)
            mark[own] = 0
            union = sizes + sizes[q] - both
            ok = np.flatnonzero(members & (100 * both >= percent * union) & (group != group[q]))
            joined, first = np.unique(group[ok], return_index=True)
            found += [(int(reps[q]), int(reps[i])) for i in ok[first]]
            group[np.isin(group, joined)] = group[q]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()),
                         "b": pa.array([y for _, y in found], pa.int64())})
    return run


def _compare(asking: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between asking (hub, rep, n) and members (hub, rep, n) of the same hub, by blocks:
    of each block's links as many as connect what they connect."""
    def blocks(df, name):
        return df.groupBy("hub").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias(name))

    # stored, so that Spark can split a hot hub in the joins below
    sizes = stored(blocks(asking, "qs").join(blocks(members, "ms"), "hub"), "minhash-blocks")

    def place(df, own, other, flag):
        count, reach = F.col(own), F.sequence(F.lit(0), F.col(other) - 1)
        return (df.join(sizes, "hub")
                .select("hub", F.pmod(F.xxhash64("rep"), count).cast("int").alias(own[0]),
                        F.explode(reach).alias(other[0]), "rep", F.lit(flag).alias("asks")))

    rows = place(asking, "qs", "ms", True).unionByName(place(members, "ms", "qs", False))
    return (rows.join(sets, "rep").groupBy("hub", "q", "m")
            .applyInArrow(_block_links(percent), "a long, b long").distinct())


def _of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in the stored table ``ids``."""
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "id", "left_semi")


def _unlinked(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Members (hub, rep, n) that are not linked (hub, b) to their hub's centre; computed once."""
    return cut(members.join(linked.select("hub", F.col("b").alias("rep")).distinct(), ["hub", "rep"], "left_anti"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: (id, n_shingles, component_id).

    Words are runs of non-white-space, A-Z lower-cased; a document's set holds
    its distinct ``width``-word shingles (with fewer words, the whole sequence
    as one).  Documents are linked when 100 * intersection >= percent * union,
    and component_id is the smallest id reachable over links, itself included.

    NULL, empty and blank texts have an empty set and are linked with nothing.
    A NULL id is passed through with a NULL component.  Rows that share an id
    are one node (their links are joined).  Other columns are not read, so
    their names cannot clash.  An empty table gives an empty result.
    """
    rows, bands = ROWS, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sigs = stored(docs.mapInArrow(_signature_rows(width, bands, rows),
                                  "id long, n long, d1 long, d2 long, keys array<long>"), "minhash-signatures")
    known = sigs.filter("n > 0 AND id IS NOT NULL")
    classes = known.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"),
                                                 F.min_by("keys", "id").alias("keys"))
    reps = classes.select("rep", "n", F.explode("keys").alias("key"))
    hubs = reps.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    stars = cut(reps.join(hubs.select("key", "hub"), "key").select("hub", "rep", "n").distinct())
    ids = cut(stars.select(F.col("rep").alias("id")).distinct())
    sets = stored(_of(ids, docs).mapInArrow(_set_rows(width), "rep long, shingles binary")
                  .filter(F.length("shingles") > 0).distinct(), "minhash-sets")   # an id may have several texts

    links = cut(_compare(stars.filter("hub = rep"), stars.filter("hub <> rep"), sets, percent))
    left = _unlinked(stars.filter("hub <> rep"), links.withColumnRenamed("a", "hub"))
    for _ in range(CENTRES):
        if left.isEmpty():
            break
        centres = cut(left.groupBy("hub").agg(F.min_by(F.struct("rep", "n"), "rep").alias("c")).select("hub", "c.rep", "c.n"))
        others = cut(left.join(centres.select("hub", F.col("rep").alias("centre")), "hub").filter("rep <> centre"))
        more = cut(_compare(centres, others.select("hub", "rep", "n"), sets, percent))
        links = links.unionByName(more)
        found = more.join(centres.select("hub", F.col("rep").alias("a")), "a").select("hub", "b")
        left = _unlinked(others.select("hub", "rep", "n"), found)
    links = cut(links)
    same = cut(known.join(classes.filter("copies > 1").select("n", "d1", "d2", "rep"), ["n", "d1", "d2"])
               .select(F.col("id").alias("a"), F.col("rep").alias("b")).filter("a <> b").distinct())
    first = connected_components(links)
    labelled = cut(stars.join(first.select(F.col("node").alias("rep"), F.col("component").alias("c")), "rep", "left")
                   .select("hub", "rep", "n", F.coalesce("c", "rep").alias("c")))
    largest = (labelled.groupBy("hub", "c").agg(F.count("*").alias("size"))
               .groupBy("hub").agg(F.max_by("c", F.struct("size", -F.col("c"))).alias("largest")))
    stragglers = cut(labelled.join(largest, "hub").filter("c <> largest").select("hub", "rep", "n"))
    rest = stars.join(stragglers.select("hub").distinct(), "hub", "left_semi")
    late = _compare(stragglers, rest, sets, percent)
    component = connected_components(links.unionByName(late).unionByName(same))
    return (sigs.join(component.withColumnRenamed("node", "id"), "id", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
             percent: int = 80) -> DataFrame:
    """``docs`` without the near copies: of each component, the document with the smallest id stays.

    All columns are returned as they were.  Rows with a NULL id, without text
    or without words stay; of rows that repeat the kept id, all stay.
    """
    found = near_duplicates(docs, id_col, text_col, width, percent)
    gone = found.filter("component_id <> id").select(F.col("id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")


def keep_one_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 percent: int = 80) -> DataFrame:
    """``docs`` without the near copies, by row: of each component, exactly one row stays.

    Every row is a node of its own, so rows that repeat an id or have a NULL
    one are compared like others.  The row with the smallest id stays (NULLs
    last; of rows with that id, the one whose text has the smallest hash).  All
    columns are returned as they were.  Rows without text or words stay.
    """
    # stored, so that a row keeps its number
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "minhash-rows")
    found = near_duplicates(rows, "_row", text_col, width, percent)
    others = cut(found.filter("component_id <> id").select(F.col("id").alias("_row"), "component_id"))
    members = others.unionByName(others.select(F.col("component_id").alias("_row"), "component_id").distinct())
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                     F.xxhash64(text_col).alias("text"), "_row")
    kept = (members.join(rows.select("_row", order.alias("order")), "_row").groupBy("component_id")
            .agg(F.min("order").alias("least")).select(F.col("least._row").alias("_row")))
    gone = members.select("_row").join(kept, "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)
