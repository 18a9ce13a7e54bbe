"""Regression trees and forests of many rows, grown in numpy.

``pyspark.ml`` keeps a level's sums of every open node in every task and passes
over all rows once per group of nodes that fits its memory; a forest walks every
tree for every row, also where the row was not drawn.  Here the trees of all
folds and grid values grow together, in two ways:

* Nodes of many rows: one pass a level.  A task adds up the rows of its blocks by
  (node, feature, bin), the sums are merged by tree and the best split is found
  where they meet.  Rows that a tree did not draw are not touched.
* Nodes of at most ``LOCAL_ROWS`` rows of a tree without draws: their rows meet in
  one task, which grows the rest of the tree there.  One shuffle, however deep.

The rules are those of ``pyspark.ml``: its split candidates, at least one row a
child, variance as impurity, Poisson(1) draws with replacement and a third of the
features a node for a forest.  Draws depend on seed, tree and the place of a
row in its partition, as there, but come from numpy's generator.  Among splits
of equal gain (to rounding) the first feature and bin is taken.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 15            # rows that are walked and added up at once: what is made of a byte a row stays near the core
LOCAL_ROWS = 100_000            # of a node that one task grows to its leaves
TIE = 1e-9                      # gains closer than this share are equal
_BLOCKS = "n int, x binary, y binary, fold binary, block bigint"
_SUMS = "tree int, part int, sums binary"
_PARTS = "tree int, node int, part int, block bigint, n int, x binary, y binary"

# the functions that run in tasks travel with the job: executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _poisson_limits() -> np.ndarray:
    """A 32-bit draw has as many copies as limits it reaches (Poisson of mean 1)."""
    limits, term, total = [], np.exp(-1.0), np.exp(-1.0)
    while round(total * 2 ** 32) < 2 ** 32:
        limits.append(round(total * 2 ** 32))
        term /= len(limits)
        total += term
    return np.array(limits, np.uint32)


POISSON = _poisson_limits()


class Binner:
    """Scaler and split candidates of one training set: bin ``b`` of a feature holds what lies up to its candidate ``b``."""

    def __init__(self, shift, scale, candidates):
        self.shift, self.scale, self.candidates = shift, scale, candidates

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape[::-1], np.uint8)
        for f, c in enumerate(self.candidates):
            out[f] = np.searchsorted(c, (x[:, f] - self.shift[f]) * self.scale[f], side="left")
        return out


class Tree:
    """A growing tree: ``fold`` is left out (-1: none), ``binner`` is its number among the blocks' binners.

    Nodes are numbered as they come, children after their parent and the right
    one after the left one; ``left`` is -1 at leaves and at nodes still open.
    """

    def __init__(self, number: int, binner: int, fold: int, depth: int, features: int, drawn: bool, seed: int):
        if drawn and depth > 6:
            raise ValueError(f"the leaves of a tree of drawn rows are walked one by one: depth {depth} is over 6")
        self.number, self.binner, self.fold, self.depth = number, binner, fold, depth
        self.features, self.drawn, self.seed = features, drawn, seed
        self.feature, self.bin, self.left, self.level, self.value = [0], [0], [-1], [0], [0.0]
        self.open: list[int] = [0]
        self.subsets: dict[int, np.ndarray] = {}

    def choose(self, of: int) -> None:
        """The features that the open nodes may split by."""
        for node in self.open:
            self.subsets[node] = (np.arange(of) if self.features >= of else np.sort(
                np.random.default_rng([self.seed, self.number, node]).choice(of, self.features, replace=False)))

    def split(self, node: int, feature: int, cut: int, left_mean: float, right_mean: float) -> int:
        at = len(self.left)
        self.feature[node], self.bin[node], self.left[node] = feature, cut, at
        for mean in (left_mean, right_mean):
            self.feature.append(0)
            self.bin.append(0)
            self.left.append(-1)
            self.level.append(self.level[node] + 1)
            self.value.append(mean)
        return at

    def shape(self) -> tuple:
        return (self.number, self.binner, self.fold, self.drawn, self.seed, np.array(self.feature, np.int32),
                np.array(self.bin, np.int32), np.array(self.left, np.int32), list(self.open), dict(self.subsets))


# ---------------------------------------------------------------- rows as blocks
def blocks(df: DataFrame, features_col: str, label: str, fold, binners: list[Binner], shift: float) -> DataFrame:
    """The rows as blocks of bins (binner, feature, row), labels less ``shift`` and folds; persisted by the caller."""
    width = len(binners[0].candidates)

    def run(batches):
        held, n, number, part = [], 0, 0, None

        def block():
            x = np.concatenate([h[0] for h in held], axis=2)
            y, f = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            return pa.RecordBatch.from_pylist([{"n": len(y), "x": x.tobytes(), "y": y.tobytes(), "fold": f.tobytes(),
                                                "block": (part << 32) + number}], schema=schema)
        schema = pa.schema([("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("fold", pa.binary()),
                            ("block", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, f = batch.column(0), batch.column(1), batch.column(2)
            if x.null_count or y.null_count or f.null_count:
                raise ValueError("a row without features, label or fold number")
            flat = x.flatten().to_numpy(zero_copy_only=False)
            if len(flat) != width * batch.num_rows:
                raise ValueError(f"not every row has {width} features")
            flat, y = flat.reshape(-1, width), y.to_numpy(zero_copy_only=False)
            if not (np.isfinite(flat).all() and np.isfinite(y).all()):
                raise ValueError("features and label must be finite")
            part = batch.column(3)[0].as_py()
            held.append((np.stack([b.bins(flat) for b in binners]), y - shift, f.to_numpy(zero_copy_only=False).astype(np.int16)))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block()
                held, n, number = [], 0, number + 1
        if held:
            yield block()

    rows = df.select(vector_to_array(features_col).alias("x"), F.col(label).cast("double").alias("y"),
                     fold.cast("int").alias("fold"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, _BLOCKS)


def _read(batches, binners: int):
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column(0)[i].as_py()
            x = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint8).reshape(binners, -1, n)
            y = np.frombuffer(batch.column(2)[i].as_buffer(), np.float64)
            fold = np.frombuffer(batch.column(3)[i].as_buffer(), np.int16)
            yield x, y, fold, batch.column(4)[i].as_py()


def _training_rows(trees, x, y, fold):
    """(trees, bins, labels) of the trees that learn from the same rows."""
    for key in sorted({(t[1], t[2]) for t in trees}):
        rows = np.flatnonzero(fold != key[1])
        if len(rows):
            yield ([t for t in trees if (t[1], t[2]) == key],
                   np.ascontiguousarray(x[key[0]][:, rows]) if len(rows) < len(y) else x[key[0]], y[rows])


def _drawn(tree, block: int, n: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree."""
    seed = np.random.SeedSequence([tree[4], tree[0], block >> 32, block & 0xFFFFFFFF])
    u = np.random.Generator(np.random.SFC64(seed)).integers(0, (1 << 64) - 1, n // 2 + 1, np.uint64, endpoint=True).view(np.uint32)[:n]
    w = (u >= POISSON[0]).view(np.uint8)
    for limit in POISSON[1:4]:
        w += (u >= limit).view(np.uint8)
    often = np.flatnonzero(u >= POISSON[4])                     # one row in 270
    w[often] += np.searchsorted(POISSON[4:], u[often], side="right").astype(np.uint8)
    return w


def _masks(tree, x) -> dict[int, np.ndarray]:
    """{node without children: 255 at its rows, else 0} of a small tree: whole columns of bytes, no row is looked up."""
    _, _, _, _, _, feature, cut, left, _, _ = tree
    masks = {0: np.full(x.shape[1], 255, np.uint8)}
    for v in np.flatnonzero(left >= 0):                         # parents come before their children
        here = masks.pop(v)
        right = np.negative((x[feature[v]] > np.uint8(cut[v])).view(np.uint8))
        right &= here
        here ^= right
        masks[left[v]], masks[left[v] + 1] = here, right
    return masks


def _numbered(masks, n: int) -> np.ndarray:
    """Per row the place of its mask in ``masks``."""
    place = np.zeros(n, np.uint8)
    for i, mask in enumerate(masks):
        if i:
            place |= mask & np.uint8(i)
    return place


def _members(tree, x, idx):
    """[(node, rows)] of the rows ``idx`` at the nodes without children."""
    _, _, _, _, _, feature, cut, left, _, _ = tree
    todo, found = [(0, idx)], []
    while todo:
        node, rows = todo.pop()
        if left[node] < 0:
            found.append((node, rows))
        elif len(rows):
            below = x[feature[node]][rows] <= cut[node]
            todo.append((left[node], rows[below]))
            todo.append((left[node] + 1, rows[~below]))
    return found


# ---------------------------------------------------------------- a level of many nodes
def _add_drawn(tree, x, y, w, sums, bins: int) -> None:
    """Adds the drawn rows to the sums (open node, feature's place, bin, [rows, labels]), two features at a time."""
    open_nodes, subsets = tree[8], tree[9]
    masks = _masks(tree, x)
    here = [masks[v] for v in open_nodes]
    inside = w if len(masks) == len(here) else w & np.bitwise_or.reduce(here)
    taken = np.flatnonzero(inside.astype(np.bool_))
    weight = w[taken].astype(np.float64)
    labels = y[taken] * weight
    shares, wide = len(subsets[open_nodes[0]]), len(open_nodes) * bins * bins > 1 << 16
    at = _numbered(here, len(y)).astype(np.uint32 if wide else np.uint16)

    def column(j):
        if len(here) == 1:
            return x[subsets[open_nodes[0]][j]]
        out = np.zeros(len(y), np.uint8)
        for v, mask in zip(open_nodes, here, strict=True):
            out |= mask & x[subsets[v][j]]
        return out

    for j in range(0, shares, 2):
        both = j + 1 < shares
        key = at * at.dtype.type(bins)
        key += column(j)
        if both:
            key *= key.dtype.type(bins)
            key += column(j + 1)
        key = key[taken].astype(np.int64)
        cells = (len(open_nodes), bins, bins) if both else (len(open_nodes), bins)
        for k, values in enumerate((weight, labels)):
            found = np.bincount(key, values, minlength=math.prod(cells)).reshape(cells)
            sums[:, j, :, k] += found.sum(axis=2) if both else found
            if both:
                sums[:, j + 1, :, k] += found.sum(axis=1)


def _level_sums(shared, binners: int, bins: int):
    """Per tree the sums (open node, feature, bin, [rows, labels]) of a task's blocks."""
    def run(batches):
        trees, found, part = shared.value, {}, -1
        for x, y, fold, block in _read(batches, binners):
            part = block >> 32 if part < 0 else part
            for group, xs, ys in _training_rows(trees, x, y, fold):
                for tree in group:
                    places = {node: i for i, node in enumerate(tree[8])}
                    sums = found.get(tree[0])
                    if sums is None:
                        sums = found[tree[0]] = np.zeros((len(places), len(tree[9][tree[8][0]]), bins, 2))
                    if tree[3]:
                        _add_drawn(tree, xs, ys, _drawn(tree, block, len(ys)), sums, bins)
                        continue
                    for node, rows in _members(tree, xs, np.arange(len(ys))):
                        if node not in places or not len(rows):
                            continue
                        at, labels = sums[places[node]], ys[rows]
                        for j, f in enumerate(tree[9][node]):
                            column = xs[f][rows]
                            at[j, :, 0] += np.bincount(column, minlength=bins)
                            at[j, :, 1] += np.bincount(column, labels, minlength=bins)
        yield from _packed(found, part)
    return run


def _packed(found: dict, part: int):
    schema = pa.schema([("tree", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())])
    for tree, sums in found.items():
        yield pa.RecordBatch.from_pylist([{"tree": tree, "part": part, "sums": sums.tobytes()}], schema=schema)


def _merged(finish):
    """``finish(tree, sums)`` of the sums of every tree, whose rows come one after the other."""
    def run(batches):
        tree, sums = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["tree"] != tree:
                    if tree is not None:
                        yield from _packed({tree: finish(tree, sums)}, 0)
                    tree, sums = r["tree"], np.zeros(len(r["sums"]) // 8)
                sums += np.frombuffer(r["sums"])
        if tree is not None:
            yield from _packed({tree: finish(tree, sums)}, 0)
    return run


def best_splits(sums: np.ndarray) -> np.ndarray:
    """Per node (feature's place or -1, bin, rows left, their mean, rows right, their mean)."""
    cumulated = sums.cumsum(axis=2)
    n, s = cumulated[..., 0], cumulated[..., 1]
    whole_n, whole_s = n[..., -1:], s[..., -1:]
    right_n, right_s = whole_n - n, whole_s - s
    with np.errstate(divide="ignore", invalid="ignore"):
        children = s * s / n + right_s * right_s / right_n
        gain = np.where((n >= 1) & (right_n >= 1), children - whole_s * whole_s / whole_n, -np.inf)
        gain = np.where(gain > TIE * children, gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    top = flat.max(axis=1)
    first = (flat >= (top - TIE * np.abs(np.where(np.isfinite(top), top, 0.0)))[:, None]).argmax(axis=1)
    j, b = np.divmod(first, gain.shape[2])
    at = (np.arange(len(gain)), j, b)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.column_stack([np.where(np.isfinite(top), j, -1), b, n[at], s[at] / n[at], right_n[at], right_s[at] / right_n[at]])


def _by_tree(rows: DataFrame, trees: int) -> DataFrame:
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(trees, cores)), "tree").sortWithinPartitions("tree", "part")


def grow_levels(held: DataFrame, trees: list[Tree], binners: int, width: int, bins: int, most: int = 0) -> dict[int, list[int]]:
    """Grows the trees while they have open nodes of over ``most`` rows; {tree: nodes left open}."""
    sc, aside = held.sparkSession.sparkContext, {t.number: [] for t in trees}
    while growing := [t for t in trees if t.open]:
        for t in growing:
            t.choose(width)
        shapes = {t.number: (len(t.open), len(t.subsets[t.open[0]]), bins, 2) for t in growing}
        shared = sc.broadcast([t.shape() for t in growing])
        try:
            sums = held.mapInArrow(_level_sums(shared, binners, bins), _SUMS)
            merged = _by_tree(sums, len(growing)).mapInArrow(
                _merged(lambda tree, flat, shapes=shapes: best_splits(flat.reshape(shapes[tree]))), _SUMS)
            found = {r["tree"]: np.frombuffer(bytes(r["sums"])).reshape(-1, 6) for r in merged.collect()}
        finally:
            shared.destroy()
        for t in growing:
            if t.number not in found:
                raise ValueError(f"the training data of fold {t.fold} is empty")
            coming = []
            for node, (place, cut, left_n, left_mean, right_n, right_mean) in zip(t.open, found[t.number], strict=True):
                if place < 0:
                    continue
                left = t.split(node, int(t.subsets[node][int(place)]), int(cut), left_mean, right_mean)
                if t.level[left] < t.depth:
                    for child, n in ((left, left_n), (left + 1, right_n)):
                        if n > 1:
                            (coming if n > most else aside[t.number]).append(child)
            t.open, t.subsets = coming, {}
    return aside


# ---------------------------------------------------------------- the rest of a tree in one task
def grow_local(x: np.ndarray, y: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature, bin, left child) and (rows, labels, squared labels) of all nodes below one of the rows
    ``x`` (feature, row), ``y``: the node itself is number 0."""
    width = len(x)
    rows, starts, ids = np.arange(len(y)), np.array([0]), np.array([0])
    feature, cut, left = [np.zeros(1, np.int32)], [np.zeros(1, np.int32)], [np.full(1, -1, np.int32)]
    stats = [np.array([[len(y), y.sum(), y @ y]])]
    total = 1
    for _ in range(depth if y.min() < y.max() else 0):
        if not len(rows):
            break
        counts = np.diff(np.append(starts, len(rows)))
        seg = np.repeat(np.arange(len(starts)), counts)
        yr = y[rows]
        centred = yr - (np.add.reduceat(yr, starts) / counts)[seg]
        best, by, at = np.zeros(len(starts)), np.full(len(starts), -1), np.zeros(len(starts), np.int64)
        floor = TIE * np.add.reduceat(centred * centred, starts)
        order = np.arange(len(rows), dtype=np.int64)
        for f in range(width):
            key = np.sort((((seg << 8) | x[f][rows]) << 32) | order)
            cells = key >> 32
            sums = np.cumsum(centred[key & 0xFFFFFFFF])
            last = np.flatnonzero(cells[1:] != cells[:-1])              # of a cell; not of the node's last one
            node = cells[last] >> 8
            inner = node == cells[last + 1] >> 8
            last, node = last[inner], node[inner]
            if not len(last):
                continue
            before = np.where(starts > 0, sums[starts - 1], 0.0)
            s, n = sums[last] - before[node], last - starts[node] + 1.0
            gain = s * s * counts[node] / (n * (counts[node] - n))
            heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            top = np.maximum.reduceat(gain, heads)
            better = top > np.maximum(best[node[heads]] * (1 + TIE), floor[node[heads]])
            size = np.diff(np.append(heads, len(gain)))
            hits = np.flatnonzero((gain >= np.repeat(top * (1 - TIE), size)) & np.repeat(better, size))
            hits = hits[np.append(True, node[hits][1:] != node[hits][:-1])] if len(hits) else hits
            best[node[hits]], by[node[hits]], at[node[hits]] = gain[hits], f, cells[last[hits]] & 0xFF
        parents = np.flatnonzero(by >= 0)
        place = np.full(len(starts), -1)
        place[parents] = np.arange(len(parents))
        kept = place[seg] >= 0
        rows, seg = rows[kept], seg[kept]
        # the children's rows, each child's together
        child = 2 * place[seg] + (x[by[seg], rows] > at[seg])
        turn = np.sort((child << 32) | np.arange(len(child))) & 0xFFFFFFFF
        rows, child = rows[turn], child[turn]
        counts = np.bincount(child, minlength=2 * len(parents))
        first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        feature[-1][ids[parents]] = by[parents]
        cut[-1][ids[parents]] = at[parents]
        left[-1][ids[parents]] = total + 2 * np.arange(len(parents))
        yr = y[rows]
        many = 2 * len(parents)
        if not many:
            break
        feature.append(np.zeros(many, np.int32))
        cut.append(np.zeros(many, np.int32))
        left.append(np.full(many, -1, np.int32))
        stats.append(np.column_stack([counts, np.add.reduceat(yr, first), np.add.reduceat(yr * yr, first)]))
        total += many
        # only children whose labels differ go on
        on = np.minimum.reduceat(yr, first) < np.maximum.reduceat(yr, first)
        rows, ids = rows[on[child]], np.flatnonzero(on)
        starts = np.concatenate([[0], np.cumsum(counts[on])[:-1]]).astype(np.int64) if len(ids) else np.zeros(0, np.int64)
    return np.stack([np.concatenate(feature), np.concatenate(cut), np.concatenate(left)]).astype(np.int32), np.concatenate(stats)


def _send(shared, binners: int):
    """The rows of each node set aside, as one row a block."""
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("part", pa.int32()), ("block", pa.int64()),
                        ("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])

    def run(batches):
        trees, aside = shared.value
        for x, y, fold, block in _read(batches, binners):
            for group, xs, ys in _training_rows(trees, x, y, fold):
                for tree in group:
                    wanted = set(aside[tree[0]])
                    for node, rows in _members(tree, xs, np.arange(len(ys))):
                        if node in wanted and len(rows):
                            yield pa.RecordBatch.from_pylist(
                                [{"tree": tree[0], "node": int(node), "part": block >> 32, "block": block, "n": len(rows),
                                  "x": xs[:, rows].tobytes(), "y": ys[rows].tobytes()}], schema=schema)
    return run


def _grown(depths: dict):
    """Subtrees of the nodes whose rows come one after the other: one row a node."""
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("part", pa.int32()), ("block", pa.int64()),
                        ("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])

    def finished(key, held):
        n = sum(h[0] for h in held)
        x = np.concatenate([np.frombuffer(h[1], np.uint8).reshape(-1, h[0]) for h in held], axis=1)
        y = np.concatenate([np.frombuffer(h[2]) for h in held])
        links, stats = grow_local(x, y, depths[key])
        return pa.RecordBatch.from_pylist([{"tree": key[0], "node": key[1], "part": 0, "block": 0, "n": n,
                                            "x": links.tobytes(), "y": stats.tobytes()}], schema=schema)

    def run(batches):
        key, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["tree"], r["node"]) != key:
                    if held:
                        yield finished(key, held)
                    key, held = (r["tree"], r["node"]), []
                held.append((r["n"], r["x"], r["y"]))
        if held:
            yield finished(key, held)
    return run


def grow_deep(held: DataFrame, trees: list[Tree], binners: int, width: int, bins: int) -> dict[int, np.ndarray]:
    """Trees without draws to their depth: levels while nodes are large, then the rest of each node in one task.

    Returns what ``node_sums`` does.
    """
    aside = grow_levels(held, trees, binners, width, bins, LOCAL_ROWS)
    sums = node_sums(held, trees, binners)
    depths = {(t.number, node): t.depth - t.level[node] for t in trees for node in aside[t.number]}
    if not depths:
        return sums
    sc = held.sparkSession.sparkContext
    shared = sc.broadcast(([t.shape() for t in trees if aside[t.number]], aside))
    try:
        sent = held.mapInArrow(_send(shared, binners), _PARTS)
        meet = (sent.repartition(max(4 * sc.defaultParallelism, len(depths) // 16), "tree", "node")
                .sortWithinPartitions("tree", "node", "block"))
        grown = meet.mapInArrow(_grown(depths), _PARTS).select("tree", "node", "x", "y").collect()
    finally:
        shared.destroy()
    for t in trees:
        links = [np.array([t.feature, t.bin, t.left], np.int32)]
        stats, total = [sums[t.number]], len(t.left)
        for r in sorted((r for r in grown if r["tree"] == t.number), key=lambda r: r["node"]):
            own = np.frombuffer(bytes(r["x"]), np.int32).reshape(3, -1).copy()
            # the subtree's node 0 is the node itself, its others follow the tree's
            own[2] = np.where(own[2] >= 0, own[2] + total - 1, -1)
            links[0][:, r["node"]] = own[:, 0]
            links.append(own[:, 1:])
            stats.append(np.frombuffer(bytes(r["y"])).reshape(-1, 3)[1:])
            total += own.shape[1] - 1
        t.feature, t.bin, t.left = np.concatenate(links, axis=1)
        sums[t.number] = np.concatenate(stats)
        t.value = sums[t.number][:, 1] / sums[t.number][:, 0]
    return sums


# ---------------------------------------------------------------- scoring rows that a fold left out
def _leaf_errors(shared, binners: int, forests: dict):
    """(fold, forest) -> [squared errors, rows] of forests over the rows of the fold they left out."""
    def run(batches):
        trees, found, part = shared.value, {}, -1
        for x, y, fold, block in _read(batches, binners):
            part = block >> 32 if part < 0 else part
            for key, (k, b, members) in forests.items():
                rows = np.flatnonzero(fold == k)
                if not len(rows):
                    continue
                xs, total = np.ascontiguousarray(x[b][:, rows]), np.zeros(len(rows))
                for m in members:
                    tree, value = trees[m]
                    masks = _masks(tree, xs)
                    total += value[list(masks)][_numbered(masks.values(), len(rows))]
                e = y[rows] - total / len(members)
                found[key] = found.get(key, 0.0) + np.array([e @ e, len(rows)])
        yield from _packed(found, part)
    return run


def _depth_errors(shared, binners: int, depths: list[int]):
    """Tree -> [squared errors by depth..., rows] over the rows of the fold that the tree left out."""
    def run(batches):
        trees, found, part = shared.value, {}, -1
        for x, y, fold, block in _read(batches, binners):
            part = block >> 32 if part < 0 else part
            for number, b, k, feature, cut, left, value in trees:
                rows = np.flatnonzero(fold == k)
                if not len(rows):
                    continue
                node, errors = np.zeros(len(rows), np.int64), {}
                for level in range(max(depths) + 1):
                    if level in depths:
                        e = y[rows] - value[node]
                        errors[level] = e @ e
                    child = left[node]
                    node = np.where(child < 0, node, child + (x[b][feature[node], rows] > cut[node]))
                found[number] = found.get(number, 0.0) + np.array([*[errors[d] for d in depths], len(rows)])
        yield from _packed(found, part)
    return run


def _errors(held: DataFrame, run) -> dict[int, np.ndarray]:
    found: dict[int, np.ndarray] = {}
    for r in sorted(held.mapInArrow(run, _SUMS).collect(), key=lambda r: r["part"]):
        found[r["tree"]] = found.get(r["tree"], 0.0) + np.frombuffer(bytes(r["sums"]))
    return found


def forest_errors(held: DataFrame, forests: dict[int, list[Tree]], binners: int) -> dict[int, float]:
    """{forest: RMSE over the rows of the fold that its trees left out}; NaN without rows."""
    sc = held.sparkSession.sparkContext
    shared = sc.broadcast({t.number: (t.shape(), np.array(t.value)) for ts in forests.values() for t in ts})
    members = {key: (ts[0].fold, ts[0].binner, [t.number for t in ts]) for key, ts in forests.items()}
    try:
        found = _errors(held, _leaf_errors(shared, binners, members))
    finally:
        shared.destroy()
    return {key: float(np.sqrt(found[key][0] / found[key][1])) if key in found else float("nan") for key in forests}


def depth_errors(held: DataFrame, trees: list[Tree], depths: list[int], binners: int) -> dict[int, list[float]]:
    """{tree: RMSE by depth}: a tree cut at a depth predicts the mean of the node there."""
    sc = held.sparkSession.sparkContext
    shared = sc.broadcast([(t.number, t.binner, t.fold, np.asarray(t.feature), np.asarray(t.bin), np.asarray(t.left),
                            np.asarray(t.value, float)) for t in trees])
    try:
        found = _errors(held, _depth_errors(shared, binners, list(depths)))
    finally:
        shared.destroy()
    return {t.number: [float(np.sqrt(e / found[t.number][-1])) for e in found[t.number][:-1]] if t.number in found
            else [float("nan")] * len(depths) for t in trees}


# ---------------------------------------------------------------- the rows of every leaf
def _leaf_sums(shared, binners: int):
    """Per tree (leaf, [rows, labels, squared labels]) of a task's blocks."""
    def run(batches):
        trees, found, part = shared.value, {}, -1
        for x, y, fold, block in _read(batches, binners):
            part = block >> 32 if part < 0 else part
            for group, xs, ys in _training_rows(trees, x, y, fold):
                for tree in group:
                    drawn, left = tree[3], tree[7]
                    if drawn:
                        masks = _masks(tree, xs)
                        weight, node = _drawn(tree, block, len(ys)).astype(float), np.array(list(masks))[_numbered(masks.values(), len(ys))]
                    else:
                        weight, node = np.ones(len(ys)), np.zeros(len(ys), np.int64)
                        for v, rows in _members(tree, xs, np.arange(len(ys))):
                            node[rows] = v
                    sums = np.column_stack([np.bincount(node, v, minlength=len(left))
                                            for v in (weight, weight * ys, weight * ys * ys)])
                    found[tree[0]] = found[tree[0]] + sums if tree[0] in found else sums
        yield from _packed(found, part)
    return run


def node_sums(held: DataFrame, trees: list[Tree], binners: int) -> dict[int, np.ndarray]:
    """{tree: (node, [rows, labels, squared labels])}: leaves from one pass, inner nodes from their children."""
    sc = held.sparkSession.sparkContext
    shared = sc.broadcast([t.shape() for t in trees])
    try:
        merged = _by_tree(held.mapInArrow(_leaf_sums(shared, binners), _SUMS), len(trees)).mapInArrow(
            _merged(lambda tree, flat: flat), _SUMS)
        found = {r["tree"]: np.frombuffer(bytes(r["sums"])).reshape(-1, 3).copy() for r in merged.collect()}
    finally:
        shared.destroy()
    for t in trees:
        sums, left = found[t.number], np.asarray(t.left)
        for node in np.flatnonzero(left >= 0)[::-1]:                # children have higher numbers
            sums[node] = sums[left[node]] + sums[left[node] + 1]
    return found


def persisted(held: DataFrame) -> DataFrame:
    return held.persist(StorageLevel.MEMORY_AND_DISK)


def node_table(tree: Tree, sums: np.ndarray, binner: Binner, shift: float) -> pa.Table:
    """The nodes as ``pyspark.ml`` saves them."""
    left, feature, cut = (np.asarray(a) for a in (tree.left, tree.feature, tree.bin))
    inner, n, s = left >= 0, sums[:, 0], sums[:, 1]
    mean = s / n
    impurity = np.maximum(sums[:, 2] / n - mean * mean, 0.0)
    lower = np.where(inner, left, 0)
    gain = np.where(inner, impurity - n[lower] / n * impurity[lower] - n[np.where(inner, left + 1, 0)] / n
                    * impurity[np.where(inner, left + 1, 0)], -1.0)
    threshold = np.array([binner.candidates[f][b] if i else 0.0 for i, f, b in zip(inner, feature, cut, strict=True)])
    offsets = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, feature, -1), pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(threshold[inner])),
         pa.array(np.full(len(left), -1), pa.int32())], names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    squares = sums[:, 2] + 2 * shift * s + n * shift * shift
    stats = pa.ListArray.from_arrays(np.arange(0, 3 * len(left) + 1, 3, dtype=np.int32),
                                     pa.array(np.column_stack([n, s + n * shift, squares]).ravel()))
    return pa.table({"id": pa.array(np.arange(len(left)), pa.int32()), "prediction": mean + shift, "impurity": impurity,
                     "impurityStats": stats, "rawCount": pa.array(n.astype(np.int64)), "gain": gain,
                     "leftChild": pa.array(left, pa.int32()),
                     "rightChild": pa.array(np.where(inner, left + 1, -1), pa.int32()), "split": split})
