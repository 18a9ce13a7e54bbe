"""Language-model scoring with a causal self-attention model in numpy.

A text is its words (A-Z lower-cased, runs of non-white-space) joined by one
space, then an end token.  Words become subword ids of a public byte-level
BPE (never trained here); the model is one causal self-attention layer with
relative positions, a rectified layer, and a two-level softmax (class, then
member of the class) over the ``CLASSES * MEMBERS`` most frequent subwords.
Rarer subwords share an escape and then their add-one share of it, so the
probabilities of all subwords sum to one.  Long texts are cut into overlapping
windows: each scores SCORED tokens once and sees CONTEXT tokens before them.

Everything that is gathered grows with the corpus and is gathered by Spark:

* one pass over the training texts counts words and subwords and cuts every
  text into windows; partial counts are summed by grouped aggregates;
* the network starts from the corpus' subword shares and is trained by
  stochastic gradient descent on all windows: in every round each task
  trains a copy on its windows; the copies, whose number grows with the
  windows, are summed in groups and the sums averaged by parameter (a grouped
  aggregate); only one model reaches the driver;
* the pass that scores looks up frequent words in a broadcast table of at most
  ``KNOWN_WORDS`` entries; counts of all other words come by a join.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.words import Words, chunks
from featureflow.session import setting

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# fixed value: the pre-token pattern the vocabulary was built with
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTEXT, SCORED = 16, 32
WINDOW = CONTEXT + SCORED
LEAD = -(-CONTEXT // SCORED) * SCORED
DIM, INNER = 16, 32
CLASSES, MEMBERS = 32, 32
ROUNDS = 3                        # parameter averages
LEAST_STEPS = 240                 # steps (of BATCH windows) a copy makes in a round at least
BATCH = 32
WINDOWS_PER_COPY = 16384          # windows a copy is trained on (expected number)
# shuffle files go when the query that wrote them ends: a round deals all windows, no two rounds' lie on disk together
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
KNOWN_WORDS = 500_000             # word counts (16 bytes each) broadcast at most
END_WORD = np.uint64(0x454E44)    # the end token among word hashes
PAD = 0xFFFF


def read_ranks(path: str = TOKENIZER) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Subwords:
    """Subword ids of words; ``end`` and ``start`` follow the vocabulary's ids."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken
        self.coder = tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.start = self.end + 1
        self.opens = np.zeros(self.end, dtype=bool)
        self.opens[[i for b, i in ranks.items() if b[0] == 0x20]] = True

    def words(self, w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given words of a batch, each as if it followed a space, and where each word's ids begin.

        All are coded as one text: words hold no space, so an id that opens
        with a space opens a word.
        """
        if not len(which):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = w.end[which] - w.start[which] + 1
        stop = np.cumsum(size)
        text = w.data[np.minimum(np.repeat(w.start[which] - 1 - (stop - size), size) + np.arange(stop[-1]),
                                 len(w.data) - 1)]
        text[stop - size] = 0x20
        ids = np.array(self.coder.encode_ordinary(text.tobytes().decode("utf-8")), dtype=np.int64)
        return ids, np.flatnonzero(self.opens[ids])

    def stream(self, w: Words, h: np.ndarray):
        """Ids of all documents of a batch, each with a start and an end token, and the documents' bounds."""
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        flat, offset = self.words(w, first)
        lengths = np.diff(np.append(offset, len(flat)))
        assert len(lengths) == len(uniq)
        flat = np.append(flat, [self.start, self.end])
        lengths = np.append(lengths, [1, 1])
        offset = np.append(offset, [len(flat) - 2, len(flat) - 1])
        n = len(w.bounds) - 1
        docs = np.insert(inverse, np.stack([w.bounds[:-1], w.bounds[1:]], axis=1).ravel(),
                         np.tile([len(uniq), len(uniq) + 1], n))
        bounds = w.bounds + 2 * np.arange(n + 1)
        size = lengths[docs]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = flat[np.repeat(offset[docs] - ends[:-1], size) + np.arange(ends[-1])]
        return out, ends[bounds], (uniq, first, inverse)


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First scored input of every window, and its document."""
    predictions = np.diff(bounds) - 1
    number = -(-predictions // SCORED)
    edge = np.concatenate([[0], np.cumsum(number)])
    doc = np.repeat(np.arange(len(number)), number)
    return bounds[:-1][doc] + SCORED * (np.arange(edge[-1]) - edge[:-1][doc]), doc


def gather(stream: np.ndarray, bounds: np.ndarray, at: np.ndarray, doc: np.ndarray, pad: int) -> np.ndarray:
    """(windows, WINDOW + 1) ids: inputs, then one more for the last target; ``pad`` outside the document."""
    where = at[:, None] + np.arange(-CONTEXT, SCORED + 1)
    inside = (where >= bounds[:-1][doc][:, None]) & (where < bounds[1:][doc][:, None])
    return np.where(inside, stream[np.where(inside, where, 0)], pad)


_DISTANCE = (CONTEXT + np.arange(SCORED))[:, None] - np.arange(WINDOW)[None, :]
_NEAR = np.maximum(_DISTANCE, 0)
NO_OUTPUT = CLASSES * MEMBERS + 2     # the place of PAD
_CLASS = np.minimum(np.arange(NO_OUTPUT + 1) // MEMBERS, CLASSES).astype(np.uint8)      # one byte: sorted by counting
_CLASS[NO_OUTPUT] = CLASSES + 1


def _held(z: np.ndarray) -> np.ndarray:
    """``z`` with its values held below what exp can take."""
    return np.minimum(z, 80, out=z)


def _largest(z: np.ndarray) -> float:
    """The largest absolute value (two passes without a copy)."""
    return max(float(z.max(initial=0)), -float(z.min(initial=0)))


def _exp(z: np.ndarray, largest: float) -> np.ndarray:
    """exp of ``z`` in place, each row up to a factor: 1 if exp can take ``largest``, the largest absolute value."""
    if largest > 80:
        z -= z.max(axis=-1, keepdims=True, initial=-np.inf)
    return np.exp(z, out=z)


def _with_ones(x: np.ndarray) -> np.ndarray:
    """``x`` and a last column of ones, so that offsets are one more row of the weights."""
    out = np.empty((len(x), x.shape[1] + 1), np.float32)
    out[:, :-1], out[:, -1] = x, 1
    return out


def _by_class(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the outputs are that are not PAD, sorted by class, and the bounds of each class (the escape last)."""
    group = _CLASS[y]
    edges = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=CLASSES + 2))[:-1]])
    return np.argsort(group, kind="stable")[:edges[-1]], edges


class Attention:
    """The network; ``params`` are float32 arrays by name, ``place`` maps subwords to outputs."""

    def __init__(self, counts: np.ndarray, seed: int = 1):
        """``counts``: corpus count of every subword id, the end token included."""
        size = CLASSES * MEMBERS
        order = np.argsort(-counts, kind="stable")[:size]
        self.place = np.full(PAD + 1, size, dtype=np.int32)          # tail subwords: the escape
        self.place[order] = (np.arange(len(order)) % CLASSES) * MEMBERS + np.arange(len(order)) // CLASSES
        self.place[len(counts)] = size + 1                            # start
        self.place[PAD] = size + 2
        tail = np.ones(len(counts), dtype=bool)
        tail[order] = False
        share = np.where(tail, counts + 1.0, 0)
        self.tail = np.zeros(PAD + 1)
        if tail.any():
            self.tail[:len(counts)] = np.where(tail, np.log(np.maximum(share, 1) / share.sum()), 0)
        mass = np.zeros(size)
        mass[self.place[order]] = counts[order] + 1.0
        mass = mass.reshape(CLASSES, MEMBERS)
        rng = np.random.default_rng(seed)
        normal = lambda *shape, s: rng.normal(0, s, shape)            # noqa: E731
        groups = np.append(mass.sum(axis=1), max(share.sum(), 1.0))
        self.params = {k: v.astype(np.float32) for k, v in {
            "embed": normal(size + 3, DIM, s=0.3), "q": normal(DIM, DIM, s=0.2), "k": normal(DIM, DIM, s=0.2),
            "v": normal(DIM, DIM, s=0.2), "o": normal(DIM, DIM, s=0.1), "rel": np.zeros(WINDOW),
            "w1": normal(DIM, INNER, s=0.2), "b1": np.zeros(INNER), "w2": normal(INNER, DIM, s=0.1),
            "group": normal(DIM, CLASSES + 1, s=0.05), "group0": np.log(groups / groups.sum()),
            "member": normal(CLASSES, DIM, MEMBERS, s=0.05),
            "member0": np.log((mass + 1e-3) / (mass + 1e-3).sum(axis=1, keepdims=True))}.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.params.values()])

    def load(self, flat: np.ndarray) -> None:
        self.params = self._views(flat.astype(np.float32))

    def _attend(self, x: np.ndarray, rows: np.ndarray):
        """The layers over windows ``x`` of places, from the context on for the flat positions ``rows`` alone.

        Weights ``s`` are not normalised: the last column of the values, one
        (zero for PAD, which so has no part in any sum), makes their sums.
        """
        p = self.params
        e = p["embed"].take(x, axis=0)
        own = e[:, CONTEXT:].reshape(-1, DIM)
        q = (own @ (p["q"] * np.float32(DIM ** -0.5))).reshape(len(x), SCORED, DIM)
        kv = np.empty((*x.shape, 2 * DIM + 1), np.float32)
        np.matmul(e.reshape(-1, DIM), np.concatenate([p["k"], p["v"]], axis=1), out=kv.reshape(-1, 2 * DIM + 1)[:, :-1])
        kv[:, :, -1] = 1
        k, v = kv[:, :, :DIM], kv[:, :, DIM:]
        empty = x == NO_OUTPUT
        v[empty] = 0
        s = q @ k.transpose(0, 2, 1)
        largest = _largest(s) + _largest(p["rel"])
        s += np.where(_DISTANCE >= 0, p["rel"][_NEAR], np.float32(-1e9))
        if largest > 80:
            s += np.where(empty, np.float32(-1e9), np.float32(0))[:, None, :]
        _exp(s, largest)
        c = (s @ v).reshape(-1, DIM + 1).take(rows, axis=0)
        sums = c[:, DIM:]
        c = c[:, :DIM] / sums
        h = _with_ones(own.take(rows, axis=0) + c @ p["o"])
        m = h @ np.concatenate([p["w1"], p["b1"][None]])
        np.maximum(m, 0, out=m)
        return e, q, k, v, empty, s, sums, c, h, m, _with_ones(h[:, :DIM] + m @ p["w2"])

    def _output_weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the classes and of the members, the offsets as a last row."""
        p = self.params
        return (np.concatenate([p["group"], p["group0"][None]]),
                np.concatenate([p["member"], p["member0"][:, None]], axis=1))

    def _target_logs(self, g: np.ndarray, y: np.ndarray, raw: np.ndarray, edges: np.ndarray,
                     weights: tuple) -> np.ndarray:
        """Natural logs of the probabilities of outputs ``y`` (raw ids ``raw``, sorted by class) given the last
        layer ``g`` and a one."""
        ones = np.ones(max(CLASSES + 1, MEMBERS), np.float32)
        z = _held(g @ weights[0])
        logp = z[np.arange(len(y)), _CLASS[y]] + self.tail[raw]
        logp -= np.log(np.exp(z, out=z) @ ones[:CLASSES + 1])
        some = edges[CLASSES]                                           # the escape has no members
        z = np.empty((some, MEMBERS), np.float32)
        for c in range(CLASSES):
            np.dot(g[edges[c]:edges[c + 1]], weights[1][c], out=z[edges[c]:edges[c + 1]])
        _held(z)
        logp[:some] += z[np.arange(some), y[:some] % MEMBERS]
        logp[:some] -= np.log(np.exp(z, out=z) @ ones[:MEMBERS])
        return logp

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """(windows, SCORED) natural logs of the targets' probabilities; 0 where there is no target."""
        target = ids[:, CONTEXT + 1:]
        raw = target.ravel()
        rows, edges = _by_class(self.place[raw])
        out = np.zeros(raw.shape)
        g = self._attend(self.place[ids[:, :-1]], rows)[-1]
        out[rows] = self._target_logs(g, self.place[raw[rows]], raw[rows], edges, self._output_weights())
        return out.reshape(target.shape)

    def document_scores(self, stream: np.ndarray, bounds: np.ndarray, at_once: int = 128) -> np.ndarray:
        """Sum of the logs of every document's tokens after its start token.

        Documents are laid out one after the other, each behind LEAD empty
        places and filled up to whole windows, so that all overlapping windows
        are one strided view and keys and values are computed once a token.
        """
        p = self.params
        predictions = np.diff(bounds) - 1
        number = -(-predictions // SCORED)
        begin = np.concatenate([[0], np.cumsum(LEAD + number * SCORED)])
        laid = np.full(begin[-1] + 1, PAD, dtype=np.int64)
        doc = np.repeat(np.arange(len(number)), predictions + 1)
        laid[np.arange(len(stream)) - bounds[:-1][doc] + (begin[:-1] + LEAD)[doc]] = stream
        total = np.zeros(len(number))
        # one more token than inputs stands where the next document's empty places begin: it is only a target
        inputs, targets = laid[:-1].copy(), laid[1:].copy()
        last = begin[:-1] + LEAD + predictions
        inputs[last[last < len(inputs)]] = PAD
        targets[begin[:-1] + LEAD - 1] = PAD
        owner = np.repeat(np.arange(len(number)), LEAD + number * SCORED)
        bias = np.where(_DISTANCE >= 0, p["rel"][_NEAR], np.float32(-1e9))
        weights = self._output_weights()
        first = np.concatenate([p["w1"], p["b1"][None]])
        # queries, keys and values of every place; empty places have no part in any sum
        q_of, k_of, v_of = p["embed"] @ (p["q"] * np.float32(DIM ** -0.5)), p["embed"] @ p["k"], \
            _with_ones(p["embed"] @ p["v"])
        v_of[NO_OUTPUT] = 0
        view = np.lib.stride_tricks.as_strided
        for low in range(0, len(inputs) - LEAD, at_once * SCORED):
            part = slice(low, min(len(inputs), low + LEAD + at_once * SCORED))
            x = self.place[inputs[part]]
            k, v, own = k_of.take(x, axis=0), v_of.take(x, axis=0), x[LEAD:]
            n = len(own) // SCORED
            keys = view(k[LEAD - CONTEXT:], (n, WINDOW, DIM), (SCORED * k.strides[0], *k.strides))
            values = view(v[LEAD - CONTEXT:], (n, WINDOW, DIM + 1), (SCORED * v.strides[0], *v.strides))
            s = q_of.take(own, axis=0).reshape(n, SCORED, DIM) @ keys.transpose(0, 2, 1)
            s += bias
            np.exp(_held(s), out=s)
            wanted = targets[part][LEAD:]
            live, edges = _by_class(self.place[wanted])
            c = (s @ values).reshape(-1, DIM + 1).take(live, axis=0)
            h = _with_ones(p["embed"].take(own[live], axis=0) + (c[:, :DIM] / c[:, DIM:]) @ p["o"])
            m = h @ first
            g = _with_ones(h[:, :DIM] + np.maximum(m, 0, out=m) @ p["w2"])
            raw = wanted[live]
            logs = self._target_logs(g, self.place[raw], raw, edges, weights)
            total += np.bincount(owner[part][LEAD:][live], weights=logs, minlength=len(total))
        return total

    def gradients(self, ids: np.ndarray, out: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log probability of the targets of a batch of windows (written to ``out``)."""
        p = self.params
        grads = {name: np.empty_like(value) for name, value in p.items()} if out is None else out
        x, target = self.place[ids[:, :-1]], self.place[ids[:, CONTEXT + 1:]].ravel()
        # targets sorted by class, so that a class' rows are one slice
        rows, edges = _by_class(target)
        e, q, k, v, empty, s, sums, c, h, m, g = self._attend(x, rows)
        y = target[rows]
        n = max(len(y), 1)
        ones = np.ones(max(CLASSES + 1, MEMBERS, len(x)), np.float32)
        weights = self._output_weights()

        z = g @ weights[0]
        _exp(z, _largest(z))
        z *= (1 / (n * (z @ ones[:CLASSES + 1])))[:, None]
        z.reshape(-1)[np.arange(0, z.size, CLASSES + 1) + _CLASS[y]] -= np.float32(1 / n)
        both = g.T @ z
        grads["group"][:], grads["group0"][:] = both[:DIM], both[DIM]
        dg = z @ p["group"].T
        slices = [slice(a, b) for a, b in zip(edges[:CLASSES].tolist(), edges[1:CLASSES + 1].tolist())]
        some = edges[CLASSES]                                           # the escape has no members
        z = np.empty((some, MEMBERS), np.float32)
        for i, own in enumerate(slices):
            np.dot(g[own], weights[1][i], out=z[own])
        _exp(z, _largest(z))
        z *= (1 / (n * (z @ ones[:MEMBERS])))[:, None]
        z.reshape(-1)[np.arange(0, z.size, MEMBERS) + y[:some] % MEMBERS] -= np.float32(1 / n)
        both, own_dg = np.empty_like(weights[1]), np.empty((some, DIM), np.float32)
        for i, own in enumerate(slices):
            np.dot(g[own].T, z[own], out=both[i])
            np.dot(z[own], p["member"][i].T, out=own_dg[own])
        grads["member"][:], grads["member0"][:] = both[:, :DIM], both[:, DIM]
        dg[:some] += own_dg

        np.matmul(m.T, dg, out=grads["w2"])
        dm = dg @ p["w2"].T
        dm *= m > 0
        both = h.T @ dm
        grads["w1"][:], grads["b1"][:] = both[:DIM], both[DIM]
        dh = dg + dm @ p["w1"].T
        np.matmul(c.T, dh, out=grads["o"])
        # what a weight takes from the others by the common sum goes with the values' last column
        dc = np.zeros((len(x) * SCORED, DIM + 1), np.float32)
        own = dh @ p["o"].T
        own = _with_ones(own / sums)
        own[:, DIM] = -np.einsum("ij,ij->i", own[:, :DIM], c)
        dc[rows] = own
        dc = dc.reshape(len(x), SCORED, DIM + 1)
        dkv = np.empty((len(x), WINDOW, 2 * DIM), np.float32)
        np.matmul(s.transpose(0, 2, 1), dc[:, :, :DIM], out=dkv[:, :, DIM:])
        dkv[empty] = 0
        ds = dc @ v.transpose(0, 2, 1)
        ds *= s
        np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :DIM])
        grads["rel"][:] = np.bincount(_NEAR.ravel(), weights=ones[:len(x)] @ ds.reshape(len(x), -1), minlength=WINDOW)
        dq = (ds @ k).reshape(-1, DIM)
        dq *= np.float32(DIM ** -0.5)
        np.matmul(e[:, CONTEXT:].reshape(-1, DIM).T, dq, out=grads["q"])
        both = e.reshape(-1, DIM).T @ dkv.reshape(-1, 2 * DIM)
        grads["k"][:], grads["v"][:] = both[:, :DIM], both[:, DIM:]
        de = dkv.reshape(-1, 2 * DIM) @ np.concatenate([p["k"], p["v"]], axis=1).T
        own = dq @ p["q"].T
        own[rows] += dh
        de = de.reshape(len(x), WINDOW, DIM)
        de[:, CONTEXT:] += own.reshape(len(x), SCORED, DIM)
        grads["embed"][:] = 0
        np.add.at(grads["embed"].reshape(-1), (x.reshape(-1, 1) * DIM + np.arange(DIM)).ravel(), de.ravel())
        return grads

    def train(self, ids: np.ndarray, rate: float, steps: int, seed: int) -> None:
        """``steps`` steps of Adam over random batches of windows (rows of ``ids``)."""
        rng = np.random.default_rng(seed)
        flat = self.vector()
        self.params = self._views(flat)
        g, m, v, change = (np.zeros_like(flat) for _ in range(4))
        grads = self._views(g)
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < min(BATCH, len(ids)):
                order = np.concatenate([order, rng.permutation(len(ids))])
            own, order = order[:BATCH], order[BATCH:]
            self.gradients(ids[own], grads)
            # m and v are kept 10 and 100 times as large: passes over all parameters are what a step of Adam takes
            m *= np.float32(0.9)
            m += g
            v *= np.float32(0.99)
            g *= g
            v += g
            late = (0.01 / (1 - 0.99 ** step)) ** 0.5
            np.sqrt(v, out=change)
            change += np.float32(1e-8 / late)
            np.divide(m, change, out=change)
            change *= np.float32(rate * 0.1 / (1 - 0.9 ** step) / late)
            flat -= change

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of ``flat`` that hold each parameter."""
        ends = np.cumsum([v.size for v in self.params.values()])
        return {k: part.reshape(v.shape) for (k, v), part in zip(self.params.items(), np.split(flat, ends[:-1]))}


# ---------------------------------------------------------------- Spark passes
def _counting(ranks):
    """Rows (kind, key, n, ids): 0 word hash and count, 1 subword and count, 2 a window and its number (key)."""

    def rows(kind, key, n, ids=None):
        size = len(key)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, kind, np.int32)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64)),
             ids if ids is not None else pa.nulls(size, pa.binary())], ["kind", "key", "n", "ids"])

    def run(batches):
        coder = Subwords(ranks)
        pieces = np.zeros(coder.start + 1, dtype=np.int64)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        for batch in batches:
            for part in chunks(batch, "text", 8 << 20):
                w = Words(part.column("text"), lower=True)
                stream, bounds, (uniq, _, inverse) = coder.stream(w, w.hashes())
                pieces += np.bincount(stream, minlength=len(pieces))
                times = np.bincount(inverse, minlength=len(uniq))
                yield rows(0, np.append(uniq, END_WORD).view(np.int64), np.append(times, part.num_rows))
                at, doc = windows(bounds)
                for k in range(0, len(at), 4096):
                    ids = gather(stream, bounds, at[k:k + 4096], doc[k:k + 4096], PAD).astype(np.uint16)
                    edges = np.arange(len(ids) + 1, dtype=np.int32) * (2 * ids.shape[1])
                    yield rows(2, number + np.arange(len(ids)), np.ones(len(ids)), pa.Array.from_buffers(
                        pa.binary(), len(ids), [None, pa.py_buffer(edges), pa.py_buffer(ids)]))
                    number += len(ids)
        used = np.flatnonzero(pieces)
        used = used[used != coder.start]
        yield rows(1, used, pieces[used])
    return run


def _copy(model: Attention, rate: float, round_number: int):
    """One trained copy per task: (task, values * weight as float64, weight)."""

    def run(batches):
        ids = [x for batch in batches for x in batch.column("ids").to_pylist()]
        if not ids:
            return
        ids = np.frombuffer(b"".join(ids), dtype=np.uint16).reshape(-1, WINDOW + 1).astype(np.int32)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        steps = max(LEAST_STEPS, -(-len(ids) // BATCH))
        model.train(ids, rate, steps, seed=1000 * round_number + part)
        flat = model.vector().astype(np.float64) * len(ids)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([flat.tobytes()], pa.binary()),
                                          pa.array([float(len(ids))])], ["part", "v", "w"])
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a task's copies: (i, value * weight, weight) for every parameter."""
    total, weight = 0.0, 0.0
    for batch in batches:
        for v, w in zip(batch.column("v"), batch.column("w").to_pylist()):
            total, weight = total + np.frombuffer(v.as_buffer(), np.float64), weight + w
    if weight:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total),
                                          pa.array(np.full(len(total), weight))], ["i", "v", "w"])


def train(gathered: DataFrame, subwords: int) -> Attention:
    """The network, from the gathered subword counts and windows."""
    found = (gathered.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))).toArrow()
    counts = np.zeros(subwords, dtype=np.float64)            # one entry per id of the vocabulary
    counts[found.column("key").to_numpy()] = found.column("n").to_numpy()
    model = Attention(counts)
    cut = gathered.filter("kind = 2").select("key", "ids")
    number = cut.count()
    if not number:
        return model
    # dealt by the stored number: a lost task deals the same windows again, and equal windows spread over the copies
    copies = -(-number // WINDOWS_PER_COPY)
    groups = math.ceil(math.sqrt(copies))                    # whose sums go to the average by parameter
    for r in range(ROUNDS):
        mean = (cut.repartition(copies, F.xxhash64("key", F.lit(r))).select("ids")
                .mapInArrow(_copy(model, 0.03 / 3 ** r, r), "part int, v binary, w double")
                .repartition(groups, "part").mapInArrow(_summed, "i int, v double, w double")
                .groupBy("i").agg((F.sum("v") / F.sum("w")).alias("v")).toArrow())
        flat = np.empty(mean.num_rows)
        flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
        model.load(flat)
    return model


def _known_words(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes (sorted) and counts of the most frequent words, at most KNOWN_WORDS, and the count they reach."""
    scale = F.floor(F.log2("c")).cast("int")
    sizes = {r["b"]: r["n"] for r in counts.groupBy(scale.alias("b")).agg(F.count("*").alias("n")).collect()}
    total, least = 0, 62
    for b in sorted(sizes, reverse=True):
        if total + sizes[b] > KNOWN_WORDS:
            break
        total, least = total + sizes[b], b
    some = counts.filter(F.col("c") >= 1 << least).toArrow()
    keys = some.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], some.column("c").to_numpy()[order], 1 << least


def _scoring(ranks, model: Attention, keys: np.ndarray, counts: np.ndarray):
    def run(batches) -> Iterator[pa.RecordBatch]:
        coder = Subwords(ranks)
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        logs = np.log10(counts + 1.0)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                w = Words(part.column("text"), lower=True)
                h = w.hashes()
                stream, bounds, (uniq, _, inverse) = coder.stream(w, h)
                score = model.document_scores(stream, bounds)
                place = np.minimum(np.searchsorted(keys, uniq), max(len(keys) - 1, 0))
                common = keys[place] == uniq if len(keys) else np.zeros(len(uniq), bool)
                per_word = np.where(common, logs[place], 0) if len(keys) else np.zeros(len(uniq))
                sums = np.concatenate([[0], np.cumsum(per_word[inverse])])
                known = np.concatenate([[0], np.cumsum(common[inverse])])
                a, b = w.bounds[:-1], w.bounds[1:]
                # (document, distinct word) pairs of the other words, in one sort
                other = np.flatnonzero(~common[inverse])
                owner = np.repeat(np.arange(part.num_rows), b - a)[other]
                pairs, times = np.unique(owner * len(uniq) + inverse[other], return_counts=True)
                whose, which = np.divmod(pairs, max(len(uniq), 1))
                rare = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(whose, np.arange(part.num_rows + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(uniq[which].view(np.int64)), pa.array(times.astype(np.int64))],
                                               ["key", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + part.num_rows)), part.column("id"), part.column("held_out"),
                     pa.array(b - a + 1), pa.array(known[b] - known[a]), pa.array(sums[b] - sums[a]),
                     pa.array(score / np.log(10)), rare],
                    ["row", "id", "held_out", "n_tokens", "known", "sums", "score", "rare"])
                row += part.num_rows
    return run


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
          tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``held_out`` is a Column; the model and the counts learn from all rows for
    which it is FALSE (a NULL, as for a NULL id, is scored as not held out but
    not learnt from).  ``score`` is the model's log10 probability of the text,
    ``base_score`` that of an add-one unigram model over words and the end
    token.  NULL, empty and blank texts are the end token alone.  Repeated
    rows count and are scored like others; other columns are not read.  With
    nothing to learn from, counts are 0 and the model is its start.
    """
    ranks = read_ranks(tokenizer)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held"))
    with setting(docs.sparkSession, CLEAN_UP, "true"):
        gathered = stored(rows.filter("NOT held").select("text").mapInArrow(
            _counting(ranks), "kind int, key long, n long, ids binary"), "lm-gathered")
        counts = stored(gathered.filter("kind = 0").groupBy("key").agg(F.sum("n").alias("c")).filter("c > 0"), "lm-words")
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                           F.coalesce(F.sum(F.when(F.col("key") == int(END_WORD), F.col("c"))), F.lit(0)).alias("end")).first()
        model = train(gathered, max(ranks.values()) + 2)
        keys, known, _ = _known_words(counts)
        kind = rows.schema["id"].dataType.simpleString()
        scored = stored(rows.select("id", "text", F.coalesce("held", F.lit(False)).alias("held_out")).mapInArrow(
            _scoring(ranks, model, keys, known),
            f"row long, id {kind}, held_out boolean, n_tokens long, known long, sums double, score double, "
            "rare array<struct<key: long, n: long>>"), "lm-scored")
    rest = (scored.select("row", F.explode("rare").alias("x")).select("row", "x.key", "x.n").join(counts, "key")
            .groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("sum")))
    base = F.log10(F.lit(float(total["n"] + total["v"] + 1)))
    return (scored.drop("rare").join(rest, "row", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(1 if total["end"] else 0)).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("sums") + F.coalesce("sum", F.lit(0.0)) + F.log10(F.lit(total["end"] + 1.0))
         - F.col("n_tokens") * base).alias("base_score"), "score"))
