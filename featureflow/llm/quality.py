"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it.  Learned filters
slide over the bytes of a chunk, each filter's maximum in the chunk is kept
(rectified), and the mean and the maximum of the chunks' values over the whole
text go into one logistic unit.  Training back-propagates through the maxima
into the filters and the byte embeddings; it runs on the driver on a bounded
sample of labelled rows, half of each class, and the prior of the classes is
put back into the intercept.

For scoring, embedding times filter is a table per position in the filter, so
a filter costs one lookup and one addition per byte and position.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from featureflow.llm.words import Words, chunks

HALF = 128                        # chunks are two halves long and start every half
WIDTH = 7                         # bytes a filter sees
FILTERS = 12
EMBED = 8
SEGMENT = HALF << 10              # bytes convolved at a time
SHORT = 0.3                       # share of training steps that see a short piece of a text only
SAMPLE_PER_CLASS = 1500           # labelled rows of each class learnt from (expected number)
CHUNKS_PER_STEP = 12              # chunks of a document used in one training step


@dataclass
class QualityModel:
    """Lookup tables (WIDTH, 256, FILTERS), filter biases, output weights (2 * FILTERS) and intercept."""

    tables: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of each text ``data[offsets[i]:offsets[i + 1]]``.

        Runs of short texts are convolved together; a text over a segment long
        is taken segment by segment, whose chunks join without a gap.
        """
        n = len(offsets) - 1
        total, number = np.zeros((n, FILTERS)), np.zeros(n)
        top = np.zeros((n, FILTERS))
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SEGMENT, side="right")) - 1)
            if j > i + 1 or offsets[j] - offsets[i] <= SEGMENT:
                part = self._pooled(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                total[i:j], number[i:j], top[i:j] = part
            else:
                size = int(offsets[j] - offsets[i])
                halves = -(-(size - WIDTH + 1) // HALF)
                for h in range(0, halves - 1, SEGMENT // HALF):
                    low = int(offsets[i]) + h * HALF
                    high = min(int(offsets[j]), low + SEGMENT + HALF + WIDTH - 1)
                    s, c, t = self._pooled(data[low:high], np.array([0, high - low]))
                    total[i] += s[0]
                    number[i] += c[0]
                    top[i] = np.maximum(top[i], t[0])
            i = j
        mean = total / np.maximum(number, 1)[:, None]
        z = np.concatenate([mean, top], axis=1) @ self.out + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def _pooled(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum, number and maximum of the pooled chunks of each text."""
        n = len(offsets) - 1
        total, top, number = np.zeros((n, FILTERS)), np.zeros((n, FILTERS)), np.zeros(n)
        sizes = np.diff(offsets) - WIDTH + 1
        full = np.flatnonzero(sizes > 0)
        if not len(full):
            return total, number, top
        m = len(data) - WIDTH + 1
        conv = self.tables[0][data[:m]]
        for j in range(1, WIDTH):
            conv += self.tables[j][data[j:j + m]]
        halves = -(-sizes[full] // HALF)
        first = np.concatenate([[0], np.cumsum(halves)])
        low = np.repeat(offsets[:-1][full], halves)
        low = low + HALF * (np.arange(first[-1]) - np.repeat(first[:-1], halves))
        high = np.minimum(low + HALF, np.repeat(offsets[:-1][full] + sizes[full], halves))
        cuts = np.stack([low, high], axis=1).ravel()
        if cuts[-1] >= m:
            cuts = cuts[:-1]
        most = np.maximum.reduceat(conv, cuts, axis=0)[::2]
        follows = np.ones(len(most), dtype=bool)
        follows[first[1:] - 1] = False
        pair = most.copy()
        at = np.flatnonzero(follows)
        pair[at] = np.maximum(most[at], most[at + 1])
        alone = halves == 1
        follows[first[:-1][alone]] = True
        pooled = np.maximum(pair[follows] + self.bias, 0)
        number[full] = np.where(alone, 1, halves - 1)
        begins = np.concatenate([[0], np.cumsum(number[full].astype(np.int64))[:-1]])
        total[full] = np.add.reduceat(pooled, begins, axis=0)
        top[full] = np.maximum.reduceat(pooled, begins, axis=0)
        return total, number, top


def _pieces(data: np.ndarray, rng) -> tuple[np.ndarray, int]:
    """(k, 2 * HALF) bytes of at most CHUNKS_PER_STEP of the text's overlapping chunks, and the bytes in use.

    Now and then a short piece between two spaces stands for the text, so that
    short texts are judged by what they hold and not by their length.
    """
    size = 2 * HALF
    if len(data) > 20 and rng.random() < SHORT:
        gaps = np.flatnonzero(data[:-1] == 32)
        if len(gaps) > 2:
            at = int(gaps[rng.integers(0, len(gaps))]) + 1
            stop = gaps[gaps > at + int(rng.integers(8, 160))]
            data = data[at:int(stop[0]) if len(stop) else len(data)]
    if len(data) <= size:
        return np.pad(data, (0, size - len(data)))[None, :], max(len(data), WIDTH)
    starts = np.arange(0, len(data) - HALF, HALF)
    if len(starts) > CHUNKS_PER_STEP:
        starts = rng.choice(starts, CHUNKS_PER_STEP, replace=False)
    return np.stack([data[s:s + size] if s + size <= len(data) else data[-size:] for s in starts]), size


def fit(texts: list[str], labels: list[int], prior: float, epochs: int = 4, least_steps: int = 700,
        seed: int = 11) -> QualityModel:
    """Train on the given rows (labels 0 and 1); ``prior`` is the share of label 1 where the model is used.

    ``epochs`` passes, or as many as make ``least_steps`` steps of 16 rows.
    """
    rng = np.random.default_rng(seed)
    data = [np.frombuffer(t.encode("utf-8", "replace"), dtype=np.uint8) for t in texts]
    y = np.asarray(labels, dtype=np.float64)
    embed = rng.normal(0, 0.5, (256, EMBED))
    filters = rng.normal(0, 0.3, (WIDTH, EMBED, FILTERS))
    bias = np.zeros(FILTERS)
    out = rng.normal(0, 0.2, 2 * FILTERS)
    intercept = 0.0
    params = [embed, filters, bias, out]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    usable = np.flatnonzero([len(d) >= WIDTH for d in data])
    step = 0
    m0 = v0 = 0.0
    for _ in range(max(epochs, -(-16 * least_steps // max(1, len(usable))))):
        order = rng.permutation(usable)
        for k in range(0, len(order), 16):
            own = order[k:k + 16]
            mats = [_pieces(data[i], rng) for i in own]
            lengths = [seen for _, seen in mats]
            mats = [x for x, _ in mats]
            rows = np.concatenate(mats)
            counts = np.array([len(m) for m in mats])
            begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
            m = 2 * HALF - WIDTH + 1
            tables = np.einsum("be,jef->jbf", embed, filters).astype(np.float32)
            conv = tables[0][rows[:, :m]]
            for j in range(1, WIDTH):
                conv += tables[j][rows[:, j:j + m]]
            valid = np.repeat(np.array(lengths) - WIDTH + 1, counts)
            if (valid < m).any():
                conv[np.arange(m)[None, :] >= valid[:, None]] = -1e9
            where = conv.argmax(axis=1)
            raw = np.take_along_axis(conv, where[:, None, :], axis=1)[:, 0, :] + bias
            pooled = np.maximum(raw, 0)
            mean = np.add.reduceat(pooled, begins, axis=0) / counts[:, None]
            top = np.maximum.reduceat(pooled, begins, axis=0)
            z = np.concatenate([mean, top], axis=1) @ out + intercept
            dz = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[own]) / len(own)
            dout = np.concatenate([mean, top], axis=1).T @ dz + 1e-4 * out
            doc = np.repeat(np.arange(len(own)), counts)
            dp = (dz / counts)[doc][:, None] * out[:FILTERS]
            dp = dp + (pooled == top[doc]) * dz[doc][:, None] * out[FILTERS:]
            dp = dp * (raw > 0)
            dbias = dp.sum(axis=0)
            dtables = np.zeros((WIDTH, 256, FILTERS))
            r, f = np.nonzero(dp)
            for j in range(WIDTH):
                np.add.at(dtables[j], (rows[r, where[r, f] + j], f), dp[r, f])
            dembed = np.einsum("jbf,jef->be", dtables, filters)
            dfilters = np.einsum("be,jbf->jef", embed, dtables)
            step += 1
            di = dz.sum()
            m0, v0 = 0.9 * m0 + 0.1 * di, 0.999 * v0 + 0.001 * di * di
            scale = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            intercept -= 0.01 * scale * m0 / (np.sqrt(v0) + 1e-8)
            for p, g, mv in zip(params, (dembed, dfilters, dbias, dout), moments, strict=True):
                mv[0] = 0.9 * mv[0] + 0.1 * g
                mv[1] = 0.999 * mv[1] + 0.001 * g * g
                p -= 0.01 * scale * mv[0] / (np.sqrt(mv[1]) + 1e-8)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    intercept += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    tables = np.einsum("be,jef->jbf", embed, filters).astype(np.float32)
    return QualityModel(tables, bias.astype(np.float32), out, float(intercept))


def train(docs: DataFrame, labels: DataFrame, usable=None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Model from the labelled rows (id, label 0/1) that satisfy ``usable`` (a Column over ``labels``).

    The sample is the labelled ids whose hash lies below a share of its range
    that gives about ``per_class`` rows of each class.  NULL labels and NULL
    texts are left out.  With no labelled row every score is 0.5; with one
    class the score is the (smoothed) prior.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"),
                          (F.lit(True) if usable is None else usable).alias("u")).filter("u AND y IN (0, 1)")
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = (sizes.get(1, 0) + 1) / (total + 2)
    got = []
    if len(sizes) == 2:
        draw = F.pmod(F.xxhash64("id", F.lit("quality sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        some = marks.filter(draw < F.when(F.col("y") == 1, per_class / sizes[1]).otherwise(per_class / sizes[0]))
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        # the sample has about 2 * per_class ids, whatever the tables' size
        got = (texts.filter("text IS NOT NULL").join(F.broadcast(some.select("id", "y")), "id")
               .select("id", "y", "text").collect())
        got.sort(key=lambda r: (r["id"], r["y"], r["text"]))
    if len({r["y"] for r in got}) < 2:
        flat = np.zeros((WIDTH, 256, FILTERS), np.float32)
        return QualityModel(flat, flat[0, 0], np.zeros(2 * FILTERS), float(np.log(prior / (1 - prior))))
    return fit([r["text"] for r in got], [r["y"] for r in got], prior)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``quality_score`` (0 to 1), from the whole text alone.

    NULL, empty and very short texts (under one filter width) get the score of
    the intercept.  Repeated rows get equal scores; an existing column named
    ``quality_score`` is replaced.
    """
    docs = docs.drop("quality_score")
    column = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            renamed = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in chunks(renamed, f"c{column}", 1 << 18):
                w = Words(part.column(column))
                values = model.scores(w.data, w.offsets)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.float64())],
                                                 [*batch.schema.names, "quality_score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("quality_score", DoubleType())]))
