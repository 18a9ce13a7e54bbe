"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the byte n-grams (2 to 4 bytes, A-Z lower-cased) of a text, hashed
into a fixed number of buckets.  A text is the mean of its n-grams' embedding
vectors, a linear softmax on it gives the languages, and both are trained by
stochastic gradient descent in numpy on the driver from a bounded sample of
labelled rows.  Temperature and rejection threshold are calibrated on a part
of the sample the descent never sees.

Prediction reads every whole text in Arrow batches.  As the softmax is linear
in the mean, embeddings times output weights is one (buckets x languages)
table, which is what tasks receive.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.words import Words, chunks

BUCKETS = 1 << 14
DIMENSION = 16
GRAMS = (2, 3, 4)
SAMPLE_PER_LANGUAGE = 500         # labelled rows a language is learnt from (expected number)
SAMPLE_ROWS = 8000                # labelled rows altogether (expected number)


def gram_ids(data: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that starts at each byte, for each n of GRAMS."""
    out = []
    wide = data.astype(np.uint32)
    for n in GRAMS:
        m = max(len(wide) - n + 1, 0)
        h = np.full(m, 0x811C9DC5 + n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ wide[j:j + m]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out.append((h >> np.uint32(18)).astype(np.int32))
    return out


def counts_of(ids: list[np.ndarray], low: int, high: int) -> np.ndarray:
    """Mean-normalised bucket counts of the n-grams inside bytes [low, high)."""
    total = np.zeros(BUCKETS, dtype=np.float32)
    n_all = 0
    for n, h in zip(GRAMS, ids, strict=True):
        if high - low >= n:
            own = h[low:high - n + 1]
            total += np.bincount(own, minlength=BUCKETS)
            n_all += len(own)
    return total / n_all if n_all else total


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


@dataclass
class LanguageModel:
    """``table``: logits of each bucket; ``bias``; ``temperature``; ``threshold`` below which to reject."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (x @ self.table + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], epochs: int = 6, rate: float = 40.0, seed: int = 7) -> LanguageModel:
    """Train on the given rows; every fifth row only calibrates.  Rows must not be empty lists."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    target = np.array([languages.index(x) for x in labels])
    data = [np.frombuffer(t.encode("utf-8", "replace").lower(), dtype=np.uint8) for t in texts]
    held = np.arange(len(data)) % 5 == 4 if len(data) >= 50 else np.zeros(len(data), bool)

    def features(i, whole):
        d = data[i]
        if not whole and len(d) > 24:          # a random piece: short texts must be known too
            size = int(min(len(d), rng.integers(8, 400)))
            at = int(rng.integers(0, len(d) - size + 1))
            d = d[at:at + size]
        return counts_of(gram_ids(d), 0, len(d))

    c = len(languages)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    weight = rng.normal(0, 0.3, (DIMENSION, c)).astype(np.float32)
    bias = np.zeros(c, dtype=np.float32)
    train = np.flatnonzero(~held)
    steps = max(1, epochs * 2 * ((len(train) + 31) // 32))
    step = 0
    for _ in range(epochs):
        for whole in (True, False):
            order = rng.permutation(train)
            for k in range(0, len(order), 32):
                own = order[k:k + 32]
                x = np.stack([features(i, whole) for i in own])
                h = x @ embed
                z = h @ weight + bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(own)), target[own]] -= 1
                p /= len(own)
                lr = rate * (1 - step / steps)
                step += 1
                used = np.flatnonzero(x.any(axis=0))
                dh = p @ weight.T
                weight -= 0.02 * lr * (h.T @ p)
                bias -= 0.005 * lr * p.sum(axis=0)
                embed[used] -= lr * (x[:, used].T @ dh)
    model = LanguageModel(languages, embed @ weight, bias)
    check = np.flatnonzero(held) if held.any() else train
    x = np.stack([features(i, whole) for i in check for whole in (True, False)])
    y = np.repeat(target[check], 2)
    losses = []
    for t in (grid := np.geomspace(0.05, 5, 41)):
        model.temperature = float(t)
        losses.append(-np.log(model.probabilities(x)[np.arange(len(y)), y] + 1e-12).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    p = model.probabilities(x)
    right, best = p.argmax(axis=1) == y, p.max(axis=1)
    order = np.argsort(-best)
    kept = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(kept >= 0.99)
    model.threshold = float(best[order[good[-1]]]) if len(good) else 1.0
    return model


def train(docs: DataFrame, usable=None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Model from labelled rows of ``docs`` that satisfy ``usable`` (a Column).

    The sample is the rows whose id hashes below a share of its range that
    gives about ``per_language`` rows of each language and ``total`` at most
    (whole texts).  None when no row has both a text and a label.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), (F.lit(True) if usable is None else usable)
                       .alias("u")).filter("u AND text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = min(per_language, max(1, total // len(sizes)))
    draw = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    limits = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, float(max(share / n, 0.0)))])
    got = rows.filter(draw < limits[F.col("lang")]).select("id", "text", "lang").collect()
    got.sort(key=lambda r: (str(r["id"]), r["text"]))
    if not got:
        return None
    return fit([r["text"] for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for every row of ``docs``, from the whole text alone.

    A NULL text, one without a letter, and any text without a model gives
    ``und`` with score 0 and rejected TRUE.  ``rejected`` marks predictions
    whose calibrated confidence is below the threshold that kept 99 % of the
    accepted calibration rows right.  Repeated rows and NULL ids are scored
    like others; other columns are not read.
    """
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                n = part.num_rows
                w = Words(part.column("text"), lower=True)
                ids = gram_ids(w.data)
                letters = np.concatenate([[0], np.cumsum((w.data >= 97) & (w.data <= 122))])
                has = letters[w.offsets[1:]] > letters[w.offsets[:-1]]
                for i in np.flatnonzero(~has):
                    has[i] = _has_letter(w.text(i))
                lang, score, low = ["und"] * n, np.zeros(n), np.ones(n, dtype=bool)
                own = np.flatnonzero(has) if model is not None else []
                for k in range(0, len(own), 64):
                    some = own[k:k + 64]
                    x = np.stack([counts_of(ids, w.offsets[i], w.offsets[i + 1]) for i in some])
                    p = model.probabilities(x)
                    for i, j, v in zip(some, p.argmax(axis=1), p.max(axis=1), strict=True):
                        lang[i], score[i], low[i] = model.languages[j], min(1.0, float(v)), v < model.threshold
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(lang), pa.array(score), pa.array(low)],
                                                 ["id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean")
