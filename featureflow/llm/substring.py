"""Exact removal of repeated passages with suffix automata of reference shards.

A window is ``window`` consecutive words of one document.  A word goes when a
window that covers it has a word sequence that also starts somewhere else.

Comparing every document with automata of the whole corpus would cost
documents times shards, and automata of all text do not fit anywhere.  So the
passages are routed first: every window names its anchor, the smallest hash
among its ``ANCHOR``-word grams (leftmost of equal ones), equal windows name
equal anchors, and the windows of one document that share an anchor position
form one passage.  Then

1. anchors that occur once in the corpus are dropped (grouped counts);
2. passages that are equal word for word collapse into one with a count (all
   their windows are repeated when the count is over one);
3. the distinct passages of the other anchors are the reference.  It is dealt
   by anchor into shards of a bounded number of words; each task builds its
   shard's generalised suffix automaton with weighted occurrence counts and
   streams the shard's passages through it: a window is repeated when the
   state of its last ``window`` words occurs more than once.  Only windows
   that turn out to occur once leave the task: all others of the passages
   that passed step 1 are repeated, so nothing is joined back;
4. an anchor with more than ``HOT_PASSAGES`` distinct passages would make a
   shard too large; the windows of its passages are counted by hash instead
   (grouped counts, exact as well, no group in one task).

A shard's automaton is only needed where its passages are, so it is built in
that task instead of being broadcast: the reference grows with the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureflow.llm.common import stored
from featureflow.llm.words import Words, chunks, mix64

ANCHOR = 8
HOT_PASSAGES = 2048
SHARD_PASSAGES = 2048
_STEP = 0x9E3779B97F4A7C15


def _prefix(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over word hashes, and the inverse powers."""
    n = len(h)
    power = np.full(n, _STEP, dtype=np.uint64)
    inverse = np.full(n + 1, pow(_STEP, -1, 1 << 64), dtype=np.uint64)
    power[:1] = inverse[:1] = 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * np.multiply.accumulate(power), out=sums[1:])
    return sums, np.multiply.accumulate(inverse)


def _sequence_hash(sums, inverse, a, b):
    """Hash of the words [a, b); equal sequences have equal hashes wherever they stand."""
    return mix64((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span, best = 1, g
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    rest = width - span
    return np.minimum(best[:len(best) - rest], best[rest:]) if rest else best


def passages(h: np.ndarray, bounds: np.ndarray, window: int):
    """Passages of a batch of documents: (document, anchor hash, first and last window start, anchor position,
    passage hash).  Positions count words of the batch."""
    empty = np.zeros(0, np.int64)
    if len(h) < window:
        return (empty, empty.view(np.uint64), empty, empty, empty, empty.view(np.uint64))
    anchor = min(ANCHOR, window)
    grams = np.full(len(h) - anchor + 1, anchor, dtype=np.uint64)
    for j in range(anchor):
        grams = (grams + h[j:j + len(grams)]) * np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(32)
    width = window - anchor + 1
    least = _least(grams, width)                      # one per window start
    at = np.zeros(len(least), dtype=np.int64)
    for j in range(width - 1, -1, -1):
        np.copyto(at, j, where=grams[j:j + len(least)] == least)
    at += np.arange(len(least))
    lengths = np.diff(bounds)
    count = np.maximum(lengths - window + 1, 0)
    doc = np.repeat(np.arange(len(lengths)), count)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + bounds[:-1][doc]
    if not len(start):
        return (empty, empty.view(np.uint64), empty, empty, empty, empty.view(np.uint64))
    pos = at[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (pos[1:] != pos[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    low, high, p = start[first], start[last], pos[first]
    sums, inverse = _prefix(h)
    seq = _sequence_hash(sums, inverse, low, high + window)
    seq = mix64(seq + (p - low).astype(np.uint64))
    return doc[first], mix64(grams[p]), low, high, p, seq


def _passage_rows(window: int):
    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                w = Words(part.column("text"))
                doc, anchor, low, high, _, seq = passages(w.hashes(), w.bounds, window)
                base = w.bounds[:-1][doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(seq.view(np.int64)), part.column("key").take(pa.array(doc)),
                     pa.array((low - base).astype(np.int32)), pa.array((high - base).astype(np.int32))],
                    ["anchor", "seq", "key", "low", "high"])
    return run


def _reference_rows(batches):
    """Word hashes of the passages named in each document's ``wanted`` list."""
    names = ["anchor", "copies", "hot", "low", "high"]
    for batch in batches:
        for part in chunks(batch, "text", 1 << 20):
            w = Words(part.column("text"))
            h = w.hashes()
            keys = part.column("key").to_pylist()
            rows = {n: [] for n in [*names, "key", "words"]}
            for i, wanted in enumerate(part.column("wanted").to_pylist()):
                for x in wanted:
                    for n in names:
                        rows[n].append(x[n])
                    rows["key"].append(keys[i])
                    a = int(w.bounds[i])
                    rows["words"].append(h[a + x["low"]:a + x["end"]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["anchor"], pa.int64()), pa.array(rows["copies"], pa.int64()),
                 pa.array(rows["hot"], pa.bool_()), pa.array(rows["low"], pa.int32()),
                 pa.array(rows["high"], pa.int32()), pa.array(rows["key"], pa.int64()),
                 pa.array(rows["words"], pa.binary())], [*names, "key", "words"])


class Automaton:
    """Generalised suffix automaton over sequences of ints, with weighted occurrence counts."""

    def __init__(self):
        self.next = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """A copy of q for the strings that end a shorter context of p."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int], weight: int) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for symbol in sequence:
            q = nxt[last].get(symbol)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, symbol, q)
            else:
                new = self._state(length[last] + 1, {}, 0)
                p = last
                while p != -1 and symbol not in nxt[p]:
                    nxt[p][symbol] = new
                    p = link[p]
                if p != -1:
                    q = nxt[p][symbol]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
                last = new
            self.count[last] += weight

    def finish(self, size: int) -> None:
        """Sum counts along suffix links; ``home`` is each state's suffix of ``size`` symbols."""
        order = np.argsort(np.array(self.length), kind="stable")
        for s in order[:0:-1].tolist():
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]
        self.home = [0] * len(self.link)
        for s in order.tolist():
            if self.length[s] >= size:
                up = self.link[s]
                self.home[s] = self.home[up] if self.length[up] >= size else s

    def repeated(self, sequence: list[int], size: int) -> list[int]:
        """Ends (exclusive) of the windows of ``size`` symbols that occur more than once."""
        state, out = 0, []
        for i, symbol in enumerate(sequence, 1):
            state = self.next[state][symbol]
            if i >= size and self.count[self.home[state]] > 1:
                out.append(i)
        return out


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in starts:
        if out and out[-1][1] == s - 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [(a, b) for a, b in out]


def _shard(window: int):
    """Runs (key, low, high) of windows that occur once, of the passages that occur once, by one shard's automaton."""

    def run(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(x, dtype=np.int64) for x in table.column("words").to_pylist()]
        copies = table.column("copies").to_pylist()
        keys, lows = table.column("key").to_pylist(), table.column("low").to_pylist()
        _, ids = np.unique(np.concatenate(words), return_inverse=True)
        cuts = np.concatenate([[0], np.cumsum([len(x) for x in words])])
        sequences = [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        auto = Automaton()
        for seq, n in zip(sequences, copies, strict=True):
            auto.add(seq, n)
        auto.finish(window)
        rows = []
        for seq, n, key, low in zip(sequences, copies, keys, lows, strict=True):
            if n == 1:
                twice = {e - window for e in auto.repeated(seq, window)}
                alone = [k for k in range(len(seq) - window + 1) if k not in twice]
                rows += [(key, low + a, low + b) for a, b in _runs(alone)]
        return pa.table({"key": pa.array([r[0] for r in rows], pa.int64()),
                         "low": pa.array([r[1] for r in rows], pa.int32()),
                         "high": pa.array([r[2] for r in rows], pa.int32())})
    return run


def _window_rows(window: int):
    """One row per window of hot passages: its hash, the passage's count, and where it starts."""

    def run(batches):
        for batch in batches:
            hashes, copies, keys, lows = [], [], [], []
            for x, n, key, low in zip(*(batch.column(c).to_pylist() for c in ("words", "copies", "key", "low")),
                                      strict=True):
                h = np.frombuffer(x, dtype=np.uint64)
                sums, inverse = _prefix(h)
                a = np.arange(len(h) - window + 1)
                hashes.append(_sequence_hash(sums, inverse, a, a + window))
                copies += [n] * len(a)
                keys += [key] * len(a)
                lows += (a + low).tolist()
            flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), pa.array(copies, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(lows, pa.int32())], ["window", "copies", "key", "low"])
    return run


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """(key, low, high, repeated) for ``docs`` with columns key and text.

    Runs of window starts that are repeated (TRUE), except for those that lie
    in a run that is not (FALSE).
    """
    rows = docs.filter("text IS NOT NULL").mapInArrow(
        _passage_rows(window), "anchor long, seq long, key long, low int, high int")
    # stored, so that the join below has plain shuffles on both sides, whose hot partitions Spark splits
    common = stored(rows.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("seq") != F.max("seq")).alias("differ"))
                    .filter("n > 1").select("anchor", "differ"), "substring-anchors")
    found = stored(rows.join(common, "anchor"), "substring-passages")
    classes = stored(found.filter("differ").groupBy("anchor", "seq")
                     .agg(F.count("*").alias("copies"), F.min(F.struct("key", "low", "high")).alias("one")),
                     "substring-classes")
    hot = classes.groupBy("anchor").agg((F.count("*") > HOT_PASSAGES).alias("hot"))
    wanted = (classes.join(hot, "anchor")
              .groupBy(F.col("one.key").alias("key"))
              .agg(F.collect_list(F.struct("anchor", "copies", "hot", F.col("one.low").alias("low"),
                                           F.col("one.high").alias("high"),
                                           (F.col("one.high") + window).alias("end"))).alias("wanted")))
    # rows with one key are equal: one of them gives the passages
    texts = docs.filter("text IS NOT NULL").select("key", "text").dropDuplicates(["key"])
    reference = stored(texts.join(wanted, "key").mapInArrow(
        _reference_rows, "anchor long, copies long, hot boolean, low int, high int, key long, words binary"),
        "substring-reference")
    shards = max(1, -(-reference.filter("NOT hot").count() // SHARD_PASSAGES))
    cold = (reference.filter("NOT hot").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
            .groupBy("shard").applyInArrow(_shard(window), "key long, low int, high int"))
    warm = (reference.filter("hot").mapInArrow(_window_rows(window), "window long, copies long, key long, low int")
            .groupBy("window").agg(F.sum("copies").alias("n"), F.min(F.struct("key", "low")).alias("one"))
            .filter("n = 1").select("one.key", "one.low", F.col("one.low").alias("high")))
    return (found.select("key", "low", "high", F.lit(True).alias("repeated"))
            .unionByName(cold.unionByName(warm).withColumn("repeated", F.lit(False))))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumn("_key", F.xxhash64(F.col(id_col), F.col(text_col)))


def with_spans(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_starts``: its runs (low, high, repeated) of window starts, NULL without any."""
    keyed = _keyed(docs, id_col, text_col)
    runs = repeated_windows(keyed.select(F.col("_key").alias("key"), F.col(text_col).cast("string").alias("text")),
                            window)
    per_doc = runs.groupBy(F.col("key").alias("_key")).agg(F.collect_set(F.struct("low", "high", "repeated")).alias("_starts"))
    return keyed.join(per_doc, "_key", "left").drop("_key")


def _gone(n: int, starts, window: int) -> np.ndarray:
    """Which of ``n`` words are covered by a repeated window."""
    begins = np.zeros(n + 1, dtype=bool)
    for x in sorted(starts or (), key=lambda x: not x["repeated"]):
        begins[x["low"]:x["high"] + 1] = x["repeated"]
    edge = begins.astype(np.int64)
    edge[window:] -= begins[:-window] if n >= window else 0
    return np.cumsum(edge[:-1]) > 0


def digests(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) for every row of ``docs``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged.  NULL,
    empty and blank texts have no words (the digest is that of the empty
    string); texts shorter than a window lose nothing.  Equal rows are
    different documents: each one's windows start elsewhere too.  NULL ids are
    ordinary rows.  Other columns are not read.
    """
    rows = with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), window,
                      "id", "text")

    def run(batches):
        for batch in batches:
            ids, n_words, n_removed, digest = [], [], [], []
            texts, starts = batch.column("text"), batch.column("_starts").to_pylist()
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or "").encode("utf-8").split()
                kept = words
                if starts[i]:
                    gone = _gone(len(words), starts[i], window)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()),
                                              pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())],
                                             ["id", "n_words", "n_removed", "kept_sha256"])

    schema = StructType([rows.schema["id"], *StructType.fromDDL("n_words long, n_removed long, kept_sha256 string")])
    return rows.select("id", "text", "_starts").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; every row and column stays.

    A removed word goes together with the white space after it; all other
    bytes stay as they were.  Rows without a repeated window are unchanged,
    NULL texts included; a text that is repeated altogether becomes empty.
    """
    rows = with_spans(docs, window, id_col, text_col)
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            texts, starts = batch.column(at), batch.column(len(names)).to_pylist()
            out = []
            for i in range(batch.num_rows):
                if not starts[i]:
                    out.append(texts[i].as_py())
                    continue
                w = Words(pa.array([texts[i].as_py()], pa.large_string()))
                gone = _gone(len(w), starts[i], window)
                keep = np.ones(len(w.data), dtype=bool)
                ends = np.concatenate([w.start[1:], [len(w.data)]])
                for k in np.flatnonzero(gone):
                    keep[w.start[k]:ends[k]] = False
                out.append(w.data[keep].tobytes().decode("utf-8"))
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select(*[F.col(c) for c in names], "_starts").mapInArrow(run, docs.schema)
