"""Spelling variant groups: words one edit apart, found with bidirectional FM-indexes.

Of two words that differ by one inserted, deleted or replaced character, either
the first half or the last half of the shorter one stands unchanged in the
other.  Words are therefore dealt twice, by their first and by their last half
(and by the halves a word one character shorter would have), to shards of a
bounded number of words.  Each shard holds an FM-index of its delimited
vocabulary, built in the task; every word matches its half exactly and extends
across the other half, allowing one error, by suffix-rank intervals
(``fm_index``).  Last halves are searched on reversed words, so one scheme
serves both.

A half that more words share than a shard holds is split into a grid of
blocks: every block of queries meets every block of the index, so no word is
lost and no task holds the whole group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.fm_index import BiIndex
from featureflow.llm.words import chunks

SHARD_WORDS = 40_000        # rows dealt to a shard, on average
BLOCK_WORDS = 20_000        # words of one half; more are split into blocks of about this many
TASK_COUNTS = 400_000       # distinct words a task counts before it hands them on

_RUNS = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _count_rows(noise: int | None, least: int):
    def words(doc_id, text: bytes):
        runs = Counter(_RUNS.findall(text.translate(_LOWER).decode()))
        if noise is not None and doc_id is not None:
            start = zlib.crc32(f"{doc_id}:".encode())
            for run in list(runs):
                h = zlib.crc32(run.encode(), start)
                if not h % noise:
                    n, at = runs.pop(run), h % len(run)
                    yield run[:at] + run[at + 1:], n
        yield from runs.items()

    def run(batches):
        counts = Counter()

        def table():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text").cast(pa.large_binary())
                for doc_id, text in zip(part.column("id").to_pylist(), texts, strict=True):
                    if text.is_valid:
                        for word, n in words(doc_id, text.as_buffer().to_pybytes()):
                            if len(word) >= least:
                                counts[word] += n
                    if len(counts) >= TASK_COUNTS:
                        yield table()
                        counts.clear()
        yield table()
    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None,
               min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n): words of all whole texts with at least ``min_length`` code points and ``min_count`` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.
    With ``noise``, a run whose CRC-32 of ``<id>:<run>`` it divides loses the
    code point at that CRC modulo the run's length (rows without an id lose
    none).  NULL texts have no words; repeated rows count each; an empty table
    gives an empty vocabulary.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(_count_rows(noise, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _deal(words: DataFrame) -> DataFrame:
    """Rows (last, shard, q, m, word, n, asks, held): every word once or more for each of its halves."""
    total = words.count() * 4
    shards = max(1, -(-total // SHARD_WORDS))
    length = F.length("word")

    def rows(size, asks):
        half = F.expr(f"int(({size}) div 2)")
        return [F.struct(F.lit(last).alias("last"), F.expr(f"int({size})").alias("size"),
                         (F.expr(f"right(word, ({size}) - ({size}) div 2)") if last else F.substring("word", F.lit(1), half))
                         .alias("half"), F.lit(asks).alias("asks")) for last in (False, True)]

    own, shorter = rows("length(word)", True), rows("length(word) - 1", False)
    dealt = (words.filter(length >= 2)
             .withColumn("r", F.explode(F.when(length > 2, F.array(*own, *shorter)).otherwise(F.array(*own))))
             .select("word", "n", "r.asks", "r.last", F.xxhash64("r.last", "r.size", "r.half").alias("key")))
    heavy = stored(dealt.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > BLOCK_WORDS)
                   .select("key", F.ceil(F.col("rows") / BLOCK_WORDS).cast("int").alias("blocks")), "spelling-heavy")
    dealt = dealt.join(heavy, "key", "left")
    light = dealt.filter("blocks IS NULL").select(
        "last", F.pmod("key", F.lit(shards)).alias("shard"), F.lit(-1).alias("q"), F.lit(-1).alias("m"),
        "word", "n", "asks", F.lit(True).alias("held"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def own_block(seed):
        return F.pmod(F.xxhash64("word", F.lit(seed)), "blocks").cast("int")

    split = dealt.filter("blocks IS NOT NULL")
    queries = split.filter("asks").select("last", F.col("key").alias("shard"), own_block(1).alias("q"),
                                          F.explode(every).alias("m"), "word", "n", "asks", F.lit(False).alias("held"))
    items = split.select("last", F.col("key").alias("shard"), F.explode(every).alias("q"), own_block(2).alias("m"),
                         "word", "n", F.lit(False).alias("asks"), F.lit(True).alias("held"))
    return light.unionByName(queries).unionByName(items)


def near_in_shard(items: dict[str, int], queries: dict[str, int], last: bool) -> list[tuple[str, str, int]]:
    """(word, near word, its n) for queries and held words that share a half (the last one if ``last``)."""
    out = []
    words = list(items)
    index = BiIndex([w[::-1] for w in words] if last else words) if words else None
    by_length: dict[int, list[str]] = {}
    for word in queries:
        by_length.setdefault(len(word), []).append(word)
    for size, asked in by_length.items() if index else ():
        first = size // 2
        codes = index.codes([w[::-1] for w in asked] if last else asked, size)
        for q, w in zip(*index.half_exact(codes, size - first if last else first), strict=True):
            word, near = asked[q], words[w]
            if len(near) == size:
                out.append((word, near, items[near]))
            elif not (last and near.startswith(word[:first])):      # both halves stand: found by the first one
                out += [(word, near, items[near]), (near, word, queries[word])]
    return out


def _near_rows(table: pa.Table) -> pa.Table:
    words, counts = table.column("word").to_pylist(), table.column("n").to_pylist()
    asks, held = table.column("asks").to_pylist(), table.column("held").to_pylist()
    items = {w: n for w, n, h in zip(words, counts, held, strict=True) if h}
    queries = {w: n for w, n, a in zip(words, counts, asks, strict=True) if a}
    found = near_in_shard(items, queries, table.column("last")[0].as_py())
    return pa.table({"word": pa.array([x[0] for x in found], pa.string()),
                     "near": pa.array([x[1] for x in found], pa.string()),
                     "near_n": pa.array([x[2] for x in found], pa.int64())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``words`` (word, n) one edit apart, once.

    Words are taken by code points, once each (of repeated words any count);
    words of fewer than two code points and NULL have no halves and no pairs.
    """
    return (_deal(words).groupBy("last", "shard", "q", "m")
            .applyInArrow(_near_rows, "word string, near string, near_n long"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, doubling the distance each round."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(now.join(ahead, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"),
                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not moved.filter("moved").head(1):
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """One row per word of a vocabulary (word, n): its spelling variants' group.

    Columns: word, form (its near word of largest n, ties to the smallest in
    code-point order, if that n is at least ``factor`` times its own; else
    NULL), root (forms followed to the last; the word itself without a form),
    n, n_near (near words), form_n.  Near: exactly one inserted, deleted or
    replaced code point.  Counts grow along forms, so they cannot go round
    (``factor`` is at least 2).  An empty vocabulary gives an empty result;
    very long words cost one step a character.
    """
    if factor < 2:
        raise ValueError("factor must be at least 2, or forms could go round")
    words = stored(words.select("word", "n"), "spelling-words")
    best = (near_words(words).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    formed = F.col("best.less") <= -factor * F.col("n")
    linked = stored(words.join(best, "word", "left")
                    .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                            F.when(formed, F.col("best.near")).alias("form"),
                            F.when(formed, -F.col("best.less")).alias("form_n")), "spelling-linked")
    roots = _roots(linked.filter("form IS NOT NULL"))
    return (linked.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
