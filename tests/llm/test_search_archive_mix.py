"""Top-k search, WARC archives, source mixing and the pipeline."""
import base64
import collections
import hashlib
import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featureflow.llm import mixing, topk, warc
from featureflow.llm.common import table
from featureflow.session import shared_path


@pytest.mark.parametrize("bytes_", [4 << 20, 2000])
def test_top_k_matches_brute_force(spark, monkeypatch, bytes_):
    monkeypatch.setattr(topk, "PART_BYTES", 2 * bytes_)            # many parts and blocks
    monkeypatch.setattr(topk, "BLOCK_BYTES", bytes_ // 10)
    monkeypatch.setattr(topk, "STEP", 8)
    rng = np.random.default_rng(0)
    vectors = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(400)}
    for i in range(50, 90):
        vectors[i] = vectors[3]                                    # ties
    vectors[7], vectors[8], vectors[9] = None, [1.0, None] + [0.0] * 6, [float("nan")] * 8
    vectors[11] = [1.0] * 3
    rows = [(i, v, i) for i, v in vectors.items()] + [(None, [1.0] * 8, 1), (3, vectors[3], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")
    got = {tuple(r) for r in topk.top_k(df, F.col("id") % 20 == 0, k=5).collect()}
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()
             if v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q, a in whole.items():
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole.items()
                            if i != q and len(a) == len(b))[:5]
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)}
    assert got == want
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_bounds_eliminate_rows():
    rng = np.random.default_rng(1)
    centres = rng.integers(-300, 300, (20, 16))
    rows = (centres[rng.integers(0, 20, 4000)] + rng.integers(-10, 10, (4000, 16))).astype(np.int64)
    ids = np.arange(4000)
    table = topk.pivot_distances(rows, centres.astype(float))
    _, best, scores, seen = topk._nearest(ids, rows, table, rows[:1], table[:1], 10, np.array([0]))
    assert seen < 4000 and 0 not in best
    assert scores.tolist() == sorted((rows[1:] @ rows[0]).tolist(), reverse=True)[:10]


def test_top_k_keeps_other_vectors_of_an_id_and_empty_ones(spark):
    rows = [(1, [5.0, 0.0]), (1, [2.0, 0.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0]), (200, []), (2, []), (2, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("id") % 100 == 0, k=3).collect()))
    m = 1024 * 1024
    assert got == sorted([(100, 1, 1, 5 * m), (100, 2, 1, 2 * m), (100, 3, 100, 0),         # the query [1, 0]
                          (100, 1, 1, 0), (100, 2, 1, 0), (100, 3, 100, 0), (200, 1, 2, 0)])


def test_warc_round_trip(spark):
    rows = [(i, f"http://e/{i}", f"<p>page {i % 40} " + "text " * (i % 13)) for i in range(300)]
    rows += [(900, None, None), (901, "http://x/ä b\nc", ""), (None, "u", "<p>null id"), (902, "u", "<p>null id"),
             (903, "v", "é" * 100_000), (5, "http://e/5", rows[5][2])]
    pages = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, sha string, first int")
    folder = shared_path(spark, "warc-test")
    listing = warc.write_archives(pages.repartition(3), folder)
    assert sum(r["records"] for r in listing.collect()) == len(rows)
    got = warc.read_archives(spark, folder).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = collections.Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        lead = first.get(h or "")
        again = i is not None and lead != i
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response",
             lead if again else None] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                               for r in got) == want
    payloads = {(h or "").encode() for _, _, h in rows}
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == payloads
    for r in spark.read.format("binaryFile").load(folder).select("content").collect():
        assert struct.unpack_from("<I", r["content"])[0] == 0x184D2A5D
    empty = shared_path(spark, "warc-empty")
    assert warc.write_archives(pages.limit(0), empty).count() == 0
    assert warc.read_archives(spark, empty).count() == 0


def test_warc_keeps_every_copy_of_a_repeated_row(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 2000)                     # a few records an archive
    rows = [(7, "u", "<p>hot " * 50)] * 200 + [(None, None, "<p>no id " * 40)] * 100 + [(8, "v", None)] * 30
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one = pages.coalesce(1).sortWithinPartitions("html")
    folder = shared_path(spark, "warc-hot")
    # twice the same file: tasks with equal rows, not dealt anew as the join is a broadcast
    listing = warc.write_archives(one.union(one), folder).collect()
    got = collections.Counter(r["page_id"] for r in warc.read_archives(spark, folder).collect())
    assert len({r["archive"] for r in listing}) == len(listing) > 100
    assert sum(r["records"] for r in listing) == sum(got.values())
    assert got == {7: 400, None: 200, 8: 60}


def test_archive_is_smaller_with_its_dictionary():
    records = [warc.record(i, "http://e", f"<html><nav>the same menu of every page</nav><p>{i}</p>".encode() * 3, "D", None)
               for i in range(400)]
    packed = warc.pack(records)
    assert struct.unpack_from("<II", packed)[1] > 0
    assert warc.unpack(packed) == b"".join(records)
    assert len(packed) < sum(map(len, records)) / 3


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, source string, tokens int, block string")
    return mixing.mix(docs, **kw).collect()


def test_mixing_meets_targets_and_budget(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 40), "big" if i % 3 else f"s{i % 6}" if i % 2 else None) for i in range(900)]
    rows += [(1000, None, "big"), (1001, " ", "only empty"), (None, "a b c", "big")]
    tokens = collections.Counter()
    for _, t, s in rows:
        tokens[s] += len((t or "").split())
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    out = mixed(spark, rows, entropy=0.9)
    weight = {r["source"]: r["weight"] for r in out}
    assert sum(weight.values()) == pytest.approx(1, abs=1e-6) and set(weight) == set(tokens)
    share = -sum(w * math.log(w) for w in weight.values()) / math.log(len(weight))
    assert share == pytest.approx(0.9, abs=1e-4)
    drawn = collections.Counter()
    for r in out:
        drawn[r["source"]] += r["tokens"]
    for s, n in drawn.items():
        quota = math.floor(weight[s] * total)
        assert quota - 45 < n <= quota                             # whole documents, of at most 39 tokens here
    copies = collections.Counter((r["id"], r["source"], r["epoch"]) for r in out)
    assert max(copies.values()) == 1                               # an epoch draws a document once
    limited = mixed(spark, rows, repeats=1.2, budget=total)
    assert max(r["weight"] * total / tokens[r["source"]] for r in limited) <= 1.2 + 1e-3
    assert {tuple(r) for r in out} == {tuple(r) for r in mixed(spark, rows[::-1], entropy=0.9)}
    assert mixed(spark, [], entropy=0.9) == []
    with pytest.raises(ValueError, match="one target"):
        mixed(spark, rows)


def test_mixing_sums_in_groups_of_blocks(spark, monkeypatch):
    """Many small groups of blocks give the rows that one running sum gives; rows without an id spread over blocks."""
    rng = random.Random(6)
    rows = [(i if i % 4 else None, f"w{i} " * rng.randrange(1, 30), rng.choice(["a", "a", "b", None])) for i in range(600)]
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 4)
    plain = {tuple(r) for r in mixed(spark, rows, entropy=0.8)}
    monkeypatch.setattr(mixing, "BLOCK_GROUP", 3)
    assert {tuple(r) for r in mixed(spark, rows, entropy=0.8)} == plain
    assert len({r[4] for r in plain if r[0] is None}) > 20
    texts = mixed(spark, rows, entropy=0.8, with_text=True)
    assert {tuple(r)[:-1] for r in texts} == plain and all(len(r["text"].split()) == r["tokens"] for r in texts)


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "substring_dedup", "decontaminate", "mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "substring_dedup":
            assert set(after) == set(before) and all(len(after[i] or "") <= len(before[i] or "") for i in after)
            seen = collections.Counter(tuple(w[k:k + 35]) for w in (t.encode().split() for t in before.values() if t)
                                       for k in range(len(w) - 34))
            assert any(v > 1 for v in seen.values()) == any(after[i] != before[i] for i in after)
        else:
            assert all(after[i] == before[i] for i in after)
        before = after
    assert 0 < docs.count()
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "source", "tokens", "epoch", "block", "place", "weight", "text"]
    assert all(len(r["text"].encode().split()) == r["tokens"] and r["text"] == before[r["doc_id"]] for r in out.collect())


def test_pipeline_leaves_one_whole_text_of_repeated_rows(spark):
    sf = "/root/testdata/sf0.001"
    text = {k: " ".join(f"{k}{i}" for i in range(50)) for k in "abcdef"}
    rows = [(1, text["a"])] * 3 + [(None, text["a"])] * 2          # repeated row and copies without an id
    rows += [(2, text["b"]), (5, text["b"]), (5, text["c"])]       # one id, of its two texts one is a copy
    rows += [(None, text["d"])] * 2 + [(None, text["e"])]
    rows += [(9, text["f"]), (7, text["f"] + " more"), (8, ""), (8, ""), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 table(spark, sf, "documents").schema)
    for stage in (corpus_pipeline.near_dedup_stage, corpus_pipeline.substring_stage):
        docs = stage(spark, docs, sf)
    got = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert got == collections.Counter([(1, text["a"]), (2, text["b"]), (5, text["c"]), (None, text["d"]), (None, text["e"]),
                                       (7, text["f"] + " more"), (8, ""), (8, ""), (None, None), (None, None)])


def test_pipeline_takes_odd_and_empty_tables(spark):
    sf = "/root/testdata/sf0.001"
    schema = table(spark, sf, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
                                 (2, "word " * 3000, None, None, None)], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert out.count() <= 8
