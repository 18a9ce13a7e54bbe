"""The trained operators: held-out accuracy, gradients, and defined results for odd rows."""
import collections
import math
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.llm import html, langid, lm, quality
from featureflow.llm.common import crc_mod, table

SF = "/root/testdata/sf0.01"


def test_language_is_right_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    model = langid.train(docs, crc_mod("doc_id", 5) != 0)
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.predict(docs, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["id"]).encode()) % 5 == 0]
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == truth[r["id"]] for r in held) >= 0.98 * len(held)


def test_language_of_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "12 ... 34"), (4, "ñ"), (5, "the and of the"), (None, "the and"), (5, "the and of the")]
    model = langid.fit(["the and of to in"] * 30 + ["der die und das"] * 30, ["en"] * 30 + ["de"] * 30)
    got = [(r["id"], r["lang_pred"]) for r in langid.predict(docs_of(rows), model).collect()]
    assert got[:3] == [(1, "und"), (2, "und"), (3, "und")] and got[3][1] in ("en", "de")
    assert [x[1] for x in got[4:]] == ["en"] * 3
    assert langid.predict(docs_of(rows).limit(0), model).count() == 0
    assert langid.train(docs_of(rows).limit(0)) is None
    assert {r["lang_pred"] for r in langid.predict(docs_of(rows), None).collect()} == {"und"}


def test_quality_is_right_on_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train(docs, labels, crc_mod("doc_id", 3) != 1)
    scored = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, model).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = [(scored[r["doc_id"]] >= 0.5) == (r["quality"] == 1) for r in held]
    assert sum(right) >= 0.93 * len(right)


def test_quality_of_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "ab"), (None, "x " * 100_000), (4, "some text"), (4, "some text")]
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs_of(rows), none)
    out = quality.score(docs_of(rows), model)
    assert out.columns == [*docs_of(rows).columns, "quality_score"]
    assert all(abs(r["quality_score"] - 0.5) < 1e-9 for r in out.collect())
    one = spark.createDataFrame([(4, 1), (4, None), (None, 0)], "doc_id long, quality int")
    assert all(0 <= r["quality_score"] <= 1 for r in quality.score(docs_of(rows), quality.train(docs_of(rows), one)).collect())
    assert quality.score(docs_of(rows).limit(0), model).count() == 0


def test_quality_scores_cover_all_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    m = quality.QualityModel(rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype("f"),
                             np.zeros(quality.FILTERS, "f"), rng.normal(size=2 * quality.FILTERS), 0.1)
    sizes = [0, 3, 7, 128, 134, 135, 262, 263, 0, 1500]
    texts = [rng.integers(0, 256, s).astype(np.uint8) for s in sizes]
    offsets = np.concatenate([[0], np.cumsum(sizes)])

    def slow(d):
        n = len(d) - quality.WIDTH + 1
        if n <= 0:
            return 1 / (1 + math.exp(-0.1))
        conv = np.stack([sum(m.tables[j][d[i + j]] for j in range(quality.WIDTH)) for i in range(n)])
        halves = -(-n // quality.HALF)
        p = np.array([conv[h * quality.HALF:(h + 2) * quality.HALF].max(0) for h in range(max(1, halves - 1))])
        p = np.maximum(p, 0)
        return 1 / (1 + np.exp(-np.clip(np.concatenate([p.mean(0), p.max(0)]) @ m.out + 0.1, -40, 40)))

    want = [slow(t) for t in texts]
    assert np.allclose(m.scores(np.concatenate(texts), offsets), want)
    monkeypatch.setattr(quality, "SEGMENT", 256)
    assert np.allclose(m.scores(np.concatenate(texts), offsets), want)


def test_attention_gradients_and_normalisation():
    rng = np.random.default_rng(0)
    m = lm.Attention(rng.integers(0, 50, 3001).astype(float))
    ids = rng.integers(0, 3001, (4, lm.WINDOW + 1))
    ids[0, :10], ids[0, 10], ids[1, 40:] = lm.PAD, 3001, lm.PAD
    same = np.repeat(ids[2:3], 3001, 0)
    same[:, lm.CONTEXT + 5], same[:, lm.CONTEXT + 6:] = np.arange(3001), lm.PAD
    assert np.exp(m.log_probabilities(same)[:, 4]).sum() == pytest.approx(1, abs=1e-4)
    grads = m.gradients(ids)
    n = (ids[:, lm.CONTEXT + 1:] != lm.PAD).sum()
    for name in ("q", "k", "v", "o", "w1", "w2", "group", "embed"):
        direction = rng.normal(size=m.params[name].shape).astype(np.float32)
        start = m.params[name].copy()
        losses = []
        for e in (2e-3, -2e-3):
            m.params[name] = start + np.float32(e) * direction
            losses.append(-m.log_probabilities(ids).sum() / n)
        m.params[name] = start
        assert (losses[0] - losses[1]) / 4e-3 == pytest.approx(float((grads[name] * direction).sum()), rel=0.05, abs=2e-3)


def test_training_is_adam_on_the_gradients():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 600, (70, lm.WINDOW + 1))
    ids[:9, :lm.CONTEXT], ids[:9, lm.CONTEXT], ids[60:, 30:] = lm.PAD, 600, lm.PAD
    m, plain = (lm.Attention(rng.permutation(600).astype(float)) for _ in range(2))
    plain.place, plain.tail = m.place, m.tail
    plain.load(m.vector())
    m.train(ids, 0.01, 7, seed=3)
    draw, order, moments = np.random.default_rng(3), np.zeros(0, np.int64), {k: [0, 0] for k in plain.params}
    for step in range(1, 8):
        if len(order) < lm.BATCH:
            order = np.concatenate([order, draw.permutation(len(ids))])
        own, order = order[:lm.BATCH], order[lm.BATCH:]
        for k, g in plain.gradients(ids[own]).items():
            moments[k] = [0.9 * moments[k][0] + 0.1 * g, 0.99 * moments[k][1] + 0.01 * g * g]
            change = moments[k][0] / (1 - 0.9 ** step) / (np.sqrt(moments[k][1] / (1 - 0.99 ** step)) + 1e-8)
            plain.params[k] = (plain.params[k] - 0.01 * change).astype(np.float32)
    assert np.allclose(m.vector(), plain.vector(), atol=2e-4)


def test_large_outputs_and_weights_keep_their_logs_finite():
    rng = np.random.default_rng(5)
    m = lm.Attention(rng.integers(0, 50, 3001).astype(float))
    for name in ("embed", "q", "k", "group", "member"):
        m.params[name] = m.params[name] * np.float32(12)
    ids = rng.integers(0, 3001, (8, lm.WINDOW + 1))
    ids[0, :lm.CONTEXT], ids[0, lm.CONTEXT] = lm.PAD, 3001
    assert np.isfinite(m.log_probabilities(ids)).all()
    assert all(np.isfinite(g).all() for g in m.gradients(ids).values())


def test_training_works_on_one_array_of_parameters_and_one_of_gradients():
    rng = np.random.default_rng(6)
    m = lm.Attention(rng.integers(0, 50, 600).astype(float))
    ids = rng.integers(0, 600, (8, lm.WINDOW + 1))
    out = {k: np.full_like(v, 9) for k, v in m.params.items()}
    for k, g in m.gradients(ids, out).items():
        assert g is out[k] and np.array_equal(g, m.gradients(ids)[k])
    before = m.vector()
    m.train(ids, 0.01, 2, seed=1)
    whole = m.params["embed"].base
    assert whole.size == len(before) and all(v.base is whole for v in m.params.values())
    assert np.array_equal(whole, m.vector()) and not np.array_equal(whole, before)


def test_the_average_of_a_round_takes_one_row_a_group_and_parameter(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lm, "WINDOWS_PER_COPY", 8)
    monkeypatch.setattr(lm, "LEAST_STEPS", 2)
    monkeypatch.setattr(lm, "ROUNDS", 1)
    text = "one two three four five six seven eight nine ten " * 9
    gathered = docs_of([(i, text + str(i)) for i in range(60)]).select("text").mapInArrow(
        lm._counting(lm.read_ranks()), "kind int, key long, n long, ids binary").localCheckpoint()
    steps, to_driver = [], type(gathered).toArrow
    monkeypatch.setattr(type(gathered), "toArrow", lambda self: steps.append(self) or to_driver(self))
    subwords = max(lm.read_ranks().values()) + 2
    got = lm.train(gathered, subwords)
    cut = gathered.filter("kind = 2").select("key", "ids")
    copies = -(-cut.count() // 8)
    assert copies > 12
    found = gathered.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(subwords)
    for r in found:
        counts[r["key"]] = r["n"]
    parts = cut.repartition(copies, F.xxhash64("key", F.lit(0))).select("ids").mapInArrow(
        lm._copy(lm.Attention(counts), 0.03, 0), "part int, v binary, w double").collect()
    weights = [r["w"] for r in parts]
    assert sum(weights) == cut.count()
    assert np.allclose(got.vector(), sum(np.frombuffer(r["v"], np.float64) for r in parts) / sum(weights), atol=1e-6)
    before = steps[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert before.count("MapInArrow") == 2 and f"{math.ceil(math.sqrt(copies))}" in before


def test_windows_score_every_token_once():
    rng = np.random.default_rng(2)
    m = lm.Attention(rng.integers(0, 50, 500).astype(float))
    sizes = [2, 3, lm.SCORED, lm.SCORED + 1, lm.SCORED + 2, 5 * lm.SCORED + 7, 2]
    stream = np.concatenate([np.concatenate([[500], rng.integers(0, 500, s - 1)]) for s in sizes])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at, doc = lm.windows(bounds)
    logs = m.log_probabilities(lm.gather(stream, bounds, at, doc, lm.PAD))
    assert (logs != 0).sum() == sum(s - 1 for s in sizes)
    want = np.bincount(doc, weights=logs.sum(axis=1), minlength=len(sizes))
    for at_once in (1, 3, 128):
        assert np.allclose(m.document_scores(stream, bounds, at_once), want, rtol=1e-4)


@pytest.mark.parametrize("known", [500_000, 1])
def test_lm_base_scores_match_brute_force(spark, docs_of, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN_WORDS", known)                  # 1: counts of most words come by the join
    rows = [(i, f"Common words {i % 7} and word{i} é é end") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (5, rows[5][1]), (None, "common null id"), (103, "x" * 50_000)]
    got = lm.score(docs_of(rows), crc_mod("doc_id", 7) == 2).collect()
    tokens = [(i, [w.lower() for w in (t or "").encode().split()] + [None]) for i, t in rows]
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count = collections.Counter(x for i, t in tokens if i is not None and not out[i] for x in t)
    n, v = sum(count.values()), len(count)
    want = collections.Counter((i, out[i], len(t), sum(count[x] > 0 for x in t), n,
                                round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t), 6)) for i, t in tokens)
    assert collections.Counter((r["id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                                round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_lm_beats_its_start_on_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [r for r in lm.score(docs, crc_mod("doc_id", 7) == 2).collect() if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / tokens > -4.6          # subword shares alone: about -6


def test_lm_learns_from_every_training_text(spark, docs_of, monkeypatch):
    rows = [(i, "one two three " * (i % 40)) for i in range(6000)] + [(None, "a b"), (8, None)]
    seen = []
    monkeypatch.setattr(lm, "train", lambda gathered, subwords: (
        seen.extend(gathered.filter("kind = 2").collect()), lm.Attention(np.ones(subwords)))[1])
    lm.score(docs_of(rows), crc_mod("doc_id", 7) == 2)
    coder = lm.Subwords(lm.read_ranks())
    learnt = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    sizes = {t: len(coder.coder.encode_ordinary("".join(" " + w for w in (t or "").split()))) + 1 for t in set(learnt)}
    assert len(seen) == sum(-(-sizes[t] // lm.SCORED) for t in learnt)
    ids = np.stack([np.frombuffer(r["ids"], np.uint16) for r in seen])
    assert (ids[:, lm.CONTEXT + 1:] != lm.PAD).sum() == sum(sizes[t] for t in learnt)
    assert len({r["key"] for r in seen}) == len(seen)             # windows are dealt by number, equal ones too


def test_lm_leaves_no_shuffle_files_of_its_rounds(spark, docs_of):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    before = files()
    lm.score(docs_of([(i, "one two three " * (i % 40)) for i in range(200)]), crc_mod("doc_id", 7) == 2)
    left, end = files() - before, time.time() + 10                # they are removed in the background
    while left and time.time() < end:
        time.sleep(0.2)
        left = files() - before
    assert not left
    assert spark.conf.get(lm.CLEAN_UP) == "false"


def test_lm_with_nothing_to_learn_from(spark, docs_of):
    assert lm.score(docs_of([]), crc_mod("doc_id", 7) == 2).count() == 0
    rows = lm.score(docs_of([(None, "a b"), (None, None)]), crc_mod("doc_id", 7) == 2).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(3, 0, 0), (1, 0, 0)}


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Big &amp; small</h1><p><b>First  line
of text, with caf&eacute;.<br><p>Second line of it, which is longer than the first.<p>Third one.</article>
<section class="comments"><p>I liked this, said a reader.</p></section><footer>&copy; me</footer></body></html>"""


def test_html_blocks_and_text(spark):
    blocks = [b.text for b in html.leaf_blocks(PAGE)]
    assert blocks == ["Home", "News", "We use cookies", "Big & small", "First line of text, with café.",
                      "Second line of it, which is longer than the first.", "Third one.",
                      "I liked this, said a reader.", "© me"]
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"),
                                   (3, "w", "<script>only", "x")], "page_id long, url string, html string, text string")
    model = html.train(table(spark, SF, "pages"))
    got = [(r["page_id"], r["text"]) for r in html.main_text(pages, model).collect()]
    main = "\n".join(blocks[3:7])
    assert sorted(got, key=str) == sorted([(1, main), (1, main), (2, ""), (None, ""), (3, "")], key=str)
    assert html.main_text(pages.limit(0), html.train(pages.limit(0))).count() == 0


def test_html_labels_generated_layouts():
    rng = np.random.default_rng(77)
    pool = [" ".join(f"word{rng.integers(300)}" for _ in range(rng.integers(8, 60))) + "." for _ in range(200)]
    model = html.fit(pool, [t[:30] for t in pool], pages=300, epochs=8)
    right = total = 0
    for _ in range(60):
        blocks, marks = html.make_page(rng, pool, pool)
        if blocks:
            x = model.inputs(blocks, {})
            x[:, html.PATH_DIM + html.WORD_DIM:] = html.counts(blocks)
            p = model.probabilities(*html._padded([x]))[:, 0]
            right += int(((p >= 0.5) == (np.array(marks) == 1)).sum())
            total += len(marks)
    assert right >= 0.95 * total


def test_labeller_gradients():
    rng = np.random.default_rng(4)
    m = html.Labeller()
    x, mask = html._padded([rng.normal(size=(n, html.PATH_DIM + html.WORD_DIM + html.COUNTS)).astype("f") for n in (3, 5)])
    y = (rng.random(mask.shape) < 0.5).astype("f") * mask

    def loss():
        p = m.probabilities(x, mask)
        return float(-((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum())

    grads, dx = m.gradients(x, mask, y)
    for name in ("xf", "hf", "cf", "xb", "hb", "out"):
        direction = rng.normal(size=m.params[name].shape).astype(np.float32)
        start = m.params[name].copy()
        m.params[name] = start + np.float32(5e-3) * direction
        a = loss()
        m.params[name] = start - np.float32(5e-3) * direction
        b = loss()
        m.params[name] = start
        assert (a - b) / 1e-2 == pytest.approx(float((grads[name] * direction).sum()), rel=0.05, abs=2e-3)


def test_blocks_of_minified_deep_and_math_pages():
    """A head that is never closed, text right after it, formulas, and elements that nest without end."""
    texts = lambda page: [b.text for b in html.leaf_blocks(page)]
    assert texts("<html><head><title>T</title><article><p>Text of it</article>") == ["Text of it"]
    assert texts("<head><meta charset=utf-8><title>T</title><style>p{}</style>Loose text<p>More") == ["Loose text", "More"]
    assert texts("<head><title>T</title><script>if (a<b) x()</script></head><body><svg><g>no</g></svg><p>Yes") == ["Yes"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.") == ["Let x=2 hold."]
    n = 3000
    deep = html.leaf_blocks("<font>" * n + "".join(f"<p>text {i}" for i in range(n)))
    assert [b.text for b in deep] == [f"text {i}" for i in range(n)]
    assert max(len(b.path) for b in deep) <= html.OUTER + html.INNER
