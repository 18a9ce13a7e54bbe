"""Filter audit, licence scan and spelling variants against brute force, and their edge cases."""
import collections
import itertools
import random
import re
import zlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from featureflow.llm import filter_audit, licenses, spelling
from featureflow.llm.license_rules import KINDS, default_rules, parse
from featureflow.llm.queries import QUERIES

# --- filter audit ---------------------------------------------------------------------------------------------------


def audit_by_hand(docs, labels):
    texts = collections.defaultdict(list)
    for i, t, _ in docs:
        if i is not None:
            texts[t or ""].append(i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, z in labels if i is not None and z == 1}
    fails, parts = [], []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {x for x, c in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and min(texts[t]) < i), strict=True) if c}
        fails.append(bad)
        parts.append((part or "", i in good, i in toxic))
    out, shapley = {}, collections.Counter()
    for part in {p for p, _, _ in parts}:
        for order in itertools.permutations("ABCDE"):
            left = [k for k, p in enumerate(parts) if p[0] == part]
            every = list(left)
            for step, x in enumerate(order, 1):
                gone = [k for k in left if x in fails[k]]
                redundant = sum(x in fails[k] for k in every) - len(gone)
                left = [k for k in left if x not in fails[k]]
                out[part, "".join(order), step] = [len(left), len(gone), redundant, sum(fails[k] == {x} for k in every),
                                                   sum(parts[k][1] for k in gone), sum(parts[k][2] for k in gone), x]
                shapley[part, x] += len(gone)
    return {(p, o, s, *v[:6], shapley[p, v[6]]) for (p, o, s), v in out.items()}


def audit_docs():
    rng = random.Random(5)
    docs = []
    for i in range(80):
        w = [f"w{rng.randrange(60 if i % 3 else 900)}" for _ in range(rng.choice([0, 10, 199, 200, 260]))]
        t = " ".join(x.upper() if i % 7 == 0 else x for x in w) + ("#" if i % 5 == 0 else "")
        docs.append((i, t, rng.choice(["en", "de", None, ""])))
    docs += [(200 + k, docs[k % 9][1], "en") for k in range(30)]                 # copies
    docs += [(3, docs[5][1], "fr"), (3, docs[5][1], "fr"), (5, docs[3][1], "fr"), (None, docs[1][1], "en"), (None, None, None),
             (300, None, "fr"), (301, "", "fr"), (302, "É" * 300 + "A" * 9, "fr"), (303, "É" * 290 + "A" * 10, "fr")]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 120, 2)] + [(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, 1)]
    return docs, labels


def test_audit_matches_brute_force(spark):
    docs, labels = audit_docs()
    df = spark.createDataFrame([(*d, 7, 1) for d in docs], "doc_id long, text string, lang string, id int, mask int")
    marks = spark.createDataFrame([(*x, "m") for x in labels], "doc_id long, quality int, toxic int, mask string")
    got = [tuple(r) for r in filter_audit.filter_interactions(df, marks).collect()]
    assert len(got) == len(set(got)) == 600 * 4 and set(got) == audit_by_hand(docs, labels)
    # other letters and fewer filters through the general interface
    cells = filter_audit.failure_cells(df, marks, {"x": df["text"].isNull(), "y": None}, part_col="lang")
    assert filter_audit.audit(cells, ["x", "y"]).count() == 4 * 2 * 2
    for bad in ([], ["x", "x"], ["'"]):
        with pytest.raises(ValueError):
            filter_audit.audit(cells, bad)


def test_audit_of_nothing_and_of_many_parts(spark):
    docs = spark.createDataFrame([(i, "a", f"p{i}") for i in range(40)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1000")                              # more prefixes than the session allows by itself
    try:
        rows = filter_audit.filter_interactions(docs, marks)
        assert rows.count() == 40 * 600 and spark.conf.get(limit) == "1000"
    finally:
        spark.conf.set(limit, before)
    assert filter_audit.filter_interactions(docs.limit(0), marks).count() == 0


# --- licence scan ---------------------------------------------------------------------------------------------------

LICENCES = [
    (1, "Licensed under the Apache License, Version 2.0 (the \"License\"); see http://www.apache.org/licenses/LICENSE-2.0"),
    (2, "GNU\nGeneral  PUBLIC-license; GNU general public license. cc BY CC-by, MIT license mit licence"),
    (3, "gnu general public licenses and the mit licensed, ccby, apache licénse"),
    (4, None), (5, ""), (6, " ,.; "), (7, "SPDX-License-Identifier: GPL-2.0-or-later"),
    (8, "word " * 30000 + "MIT License " + "wörd " * 30000), (9, "Copyright (c) 2019 Someone. All rights reserved."),
    (9, "Copyright (c) 2019 Someone. All rights reserved."), (None, "CC BY 4.0"),
    (10, "permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License"),
]
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None),
            sorted({x for _, x in places}))


def test_scan_base_and_spans(spark, docs_of):
    rows = licenses.scan(docs_of(LICENCES)).collect()
    assert sorted(((r["id"] or 0), *(r[c] if c != "base_labels" else tuple(r[c]) for c in
                   ("n_words", "n_base", "first_word", "last_word", "base_labels"))) for r in rows) == sorted(
        ((i or 0), *v[:4], tuple(v[4])) for i, t in LICENCES for v in [base_by_hand(t)])
    of = {r["id"]: r for r in rows}
    assert "apache-2.0" in of[1]["labels"] and of[1]["detections"][0]["kind"] == "notice"
    assert of[7]["labels"] == ["gpl-2.0+"] and of[None]["labels"] == ["cc-by", "cc-by-4.0"]
    assert of[10]["labels"] == ["mit"] and of[8]["first_word"] == 30000
    assert all(0.0 <= r["score"] <= 1.0 and set(r["base_labels"]) <= set(r["labels"]) for r in rows)
    assert of[4]["score"] == of[5]["score"] == 0.0 and of[1]["score"] >= 0.9 and of[9]["score"] >= 0.9 > of[3]["score"]
    assert licenses.scan(docs_of(LICENCES).limit(0)).count() == 0


def test_priority_and_containment():
    rules = parse("""
        text  whole  b  a b c d
        title part   b  b c
        title long   c  b c d e
        base  other  e  e
        hint  last   f  e f""")
    found = licenses.detect([b"x", b"a", b"b", b"c", b"d", b"e", b"f", b"b", b"c"], rules)
    kept = [(r.label, a, b) for r, a, b in licenses.resolve(found)]
    assert kept == [("whole", 1, 4), ("long", 2, 5), ("last", 5, 6), ("part", 7, 8)]


@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 12), st.integers(0, 5)), max_size=25))
def test_resolve_matches_pairwise_suppression(picks):
    rules = default_rules()
    by_kind = [next(r for r in rules if r.kind == k) for k in KINDS] + [rules[1]]
    found = list({(by_kind[k], a, a + n) for k, a, n in picks})
    order = sorted(found, key=lambda d: (d[0].priority, d[1] - d[2], d[0].order, d[1]))
    kept = []
    for d in order:
        if not any(a <= d[1] and d[2] <= b for _, a, b in kept):
            kept.append(d)
    assert set(licenses.resolve(found)) == set(kept)


@settings(max_examples=600, suppress_health_check=list(HealthCheck), deadline=None)
@given(st.data())
def test_rules_pass_their_own_gate(data):
    """Every text that a rule matches holds one of its keywords, so the prefilter loses no detection."""
    rules = default_rules()
    assert len(rules) > 300
    rule = data.draw(st.sampled_from(rules))
    core = rule.pattern.pattern[len(b"(?<![^ ])"):-len(b"(?![^ ])")].replace(b"[^ ]", b"[a-z0-9]")
    words = data.draw(st.from_regex(core, fullmatch=True)).split()
    gate = licenses.Gate(rules)
    assert rule in gate(words) and (rule, 0, len(words) - 1) in [(r, a, b) for r, a, b in licenses.detect(words, [rule])]


# --- spelling variants ----------------------------------------------------------------------------------------------


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_by_hand(docs, noise=97):
    counts = collections.Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % noise == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        found = sorted((-m, x) for x, m in words.items() if near(w, x))
        form = found[0][1] if found and -found[0][0] >= 2 * n else None
        out[w] = (form, n, len(found), words.get(form))
    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def spelling_docs():
    rng = random.Random(11)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 9))) for _ in range(40)] + ["Ünder", "bÀéab", "a" * 60]
    docs = []
    for i in range(300):
        w = rng.choices(base, [1 / (k + 1) for k in range(len(base))], k=12)
        for k in range(3):
            x = list(w[k])
            if rng.random() < 0.5:
                x.insert(rng.randrange(len(x) + 1), rng.choice("abc"))
            else:
                x[rng.randrange(len(x))] = rng.choice("abcÉ")
            w[k] = "".join(x)
        docs.append((i, rng.choice([" ", "-", "1", "ß ", "×"]).join(w)))
    return docs + [(400, None), (401, ""), (402, "12 34 ."), (3, docs[3][1]), (None, docs[4][1]), (403, "Z" * 70000 + " b")]


@pytest.mark.parametrize("block", [20_000, 3])
def test_variants_match_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "SHARD_WORDS", 300)
    monkeypatch.setattr(spelling, "TASK_COUNTS", 50)
    docs = spelling_docs()
    got = [tuple(r) for r in spelling.variants(spelling.vocabulary(docs_of(docs), noise=7)).collect()]
    want = variants_by_hand(docs, noise=7)
    assert len(got) == len(want) and set(got) == want
    assert any(f is not None and r != f for _, f, r, _, _, _ in want) and any(f is None for _, f, *_ in want)


def test_variants_of_nothing_and_limits(spark, docs_of):
    assert spelling.variants(spelling.vocabulary(docs_of([(1, "seldom")]))).count() == 0
    words = spark.createDataFrame([("a", 9), ("ab", 4), ("abc", 8), ("", 5), (None, 3)], "word string, n long")
    assert {tuple(r) for r in spelling.near_words(words).collect()} == {("ab", "abc", 8), ("abc", "ab", 4)}
    with pytest.raises(ValueError):
        spelling.variants(words, factor=1)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=2, max_size=6), min_size=1, max_size=40))
def test_index_finds_every_pair_once(words):
    counts = {w: k for k, w in enumerate(sorted(words))}
    found = [p for last in (False, True) for p in spelling.near_in_shard(counts, counts, last)]
    assert sorted(found) == sorted((a, b, counts[b]) for a in words for b in words if near(a, b))


def test_queries_on_the_given_tables(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:6] for r in QUERIES["op12_license_scan"](spark, sf).collect()}
    assert got == {i: (*v[:4], ",".join(v[4])) for i, t in docs for v in [base_by_hand(t)]}
    assert {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, sf).collect()} == variants_by_hand(docs)
