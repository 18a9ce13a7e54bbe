"""Near copies, repeated passages and benchmark items against brute force, and their edge cases."""
import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featureflow.llm import decontaminate, minhash, substring
from featureflow.llm.components import connected_components
from featureflow.llm.words import Words, flat_shingles, shingles

ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one two"), (905, "One tWo"), (None, "one two three"),
       (906, "ä ö " * 40), (907, "w " * 5000)]


def words(t):
    return (t or "").encode().split()


def low(t):
    return [bytes(x).lower() for x in words(t)]


def shingle_set(t, k):
    w = low(t)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_words_and_shingles():
    t = pa.array(["a b  c", None, "", "é x A", "b c d e", "x" * 1_200_000 + " y"])
    w = Words(t, lower=True)
    assert w.bounds.tolist() == [0, 3, 3, 3, 5, 9, 11]
    h = w.hashes()
    assert h[1] == h[5] and h[2] == h[6] and h[0] == h[4] and len(set(h.tolist())) == 8
    flat, bounds = flat_shingles(h, w.bounds, 3)
    for i in range(len(t)):
        assert (flat[bounds[i]:bounds[i + 1]] == shingles(h[w.bounds[i]:w.bounds[i + 1]], 3)).all()


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30) if i != 14] + [(40, 40), (None, 3), (50, 45), (50, 45)],
                                  "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(15)}, **{i: 15 for i in range(15, 31)}, 45: 45, 50: 45}
    assert connected_components(edges.limit(0)).count() == 0


def near_copies(seed=3):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(4000)}" for _ in range(60)] for _ in range(6)]
    rows = []
    for i in range(150):
        w = list(base[0] if i < 90 else rng.choice(base))
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(100000)}"
        rows.append((1000 - i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("width", "percent", "block"), [(3, 85, 200_000), (5, 80, 300)])
def test_near_duplicates_match_brute_force(spark, docs_of, monkeypatch, width, percent, block):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)          # small blocks: salting and cross-block stragglers
    rows = near_copies() + ODD
    got = {(r["id"], r["n_shingles"], r["component_id"])
           for r in minhash.near_duplicates(docs_of(rows), width=width, percent=percent).collect()}
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    assert got == {(i, len(x), None if i is None else find(i)) for i, x in sets}


def test_links_of_a_group_around_a_far_centre_stay_linear(spark, docs_of, monkeypatch):
    """One document shares a band with 120 near copies of another text but is linked to none of them."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(400)]
    far = base[:]
    for k in range(0, 400, 14):
        far[k] = f"far{k}"
    rows = [(0, " ".join(far))]
    for i in range(1, 121):
        w = base[:]
        w[rng.randrange(400)] = f"z{i}"
        rows.append((i, " ".join(w)))
    # every document in one bucket, whatever its signature: the star's centre is the far one
    keys = minhash._signature_rows

    def one_bucket(width, bands, rows_):
        run = keys(width, bands, rows_)

        def all_in_one(batches):
            for b in run(batches):
                yield b.set_column(4, "keys", pa.array([[1]] * b.num_rows, pa.list_(pa.int64())))
        return all_in_one

    made = []
    compare = minhash._compare

    def counted(*args):
        out = minhash.cut(compare(*args))
        made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_signature_rows", one_bucket)
    monkeypatch.setattr(minhash, "_compare", counted)
    for block in (200_000, 4000):
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
        made.clear()
        got = {r["id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(rows), width=3, percent=85).collect()}
        assert got == {0: 0, **{i: 1 for i in range(1, 121)}}
        assert sum(made) <= 2 * len(rows)


def test_keep_one_keeps_columns_and_odd_rows(spark, docs_of):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (3, "A b c d e f"), (9, "g h i j k l"), *ODD]
    out = minhash.keep_one(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    kept = collections.Counter(r["doc_id"] for r in out.collect())
    assert kept == {3: 2, 9: 1, **{i: 1 for i, _ in ODD if i != 905}}
    assert minhash.keep_one(docs_of(rows).limit(0)).count() == 0


def expected_digests(rows, window):
    count = collections.Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def passages(seed=1):
    rng = random.Random(seed)
    shared = [[f"p{k}_{j}" for j in range(rng.randrange(8, 30))] for k in range(5)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(4):
            w += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
            p = rng.choice(shared)
            a = rng.randrange(4)
            w += p[a:len(p) - rng.randrange(4)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    return rows + [(1, rows[1][1]), (70, "r " * 40), (71, "r s " * 9)]


@pytest.mark.parametrize("hot", [2048, 1])
def test_substring_digests_match_brute_force(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_PASSAGES", hot)            # 1: every anchor takes the counted path
    rows = passages() + ODD
    got = [tuple(r) for r in substring.digests(docs_of(rows), window=10).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])                # noqa: E731
    assert sorted(got, key=key) == sorted(expected_digests(rows, 10), key=key)
    assert substring.digests(docs_of(rows).limit(0)).count() == 0


def test_substring_reference_holds_a_passage_of_equal_rows_once(spark, docs_of, monkeypatch):
    rows = passages()
    rows += [rows[4]] * 20 + [(None, rows[6][1])] * 20
    held, store = [], substring.stored

    def keep(df, tag):
        out = store(df, tag)
        held.extend((r["anchor"], r["key"], r["low"], r["high"]) for r in out.collect())
        return out

    monkeypatch.setattr(substring, "stored", lambda df, tag: keep(df, tag) if tag == "substring-reference" else store(df, tag))
    got = [tuple(r) for r in substring.digests(docs_of(rows), window=10).collect()]
    assert held and len(held) == len(set(held))
    assert collections.Counter(got) == collections.Counter(expected_digests(rows, 10))


def test_remove_repeats_cuts_texts(spark, docs_of):
    p = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"Start\there {p}\nend  one."), (2, f"Other {p} x"), (3, "clean text"), (4, None), (5, "")]
    out = substring.remove_repeats(docs_of(rows), window=10)
    assert out.schema == docs_of(rows).schema
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: "Start\there end  one.", 2: "Other x", 3: "clean text", 4: None, 5: ""}


@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=30), min_size=1, max_size=5), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_automaton_counts_occurrences(sequences, size):
    auto = substring.Automaton()
    for s in sequences:
        auto.add(s, 1)
    auto.finish(size)
    count = collections.Counter(tuple(s[k:k + size]) for s in sequences for k in range(len(s) - size + 1))
    for s in sequences:
        assert auto.repeated(s, size) == [k + size for k in range(len(s) - size + 1) if count[tuple(s[k:k + size])] > 1]


@pytest.mark.parametrize("slice_size", [2_000_000, 20])
def test_contained_items_match_brute_force(spark, docs_of, monkeypatch, slice_size):
    monkeypatch.setattr(decontaminate, "SLICE_SHINGLES", slice_size)
    rng = random.Random(5)
    items = [(k, " ".join(f"i{rng.randrange(60)}" for _ in range(rng.choice([3, 12, 40, 400])))) for k in range(12)]
    items += [(50, None), (51, ""), (52, "one two"), (None, "a b"), (3, items[3][1])]
    rows = []
    for i in range(80):
        w = [f"i{rng.randrange(60)}" for _ in range(rng.randrange(200))]
        piece = rng.choice(items[:12])[1].upper().split()
        for _ in range(rng.randrange(4)):
            piece[rng.randrange(len(piece))] = "changed"
        rows.append((i, " ".join(w + piece + w[:10])))
    rows += ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = collections.Counter(tuple(r) for r in decontaminate.contained_items(docs_of(rows), bench).collect())
    want = collections.Counter()
    for i, t in rows:
        d = shingle_set(t, 5)
        for k, u in items:
            s = shingle_set(u, 5)
            if k is not None and s and 100 * len(s & d) >= 80 * len(s):
                want[i, k, len(s & d), len(s)] += 1
    assert got == want
    clean = decontaminate.remove_contaminated(docs_of(rows), bench)
    assert clean.columns == docs_of(rows).columns
    assert collections.Counter(r["doc_id"] for r in clean.collect()) == collections.Counter(
        i for i, _ in rows if all(x[0] != i for x in want))
    assert decontaminate.contained_items(docs_of(rows), bench.limit(0)).count() == 0
    assert decontaminate.contained_items(docs_of(rows).limit(0), bench).count() == 0


def test_circulant_signature_is_two_permutations():
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash._sigma(x.copy()))) == len(x) and len(np.unique(minhash._pi(x.copy()))) == len(x)
    sig = minhash.signatures(np.array([5, 9, 11], np.uint64), np.array([0]), 4)
    base = minhash._sigma(np.array([5, 9, 11], np.uint32))
    assert sig[0].tolist() == [int(minhash._pi(base + np.uint32(k)).min()) for k in range(4)]
