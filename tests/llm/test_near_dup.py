from __future__ import annotations

import random
from collections import Counter

import pytest

from postlake.llm import near_dup
from tests.llm.rows import N_ODD, documents, odd


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(texts):
    """doc -> (class_id, copy_of, n_links) by comparing every pair of sets."""
    sets = [shingles(t) for t in texts]
    first: dict = {}
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    kinds = [s for s in first if s]
    links, parent = Counter(), {s: first[s] for s in kinds}

    def top(x):
        while parent[kind_of[x]] != x:
            x = parent[kind_of[x]]
        return x

    kind_of = {first[s]: s for s in kinds}
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            n = len(a & b)
            if n >= 0.8 * (len(a) + len(b) - n):
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(first[a]), top(first[b])))
                parent[kind_of[y]] = x
    return [(top(first[s]), first[s], links[s]) if s else (i, i, 0) for i, s in enumerate(sets)]


def families(seed, n_families, copies):
    rnd = random.Random(seed)
    texts = []
    for f in range(n_families):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([4, 30, 120]))]
        for _ in range(rnd.randrange(1, copies)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(5000)}"
            texts.append((" " if rnd.random() < 0.8 else "\n ").join(w))
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("cell", [256, 4])
def test_links_and_groups(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dup, "CELL", cell)  # small blocks take the same pairs
    monkeypatch.setattr(near_dup, "SIGNED", cell)
    texts = families(7, 25, 14)
    got = sorted(near_dup.near_duplicates(documents(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [(r.class_id, r.copy_of, r.n_links) for r in got] == brute(texts)
    assert [r.keeper for r in got] == [r.class_id == r.doc_id for r in got]


def test_odd_rows(spark):
    got = near_dup.near_duplicates(odd(spark, "class_id")).collect()
    assert len(got) == N_ODD
    same = [r for r in got if r.doc_id == 7]
    assert [(r.class_id, r.n_copies, r.n_links) for r in same] == [(7, 2, 0)] * 2
    assert all(r.keeper and r.n_links == 0 for r in got)
    assert [r.class_id for r in got if r.doc_id is None] == [None]
    assert near_dup.keep_one(odd(spark)).count() == N_ODD - 1  # of the repeated row one stays
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def test_clashing_columns_stay(spark):
    names = ["_row", "_k1", "_own", "row", "cls", "_wordless"]
    docs = documents(spark, ["a b c d e f"] * 2 + ["\n\t", None]).selectExpr("*", *[f"'mine' AS `{n}`" for n in names])
    for out in (near_dup.near_duplicates(docs), near_dup.keep_one(docs)):
        assert {tuple(r[n] for n in names) for r in out.collect()} == {("mine",) * len(names)}


def test_rows_without_words_all_stay(spark):
    texts = ["\n\t", "\n\t", "", None, "\u00a0", "one two", "one two"]
    docs = documents(spark, texts, more=[(None, "\n", "en", "s", 1)] * 2 + [(5, "\n", "en", "s", 1)] * 2)
    assert sorted(r.doc_id for r in near_dup.keep_one(docs).filter("doc_id IS NOT NULL").collect()) == [0, 1, 2, 3, 4, 5, 5, 5]
    assert near_dup.keep_one(docs).filter("doc_id IS NULL").count() == 2


@pytest.mark.parametrize("threshold", [0.5, 0.9])
def test_other_thresholds(spark, threshold):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(900)}" for _ in range(60)]
    texts = [" ".join(base[:k] + [f"x{k}-{i}" for i in range(60 - k)]) for k in range(10, 60, 2)]
    sets = [shingles(t) for t in texts]
    want = [sum(len(a & b) >= threshold * len(a | b) for b in sets) - 1 for a in sets]
    got = sorted(near_dup.near_duplicates(documents(spark, texts), threshold).collect(), key=lambda r: r.doc_id)
    assert [r.n_links for r in got] == want


def test_threshold_out_of_reach():
    assert [near_dup.rows_per_band(t) for t in (0.8, 0.9, 0.5)] == [4, 5, 2]
    with pytest.raises(ValueError):
        near_dup.rows_per_band(0.05)


def test_pages_of_one_template_fetch_no_texts(spark):
    """Thousands of pages at a similarity of 0.3 share buckets, but hardly any two are tied together."""
    rnd = random.Random(3)
    frame = [f"t{i}" for i in range(46)]
    texts = [" ".join(frame + [f"p{rnd.randrange(10**9)}" for _ in range(46)]) for _ in range(5000)]
    a, b = shingles(texts[0]), shingles(texts[1])
    assert 0.25 < len(a & b) / len(a | b) < 0.35
    classes = near_dup.stage(near_dup.text_classes(documents(spark, texts), 4).select("cls", "bands", "signature"), "texts")
    assert near_dup.likely_ties(classes, 0.8).count() < 20


def test_posterior_bounds():
    keep = near_dup.least_matches(0.8, near_dup.TOLERANCE)
    assert keep[0] == 0 and (keep[1:] >= keep[:-1]).all() and 40 < keep[80] < 64 and 95 < keep[160] < 110


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (200, 300), (7, 7)]
    got = {r.node: r.root for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, 200: 200, 300: 200}
