from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from postlake.llm.quality import fit_quality, grow, op10_quality, score_quality, statistics
from postlake.llm.toxicity import fit_toxicity, index_of, normalised, op9_toxicity, score_toxicity
from tests.llm.rows import N_ODD, documents, odd

SF = "/root/testdata/sf0.01"


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = query(spark, SF).filter("held_out").join(labels, "doc_id").collect()
    return np.array([r.score for r in rows]), np.array([r[label] for r in rows])


def auc(score, y):
    p, n = score[y == 1], score[y == 0]
    return float(((p[:, None] > n[None, :]) + 0.5 * (p[:, None] == n[None, :])).mean())


def test_quality_on_held_out_rows(spark):
    score, y = held_out(spark, op10_quality, "quality")
    assert auc(score, y) > 0.95 and ((score >= 0.5) == y).mean() > 0.93
    assert ((0 <= score) & (score <= 1)).all()


def test_toxicity_on_held_out_rows(spark):
    score, y = held_out(spark, op9_toxicity, "toxic")
    assert auc(score, y) > 0.75 and ((score >= 0.5) == y).mean() > 0.9


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark):
    docs = odd(spark, "score")
    some = labels(spark, [(0, 1, 0), (4, 0, 1), (4, 1, 0), (5, None, None), (None, 1, 1), (6, 1, 0), (7, 0, 1), (8, 1, 1), (99, 1, 1)])
    for fitted in (some, some.limit(0), some.filter("doc_id = 0")):
        for score, fit in ((score_quality, fit_quality), (score_toxicity, fit_toxicity)):
            got = score(docs, fit(docs, fitted, F.lit(True))).collect()
            assert len(got) == N_ODD and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
            assert score(documents(spark, []), fit(docs, fitted, F.lit(True))).count() == 0


def test_forest_walk_is_the_tree():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(500, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    f = grow(x, y, trees=20, depth=3)
    assert ((f.scores(x) >= 0.5) == y).mean() > 0.95
    for row, got in zip(x[:40], f.scores(x[:40])):
        total = f.base
        for t in range(len(f.feature)):
            k = 0
            while k < f.feature.shape[1]:
                k = 2 * k + 1 + int(row[f.feature[t, k]] > f.threshold[t, k])
            total += f.leaf[t, k - f.feature.shape[1]]
        assert abs(got - 1 / (1 + np.exp(-total))) < 1e-12  # summed in another order


def test_statistics_are_finite():
    for t in ["", " ", "\n", "A", "!!!", "é" * 10, "a b a b", "\x00"]:
        assert len(statistics(t)) == 26 and np.isfinite(statistics(t)).all()


def test_nearest_is_exact():
    rnd = random.Random(3)
    terms = [f"t{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(60)]
    examples = []
    for i in range(700):
        t = sorted(rnd.sample(range(60), rnd.randrange(0, 6)))
        examples.append((i, rnd.randrange(2), t, [rnd.randrange(1, 4) for _ in t]))
    df = [sum(k in e[2] for e in examples) for k in range(60)]
    index = index_of(examples, terms, df)
    dense = np.zeros((len(examples), 60))
    for e in examples:
        dense[e[0], e[2]] = normalised(index.idf[e[2]], np.array(e[3], float)) if e[2] else 0
    dense = dense[index.ids]  # in the index's order
    for _ in range(60):
        text = " ".join(rnd.choice(terms) for _ in range(rnd.randrange(0, 12)))
        t, w = index.vector(text)
        cosine = dense[:, t] @ w if len(t) else np.zeros(len(examples))
        want = [i for i in np.lexsort((np.arange(len(cosine)), -np.round(cosine, 12)))[:15] if cosine[i] > 0]
        got, value = index.nearest(t, w)
        assert np.allclose(value, cosine[want]) and len(got) == len(want)
