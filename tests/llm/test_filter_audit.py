from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations
from math import factorial

import __spark_entry__ as entry
from postlake.llm.filter_audit import SCHEMA, audit_filters, shapley
from tests.llm.rows import SCHEMA as DOCS
from tests.llm.rows import documents, odd

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order walked document by document."""
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1 and d is not None} for k in (0, 1))
    place = lambda d: 1 << 63 if d is None else d
    least = {}
    for d, text, source in docs:
        least[text or ""] = min(least.get(text or "", 1 << 63), place(d))
    fails = []
    for d, text, source in docs:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        found = ""
        found += "A" if len(words) < 50 else ""
        found += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        found += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        found += "D" if re.search("[#$%&*|]", t) else ""
        found += "E" if place(d) > least[t] else ""
        fails.append((source or "", d, found))
    out = []
    for part in {f[0] for f in fails}:
        own = [(d, f) for p, d, f in fails if p == part]
        total = Counter()
        rows = []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                total[x] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == x for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), x))
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return sorted(out)


def got(df):
    assert [f.split()[0] for f in SCHEMA.split(", ")] == df.columns
    return sorted(tuple(r) for r in df.collect())


def test_shapley_is_the_mean_over_orders():
    rng = random.Random(3)
    for n in (1, 2, 3, 5):
        value = [rng.randrange(-50, 1000) for _ in range(1 << n)]
        want = [Fraction(0)] * n
        for order in permutations(range(n)):
            s = 0
            for i in order:
                want[i] += Fraction(value[s | 1 << i] - value[s], factorial(n))
                s |= 1 << i
        assert shapley(value) == want


def test_against_every_order_walked(spark):
    rng = random.Random(5)
    words = ["alpha", "Beta", "GAMMA", "del#ta", "eps", "zeta", "et*a", "théta", "iota", "\U0001f600"]
    texts = [" ".join(rng.choice(words) if rng.random() < 0.3 else f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 49, 50, 51, 80]))) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, "", "srcé"])) for i in range(300)]
    rows += [rows[3], rows[3], (None, texts[0], "a"), (None, "only without an id", "a"), (None, "only without an id", "b"), (5, "second text of an id", "a")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(d, t, "en", s, 1) for d, t, s in rows], DOCS)
    assert got(audit_filters(docs, spark.createDataFrame(labels, LABELS))) == brute(rows, labels)


def test_odd_rows(spark):
    for extra in (None, "fails", "part", "n"):
        docs = odd(spark, extra)
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        assert got(audit_filters(docs, spark.createDataFrame([(7, 1, 1)], LABELS))) == brute(rows, [(7, 1, 1)])


def test_empty_tables(spark):
    assert got(audit_filters(documents(spark, []), spark.createDataFrame([], LABELS))) == []
    out = got(audit_filters(documents(spark, ["x"]), spark.createDataFrame([], LABELS)))
    assert len(out) == 600 and all(r[-1] == (120 if r[1][r[2] - 1] == "A" else 0) for r in out)


def test_registered(spark):
    df = entry.queries()["op13_filter_audit"](spark, "/root/testdata/sf0.001")
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert got(df) == brute(docs, labels)
