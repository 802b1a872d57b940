from __future__ import annotations

import random
from collections import defaultdict

import pytest

from postlake.llm.line_dedup import dedup_lines
from tests.llm.rows import N_ODD, documents, odd

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_docs=2):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and min(holders[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_random_lines(spark, min_docs):
    rnd = random.Random(3)
    pool = ["a line of some length %d" % i for i in range(12)] + ["  A LINE of some length 3\t", "short", "", "ÉTÉ line of length", "été line of length", "\x0bLine With Tab\t "]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(0, 9)))) for i in range(40)]
    got = dedup_lines(documents(spark, [t for _, t in rows]), min_docs).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted(tuple(r) for r in got) == brute(rows, min_docs)


def test_odd_rows(spark):
    out = dedup_lines(odd(spark, "n_lines")).collect()
    assert len(out) == N_ODD
    by = {r.doc_id: r for r in out if r.doc_id not in (4, 7)}
    assert by[0].text == "" and by[0].n_lines == 1 and by[3].n_lines == 3
    assert [r.n_dropped for r in out if r.doc_id == 7] == [0, 0]  # repeated rows are one document
    null_last = documents(spark, ["the very same line"], more=[(None, "the very same line", None, None, None)])
    assert {r.doc_id: r.text for r in dedup_lines(null_last).collect()} == {0: "the very same line", None: ""}


def test_empty_table(spark):
    assert dedup_lines(documents(spark, [])).count() == 0


def test_clashing_columns_stay(spark):
    names = ["_k1", "_k2", "_gone", "_all", "row", "_id", "_line", "_keeper"]
    docs = documents(spark, ["a line of text\nb", "a line of text\nc"]).selectExpr("*", *[f"'mine' AS `{n}`" for n in names])
    out = sorted(dedup_lines(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.text, r.n_dropped) for r in out] == [("a line of text\nb", 0), ("c", 1)]
    assert {tuple(r[n] for n in names) for r in out} == {("mine",) * len(names)}
