from __future__ import annotations

import random
import re

import pytest

from postlake.llm.decontaminate import decontaminate, proximity_matches
from tests.llm.rows import N_ODD, documents, odd

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            n = min(10, len(iw))
            for s in range(len(iw) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == iw[s : s + n]:
                        hit.update(range(p, p + n))
                        found.add(item)
        out.append((len(w), sorted(hit), sorted(found)))
    return out


def test_random_passages(spark):
    rnd = random.Random(5)
    vocabulary = ["the", "of", "and", "été", "Éa", "x1"] + ["w%d" % i for i in range(30)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice([3, 8, 10, 11, 25]))) for i in range(12)] + [(3, text(12)), (20, "!!"), (21, None)]
    texts = []
    for _ in range(40):
        parts = [text(rnd.randrange(0, 12))]
        for _ in range(rnd.randrange(0, 3)):
            piece = words(rnd.choice(items)[1])
            cut = rnd.randrange(0, 4)
            parts += [rnd.choice([" ", "-- ", "\n"]).join(piece[cut:]).upper() if rnd.random() < 0.3 else " ".join(piece[cut:]), text(2)]
        texts.append(" ".join(parts))
    benchmark = spark.createDataFrame([*items, (None, texts[0] or "a")], "item_id long, text string")
    got = sorted(decontaminate(documents(spark, texts), benchmark).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, sorted(r.hits), sorted(r.items)) for r in got] == brute(texts, items)
    assert all(r.n_hit == len(r.hits) and r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0) for r in got)


def test_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, "x" * 3000)], "item_id long, text string")
    got = decontaminate(odd(spark, "hits"), benchmark).collect()
    assert len(got) == N_ODD
    assert [r.n_items for r in got if r.doc_id == 5] == [1] and [r.n_hit for r in got if r.doc_id == 7] == [1, 1]
    assert decontaminate(documents(spark, []), benchmark).count() == 0
    none = decontaminate(odd(spark), benchmark.limit(0)).collect()
    assert len(none) == N_ODD and not any(r.contaminated for r in none)


def test_proximity(spark):
    benchmark = spark.createDataFrame([(1, " ".join("k%d" % i for i in range(20)))], "item_id long, text string")
    near = " ".join("k%d" % i for i in range(9)) + " gap gap " + " ".join("k%d" % i for i in range(11, 20))
    got = proximity_matches(documents(spark, [near, "k1 nothing else here"]), benchmark).collect()
    assert {r.doc_id for r in got} <= {0}


def test_near_copies_are_found(spark):
    words = lambda c, *n: " ".join(f"{c}{i}" for i in range(*n))
    benchmark = spark.createDataFrame([(1, words("k", 20)), (2, words("s", 5)), (3, words("m", 15)), (4, "solo"), (5, words("p", 10))], "item_id long, text string")
    texts = [
        words("k", 9) + " gap gap " + words("k", 11, 20),  # k9 and k10 are in no document
        "x " + words("s", 5) + " y",  # a short item, verbatim
        words("m", 15),  # all windows share their rarest word
        "a solo b",
        words("p", 4) + " q q " + words("p", 6, 10),  # two words of the only window changed
        "k1 nothing else here",
        words("k", 9) + " " + words("k", 10, 20),  # a word missing
    ]
    want = {(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (6, 1)}
    docs = documents(spark, texts)
    assert {(r.doc_id, r.item_id) for r in proximity_matches(docs.filter("doc_id <> 6"), benchmark).collect()} == want - {(6, 1)}
    got = decontaminate(docs, benchmark, near=True).collect()
    assert {(r.doc_id, m.item_id) for r in got for m in r.near_matches} == want
    assert {r.doc_id for r in got if r.contaminated} == {1, 2, 3, 6}


@pytest.mark.parametrize("near", [False, True])
def test_clashing_columns_and_text_ids(spark, near):
    names = ["_found", "_k1", "_k2", "_spans", "row", "_item", "item_id", "_term"]
    words = " ".join(f"k{i}" for i in range(12))
    docs = documents(spark, [f"x {words} y", "nothing here"]).selectExpr("*", *[f"'mine' AS `{n}`" for n in names])
    items = spark.createDataFrame([("item-a", words), ("item-b", "not there at all")], "item_id string, text string")
    out = sorted(decontaminate(docs, items, near=near).collect(), key=lambda r: r.doc_id)
    assert [(r.n_hit, r["items"]) for r in out] == [(12, ["item-a"]), (0, [])]
    assert {tuple(r[n] for n in names) for r in out} == {("mine",) * len(names)}
