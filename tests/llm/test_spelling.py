from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
from postlake.llm.spelling import Index, group_variants, one_edit, vocabulary
from tests.llm.rows import documents, odd


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(docs) -> dict[str, int]:
    c = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            c[run] += 1
    return c


def brute(docs, min_length=5, min_count=3):
    n = {w: c for w, c in counted(docs).items() if len(w) >= min_length and c >= min_count}
    # Candidates share what is left when one code point, or none, is taken out.
    by = {}
    for w in n:
        for left in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(left, set()).add(w)
    around = {w: set() for w in n}
    for some in by.values():
        for a in some:
            around[a] |= {b for b in some if b not in around[a] and near(a, b)}
    form = {}
    for w, ws in around.items():
        best = min(ws, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), n.get(form[w])))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_index_finds_all_pairs_once():
    rng = random.Random(2)
    for letters, most in (("ab", 7), ("abcé", 9), ("abcdefghijklmnop", 6)):
        words = list({"".join(rng.choice(letters) for _ in range(rng.randrange(1, most))) for _ in range(200)})
        index = Index(words)
        for from_left in (True, False):
            pairs = list(zip(*(x.tolist() for x in index.near(words, from_left))))
            assert len(pairs) == len(set(pairs))
            shares = (lambda a, b: b.startswith(a[: len(a) // 2])) if from_left else (lambda a, b: b.endswith(a[len(a) // 2 :]))
            want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(index.words) if shares(a, b) and near(a, b)}
            assert set(pairs) == want


def test_long_words_are_compared_whole():
    rng = random.Random(8)
    base = "".join(rng.choice("abcé") for _ in range(150))
    words = {base}
    for _ in range(150):
        w = list(rng.choice(sorted(words)))
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], [rng.choice("abz")], [w[i], "c"]])
        words.add("".join(w))
    words = sorted(words | {base[::-1], "ab" * 80, "ab" * 80 + "a", "b" + "ab" * 80, "a" * 140, "a" * 141})
    index = Index(words)
    for from_left in (True, False):
        pairs = list(zip(*(x.tolist() for x in index.near(words, from_left))))
        want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b) and Index.shares_half(a, b, from_left)}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want and want
    for a in words[:40]:
        for b in words:
            assert one_edit(a, b) == near(a, b)


def texts_of(rng, k):
    stems = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(4, 11))) for _ in range(60)]
    out = []
    for _ in range(k):
        words = []
        for _ in range(rng.randrange(60)):
            w = list(rng.choice(stems[: rng.choice([4, 20, 60])]))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(w))
                w[i : i + 1] = rng.choice([[], [rng.choice("abÀ")], [w[i], "c"]])
            words.append("".join(w))
        out.append(rng.choice([" ", "-", "1", "\n"]).join(words))
    return out


@pytest.mark.parametrize("block_points", [1 << 19, 1_000, 200])
def test_against_all_pairs(spark, block_points):
    """Also with blocks so small that halves are split into salted blocks and chunks of searches."""
    texts = texts_of(random.Random(4), 300)
    docs = documents(spark, texts, more=[(None, texts[0], None, None, None), (3, texts[1], None, None, None)])
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(want) > 100 and any(len({r[0], r[1], r[2]}) == 3 for r in want)
    assert got(group_variants(docs, block_points=block_points)) == want


def test_odd_rows(spark):
    for extra in (None, "word", "n", "block"):
        docs = odd(spark, extra).unionByName(odd(spark, extra)).unionByName(odd(spark, extra))
        assert got(group_variants(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_tables(spark):
    assert got(group_variants(documents(spark, []))) == []
    assert got(group_variants(documents(spark, [None, "", "1 2", "abcd"]))) == []


def test_long_runs(spark):
    for n in (700, 200_000):
        a, b = "ab" * n, "ab" * n + "c"
        ids = [d for d in range(99) if all(zlib.crc32(f"{d}:{w}".encode()) % 97 for w in (a, b))][:3]
        docs = documents(spark, [], more=[(d, f"{a} {b}", None, None, None) for d in ids])
        assert got(group_variants(docs)) == sorted([(a, None, a, 3, 1, None), (b, None, b, 3, 1, None)], key=repr)


def test_registered(spark):
    df = entry.queries()["op11_spelling_variants"](spark, "/root/testdata/sf0.01")
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert got(df) == brute(docs)
    assert {r.word: r.n for r in vocabulary(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()} == {r[0]: r[3] for r in brute(docs)}
