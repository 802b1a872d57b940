from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm import lm
from postlake.llm.common import crc_mod
from tests.llm.rows import N_ODD, documents, odd


def tokens(text):
    return (text or "").encode().lower().split() + [b"<end>"]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.count, self.pair = Counter(), Counter()
        before = defaultdict(set)
        for t in texts:
            w = [b"<start>", *tokens(t)]
            self.count.update(w[1:])
            self.pair.update(zip(w, w[1:]))
        for a, b in self.pair:
            before[b].add(a)
        self.before = {w: len(s) for w, s in before.items()}
        self.held, self.follow = Counter(), defaultdict(Counter)
        for (a, _), n in self.pair.items():
            self.held[a] += n
            self.follow[a][min(n, 3)] += 1
        self.d2 = self.discounts(self.pair.values())
        self.d1 = self.discounts(self.before.values())
        self.types = len(self.pair)
        self.v = len(self.count)

    @staticmethod
    def discounts(counts):
        c = Counter(counts)
        return lm.discounts([c[k] for k in (1, 2, 3, 4)])

    def p1(self, w):
        n = self.before.get(w, 0)
        mass = sum(self.d1[min(x, 3) - 1] for x in self.before.values()) / self.types
        return max(n - (self.d1[min(n, 3) - 1] if n else 0), 0) / self.types + mass / (self.v + 1)

    def p2(self, a, w):
        if not self.held[a]:
            return self.p1(w)
        n = self.pair[a, w]
        mass = sum(self.d2[k - 1] * m for k, m in self.follow[a].items())
        return (max(n - (self.d2[min(n, 3) - 1] if n else 0), 0) + mass * self.p1(w)) / self.held[a]

    def score(self, text):
        w = [b"<start>", *tokens(text)]
        return sum(math.log10(self.p2(a, b)) for a, b in zip(w, w[1:]))


@pytest.mark.parametrize("slice_tokens", [1_000_000, 7])
def test_against_dictionaries(spark, monkeypatch, slice_tokens):
    monkeypatch.setattr(lm, "SLICE_TOKENS", slice_tokens)
    import random

    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("the The of a b c dd é É x1".split() + ["w%d" % rnd.randrange(30)]) for _ in range(rnd.randrange(0, 30))) for _ in range(60)]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(60)]
    docs = documents(spark, texts)
    model = lm.train(docs, crc_mod("doc_id", 5) != 1)
    brute = Brute([t for t, h in zip(texts, held) if not h])
    assert (model.train_tokens, model.n_words) == (sum(brute.count.values()), brute.v)
    n = model.train_tokens
    for r in lm.score_texts(docs, model).collect():
        w = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(w), sum(x in brute.count for x in w))
        assert r.base_score == pytest.approx(sum(math.log10((brute.count[x] + 0.5) / (n + 0.5 * (brute.v + 1))) for x in w))
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]))
    # the probabilities after any word sum to one over all words and one unknown
    for a in (b"<start>", b"the", b"never seen"):
        assert sum(brute.p2(a, w) for w in [*brute.count, b"unseen"]) == pytest.approx(1)


def test_packing():
    rnd = np.random.default_rng(0)
    keys = np.unique(rnd.integers(0, 1 << 63, 1000, dtype=np.uint64))
    counts = rnd.integers(1, 1000, len(keys))
    a, b = lm.unpacked(lm.packed(keys, counts))
    assert (a == keys).all() and (b == counts).all()


def test_odd_rows(spark):
    docs = odd(spark, "score")
    got = lm.score_texts(docs, lm.train(docs, F.lit(True))).collect()
    assert len(got) == N_ODD and all(r.score < 0 and r.n_tokens >= 1 for r in got)
    assert [r.n_tokens for r in got if r.doc_id in (0, 1, 2, 3)] == [1] * 4
    untrained = lm.train(docs, F.lit(False))
    assert all(r.score == 0 and r.n_known == 0 for r in lm.score_texts(docs, untrained).collect())
    assert lm.score_texts(documents(spark, []), untrained).count() == 0
