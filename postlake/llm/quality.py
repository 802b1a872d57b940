"""Quality classifier: histogram gradient-boosted trees over document statistics.

Method: statistics of whole texts are taken in Spark tasks; trees are grown on histograms of a bounded sample of labelled rows
(at most ``FIT_ROWS``, spread by a hash of the id); the forest is flattened into arrays and all
rows of a batch walk all trees together. Statistics are of the text alone: no label, language, source or id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import crc_mod, table, text_of

#: Bound of the labelled sample that the trees are grown on; scores cover all rows.
FIT_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 48
LEAST_HESSIAN, RIDGE = 2.0, 1.0

_PUNCTUATION = np.array([chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for b in range(256)])
_SYMBOL = np.array([chr(b) in "#$%&*@^~+=<>\\{}[]_" for b in range(256)])
_STATISTICS = 26


def statistics(text: str) -> list[float]:
    """What the trees see of a text; an empty text gives zeros."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words = text.split()
    if not words:
        return [float(len(text))] + [0.0] * (_STATISTICS - 1)
    size, n = len(raw), len(words)
    bytes_ = np.bincount(raw, minlength=256)
    upper, lower = bytes_[65:91].sum(), bytes_[97:123].sum()
    share = bytes_[bytes_ > 0] / size
    counts = Counter(words)
    top = counts.most_common(3)
    lines = [x for x in text.split("\n") if x.strip()]
    full_stops = bytes_[46] + bytes_[33] + bytes_[63]
    return [
        log1p(size), log1p(n), size / n,
        upper / (upper + lower + 1), bytes_[48:58].sum() / size, bytes_[32] / size, bytes_[10] / size,
        bytes_[_PUNCTUATION].sum() / n, bytes_[_SYMBOL].sum() / n, bytes_[46] / n, bytes_[44] / n, bytes_[33] / n, bytes_[124] / n,
        bytes_[128:].sum() / size, float(-(share * np.log2(share)).sum()),
        len(counts) / n, top[0][1] / n, sum(c for _, c in top) / n, sum(map(eq, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n, sum(map(str.isalpha, words)) / n, n / (full_stops + 1),
        log1p(len(lines)), n / (len(lines) + 1), len(set(lines)) / (len(lines) or 1), log1p(max(map(len, counts))),
    ]


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as arrays: node k has children 2k+1 and 2k+2; ``base`` is the log-odds to start from."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        trees, inner = self.feature.shape
        at = np.zeros((len(x), trees), np.int64)
        rows, every = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[every, at]] > self.threshold[every, at]
            at = 2 * at + 1 + right
        return 1 / (1 + np.exp(-(self.base + self.leaf[every, at - inner].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Forest:
    """Boost on histograms. Without rows, or with one class alone, the forest gives the smoothed share of label 1."""
    n, inner = len(y), 2**depth - 1
    positive = float(y.sum()) if n else 0.0
    base = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if positive in (0.0, float(n)):
        return Forest(feature, threshold, leaf, base)
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    cells = codes + np.arange(width) * bins
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            keys = ((at - first)[:, None] * (width * bins) + cells).ravel()
            hist = [np.bincount(keys, np.repeat(w, width), nodes * width * bins).reshape(nodes, width, bins) for w in (g, h)]
            left_g, left_h = (a.cumsum(axis=2) for a in hist)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0.0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            f, b = np.divmod(best, bins)
            for k in range(nodes):
                # A node without a useful split sends all its rows to the left.
                if gain[k, f[k], b[k]] > 1e-6 and b[k] < len(edges[f[k]]):
                    feature[t, first + k], threshold[t, first + k] = f[k], edges[f[k]][b[k]]
            right = x[np.arange(n), feature[t, at]] > threshold[t, at]
            at = 2 * at + 1 + right
        ends = at - inner
        leaf[t] = -rate * np.bincount(ends, g, inner + 1) / (np.bincount(ends, h, inner + 1) + RIDGE)
        margin += leaf[t, ends]
    return Forest(feature, threshold, leaf, base)


def labelled_sample(labels: DataFrame, label: str, usable: Column, limit: int) -> DataFrame:
    """At most ``limit`` usable labels, spread by a hash of the id; of repeated labels the highest counts."""
    known = labels.filter(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    one = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column, limit: int = FIT_ROWS) -> Forest:
    """Trees for ``labels.quality``, learnt from at most ``limit`` labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    sample = F.broadcast(labelled_sample(labels, "quality", usable, limit))  # at most ``limit`` rows of two numbers
    texts = docs.select("doc_id", text_of().alias("_text")).join(sample, "doc_id").select("doc_id", "label", "_text")
    seen = texts.mapInArrow(run, "doc_id long, label int, x array<double>").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("x").alias("x"))
    rows = sorted((r.doc_id, r.label, r.x) for r in seen.collect())
    x = np.array([r[2] for r in rows]).reshape(-1, _STATISTICS)
    return grow(x, np.array([r[1] for r in rows], float))


def score_quality(docs: DataFrame, forest: Forest) -> DataFrame:
    """All columns of ``docs`` plus ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    NULL and empty texts are scored by their zero statistics; NULL ids and repeated rows are rows like others;
    columns of the result's names are replaced; an empty table gives an empty table.
    """
    kept = docs.drop("score", "predicted")
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t or "") for t in batch.column(at).to_pylist()]).reshape(-1, _STATISTICS)
            score = forest.scores(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= 0.5).astype("i4"))], [*batch.schema.names, "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return kept.mapInArrow(run, ", ".join([*fields, "score double", "predicted int"]))


def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = fit_quality(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    held = (crc_mod("doc_id", 3) == 1).alias("held_out")
    return score_quality(docs, forest).select("doc_id", held, "score", "predicted")


QUERIES = {"op10_quality": op10_quality}
SQL: dict[str, str] = {}
