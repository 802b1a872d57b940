"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Method: at most ``FIT_ROWS`` labelled documents become examples; terms are words and word beginnings, chosen by their
chi-square with the label; per term the index lists the blocks of examples with its largest weight in each. A document's
bound for a block is the sum of its terms' largest weights there; blocks are scored from the highest bound
down until no bound reaches the k-th best cosine, so the neighbours are exact. Their votes, weighted by
cosine, are calibrated on examples, each without its own vote.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import crc_mod, table, text_of
from postlake.llm.quality import labelled_sample
from postlake.plans.staging import stage

#: Bounds of what is learnt: labelled rows, terms, and examples used to calibrate. Scores cover all rows and whole texts.
FIT_ROWS, TERMS, CALIBRATED = 20_000, 4_096, 8_000
NEIGHBOURS, BLOCK = 15, 64
#: A term must be in so many examples, in at most this share of them, and tell the classes apart this well.
LEAST_EXAMPLES, MOST_SHARE, LEAST_CHI2 = 5, 0.2, 15.0
BEGINNINGS = (4, 6)
#: Weight of the silent vote for label 0, which rules where there are no near examples.
PRIOR = 0.05

WORD = re.compile(r"[^\W\d_]+")


def term_counts(text: str) -> Counter[str]:
    """Words, and the beginnings of longer words, marked with a caret."""
    words = Counter(WORD.findall(text.lower()))
    starts: Counter[str] = Counter()
    for w, n in words.items():
        for k in BEGINNINGS:
            if len(w) > k:
                starts["^" + w[:k]] += n
    words.update(starts)
    return words


@dataclass(frozen=True)
class Index:
    """Examples in blocks: per term and block the largest weight, and per block its postings, example by example."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray  # doc_id of each example
    labels: np.ndarray
    starts: np.ndarray  # of each example's postings; each has at least one, of a term that is in no text
    term: np.ndarray
    weight: np.ndarray
    most: np.ndarray  # terms x blocks: the largest weight
    logits: np.ndarray  # turn votes into a score

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and normalised TF-IDF weights of a text."""
        found: Counter[int] = Counter()
        number = self.terms.get
        for w, n in Counter(WORD.findall(text.lower())).items():
            if (t := number(w)) is not None:
                found[t] += n
            size = len(w)
            for k in BEGINNINGS:
                if size > k and (t := number("^" + w[:k])) is not None:
                    found[t] += n
        t = np.array(sorted(found), np.int64)
        return t, normalised(self.idf[t], np.array([found[i] for i in t.tolist()], float))

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the highest cosine above 0 and their cosines, ties to the smaller number."""
        n = len(self.labels)
        if not len(t) or not n:
            return np.empty(0, np.int64), np.empty(0)
        bound = w @ self.most[t]
        order = np.argsort(-bound, kind="stable").tolist()
        query = np.zeros(len(self.terms) + 1)
        query[t] = w
        best, cosine, at, step = np.empty(0, np.int64), np.empty(0), 0, 4
        while at < len(order) and bound[order[at]] > 0:
            if len(best) == k and bound[order[at]] * (1 + 1e-9) < cosine[-1]:
                break
            who, value = [best], [cosine]
            for block in order[at : at + step]:
                first, last = block * BLOCK, min(block * BLOCK + BLOCK, n)
                low, high = self.starts[first], self.starts[last]
                sums = np.add.reduceat(query[self.term[low:high]] * self.weight[low:high], self.starts[first:last] - low)
                near = np.flatnonzero(sums)
                who.append(near + first)
                value.append(sums[near])
            best, cosine = np.concatenate(who), np.concatenate(value)
            if without >= 0:
                others = best != without
                best, cosine = best[others], cosine[others]
            if len(best) > k:
                # Only ties with the k-th best need an order.
                least = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
                best, cosine = best[cosine >= least], cosine[cosine >= least]
            top = np.lexsort((best, -cosine))[:k]
            best, cosine = best[top], cosine[top]
            at, step = at + step, min(32, step * 2)
        return best, cosine

    def votes(self, best: np.ndarray, cosine: np.ndarray) -> list[float]:
        share = float((cosine * self.labels[best]).sum() / (cosine.sum() + PRIOR))
        return [1.0, share, float(cosine[0]) * share if len(cosine) else 0.0]

    def score(self, text: str) -> tuple[float, np.ndarray, np.ndarray]:
        """Calibrated score, and as evidence the nearest examples' doc_ids with their cosines."""
        best, cosine = self.nearest(*self.vector(text))
        return float(1 / (1 + np.exp(-np.dot(self.votes(best, cosine), self.logits)))), self.ids[best], cosine


def normalised(idf: np.ndarray, counts: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * idf
    return w / (np.sqrt((w * w).sum()) or 1.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 25) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), x.T @ (p - y) + ridge * beta)
    return beta


def index_of(examples: list[tuple[int, int, list[int], list[int]]], terms: list[str], holding: list[int]) -> Index:
    """Index over (doc_id, label, term numbers, counts); ``holding`` has the number of examples of each term."""
    n = len(examples)
    idf = np.log((1 + n) / (1 + np.array(holding, float))) + 1
    # Examples with the same leading term stand together, which makes the blocks' largest weights tell more.
    vectors = [(np.array(t, np.int64), np.array(c, float)) for _, _, t, c in examples]
    weighted = [(t, normalised(idf[t], c)) for t, c in vectors]
    lead = [int(t[w.argmax()]) if len(t) else -1 for t, w in weighted]
    order = sorted(range(n), key=lambda i: (lead[i], examples[i][0]))
    blocks = -(-n // BLOCK)
    sizes = np.array([len(weighted[i][0]) + 1 for i in order], np.int64)
    term = np.concatenate([np.append(weighted[i][0], len(terms)) for i in order] or [np.empty(0, np.int64)]).astype(np.int64)
    weight = np.concatenate([np.append(weighted[i][1], 0.0) for i in order] or [np.empty(0)])
    most = np.zeros((len(terms) + 1, blocks))
    np.maximum.at(most, (term, np.repeat(np.arange(n), sizes) // BLOCK), weight)
    labels = np.array([examples[i][1] for i in order], float)
    ids = np.array([examples[i][0] for i in order], np.int64)
    bare = Index({t: i for i, t in enumerate(terms)}, idf, ids, labels, np.concatenate([[0], np.cumsum(sizes)]), term, weight, most, np.zeros(3))
    if not n:
        return bare
    # Votes on the examples themselves, spread over all of them, show what a vote is worth.
    shown = range(0, n, max(1, n // CALIBRATED))
    seen = [bare.votes(*bare.nearest(*weighted[order[k]], without=k)) for k in shown]
    return Index(**{**vars(bare), "logits": logistic(np.array(seen), labels[list(shown)])})


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, limit: int = FIT_ROWS) -> Index:
    """Index of at most ``limit`` labelled documents. Without labels every score is one half."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(t) for t in batch.column(2).to_pylist()]
            words = pa.array([list(c) for c in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), words, pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["doc_id", "label", "term", "n"])

    sample = F.broadcast(labelled_sample(labels, "toxic", usable, limit))  # at most ``limit`` rows of two numbers
    texts = docs.select("doc_id", text_of().alias("_text")).join(sample, "doc_id").select("doc_id", "label", "_text")
    rows = texts.mapInArrow(counted, "doc_id long, label int, term array<string>, n array<int>")
    # A repeated id is one example, and so is a repeated text: copies would make words of theirs look telling.
    one = rows.groupBy("doc_id").agg(F.max(F.struct("label", "term", "n")).alias("e")).select("doc_id", "e.*")
    once = one.groupBy(F.xxhash64("term", "n").alias("same")).agg(F.max(F.struct("label", "doc_id", "term", "n")).alias("e")).select("e.*")
    examples = stage(once.select("doc_id", "label", "term", "n"), "examples")
    n, positive = examples.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    held = examples.select("label", F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("label").alias("pos"))
    a, both = F.col("pos"), F.col("df")
    spread = F.lit(float(n)) * F.pow(a * F.lit(float(n)) - both * F.lit(float(positive)), 2)
    chi2 = spread / (both * (n - both) * F.lit(float(max(1, positive)) * max(1, n - positive)))
    chosen = held.filter((both >= min(LEAST_EXAMPLES, max(1, n // 50))) & (both <= max(1, MOST_SHARE * n)) & (both < n)).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
    top = chosen.orderBy(F.desc("chi2"), "term").limit(TERMS).collect()
    number = {r.term: i for i, r in enumerate(top)}

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [[(number[w], c) for w, c in zip(ws, cs) if w in number] for ws, cs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            t, c = ([[p[k] for p in sorted(ps)] for ps in pairs] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(t, pa.list_(pa.int32())), pa.array(c, pa.list_(pa.int32()))], ["doc_id", "label", "t", "c"])

    vectors = examples.select("doc_id", "label", "term", "n").mapInArrow(kept, "doc_id long, label int, t array<int>, c array<int>").collect()
    return index_of(sorted((r.doc_id, r.label, r.t, r.c) for r in vectors), [r.term for r in top], [r.df for r in top])


def score_toxicity(docs: DataFrame, index: Index) -> DataFrame:
    """All columns of ``docs`` plus ``score``, ``predicted``, and as evidence ``near_ids`` with their ``near_cosines``.

    NULL and empty texts have no near examples and get the score of that; NULL ids and repeated rows are
    rows like others; columns of the result's names are replaced; an empty table gives an empty table.
    """
    kept = docs.drop("score", "predicted", "near_ids", "near_cosines")
    at = kept.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by FIT_ROWS and TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            rows = [found.score(t or "") for t in batch.column(at).to_pylist()]
            score = np.array([r[0] for r in rows], float)
            ids, near = pa.array([r[1].tolist() for r in rows], pa.list_(pa.int64())), pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= 0.5).astype("i4")), ids, near], [*batch.schema.names, "score", "predicted", "near_ids", "near_cosines"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return kept.mapInArrow(run, ", ".join([*fields, "score double, predicted int, near_ids array<long>, near_cosines array<double>"]))


def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = fit_toxicity(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    held = (crc_mod("doc_id", 5) == 0).alias("held_out")
    return score_toxicity(docs, index).select("doc_id", held, "score", "predicted", "near_ids")


QUERIES = {"op9_toxicity": op9_toxicity}
SQL: dict[str, str] = {}
