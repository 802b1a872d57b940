"""Language-model scores: an interpolated modified Kneser-Ney bigram model counted in Spark.

Method: tasks count words and word pairs of their slices of the training texts and send them, packed and sorted, to the shard
of their hash; each shard is merged into a sorted hash array in a file of the shared folder. Shard boundaries
are leading bits of the hash, so all files together are one sorted array. Workers memory-map the files and look
up the sorted, distinct words and pairs of a slice at a time. Hashes of pairs are a bijection of exact
word numbers; words are known by 64-bit hashes.

The number of shards follows the bytes of the input, so a shard's size does not. Nothing but one row of totals per shard
reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import crc_mod, mounted, new_folder, publish, table, text_of
from postlake.plans.staging import stage

SLICE_TOKENS = 1_000_000
SHARD_BYTES = 64 << 20
#: No word holds a blank, so these stand for what is no word.
END, START = b" ", b"\n"

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def word_hashes(words: np.ndarray) -> np.ndarray:
    return mixed(pd.util.hash_array(words, categorize=False).astype(np.uint64))


_MARKS = np.empty(2, object)
_MARKS[:] = [END, START]
END_HASH, START_HASH = word_hashes(_MARKS)


@dataclass
class Slice:
    """Some whole texts: distinct word hashes, sorted, and per token the number of its hash; every text ends with the end mark."""

    hashes: np.ndarray
    tokens: np.ndarray
    starts: np.ndarray  # of each text in ``tokens``
    rows: list


def slices(batches: Iterator[pa.RecordBatch], at: int, limit: int) -> Iterator[Slice]:
    """Texts of column ``at``, gathered to about ``limit`` tokens; A-Z lower-cased, words between ASCII blanks."""
    words: list[bytes] = []
    starts: list[int] = []
    rows: list[tuple[pa.RecordBatch, int]] = []

    def cut() -> Slice:
        array = np.empty(len(words), object)
        array[:] = words
        codes, kinds = pd.factorize(array)
        hashes, place = np.unique(word_hashes(kinds), return_inverse=True)
        out = Slice(hashes, place[codes], np.array(starts), list(rows))
        words.clear(), starts.clear(), rows.clear()
        return out

    for batch in batches:
        for i, text in enumerate(batch.column(at).to_pylist()):
            starts.append(len(words))
            words += (text or "").encode().lower().split()
            words.append(END)
            rows.append((batch, i))
            if len(words) >= limit:
                yield cut()
    if rows:
        yield cut()


def packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte planes apart, and counts; zlib takes the planes that are mostly zero."""
    steps = np.diff(values, prepend=values.dtype.type(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<u8")
    head = np.array([len(values), len(large)], "<u8").tobytes()
    return zlib.compress(head + np.ascontiguousarray(steps).tobytes() + small.tobytes() + large.tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    n, n_large = raw[:16].view("<u8").tolist()
    values = np.ascontiguousarray(raw[16 : 16 + 8 * n].reshape(8, n).T).view("<u8").ravel().cumsum(dtype=np.uint64)
    counts = raw[16 + 8 * n : 16 + 9 * n].astype(np.int64)
    counts[counts == 255] = raw[16 + 9 * n : 16 + 9 * n + 8 * n_large].view("<u8") if n_large else 0
    return values, counts


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def array_file(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(len(a) for a in arrays)], "<u8")
    return head.tobytes() + b"".join(a.astype("<i8" if a.dtype.kind == "i" else "<u8").tobytes() for a in arrays)


@lru_cache(maxsize=512)
def mapped(path: str) -> list[np.ndarray]:
    """The memory-mapped arrays of a file, as unsigned 64-bit numbers."""
    raw = np.memmap(path, "<u8", "r")
    n = int(raw[0])
    ends = (1 + n + np.cumsum(raw[1 : 1 + n])).astype("i8").tolist()
    return [raw[a:b] for a, b in zip([1 + n, *ends], ends)]


def count_codes(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


@dataclass(frozen=True)
class Model:
    """Where the files are, the totals, and the discounts; small, as the arrays stay in the files."""

    folder: str
    bits: int
    bases: np.ndarray  # of the word numbers of each shard
    train_tokens: int  # with end marks
    n_words: int  # distinct, the end mark with them
    pair_types: int = 0
    pair_discounts: list[float] = field(default_factory=list)
    word_discounts: list[float] = field(default_factory=list)
    unigram_backoff: float = 1.0

    def shard(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)

    def parts(self, h: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(shard, from, to) of sorted hashes."""
        owner = self.shard(h)
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(h)]):
            if a < b:
                yield int(owner[a]), a, b

    def words(self, h: np.ndarray, facts: bool) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of sorted word hashes (-1: unknown) and their counts, with ``facts`` also contexts before them and followers by count."""
        number, found = np.full(len(h), -1), np.zeros((5 if facts else 1, len(h)), np.int64)
        for s, a, b in self.parts(h):
            keys, counts = mapped(f"{self.folder}/words-{s:08d}")
            if not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, h[a:b]), len(keys) - 1)
            hit = keys[at] == h[a:b]
            number[a:b] = np.where(hit, at + self.bases[s], -1)
            columns = [counts, *(mapped(f"{self.folder}/contexts-{s:08d}") if facts else [])]
            for row, column in zip(found, columns):
                row[a:b] = np.where(hit, column[at], 0)
        return number, found

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """Counts of distinct pair keys."""
        h = mixed(keys)
        order = np.argsort(h)
        h = h[order]
        counts = np.zeros(len(h), np.int64)
        for s, a, b in self.parts(h):
            held, n = mapped(f"{self.folder}/pairs-{s:08d}")
            if len(held):
                at = np.minimum(np.searchsorted(held, h[a:b]), len(held) - 1)
                counts[a:b] = np.where(held[at] == h[a:b], n[at], 0)
        out = np.empty_like(counts)
        out[order] = counts
        return out


def with_start(s: Slice, numbers: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Per token the number of the one before it (the start mark's for the first of a text) and its own."""
    own = numbers[s.tokens]
    before = np.concatenate([[start], own[:-1]])
    before[s.starts] = start
    return before, own


def pair_keys(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64)


def discounts(n: list[int]) -> list[float]:
    """The three discounts of modified Kneser-Ney from the counts of counts; where one of these is 0, the simple discount."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = [1 - 2 * y * n2 / n1 if n1 and n2 else y, 2 - 3 * y * n3 / n2 if n2 and n3 else y, 3 - 4 * y * n4 / n3 if n3 and n4 else y]
    return [min(max(d, 0.01), k) for d, k in zip(found, (1.0, 2.0, 3.0))]


def dealt(keys: np.ndarray, counts: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """One packed row per shard; ``keys`` are sorted within each."""
    order = np.argsort(owner, kind="stable")
    owner, keys, counts = owner[order], keys[order], counts[order]
    cuts = np.flatnonzero(np.diff(owner)) + 1
    bounds = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(owner)])) if len(owner) else []
    rows = [(int(owner[a]), packed(keys[a:b], counts[a:b])) for a, b in bounds]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])


DEALT = "shard int, data binary"


def merged(rows: DataFrame, n_shards: int, finish: Callable[[int, list[bytes]], tuple[list[int], pa.RecordBatch | None]]) -> tuple[list[list[int]], DataFrame]:
    """Run ``finish`` once per shard, also for those without rows; its few totals by shard, and what it deals out in turn."""
    none = rows.sparkSession.range(n_shards).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("data"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        totals, out = finish(int(key[0]), [d for d in pdf["data"] if d is not None])
        more = out.to_pydict() if out is not None else {"shard": [], "data": []}
        n = len(more["shard"])
        return pd.DataFrame({"shard": [key[0], *more["shard"]], "totals": [totals, *[None] * n], "data": [None, *more["data"]]})

    found = stage(rows.unionByName(none).groupBy("shard").applyInPandas(run, "shard int, totals array<long>, data binary"), "shards")
    totals = found.filter("totals IS NOT NULL").select("shard", "totals").collect()
    return [r.totals for r in sorted(totals, key=lambda r: r.shard)], found.filter("data IS NOT NULL").select("shard", "data")


def joined(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The packed arrays of a shard as one, summed by key."""
    parts = [unpacked(d) for d in data]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def train(docs: DataFrame, usable: Column) -> Model:
    """Count the model over all texts of the ``usable`` rows of ``docs`` and store it."""
    spark, limit = docs.sparkSession, SLICE_TOKENS
    folder = mounted(new_folder(spark, "lm"))
    texts = docs.filter(usable).select(text_of().alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(3, (size // SHARD_BYTES).bit_length())
    model = Model(folder, bits, np.zeros(1 << bits, np.int64), 0, 0)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, 0, limit):
            hashes = np.concatenate([s.hashes, [START_HASH]])
            counts = np.concatenate([np.bincount(s.tokens, minlength=len(s.hashes)), [len(s.rows)]])
            hashes, counts = summed(hashes, counts)
            yield dealt(hashes, counts, model.shard(hashes))

    def store_words(shard: int, data: list[bytes]) -> tuple[list[int], None]:
        keys, counts = joined(data)
        publish(f"{folder}/words-{shard:08d}", array_file(keys, counts))
        real = keys != START_HASH
        return [len(keys), int(real.sum()), int(counts[real].sum())], None

    totals, _ = merged(texts.mapInArrow(words, DEALT), 1 << bits, store_words)
    bases = np.cumsum([0, *(t[0] for t in totals)])
    model = Model(folder, bits, bases[:-1], sum(t[2] for t in totals), sum(t[1] for t in totals))
    if not model.n_words:
        return model
    if bases[-1] >= 1 << 32:
        raise ValueError("pair keys hold word numbers of 32 bits")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = int(model.words(np.array([START_HASH]), False)[0][0])
        for s in slices(batches, 0, limit):
            numbers, _ = model.words(s.hashes, False)
            keys, counts = np.unique(pair_keys(*with_start(s, numbers, start)), return_counts=True)
            yield dealt(keys, counts, model.shard(mixed(keys)))

    def store_pairs(shard: int, data: list[bytes]) -> tuple[list[int], pa.RecordBatch]:
        keys, counts = joined(data)
        h = mixed(keys)
        order = np.argsort(h)
        publish(f"{folder}/pairs-{shard:08d}", array_file(h[order], counts[order]))
        # What this shard knows of each word, as a follower (kind 0) and as a context of pairs seen 1, 2, 3 or more times.
        kind = np.minimum(counts, 3).astype(np.uint64)
        facts = [((keys >> np.uint64(32)) << np.uint64(2)) | kind, (keys & np.uint64(0xFFFFFFFF)) << np.uint64(2)]
        about, n = np.unique(np.concatenate(facts), return_counts=True)
        owner = np.searchsorted(bases, (about >> np.uint64(2)).astype(np.int64), side="right") - 1
        return [len(keys), *count_codes(counts)], dealt(about, n, owner)

    totals, facts = merged(texts.mapInArrow(pairs, DEALT), 1 << bits, store_pairs)
    pair_types = sum(t[0] for t in totals)
    pair_discounts = discounts([sum(t[k] for t in totals) for k in range(1, 5)])

    def store_contexts(shard: int, data: list[bytes]) -> tuple[list[int], None]:
        columns = np.zeros((4, int(bases[shard + 1] - bases[shard])), np.int64)
        about, counts = joined(data)
        at = about.astype(np.int64)
        columns[at & 3, (at >> 2) - bases[shard]] = counts
        publish(f"{folder}/contexts-{shard:08d}", array_file(*columns))
        before = columns[0]
        return [*count_codes(before), int((before >= 3).sum())], None

    totals, _ = merged(facts, 1 << bits, store_contexts)
    n1, n2, n3, n4, n3_up = (sum(t[k] for t in totals) for k in range(5))
    d = discounts([n1, n2, n3, n4])
    backoff = (d[0] * n1 + d[1] * n2 + d[2] * n3_up) / pair_types
    return Model(folder, bits, bases[:-1], model.train_tokens, model.n_words, pair_types, pair_discounts, d, backoff)


def discounted(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3)], 0.0)


def slice_scores(s: Slice, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text: tokens, known tokens, base score, model score (log10)."""
    n_tokens = np.diff([*s.starts, len(s.tokens)])
    if not model.n_words:
        flat = np.log10(0.5 / 0.5) * n_tokens
        return n_tokens, np.zeros_like(n_tokens), flat, flat
    numbers, facts = model.words(s.hashes, True)
    marks, mark_facts = model.words(np.array([START_HASH]), True)
    counts, before, n1, n2, n3 = facts
    base = np.log10((counts + 0.5) / (model.train_tokens + 0.5 * (model.n_words + 1)))
    # Lower order: by how many different words stand before; the rest is spread over all words and one unknown.
    lower = discounted(before, model.word_discounts) / model.pair_types + model.unigram_backoff / (model.n_words + 1)
    d1, d2, d3 = model.pair_discounts
    # Per context: the mass its discounts set free. The start mark comes last.
    free = np.append(d1 * n1 + d2 * n2 + d3 * n3, d1 * mark_facts[2, 0] + d2 * mark_facts[3, 0] + d3 * mark_facts[4, 0])
    held = np.append(counts, mark_facts[0, 0])
    context = np.concatenate([[0], s.tokens[:-1]])
    context[s.starts] = len(counts)
    left, own = with_start(s, numbers, int(marks[0]))
    known = (left >= 0) & (own >= 0)
    keys, back = np.unique(pair_keys(left[known], own[known]), return_inverse=True)
    pair = np.zeros(len(own), np.int64)
    pair[known] = model.pairs(keys)[back]
    p = lower[s.tokens]
    total = held[context]
    some = total > 0
    p[some] = (discounted(pair[some], model.pair_discounts) + free[context[some]] * p[some]) / total[some]
    add = lambda x: np.add.reduceat(x, s.starts)  # noqa: E731  no text is without its end mark
    return n_tokens, add((counts > 0)[s.tokens].astype(np.int64)), add(base[s.tokens]), add(np.log10(p))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` plus n_tokens, n_known, base_score, score and perplexity.

    Every text ends with one end token, which counts; NULL and empty texts have this one alone. NULL ids and repeated rows
    are rows like others; columns of the result's names are replaced; an empty table gives an empty table.
    Without training texts every token has probability 1.
    """
    own = ["n_tokens", "n_known", "base_score", "score", "perplexity"]
    kept, limit = docs.drop(*own), SLICE_TOKENS
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, at, limit):
            columns = slice_scores(s, model)
            columns = [*columns, 10 ** (-columns[3] / columns[0])]
            taken, k = [], 0
            while k < len(s.rows):
                batch, first = s.rows[k]
                n = min(len(batch) - first, len(s.rows) - k)
                taken.append(batch.slice(first, n))
                k += n
            rows = pa.Table.from_batches(taken).combine_chunks()
            arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns]
            arrays = [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(c) for c in columns)], [*rows.schema.names, *own])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return kept.mapInArrow(run, ", ".join([*fields, "n_tokens long, n_known long, base_score double, score double, perplexity double"]))


def op2_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, crc_mod("doc_id", 5) != 1)
    rows = docs.withColumn("held_out", crc_mod("doc_id", 5) == 1)
    out = score_texts(rows, model)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


QUERIES = {"op2_lm_score": op2_lm_score}
SQL: dict[str, str] = {}
