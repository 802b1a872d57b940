"""N-gram Jaccard join: all pairs of different texts whose sets of five-word shingles are similar enough.

Method: MinHash values of the shingle sets, dealt into bands; texts that share a band are candidates. Candidates are
compared on their MinHash values a few at a time, and a pair is dropped as soon as the posterior probability
that its Jaccard similarity reaches the threshold falls below ``TOLERANCE`` (uniform prior); what remains is verified on the sets.

Texts with equal shingle sets are one class from the start, so copies never meet. Within a bucket classes are first compared
on MinHash values alone, kept beside the class: pages of one template share many buckets and end there. What
is left ties classes together, and connected components of these ties bound where links can be: only their texts are fetched,
and each component is verified on its own. A bucket or component over its bound is cut into blocks, each pair of which
is a piece of work of bounded size. Pairs are never written: a piece returns per class its number of links
and a spanning edge to its group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import LAST_ID, row_key, table, text_of
from postlake.plans.staging import stage

SHINGLE = 5
THRESHOLD = 0.8
#: Values per set, and how many of them make bands; the others only tell pairs apart.
HASHES, BANDED = 160, 80
STEP = 8
TOLERANCE = 1e-7
#: The chance that a pair at the threshold shares no band.
MISSED = 1e-4
#: Classes of a block: of texts, and of MinHash values.
CELL, SIGNED = 256, 4_096
_SLICE = 1 << 18

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20)
_A = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text: lower-cased words between blanks; fewer than ``size`` words are one shingle."""
    words: list[str] = []
    ends = []
    for t in texts:
        words += t.lower().split()
        ends.append(len(words))
    if not words:
        return [np.empty(0, np.uint64) for _ in texts]
    codes, kinds = pd.factorize(np.array(words, object))
    h = mixed(pd.util.hash_array(kinds, categorize=False).astype(np.uint64))[codes]
    n = len(h)
    grams = np.zeros(n, np.uint64)
    for j in range(size):
        grams[: n - j] = mixed(grams[: n - j] * _STEP + h[j:] + np.uint64(j + 1)) if n > j else grams[: n - j]
    out, start = [], 0
    for end in ends:
        if end - start >= size:
            out.append(np.unique(grams[start : end - size + 1]))
        elif end > start:
            x = np.zeros(1, np.uint64)
            for v in h[start:end]:
                x = mixed(x * _STEP + v + np.uint64(77))
            out.append(x)
        else:
            out.append(np.empty(0, np.uint64))
        start = end
    return out


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row per non-empty set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    at = 0
    while at < len(sets):
        # Whole sets, about a slice of shingles at a time: the working memory is bounded by the largest set.
        stop, held = at, 0
        while stop < len(sets) and (stop == at or held + len(sets[stop]) <= _SLICE):
            held += len(sets[stop])
            stop += 1
        flat = np.concatenate(sets[at:stop])
        starts = np.cumsum([0, *(len(s) for s in sets[at : stop - 1])])
        for k in range(HASHES):
            out[at:stop, k] = np.minimum.reduceat(((flat * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), starts)
        at = stop
    return out


def rows_per_band(threshold: float) -> int:
    """The most values a band may have so that a pair at the threshold shares one, but for a chance of ``MISSED``."""
    for rows in (8, 5, 4, 2, 1):
        if (1 - threshold**rows) ** (BANDED // rows) <= MISSED:
            return rows
    raise ValueError(f"{BANDED} values cannot find pairs at a similarity of {threshold}")


def bands_of(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` values."""
    parts = values[:, :BANDED].reshape(len(values), -1, rows).astype(np.uint64)
    keys = np.arange(parts.shape[1], dtype=np.uint64)[None, :] * _STEP
    for r in range(rows):
        keys = mixed(keys + parts[:, :, r] * _MIX[1] + np.uint64(r))
    return keys.view(np.int64)


def class_of(shingles: np.ndarray) -> int:
    """64-bit fingerprint of a shingle set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For 0..HASHES compared values, the fewest equal ones that keep a pair.

    With a uniform prior the similarity after m of n equal values is Beta(m + 1, n - m + 1), and its
    chance to be over t is that of at most m successes in n + 1 draws with chance t.
    """
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(HASHES + 1):
        chance = 0.0
        for m in range(n + 1):
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                out[n] = m
                break
    return out


def linked_pairs(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of a, j of b) with similarity of at least ``threshold``; without b, pairs i < j within a."""
    va = minhashes(a)
    vb = va if b is None else minhashes(b)
    sets_b = a if b is None else b
    keep = least_matches(threshold, tolerance)
    equal = np.zeros((len(va), len(vb)), np.int64)
    for k in range(STEP):
        equal += va[:, k][:, None] == vb[:, k][None, :]
    alive = equal >= keep[STEP]
    if b is None:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    same = equal[i, j]
    for at in range(STEP, HASHES, STEP):
        same = same + (va[i, at : at + STEP] == vb[j, at : at + STEP]).sum(axis=1)
        live = same >= keep[at + STEP]
        i, j, same = i[live], j[live], same[live]
    if not len(i):
        return i, j
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in sets_b])
    shared = shared_counts(a, sets_b, i, j)
    close = shared >= threshold * (na[i] + nb[j] - shared) - 1e-9
    return i[close], j[close]


def shared_counts(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the given pairs of sets, exactly."""
    if len(i) <= 64:
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    # Many pairs of few sets: 0/1 matrices over the shingles that stand on both sides, a slice of them at a time.
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(flat_a, flat_b)
    row_a, row_b = np.repeat(np.arange(len(a)), [len(s) for s in a]), np.repeat(np.arange(len(b)), [len(s) for s in b])
    col_a, col_b = np.searchsorted(both, flat_a), np.searchsorted(both, flat_b)
    in_a, in_b = col_a < len(both), col_b < len(both)
    in_a[in_a] = both[col_a[in_a]] == flat_a[in_a]
    in_b[in_b] = both[col_b[in_b]] == flat_b[in_b]
    row_a, col_a, row_b, col_b = row_a[in_a], col_a[in_a], row_b[in_b], col_b[in_b]
    order_a, order_b = np.argsort(col_a, kind="stable"), np.argsort(col_b, kind="stable")
    row_a, col_a, row_b, col_b = row_a[order_a], col_a[order_a], row_b[order_b], col_b[order_b]
    total = np.zeros((len(a), len(b)), np.float32)
    width = 4096
    for low in range(0, len(both), width):
        ma, mb = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        p, q = np.searchsorted(col_a, [low, low + width])
        ma[row_a[p:q], col_a[p:q] - low] = 1
        p, q = np.searchsorted(col_b, [low, low + width])
        mb[row_b[p:q], col_b[p:q] - low] = 1
        total += ma @ mb.T
    return total[i, j].astype(np.int64)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """Of n items the smallest of their connected group, by the given links."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(i.tolist(), j.tolist()):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [top(x) for x in range(n)]


def likely_pairs(values: np.ndarray, others: np.ndarray | None, threshold: float, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose MinHash values leave the threshold possible; without ``others``, pairs i < j within ``values``."""
    keep = least_matches(threshold, tolerance)
    right = values if others is None else others
    if others is None and len(values) == 2:
        alike = int(np.count_nonzero(values[0] == values[1]) >= keep[HASHES])
        return np.zeros(alike, np.int64), np.ones(alike, np.int64)
    found = [(np.empty(0, np.int64),) * 2]
    rows = max(1, (1 << 20) // max(1, len(right)))
    for low in range(0, len(values), rows):
        left = values[low : low + rows]
        equal = np.zeros((len(left), len(right)), np.int16)
        for k in range(STEP):
            equal += left[:, k][:, None] == right[:, k][None, :]
        alive = equal >= keep[STEP]
        if others is None:
            alive &= np.arange(len(right)) > np.arange(low, low + len(left))[:, None]
        i, j = np.nonzero(alive)
        same = equal[i, j].astype(np.int64)
        for at in range(STEP, HASHES, STEP):
            same = same + (left[i, at : at + STEP] == right[j, at : at + STEP]).sum(axis=1)
            live = same >= keep[at + STEP]
            i, j, same = i[live], j[live], same[live]
        found.append((i + low, j))
    return tuple(np.concatenate(x) for x in zip(*found))


def text_classes(docs: DataFrame, rows_in_band: int) -> DataFrame:
    """(_k1, _k2, doc_id, cls, bands, signature) for every row with words; ``cls`` is a hash of the shingle set, the signature 16 bits of each MinHash value."""
    names = ["_k1", "_k2", "doc_id", "cls", "bands", "signature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                sets = shingle_sets(part.column(3).to_pylist())
                some = [k for k, s in enumerate(sets) if len(s)]
                if not some:
                    continue
                values = minhashes([sets[k] for k in some])
                keys = bands_of(values, rows_in_band)
                classes = pa.array([class_of(sets[k]) for k in some], pa.int64())
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel(), pa.int64()))
                signature = pa.array([v.tobytes() for v in values.astype("<u2")], pa.binary())
                taken = part.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), taken.column(2), classes, bands, signature], names)

    rows = docs.select(*row_key(), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "_k1 long, _k2 long, doc_id long, cls long, bands array<long>, signature binary")


def in_pieces(members: DataFrame, group: str, size: Column, per_block: int, *columns: str) -> DataFrame:
    """Rows of every pair of blocks of a group, dealt by piece: piece, group, i, j, block, and the columns; a group's rows go to each of its blocks' pairs."""
    n_blocks = F.ceil(size / per_block).cast("int")
    dealt = members.withColumns({"n_blocks": n_blocks, "block": F.pmod(F.xxhash64("cls", F.lit(5)), n_blocks).cast("int")})
    both = dealt.select(group, "block", *columns, F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other"))
    i, j = F.least("block", "other"), F.greatest("block", "other")
    pieces = both.select(F.xxhash64(group, i, j).alias("piece"), group, i.alias("i"), j.alias("j"), "block", *columns)
    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(partitions * 2, "piece").sortWithinPartitions("piece", group, "i", "j", "block")


def by_piece(batches: Iterator[pa.RecordBatch], compare: Callable[[list[tuple], bool], list[tuple]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Gather the rows of one piece at a time, (block is the second, *columns), and yield what ``compare`` makes of them as ``names``."""
    waiting: list[tuple] = []
    out: list[tuple] = []
    key: tuple | None = None

    def finish() -> None:
        if key is not None and len(waiting) > 1:
            out.extend(compare(waiting, key[2] == key[3]))

    def sent() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(len(names))], names)
        out.clear()
        return batch

    for batch in batches:
        for *piece, block, cls, data in zip(*(c.to_pylist() for c in batch.columns)):
            if tuple(piece) != key:
                finish()
                waiting.clear()
                key = tuple(piece)
            waiting.append((block == key[3] and key[2] != key[3], cls, data))
        yield sent()
    finish()
    yield sent()


def sides(rows: list[tuple]) -> tuple[list[int], list[int]]:
    """Places of the rows of the first and of the second block."""
    return [k for k, r in enumerate(rows) if not r[0]], [k for k, r in enumerate(rows) if r[0]]


def likely_ties(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b): classes whose MinHash values leave the threshold possible, tied to the smallest of their group in a piece of a bucket."""
    placed = classes.select("cls", F.explode("bands").alias("bucket"))
    same = [F.bit_xor(F.xxhash64("cls", F.lit(seed))).alias(f"same{seed}") for seed in (7, 8)]
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), *same).filter("size > 1")
    # Near copies share many buckets; those with the same members are compared once.
    shared = shared.groupBy("size", "same7", "same8").agg(F.min("bucket").alias("bucket"))
    members = placed.join(shared, "bucket").join(classes.select("cls", "signature"), "cls")

    def compare(rows: list[tuple], alone: bool) -> list[tuple]:
        values = np.frombuffer(b"".join(r[2] for r in rows), "<u2").reshape(len(rows), HASHES)
        if alone:
            i, j = likely_pairs(values, None, threshold)
        else:
            left, right = sides(rows)
            i, j = likely_pairs(values[left], values[right], threshold)
            i, j = np.array(left, np.int64)[i], np.array(right, np.int64)[j]
        return [(rows[k][1], rows[r][1]) for k, r in enumerate(roots(len(rows), i, j)) if r != k]

    pieces = in_pieces(members, "bucket", F.col("size"), SIGNED, "cls", "signature")
    return pieces.mapInArrow(lambda batches: by_piece(batches, compare, ["a", "b"]), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the smallest node it is connected with.

    Alternates two steps until nothing changes: each node's larger neighbours, then its smaller ones, are tied to the
    smallest. Both take a minimum per node and join it back, so a node with very many neighbours is never
    gathered. Each round is a written table: a lost executor repeats one round at most.
    """
    now = stage(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = stage(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        after = stage(small.select("e.*").filter("a != b").distinct(), "edges")
        facts = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        same = now.agg(*facts).first() == after.agg(*facts).first()
        now = after
        if same:
            break
    tied = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tied.union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def similarity_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` with words: _k1, _k2, doc_id, class_id, copy_of, n_copies, n_links.

    ``class_id`` is the smallest doc_id of the connected group of similar texts, ``copy_of`` that of the texts
    with the same shingles, ``n_copies`` how many rows these are, ``n_links`` the number of different shingle sets
    whose similarity with this one is at least ``threshold``.
    """
    rows = stage(text_classes(docs, rows_per_band(threshold)), "classes")
    firsts = [F.min("doc_id").alias("copy_of"), F.min(F.struct("_k1", "_k2")).alias("_key"), F.count(F.lit(1)).alias("n_copies")]
    classes = stage(rows.groupBy("cls").agg(*firsts, F.max("bands").alias("bands"), F.max("signature").alias("signature")), "texts")
    cells = stage(components(likely_ties(classes, threshold)).withColumnRenamed("node", "cls"), "cells")
    sizes = cells.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = cells.join(sizes, "root").join(classes.select("cls", "_key.*"), "cls")
    texts = docs.select(*row_key(), text_of().alias("text"))
    held = members.join(texts, ["_k1", "_k2"]).groupBy("cls", "root", "size").agg(F.max("text").alias("text"))

    def compare(rows: list[tuple], alone: bool) -> list[tuple]:
        sets = shingle_sets([r[2] for r in rows])
        if alone:
            i, j = linked_pairs(sets, None, threshold)
        else:
            left, right = sides(rows)
            if not left or not right:
                return []
            i, j = linked_pairs([sets[k] for k in left], [sets[k] for k in right], threshold)
            i, j = np.array(left, np.int64)[i], np.array(right, np.int64)[j]
        links = np.bincount(np.concatenate([i, j]), minlength=len(rows))
        group = roots(len(rows), i, j)
        return [(rows[k][1], int(links[k]), rows[group[k]][1]) for k in np.flatnonzero(links).tolist()]

    pieces = in_pieces(held, "root", F.col("size"), CELL, "cls", "text")
    found = stage(pieces.mapInArrow(lambda batches: by_piece(batches, compare, ["cls", "links", "root"]), "cls long, links long, root long"), "links")
    links = found.groupBy("cls").agg(F.sum("links").alias("n_links"))
    groups = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    known = classes.select("cls", "copy_of", "n_copies").join(groups, "cls", "left").join(links, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    first = known.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    facts = known.join(first, "root").select("cls", "class_id", "copy_of", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows.select("_k1", "_k2", "doc_id", "cls").join(facts, "cls").drop("cls")


def marked(docs: DataFrame, threshold: float) -> DataFrame:
    """(row, _k1, _k2, class_id, copy_of, n_copies, n_links) with the columns of ``docs`` as the struct ``row``; NULLs where a text has no words."""
    facts = similarity_groups(docs, threshold).groupBy("_k1", "_k2").agg(*[F.min(c).alias(c) for c in ("class_id", "copy_of", "n_copies", "n_links")])
    return docs.select(F.struct("*").alias("row"), *row_key()).join(facts, ["_k1", "_k2"], "left")


def is_keeper() -> Column:
    return F.coalesce(F.col("class_id") == F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST_ID)), F.lit(True))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` plus class_id, copy_of, n_copies, n_links and ``keeper``.

    ``keeper`` marks the one row of a group that stays: the smallest doc_id's. Texts without words (NULL, empty, blank)
    are similar to nothing: groups of their own with no links. NULL ids come last and are shown as NULL; of
    repeated rows (same id and text) each gets the same values, and they are copies of each other. Columns of the
    result's names are replaced; an empty table gives an empty table.
    """
    kept = docs.drop("class_id", "copy_of", "n_copies", "n_links", "keeper")
    real = lambda c: F.when(F.col("class_id").isNull(), F.col("row.doc_id").cast("long")).otherwise(F.nullif(F.col(c), F.lit(LAST_ID)))
    return marked(kept, threshold).select(
        *[f"row.`{c}`" for c in kept.columns], real("class_id").alias("class_id"), real("copy_of").alias("copy_of"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        is_keeper().alias("keeper"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of similar texts: the one with the smallest doc_id, repeated rows once.

    Rows without words belong to no group: all of them stay, repeated or not.
    """
    keepers = marked(docs, threshold).filter(is_keeper()).withColumn("_own", F.monotonically_increasing_id())
    wordless = F.col("class_id").isNull()
    # A row without words has a key of its own; the others share theirs with equal rows only.
    keyed = keepers.withColumns({"_wordless": wordless, "_k1": F.when(wordless, F.col("_own")).otherwise(F.col("_k1")), "_k2": F.when(~wordless, F.col("_k2"))})
    return keyed.dropDuplicates(["_wordless", "_k1", "_k2"]).select(*[f"row.`{c}`" for c in docs.columns])


def op5_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "copy_of", "n_copies", "n_links")


QUERIES = {"op5_jaccard_join": op5_jaccard_join}
SQL: dict[str, str] = {}
