"""Spelling variants: words one edit apart, each led to its most frequent near word, by bidirectional FM-index search.

Method: the vocabulary is dealt into blocks, and each block's words, delimited, become an FM-index over the sorted
rotations of the text and of its reverse. A search scheme of two halves finds every word one edit away: one search
matches the first half exactly from the delimiter and extends to the right with one error, the other matches the second half
exactly and extends to the left. Both keep synchronised suffix-rank intervals of the text and of its reverse; the interval of a
whole delimited word lies among the delimiter's rows, which are in the order of the words.

Blocks: two words one edit apart share one half of either of them, so words are dealt by the halves that a word of
their length, one less or one more would look for. A half that many words share is split: its words into salted blocks, its
searches into chunks. A pair belongs to the first search if that can find it, so each is found once, and only counts and the best
near word leave a block, never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import table, text_of
from postlake.plans.staging import stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT, LEAD = 5, 3, 2
#: One run in so many loses a letter, told by its document and itself.
TYPO_RATE = 97
#: Distinct words a task counts before it sends them on, code points of a block, and searches that go on together.
HELD_WORDS, BLOCK_POINTS, BATCH = 500_000, 1 << 19, 8_192
STEP = 32
#: Where so many code points of an exact half are still to come and so few words are left, these are compared whole.
AHEAD, FEW = 32, 4


def runs_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """Runs of letters with A-Z lower-cased, one in ``TYPO_RATE`` without a letter, and how often; a NULL id is the empty text."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    # Lower-casing bytes leaves all but A-Z as it is.
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % TYPO_RATE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of ``min_length`` code points and ``min_count`` occurrences in all texts, with their number ``n``.

    Counted in the task first, so that a frequent word is one row of each task. A NULL text has no words; rows with NULL or repeated
    ids count like others; other columns are not read; an empty table has no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in runs_of(doc_id, text):
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield sent()
        yield sent()

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point tells the words apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


class Ranks:
    """Last column of a cyclic text's sorted rotations, with the ranks of its symbols."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        bits = max(1, (symbols - 1).bit_length())
        # As many symbols as a number takes are compared at once, then twice as many each time until no rotations tie.
        width = 62 // bits
        key = np.zeros(n, np.int64)
        for k in range(width):
            key = key << bits | np.roll(text, -k)
        rank = np.unique(key, return_inverse=True)[1]
        while rank.max() + 1 < n:
            rank = np.unique(rank * n + np.roll(rank, -width), return_inverse=True)[1]
            width *= 2
        last = np.empty(n, text.dtype)
        last[rank] = np.roll(text, 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        blocks = n // STEP + 1
        self.rows = np.zeros((blocks, STEP), text.dtype)
        self.rows.reshape(-1)[:n] = last
        counts = np.bincount(np.repeat(np.arange(blocks), STEP)[:n] * symbols + last, minlength=blocks * symbols).reshape(blocks, symbols)
        #: Symbols below c before each block, for every c.
        self.below = np.zeros((blocks, symbols + 1), np.int32)
        np.cumsum(np.cumsum(counts[:-1], axis=0), axis=1, out=self.below[1:, 1:])

    def rank(self, at: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the first ``at`` symbols are c, and how many are smaller."""
        block, rest = at // STEP, at % STEP
        smaller = self.below[block, c].astype(np.int64)
        equal = self.below[block, c + 1] - smaller
        row, ahead = self.rows[block], np.arange(STEP) < rest[:, None]
        c = c.astype(self.rows.dtype)[:, None]
        return equal + np.count_nonzero((row == c) & ahead, axis=1), smaller + np.count_nonzero((row < c) & ahead, axis=1)


class Index:
    """Bidirectional FM-index over the distinct ``words``, delimited by symbol 0; row i of the delimiter is word i of the sorted words."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        letters = sorted(set("".join(self.words)))
        self.symbols = len(letters) + 1
        #: Symbols of letters in code-point order; no word holds the last symbol, which stands for any other letter.
        self.symbol = {c: i for i, c in enumerate(letters, 1)}
        kind = np.uint8 if self.symbols < 255 else np.uint16 if self.symbols < 65_535 else np.uint32
        self.text = np.array([i for w in self.words for i in (0, *map(self.symbol.__getitem__, w))], kind)

    @cached_property
    def forward(self) -> Ranks:
        return Ranks(self.text, self.symbols)

    @cached_property
    def backward(self) -> Ranks:
        return Ranks(self.text[::-1], self.symbols)

    @cached_property
    def by_end(self) -> list[int]:
        """Numbers of the words in the order of the delimiter's rows of the reverse text."""
        return sorted(range(len(self.words)), key=lambda i: self.words[i][::-1])

    def candidates(self, low: int, size: int, from_left: bool) -> list[int]:
        """Words of an interval of the text opposite to the search: what has been met begins, or ends, with the delimiter."""
        return list(range(low, low + size)) if from_left else self.by_end[low : low + size]

    def extend(self, ranks: Ranks, own: np.ndarray, other: np.ndarray, size: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after one more symbol on the side of ``ranks``; ``other`` follows in the opposite text."""
        known = np.where(c < self.symbols, c, 0)
        equal, smaller = ranks.rank(own, known)
        equal_end, smaller_end = ranks.rank(own + size, known)
        return ranks.first[known] + equal, other + smaller_end - smaller, np.where(c < self.symbols, equal_end - equal, 0)

    def branches(self, ranks: Ranks, own: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol) of every letter that can follow each interval: read from a narrow one, tried on a wide one."""
        wide = np.flatnonzero(size > 2 * self.symbols)
        state = np.repeat(wide, self.symbols - 1)
        symbol = np.tile(np.arange(1, self.symbols), len(wide))
        narrow = np.flatnonzero(size <= 2 * self.symbols)
        owner = np.repeat(narrow, size[narrow])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size[narrow]) - size[narrow], size[narrow]) + own[owner]
        seen = np.unique(owner * self.symbols + ranks.rows.reshape(-1)[at])
        seen = seen[seen % self.symbols > 0]
        return np.concatenate([state, seen // self.symbols]), np.concatenate([symbol, seen % self.symbols])

    @staticmethod
    def shares_half(word: str, other: str, from_left: bool) -> bool:
        half = len(word) // 2
        return other.startswith(word[:half]) if from_left else other.endswith(word[half:])

    def near(self, words: list[str], from_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``words``, number of the index's word) of pairs one edit apart that one search finds, each once.

        From the left: the first half (rounded down) is equal and the error lies behind; else the second half is.
        """
        found = [self._near(words[i : i + BATCH], from_left) for i in range(0, len(words), BATCH)]
        parts = [(q + i * BATCH, w) for i, (q, w) in enumerate(found)]
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2

    def _near(self, words: list[str], from_left: bool) -> tuple[np.ndarray, np.ndarray]:
        ranks = self.backward if from_left else self.forward
        end = np.array([len(w) for w in words], np.int64)
        exact = end // 2 if from_left else end - end // 2
        # What a search meets, in its order, is one stretch of ``flat`` closed by the delimiter; a second one keeps the next symbol readable.
        get = self.symbol.get
        flat = np.array([i for w in words for i in (*(get(c, self.symbols) for c in (w if from_left else reversed(w))), 0, 0)], np.int64)
        start = np.cumsum(end + 2) - end - 2
        q, i = np.arange(len(words)), np.zeros(len(words), np.int64)
        own, other, size = i, i, np.full(len(words), len(self.words))
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        bad = [np.empty(0, np.int64)] * 5  # states that have met their error
        while len(q) or len(bad[0]):
            if len(bad[0]):
                bq, bi, bown, bother, bsize = bad
                c = flat[start[bq] + bi]
                bown, bother, bsize = self.extend(ranks, bown, bother, bsize, c)
                live = bsize > 0
                done = live & (bi == end[bq])
                hits.append((bq[done], (bother if from_left else bown)[done]))
                live &= ~done
                bad = [bq[live], bi[live] + 1, bown[live], bother[live], bsize[live]]
            if not len(q):
                continue
            # Long words with few left to be: compared here, not symbol by symbol.
            few = (size <= FEW) & (exact[q] - i >= AHEAD)
            if few.any():
                pairs = [(a, b) for a, low, n in zip(q[few].tolist(), other[few].tolist(), size[few].tolist()) for b in self.candidates(low, n, from_left)]
                found = [(a, b) for a, b in pairs if self.shares_half(words[a], self.words[b], from_left) and one_edit(words[a], self.words[b])]
                hits.append(tuple(np.array(x, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2)
                q, i, own, other, size = (x[~few] for x in (q, i, own, other, size))
                if not len(q):
                    continue
            # Where the exact half is behind, the error may come now.
            at = np.flatnonzero(i >= exact[q])
            c, following = flat[start[q[at]] + i[at]], flat[start[q[at]] + i[at] + 1]
            # A letter left out: of equal ones in a row, the last.
            out = at[(i[at] < end[q[at]]) & (c != following)]
            more = [[q[out], i[out] + 1, own[out], other[out], size[out]]]
            state, symbol = self.branches(ranks, own[at], size[at])
            from_ = at[state]
            own2, other2, size2 = self.extend(ranks, own[from_], other[from_], size[from_], symbol)
            # Another letter instead of the next one, or put in before it; before an equal one it would be put in behind.
            new = (size2 > 0) & (symbol != c[state])
            from_, own2, other2, size2 = from_[new], own2[new], other2[new], size2[new]
            inside = i[from_] < end[q[from_]]
            more.append([q[from_], i[from_], own2, other2, size2])
            more.append([x[inside] for x in (q[from_], i[from_] + 1, own2, other2, size2)])
            bad = [np.concatenate(x) for x in zip(bad, *more)]
            go = np.flatnonzero(i < end[q])
            c = flat[start[q[go]] + i[go]]
            own3, other3, size3 = self.extend(ranks, own[go], other[go], size[go], c)
            live = size3 > 0
            q, i, own, other, size = q[go][live], i[go][live] + 1, own3[live], other3[live], size3[live]
        return tuple(np.concatenate(x) for x in zip(*hits)) if hits else (np.empty(0, np.int64),) * 2


def searched(rows: pa.Table) -> pa.RecordBatch:
    """Of one block: per searching word how many near words it has there, and the most frequent, ties to the smallest."""
    from_left = rows.column("side")[0].as_py() == 0
    held = rows.filter(rows.column("held"))
    asking = rows.filter(pc.invert(rows.column("held")))
    # A word may be dealt to a block under two of its halves.
    facts = dict(zip(held.column("word").to_pylist(), zip(held.column("n").to_pylist(), held.column("salt").to_pylist())))
    words, salt, salts = (asking.column(c).to_pylist() for c in ("word", "salt", "salts"))
    names = ["word", "n_near", "best_n", "best"]
    if not facts or not words:
        empty = [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.string())]
        return pa.RecordBatch.from_arrays(empty, names)
    index = Index(list(facts))
    q, w = index.near(words, from_left)
    n, own_salt = (np.array(x, np.int64) for x in zip(*(facts[x] for x in index.words)))
    keep = own_salt[w] % np.array(salts, np.int64)[q] == np.array(salt, np.int64)[q]
    if not from_left:
        # The other search finds those whose first half is equal as well.
        keep &= np.array([not index.shares_half(words[a], index.words[b], True) for a, b in zip(q.tolist(), w.tolist())], bool)
    q, w = q[keep], w[keep]
    order = np.lexsort((w, -n[w], q))
    q, w = q[order], w[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(q)))
    columns = [[words[k] for k in q[first].tolist()], counts, n[w[first]], [index.words[k] for k in w[first].tolist()]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names)


def halves(length: Column, side: int) -> Column:
    """Code points of the half that a word of this length keeps equal: the first one, rounded down, or the second."""
    low = F.floor(length / 2).cast("int")
    return low if side == 0 else length - low


def dealt(words: DataFrame, block_points: int = BLOCK_POINTS) -> DataFrame:
    """Rows of blocks: words held there, and words that search there with the salt whose words they may take."""
    length = F.length("word")
    parts = []
    for side in (0, 1):
        cut = (lambda k: F.expr("word").substr(F.lit(1), k)) if side == 0 else (lambda k: F.expr("word").substr(F.length("word") - k + 1, k))
        # Words of this length, one less and one more may look for it; two of the three look for the same half.
        sizes = F.array_distinct(F.array(*[halves(F.greatest(length + d, F.lit(1)), side) for d in (-1, 0, 1)]))
        parts.append(words.select("word", "n", F.lit(side).alias("side"), F.lit(True).alias("held"), F.explode(sizes).alias("size")).withColumn("half", cut(F.col("size"))))
        parts.append(words.select("word", "n", F.lit(side).alias("side"), F.lit(False).alias("held"), halves(length, side).alias("size")).withColumn("half", cut(F.col("size"))))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).drop("size")
    points = lambda held: F.sum(F.when(F.col("held") == held, F.length("word") + 1).otherwise(0))
    pieces = lambda held: F.greatest(F.ceil(points(held) / block_points), F.lit(1)).cast("long")
    # At most a row for every ``block_points`` code points of all rows.
    large = rows.groupBy("side", "half").agg(pieces(True).alias("salts"), pieces(False).alias("chunks")).filter("salts > 1 OR chunks > 1")
    own = F.pmod(F.xxhash64("word"), F.lit(1 << 40))
    several = rows.join(large, ["side", "half"], "left").na.fill(1, ["salts", "chunks"]).withColumn("own", own)
    # A held word is in one salted block for every chunk of searches, a search in one chunk for every salted block.
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("held"), F.col("chunks")).otherwise(F.col("salts")) - 1))
    spread = several.withColumn("k", everywhere)
    salt = F.when(F.col("held"), F.col("own") % F.col("salts")).otherwise(F.col("k"))
    chunk = F.when(F.col("held"), F.col("k")).otherwise(F.col("own") % F.col("chunks"))
    total = words.agg(F.coalesce(F.sum(F.length("word") + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * total // block_points))
    block = F.pmod(F.xxhash64("half", salt, chunk), F.lit(blocks)) + F.col("side") * blocks
    return spread.select(block.alias("block"), "side", "held", "word", "n", F.when(F.col("held"), F.col("own")).otherwise(salt).alias("salt"), "salts")


def near_words(words: DataFrame, block_points: int = BLOCK_POINTS) -> DataFrame:
    """Of ``words`` (word, n; distinct): those with near words, how many, and the most frequent one with its number."""
    schema = "word string, n_near long, best_n long, best string"

    def run(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([searched(rows)])

    found = dealt(words, block_points).groupBy("block").applyInArrow(run, schema)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    ).select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of words with a form: the end of the chain of forms, of at most ``steps``, by doubling jumps."""
    jumps = stage(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max(0, steps - 1).bit_length()):
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = stage(jumps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if jumps.filter("moved").isEmpty():
            break
    return jumps.select("word", "root")


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, lead: int = LEAD, block_points: int = BLOCK_POINTS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of ``vocabulary``.

    Two words are near at exactly one inserted, deleted or replaced code point. ``form`` is the near word with the largest n, ties to the
    smallest in code-point order, if that n is ``lead`` times the word's own; ``root`` the last word along the forms, the
    word itself if it has none. NULL texts, odd ids, other columns and empty tables are as in ``vocabulary``.
    """
    if lead < 2:
        raise ValueError("lead must be at least 2, or chains of forms have no bound")
    words = stage(vocabulary(docs, min_length, min_count), "words")
    most = words.agg(F.max("n")).first()[0] or 1
    joined = words.join(near_words(words, block_points), "word", "left")
    has = F.col("best_n") >= lead * F.col("n")
    formed = stage(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    # n doubles at least from form to form, which bounds the chains.
    ends = roots(formed.filter("form IS NOT NULL"), most.bit_length())
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling_variants(spark, sf_dir):
    return group_variants(table(spark, sf_dir, "documents").select("doc_id", "text")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
SQL: dict[str, str] = {}
