"""BPE encoding and decoding with a lexicon of frequent words in a minimal acyclic transducer.

Method: Spark counts the pieces of all texts; the frequent words become a minimal acyclic automaton whose shared
suffixes are stored once and whose paths count words, so that a word's path gives its number and with it its
ids. Workers memory-map the automaton; a word not in it is merged exactly. Words are independent
in a byte-level BPE, so the ids of a text are those of its words in order.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import mounted, new_folder, publish, table, text_of
from postlake.plans.staging import stage

TOKENIZER = "byte_bpe_50k.json"
LEXICON_WORDS = 50_000
#: A piece is counted where a slice of the texts has it this often; a rarer one is no frequent word.
SLICE_COUNT = 4
SLICE_WORDS = 300_000
CACHED_WORDS = 400_000
#: Words up to this length are merged by plain scans, longer ones with a heap.
SCAN_BYTES = 48
NO_MERGE = 2**31 - 1
#: Texts are split and looked up together up to about so many characters.
BATCH_CHARS = 1 << 20

# Fixed value: the split that the byte-level tokenizers apply before the merges.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


class Vocabulary:
    """Byte ids, merges and the bytes of every id, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        value = {c: b for b, c in enumerate(letters)}
        self.byte_id = [ids[c] for c in letters]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        # The same merges for many words at once: pair keys in order, with rank and result of each, and a last row for no merge.
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array([r for r, _ in self.merges.values()], np.int32)[order], NO_MERGE)
        self.rank_ids = np.array([i for _, i in self.merges.values()], np.int32)
        self.byte_ids = np.array(self.byte_id, np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(value[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.split = regex.compile(WORD).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: always the pair of lowest rank, leftmost first."""
        parts = [self.byte_id[b] for b in word]
        if len(parts) > SCAN_BYTES:
            return self._merge_long(parts)
        ranked = self.merges.get
        while len(parts) > 1:
            found = min((m for m in map(ranked, zip(parts, parts[1:])) if m), default=None)
            if found is None:
                break
            rank, new = found
            out, i, last = [], 0, len(parts) - 1
            while i <= last:
                pair = ranked((parts[i], parts[i + 1])) if i < last else None
                if pair and pair[0] == rank:
                    out.append(new)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_MERGE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as 32-bit numbers: ``merge`` on all words of about one length together, one merge a step."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        low = 0
        for high in (4, 8, 12, 16, 24, 32, SCAN_BYTES):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if len(chosen):
                ids, n = self._merge_rows([words[i] for i in chosen], sizes[chosen], high)
                for i, row, k in zip(chosen.tolist(), ids, n.tolist()):
                    out[i] = row[:k].tobytes()
        for i in np.flatnonzero(sizes > SCAN_BYTES).tolist():
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        return out

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        raw = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)
        places = np.arange(width)
        ids = np.where(places < sizes[:, None], self.byte_ids[raw], 0)
        ranks = np.full((len(words), width), NO_MERGE, np.int32)
        inner = places[1:] < sizes[:, None]
        ranks[:, :-1][inner] = self.ranks(ids[:, :-1][inner], ids[:, 1:][inner])
        n, done_ids, live = sizes.copy(), np.zeros((len(words), width), "<u4"), np.arange(len(words))
        while True:
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(live)), best]
            going = rank != NO_MERGE
            done_ids[live[~going]] = ids[~going]
            if not going.any():
                return done_ids, n
            live, ids, ranks, best, rank = live[going], ids[going], ranks[going], best[going], rank[going]
            rows = np.arange(len(live))
            # The pair becomes one id, and what stands to its right moves up.
            from_ = np.minimum(places + (places > best[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, from_, 1), np.take_along_axis(ranks, from_, 1)
            ids[rows, best] = self.rank_ids[rank]
            n[live] -= 1
            ranks[rows, n[live] - 1] = NO_MERGE
            for at in (best - 1, best):
                some = (at >= 0) & (at + 1 < n[live])
                ranks[rows[some], at[some]] = self.ranks(ids[rows[some], at[some]], ids[rows[some], at[some] + 1])

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before, ranked = [*range(1, n), -1], [*range(-1, n - 1)], self.merges.get
        queue = [(m[0], i, a, b, m[1]) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (m := ranked((a, b)))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = new, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (m := ranked((parts[left], parts[right]))):
                    heapq.heappush(queue, (m[0], left, parts[left], parts[right], m[1]))
        return [p for p in parts if p >= 0]


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic automaton of the words and the ids of each word in sorted order, as one file.

    Words come in sorted; a suffix that a later word cannot extend any more is replaced by an equal one
    if there is one. Per arc, ``skip`` counts the words that sort before those through it.
    """
    order = sorted(w for w in words if w)
    known: dict[tuple, int] = {}
    done: list[tuple] = []  # (is_word, arcs, words below) of finished states
    path: list[list] = [[False, []]]

    def finish(depth: int) -> None:
        while len(path) > depth + 1:
            is_word, arcs = path.pop()
            key = (is_word, tuple(arcs))
            state = known.get(key)
            if state is None:
                state = known[key] = len(done)
                done.append((*key, is_word + sum(done[t][2] for _, t in arcs)))
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    last = b""
    for word in order:
        same = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        finish(same)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    finish(0)
    states = [*done, (path[0][0], tuple(path[0][1]), 0)]
    first, labels, targets, skips = [0], bytearray(), [], []
    for is_word, arcs, _ in states:
        before = int(is_word)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            skips.append(before)
            before += done[target][2]
        first.append(len(targets))
    ids = [words[w] for w in order]
    starts = np.cumsum([0, *map(len, ids)])
    columns = [first, targets, skips, [int(s[0]) for s in states], starts, [i for w in ids for i in w]]
    arrays = [np.asarray(c, "<u4").tobytes() for c in columns]
    head = np.asarray([len(a) // 4 for a in arrays] + [len(labels), max(map(len, order), default=1)], "<u4").tobytes()
    return head + b"".join(arrays) + bytes(labels)


class Lexicon:
    """A memory-mapped transducer file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        *sizes, n_labels, longest = np.frombuffer(self.map, "<u4", 8).tolist()
        whole = memoryview(self.map)
        views, at = [], 32
        for size in sizes:
            views.append(whole[at : at + 4 * size].cast("I"))
            at += 4 * size
        first, target, skip, is_word, self.starts, self.ids = views
        self.root = len(first) - 2
        self.targets, self.skips, self.word = (np.frombuffer(v, "<u4").astype(np.int64) for v in (target, skip, is_word))
        # States stand in order and so do the arcs of each: (state, byte) is a sorted key.
        labels = np.frombuffer(whole[at : at + n_labels], np.uint8).astype(np.int64)
        self.states = len(first) - 1
        self.arcs = np.repeat(np.arange(self.states), np.diff(np.frombuffer(first, "<u4").astype(np.int64))) * 256 + labels
        self.longest = int(longest)

    def find(self, word: bytes) -> memoryview | None:
        number = int(self.numbers([word])[0])
        return None if number < 0 else self.ids[self.starts[number] : self.starts[number + 1]]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those not in it: all words take one arc a step."""
        out = np.full(len(words), -1)
        sizes = np.array([len(w) for w in words], np.int64)
        live = np.flatnonzero((sizes > 0) & (sizes <= self.longest))
        if not len(live):
            return out
        raw = np.array([words[i] for i in live], f"S{self.longest}").view(np.uint8).reshape(len(live), self.longest)
        row, state, number = np.arange(len(live)), np.full(len(live), self.root), np.zeros(len(live), np.int64)
        for at in range(self.longest):
            ended = sizes[live[row]] == at
            real = ended & (self.word[state] > 0)
            out[live[row[real]]] = number[real]
            row, state, number = row[~ended], state[~ended], number[~ended]
            if not len(row):
                return out
            keys = state * 256 + raw[row, at]
            arc = np.minimum(np.searchsorted(self.arcs, keys), len(self.arcs) - 1)
            hit = self.arcs[arc] == keys
            row, arc = row[hit], arc[hit]
            state, number = self.targets[arc], number[hit] + self.skips[arc]
        real = self.word[state] > 0
        out[live[row[real]]] = number[real]
        return out


@lru_cache(maxsize=2)
def lexicon(path: str) -> Lexicon:
    return Lexicon(path)


class Encoder(dict):
    """Words to their ids as bytes: from the lexicon, else merged. Holds the words met last, for speed only."""

    def __init__(self, tokenizer: str, lexicon_path: str | None):
        self.vocabulary = vocabulary(tokenizer)
        self.lexicon = lexicon(lexicon_path) if lexicon_path else None
        self.merged = 0

    def learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        number = self.lexicon.numbers(raw) if self.lexicon else np.full(len(raw), -1)
        new = np.flatnonzero(number < 0).tolist()
        self.merged += len(new)
        for i, ids in zip(new, self.vocabulary.merge_many([raw[i] for i in new])):
            self[words[i]] = ids
        if self.lexicon:
            starts, ids = self.lexicon.starts, self.lexicon.ids
            for i in np.flatnonzero(number >= 0).tolist():
                k = int(number[i])
                self[words[i]] = ids[starts[k] : starts[k + 1]].tobytes()

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; special-token strings in it get their ids."""
        v = self.vocabulary
        cut: list[list[str]] = []
        for text in texts:
            if v.specials and any(s in text for s in v.special):
                parts = v.specials.split(text)
                # Every second part is a special token; a word cannot be one, as it would have been split off.
                cut.append([w for i, p in enumerate(parts) for w in ([p] if i % 2 else v.split(p))])
            else:
                cut.append(v.split(text))
        if len(self) > CACHED_WORDS:
            self.clear()
        for special, i in v.special.items():
            self[special] = np.array([i], "<u4").tobytes()
        self.learn(list(set().union(*cut) - self.keys()))
        out = [memoryview(b"".join(map(self.__getitem__, words))).cast("I").tolist() for words in cut]
        if len(self) > 2 * CACHED_WORDS or any(len(t) > BATCH_CHARS for t in texts):
            self.clear()  # a very long text may have had very many or very long words
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(tokenizer: str, lexicon_path: str | None) -> Encoder:
    return Encoder(tokenizer, lexicon_path)


def every_ids(enc: Encoder, texts: pa.Array) -> Iterator[list[int]]:
    """Ids of each text of a column; NULL has none. Texts are taken together up to ``BATCH_CHARS``."""
    waiting: list[str] = []
    size = 0
    for text in texts:
        waiting.append(text.as_py() or "")
        size += len(waiting[-1])
        if size >= BATCH_CHARS:
            yield from enc.encode_many(waiting)
            waiting, size = [], 0
    if waiting:
        yield from enc.encode_many(waiting)


def frequent_words(docs: DataFrame, tokenizer: str, limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all texts: a bounded list, for the driver to compile."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def frequent() -> pa.RecordBatch:
            rows = [(w, n) for w, n in seen.items() if n >= SLICE_COUNT and len(w) <= 64]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["piece", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(text.split(" "))
                if len(seen) > SLICE_WORDS:
                    yield frequent()
        yield frequent()

    counts = docs.select(text_of().alias("text")).mapInArrow(pieces, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = stage(counts, "pieces")
    # The count that leaves at most ``limit`` pieces, from a histogram of a few hundred steps: no sort, and no more than that reach the driver.
    step = F.floor(F.log2("n") * 16).cast("int")
    held, least = 0, None
    for size, n in sorted(((r.size, r.n) for r in counts.groupBy(step.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        held += n
        if held > limit and least is not None:
            break
        least = size
    top = counts.filter(step >= (0 if least is None else least)).orderBy(F.desc("n"), "piece").limit(limit).collect()
    split = vocabulary(tokenizer).split
    words: Counter[str] = Counter()
    for piece, n in top:
        for word in split(" " + piece):
            words[word] += n
    return [w for w, _ in words.most_common(limit)]


def build_lexicon(docs: DataFrame, tokenizer: str, limit: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of ``docs`` into a file of the shared folder; its path for the workers."""
    merge = vocabulary(tokenizer).merge
    words = {w.encode(): merge(w.encode()) for w in frequent_words(docs, tokenizer, limit)}
    path = f"{mounted(new_folder(docs.sparkSession, 'lexicon'))}/words.fst"
    publish(path, compile_lexicon(words))
    return path


def encode_decode(docs: DataFrame, tokenizer: str, lexicon_path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """All columns of ``docs`` plus ``ids`` (unless ``keep_ids`` is off), ``n_tokens``, the sha256 of ids and decoded text.

    Encodes special-token strings as their ids, adds none, truncates nothing. NULL texts count as empty and
    have no ids; a NULL doc_id or repeated rows are rows like any others; columns of the result's names
    are replaced; an empty table gives an empty table. Results do not depend on the lexicon.
    """
    own = ["ids"] * keep_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = docs.drop("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    kinds = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    at = kept.columns.index("text")
    path = lexicon_path or build_lexicon(docs, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, path)
        decimal = enc.vocabulary.decimal.__getitem__
        for batch in batches:
            out: dict[str, list] = {name: [] for name in own}
            for ids in every_ids(enc, batch.column(at)):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
                if keep_ids:
                    out["ids"].append(ids)
            made = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(out[n], made[n]) for n in own)], [*batch.schema.names, *own])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"{n} {kinds[n]}" for n in own]
    return kept.mapInArrow(run, ", ".join(fields))


def op3_bpe_encoding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_decode(docs, tokenizer_path(TOKENIZER), keep_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES = {"op3_bpe_encoding": op3_bpe_encoding}
SQL: dict[str, str] = {}
