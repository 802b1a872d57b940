"""Best-fit packing of token ids into sequences of one size, planned over a histogram of lengths.

Method: documents are cut into pieces and counted by length. Best-fit decreasing runs over the counts, not the pieces: sequences with
the same room are one range of numbers, and a length fills as many of a range as it has pieces for. The plan maps
ranges of ranks within a length to sequences and places; each piece takes its slot by its rank. The plan has
a number of entries that depends on the size alone (see ``plan``), whatever the number of documents.

A rank is the piece's number among those of its length in its slice (the input of one task, written with it) plus the
count of that length in the slices before, so no task ever sees all pieces of a length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.bpe import TOKENIZER, tokenizer_path
from postlake.llm.common import table, text_of
from postlake.llm.token_files import tokens
from postlake.plans.staging import stage

SIZE, END_ID = 1024, 2
RANK_BITS = 50


@dataclass(frozen=True)
class Plan:
    """Slots by (length, rank): ``each`` pieces of a length go to one sequence after ``offset``, then the next sequence follows."""

    key: np.ndarray  # length << RANK_BITS | first rank, ascending
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def slots(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        at = np.searchsorted(self.key, (length << RANK_BITS) | rank, side="right") - 1
        row, column = np.divmod(rank - (self.key[at] & ((1 << RANK_BITS) - 1)), self.each[at])
        return self.sequence[at] + row, self.offset[at] + column * length


def plan(counts: dict[int, int], size: int) -> Plan:
    """Best-fit decreasing over the number of pieces of each length.

    Each length splits at most one range of sequences in three, so there are at most 3 ``size`` ranges; a filled range keeps
    less than half of its room, so it is filled at most log2(``size``) times. Both bound the entries.
    """
    open_: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by room: (first sequence, how many)
    entries: list[tuple[int, int, int, int]] = []
    used = 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        left, rank, room = counts[length], 0, length
        while left:
            while room < size and not open_[room]:
                room += 1
            if open_[room]:
                first, many = open_[room].pop()
            else:
                first, many = used, -(-left // (size // length))
                used += many
            # What a piece leaves in the tightest sequence is tighter still: a sequence is filled before the next is opened.
            each = room // length
            full = min(many, left // each)
            rest = min(left - full * each, each) if full < many else 0
            if full:
                entries.append(((length << RANK_BITS) | rank, first, each, size - room))
                open_[room - each * length].append((first, full))
            if rest:
                entries.append(((length << RANK_BITS) | rank + full * each, first + full, each, size - room))
                open_[room - rest * length].append((first + full, 1))
            if (over := many - full - (rest > 0)) > 0:
                open_[room].append((first + many - over, over))
            rank += full * each + rest
            left -= full * each + rest
    columns = np.array(sorted(entries), np.int64).reshape(-1, 4).T
    return Plan(*columns, used)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: all of ``size`` but the first, which may be shorter."""
    first = (n - 1) % size + 1
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Encoded pieces with their rank within (slice, length)."""
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "slice": pa.int64(), "rank": pa.int64()}
    types |= {"ids": pa.list_(pa.int32())} if keep_ids else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, number, seen = tokens(tokenizer), TaskContext.get().partitionId(), [0] * (size + 1)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([encoder.encode(text), end]).astype("<u4", copy=False)
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    own = ids[start : start + length]
                    row = (doc_id, k, start, length, zlib.crc32(own.tobytes()), number, seen[length])
                    rows.append((*row, own.astype("i4")) if keep_ids else row)
                    seen[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, slice long, rank long" + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start in its document, length, crc32 of its ids, sequence, offset, and with ``keep_ids`` the ids.

    Every document is encoded whole and ends with ``end_id``; only documents over ``size`` ids are cut. Sequences are filled
    without gaps from offset 0. NULL and empty texts are the end id alone; NULL ids and repeated rows are documents like
    others, each with slots of its own; other columns are not read; an empty table gives an empty table. Which of two pieces of one
    length gets which slot depends on how the input is dealt to tasks, the number of sequences does not.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    staged = stage(pieces(docs, tokenizer, size, end_id, keep_ids), "pieces")
    held = stage(staged.groupBy("slice", "length").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    histogram = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    planned = docs.sparkSession.sparkContext.broadcast(plan(histogram, size))  # bounded by ``size``
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("slice", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = staged.join(bases, ["slice", "length"]).withColumn("rank", F.col("rank") + F.col("base")).drop("slice", "base")
    own = [c for c in staged.columns if c not in ("slice", "rank")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = planned.value.slots(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(sequence), pa.array(offset)], [*own, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in staged.select(own).schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, their ids, and the doc_id of each piece in them in order."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return held.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def op12_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, tokenizer_path(TOKENIZER), keep_ids=False)


QUERIES = {"op12_best_fit_packing": op12_best_fit_packing}
SQL: dict[str, str] = {}
