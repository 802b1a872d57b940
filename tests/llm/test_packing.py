from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from postlake.llm.bpe import TOKENIZER, tokenizer_path
from postlake.llm.packing import pack, plan, sequences
from tests.llm.rows import N_ODD, documents, odd


def best_fit(lengths, size):
    """Number of sequences of best-fit decreasing, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


def test_plan_is_best_fit_piece_by_piece():
    rng = random.Random(7)
    for size in (1, 7, 64, 100):
        for _ in range(60):
            weights = [rng.random() ** 3 for _ in range(size)]
            lengths = rng.choices(range(1, size + 1), weights, k=rng.choice([0, 1, 5, 300]))
            counts = Counter(lengths)
            p = plan(counts, size)
            assert p.n_sequences == best_fit(lengths, size)
            held = defaultdict(list)
            for n, c in counts.items():
                for s, o in zip(*p.slots(np.full(c, n), np.arange(c))):
                    held[s].append((int(o), n))
            assert len(held) == p.n_sequences
            for slots in held.values():
                at = 0
                for o, n in sorted(slots):
                    assert o == at
                    at += n
                assert at <= size


def test_plan_does_not_grow_with_the_documents():
    rng = random.Random(8)
    for scale in (1, 10**3, 10**9):
        p = plan({n: rng.randrange(scale + 1) for n in range(1, 1025)}, 1024)
        assert len(p.key) <= 3 * 1024 * 11


def checked(spark, docs, size, end_id=2):
    """Rows of the operator, held against the library's ids."""
    library = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    library.no_truncation()
    library.no_padding()
    rows = pack(docs, tokenizer_path(TOKENIZER), size, end_id).collect()
    want = Counter()
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, end_id]
        first = len(ids) % size or size
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), size)], [first, *range(first + size, len(ids) + 1, size)])):
            want[r.doc_id, k, a, tuple(ids[a:b]), zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids), r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids)
        held[r.sequence_id].append((r.offset, r.length))
    for slots in held.values():
        ends = np.cumsum([n for _, n in sorted(slots)]).tolist()
        assert [o for o, _ in sorted(slots)] == [0, *ends[:-1]] and ends[-1] <= size
    assert len(held) == best_fit([r.length for r in rows], size)
    return rows


@pytest.mark.parametrize("size", [1, 16, 1024])
def test_odd_rows(spark, size):
    for extra in (None, "rank", "length"):
        rows = checked(spark, odd(spark, extra), size)
        assert sum(r.piece == 0 for r in rows) == N_ODD


def test_dealt_over_many_tasks(spark):
    rng = random.Random(9)
    texts = ["same text for many"] * 200 + [" ".join("abc de fghi j".split()[rng.randrange(4)] for _ in range(rng.randrange(90))) for _ in range(200)]
    docs = documents(spark, texts)
    assert len(checked(spark, docs.repartition(13), 32)) == len(checked(spark, docs.coalesce(1), 32))


def test_empty_table(spark):
    assert pack(documents(spark, []), tokenizer_path(TOKENIZER)).collect() == []


def test_sequences_hold_the_pieces(spark):
    packed = pack(documents(spark, ["one two three", None, "x y " * 30]), tokenizer_path(TOKENIZER), 16)
    rows = {r.sequence_id: r for r in sequences(packed).collect()}
    for r in packed.collect():
        assert rows[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids


def test_registered(spark):
    df = entry.queries()["op12_best_fit_packing"](spark, "/root/testdata/sf0.01")
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = df.collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    lengths = [r.length for r in rows]
    n = len({r.sequence_id for r in rows})
    assert n == best_fit(lengths, 1024)
    # No packing can do with fewer than all ids need.
    assert n <= 1.005 * -(-sum(lengths) // 1024)
