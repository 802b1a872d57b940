from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from postlake.llm.bpe import TOKENIZER, Encoder, compile_lexicon, encode_decode, tokenizer_path, vocabulary
from postlake.llm.token_files import Reader, Writer, read_token_files, write_token_files
from postlake.llm.common import new_folder
from tests.llm.rows import N_ODD, ODD_TEXTS, documents, odd


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    t.no_truncation()
    t.no_padding()
    return t


TEXTS = [t or "" for t in ODD_TEXTS] + ["don't we'll 'S", "<|endoftext|>", "a <|endoftext|><|endoftext|> b<|endoftext", "  lead  and trail  ", "12345 6,7", "　wide blank line\x85", "𝒜𝓁𝓅𝒽𝒶 ١٢٣", " the the the of of", "\x00\x1c\x1f control", "z" * 500 + " " * 500]


def test_same_ids_as_the_library(library):
    path = tokenizer_path(TOKENIZER)
    enc = Encoder(path, None)
    rnd = random.Random(1)
    mixed = ["".join(rnd.choice("abc  éß日\n\t'1 !<|") for _ in range(rnd.randrange(60))) for _ in range(400)]
    for t in TEXTS + mixed:
        want = library.encode(t, add_special_tokens=False).ids
        assert enc.encode(t) == want, t[:40]
        assert enc.decode(want) == library.decode(want, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    from postlake.llm.bpe import Lexicon

    words = [b"walk", b"walking", b"walked", b"talk", b"talking", b"talked", b" t", "é".encode(), b"a", b"ab"]
    want = {w: list(range(i, i + 1 + i % 3)) for i, w in enumerate(words)}
    (tmp_path / "f").write_bytes(compile_lexicon(want))
    lex = Lexicon(str(tmp_path / "f"))
    assert {w: lex.find(w).tolist() for w in words} == want
    assert all(lex.find(w) is None for w in (b"", b"wal", b"walks", b"zz", b"talkin", b"walkeds", b"\xc3"))
    # walk- and talk- share one tail: the states of one of them are not stored again
    (tmp_path / "g").write_bytes(compile_lexicon({w: [1] for w in words if b"talk" not in w}))
    assert lex.states - Lexicon(str(tmp_path / "g")).states <= 1


def test_query_rows(spark, library):
    got = sorted(encode_decode(documents(spark, TEXTS), tokenizer_path(TOKENIZER)).collect(), key=lambda r: r.doc_id)
    for r, t in zip(got, TEXTS):
        ids = library.encode(t, add_special_tokens=False).ids
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert len(encode_decode(odd(spark, "ids"), tokenizer_path(TOKENIZER)).collect()) == N_ODD
    assert encode_decode(documents(spark, []), tokenizer_path(TOKENIZER)).count() == 0


def test_long_words_merge_alike():
    v = vocabulary(tokenizer_path(TOKENIZER))
    rnd = random.Random(2)
    for n in (49, 200, 1000):
        word = bytes(rnd.choice(b"abcaaet") for _ in range(n))
        parts = [v.byte_id[b] for b in word]
        assert v._merge_long(list(parts)) == _plain(v, parts)


def _plain(v, parts):
    while True:
        found = [(v.merges[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in v.merges]
        if not found:
            return parts
        (_, new), i = min(found)
        parts = [*parts[:i], new, *parts[i + 2 :]]


def test_token_files(spark, library, tmp_path):
    import zlib

    import numpy as np

    docs = documents(spark, list(reversed(TEXTS)), more=[(None, "no id", None, None, None), (2, TEXTS[-3], None, None, None)])
    files = write_token_files(docs, tokenizer_path(TOKENIZER), new_folder(spark, "t"))
    got = read_token_files(files).collect()
    rows = sorted(((-1 if r.doc_id is None else r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got)
    assert len(rows) == docs.count() and [r[1] for r in rows] == [sum(x[2] for x in rows[:k]) for k in range(len(rows))]
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (None, 2)}
    for i, _, n, crc in rows:
        if i in text:
            ids = np.array([*library.encode(text[i] or "", add_special_tokens=False).ids, 0], "<u4")
            assert (n, crc) == (len(ids), zlib.crc32(ids.tobytes()))
    some = read_token_files(write_token_files(docs, tokenizer_path(TOKENIZER), new_folder(spark, "t")), wanted=[3, 5]).collect()
    assert {r.doc_id for r in some} == {3, 5} and {tuple(r) for r in some} <= {tuple(r) for r in got}
    empty = write_token_files(documents(spark, []), tokenizer_path(TOKENIZER), new_folder(spark, "t"))
    assert read_token_files(empty).count() == 0


def test_frames_are_checked(tmp_path):
    import numpy as np

    w = Writer()
    docs = [np.arange(n, dtype="u4") for n in (3, 70_000, 0, 5, 80_000, 1)]
    for i, d in enumerate(docs):
        w.add(d, i if i else None)
    data = w.close()
    path = tmp_path / "f"
    path.write_bytes(data)
    with Reader(str(path)) as r:
        assert r.doc_ids == [None, 1, 2, 3, 4, 5]
        assert len(r.frames) == 3 and all((r.document(i) == d).all() for i, d in enumerate(docs))
        assert all((a == b).all() for a, b in zip(r.documents(), docs))
    broken = bytearray(data)
    broken[10] ^= 1
    path.write_bytes(bytes(broken))
    with Reader(str(path)) as r:
        assert len(r.document(5)) == 1  # other frames are still whole
        with pytest.raises(ValueError):
            r.document(0)
