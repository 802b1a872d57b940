"""Token-id files: independent zstandard frames, a trailing seek table, a checksum per frame.

File: frames of 32-bit little-endian ids, then one zstandard-compressed seek table, then a fixed trailer. A frame holds
whole documents, up to about ``FRAME_TOKENS`` ids. The seek table has per frame its place, compressed size, crc32
of the compressed bytes and number of documents, and per document its number of ids and its doc_id. A reader takes trailer and
table, then decompresses only the frames of the documents asked for.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.bpe import TOKENIZER, tokenizer_path
from postlake.llm.common import mounted, new_folder, publish, table, text_of

FRAME_TOKENS = 65_536
END_ID = 0
MAGIC = b"PLTK0001"
#: Stands for a NULL doc_id in the seek table.
NO_ID = -(1 << 63)
TRAILER = struct.Struct("<QQI8s")
#: Rows of the range shuffle in one file, about.
FILE_ROWS = 8_192


class Writer:
    """One token file in memory until ``close``; documents are added in order."""

    def __init__(self):
        self.body, self.waiting, self.n_waiting = bytearray(), [], 0
        self.frames: list[tuple[int, int, int, int]] = []
        self.counts: list[int] = []
        self.doc_ids: list[int] = []
        self.zip = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, ids: np.ndarray, doc_id: int | None) -> None:
        self.waiting.append(ids)
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids))
        self.n_waiting += len(ids)
        if self.n_waiting >= FRAME_TOKENS:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            frame = self.zip.compress(np.concatenate(self.waiting).astype("<u4").tobytes())
            self.frames.append((len(self.body), len(frame), zlib.crc32(frame), len(self.waiting)))
            self.body += frame
            self.waiting, self.n_waiting = [], 0

    def close(self) -> bytes:
        self._flush()
        table = self.zip.compress(b"".join(np.array(c, "<i8").tobytes() for c in (self.frames, self.counts, self.doc_ids)))
        return bytes(self.body) + table + TRAILER.pack(len(self.frames), len(table), zlib.crc32(table), MAGIC)


class Reader:
    """Random access to the documents of one token file."""

    def __init__(self, path: str):
        self.file = open(path, "rb")
        self.unzip = zstandard.ZstdDecompressor()
        self.file.seek(-TRAILER.size, os.SEEK_END)
        n_frames, size, crc, magic = TRAILER.unpack(self.file.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.file.seek(-TRAILER.size - size, os.SEEK_END)
        raw = np.frombuffer(self._checked(self.file.read(size), crc, "seek table"), "<i8")
        self.frames = raw[: 4 * n_frames].reshape(-1, 4)
        self.counts, ids = raw[4 * n_frames :].reshape(2, -1)
        self.doc_ids = [None if i == NO_ID else i for i in ids.tolist()]
        self.first_doc = np.concatenate([[0], np.cumsum(self.frames[:, 3])]).astype("i8")
        self.held, self.held_ids = -1, np.empty(0, "<u4")

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def __len__(self) -> int:
        return len(self.counts)

    def _checked(self, data: bytes, crc: int, what: str) -> bytes:
        if zlib.crc32(data) != crc:
            raise ValueError(f"checksum of the {what} differs")
        return self.unzip.decompress(data)

    def frame(self, k: int) -> np.ndarray:
        """Ids of one frame; the last frame stays decompressed."""
        if k != self.held:
            place, size, crc, _ = (int(x) for x in self.frames[k])
            self.file.seek(place)
            self.held, self.held_ids = k, np.frombuffer(self._checked(self.file.read(size), crc, f"frame {k}"), "<u4")
        return self.held_ids

    def document(self, i: int) -> np.ndarray:
        k = bisect_right(self.first_doc, i) - 1
        low = int(self.first_doc[k])
        start = int(self.counts[low:i].sum())
        return self.frame(k)[start : start + int(self.counts[i])]

    def documents(self) -> Iterator[np.ndarray]:
        for k in range(len(self.frames)):
            ids, at = self.frame(k), 0
            for n in self.counts[self.first_doc[k] : self.first_doc[k + 1]].tolist():
                yield ids[at : at + n]
                at += n


class Tokens:
    """Ids of texts as the tokenizers library gives them, by a faster encoder over the same merges.

    A text the fast one cannot take (its pattern gives up on some very long runs) goes to the library itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        from postlake.llm.bpe import WORD, vocabulary

        v = vocabulary(path)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {v.bytes_of[i]: i for i in spec["model"]["vocab"].values()}
        self.path, self.library = path, None
        self.fast = tiktoken.Encoding("own", pat_str=WORD, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except Exception as error:  # its failures have no class of their own
            if isinstance(error, (MemoryError, TypeError)):
                raise
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
                self.library.no_truncation()
                self.library.no_padding()
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "u4")


@lru_cache(maxsize=1)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode whole texts and write them in ascending ``doc_id`` order; one row per file: its place, first number, documents, ids.

    Rows are dealt by ranges of (doc_id, hash of the text), so that a repeated id cannot fill one file. NULL ids come
    first; NULL texts count as empty and hold the end id alone; repeated rows are written as often as they are
    there; other columns are not read; an empty table writes no file. File names are places of the range order: a repeated task replaces its own file.
    """
    base = mounted(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, enc = Writer(), tokens(tokenizer)
        total = 0
        end = np.array([end_id], "<u4")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.concatenate([enc.encode(text), end])
                total += len(found)
                out.add(found, doc_id)
        n = len(out.counts)
        if n:
            part = TaskContext.get().partitionId()
            path = f"{base}/tokens-{part:08d}.plt"
            publish(path, out.close())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([path]), pa.array([n], pa.int64()), pa.array([total], pa.int64())], ["part", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    n_files = max(1, -(-rows.count() // FILE_ROWS))
    ordered = rows.repartitionByRange(n_files, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return ordered.mapInArrow(run, "part long, path string, n_docs long, n_ids long")


def read_token_files(files: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """Documents of the files: doc_id, start among all ids, number of ids, crc32 of the ids; ``wanted`` reads only the frames with these.

    ``files`` are the rows of ``write_token_files``, with one row per file; their running total is taken on the
    driver, all else where the files are read.
    """
    spark = files.sparkSession
    rows = sorted((tuple(r) for r in files.collect()), key=lambda r: r[0])
    starts = np.cumsum([0, *(r[3] for r in rows)]).tolist()
    only = None if wanted is None else set(wanted)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame([(r[1], s) for r, s in zip(rows, starts)], "path string, start long").repartition(len(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with Reader(path) as reader:
                    ids, counts = reader.doc_ids, reader.counts
                    at = start + np.concatenate([[0], np.cumsum(counts)])[:-1]
                    if only is None:
                        chosen, crcs = range(len(ids)), [zlib.crc32(d) for d in reader.documents()]
                    else:
                        chosen = [i for i, d in enumerate(ids) if d in only]
                        crcs = [zlib.crc32(reader.document(i)) for i in chosen]
                    arrays = [pa.array([ids[i] for i in chosen], pa.int64()), pa.array(at[list(chosen)], pa.int64()), pa.array(counts[list(chosen)], pa.int64()), pa.array(crcs, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(run, schema)


def op7_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = write_token_files(docs, tokenizer_path(TOKENIZER), new_folder(spark, "tokens"))
    return read_token_files(files)


QUERIES = {"op7_token_files": op7_token_files}
SQL: dict[str, str] = {}
