"""Exact top-k by integer inner product over a bit-sliced index.

Method: vectors become integers; per block of rows every attribute is kept as bit slices, one bitmap over the rows
per binary digit, the lowest ``DROPPED`` digits left out. For a query the slices are added up with
bitmap arithmetic (carry-save adders, query digits in non-adjacent form), which gives the slices of the
approximate score; the top rows are chosen from the most significant slice downward; the rows the
left-out digits leave in doubt are resolved with the exact product.

A block has about ``BLOCK_ROWS`` rows and is a file that workers memory-map. Queries are dealt with the number of a
block, about ``QUERY_ROWS`` of them at a time. Vectors with a component over 62 bits are no rows of slices: they
have blocks of their own, which are scored in Python integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import mounted, new_folder, publish, table
from postlake.plans.staging import stage

SCALE = 1024
DROPPED = 2
BLOCK_ROWS = 8_192
QUERY_ROWS = 128
TOP = 10
#: Scores have to be smaller, as their column is a long; components of sliced vectors, as differences of two are taken.
LARGEST, SLICED = 1 << 63, 1 << 62


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v, wide): usable vectors as integers floor(scale * x), or in ``wide`` as the numbers they were where one is over 62 bits.

    ``row`` numbers the rows: rows that repeat an id, or are equal, are rows like others. NULL ids, NULL vectors and vectors with a
    NULL or non-finite component take no part.
    """
    number = lambda x: x.cast("double")
    usable = F.forall("embedding", lambda x: F.coalesce(F.abs(number(x)) < float("inf"), F.lit(False)) & ~F.isnan(x))
    small = F.forall("embedding", lambda x: F.abs(F.lit(float(scale)) * number(x)) < float(SLICED))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
    whole = F.when(small, F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * number(x)).cast("long")))
    wide = F.when(~small, F.transform("embedding", number))
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), wide.alias("wide"))
    return stage(numbered, "quantised")


def whole_numbers(x: list[float], scale: int) -> list[int]:
    """floor(scale * x) of any finite numbers; a product that leaves the doubles has no fraction to lose."""
    return [math.floor(y) if math.isfinite(y := v * scale) else int(v) * scale for v in x]


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows with q: 64-bit where every sum fits, else Python integers."""
    if x.dtype == object or q.dtype == object:
        return x.astype(object) @ q.astype(object)
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if largest * sum(abs(v) for v in q.tolist()) < LARGEST:
        return x @ q
    return x.astype(object) @ q.astype(object)


def padded(vectors: list, width: int, kind: type = np.int64) -> np.ndarray:
    out = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def slices_of(x: np.ndarray, dropped: int) -> np.ndarray:
    """Bitmaps (attribute, digit, words of 64 rows) of x minus its smallest value per attribute, without low digits."""
    # Unsigned, as the difference of two 64-bit integers may need all 64 digits.
    y = (x.astype(np.uint64) - x.min(axis=0).astype(np.uint64)) >> np.uint64(dropped)
    digits = max(1, int(y.max()).bit_length())
    rows = -(-len(x) // 64) * 64
    bits = np.zeros((x.shape[1], digits, rows), np.uint8)
    for d in range(digits):
        bits[:, d, : len(x)] = ((y >> np.uint64(d)) & np.uint64(1)).T
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")


def signed_digits(q: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) of the non-adjacent form of q: the fewest digits."""
    out, place = [], 0
    while q:
        if q & 1:
            digit = 2 - (q & 3)
            out.append((place, digit))
            q -= digit
        q >>= 1
        place += 1
    return out


def add_slices(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of all bitmaps, ``columns[w]`` holding those of weight 2**w."""
    out, w = [], 0
    columns = [list(c) for c in columns]
    while w < len(columns):
        column = columns[w]
        while len(column) > 1:
            if w + 1 == len(columns):
                columns.append([])
            if len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                ab = a ^ b
                column.insert(0, ab ^ c)
                columns[w + 1].append((a & b) | (ab & c))
            else:
                a, b = column.pop(), column.pop()
                column.append(a ^ b)
                columns[w + 1].append(a & b)
        out.append(column[0] if column else None)
        w += 1
    return out


def score_slices(slices: np.ndarray, inverse: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Slices of sum(q_d * y_d) for all rows, up to a constant that makes all sums non-negative.

    A digit -1 adds the complement: -y = ~y + 1 - 2**digits, of which only the constant differs.
    """
    digits = slices.shape[1]
    columns: list[list[np.ndarray]] = []
    for d, value in enumerate(q.tolist()):
        for place, sign in signed_digits(value):
            while len(columns) < place + digits:
                columns.append([])
            source = slices if sign > 0 else inverse
            for j in range(digits):
                columns[place + j].append(source[d, j])
    return add_slices(columns)


def rows_from(slices: list[np.ndarray], least: int, valid: np.ndarray) -> np.ndarray:
    """Bitmap of the valid rows whose value is at least ``least``, from the highest slice down."""
    if least <= 0:
        return valid
    if least >> len(slices):
        return np.zeros_like(valid)
    above, equal = np.zeros_like(valid), valid.copy()
    for w in reversed(range(len(slices))):
        bits = slices[w]
        if least >> w & 1:
            equal = equal & bits if bits is not None else np.zeros_like(equal)
        elif bits is not None:
            above |= equal & bits
            equal = equal & ~bits
    return above | equal


def kth_value(slices: list[np.ndarray], k: int, valid: np.ndarray) -> int:
    """The k-th highest value among the valid rows, digit by digit from the most significant slice."""
    value, equal, wanted = 0, valid.copy(), k
    for w in reversed(range(len(slices))):
        if slices[w] is None:
            continue
        ones = equal & slices[w]
        n = int(np.bitwise_count(ones).sum())
        if n >= wanted:
            equal, value = ones, value | (1 << w)
        else:
            wanted -= n
            equal &= ~slices[w]
    return value


class Block:
    """One memory-mapped index file of a block of rows: numbers, ids, integers, slices; without slices the numbers before they were scaled."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n, width, digits, scale = raw[:32].view("<i8").tolist()
        at = 32
        self.rows = raw[at : (at := at + 8 * n)].view("<i8")
        self.ids = raw[at : (at := at + 8 * n)].view("<i8")
        if digits:
            self.x = raw[at : (at := at + 8 * n * width)].view("<i8").reshape(n, width)
            self.slices = np.array(raw[at:].view("<u8")).reshape(width, digits, -1)
            self.inverse = ~self.slices
        else:
            self.x = np.array([whole_numbers(v, scale) for v in raw[at:].view("<f8").reshape(n, width).tolist()], object).reshape(n, width)
            self.slices = None

    @staticmethod
    def file(rows: np.ndarray, ids: np.ndarray, x: np.ndarray, dropped: int, scale: int) -> bytes:
        slices = slices_of(x, dropped) if x.dtype.kind == "i" else None
        head = np.array([*x.shape, 0 if slices is None else slices.shape[1], scale], "<i8").tobytes()
        body = rows.astype("<i8").tobytes() + ids.astype("<i8").tobytes() + x.astype(f"<{x.dtype.kind}8").tobytes()
        return head + body + (b"" if slices is None else slices.tobytes())

    def top(self, q_row: int, q: np.ndarray, k: int, dropped: int) -> tuple[np.ndarray, list[int]]:
        """Places and exact scores of the best k rows, ties to the smaller id; the query's own row is left out."""
        valid = np.zeros(-(-len(self.ids) // 64) * 64, np.uint8)
        valid[: len(self.ids)] = self.rows != q_row
        chosen = np.flatnonzero(valid)
        if len(chosen) > k and self.slices is not None and q.dtype != object:
            bitmap = np.packbits(valid, bitorder="little").view("<u8")
            summed = score_slices(self.slices, self.inverse, q)
            # By the digits left out, two rows differ by at most this much more or less than their sums say.
            spread = ((1 << dropped) - 1) * sum(abs(v) for v in q.tolist())
            least = kth_value(summed, k, bitmap) - (-(-spread >> dropped))
            chosen = np.flatnonzero(np.unpackbits(rows_from(summed, least, bitmap).view(np.uint8), bitorder="little"))
        ids, exact = self.ids[chosen], exact_scores(self.x[chosen], q)
        if exact.dtype != object:
            order = np.lexsort((self.rows[chosen], ids, -exact))[:k]
        else:
            order = np.array(sorted(range(len(ids)), key=lambda i: (-exact[i], ids[i], self.rows[chosen[i]]))[:k], np.int64)
        return chosen[order], exact[order].tolist()


@lru_cache(maxsize=2)
def block(path: str) -> Block:
    return Block(path)


def build_index(vectors: DataFrame, n_blocks: int, n_wide: int, width: int, dropped: int, scale: int) -> DataFrame:
    """Write each block's file to the shared folder; one row per block: its number and path."""
    base = mounted(new_folder(vectors.sparkSession, "slices"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "row"])
        number = int(pdf["block"].iloc[0])
        path = f"{base}/block-{number:08d}.bsi"
        held, kind = (pdf["v"], np.int64) if number < n_blocks else (pdf["wide"], np.float64)
        publish(path, Block.file(pdf["row"].to_numpy("i8"), pdf["vec_id"].to_numpy("i8"), padded(held.tolist(), width, kind), dropped, scale))
        return pd.DataFrame({"block": [number], "path": [path]})

    sliced, wide = F.pmod(F.xxhash64("row"), F.lit(n_blocks)), n_blocks + F.pmod(F.xxhash64("row"), F.lit(max(1, n_wide)))
    blocks = vectors.withColumn("block", F.when(F.col("v").isNotNull(), sliced).otherwise(wide).cast("int"))
    return blocks.groupBy("block").applyInPandas(run, "block int, path string")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, dropped: int = DROPPED, block_rows: int = BLOCK_ROWS, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's best k of the other rows, ties to the smaller id.

    Both inputs are rows of one ``quantised`` table. Only the query's own row is left out: another row with its id is a
    candidate, and of repeated query ids each row has its own list. Fewer than k other rows: all of them. Shorter vectors
    count as padded with zeros. No usable vectors, or no queries: no rows. A returned score that leaves 64 bits raises an
    error, other scores may be of any size. Every row is in the index; every query meets every block.
    """
    counted = vectors.agg(F.count("v"), F.count("wide"), F.coalesce(F.max(F.greatest(F.size("v"), F.size("wide"))), F.lit(0))).first()
    n, wide, width = counted[0], counted[1], max(1, counted[2])
    n_blocks, n_wide = max(1, -(-n // block_rows)), -(-wide // block_rows)
    index = stage(build_index(vectors, n_blocks, n_wide, width, dropped, scale), "blocks")
    asked = stage(queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("wide").alias("q_wide")), "asked")
    per_block = max(1, -(-asked.count() // QUERY_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_row", "query_id", "row", "vec_id", "score", "fits"]
        for batch in batches:
            out: list[tuple] = []
            for path, query_row, query_id, v, raw in zip(*(c.to_pylist() for c in batch.columns)):
                found = block(path)
                q = padded([v], width, np.int64)[0] if raw is None else np.array((whole_numbers(raw, scale) + [0] * width)[:width], object)
                places, scores = found.top(query_row, q, k, dropped)
                for at, score in zip(places.tolist(), scores):
                    fits = -LARGEST <= score < LARGEST
                    out.append((query_row, query_id, int(found.rows[at]), int(found.ids[at]), score if fits else LARGEST - 1 if score > 0 else -LARGEST, fits))
            types = [*[pa.int64()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)

    spread = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks + n_wide - 1))))
    pieces = (
        spread.join(index, "block")
        .repartition(min((n_blocks + n_wide) * per_block, 8192), "block", F.pmod(F.xxhash64("query_row"), F.lit(per_block)))
        .sortWithinPartitions("block").select("path", "query_row", "query_id", "q", "q_wide")
    )
    best = pieces.mapInArrow(run, "query_row long, query_id long, row long, vec_id long, score long, fits boolean")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    # Only a score that would be returned has to fit.
    score = F.when(F.col("fits"), F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit 64 bits")).cast("long"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))


def op4_topk(spark, sf_dir):
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


SQL = {"op4_topk": """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
          FROM v q JOIN v c ON c.r <> q.r WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 10
"""}
QUERIES = {"op4_topk": op4_topk}
