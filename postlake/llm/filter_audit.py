"""Filter interaction audit: what each of five filters removes under every order, and its Shapley share.

Method: every document becomes the set of filters it fails; per part the documents that each of the 32 coalitions of
filters removes are tabulated in Spark. A filter's Shapley value is the exact solution of the least squares over the
coalitions, weighted by the Shapley kernel and constrained to efficiency (the values add up to what all filters remove):
its normal equations are solved in rationals. What a step of an order removes is a difference of two coalitions.

Texts are read once, to a narrow row each; copies are counted before they meet, and a part needs one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import LAST_ID, table, text_of
from postlake.plans.staging import stage

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
REPEATED = 1 << FILTERS.index("E")
BLANKS = " \t\n\x0b\x0c\r"
#: Thresholds of the filters: least words, least share of distinct words, most share of capitals, marks that rule a text out.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, MARKS = 50, 65, 5, "[#$%&*|]"
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    fails = [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < MIN_DISTINCT * F.size(words).cast("long"),
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > MAX_CAPITALS * F.length(text).cast("long"),
        text.rlike(MARKS),
    ]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def kernel(n: int, coalition: int) -> Fraction:
    """Weight of a coalition of some, not all, of n players."""
    size = coalition.bit_count()
    return Fraction(n - 1, comb(n, size) * size * (n - size))


@lru_cache(maxsize=4)
def normal_matrix(n: int) -> list[list[Fraction]]:
    """Left side of the normal equations of n players, bordered by the efficiency constraint."""
    sets = range(1, (1 << n) - 1)
    rows = [[sum((kernel(n, s) for s in sets if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    return [*rows, [Fraction(1)] * n + [Fraction(0)]]


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Gauss-Jordan elimination in rationals."""
    rows = [[*row, value] for row, value in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(len(rows)):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k])]
    return [row[-1] for row in rows]


def shapley(value: list[int]) -> list[Fraction]:
    """Shapley values of the game whose coalition with the bits s is worth ``value[s]``."""
    n = (len(value) - 1).bit_length()
    if n == 1:
        return [Fraction(value[1] - value[0])]
    sets = range(1, len(value) - 1)
    right = [sum((kernel(n, s) * (value[s] - value[0]) for s in sets if s >> i & 1), Fraction(0)) for i in range(n)]
    return solved(normal_matrix(n), [*right, Fraction(value[-1] - value[0])])[:n]


def steps_of(part: str, total: int, removed: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """The rows of one part: every order, every step."""
    shares = [int(x * factorial(len(FILTERS))) for x in shapley(removed)]
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            gone = removed[after] - removed[before]
            yield (
                part, name, step, total - removed[after], gone, removed[1 << i] - gone, removed[ALL] - removed[ALL ^ 1 << i],
                good[after] - good[before], toxic[after] - toxic[before], shares[i],
            )
            before = after


def coalitions(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Per part: documents, and per coalition of filters the documents, the good and the toxic ones that it removes (32 numbers each).

    Copies of a text are told by 128 bits of it. They are counted by id first, so neither a text nor an id that holds a
    large share of the rows meets in one task before it has become a few numbers.
    """
    text = text_of()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).select("id", "part", own_failures(F.col("text")).alias("fails"), F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    rows = rows.groupBy("id", "part", "fails", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    is_one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    known = rows.join(marked, "id", "left").na.fill(False, ["good", "toxic"])
    place = F.coalesce("id", F.lit(LAST_ID))
    texts = known.groupBy("h1", "h2", "part", "fails", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(place).alias("least"), F.min_by("n", place).alias("n_least")
    )
    texts = stage(texts, "audit-texts")
    firsts = texts.groupBy("h1", "h2").agg(F.min("least").alias("first"))
    alone = F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = texts.join(firsts, ["h1", "h2"]).withColumn("alone", alone)
    counted = split.groupBy("part", "fails", "good", "toxic").agg(F.sum("alone").alias("alone"), (F.sum("n") - F.sum("alone")).alias("again"))
    both = F.array(F.struct(F.col("fails"), F.col("alone").alias("n")), F.struct((F.col("fails") + REPEATED).alias("fails"), F.col("again").alias("n")))
    cells = counted.select("part", "good", "toxic", F.inline(both))
    return cells.groupBy("part").agg(
        F.sum("n").alias("total"),
        removals(F.lit(True)).alias("removed"),
        removals(F.col("good")).alias("good"),
        removals(F.col("toxic")).alias("toxic"),
    )


def removals(of: Column) -> Column:
    hit = lambda s: F.when(of & (F.col("fails").bitwiseAND(s) != 0), F.col("n")).otherwise(0)
    return F.array(*[F.sum(hit(s)) for s in range(ALL + 1)])


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, as ``SCHEMA`` has it; ``part`` names the column of ``docs`` to split by.

    A NULL text counts as empty: it fails A alone, and E beside other empty texts. Rows with one id are one place in
    the order of ids: copies under the same id don't make each other fail E. NULL ids come after all others and have no
    labels. A document with several labels is good, or toxic, if any of them says so. A NULL part is the empty one.
    Other columns are not read; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                columns = list(zip(*steps_of(*row)))
                types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in SCHEMA.split(", ")])

    return coalitions(docs, labels, part).mapInArrow(run, SCHEMA)


def op13_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit_filters(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


#: Every step counted from the documents' own sets of failures, and the Shapley share summed over the orders.
AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, range(1, 6) r(step)),
seen AS (
  SELECT s.*, c.*, contains(fails, own) AS hit, len(regexp_replace(fails, '[^' || earlier || '_]', '', 'g')) > 0 AS gone FROM steps s, cells c),
counted AS (
  SELECT part, filter_order, step, own,
    CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE gone AND hit), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE fails = own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (WHERE NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

QUERIES = {"op13_filter_audit": op13_filter_audit}
SQL = {"op13_filter_audit": AUDIT_SQL}
