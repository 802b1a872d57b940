"""Line dedup: lines found in several documents stay only in the first of them.

Method: explode the normalised lines, hash them, count distinct documents per hash, drop the lines over the
threshold, reassemble by position. All of it is DataFrame work; a hot line is pre-aggregated before
the shuffle, and the join back to it is one adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import LAST_ID, ascii_lower, row_key, table, text_of

BLANKS = " \t\n\x0b\x0c\r"
MIN_DOCS = 2
MIN_CHARS = 10


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text`` reduced to the kept lines, plus ``n_lines`` (before) and ``n_dropped``.

    A line whose key has ``min_chars`` code points and is in ``min_docs`` documents is dropped everywhere but in
    the document with the smallest ``doc_id``, which keeps all its copies. A NULL text counts as empty, one
    empty line. All rows with NULL ids are one document, the last. Rows with the same id are one document. Columns named
    ``n_lines`` or ``n_dropped`` are replaced, all others are kept. An empty table gives an empty table.
    """
    rows = docs.drop("n_lines", "n_dropped").withColumns({"text": text_of()})
    # The caller's columns go along as one struct, so that no name of theirs meets one used here.
    keyed = rows.select(F.struct("*").alias("row"), *row_key())
    lines = (
        keyed.select("_k1", "_k2", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"), F.posexplode(F.split("row.text", "\n", -1)).alias("_pos", "_line"))
        .withColumn("_line", line_key(F.col("_line")))
        .filter(F.length("_line") >= min_chars)
        .select("_k1", "_k2", "_id", "_pos", F.xxhash64(F.lit(1), "_line").alias("_h1"), F.xxhash64(F.lit(2), "_line").alias("_h2"))
    )
    if min_docs == 2:
        # Two distinct ids are there exactly if the smallest and the largest differ: no distinct count is needed.
        spread = lines.groupBy("_h1", "_h2").agg(F.min("_id").alias("_keeper"), F.max("_id").alias("_last")).filter("_keeper < _last")
    else:
        held = lines.groupBy("_h1", "_h2", "_id").agg(F.lit(1).alias("_one"))
        spread = held.groupBy("_h1", "_h2").agg(F.min("_id").alias("_keeper"), F.count(F.lit(1)).alias("_docs")).filter(F.col("_docs") >= min_docs)
    dropped = (
        lines.join(spread.select("_h1", "_h2", "_keeper"), ["_h1", "_h2"])
        .filter("_id != _keeper")
        .groupBy("_k1", "_k2")
        .agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    )
    joined = keyed.join(dropped, ["_k1", "_k2"], "left").withColumn("_all", F.split("row.text", "\n", -1))
    return joined.select(
        *[kept_text().alias("text") if c == "text" else F.col(f"row.`{c}`") for c in rows.columns],
        F.size("_all").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def kept_text() -> Column:
    """The runs of lines between dropped positions, joined: linear in the lines of a document."""
    count = F.size("_gone")
    after = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("_gone", i - 1) + 1)
    before = lambda i: F.when(i == count, F.size("_all")).otherwise(F.get("_gone", i))
    runs = F.transform(F.sequence(F.lit(0), count), lambda i: F.slice(F.col("_all"), after(i) + 1, before(i) - after(i)))
    return F.when(F.col("_gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.flatten(runs), "\n"))


def op8_line_dedup(spark, sf_dir):
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Kept lines of ``{docs}``; used by the query's twin and by the pipeline's.
KEPT_SQL = f"""
  SELECT r.doc_id, any_value(r.n) AS n_lines, count(*) FILTER (WHERE g.h IS NOT NULL AND g.keeper <> r.doc_id) AS n_dropped,
    coalesce(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (WHERE g.h IS NULL OR g.keeper = r.doc_id), '') AS kept
  FROM (SELECT *, translate(trim(line, {_BLANKS_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h
        FROM (SELECT doc_id, len(ls) AS n, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {{docs}}))) r
  LEFT JOIN (
    SELECT h, min(doc_id) AS keeper FROM (
      SELECT doc_id, translate(trim(line, {_BLANKS_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {{docs}}))
    WHERE length(h) >= 10 GROUP BY h HAVING count(DISTINCT doc_id) >= 2) g ON g.h = r.h
  GROUP BY r.doc_id
"""

QUERIES = {"op8_line_dedup": op8_line_dedup}
SQL = {"op8_line_dedup": f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({KEPT_SQL.format(docs='documents')})"}
