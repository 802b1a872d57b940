"""Capture table scan and what every board does with it first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.dates import parse_iso
from postlake.sources.schema import CAPTURE_DDL, DETAIL_KINDS, JOB_KEYS, LISTING_COLS, LISTING_KINDS


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Captures laid out by ``source`` and ``run_id``; filters on both prune directories."""
    return spark.read.format(fmt).schema(CAPTURE_DDL).load(path)


def write_captures(captures: DataFrame, path: str) -> None:
    """Append captures by source and run.

    The rows of a run are brought together first, or every task would leave a file in the folder of every run it has a page of.
    A run too large for one task is split where adaptive execution sees it.
    """
    captures.hint("rebalance", F.col("source"), F.col("run_id")).write.mode("append").partitionBy("source", "run_id").parquet(path)


def save_captures(captures: DataFrame, name: str, buckets: int) -> None:
    """Write a catalog table dealt into buckets by posting and sorted in them.

    What looks for the detail captures of some postings shuffles these to the buckets; the bodies stay where they are.
    """
    captures.write.format("parquet").bucketBy(buckets, *JOB_KEYS).sortBy(*JOB_KEYS).saveAsTable(name)


def with_clock(captures: DataFrame, scraped_at: str | Column) -> DataFrame:
    """Add the run's clock (one ISO text for all, or a column the crawler wrote per run) and what tells attempts at a page apart."""
    text = F.lit(scraped_at) if isinstance(scraped_at, str) else scraped_at
    attempt = F.xxhash64("status_code", "error", "fetched_at", "body", "body_text")
    return captures.withColumns({"scraped_at": text, "scraped_ts": parse_iso(text), "attempt": attempt})


def listing_pages(captures: DataFrame, source: str) -> DataFrame:
    return captures.filter((F.col("source") == source) & F.col("kind").isin(*LISTING_KINDS))


def detail_pages(captures: DataFrame, source: str) -> DataFrame:
    """Detail captures that came back; a failed one counts as absent."""
    return captures.filter(
        (F.col("source") == source)
        & F.col("kind").isin(*DETAIL_KINDS)
        & F.col("body").isNotNull()
        & F.col("error").isNull()
        & (F.coalesce(F.col("status_code"), F.lit(200)) < 400)
    )


def lost() -> Column:
    """No body came back: unreadable on every board."""
    return F.col("error").isNotNull() | F.col("body").isNull()


def fetch_outcome(*, http: bool = True) -> Column:
    """``rejected`` (HTTP 400), ``failed``, or NULL when there is a body to read.

    Pages taken with a browser (``http=False``) are read whatever their status was.
    """
    if not http:
        return F.when(lost(), "failed")
    return F.when(F.col("status_code") == 400, "rejected").when(lost() | (F.col("status_code") > 400), "failed")


def explode_items(pages: DataFrame, items: Column) -> DataFrame:
    """One row per item, plus one row for a page without items so its facts survive."""
    spread = pages.select("*", F.posexplode_outer(items).alias("pos", "item"))
    return spread.drop("body", "body_text")


def finish_listing(rows: DataFrame) -> DataFrame:
    """Common shape; a rejected item keeps its reason and no required field is dropped silently."""
    given = {"markup": F.col("markup") if "markup" in rows.columns else F.lit(None).cast("string")}
    # Without a clock nothing is recent, and without a page number no page rule can speak for the item.
    reject = F.coalesce(
        F.col("reject"), F.when(F.col("scraped_ts").isNull(), "missing scraped_at"), F.when(F.col("page_no").isNull(), "missing page_no")
    )
    return rows.withColumns({**given, "reject": F.when(F.col("pos").isNotNull(), reject)}).select(*LISTING_COLS)


def required(**columns: Column) -> Column:
    """Name of the first missing required field, or NULL."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit("")) == "", F.lit(f"missing {name}")) for name, c in columns.items()])
