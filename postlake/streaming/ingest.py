"""Incremental ingest: new capture files to postings, each posting once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.dates import render_utc
from postlake.operators.recency import recent_only
from postlake.plans.boards import board, read_markup
from postlake.sources.captures import with_clock
from postlake.sources.schema import CAPTURE_DDL, JOB_COLS


def read_capture_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(CAPTURE_DDL).option("maxFilesPerTrigger", max_files).parquet(path)


def posting_stream(captures: DataFrame, source: str) -> DataFrame:
    """Recent postings of a capture stream; the fetch time of a capture is its clock.

    No watermark: files may come in any order, and a posting is recent by its own capture's clock, so no capture
    is ever too late. The state keeps one key per posting for good; it belongs in the RocksDB state store.
    """
    clocked = with_clock(captures, render_utc(F.col("fetched_at")))
    return first_seen_stream(recent_only(stream_listing(clocked, source)), ["source", "job_id"]).drop("markup", "fetched_at", "attempt")


def stream_listing(captures: DataFrame, source: str) -> DataFrame:
    rows = board(source).listing(captures)
    return read_markup(rows.filter(F.col("pos").isNotNull() & F.col("reject").isNull()), board(source))


def first_seen_stream(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, across all micro-batches."""
    return rows.dropDuplicates(keys)


def write_stream(postings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new postings by board; takes what is there and ends."""
    return (
        postings.select("source", "run_id", *JOB_COLS)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .partitionBy("source")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
