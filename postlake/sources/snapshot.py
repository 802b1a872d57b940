"""Dated snapshots of postings as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.dates import parse_iso, snapshot_stamp
from postlake.sources.schema import JOB_COLS, JOB_DDL

PARTS = ["source", "snapshot", "run_id"]
ORDER = ["page_no", "pos"]


def write_snapshot(jobs: DataFrame, path: str) -> None:
    """``<path>/source=<source>/snapshot=<UTC stamp>/run_id=<run>/``, all columns in order and after them the place on its page, NULL fields kept.

    A run owns its folder: writing the same run again replaces it, so a retried job leaves one copy, and no other
    run is touched. Postings stand in page order: ranges of it are dealt to the files, whose names
    are in order too, so a long run is spread over several and still reads as one list.
    """
    stamped = jobs.withColumn("snapshot", snapshot_stamp(parse_iso(F.col("scraped_at"))))
    # Folder names that cannot be NULL: for others the writer sorts by folder once more, which undoes the page order,
    # as it does where the columns of the order are not written or a folder name is a literal.
    stamped = stamped.withColumns({c: F.coalesce(c, F.lit("")) for c in PARTS})
    ordered = stamped.repartitionByRange(*PARTS, *ORDER).sortWithinPartitions(*PARTS, *ORDER)
    (
        ordered.select(*PARTS, *JOB_COLS, *ORDER)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*PARTS)
        .json(path)
    )


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{JOB_DDL}, page_no INT, pos INT, source STRING, snapshot STRING, run_id STRING").json(path)
