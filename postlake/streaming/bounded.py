"""Incremental ingest in two steps over shared folders, with state that ends.

``land`` parses every new capture once and writes, batch by batch, the items, the rejects and the counts. ``first_postings``
reads the landed items and gives each posting once. A posting is remembered until no capture that is in time can show it as recent
any more; then a timer on event time clears it. Captures behind the watermark are told apart, never dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from postlake.functions.dates import RECENT_DAYS, is_recent, render_utc
from postlake.plans.boards import board, read_markup
from postlake.sources.captures import with_clock
from postlake.sources.schema import JOB_COLS, PAGE_KEYS, RUN_KEYS

#: How far behind the newest capture seen another one may be and still count as in time.
LATENESS = "7 days"
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ITEM_COLS = [*PAGE_KEYS, "pos", "outcome", "reject", *JOB_COLS, "posted_ts", "scraped_ts"]


def batch_folder(folder: str, kind: str, batch_id: int) -> str:
    return f"{folder}/{kind}/batch={batch_id:010d}"


def written(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing there."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def write_once(rows: DataFrame, path: str) -> None:
    """A batch that is run again finds its output and leaves it; one that was broken off is written over."""
    if not written(rows.sparkSession, path):
        rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)


def land_batch(items: DataFrame, batch_id: int, folder: str) -> None:
    """Write one micro-batch: its items, then from these the rejects and the counts by run, outcome and reason."""
    path = batch_folder(folder, "items", batch_id)
    write_once(items.select(*ITEM_COLS), path)
    landed = items.sparkSession.read.schema(items.select(*ITEM_COLS).schema).parquet(path)
    rejects = landed.filter("reject IS NOT NULL").select(*PAGE_KEYS, "pos", "job_id", "title", "company", "reject")
    write_once(rejects, batch_folder(folder, "rejects", batch_id))
    recent = F.col("pos").isNotNull() & F.col("reject").isNull() & is_recent(F.col("posted_ts"), F.col("scraped_ts"))
    counts = landed.groupBy(*RUN_KEYS, "outcome", "reject").agg(
        F.count("pos").alias("items"), F.count_if(F.col("pos").isNull()).alias("pages_without_items"), F.count_if(recent).alias("recent")
    )
    write_once(counts, batch_folder(folder, "counts", batch_id))


def land(captures: DataFrame, source: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Parse the captures of a stream once and write ``items``, ``rejects`` and ``counts`` below ``folder`` by batch.

    The fetch time of a capture is its clock; items of captures without one are rejects. The batch id is the key under which
    a batch is written, so a batch that runs again leaves one copy. Takes what is there and ends.
    """
    b = board(source)
    rows = read_markup(b.listing(with_clock(captures, render_utc(F.col("fetched_at")))), b)
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: land_batch(batch, batch_id, folder))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_landed(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Everything landed so far of a kind: ``items``, ``rejects`` or ``counts``."""
    return spark.read.parquet(f"{folder}/{kind}").drop("batch")


def item_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    schema = spark.read.parquet(f"{folder}/items").drop("batch").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{folder}/items/batch=*")


class Remember(StatefulProcessor):
    """One posting: when it may be forgotten. Gives its first row, and rows behind the watermark marked late.

    Most postings have one row a batch, so rows are read as they are: a pandas frame each would cost more than the state does.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        known = self.until.get()[0] if self.until.exists() else None
        first, until = None, known
        for row in rows:
            # What is remembered is no news, late or not; what is late may have been forgotten, so all of it is told.
            if row.seen_ms < watermark:
                if known is None:
                    yield self._told(row, late=True)
                continue
            until = max(until or 0, row.until_ms)
            if known is None and (first is None or self._place(row) < self._place(first)):
                first = row
        if first is not None:
            yield self._told(first, late=False)
        if until != known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.until.update((until,))
            self.handle.registerTimer(until)

    @staticmethod
    def _place(row: Row) -> list[tuple]:
        """Order of a posting's rows: by time, run and place on the page, NULLs last."""
        return [(True,) if v is None else (False, v) for v in (row.seen_ms, row.run_id, row.page_no, row.pos)]

    @staticmethod
    def _told(row: Row, late: bool) -> Row:
        return Row(**{name: value for name, value in row.asDict().items() if name not in ("seen_ms", "until_ms")}, late=late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.until.clear()
        yield from ()

    def close(self) -> None:
        pass


def first_postings(items: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Recent postings of an item stream, each with its first row, and ``late``.

    A posting stays in the state until the watermark (the newest fetch time less ``lateness``) is past its own recency: no capture
    in time can show it after that, unless it was posted anew, which is a new posting then. Rows behind the watermark that the
    state does not know come out with ``late`` set, every one of them: they may repeat a posting that is forgotten.
    """
    usable = items.filter(F.col("pos").isNotNull() & F.col("reject").isNull() & is_recent(F.col("posted_ts"), F.col("scraped_ts")))
    marked = usable.withWatermark("scraped_ts", lateness)
    columns = ["run_id", "page_no", "pos", *[c for c in JOB_COLS if c != "job_id"]]
    # The event time goes on as a number: the watermark is kept, but no row is taken out for being behind it.
    timed = marked.select(
        "source", "job_id", *columns, F.unix_millis("scraped_ts").alias("seen_ms"),
        # Both ends of the recent days are included.
        (F.unix_millis("posted_ts") + RECENT_DAYS * 86_400_000 + 1).alias("until_ms"),
    )
    kinds = dict(items.dtypes)
    schema = ", ".join(["source string, job_id string", *[f"{c} {kinds[c]}" for c in columns], "late boolean"])
    return timed.groupBy("source", "job_id").transformWithState(Remember(), outputStructType=schema, outputMode="Append", timeMode="EventTime")


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """A query takes its state store from the session when it starts; the caller's setting comes back."""
    key, value = PROVIDER
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_postings(postings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new postings below ``path``, those in time and the late ones in folders of their own; takes what is there and ends."""
    with _rocksdb(postings.sparkSession):
        return (
            postings.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("late").outputMode("append").trigger(availableNow=True).start()
        )


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("late", F.col("late").cast("boolean"))
