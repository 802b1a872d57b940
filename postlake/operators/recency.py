"""Recency filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.functions.dates import is_recent


def recent_only(df: DataFrame, posted: str = "posted_ts", scraped: str = "scraped_ts") -> DataFrame:
    return df.filter(is_recent(F.col(posted), F.col(scraped)))
