"""First / last of a key by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key.

    The ``= 1`` filter on ``row_number`` makes Spark keep one row per key already before the
    shuffle, so a key that holds a large share of all rows sends one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def link_map(links: DataFrame, keys: Sequence[str], value: str, order: str, *, last: bool = False) -> DataFrame:
    """One value per key, the first (or last) by order; combined before the shuffle."""
    pick = F.max_by if last else F.min_by
    return links.groupBy(*keys).agg(pick(value, order).alias(value))
