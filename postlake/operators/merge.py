"""Filling gaps of one record from another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.first_seen import first_seen


def more_specific(current: Column, candidate: Column) -> Column:
    """The location to keep: the candidate if it adds detail (country only, or fewer commas before)."""
    commas = lambda c: F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))
    better = current.isNull() | (F.lower(current) == "indonesia") | (commas(candidate) > commas(current))
    return F.when(candidate.isNotNull() & better, candidate).otherwise(current)


def fill_tags(current: Column, candidate: Column) -> Column:
    return F.when(F.size(current) > 0, current).otherwise(F.coalesce(candidate, current))


def longer_tags(current: Column, candidate: Column, count: Column) -> Column:
    """The candidate if it has more entries (``count``) than the current list."""
    return F.when(F.coalesce(count, F.lit(0)) > F.size(current), candidate).otherwise(current)


def fold_first(df: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str) -> DataFrame:
    """One row per key with each field's first non-NULL value by order, and the first order; combined before the shuffle."""
    firsts = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    return df.groupBy(*keys).agg(*firsts, F.min(order).alias(order))


def merge_sources(
    primary: DataFrame, fallback: DataFrame, keys: Sequence[str], fields: Sequence[str], order: str = "pos"
) -> DataFrame:
    """Primary rows with gaps filled by key from the fallback, then fallback rows of unknown keys.

    ``is_fallback`` with the order column gives the row order. A repeated fallback key is folded
    first, so both sides stay unique per key and the join cannot grow on a hot key.
    """
    folded = fold_first(fallback, keys, fields, order)
    left, right = primary.alias("l"), folded.alias("r")
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    known = F.col(f"l.{keys[0]}").isNotNull()
    pick = lambda c: F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).alias(c)
    return left.join(right, on, "full_outer").select(
        *[pick(k) for k in keys], (~known).alias("is_fallback"), pick(order), *[pick(f) for f in fields]
    )


def with_details(jobs: DataFrame, details: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Left join of the earliest detail of each posting as a struct ``detail`` (NULL = none)."""
    single = first_seen(details, keys, ["fetched_at", F.xxhash64(*fields)])
    packed = single.select(*keys, F.struct(*fields).alias("detail"))
    return jobs.join(packed, list(keys), "left")


def detail_worklist(jobs: DataFrame, details: DataFrame, keys: Sequence[str], needs: Column) -> DataFrame:
    """Postings that need a detail page and have none."""
    return jobs.filter(needs).join(details.select(*keys).distinct(), list(keys), "left_anti")
