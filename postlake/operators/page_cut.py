"""Where a run's pagination ended.

A crawl reads pages 1, 2, … until a stop condition. Over landed pages this is a prefix per run. It is
computed with grouped minima only: no window collects a whole run in one task, however long it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAR = 2**31 - 1


@dataclass(frozen=True)
class CutRules:
    """Page conditions (over ``page_no`` and the page facts) and the run's last page.

    ``stop_before`` leaves its page out, ``stop_after`` keeps it and stops, ``fatal`` fails the run if
    the page is reached. ``last_page`` is an aggregate over the run's pages (NULL = unknown).
    """

    stop_before: Column
    stop_after: Column
    fatal: Column
    last_page: Column


def cut_runs(pages: DataFrame, keys: list[str], rules: CutRules, max_pages: int | None = None) -> DataFrame:
    """One row per run: ``last_kept`` page (0 = none) and ``failed_on`` page (NULL = fine).

    ``pages`` has one row per (run, ``page_no``).
    """
    flagged = pages.select(
        *keys, "page_no", rules.stop_before.alias("before"), rules.stop_after.alias("after"), rules.fatal.alias("fatal"),
        F.lit(True).alias("present"), *[c for c in pages.columns if c not in (*keys, "page_no")],
    )
    first_page = lambda flag: F.min(F.when(F.col(flag), F.col("page_no")))
    stops = flagged.groupBy(*keys).agg(
        first_page("before").alias("before"), first_page("after").alias("after"), first_page("fatal").alias("fatal"),
        rules.last_page.alias("last_page"),
    )
    runs = stops.join(first_gap(pages, keys), keys, "left")
    limit = F.lit(FAR if max_pages is None else max_pages)
    far = lambda name: F.coalesce(F.col(name), F.lit(FAR))
    reach = F.least(far("after"), far("last_page"), limit, far("gap") - 1)
    failed = F.when((F.col("fatal") <= reach) & (F.col("fatal") < far("before")), F.col("fatal"))
    return runs.select(
        *keys, F.greatest(F.least(reach, far("before") - 1), F.lit(0)).cast("int").alias("last_kept"), failed.alias("failed_on")
    )


def first_gap(pages: DataFrame, keys: list[str]) -> DataFrame:
    """First page number from 1 on that a run does not have.

    Every page vouches for itself and asks for the next one; grouping by page spreads a long run.
    """
    asked = pages.select(*keys, F.inline(F.array(
        F.struct(F.col("page_no").alias("page_no"), F.lit(True).alias("present")),
        F.struct((F.col("page_no") + 1).alias("page_no"), F.lit(False).alias("present")),
        F.struct(F.lit(1).alias("page_no"), F.lit(False).alias("present")),
    )))
    known = asked.filter("page_no >= 1").groupBy(*keys, "page_no").agg(F.bool_or("present").alias("present"))
    return known.filter(~F.col("present")).groupBy(*keys).agg(F.min("page_no").alias("gap"))


def keep_reached(rows: DataFrame, cuts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on the kept pages of runs that did not fail."""
    good = cuts.filter("failed_on IS NULL AND last_kept > 0").select(*keys, "last_kept")
    return rows.join(good, keys).filter("page_no <= last_kept").drop("last_kept")
