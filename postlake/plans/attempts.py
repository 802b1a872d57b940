"""Several captures of one page: which of them is parsed, chosen on narrow facts.

A page's attempts are counted by its key, without the bodies. Pages with one attempt, nearly all, are parsed as they are. Of the
others the earliest attempt that came back is parsed, and only where that turns out unreadable are the rest. Items are never
shuffled to choose between attempts; bodies are, only of pages that were captured again and only where these are
too many for Spark to send their keys around.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.plans.boards import Board
from postlake.plans.staging import stage
from postlake.sources.captures import listing_pages, lost
from postlake.sources.schema import PAGE_KEYS

PAGE_ATTEMPT = [*PAGE_KEYS, "attempt"]


def listed(captures: DataFrame, b: Board, work_folder: str | None = None) -> DataFrame:
    """Staged items of one capture per page: the earliest readable one, or the earliest if none is; equal captures count once.

    Captures without a page number have no page to be attempts of: all of them are parsed.
    """
    own = listing_pages(captures, b.name)
    pages = own.filter("page_no IS NOT NULL").groupBy(*PAGE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    again = stage(pages.filter("n > 1").select(*PAGE_KEYS), f"{b.name}-pages-again", work_folder)
    if again.isEmpty():
        return stage(b.listing(own), b.name, work_folder)
    several = own.join(again, PAGE_KEYS, "left_semi")
    best = several.groupBy(*PAGE_KEYS).agg(F.min(F.struct(lost().alias("lost"), *_age())).alias("best"))
    best = stage(best.select(*PAGE_KEYS, F.col("best.attempt").alias("attempt")), f"{b.name}-first-attempts", work_folder)
    alone = own.join(again, PAGE_KEYS, "left_anti")
    first = stage(b.listing(alone.unionByName(_picked(several, best))), b.name, work_folder)
    # One row of a page has its outcome.
    unread = first.filter("outcome <> 'ok'").select(*PAGE_KEYS).distinct().join(again, PAGE_KEYS, "left_semi")
    unread = stage(unread, f"{b.name}-unread", work_folder)
    if unread.isEmpty():
        return first
    others = several.join(unread, PAGE_KEYS, "left_semi").join(best, PAGE_ATTEMPT, "left_anti").dropDuplicates(PAGE_ATTEMPT)
    second = stage(b.listing(others), f"{b.name}-other-attempts", work_folder)
    tried = second.unionByName(first.join(unread, PAGE_KEYS, "left_semi"))
    ranked = tried.groupBy(*PAGE_KEYS).agg(F.min(F.struct((F.col("outcome") != "ok").alias("unreadable"), *_age())).alias("best"))
    chosen = ranked.select(*PAGE_KEYS, F.col("best.attempt").alias("attempt"))
    rest = first.join(unread, PAGE_KEYS, "left_anti")
    return stage(rest.unionByName(tried.join(chosen, PAGE_ATTEMPT, "left_semi")), f"{b.name}-chosen", work_folder)


def _age() -> list[Column]:
    """Order of attempts: by fetch time, those without one last."""
    return [F.col("fetched_at").isNull().alias("undated"), F.col("fetched_at"), F.col("attempt")]


def _picked(captures: DataFrame, attempts: DataFrame) -> DataFrame:
    return captures.join(attempts, PAGE_ATTEMPT, "left_semi").dropDuplicates(PAGE_ATTEMPT)
