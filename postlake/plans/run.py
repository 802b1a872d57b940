"""Captures in, clean postings out."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.dates import ISO_SHAPE, is_recent
from postlake.operators.first_seen import first_seen
from postlake.operators.merge import detail_worklist, with_details
from postlake.operators.page_cut import cut_runs, keep_reached
from postlake.plans.attempts import listed
from postlake.plans.boards import BOARDS, DEFAULT_BOARD, Board, board, read_markup
from postlake.plans.staging import stage
from postlake.sources.captures import with_clock
from postlake.sources.schema import DETAIL_FIELDS, JOB_COLS, JOB_KEYS, PAGE_FACTS, PAGE_KEYS, RUN_KEYS


@dataclass(frozen=True)
class RunResult:
    """DataFrames of one board's runs; all read the same staged rows."""

    jobs: DataFrame
    pages: DataFrame
    runs: DataFrame
    rejects: DataFrame
    worklist: DataFrame


def normalize(captures: DataFrame, source: str, scraped_at: str | Column) -> DataFrame:
    """Every listing item of a board in the common shape, unfiltered, with its reject reason."""
    _check_clock(scraped_at)
    b = board(source)
    return read_markup(b.listing(with_clock(captures, scraped_at)), b).drop("markup", "fetched_at", "attempt")


def run(
    captures: DataFrame,
    source: str = DEFAULT_BOARD,
    *,
    scraped_at: str | Column,
    max_pages: int | None = 1,
    fetch_details: bool = False,
    work_folder: str | None = None,
    detail_options: dict | None = None,
) -> RunResult:
    """Postings of a board's runs: recent, on the pages the crawl reached, first seen, enriched.

    ``scraped_at`` is the runs' clock: an ISO text, or a column the crawler wrote per run; items without one go to
    ``rejects``, as do those of captures without page number. Of several captures of one page the earliest readable one counts.
    Intermediate tables go to ``work_folder`` (default: ``staging.shared_folder``), for the caller to remove. ``detail_options`` goes to
    the board's reader of detail pages, such as ``stops``, the lines that end a section at ``karirhub``.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be at least 1")
    _check_clock(scraped_at)
    b = board(source)
    clocked = with_clock(captures, scraped_at)
    # A page past the limit can only matter as absent, so it is not even parsed.
    within = clocked if max_pages is None else clocked.filter(F.coalesce(F.col("page_no") <= max_pages, F.lit(True)))
    staged = listed(within, b, work_folder)
    usable = staged.filter(F.col("pos").isNotNull() & F.col("reject").isNull() & is_recent(F.col("posted_ts"), F.col("scraped_ts")))

    pages = page_facts(staged, usable, b)
    cuts = cut_runs(pages, RUN_KEYS, b.rules(max_pages), max_pages)
    # The first row of a posting is on its earliest page and the cut keeps a prefix, so the order of the
    # two does not matter for the result. It does for the shuffle: rows laid out by run for a large cut
    # table would otherwise also serve the first-seen step, with a hot run in one task.
    first = first_seen(usable, JOB_KEYS, ["page_no", "pos"]) if b.dedupes else usable
    kept = read_markup(keep_reached(first, cuts, RUN_KEYS), b)
    jobs, worklist = enrich(kept, clocked, b, fetch_details, work_folder, detail_options)
    return RunResult(
        jobs=jobs,
        pages=pages.join(cuts, RUN_KEYS).withColumn("kept", F.col("failed_on").isNull() & (F.col("page_no") <= F.col("last_kept"))),
        runs=run_report(first, cuts),
        rejects=staged.filter("reject IS NOT NULL").select(*PAGE_KEYS, "pos", "job_id", "title", "company", "reject"),
        worklist=worklist,
    )


def page_facts(staged: DataFrame, usable: DataFrame, b: Board) -> DataFrame:
    """One row per page: its facts, its recent postings, and those first seen on it."""
    recent = F.col("pos").isNotNull() & F.col("reject").isNull() & is_recent(F.col("posted_ts"), F.col("scraped_ts"))
    # The facts are equal on all rows of a page: as keys they stay in a hash aggregate.
    pages = staged.groupBy(*PAGE_KEYS, *PAGE_FACTS).agg(
        F.count("pos").alias("items"), F.count_if(recent).alias("recent_jobs")
    )
    if not b.dedupes:
        return pages.withColumn("new_jobs", F.col("recent_jobs"))
    firsts = usable.groupBy(*JOB_KEYS).agg(F.min("page_no").alias("page_no"))
    new = firsts.groupBy(*PAGE_KEYS).agg(F.count(F.lit(1)).alias("new_jobs"))
    return pages.join(new, PAGE_KEYS, "left").withColumn("new_jobs", F.coalesce("new_jobs", F.lit(0)))


def enrich(jobs: DataFrame, captures: DataFrame, b: Board, with_text: bool, work_folder: str | None = None, options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Postings with what their detail pages add, and those whose detail page is still to be taken."""
    order = [*RUN_KEYS, "page_no", "pos"]
    needs = b.needs(with_text)
    if b.details is None or needs is None:
        # Nothing to add: the detail captures are not even read.
        return jobs.select(*order, *JOB_COLS), jobs.filter(F.lit(False)).select(*JOB_KEYS, "url")
    # Only pages of postings that need them are parsed, and once for both uses below; the flag is read back, as a
    # filter here would parse twice.
    wanted = captures.join(jobs.filter(needs).select(*JOB_KEYS).distinct(), JOB_KEYS, "left_semi")
    details = stage(b.details(wanted, **(options or {})), f"{b.name}-details", work_folder).filter("usable")
    worklist = detail_worklist(jobs, details, JOB_KEYS, needs).select(*JOB_KEYS, "url")
    joined = with_details(jobs, details, JOB_KEYS, DETAIL_FIELDS)
    apply = needs & F.col("detail").isNotNull()
    merged = {
        name: F.when(apply, value).otherwise(F.col(name)) for name, value in b.merge(F.col("detail"), with_text).items()
    }
    return joined.select(*order, *[merged.get(c, F.col(c)).alias(c) for c in JOB_COLS]), worklist


def run_report(first: DataFrame, cuts: DataFrame) -> DataFrame:
    """Postings per run, with the last page read or the page that failed the run.

    Counted by page before the cut is joined, so that a long run is spread and only its page counts meet.
    """
    pages = first.groupBy(*PAGE_KEYS).agg(F.count(F.lit(1)).alias("jobs"))
    counts = keep_reached(pages, cuts, RUN_KEYS).groupBy(*RUN_KEYS).agg(F.sum("jobs").alias("jobs"))
    return cuts.join(counts, RUN_KEYS, "left").withColumn("jobs", F.coalesce("jobs", F.lit(0)))


def run_all(captures: DataFrame, sources: Iterable[str] = tuple(BOARDS), **options) -> DataFrame:
    """Postings of several boards as one table."""
    parts = [run(captures, source, **options).jobs for source in sources]
    return reduce(DataFrame.unionByName, parts)


def postings(jobs: DataFrame) -> DataFrame:
    """The posting columns alone, in their fixed order."""
    return jobs.select(*JOB_COLS)


def _check_clock(scraped_at: str | Column) -> None:
    if not isinstance(scraped_at, str):
        return
    try:
        right = re.match(ISO_SHAPE, scraped_at) and datetime.fromisoformat(scraped_at.replace(",", "."))
    except ValueError:
        right = None
    if not right:
        raise ValueError(f"scraped_at must be a valid ISO 8601 timestamp, not {scraped_at!r}")
