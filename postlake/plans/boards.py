"""The boards by name: how each is read, where its runs stop, what its details add."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.lists import tag_list
from postlake.functions.text import clean, html_text
from postlake.operators.merge import fill_tags, longer_tags, more_specific
from postlake.operators.page_cut import CutRules
from postlake.sources import dealls, glints, karirhub, kitalulus, lokerid

Merged = dict[str, Column]


@dataclass(frozen=True)
class Board:
    """``needs`` says which postings need their detail page (NULL = none does), given the text flag."""

    name: str
    listing: Callable[[DataFrame], DataFrame]
    details: Callable[[DataFrame], DataFrame] | None
    rules: Callable[[int | None], CutRules]
    needs: Callable[[bool], Column | None]
    merge: Callable[[Column, bool], Merged]
    dedupes: bool
    #: Descriptions of listing items are HTML, to be read where the posting is kept.
    has_markup: bool = False


def read_markup(rows: DataFrame, b: Board) -> DataFrame:
    """Descriptions that came as HTML, as text."""
    return rows.withColumn("description", F.coalesce("description", html_text("markup"))) if b.has_markup else rows


def _page() -> Column:
    return F.col("page_no")


def _outcome(*values: str) -> Column:
    return F.col("outcome").isin(*values)


def _none(kind: str) -> Column:
    return F.max(F.lit(None).cast(kind))


def _missing(*fields: str) -> Column:
    tests = [F.size("tags") == 0 if f == "tags" else F.col(f).isNull() for f in fields]
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


# dealls ------------------------------------------------------------------------------------------


def _dealls_rules(max_pages: int | None) -> CutRules:
    total = F.max(F.when((_page() == 1) & (F.col("total_pages") > 0), F.col("total_pages")))
    past_end = (_page() > 1) & _outcome("rejected") if max_pages is None else F.lit(False)
    return CutRules(
        stop_before=past_end,
        stop_after=F.lit(False),
        fatal=~_outcome("ok") & ~past_end,
        # Without a valid total an unbounded run ends after page 1.
        last_page=F.coalesce(total, F.lit(1)) if max_pages is None else total,
    )


def _dealls_merge(d: Column, with_text: bool) -> Merged:
    out = {f: F.coalesce(F.nullif(F.col(f), F.lit("")), d[f]) for f in ("location", "job_type", "salary_range", "description")}
    return {**out, "tags": fill_tags(F.col("tags"), d["tags"])}


# glints ------------------------------------------------------------------------------------------


def _glints_rules(max_pages: int | None) -> CutRules:
    unread = ~_outcome("ok")
    return CutRules(
        stop_before=unread & ~_outcome("failed") & (_page() > 1),
        stop_after=~F.coalesce(F.col("has_more"), F.lit(False)),
        fatal=_outcome("failed") | (unread & (_page() == 1)),
        last_page=_none("int"),
    )


def _glints_needs(with_text: bool) -> Column:
    always = _missing("location", "job_type")
    return always | _missing("salary_range", "tags", "description") if with_text else always


def _glints_merge(d: Column, with_text: bool) -> Merged:
    kind = F.col("job_type")
    longer = d["job_type"].isNotNull() & (kind.isNull() | (F.length(d["job_type"]) > F.length(kind)))
    return {
        "location": more_specific(F.col("location"), d["location"]),
        "job_type": F.when(longer, d["job_type"]).otherwise(kind),
        "salary_range": F.coalesce(F.col("salary_range"), d["salary_range"]),
        "tags": longer_tags(F.col("tags"), d["tags"], F.size(d["tags"])),
        "description": F.coalesce(F.col("description"), d["description"]) if with_text else F.col("description"),
    }


# karirhub ----------------------------------------------------------------------------------------


def _karirhub_rules(max_pages: int | None) -> CutRules:
    late_reject = (_page() > 1) & _outcome("rejected")
    return CutRules(
        stop_before=late_reject | (_outcome("ok") & (F.col("new_jobs") == 0)),
        stop_after=F.lit(False),
        fatal=~_outcome("ok") & ~late_reject,
        last_page=_none("int"),
    )


def _karirhub_merge(d: Column, with_text: bool) -> Merged:
    tags = F.filter(F.transform(d["tags"], clean), lambda t: t.isNotNull())
    out = {f: F.coalesce(F.col(f), clean(d[f])) for f in ("job_type", "salary_range", "description")}
    # The list is counted before equal values are dropped.
    return {
        **out,
        "location": more_specific(F.col("location"), clean(d["location"])),
        "tags": longer_tags(F.col("tags"), tag_list(tags), F.size(tags)),
    }


# kitalulus ---------------------------------------------------------------------------------------


def _kitalulus_rules(max_pages: int | None) -> CutRules:
    bad = ~_outcome("ok")
    return CutRules(
        stop_before=(bad & (_page() > 1)) | (~bad & (F.col("recent_jobs") == 0)),
        stop_after=~F.coalesce(F.col("has_more"), F.lit(False)),
        fatal=bad & (_page() == 1),
        last_page=_none("int"),
    )


# lokerid -----------------------------------------------------------------------------------------


def _lokerid_rules(max_pages: int | None) -> CutRules:
    known = F.col("total_pages").isNotNull()
    # The first total any page gives holds for the run, from that page on.
    total = F.min_by("total_pages", F.when(known, _page()))
    return CutRules(
        stop_before=_outcome("ok") & (F.col("recent_jobs") == 0),
        stop_after=~F.coalesce(F.col("has_more"), F.lit(True)),
        fatal=~_outcome("ok"),
        last_page=F.greatest(total, F.min(F.when(known, _page()))),
    )


def _lokerid_needs(with_text: bool) -> Column:
    return F.lit(True) if with_text else _missing("location", "job_type", "salary_range", "tags")


def _lokerid_merge(d: Column, with_text: bool) -> Merged:
    out = {f: F.coalesce(F.col(f), d[f]) for f in ("location", "job_type", "salary_range", "posted_at")}
    home = F.lit(lokerid.LISTING_URL)
    return {
        **out,
        "url": F.when(F.col("url") == home, F.coalesce(d["url"], home)).otherwise(F.col("url")),
        "tags": fill_tags(F.col("tags"), d["tags"]),
        "description": F.coalesce(F.col("description"), d["description"]) if with_text else F.lit(None).cast("string"),
    }


BOARDS = {
    board.name: board
    for board in (
        Board(
            dealls.NAME, dealls.listing, dealls.details, _dealls_rules,
            lambda with_text: _missing("location", "job_type", "description") if with_text else None,
            _dealls_merge, dedupes=False,
        ),
        Board(glints.NAME, glints.listing, glints.details, _glints_rules, _glints_needs, _glints_merge, dedupes=True),
        Board(
            karirhub.NAME, karirhub.listing, karirhub.details, _karirhub_rules,
            lambda with_text: _missing("location", "job_type", "salary_range", "tags", "description") if with_text else None,
            _karirhub_merge, dedupes=True,
        ),
        Board(
            kitalulus.NAME, kitalulus.listing, None, _kitalulus_rules,
            lambda with_text: None, lambda d, with_text: {}, dedupes=False, has_markup=True,
        ),
        Board(lokerid.NAME, lokerid.listing, lokerid.details, _lokerid_rules, _lokerid_needs, _lokerid_merge, dedupes=True),
    )
}
DEFAULT_BOARD = dealls.NAME


def board(name: str = DEFAULT_BOARD) -> Board:
    if name not in BOARDS:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(BOARDS)}")
    return BOARDS[name]
