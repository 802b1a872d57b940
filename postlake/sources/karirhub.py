"""Board ``karirhub``: JSON listing API, HTML detail pages read as text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import lists, money
from postlake.functions.dates import from_seconds, render_utc
from postlake.functions.payload import int_at, item_reject, list_at, text_at, text_or, truthy, at
from postlake.functions.text import clean, html_texts, lines_and_meta, sections, slugify
from postlake.sources.captures import detail_pages, explode_items, fetch_outcome, finish_listing, listing_pages, required

NAME = "karirhub"
# Site address, hidden-salary word, page labels.
LISTING_URL = "https://karirhub.kemnaker.go.id/lowongan-dalam-negeri/lowongan"
HIDDEN = "Dirahasiakan"
TOP_LINE = "Lowongan dalam negeri"
SALARY_LABEL = "Rentang gaji"
TYPE_LABEL = "Jenis pekerjaan"
SKILLS_HEADING = "Keterampilan"
HEADINGS = ("Deskripsi Pekerjaan", "Persyaratan Khusus", "Persyaratan Umum", SKILLS_HEADING)
STOPS = ("PT Duta Generasi Mandiri", "Lowongan dari")


def listing(captures: DataFrame) -> DataFrame:
    pages = listing_pages(captures, NAME).withColumn("doc", F.try_parse_json("body"))
    pages = pages.withColumns({
        "outcome": F.coalesce(
            fetch_outcome(),
            F.when(F.col("doc").isNull(), "bad_json"),
            F.when(list_at(F.col("doc"), "$.data").isNull(), "no_list"),
            F.lit("ok"),
        ),
        "total_pages": F.lit(None).cast("int"),
        "has_more": F.lit(None).cast("boolean"),
    })
    items = F.when(F.col("outcome") == "ok", list_at(F.col("doc"), "$.data"))
    rows = explode_items(pages, items).drop("doc")
    item = F.col("item")
    rows = rows.withColumns({
        "job_id": clean(text_or(item, "$.id", "$._id", "$.job_id")),
        "title": clean(text_at(item, "$.title")),
        "company": clean(text_at(item, "$.company_name")),
        "posted_ts": from_seconds(int_at(item, "$.published_at")),
        "low": int_at(item, "$.min_salary_amount"),
        "high": int_at(item, "$.max_salary_amount"),
        "skills": skills(item),
    })
    rows = rows.withColumns({
        "location": clean(text_or(item, "$.city_name", "$.location")),
        "job_type": clean(text_or(item, "$.job_type_name", "$.job_type")),
        "salary_range": salary(F.lit(None).cast("string"), truthy(at(item, "$.show_salary")), F.col("low"), F.col("high")),
        "url": detail_url(F.col("title"), F.col("job_id")),
        "description": clean(text_or(item, "$.description", "$.job_description", "$.description_text")),
        "tags": F.when(F.size("skills") > 0, F.col("skills")).otherwise(
            lists.tag_list(F.array(clean(text_at(item, "$.job_function_name"))))
        ),
        "posted_at": render_utc(F.col("posted_ts")),
        "reject": item_reject(
            item, required(job_id=F.col("job_id"), title=F.col("title"), company=F.col("company"), posted_at=F.col("posted_ts").cast("string"))
        ),
    })
    return finish_listing(rows)


def skills(item: Column) -> Column:
    return lists.tag_list(F.transform(list_at(item, "$.skills"), lambda s: clean(text_at(s, "$"))))


def salary(card_text: Column, shown: Column, low: Column, high: Column) -> Column:
    """Text of a card wins (the hidden word gives NULL); else the bounds if they may be shown."""
    bounds = F.when(shown, money.span(low, high, F.lit("Rp "), repeat_prefix=True))
    return F.when(card_text.isNotNull(), F.nullif(card_text, F.lit(HIDDEN))).otherwise(bounds)


def detail_url(title: Column, job_id: Column) -> Column:
    return F.concat(F.lit(LISTING_URL + "/"), slugify(title), F.lit("-"), job_id)


def details(captures: DataFrame, stops: tuple[str, ...] = STOPS) -> DataFrame:
    """``stops`` are the lines that end a section besides the next heading."""
    # The page is read once, for both.
    pages = detail_pages(captures, NAME).select("source", "run_id", "job_id", "fetched_at", lines_and_meta("body").alias("page"))
    pages = pages.select("source", "run_id", "job_id", "fetched_at", "page.*")
    lines = F.col("lines")
    pages = pages.withColumn("heading", lists.line_after(lines, TOP_LINE))
    pages = pages.withColumns({
        f"part_{i}": F.array_join(lists.section(lines, heading, (*HEADINGS[i + 1:], *stops)), "\n")
        for i, heading in enumerate(HEADINGS)
    })
    # All sections are read in one call.
    pages = pages.withColumn("texts", html_texts(F.array(*[F.nullif(F.col(f"part_{i}"), F.lit("")) for i in range(len(HEADINGS))])))
    parts = [(heading, F.col("texts")[i]) for i, heading in enumerate(HEADINGS)]
    return pages.select(
        "source", "run_id", "job_id", "fetched_at",
        lists.line_after(lines, F.col("heading")).alias("location"),
        lists.line_after(lines, TYPE_LABEL).alias("job_type"),
        F.nullif(lists.line_after(lines, SALARY_LABEL), F.lit(HIDDEN)).alias("salary_range"),
        F.lit(None).cast("string").alias("url"),
        F.coalesce(sections(*parts), F.col("meta")).alias("description"),
        lists.section(lines, SKILLS_HEADING, stops).alias("tags"),
        F.lit(None).cast("string").alias("posted_at"),
        # A page without text is a failed detail.
        (F.size(lines) > 0).alias("usable"),
    )
