"""Board ``kitalulus``: JSON listing API with complete items, no detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import lists, money
from postlake.functions.dates import from_micros, render_utc
from postlake.functions.payload import amount_at, at, int_at, item_reject, list_at, text_at, truthy
from postlake.functions.text import clean, humanize, non_empty
from postlake.sources.captures import explode_items, fetch_outcome, finish_listing, listing_pages, required

NAME = "kitalulus"
# Posting address, negotiable-salary word, page size.
DETAIL_URL = "https://www.kitalulus.com/lowongan/detail/"
NEGOTIABLE = "Dinegosiasikan"
PAGE_SIZE = 20


def listing(captures: DataFrame) -> DataFrame:
    doc = F.col("doc")
    pages = listing_pages(captures, NAME).withColumn("doc", F.try_parse_json("body"))
    pages = pages.withColumns({
        "outcome": F.coalesce(
            F.when(F.coalesce(F.col("status_code"), F.lit(200)) != 200, "bad_status"),
            fetch_outcome(),
            F.when(doc.isNull(), "bad_json"),
            F.when(at(doc, "$.errors").isNotNull(), "api_errors"),
            F.when(at(doc, "$.data.vacanciesV3").isNull(), "no_list"),
            F.lit("ok"),
        ),
        "total_pages": page_estimate(int_at(doc, "$.data.vacanciesV3.elements")),
        "has_more": truthy(at(doc, "$.data.vacanciesV3.hasNextPage")),
    })
    items = F.when(F.col("outcome") == "ok", list_at(doc, "$.data.vacanciesV3.list"))
    rows = explode_items(pages, items).drop("doc")
    item = F.col("item")
    rows = rows.withColumns({
        "job_id": text_at(item, "$.code"),
        "title": text_at(item, "$.positionName"),
        "slug": text_at(item, "$.slug"),
        "company": text_at(item, "$.company.name"),
        "posted_ts": from_micros(amount_at(item, "$.updatedAt")),
        "low": F.coalesce(amount_at(item, "$.salaryLowerBound"), F.lit(0)),
        "high": F.coalesce(amount_at(item, "$.salaryUpperBound"), F.lit(0)),
        "low_text": non_empty(text_at(item, "$.salaryLowerBoundStr")),
        "high_text": non_empty(text_at(item, "$.salaryUpperBoundStr")),
        "type_text": non_empty(text_at(item, "$.typeStr")),
        "rich": non_empty(text_at(item, "$.formattedDescription")),
    })
    names = [
        text_at(item, p)
        for p in ("$.jobRole.displayName", "$.jobSpecialization.displayName", "$.jobFunction", "$.educationLevelStr")
    ]
    rows = rows.withColumns({
        "location": non_empty(
            F.concat_ws(", ", non_empty(text_at(item, "$.city.name")), non_empty(text_at(item, "$.province.name")))
        ),
        "job_type": F.when(F.col("type_text").isNotNull(), clean(F.col("type_text"))).otherwise(
            humanize(non_empty(text_at(item, "$.type")))
        ),
        "salary_range": salary(F.col("low"), F.col("high"), F.col("low_text"), F.col("high_text")),
        "url": F.concat(F.lit(DETAIL_URL), F.col("slug")),
        "tags": lists.tag_list(F.array(*[non_empty(n) for n in names])),
        "description": F.when(F.col("rich").isNull(), clean(text_at(item, "$.requirementStr"))),
        "markup": F.col("rich"),
        "posted_at": render_utc(F.col("posted_ts")),
        "reject": item_reject(
            item, required(job_id=F.col("job_id"), title=F.col("title"), slug=F.col("slug"), company=F.col("company"))
        ),
    })
    return finish_listing(rows)


def page_estimate(elements: Column) -> Column:
    """Number of pages a total of postings takes."""
    return F.floor((elements + (PAGE_SIZE - 1)) / PAGE_SIZE).cast("int")


def salary(low: Column, high: Column, low_text: Column, high_text: Column) -> Column:
    """Positive bounds, else the display texts; both texts negotiable hides everything."""
    texts = non_empty(F.concat_ws(" - ", low_text, high_text))
    hidden = F.coalesce(low_text.contains(NEGOTIABLE) & high_text.contains(NEGOTIABLE), F.lit(False))
    return F.when(~hidden, F.coalesce(money.plus_span(low, high), texts))
