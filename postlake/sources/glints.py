"""Board ``glints``: HTML pages with a data script; links come from the rendered cards."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions import lists, markup, money
from postlake.functions.dates import parse_iso
from postlake.functions.payload import (
    amount_at, at, bound, deref, int_at, is_object, item_reject, kind_of, list_at, next_data, next_data_status, text_at, text_or, truthy,
)
from postlake.functions.text import clean, html_text, humanize, non_empty
from postlake.functions.urls import resolve, without_query
from postlake.sources.captures import detail_pages, explode_items, fetch_outcome, finish_listing, listing_pages, required

NAME = "glints"
# Site address, link path and id pattern, login prompt, card markup.
LISTING_URL = "https://glints.com/id/lowongan-kerja"
JOB_PATH = "/id/opportunities/jobs/"
JOB_ID = re.compile(r"/id/opportunities/jobs/[^/]+/([0-9a-f-]+)")
LOGIN_PROMPT = "Login untuk lihat loker lebih banyak"
CARD_CLASS = "job-search-results_job-card_link"
CARD_ID = "data-gtm-job-id"
SEARCH_KEY = "searchJobsV3("
# Labels of the work arrangements.
ARRANGEMENTS = {"HYBRID": "Hybrid", "ONSITE": "On Site", "REMOTE": "Remote"}


def _links(html: str) -> Iterator[tuple[str, str]]:
    page = markup.parse(html)
    to_job = markup.every(markup.tag("a"), markup.contains("href", JOB_PATH))
    found = False
    for card in filter(markup.cls(CARD_CLASS), page.walk()):
        anchor = markup.first(card, to_job)
        key, href = card.attr(CARD_ID), anchor and anchor.attr("href")
        if key and href:
            found = True
            yield key, href
    if not found:
        for anchor in filter(to_job, page.walk()):
            match = JOB_ID.search(anchor.attr("href") or "")
            if match:
                yield match.group(1), anchor.attr("href")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("href", T.StringType())])))
def card_pairs(html: pd.Series) -> pd.Series:
    """(posting id, link) of a page's cards, in page order."""
    return html.map(lambda page: list(_links(page)), na_action="ignore")


def card_links(pairs: Column) -> Column:
    """Posting id -> link of a page; the first link of an id wins."""
    return lists.map_by(F.transform(pairs, lambda p: p["key"]), F.transform(pairs, lambda p: p["href"]))


def listing(captures: DataFrame) -> DataFrame:
    doc = F.col("doc")
    pages = listing_pages(captures, NAME).withColumn("payload", next_data(F.col("body")))
    pages = pages.withColumns({"doc": F.try_parse_json("payload"), "pairs": card_pairs("body")})
    pages = pages.withColumn("links", card_links(F.col("pairs"))).drop("pairs")
    cache = at(doc, "$.props.apolloCache", "map<string,variant>")
    pages = pages.withColumns({"initial": at(doc, "$.props.pageProps.initialJobs"), "cache": cache})
    # Only a page without the first shape resolves references.
    pages = pages.withColumn("direct", list_at(F.col("initial"), "$.jobsInPage").isNotNull())
    pages = pages.withColumn("found", F.when(F.col("direct"), F.col("initial")).otherwise(cached_search(F.col("payload"), F.col("cache"))))
    pages = pages.withColumn("cache", F.when(~F.col("direct"), F.col("cache")))
    page_items = list_at(F.col("found"), "$.jobsInPage")
    pages = pages.withColumns({
        "outcome": F.coalesce(
            fetch_outcome(http=False),
            F.nullif(next_data_status(F.col("body"), F.col("payload"), doc), F.lit("ok")),
            F.when(page_items.isNull(), "no_list"),
            F.when(F.size(page_items) == 0, "empty"),
            F.lit("ok"),
        ),
        "total_pages": F.lit(None).cast("int"),
        "has_more": truthy(at(F.col("found"), "$.hasMore")),
    })
    # A page without postings is told apart by the login prompt.
    gated = F.coalesce(F.col("body_text").contains(LOGIN_PROMPT), F.lit(False))
    unloadable = F.col("outcome").isin("empty", "no_list", "missing_script", "empty_script", "bad_json")
    pages = pages.withColumn("outcome", F.when(unloadable & gated, "login_gated").otherwise(F.col("outcome")))
    items = F.when(F.col("outcome") == "ok", F.transform(page_items, lambda i: resolved(i, F.col("cache"), F.col("links"))))
    rows = explode_items(pages, items).drop("doc", "payload", "initial", "cache", "found", "direct", "links")
    item = F.col("item")
    raw = item["raw"]
    rows = rows.withColumns({
        "job_id": clean(text_at(raw, "$.id")),
        "title": clean(text_at(raw, "$.title")),
        "company": clean(text_at(item["company"], "$.name")),
        "posted_at": clean(text_or(raw, "$.createdAt", "$.updatedAt")),
        "link": F.coalesce(item["link"], clean(text_at(raw, "$.url"))),
    })
    rows = rows.withColumns({
        **posting_fields(item),
        "url": job_url(F.col("link")),
        "description": F.lit(None).cast("string"),
        "posted_ts": parse_iso(F.col("posted_at")),
    })
    rows = rows.withColumn(
        "reject",
        item_reject(
            raw, required(
                job_id=F.col("job_id"), title=F.col("title"), company=F.col("company"), url=F.col("url"),
                posted_at=F.col("posted_ts").cast("string"),
            )
        ),
    )
    return finish_listing(rows)


def job_url(link: Column) -> Column:
    return resolve(LISTING_URL, without_query(link))


def cached_search(payload: Column, cache: Column) -> Column:
    """First cached search result that has a job list, in the page's own key order."""
    root = F.from_json(F.get_json_object(payload, "$.props.apolloCache.ROOT_QUERY"), "map<string,string>")
    results = F.map_values(F.map_filter(root, lambda k, v: k.startswith(SEARCH_KEY)))
    parsed = F.transform(results, lambda text: deref(cache, F.try_parse_json(text)))
    return F.try_element_at(F.filter(parsed, lambda r: list_at(r, "$.jobsInPage").isNotNull()), F.lit(1))


def resolved(item: Column, cache: Column, links: Column | None = None) -> Column:
    """The item with its linked objects looked up, so that no cache travels with each row."""
    return bound(deref(cache, item), lambda i: linked(i, cache, links))


def linked(item: Column, cache: Column, links: Column | None) -> Column:
    look = lambda path: deref(cache, at(item, path))
    each = lambda doc, path: F.transform(list_at(doc, path), lambda x: deref(cache, x))
    with_place = lambda place: parts_of(item, place, look, each, cache, links)
    return bound(look("$.location"), with_place)


def parts_of(item: Column, place: Column, look, each, cache: Column, links: Column | None) -> Column:
    return F.struct(
        item.alias("raw"),
        look("$.company").alias("company"),
        look("$.city").alias("city"),
        look("$.country").alias("country"),
        place.alias("place"),
        each(place, "$.parents").alias("parents"),
        each(item, "$.salaries").alias("salaries"),
        look("$.salaryEstimate").alias("estimate"),
        F.transform(each(item, "$.skills"), lambda s: deref(cache, at(s, "$.skill"))).alias("skills"),
        look("$.hierarchicalJobCategory").alias("category"),
        (F.lit(None).cast("string") if links is None else F.try_element_at(links, clean(text_at(item, "$.id")))).alias("link"),
    )


def posting_fields(item: Column) -> dict[str, Column]:
    raw = item["raw"]
    arrangement = arrangement_label(text_at(raw, "$.workArrangementOption"))
    skills = lists.tag_list(F.array(arrangement), F.transform(item["skills"], lambda s: clean(text_at(s, "$.name"))))
    category = lists.tag_list(F.array(clean(text_at(item["category"], "$.name"))))
    kind = clean(text_at(raw, "$.type"))
    return {
        "location": location(item),
        "job_type": lists.distinct_join(", ", humanize(kind), arrangement),
        "salary_range": salary(item),
        "tags": F.when(F.size(skills) > 0, skills).otherwise(category),
    }


def arrangement_label(option: Column) -> Column:
    fixed = [F.when(option == code, F.lit(label)) for code, label in ARRANGEMENTS.items()]
    return F.coalesce(*fixed, humanize(non_empty(option)))


def location(item: Column) -> Column:
    def level_name(level: int) -> Column:
        names = F.transform(
            F.filter(item["parents"], lambda p: int_at(p, "$.level") == level),
            lambda p: clean(text_or(p, "$.formattedName", "$.name")),
        )
        # The last name given for a level wins.
        return F.try_element_at(F.filter(names, lambda n: n.isNotNull()), F.lit(-1))

    city = F.coalesce(level_name(3), clean(text_at(item["city"], "$.name")))
    country = F.coalesce(level_name(1), clean(text_at(item["country"], "$.name")))
    place = clean(text_or(item["place"], "$.formattedName", "$.name"))
    return F.when(clean(text_at(item["raw"], "$.workArrangementOption")) == "REMOTE", "Remote").otherwise(
        F.coalesce(lists.distinct_join(", ", city, level_name(2)), lists.distinct_join(", ", place, country))
    )


def salary(item: Column) -> Column:
    """First salary object, else the estimate."""
    objects = F.filter(item["salaries"], is_object)
    pick = F.coalesce(F.try_element_at(objects, F.lit(1)), item["estimate"])
    mode = humanize(clean(text_at(pick, "$.salaryMode")))
    currency = F.concat(F.coalesce(clean(text_at(pick, "$.CurrencyCode")), F.lit("IDR")), F.lit(" "))
    suffix = F.coalesce(F.concat(F.lit(" / "), mode), F.lit(""))
    return money.span(amount_at(pick, "$.minAmount"), amount_at(pick, "$.maxAmount"), currency, repeat_prefix=False, suffix=suffix)


def details(captures: DataFrame) -> DataFrame:
    pages = detail_pages(captures, NAME).select(
        "source", "run_id", "job_id", "fetched_at",
        at(F.try_parse_json(next_data(F.col("body"))), "$.props.apolloCache", "map<string,variant>").alias("cache"),
    )
    cache = F.col("cache")
    pages = pages.withColumn("job", F.try_element_at(cache, F.concat(F.lit("Job:"), F.col("job_id"))))
    pages = pages.withColumn("item", resolved(F.col("job"), cache))
    item = F.col("item")
    pages = pages.withColumn("rich", clean(text_at(item["raw"], "$.descriptionJsonString")))
    pages = pages.withColumn("text", block_text(F.col("rich")))
    fields = posting_fields(item)
    return pages.select(
        "source", "run_id", "job_id", "fetched_at",
        *[fields[f].alias(f) for f in ("location", "job_type", "salary_range")],
        F.lit(None).cast("string").alias("url"),
        html_text("text").alias("description"),
        fields["tags"].alias("tags"),
        F.lit(None).cast("string").alias("posted_at"),
        F.coalesce(kind_of(F.col("job")).startswith("OBJECT"), F.lit(False)).alias("usable"),
    )


def block_text(rich: Column) -> Column:
    """Block texts of an editor document, one per line; text that is not JSON stays itself."""
    doc = F.try_parse_json(rich)
    texts = F.transform(list_at(doc, "$.blocks"), lambda b: clean(text_at(b, "$.text")))
    return F.when(doc.isNull(), rich).otherwise(F.array_join(texts, "\n"))
