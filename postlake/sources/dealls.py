"""Board ``dealls``: page 1 from an HTML page's data script, further pages and details from JSON APIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import lists, money
from postlake.functions.dates import parse_iso
from postlake.functions.payload import at, int_at, item_reject, kind_of, list_at, next_data, next_data_status, text_at, text_or
from postlake.functions.text import clean, html_text, humanize, non_empty, sections
from postlake.sources.captures import detail_pages, explode_items, fetch_outcome, finish_listing, listing_pages, required

NAME = "dealls"
# Site address and the key of the listing query.
LISTING_URL = "https://dealls.com/loker"
QUERY_KEY = "/v1/explore-job/job"


def listing(captures: DataFrame) -> DataFrame:
    doc, html = F.col("doc"), F.col("kind") == "listing_html"
    pages = listing_pages(captures, NAME)
    pages = pages.withColumn("payload", F.when(html, next_data(F.col("body"))).otherwise(F.col("body")))
    pages = pages.withColumn("doc", F.try_parse_json("payload"))
    pages = pages.withColumn("first_page", first_page(doc))
    page = F.coalesce(
        F.when(docs(doc).isNotNull(), doc),
        F.when(docs(at(doc, "$.data")).isNotNull(), at(doc, "$.data")),
        F.when(docs(at(doc, "$.data.data")).isNotNull(), at(doc, "$.data.data")),
        F.col("first_page"),
    )
    pages = pages.withColumn("page", page)
    pages = pages.withColumns({
        "outcome": F.coalesce(
            fetch_outcome(),
            F.nullif(F.when(html, next_data_status(F.col("body"), F.col("payload"), doc)), F.lit("ok")),
            F.when(doc.isNull(), "bad_json"),
            F.when(docs(F.col("page")).isNull(), "no_list"),
            F.lit("ok"),
        ),
        "total_pages": int_at(F.col("page"), "$.totalPages").try_cast("int"),
        "has_more": F.lit(None).cast("boolean"),
    })
    items = F.when(F.col("outcome") == "ok", docs(F.col("page")))
    rows = explode_items(pages, items).drop("doc", "payload", "page", "first_page")
    item = F.col("item")
    rows = rows.withColumns({
        "job_id": text_at(item, "$.id"),
        "title": clean(text_at(item, "$.role")),
        "company": clean(text_or(item, "$.company.name", "$.author.name")),
        "posted_at": clean(text_or(item, "$.publishedAt", "$.createdAt")),
    })
    rows = rows.withColumns({
        **posting_fields(item),
        "url": job_url(clean(text_or(item, "$.slug", "$.slugPrimarySegment")), clean(text_at(item, "$.company.slug"))),
        "description": F.lit(None).cast("string"),
        "posted_ts": parse_iso(F.col("posted_at")),
        "reject": item_reject(
            item, required(job_id=F.col("job_id"), title=F.col("title"), company=F.col("company"))
        ),
    })
    return finish_listing(rows)


def docs(page: Column) -> Column:
    return list_at(page, "$.docs")


def first_page(doc: Column) -> Column:
    """First page of the first listing query kept in the page data."""
    queries = F.filter(
        list_at(doc, "$.props.pageProps.dehydratedState.queries"),
        lambda q: F.coalesce(text_at(q, "$.queryKey[0]") == QUERY_KEY, F.lit(False)),
    )
    return at(F.try_element_at(queries, F.lit(1)), "$.state.data.pages[0]")


def posting_fields(item: Column) -> dict[str, Column]:
    """Fields that a listing item and a detail result format alike."""
    place = lists.distinct_join(", ", clean(text_at(item, "$.city.name")), clean(text_at(item, "$.country.name")))
    workplace = non_empty(text_at(item, "$.workplaceType"))
    kinds = F.filter(
        F.transform(list_at(item, "$.employmentTypes"), lambda t: non_empty(text_at(t, "$"))), lambda t: t.isNotNull()
    )
    skills = F.transform(list_at(item, "$.skills"), lambda s: clean(text_at(s, "$.name")))
    return {
        "location": F.coalesce(clean(text_at(item, "$.location")), place, F.when(workplace == "remote", "Remote")),
        "job_type": F.coalesce(non_empty(F.array_join(F.transform(kinds, humanize), ", ")), humanize(workplace)),
        "salary_range": salary(item),
        "tags": lists.tag_list(F.array(humanize(workplace)), skills),
    }


def salary(item: Column) -> Column:
    bounds = money.span(
        int_at(item, "$.salaryRange.start"), int_at(item, "$.salaryRange.end"), F.lit("IDR "), repeat_prefix=False
    )
    return F.when(text_at(item, "$.salaryType") == "unpaid", "Unpaid").otherwise(bounds)


def job_url(slug: Column, company_slug: Column) -> Column:
    tail = F.concat(F.lit("/"), slug, F.coalesce(F.concat(F.lit("~"), company_slug), F.lit("")))
    return F.concat(F.lit(LISTING_URL), F.coalesce(tail, F.lit("")))


def details(captures: DataFrame) -> DataFrame:
    result = F.col("result")
    pages = detail_pages(captures, NAME).select(
        "source", "run_id", "job_id", "fetched_at", at(F.try_parse_json("body"), "$.data.result").alias("result")
    )
    pages = pages.withColumns({key: text_at(result, f"$.{key}") for key in ("description", "responsibilities", "requirements")})
    text = sections(
        (None, html_text("description")),
        ("Responsibilities", html_text("responsibilities")),
        ("Requirements", html_text("requirements")),
    )
    fields = posting_fields(result)
    return pages.select(
        "source", "run_id", "job_id", "fetched_at",
        *[fields[f].alias(f) for f in ("location", "job_type", "salary_range")],
        F.lit(None).cast("string").alias("url"),
        text.alias("description"),
        fields["tags"].alias("tags"),
        F.lit(None).cast("string").alias("posted_at"),
        F.coalesce(kind_of(result).startswith("OBJECT"), F.lit(False)).alias("usable"),
    )
