"""Board ``lokerid``: HTML pages with free-form records in a script, and rendered cards as fallback."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import parse_qs, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from postlake.functions import aliases, lists, markup, money, records, urls
from postlake.functions.dates import parse_posted, render_utc
from postlake.functions.payload import bound, int_at, list_at, script_objects, text_at
from postlake.functions.text import clean, html_text, humanize, non_empty
from postlake.sources.captures import detail_pages, explode_items, fetch_outcome, finish_listing, listing_pages, required

NAME = "lokerid"
# Site address, script marker, listing path.
SITE = "https://www.loker.id/"
LISTING_URL = "https://www.loker.id/cari-lowongan-kerja"
LISTING_PATH = "cari-lowongan-kerja"
MARKER = "window.__remixContext"
NEXT_LABELS = ("next", "selanjutnya", "berikutnya")

# Card markup, in the order it is tried.
_a, _cls, _in = markup.tag("a"), markup.cls, markup.within
_id_link = markup.every(_a, markup.contains("href", "?jobid="))
_html_link = markup.every(_a, markup.ends("href", ".html"))
CARDS = (
    markup.every(markup.tag("article"), _cls("job")),
    _cls("job-card"),
    markup.every(markup.tag("li"), _cls("job")),
    markup.has("data-job-id"),
    markup.child_of(_cls("jobs-list"), markup.tag("li")),
)
TITLE_LINK = (_in(markup.tag("h3"), _a), _in(_cls("title"), _a), _html_link, _id_link)
CARD_TEXTS = {
    "company": (_cls("company-name"), _in(_cls("company"), _a), _cls("company"), markup.contains("class", "company")),
    "place": (_cls("location"), _cls("job-location"), markup.contains("class", "location")),
    "pay": (_cls("salary"), _cls("job-salary"), markup.contains("class", "salary")),
    "kind": (_cls("job-type"), _cls("employment-type"), markup.contains("class", "type")),
}
POSTED = (markup.every(markup.tag("time"), markup.has("datetime")), markup.has("data-posted-at"))
TAGS = (
    _cls("tag"), _in(_cls("tags"), markup.tag("span")), _in(_cls("skills"), markup.tag("span")),
    markup.has("data-tag"), markup.contains("class", "skill"),
)


def _link(node: markup.Element | None) -> str | None:
    href = node and node.attr("href")
    return urljoin(LISTING_URL, href) if href else None


def _link_id(link: str | None) -> str | None:
    parts = urlsplit(link or "")
    values = parse_qs(parts.query)
    given = next((values[key][0].strip() for key in ("jobid", "job_id", "id") if key in values), None)
    last = parts.path.rsplit("/", 1)[-1].removesuffix(".html")
    by_path = last if parts.path.endswith(".html") and last.isascii() and last.isdigit() else None
    return given if given is not None else by_path


def _card(card: markup.Element) -> dict | None:
    """One rendered card as a canonical record, or None if a required part is missing."""
    title, id_link, posted = (markup.first(card, *tests) for tests in (TITLE_LINK, [_id_link], POSTED))
    parts = {field: markup.first(card, *tests) for field, tests in CARD_TEXTS.items()}
    stamps = [posted and posted.attr("datetime"), posted and posted.attr("data-posted-at"), card.attr("data-posted-at")]
    number, written = records.posted(next(filter(None, stamps), None))
    job_id = card.attr("data-job-id") or _link_id(_link(title)) or _link_id(_link(id_link))
    record = {
        **{field: node and node.text(" ") for field, node in parts.items()},
        "id": job_id,
        "link_id": job_id,
        "title": title and title.text(" "),
        "posted": written,
        "posted_number": number,
        "link": _link(title) or _link(id_link),
        "remote": False,
        "tags": [t for test in TAGS for node in filter(test, card.walk()) if (t := node.text(" "))],
        "areas": [],
        "alt": False,
    }
    complete = record["id"] and record["title"] and record["company"] and (written or number is not None)
    return record if complete else None


def _cards(page: markup.Element) -> list[dict]:
    nodes = list(page.walk())
    picked = {id(n): n for test in CARDS for n in filter(test, nodes)}
    if not picked:
        links = filter(lambda n: _html_link(n) or _id_link(n), nodes)
        boxes = (next((a for a in n.ancestors() if a.tag in ("article", "li", "div")), None) for n in links)
        picked = {id(b): b for b in boxes if b is not None}
    return [record for card in picked.values() if (record := _card(card))]


# A canonical record, from a script or a card.
RECORD = (
    "struct<id:string,link_id:string,title:string,company:string,posted:string,posted_number:double,slug:string,link:string,"
    "place:string,kind:string,kind_label:string,pay:string,low:bigint,high:bigint,currency:string,remote:boolean,"
    "tags:array<string>,areas:array<string>,body:string,alt:boolean>"
)
PARSED = ["job_id", "title", "company", "location", "job_type", "salary_range", "url", "tags", "posted_at", "posted_ts"]


def _type(ddl: str) -> T.DataType:
    return T.DataType.fromDDL(ddl)


def _udf(function: Callable, ddl: str) -> Callable[..., Column]:
    """Arrow function over whole batches; made on first use, as parsing the type needs a session."""

    def call(*columns: Column) -> Column:
        kind = _type(ddl)
        arrow = to_arrow_type(kind)
        return F.arrow_udf(lambda batch: pa.array(map(function, batch.to_pylist()), arrow), kind)(*columns)

    return call


def _read_markup(html: str | None) -> dict:
    page = markup.parse(html or "")
    return {"cards": _cards(page), "links": [h for n in page.walk() if n.tag == "a" and (h := n.attr("href"))]}


def _read_detail_page(html: str | None) -> dict | None:
    if html is None:
        return None
    page = markup.parse(html)
    rendered = markup.described(page)
    return {"rendered": rendered, "cards": _cards(page) if rendered is None else []}


def _walk_listing(contexts: list[str] | None) -> dict | None:
    if contexts is None:
        return None
    context = records.first_object(contexts)
    meta = records.page_meta(context)
    return {"records": records.listing_records(context), "meta": json.dumps(meta) if meta else None}


def _walk_detail(contexts: list[str] | None) -> dict | None:
    if contexts is None:
        return None
    record = records.detail_record(records.first_object(contexts))
    return {"records": [] if record is None else [record], "meta": None}


# Rendered cards and every anchor's link, in page order.
page_markup = _udf(_read_markup, f"struct<cards:array<{RECORD}>,links:array<string>>")
# The rendered description of a detail page, and its cards where it has none.
detail_markup = _udf(_read_detail_page, f"struct<rendered:string,cards:array<{RECORD}>>")
# Records and pagination facts of a page's contexts, walked in Python.
WALKS = {
    aliases.with_listing_records: _udf(_walk_listing, f"struct<records:array<{RECORD}>,meta:string>"),
    aliases.with_detail_record: _udf(_walk_detail, f"struct<records:array<{RECORD}>,meta:string>"),
}


def with_records(pages: DataFrame, candidates: Column, name: str, read: Callable[[DataFrame, Column, str], DataFrame] = aliases.with_listing_records) -> DataFrame:
    """Add (records, meta) of the first readable context; only pages that Columns cannot read exactly go to Python."""
    walked = read(pages, candidates, RECORD).withColumn("_walked", WALKS[read](F.when(~F.col("_known.exact"), F.col("_contexts"))))
    plain = F.struct(F.col("_known.records").alias("records"), F.col("_known.meta").alias("meta"))
    return walked.withColumn(name, F.when(F.col("_known.exact"), plain).otherwise(F.col("_walked"))).drop("_contexts", "_known", "_walked")


def contexts(body: Column, kind: Column) -> Column:
    return F.when(kind.endswith("_api"), F.array(body)).otherwise(script_objects(body, MARKER))


def format_fields(r: Column, posted_ts: Column, page_links: Column) -> Column:
    """Posting from a canonical record."""
    mapped = F.try_element_at(page_links, r["slug"])
    prefix = F.concat(money.currency_label(r["currency"]), F.lit(" "))
    remote = F.when(r["remote"], F.lit("Remote"))
    slug_page = F.regexp_replace(r["slug"], r"^/*(.*?)(?:\.html)?$", "$1.html")
    return struct_of({
        "job_id": r["id"],
        "title": r["title"],
        "company": r["company"],
        "location": F.coalesce(r["place"], remote, non_empty(F.array_join(F.array_distinct(r["areas"]), ", "))),
        "job_type": F.coalesce(humanize(r["kind"]), r["kind_label"]),
        "salary_range": F.coalesce(r["pay"], money.span(r["low"], r["high"], prefix, repeat_prefix=True)),
        "url": F.coalesce(
            urls.resolve(LISTING_URL, F.coalesce(mapped, r["link"])),
            urls.resolve(SITE, slug_page),
            F.concat(F.lit(LISTING_URL + "?jobid="), r["link_id"]),
            F.lit(LISTING_URL),
        ),
        "tags": lists.tag_list(r["tags"], F.array(remote)),
        "posted_at": render_utc(posted_ts),
        "posted_ts": posted_ts,
        "alt": r["alt"],
    })


def struct_of(fields: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def reject_reason(job: Column) -> Column:
    return required(job_id=job["job_id"], title=job["title"], company=job["company"], posted_at=job["posted_at"])


def parsed(found: Column, links: Column, base: Column) -> Column:
    """Array of records -> array of (posting, reject reason)."""
    timed = F.transform(found, lambda r: F.struct(r.alias("r"), parse_posted(r["posted_number"], r["posted"], base).alias("ts")))
    jobs = F.transform(timed, lambda t: format_fields(t["r"], t["ts"], links))
    return F.transform(jobs, lambda j: F.struct(j.alias("job"), reject_reason(j).alias("reject")))


def slug_links(links: Column) -> Column:
    """Map from the last path segment without ``.html`` to the link, of the page's posting links; the last of equal ones counts."""
    posting = F.filter(links, lambda h: h.contains(".html") & ~h.contains(LISTING_PATH))
    segment = lambda h: F.replace(F.substring_index(h, "/", -1), F.lit(".html"), F.lit(""))
    return bound(posting, lambda hrefs: lists.map_by(F.transform(hrefs, segment), hrefs, last=True))


def fill(job: Column, others: Column) -> Column:
    """The posting with its gaps filled from same-id postings of the page, in their order."""
    spare = lambda f, test: F.try_element_at(F.filter(F.transform(others, lambda o: o[f]), test), F.lit(1))
    merged = {name: job[name] for name in PARSED}
    for name in ("location", "job_type", "salary_range"):
        merged[name] = F.coalesce(job[name], spare(name, lambda v: v.isNotNull()))
    link = F.coalesce(spare("url", lambda u: u != LISTING_URL), job["url"])
    merged["url"] = F.when(job["url"] == LISTING_URL, link).otherwise(job["url"])
    tags = F.coalesce(spare("tags", lambda t: F.size(t) > 0), job["tags"])
    merged["tags"] = F.when(F.size(job["tags"]) > 0, job["tags"]).otherwise(tags)
    return struct_of(merged)


def merge_page(loaded: Column, carded: Column) -> Column:
    """Script postings first, cards fill their gaps by id, and cards of unknown ids follow.

    All inside the page's row: a merge by (run, page, id) needs no shuffle here.
    """
    both = F.struct(lists.index_by(F.transform(loaded, lambda j: j["job_id"])).alias("loaded"), lists.index_by(F.transform(carded, lambda c: c["job_id"])).alias("carded"))

    def merged(places: Column) -> Column:
        at = lambda side, job: F.try_element_at(places[side], job["job_id"])
        # Of repeated script ids only the last one takes the card's values.
        is_last = lambda j, i: F.element_at(at("loaded", j), -1) == i
        is_fresh = lambda c, i: at("loaded", c).isNull() & (F.element_at(at("carded", c), 1) == i)
        none = F.slice(carded, 1, 0)
        own = F.transform(loaded, lambda j, i: F.struct(j.alias("job"), is_last(j, i).alias("takes")))
        fresh = F.transform(F.filter(carded, is_fresh), lambda c: F.struct(c.alias("job"), F.lit(True).alias("takes")))
        same = lambda job: F.coalesce(F.transform(at("carded", job), lambda i: F.get(carded, i)), none)
        return F.transform(F.concat(own, fresh), lambda e: bound(F.when(e["takes"], same(e["job"])).otherwise(none), lambda others: fill(e["job"], others)))

    return bound(both, merged)


def listing(captures: DataFrame) -> DataFrame:
    pages = listing_pages(captures, NAME)
    html = F.when(F.col("kind") == "listing_html", F.col("body"))
    pages = with_records(pages, contexts(F.col("body"), F.col("kind")), "script")
    pages = pages.withColumns({"rendered": page_markup(html), "base": F.col("scraped_ts")})
    links = F.col("rendered.links")
    pages = pages.withColumns({
        "n_records": F.size("script.records"),
        "found": F.concat("script.records", "rendered.cards"),
        "slugs": slug_links(links),
        "meta": F.try_parse_json("script.meta"),
        "dom_last": F.array_max(urls.page_numbers(links)),
    }).drop("script", "rendered")
    meta = F.col("meta")
    pages = pages.withColumns({
        "outcome": F.coalesce(fetch_outcome(http=False), F.when(F.size("found") == 0, "no_list"), F.lit("ok")),
        "total_pages": F.coalesce(last_page(meta), F.when(meta.isNull(), F.col("dom_last"))),
        "parsed": parsed(F.col("found"), F.col("slugs"), F.col("base")),
    })
    more = F.when(meta.isNotNull(), has_next(meta, F.col("total_pages"))).when(F.col("dom_last").isNotNull(), F.lit(False))
    own = F.slice("parsed", F.lit(1), F.col("n_records"))
    cards = F.slice("parsed", F.col("n_records") + 1, F.size("parsed"))
    pages = pages.withColumns({"has_more": more, "own": own, "cards": cards})
    jobs = lambda rows: F.transform(rows, lambda r: r["job"])
    good = lambda rows: jobs(F.filter(rows, lambda r: r["reject"].isNull()))
    # A record's inner part counts only where the record before it is no posting itself.
    unneeded = lambda r, i: r["job"]["alt"] & F.try_element_at(F.col("own"), i)["reject"].isNull()
    needed = F.filter("own", lambda r, i: ~unneeded(r, i))
    pages = pages.withColumns({"loaded": good(needed), "carded": good(F.col("cards"))})
    bad = F.filter("parsed", lambda r: r["reject"].isNotNull())
    plain = lambda j: struct_of({name: j[name] for name in PARSED})
    as_item = lambda job, reject: F.struct(job.alias("job"), reject.alias("reject"))
    kept = F.transform(merge_page(F.col("loaded"), F.col("carded")), lambda j: as_item(j, F.lit(None).cast("string")))
    items = F.concat(kept, F.transform(bad, lambda r: as_item(plain(r["job"]), r["reject"])))
    rows = explode_items(pages.withColumn("items", F.when(F.col("outcome") == "ok", items)), F.col("items"))
    rows = rows.select(
        "source", "run_id", "page_no", "pos", "outcome", "total_pages", "has_more", "item.reject", "item.job.*",
        F.lit(None).cast("string").alias("description"), "scraped_at", "scraped_ts", "fetched_at", "attempt",
    )
    return finish_listing(rows)


def last_page(meta: Column) -> Column:
    given = F.coalesce(int_at(meta, "$.last_page"), money.lenient_int_text(text_at(meta, "$.last_page"))).try_cast("int")
    linked = urls.page_numbers(F.transform(list_at(meta, "$.links"), lambda link: clean(text_at(link, "$.url"))))
    return F.coalesce(F.when(given > 0, given), F.array_max(linked))


def has_next(meta: Column, last: Column) -> Column:
    current = F.coalesce(F.nullif(int_at(meta, "$.current_page"), F.lit(0)), money.lenient_int_text(text_at(meta, "$.current_page")))
    said = F.exists(
        F.coalesce(list_at(meta, "$.links"), F.array().cast("array<variant>")),
        lambda link: F.coalesce(F.lower(clean(text_at(link, "$.label"))).isin(*NEXT_LABELS), F.lit(False))
        | F.coalesce(F.lower(clean(text_at(link, "$.rel"))) == "next", F.lit(False)),
    )
    by_link = F.coalesce(text_at(meta, "$.next_page_url") != "", F.lit(False)) | said
    return F.coalesce(current < last, by_link)


def details(captures: DataFrame) -> DataFrame:
    keys = ["source", "run_id", "job_id", "fetched_at", "scraped_ts"]
    pages = with_records(detail_pages(captures, NAME), contexts(F.col("body"), F.col("kind")), "script", aliases.with_detail_record)
    pages = pages.select(*keys, "body", F.get("script.records", F.lit(0)).alias("record"))
    # Markup is read once, and only of pages whose script holds no record.
    pages = pages.select(*keys, "record", detail_markup(F.when(F.col("record").isNull(), F.col("body"))).alias("page"))
    pages = pages.select(*keys, "record", "page.*")
    # A record in the script is final; then a rendered description alone; then the first usable card.
    record, rendered = F.col("record"), F.col("rendered")
    found = F.when(record.isNotNull(), F.array("record")).when(rendered.isNull(), F.col("cards"))
    no_links = F.create_map().cast("map<string,string>")
    pages = pages.withColumns({"jobs": parsed(found, no_links, F.col("scraped_ts")), "text": html_text("record.body")})
    usable = F.filter("jobs", lambda r: r["reject"].isNull())
    pages = pages.withColumn("job", F.try_element_at(usable, F.lit(1))["job"])
    return pages.select(
        "source", "run_id", "job_id", "fetched_at",
        *[F.col(f"job.{f}").alias(f) for f in ("location", "job_type", "salary_range", "url")],
        F.when(record.isNotNull(), F.col("text")).otherwise(rendered).alias("description"),
        F.coalesce(F.col("job.tags"), lists.empty_texts()).alias("tags"),
        F.col("job.posted_at").alias("posted_at"),
        (F.col("job").isNotNull() | (record.isNull() & rendered.isNotNull())).alias("usable"),
    )
