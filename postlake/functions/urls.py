"""URL building and reading."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import non_empty


def resolve(base: str, link: Column) -> Column:
    """Resolve a link against a fixed page URL (dot segments are kept as written)."""
    parts = urlsplit(base)
    origin = f"{parts.scheme}://{parts.netloc}"
    folder = base[: base.rindex("/") + 1]
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(F.lit(parts.scheme + ":"), link))
        .when(link.startswith("/"), F.concat(F.lit(origin), link))
        .when(link.startswith("?") | link.startswith("#") | (link == ""), F.concat(F.lit(base), link))
        .otherwise(F.concat(F.lit(folder), link))
    )


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def query_of(url: Column) -> Column:
    return non_empty(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1))


def query_value(url: Column, key: str) -> Column:
    """First non-empty value of a query key."""
    return non_empty(F.regexp_extract(query_of(url), rf"(?:^|&){key}=([^&]+)", 1))


def id_from_link(url: Column) -> Column:
    """Posting id of a link: a query id, else an all-digits last path segment."""
    path = F.regexp_extract(url, r"^([^?#]*)", 1)
    return F.coalesce(
        query_value(url, "jobid"),
        query_value(url, "job_id"),
        query_value(url, "id"),
        non_empty(F.regexp_extract(path, r"/([0-9]+)\.html$", 1)),
    )


def page_numbers(urls: Column) -> Column:
    """Whole numbers given as ``page=`` in an array of URLs."""
    values = F.flatten(
        F.transform(urls, lambda u: F.regexp_extract_all(F.coalesce(query_of(u), F.lit("")), F.lit(r"(?:^|&)page=([^&]+)"), F.lit(1)))
    )
    return F.filter(F.transform(values, lambda v: F.when(v.rlike(r"^\d+$"), v.try_cast("int"))), lambda n: n.isNotNull())
