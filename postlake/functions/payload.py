"""Untyped JSON payloads as VARIANT, read with the type checks each field needs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import non_empty

# JSON texts that count as "no value" when alternatives are tried.
FALSY = ("null", '""', "0", "0.0", "false", "[]", "{}")
# The script element that carries a page's data.
NEXT_DATA = r"""(?is)<script\b[^>]*\bid\s*=\s*["']?__NEXT_DATA__["']?(?=[\s>])[^>]*>(.*?)</script"""
SCRIPTS = r"(?is)<script\b[^>]*>(.*?)</script"


def at(doc: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(doc, path, kind)


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named there.

    A column expression is copied into every place it is used in, nested ones many times over; the variable of a
    one-element ``transform`` is not.
    """
    return F.get(F.transform(F.array(value), use), 0)


def text_at(doc: Column, path: str) -> Column:
    """String at the path; numbers, booleans and containers give NULL."""
    return bound(at(doc, path), lambda v: F.when(kind_of(v) == "STRING", v.cast("string")))


def int_at(doc: Column, path: str) -> Column:
    """Whole JSON number at the path; decimals and booleans give NULL."""
    return bound(at(doc, path), lambda v: F.when(kind_of(v) == "BIGINT", v.cast("bigint")))


def amount_at(doc: Column, path: str) -> Column:
    """Any JSON number at the path, cut to a whole number."""

    def whole(v: Column) -> Column:
        is_number = lambda kind: (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
        return F.when(bound(kind_of(v), is_number), v.cast("double").try_cast("bigint"))

    return bound(at(doc, path), whole)


def list_at(doc: Column, path: str) -> Column:
    return at(doc, path, "array<variant>")


def truthy(value: Column) -> Column:
    """Whether a value counts when alternatives are tried: not NULL, empty, zero or false."""

    def counts(v: Column) -> Column:
        return F.when(v.isNull(), F.lit(False)).otherwise(~F.to_json(v).isin(*FALSY))

    return bound(value, counts)


def text_or(doc: Column, *paths: str) -> Column:
    """Text of the first path that holds any value; a non-text there gives NULL."""
    first = lambda v: F.when(truthy(v), F.struct(F.when(kind_of(v) == "STRING", v.cast("string")).alias("text")))
    return F.coalesce(*[bound(at(doc, p), first) for p in paths]).getField("text")


def is_object(value: Column) -> Column:
    return F.coalesce(F.to_json(value).startswith("{"), F.lit(False))


def item_reject(item: Column, reason: Column) -> Column:
    """The reject reason; an item that lacks something is first checked for being an object at all."""
    return F.when(reason.isNotNull(), F.when(is_object(item), reason).otherwise("not an object"))


def next_data(html: Column) -> Column:
    """Text of the page-data script; NULL if the page has none, '' if it is empty."""
    found = F.regexp_extract_all(html, F.lit(NEXT_DATA), F.lit(1))
    return F.try_element_at(found, F.lit(1))


def next_data_status(html: Column, payload: Column, doc: Column) -> Column:
    return (
        F.when(html.isNull() | payload.isNull(), "missing_script")
        .when(F.trim(payload) == "", "empty_script")
        .when(doc.isNull(), "bad_json")
        .otherwise("ok")
    )


def script_objects(html: Column, marker: str) -> Column:
    """First-``{``-to-last-``}`` slices of the scripts that contain the marker, in page order."""
    scripts = F.filter(F.regexp_extract_all(html, F.lit(SCRIPTS), F.lit(1)), lambda s: s.contains(marker))
    return F.filter(F.transform(scripts, lambda s: non_empty(F.regexp_extract(s, r"(?s)(\{.*\})", 1))), lambda s: s.isNotNull())


def deref(cache: Column, value: Column) -> Column:
    """Follow ``{"__ref": key}`` one step into a cache map; other values stay."""

    def follow(v: Column) -> Column:
        return bound(text_at(v, "$.__ref"), lambda ref: F.when(ref.isNotNull(), F.try_element_at(cache, ref)).otherwise(v))

    return bound(value, follow)
