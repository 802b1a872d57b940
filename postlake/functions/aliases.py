"""Free-form job records found and read as Columns; ``records`` holds the spellings, and the walk for what is left over.

A record's values are looked up by node and spelling: the nodes of the record in written order, in each the spellings in the
order they are tried. Texts this cannot read exactly (nested deeper than the levels here, repeated keys, ids that are no text or
whole number, a part of a record that is a posting itself) are told, and those pages alone go to the walk in ``records``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import records
from postlake.functions.money import lenient_int_text
from postlake.functions.ordered import NODES, below, containers, in_order, inside, is_list, is_object, member, members, top, whole_object, with_levels
from postlake.functions.payload import bound, kind_of, list_at, text_or
from postlake.functions.text import BLANKS, clean, non_empty

#: Levels below a record, below a page's context for its records, and for its pagination facts.
RECORD_DEPTH, LIST_DEPTH, META_DEPTH = 5, 7, 7
#: What is looked up in a record, each by its spellings in the order they are tried; the last groups have one spelling each.
LOOKUPS = {
    **records.ALIASES, "company": records.COMPANY, "short_id": records.SHORT_ID, "short_title": records.SHORT_TITLE,
    **{f"{group} {name}": (name,) for group, names in (("remote", records.REMOTE), ("tags", records.TAGS), ("body", records.BODY)) for name in names},
}
PLACE = {name: i for i, name in enumerate(LOOKUPS)}
#: What is read as text; the names of the description come last.
TEXTS = ["title", "slug", "link", "place", "kind", "kind_label", "pay", "currency", *(f"body {name}" for name in records.BODY)]
KNOWN = sorted({*records.AREAS, *(n for names in LOOKUPS.values() for n in names)})
FACTS = "|".join(records.META)


def _first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def _group(array: Column, group: str) -> Column:
    places = [i for name, i in PLACE.items() if name.startswith(f"{group} ")]
    return F.slice(array, places[0] + 1, len(places))


def hits(nodes: Column) -> Column:
    """(node number, key, value) of every known spelling that holds a value, nodes in order."""

    def of(node: Column, i: Column) -> Column:
        known = F.filter(members(node["raw"]), lambda m: (m["raw"] != "") & m["key"].isin(KNOWN))
        return F.transform(known, lambda m: F.struct(i.alias("node"), m["key"].alias("key"), m["value"].alias("value")))

    return F.flatten(F.transform(nodes, of))


def find(found: Column, names: Column) -> Column:
    """Value of the first node that has any of the names, by the first of them it has."""
    def of(own: Column) -> Column:
        place = F.array_min(F.transform(own, lambda h: F.struct(h["node"].alias("node"), F.array_position(names, h["key"]).alias("rank"), h["key"].alias("key"))))
        best = bound(place, lambda p: _first(F.filter(own, lambda h: (h["node"] == p["node"]) & (h["key"] == p["key"]))))
        # Most names are found once or not at all.
        return F.when(F.size(own) <= 1, _first(own)).otherwise(best)["value"]

    return bound(F.filter(found, lambda h: F.array_contains(names, h["key"])), of)


def text(value: Column) -> Column:
    trimmed = lambda v: bound(F.trim(v.cast("string"), F.lit(BLANKS)), non_empty)
    return bound(value, lambda v: F.when(kind_of(v) == "STRING", trimmed(v)))


def _is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")


def whole(value: Column) -> Column:
    """Whole number of a number without fraction or a numeric text."""
    def of(v: Column) -> Column:
        kind, number = kind_of(v), F.try_variant_get(v, "$", "decimal(38,10)")
        return F.when(kind == "STRING", lenient_int_text(v.cast("string"))).when(_is_number(kind) & (number == F.floor(number)), number.try_cast("bigint"))

    return bound(value, of)


def label(value: Column) -> Column:
    return bound(value, lambda v: F.when(kind_of(v) == "STRING", clean(v.cast("string"))).when(kind_of(v) == "BIGINT", v.cast("string")))


def _plain(value: Column) -> Column:
    """Whether an id is a text, a whole number or nothing, which ``label`` gives exactly."""
    return bound(value, lambda v: v.isNull() | kind_of(v).isin("STRING", "BIGINT", "BOOLEAN"))


def posted(value: Column) -> Column:
    """Epoch number or text, and whether that is exact."""
    def of(v: Column) -> Column:
        numbered = lambda written: F.struct(written.alias("text"), lenient_int_text(written).alias("number"))
        return bound(F.struct(kind_of(v).alias("kind"), bound(text(v), numbered).alias("said")), lambda s: told(v, s["kind"], s["said"]))

    def told(v: Column, kind: Column, said: Column) -> Column:
        return F.struct(
            F.when(_is_number(kind), v.cast("double")).otherwise(said["number"].cast("double")).alias("number"),
            F.when(said["number"].isNull(), said["text"]).alias("text"),
            (v.isNull() | _is_number(kind) | kind.isin("STRING", "BOOLEAN")).alias("plain"),
        )

    return bound(value, of)


def named(value: Column, names: Sequence[str]) -> Column:
    """Text of a value, or of an object's first filled key."""
    of_object = lambda v: clean(text_or(v, *[f"$.{n}" for n in names]))
    return bound(value, lambda v: F.when(kind_of(v).startswith("OBJECT"), of_object(v)).otherwise(text(v)))


def company(value: Column) -> Column:
    """Name of the company, and whether it is certain: an object without a name of its own may hold one deeper."""
    def of(v: Column) -> Column:
        name = named(v, records.COMPANY_NAME)
        inner = F.coalesce(kind_of(v).startswith("OBJECT") | kind_of(v).startswith("ARRAY"), F.lit(False))
        return bound(name, lambda n: F.struct(n.alias("name"), (n.isNotNull() | ~inner).alias("plain")))

    return bound(value, of)


def _remote(value: Column) -> Column:
    yes = lambda v: ((kind_of(v) == "BOOLEAN") & v.cast("string").eqNullSafe("true")) | ((kind_of(v) == "STRING") & (F.lower(v.cast("string")) == "remote"))
    return bound(value, lambda v: F.coalesce(yes(v), F.lit(False)))


def record_type(ddl: str) -> str:
    return f"struct<record:{ddl},job_like:boolean,exact:boolean>"


def canonical(raw: Column, ddl: str, depth: int = RECORD_DEPTH) -> Column:
    """(record under one set of names, whether it is like a job, whether both are exact) of a record's text."""

    def read(levels: list[Column]) -> Column:
        objects = F.filter(in_order(levels), lambda n: n["raw"].startswith("{"))
        return bound(hits(objects), lambda found: looked_up(found, F.size(objects), F.size(levels[-1])))

    def looked_up(found: Column, n_objects: Column, n_deepest: Column) -> Column:
        names = F.array(*[F.array(*map(F.lit, n)) for n in LOOKUPS.values()])
        values = F.transform(names, lambda n: find(found, n))
        own = F.filter(found, lambda h: (h["node"] == 0) & h["key"].isin(*records.AREAS))
        area = lambda places, name: named(_first(F.filter(places, lambda h: h["key"] == name))["value"], ("name", "label"))
        in_places = lambda places: F.array_compact(F.transform(F.array(*map(F.lit, records.AREAS)), lambda name: area(places, name)))
        areas = bound(own, lambda places: F.when(F.size(places) > 0, in_places(places)).otherwise(F.array().cast("array<string>")))
        return bound(values, lambda v: with_texts(v, areas, n_objects, n_deepest))

    def with_texts(values: Column, areas: Column, n_objects: Column, n_deepest: Column) -> Column:
        at = lambda name: F.get(values, F.lit(PLACE[name]))
        texts = F.transform(F.array(*[F.get(values, F.lit(PLACE[name])) for name in TEXTS]), text)
        known = F.struct(texts.alias("texts"), posted(at("posted")).alias("posted"), company(at("company")).alias("company"))
        return bound(known, lambda k: fields(values, k, areas, n_objects, n_deepest))

    def fields(values: Column, k: Column, areas: Column, n_objects: Column, n_deepest: Column) -> Column:
        at = lambda name: F.get(values, F.lit(PLACE[name]))
        written = lambda name: F.get(k["texts"], F.lit(TEXTS.index(name)))
        item_texts = lambda v: F.transform(list_at(v, "$"), lambda i: named(i, ("name", "label", "title")))
        lists = F.transform(_group(values, "tags"), lambda v: F.coalesce(item_texts(v), F.array().cast("array<string>")))
        record = {
            "id": label(at("id")), "link_id": label(at("link_id")), "title": written("title"), "company": k["company"]["name"],
            "posted": k["posted"]["text"], "posted_number": k["posted"]["number"],
            **{name: written(name) for name in ("slug", "link", "place", "kind", "kind_label", "pay")},
            "low": whole(at("pay_min")), "high": whole(at("pay_max")), "currency": written("currency"),
            "remote": F.exists(_group(values, "remote"), _remote), "tags": F.array_compact(F.flatten(lists)), "areas": areas,
            "body": _first(F.array_compact(F.slice(k["texts"], len(TEXTS) - len(records.BODY) + 1, len(records.BODY)))), "alt": F.lit(False),
        }
        like = at("short_id").isNotNull() & at("short_title").isNotNull() & k["company"]["name"].isNotNull()
        # A record that is no posting may hold one.
        exact = (n_deepest == 0) & _plain(at("id")) & _plain(at("link_id")) & k["posted"]["plain"] & k["company"]["plain"] & (like | (n_objects == 1))
        return F.struct(F.struct(*[c.alias(n) for n, c in record.items()]).alias("record"), like.alias("job_like"), exact.alias("exact"))

    return with_levels(raw, depth, read).cast(record_type(ddl))


def _objects_of(entry: Column) -> Column:
    """Raw texts of the objects in a list; NULL if it is no list or holds none."""
    kept = F.transform(F.filter(inside(entry["raw"]), is_object), lambda e: e["raw"])
    return F.when(is_list(entry), bound(kept, lambda k: F.when(F.size(k) > 0, k)))


def records_at(raw: Column) -> Column:
    """Record texts that a node lists itself: in its routes' data, in order, else under one of five keys."""

    def of_route(route: Column) -> Column:
        listed = lambda jobs: F.when(is_list(jobs) & (F.size(inside(jobs["raw"])) > 0), F.coalesce(_objects_of(jobs), F.array().cast("array<string>")))
        return F.when(is_object(route), bound(member(members(route["raw"]), "jobs"), listed))

    def of_object(own: Column) -> Column:
        step = lambda entries, key, use: bound(member(entries, key), lambda m: F.when(is_object(m), use(members(m["raw"]))))
        routes = step(own, "state", lambda state: step(state, "loaderData", lambda data: F.transform(data, of_route)))
        by_route = _first(F.filter(routes, lambda r: r.isNotNull()))
        return F.coalesce(by_route, *[bound(member(own, key), _objects_of) for key in records.RECORD_LISTS])

    def of_list(own: Column) -> Column:
        return F.when((F.size(own) > 0) & F.forall(own, is_object), F.transform(own, lambda e: e["raw"]))

    return F.when(raw.startswith("{"), bound(members(raw), of_object)).otherwise(bound(inside(raw), of_list))


# These read the helper columns by name and are the same for every table, so each is built once: building them costs
# more than planning does.


@cache
def _next_level(name: str, i: int, children: Callable[[Column], Column]) -> Column:
    return F.flatten(F.transform(f"{name}{i}", children))


@cache
def _listed_here() -> Column:
    return records_at(F.col("_context"))


@cache
def _listed_below() -> Column:
    return _first(F.filter(F.transform(_all("_list", 1, LIST_DEPTH), lambda n: records_at(n["raw"])), lambda r: r.isNotNull()))


@cache
def _first_with_facts() -> Column:
    return _first(F.filter(_all("_meta", 0, META_DEPTH), lambda n: n["raw"].startswith("{") & _has_facts(members(n["raw"]))))


@cache
def _rows(ddl: str) -> Column:
    return F.transform("_raws", lambda r: canonical(r, ddl))


@cache
def _whole(ddl: str) -> Column:
    return canonical(F.col("_context"), ddl, META_DEPTH)


def _with_levels(pages: DataFrame, name: str, raw: Column, depth: int, children: Callable[[Column], Column] = below) -> DataFrame:
    """Add the nodes by depth as columns ``name0``, ``name1``, … A column each keeps the expressions flat."""
    pages = pages.withColumn(f"{name}0", F.when(raw.isNotNull(), top(raw)))
    for i in range(depth):
        pages = pages.withColumn(f"{name}{i + 1}", _next_level(name, i, children))
    return pages


def _all(name: str, first: int, depth: int) -> Column:
    return in_order([F.col(f"{name}{i}") for i in range(first, depth + 1)])


def with_job_records(pages: DataFrame) -> DataFrame:
    """Add ``_raws``, the record texts of the first list of records anywhere in ``_context``, and ``_listed``, whether that is exact."""
    pages = pages.withColumn("_here", _listed_here())
    # Only where the context has none itself is it searched.
    pages = _with_levels(pages, "_list", F.when(F.col("_here").isNull(), F.col("_context")), LIST_DEPTH)
    return pages.withColumns({"_raws": F.coalesce("_here", _listed_below()), "_listed": F.coalesce(F.size(f"_list{LIST_DEPTH}") <= 0, F.lit(True))})


def _has_facts(entries: Column) -> Column:
    return F.exists(entries, lambda e: F.coalesce(e["key"].isin(*records.META), F.lit(False)))


def _may_name_facts(raw: Column) -> Column:
    """A text that names none of the facts holds none; an escape could hide a name."""
    return raw.rlike(f'"({FACTS})"') | raw.contains("\\u")


def _meta_children(node: Column) -> Column:
    """Where to look for pagination facts in an object without any: in its ``meta`` object alone, if it has one."""

    def of(own: Column) -> Column:
        lone = F.exists(own, lambda e: F.coalesce(e["key"] == "meta", F.lit(False)) & is_object(e))
        looked = F.when(lone, F.filter(own, lambda e: e["key"] == "meta")).otherwise(own)
        # Only what names a fact can hold one.
        deeper = F.filter(looked, lambda e: _may_name_facts(e["raw"]))
        return F.when(~_has_facts(own), containers(deeper, node["path"])).otherwise(F.array().cast(NODES))

    return bound(inside(node["raw"]), of)


def with_page_meta(pages: DataFrame) -> DataFrame:
    """Add ``_meta``, the text of the first object of ``_context`` with pagination facts, and ``_met``, whether that is exact."""
    pages = _with_levels(pages, "_meta", F.when(_may_name_facts(F.col("_context")), F.col("_context")), META_DEPTH, _meta_children)
    pages = pages.withColumn("_hit", _first_with_facts())
    # What lies too deep could come first only if it stands first.
    unread = F.filter(_next_level("_meta", META_DEPTH, _meta_children), lambda n: F.col("_hit").isNull() | (n["path"] < F.col("_hit.path")))
    return pages.withColumns({"_meta": F.col("_hit.raw"), "_met": F.coalesce(F.size(unread) <= 0, F.lit(True))})


def with_listing_records(pages: DataFrame, candidates: Column, ddl: str) -> DataFrame:
    """Add ``_known``: (records, meta, exact) of a page's contexts; not exact where the walk has to read the page."""
    out = with_page_meta(with_job_records(_with_context(pages, candidates)))
    out = out.withColumn("_rows", _rows(ddl))
    rows_exact = F.coalesce(F.forall("_rows", lambda r: r["exact"]), F.lit(True))
    own = F.transform("_rows", lambda r: r["record"])
    return _known(out, pages.columns, own, F.col("_meta"), F.col("_listed") & F.col("_met") & rows_exact, ddl)


def with_detail_record(pages: DataFrame, candidates: Column, ddl: str) -> DataFrame:
    """Add ``_known``: (records, meta, exact) with the one job record of a detail page's contexts, if it has one."""
    out = with_job_records(_with_context(pages, candidates)).withColumn("_rows", _rows(ddl))
    out = out.withColumn("_like", _first(F.filter("_rows", lambda r: r["job_like"]))["record"])
    # The whole context is like a job if any part of it is.
    out = out.withColumn("_whole", F.when(F.col("_like").isNull(), _whole(ddl)))
    chosen = F.coalesce("_like", F.when(F.col("_whole.job_like"), F.col("_whole.record")))
    rows_exact = F.coalesce(F.forall("_rows", lambda r: r["exact"]), F.lit(True))
    return _known(out, pages.columns, F.array_compact(F.array(chosen)), F.lit(None), F.col("_listed") & rows_exact & F.coalesce(F.col("_whole.exact"), F.lit(True)), ddl)


def _with_context(pages: DataFrame, candidates: Column) -> DataFrame:
    """Add ``_contexts``, and as ``_context`` the first if that is one whole object; one that this cannot read may be read by the walk."""
    return pages.withColumn("_contexts", candidates).withColumn("_context", whole_object(_first(F.col("_contexts"))))


def _known(out: DataFrame, columns: list[str], own: Column, meta: Column, exact: Column, ddl: str) -> DataFrame:
    nothing = F.coalesce(F.size("_contexts") <= 0, F.lit(True))
    found = F.struct(
        F.coalesce(own, F.array().cast(f"array<{ddl}>")).alias("records"), meta.cast("string").alias("meta"),
        F.when(F.col("_context").isNull(), nothing).otherwise(exact).alias("exact"),
    )
    return out.withColumn("_known", found.cast(f"struct<records:array<{ddl}>,meta:string,exact:boolean>")).select(*columns, "_contexts", "_known")
