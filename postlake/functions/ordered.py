"""JSON texts read in written order, as Columns.

VARIANT sorts the keys of an object; a map read from the text keeps them as written. So an object is read twice, for
the raw text of each member in order and for its typed value. A node is a container (object or list) with its
path of member numbers from the top; arrays compare number by number, so the order of paths is the order of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.payload import bound

NODES = "array<struct<path:array<int>,raw:string>>"


def members(raw: Column) -> Column:
    """Members of an object text as written: key, raw text (a string without its quotes), typed value."""
    texts, values = F.from_json(raw, "map<string,string>"), F.from_json(raw, "map<string,variant>")
    entry = lambda text, value: F.struct(text["key"].alias("key"), text["value"].alias("raw"), value.alias("value"))
    return F.zip_with(F.map_entries(texts), F.map_values(values), entry)


def elements(raw: Column) -> Column:
    """Elements of a list text, without keys."""
    entry = lambda text, value: F.struct(F.lit(None).cast("string").alias("key"), text.alias("raw"), value.alias("value"))
    return F.zip_with(F.from_json(raw, "array<string>"), F.from_json(raw, "array<variant>"), entry)


def is_object(entry: Column) -> Column:
    # Only a string could look like one in its raw text and be none.
    return _starts(entry, "{")


def is_list(entry: Column) -> Column:
    return _starts(entry, "[")


def _starts(entry: Column, mark: str) -> Column:
    raw, value = entry["raw"], entry["value"]
    return F.when(F.coalesce(raw.startswith(mark), F.lit(False)), F.to_json(value).startswith(mark)).otherwise(False)


def member(entries: Column, key: str) -> Column:
    """The entry under a key, or NULL."""
    return F.get(F.filter(entries, lambda e: e["key"] == key), F.lit(0))


def inside(raw: Column) -> Column:
    return F.when(raw.startswith("{"), members(raw)).otherwise(elements(raw))


def containers(entries: Column, path: Column) -> Column:
    """Nodes among the entries of the container at ``path``."""
    placed = F.transform(entries, lambda e, i: F.struct(e.alias("e"), F.concat(path, F.array(i)).alias("path")))
    kept = F.filter(placed, lambda p: is_object(p["e"]) | is_list(p["e"]))
    return F.transform(kept, lambda p: F.struct(p["path"].alias("path"), p["e"]["raw"].alias("raw")))


def below(node: Column) -> Column:
    """What a container holds; one without another opening bracket in its text holds none and is not read."""
    flat = ~F.substring(node["raw"], 2, 2**31 - 1).rlike(r"[\[{]")
    return F.when(flat, F.array().cast(NODES)).otherwise(containers(inside(node["raw"]), node["path"]))


def top(raw: Column) -> Column:
    return F.array(F.struct(F.array().cast("array<int>").alias("path"), raw.alias("raw"))).cast(NODES)


def with_levels(raw: Column, depth: int, use: Callable[[list[Column]], Column], children: Callable[[Column], Column] = below) -> Column:
    """``use`` of the nodes by depth: the text itself, what it holds, and so on; each level is computed once."""

    def deeper(levels: list[Column], left: int) -> Column:
        if not left:
            return use(levels)
        return bound(F.flatten(F.transform(levels[-1], children)), lambda level: deeper([*levels, level], left - 1))

    return bound(top(raw), lambda level: deeper([level], depth))


def in_order(levels: list[Column]) -> Column:
    """The nodes of all levels as they stand in the text: parents first."""
    return F.array_sort(F.concat(*levels))


def whole_object(text: Column) -> Column:
    """The text if it is one JSON object and nothing else, without repeated keys; otherwise NULL."""
    inside_list = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_variant_get(inside_list, "$", "array<variant>")
    is_one = (F.size(alone) == 1) & F.to_json(F.get(alone, F.lit(0))).startswith("{")
    return F.when(F.coalesce(is_one, F.lit(False)), F.trim(text, F.lit(" \t\r\n")))
