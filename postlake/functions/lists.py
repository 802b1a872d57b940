"""Arrays: tags, first-of lists and page-line lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.payload import bound


def empty_texts() -> Column:
    return F.array().cast("array<string>")


def tag_list(*parts: Column) -> Column:
    """Concatenate arrays, drop NULLs, keep the first of equal values in order."""
    return F.array_distinct(F.array_compact(F.concat(*[F.coalesce(p, empty_texts()) for p in parts])))


def index_by(keys: Column) -> Column:
    """Map from each value of an array to the places it stands at, from 0 and in order; NULLs have none.

    Sorted once, so a page of many rows looks up its others without going through all of them in a lambda for each row.
    """
    placed = F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at")))

    def grouped(s: Column) -> Column:
        begins = lambda p, i: F.when((i == 0) | (p["key"] != F.get(s, i - 1)["key"]), i)
        starts = F.array_compact(F.transform(s, begins))
        places = lambda b: lambda i, j: F.transform(F.slice(s, i + 1, F.coalesce(F.get(b, j + 1), F.size(s)) - i), lambda p: p["at"])
        return bound(starts, lambda b: F.map_from_arrays(F.transform(b, lambda i: F.get(s, i)["key"]), F.transform(b, places(b))))

    return bound(F.array_sort(F.filter(placed, lambda p: p["key"].isNotNull())), grouped)


def map_by(keys: Column, values: Column, *, last: bool = False) -> Column:
    """Map from each key to its value, the first of equal keys or the last; NULL keys are left out."""
    pick = -1 if last else 1
    return F.transform_values(index_by(keys), lambda key, at: F.get(values, F.element_at(at, pick)))


def distinct_join(glue: str, *texts: Column) -> Column:
    """Join the non-NULL texts, each once; NULL when none is left."""
    joined = F.concat_ws(glue, F.array_distinct(F.array_compact(F.array(*texts))))
    return F.nullif(joined, F.lit(""))


def line_after(lines: Column, marker: Column | str) -> Column:
    """Line that follows the first line equal to the marker."""
    spot = F.nullif(F.array_position(lines, marker), F.lit(0))
    return F.try_element_at(lines, (spot + 1).cast("int"))


def section(lines: Column, heading: str, stops: Sequence[str]) -> Column:
    """Lines after the heading up to the first stop line; empty without the heading."""
    start = F.nullif(F.array_position(lines, heading), F.lit(0)).cast("int")
    tail = F.slice(lines, start + 1, F.size(lines))
    ends = F.array_compact(F.array(*[F.nullif(F.array_position(tail, s), F.lit(0)) for s in stops]))
    length = F.coalesce(F.array_min(ends) - 1, F.size(tail)).cast("int")
    return F.coalesce(F.slice(tail, 1, length), empty_texts())
