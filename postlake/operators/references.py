"""Linked objects of page caches, resolved as sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions.payload import kind_of
from postlake.plans.staging import stage

REF, TYPE_NAME = "__ref", "__typename"


def reference(value: Column) -> Column:
    """Key that an object links to: its only member is a text under ``__ref``."""
    target = F.try_variant_get(value, f"$.{REF}", "variant")
    alone = F.size(F.try_variant_get(value, "$", "map<string,variant>")) == 1
    return F.when(alone & (kind_of(target) == "STRING"), target.cast("string"))


def members(value: Column) -> Column:
    """(name, value) of what a container holds; of a link, a scalar or an empty container itself, without a name."""
    entry = lambda name, v: F.struct(name.cast("string").alias("name"), v.alias("value"))
    fields = F.map_filter(F.try_variant_get(value, "$", "map<string,variant>"), lambda k, v: k != TYPE_NAME)
    of_object = F.transform(F.map_entries(fields), lambda e: entry(e["key"], e["value"]))
    of_list = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v, i: entry(i, v))
    itself = F.array(entry(F.lit(None), value))
    empty = lambda text: F.array(entry(F.lit(None), F.parse_json(F.lit(text))))
    held = lambda found, text: F.when(F.size(found) > 0, found).otherwise(empty(text))
    opened = F.when(of_object.isNotNull(), held(of_object, "{}")).when(of_list.isNotNull(), held(of_list, "[]")).otherwise(itself)
    return F.when(reference(value).isNotNull(), itself).otherwise(opened)


def leaves(objects: DataFrame, keys: list[str], depth: int = 8) -> DataFrame:
    """(*keys, key, path, value, ref) of every value in the objects (*keys, key, value VARIANT): scalars, empty containers, and links.

    ``path`` holds member names and list places; ``__typename`` members are left out. One narrow step a level, no shuffle. An object nested
    deeper than ``depth`` raises an error.
    """
    now = objects.select(*keys, "key", F.array().cast("array<string>").alias("path"), "value")
    for _ in range(depth + 1):
        opened = now.select(*keys, "key", "path", F.explode(members(F.col("value"))).alias("held"))
        path = F.when(F.col("held.name").isNull(), F.col("path")).otherwise(F.concat("path", F.array("held.name")))
        now = opened.select(*keys, "key", path.alias("path"), F.col("held.value").alias("value"))
    told = now.withColumn("ref", reference(F.col("value")))
    left = F.col("ref").isNull() & F.coalesce(F.get(members(F.col("value")), F.lit(0))["name"].isNotNull(), F.lit(False))
    deeper = F.raise_error(F.lit(f"an object is nested deeper than {depth} levels")).cast("string")
    return told.withColumn("ref", F.when(left, deeper).otherwise(F.col("ref")))


def resolve_references(objects: DataFrame, keys: list[str], wanted: Column, depth: int = 8) -> DataFrame:
    """(*keys, key, path, value as JSON text) of the objects where ``wanted`` holds, with all links followed; a link to nothing is NULL.

    ``objects`` holds every object of the caches, (*keys, key, value VARIANT), once. Links are jumped by doubling: each
    round joins the links that are left with the leaves of what they lead to, links of theirs included, so chains
    of n links take about log2(n) rounds of one join by (*keys, key). A chain of over 2**``depth`` links, such as a ring, raises an error.
    """
    flat = stage(leaves(objects, keys).select(*keys, "key", "path", F.to_json("value").alias("value"), "ref"), "leaves")
    for _ in range(depth + 1):
        open_ = flat.filter("ref IS NOT NULL")
        if open_.isEmpty():
            break
        ahead = flat.select(*keys, F.col("key").alias("ref"), F.col("path").alias("further"), F.col("value").alias("held"), F.col("ref").alias("next"))
        known = F.col("further").isNotNull()
        jumped = open_.join(ahead, [*keys, "ref"], "left").select(
            *keys, "key", F.when(known, F.concat("path", "further")).otherwise(F.col("path")).alias("path"),
            F.when(known, F.col("held")).alias("value"), F.when(known, F.col("next")).alias("ref"),
        )
        flat = stage(flat.filter("ref IS NULL").unionByName(jumped), "leaves")
    else:
        raise ValueError(f"links lead on after {2**depth} steps")
    return flat.filter(wanted).select(*keys, "key", "path", "value")
