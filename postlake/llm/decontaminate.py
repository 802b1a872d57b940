"""Benchmark decontamination: exact passages of benchmark items in documents, by a positional inverted index.

Method: count the benchmark's terms over all documents; for every window of an item take its rarest term; store the
documents' postings (term, document, position) of those terms; shift each posting by the term's offset in the
item, which gives the place where the item would start; postings of one item that agree on it fall together.
What is left is compared word by word with the text. All of it is DataFrame work.

The index keeps no postings of terms that are the rarest of no window, as none of them is ever looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import ascii_lower, row_key, table, text_of
from postlake.plans.staging import stage

WINDOW = 10
#: Anchors of a window beyond those a near match needs: so many of its words may have been changed.
SPARE = 2
# Fixed value: what separates words.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def raw_words(text: Column) -> Column:
    """Words before A-Z are lower-cased; the break keeps both cases, so the split is the same."""
    return F.filter(F.split(text, BREAK, -1), lambda w: w != "")


def item_words(benchmark: DataFrame) -> DataFrame:
    """Distinct (item_id, words); items without id or words take no part."""
    words = F.transform(raw_words(text_of()), ascii_lower)
    return benchmark.select("item_id", words.alias("_item")).filter("item_id IS NOT NULL AND size(_item) > 0").distinct()


def window_anchors(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """(term, item_id, _item, offset): the rarest term of each window, once per place in its item.

    A window with a term that no document holds occurs nowhere and has none.
    """
    width = F.least(F.lit(window), F.size("_item"))
    starts = items.select("item_id", "_item", F.explode(F.sequence(F.lit(0), F.size("_item") - width)).alias("_start"))
    places = starts.select("item_id", "_item", "_start", F.explode(F.sequence(F.col("_start"), F.col("_start") + width - 1)).alias("_offset"))
    known = places.withColumn("_term", F.get("_item", F.col("_offset"))).join(counts, "_term", "left")
    rarest = known.groupBy("item_id", "_item", "_start").agg(
        F.min(F.struct("_count", "_term", "_offset")).alias("_best"), F.count_if(F.col("_count").isNull()).alias("_missing")
    )
    return rarest.filter("_missing = 0").select(F.col("_best._term").alias("_term"), "item_id", "_item", F.col("_best._offset").alias("_offset")).distinct()


def near_anchors(items: DataFrame, counts: DataFrame, window: int, per_window: int) -> DataFrame:
    """(term, item_id, _item, offset): the ``per_window`` rarest known places of each window, whole in the documents or not."""
    width = F.least(F.lit(window), F.size("_item"))
    starts = items.select("item_id", "_item", F.explode(F.sequence(F.lit(0), F.size("_item") - width)).alias("_start"))
    places = starts.select("item_id", "_item", "_start", F.explode(F.sequence(F.col("_start"), F.col("_start") + width - 1)).alias("_offset"))
    known = places.withColumn("_term", F.get("_item", F.col("_offset"))).join(counts, "_term")
    rarest = known.groupBy("item_id", "_item", "_start").agg(F.slice(F.array_sort(F.collect_list(F.struct("_count", "_term", "_offset"))), 1, per_window).alias("_best"))
    best = rarest.select("item_id", "_item", F.explode("_best").alias("_best"))
    return best.select(F.col("_best._term").alias("_term"), "item_id", "_item", F.col("_best._offset").alias("_offset")).distinct()


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (_term, _k1, _k2, _pos) of the given terms in all documents."""
    k1, k2 = row_key()
    tokens = docs.select(k1, k2, F.posexplode(raw_words(text_of())).alias("_pos", "_raw"))
    return tokens.select("_k1", "_k2", "_pos", ascii_lower(F.col("_raw")).alias("_term")).join(terms, "_term")


def aligned(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """Offset-adjusted postings, brought together: (document, item, delta) with the matched offsets."""
    shifted = postings.join(anchors, "_term").select("_k1", "_k2", "item_id", "_item", (F.col("_pos") - F.col("_offset")).alias("_delta"), "_offset")
    return shifted.groupBy("_k1", "_k2", "item_id", "_item", "_delta").agg(F.collect_set("_offset").alias("_matched"))


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per_window: int = 0) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The stored postings and the anchors they were chosen for: those of exact windows, and with ``per_window`` those of near ones."""
    items = stage(item_words(benchmark), "items")
    terms = stage(items.select(F.explode("_item").alias("_term")).distinct(), "terms")
    tokens = docs.select(F.explode(F.split(text_of(), BREAK, -1)).alias("_raw"))
    counts = tokens.select(ascii_lower(F.col("_raw")).alias("_term")).join(terms, "_term").groupBy("_term").agg(F.count(F.lit(1)).alias("_count"))
    counted = stage(counts, "counts")
    anchors = stage(window_anchors(items, counted, window), "anchors")
    near = stage(near_anchors(items, counted, window, per_window), "near") if per_window else None
    chosen = anchors.select("_term") if near is None else anchors.select("_term").union(near.select("_term"))
    postings = stage(positional_index(docs, chosen.distinct()), "postings")
    return postings, anchors, near


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: bool = False, slop: int = 3, least: int = 2) -> DataFrame:
    """All columns of ``docs`` plus n_words, hits (word positions), items (item ids), n_hit, n_items and contaminated.

    With ``near`` also near_matches, the matches of ``proximity_matches`` as structs, from the same index.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. A document word inside any
    occurrence of a window is a hit. NULL or wordless texts have no words; items with NULL id or no words
    take no part; items that share an id count once; repeated rows get equal results; NULL doc_ids are kept. Columns of
    the result's names are replaced. No benchmark: nothing is hit.
    """
    postings, anchors, loose = build_index(docs, benchmark, window, least + SPARE if near else 0)
    candidates = aligned(postings, anchors).groupBy("_k1", "_k2").agg(F.collect_list(F.struct("item_id", "_item", "_delta", "_matched")).alias("_found"))
    own = ["n_words", "hits", "items", "n_hit", "n_items", "contaminated"] + (["near_matches"] if near else [])
    kept = docs.drop(*own)
    # The caller's columns go along as one struct, so that no name of theirs meets one used here.
    rows = kept.select(F.struct("*").alias("row"), *row_key()).join(candidates, ["_k1", "_k2"], "left")
    text = text_of("row.text")
    extra = []
    if near:
        close = near_places(postings, loose, slop, least).groupBy("_k1", "_k2").agg(F.array_sort(F.collect_list(F.struct("item_id", "start", "n_anchors"))).alias("near_matches"))
        rows = rows.join(close, ["_k1", "_k2"], "left")
        extra = [F.coalesce("near_matches", F.array().cast(close.schema["near_matches"].dataType)).alias("near_matches")]
    # The variable of a one-element transform: the text is split once, whichever of the columns below are used. A plain column
    # could be copied to where its words are compared, and the text split once for each of them.
    spans = F.transform(F.array(raw_words(text)), lambda words: F.transform("_found", lambda c: verified(words, c, window)))
    checked = rows.withColumn("_spans", F.when(F.col("_found").isNotNull(), F.get(spans, 0)))
    real = F.filter("_spans", lambda s: F.size(s["at"]) > 0)
    hits = F.coalesce(F.array_distinct(F.flatten(F.transform(real, lambda s: s["at"]))), F.array().cast("array<int>"))
    items = F.coalesce(F.array_distinct(F.transform(real, lambda s: s["item_id"])), F.array().cast(T.ArrayType(benchmark.schema["item_id"].dataType)))
    out = checked.select(*[f"row.`{c}`" for c in kept.columns], F.size(raw_words(text)).cast("long").alias("n_words"), hits.alias("hits"), items.alias("items"), *extra)
    return out.select("*", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), (F.size("hits") > 0).alias("contaminated"))


def verified(words: Column, c: Column, window: int) -> Column:
    """Positions of the words inside exact windows of one alignment; none if the rest of the words differ."""
    item, delta = c["_item"], c["_delta"]
    width = F.least(F.lit(window), F.size(item))
    last = F.size(item) - width
    # Only windows around a matched anchor can be whole.
    near = F.array_distinct(F.flatten(F.transform(c["_matched"], lambda o: F.sequence(F.greatest(F.lit(0), o - width + 1), F.least(o, last)))))
    same = F.transform(item, lambda w, i: F.coalesce(ascii_lower(F.get(words, delta + i)) == w, F.lit(False)))
    whole = F.transform(F.array(same), lambda eq: F.filter(near, lambda s: (delta + s >= 0) & F.forall(F.slice(eq, s + 1, width), lambda x: x)))
    at = F.array_distinct(F.flatten(F.transform(F.get(whole, 0), lambda s: F.sequence(delta + s, delta + s + width - 1))))
    return F.struct(c["item_id"].alias("item_id"), at.alias("at"))


def near_places(postings: DataFrame, anchors: DataFrame, slop: int, least: int) -> DataFrame:
    """(_k1, _k2, item_id, start, n_anchors): the alignments with enough near anchors, or all words of an item of fewer."""
    near = aligned(postings, anchors).select("_k1", "_k2", "item_id", "_item", F.floor(F.col("_delta") / (slop + 1)).alias("_band"), "_delta", F.explode("_matched").alias("_offset"))
    both = near.select("*", F.explode(F.array(F.col("_band"), F.col("_band") - 1)).alias("_near"))
    found = both.groupBy("_k1", "_k2", "item_id", "_item", "_near").agg(F.min("_delta").alias("start"), F.count_distinct("_offset").alias("n_anchors"))
    enough = found.filter(F.col("n_anchors") >= F.least(F.lit(least), F.size("_item")))
    return enough.groupBy("_k1", "_k2", "item_id", "start").agg(F.max("n_anchors").alias("n_anchors"))


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = 3, least: int = 2, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, start, n_anchors): places where ``least`` anchors of an item lie within ``slop`` words of one alignment.

    A looser test than the phrase: words between the anchors may differ, be missing or added. Each window of an item has its
    ``least`` + ``SPARE`` rarest words that any document holds as anchors, so a copy of a window with ``SPARE`` words
    changed is still found. An item of fewer than ``least`` words needs all of them. Alignments are
    taken in bands of ``slop`` + 1 places and each band with its successor, so that no near pair is cut apart.
    """
    postings, _, loose = build_index(docs, benchmark, window, least + SPARE)
    return docs.select("doc_id", *row_key()).join(near_places(postings, loose, slop, least), ["_k1", "_k2"]).select("doc_id", "item_id", "start", "n_anchors")


def op6_decontamination(spark, sf_dir):
    out = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    joined = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(joined, 256).alias("items_sha256"), "contaminated")


_SPLIT_SQL = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

#: Hits per document of ``{docs}``: doc_id, n_words, n_hit, n_items, ids. Windows are compared as joined text.
HITS_SQL = f"""
  WITH d AS (SELECT doc_id, {_SPLIT_SQL} AS w FROM {{docs}}),
  b AS (SELECT item_id, {_SPLIT_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
  bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS gram
         FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s) WHERE len(w) > 0),
  sizes AS (SELECT DISTINCT n FROM bw),
  dw AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
  hit AS (SELECT DISTINCT doc_id, item_id, s, n FROM dw JOIN bw USING (n, gram)),
  marks AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
  ids AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(ids, '') AS ids
  FROM d LEFT JOIN marks USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

QUERIES = {"op6_decontamination": op6_decontamination}
SQL = {"op6_decontamination": f"SELECT doc_id, n_words, n_hit, n_items, sha256(ids) AS items_sha256, n_hit > 0 AS contaminated FROM ({HITS_SQL.format(docs='documents')})"}
