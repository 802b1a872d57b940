"""The operators bound to the test tables, each with its SQL twin where SQL can say it.

A binding reads whole tables. The boards' own captures are not among the tables, so the board bindings
first derive captures from table rows with Spark (``plans/derived.py``) and then run the board on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import dates, lists, markup, money, payload, text, urls
from postlake.operators.first_seen import first_seen, link_map
from postlake.operators.merge import detail_worklist, fill_tags, merge_sources, more_specific, with_details
from postlake.operators.page_cut import CutRules, cut_runs
from postlake.operators.recency import recent_only
from postlake.plans.boards import BOARDS
from postlake.sources import glints, karirhub, kitalulus, lokerid

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def binding(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utc(column: str) -> F.Column:
    return F.col(column).cast("timestamp")


# Filters, first-seen, joins ----------------------------------------------------------------------


@binding("""
SELECT event_id, user_id, event_type FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-20' - INTERVAL 30 DAY AND TIMESTAMP '2024-01-20'
""")
def recency_filter(spark, sf):
    # Compared in the table's own type, so that the range reaches the Parquet scan.
    rows = table(spark, sf, "events").withColumn("scraped", F.lit("2024-01-20").cast("timestamp_ntz"))
    return recent_only(rows, "ts", "scraped").select("event_id", "user_id", "event_type")


@binding("""
SELECT user_id, event_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
""")
def first_seen_rows(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return first_seen(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@binding("""
SELECT d.doc_id, coalesce(CASE WHEN d.lang = 'en' THEN NULL ELSE d.lang END, 'q' || l.quality) AS location,
  CASE WHEN 'q' || l.quality IS NOT NULL AND length('q' || l.quality) > length(d.source) THEN 'q' || l.quality ELSE d.source END AS job_type
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def detail_enrich(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("location"), F.col("source").alias("job_type")
    )
    grade = F.concat(F.lit("q"), F.col("quality").cast("string"))
    details = table(spark, sf, "labels").select("doc_id", F.lit(0).alias("fetched_at"), grade.alias("grade"))
    joined = with_details(docs, details, ["doc_id"], ["grade"])
    grade = F.col("detail.grade")
    longer = grade.isNotNull() & (F.length(grade) > F.length("job_type"))
    return joined.select(
        "doc_id", F.coalesce("location", grade).alias("location"), F.when(longer, grade).otherwise(F.col("job_type")).alias("job_type")
    )


@binding("""
SELECT doc_id, source FROM documents d WHERE n_chars > 0 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def detail_worklist_rows(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return detail_worklist(docs, table(spark, sf, "labels"), ["doc_id"], F.col("n_chars") > 0).drop("n_chars")


@binding("""
WITH s AS (
  SELECT s_suppkey + 1450 AS job_id, min(s_suppkey) AS pos, arg_min(s_name, s_suppkey) AS company,
    arg_min(CAST(s_nationkey AS VARCHAR), s_suppkey) AS location FROM supplier GROUP BY s_suppkey + 1450),
c AS (SELECT c_custkey AS job_id, c_custkey AS pos, c_name AS company,
  CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS location FROM customer)
SELECT coalesce(c.job_id, s.job_id) AS job_id, c.job_id IS NULL AS is_fallback, coalesce(c.pos, s.pos) AS pos,
  coalesce(c.company, s.company) AS company, coalesce(c.location, s.location) AS location
FROM c FULL JOIN s ON c.job_id = s.job_id
""")
def merge_sources_rows(spark, sf):
    nation = F.col("c_nationkey").cast("string")
    primary = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("job_id"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("company"),
        F.when(F.col("c_nationkey") % 3 != 0, nation).alias("location"),
    )
    fallback = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1450).alias("job_id"), F.col("s_suppkey").alias("pos"), F.col("s_name").alias("company"),
        F.col("s_nationkey").cast("string").alias("location"),
    )
    return merge_sources(primary, fallback, ["job_id"], ["company", "location"])


@binding("""
WITH p AS (SELECT CAST(l_orderkey AS VARCHAR) AS job_id, CASE WHEN l_linenumber > 3 THEN l_returnflag END AS job_type,
  CASE WHEN l_linenumber > 2 THEN l_linestatus END AS location, l_orderkey * 10 + l_linenumber AS pos FROM lineitem)
SELECT job_id, arg_min(job_type, pos * 1000 + ascii(job_type)) FILTER (WHERE job_type IS NOT NULL) AS job_type,
  arg_min(location, pos * 1000 + ascii(location)) FILTER (WHERE location IS NOT NULL) AS location, min(pos) AS pos, true AS is_fallback
FROM p GROUP BY job_id
""")
def merge_folded_fallback(spark, sf):
    # Many fallback rows per id; the text breaks ties of equal positions.
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("job_id"),
        F.when(F.col("l_linenumber") > 3, F.col("l_returnflag")).alias("job_type"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linestatus")).alias("location"),
        place.alias("place"),
    )
    types = rows.select("job_id", "job_type", F.lit(None).cast("string").alias("location"), (F.col("place") * 1000 + F.coalesce(F.ascii("job_type"), F.lit(0))).alias("pos"))
    places = rows.select("job_id", F.lit(None).cast("string").alias("job_type"), "location", (F.col("place") * 1000 + F.coalesce(F.ascii("location"), F.lit(0))).alias("pos"))
    nobody = rows.select("job_id", F.lit(0).cast("bigint").alias("pos"), "job_type", "location").filter(F.lit(False))
    merged = merge_sources(nobody, types.unionByName(places), ["job_id"], ["job_type", "location"])
    return merged.withColumn("pos", F.floor(F.col("pos") / 1000))


@binding("""
SELECT p.p_partkey,
  CASE WHEN cand IS NOT NULL AND (cur IS NULL OR lower(cur) = 'indonesia'
    OR length(cand) - length(replace(cand, ',', '')) > length(cur) - length(replace(cur, ',', ''))) THEN cand ELSE cur END AS location
FROM (SELECT p_partkey,
  CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Indonesia' WHEN 2 THEN p_brand || ', ' || p_type ELSE p_name END AS cur,
  CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN p_name || ', ' || p_brand ELSE p_type END AS cand FROM part) p
""")
def specific_location(spark, sf):
    key, size = F.col("p_partkey") % 4, F.col("p_size") % 3
    current = (
        F.when(key == 0, None).when(key == 1, "Indonesia").when(key == 2, F.concat_ws(", ", "p_brand", "p_type")).otherwise(F.col("p_name"))
    )
    candidate = F.when(size == 0, None).when(size == 1, F.concat_ws(", ", "p_name", "p_brand")).otherwise(F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", more_specific(current, candidate).alias("location"))


@binding("""
SELECT 'customer' AS source, 'c' || c_custkey AS job_id, c_name AS title, c_mktsegment AS company FROM customer
UNION ALL SELECT 'supplier', 's' || s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'part', 'p' || p_partkey, p_name, p_brand FROM part
""")
def union_sources(spark, sf):
    def source(name, key, title, company):
        return table(spark, sf, name).select(
            F.lit(name).alias("source"), F.concat(F.lit(name[0]), F.col(key)).alias("job_id"), F.col(title).alias("title"),
            F.col(company).cast("string").alias("company"),
        )

    parts = [("customer", "c_custkey", "c_name", "c_mktsegment"), ("supplier", "s_suppkey", "s_name", "s_nationkey"), ("part", "p_partkey", "p_name", "p_brand")]
    first, *rest = [source(*p) for p in parts]
    for other in rest:
        first = first.unionByName(other)
    return first


@binding("""
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'missing job_id' WHEN c_custkey % 5 = 0 THEN 'missing title'
  WHEN c_custkey % 3 = 0 THEN 'missing company' ELSE 'ok' END AS status FROM customer
""")
def rejects(spark, sf):
    from postlake.sources.captures import required

    key = F.col("c_custkey")
    blank = lambda n, c, gap: F.when(key % n == 0, gap).otherwise(c)
    reason = required(
        job_id=blank(7, key.cast("string"), F.lit("")), title=text.clean(blank(5, F.col("c_name"), F.lit("  "))),
        company=blank(3, F.col("c_mktsegment"), F.lit(None).cast("string")),
    )
    return table(spark, sf, "customer").select("c_custkey", F.coalesce(reason, F.lit("ok")).alias("status"))


# Text --------------------------------------------------------------------------------------------


@binding(r"""
SELECT p_partkey, array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(
    regexp_replace(replace(replace(label, '-', ' '), '_', ' '), '([a-z0-9])([A-Z])', '\1 \2', 'g'), ' ') IF w <> ''], ' ') AS label
FROM (SELECT p_partkey, '_' || lower(p_type) || '-' || p_size || upper(p_type) || '__' || replace(p_name, ' ', 'X') || '- ' || p_brand AS label FROM part)
""")
def humanize_labels(spark, sf):
    label = F.concat(
        F.lit("_"), F.lower("p_type"), F.lit("-"), F.col("p_size"), F.upper("p_type"), F.lit("__"),
        F.replace("p_name", F.lit(" "), F.lit("X")), F.lit("- "), F.col("p_brand"),
    )
    return table(spark, sf, "part").select("p_partkey", text.humanize(label).alias("label"))


@binding(r"""
SELECT doc_id, length(t) AS n, md5(t) AS digest FROM (SELECT doc_id,
  nullif(regexp_replace(regexp_replace(text, '^[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', ''), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+$', ''), '') AS t
  FROM (SELECT doc_id, chr(160) || chr(9) || ' ' || text || chr(8195) || chr(10) || chr(31) AS text FROM documents))
""")
def clean_text(spark, sf):
    padded = F.concat(F.lit(" \t "), F.col("text"), F.lit(" \n\x1f"))
    return table(spark, sf, "documents").select("doc_id", text.clean(padded).alias("t")).select(
        "doc_id", F.length("t").cast("bigint").alias("n"), F.md5("t").alias("digest")
    )


@binding(r"""
SELECT p_partkey, 'https://karirhub.kemnaker.go.id/lowongan-dalam-negeri/lowongan/' || lower(replace(p_name, ' ', '-')) || '-' || p_partkey AS karirhub_url,
  'https://dealls.com/loker' || CASE WHEN p_size % 3 = 0 THEN '' ELSE '/' || replace(p_name, ' ', '_') || CASE WHEN p_size % 3 = 1 THEN '~' || p_brand ELSE '' END END AS dealls_url
FROM part
""")
def slug_urls(spark, sf):
    from postlake.sources import dealls

    size = F.col("p_size") % 3
    padded = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit("\t"))
    return table(spark, sf, "part").select(
        "p_partkey",
        karirhub.detail_url(padded, F.col("p_partkey").cast("string")).alias("karirhub_url"),
        dealls.job_url(F.when(size != 0, F.replace("p_name", F.lit(" "), F.lit("_"))), F.when(size == 1, F.col("p_brand"))).alias("dealls_url"),
    )


@binding(r"""
WITH bare AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g') AS t FROM pages),
decoded AS (SELECT page_id, regexp_replace(replace(replace(replace(t, '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM bare),
lines AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '[^\S\n]+', ' ', 'g'), ' *\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS t FROM decoded)
SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS digest, CAST(length(t) - length(replace(t, chr(10), '')) + 1 AS INTEGER) AS n_lines FROM lines
""")
def html_text_lines(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html").select("page_id", text.html_text("html").alias("t"), text.text_lines("html").alias("lines"))
    return pages.select("page_id", F.length("t").alias("n_chars"), F.md5("t").alias("digest"), F.size("lines").alias("n_lines"))


@binding(r"""
SELECT doc_id, count(*) AS n_lines, md5(string_agg(line, chr(10) ORDER BY i)) AS digest FROM (
  SELECT doc_id, i, regexp_replace(regexp_replace(regexp_replace(line, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', ' ', 'g'), '^ ', ''), ' $', '') AS line FROM (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM (
      SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]') AS parts FROM documents)))
WHERE line <> '' GROUP BY doc_id
""")
def html_text_of_fragments(spark, sf):
    # Every line of a document becomes a list item, with its markup characters escaped.
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    html = F.concat(
        F.lit("<style>b{}</style><ul><!-- x --><li>"), F.replace(escaped, F.lit("\n"), F.lit("<br/><script>var t = '<p>';</script></li><li class=\"a>b\">")), F.lit("</li></ul>")
    )
    docs = table(spark, sf, "documents").select("doc_id", "text").select("doc_id", text.html_text(html).alias("t")).filter("t IS NOT NULL")
    return docs.select("doc_id", F.size(F.split("t", "\n")).cast("bigint").alias("n_lines"), F.md5("t").alias("digest"))


@binding(r"""
SELECT conv_id, max(CASE WHEN turn = 1 THEN body END) AS first_reply, max(CASE WHEN turn = 0 THEN body END) AS opening,
  max(turn) AS last_turn FROM (SELECT conv_id, turn, md5(text) AS body FROM conversations) GROUP BY conv_id
""")
def section_lines(spark, sf):
    # The first two turns of a talk as a page of lines, each under its own heading, then an end line; no talk is gathered whole.
    body = lambda turn: F.max(F.when(F.col("turn") == turn, F.md5("text")))
    talks = table(spark, sf, "conversations").groupBy("conv_id").agg(body(0).alias("one"), body(1).alias("two"), F.max("turn").alias("last"))
    turn = lambda n, body: F.when(F.col(body).isNotNull(), F.array(F.lit(f"Turn {n}"), F.col(body))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(turn(0, "one"), turn(1, "two"), F.array(F.lit("End"), F.coalesce("one", "two")))
    talks = talks.select("conv_id", lines.alias("lines"), "last")
    only = lambda a: F.try_element_at(a, F.lit(1))
    return talks.select(
        "conv_id",
        lists.line_after(F.col("lines"), "Turn 1").alias("first_reply"),
        only(lists.section(F.col("lines"), "Turn 0", ["End", "Turn 1"])).alias("opening"),
        F.col("last").cast("bigint").alias("last_turn"),
    )


# Money -------------------------------------------------------------------------------------------


@binding("""
WITH b AS (SELECT p_partkey, CASE WHEN p_partkey % 4 IN (1, 2) THEN CAST(floor(p_retailprice * 1000) AS BIGINT) END AS lo,
  CASE WHEN p_partkey % 4 IN (2, 3) THEN CAST(floor(p_retailprice * 1500) AS BIGINT) END AS hi, p_size % 2 = 1 AS shown,
  CASE p_size % 5 WHEN 0 THEN 'Dirahasiakan' WHEN 1 THEN 'Rp ' || p_size END AS card FROM part),
t AS (SELECT *, format('{:,}', lo) AS l, format('{:,}', hi) AS h FROM b)
SELECT p_partkey,
  CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 'IDR ' || l || ' - ' || h || ' / Month' WHEN lo IS NOT NULL THEN 'From IDR ' || l || ' / Month'
    WHEN hi IS NOT NULL THEN 'Up to IDR ' || h || ' / Month' END AS plain,
  CASE WHEN card IS NOT NULL THEN nullif(card, 'Dirahasiakan') WHEN NOT shown THEN NULL WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 'Rp ' || l || ' - Rp ' || h
    WHEN lo IS NOT NULL THEN 'From Rp ' || l WHEN hi IS NOT NULL THEN 'Up to Rp ' || h END AS shown_only
FROM t
""")
def salary_range(spark, sf):
    key, price = F.col("p_partkey") % 4, F.col("p_retailprice")
    low, high = F.when(key.isin(1, 2), F.floor(price * 1000)), F.when(key.isin(2, 3), F.floor(price * 1500))
    card = F.when(F.col("p_size") % 5 == 0, "Dirahasiakan").when(F.col("p_size") % 5 == 1, F.concat(F.lit("Rp "), F.col("p_size")))
    return table(spark, sf, "part").select("p_partkey", low.alias("lo"), high.alias("hi"), card.alias("card"), (F.col("p_size") % 2 == 1).alias("shown")).select(
        "p_partkey",
        money.span(F.col("lo"), F.col("hi"), F.lit("IDR "), repeat_prefix=False, suffix=F.lit(" / Month")).alias("plain"),
        karirhub.salary(F.col("card"), F.col("shown"), F.col("lo"), F.col("hi")).alias("shown_only"),
    )


@binding(r"""
WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(round(o_totalprice) AS BIGINT) END AS lo,
  CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE CAST(round(o_totalprice * 2) AS BIGINT) END AS hi,
  CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'P' THEN 'Dapat Dinegosiasikan' ELSE o_orderpriority END AS lt,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 < 3 THEN 'Dinegosiasikan' ELSE '9 jt' END AS ht,
  CASE o_orderkey % 6 WHEN 0 THEN '+' || o_custkey WHEN 1 THEN ' ' || o_custkey || ' ' WHEN 2 THEN '1_0' || o_custkey WHEN 3 THEN o_custkey || '.0' WHEN 4 THEN 'x' ELSE '-' || o_custkey END AS num,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'idr' WHEN 2 THEN ' RP ' ELSE lower(o_orderstatus) || 'sd' END AS cur FROM orders),
t AS (SELECT *, format('{:,}', lo) AS l, format('{:,}', hi) AS h FROM b)
SELECT o_orderkey,
  CASE WHEN coalesce(contains(lt, 'Dinegosiasikan') AND contains(ht, 'Dinegosiasikan'), false) THEN NULL
    WHEN lo > 0 AND hi > 0 THEN 'Rp ' || l || ' - Rp ' || h WHEN lo > 0 THEN 'Rp ' || l || '+' WHEN hi > 0 THEN 'Up to Rp ' || h
    WHEN lt IS NOT NULL AND ht IS NOT NULL THEN lt || ' - ' || ht ELSE coalesce(lt, ht) END AS pay,
  CASE WHEN regexp_matches(trim(num), '^[+-]?[0-9]+(_[0-9]+)*$') THEN CAST(replace(trim(num), '_', '') AS BIGINT) END AS whole,
  CASE WHEN cur IS NULL OR upper(trim(cur)) IN ('IDR', 'RP') THEN 'Rp' ELSE upper(trim(cur)) END AS currency
FROM t
""")
def money_plus_and_strings(spark, sf):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    amount = lambda n, c: F.when(key % n == 0, F.lit(0).cast("bigint")).otherwise(F.round(c).cast("bigint"))
    low_text = F.when(F.col("o_orderstatus") == "F", None).when(F.col("o_orderstatus") == "P", "Dapat Dinegosiasikan").otherwise(F.col("o_orderpriority"))
    high_text = F.when(key % 5 == 0, None).when(key % 5 < 3, "Dinegosiasikan").otherwise("9 jt")
    cust = F.col("o_custkey").cast("string")
    shapes = [F.concat(F.lit("+"), cust), F.concat(F.lit(" "), cust, F.lit(" ")), F.concat(F.lit("1_0"), cust), F.concat(cust, F.lit(".0")), F.lit("x"), F.concat(F.lit("-"), cust)]
    number = F.array(*shapes)[(key % 6).cast("int")]
    code = F.when(key % 4 == 0, None).when(key % 4 == 1, "idr").when(key % 4 == 2, " RP ").otherwise(F.concat(F.lower("o_orderstatus"), F.lit("sd")))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority").select(
        key, kitalulus.salary(amount(3, price), amount(4, price * 2), low_text, high_text).alias("pay"),
        money.lenient_int_text(number).alias("whole"), money.currency_label(code).alias("currency"),
    )


# URLs and links ----------------------------------------------------------------------------------

HREFS = r'href="([^"]*)"'


def hrefs(spark: SparkSession, sf: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit(HREFS), F.lit(1))
    return table(spark, sf, "pages").select("page_id", F.posexplode(found).alias("pos", "href"))


SQL_HREFS = """SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)"""


@binding(r"""
SELECT page_id, split_part(url, '?', 1) AS bare, nullif(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '') AS query,
  try_cast(nullif(regexp_extract(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '(?:^|&)page=([0-9]+)(?:&|$)', 1), '') AS INTEGER) AS page_no FROM pages
""")
def url_strip_and_page(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.without_query(url).alias("bare"), urls.query_of(url).alias("query"), F.array_max(urls.page_numbers(F.array(url))).alias("page_no")
    )


@binding(rf"""
WITH h AS ({SQL_HREFS}), r AS (SELECT *, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN href WHEN href LIKE '//%' THEN 'https:' || href
  WHEN href LIKE '/%' THEN 'https://www.loker.id' || href WHEN href LIKE '?%' OR href LIKE '#%' OR href = '' THEN 'https://www.loker.id/cari-lowongan-kerja' || href
  ELSE 'https://www.loker.id/' || href END AS url FROM h)
SELECT page_id, pos, url, coalesce(nullif(regexp_extract(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '(?:^|&)id=([^&]+)', 1), ''),
  nullif(regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '/([0-9]+)\.html$', 1), '')) AS link_id FROM r
""")
def url_resolve(spark, sf):
    rows = hrefs(spark, sf).withColumn("url", urls.resolve(lokerid.LISTING_URL, F.col("href")))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "url", urls.id_from_link(F.col("url")).alias("link_id"))


@binding(f"SELECT page_id, string_split(href, '/')[-1] AS key, arg_max(href, pos) AS href FROM ({SQL_HREFS}) GROUP BY ALL")
def link_map_last_wins(spark, sf):
    rows = hrefs(spark, sf).withColumn("key", F.substring_index("href", "/", -1))
    return link_map(rows, ["page_id", "key"], "href", "pos", last=True)


@binding(f"SELECT page_id, string_split(href, '/')[-1] AS key, arg_min(href, pos) AS href FROM ({SQL_HREFS}) GROUP BY ALL")
def link_map_first_wins(spark, sf):
    rows = hrefs(spark, sf).withColumn("key", F.substring_index("href", "/", -1))
    return link_map(rows, ["page_id", "key"], "href", "pos")


@binding(f"""
WITH m AS (SELECT page_id, href, min(pos) AS pos FROM ({SQL_HREFS}) GROUP BY ALL)
SELECT p.page_id, m.href AS first_link FROM pages p LEFT JOIN m ON m.page_id = p.page_id AND m.pos = 0
""")
def url_map_join(spark, sf):
    firsts = link_map(hrefs(spark, sf).withColumn("key", F.col("href")), ["page_id", "key"], "pos", "pos")
    firsts = firsts.filter("pos = 0").select("page_id", F.col("key").alias("first_link"))
    return table(spark, sf, "pages").select("page_id").join(firsts, "page_id", "left")


@binding(r"""
WITH l AS (SELECT page_id, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS pos FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"?#]*)', 1) AS hrefs FROM pages))
SELECT page_id, regexp_extract(href, '/([^/]*)$', 1) AS key, arg_min(href, pos) AS first_link, arg_max(href, pos) AS last_link FROM l GROUP BY ALL
""")
def page_link_maps(spark, sf):
    """The maps that pages of two boards look links up in: the first of equal keys counts on one, the last on the other."""
    pages = table(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit('href="([^"?#]*)'), F.lit(1)).alias("hrefs"))
    keys = F.transform("hrefs", lambda h: F.regexp_extract(h, "/([^/]*)$", 1))
    maps = pages.select("page_id", lists.map_by(keys, F.col("hrefs")).alias("firsts"), lists.map_by(keys, F.col("hrefs"), last=True).alias("lasts"))
    return maps.select("page_id", F.explode("firsts").alias("key", "first_link"), "lasts").select("page_id", "key", "first_link", F.col("lasts")[F.col("key")].alias("last_link"))


@binding("""
SELECT page_id, len(regexp_extract_all(html, '<a href="', 0)) AS n_links FROM pages
""")
def link_count(spark, sf):
    found = lokerid.page_markup(F.col("html"))["links"]
    return table(spark, sf, "pages").select("page_id", "html").select("page_id", F.size(found).cast("bigint").alias("n_links"))


# Pages and runs ----------------------------------------------------------------------------------


@binding("""
WITH e AS (SELECT event_id // 500 AS run, event_id % 500 // 10 + 1 AS page_no, user_id FROM events),
first AS (SELECT run, user_id, min(page_no) AS page_no FROM e GROUP BY ALL),
new AS (SELECT run, page_no, count(*) AS n FROM first GROUP BY ALL),
pages AS (SELECT p.run, p.page_no, coalesce(n, 0) AS n, lead(p.page_no) OVER (PARTITION BY p.run ORDER BY p.page_no) AS next
  FROM (SELECT DISTINCT run, page_no FROM e) p LEFT JOIN new USING (run, page_no))
SELECT run, coalesce(least(min(page_no) FILTER (WHERE n = 0) - 1, min(page_no) FILTER (WHERE next IS DISTINCT FROM page_no + 1)),
  min(page_no) FILTER (WHERE next IS DISTINCT FROM page_no + 1)) AS last_kept FROM pages GROUP BY run
""")
def page_prefix_cut(spark, sf):
    rows = table(spark, sf, "events").select(
        F.expr("event_id div 500").alias("run"), F.expr("cast(event_id % 500 div 10 + 1 as int)").alias("page_no"), "user_id"
    )
    firsts = rows.groupBy("run", "user_id").agg(F.min("page_no").alias("page_no"))
    new = firsts.groupBy("run", "page_no").agg(F.count(F.lit(1)).alias("new_jobs"))
    pages = rows.select("run", "page_no").distinct().join(new, ["run", "page_no"], "left").withColumn("new_jobs", F.coalesce("new_jobs", F.lit(0)))
    rules = CutRules(F.col("new_jobs") == 0, F.lit(False), F.lit(False), F.max(F.lit(None).cast("int")))
    return cut_runs(pages, ["run"], rules).select("run", F.col("last_kept").cast("bigint").alias("last_kept"))


def _flag_pages(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.expr("event_id div 50").alias("run"), F.expr("cast(event_id % 50 + 1 as int)").alias("page_no"),
        F.when((kind == "error") & (F.col("value") > 20), "rejected").when((kind == "error") & (F.col("value") < 1), "failed").otherwise("ok").alias("outcome"),
        (F.col("value") < 30).alias("has_more"),
        F.when(F.col("user_id") % 2 == 0, (F.col("user_id") % 60).cast("int")).alias("total_pages"),
        F.when(F.col("value") < 40, 1).otherwise(0).alias("recent_jobs"), F.lit(1).alias("new_jobs"),
    )


@binding("""
WITH p AS (SELECT event_id // 50 AS run, event_id % 50 + 1 AS p, value,
  CASE WHEN event_type = 'error' AND value > 20 THEN 'rejected' WHEN event_type = 'error' AND value < 1 THEN 'failed' ELSE 'ok' END AS o,
  value < 30 AS more, CASE WHEN user_id % 2 = 0 THEN user_id % 60 END AS total, value < 40 AS recent FROM events),
r AS (SELECT run, max(p) AS n, max(CASE WHEN p = 1 AND total > 0 THEN total END) AS d_total,
  min(p) FILTER (WHERE o = 'rejected' AND p > 1) AS late, min(p) FILTER (WHERE NOT (o = 'ok' OR (o = 'rejected' AND p > 1))) AS d_bad,
  min(p) FILTER (WHERE o = 'rejected' AND p > 1) AS g_before, min(p) FILTER (WHERE NOT more) AS no_more, min(p) FILTER (WHERE o = 'failed' OR (o <> 'ok' AND p = 1)) AS g_bad,
  min(p) FILTER (WHERE (o <> 'ok' AND p > 1) OR (o = 'ok' AND NOT recent)) AS k_before, min(p) FILTER (WHERE o <> 'ok' AND p = 1) AS k_bad,
  min(p) FILTER (WHERE o = 'ok' AND NOT recent) AS l_before, min(p) FILTER (WHERE o <> 'ok') AS l_bad,
  greatest(arg_min(total, p) FILTER (WHERE total IS NOT NULL), min(p) FILTER (WHERE total IS NOT NULL)) AS l_total FROM p GROUP BY run),
x AS (SELECT *, least(n, coalesce(d_total, 1)) AS d_reach, least(n, no_more) AS g_reach, least(n, no_more, l_total) AS l_reach, 999999 AS far FROM r)
SELECT run, least(d_reach, coalesce(late, far) - 1) AS dealls_kept, CASE WHEN d_bad <= d_reach AND d_bad < coalesce(late, far) THEN d_bad END AS dealls_failed,
  least(g_reach, coalesce(g_before, far) - 1) AS glints_kept, CASE WHEN g_bad <= g_reach AND g_bad < coalesce(g_before, far) THEN g_bad END AS glints_failed,
  least(g_reach, coalesce(k_before, far) - 1) AS kitalulus_kept, CASE WHEN k_bad <= g_reach AND k_bad < coalesce(k_before, far) THEN k_bad END AS kitalulus_failed,
  least(l_reach, coalesce(l_before, far) - 1) AS lokerid_kept, CASE WHEN l_bad <= l_reach AND l_bad < coalesce(l_before, far) THEN l_bad END AS lokerid_failed
FROM x
""")
def page_cut_by_flag(spark, sf):
    pages = _flag_pages(spark, sf)
    out = None
    for name in ("dealls", "glints", "kitalulus", "lokerid"):
        cut = cut_runs(pages, ["run"], BOARDS[name].rules(None)).select(
            "run", F.col("last_kept").cast("bigint").alias(f"{name}_kept"), F.col("failed_on").cast("bigint").alias(f"{name}_failed")
        )
        out = cut if out is None else out.join(cut, "run")
    return out


@binding("SELECT event_type, count(*) AS elements, (count(*) + 19) // 20 AS n_pages FROM events GROUP BY event_type")
def page_estimate(spark, sf):
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("elements"))
    return counts.withColumn("n_pages", kitalulus.page_estimate(F.col("elements")).cast("bigint"))


@binding("""
SELECT event_type AS run_id, event_id // 100 AS page_no, count(*) AS n_jobs FROM events GROUP BY ALL
""")
def run_report_counts(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_type").alias("run_id"), F.expr("event_id div 100").alias("page_no"))
    return rows.groupBy("run_id", "page_no").agg(F.count(F.lit(1)).alias("n_jobs"))


# Dates -------------------------------------------------------------------------------------------

ISO_SQL = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({0}, '%f') = '000000' THEN 'Z' ELSE '.' || strftime({0}, '%f') || 'Z' END"


@binding("SELECT event_id, " + ISO_SQL.format("CASE event_id % 3 WHEN 0 THEN ts WHEN 1 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END") + " AS posted_at FROM events")
def epoch_parse(spark, sf):
    micros = F.unix_micros(utc("ts"))
    unit = F.col("event_id") % 3
    number = F.when(unit == 0, micros).when(unit == 1, F.floor(micros / 1000)).otherwise(F.floor(micros / 1_000_000))
    return table(spark, sf, "events").select("event_id", dates.render_utc(dates.from_epoch(number)).alias("posted_at"))


@binding("SELECT event_id, " + ISO_SQL.format("ts") + " AS rendered, " + ISO_SQL.format("ts - INTERVAL 7 HOUR") + " AS zoned, CAST(NULL AS VARCHAR) AS bad FROM events")
def iso_render(spark, sf):
    shown = F.date_format(utc("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    render = lambda t: dates.render_utc(dates.parse_iso(t))
    return table(spark, sf, "events").select(
        "event_id", render(shown).alias("rendered"), render(F.concat(shown, F.lit("+07:00"))).alias("zoned"), render(F.concat(F.lit(" "), shown)).alias("bad")
    )


@binding("""
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 MINUTE * (o_orderkey % 60) + INTERVAL 1 SECOND * (o_custkey % 60)
  WHEN o_orderkey % 3 = 1 THEN o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) + INTERVAL 1 MINUTE * (o_orderkey % 60) ELSE o_orderdate END, '%Y-%m-%dT%H:%M:%SZ') AS posted_at FROM orders
""")
def common_dates(spark, sf):
    key, day = F.col("o_orderkey"), utc("o_orderdate")
    shapes = ["yyyy-MM-dd", "dd-MM-yyyy", "d/M/yyyy", "d MMM yyyy", "dd MMMM yyyy"]
    date = F.array(*[F.date_format(day, s) for s in shapes])[F.expr("cast(o_orderkey div 3 % 5 as int)")]
    clock = F.format_string("%d:%02d", key % 24, key % 60)
    clock = F.when(key % 3 == 0, F.concat(clock, F.format_string(":%02d", F.col("o_custkey") % 60))).when(key % 3 == 1, clock)
    written = F.concat_ws("  ", F.when(key % 2 == 0, F.upper(date)).otherwise(date), clock)
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate").select(key, dates.render_utc(dates.parse_written(written)).alias("posted_at"))


@binding("SELECT event_id, " + ISO_SQL.format("""make_timestamp(epoch_us(ts) - 1000000 * CASE event_id % 8 WHEN 0 THEN 60 * user_id WHEN 1 THEN 3600 * user_id
  WHEN 2 THEN 86400 * user_id WHEN 3 THEN 604800 * user_id WHEN 4 THEN 2592000 * user_id WHEN 5 THEN 31536000 * user_id WHEN 6 THEN 86400 ELSE 0 END)""") + " AS posted_at FROM events")
def relative_dates(spark, sf):
    n = F.col("user_id").cast("string")
    phrases = ["{} menit lalu", "Posted {}  Hours ago", "{} hari lalu", "{} weeks ago!", "{}bulan lalu", "{} tahun lalu"]
    texts = [F.concat(F.lit(p.split("{}")[0]), n, F.lit(p.split("{}")[1])) for p in phrases] + [F.lit(" Kemarin"), F.lit("hari ini")]
    phrase = F.array(*texts)[(F.col("event_id") % 8).cast("int")]
    return table(spark, sf, "events").select("event_id", "user_id", "ts").select("event_id", dates.render_utc(dates.parse_relative(phrase, utc("ts"))).alias("posted_at"))


# Payloads, labels, tags --------------------------------------------------------------------------


@binding("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS as_text FROM events")
def json_props(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    return rows.select("event_id", payload.int_at(F.col("doc"), "$.k").alias("k"), payload.text_at(F.col("doc"), "$.k").alias("as_text"))


@binding("""
SELECT user_id, string_agg(event_type, ',' ORDER BY ts, event_id) AS tags FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1 GROUP BY user_id
""")
def tags_distinct(spark, sf):
    # Reduced to one row per (user, tag) first: a user's list is as long as the tag set, not the history.
    rows = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    firsts = first_seen(rows, ["user_id", "event_type"], ["ts", "event_id"])
    packed = firsts.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("parts"))
    tags = lists.tag_list(F.transform("parts", lambda p: p["event_type"]))
    return packed.select("user_id", F.array_join(tags, ",").alias("tags"))


@binding("""
SELECT o_orderkey, CASE WHEN p = '' THEN a WHEN a IS NULL OR a = p THEN p ELSE p || ', ' || a END AS job_type, coalesce(a, '-') AS arrangement FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'On Site' WHEN 'F' THEN 'Remote' ELSE 'Half Day' END AS a,
    CASE WHEN o_orderkey % 5 = 0 THEN 'Remote' ELSE upper(split_part(o_orderpriority, '-', 1)) ||
      array_to_string([' ' || upper(w[1]) || lower(w[2:]) FOR w IN string_split(split_part(o_orderpriority, '-', 2), ' ') IF w <> ''], '') END AS p FROM orders)
""")
def job_type_format(spark, sf):
    arrangement = glints.arrangement_label(F.when(F.col("o_orderstatus") == "O", "ONSITE").when(F.col("o_orderstatus") == "F", "REMOTE").otherwise("halfDay"))
    kind = F.when(F.col("o_orderkey") % 5 == 0, "remote").otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey", lists.distinct_join(", ", text.humanize(kind), arrangement).alias("job_type"), F.coalesce(arrangement, F.lit("-")).alias("arrangement")
    )


@binding("""
SELECT c_custkey, concat_ws(', ', n_name, CASE WHEN c_custkey % 2 = 0 THEN r_name END) AS city_first,
  CASE WHEN c_custkey % 4 = 3 THEN 'Remote' ELSE n_name || ', ' || r_name END AS by_level, CASE WHEN c_custkey % 4 = 3 THEN r_name || ', ' || n_name ELSE r_name END AS parts
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def location_format(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = rows.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    remote = F.col("c_custkey") % 4 == 3
    level = lambda n, c: F.struct(F.lit(n).alias("level"), c.alias("name"))
    doc = F.to_json(F.struct(
        F.when(remote, "REMOTE").alias("workArrangementOption"),
        F.struct(F.array(level(3, F.lit("old")), level(2, F.col("r_name")), level(3, F.col("n_name"))).alias("parents")).alias("location"),
    ))
    rows = rows.withColumn("item", glints.resolved(F.try_parse_json(doc), F.lit(None).cast("map<string,variant>")))
    return rows.select(
        "c_custkey",
        lists.distinct_join(", ", F.col("n_name"), F.when(F.col("c_custkey") % 2 == 0, F.col("r_name"))).alias("city_first"),
        glints.location(F.col("item")).alias("by_level"),
        lists.distinct_join(", ", F.col("r_name"), F.when(remote, F.col("n_name")).otherwise(F.col("r_name"))).alias("parts"),
    )


@binding("""
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id, c_name AS title, n_name AS company, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS place,
  c_nationkey AS low, c_custkey % 2 = 0 AS remote FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def alias_lookup(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    flat = F.to_json(F.struct(
        F.lit("").alias("id"), key.alias("jobid"), F.col("c_name").alias("judul"), F.col("n_name").alias("perusahaan"), F.col("c_mktsegment").alias("kota"),
        F.col("c_nationkey").alias("minSalary"), F.when(key % 2 == 0, "Remote").alias("wfh"),
    ))
    deep = F.to_json(F.struct(F.struct(F.array(F.struct(
        F.struct(F.col("n_name").alias("label")).alias("employer"), key.cast("string").alias("lowongan_id"), F.col("c_name").alias("position"),
        F.when(key % 3 != 0, F.col("c_mktsegment")).alias("lokasi"), F.concat(F.lit(" "), F.col("c_nationkey")).alias("salary_from"), (key % 2 == 0).alias("is_remote"),
    )).alias("wrapped")).alias("attributes")))
    context = F.concat(F.lit('{"list":['), F.when((key % 2 == 1) & (key % 3 != 0), flat).otherwise(deep), F.lit("]}"))
    # Few bytes and much work: dealt over the cores, as the packed pages of the board runs are.
    rows = rows.select("c_custkey", F.array(context).alias("context")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    rows = lokerid.with_records(rows, F.col("context"), "script").select("c_custkey", F.col("script.records")[0].alias("r"))
    return rows.select("c_custkey", *[F.col(f"r.{f}").alias(f) for f in ("id", "title", "company", "place")], F.col("r.low").cast("int").alias("low"), "r.remote")


@binding("""
SELECT page_id, pos, href, label FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS pos FROM (
  SELECT page_id, regexp_extract_all(nav, '<li><a href="[^"]*">[^<]*</a>', 0) AS items FROM (SELECT page_id, regexp_extract(html, '<nav>.*?</nav>', 0) AS nav FROM pages))),
  LATERAL (SELECT regexp_extract(item, 'href="([^"]*)"', 1) AS href, regexp_extract(item, '>([^<]*)</a>', 1) AS label)
""")
def card_scan(spark, sf):
    in_nav = markup.within(markup.tag("nav"), markup.child_of(markup.tag("li"), markup.tag("a")))

    def cards(batches):
        import pandas as pd

        for pages in batches:
            rows = [
                (page_id, pos, node.attr("href"), node.text(" "))
                for page_id, html in zip(pages["page_id"], pages["html"])
                for pos, node in enumerate(filter(in_nav, markup.parse(html).walk()))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "href", "label"])

    return table(spark, sf, "pages").select("page_id", "html").mapInPandas(cards, "page_id bigint, pos bigint, href string, label string")
