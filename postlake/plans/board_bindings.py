"""Whole board runs on derived captures, each with its SQL twin over the source table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.references import resolve_references
from postlake.plans import derived
from postlake.plans.bindings import ISO_SQL, SQL, binding, table
from postlake.plans.run import run, run_all
from postlake.plans.staging import shared_folder, stage
from postlake.sources.captures import read_captures, save_captures, write_captures
from postlake.sources.schema import JOB_COLS
from postlake.sources.snapshot import read_snapshot, write_snapshot
from postlake.streaming.bounded import first_postings, item_stream, land, read_landed, read_postings, write_postings
from postlake.streaming.ingest import first_seen_stream, posting_stream, read_capture_stream, write_stream

ALL = {"scraped_at": derived.CLOCK, "max_pages": None}
DAY_TEXT = "strftime(make_timestamp((1773662400 - {0} * 86400) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def shown(jobs: DataFrame) -> DataFrame:
    """Posting columns with tags as text; the clock column is the same everywhere."""
    columns = [F.array_join("tags", "|").alias("tags") if c == "tags" else F.col(c) for c in JOB_COLS if c != "scraped_at"]
    return jobs.select("run_id", *columns)


KARIRHUB_ITEMS = """i AS (SELECT o_orderkey AS k, o_orderkey // 2000 AS run, o_orderkey % 2000 // 20 + 1 AS page, 'c' || o_custkey AS id, o_orderpriority AS title,
  o_orderstatus AS st, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS lo, format('{:,}', CAST(floor(o_totalprice * 2) AS BIGINT)) AS hi, o_custkey AS cust FROM orders),
ok AS (SELECT * FROM i WHERE k % 50 <> 0 AND k % 37 <= 30),
new AS (SELECT run, page, count(*) AS n FROM (SELECT run, id, min(page) AS page FROM ok GROUP BY ALL) GROUP BY ALL),
stop AS (SELECT p.run, min(p.page) AS stop FROM (SELECT DISTINCT run, page FROM i) p LEFT JOIN new USING (run, page) WHERE n IS NULL GROUP BY p.run),
kept AS (SELECT *, row_number() OVER (PARTITION BY run, id ORDER BY k) AS rn FROM ok LEFT JOIN stop USING (run) WHERE page < coalesce(stop, 999999))"""


@binding(f"""
WITH {KARIRHUB_ITEMS},
det AS (SELECT run, id, min(k) AS dk FROM i WHERE st = 'P' GROUP BY ALL)
SELECT 'r' || run AS run_id, id AS job_id, title, 'PT ' || st AS company,
  CASE WHEN dk IS NOT NULL THEN 'Bandung, Jawa Barat' WHEN st <> 'P' THEN 'Kota ' || cust % 10 END AS location,
  CASE WHEN dk IS NOT NULL THEN 'Kontrak' END AS job_type,
  CASE WHEN st = 'O' AND k % 3 = 0 THEN 'Rp ' || lo || ' - Rp ' || hi WHEN st = 'O' THEN 'From Rp ' || lo WHEN dk IS NOT NULL THEN 'Rp 7' END AS salary_range,
  'https://karirhub.kemnaker.go.id/lowongan-dalam-negeri/lowongan/' || lower(replace(title, ' ', '-')) || '-' || id AS url,
  CASE WHEN dk IS NOT NULL THEN 'Deskripsi Pekerjaan' || chr(10) || 'Isi ' || dk || chr(10) || chr(10) || 'Keterampilan' || chr(10) || 'A' || chr(10) || 'B' || chr(10) || 'A' END AS description,
  CASE WHEN dk IS NOT NULL THEN 'A|B' ELSE title || '|kerja' END AS tags, {DAY_TEXT.format("(k % 37)")} AS posted_at
FROM kept LEFT JOIN det USING (run, id) WHERE rn = 1
""")
def karirhub_run(spark, sf):
    return shown(run(derived.karirhub(spark, sf), "karirhub", fetch_details=True, **ALL).jobs)


@binding(f"""
WITH {KARIRHUB_ITEMS}, det AS (SELECT DISTINCT run, id FROM i WHERE st = 'P')
SELECT 'r' || run AS run_id, id AS job_id FROM kept WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM det WHERE det.run = kept.run AND det.id = kept.id)
""")
def karirhub_worklist(spark, sf):
    return run(derived.karirhub(spark, sf), "karirhub", fetch_details=True, **ALL).worklist.select("run_id", "job_id")


@binding(f"""
WITH {KARIRHUB_ITEMS}
SELECT 'r' || run AS run_id, CAST(max(coalesce(stop - 1, top)) AS BIGINT) AS last_kept, count(*) FILTER (WHERE rn = 1) AS jobs
FROM kept JOIN (SELECT run, max(page) AS top FROM i GROUP BY run) USING (run) GROUP BY run
""")
def karirhub_run_report(spark, sf):
    report = run(derived.karirhub(spark, sf), "karirhub", **ALL).runs
    return report.select("run_id", F.col("last_kept").cast("bigint").alias("last_kept"), "jobs")


REJECTS_SQL = """
WITH i AS (SELECT o_orderkey AS k, o_orderkey // 2000 AS run, o_orderkey % 2000 // 20 + 1 AS page FROM orders)
SELECT 'r' || run AS run_id, page AS page_no, 'not an object' AS reject, count(DISTINCT page) AS n FROM i GROUP BY ALL
UNION ALL SELECT 'r' || run, page, 'missing company', count(*) FROM i WHERE k % 50 = 0 GROUP BY ALL
"""


@binding(REJECTS_SQL)
def karirhub_rejects(spark, sf):
    return _reject_counts(run(derived.karirhub(spark, sf), "karirhub", **ALL).rejects)


def _reject_counts(rejects: DataFrame) -> DataFrame:
    counts = rejects.groupBy("run_id", "page_no", "reject").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("page_no", F.col("page_no").cast("bigint"))


@binding("""
WITH i AS (SELECT p_partkey AS k, p_partkey // 400 AS run, p_partkey % 400 // 20 + 1 AS page, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size,
  CASE WHEN p_size % 4 <> 0 THEN CAST(floor(p_retailprice) AS BIGINT) ELSE 0 END AS lo, CASE WHEN p_size % 4 > 1 THEN CAST(floor(p_retailprice) AS BIGINT) * 2 ELSE 0 END AS hi,
  make_timestamp((1773662400 - p_partkey % 37 * 86400) * 1000000 + p_partkey) AS ts FROM part)
SELECT 'r' || run AS run_id, 'K' || k AS job_id, name AS title, brand AS company, CASE WHEN size % 2 = 0 THEN kind || ', ' ELSE '' END || 'DKI Jakarta' AS location,
  CASE WHEN size % 3 = 0 THEN 'Penuh Waktu' ELSE 'Part Time' END AS job_type,
  CASE WHEN size % 5 = 0 THEN NULL WHEN lo > 0 AND hi > 0 THEN 'Rp ' || format('{:,}', lo) || ' - Rp ' || format('{:,}', hi) WHEN lo > 0 THEN 'Rp ' || format('{:,}', lo) || '+'
    ELSE 'Dapat Dinegosiasikan - 9 jt' END AS salary_range,
  'https://www.kitalulus.com/lowongan/detail/' || replace(name, ' ', '-') AS url,
  CASE WHEN size % 2 = 1 THEN 'Tugas & peran:' || chr(10) || name || chr(10) || 'No. ' || k ELSE 'Usia ' || size END AS description,
  kind || '|' || brand || CASE WHEN size % 7 = 0 THEN '|S1' ELSE '' END AS tags, """ + ISO_SQL.format("ts") + """ AS posted_at
FROM i WHERE k % 60 <> 0 AND k % 37 BETWEEN 1 AND 30 AND page <= 17
""")
def kitalulus_run(spark, sf):
    return shown(run(derived.kitalulus(spark, sf), "kitalulus", **ALL).jobs)


@binding(f"""
WITH i AS (SELECT c_custkey AS k, c_custkey // 300 AS run, c_custkey % 300 // 15 + 1 AS page, c_name AS name, c_mktsegment AS seg, c_nationkey AS n, CAST(floor(c_acctbal) AS BIGINT) AS pay,
  CASE WHEN c_custkey % 5 < 2 THEN 'Remote' WHEN c_custkey % 5 < 4 THEN 'On Site' END AS place, c_mktsegment <> 'BUILDING' AS det FROM customer),
f AS (SELECT *, CASE WHEN n % 4 <> 0 THEN 'City ' || n END AS city, CASE WHEN n % 8 <> 0 THEN 'City ' || (n - n % 2) END AS country,
  CASE WHEN k % 2 = 0 THEN format('{{:,}}', pay) END AS lo, CASE WHEN k % 6 < 3 THEN format('{{:,}}', pay + 1000) END AS hi FROM i)
SELECT 'r' || run AS run_id, 'd' || k AS job_id, name AS title, CASE WHEN k % 3 <> 0 THEN 'Co ' || n ELSE 'Author ' || n END AS company,
  coalesce(CASE WHEN city = country THEN city ELSE nullif(concat_ws(', ', city, country), '') END, CASE WHEN place = 'Remote' THEN place END, CASE WHEN det THEN 'Place ' || n END) AS location,
  CASE WHEN k % 4 < 2 THEN 'Full Time, Contract Based' ELSE coalesce(place, CASE WHEN det THEN 'Internship' END) END AS job_type,
  CASE WHEN k % 11 = 0 THEN 'Unpaid' WHEN lo IS NOT NULL AND hi IS NOT NULL THEN 'IDR ' || lo || ' - ' || hi WHEN lo IS NOT NULL THEN 'From IDR ' || lo
    WHEN hi IS NOT NULL THEN 'Up to IDR ' || hi WHEN det THEN 'From IDR 5' END AS salary_range,
  'https://dealls.com/loker/' || CASE WHEN k % 2 = 0 THEN lower(seg) ELSE seg END || CASE WHEN k % 3 <> 0 THEN '~co-' || n ELSE '' END AS url,
  CASE WHEN det THEN 'About ' || seg || CASE WHEN k % 4 = 0 THEN chr(10) || chr(10) || 'Responsibilities' || chr(10) || 'Lead.' || chr(10) || 'Care more.' ELSE '' END END AS description,
  concat_ws('|', place, seg) AS tags, {DAY_TEXT.format("(k % 37)")} AS posted_at
FROM f WHERE k % 45 <> 0 AND k % 37 <= 30 AND page <= CASE WHEN run % 2 = 1 THEN 15 ELSE 18 END
""")
def dealls_run(spark, sf):
    return shown(run(derived.dealls(spark, sf), "dealls", fetch_details=True, **ALL).jobs)


GLINTS_SQL = f"""
WITH i AS (SELECT p_partkey AS k, p_partkey // 500 AS run, p_partkey % 500 // 10 + 1 AS page, 'ab-' || p_partkey % 300 AS id, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size,
  format('{{:,}}', CAST(floor(p_retailprice) AS BIGINT)) AS lo, format('{{:,}}', CAST(floor(p_retailprice * 2) AS BIGINT)) AS hi,
  CASE WHEN p_size % 2 = 0 THEN 'On Site' WHEN p_size % 5 = 0 THEN 'Remote' END AS arr FROM part),
f AS (SELECT *, row_number() OVER (PARTITION BY run, id ORDER BY k) AS rn FROM i WHERE k % 37 <= 30 AND page <= 43)
SELECT 'r' || run AS run_id, id AS job_id, name AS title, brand AS company, CASE WHEN arr = 'Remote' THEN arr WHEN size % 4 <> 0 THEN brand || ', ' || kind END AS location,
  nullif(concat_ws(', ', CASE WHEN size % 3 <> 0 THEN 'Full Time' END, arr), '') AS job_type,
  CASE WHEN size % 2 = 0 THEN 'IDR ' || lo || ' - ' || hi ELSE 'From IDR ' || lo END || ' / Month' AS salary_range,
  'https://glints.com/id/opportunities/jobs/p' || k || '/' || id AS url, CAST(NULL AS VARCHAR) AS description, coalesce(arr, kind) AS tags, {DAY_TEXT.format("(k % 37)")} AS posted_at
FROM f WHERE rn = 1
"""


@binding(GLINTS_SQL)
def glints_run(spark, sf):
    return shown(run(derived.glints(spark, sf), "glints", **ALL).jobs)


@binding(GLINTS_SQL.replace("page <= 43", "page <= 43 AND (run % 2 = 0 OR page < 20) AND run % 4 <> 2"))
def glints_gated_run(spark, sf):
    """Page 20 of odd runs asks for a login, which ends them; page 30 of every fourth run is lost, which fails it."""
    page, number = F.col("page_no"), F.regexp_extract("run_id", "[0-9]+", 0).cast("int")
    gated, lost = (page == 20) & (number % 2 == 1), (page == 30) & (number % 4 == 2)
    captures = derived.glints(spark, sf).withColumns({
        "body": F.when(gated, "<!DOCTYPE html><html><body>Masuk</body></html>").when(~lost, F.col("body")),
        "body_text": F.when(gated, "Halo. Login untuk lihat loker lebih banyak!"), "error": F.when(lost, "timeout"),
    })
    return shown(run(captures, "glints", **ALL).jobs)


@binding("""
WITH i AS (SELECT p_partkey // 400 AS run, p_partkey % 400 // 20 + 1 AS page, count(*) AS n FROM part GROUP BY ALL)
SELECT 'r' || run AS run_id, page AS page_no, ['ok', 'bad_status', 'bad_json', 'api_errors', 'no_list', 'failed'][page % 6 + 1] AS outcome, CASE WHEN page % 6 = 0 THEN n ELSE 0 END AS items FROM i
""")
def kitalulus_outcomes(spark, sf):
    """The four answers that are no list, and no answer at all."""
    kind = F.col("page_no") % 6
    answers = {2: "{half an answer", 3: '{"errors":[{"message":"no"}],"data":{"vacanciesV3":{"list":[]}}}', 4: '{"data":{}}'}
    body = F.when(kind == 5, F.lit(None).cast("string"))
    for k, text in answers.items():
        body = body.when(kind == k, text)
    captures = derived.kitalulus(spark, sf).withColumns({"body": body.otherwise(F.col("body")), "status_code": F.when(kind == 1, 503).otherwise(200), "error": F.when(kind == 5, "timeout")})
    pages = run(captures, "kitalulus", **ALL).pages
    return pages.select("run_id", F.col("page_no").cast("bigint").alias("page_no"), "outcome", "items")


LOKERID_SQL = f"""
WITH i AS (SELECT c_custkey AS k, c_custkey // 300 AS run, c_custkey % 300 // 15 + 1 AS page, c_name AS name, c_mktsegment AS seg, c_nationkey AS n,
  format('{{:,}}', CAST(floor(c_acctbal) AS BIGINT)) AS pay, CASE WHEN c_custkey % 6 = 0 THEN 'USD ' ELSE 'Rp ' END AS cur FROM customer WHERE c_custkey % 300 // 15 + 1 <= 18)
SELECT 'r' || run AS run_id, 'q' || k AS job_id, name AS title, 'PT ' || n AS company, CASE WHEN k % 2 = 0 THEN 'Kota ' || n WHEN k % 7 = 0 THEN 'Remote' ELSE 'Card Town' END AS location,
  CASE WHEN k % 3 <> 1 THEN 'Full Time' ELSE 'Card Type' END AS job_type, CASE WHEN k % 2 = 0 THEN cur || pay || ' - ' || cur || pay ELSE 'From ' || cur || pay END AS salary_range,
  'https://www.loker.id/' || CASE WHEN k % 5 < 2 THEN lower(seg) || '/kerja-' || k || '.html' WHEN k % 10 = 2 THEN 'baru/kerja-' || k || '.html' WHEN k % 5 = 2 THEN 'kerja-' || k || '.html' ELSE 'cari-lowongan-kerja?jobid=q' || k END AS url, CAST(NULL AS VARCHAR) AS description,
  seg || '|x' || CASE WHEN k % 7 = 0 THEN '|Remote' ELSE '' END AS tags, {DAY_TEXT.format("(k % 37)")} AS posted_at FROM i WHERE k % 37 <= 30
UNION ALL SELECT 'r' || run, 'q' || k, name, 'Card Co', 'Card Town', 'Card Type', NULL, 'https://www.loker.id/c/' || k || '.html', NULL, '', '2026-03-16T00:00:00Z' FROM i WHERE k % 4 = 3 AND k % 37 = 36
UNION ALL SELECT DISTINCT 'r' || run, 'x' || run || '-' || page, 'Only here', 'Card Co', NULL, NULL, NULL, 'https://www.loker.id/c/extra.html', NULL, 'T', '2026-03-15T00:00:00Z' FROM i
"""


@binding(LOKERID_SQL)
def lokerid_run(spark, sf):
    return shown(run(derived.lokerid(spark, sf), "lokerid", **ALL).jobs)


def _glints_detail_sql(with_text: bool) -> str:
    need = "true" if with_text else "(location IS NULL OR job_type IS NULL)"
    return f"""
WITH base AS ({GLINTS_SQL}),
p AS (SELECT 'r' || (p_partkey // 500) AS run_id, 'ab-' || p_partkey % 300 AS job_id, p_partkey AS k, p_brand AS brand, p_type AS kind, p_name AS name FROM part WHERE p_partkey % 3 <> 0),
d AS (SELECT p.* FROM p JOIN (SELECT run_id, job_id, min(k) AS k FROM p GROUP BY ALL) USING (run_id, job_id, k)),
j AS (SELECT base.*, d.k IS NOT NULL AND {need} AS a, d.brand, d.kind, d.name FROM base LEFT JOIN d USING (run_id, job_id))
SELECT run_id, job_id, title, company, CASE WHEN a AND (location IS NULL OR location NOT LIKE '%,%') THEN 'Kota ' || brand || ', ' || kind ELSE location END AS location,
  CASE WHEN a AND (job_type IS NULL OR length(job_type) < length('Contract, Hybrid')) THEN 'Contract, Hybrid' ELSE job_type END AS job_type, salary_range, url,
  CASE WHEN a AND {with_text} THEN 'Tugas ' || name || chr(10) || 'Baris dua' END AS description, CASE WHEN a THEN 'Hybrid|S1|S2' ELSE tags END AS tags, posted_at FROM j
"""


def _glints_with_details(spark, sf, with_text: bool):
    captures = derived.glints(spark, sf).unionByName(derived.glints_details(spark, sf))
    return shown(run(captures, "glints", fetch_details=with_text, **ALL).jobs)


@binding(_glints_detail_sql(True))
def glints_detail_run(spark, sf):
    return _glints_with_details(spark, sf, True)


@binding(_glints_detail_sql(False))
def glints_detail_gaps_run(spark, sf):
    """Without asking for texts, only postings without place or kind take their detail page."""
    return _glints_with_details(spark, sf, False)


def _lokerid_detail_sql(with_text: bool) -> str:
    return f"""
WITH base AS ({LOKERID_SQL}), j AS (SELECT *, CASE WHEN job_id LIKE 'x%' THEN CAST(split_part(job_id, '-', 2) AS INTEGER) % 3 END AS shape FROM base)
SELECT run_id, job_id, title, company, coalesce(location, CASE shape WHEN 1 THEN 'Kota D' WHEN 0 THEN 'Kota C' END) AS location, coalesce(job_type, CASE WHEN shape = 1 THEN 'Contract' END) AS job_type,
  coalesce(salary_range, CASE WHEN shape = 1 THEN 'Rp 6 - Rp 9' END) AS salary_range, url,
  CASE WHEN NOT {with_text} THEN NULL WHEN shape = 1 THEN 'Isi satu.' || chr(10) || 'Isi dua.' WHEN shape = 2 THEN 'Kualifikasi' || chr(10) || rtrim(repeat('rajin dan teliti ', 8)) END AS description, tags, posted_at FROM j
"""


def _lokerid_with_details(spark, sf, with_text: bool):
    captures = derived.lokerid(spark, sf).unionByName(derived.lokerid_details(spark, sf))
    return shown(run(captures, "lokerid", fetch_details=with_text, **ALL).jobs)


@binding(_lokerid_detail_sql(True))
def lokerid_detail_run(spark, sf):
    return _lokerid_with_details(spark, sf, True)


@binding(_lokerid_detail_sql(False))
def lokerid_detail_gaps_run(spark, sf):
    return _lokerid_with_details(spark, sf, False)


@binding("""
SELECT 'kitalulus' AS source, count(*) AS jobs FROM part WHERE p_partkey % 60 <> 0 AND p_partkey % 37 BETWEEN 1 AND 30 AND p_partkey % 400 // 20 < 3
UNION ALL SELECT 'dealls', count(*) FROM customer WHERE c_custkey % 45 <> 0 AND c_custkey % 37 <= 30 AND c_custkey % 300 // 15 < 3
""")
def run_all_first_pages(spark, sf):
    captures = derived.kitalulus(spark, sf).unionByName(derived.dealls(spark, sf))
    jobs = run_all(captures, ["kitalulus", "dealls"], scraped_at=derived.CLOCK, max_pages=3)
    return jobs.groupBy("source").agg(F.count(F.lit(1)).alias("jobs"))


@binding(" UNION ALL ".join(f"SELECT '{name}' AS source, * FROM ({SQL[f'{name}_run']})" for name in ("karirhub", "kitalulus", "dealls", "glints", "lokerid")))
def run_all_boards(spark, sf):
    """Captures of all boards in one table, every board run to its end, whole postings compared."""
    parts = [derived.karirhub, derived.kitalulus, derived.dealls, derived.glints, derived.lokerid]
    captures = reduce(DataFrame.unionByName, [part(spark, sf) for part in parts])
    jobs = run_all(captures, fetch_details=True, **ALL)
    return shown(jobs.withColumn("run_id", F.struct("source", "run_id"))).select("run_id.*", *[c for c in JOB_COLS if c != "scraped_at"])


@binding(LOKERID_SQL)
def lokerid_wrapped_run(spark, sf):
    """A third of the records lie inside a wrapper that is no posting itself: it names an organisation without a name."""
    return shown(run(derived.lokerid(spark, sf, wrapped=True), "lokerid", **ALL).jobs)


@binding(f"""
WITH {KARIRHUB_ITEMS}
SELECT 'r' || run AS run_id, CASE WHEN k % 50 = 0 THEN 'missing company' ELSE 'missing scraped_at' END AS reject, count(*) AS n
FROM i WHERE run % 3 < 2 OR k % 50 = 0 GROUP BY ALL
""")
def clock_rejects(spark, sf):
    """Runs whose clock is missing or no instant: every item is told, none is dated by another run's clock."""
    run_no = F.regexp_extract("run_id", "[0-9]+", 0).cast("int")
    clock = F.when(run_no % 3 == 0, F.lit(None).cast("string")).when(run_no % 3 == 1, "2026-02-30T12:00:00Z").otherwise(derived.CLOCK)
    bad = run(derived.karirhub(spark, sf).withColumn("clock", clock), "karirhub", scraped_at=F.col("clock"), max_pages=None).rejects
    return bad.filter("reject <> 'not an object'").groupBy("run_id", "reject").agg(F.count(F.lit(1)).alias("n"))


@binding("""
SELECT 'r' || (c_custkey // 300) AS page, 'Job:' || c_custkey AS key, leaf.path AS path, leaf.v AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
LATERAL (SELECT unnest([{'path': 'id', 'v': CAST(c_custkey AS VARCHAR)}, {'path': 'place|name', 'v': '"' || n_name || '"'}, {'path': 'place|parents|0|name', 'v': '"' || r_name || '"'},
  {'path': 'place|parents|0|code', 'v': CAST(r_regionkey AS VARCHAR)}, {'path': 'place|parents|1', 'v': NULL}, {'path': 'tags', 'v': '[]'}]) AS leaf)
""")
def apollo_refs(spark, sf):
    """Postings link to nations, these in a list to regions, these to their codes, and to an object that is not there."""
    page = derived.text("r", F.expr("c_custkey div 300"))
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", page.alias("page"))
    rows = rows.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ref = lambda *parts: F.struct(derived.text(*parts).alias("__ref"))
    kind = lambda n: F.lit(n).alias("__typename")
    docs = [
        (derived.text("Job:", F.col("c_custkey")), F.to_json(F.struct(
            kind("Job"), F.col("c_custkey").alias("id"), ref("Nation:", F.col("n_nationkey")).alias("place"), F.array().cast("array<string>").alias("tags")))),
        (derived.text("Nation:", F.col("n_nationkey")), F.to_json(F.struct(
            kind("Nation"), F.col("n_name").alias("name"), F.array(ref("Region:", F.col("r_regionkey")), ref("Region:none")).alias("parents")))),
        (derived.text("Region:", F.col("r_regionkey")), F.to_json(F.struct(F.col("r_name").alias("name"), ref("Code:", F.col("r_regionkey")).alias("code")))),
        (derived.text("Code:", F.col("r_regionkey")), F.col("r_regionkey").cast("string")),
    ]
    # Every page has a cache of its own, with each object once.
    entries = rows.select("page", F.inline(F.array(*[F.struct(key.alias("key"), doc.alias("doc")) for key, doc in docs]))).distinct()
    objects = entries.select("page", "key", F.parse_json("doc").alias("value"))
    found = resolve_references(objects, ["page"], F.col("key").startswith("Job:"))
    return found.select("page", "key", F.array_join("path", "|").alias("path"), "value")


@binding("""
SELECT 'r' || (p_partkey // 400) AS run_id, 'K' || p_partkey AS job_id FROM part
WHERE p_partkey % 60 <> 0 AND p_partkey % 37 BETWEEN 1 AND 30 AND p_partkey % 400 // 20 + 1 <= 17
""")
def capture_buckets_run(spark, sf):
    """The capture table laid out by posting, and a run on it."""
    name = f"captures_{uuid.uuid4().hex}"
    save_captures(derived.kitalulus(spark, sf), name, 8)
    return run(spark.table(name), "kitalulus", **ALL).jobs.select("run_id", "job_id")


# Sinks and streams -------------------------------------------------------------------------------


def _jobs_of_orders(spark, sf):
    none = F.lit(None).cast("string")
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") >= 0, "dealls").alias("source"), F.concat(F.lit("r"), F.col("o_custkey") % 2).alias("run_id"), (F.col("o_orderkey") % 100 + 1).cast("int").alias("page_no"),
        F.col("o_orderkey").cast("int").alias("pos"), F.concat(F.lit("k"), F.col("o_orderkey")).alias("job_id"), F.col("o_orderpriority").alias("title"),
        F.lit("Co").alias("company"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("location"), none.alias("job_type"),
        none.alias("salary_range"), F.lit("u").alias("url"), none.alias("description"), F.array(F.lit("a"), F.col("o_orderstatus")).alias("tags"),
        none.alias("posted_at"), F.when(F.col("o_custkey") % 2 == 0, "2026-03-16T12:00:00Z").otherwise("2026-03-17T00:00:00Z").alias("scraped_at"),
    )


@binding("""
SELECT 'k' || o_orderkey AS job_id, o_orderpriority AS title, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS location, 'a|' || o_orderstatus AS tags,
  CASE WHEN o_custkey % 2 = 0 THEN '20260316T120000Z' ELSE '20260317T000000Z' END AS snapshot,
  row_number() OVER (PARTITION BY o_custkey % 2 ORDER BY o_orderkey % 100, o_orderkey) AS place FROM orders
""")
def snapshot_roundtrip(spark, sf):
    path = _new_folder(spark, "snapshot")
    write_snapshot(_jobs_of_orders(spark, sf), path)
    # The place of a posting in its snapshot: files by name, lines as they stand. The lines of a block of a file have numbers that
    # follow each other, so only the blocks' counts meet in one task. The numbers are written, as a second reading may give others.
    lines = read_snapshot(spark, path).withColumns({"file": F.input_file_name(), "block": F.input_file_block_start(), "line": F.monotonically_increasing_id()})
    rows = stage(lines.select("job_id", "title", "location", "tags", "snapshot", "run_id", "file", "block", "line"), "snapshot-lines")
    blocks = rows.groupBy("snapshot", "run_id", "file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("line").alias("first"))
    earlier = Window.partitionBy("snapshot", "run_id").orderBy("file", "first").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("line") - F.col("first") + 1
    return rows.join(blocks, ["file", "block"]).select("job_id", "title", "location", F.array_join("tags", "|").alias("tags"), "snapshot", place.alias("place"))


@binding("SELECT 'k' || o_orderkey AS job_id, 'r' || o_custkey % 2 AS run_id FROM orders")
def snapshot_two_runs(spark, sf):
    path = _new_folder(spark, "snapshots")
    jobs = _jobs_of_orders(spark, sf).withColumn("scraped_at", F.lit("2026-03-16T12:00:00Z"))
    # Two runs with one clock, written one after the other, and the second once more.
    for run_key in ("r0", "r1", "r1"):
        write_snapshot(jobs.filter(F.col("run_id") == run_key), path)
    return read_snapshot(spark, path).select("job_id", "run_id")


LATE_SQL = "SELECT 'K' || p_partkey AS job_id FROM part WHERE p_partkey % 60 <> 0 AND p_partkey % 37 BETWEEN 1 AND 30"


@binding(LATE_SQL)
def stream_late_captures(spark, sf):
    """Files a year, three months and no time old, newest first, each in a micro-batch of its own."""
    path = _new_folder(spark, "late")
    for i, days in enumerate((0, 90, 365)):
        rows = derived.kitalulus(spark, sf, days).filter(F.regexp_extract("run_id", "[0-9]+", 0).cast("int") % 3 == i)
        dated = rows.withColumns({"fetched_at": F.timestamp_seconds(F.lit(derived.CLOCK_SECONDS - days * derived.DAY))})
        dated.coalesce(1).write.mode("append").parquet(f"{path}/landed")
    captures = read_capture_stream(spark, f"{path}/landed", max_files=1)
    write_stream(posting_stream(captures, "kitalulus"), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema("job_id STRING, source STRING").json(f"{path}/out").select("job_id")


@binding(f"""
WITH {KARIRHUB_ITEMS}
SELECT 'r' || run AS run_id, count(*) AS jobs FROM kept WHERE rn = 1 GROUP BY run
""")
def listing_retries(spark, sf):
    """Every page captured three times: a failed attempt first, then the good one, then a later one without postings."""
    good = derived.karirhub(spark, sf).filter("kind = 'listing_api'").withColumn("fetched_at", F.timestamp_seconds(F.lit(2)))
    failed = good.withColumns({"status_code": F.lit(503), "body": F.lit(None).cast("string"), "fetched_at": F.timestamp_seconds(F.lit(1))})
    later = good.withColumns({"body": F.lit('{"data":[]}'), "fetched_at": F.timestamp_seconds(F.lit(3))})
    return run(good.unionByName(failed).unionByName(later), "karirhub", **ALL).runs.select("run_id", "jobs")


@binding("""
SELECT 'r' || (p_partkey // 400) AS run_id, 'K' || p_partkey AS job_id FROM part
WHERE p_partkey % 60 <> 0 AND p_partkey % 37 BETWEEN 1 AND 30 AND p_partkey % 400 // 20 + 1 <= 17
""")
def capture_table_run(spark, sf):
    """The batch capture table: written by source and run, read back, a board run on it."""
    path = _new_folder(spark, "captures")
    write_captures(derived.kitalulus(spark, sf).unionByName(derived.dealls(spark, sf)), path)
    return run(read_captures(spark, path), "kitalulus", **ALL).jobs.select("run_id", "job_id")


@binding("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, sf):
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    once = first_seen_stream(events, ["user_id", "event_type"]).select("user_id", "event_type")
    path = _new_folder(spark, "stream")
    once.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{path}/out")


@binding("""
SELECT DISTINCT 'K' || p_partkey AS job_id FROM part WHERE p_partkey % 60 <> 0 AND p_partkey % 37 BETWEEN 1 AND 30
""")
def stream_postings(spark, sf):
    clock = F.timestamp_seconds(F.lit(derived.CLOCK_SECONDS))
    path = _new_folder(spark, "postings")
    derived.kitalulus(spark, sf).withColumn("fetched_at", clock).write.parquet(f"{path}/landed")
    captures = read_capture_stream(spark, f"{path}/landed")
    write_stream(posting_stream(captures, "kitalulus"), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.schema("job_id STRING, source STRING").json(f"{path}/out").select("job_id")


@binding("""
SELECT 'K' || p_partkey AS job_id, p_partkey // 400 % 3 <> 0 AS late FROM part WHERE p_partkey % 60 <> 0 AND p_partkey % 37 BETWEEN 1 AND 30
""")
def stream_bounded_state(spark, sf):
    """Files no time, three months and a year old, newest first: what is behind the watermark is told apart, nothing is lost."""
    path = _new_folder(spark, "bounded")
    for i, days in enumerate((0, 90, 365)):
        rows = derived.kitalulus(spark, sf, days).filter(F.regexp_extract("run_id", "[0-9]+", 0).cast("int") % 3 == i)
        dated = rows.withColumns({"fetched_at": F.timestamp_seconds(F.lit(derived.CLOCK_SECONDS - days * derived.DAY))})
        # The files of an age are parsed and told side by side; both streams go on from where they were when the next ones come.
        dated.write.mode("append").parquet(f"{path}/captures")
        land(read_capture_stream(spark, f"{path}/captures"), "kitalulus", f"{path}/out", f"{path}/land").awaitTermination()
        write_postings(first_postings(item_stream(spark, f"{path}/out")), f"{path}/postings", f"{path}/state").awaitTermination()
    return read_postings(spark, f"{path}/postings").select("job_id", "late")


@binding(REJECTS_SQL)
def stream_rejects(spark, sf):
    """Rejects of a stream whose batches ran twice under the same ids."""
    path = _new_folder(spark, "rejects")
    clock = F.timestamp_seconds(F.lit(derived.CLOCK_SECONDS))
    derived.karirhub(spark, sf).filter("kind = 'listing_api'").withColumn("fetched_at", clock).write.parquet(f"{path}/captures")
    # A few batches however many files there are: the files of a batch are parsed side by side, batches one after the other.
    files = len(spark.read.parquet(f"{path}/captures").inputFiles())
    for checkpoint in ("first", "again"):
        captures = read_capture_stream(spark, f"{path}/captures", max_files=max(2, -(-files // 4)))
        land(captures, "karirhub", f"{path}/out", f"{path}/{checkpoint}").awaitTermination()
    return _reject_counts(read_landed(spark, f"{path}/out", "rejects"))


def _new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
