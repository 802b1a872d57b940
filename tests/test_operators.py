"""DataFrame operators, sinks and streams; invariants that need no reference."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import functions as F

from postlake import read_captures, read_snapshot, run, write_captures, write_snapshot
from postlake.operators.first_seen import first_seen, link_map
from postlake.operators.merge import detail_worklist, merge_sources, with_details
from postlake.operators.page_cut import CutRules, cut_runs
from postlake.operators.recency import recent_only
from postlake.sources.schema import JOB_COLS
from postlake.streaming.ingest import posting_stream, read_capture_stream, write_stream
from tests import builders as b


def test_first_seen_is_unique_ordered_and_limited_before_the_shuffle(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), (F.lit(5000) - F.col("id")).alias("o"), "id")
    hot = rows.unionByName(spark.range(5000).select(F.lit(7).alias("k"), F.col("id").alias("o"), "id"))
    out = first_seen(hot, ["k"], ["o", "id"])
    assert {(r.k, r.o) for r in out.collect()} == {(0, 2), (1, 1), (2, 3), (7, 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    again = first_seen(out, ["k"], ["o", "id"])
    assert again.exceptAll(out).count() == 0 and again.count() == 4


def test_link_maps(spark):
    links = spark.createDataFrame([(1, "a", "x", 0), (1, "a", "y", 1), (1, "b", "z", 2)], "page int, key string, href string, pos int")
    assert {(r.key, r.href) for r in link_map(links, ["page", "key"], "href", "pos").collect()} == {("a", "x"), ("b", "z")}
    assert {(r.key, r.href) for r in link_map(links, ["page", "key"], "href", "pos", last=True).collect()} == {("a", "y"), ("b", "z")}


def brute_cut(pages, max_pages):
    """The crawl loop itself: pages by number, until one stops it."""
    kept, page = 0, 1
    while page in pages and (max_pages is None or page <= max_pages):
        before, after, fatal = pages[page]
        if fatal:
            return kept, page
        if before:
            return kept, None
        kept = page
        if after:
            break
        page += 1
    return kept, None


def test_page_cut_equals_the_crawl_loop(spark):
    import random

    rnd = random.Random(3)
    runs = {}
    for n in range(300):
        size = rnd.randint(1, 9)
        pages = {}
        for page in range(1, size + 1):
            if rnd.random() < 0.92:
                before, fatal = rnd.random() < 0.12, rnd.random() < 0.1
                pages[page] = (before and not fatal, rnd.random() < 0.12, fatal)
        if pages:
            runs[n] = pages
    rows = [(n, p, *flags) for n, pages in runs.items() for p, flags in pages.items()]
    frame = spark.createDataFrame(rows, "run int, page_no int, b boolean, a boolean, f boolean")
    rules = CutRules(F.col("b"), F.col("a"), F.col("f"), F.max(F.lit(None).cast("int")))
    for limit in (None, 3):
        got = {r.run: (r.last_kept, r.failed_on) for r in cut_runs(frame, ["run"], rules, limit).collect()}
        want = {n: brute_cut(pages, limit) for n, pages in runs.items()}
        assert {n: g[1] for n, g in got.items()} == {n: w[1] for n, w in want.items()}
        # A failed run keeps nothing, so only sound runs compare by page.
        assert {n: g[0] for n, g in got.items() if g[1] is None} == {n: w[0] for n, w in want.items() if w[1] is None}


def test_page_cut_collects_no_run_in_a_window(spark):
    pages = spark.range(10).select(F.lit(1).alias("run"), (F.col("id") + 1).cast("int").alias("page_no"))
    cut = cut_runs(pages, ["run"], CutRules(F.lit(False), F.lit(False), F.lit(False), F.max(F.lit(None).cast("int"))))
    assert "Window" not in cut._jdf.queryExecution().executedPlan().toString()
    assert cut.first().last_kept == 10


def test_merge_sources(spark):
    ddl = "k string, pos int, x string, y string"
    primary = spark.createDataFrame([("a", 0, None, "p"), ("b", 1, "p", None)], ddl)
    fallback = spark.createDataFrame([("a", 0, None, "f"), ("a", 1, "g", "h"), ("c", 2, None, None), ("c", 3, "z", None)], ddl)
    out = merge_sources(primary, fallback, ["k"], ["x", "y"])
    assert {tuple(r) for r in out.collect()} == {("a", False, 0, "g", "p"), ("b", False, 1, "p", None), ("c", True, 2, "z", None)}
    assert out.count() == primary.select("k").union(fallback.select("k")).distinct().count()


def test_details_take_the_earliest_capture(spark):
    jobs = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    details = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("z", 1, "other")], "k string, fetched_at int, w string")
    out = with_details(jobs, details, ["k"], ["w"])
    assert {r.k: r.detail and r.detail.w for r in out.collect()} == {"a": "early", "b": None}
    assert [r.k for r in detail_worklist(jobs, details, ["k"], F.col("v").isNotNull()).collect()] == ["b"]
    assert detail_worklist(jobs, details, ["k"], F.lit(True)).count() == 1


def test_recency_is_idempotent_and_order_of_input_does_not_matter(spark):
    rows = spark.range(100).select(
        (F.timestamp_seconds(F.lit(b.NOW) - F.col("id") * 86400)).alias("posted_ts"), F.timestamp_seconds(F.lit(b.NOW)).alias("scraped_ts")
    )
    once = recent_only(rows)
    assert once.count() == 31 and recent_only(once).count() == 31
    captures = [b.capture("karirhub", "listing_api", {"data": [b.karirhub_item(f"j{(p * i) % 5}", title=f"t{p}{i}") for i in range(4)]}, page=p) for p in (1, 2, 3)]
    pick = lambda rows: sorted((r.job_id, r.title) for r in run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK, max_pages=None).jobs.collect())
    assert pick(captures) == pick(captures[::-1])


def test_captures_and_snapshot_round_trip(spark, tmp_path):
    rows = [b.capture("kitalulus", "listing_api", b.kitalulus_page([b.kitalulus_item("ä", requirementStr="x")]), page=1)]
    write_captures(b.frame(spark, rows), str(tmp_path / "captures"))
    captures = read_captures(spark, str(tmp_path / "captures"))
    out = run(captures, "kitalulus", scraped_at=b.CLOCK)
    for _ in range(2):
        write_snapshot(out.jobs, str(tmp_path / "out"))
    files = list(Path(tmp_path / "out" / "source=kitalulus" / "snapshot=20260316T120000Z" / "run_id=r1").glob("part-*.json"))
    lines = [line for f in files for line in f.read_text(encoding="utf-8").splitlines()]
    assert len(lines) == 1
    record = json.loads(lines[0])
    assert list(record) == [*JOB_COLS, "page_no", "pos"] and record["job_id"] == "ä" and record["location"] is None and record["tags"] == []
    back = read_snapshot(spark, str(tmp_path / "out"))
    assert back.select(*JOB_COLS).exceptAll(out.jobs.select(*JOB_COLS)).count() == 0
    plan = captures.filter("source = 'kitalulus' AND run_id = 'r1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_snapshots_of_runs_with_one_clock_stay_and_keep_page_order(spark, tmp_path):
    row = lambda run, page, pos: ("dealls", run, page, pos, f"{run}-{page}-{pos}", b.CLOCK)
    rows = [row("a", p, i) for p in range(12, 0, -1) for i in (1, 0)] + [row("z", 1, 0)]
    jobs = spark.createDataFrame(rows, "source string, run_id string, page_no int, pos int, job_id string, scraped_at string")
    jobs = jobs.withColumns({c: F.lit(None).cast("array<string>" if c == "tags" else "string") for c in JOB_COLS if c not in ("job_id", "scraped_at")})
    for run_id in ("a", "z", "a"):
        write_snapshot(jobs.filter(F.col("run_id") == run_id), str(tmp_path))
    back = read_snapshot(spark, str(tmp_path))
    assert back.count() == len(rows)
    files = sorted((tmp_path / "source=dealls" / "snapshot=20260316T120000Z" / "run_id=a").glob("part-*.json"))
    got = [json.loads(line)["job_id"] for f in files for line in f.read_text().splitlines()]
    assert got == [f"a-{p}-{i}" for p in range(1, 13) for i in (0, 1)]


def test_stream_keeps_late_captures(spark, tmp_path):
    import datetime

    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for name, days in (("march", 0), ("january", 60), ("last", 400)):
        day = datetime.datetime.fromtimestamp(b.NOW - days * 86400, datetime.timezone.utc)
        rows = b.frame(spark, [b.capture("lokerid", "listing_html", b.lokerid_html([b.lokerid_item(name, day.strftime("%Y-%m-%d"))]), page=1)])
        rows.withColumn("fetched_at", F.timestamp_seconds(F.lit(b.NOW - days * 86400))).coalesce(1).write.mode("append").parquet(source)
    write_stream(posting_stream(read_capture_stream(spark, source, max_files=1), "lokerid"), out, state).awaitTermination()
    assert {r.job_id for r in spark.read.schema("job_id string").json(out).collect()} == {"march", "january", "last"}


def test_stream_keeps_first_posting_across_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land = lambda name, items: b.frame(spark, [b.capture("lokerid", "listing_html", b.lokerid_html(items), page=1)]).write.mode("append").parquet(source)
    land("one", [b.lokerid_item("a", "2026-03-15"), b.lokerid_item("b", "2026-03-15"), b.lokerid_item("old", "2020-01-01")])
    go = lambda: write_stream(posting_stream(read_capture_stream(spark, source), "lokerid"), out, state).awaitTermination()
    go()
    land("two", [b.lokerid_item("a", "2026-03-15"), b.lokerid_item("c", "2026-03-15")])
    go()
    ids = [r.job_id for r in spark.read.schema("job_id string").json(out).collect()]
    assert sorted(ids) == ["a", "b", "c"]


def test_stream_reads_every_board(spark, tmp_path):
    rows = [
        b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("k")]}, page=1),
        b.capture("dealls", "listing_html", b.dealls_html([b.dealls_item("d")]), page=1),
        b.capture("glints", "listing_html", b.glints_html([b.glints_item("e1")]), page=1),
    ]
    source = str(tmp_path / "in")
    b.frame(spark, rows).write.parquet(source)
    for name, job_id in (("karirhub", "k"), ("dealls", "d"), ("glints", "e1")):
        out = str(tmp_path / name)
        write_stream(posting_stream(read_capture_stream(spark, source), name), out, out + "-state").awaitTermination()
        assert [r.job_id for r in spark.read.schema("job_id string").json(out).collect()] == [job_id]
