"""The two-step stream: what is landed once, what is remembered, what comes late."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from postlake import run
from postlake.streaming.bounded import first_postings, item_stream, land, read_landed, read_postings, write_postings
from postlake.streaming.ingest import read_capture_stream
from tests import builders as b

DAY = 86_400


def page(job_ids, days, number=1, run_id="r1", bad=0):
    """A page taken so many days before the clock, with postings of that day and some without company."""
    items = [b.karirhub_item(i, b.NOW - days * DAY - 60) for i in job_ids] + [b.karirhub_item(f"bad{k}", b.NOW, company_name=" ") for k in range(bad)]
    return b.capture("karirhub", "listing_api", {"data": items}, page=number, run=run_id, fetched=b.FETCHED - timedelta(days=days))


def landed(spark, folder, batches):
    """One file of captures per batch, in order, each landed in a micro-batch of its own."""
    for rows in batches:
        b.frame(spark, rows).write.mode("append").parquet(f"{folder}/captures")
        land(read_capture_stream(spark, f"{folder}/captures", max_files=1), "karirhub", f"{folder}/out", f"{folder}/land").awaitTermination()


def told(spark, folder):
    query = write_postings(first_postings(item_stream(spark, f"{folder}/out", max_files=1)), f"{folder}/postings", f"{folder}/state")
    query.awaitTermination()
    rows = read_postings(spark, f"{folder}/postings").collect()
    return sorted((r.job_id, r.late) for r in rows), query


def test_state_ends_and_nothing_is_lost(spark, tmp_path):
    folder = str(tmp_path)
    landed(spark, folder, [
        [page(["a", "b", "c"], 365)], [page(["a", "d"], 364)], [page(["e"], 90), page(["e", "f"], 89, 2)],
        [page(["g"], 0)], [page(["late", "g"], 200)], [page(["g", "h"], 1, 2)],
    ])
    rows, query = told(spark, folder)
    assert rows == [("a", False), ("b", False), ("c", False), ("d", False), ("e", False), ("f", False), ("g", False), ("h", False), ("late", True)]
    # Only the postings that may still show up are remembered: g and h, each with its timer.
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(states) > states[-1] and states[-1] <= 4
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_first_row_of_a_posting(spark, tmp_path):
    """The earliest capture in a batch wins, then the place on its page; a later batch adds nothing."""
    folder = str(tmp_path)
    landed(spark, folder, [[page(["x"], 1, 4), page(["y", "x"], 2, 3)], [page(["x", "y"], 0, 1)]])
    told(spark, folder)
    assert {r.job_id: (r.page_no, r.pos) for r in read_postings(spark, f"{folder}/postings").collect()} == {"x": (3, 1), "y": (3, 0)}


def test_replayed_batches_leave_one_copy(spark, tmp_path):
    folder = str(tmp_path)
    batches = [[page(["a", "b"], 0, 1, bad=2)], [page(["c"], 0, 2, bad=1), page(["d"], 0, 1, "r2")]]
    landed(spark, folder, batches)
    once = {k: sorted(map(str, read_landed(spark, f"{folder}/out", k).collect())) for k in ("items", "rejects", "counts")}
    # The same batches under the same ids, as after a failure before their commit.
    land(read_capture_stream(spark, f"{folder}/captures", max_files=1), "karirhub", f"{folder}/out", f"{folder}/again").awaitTermination()
    assert once == {k: sorted(map(str, read_landed(spark, f"{folder}/out", k).collect())) for k in ("items", "rejects", "counts")}
    rejects = read_landed(spark, f"{folder}/out", "rejects")
    want = run(b.frame(spark, [r for rows in batches for r in rows]), "karirhub", scraped_at=F.lit(b.CLOCK), max_pages=None).rejects
    assert sorted(map(tuple, rejects.select(want.columns).collect())) == sorted(map(tuple, want.collect())) and rejects.count() == 3
    counts = read_landed(spark, f"{folder}/out", "counts").groupBy("reject").agg(F.sum("items"), F.sum("recent")).collect()
    assert {tuple(r) for r in counts} == {(None, 4, 4), ("missing company", 3, 0)}


@pytest.mark.parametrize("kind", ["items", "counts"])
def test_half_written_batch_is_written_again(spark, tmp_path, kind):
    folder = str(tmp_path)
    path = tmp_path / "out" / kind / f"batch={0:010d}"
    path.mkdir(parents=True)
    (path / "part-broken.parquet").write_bytes(b"PAR1")
    landed(spark, folder, [[page(["a"], 0)]])
    assert read_landed(spark, f"{folder}/out", kind).count() == 1


def test_page_without_items_or_clock(spark, tmp_path):
    folder = str(tmp_path)
    lost = b.capture("karirhub", "listing_api", None, page=1, status=503)
    undated = b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("u")]}, page=2, fetched=None)
    landed(spark, folder, [[lost, undated]])
    counts = {(r.outcome, r.reject): (r["items"], r.pages_without_items) for r in read_landed(spark, f"{folder}/out", "counts").collect()}
    assert counts == {("failed", None): (0, 1), ("ok", "missing scraped_at"): (1, 0)}
    assert [r.reject for r in read_landed(spark, f"{folder}/out", "rejects").collect()] == ["missing scraped_at"]
