"""Which capture of a page counts."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest

from postlake import run
from postlake.plans import attempts
from postlake.plans.boards import board
from postlake.sources.captures import with_clock
from tests import builders as b


def attempt(rng, page, run_id):
    kind = rng.randrange(6)
    fetched = rng.choice([None, b.FETCHED, b.FETCHED - timedelta(hours=rng.randrange(3)), b.FETCHED - timedelta(minutes=rng.randrange(500))])
    name = f"p{page}-{rng.randrange(10**6)}"
    body = {"data": [b.karirhub_item(name), b.karirhub_item(name + "b")]}
    if kind == 0:
        return b.capture("karirhub", "listing_api", None, page=page, run=run_id, status=503, fetched=fetched)
    if kind == 1:
        return b.capture("karirhub", "listing_api", "{broken", page=page, run=run_id, fetched=fetched)
    if kind == 2:
        return b.capture("karirhub", "listing_api", body, page=page, run=run_id, status=429, fetched=fetched)
    if kind == 3:
        return b.capture("karirhub", "listing_api", body, page=page, run=run_id, error="timeout", fetched=fetched)
    return b.capture("karirhub", "listing_api", body, page=page, run=run_id, fetched=fetched)


def readable(c):
    return c[6] == 200 and c[7] is None and c[9] is not None and c[9] != "{broken"


def test_against_all_attempts(spark):
    rng = random.Random(6)
    rows = []
    for run_id in ("r1", "r2"):
        for page in range(1, 25):
            own = [attempt(rng, page, run_id) for _ in range(rng.choice([1, 1, 2, 3, 5]))]
            rows += own + [rng.choice(own)] * rng.choice([0, 0, 2])
    rng.shuffle(rows)
    frame = with_clock(b.frame(spark, rows), b.CLOCK).repartition(5)
    hashes = {tuple(r)[:11]: r.attempt for r in frame.select(*frame.columns).collect()}
    got = {}
    for r in attempts.listed(frame, board("karirhub")).collect():
        got.setdefault((r.run_id, r.page_no), []).append((r.attempt, r.job_id))
    order = lambda c: (not readable(c), c[8] is None, c[8] or b.FETCHED, hashes[c])
    for key in {(c[1], c[3]) for c in rows}:
        best = min((c for c in rows if (c[1], c[3]) == key), key=order)
        n = 2 if readable(best) else 1
        assert len(got[key]) == n and {a for a, _ in got[key]} == {hashes[best]}, key
        assert len(set(got[key])) == n
    assert len(got) == 48


def test_bodies_and_items_stay_where_they_are(spark, monkeypatch):
    """With one capture a page, items are parsed and written without a shuffle; with few captured again, only keys go around."""
    plans = []
    staged = attempts.stage

    def watched(df, name, folder=None):
        out = staged(df, name, folder)
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(attempts, "stage", watched)
    pages = [b.capture("karirhub", "listing_api", {"data": [b.karirhub_item(f"a{p}")]}, page=p) for p in range(1, 4)]
    run(b.frame(spark, pages), "karirhub", scraped_at=b.CLOCK, max_pages=None)
    assert [n for n, _, _ in plans] == ["karirhub-pages-again", "karirhub"]
    assert "body" not in plans[0][1].split("Aggregate")[1].split("\n")[0] and "Exchange" not in plans[1][2] and "Window" not in plans[1][2]
    plans.clear()
    lost = b.capture("karirhub", "listing_api", None, page=2, status=503, fetched=b.FETCHED - timedelta(hours=1))
    out = run(b.frame(spark, [*pages, lost]), "karirhub", scraped_at=b.CLOCK, max_pages=None)
    assert out.jobs.count() == 3
    # The good capture is tried first, so nothing is parsed a second time.
    assert [n for n, _, _ in plans] == ["karirhub-pages-again", "karirhub-first-attempts", "karirhub", "karirhub-unread"]
    assert "Window" not in plans[2][2]


@pytest.mark.parametrize("body", [None, "{broken"])
def test_page_without_a_readable_attempt(spark, body):
    rows = [b.capture("karirhub", "listing_api", body, page=1, fetched=b.FETCHED - timedelta(hours=h)) for h in (2, 1, 3)]
    out = run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK)
    assert [(r.page_no, r["items"]) for r in out.pages.collect()] == [(1, 0)] and out.runs.first().failed_on == 1
