"""Shapes of the capture table (input) and of a posting (output)."""

from __future__ import annotations

# One row per landed response: listing pages and detail pages, HTML or JSON.
CAPTURE_DDL = (
    "source STRING, run_id STRING, kind STRING, page_no INT, job_id STRING, url STRING, "
    "status_code INT, error STRING, fetched_at TIMESTAMP, body STRING, body_text STRING"
)
LISTING_KINDS = ("listing_html", "listing_api")
DETAIL_KINDS = ("detail_html", "detail_api")

# Column order of a posting.
JOB_DDL = (
    "job_id STRING, title STRING, company STRING, location STRING, job_type STRING, "
    "salary_range STRING, url STRING, description STRING, tags ARRAY<STRING>, "
    "posted_at STRING, scraped_at STRING"
)
JOB_COLS = [field.split()[0] for field in JOB_DDL.split(", ")]

RUN_KEYS = ["source", "run_id"]
PAGE_KEYS = [*RUN_KEYS, "page_no"]
JOB_KEYS = [*RUN_KEYS, "job_id"]

# Facts of a listing page that decide where a run's pagination ended.
PAGE_FACTS = ["outcome", "total_pages", "has_more"]

# A listing row: one per item of a page, or one without item (pos NULL) for an empty page.
# ``markup`` is a description still in HTML; ``fetched_at`` and ``attempt`` tell captures of one page apart.
LISTING_COLS = [*PAGE_KEYS, "pos", *PAGE_FACTS, "reject", *JOB_COLS, "posted_ts", "scraped_ts", "markup", "fetched_at", "attempt"]
# Fields a detail page can add to a posting.
DETAIL_FIELDS = ["location", "job_type", "salary_range", "url", "description", "tags", "posted_at"]
