"""Capture rows in the boards' shapes, written for these tests."""

from __future__ import annotations

import json
from datetime import datetime

from postlake.sources.schema import CAPTURE_DDL

FETCHED = datetime(2026, 3, 16, 12, 0, 0)
CLOCK = "2026-03-16T12:00:00Z"
NOW = 1773662400  # CLOCK in epoch seconds
MONTH = 30 * 86400


def capture(source, kind, body, *, page=None, job_id=None, run="r1", status=200, error=None, text=None, fetched=FETCHED):
    if body is not None and not isinstance(body, str):
        body = json.dumps(body)
    return (source, run, kind, page, job_id, None, status, error, fetched, body, text)


def frame(spark, rows):
    return spark.createDataFrame(rows, CAPTURE_DDL).coalesce(1)


def karirhub_item(job_id, posted=NOW - 3600, **more):
    return {"id": job_id, "title": "Backend Engineer", "company_name": "PT Uji", "published_at": posted, **more}


def kitalulus_item(code, posted=(NOW - 3600) * 1_000_000, **more):
    return {"code": code, "positionName": "Kasir", "slug": f"kasir-{code}", "company": {"name": "Toko Uji"}, "updatedAt": posted, **more}


def kitalulus_page(items, has_next=False, elements=None):
    return {"data": {"vacanciesV3": {"elements": elements or len(items), "hasNextPage": has_next, "list": items}}}


def dealls_item(job_id, posted="2026-03-16T08:00:00Z", **more):
    return {"id": job_id, "role": "Analyst", "company": {"name": "Uji Co", "slug": "uji-co"}, "publishedAt": posted, **more}


def dealls_html(items, total_pages=1):
    page = {"docs": items, "totalPages": total_pages}
    query = {"queryKey": ["/v1/explore-job/job", {}], "state": {"data": {"pages": [page]}}}
    other = {"queryKey": ["/other"], "state": {}}
    return script({"props": {"pageProps": {"dehydratedState": {"queries": [other, query]}}}})


def script(payload):
    return f'<html><body><script id="__NEXT_DATA__" type="application/json">{json.dumps(payload)}</script></body></html>'


def glints_item(job_id, posted="2026-03-16T08:00:00Z", **more):
    return {"id": job_id, "title": "Nurse", "company": {"name": "Klinik Uji"}, "createdAt": posted, **more}


def glints_html(items, has_more=False, links=None):
    cards = "".join(
        f'<div class="x job-search-results_job-card_link" data-gtm-job-id="{i["id"]}">'
        f'<p><a href="/id/opportunities/jobs/nurse/{i["id"]}?utm=1&amp;b=2">Go</a></p></div>'
        for i in (items if links is None else links)
    )
    data = {"props": {"pageProps": {"initialJobs": {"hasMore": has_more, "jobsInPage": items}}}}
    return script(data).replace("</body>", cards + "</body>")


def lokerid_item(job_id, posted="2026-03-16T08:00:00Z", **more):
    return {"id": job_id, "title": "Sales", "company_name": "PT Loka", "posted_at": posted, **more}


def lokerid_html(items, meta=None, cards="", route="routes/list"):
    context = {"state": {"loaderData": {"root": {"user": None}, route: {"jobs": items, **({"meta": meta} if meta else {})}}}}
    remix = f"<script>var a = 1;</script><script>\nwindow.__remixContext = {json.dumps(context)};\n</script>" if items is not None else ""
    return f"<!DOCTYPE html><html><head><title>L</title></head><body>{remix}{cards}</body></html>"


def lokerid_card(job_id, title="Sales", company="PT Loka", posted="2026-03-16T07:00:00Z", extra="", tags=()):
    spans = "".join(f"<span>{t}</span>" for t in tags)
    return (
        f'<article class="job-card" data-job-id="{job_id}"><div class="company-name">{company}</div>'
        f'<h3 class="title"><a href="/sales/sales-{job_id}.html">{title}</a></h3>{extra}'
        f'<a class="more" href="/cari-lowongan-kerja?jobid={job_id}">More</a><div class="tags">{spans}</div>'
        f'<time datetime="{posted}"></time></article>'
    )
