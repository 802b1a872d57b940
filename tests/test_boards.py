"""Payload to posting, per board, with literal expected values."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from postlake import normalize, postings, run, run_all
from postlake.sources.schema import JOB_COLS
from tests import builders as b


def listed(spark, source, rows, clock=b.CLOCK):
    df = normalize(b.frame(spark, rows), source, clock).filter("pos is not null").orderBy("page_no", "pos")
    return df.collect()


def ids(df):
    return [r.job_id for r in df.orderBy("page_no", "pos").collect()]


# karirhub ----------------------------------------------------------------------------------------

KARIRHUB_DETAIL = """<html><head><meta name="description" content=" From meta "><title>T</title></head><body>
<div>Lowongan dalam negeri</div><div>Juru Ukir</div><div>Jepara, Jawa Tengah</div>
<div>Dipublikasikan hari ini</div><div>Rentang gaji</div><div>Rp 1 - Rp 2</div><div>Jenis pekerjaan</div><div>Kontrak</div>
<div>Deskripsi Pekerjaan</div><div>Mengukir   kayu.</div><div>Persyaratan Umum</div><div>Sabar.</div>
<div>Keterampilan</div><div>Pahat</div><div>Amplas</div><div>Pahat</div><div>Lowongan dari</div><div>Other</div></body></html>"""


def test_karirhub_fields(spark):
    item = b.karirhub_item(
        " job-1 ", 1773648000, title="  Juru Ukir ", city_name=" ", location="Bandung", job_type="Kontrak",
        show_salary=True, min_salary_amount=5_000_000, max_salary_amount=8_000_000, skills=["Python", " SQL ", "Python", 4],
        job_function_name="IT", description_text=" text ",
    )
    plain = b.karirhub_item("job-2", show_salary=False, min_salary_amount=1, skills=[], job_function_name="Web")
    low = b.karirhub_item("job-3", show_salary=1, min_salary_amount=5000, max_salary_amount=True)
    high = b.karirhub_item(None, _id="job-4", show_salary=True, max_salary_amount=7000)
    rows = listed(spark, "karirhub", [b.capture("karirhub", "listing_api", {"data": [item, plain, low, 7, high, b.karirhub_item(5), {"id": "x"}]}, page=1)])
    first = rows[0]
    assert (first.job_id, first.title, first.company) == ("job-1", "Juru Ukir", "PT Uji")
    # A blank first choice is still the choice.
    assert first.location is None and first.job_type == "Kontrak"
    assert first.salary_range == "Rp 5,000,000 - Rp 8,000,000"
    assert first.url == "https://karirhub.kemnaker.go.id/lowongan-dalam-negeri/lowongan/juru-ukir-job-1"
    assert first.tags == ["Python", "SQL"] and first.posted_at == "2026-03-16T08:00:00Z" and first.description == "text"
    assert rows[1].salary_range is None and rows[1].tags == ["Web"]
    assert rows[2].salary_range == "From Rp 5,000"
    assert rows[4].job_id == "job-4" and rows[4].salary_range == "Up to Rp 7,000"
    assert [r.reject for r in rows] == [None, None, None, "not an object", None, "missing job_id", "missing title"]


def test_karirhub_recency_dedupe_and_stop(spark):
    pages = [
        [b.karirhub_item("now", b.NOW), b.karirhub_item("edge", b.NOW - b.MONTH), b.karirhub_item("old", b.NOW - b.MONTH - 1), b.karirhub_item("future", b.NOW + 1)],
        [b.karirhub_item("edge"), b.karirhub_item("two")],
        [b.karirhub_item("two"), b.karirhub_item("now")],
        [b.karirhub_item("never reached")],
    ]
    rows = [b.capture("karirhub", "listing_api", {"data": p}, page=i) for i, p in enumerate(pages, 1)]
    out = run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK, max_pages=None)
    assert ids(out.jobs) == ["now", "edge", "two"]
    assert {r.page_no: (r.recent_jobs, r.new_jobs, r.kept) for r in out.pages.collect()} == {
        1: (2, 2, True), 2: (2, 1, True), 3: (2, 0, False), 4: (1, 1, False)
    }
    assert [(r.last_kept, r.failed_on, r.jobs) for r in out.runs.collect()] == [(2, None, 3)]
    assert ids(run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK).jobs) == ["now", "edge"]


def test_karirhub_rejected_page_and_failure(spark):
    good = b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("a")]}, page=1)
    late = b.capture("karirhub", "listing_api", None, page=2, status=400)
    broken = b.capture("karirhub", "listing_api", None, page=2, status=503, run="r2")
    first = b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("b")]}, page=1, run="r2")
    gap = [b.capture("karirhub", "listing_api", {"data": [b.karirhub_item(f"g{p}")]}, page=p, run="r3") for p in (1, 3)]
    out = run(b.frame(spark, [good, late, broken, first, *gap]), "karirhub", scraped_at=b.CLOCK, max_pages=None)
    report = {r.run_id: (r.last_kept, r.failed_on, r.jobs) for r in out.runs.collect()}
    assert report["r1"] == (1, None, 1) and report["r2"][1:] == (2, 0) and report["r3"] == (1, None, 1)
    assert sorted(r.job_id for r in out.jobs.collect()) == ["a", "g1"]


def test_karirhub_details(spark):
    items = [b.karirhub_item("d1", city_name="Indonesia", skills=["Java"]), b.karirhub_item("d2", title="Other")]
    rows = [
        b.capture("karirhub", "listing_api", {"data": items}, page=1),
        b.capture("karirhub", "detail_html", KARIRHUB_DETAIL, job_id="d1"),
    ]
    out = run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK, fetch_details=True)
    one, two = out.jobs.orderBy("pos").collect()
    assert (one.location, one.job_type, one.salary_range) == ("Jepara, Jawa Tengah", "Kontrak", "Rp 1 - Rp 2")
    assert one.tags == ["Pahat", "Amplas"]
    assert one.description == (
        "Deskripsi Pekerjaan\nMengukir kayu.\n\nPersyaratan Umum\nSabar.\n\nKeterampilan\nPahat\nAmplas\nPahat"
    )
    assert two.description is None and [r.job_id for r in out.worklist.collect()] == ["d2"]
    assert run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK).jobs.filter("description is not null").count() == 0


def test_karirhub_stop_lines_of_an_employer(spark):
    """Who reads another employer's pages gives the line that follows the skills there."""
    html = "<div>Lowongan dalam negeri</div><div>Role</div><div>Keterampilan</div><div>Las</div><div>PT Lain Jaya</div><div>Alamat</div>"
    rows = [b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("d")]}, page=1), b.capture("karirhub", "detail_html", html, job_id="d")]
    tags = lambda **more: run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK, fetch_details=True, **more).jobs.first().tags
    assert tags() == ["Las", "PT Lain Jaya", "Alamat"] and tags(detail_options={"stops": ("PT Lain Jaya",)}) == ["Las"]


def test_karirhub_detail_without_sections_uses_meta(spark):
    html = "<head><meta name=description content=' M '></head><div>Lowongan dalam negeri</div><div>Role</div><div>Solo</div><div>Rentang gaji</div><div>Dirahasiakan</div>"
    rows = [b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("d")]}, page=1), b.capture("karirhub", "detail_html", html, job_id="d")]
    job = run(b.frame(spark, rows), "karirhub", scraped_at=b.CLOCK, fetch_details=True).jobs.first()
    assert (job.location, job.salary_range, job.description, job.tags) == ("Solo", None, "M", [])


# kitalulus ---------------------------------------------------------------------------------------


def test_kitalulus_fields(spark):
    items = [
        b.kitalulus_item(
            "A", 1773720667000000, city={"name": "Jakarta Timur"}, province={"name": "DKI Jakarta"}, type="FULL_TIME", typeStr=" Penuh ",
            salaryLowerBound=5_000_000, salaryUpperBound=8_000_000, jobRole={"displayName": "Sales"}, jobSpecialization={"displayName": "Sales"},
            jobFunction="Jual", educationLevelStr="S1", formattedDescription="<p>Tugas:</p><ul><li>Satu</li><li>Dua &amp; tiga</li></ul>",
        ),
        b.kitalulus_item("B", 999999999999999999, type="PART_TIME", salaryLowerBound=5_000_000, salaryUpperBound=0, city=None, requirementStr=" Rajin "),
        b.kitalulus_item("C", None, salaryUpperBound=None, salaryLowerBoundStr="Dapat Dinegosiasikan", salaryUpperBoundStr="Dinegosiasikan"),
        b.kitalulus_item("D", salaryLowerBoundStr="1 jt", salaryUpperBoundStr="2 jt", salaryUpperBound=9),
        b.kitalulus_item("E", salaryLowerBoundStr="1 jt", province={"name": "Bali"}),
        b.kitalulus_item("", company=None), "text",
    ]
    rows = listed(spark, "kitalulus", [b.capture("kitalulus", "listing_api", b.kitalulus_page(items), page=1)])
    a, bb, c, d, e = rows[:5]
    assert (a.location, a.job_type, a.salary_range) == ("Jakarta Timur, DKI Jakarta", "Penuh", "Rp 5,000,000 - Rp 8,000,000")
    assert a.tags == ["Sales", "Jual", "S1"] and a.description == "Tugas:\nSatu\nDua & tiga"
    assert a.url == "https://www.kitalulus.com/lowongan/detail/kasir-A" and a.posted_at == "2026-03-17T04:11:07Z"
    assert (bb.job_type, bb.salary_range, bb.posted_at, bb.description) == ("Part Time", "Rp 5,000,000+", None, "Rajin")
    assert c.salary_range is None and d.salary_range == "Up to Rp 9" and (e.salary_range, e.location) == ("1 jt", "Bali")
    assert [r.reject for r in rows[5:]] == ["missing job_id", "not an object"]


def test_kitalulus_pages(spark):
    old = (b.NOW - b.MONTH - 5) * 1_000_000
    page = lambda n, items, nxt=True, run="r1", **kw: b.capture("kitalulus", "listing_api", b.kitalulus_page(items, nxt, 1510), page=n, run=run, **kw)
    rows = [
        page(1, [b.kitalulus_item("a"), b.kitalulus_item("a")]), page(2, [b.kitalulus_item("b", old)]), page(3, [b.kitalulus_item("c")]),
        page(1, [b.kitalulus_item("d")], run="r2"), page(2, [b.kitalulus_item("e")], False, run="r2"), page(3, [b.kitalulus_item("f")], run="r2"),
        b.capture("kitalulus", "listing_api", {"errors": []}, page=1, run="r3"),
        page(1, [b.kitalulus_item("g")], run="r4"), b.capture("kitalulus", "listing_api", "oops", page=2, run="r4"),
    ]
    out = run(b.frame(spark, rows), "kitalulus", scraped_at=b.CLOCK, max_pages=None)
    # Repeats are kept on this board.
    assert sorted(r.job_id for r in out.jobs.collect()) == ["a", "a", "d", "e", "g"]
    assert {r.run_id: r.failed_on for r in out.runs.collect()} == {"r1": None, "r2": None, "r3": 1, "r4": None}
    assert out.pages.filter("run_id = 'r1' and page_no = 1").first().total_pages == 76


# dealls ------------------------------------------------------------------------------------------


def test_dealls_fields(spark):
    items = [
        b.dealls_item(
            "x1", slug="data-analyst", city={"name": "Bandung"}, country={"name": "Indonesia"}, employmentTypes=["fullTime", "contract", 3],
            workplaceType="onSite", salaryRange={"start": 10_500_000, "end": 13_000_000}, skills=[{"name": "SQL"}, {"name": " "}, 1, {"name": "SQL"}],
        ),
        b.dealls_item("x2", company=None, author={"name": " Solo "}, slug="", slugPrimarySegment="seg", workplaceType="remote", salaryType="unpaid"),
        b.dealls_item("x3", city={"name": "Singapore"}, country={"name": "Singapore"}, salaryRange={"start": None, "end": 5}, publishedAt=None, createdAt="2026-03-15T00:00:00.5Z"),
        b.dealls_item(9), {"id": "x4", "role": " "}, None,
    ]
    rows = listed(spark, "dealls", [b.capture("dealls", "listing_html", b.dealls_html(items), page=1)])
    x1, x2, x3 = rows[:3]
    assert (x1.location, x1.job_type, x1.salary_range) == ("Bandung, Indonesia", "Full Time, Contract", "IDR 10,500,000 - 13,000,000")
    assert x1.url == "https://dealls.com/loker/data-analyst~uji-co" and x1.tags == ["On Site", "SQL"]
    assert (x2.company, x2.location, x2.job_type, x2.salary_range) == ("Solo", "Remote", "Remote", "Unpaid")
    assert x2.url == "https://dealls.com/loker/seg" and x2.tags == ["Remote"]
    assert (x3.location, x3.salary_range, x3.url) == ("Singapore", "Up to IDR 5", "https://dealls.com/loker")
    assert x3.posted_at == "2026-03-15T00:00:00.5Z"
    assert [r.reject for r in rows[3:]] == ["missing job_id", "missing title", "not an object"]


def test_dealls_shapes_and_total_pages(spark):
    rows = [
        b.capture("dealls", "listing_html", b.dealls_html([b.dealls_item("a")], 3), page=1),
        b.capture("dealls", "listing_api", {"data": {"docs": [b.dealls_item("b")]}}, page=2),
        b.capture("dealls", "listing_api", {"docs": [b.dealls_item("c"), b.dealls_item("a")]}, page=3),
        b.capture("dealls", "listing_api", {"docs": [b.dealls_item("past the end")]}, page=4),
    ]
    frame = b.frame(spark, rows)
    assert ids(run(frame, scraped_at=b.CLOCK, max_pages=None).jobs) == ["a", "b", "c", "a"]
    assert ids(run(frame, scraped_at=b.CLOCK, max_pages=2).jobs) == ["a", "b"]
    rejected = [*rows[:2], b.capture("dealls", "listing_api", None, page=3, status=400)]
    assert ids(run(b.frame(spark, rejected), scraped_at=b.CLOCK, max_pages=None).jobs) == ["a", "b"]
    bounded = run(b.frame(spark, rejected), scraped_at=b.CLOCK, max_pages=3)
    assert ids(bounded.jobs) == [] and bounded.runs.first().failed_on == 3
    no_total = [b.capture("dealls", "listing_html", b.dealls_html([b.dealls_item("a")], None), page=1), rows[1]]
    assert ids(run(b.frame(spark, no_total), scraped_at=b.CLOCK, max_pages=None).jobs) == ["a"]


def test_dealls_page_statuses(spark):
    html = lambda run, body: b.capture("dealls", "listing_html", body, page=1, run=run)
    rows = [
        html("none", "<html></html>"), html("empty", '<script id="__NEXT_DATA__"> </script>'),
        html("bad", '<script type="x" id=\'__NEXT_DATA__\'>{"a":</script>'), html("other", b.script({"props": {}})),
        b.capture("dealls", "listing_api", {"data": 5}, page=1, run="api"),
    ]
    out = run(b.frame(spark, rows), scraped_at=b.CLOCK)
    assert {r.run_id: r.outcome for r in out.pages.collect()} == {
        "none": "missing_script", "empty": "empty_script", "bad": "bad_json", "other": "no_list", "api": "no_list"
    }


def test_dealls_details(spark):
    detail = {"data": {"result": {
        "location": "Jakarta", "employmentTypes": ["fullTime"], "salaryRange": {"start": 1000}, "skills": [{"name": "R"}],
        "responsibilities": "<ul><li>Lead daily work.</li><li>Talk&nbsp;to vendors.</li></ul>", "requirements": "<p>3+ years.</p><p>Calm.</p>",
    }}}
    rows = [
        b.capture("dealls", "listing_html", b.dealls_html([b.dealls_item("a", city={"name": "Solo"}), b.dealls_item("b")]), page=1),
        b.capture("dealls", "detail_api", detail, job_id="a"),
        b.capture("dealls", "detail_api", {"data": {"result": None}}, job_id="b"),
    ]
    out = run(b.frame(spark, rows), scraped_at=b.CLOCK, fetch_details=True)
    a, bb = out.jobs.orderBy("pos").collect()
    assert (a.location, a.job_type, a.salary_range, a.tags) == ("Solo", "Full Time", "From IDR 1,000", ["R"])
    assert a.description == "Responsibilities\nLead daily work.\nTalk to vendors.\n\nRequirements\n3+ years.\nCalm."
    assert bb.description is None


# glints ------------------------------------------------------------------------------------------

PLACE = {
    "name": "Kampung Uji", "level": 4,
    "parents": [{"name": "Kota Contoh", "level": 3}, {"formattedName": "Provinsi Contoh", "level": 2}, {"name": "Indonesia", "level": 1}, 5],
}


def test_glints_fields(spark):
    items = [
        b.glints_item(
            "aa-1", type="FULL_TIME", workArrangementOption="ONSITE", location=PLACE, country={"name": "ID"},
            salaries=[None, {"salaryMode": "MONTH", "minAmount": 5300000.9, "maxAmount": 5500000}],
            skills=[{"skill": {"name": "Care"}}, {"skill": None}, {"skill": {"name": "Care"}}],
        ),
        b.glints_item("aa-2", type="REMOTE", workArrangementOption="REMOTE", location=PLACE, salaryEstimate={"maxAmount": 7, "CurrencyCode": "SGD"}),
        b.glints_item("aa-3", location={"name": "Solo"}, country={"name": "Indonesia"}, hierarchicalJobCategory={"name": "Health"}, updatedAt="x"),
        b.glints_item("aa-4", "not a date"),
        b.glints_item("aa-5", None, updatedAt="2026-03-16T09:05:54.423Z", workArrangementOption="NEW_kind", city={"name": "Kudus"}),
    ]
    rows = listed(spark, "glints", [b.capture("glints", "listing_html", b.glints_html(items), page=1)])
    one, two, three, four, five = rows
    assert (one.location, one.job_type) == ("Kota Contoh, Provinsi Contoh", "Full Time, On Site")
    assert one.salary_range == "IDR 5,300,000 - 5,500,000 / Month" and one.tags == ["On Site", "Care"]
    assert one.url == "https://glints.com/id/opportunities/jobs/nurse/aa-1"
    assert (two.location, two.job_type, two.salary_range, two.tags) == ("Remote", "Remote", "Up to SGD 7", ["Remote"])
    assert (three.location, three.job_type, three.tags) == ("Solo, Indonesia", None, ["Health"])
    assert four.reject == "missing posted_at"
    assert (five.posted_at, five.location, five.tags) == ("2026-03-16T09:05:54.423Z", "Kudus", ["New Kind"])


def test_glints_links_without_cards_and_item_url(spark):
    html = b.glints_html([b.glints_item("ab-1"), b.glints_item("ab-2", url="jobs/x?y"), b.glints_item("ab-3")], links=[])
    html = html.replace("</body>", '<a href="/id/opportunities/jobs/n/ab-1?q">1</a><a href="/id/opportunities/jobs/z/ab-1">2</a></body>')
    rows = listed(spark, "glints", [b.capture("glints", "listing_html", html, page=1)])
    assert [r.url for r in rows] == ["https://glints.com/id/opportunities/jobs/n/ab-1", "https://glints.com/id/jobs/x", None]
    assert rows[2].reject == "missing url"


def test_glints_cached_search_with_references(spark):
    cache = {
        "ROOT_QUERY": {"other": 1, 'searchJobsV3({"z":1})': {"hasMore": False, "jobsInPage": None}, 'searchJobsV3({"a":1})': {"hasMore": True, "jobsInPage": [{"__ref": "Job:c1"}]}},
        "Job:c1": b.glints_item("c1", company={"__ref": "Company:1"}, location={"__ref": "Place:1"}, skills=[{"skill": {"__ref": "Skill:1"}}], salaries=[{"__ref": "Pay:1"}, {"__ref": "gone"}]),
        "Company:1": {"name": "Ref Co"}, "Place:1": {"name": "X", "parents": [{"__ref": "P"}]}, "P": {"level": 3, "name": "Batu"},
        "Skill:1": {"name": "Go"}, "Pay:1": {"minAmount": 3},
    }
    html = b.script({"props": {"pageProps": {}, "apolloCache": cache}}).replace("</body>", '<a href="/id/opportunities/jobs/n/c1">x</a></body>')
    job = listed(spark, "glints", [b.capture("glints", "listing_html", html, page=1)])[0]
    assert (job.company, job.location, job.tags, job.salary_range) == ("Ref Co", "Batu", ["Go"], "From IDR 3")
    assert job.has_more is True


def test_glints_run_stops_at_login_and_dedupes(spark):
    rows = [
        b.capture("glints", "listing_html", b.glints_html([b.glints_item("a1"), b.glints_item("a2", "2026-02-14T12:00:00Z"), b.glints_item("a3", "2026-02-14T11:59:59Z")], True), page=1),
        b.capture("glints", "listing_html", b.glints_html([b.glints_item("a1"), b.glints_item("b1")], True), page=2),
        b.capture("glints", "listing_html", b.glints_html([]), page=3, text="… Login untuk lihat loker lebih banyak\nDaftar"),
        b.capture("glints", "listing_html", b.glints_html([b.glints_item("c1")]), page=4),
    ]
    out = run(b.frame(spark, rows), "glints", scraped_at=b.CLOCK, max_pages=None)
    assert ids(out.jobs) == ["a1", "a2", "b1"]
    assert {r.page_no: r.outcome for r in out.pages.collect()} == {1: "ok", 2: "ok", 3: "login_gated", 4: "ok"}
    empty_first = run(b.frame(spark, [b.capture("glints", "listing_html", b.glints_html([]), page=1)]), "glints", scraped_at=b.CLOCK)
    assert empty_first.runs.first().failed_on == 1


def test_glints_details(spark):
    blocks = '{"blocks":[{"text":" Mencari perawat. "},{"text":""},{"text":"Ramah   sekali."}]}'
    cache = {
        "Job:d1": {"id": "d1", "type": "FULL_TIME", "workArrangementOption": "ONSITE", "location": {"__ref": "L"}, "descriptionJsonString": blocks, "skills": [{"skill": {"__ref": "S"}}]},
        "L": PLACE, "S": {"name": "Care"},
    }
    rows = [
        b.capture("glints", "listing_html", b.glints_html([b.glints_item("d1", country={"name": "Indonesia"})]), page=1),
        b.capture("glints", "detail_html", b.script({"props": {"apolloCache": cache}}), job_id="d1"),
    ]
    frame = b.frame(spark, rows)
    job = run(frame, "glints", scraped_at=b.CLOCK, fetch_details=True).jobs.first()
    assert (job.location, job.job_type, job.tags) == ("Kota Contoh, Provinsi Contoh", "Full Time, On Site", ["On Site", "Care"])
    assert job.description == "Mencari perawat.\nRamah sekali."
    # Missing location or type is filled even without details asked for; the text is not.
    plain = run(frame, "glints", scraped_at=b.CLOCK).jobs.first()
    assert plain.location == "Kota Contoh, Provinsi Contoh" and plain.description is None


# lokerid -----------------------------------------------------------------------------------------

LOKER = "2026-03-18T12:00:00Z"


def test_lokerid_fields(spark):
    items = [
        b.lokerid_item(
            41, slug="/kebun/tukang-41", location="Ternate", job_type="full_time", salary_min=1_250_000, salary_max="3100000",
            salary_currency="IDR", job_skills=["Cangkul", "Pupuk", "Cangkul"],
        ),
        {
            "id": "52", "title": "Nahkoda", "company": {"name": "CV Laut"}, "slug": "kapal-52", "city": {"name": "Bitung"}, "province": "Sulawesi Utara",
            "employment_type": "seasonal", "salary_text": "Bagi hasil", "job_skills": [{"name": "Jaring"}, {"label": "Kompas"}], "posted_at": "2 days ago",
        },
        {"attributes": {"id": "n1", "title": "Nested", "company": {"name": "PT Dalam"}, "posted_at": 1773648000, "url": "/n/nested.html", "is_remote": True, "tags": ["T"]}},
        b.lokerid_item("e", "16/03/2026 08:30", currency="usd", salary_from=5),
        b.lokerid_item("f", "no date"), b.lokerid_item("g", "2026-01-01"), {"id": "h"},
    ]
    html = b.lokerid_html(items).replace("</body>", '<a href="/a/kapal-52.html">x</a><a href="/b/kapal-52.html">y</a></body>')
    rows = listed(spark, "lokerid", [b.capture("lokerid", "listing_html", html, page=1)], LOKER)
    by_id = {r.job_id: r for r in rows}
    first = by_id["41"]
    assert (first.location, first.job_type, first.salary_range) == ("Ternate", "Full Time", "Rp 1,250,000 - Rp 3,100,000")
    assert first.url == "https://www.loker.id/kebun/tukang-41.html" and first.tags == ["Cangkul", "Pupuk"]
    assert first.posted_at == "2026-03-16T08:00:00Z" and first.description is None
    second = by_id["52"]
    assert (second.company, second.location, second.job_type) == ("CV Laut", "Bitung, Sulawesi Utara", "Seasonal")
    assert (second.salary_range, second.posted_at) == ("Bagi hasil", "2026-03-16T12:00:00Z")
    assert second.url == "https://www.loker.id/b/kapal-52.html" and second.tags == ["Jaring", "Kompas"]
    nested = by_id["n1"]
    assert (nested.company, nested.location, nested.tags) == ("PT Dalam", "Remote", ["T", "Remote"])
    assert (nested.url, nested.posted_at) == ("https://www.loker.id/n/nested.html", "2026-03-16T08:00:00Z")
    assert (by_id["e"].posted_at, by_id["e"].salary_range) == ("2026-03-16T08:30:00Z", "From USD 5")
    assert by_id["e"].url == "https://www.loker.id/cari-lowongan-kerja?jobid=e"
    assert by_id["f"].reject == "missing posted_at" and by_id["g"].reject is None and by_id["h"].reject == "missing title"


def test_lokerid_cards_only_and_api(spark):
    extra = '<div><span class="location">Depok</span><span class="job-type">Part Time</span><span class="salary">Rp 4</span></div>'
    html = b.lokerid_html(None, cards=b.lokerid_card("2001", extra=extra, tags=("Jual", "Jual", "Ramah")))
    job = listed(spark, "lokerid", [b.capture("lokerid", "listing_html", html, page=1)], LOKER)[0]
    assert (job.job_id, job.title, job.company, job.location) == ("2001", "Sales", "PT Loka", "Depok")
    assert (job.job_type, job.salary_range, job.tags) == ("Part Time", "Rp 4", ["Jual", "Ramah"])
    assert job.url == "https://www.loker.id/sales/sales-2001.html" and job.posted_at == "2026-03-16T07:00:00Z"
    linked = '<ul><li><a href="/x/77.html">Kasir</a> <b class="my-company">PT U</b><i data-posted-at="kemarin"></i></li></ul>'
    job = listed(spark, "lokerid", [b.capture("lokerid", "listing_html", b.lokerid_html(None, cards=linked), page=1)], LOKER)[0]
    assert (job.job_id, job.company, job.posted_at) == ("77", "PT U", "2026-03-17T12:00:00Z")
    body = {"data": {"jobs": [b.lokerid_item("a1")], "meta": {"current_page": 1, "last_page": 1}}}
    assert [r.job_id for r in listed(spark, "lokerid", [b.capture("lokerid", "listing_api", body, page=1)], LOKER)] == ["a1"]


def test_lokerid_merges_cards_into_records(spark):
    place = '<span class="location">{}</span>'
    cards = b.lokerid_card("m1", extra=place.format("Depok"), tags=("T",)) + b.lokerid_card("m1", extra='<i class="salary">Rp 9</i>')
    cards += b.lokerid_card("new") + b.lokerid_card("new", extra=place.format("Solo")) + b.lokerid_card("bad", posted="soon")
    html = b.lokerid_html([b.lokerid_item("m1", slug="m1"), b.lokerid_item("m2")], cards=cards)
    rows = listed(spark, "lokerid", [b.capture("lokerid", "listing_html", html, page=1)], LOKER)
    assert [(r.job_id, r.location, r.salary_range, r.tags) for r in rows if r.reject is None] == [
        ("m1", "Depok", "Rp 9", ["T"]), ("m2", None, None, []), ("new", "Solo", None, [])
    ]
    assert [r.job_id for r in rows if r.reject] == ["bad"]


def test_lokerid_pages(spark):
    page = lambda n, items, meta, run="r1": b.capture("lokerid", "listing_html", b.lokerid_html(items, meta), page=n, run=run)
    full = dict(location="X", job_type="y", salary="Rp 1", tags=["t"])
    rows = [
        page(1, [b.lokerid_item("a", **full), b.lokerid_item("old", "2026-02-16T11:59:59Z", **full)], {"current_page": 1, "last_page": 2}),
        page(2, [b.lokerid_item("a", **full), b.lokerid_item("b", "2026-02-16T12:00:00Z", **full)], {"current_page": 2, "last_page": 2}),
        page(3, [b.lokerid_item("c", **full)], {"current_page": 3, "last_page": 9}),
        # Links only in the page body: no next page is known, so the run ends.
        b.capture("lokerid", "listing_html", b.lokerid_html([b.lokerid_item("d", **full)], cards='<a href="/l?page=2">2</a><a href="?x=1&page=7">7</a>'), page=1, run="dom"),
        page(2, [b.lokerid_item("e", **full)], None, "dom"),
        # No facts at all: go on until a page has nothing recent.
        page(1, [b.lokerid_item("f", **full)], None, "bare"), page(2, [b.lokerid_item("g", **full)], None, "bare"), page(3, [b.lokerid_item("h", "2020-01-01", **full)], None, "bare"),
        page(1, [b.lokerid_item("i", **full)], {"links": [{"label": " Berikutnya ", "url": None}]}, "label"), page(2, [b.lokerid_item("j", **full)], {"next_page_url": ""}, "label"), page(3, [b.lokerid_item("k", **full)], None, "label"),
        b.capture("lokerid", "listing_html", "<html></html>", page=1, run="nothing"),
    ]
    out = run(b.frame(spark, rows), "lokerid", scraped_at=LOKER, max_pages=None)
    got = {}
    for r in out.jobs.orderBy("run_id", "page_no", "pos").collect():
        got.setdefault(r.run_id, []).append(r.job_id)
    assert got == {"r1": ["a", "b"], "dom": ["d"], "bare": ["f", "g"], "label": ["i", "j"]}
    assert {r.run_id: r.failed_on for r in out.runs.collect()}["nothing"] == 1
    assert out.pages.filter("run_id = 'dom' and page_no = 1").first().total_pages == 7


def test_lokerid_details(spark):
    listing = [b.lokerid_item("p", url="/p.html"), b.lokerid_item("q", url="/q.html"), b.lokerid_item("s", url="/s.html")]
    full = b.lokerid_item("p", location="Surabaya", job_type="full_time", salary_min=6, salary_max=9, job_skills=["Ads"], description="<p>Kelola iklan.</p><p>Tim kreatif.</p>")
    rendered = "<main><div><p>Kualifikasi</p><p>" + "rajin dan teliti " * 8 + "</p></div></main>"
    rows = [
        b.capture("lokerid", "listing_html", b.lokerid_html(listing), page=1),
        b.capture("lokerid", "detail_html", b.lokerid_html([full]), job_id="p"),
        b.capture("lokerid", "detail_html", rendered, job_id="q"),
        b.capture("lokerid", "detail_html", b.lokerid_card("s", extra='<i class="location">Solo</i>'), job_id="s"),
    ]
    frame = b.frame(spark, rows)
    p, q, s = run(frame, "lokerid", scraped_at=LOKER, fetch_details=True).jobs.orderBy("pos").collect()
    assert (p.location, p.job_type, p.salary_range, p.tags) == ("Surabaya", "Full Time", "Rp 6 - Rp 9", ["Ads"])
    assert p.description == "Kelola iklan.\nTim kreatif."
    assert q.description == "Kualifikasi\n" + ("rajin dan teliti " * 8).strip() and q.url == "https://www.loker.id/q.html"
    assert (s.location, s.description) == ("Solo", None)
    plain = run(frame, "lokerid", scraped_at=LOKER).jobs.orderBy("pos").collect()
    assert [r.location for r in plain] == ["Surabaya", None, "Solo"] and all(r.description is None for r in plain)


# all boards --------------------------------------------------------------------------------------


def test_union_and_parameter_checks(spark):
    rows = [
        b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("a")]}, page=1),
        b.capture("kitalulus", "listing_api", b.kitalulus_page([b.kitalulus_item("b")]), page=1),
        b.capture("dealls", "listing_html", b.dealls_html([b.dealls_item("c")]), page=1),
        b.capture("glints", "listing_html", b.glints_html([b.glints_item("d")]), page=1),
        b.capture("lokerid", "listing_html", b.lokerid_html([b.lokerid_item("e")]), page=1),
    ]
    frame = b.frame(spark, rows)
    jobs = run_all(frame, scraped_at=b.CLOCK)
    assert postings(jobs).columns == JOB_COLS
    assert {(r.source, r.job_id) for r in jobs.collect()} == {("karirhub", "a"), ("kitalulus", "b"), ("dealls", "c"), ("glints", "d"), ("lokerid", "e")}
    clocked = frame.withColumn("clock", F.lit(b.CLOCK))
    assert run(clocked, "karirhub", scraped_at=F.col("clock")).jobs.count() == 1
    with pytest.raises(ValueError):
        run(frame, "nowhere", scraped_at=b.CLOCK)
    with pytest.raises(ValueError):
        run(frame, scraped_at=b.CLOCK, max_pages=0)
    for clock in ("yesterday", "2026-13-45T12:00:00Z", "2026-02-30"):
        with pytest.raises(ValueError):
            run(frame, scraped_at=clock)
    no_clock = run(frame, "karirhub", scraped_at=F.lit("2026-13-45T12:00:00Z"))
    assert no_clock.jobs.count() == 0 and [r.reject for r in no_clock.rejects.collect()] == ["missing scraped_at"]


def test_captures_without_page_and_repeated_attempts(spark):
    good = b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("a")]}, page=1)
    lost = b.capture("karirhub", "listing_api", None, page=1, status=503)
    nowhere = b.capture("karirhub", "listing_api", {"data": [b.karirhub_item("n")]}, page=None)
    out = run(b.frame(spark, [lost, good, good, nowhere]), "karirhub", scraped_at=b.CLOCK)
    assert [r.job_id for r in out.jobs.collect()] == ["a"]
    assert [(r.last_kept, r.failed_on, r.jobs) for r in out.runs.filter("last_kept > 0 OR failed_on IS NOT NULL").collect()] == [(1, None, 1)]
    assert [(r.job_id, r.reject) for r in out.rejects.collect()] == [("n", "missing page_no")]


def test_payloads_are_read_once(spark):
    """Paths are not looked up again wherever a value is used."""
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().lower().count("variant_get")
    frame = b.frame(spark, [b.capture("karirhub", "listing_api", {"data": []}, page=1)])
    assert count(normalize(frame, "karirhub", b.CLOCK)) <= 60
    assert count(normalize(frame, "glints", b.CLOCK)) <= 130


def test_lokerid_slug_links_and_large_page(spark):
    """The last of equal links counts; a page of thousands of records merges in seconds, as lookups are indexed."""
    from postlake.functions.lists import index_by
    from postlake.sources import lokerid

    row = spark.sql("SELECT array('/a/x.html', '/b/y.html', '/c/x.html', '/cari-lowongan-kerja/x.html', '/z') AS links, array('p', NULL, 'q', 'p', '') AS k")
    got = row.select(lokerid.slug_links(F.col("links")).alias("m"), index_by(F.col("k")).alias("i")).first()
    assert got.m == {"x": "/c/x.html", "y": "/b/y.html"} and got.i == {"p": [0, 3], "q": [2], "": [4]}

    n = 6000
    one = lambda key, place: F.struct(
        *[(F.concat(F.lit("j"), key.cast("string")) if f == "job_id" else F.lit(place) if f == "location" else F.lit(None).cast("timestamp") if f == "posted_ts"
           else F.array().cast("array<string>") if f == "tags" else F.lit(None).cast("string")).alias(f) for f in lokerid.PARSED]
    )
    page = spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: one(i, None)).alias("loaded"),
        F.transform(F.sequence(F.lit(n // 2), F.lit(2 * n)), lambda i: one(i, "Kota")).alias("carded"),
    )
    start = time.monotonic()
    merged = page.select(F.inline(lokerid.merge_page(F.col("loaded"), F.col("carded")))).groupBy("location").count().collect()
    assert {r.location: r["count"] for r in merged} == {None: n // 2 - 1, "Kota": n // 2 + 1 + n}
    assert time.monotonic() - start < 20
