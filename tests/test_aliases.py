"""Records read as Columns against the walk over the parsed text."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from postlake.functions import aliases, records
from postlake.sources import lokerid

COLUMNS = [*records.ALIASES["id"][:3], *records.ALIASES["title"][:4], "published_at", "createdAt", *records.ALIASES["slug"], "url", "lokasi", "kota",
           "job_type", "gaji", "salary_min", "salary_max", "currency", *records.COMPANY[:4], "employer", *records.REMOTE[:5], *records.TAGS[:4], *records.BODY[:3], *records.AREAS, "other", "label"]


def value(rng, depth=0):
    pick = rng.random()
    if depth < 4 and pick < 0.12:
        return {rng.choice(COLUMNS): value(rng, depth + 1) for _ in range(rng.randrange(4))}
    if depth < 4 and pick < 0.22:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return rng.choice([None, "", " ", "teks", " Kota B ", "remote", "REMOTE", True, False, 0, 7, -3, 5.0, 2.5, 1e3, 10**25, "12", "1_000", " 8 ", "é ", "{\"a\":1}", "[1]", "20260316", 1773648000])


def record(rng):
    keys = rng.sample(COLUMNS, rng.randrange(3, 14))
    if rng.random() < 0.8:
        keys += ["id", "title", rng.choice(["company", "perusahaan", "employer"])]
    rng.shuffle(keys)
    made = {k: value(rng) for k in keys}
    for k, text in (("id", "j1"), ("title", "Juru"), ("company", {"name": "PT A"})):
        if k in made and rng.random() < 0.7:
            made[k] = text
    return made


def context(rng):
    jobs = [record(rng) for _ in range(rng.randrange(4))] + ([7] if rng.random() < 0.1 else [])
    meta = {k: value(rng) for k in rng.sample(records.META, rng.randrange(3))} if rng.random() < 0.6 else {"x": 1}
    shape = rng.randrange(8)
    if shape < 3:
        route = {"jobs": jobs, "meta": meta}
        return {"state": {"loaderData": {"root": rng.choice([None, {"user": {"links": 1}}, {"a": 1}, "s", {"jobs": []}]), "routes/list": route, "z": {"jobs": [{"id": 9}]}}}}
    if shape == 3:
        return {rng.choice(records.RECORD_LISTS): jobs, rng.choice(records.RECORD_LISTS): rng.choice([[], "x", [{"id": 1, "name": "n"}]]), "total": 3}
    if shape == 4:
        return {"a": {"b": [1, {"c": {"items": jobs}}]}, "d": {"meta": {"q": {"last_page": 4}}, "total_": 2}, "meta2": {"last_page": 9}}
    if shape == 5:
        return {"wrap": [jobs, [record(rng)]], "meta": meta}
    if shape == 6:
        return {"state": rng.choice(["x", {"loaderData": rng.choice([None, [], {"r": {"job": record(rng)}}])}]), "page": {"links": []}}
    return record(rng)


def texts(rng, n):
    made = [json.dumps(context(rng), ensure_ascii=rng.random() < 0.5) for _ in range(n)]
    odd = ['{"a":1}; more {}', '{"id":1,"id":2}', "{bad", '{"a":NaN}', "[1]", "{}", " {\"jobs\":[{\"id\":1}]} \n"]
    return [[t] for t in made] + [[t] for t in odd] + [["{bad", made[0]], [], [made[1], made[0]], None]


def both(spark, read, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, contexts array<string>").repartition(8)
    known = read(df, F.col("contexts"), lokerid.RECORD).select("i", "_known.exact", F.struct("_known.records", "_known.meta").alias("own"))
    whole = lokerid.with_records(df, F.col("contexts"), "script", read).select("i", "script")
    return known.join(whole, "i").orderBy("i").collect()


def plain(row):
    return None if row is None else row.asDict(recursive=True)


def test_listing_records(spark):
    rows = texts(random.Random(11), 300)
    exact = 0
    for r in both(spark, aliases.with_listing_records, rows):
        parsed = records.first_object(rows[r.i] or [])
        want, meta = records.listing_records(parsed), records.page_meta(parsed)
        exact += r.exact
        for got in [r.script, *([r.own] if r.exact else [])]:
            assert [plain(x) for x in got.records] == want, rows[r.i]
            facts = {k: v for k, v in json.loads(got.meta or "{}").items() if k in records.META}
            assert facts == meta, rows[r.i]
    assert exact > 150


def test_detail_record(spark):
    rows = texts(random.Random(12), 300)
    exact = 0
    for r in both(spark, aliases.with_detail_record, rows):
        want = records.detail_record(records.first_object(rows[r.i] or []))
        exact += r.exact
        for got in [r.script, *([r.own] if r.exact else [])]:
            assert [plain(x) for x in got.records] == ([] if want is None else [want]), rows[r.i]
    assert exact > 60


def test_flat_and_usual_records_meet_no_python(spark):
    """Records with a company object, lists of named tags and a meta object, as pages have them, are read by Columns alone."""
    usual = {"id": 5, "title": "Juru", "company": {"name": "PT A", "logo": {"url": "x"}}, "posted_at": "2026-03-16", "skills": [{"name": "a"}, "b"], "city": {"label": "Kota"}}
    flat = {"jobid": "7", "judul": "Juru", "perusahaan": "PT B", "tanggal_posting": "kemarin", "gaji": "Rp 1"}
    page = {"state": {"loaderData": {"root": {"a": 1}, "routes/list": {"jobs": [usual, flat], "meta": {"last_page": 3, "links": [{"url": "?page=3"}]}}}}}
    detail = {"state": {"loaderData": {"routes/job": {"job": usual}}}}
    df = spark.createDataFrame([([json.dumps(page)], [json.dumps(detail)])], "page array<string>, detail array<string>")
    p = aliases.with_listing_records(df, F.col("page"), lokerid.RECORD).first()["_known"]
    d = aliases.with_detail_record(df, F.col("detail"), lokerid.RECORD).first()["_known"]
    assert p.exact and d.exact
    assert [r.id for r in p.records] == ["5", "7"] and [r.company for r in p.records] == ["PT A", "PT B"] and p.records[0].areas == ["Kota"]
    assert [r.tags for r in d.records] == [["a", "b"]]
    # Exact rows hand Python a NULL in place of their texts.
    plan = lokerid.with_records(df, F.col("page"), "script")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "CASE WHEN NOT" in plan
