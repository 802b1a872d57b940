"""Single functions with literal expected values."""

from __future__ import annotations

import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from postlake.functions import dates, lists, markup, money, payload, records, text, urls
from postlake.operators.merge import more_specific
from postlake.sources import karirhub, kitalulus


def apply(spark, function, values, ddl="v string"):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    df = spark.createDataFrame(rows, ddl).coalesce(1)
    return [r[0] for r in df.select(function(*[F.col(c) for c in df.columns])).collect()]


def test_clean_and_labels(spark):
    wide = "".join(map(chr, text.BLANK_CODES))
    assert apply(spark, text.clean, [f"{wide} a b {wide}", wide, "", None, "x"]) == ["a b", None, None, None, "x"]
    # The set is what Python itself strips.
    assert all(chr(c).isspace() for c in text.BLANK_CODES) and sum(chr(c).isspace() for c in range(0x110000)) == len(text.BLANK_CODES)
    values = ["fullTime", "full_time", "full-time", "FULL_TIME", "onSite_full-Time", " a  b ", "o'neil x.y", "aBCd"]
    assert apply(spark, text.humanize, values) == [
        "Full Time", "Full Time", "Full Time", "Full Time", "On Site Full Time", "A B", "O'neil X.y", "A Bcd"
    ]
    assert apply(spark, text.slugify, [" Backend  Engineer II ", "A\tb"]) == ["backend-engineer-ii", "a-b"]


def test_html_text(spark):
    values = [
        "<p>Hello <b>world</b></p>", "Second&nbsp; line<br>Third line", "<style>a{}</style><script>x</script><!-- c --> ",
        "<template><p>no</p></template>yes", "a &lt; b &amp; c", "1 < 2", None, "<ul><li>A</li><li> B </li></ul>",
    ]
    assert apply(spark, lambda c: text.html_text(c), values) == [
        "Hello\nworld", "Second line\nThird\nline", None, "yes", "a < b & c", "1 < 2", None, "A\nB"
    ]
    assert apply(spark, lambda c: text.text_lines(c), [" a  b <br> <i>c</i>"]) == [["a  b", "c"]]


def test_fast_markup_equals_tolerant_parser():
    parts = [
        "<p>", "</p>", "<b class='x y'>", "</b>", "a &amp; b", "&nbsp;", "<br>", "<br/>", "<div id=q data-x>", "</div>", "<!-- c -->",
        "<script>var a='<p>';</script>", "<style>x</style>", "<", "> ", "&#65;&bogus;", '<a href="/x?a=1&amp;b=2">', "</a>", "<template><i>",
        "</i></template>", "<!DOCTYPE html>", "  t\n", "</x>", "<P CLASS=Z>", "<!-- a -- b -->", "<img src=/a/b.png>", "<a href=x/>", "<script>", "<>", '<a b="1"c>',
    ]

    def shape(node):
        return node.tag, node.attrs, [c if isinstance(c, str) else shape(c) for c in node.children]

    rnd = random.Random(7)
    for _ in range(3000):
        html = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9)))
        tree = markup.parse_any(html)
        assert shape(markup.parse(html)) == shape(tree), html
        split = [line.strip() for t in tree.texts() for line in t.splitlines()]
        assert markup.lines(html) == [line for line in split if line], html


def test_iso_dates(spark):
    values = [
        "2026-03-16T19:00:00+07:00", "2026-03-16", "2026-03-16T12:00:00.715Z", "2026-03-16 12:00", "2026-03", " 2026-03-16", "2026-02-30", "", None, "x",
    ]
    got = apply(spark, lambda c: dates.render_utc(dates.parse_iso(c)), values)
    assert got == ["2026-03-16T12:00:00Z", "2026-03-16T00:00:00Z", "2026-03-16T12:00:00.715000Z", "2026-03-16T12:00:00Z"] + [None] * 6


def test_recency_bounds(spark):
    clock = F.lit("2026-03-16T12:00:00Z").cast("timestamp")
    values = ["2026-02-14T12:00:00Z", "2026-02-14T11:59:59Z", "2026-03-16T12:00:00Z", "2026-03-16T12:00:01Z", None]
    assert apply(spark, lambda c: dates.is_recent(dates.parse_iso(c), clock), values) == [True, False, True, False, False]


def test_epochs(spark):
    show = lambda f: lambda c: dates.render_utc(f(c))
    assert apply(spark, show(dates.from_seconds), [1773648000, 10**15, None], "v bigint") == ["2026-03-16T08:00:00Z", None, None]
    assert apply(spark, show(dates.from_micros), [1773720667000000, 999999999999999999], "v bigint") == ["2026-03-17T04:11:07Z", None]
    values = [1773648000.0, 1773648000123.0, 1773648000123456.0, 1.5, -86400.0, 1e20]
    assert apply(spark, show(dates.from_epoch), values, "v double") == [
        "2026-03-16T08:00:00Z", "2026-03-16T08:00:00.123000Z", "2026-03-16T08:00:00.123456Z", "1970-01-01T00:00:01.500000Z", "1969-12-31T00:00:00Z", None,
    ]


WRITTEN = "%Y-%m-%d %d-%m-%Y %d/%m/%Y %d_%b_%Y %d_%B_%Y".split()


def test_written_dates(spark):
    moment = datetime(2026, 3, 5, 7, 8, 9, tzinfo=timezone.utc)
    values, want = [], []
    for day in WRITTEN:
        for clock in ("", " %H:%M", " %H:%M:%S"):
            shape = day.replace("_", " ") + clock
            shown = moment.strftime(shape)
            values.append(shown)
            want.append(datetime.strptime(shown, shape).strftime("%Y-%m-%dT%H:%M:%SZ"))
    values += ["5/3/2026", "5 MARCH 2026", "31/02/2026", "5 Maret 2026", "5-3/2026", "2026-03-05x", None, "May 5 2026"]
    want += ["2026-03-05T00:00:00Z", "2026-03-05T00:00:00Z"] + [None] * 6
    assert apply(spark, lambda c: dates.render_utc(dates.parse_written(c)), values) == want


def test_relative_dates(spark):
    base = F.lit("2026-03-18T12:00:00Z").cast("timestamp")
    cases = {
        "2 days ago": "2026-03-16T12:00:00Z", "Dipasang 3 JAM lalu": "2026-03-18T09:00:00Z", "10menit lalu": "2026-03-18T11:50:00Z", "1 minggu lalu": "2026-03-11T12:00:00Z",
        "2 bulan lalu": "2026-01-17T12:00:00Z", "1 year ago": "2025-03-18T12:00:00Z", " Kemarin ": "2026-03-17T12:00:00Z", "hari ini": "2026-03-18T12:00:00Z",
        "0 hari yang lalu": None, "soon": None, "99999999999999999999 years ago": None, "3000 years ago": None, "2 days ago, 5 minutes ago": "2026-03-18T11:55:00Z",
    }
    assert apply(spark, lambda c: dates.render_utc(dates.parse_relative(c, base)), list(cases)) == list(cases.values())


def test_posted_prefers_numbers(spark):
    base = F.lit("2026-03-18T12:00:00Z").cast("timestamp")
    number, written = zip(*map(records.posted, [1773648000, "20260316", "2026-03-16", 5.0, True, None, {"a": "1 day ago"}, " 1_000 "]))
    assert number == (1773648000.0, 20260316.0, None, 5.0, None, None, None, 1000.0)
    got = apply(spark, lambda n, t: dates.render_utc(dates.parse_posted(n, t, base)), list(zip(number, written)), "n double, t string")
    assert got == [
        "2026-03-16T08:00:00Z", "1970-08-23T11:51:56Z", "2026-03-16T00:00:00Z", "1970-01-01T00:00:05Z", None, None, "2026-03-17T12:00:00Z", "1970-01-01T00:16:40Z",
    ]


def test_money(spark):
    span = lambda lo, hi: money.span(lo, hi, F.lit("IDR "), repeat_prefix=False)
    assert apply(spark, span, [(10_500_000, 13_000_000), (5, None), (None, 7), (None, None)], "a bigint, b bigint") == [
        "IDR 10,500,000 - 13,000,000", "From IDR 5", "Up to IDR 7", None
    ]
    assert apply(spark, money.plus_span, [(5_000_000, 0), (0, 9), (1, 2), (0, 0)], "a bigint, b bigint") == ["Rp 5,000,000+", "Up to Rp 9", "Rp 1 - Rp 2", None]
    assert apply(spark, money.currency_label, [None, "idr", " rp ", "usd"]) == ["Rp", "Rp", "Rp", "USD"]
    assert apply(spark, money.lenient_int_text, ["12", " +1_000 ", "-3", "1.0", "x", None, "9" * 30]) == [12, 1000, -3, None, None, None, None]
    assert [records.whole(v) for v in (5, 5.0, 5.5, True, None, " 7 ", "x", [1], 2**70)] == [5, 5, None, None, None, 7, None, None, None]
    assert [records.label(v) for v in (5, 5.0, 5.5, True, None, " a ", "")] == ["5", "5", "5.5", None, None, "a", None]


def test_karirhub_card_salary(spark):
    pay = lambda card: karirhub.salary(card, F.lit(True), F.lit(1).cast("bigint"), F.lit(None).cast("bigint"))
    assert apply(spark, pay, ["Dirahasiakan", "Rp 3", None]) == [None, "Rp 3", "From Rp 1"]
    assert apply(spark, kitalulus.page_estimate, [1510, 20, 0, 1], "v bigint") == [76, 1, 0, 1]


def test_urls(spark):
    base = "https://www.loker.id/cari-lowongan-kerja"
    cases = {
        "/a/b.html": "https://www.loker.id/a/b.html", "b.html": "https://www.loker.id/b.html", "?jobid=7": base + "?jobid=7", "//x.id/y": "https://x.id/y",
        "HTTP://x/y": "HTTP://x/y", "mailto:a": "mailto:a", "#t": base + "#t", "": base,
    }
    assert apply(spark, lambda c: urls.resolve(base, c), list(cases)) == list(cases.values())
    links = ["/c?jobid=5&id=6", "/c?x=1&job_id=8", "/a/77.html", "/a/b-77.html", "/c?jobid=#x", "/77.html?q"]
    assert apply(spark, urls.id_from_link, links) == ["5", "8", "77", None, None, "77"]
    pages = lambda c: F.array_max(urls.page_numbers(F.split(c, " ")))
    assert apply(spark, pages, ["/l?page=2 ?x=1&page=12 ?page=x", "/l", "?mypage=3"]) == [12, None, None]


def test_lists(spark):
    lines = "A,x,B,y,z,C,A,q,End"
    split = lambda c: F.split(c, ",")
    assert apply(spark, lambda c: lists.line_after(split(c), "A"), [lines, "x,A", "x"]) == ["x", None, None]
    assert apply(spark, lambda c: lists.section(split(c), "B", ["End", "C"]), [lines, "B", "B,1,2", "x"]) == [["y", "z"], [], ["1", "2"], []]
    assert apply(spark, lambda a, b: lists.distinct_join(", ", a, b), [("x", "x"), ("x", None), (None, None), ("x", "y")], "a string, b string") == ["x", "x", None, "x, y"]
    assert apply(spark, lambda c: lists.tag_list(split(c), F.lit(None).cast("array<string>"), F.array(F.lit("b"))), ["c,b,c"]) == [["c", "b"]]


def test_specific_location(spark):
    cases = [("Indonesia", "X"), ("X", "Indonesia"), (None, "X"), ("X", None), ("A, B", "C"), ("C", "A, B"), ("X", "X")]
    assert apply(spark, more_specific, cases, "a string, b string") == ["X", "X", "X", "X", "A, B", "A, B", "X"]


@pytest.mark.parametrize("value,as_text,as_int,as_amount,counts", [
    ('"a"', "a", None, None, True), ('""', "", None, None, False), ("5", None, 5, 5, True), ("5.9", None, None, 5, True), ("true", None, None, None, True),
    ("false", None, None, None, False), ("null", None, None, None, False), ("[]", None, None, None, False), ('{"b":1}', None, None, None, True), ("0", None, 0, 0, False),
])
def test_typed_payload_access(spark, value, as_text, as_int, as_amount, counts):
    def read(c):
        doc = F.try_parse_json(c)
        return F.struct(payload.text_at(doc, "$.v"), payload.int_at(doc, "$.v"), payload.amount_at(doc, "$.v"), payload.truthy(payload.at(doc, "$.v")))

    assert tuple(apply(spark, read, ['{"v":%s}' % value])[0]) == (as_text, as_int, as_amount, counts)


def test_text_or_stops_at_any_value(spark):
    pick = lambda c: payload.text_or(F.try_parse_json(c), "$.a", "$.b")
    assert apply(spark, pick, ['{"a":"","b":"x"}', '{"a":" ","b":"x"}', '{"a":5,"b":"x"}', '{"a":0,"b":"x"}', '{"b":7}', "bad"]) == ["x", " ", None, "x", None, None]


def test_script_context_and_records():
    assert records.first_object(["{bad", "[1]", '{"a":1}', '{"b":2}']) == {"a": 1}
    assert records.first_object(['{"a":1}; more {}']) is None
    nested = {"x": [1, {"results": [3, {"id": 1}]}], "list": []}
    assert records.job_records(nested) == [{"id": 1}] and records.job_records({"a": 1}) is None
    assert records.job_records([[{"id": 1}, {"id": 2}]]) == [{"id": 1}, {"id": 2}]
    assert records.page_meta({"meta": {"x": 1}, "y": {"total": 3}}) == {}
    assert records.page_meta({"a": {"meta": {"last_page": 3, "z": 1}}}) == {"last_page": 3}
    # Deep lookup: this level first by alias order, then below in written order.
    nodes = records.objects({"b": {"title": "deep"}, "name": "flat", "position": ""})
    assert records.find(nodes, ("title", "name")) == "flat" and records.find(nodes, ("title",)) == "deep"


def test_inner_record_used_when_outer_is_no_job():
    outer = {"company": 5, "job": {"id": "i", "title": "T", "company": "C", "posted_at": "2026-03-16"}}
    first, second = records.listing_records({"jobs": [outer]})
    assert first["company"] is None and (second["company"], second["alt"]) == ("C", True)


def test_description_block_of_nested_pages():
    """The first block in the page's order that is long enough and holds a keyword, found without reading nested text again."""
    import random
    import time

    def by_block(html):
        root = markup.parse(html)
        main = markup.first(root, markup.tag("main"), markup.tag("article"))
        for block in main.walk() if main else ():
            if block.tag in ("div", "section"):
                found = block.text("\n") or ""
                if len(found) > markup.DESCRIPTION_MIN_CHARS and any(w in found for w in markup.DESCRIPTION_WORDS):
                    return markup.plain_text(found)
        return None

    rng = random.Random(5)
    for _ in range(400):
        html, open_ = "<main>", []
        for _ in range(rng.randrange(40)):
            pick = rng.random()
            if pick < 0.35:
                open_.append(rng.choice(["div", "section", "p", "span"]))
                html += f"<{open_[-1]}>"
            elif pick < 0.6 and open_:
                html += f"</{open_.pop()}>"
            else:
                html += rng.choice([" Kualifikasi ", "teks " * 12, "Tanggung Jawab", " ", "<script>Kualifikasi " + "x" * 120 + "</script>", "&amp; <br>"])
        assert markup.described(markup.parse(html)) == by_block(html), html
    start = time.monotonic()
    deep = "<main>" + "<div>kata " * 3000 + "Kualifikasi" + "</div>" * 3000
    assert markup.described(markup.parse(deep)).endswith("Kualifikasi") and time.monotonic() - start < 5
