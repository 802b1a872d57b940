"""Captures derived from the test tables, in each board's shape.

Table rows become posting items; 20 or fewer neighbouring keys make a page, so packing a page never
collects more than that. Page bodies are what a crawler would have landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.sources.schema import CAPTURE_DDL

CLOCK = "2026-03-16T12:00:00Z"
CLOCK_SECONDS = 1773662400
DAY = 86400


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def days_ago(key: Column, cycle: int) -> Column:
    """Epoch seconds 0 to ``cycle - 2`` days before the clock; the last of each cycle lies one second ahead."""
    step = (key % cycle).cast("bigint")
    return F.when(step == cycle - 1, F.lit(CLOCK_SECONDS + 1)).otherwise(F.lit(CLOCK_SECONDS) - step * DAY)


def iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def captures(rows: DataFrame, **given: Column) -> DataFrame:
    """Capture rows; columns not given are NULL."""
    fields = [f.split() for f in CAPTURE_DDL.split(", ")]
    return rows.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Pages are few bytes and much work to write and parse: dealt by key over the session's partitions, which are not merged by size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pack(rows: DataFrame, key: str, per_page: int, pages: int, item: Column, *more: str) -> DataFrame:
    """(run, page_no, items as JSON texts in key order); ``more`` columns are equal within a page."""
    keyed = rows.withColumns({
        "run": F.expr(f"{key} div {per_page * pages}"), "page_no": F.expr(f"cast({key} % {per_page * pages} div {per_page} + 1 as int)"),
    })
    # The items are written where the pages lie, not in the few tasks that read the table.
    items = dealt(keyed, "run", "page_no").select("run", "page_no", F.col(key).alias("key"), F.to_json(item).alias("item"), *more)
    packed = items.groupBy("run", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("key", "item"))).alias("packed"), *[F.max(c).alias(c) for c in more]
    )
    return packed.withColumn("items", F.transform("packed", lambda p: p["item"])).drop("packed")


def json_list(items: str = "items") -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def run_id(run: Column) -> Column:
    return text("r", run)


def karirhub(spark: SparkSession, sf: str) -> DataFrame:
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    rows = table(spark, sf, "orders")
    item = F.struct(
        text("c", cust).alias("id"), F.col("o_orderpriority").alias("title"),
        F.when(key % 50 == 0, "  ").otherwise(text("PT ", status)).alias("company_name"),
        days_ago(key, 37).alias("published_at"), (status == "O").alias("show_salary"),
        F.floor("o_totalprice").alias("min_salary_amount"), F.when(key % 3 == 0, F.floor(F.col("o_totalprice") * 2)).alias("max_salary_amount"),
        F.when(status != "P", text("Kota ", cust % 10)).alias("city_name"),
        F.array(F.col("o_orderpriority"), F.lit(" kerja "), F.col("o_orderpriority")).alias("skills"),
    )
    pages = pack(rows, "o_orderkey", 20, 100, item)
    # One scalar among the items of every page.
    body = text('{"data":[7,', F.array_join("items", ","), "]}")
    lines = [
        "Lowongan dalam negeri", F.col("o_orderpriority"), "Bandung, Jawa Barat", "Rentang gaji", "Rp 7", "Jenis pekerjaan", "Kontrak",
        "Deskripsi Pekerjaan", text("Isi ", key), "Keterampilan", "A", "B", "A", "Lowongan dari", "Lain",
    ]
    html = text("<html><body><main>", *[p for line in lines for p in ("<div> ", line, "</div>\n")], "</main></body></html>")
    details = captures(
        dealt(rows.filter(status == "P"), "o_orderkey"), source=F.lit("karirhub"), run_id=run_id(F.expr("o_orderkey div 2000")), kind=F.lit("detail_html"),
        job_id=text("c", cust), fetched_at=F.timestamp_seconds(key), body=html,
    )
    listing = captures(pages, source=F.lit("karirhub"), run_id=run_id(F.col("run")), kind=F.lit("listing_api"), page_no=F.col("page_no"), body=body)
    return listing.unionByName(details)


def kitalulus(spark: SparkSession, sf: str, age: int = 0) -> DataFrame:
    """``age`` moves all postings so many days back."""
    key, size = F.col("p_partkey"), F.col("p_size")
    price = F.floor("p_retailprice")
    item = F.struct(
        F.when(key % 60 != 0, text("K", key)).alias("code"), F.col("p_name").alias("positionName"), F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"),
        F.struct(F.col("p_brand").alias("name")).alias("company"), ((days_ago(key, 37) - age * DAY) * 1_000_000 + key).alias("updatedAt"),
        F.when(size % 2 == 0, F.struct(F.col("p_type").alias("name"))).alias("city"), F.struct(F.lit("DKI Jakarta").alias("name")).alias("province"),
        F.when(size % 3 == 0, "Penuh Waktu ").alias("typeStr"), F.lit("PART_TIME").alias("type"),
        F.when(size % 4 != 0, price).otherwise(F.lit(0)).alias("salaryLowerBound"), F.when(size % 4 > 1, price * 2).otherwise(F.lit(0)).alias("salaryUpperBound"),
        F.lit("Dapat Dinegosiasikan").alias("salaryLowerBoundStr"), F.when(size % 5 == 0, "Dinegosiasikan").otherwise("9 jt").alias("salaryUpperBoundStr"),
        F.struct(F.col("p_type").alias("displayName")).alias("jobRole"), F.struct(F.col("p_type").alias("displayName")).alias("jobSpecialization"),
        F.col("p_brand").alias("jobFunction"), F.when(size % 7 == 0, "S1").alias("educationLevelStr"),
        F.when(size % 2 == 1, text("<p>Tugas &amp; peran:</p><ul><li>", F.col("p_name"), "</li><li>No.  ", key, "</li></ul>")).alias("formattedDescription"),
        text(" Usia ", size, " ").alias("requirementStr"),
    )
    pages = pack(table(spark, sf, "part"), "p_partkey", 20, 20, item)
    body = text('{"data":{"vacanciesV3":{"elements":400,"hasNextPage":', F.col("page_no") % 17 != 0, ',"list":', json_list(), "}}}")
    return captures(pages, source=F.lit("kitalulus"), run_id=run_id(F.col("run")), kind=F.lit("listing_api"), page_no=F.col("page_no"), body=body)


def dealls(spark: SparkSession, sf: str) -> DataFrame:
    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    rows = table(spark, sf, "customer")
    pay = F.floor("c_acctbal")
    item = F.struct(
        text("d", key).alias("id"), text(" ", F.col("c_name"), " ").alias("role"), F.when(key % 2 == 0, F.lower(segment)).alias("slug"), segment.alias("slugPrimarySegment"),
        F.when(key % 3 != 0, F.struct(text("Co ", nation).alias("name"), text("co-", nation).alias("slug"))).alias("company"),
        F.when(key % 45 != 0, F.struct(text("Author ", nation).alias("name"))).alias("author"),
        F.when(nation % 4 != 0, F.struct(text("City ", nation).alias("name"))).alias("city"),
        F.when(nation % 8 != 0, F.struct(text("City ", nation - nation % 2).alias("name"))).alias("country"),
        F.when(key % 4 < 2, F.array(F.lit("fullTime"), F.lit("contract_based"))).alias("employmentTypes"),
        F.when(key % 5 < 2, "remote").when(key % 5 < 4, "onSite").alias("workplaceType"), F.when(key % 11 == 0, "unpaid").otherwise("paid").alias("salaryType"),
        F.struct(F.when(key % 2 == 0, pay).alias("start"), F.when(key % 6 < 3, pay + 1000).alias("end")).alias("salaryRange"),
        F.array(F.struct(segment.alias("name")), F.struct(F.lit(" ").alias("name")), F.struct(segment.alias("name"))).alias("skills"),
        iso(days_ago(key, 37)).alias("publishedAt"),
    )
    pages = pack(rows, "c_custkey", 15, 20, item)
    first = text(
        '<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"dehydratedState":{"queries":[{"queryKey":["/x"]},',
        '{"queryKey":["/v1/explore-job/job",{}],"state":{"data":{"pages":[{"totalPages":18,"docs":', json_list(), "}]}}}]}}}}</script></html>",
    )
    html = F.col("page_no") == 1
    listing = captures(
        pages, source=F.lit("dealls"), run_id=run_id(F.col("run")), page_no=F.col("page_no"), kind=F.when(html, "listing_html").otherwise("listing_api"),
        status_code=F.when((F.col("page_no") == 16) & (F.col("run") % 2 == 1), 400).otherwise(200),
        body=F.when(html, first).otherwise(text('{"data":{"docs":', json_list(), "}}")),
    )
    result = F.to_json(F.struct(F.struct(F.struct(
        text("Place ", nation).alias("location"), F.array(F.lit("internship")).alias("employmentTypes"), F.struct(F.lit(5).alias("start")).alias("salaryRange"),
        F.array(F.struct(F.lit("Skill").alias("name"))).alias("skills"), text("<p>About ", segment, "</p>").alias("description"),
        F.when(key % 4 == 0, "<ul><li>Lead.</li><li>Care&nbsp;more.</li></ul>").alias("responsibilities"), F.lit("").alias("requirements"),
    ).alias("result")).alias("data")))
    details = captures(
        dealt(rows.filter(segment != "BUILDING"), "c_custkey"), source=F.lit("dealls"), run_id=run_id(F.expr("c_custkey div 300")), kind=F.lit("detail_api"),
        job_id=text("d", key), fetched_at=F.timestamp_seconds(key), body=result,
    )
    return listing.unionByName(details)


def glints(spark: SparkSession, sf: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    level = lambda n, c: F.struct(F.lit(n).alias("level"), c.alias("formattedName"))
    ref = lambda *parts: F.struct(text(*parts).alias("__ref"))
    place = F.struct(F.lit("Area").alias("name"), F.array(level(3, F.col("p_brand")), level(2, F.col("p_type")), level(1, F.lit("ID"))).alias("parents"))
    job = lambda company: (
        text("ab-", key % 300).alias("id"), F.col("p_name").alias("title"), company.alias("company"), iso(days_ago(key, 37)).alias("createdAt"),
        F.when(size % 3 != 0, "FULL_TIME").alias("type"), F.when(size % 2 == 0, "ONSITE").when(size % 5 == 0, "REMOTE").alias("workArrangementOption"),
        F.when(size % 4 != 0, place).alias("location"),
        F.array(F.struct(F.lit("MONTH").alias("salaryMode"), F.floor("p_retailprice").alias("minAmount"), F.when(size % 2 == 0, F.col("p_retailprice") * 2).alias("maxAmount"))).alias("salaries"),
        F.struct(F.col("p_type").alias("name")).alias("hierarchicalJobCategory"),
    )
    direct = F.struct(*job(F.struct(F.col("p_brand").alias("name"))))
    linked = F.struct(*job(ref("Company:", F.replace("p_brand", F.lit("Brand#"), F.lit("")))))
    odd = F.expr("p_partkey % 500 div 10 % 2 = 0")
    rows = table(spark, sf, "part")
    item = F.struct(
        F.when(odd, F.to_json(direct)).otherwise(F.to_json(linked)).alias("job"), text("ab-", key % 300).alias("id"), F.col("p_brand").alias("brand"), key.alias("key")
    )
    pages = pack(rows, "p_partkey", 10, 50, item)
    items = F.from_json(json_list(), "array<struct<job:string,id:string,brand:string,key:bigint>>")
    pages = pages.withColumn("parts", items)
    jobs = F.array_join(F.transform("parts", lambda p: p["job"]), ",")
    companies = F.array_join(
        F.transform(
            F.array_distinct(F.transform("parts", lambda p: p["brand"])),
            lambda b: text('"Company:', F.replace(b, F.lit("Brand#"), F.lit("")), '":{"__typename":"Company","name":"', b, '"}'),
        ), ",",
    )
    more = text('"hasMore":', F.col("page_no") % 43 != 0)
    direct_data = text('{"props":{"pageProps":{"initialJobs":{', more, ',"jobsInPage":[', jobs, "]}}}}")
    linked_data = text('{"props":{"apolloCache":{', companies, ',"ROOT_QUERY":{"x":1,"searchJobsV3({})":{', more, ',"jobsInPage":[', jobs, "]}}}}}")
    data = F.when(F.col("page_no") % 2 == 1, direct_data).otherwise(linked_data)
    link = lambda p: text("/id/opportunities/jobs/p", p["key"], "/", p["id"], "?ref=1")
    cards = F.array_join(F.transform("parts", lambda p: text('<div class="job-search-results_job-card_link" data-gtm-job-id="', p["id"], '"><p><a href="', link(p), '">x</a></p></div>')), "\n")
    anchors = F.array_join(F.transform("parts", lambda p: text('<li><a href="', link(p), '&amp;b=2">x</a></li>')), "\n")
    body = text(
        '<!DOCTYPE html><html><body><script id="__NEXT_DATA__" type="application/json">', data, "</script>",
        F.when(F.col("page_no") % 3 == 0, anchors).otherwise(cards), "</body></html>",
    )
    return captures(pages, source=F.lit("glints"), run_id=run_id(F.col("run")), kind=F.lit("listing_html"), page_no=F.col("page_no"), body=body)


def glints_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail pages whose location, pay and skills are linked objects of the page's cache, with a block text."""
    key = F.col("p_partkey")
    job_id = text("ab-", key % 300)
    cache = text(
        '{"props":{"apolloCache":{"Job:', job_id, '":{"id":"', job_id, '","type":"CONTRACT","workArrangementOption":"HYBRID","location":{"__ref":"Place:1"},',
        '"salaries":[{"__ref":"Pay:1"}],"skills":[{"skill":{"__ref":"Skill:1"}},{"skill":{"__ref":"Skill:2"}}],',
        r'"descriptionJsonString":"{\"blocks\":[{\"text\":\" Tugas ', F.col("p_name"), r' \"},{\"text\":\"\"},{\"text\":\"Baris   dua\"}]}"},',
        '"Place:1":{"name":"Area","parents":[{"__ref":"Level:3"},{"__ref":"Level:2"}]},"Level:3":{"level":3,"formattedName":"Kota ', F.col("p_brand"),
        '"},"Level:2":{"level":2,"name":"', F.col("p_type"), '"},"Pay:1":{"salaryMode":"DAY","minAmount":9},"Skill:1":{"name":"S1"},"Skill:2":{"name":"S2"}}}}',
    )
    body = text('<!DOCTYPE html><html><body><script id="__NEXT_DATA__" type="application/json">', cache, "</script></body></html>")
    rows = table(spark, sf, "part").filter(key % 3 != 0)
    return captures(
        dealt(rows, "p_partkey"), source=F.lit("glints"), run_id=run_id(F.expr("p_partkey div 500")), kind=F.lit("detail_html"), job_id=job_id, fetched_at=F.timestamp_seconds(key), body=body,
    )


def lokerid_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail pages of the postings only cards have: by page number a script record, a rendered text alone, or a card alone."""
    pages = table(spark, sf, "customer").select(F.expr("c_custkey div 300").alias("run"), F.expr("cast(c_custkey % 300 div 15 + 1 as int)").alias("page")).distinct()
    job_id = text("x", F.col("run"), "-", F.col("page"))
    record = text(
        '<script>window.__remixContext = {"state":{"loaderData":{"root":{"a":1},"routes/job":{"job":{"id":"', job_id, '","title":"Only here","company":"Card Co","posted_at":"2026-03-15",',
        '"location":"Kota D","job_type":"contract","salary_min":6,"salary_max":9,"job_skills":["Ads"],"description":"<p>Isi satu.</p><p>Isi dua.</p>"}}}}};</script>',
    )
    rendered = text("<main><div><p>Kualifikasi</p><p>", F.repeat(F.lit("rajin dan teliti "), 8), "</p></div></main>")
    card = text(
        '<article class="job-card" data-job-id="', job_id, '"><b class="company-name">Card Co</b><h3><a href="/c/extra.html">Only here</a></h3>',
        '<i class="job-location">Kota C</i><time datetime="2026-03-15T00:00:00Z"></time></article>',
    )
    shape = F.col("page") % 3
    body = text("<!DOCTYPE html><html><body>", F.when(shape == 1, record).when(shape == 2, rendered).otherwise(card), "</body></html>")
    pages = dealt(pages, "run", "page")
    return captures(pages, source=F.lit("lokerid"), run_id=run_id(F.col("run")), kind=F.lit("detail_html"), job_id=job_id, fetched_at=F.timestamp_seconds(F.lit(1)), body=body)


def lokerid(spark: SparkSession, sf: str, wrapped: bool = False) -> DataFrame:
    """``wrapped`` puts every third record of a page inside an object that names an organisation without a name."""
    key, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    number = days_ago(key, 37)
    pay = F.floor("c_acctbal")
    record = F.struct(
        F.when(key % 2 == 0, text("q", key)).alias("id"), F.when(key % 2 == 1, text("q", key)).alias("jobid"), F.col("c_name").alias("title"),
        F.when(key % 3 == 0, F.struct(text("PT ", nation).alias("name"))).alias("company"), F.when(key % 3 != 0, text("PT ", nation)).alias("nama_perusahaan"),
        F.when(key % 4 == 0, iso(number)).when(key % 4 == 1, F.date_format(F.timestamp_seconds(number), "dd/MM/yyyy HH:mm:ss")).when(key % 4 == 2, number.cast("string"))
        .when(key % 37 == 36, "soon").otherwise(text(key % 37, " hari lalu")).alias("posted_at"),
        F.when(key % 5 < 2, text("/", F.lower(segment), "/kerja-", key)).when(key % 5 == 2, text("kerja-", key)).alias("slug"),
        F.when(key % 2 == 0, text("Kota ", nation)).alias("lokasi"), F.when(key % 7 == 0, True).alias("is_remote"),
        F.when(key % 3 != 1, "full_time").alias("employmentType"), pay.alias("salary_min"), F.when(key % 2 == 0, pay.cast("string")).alias("salary_max"),
        F.when(key % 6 == 0, "usd").alias("currency"), F.array(segment, segment, F.lit(" x ")).alias("skills"), F.col("c_custkey").alias("key"),
    )
    rows = table(spark, sf, "customer")
    pages = pack(rows, "c_custkey", 15, 20, record)
    pages = pages.withColumn("parts", F.from_json(json_list(), "array<struct<id:string,jobid:string,title:string,key:bigint>>"))
    items = F.col("parts")
    if wrapped:
        inside = lambda i, at: F.when(at % 3 == 1, text('{"organization":{"kode":7},"job":', i, "}")).otherwise(i)
        pages = pages.withColumn("items", F.transform("items", inside))
    context = text(
        '<script>\nwindow.__remixContext = {"state":{"loaderData":{"root":{"a":1},"routes/list":{"jobs":', json_list(), ',"meta":{"current_page":',
        F.col("page_no"), ',"last_page":"18","links":[]}}}}};\n</script>',
    )
    # Cards repeat the page's records with a place and a link, and add one posting that only they have.
    card = lambda p: text(
        '<article class="job-card" data-job-id="', F.coalesce(p["id"], p["jobid"]), '"><b class="company-name">Card Co</b><h3><a href="/c/', p["key"], '.html">',
        p["title"], '</a></h3><i class="job-location">Card Town</i><i class="job-type">Card Type</i><time datetime="2026-03-16T00:00:00Z"></time></article>',
    )
    extra = text(
        '<article class="job-card" data-job-id="x', F.col("run"), "-", F.col("page_no"), '"><b class="company-name">Card Co</b><h3><a href="/c/extra.html">Only here</a></h3>',
        '<div class="tags"><span>T</span><span>T</span></div><time datetime="2026-03-15T00:00:00Z"></time></article>',
    )
    # Half of the bare slugs are linked on the page, twice: the last link counts.
    linked = lambda p: F.when(p["key"] % 10 == 2, text('<a href="/lama/kerja-', p["key"], '.html">x</a><a href="/baru/kerja-', p["key"], '.html">x</a>'))
    anchors = F.array_join(F.transform(items, linked), "")
    body = text("<!DOCTYPE html><html><body>", context, F.array_join(F.transform(items, card), "\n"), extra, anchors, "</body></html>")
    return captures(pages, source=F.lit("lokerid"), run_id=run_id(F.col("run")), kind=F.lit("listing_html"), page_no=F.col("page_no"), body=body)
