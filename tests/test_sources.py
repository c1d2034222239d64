import json

from pyspark.sql import functions as F

from postweave import schemas as S
from postweave.operators import dedup as U
from postweave.sources import grid as G
from postweave.sources import html as H
from postweave.sources import landed as L


def pages(spark, *payloads, unit="u"):
    rows = [(i, unit, "engineer", p if isinstance(p, str) else json.dumps(p), None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, S.PAGE)


def test_jsearch_text(spark):
    job = {
        "job_id": "j1", "job_title": "Dev", "employer_name": None, "job_city": "Lagos", "job_is_remote": True,
        "job_description": "Do it", "job_min_salary": 50000.0, "job_salary_currency": "EUR", "job_apply_link": "http://a",
        "job_highlights": {"Qualifications": ["A", "B"], "Benefits": []},
    }
    first, second = L.raw_from_jsearch(pages(spark, {"data": [job, {"job_min_salary": 0}]}, "not json", {"data": []})).orderBy("seq").collect()
    assert first.raw_text == (
        "Title: Dev\nCompany: None\nLocation: Lagos  \nRemote: True\nEmployment Type: \nDescription:\nDo it\n"
        "Salary: 50000.0 -  EUR \nQualifications:\n- A\n- B"
    )
    assert (first.external_id, first.source_url, first.seq) == ("j1", "http://a", 0)
    assert json.loads(first.metadata) == {"employer": None, "posted_at": None, "query": "engineer"}
    assert second.raw_text == "Title: \nCompany: \nLocation:   \nRemote: False\nEmployment Type: \nDescription:\n"
    assert second.external_id == ""


def test_adzuna_text(spark):
    full = {"id": 7, "title": "Dev", "company": {"display_name": "Acme"}, "location": {"display_name": "Leeds"},
            "category": None, "description": "x", "salary_min": 0, "salary_max": 60000}
    a, b = L.raw_from_adzuna(pages(spark, {"results": [full, {}]})).orderBy("seq").collect()
    assert a.raw_text == "Title: Dev\nCompany: Acme\nLocation: Leeds\nCategory: \nContract Type: \nDescription:\nx\nSalary: ? - 60000 GBP yearly"
    assert (a.external_id, b.external_id) == ("adzuna_7", "adzuna_")
    assert "Salary" not in b.raw_text


def test_workable_metadata(spark):
    job = {"id": "w", "title": "Dev", "company": {"title": "Acme"}, "location": {"city": "Oslo", "countryName": "Norway"}, "workplace": "remote"}
    r = L.raw_from_workable(pages(spark, {"jobs": [job]})).first()
    assert r.raw_text == "Title: Dev\nCompany: Acme\nLocation: Oslo, , Norway\nWorkplace: remote\nEmployment Type: \nDescription:\n"
    m = json.loads(r.metadata)
    assert (m["title"], m["company"], m["location"]["city"], m["workplace"]) == ("Dev", "Acme", "Oslo", "remote")


def test_rss(spark):
    good = ("<rss><channel><title>f</title><item><title> A </title><description><![CDATA[ Title: A\nx ]]></description><guid>1</guid>"
            "<link> http://a </link></item><item><guid>2</guid></item></channel></rss>")
    rows = L.raw_from_rss(pages(spark, good, good[:-10], "<rss></rss>", "no xml")).orderBy("seq").collect()
    assert [(r.external_id, r.raw_text, r.source_url) for r in rows] == [("1", "Title: A\nx", "http://a"), ("2", "", "")]


def test_fetch_unit_keeps_first_per_id(spark):
    page = {"results": [{"id": 1}, {"id": 2}]}
    raw = L.raw_from_adzuna(pages(spark, page, page))
    assert sorted(r.seq for r in U.dedup_within_fetch(raw).collect()) == [0, 1]


def test_manual(spark):
    df = spark.createDataFrame([(1, "text"), (2, " \n")], "seq long, raw_text string")
    rows = L.raw_manual(df).withColumn("healthy", L.healthy_text(F.col("raw_text"))).orderBy("seq").collect()
    assert [(r.source, r.external_id, r.healthy) for r in rows] == [("manual", None, True), ("manual", None, False)]


def test_links(spark):
    html = ('<a href="/job/1">Engineer &amp; <b>lead</b></a><a href="/x/job/2"> Developer </a><a href="/job/3">five5</a><a>none here</a>'
            '<a href="http://b/job/4">Analyst job</a><!-- <a href="/job/9">Commented</a> --><a href="&#47;job/5">Encoded</a>')
    def got(board):
        return [(r.title, r.url) for r in H.html_job_links(pages(spark, html), H.BOARDS[board]).orderBy("seq").collect()]

    assert got("myjobmag") == [("Engineer & lead", "https://www.myjobmag.com/job/1"), ("Encoded", "https://www.myjobmag.com/job/5")]
    assert got("fuzu") == [
        ("Engineer & lead", "https://www.fuzu.com/job/1"), ("Developer", "https://www.fuzu.com/x/job/2"),
        ("Analyst job", "http://b/job/4"), ("Encoded", "https://www.fuzu.com/job/5"),
    ]


def test_pages_without_links(spark):
    assert H.html_anchors(pages(spark, "<p>/job/</p>", "")).count() == 0
    assert H.html_job_links(pages(spark, "<p>/job/</p>"), H.BOARDS["fuzu"]).count() == 0


def test_detail_text():
    page = ('<title> T </title><script>var x = "<p>no</p>";</script><div class="a description b">in <b>bold</b><br>next<!-- c -->end</div>'
            '<div id="job-detail">by id</div><p>rest &lt;x&gt;')
    text = lambda b: H.text_of(page, H.BOARDS[b].content, H.BOARDS[b].ids_too)
    assert text("fuzu") == "Title: T\n\nby id"
    assert text("jobberman") == "Title: T\n\nin\nbold\nnext\nend"
    assert text("myjobmag") == "Title: T\n\nT\nin\nbold\nnext\nend\nby id\nrest <x>"
    assert H.text_of('<p class="content"></p>x', ("content",), False) == "Title: \n\nx"


def test_html_rows(spark):
    board = H.BOARDS["fuzu"]
    html = '<a href="/job/1">Engineer one</a><a href="/job/1">Engineer again</a><a href="/job/2">No detail</a>'
    details = spark.createDataFrame([("https://www.fuzu.com/job/1", '<p class="main">hi</p>')], "url string, payload string")
    r, = H.raw_from_html(H.html_job_links(pages(spark, html), board), H.html_detail_text(details, board), board).collect()
    assert (r.external_id, r.raw_text, json.loads(r.metadata)) == (
        "https://www.fuzu.com/job/1", "Title: \n\nhi", {"title": "Engineer one", "query": "engineer"})


def test_grid(spark):
    req = spark.createDataFrame(
        [("r", ["q1", "q2"], ["remote", "Kyiv, Ukraine"], ["jsearch_api", "indeed_rss", "adzuna_api", "workable", "jobberman", "manual"])],
        "run_id string, queries array<string>, locations array<string>, sources array<string>")
    grid = G.fetch_grid(req)
    n = {r.source: (r.units, r.requests) for r in grid.groupBy("source").agg(
        F.countDistinct("unit").alias("units"), F.count(F.lit(1)).alias("requests")).collect()}
    assert n == {"jsearch_api": (4, 40), "indeed_rss": (2, 20), "adzuna_api": (4, 20), "workable": (2, 10), "jobberman": (2, 4)}
    assert {r.country for r in grid.filter("location = 'Kyiv, Ukraine' and source = 'adzuna_api'").collect()} == {"gb"}
    assert {r.location for r in grid.filter("source = 'workable'").collect()} == {"remote"}


def test_countries(spark):
    want = {"United States": "us", "Chicago": "ca", "Ukraine": "gb", "Austin": "au", "Denver": "de", "remote": "us"}
    df = spark.createDataFrame([(k,) for k in want], "l string")
    assert {r.l: r.c for r in df.select("l", G.country_code(F.col("l")).alias("c")).collect()} == want


def test_board_side_filters(spark):
    df = spark.createDataFrame([("FULLTIME", "it", True), ("INTERN", "hr", False)], "employment_type string, category string, is_remote boolean")
    assert G.employment_type_filter(df, "FULLTIME,CONTRACTOR").count() == 1 and G.employment_type_filter(df, "").count() == 2
    assert G.category_filter(df, "hr").count() == 1 and G.category_filter(df, None).count() == 2
    assert G.remote_only_filter(df).count() == 1 and G.remote_only_filter(df, wanted=False).count() == 2
