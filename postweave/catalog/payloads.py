"""Landed payloads made from the given tables: JSON pages, feeds, search and detail pages, model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postweave.catalog import inputs as I

PAGE_SIZE = 20
ALL_FIELDS = {"ignoreNullFields": "false"}


def _pages(rows: DataFrame, item: Column, field: str) -> DataFrame:
    """Pages of PAGE_SIZE consecutive items each."""
    page = F.floor(F.col("seq") / PAGE_SIZE)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", item.alias("item")))), lambda x: x["item"])
    return rows.groupBy(page.alias("page_seq")).agg(F.to_json(F.struct(listed.alias(field)), ALL_FIELDS).alias("payload")).select(
        "page_seq", F.lit("unit").alias("unit"), F.lit("engineer").alias("query"), "payload",
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


def jsearch_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("seq")
    item = F.struct(
        F.when(n % 11 != 0, F.concat(F.lit("j"), n)).alias("job_id"),
        F.concat("segment", F.lit(" Engineer")).alias("job_title"),
        F.col("employer").alias("employer_name"),
        F.when(n % 3 != 0, F.col("place")).alias("job_city"),
        F.lit("Testland").alias("job_country"),
        (n % 2 == 0).alias("job_is_remote"),
        F.lit("FULLTIME").alias("job_employment_type"),
        F.col("raw_text").alias("job_description"),
        F.when(n % 4 == 0, 0).when(n % 4 == 1, F.floor(F.col("price"))).alias("job_min_salary"),
        F.floor(F.col("price") * 2).alias("job_max_salary"),
        F.lit("YEAR").alias("job_salary_period"),
        F.concat(F.lit("http://jobs.test/"), n).alias("job_apply_link"),
        F.struct(
            F.array(F.lit("Degree"), F.col("segment")).alias("Qualifications"),
            F.array().cast("array<string>").alias("Responsibilities"),
        ).alias("job_highlights"),
    )
    return _pages(I.view(spark, sf_dir, I.POSTINGS), item, "data")


def adzuna_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("seq")
    item = F.struct(
        n.alias("id"),
        F.concat("segment", F.lit(" Analyst")).alias("title"),
        F.when(n % 5 != 0, F.struct(F.col("employer").alias("display_name"))).alias("company"),
        F.struct(F.col("place").alias("display_name")).alias("location"),
        F.struct(F.col("segment").alias("label")).alias("category"),
        F.when(n % 3 == 0, "permanent").alias("contract_type"),
        F.col("raw_text").alias("description"),
        F.when(n % 4 < 2, F.floor(F.col("price"))).alias("salary_min"),
        F.when(n % 4 == 1, F.floor(F.col("price") * 2)).alias("salary_max"),
        F.concat(F.lit("http://ads.test/"), n).alias("redirect_url"),
    )
    return _pages(I.view(spark, sf_dir, I.POSTINGS), item, "results")


def workable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("seq")
    item = F.struct(
        F.concat(F.lit("w"), n).alias("id"),
        F.col("m_title").alias("title"),
        F.struct(F.col("employer").alias("title")).alias("company"),
        F.struct(F.col("m_city").alias("city"), F.col("m_country").alias("countryName")).alias("location"),
        F.col("m_employment").alias("employmentType"),
        F.col("m_workplace").alias("workplace"),
        F.concat(F.lit("http://board.test/"), n).alias("url"),
        F.col("raw_text").alias("description"),
    )
    return _pages(I.view(spark, sf_dir, I.POSTINGS), item, "jobs")


def rss_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh feed is cut off before its end."""
    rows = I.view(spark, sf_dir, I.POSTINGS)
    item = F.concat(
        F.lit("<item><title>"), "segment", F.lit(" Engineer </title><description><![CDATA[\n"), "raw_text",
        F.lit("\n]]></description><guid isPermaLink=\"false\">g"), "seq", F.lit("</guid>"),
        F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("<link>http://feed.test/"), "seq", F.lit("</link>"))),
        F.lit("</item>"),
    )
    page = F.floor(F.col("seq") / PAGE_SIZE)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", item.alias("item")))), lambda x: x["item"])
    end = F.when(F.col("page_seq") % 7 == 0, "").otherwise("</channel></rss>")
    return rows.groupBy(page.alias("page_seq")).agg(F.array_join(listed, "").alias("items")).select(
        "page_seq", F.lit("unit").alias("unit"), F.lit("engineer").alias("query"),
        F.concat(F.lit('<rss version="2.0"><channel><title>feed</title>'), "items", end).alias("payload"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


# The pages' own links become job links of several kinds, and their articles get a content name.
SEARCH_PAGE = """
SELECT page_id AS page_seq, concat('unit', CAST(page_id % 7 AS STRING)) AS unit, 'engineer' AS query,
 replace(html, '<a href="/', CASE page_id % 4 WHEN 0 THEN '<a href="/job/' WHEN 1 THEN '<a href="http://other.test/job/'
   WHEN 2 THEN '<a href="/vacancy/' ELSE '<a href="/about/job-' END) AS payload
FROM {pages}
"""
DETAIL_PAGE = """
SELECT url, replace(html, '<article>', CASE page_id % 4 WHEN 0 THEN '<article class="wide job-details">'
   WHEN 1 THEN '<article id="content">' WHEN 2 THEN '<article class="content">' ELSE '<article>' END) AS payload
FROM {pages}
"""


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.view(spark, sf_dir, SEARCH_PAGE).withColumn("fetched_at", F.lit(None).cast("timestamp"))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.view(spark, sf_dir, DETAIL_PAGE)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers about the postings: some fenced, some broken, some with fields of the wrong type."""
    rows = I.view(spark, sf_dir, I.POSTINGS)
    n = F.col("seq")
    salary = F.when(n % 3 == 0, F.struct(F.floor(F.col("price")).alias("min"), F.floor(F.col("price") * 2).alias("max")))
    body = F.to_json(F.struct(
        F.concat("segment", F.lit(" Engineer")).alias("job_title"), F.col("employer").alias("company"),
        F.col("place").alias("location"), (n % 2 == 0).alias("remote"), salary.alias("salary"),
        F.array("segment", F.lit("SQL")).alias("required_skills"),
        ((n % 40).cast("double") / F.when(n % 10 == 7, 4).otherwise(1)).alias("years_experience"),
        ((n % 100).cast("double") / 100).alias("confidence"),
    ), {"ignoreNullFields": "true"})
    response = (
        F.when(n % 10 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```\n")))
        .when(n % 10 == 1, F.concat(F.lit("  ``` "), body, F.lit("``` and more")))
        .when(n % 10 == 2, F.left(body, F.lit(25)))
        .when(n % 10 == 3, F.concat(F.lit("["), body, F.lit("]")))
        .when(n % 10 == 4, F.replace(body, F.lit('"job_title"'), F.lit('"title"')))
        .when(n % 10 == 5, F.regexp_replace(body, '"job_title":"[^"]*"', '"job_title":null'))
        .when(n % 10 == 6, F.regexp_replace(body, r'"required_skills":\[[^\]]*\]', '"required_skills":[]'))
        .otherwise(body)
    )
    return rows.select(F.col("id").alias("raw_id"), F.lit("stub").alias("model_used"), response.alias("response"))
