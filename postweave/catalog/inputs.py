"""Inputs of the registered queries: the given tables seen as postings, jobs, logs and payloads.

Each view is one SELECT over {table} placeholders, which Spark fills with DataFrames and the check
SQL with table names, so both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postweave import schemas as S
from postweave.session import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Orders as raw postings, with the board metadata of their source beside them.
POSTINGS = """
SELECT o.o_orderkey AS seq, CAST(o.o_orderkey AS STRING) AS id,
 CASE o.o_orderkey % 5 WHEN 0 THEN 'workable' WHEN 1 THEN 'jsearch_api' WHEN 2 THEN 'adzuna_api'
   WHEN 3 THEN 'indeed_rss' ELSE 'manual' END AS source,
 CASE WHEN o.o_orderkey % 11 = 0 THEN CAST(NULL AS STRING)
   ELSE concat('x', CAST(o.o_orderkey % 9000 AS STRING)) END AS external_id,
 concat(
  CASE WHEN o.o_orderkey % 13 = 0 THEN '' ELSE concat('Title: ', c.c_mktsegment, ' Engineer', chr(10)) END,
  CASE WHEN o.o_orderkey % 17 = 0 THEN '' ELSE concat('Company: ', c.c_name, chr(10)) END,
  'Location: ', n.n_name, chr(10),
  CASE o.o_orderkey % 4 WHEN 0 THEN 'Employment Type: full-time' WHEN 1 THEN 'Employment Type: contract'
    WHEN 2 THEN 'Workplace: remote' ELSE 'Part time role' END, chr(10),
  CASE o.o_orderkey % 6
    WHEN 0 THEN concat('Salary: ', CAST(CAST(floor(o.o_totalprice / 10) AS BIGINT) AS STRING), ' - ',
                       CAST(CAST(floor(o.o_totalprice / 5) AS BIGINT) AS STRING), ' USD yearly')
    WHEN 1 THEN concat('$', CAST(20 + o.o_orderkey % 180 AS STRING), 'k - $',
                       CAST(30 + o.o_orderkey % 300 AS STRING), 'k /year')
    ELSE 'No range given' END, chr(10),
  'Requirements: ', CASE o.o_orderkey % 3 WHEN 0 THEN 'Python and SQL' WHEN 1 THEN 'Java, Kafka' ELSE 'none' END, chr(10),
  '- priority ', o.o_orderpriority) AS raw_text,
 o.o_orderdate AS fetched_at,
 CASE o.o_orderkey % 3 WHEN 0 THEN concat(c.c_mktsegment, ' Lead') WHEN 1 THEN '' ELSE CAST(NULL AS STRING) END AS m_title,
 CASE WHEN o.o_orderkey % 2 = 0 THEN c.c_name ELSE CAST(NULL AS STRING) END AS m_company,
 CASE WHEN o.o_orderkey % 4 = 0 THEN '' ELSE n.n_name END AS m_city,
 CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE 'Testland' END AS m_country,
 CASE o.o_orderkey % 4 WHEN 1 THEN 'remote' WHEN 2 THEN 'on_site' ELSE CAST(NULL AS STRING) END AS m_workplace,
 CASE WHEN o.o_orderkey % 3 = 1 THEN 'Full-Time' ELSE CAST(NULL AS STRING) END AS m_employment,
 c.c_mktsegment AS segment, c.c_name AS employer, n.n_name AS place, o.o_totalprice AS price, o.o_orderstatus AS mark
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Orders as parsed jobs with every kind of defect that a rule looks for.
JOBS = """
SELECT o.o_orderkey AS n, CAST(o.o_orderkey AS STRING) AS id, concat('r', CAST(o.o_orderkey AS STRING)) AS raw_id,
 CASE WHEN o.o_orderkey % 13 = 0 THEN '' WHEN o.o_orderkey % 13 = 1 THEN '[UNKNOWN]' WHEN o.o_orderkey % 13 = 2 THEN '[PARSE FAILED]'
   ELSE concat('Role ', o.o_orderpriority) END AS job_title,
 CASE WHEN o.o_orderkey % 7 = 0 THEN CAST(NULL AS STRING) WHEN o.o_orderkey % 7 = 1 THEN '' ELSE concat('Firm ', CAST(o.o_custkey AS STRING)) END AS company,
 CASE WHEN o.o_orderkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE 'Lagos' END AS location,
 o.o_orderkey % 2 = 0 AS remote,
 CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(NULL AS INT) WHEN o.o_orderkey % 5 = 4 THEN 0 ELSE CAST(floor(o.o_totalprice / 10) AS INT) END AS lo,
 CASE WHEN o.o_orderkey % 5 IN (0, 3) THEN CAST(NULL AS INT) WHEN o.o_orderkey % 17 = 0 THEN 6000000 ELSE CAST(floor(o.o_totalprice / 12) AS INT) + CAST(o.o_orderkey % 9000 AS INT) END AS hi,
 o.o_orderkey % 4 AS skill_count,
 CASE WHEN o.o_orderkey % 6 = 0 THEN '' ELSE 'full-time' END AS employment_type,
 CAST(o.o_orderkey % 101 AS DOUBLE) / 100.0 AS confidence, o.o_orderdate AS parsed_at,
 CASE WHEN o.o_orderkey % 4 = 3 THEN 'failed' WHEN o.o_orderkey % 4 = 2 THEN 'sent' ELSE 'parsed' END AS status
FROM {orders} o
"""

# Line items as status events: several per order, and orders without any.
STATUS_LOG = """
SELECT CAST(l_orderkey AS STRING) AS job_id,
 CASE l_returnflag WHEN 'R' THEN 'rejected' WHEN 'A' THEN 'sent' ELSE 'failed' END AS status,
 concat('note ', l_linestatus) AS reviewer_notes, l_shipdate AS reviewed_at, CAST(l_linenumber AS BIGINT) AS event_seq
FROM {lineitem}
"""

# Events as records of runs (one run per user), and as fetch attempts of sources.
RECORDS = """
SELECT CAST(user_id AS STRING) AS run_id, concat('s', CAST(event_id % 5 AS STRING)) AS source,
 event_type <> 'view' OR event_id % 3 = 0 AS fetched, event_type = 'view' AS duplicate, event_type IN ('click', 'purchase', 'error') AS parsed,
 CASE event_type WHEN 'purchase' THEN 'validated' WHEN 'click' THEN 'flagged' WHEN 'error' THEN 'error' ELSE CAST(NULL AS STRING) END AS outcome,
 CASE WHEN event_type IN ('purchase', 'click') THEN value >= 5 ELSE CAST(NULL AS BOOLEAN) END AS delivered,
 value AS latency, ts, event_id AS seq, user_id AS source_id, event_type <> 'error' AS ok
FROM {events}
"""


# Unique keys of the tables whose rows are texts to parse.
KEYS = {"orders": "o_orderkey", "documents": "doc_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table for costly work per row: its rows lie over all cores."""
    return spread(table(spark, sf_dir, name), KEYS[name])


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: (spread_table if t in KEYS else table)(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SELECT with the table names themselves, for the check SQL."""
    return sql.format(**{t: t for t in TABLES})


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows; only board rows carry metadata."""
    rows = view(spark, sf_dir, POSTINGS)
    meta = F.to_json(F.struct(
        F.col("m_title").alias("title"), F.col("m_company").alias("company"),
        F.struct(F.col("m_city").alias("city"), F.col("m_country").alias("countryName")).alias("location"),
        F.col("m_employment").alias("employment_type"), F.col("m_workplace").alias("workplace"),
    ), {"ignoreNullFields": "false"})
    return rows.select(
        "seq", "id", "source", "external_id", "raw_text", F.lit(None).cast("string").alias("source_url"),
        F.col("fetched_at").cast("timestamp").alias("fetched_at"), meta.alias("metadata"), "mark",
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, JOBS)
    made = {
        "salary": F.when(F.col("lo").isNotNull() | F.col("hi").isNotNull(), F.struct(
            F.col("lo").alias("min"), F.col("hi").alias("max"), F.lit("USD").alias("currency"), F.lit("yearly").alias("period"))),
        "required_skills": F.slice(F.array(F.lit("Python"), F.lit("SQL"), F.lit("Spark")), F.lit(1), F.col("skill_count").cast("int")),
        "parsed_at": F.col("parsed_at").cast("timestamp"),
        "reviewer_notes": F.lit(""),
        "validation_issues": F.array().cast("array<string>"),
    }
    rows = rows.withColumns(made)
    return rows.select(*(
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.PARSED
    ))


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, STATUS_LOG).withColumn("reviewed_at", F.col("reviewed_at").cast("timestamp"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, RECORDS).withColumn("ts", F.col("ts").cast("timestamp"))
