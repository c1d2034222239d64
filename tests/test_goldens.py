"""Values that must be as they are, written out apart from the code that uses them."""

from datetime import datetime

from pyspark.sql import functions as F

from postweave.functions import extract as X
from postweave.operators import tables as T
from postweave.plans.intake import Request
from postweave.sources import grid as G
from tests.test_jobs import raw_rows

SKILLS = (
    "Python|Java|JavaScript|TypeScript|Go|Rust|C++|C#|React|Angular|Vue|Node.js|Django|Flask|FastAPI|PostgreSQL|MySQL|MongoDB|Redis|Kubernetes|Docker|"
    "AWS|Azure|GCP|Terraform|CI/CD|Git|Linux|Machine Learning|AI|Data Science|NLP|Computer Vision|REST API|GraphQL|gRPC|Kafka|RabbitMQ|Spark|Flink|"
    "Agile|Scrum|SQL|NoSQL|HTML|CSS|Sass|Figma|Photoshop|Illustrator|UI/UX|Product Management"
)


def test_skills_in_order(spark):
    df = spark.createDataFrame([(SKILLS,)], "t string")
    assert "|".join(df.select(X.skills(F.col("t"))).first()[0]) == SKILLS


def test_salary_bounds(spark):
    rows = ["pay 1000 - 4999999", "pay 999 - 2000", "pay 1000 - 5000000", "Salary: 50,000 \u2013 60,000", "pay\u00a070k\u2003to\r\n80k", "12k-13K"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in rows], "t string").select(X.salary(F.col("t"))).collect()]
    assert [g and (g.min, g.max, g.currency, g.period) for g in got] == [
        (1000, 4999999, "USD", "yearly"), None, None, (50000, 60000, "USD", "yearly"), (70000, 80000, "USD", "yearly"), (12000, 13000, "USD", "yearly"),
    ]


def test_grid_of_a_request(spark):
    rows = Request(["data", "ops"], ["Oslo", "Toronto, Canada"], ["jsearch_api", "indeed_rss", "workable", "adzuna_api", "fuzu", "myjobmag", "nobody"]).grid(spark, "r").collect()
    count = {}
    for r in rows:
        count[r.source] = count.get(r.source, 0) + 1
    assert count == {"jsearch_api": 40, "indeed_rss": 20, "workable": 10, "adzuna_api": 20, "fuzu": 8, "myjobmag": 6}
    assert {r.unit for r in rows if r.source == "indeed_rss"} == {"indeed_rss|*|Oslo", "indeed_rss|*|Toronto, Canada"}
    assert {(r.location, r.country) for r in rows if r.source == "adzuna_api"} == {("Oslo", "us"), ("Toronto, Canada", "ca")}


def test_countries(spark):
    names = ["United States", "Chicago", "Ukraine", "Austin", "Denver", "remote"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(G.country_code(F.col("n"))).collect()
    assert [r[0] for r in got] == ["us", "ca", "gb", "au", "de", "us"]


def test_rows_that_a_request_wants(spark):
    meta = ['{"posted_at": "2024-05-09T10:00:00Z", "contract_type": "permanent", "category": "IT"}', '{"posted_at": "2024-01-01T00:00:00Z"}', "{}", None, "no json"]
    rows = raw_rows(spark, [(i, "manual", None, "Title: x remote" if i % 2 else "Title: x", m) for i, m in enumerate(meta)])
    asof = datetime(2024, 5, 10)
    got = lambda **k: sorted(r.seq for r in Request(["x"], **k).wanted(rows, asof).collect())
    assert got() == [0, 1, 2, 3, 4] and got(date_posted="week") == [0, 2, 3, 4] and got(date_posted="any") == [0, 1, 2, 3, 4]
    assert got(remote_only=True) == [1, 3] and got(employment_types="contract,permanent") == [0, 1, 2, 3, 4] and got(employment_types="contract") == [1, 2, 3, 4]
    assert got(category="Sales") == [1, 2, 3, 4]


def test_look_up_reads_few_row_groups(spark, tmp_path):
    """Parsed rows lie in the order of their ids, so statistics of row groups exclude most of them."""
    store = T.JobTables(str(tmp_path))
    jobs = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit("r").alias("raw_id"))
    from postweave.operators.parse import _finish

    store.save_parsed(_finish(jobs.drop("id").withColumn("job_title", F.lit("x"))).withColumn("id", F.md5(F.monotonically_increasing_id().cast("string"))), "one")
    plan = T.get_by_id(store.parsed_rows(spark), "7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,7)]" in plan
    for part in spark.read.parquet(store.path("parsed_jobs")).select("id", F.spark_partition_id().alias("p")).groupBy("p").agg(F.collect_list("id").alias("ids")).collect():
        assert part.ids == sorted(part.ids)
