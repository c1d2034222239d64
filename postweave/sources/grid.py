"""Which requests a run consists of, and the filters that boards apply on their side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Per source, whether every location or only the first is asked (none: no location),
# whether one fetch takes all queries, and how many pages it asks for.
GRID_RULES = [
    # source, locations, all queries in one fetch, pages
    ("jsearch_api", "each", False, 10),
    ("indeed_rss", "each", True, 5),
    ("adzuna_api", "each", False, 5),
    ("workable", "first", False, 5),
    ("myjobmag", "none", False, 3),
    ("fuzu", "each", False, 2),
    ("jobgurus", "none", False, 2),
    ("jobberman", "none", False, 2),
]
# Part of a location name, in order of precedence, and the country it stands for.
COUNTRY_HINTS = (
    ("united kingdom", "gb"), ("uk", "gb"), ("canada", "ca"), ("ca", "ca"),
    ("australia", "au"), ("au", "au"), ("germany", "de"), ("de", "de"),
)
DEFAULT_COUNTRY = "us"
RECENCY_DAYS = {"today": 1, "3days": 3, "week": 7, "month": 30}
DEFAULT_DAYS = 7


def country_code(location: Column) -> Column:
    low = F.lower(location)
    found = F.coalesce(*(F.when(low.contains(part), code) for part, code in COUNTRY_HINTS))
    return F.coalesce(found, F.lit(DEFAULT_COUNTRY))


def _rule(pick) -> Column:
    return F.coalesce(*(F.when(F.col("source") == r[0], F.lit(pick(r))) for r in GRID_RULES))


def fetch_grid(requests: DataFrame) -> DataFrame:
    """Page requests of each run: run_id, source, query, location, page, unit, country.

    requests: run_id and the arrays queries, locations, sources; one row per run. A run's product of
    short lists is exploded in place, so nothing is joined or shuffled.
    """
    none = F.array(F.lit(""))
    first = F.when(F.size("locations") > 0, F.slice("locations", 1, 1)).otherwise(none)
    how = _rule(lambda r: r[1])
    places = F.when(how == "each", F.col("locations")).when(how == "first", first).otherwise(none)
    per_source = requests.withColumn("source", F.explode("sources")).filter(how.isNotNull())
    per_place = per_source.withColumn("location", F.explode(places))
    asked = per_place.withColumn("query", F.explode("queries"))
    unit = F.concat_ws(
        "|", "source", F.when(_rule(lambda r: r[2]), "*").otherwise(F.col("query")), "location"
    )
    return asked.select(
        "run_id", "source", "query", "location",
        F.explode(F.sequence(F.lit(1), _rule(lambda r: r[3]))).alias("page"), unit.alias("unit"),
        F.when(F.col("source") == "adzuna_api", country_code(F.col("location"))).alias("country"),
    )


def _keep(rows: DataFrame, test: Column, column: str, unsaid: bool) -> DataFrame:
    """Rows that pass the test; with unsaid also those that do not say what it is about. One filter, so one scan."""
    return rows.filter(F.col(column).isNull() | test if unsaid else test)


def recency_filter(rows: DataFrame, date_posted: str, asof: Column, posted: str = "posted_at", unsaid: bool = False) -> DataFrame:
    days = RECENCY_DAYS.get(date_posted, DEFAULT_DAYS)
    return _keep(rows, F.col(posted) >= asof - F.make_dt_interval(F.lit(days)), posted, unsaid)


def remote_only_filter(rows: DataFrame, wanted: bool = True, flag: str = "is_remote") -> DataFrame:
    return rows.filter(F.col(flag)) if wanted else rows


def employment_type_filter(rows: DataFrame, wanted: str, column: str = "employment_type", unsaid: bool = False) -> DataFrame:
    """wanted: comma-separated list such as FULLTIME,CONTRACTOR; empty for all."""
    kinds = [w.strip() for w in wanted.split(",") if w.strip()]
    return _keep(rows, F.col(column).isin(*kinds), column, unsaid) if kinds else rows


def category_filter(rows: DataFrame, slug: str | None, column: str = "category", unsaid: bool = False) -> DataFrame:
    return _keep(rows, F.col(column) == slug, column, unsaid) if slug else rows
