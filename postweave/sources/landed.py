"""Landed payloads (JSON pages, feeds, pasted text) to raw rows.

A page frame has the columns of schemas.PAGE. Arrival order of the rows is page order, then position
on the page; nothing is collected, so the pages may be a batch or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postweave.functions import jsonval as J
from postweave.functions.text import blank, stable_uuid, strip
from postweave.session import small_methods

# Places on a page are 32-bit numbers, so this many bits hold every place of every page.
PLACE_BITS = 31
HIDDEN = ("unit",)


def arrival(page_seq: Column, position: Column) -> Column:
    """Page order, then place on the page."""
    return F.shiftleft(page_seq.cast("bigint"), PLACE_BITS) + position


def _raw(rows: DataFrame, source: str, external_id: Column, text: Column, url: Column, metadata: Column) -> DataFrame:
    seq = F.col("seq")
    return rows.select(
        seq, stable_uuid(F.lit(source), seq.cast("string")).alias("id"), F.lit(source).alias("source"),
        external_id.cast("string").alias("external_id"), text.alias("raw_text"),
        url.cast("string").alias("source_url"), F.col("fetched_at").cast("timestamp").alias("fetched_at"),
        metadata.alias("metadata"), *(F.col(h) for h in HIDDEN if h in rows.columns),
    )


def _items(pages: DataFrame, path: str) -> DataFrame:
    """One row per element of the JSON array at path; pages that are no JSON or lack it give none."""
    v = F.try_variant_get(F.try_parse_json("payload"), path, "array<variant>")
    return small_methods(pages).select("page_seq", "unit", "query", "fetched_at", F.posexplode(v).alias("pos", "v")).select(
        arrival(F.col("page_seq"), F.col("pos")).alias("seq"), "unit", "query", "fetched_at", "v"
    )


def _lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)


def _line(label: str, *values: Column, sep: str = " ") -> Column:
    return F.concat(F.lit(f"{label}: "), F.concat_ws(sep, *values))


def _metadata(**fields: Column) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"})


def _p(path: str, default: str = "") -> Column:
    return J.printed(F.col("v"), path, default)


def _t(path: str) -> Column:
    return J.text_or_null(F.col("v"), path)


def _truthy(path: str) -> Column:
    """Neither missing, null, zero, false nor the empty text."""
    got, text = J.at(F.col("v"), path), _t(path)
    is_text = J.kind(got) == "STRING"
    return F.coalesce(J.present(got) & F.when(is_text, text != "").otherwise(
        (text != "false") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0)
    ), F.lit(False))


def raw_from_jsearch(pages: DataFrame) -> DataFrame:
    def bullets(name: str) -> Column:
        items = F.try_variant_get(F.col("v"), f"$.job_highlights.{name}", "array<string>")
        listed = F.array_join(F.transform(items, lambda q: F.concat(F.lit("- "), F.coalesce(q, F.lit("None")))), "\n")
        return F.when(F.size(items) > 0, F.concat(F.lit(f"{name}:\n"), listed))

    pay = F.concat(
        F.lit("Salary: "), _p("$.job_min_salary"), F.lit(" - "), _p("$.job_max_salary"), F.lit(" "),
        _p("$.job_salary_currency", "USD"), F.lit(" "), _p("$.job_salary_period"),
    )
    text = _lines(
        _line("Title", _p("$.job_title")),
        _line("Company", _p("$.employer_name")),
        _line("Location", _p("$.job_city"), _p("$.job_state"), _p("$.job_country")),
        _line("Remote", _p("$.job_is_remote", "False")),
        _line("Employment Type", _p("$.job_employment_type")),
        F.concat(F.lit("Description:\n"), _p("$.job_description")),
        F.when(_truthy("$.job_min_salary"), pay),
        *(bullets(n) for n in ("Qualifications", "Responsibilities", "Benefits")),
    )
    ext = F.when(J.at(F.col("v"), "$.job_id").isNull(), "").otherwise(_t("$.job_id"))
    meta = _metadata(
        employer=_t("$.employer_name"), posted_at=_t("$.job_posted_at_datetime_utc"), query=F.col("query")
    )
    return _raw(_items(pages, "$.data"), "jsearch_api", ext, text, _t("$.job_apply_link"), meta)


def raw_from_adzuna(pages: DataFrame) -> DataFrame:
    low, high = (F.when(_truthy(p), _p(p)) for p in ("$.salary_min", "$.salary_max"))
    # The currency is fixed, whatever the country.
    pay = F.concat(
        F.lit("Salary: "), F.coalesce(low, F.lit("?")), F.lit(" - "), F.coalesce(high, F.lit("?")), F.lit(" GBP yearly")
    )
    text = _lines(
        _line("Title", _p("$.title")),
        _line("Company", _p("$.company.display_name")),
        _line("Location", _p("$.location.display_name")),
        _line("Category", _p("$.category.label")),
        _line("Contract Type", _p("$.contract_type")),
        F.concat(F.lit("Description:\n"), _p("$.description")),
        F.when(low.isNotNull() | high.isNotNull(), pay),
    )
    meta = _metadata(
        employer=_t("$.company.display_name"), posted_at=_t("$.created"),
        category=_t("$.category.label"), contract_type=_t("$.contract_type"),
    )
    ext = F.concat(F.lit("adzuna_"), _p("$.id"))
    return _raw(_items(pages, "$.results"), "adzuna_api", ext, text, _t("$.redirect_url"), meta)


def raw_from_workable(pages: DataFrame) -> DataFrame:
    text = _lines(
        _line("Title", _p("$.title")),
        _line("Company", _p("$.company.title")),
        _line("Location", _p("$.location.city"), _p("$.location.subregion"), _p("$.location.countryName"), sep=", "),
        _line("Workplace", _p("$.workplace")),
        _line("Employment Type", _p("$.employmentType")),
        F.concat(F.lit("Description:\n"), _p("$.description")),
    )
    v = F.col("v")
    place = F.struct(*(_t(f"$.location.{k}").alias(k) for k in ("city", "subregion", "countryName")))
    meta = _metadata(
        title=_t("$.title"), company=_t("$.company.title"),
        location=F.when(J.present(J.at(v, "$.location")), place),
        employment_type=_t("$.employmentType"), workplace=_t("$.workplace"), published_at=_t("$.created"),
        company_info=F.when(J.present(J.at(v, "$.company")), F.struct(_t("$.company.title").alias("title"))),
    )
    ext = F.when(J.at(v, "$.id").isNull(), "").otherwise(_t("$.id"))
    return _raw(_items(pages, "$.jobs"), "workable", ext, text, _t("$.url"), meta)


_FEED = (
    "channel STRUCT<item: ARRAY<STRUCT<title: STRING, description: STRING, link: STRING, guid: STRING, pubDate: STRING>>>"
)


def unreadable_pages(pages: DataFrame, feed: bool = False) -> DataFrame:
    """page_seq, unit, query of the payloads that are no JSON, or no feed: they give no rows, and here they show."""
    if feed:
        bad = F.from_xml("payload", F.lit(_FEED), {"mode": "PERMISSIVE"})["channel"].isNull()
    else:
        bad = F.try_parse_json("payload").isNull()
    return pages.filter(bad).select("page_seq", "unit", "query")


def raw_from_rss(feeds: DataFrame) -> DataFrame:
    """Feed documents; one that is not well formed gives no rows."""
    item = F.from_xml("payload", F.lit(_FEED), {"mode": "PERMISSIVE"})["channel"]["item"]
    rows = feeds.select("page_seq", "unit", "query", "fetched_at", F.posexplode(item).alias("pos", "i")).select(
        arrival(F.col("page_seq"), F.col("pos")).alias("seq"), "unit", "query", "fetched_at",
        *(strip(F.coalesce(F.col(f"i.{n}"), F.lit(""))).alias(n) for n in ("title", "description", "link", "guid", "pubDate")),
    )
    meta = _metadata(title=F.col("title"), pub_date=F.col("pubDate"), query=F.col("query"))
    return _raw(rows, "indeed_rss", F.col("guid"), F.col("description"), F.col("link"), meta)


def raw_manual(texts: DataFrame) -> DataFrame:
    """texts: seq, raw_text, optional source_url and fetched_at. Such rows have no external id."""
    have = texts.columns
    rows = texts if "fetched_at" in have else texts.withColumn("fetched_at", F.current_timestamp())
    url = F.col("source_url") if "source_url" in have else F.lit(None)
    return _raw(rows, "manual", F.lit(None), F.col("raw_text"), url, F.lit("{}"))


def healthy_text(text: Column) -> Column:
    """Is there anything to parse? Blank text is let in all the same."""
    return ~blank(strip(text))
