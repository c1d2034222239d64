"""Raw rows to parsed rows: rule-based extraction, model answers, and the overlay of the two."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from postweave import schemas as S
from postweave.functions import extract as X
from postweave.functions import jsonval as J
from postweave.functions.text import blank, or_null, stable_uuid, strip

# Confidence levels and warning texts.
BOARD_CONFIDENCE = 0.7
TITLED_CONFIDENCE = 0.5
UNTITLED_CONFIDENCE = 0.3
OVERLAY_CONFIDENCE = 0.3
NO_TITLE = "Could not extract job title"
NO_COMPANY = "Could not extract company name"
BY_RULES = "Parsed via structured extraction (no LLM)"
FELL_BACK = "LLM unavailable — used structured fallback"

def _no_strings() -> Column:
    return F.array().cast("array<string>")


def parsed_id(raw_id: Column) -> Column:
    return stable_uuid(F.lit("parsed"), raw_id)


def _finish(df: DataFrame, now: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Brings extracted columns to the parsed-row schema; absent columns get their defaults.

    Columns named in carry follow unchanged."""
    have = set(df.columns)
    defaults = {
        "id": parsed_id(F.col("raw_id")),
        "status": F.lit("parsed"),
        "preferred_skills": _no_strings(),
        "parsed_at": now if now is not None else F.current_timestamp(),
        "validation_issues": _no_strings(),
        "reviewer_notes": F.lit(""),
    }
    return df.select(*(
        (F.col(f.name) if f.name in have else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in S.PARSED
    ), *carry)


# How long descriptions may be; None for no limit.
Limits = dict[str, int | None]
UNCUT: Limits = {"lines": None, "chars": None}


def _from_text(text: Column, limits: Limits | None = None) -> dict[str, Column]:
    return {
        "job_title": X.title(text),
        "company": X.company(text),
        "location": X.location(text),
        "remote": X.is_remote(text),
        "salary": X.salary(text),
        "required_skills": X.skills(text),
        "employment_type": X.employment_type(text),
        "description_clean": X.description(text, **(limits or {})),
    }


def _from_metadata(fields: dict[str, Column]) -> dict[str, Column]:
    """Board metadata first, text second. Only the workplace value decides about remote."""
    meta = F.try_parse_json(F.col("metadata"))

    def value(path: str) -> Column:
        return or_null(J.text_or_null(meta, path))

    parts = F.concat_ws(", ", *(value(f"$.location.{k}") for k in ("city", "subregion", "countryName")))
    return fields | {
        "job_title": F.coalesce(value("$.title"), fields["job_title"]),
        "company": F.coalesce(value("$.company"), fields["company"]),
        "location": F.coalesce(or_null(parts), fields["location"]),
        "remote": F.coalesce(value("$.workplace") == "remote", F.lit(False)),
        "employment_type": F.coalesce(value("$.employment_type"), fields["employment_type"]),
    }


def _warnings(*conditional: Column) -> Column:
    return F.array_compact(F.array(*conditional))


def _generic_marks() -> dict[str, Column]:
    untitled, nameless = blank(F.col("job_title")), blank(F.col("company"))
    return {
        "job_title": F.when(untitled, S.UNKNOWN_TITLE).otherwise(F.col("job_title")),
        "confidence": F.when(untitled, UNTITLED_CONFIDENCE).otherwise(TITLED_CONFIDENCE),
        "parse_warnings": _warnings(F.when(untitled, NO_TITLE), F.when(nameless, NO_COMPANY)),
    }


def _board_marks() -> dict[str, Column]:
    """A board row that has no title at all is a failed record; an empty one is kept as it is."""
    failed = F.col("job_title").isNull()
    return {
        "job_title": F.coalesce("job_title", F.lit(S.FAILED_TITLE)),
        "confidence": F.when(failed, 0.0).otherwise(BOARD_CONFIDENCE),
        "parse_warnings": _warnings(
            F.when(failed, "Batch parse error: no job title").when(~F.col("remote"), BY_RULES)
        ),
    }


def _extract(raw: DataFrame, fields: dict[str, Column], carry: Sequence[str] = ()) -> DataFrame:
    """The one pass over the text. Marks are added above it, where Catalyst keeps a second projection
    because every extracted column is costly and used more than once."""
    return raw.select(
        F.col("id").alias("raw_id"), F.col("source").alias("_source"),
        *(c.alias(n) for n, c in fields.items()),
        F.lit(S.RULE_PARSER).alias("model_used"), *carry,
    )


def parse_generic(raw: DataFrame, now: Column | None = None, carry: Sequence[str] = (), limits: Limits | None = None) -> DataFrame:
    """carry: columns of raw that stay beside the parsed ones. limits: lines and chars of descriptions where not the usual ones, or UNCUT."""
    return _finish(_extract(raw, _from_text(F.col("raw_text"), limits), carry).withColumns(_generic_marks()), now, carry)


def parse_workable(raw: DataFrame, now: Column | None = None, limits: Limits | None = None) -> DataFrame:
    fields = _from_metadata(_from_text(F.col("raw_text"), limits))
    return _finish(_extract(raw, fields).withColumns(_board_marks()), now)


def parse_structured(raw: DataFrame, now: Column | None = None, limits: Limits | None = None) -> DataFrame:
    """Each row by the rules of its source, in one scan: text fields are extracted once for both kinds."""
    board = F.col("source") == "workable"
    text = _from_text(F.col("raw_text"), limits)
    meta = _from_metadata(text)
    changed = [n for n in text if meta[n] is not text[n]]
    fields = text | {n: F.when(board, meta[n]).otherwise(text[n]) for n in changed}
    is_board = F.col("_source") == "workable"
    generic, special = _generic_marks(), _board_marks()
    marks = {n: F.when(is_board, special[n]).otherwise(generic[n]) for n in generic}
    return _finish(_extract(raw, fields).withColumns(marks), now)


def failure_rows(failed: DataFrame, now: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """failed: raw_id, model_used, error. A row per record that could not be parsed."""
    return _finish(failed.select(
        "raw_id", "model_used",
        F.lit(S.FAILED_TITLE).alias("job_title"),
        F.lit(False).alias("remote"),
        _no_strings().alias("required_skills"),
        F.lit(0.0).alias("confidence"),
        F.array("error").alias("parse_warnings"),
        *carry,
    ), now, carry)


# What the model is asked for; pass another template with the same placeholder to change it.
PROMPT = """Read the job posting below and answer with one JSON object and nothing else.
Keys: job_title (text, never null), company, location, remote (true/false),
salary {min, max, currency, period} or null, required_skills (list), preferred_skills (list),
years_experience (integer), education_level, employment_type, description_clean (short summary),
confidence (0 to 1), parse_warnings (list). Use null for what the posting does not say.
Turn pay by the hour, day or month into pay by the year, as whole numbers, with period "yearly".
required_skills are those that the posting demands, preferred_skills those it would merely welcome.
employment_type is one of full-time, part-time, contract, internship, freelance.
confidence says how sure you are of the whole answer: near 1 where the posting states every field,
below 0.6 where title or company are guessed. Put every doubt into parse_warnings, in a few words.

{raw_text}
"""
PROMPT_CHARS = 8_000


def build_prompt(raw: DataFrame, template: str = PROMPT, chars: int | None = PROMPT_CHARS) -> DataFrame:
    """Adds the prompt with the head of the text, or all of it where chars is None."""
    head = F.col("raw_text") if chars is None else F.left(F.col("raw_text"), F.lit(chars))
    return raw.withColumn("prompt", F.replace(F.lit(template), F.lit("{raw_text}"), head))


def _unfenced(answer: Column) -> Column:
    """Text between the first two code fences, without the language tag; all of it if unfenced."""
    plain = strip(answer)
    inner = F.split_part(plain, F.lit("```"), F.lit(2))
    inner = F.when(inner.startswith("json"), F.substr(inner, F.lit(5))).otherwise(inner)
    return strip(F.when(plain.startswith("```"), inner).otherwise(plain))


class _Answer:
    """Typed reads of the answer object, each paired with the condition under which it is unfit."""

    def __init__(self, v: Column):
        self.v = v
        self.unfit: list[Column] = []

    def _get(self, path: str) -> tuple[Column, Column]:
        got = J.at(self.v, path)
        return got, F.coalesce(J.kind(got), F.lit("MISSING"))

    def string(self, path: str, default: str | None = None, nullable: bool = True) -> Column:
        got, k = self._get(path)
        allowed = ["MISSING", "STRING", *(["VOID"] if nullable else [])]
        self.unfit.append(~k.isin(*allowed))
        return F.when(got.isNull(), F.lit(default)).otherwise(F.try_variant_get(self.v, path, "string"))

    def boolean(self, path: str) -> Column:
        got, k = self._get(path)
        read = F.try_variant_get(self.v, path, "boolean")
        switch = F.try_variant_get(self.v, path, "string").isin("0", "1")
        fits = k.isin("MISSING", "BOOLEAN") | ((k == "BIGINT") & switch) | ((k == "STRING") & read.isNotNull())
        self.unfit.append(~fits)
        return F.coalesce(read, F.lit(False))

    def integer(self, path: str) -> Column:
        """Whole numbers, also written as 3.0 or "3"; a fraction is unfit."""
        got, _ = self._get(path)
        read = F.try_variant_get(self.v, path, "double")
        self.unfit.append(J.present(got) & (read.isNull() | (read != F.floor(read))))
        return read.cast("bigint").try_cast("int")

    def number(self, path: str, default: float) -> Column:
        got, _ = self._get(path)
        read = F.try_variant_get(self.v, path, "double")
        self.unfit.append(got.isNotNull() & read.isNull())
        return F.coalesce(read, F.lit(default))

    def strings(self, path: str) -> Column:
        got, k = self._get(path)
        read = F.coalesce(F.try_variant_get(self.v, path, "array<string>"), _no_strings())
        # Sorting puts nulls first; a lambda would be interpreted and read the variant once more.
        null_in = (F.size(read) > 0) & F.get(F.sort_array(read), F.lit(0)).isNull()
        self.unfit.append(~k.isin("MISSING", "ARRAY<STRING>", "ARRAY<VOID>") | null_in)
        return read


def decode_model_json(answers: DataFrame, now: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """answers: raw_id, model_used, response. Parsed rows; an unfit answer becomes a failure row."""
    v = F.try_parse_json(F.col("_json"))
    a = _Answer(F.col("_v"))
    money = J.at(F.col("_v"), "$.salary")
    money_kind = F.coalesce(J.kind(money), F.lit("VOID"))
    # Falsy values count as no salary.
    no_money = money_kind.isin("VOID", "OBJECT<>", "ARRAY<VOID>") | money.cast("string").isin("", "0", "false")
    fields = {
        "job_title": a.string("$.job_title", S.UNKNOWN_TITLE, nullable=False),
        "company": a.string("$.company"),
        "location": a.string("$.location"),
        "remote": a.boolean("$.remote"),
        "_min": a.integer("$.salary.min"),
        "_max": a.integer("$.salary.max"),
        "_currency": a.string("$.salary.currency", S.DEFAULT_CURRENCY, nullable=False),
        "_period": a.string("$.salary.period", S.DEFAULT_PERIOD, nullable=False),
        "required_skills": a.strings("$.required_skills"),
        "preferred_skills": a.strings("$.preferred_skills"),
        "years_experience": a.integer("$.years_experience"),
        "education_level": a.string("$.education_level"),
        "employment_type": a.string("$.employment_type"),
        "description_clean": a.string("$.description_clean"),
        "confidence": a.number("$.confidence", 1.0),
        "parse_warnings": a.strings("$.parse_warnings"),
    }
    unfit = ~no_money & ~money_kind.startswith("OBJECT<")
    for u in a.unfit:
        unfit = unfit | F.coalesce(u, F.lit(False))
    reason = (
        F.when(F.col("_v").isNull(), "not valid JSON")
        .when(~F.col("_object"), "not a JSON object")
        .when(unfit, "field of the wrong type")
    )
    read = (
        answers.select("raw_id", "model_used", _unfenced(F.col("response")).alias("_json"), *carry)
        .select("raw_id", "model_used", v.alias("_v"), F.startswith("_json", F.lit("{")).alias("_object"), *carry)
        .select("raw_id", "model_used", *carry, reason.alias("_why"), (~no_money).alias("_paid"),
                *(c.alias(n) for n, c in fields.items()))
    )
    bad = F.col("_why").isNotNull()
    salary = F.struct(
        F.col("_min").alias("min"), F.col("_max").alias("max"),
        F.col("_currency").alias("currency"), F.col("_period").alias("period"),
    )
    keep = {n: F.when(~bad, F.col(n)) for n in fields if not n.startswith("_")}
    keep |= {
        "job_title": F.when(bad, S.FAILED_TITLE).otherwise(F.col("job_title")),
        "remote": ~bad & F.col("remote"),
        "salary": F.when(~bad & F.col("_paid"), salary),
        "confidence": F.when(bad, 0.0).otherwise(F.col("confidence")),
        "parse_warnings": F.when(bad, F.array(F.concat(F.lit("Batch parse error: "), "_why")))
        .otherwise(F.col("parse_warnings")),
    }
    for n in ("required_skills", "preferred_skills"):
        keep[n] = F.when(bad, _no_strings()).otherwise(F.col(n))
    return _finish(read.select("raw_id", "model_used", *carry, *(c.alias(n) for n, c in keep.items())), now, carry)


def usable(prefix: str = "") -> Column:
    """Did the primary parser give a row worth keeping? Never null."""
    title, confidence = F.col(f"{prefix}job_title"), F.col(f"{prefix}confidence")
    return F.coalesce((title != S.FAILED_TITLE) & (confidence >= OVERLAY_CONFIDENCE), F.lit(False))


def _fallback_warnings(warnings: Column) -> Column:
    return F.array_append(F.coalesce(warnings, _no_strings()), F.lit(FELL_BACK))


def hybrid_overlay(primary: DataFrame, structured: DataFrame) -> DataFrame:
    """The primary row where it parsed with enough confidence, else the structured row with a warning.

    Joined on raw_id, unique on both sides. Records the primary never answered count as failed.
    """
    def pick(n: str) -> Column:
        fallback = F.col(f"s.{n}")
        fallback = _fallback_warnings(fallback) if n == "parse_warnings" else fallback
        return F.when(usable("p."), F.col(f"p.{n}")).otherwise(fallback).alias(n)

    joined = structured.alias("s").join(primary.alias("p"), F.col("s.raw_id") == F.col("p.raw_id"), "left")
    return joined.select(*(pick(f.name) for f in S.PARSED))


def hybrid_parse(raw: DataFrame, primary: DataFrame, fallback: Callable[[DataFrame], DataFrame] = parse_structured) -> DataFrame:
    """hybrid_overlay without parsing twice: only rows that the primary did not settle reach the fallback.

    primary is read twice and filtered, so pass pinned rows, as extract_with_model returns them.
    """
    names = [f.name for f in S.PARSED]
    good = primary.filter(usable()).select(*names)
    rest = raw.join(good.select(F.col("raw_id").alias("id")), "id", "left_anti")
    parsed = fallback(rest).withColumn("parse_warnings", _fallback_warnings(F.col("parse_warnings")))
    return good.unionByName(parsed.select(*names))


def parse_stats(parsed: DataFrame) -> DataFrame:
    """Parsed and failed rows, extra attempts and fallback answers per model.

    attempts and fallback come from extract_with_model; without them those counts are zero.
    """
    failed = F.col("job_title") == S.FAILED_TITLE
    has = set(parsed.columns)
    tries = F.col("failed_attempts") if "failed_attempts" in has else F.lit(0)
    fell = F.col("used_fallback") if "used_fallback" in has else F.lit(False)
    return parsed.groupBy("model_used").agg(
        F.count_if(~failed).alias("parsed"),
        F.count_if(failed).alias("errors"),
        F.sum(tries.cast("bigint")).alias("retries"),
        F.count_if(fell).alias("fallbacks"),
    )
