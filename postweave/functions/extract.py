"""Field extraction from posting text: Column in, Column out, no Python at run time."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from postweave import schemas as S
from postweave.functions.text import SPACE, java_pattern, or_null, squeeze, strip

# The patterns of each field, in the order in which they are tried,
# and the skill names in the order in which they are reported.
TITLE_PATTERNS = (
    r"^Title:\s*(.+)",
    r"(?:job\s*)?title[:\s]+([^\n]+)",
    r"^([A-Z][A-Za-z\s]+(?:Engineer|Developer|Manager|Designer|Analyst|Architect|Consultant|Lead|Head|Director))",
)
COMPANY_PATTERNS = (
    r"^Company:\s*(.+)",
    r"company[:\s]+([^\n]+)",
    r"at\s+([A-Z][A-Za-z0-9\s&.]+?)(?:\s*(?:-|\||in|\n|$))",
)
LOCATION_PATTERNS = (
    r"^Location:\s*(.+)",
    r"location[:\s]+([^\n]+)",
    r"(?:remote|hybrid|on.?site)\s*(?:-|\||in)?\s*([A-Za-z,\s]+)",
    r"(?:in|at)\s+([A-Z][a-z]+(?:\s*,\s*[A-Z][a-z]+)?)",
)
# Of the salary patterns, the optional currency before and unit after a range are left out: they
# hold no digits, so they change no captured number, and without them a search starts at a digit.
SALARY_PATTERNS = (
    r"(\d{2,3}(?:,\d{3})?(?:k|K)?)\s*(?:-|–|to)\s*(?:\$|USD|GBP|EUR)?\s*(\d{2,3}(?:,\d{3})?(?:k|K)?)",
    r"(?:salary|range|pay)[:\s]+(?:\$|USD|GBP|EUR)?\s*(\d[\d,]*)\s*(?:-|–|to)\s*(?:\$|USD|GBP|EUR)?\s*(\d[\d,]*)",
)
EMPLOYMENT_PATTERNS = (
    r"employment\s*(?:type)?[:\s]+(full.time|part.time|contract|internship|freelance)",
    r"(full.time|part.time|contractor?|internship|freelance)",
)
DESCRIPTION_HEADERS = (
    "description", "requirements", "qualifications", "about", "responsibilities", "what you'll do",
)
SKILLS = (
    "Python", "Java", "JavaScript", "TypeScript", "Go", "Rust", "C++", "C#",
    "React", "Angular", "Vue", "Node.js", "Django", "Flask", "FastAPI",
    "PostgreSQL", "MySQL", "MongoDB", "Redis", "Kubernetes", "Docker",
    "AWS", "Azure", "GCP", "Terraform", "CI/CD", "Git", "Linux",
    "Machine Learning", "AI", "Data Science", "NLP", "Computer Vision",
    "REST API", "GraphQL", "gRPC", "Kafka", "RabbitMQ", "Spark", "Flink",
    "Agile", "Scrum", "SQL", "NoSQL", "HTML", "CSS", "Sass",
    "Figma", "Photoshop", "Illustrator", "UI/UX", "Product Management",
)
SALARY_FLOOR = 1_000
SALARY_CEILING = 5_000_000
LOCATION_MIN, LOCATION_MAX = 3, 99
DESCRIPTION_LINES = 100
DESCRIPTION_CHARS = 2_000

LINEWISE, ANYWHERE = "imdU", "idU"
_SEP = "\u0001"


def _first_group(text: Column, pattern: str, flags: str) -> Column:
    """Group 1 of the first match, null without a match.

    Every group 1 above takes at least one character, so an empty result means no match and
    the pattern needs no separate test run.
    """
    return or_null(F.regexp_extract(text, java_pattern(pattern, flags), 1))


def _first_matching(text: Column, patterns: Sequence[str], flags: str) -> Column:
    """Stripped capture of the first pattern that matches; may be empty after stripping."""
    return strip(F.coalesce(*(_first_group(text, p, flags) for p in patterns)))


def title(text: Column) -> Column:
    return _first_matching(text, TITLE_PATTERNS, LINEWISE)


def company(text: Column) -> Column:
    return _first_matching(text, COMPANY_PATTERNS, LINEWISE)


def location(text: Column) -> Column:
    """Like the others, but a capture of unfit length passes the turn to the next pattern."""
    def fit(pattern: str) -> Column:
        found = strip(F.regexp_extract(text, java_pattern(pattern, LINEWISE), 1))
        return F.when(F.length(found).between(LOCATION_MIN, LOCATION_MAX), found)

    return F.coalesce(*(fit(p) for p in LOCATION_PATTERNS))


def employment_type(text: Column) -> Column:
    return F.lower(_first_matching(text, EMPLOYMENT_PATTERNS, ANYWHERE))


def is_remote(text: Column) -> Column:
    low = F.lower(text)
    return low.contains("remote") | low.contains("hybrid")


def skills(text: Column, names: Sequence[str] = SKILLS, whole_words: bool = False) -> Column:
    """Skills named in the text, in the order of `names`; substring test unless whole_words.

    Hits are joined and split again because concat_ws drops nulls inside generated code, where
    the lower-cased text is made once; array_compact would leave it and lower-case per name.
    """
    low = F.lower(text)
    if whole_words:
        def hit(n: str) -> Column:
            return low.rlike(rf"(?<![\p{{L}}\p{{N}}])\Q{n.lower()}\E(?![\p{{L}}\p{{N}}])")
    else:
        def hit(n: str) -> Column:
            return low.contains(n.lower())
    joined = F.concat_ws(_SEP, *(F.when(hit(n), F.lit(n)) for n in names))
    return F.array_remove(F.split(joined, _SEP), "")


# Decimal digits of all scripts, as the patterns match them, and what they stand for.
_OTHER = [(chr(i), str(unicodedata.decimal(chr(i)))) for i in range(128, 0x110000) if unicodedata.decimal(chr(i), None) is not None]
_OTHER_DIGITS, _ASCII_DIGITS = ("".join(x) for x in zip(*_OTHER))


def _amount(digits: Column) -> Column:
    """Number behind one salary capture; null when it has more digits than any number here."""
    n = F.translate(F.rtrim(digits, F.lit("k")), _OTHER_DIGITS, _ASCII_DIGITS).try_cast("bigint")
    return n * F.when(digits.endswith("k"), 1000).otherwise(1)


# Cheap test that any salary match implies; spares most texts the two full scans.
_RANGE_HINT = java_pattern(r"[\d,k]\s*(?:-|–|to)\s*(?:\$|USD|GBP|EUR)?\s*\d", ANYWHERE)


def salary(text: Column) -> Column:
    """First match, over all matches of the first then the second pattern, with two sound numbers.

    Both numbers must reach the floor (which also rules out 0k) and stay below the ceiling. Matches
    pass through one small step after the other, since nothing is shared inside a lambda.
    """
    def ranges(pattern: str) -> Column:
        jp = java_pattern(pattern, ANYWHERE)
        low, high = F.lit(SALARY_FLOOR), F.lit(SALARY_CEILING - 1)

        def digits(m: Column) -> Column:
            return F.struct(*(
                F.lower(F.replace(F.regexp_extract(m, jp, i), F.lit(","), F.lit(""))).alias(n) for i, n in ((1, "a"), (2, "b"))
            ))

        hits = F.transform(F.regexp_extract_all(text, F.lit(jp), F.lit(0)), digits)
        pairs = F.transform(hits, lambda d: F.struct(_amount(d["a"]).alias("a"), _amount(d["b"]).alias("b")))
        sound = F.filter(pairs, lambda p: p["a"].between(low, high) & p["b"].between(low, high))
        return F.try_element_at(F.transform(sound, lambda p: F.struct(
            F.least(p["a"], p["b"]).cast("int").alias("min"),
            F.greatest(p["a"], p["b"]).cast("int").alias("max"),
            F.lit(S.DEFAULT_CURRENCY).alias("currency"),
            F.lit(S.DEFAULT_PERIOD).alias("period"),
        )), F.lit(1))

    return F.when(text.rlike(_RANGE_HINT), F.coalesce(*(ranges(p) for p in SALARY_PATTERNS)))


_IN_LINE = r"[\s\x1c-\x1f&&[^\n]]"
_TAIL = (
    rf"(?imdU)^{_IN_LINE}*+((?:" + "|".join(DESCRIPTION_HEADERS) + r")"
    rf"(?::|{_IN_LINE}++[^\s\x1c-\x1f])(?s:.*))"
)
_BREAKS = rf"(?U){_IN_LINE}*+\n[\s\x1c-\x1f]*+"


def description(text: Column, lines: int | None = DESCRIPTION_LINES, chars: int | None = DESCRIPTION_CHARS) -> Column:
    """Stripped, non-empty lines from the first header line on, or the head of the text without one; None sets no limit."""
    tail = F.regexp_extract(text, _TAIL, 1)
    body = F.regexp_replace(strip(tail), _BREAKS, "\n")
    body = body if lines is None else F.substring_index(body, "\n", lines)
    return F.when(tail != "", body).otherwise(text if chars is None else F.left(text, F.lit(chars)))


_HEAD = rf"(?dU)^{SPACE}*+([^\n]*+(?:\n[^\n]*+)?)"
# Labels and separators that do not tell two postings apart.
FINGERPRINT_NOISE = r"title:|company:|-|\|"


def fingerprint(text: Column) -> Column:
    """MD5 over the normalised first two lines (usually title and company)."""
    head = F.lower(F.regexp_extract(text, _HEAD, 1))
    return F.md5(squeeze(F.regexp_replace(head, FINGERPRINT_NOISE, " ")))
