"""String helpers whose whitespace rules agree with Python's str methods."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Python counts \x1c-\x1f as whitespace, Java's \s does not.
SPACE = r"[\s\x1c-\x1f]"
# The same characters one by one: trimming looks at both ends only, a pattern at every run in between.
SPACES = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_RUN = rf"(?U){SPACE}++"


def java_pattern(pattern: str, flags: str = "imdU") -> str:
    """Java spelling of a Python pattern: d stops . and $ at \\n only, U makes classes Unicode-aware."""
    return f"(?{flags})" + pattern.replace(r"\s", SPACE)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Every whitespace run becomes one space; none are left at the ends."""
    return F.btrim(F.regexp_replace(c, _RUN, " "))


def blank(c: Column) -> Column:
    """Null or empty, the two values that count as missing."""
    return c.isNull() | (c == "")


def or_null(c: Column) -> Column:
    """The value, or null where it is empty."""
    return F.when(c != "", c)


def stable_uuid(*parts: Column) -> Column:
    """UUID-shaped id computed from its parts, so that a re-run task makes the same id again."""
    h = F.md5(F.concat_ws("\u0001", *parts))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
        F.substring(h, 17, 4), F.substring(h, 21, 12),
    )
