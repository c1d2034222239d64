"""Reading of JSON values with Python's rules: missing and null differ, and null prints as None."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# How a number written with a zero fraction (5000.0) is typed; Python prints it with the fraction.
_WHOLE_DECIMAL = r"^DECIMAL\(\d+,0\)$"


def at(v: Column, path: str) -> Column:
    """Sub-value as VARIANT: SQL null when missing, variant null when the JSON says null."""
    return F.try_variant_get(v, path, "variant")


def kind(v: Column) -> Column:
    """Type name of a variant (STRING, BIGINT, BOOLEAN, VOID, ARRAY<…>, OBJECT<…>); null when missing."""
    return F.schema_of_variant(v)


def present(v: Column) -> Column:
    """Neither missing nor JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def text_or_null(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def printed(v: Column, path: str, default: str = "") -> Column:
    """The value as Python prints it: `default` when missing, None for null, True/False for booleans."""
    got = at(v, path)
    text = F.try_variant_get(v, path, "string")
    return (
        F.when(got.isNull(), F.lit(default))
        .when(F.is_variant_null(got), F.lit("None"))
        .when(kind(got) == "BOOLEAN", F.initcap(text))
        .when(kind(got).rlike(_WHOLE_DECIMAL) & (F.length(text) <= 18), F.concat(text, F.lit(".0")))
        .otherwise(text)
    )
