"""String helpers for headers, slugs and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalise_headers(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Trim, lower-case and underscore every column name, then rename."""
    rename = rename or {}
    names = [header(c) for c in df.columns]
    return df.toDF(*[rename.get(n, n) for n in names])


def slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), " ", "_")


def lookup_key(c: Column) -> Column:
    """The form under which a series key is stored for case-insensitive lookups."""
    return F.lower(F.trim(c))
