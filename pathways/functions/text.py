"""Names and text values."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .nulls import as_col


def snake_case(name: str) -> str:
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    name = re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()
    return f"x{name}" if name[:1].isdigit() else name


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case every column; repeated names get a running suffix."""
    seen: dict[str, int] = {}
    names = []
    for raw in df.columns:
        base = snake_case(raw) or "x"
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return df.toDF(*names)


def replace_first(value: Column | str, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(as_col(value), f"^((?s:.)*?)(?:{pattern})", "$1" + replacement)


def has(value: Column | str, pattern: str) -> Column:
    """Regular expression found in the text; plain text is searched as such."""
    c = as_col(value)
    plain = not set(pattern) & set("\\^$.|?*+()[]{}")
    return c.contains(pattern) if plain else c.rlike(pattern)


def first_match(rules: list[tuple[Column, object]], default: Column | None = None) -> Column:
    """Value of the first rule that is true; a missing condition is not true."""
    (condition, value), *rest = rules
    out = F.when(condition, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out if default is None else out.otherwise(default)
