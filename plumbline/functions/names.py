"""Column expressions that classify table names, column names and descriptions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The identifier pattern and the word lists decide which checks run.
VALID_NAME = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
TEMPORAL_TERMS = ["date", "time", "timestamp", "created", "updated", "modified", "ingested", "_at", "_ts"]
VETO_TERM = "status"
FRESHNESS_TERMS = ["ingested", "updated", "created", "_ts", "_date", "timestamp"]
COMPLETENESS_TERMS = ["id", "key", "uuid", "pk"]

TEMPORAL_TYPES = ["date", "timestamp", "timestamp_ntz"]


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True when ``text`` holds at least one of ``terms``; false for an empty list."""
    if not terms:
        return F.lit(False)
    return text.rlike("|".join(re.escape(t) for t in terms))


def is_valid_name(name: Column) -> Column:
    return name.rlike(VALID_NAME)


def is_temporal_name(name: Column) -> Column:
    return contains_any(F.lower(name), TEMPORAL_TERMS)


def is_vetoed_name(name: Column) -> Column:
    return F.lower(name).contains(VETO_TERM)


def name_flags(name: str) -> dict[str, bool]:
    """The same rules for one name: whether it is valid, sounds temporal, and is vetoed for freshness."""
    lower = name.lower()
    return {
        "valid_name": re.fullmatch(VALID_NAME, name) is not None,
        "temporal_name": any(t in lower for t in TEMPORAL_TERMS),
        "vetoed_name": VETO_TERM in lower,
    }


def is_temporal_type(data_type: Column) -> Column:
    """Type text of the column itself; a timestamp nested in a struct does not count."""
    return data_type.isin(TEMPORAL_TYPES)


def passes_freshness_gate(name: Column, data_type: Column) -> Column:
    temporal = is_temporal_type(data_type) | is_temporal_name(name)
    return is_valid_name(name) & temporal & ~is_vetoed_name(name)


def suggests_freshness(name: Column) -> Column:
    return contains_any(F.lower(name), FRESHNESS_TERMS)


def suggests_completeness(name: Column) -> Column:
    return contains_any(F.lower(name), COMPLETENESS_TERMS)


def is_excluded(schema: Column, table: Column, patterns: Sequence[str]) -> Column:
    """Any pattern found in the lower-cased full name; the table name is part of it."""
    wanted = [p.strip().lower() for p in patterns]
    full_name = F.lower(F.concat_ws(".", schema, table))
    return reduce(lambda a, b: a | b, [full_name.contains(p) for p in wanted if p], F.lit(False))


def split_patterns(text: str) -> list[str]:
    """Comma-separated exclusion text; empty pieces are dropped, as they match every name."""
    return [p.strip().lower() for p in text.split(",") if p.strip()]


def is_pushable(description: Column) -> Column:
    """Non-empty and not an error message that was stored in place of a description."""
    failed = description.contains("Error") | description.startswith("ERROR:")
    return F.coalesce((description != "") & ~failed, F.lit(False))


def last_segment(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def schema_part(name: Column, default_schema: Column) -> Column:
    """Text before the first dot; the default when there is no dot."""
    return F.when(name.contains("."), F.substring_index(name, ".", 1)).otherwise(default_schema)


def table_part(name: Column) -> Column:
    """Text after the first dot; the whole name when there is no dot."""
    return F.element_at(F.split(name, r"\.", 2), -1)
