"""Generate a check configuration: catalog, exclusions, evidence, suggestions, append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators.suggest import (
    candidate_evidence,
    exclude_tables,
    suggest_checks,
    suggestions_from_evidence,
)
from plumbline.sources.catalog import catalog_of
from plumbline.sources.configs import append_config


def generate_checks(
    spark: SparkSession,
    tables: Mapping[tuple[str, str], DataFrame],
    exclude: Sequence[str] = (),
    suggestions: DataFrame | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Entries for every table that is not excluded, after the existing ones.

    Without given suggestions the data is asked: the first temporal column and the first column free of nulls and
    duplicates among those whose names make them candidates. A table whose data can't be read has its names alone.
    """
    catalog = exclude_tables(catalog_of(spark, tables), exclude)
    if suggestions is None:
        suggestions = suggestions_from_evidence(candidate_evidence(catalog, tables, exact=False))
    generated = suggest_checks(catalog, suggestions)
    return generated if existing is None else append_config(existing, generated)
