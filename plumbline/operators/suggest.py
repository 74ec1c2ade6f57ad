"""Propose checks for cataloged tables from suggestions, evidence in the data and column names."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from plumbline.functions.literals import local_rows
from plumbline.functions.names import (
    TEMPORAL_TYPES,
    is_excluded,
    is_valid_name,
    last_segment,
    suggests_completeness,
    suggests_freshness,
)
from plumbline.operators.keys import NESTED, grouping_key, key_profiles
from plumbline.sources.tables import reraise_if_stopped, side_by_side

_TABLE = ["schema", "table"]


def exclude_tables(catalog: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return catalog.where(~is_excluded(F.col("schema"), F.col("table"), patterns))


def name_candidates(catalog: DataFrame) -> DataFrame:
    """Per table: the first column, in table order, whose name looks like a load time or a key."""
    named = catalog.select(
        "*",
        F.when(suggests_freshness(F.col("column")), F.col("column")).alias("freshness_name"),
        F.when(suggests_completeness(F.col("column")), F.col("column")).alias("completeness_name"),
    )
    return named.groupBy(*_TABLE).agg(
        F.min("table_pos").alias("table_pos"),
        F.expr("min_by(freshness_name, ordinal) FILTER (WHERE freshness_name IS NOT NULL)").alias("freshness_name"),
        F.expr("min_by(completeness_name, ordinal) FILTER (WHERE completeness_name IS NOT NULL)").alias(
            "completeness_name"
        ),
    )


def valid_suggestions(suggestions: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per table with the suggested columns that the table really has."""
    proposed = suggestions.select(
        *_TABLE,
        F.expr("stack(2, 'freshness', freshness_col, 'completeness', completeness_col) AS (kind, column)"),
    )
    existing = proposed.join(catalog, [*_TABLE, "column"], "left_semi")
    return existing.groupBy(*_TABLE).agg(
        F.expr("max(column) FILTER (WHERE kind = 'freshness')").alias("freshness_suggested"),
        F.expr("max(column) FILTER (WHERE kind = 'completeness')").alias("completeness_suggested"),
    )


def suggest_checks(catalog: DataFrame, suggestions: DataFrame | None = None) -> DataFrame:
    """Check configuration entries, one per cataloged table; a table without candidates keeps a bare entry."""
    entries = name_candidates(catalog)
    freshness, completeness = F.col("freshness_name"), F.col("completeness_name")
    if suggestions is not None:
        entries = entries.join(valid_suggestions(suggestions, catalog), _TABLE, "left")
        freshness = F.coalesce(F.col("freshness_suggested"), freshness)
        completeness = F.coalesce(F.col("completeness_suggested"), completeness)
    return entries.select(
        F.col("table_pos").alias("pos"),
        F.concat_ws(".", F.col("schema"), last_segment(F.col("table"))).alias("table"),
        freshness.alias("freshness_col"),
        completeness.alias("completeness_col"),
    )


_EVIDENCE = (
    "schema string, table string, table_pos long, ordinal long, column string, data_type string, kind string, "
    "n_rows long, nulls long, surplus long, usable boolean, reason string"
)
_WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Sketches of 2**14 counters have a standard error of 0.81 % (fixed value of the method); six of them rule a column out.
SKETCH_LOG2 = 14
SKETCH_MARGIN = 1 + 6 * 0.0081


def candidate_columns(catalog: DataFrame) -> DataFrame:
    """Checkable columns whose names make them candidates, one row per kind of check."""
    kinds = F.array(
        F.when(suggests_freshness(F.col("column")), F.lit("freshness")),
        F.when(suggests_completeness(F.col("column")), F.lit("completeness")),
    )
    return (
        catalog.where(is_valid_name(F.col("column")))
        .select("*", F.explode(F.array_compact(kinds)).alias("kind"))
        .select(*_TABLE, "table_pos", "ordinal", "column", "data_type", "kind")
    )


def _measurable(df: DataFrame, candidate: Mapping) -> bool:
    """Whether the column has one meaning and, as a key, a type that Spark groups; planned, not run."""
    column = candidate["column"]
    try:
        if candidate["kind"] == "freshness":
            df.select(f"`{column}`").schema  # noqa: B018  names are resolved here
        else:
            df.groupBy(grouping_key(column, df.schema[column].dataType)).count().schema  # noqa: B018
    except (AnalysisException, KeyError):
        return False
    return True


def _totals(df: DataFrame, candidates: Mapping[int, dict], sketched: bool) -> Row:
    """Rows, nulls, ranges of whole numbers and estimated different values of other keys, all in one scan."""
    totals = [F.count(F.lit(1)).alias("n_rows")]
    for n, c in candidates.items():
        value = F.col(f"`{c['column']}`")
        totals.append(F.count_if(value.isNull()).alias(f"nulls_{n}"))
        if c["kind"] != "freshness" and c["data_type"] in _WHOLE:
            totals += [F.min(value).alias(f"min_{n}"), F.max(value).alias(f"max_{n}")]
        elif c["kind"] != "freshness" and sketched:
            data_type = df.schema[c["column"]].dataType
            key = grouping_key(c["column"], data_type) if isinstance(data_type, NESTED) else value
            sketch = F.hll_sketch_agg(F.xxhash64(key), SKETCH_LOG2)
            totals.append(F.hll_sketch_estimate(sketch).alias(f"distinct_{n}"))
    return df.agg(*totals).first()


def _may_be_key(totals: Mapping, number: int) -> bool:
    """False where rows, nulls, the range of a whole-number column or a sketch already tell that values repeat."""
    if not totals["n_rows"] or totals[f"nulls_{number}"]:
        return False
    if f"min_{number}" in totals:
        return totals[f"max_{number}"] - totals[f"min_{number}"] + 1 >= totals["n_rows"]
    return totals.get(f"distinct_{number}", math.inf) * SKETCH_MARGIN >= totals["n_rows"]


def _surplus(df: DataFrame, keys: Mapping[int, dict], exact: bool) -> dict[int, int]:
    """Surplus rows of key columns: of all in one job, or one column after the other until one has none."""
    if not keys:
        return {}
    if exact:
        return {r["number"]: r["surplus"] for r in key_profiles([(n, df, c["column"]) for n, c in keys.items()]).collect()}
    found: dict[int, int] = {}
    for n, c in keys.items():
        found[n] = key_profiles([(n, df, c["column"])]).first()["surplus"]
        if not found[n]:
            break
    return found


def _evidence_of(df: DataFrame, candidates: Mapping[int, dict], exact: bool) -> list[dict]:
    """Evidence of one table: one scan for totals, then the columns that only grouping can tell about."""
    totals = _totals(df, candidates, not exact).asDict()
    keys = {n: c for n, c in candidates.items() if c["kind"] != "freshness"}
    surplus = _surplus(df, {n: c for n, c in keys.items() if exact or _may_be_key(totals, n)}, exact)
    found = []
    for n, c in candidates.items():
        n_rows, nulls = totals["n_rows"], totals[f"nulls_{n}"]
        if c["kind"] == "freshness":
            usable = c["data_type"] in TEMPORAL_TYPES and nulls < n_rows
        else:
            usable = n_rows > 0 and nulls == 0 and surplus.get(n) == 0
        found.append(c | {"n_rows": n_rows, "nulls": nulls, "surplus": surplus.get(n), "usable": usable, "reason": None})
    return found


def candidate_evidence(
    catalog: DataFrame, tables: Mapping[tuple[str, str], DataFrame], exact: bool = True, at_once: int = 8
) -> DataFrame:
    """What the data says about each candidate, one row each.

    Usable means: of a temporal type and not all null, or free of nulls and surplus rows. Tables are measured side by side,
    each by itself. The candidates of a table that fails are halved until those that fail are alone; they have rows without counts
    and the ``reason``. Columns that have no clear name, and keys that can't be grouped, are no candidates.

    Without ``exact``, key columns that nulls, the range of their whole numbers or a sketch of their different values rule out
    are not grouped, nor those after the first key of a table; they have no surplus count. A sketch rules a key out
    wrongly once in a billion columns. One row per candidate passes through the driver, as the catalog does.
    """
    spark = catalog.sparkSession
    listed = [row.asDict() for row in candidate_columns(catalog).collect()]
    listed.sort(key=lambda c: (c["table_pos"], c["ordinal"], c["kind"]))
    by_table: dict[tuple[str, str], dict[int, dict]] = {}
    for number, candidate in enumerate(listed):
        key = candidate["schema"], candidate["table"]
        if _measurable(tables[key], candidate):
            by_table.setdefault(key, {})[number] = candidate

    def measure(key: tuple[str, str], candidates: dict[int, dict]) -> list[dict]:
        try:
            return _evidence_of(tables[key], candidates, exact)
        except Exception as error:  # isolation boundary
            reraise_if_stopped(spark, error)
            if len(candidates) == 1:
                none = {"n_rows": None, "nulls": None, "surplus": None, "usable": False, "reason": str(error).split("\n")[0]}
                return [c | none for c in candidates.values()]
        numbers = list(candidates)
        half = len(numbers) // 2
        return [row for part in (numbers[:half], numbers[half:]) for row in measure(key, {n: candidates[n] for n in part})]

    found = side_by_side(spark, lambda key: measure(key, by_table[key]), by_table, at_once)
    return local_rows(spark, [row for rows in found.values() for row in rows], _EVIDENCE)


def suggestions_from_evidence(evidence: DataFrame) -> DataFrame:
    """Per table: the first usable candidate of each kind, in table order."""
    return evidence.groupBy(*_TABLE).agg(
        F.expr("min_by(column, ordinal) FILTER (WHERE usable AND kind = 'freshness')").alias("freshness_col"),
        F.expr("min_by(column, ordinal) FILTER (WHERE usable AND kind = 'completeness')").alias("completeness_col"),
    )
