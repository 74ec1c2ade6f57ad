"""The three checks: measure them over a table, then label the measures of many tables at once."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from plumbline.functions.ages import Clock, hours_between, iso_age_hours, iso_spelling
from plumbline.functions.literals import literal_rows, local_rows
from plumbline.functions.names import TEMPORAL_TYPES, name_flags
from plumbline.functions.outcomes import (
    BAD_NAME,
    ERROR,
    ERROR_TEXT_LENGTH,
    FAILED,
    NOT_TEMPORAL,
    SQL_ERROR,
    WARNING,
    completeness_outcome,
    freshness_outcome,
    not_a_time_outcome,
    severity,
    uniqueness_outcome,
)
from plumbline.operators.keys import grouping_key, key_profiles

FRESHNESS = "Freshness"
COMPLETENESS = "Completeness"
UNIQUENESS = "Uniqueness"

RESULT_SCHEMA = (
    "pos long, check_pos int, dataset_name string, table_name string, column_name string, check_type string, "
    "result_value string, status string, severity string, metric double, metadata string"
)
_CHECK_SCHEMA = (
    "pos long, check_pos int, dataset_name string, table_name string, "
    "column_name string, check_type string, data_type string"
)


@dataclass(frozen=True)
class Check:
    """One check of one column, with the column as the table spells it and its type."""

    pos: int
    check_pos: int
    dataset_name: str
    table_name: str
    column_name: str
    check_type: str
    field: str
    data_type: str


def finding(check: Check, value: str, status: str, reason: str) -> dict:
    """A result row that is known without a scan."""
    identity = {k: v for k, v in asdict(check).items() if k not in ("field", "data_type")}
    return identity | {
        "result_value": value,
        "status": status,
        "severity": "WARN" if status == WARNING else "FAIL",
        "metric": None,
        "metadata": json.dumps({"reason": reason}),
    }


def error_finding(check: Check, reason: str) -> dict:
    if check.check_type == FRESHNESS:
        return finding(check, f"Err: {reason[:ERROR_TEXT_LENGTH]}", ERROR, reason)
    return finding(check, SQL_ERROR, FAILED, reason)


def first_line(error: BaseException) -> str:
    return str(error).split("\n")[0]


def _field_name(df: DataFrame, column: str) -> str | None:
    """The table's spelling of a column, by the session's case rule."""
    if column in df.columns:
        return column
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return None
    return next((name for name in df.columns if name.lower() == column.lower()), None)


def screen(check: Check, df: DataFrame | str, valid_name: bool, temporal_name: bool, vetoed_name: bool) -> Check | dict:
    """The check with its field and type, or the result row if it can't or need not run.

    ``df`` is the table, or the reason why there is none. A column that can't be named without doubt, or whose type can't
    be grouped for uniqueness, is found by planning the expression; nothing is read.
    """
    if not valid_name:
        return finding(check, BAD_NAME, WARNING, "not a plain column name")
    if isinstance(df, str):
        return error_finding(check, df)
    field = _field_name(df, check.column_name)
    if field is None:
        return error_finding(check, f"missing column {check.column_name}")
    data_type = df.schema[field].dataType.simpleString()
    if check.check_type == FRESHNESS and (vetoed_name or not (data_type in TEMPORAL_TYPES or temporal_name)):
        return finding(check, NOT_TEMPORAL, WARNING, "neither type nor name is temporal")
    try:
        if check.check_type == UNIQUENESS:
            df.groupBy(grouping_key(field, df.schema[field].dataType)).count()
        else:
            df.select(F.col(f"`{field}`"))
    except AnalysisException as error:
        return error_finding(check, first_line(error))
    return replace(check, field=field, data_type=data_type)


def _measure(
    number: int | str, amount: str = "0L", instant: str = "NULL", wall: str = "NULL", text: str = "NULL"
) -> list[str]:
    """The columns of a measure row; the times and the text are the newest value in its own type."""
    return [
        f"{number} AS check_number", "n_rows", f"{amount} AS amount",
        f"CAST({instant} AS TIMESTAMP) AS instant", f"CAST({wall} AS TIMESTAMP_NTZ) AS wall",
        f"CAST({text} AS STRING) AS text",
    ]


def _has_nested(schema: StructType) -> bool:
    return any(isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType)) for f in schema)


def scan_measures(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """Measures of all freshness and completeness checks of a table, from one aggregate over one scan."""
    # A plain count can be answered from Parquet footers where a session turns that on. The footers
    # of nested columns count leaves, so a table that has any gets a count that reads the values.
    count = "count_if(`{}` IS NOT NULL)" if _has_nested(df.schema) else "count(`{}`)"
    totals = {"n_rows": "count(1)"}
    measures = []
    for number, check in checks:
        non_null, newest = f"`count {check.field}`", f"`max {check.field}`"
        if check.check_type == COMPLETENESS or check.data_type not in [*TEMPORAL_TYPES, "string"]:
            totals[non_null] = count.format(check.field)
            amount = f"n_rows - {non_null}" if check.check_type == COMPLETENESS else non_null
            measures.append(_measure(number, amount=amount))
            continue
        totals[newest] = f"max(`{check.field}`)"
        if check.data_type == "timestamp":
            measures.append(_measure(number, instant=newest))
        elif check.data_type == "string":
            measures.append(_measure(number, text=newest))
        else:
            measures.append(_measure(number, wall=newest))
    one_row = df.selectExpr(*(f"{aggregate} AS {name}" for name, aggregate in totals.items()))
    structs = (f"struct({', '.join(columns)})" for columns in measures)
    return one_row.selectExpr(f"inline(array({', '.join(structs)}))")


def measure_frames(tables: Sequence[tuple[DataFrame, Sequence[tuple[int, Check]]]]) -> list[DataFrame]:
    """Measures of numbered checks: a frame per scanned table and one for all uniqueness checks.

    A column that is checked for uniqueness is grouped once, which also counts its nulls: a completeness check of it needs no
    scan of its own.
    """
    frames = []
    keys: list[tuple[int, DataFrame, str]] = []
    amounts: list[str] = []
    for df, checks in tables:
        grouped: dict[str, int] = {}
        for number, check in checks:
            if check.check_type == UNIQUENESS and check.field not in grouped:
                grouped[check.field] = number
                keys.append((number, df, check.field))
        scanned = []
        for number, check in checks:
            if check.check_type == FRESHNESS or check.field not in grouped:
                scanned.append((number, check))
            else:
                amount = "surplus" if check.check_type == UNIQUENESS else "nulls"
                amounts.append(f"struct({grouped[check.field]} AS profile, {number} AS check_number, '{amount}' AS amount)")
        if scanned:
            frames.append(scan_measures(df, scanned))
    if keys:
        wanted = f"filter(array({', '.join(amounts)}), a -> a.profile = number)"
        profiles = key_profiles(keys).selectExpr("n_rows", "nulls", "surplus", f"explode({wanted}) AS wanted")
        amount = "IF(wanted.amount = 'nulls', nulls, surplus)"
        frames.append(profiles.selectExpr(*_measure("wanted.check_number", amount=amount)))
    return frames


def label_measures(measures: DataFrame, checks: Sequence[Check], clock: Clock) -> DataFrame:
    """Result rows of measure rows; ``check_number`` is the index into ``checks``.

    Identity and result come out of ``inline``, as Catalyst neither moves labels below one, into
    every branch of a union, nor copies them into a filter on the result.
    """
    check = F.get(literal_rows([asdict(c) for c in checks], _CHECK_SCHEMA), F.col("check_number"))
    text = F.col("text")
    has_value = F.col("instant").isNotNull() | F.col("wall").isNotNull() | (text != "")
    hours = [hours_between(F.col("instant"), clock.instant), hours_between(F.col("wall"), clock.wall)]
    if any(c.check_type == FRESHNESS and c.data_type == "string" for c in checks):
        hours.append(iso_age_hours(F.col("iso"), clock))
    amount, kind = F.col("amount"), F.col("check_type")
    outcome = (
        F.when(kind == COMPLETENESS, completeness_outcome(amount))
        .when(kind == UNIQUENESS, uniqueness_outcome(amount))
        .when(
            F.col("data_type").isin(*TEMPORAL_TYPES, "string"),
            freshness_outcome(has_value, text, F.col("hours")),
        )
        .otherwise(not_a_time_outcome(amount, F.col("data_type")))
    )
    details: list[Column] = [F.col("metric"), F.col("n_rows").alias("rows"), clock.wall.cast("string").alias("as_of")]
    result = F.struct(
        "pos", "check_pos", "dataset_name", "table_name", "column_name", "check_type", "result_value", "status",
        severity(F.col("status")).alias("severity"), "metric", F.to_json(F.struct(*details)).alias("metadata"),
    )
    return (
        measures.select("*", F.inline(F.array(check)))
        .select("*", iso_spelling(text).alias("iso"))
        .select("*", F.coalesce(*hours).alias("hours"))
        .select("*", outcome.alias("outcome"))
        .select("*", "outcome.*")
        .select(F.inline(F.array(result)))
    )


def _check_columns(df: DataFrame, kind: str, columns: Sequence[str], clock: Clock, table_name: str) -> DataFrame:
    asked = [Check(i, 0, "", table_name, name, kind, "", "") for i, name in enumerate(columns)]
    screened = [screen(check, df, **name_flags(check.column_name)) for check in asked]
    known = local_rows(df.sparkSession, [s for s in screened if isinstance(s, dict)], RESULT_SCHEMA)
    checks = [s for s in screened if isinstance(s, Check)]
    if not checks:
        return known
    measured = label_measures(reduce(DataFrame.union, measure_frames([(df, list(enumerate(checks)))])), checks, clock)
    return measured.unionByName(known) if len(checks) < len(asked) else measured


def completeness(df: DataFrame, columns: Sequence[str], table_name: str = "") -> DataFrame:
    """Null counts of columns as result rows, from one scan.

    Names and types are screened as in a configured run: columns that aren't checked get the same rows as there.
    """
    return _check_columns(df, COMPLETENESS, columns, Clock(), table_name)


def uniqueness(df: DataFrame, columns: Sequence[str], table_name: str = "") -> DataFrame:
    """Surplus non-null rows of columns as result rows; screened likewise."""
    return _check_columns(df, UNIQUENESS, columns, Clock(), table_name)


def freshness(df: DataFrame, columns: Sequence[str], clock: Clock = Clock(), table_name: str = "") -> DataFrame:
    """Ages of the newest values of columns as result rows, from one scan; screened likewise."""
    return _check_columns(df, FRESHNESS, columns, clock, table_name)
