"""Turn measured numbers into result text, status and severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses as stored in results and logs.
OK = "✅"
WARNING = "⚠️"
OLD = "⚠️ OLD"
FAILED = "Failed"
ERROR = "❌"
NO_VALUE = "⚪"

BAD_NAME = "Skipped (Bad Name)"
NOT_TEMPORAL = "Skipped (Not Temporal)"
SQL_ERROR = "SQL Error"

MAX_AGE_HOURS = 24
ERROR_TEXT_LENGTH = 30
BAD_FORMAT_LENGTH = 10


def outcome(value: Column, status: Column, metric: Column | None = None) -> Column:
    return F.struct(
        value.alias("result_value"),
        status.alias("status"),
        (F.lit(None) if metric is None else metric).cast("double").alias("metric"),
    )


def completeness_outcome(nulls: Column) -> Column:
    failed = F.concat(F.lit("FAIL ("), nulls.cast("string"), F.lit(")"))
    return outcome(
        F.when(nulls == 0, F.lit("PASS")).otherwise(failed),
        F.when(nulls == 0, F.lit(OK)).otherwise(F.lit(FAILED)),
        nulls,
    )


def uniqueness_outcome(surplus: Column) -> Column:
    failed = F.concat(surplus.cast("string"), F.lit(" duplicates"))
    return outcome(
        F.when(surplus == 0, F.lit("PASS")).otherwise(failed),
        F.when(surplus == 0, F.lit(OK)).otherwise(F.lit(FAILED)),
        surplus,
    )


def one_decimal(hours: Column) -> Column:
    """Half-even on the exact binary value; printf-style formatting rounds ties differently."""
    return F.call_function("format_number", hours, F.lit("0.0"))


def freshness_outcome(has_value: Column, text: Column, hours: Column) -> Column:
    """``hours`` is the age of the newest value, null when its ``text`` could not be read as a time."""
    bad_format = F.concat(F.lit("Bad fmt: "), F.substring(text, 1, BAD_FORMAT_LENGTH), F.lit("..."))
    empty = ~F.coalesce(has_value, F.lit(False))
    value = (
        F.when(empty, F.lit("EMPTY"))
        .when(hours.isNull(), bad_format)
        .when(hours < 0, F.concat(F.lit("Future: "), one_decimal(F.abs(hours)), F.lit("h")))
        .otherwise(F.concat(one_decimal(hours), F.lit("h ago")))
    )
    status = (
        F.when(empty, F.lit(NO_VALUE))
        .when(hours.isNull() | (hours < 0), F.lit(WARNING))
        .when(hours < MAX_AGE_HOURS, F.lit(OK))
        .otherwise(F.lit(OLD))
    )
    return outcome(value, status, hours)


def not_a_time_outcome(non_null: Column, data_type: Column) -> Column:
    """A column that passes the gate by name but holds a type without a point in time."""
    reason = F.substring(F.concat(data_type, F.lit(" is not a time")), 1, ERROR_TEXT_LENGTH)
    return outcome(
        F.when(non_null == 0, F.lit("EMPTY")).otherwise(F.concat(F.lit("Err: "), reason)),
        F.when(non_null == 0, F.lit(NO_VALUE)).otherwise(F.lit(ERROR)),
    )


def severity(status: Column) -> Column:
    return (
        F.when(F.upper(status).contains("FAIL") | status.contains(ERROR), F.lit("FAIL"))
        .when(status.contains("OLD") | status.contains(WARNING), F.lit("WARN"))
        .otherwise(F.lit("PASS"))
    )
