"""Roll result rows up into report counts and the first findings of each section."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import report_line

# Section titles, header icons and the number of findings shown.
SECTION_TITLES = {"FAIL": "*❌ Critical Failures*", "WARN": "*⚠️ Warnings*"}
HEADER_ICONS = {"FAIL": "🚨", "WARN": "⚠️", "PASS": "✅"}
FINDINGS_PER_SECTION = 10


def report_summary(results: DataFrame) -> DataFrame:
    """One row: counts by severity, the overall severity and the header and closing lines."""
    counts = results.agg(
        F.count_if(F.col("severity") == "FAIL").alias("fails"),
        F.count_if(F.col("severity") == "WARN").alias("warns"),
        F.count_if(F.col("severity") == "PASS").alias("passes"),
    )
    overall = F.when(F.col("fails") > 0, "FAIL").when(F.col("warns") > 0, "WARN").otherwise("PASS")
    icon = F.lit(HEADER_ICONS["PASS"])
    for level in ("WARN", "FAIL"):
        icon = F.when(F.col("overall") == level, HEADER_ICONS[level]).otherwise(icon)
    return (
        counts.withColumn("overall", overall)
        .withColumn("header", F.concat(icon, F.lit(" Data Quality Report")))
        .withColumn(
            "closing",
            F.when(
                F.col("overall") == "PASS", F.format_string("✅ *All %s checks passed successfully.*", F.col("passes"))
            ).otherwise(F.format_string("%s checks passed.", F.col("passes"))),
        )
    )


def top_findings(results: DataFrame, per_section: int = FINDINGS_PER_SECTION) -> DataFrame:
    """The first failures and warnings in result order, with their report lines.

    The rank filter lets Spark cut each section to ``per_section`` rows before the shuffle.
    """
    in_order = Window.partitionBy("severity").orderBy("pos", "check_pos")
    title = F.when(F.col("severity") == "FAIL", SECTION_TITLES["FAIL"]).otherwise(SECTION_TITLES["WARN"])
    return (
        results.where(F.col("severity").isin(*SECTION_TITLES))
        .withColumn("rank", F.row_number().over(in_order))
        .where(F.col("rank") <= per_section)
        .select(
            "severity",
            title.alias("section"),
            "rank",
            report_line(
                F.col("table_name"), F.col("column_name"), F.col("check_type"), F.col("result_value")
            ).alias("line"),
        )
    )
