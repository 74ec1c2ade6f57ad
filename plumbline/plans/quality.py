"""Run a check configuration: screen, fuse the checks of each table, label and log."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession

from plumbline.functions.ages import Clock
from plumbline.functions.literals import local_rows
from plumbline.operators.checks import RESULT_SCHEMA, Check, error_finding, first_line, label_measures, measure_frames, screen
from plumbline.sources.configs import unpivot_checks
from plumbline.sources.results_log import append_log, new_run_id, stamp_results
from plumbline.sources.tables import Tables, open_tables, reraise_if_stopped, side_by_side


class QualityRun:
    """A configuration resolved against its tables.

    Only the configuration and the schemas are read here. ``findings`` holds the results that are
    known without a scan; ``by_table`` holds the checks that need one.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: DataFrame,
        tables: Tables,
        as_of: datetime | None = None,
        concurrent_tables: int = 8,
    ):
        self.spark = spark
        self.clock = Clock(as_of)
        self.concurrent_tables = concurrent_tables
        self.findings: list[dict] = []
        self.by_table: dict[tuple[str, str], list[Check]] = {}
        wanted = sorted(unpivot_checks(config).collect(), key=lambda r: (r["pos"], r["check_pos"]))
        self.frames = open_tables(spark, tables, dict.fromkeys((r["schema"], r["table"]) for r in wanted), concurrent_tables)
        for row in wanted:
            self._place(row, (row["schema"], row["table"]))

    def _place(self, row: Row, key: tuple[str, str]) -> None:
        check = Check(row["pos"], row["check_pos"], row["schema"], row["table_name"], row["column_name"], row["check_type"], "", "")
        screened = screen(check, self.frames[key], row["valid_name"], row["temporal_name"], row["vetoed_name"])
        if isinstance(screened, Check):
            self.by_table.setdefault(key, []).append(screened)
        else:
            self.findings.append(screened)

    def results(self) -> DataFrame:
        """All results as one lazy DataFrame; meant for tens of tables."""
        known = local_rows(self.spark, self.findings, RESULT_SCHEMA)
        if not self.by_table:
            return known
        checks = [check for group in self.by_table.values() for check in group]
        numbers = {check: number for number, check in enumerate(checks)}
        frames = measure_frames(
            [(self.frames[key], [(numbers[check], check) for check in group]) for key, group in self.by_table.items()]
        )
        measured = label_measures(reduce(DataFrame.union, frames), checks, self.clock)
        return measured.unionByName(known) if self.findings else measured

    def isolated_results(self) -> DataFrame:
        """All results, each table measured by itself and several at a time.

        The checks of a table that fails are halved until those that fail are alone, so that an error costs only the
        checks it belongs to and few scans. One measure row per check passes through the driver.
        """
        checks = [check for group in self.by_table.values() for check in group]
        numbers = {check: number for number, check in enumerate(checks)}

        def measure(key: tuple[str, str], group: list[Check]) -> tuple[list[pa.Table], list[dict]]:
            numbered = [(numbers[check], check) for check in group]
            try:
                return [reduce(DataFrame.union, measure_frames([(self.frames[key], numbered)])).toArrow()], []
            except Exception as error:  # isolation boundary
                reraise_if_stopped(self.spark, error)
                if len(group) == 1:
                    return [], [error_finding(group[0], first_line(error))]
            half = len(group) // 2
            (a, x), (b, y) = measure(key, group[:half]), measure(key, group[half:])
            return a + b, x + y

        done = side_by_side(self.spark, lambda key: measure(key, self.by_table[key]), self.by_table, self.concurrent_tables).values()
        measured = [table for tables, _ in done for table in tables]
        findings = self.findings + [error for _, errors in done for error in errors]
        known = local_rows(self.spark, findings, RESULT_SCHEMA)
        if not measured:
            return known
        measures = self.spark.createDataFrame(pa.concat_tables(measured, promote_options="default"))
        return label_measures(measures, checks, self.clock).unionByName(known)


def run_checks(spark: SparkSession, config: DataFrame, tables: Tables, as_of: datetime | None = None) -> DataFrame:
    return QualityRun(spark, config, tables, as_of).results()


def run_and_log(
    spark: SparkSession,
    config: DataFrame,
    tables: Tables,
    path: str | None = None,
    table: str | None = None,
    as_of: datetime | None = None,
    concurrent_tables: int = 8,
    run_id: str | None = None,
) -> str | None:
    """Run every check, append the results in one write and return the run id; no results, no write.

    A scheduler that may repeat a run gives it a ``run_id``: the log then holds the results of the last try alone.
    """
    as_of = as_of or datetime.now(timezone.utc)
    run = QualityRun(spark, config, tables, as_of, concurrent_tables)
    if not run.findings and not run.by_table:
        return None
    fresh, run_id = not run_id, run_id or new_run_id()
    append_log(stamp_results(run.isolated_results(), run_id, Clock(datetime.now(timezone.utc))), path, table, run_id, fresh)
    return run_id
