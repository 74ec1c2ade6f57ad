"""Whole runs: configuration, screening, isolation of failures, log and report."""

import json
import math
import re
import shutil
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.operators.report import report_summary, top_findings
from plumbline.plans.quality import QualityRun, run_and_log, run_checks
from plumbline.sources.configs import (
    append_config,
    config_from_entries,
    read_config,
    read_yaml_config,
    unpivot_checks,
    write_config,
)
from plumbline.sources.tables import catalog_tables, frames, parquet_tables, quoted_name

NOW = datetime(2024, 3, 10, 12)
SHORT = ["table_name", "column_name", "check_type", "result_value", "status", "severity"]


@pytest.fixture
def tables(spark):
    events = spark.createDataFrame(
        [(1, NOW, "a", 7), (2, None, None, 7)], "id int, loaded timestamp_ntz, Name string, status_at int"
    )
    return {"web.events": events, "users": spark.range(3)}


def found(df, *columns):
    return [tuple(r) for r in df.orderBy("pos", "check_pos").select(*(columns or SHORT)).collect()]


def test_entries_unpivot_in_file_order(spark):
    config = config_from_entries(
        spark,
        [
            {"table": "a.b.c", "completeness_col": "x", "freshness_col": "y", "uniqueness_col": "z"},
            {"table": "t"},
            {"table": "t", "completeness_col": "x"},
        ],
    )
    columns = ["pos", "check_pos", "schema", "table", "check_type", "column_name"]
    assert found(unpivot_checks(config), *columns) == [
        (0, 0, "a", "b.c", "Freshness", "y"),
        (0, 1, "a", "b.c", "Completeness", "x"),
        (0, 2, "a", "b.c", "Uniqueness", "z"),
        (2, 1, "a", "t", "Completeness", "x"),
    ]
    plain = config_from_entries(spark, [{"table": "t", "completeness_col": "x"}, {"table": "s.t", "completeness_col": "x"}])
    assert found(unpivot_checks(plain), "schema") == [("public",), ("s",)]


def test_run_in_config_order_with_every_kind_of_row(spark, tables):
    config = config_from_entries(
        spark,
        [
            {"table": "web.events", "freshness_col": "LOADED", "completeness_col": "name", "uniqueness_col": "status_at"},
            {"table": "users", "completeness_col": "id", "freshness_col": "id"},
            {"table": "web.gone", "freshness_col": "created_at", "completeness_col": "id", "uniqueness_col": "id"},
            {"table": "web.events", "freshness_col": "status_at", "completeness_col": "a-b", "uniqueness_col": "lost"},
            {"table": "web.events", "freshness_col": "modified_date_of_the_record"},
        ],
    )
    assert found(run_checks(spark, config, frames(tables), NOW)) == [
        ("web.events", "LOADED", "Freshness", "0.0h ago", "✅", "PASS"),
        ("web.events", "name", "Completeness", "FAIL (1)", "Failed", "FAIL"),
        ("web.events", "status_at", "Uniqueness", "1 duplicates", "Failed", "FAIL"),
        ("users", "id", "Freshness", "Skipped (Not Temporal)", "⚠️", "WARN"),
        ("users", "id", "Completeness", "PASS", "✅", "PASS"),
        ("web.gone", "created_at", "Freshness", "Err: missing table web.gone", "❌", "FAIL"),
        ("web.gone", "id", "Completeness", "SQL Error", "Failed", "FAIL"),
        ("web.gone", "id", "Uniqueness", "SQL Error", "Failed", "FAIL"),
        ("web.events", "status_at", "Freshness", "Skipped (Not Temporal)", "⚠️", "WARN"),
        ("web.events", "a-b", "Completeness", "Skipped (Bad Name)", "⚠️", "WARN"),
        ("web.events", "lost", "Uniqueness", "SQL Error", "Failed", "FAIL"),
        ("web.events", "modified_date_of_the_record", "Freshness", "Err: missing column modified_date_o", "❌", "FAIL"),
    ]


def test_dataset_and_metadata(spark, tables):
    config = config_from_entries(
        spark, [{"table": "web.events", "completeness_col": "Name"}, {"table": "s.none", "completeness_col": "x"}]
    )
    first, second = found(run_checks(spark, config, frames(tables), NOW), "dataset_name", "metadata")
    assert first[0] == "web" and json.loads(first[1]) == {"metric": 1.0, "rows": 2, "as_of": "2024-03-10 12:00:00"}
    assert second[0] == "s" and json.loads(second[1]) == {"reason": "missing table s.none"}


def test_column_case_follows_the_session(spark, tables):
    config = config_from_entries(spark, [{"table": "web.events", "completeness_col": "name"}])
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert found(run_checks(spark, config, frames(tables), NOW), "result_value") == [("SQL Error",)]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_empty_configuration(spark, tables):
    config = config_from_entries(spark, [])
    assert run_checks(spark, config, frames(tables)).collect() == []
    assert QualityRun(spark, config, frames(tables)).isolated_results().collect() == []


def test_no_checks_write_no_log(spark, tables, tmp_path):
    config = config_from_entries(spark, [{"table": "users"}])
    assert run_and_log(spark, config, frames(tables), path=str(tmp_path / "log")) is None
    assert not (tmp_path / "log").exists()


def test_isolated_results_equal_the_lazy_ones(spark, tables):
    config = config_from_entries(
        spark,
        [
            {"table": "web.events", "freshness_col": "loaded", "completeness_col": "Name", "uniqueness_col": "id"},
            {"table": "users", "completeness_col": "id"},
            {"table": "gone", "completeness_col": "id"},
        ],
    )
    run = QualityRun(spark, config, frames(tables), NOW)
    assert found(run.isolated_results(), "*") == found(run.results(), "*")


def test_a_failing_column_costs_only_its_checks(spark, tables):
    fails = F.expr("CASE WHEN id = 2 THEN CAST(raise_error('disk on fire') AS STRING) ELSE 'x' END")
    tables["web.events"] = tables["web.events"].withColumn("broken_at", fails)
    config = config_from_entries(
        spark,
        [
            {"table": "web.events", "freshness_col": "broken_at", "completeness_col": "id", "uniqueness_col": "broken_at"},
            {"table": "users", "completeness_col": "id"},
        ],
    )
    rows = found(QualityRun(spark, config, frames(tables), NOW).isolated_results(), *SHORT, "metadata")
    assert rows[0][3].startswith("Err: ") and len(rows[0][3]) <= 35 and rows[0][5] == "FAIL"
    assert "disk on fire" in rows[0][6]
    assert [r[3:6] for r in rows[1:]] == [("PASS", "✅", "PASS"), ("SQL Error", "Failed", "FAIL"), ("PASS", "✅", "PASS")]


def test_files_lost_after_opening(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "lost"))
    spark.range(5).write.parquet(str(tmp_path / "kept"))
    config = config_from_entries(spark, [{"table": t, "completeness_col": "id"} for t in ("lost", "kept")])
    run = QualityRun(spark, config, parquet_tables(spark, f"{tmp_path}/{{table}}"), NOW)
    shutil.rmtree(tmp_path / "lost")
    assert found(run.isolated_results(), "result_value") == [("SQL Error",), ("PASS",)]


def test_log_appends_runs(spark, tables, tmp_path):
    config = config_from_entries(spark, [{"table": "`web`.events", "completeness_col": "id"},
                                         {"table": "users", "freshness_col": "id"}])
    path = str(tmp_path / "log")
    by_name = {"`web`.events": tables["web.events"], "users": tables["users"]}
    ids = [run_and_log(spark, config, frames(by_name), path=path, as_of=NOW) for _ in range(2)]
    log = spark.read.parquet(path)
    assert log.columns[:9] == ["run_id", "run_at", "dataset_name", "table_name", "column_name", "check_type",
                               "status", "result_value", "metadata"]
    assert {r["run_id"] for r in log.collect()} == set(ids) and all(uuid.UUID(i) for i in ids)
    assert log.groupBy("run_id").agg(F.count("*").alias("n"), F.count_distinct("run_at").alias("t")).where(
        "n = 2 AND t = 1").count() == 2
    assert {r["dataset_name"] for r in log.collect()} == {"web"}
    assert len(list((tmp_path / "log").glob("*.parquet"))) == 2


def test_log_to_a_catalog_table(spark, tables):
    config = config_from_entries(spark, [{"table": "users", "completeness_col": "id"}])
    for _ in range(2):
        run_and_log(spark, config, frames(tables), table="data_quality_logs", as_of=NOW)
    assert spark.table("data_quality_logs").count() == 2
    spark.sql("DROP TABLE data_quality_logs")


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(2).write.mode("overwrite").saveAsTable("shop.carts")
    config = config_from_entries(spark, [{"table": "shop.carts", "uniqueness_col": "id"},
                                         {"table": "carts", "completeness_col": "id"},
                                         {"table": "other.carts", "completeness_col": "id"}])
    values = found(run_checks(spark, config, catalog_tables(spark)), "result_value")
    assert values == [("PASS",), ("PASS",), ("SQL Error",)]
    spark.sql("DROP DATABASE shop CASCADE")


def test_quoted_names():
    assert quoted_name(None, "mytable") == "`mytable`"
    assert quoted_name("my-project.dataset", "table") == "`my-project`.`dataset`.`table`"
    assert quoted_name("dataset", "table") == "`dataset`.`table`"


def test_append_keeps_order_and_duplicates(spark, tmp_path):
    existing = config_from_entries(spark, [{"table": "a.t", "freshness_col": "x"}, {"table": "a.t", "completeness_col": "y"}])
    generated = config_from_entries(spark, [{"table": "a.t", "freshness_col": "x"}, {"table": "b.t"}])
    write_config(append_config(existing, generated.drop("uniqueness_col")), str(tmp_path / "checks"))
    rows = [tuple(r)[:3] for r in read_config(spark, str(tmp_path / "checks")).orderBy("pos").collect()]
    assert rows == [(0, "a.t", "x"), (1, "a.t", None), (2, "a.t", "x"), (3, "b.t", None)]
    none = config_from_entries(spark, [])
    assert [r["pos"] for r in append_config(none, generated).orderBy("pos").collect()] == [0, 1]


def test_yaml_configuration(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "checks.yml").write_text(
        "version: 1.0\nchecks:\n- table: a.t\n  freshness_col: x\n- table: a.u\n  completeness_col: y\n"
    )
    rows = read_yaml_config(spark, str(tmp_path / "checks.yml")).orderBy("pos").collect()
    assert [(r["table"], r["freshness_col"], r["completeness_col"]) for r in rows] == [("a.t", "x", None), ("a.u", None, "y")]
    (tmp_path / "empty.yml").write_text("")
    assert read_yaml_config(spark, str(tmp_path / "empty.yml")).collect() == []


def results_frame(spark, severities):
    rows = [(i, 0, f"s.t{i}", "c", "Completeness", f"FAIL ({i})", s) for i, s in enumerate(severities)]
    return spark.createDataFrame(
        rows, "pos long, check_pos int, table_name string, column_name string, check_type string, "
        "result_value string, severity string"
    )


@pytest.mark.parametrize(
    ("severities", "expected"),
    [
        ("PPP", (0, 0, 3, "PASS", "✅ Data Quality Report", "✅ *All 3 checks passed successfully.*")),
        ("PWP", (0, 1, 2, "WARN", "⚠️ Data Quality Report", "2 checks passed.")),
        ("PWF", (1, 1, 1, "FAIL", "🚨 Data Quality Report", "1 checks passed.")),
        ("", (0, 0, 0, "PASS", "✅ Data Quality Report", "✅ *All 0 checks passed successfully.*")),
    ],
)
def test_report_summary(spark, severities, expected):
    level = {"P": "PASS", "W": "WARN", "F": "FAIL"}
    assert tuple(report_summary(results_frame(spark, [level[s] for s in severities])).first()) == expected


def test_top_findings_take_the_first_ten_of_each_section(spark):
    results = results_frame(spark, ["FAIL", "WARN", "PASS"] * 13)
    rows = top_findings(results.repartition(5)).orderBy("severity", "rank").collect()
    assert [r["rank"] for r in rows] == [*range(1, 11)] * 2
    assert {r["section"] for r in rows} == {"*❌ Critical Failures*", "*⚠️ Warnings*"}
    first = [int(re.search(r"\*t(\d+)\*", r["line"]).group(1)) for r in rows]
    assert first == [*range(0, 30, 3), *range(1, 30, 3)]


def test_hours_are_kept_as_a_metric(spark, tables):
    config = config_from_entries(spark, [{"table": "web.events", "freshness_col": "loaded"}])
    (metric,), = found(run_checks(spark, config, frames(tables), datetime(2024, 3, 10, 12, 20)), "metric")
    assert math.isclose(metric, 1 / 3)
