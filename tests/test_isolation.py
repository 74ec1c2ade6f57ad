"""An error costs what it belongs to; a cancelled run is no result."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import suggest
from plumbline.operators.checks import completeness, freshness, uniqueness
from plumbline.operators.suggest import candidate_evidence
from plumbline.plans import quality
from plumbline.plans.config import generate_checks
from plumbline.plans.quality import QualityRun, run_and_log, run_checks
from plumbline.sources.catalog import catalog_of, session_tables
from plumbline.sources.configs import config_from_entries
from plumbline.sources.tables import catalog_tables, frames, parquet_tables


@pytest.fixture
def lake(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "good"))
    (tmp_path / "corrupt").mkdir()
    (tmp_path / "corrupt" / "part-0.parquet").write_bytes(b"no parquet at all")
    return str(tmp_path)


CONFIG = [
    {"table": "s.corrupt", "freshness_col": "loaded_at", "completeness_col": "id", "uniqueness_col": "id"},
    {"table": "s.good", "completeness_col": "id", "uniqueness_col": "id"},
    {"table": "s.missing", "freshness_col": "loaded_at"},
]


def test_corrupt_folder(spark, lake, tmp_path):
    config, tables = config_from_entries(spark, CONFIG), parquet_tables(spark, f"{lake}/{{table}}")
    rows = run_checks(spark, config, tables).orderBy("pos", "check_pos").collect()
    assert [r["severity"] for r in rows] == ["FAIL"] * 3 + ["PASS"] * 2 + ["FAIL"]
    assert rows[0]["result_value"].startswith("Err: ") and rows[1]["result_value"] == rows[2]["result_value"] == "SQL Error"
    assert "missing" not in rows[0]["metadata"] and "missing table s.missing" in rows[5]["metadata"]
    run_id = run_and_log(spark, config, tables, path=str(tmp_path / "log"))
    logged = spark.read.parquet(str(tmp_path / "log"))
    assert {r["run_id"] for r in logged.collect()} == {run_id} and logged.count() == 6


def test_broken_view(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS broken")
    try:
        spark.range(3).write.mode("overwrite").saveAsTable("broken.base")
        spark.range(3).write.mode("overwrite").saveAsTable("broken.good")
        spark.sql("CREATE VIEW broken.hollow AS SELECT * FROM broken.base")
        spark.sql("DROP TABLE broken.base")
        tables = session_tables(spark, "broken")
        assert list(tables) == [("broken", "good")]
        assert [r["table"] for r in generate_checks(spark, tables).collect()] == ["broken.good"]
        config = config_from_entries(spark, [{"table": f"broken.{t}", "completeness_col": "id"} for t in ("hollow", "good")])
        rows = run_checks(spark, config, catalog_tables(spark)).orderBy("pos").collect()
        assert [r["result_value"] for r in rows] == ["SQL Error", "PASS"] and "reason" in rows[0]["metadata"]
    finally:
        spark.sql("DROP DATABASE broken CASCADE")


def test_columns_that_can_not_be_checked(spark):
    twins = spark.range(4).select("id", F.col("id").alias("ID"), F.lit(1).alias("k"))
    typed = spark.range(4).select(F.expr("parse_json(string(id)) AS payload_id"), "id")
    tables = frames({"twins": twins, "typed": typed})
    entries = [{"table": "twins", "completeness_col": c, "uniqueness_col": c} for c in ("id", "k")]
    entries.append({"table": "typed", "completeness_col": "payload_id", "uniqueness_col": "payload_id"})
    rows = run_checks(spark, config_from_entries(spark, entries), tables).orderBy("pos", "check_pos").collect()
    assert [r["result_value"] for r in rows] == ["SQL Error", "SQL Error", "PASS", "3 duplicates", "PASS", "PASS"]
    assert "AMBIGUOUS" in rows[0]["metadata"]
    by_key = {("s", "twins"): twins, ("s", "typed"): typed}
    evidence = candidate_evidence(catalog_of(spark, by_key), by_key)
    assert [(r["table"], r["column"], r["usable"]) for r in evidence.collect()] == [("typed", "payload_id", True), ("typed", "id", True)]
    found = {r["table"]: r["completeness_col"] for r in generate_checks(spark, by_key).collect()}
    assert found == {"s.twins": "id", "s.typed": "payload_id"}


def test_evidence_of_a_failing_table(spark):
    bad = spark.range(3).select(F.expr("IF(id = 2, raise_error('disk on fire'), id) AS order_id"), F.col("id").alias("row_id"))
    by_key = {("s", "bad"): bad.select(F.col("order_id").cast("long").alias("order_id"), "row_id"), ("s", "good"): spark.range(3)}
    rows = candidate_evidence(catalog_of(spark, by_key), by_key).collect()
    assert [(r["table"], r["column"], r["usable"], r["n_rows"]) for r in rows] == [
        ("bad", "order_id", False, None), ("bad", "row_id", True, 3), ("good", "id", True, 3),
    ]
    assert "disk on fire" in rows[0]["reason"] and rows[2]["reason"] is None
    found = {r["table"]: r["completeness_col"] for r in generate_checks(spark, by_key).collect()}
    assert found == {"s.bad": "row_id", "s.good": "id"}


def test_only_columns_that_can_be_keys_are_grouped(spark, monkeypatch):
    grouped = []
    plain = suggest.key_profiles
    monkeypatch.setattr(suggest, "key_profiles", lambda keys: grouped.extend(k[2] for k in keys) or plain(keys))
    df = spark.range(100).select(
        (F.col("id") % 7).alias("user_id"), F.expr("nullif(id, 3) AS half_id"), F.col("id").alias("row_id"),
        F.lit("x").alias("text_id"), F.expr("IF(id = 9, 8, id) AS near_id"), F.lit(None).cast("int").alias("no_id"),
    )
    by_key = {("s", "t"): df}
    rows = generate_checks(spark, by_key).collect()
    assert [r["completeness_col"] for r in rows] == ["row_id"] and grouped == ["row_id"]  # a sketch rules text_id out, near_id comes after a key
    exact = {r["column"]: r["surplus"] for r in candidate_evidence(catalog_of(spark, by_key), by_key).collect()}
    assert exact == {"user_id": 93, "half_id": 0, "row_id": 0, "text_id": 99, "near_id": 1, "no_id": 0}


def test_failing_checks_are_found_by_halving(spark):
    fails = F.expr("IF(id = 2, raise_error('disk on fire'), 'x')").cast("string")
    df = spark.range(3).select("id", *[F.lit(i).alias(f"c{i}") for i in range(15)], fails.alias("bad"))
    config = config_from_entries(spark, [{"table": "t", "completeness_col": c} for c in df.columns])
    run = QualityRun(spark, config, frames({"t": df}), concurrent_tables=1)
    measured = []
    plain = quality.measure_frames
    quality.measure_frames = lambda tables: measured.append(len(tables[0][1])) or plain(tables)
    try:
        rows = run.isolated_results().collect()
    finally:
        quality.measure_frames = plain
    assert [r["column_name"] for r in rows if r["severity"] != "PASS"] == ["bad"] and len(rows) == 17
    assert len(measured) <= 11  # 1 + 2 for each halving, not one for each check


def test_a_cancelled_run_is_no_result(spark, monkeypatch):
    config = config_from_entries(spark, [{"table": "t", "completeness_col": "id"}])
    run = QualityRun(spark, config, frames({"t": spark.range(3)}))

    def cancelled(*_):
        raise RuntimeError("[SPARK_JOB_CANCELLED] Job 7 cancelled by the user")

    monkeypatch.setattr("plumbline.plans.quality.measure_frames", cancelled)
    with pytest.raises(RuntimeError, match="cancelled"):
        run.isolated_results()

    def tables(schema, table):
        raise RuntimeError("Job 3 cancelled part of cancelled job group g")

    with pytest.raises(RuntimeError, match="cancelled"):
        QualityRun(spark, config, tables)


def test_direct_checks_are_screened_like_a_run(spark):
    df = spark.createDataFrame([(1, 2, "x", 5)], "id long, status_at long, `a b` string, loaded long")
    columns = ["id", "status_at", "a b", "a`b", "gone", "loaded"]
    for check, field in ((freshness, "freshness_col"), (completeness, "completeness_col"), (uniqueness, "uniqueness_col")):
        direct = check(df, columns).orderBy("pos").collect()
        config = config_from_entries(spark, [{"table": "t", field: c} for c in columns])
        run = run_checks(spark, config, frames({"t": df})).orderBy("pos").collect()
        names = ["column_name", "check_type", "result_value", "status", "severity", "metric"]
        assert [[r[n] for n in names] for r in direct] == [[r[n] for n in names] for r in run]
        assert direct[2]["result_value"] == "Skipped (Bad Name)"
        assert check(df, []).collect() == []
    assert freshness(df, ["status_at", "id"]).collect()[0]["result_value"] == "Skipped (Not Temporal)"
