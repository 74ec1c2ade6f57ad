"""Physical plans: shared scans, pruned columns, early aggregation and no hidden products."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.functions.ages import Clock
from plumbline.operators.checks import completeness, uniqueness
from plumbline.operators.coverage import catalog_objects, coverage, undocumented
from plumbline.operators.merge import join_tables, merge_descriptions
from plumbline.operators.report import top_findings
from plumbline.plans.documentation import refresh_documentation
from plumbline.plans.quality import run_checks
from plumbline.sources.configs import config_from_entries
from plumbline.sources.descriptions import entry_pos
from plumbline.sources.tables import parquet_tables


@pytest.fixture
def lake(spark, tmp_path):
    df = spark.range(100).select(
        "id", (F.col("id") % 7).alias("k"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"),
        F.current_date().alias("day"), F.col("id").cast("string").alias("unused"),
    )
    df.write.parquet(str(tmp_path / "t"))
    df.withColumn("nested", F.array("id")).write.parquet(str(tmp_path / "n"))
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [sorted(f.split(":")[0] for f in schema.split(",")) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_checks_of_a_table_share_one_pruned_scan(spark, lake):
    entries = [
        {"table": "s.t", "freshness_col": "ts", "completeness_col": "id"},
        {"table": "s.t", "freshness_col": "day", "completeness_col": "k"},
        {"table": "s.t", "completeness_col": "ts"},
    ]
    text = plan(run_checks(spark, config_from_entries(spark, entries), parquet_tables(spark, f"{lake}/{{table}}")))
    assert scans(text) == [["day", "id", "k", "ts"]]
    assert "partial_count" in text and "partial_max" in text and "Expand" not in text


def test_a_column_is_read_once(spark, lake):
    """Grouping a column for uniqueness counts its nulls too."""
    entries = [{"table": "s.t", "uniqueness_col": c, "completeness_col": "id"} for c in ("id", "k", "id")]
    results = run_checks(spark, config_from_entries(spark, entries), parquet_tables(spark, f"{lake}/{{table}}"))
    text = plan(results)
    assert sorted(scans(text)) == [["id"], ["k"]]
    assert text.count("functions=[partial_count(1)]") == 2 and "Expand" not in text
    assert sorted((r["check_type"], r["column_name"], r["result_value"]) for r in results.collect()) == [
        ("Completeness", "id", "PASS"), ("Completeness", "id", "PASS"), ("Completeness", "id", "PASS"),
        ("Uniqueness", "id", "PASS"), ("Uniqueness", "id", "PASS"), ("Uniqueness", "k", "93 duplicates"),
    ]


def test_arrays_are_shuffled_as_digests(spark, lake):
    text = plan(uniqueness(spark.read.parquet(f"{lake}/n"), ["nested"]))
    assert "sha2" in text and not re.search(r"hashpartitioning\(nested", text)


def test_footers_answer_counts_where_the_session_allows(spark, lake):
    settings = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        flat = spark.read.parquet(f"{lake}/t")
        pushed = completeness(flat, ["id", "unused"])
        assert re.search(r"PushedAggregation: \[COUNT\(\*\), COUNT\(id\), COUNT\(unused\)\]", plan(pushed))
        assert [r["result_value"] for r in pushed.collect()] == ["PASS", "PASS"]
        nested = completeness(spark.read.parquet(f"{lake}/n"), ["id", "nested"])
        assert "PushedAggregation: []" in plan(nested)
        assert [r["result_value"] for r in nested.collect()] == ["PASS", "PASS"]
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_text_is_shuffled_as_a_digest(spark, lake):
    text = plan(uniqueness(spark.read.parquet(f"{lake}/t"), ["unused"]))
    assert re.search(r"Project \[if \(\(octet_length\(unused#\d+\) < 32\)\).*sha2", text)
    assert not re.search(r"hashpartitioning\(unused", text)


def test_report_sections_are_cut_before_the_shuffle(spark):
    results = spark.range(1000).select(
        F.col("id").alias("pos"), F.lit(0).alias("check_pos"), F.lit("t").alias("table_name"), F.lit("c").alias("column_name"),
        F.lit("Completeness").alias("check_type"), F.lit("FAIL (1)").alias("result_value"),
        F.when(F.col("id") % 2 == 0, "FAIL").otherwise("WARN").alias("severity"),
    )
    text = plan(top_findings(results))
    assert text.index("WindowGroupLimit") < text.index("hashpartitioning(severity") < text.rindex("WindowGroupLimit")
    assert "Partial" in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metadata_joins_are_keyed(spark, no_broadcast):
    catalog = spark.range(50).select(
        F.lit("s").alias("schema"), (F.col("id") % 3).cast("string").alias("table"), F.col("id").cast("string").alias("column"),
        F.col("id").alias("ordinal"), F.lit("int").alias("data_type"), F.lit("text").alias("description"),
        F.lit(0).alias("table_pos"), entry_pos(F.lit(0), F.col("id")),
    )
    objects = catalog_objects(catalog)
    for df in (
        coverage(objects, catalog), undocumented(objects, catalog), refresh_documentation(catalog, catalog, catalog),
    ):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text


def test_merging_starts_no_job_and_gives_no_hint(spark):
    rows = spark.range(50).select(
        F.lit("s").alias("schema"), (F.col("id") % 3).cast("string").alias("table"), F.col("id").cast("string").alias("column")
    )
    group = "merging"
    spark.sparkContext.setJobGroup(group, group)
    try:
        merged = merge_descriptions(rows, rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    assert "ResolvedHint" not in merged._jdf.queryExecution().analyzed().toString()
    assert "LeftAnti" in plan(merged) and "hashpartitioning(column" not in plan(merged)


@pytest.fixture
def parts_as_dealt(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def _wide(spark, n, schema="s", table="wide"):
    nothing = F.substring(F.col("id").cast("string"), 1, 0)  # so that the planner doesn't know the names
    return spark.range(0, n, 1, 40).select(
        F.concat(F.lit(schema), nothing).alias("schema"), F.concat(F.lit(table), nothing).alias("table"), F.col("id").cast("string").alias("column"), F.col("id").alias("ordinal"),
        F.lit("text").alias("description"), F.lit("int").alias("data_type"), F.lit(0).alias("table_pos"), entry_pos(F.lit(0), F.lit(0)),
    )


def _most_in_a_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_no_task_merges_a_large_table_alone(spark, parts_as_dealt):
    rows, other = _wide(spark, 60000), _wide(spark, 2, table="other")
    merged = merge_descriptions(rows, other)
    assert merged.count() == 60002 and _most_in_a_task(merged) < 40000
    same = rows.select(*[F.lit(1).cast(t).alias(c) if c == "ordinal" else F.lit("x").alias(c) if c == "column" else c for c, t in rows.dtypes])
    merged = merge_descriptions(same, other)  # rows that are equal in all
    assert merged.count() == 60002 and _most_in_a_task(merged) < 40000
    unnamed = rows.withColumn("table", F.lit(None).cast("string"))
    merged = merge_descriptions(unnamed, other)
    assert merged.count() == 60002 and _most_in_a_task(merged) < 40000
    by_schema = _wide(spark, 60000).withColumn("schema", F.col("column"))  # many small tables of one name
    merged = merge_descriptions(by_schema, _wide(spark, 2, schema="t"))
    assert merged.count() == 60002 and _most_in_a_task(merged) < 40000


def test_no_task_places_a_large_table_alone(spark, parts_as_dealt):
    wide, places = _wide(spark, 60000), _wide(spark, 1).select("schema", "table", F.lit(7).alias("place"))
    placed = join_tables(wide, places, "inner")
    assert placed.count() == 60000 and _most_in_a_task(placed) < 40000
    assert placed.columns == [*wide.columns, "place"] and placed.where("place = 7").count() == 60000
    assert refresh_documentation(wide, wide.limit(10), wide.limit(0)).count() == 60001


@pytest.mark.parametrize("how", ["inner", "left_anti"])
def test_dealt_tables_join_as_others(spark, how):
    rows = spark.createDataFrame(
        [(s, t, i % 3, {"a": i}) for i, (s, t) in enumerate([("s", "a")] * 9 + [("t", "a")] * 2 + [("s", "b")] * 7 + [(None, "a"), ("s", None), (None, None)] * 2)],
        "schema string, table string, spot int, more map<string, int>",
    )
    tables = spark.createDataFrame([("s", "a", 1), ("s", "c", 2), ("t", "a", 3), (None, "a", 4), ("s", None, 5)], "schema string, table string, place int")
    expected = rows.join(tables, ["schema", "table"], how)
    for large_rows, large_tables in ((1, 10), (2, 1), (100, 10)):
        found = join_tables(rows, tables, how, large_rows, large_tables)
        assert found.columns == expected.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_coverage_moves_no_text(spark, no_broadcast):
    rows = spark.range(50).select(
        F.lit("s").alias("schema"), F.lit("t").alias("table"), F.col("id").cast("string").alias("column"),
        F.col("id").alias("ordinal"), F.lit("int").alias("data_type"), F.uuid().alias("description"),
    )
    for df in (coverage(catalog_objects(rows), rows), undocumented(catalog_objects(rows), rows)):
        shuffled = re.findall(r"Exchange hashpartitioning.*\n.*?(?:Project \[|HashAggregate\(keys=\[)([^\]]*)\]", plan(df))
        assert shuffled and not any("description" in columns for columns in shuffled)


def test_clock_is_one_moment_per_query(spark):
    row = spark.range(0, 4, 1, 4).select(Clock().instant.alias("t")).distinct().count()
    assert row == 1
