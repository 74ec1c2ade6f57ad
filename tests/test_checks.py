"""The three checks on small frames: every outcome, type and spelling."""

from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from plumbline.functions.ages import Clock
from plumbline.operators.checks import completeness, freshness, uniqueness
from plumbline.operators.keys import key_profiles

NOW = datetime(2024, 3, 10, 12)


def rows(df):
    return [(r["column_name"], r["result_value"], r["status"], r["severity"], r["metric"])
            for r in df.orderBy("pos").collect()]


def newest(spark, values, schema, clock=Clock(NOW)):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return rows(freshness(df, df.columns, clock))[0][1:]


def test_completeness_counts_only_null(spark):
    df = spark.createDataFrame([(1, "", 0.0), (None, "a", float("nan")), (None, None, 1.0)], "a int, b string, c double")
    assert rows(completeness(df, ["a", "b", "c"])) == [
        ("a", "FAIL (2)", "Failed", "FAIL", 2.0),
        ("b", "FAIL (1)", "Failed", "FAIL", 1.0),
        ("c", "PASS", "✅", "PASS", 0.0),
    ]


def test_nested_columns(spark):
    schema = "id int, s struct<a: int>, l array<int>, m map<string, int>"
    df = spark.createDataFrame([(1, (None,), [], {}), (2, None, [None], None), (3, (1,), None, {"k": 1})], schema)
    assert [r[1] for r in rows(completeness(df, df.columns))] == ["PASS", "FAIL (1)", "FAIL (1)", "FAIL (1)"]
    twice = df.union(df)
    assert [r[1] for r in rows(uniqueness(twice, df.columns))] == ["3 duplicates", "2 duplicates", "2 duplicates", "2 duplicates"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, updated_at timestamp_ntz")
    assert rows(completeness(df, ["id"])) == [("id", "PASS", "✅", "PASS", 0.0)]
    assert rows(uniqueness(df, ["id"])) == [("id", "PASS", "✅", "PASS", 0.0)]
    assert rows(freshness(df, ["updated_at"])) == [("updated_at", "EMPTY", "⚪", "PASS", None)]


def test_uniqueness_counts_surplus_rows_and_ignores_null(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(uniqueness(df, ["k"])) == [("k", "2 duplicates", "Failed", "FAIL", 2.0)]


def key_profile(df, name):
    return key_profiles([(0, df, name)]).drop("number")


def test_uniqueness_of_long_and_short_text(spark):
    texts = [None, "", "a" * 31, "a" * 31, "a" * 32, "a" * 32, "a" * 33, "é" * 15, "é" * 16, "é" * 16, "é" * 5000, "é" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").cast("binary").alias("b"))
    profile = key_profile(df, "t").first()
    expected = sum(n - 1 for t, n in Counter(texts).items() if t is not None)
    assert (profile["n_rows"], profile["nulls"], profile["surplus"]) == (len(texts), 1, expected)
    assert key_profile(df, "b").first() == profile


def test_text_equal_to_the_digest_of_another_stays_apart(spark):
    long_text = "x" * 40
    digest = F.unhex(F.sha2(F.lit(long_text), 256))
    df = spark.range(1).select(F.explode(F.array(F.lit(long_text).cast("binary"), digest)).alias("b"))
    assert key_profile(df, "b").first()["surplus"] == 0


def test_uniqueness_matches_count_distinct(spark):
    df = spark.range(2000).select(
        (F.col("id") % 7).alias("few"), "id", F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("gaps"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("long " * 20), (F.col("id") % 50).cast("string"))).alias("text"),
        (F.col("id") % 9 / 4).alias("number"), F.array(F.col("id") % 11).alias("list"),
    )
    expected = df.agg(*(F.expr(f"count({c}) - count(DISTINCT {c})").alias(c) for c in df.columns)).first()
    found = {r["column_name"]: r["metric"] for r in uniqueness(df, df.columns).collect()}
    assert found == {c: float(expected[c]) for c in df.columns}


def test_collated_text_keeps_its_own_equality(spark):
    df = spark.createDataFrame([("a",), ("A",), ("b",)], "t string").select(F.expr("t COLLATE UTF8_LCASE AS t"))
    assert rows(uniqueness(df, ["t"]))[0][1] == "1 duplicates"


@pytest.mark.parametrize(
    ("age", "expected"),
    [
        (timedelta(hours=1), ("1.0h ago", "✅", "PASS")),
        (timedelta(hours=48), ("48.0h ago", "⚠️ OLD", "WARN")),
        (timedelta(hours=23.96), ("24.0h ago", "✅", "PASS")),
        (timedelta(hours=24), ("24.0h ago", "⚠️ OLD", "WARN")),
        (timedelta(hours=24) - timedelta(microseconds=1), ("24.0h ago", "✅", "PASS")),
        (timedelta(0), ("0.0h ago", "✅", "PASS")),
        (-timedelta(microseconds=1), ("Future: 0.0h", "⚠️", "WARN")),
        (-timedelta(hours=30), ("Future: 30.0h", "⚠️", "WARN")),
        (timedelta(seconds=1260), ("0.3h ago", "✅", "PASS")),
    ],
)
def test_freshness_labels(spark, age, expected):
    assert newest(spark, [NOW - age, NOW - age - timedelta(days=9), None], "t timestamp_ntz")[:3] == expected


def test_freshness_types(spark):
    assert newest(spark, [date(2024, 3, 9), date(2024, 3, 10)], "d date") == ("12.0h ago", "✅", "PASS", 12.0)
    aware = datetime(2024, 3, 10, 11, tzinfo=timezone.utc)
    assert newest(spark, [aware], "t timestamp", Clock(aware + timedelta(hours=3)))[0] == "3.0h ago"
    assert newest(spark, ["2024-03-10T10:00:00Z"], "created_at string")[0] == "2.0h ago"
    assert newest(spark, ["2024-03-10"], "created_at string")[0] == "12.0h ago"
    assert newest(spark, ["20240310T09"], "created_at string")[0] == "3.0h ago"
    assert newest(spark, ["2024-03-10T03+01:00"], "created_at string")[0] == "10.0h ago"


def test_freshness_text_maximum_is_lexicographic(spark):
    values = ["2024-03-10", "Not A Date", "2999-01-01"]
    assert newest(spark, values, "created_at string") == ("Bad fmt: Not A Date...", "⚠️", "WARN", None)
    assert newest(spark, ["2024-02-30"], "created_at string")[0] == "Bad fmt: 2024-02-30..."
    assert newest(spark, ["", None], "created_at string") == ("EMPTY", "⚪", "PASS", None)


def test_freshness_of_a_type_without_time(spark):
    assert newest(spark, [5], "updated_at bigint") == ("Err: bigint is not a time", "❌", "FAIL", None)
    assert newest(spark, [None], "updated_at bigint") == ("EMPTY", "⚪", "PASS", None)
    df = spark.range(1).select(F.create_map(F.lit("k"), F.lit(1)).alias("dates"))
    assert rows(freshness(df, ["dates"]))[0][1] == "Err: map<string,int> is not a time"
    long_type = spark.range(1).select(F.struct(*(F.lit(1).alias(f"field_{i}") for i in range(5))).alias("dates"))
    assert len(rows(freshness(long_type, ["dates"]))[0][1]) == len("Err: ") + 30


def test_many_types_in_one_scan(spark):
    df = spark.createDataFrame(
        [(NOW, NOW.date(), "2024-03-10T11:00", None)], "a timestamp_ntz, b date, created string, updated timestamp"
    )
    found = [r[1] for r in rows(freshness(df, df.columns, Clock(NOW)))]
    assert found == ["0.0h ago", "12.0h ago", "1.0h ago", "EMPTY"]
