"""Scalar expressions against hand-written values and Python's own formatting and parsing."""

import itertools
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from plumbline.functions.ages import Clock, hours_between, iso_age_hours, iso_spelling
from plumbline.functions.literals import local_rows
from plumbline.functions.names import (
    is_excluded,
    is_pushable,
    is_valid_name,
    last_segment,
    passes_freshness_gate,
    schema_part,
    split_patterns,
    suggests_completeness,
    suggests_freshness,
    table_part,
)
from plumbline.functions.outcomes import one_decimal, severity
from plumbline.functions.text import clean_description, description_prompt, report_line, strip_backticks


def evaluate(spark, values, expression, schema="v string"):
    """{value: result} of an expression over the column ``v``."""
    rows = local_rows(spark, [{"v": v} for v in values], schema).select("v", expression(F.col("v")).alias("r"))
    return {r["v"]: r["r"] for r in rows.collect()}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("\n    # Description\n    This is the description.\n    ", "This is the description."),
        ("**Column:** id", "id"),
        ("**Info** Some value", "Some value"),
        ("Clean text", "Clean text"),
        ("Description:  one\nDescription: two", "one two"),
        ("not a Description: here", "not a Description: here"),
        ("# a\n## b\ntext # not a heading", "text # not a heading"),
        ("#no space", "#no space"),
        ("**a**: **b** c ** d", "c ** d"),
        ("**spans\nlines** x", "**spans lines** x"),
        ("a\u00a0\u2003b\u3000c", "a b c"),
        ("keep\u2028# this", "keep # this"),
        ("keep\r# this", "keep # this"),
        ("a\x1cb\x1f\x1dc", "a b c"),
        ("\x1c# gone\nleft", "left"),
        ("**x**\x1c:\x1d y", "y"),
        ("   ", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_description(spark, text, expected):
    assert evaluate(spark, [text], clean_description)[text] == expected


def test_names(spark):
    names = ["id", "_x1", "1st", "a.b", "bad-name", "", "Ünder"]
    assert [n for n, ok in evaluate(spark, names, is_valid_name).items() if ok] == ["id", "_x1"]
    gate = {
        ("ts", "timestamp_ntz"): True, ("ts", "bigint"): False, ("created_at", "string"): True, ("Month", "date"): True,
        ("Month", "string"): False, ("status_updated_at", "timestamp"): False, ("UPDATED", "string"): True,
        ("nested", "struct<a:timestamp>"): False, ("event-date", "date"): False, ("index", "string"): False,
    }
    rows = local_rows(spark, [{"n": n, "t": t} for n, t in gate], "n string, t string")
    gated = rows.select("n", "t", passes_freshness_gate(F.col("n"), F.col("t")).alias("ok"))
    assert {(r["n"], r["t"]): r["ok"] for r in gated.collect()} == gate
    names = ["loaded_TS", "order_date", "date", "created", "paid", "user_id", "name", "UUID", "pk"]
    assert [n for n, ok in evaluate(spark, names, suggests_freshness).items() if ok] == names[:2] + ["created"]
    assert [n for n, ok in evaluate(spark, names, suggests_completeness).items() if ok] == ["paid", "user_id", "UUID", "pk"]


def test_dotted_names(spark):
    names = ["t", "s.t", "p.s.t"]
    assert evaluate(spark, names, last_segment) == {"t": "t", "s.t": "t", "p.s.t": "t"}
    assert evaluate(spark, names, lambda v: schema_part(v, F.lit("d"))) == {"t": "d", "s.t": "s", "p.s.t": "p"}
    assert evaluate(spark, names, table_part) == {"t": "t", "s.t": "t", "p.s.t": "s.t"}


def test_exclusion_ignores_empty_patterns(spark):
    tables = ["orders", "orders_staging", "Events"]

    def kept(text):
        found = evaluate(spark, tables, lambda v: is_excluded(F.lit("Raw"), v, split_patterns(text)))
        return [t for t, excluded in found.items() if not excluded]

    assert kept("") == tables
    assert kept("_staging, ,") == ["orders", "Events"]
    assert kept("EVENT") == ["orders", "orders_staging"]
    assert kept("raw.o") == ["Events"]
    assert kept("raw.") == []
    assert kept("a.c") == tables


def test_pushable(spark):
    texts = ["fine", "", None, "Conn Error: timeout", "ERROR: Missing key", "an ERROR: inside", "error lower"]
    assert [t for t, ok in evaluate(spark, texts, is_pushable).items() if ok] == ["fine", "an ERROR: inside", "error lower"]


def test_severity_of_every_status(spark):
    expected = {
        "✅": "PASS", "⚪": "PASS", "⚠️": "WARN", "⚠️ OLD": "WARN", "Failed": "FAIL", "❌": "FAIL", "FAIL": "FAIL",
    }
    assert evaluate(spark, list(expected), severity) == expected


def test_one_decimal_matches_python(spark):
    hours = [s / 3600 for s in range(0, 400_000, 63)] + [0.25, 0.35, 0.75, 1.25, 23.96, 24.0, 0.04, 1260 / 3600, 123456.75]
    found = evaluate(spark, hours, one_decimal, "v double")
    assert {h: f"{h:.1f}" for h in hours} == found


def test_text_templates(spark):
    row = spark.range(1).select(
        report_line(F.lit("s.t"), F.lit("c"), F.lit("Freshness"), F.lit("1.0h ago")).alias("line"),
        description_prompt(F.lit("column"), F.lit("id"), F.lit("Table: t")).alias("prompt"),
        strip_backticks(F.lit("`p`.d`")).alias("name"),
    ).first()
    assert row["line"] == "• *t*\n   ↳ Freshness on `c`: *1.0h ago*"
    assert row["prompt"].startswith("Write a single, concise 1-sentence business description for the column 'id'. Context: Table: t. ")
    assert row["name"] == "p.d"


AS_OF = datetime(2024, 1, 31, 12, tzinfo=timezone.utc)


def python_hours(text):
    try:
        value = datetime.fromisoformat(text.replace("Z", "+00:00"))
        if value.tzinfo is None:
            value = value.replace(tzinfo=timezone.utc)
        return (AS_OF - value).total_seconds() / 3600
    except (ValueError, OverflowError):
        return None


def spelled_times():
    dates = ["2024-01-02", "20240102", "2024-0102", "202401-02", "2024-1-02", "2024-13-02", "2023-02-29", "0000-01-01",
             "0001-01-01", "9999-12-31", "2024", "2024-01", "24-01-02", "١٠٢٤-01-02"]
    separators = ["T", " ", "x", "  ", "é", "\n"]
    times = ["03", "03:04", "03:04:05", "0304", "030405", "03:0405", "0304:05", "3:04", "24:00", "23:59:60", "03:60",
             "03:04:05.5", "03:04:05,25", "03:04:05.123456", "03:04:05.1234567", "030405.75"]
    zones = ["", "Z", "+00:00", "-05:30", "+0530", "+05", "+5", " UTC", " Europe/Paris", "+17:59", "z", "-00:00", "+05:3"]
    texts = dates + [" 2024-01-02", "2024-01-02 ", "2024-01-02Z", "2024-01-02+01:00", "Not A Date", "", "x"]
    every = [d + s + t + z for d, s, t, z in itertools.product(dates, separators, times, zones)]
    return texts + random.Random(7).sample(every, 6000)


def test_iso_text_matches_python(spark):
    texts = list(dict.fromkeys(spelled_times()))
    clock = Clock(AS_OF)
    rows = local_rows(spark, [{"v": t} for t in texts], "v string").select("v", iso_spelling(F.col("v")).alias("iso"))
    found = {r["v"]: r["h"] for r in rows.select("v", iso_age_hours(F.col("iso"), clock).alias("h")).collect()}
    expected = {t: python_hours(t) for t in texts}
    assert sum(h is not None for h in expected.values()) > 300
    wrong = {
        t: (found[t], h)
        for t, h in expected.items()
        if (found[t] is None) != (h is None) or (h is not None and found[t] != pytest.approx(h, rel=1e-12))
    }
    assert not list(wrong.items())[:20]


def test_clock_in_another_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        instant = F.lit("2024-01-31 10:00:00+00:00").cast("timestamp")
        wall = F.lit("2024-01-31 10:00:00").cast("timestamp_ntz")
        naive, aware = Clock(datetime(2024, 1, 31, 12)), Clock(datetime(2024, 1, 31, 12, tzinfo=timezone.utc))
        row = spark.range(1).select(
            hours_between(instant, naive.instant), hours_between(wall, naive.wall),
            hours_between(instant, aware.instant), hours_between(wall, aware.wall),
            hours_between(Clock().instant, F.current_timestamp()), hours_between(Clock().wall, F.localtimestamp()),
        ).first()
        # 12:00 in New York is 17:00 UTC; 12:00 UTC is 07:00 in New York.
        assert list(row) == [7.0, 2.0, 2.0, -3.0, 0.0, 0.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_clock_is_close_to_python(spark):
    hours = spark.range(1).select(hours_between(Clock().instant, Clock(datetime.now(timezone.utc)).instant)).first()[0]
    assert abs(hours) < timedelta(minutes=5).total_seconds() / 3600
