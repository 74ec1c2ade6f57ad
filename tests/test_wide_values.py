"""Times, keys, evidence and catalogs beyond plain columns."""

import random
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.functions.ages import Clock, iso_age_hours, iso_spelling
from plumbline.operators import suggest
from plumbline.operators.checks import uniqueness
from plumbline.operators.keys import key_profiles
from plumbline.operators.suggest import candidate_evidence, suggest_checks, suggestions_from_evidence
from plumbline.plans.config import generate_checks
from plumbline.sources.catalog import catalog_of

# --------------------------------------------------------------------------- ISO text


def iso_texts():
    rng = random.Random(13)
    dates = ["2024-02-29", "2023-02-29", "20240229", "2024-W09-4", "2024-W09", "2024W09", "2024W094", "2020-W53-7", "2021-W53-1", "2024-W00-1", "2024-W09-8",
             "2024-W09-0", "0001-W01-1", "9999-W52-7", "9999-W53-1", "0000-01-01", "0001-01-01", "2024-13-01", "2024-1-01", "2024-W1", "202402-29", "2024-0229",
             "2024W09-4", "2024-W094", "2026-W53-4", "2015-W53-5", "9999-12-31", "2024-W09-", "2024-W9-41"]
    times = ["", "1", "12", "12:30", "1230", "12:30:45", "123045", "12:30:45.5", "12:30:45,1234567", "123045.123", "12304512", "1230451", "1230451234567", "24:00",
             "23:60", "23:59:60", "12:", "12:30:", "12:30:45.", "12:3", "123", "12x", "12:30x", "12:30:45x", "12:30:45.123456xyz", "12:3045", "1230:45", "12.5",
             "12:30.5", "00:00", "12:30:4512", "123045.", "12:30:45é", "123045.1234567é"]
    zones = ["", "Z", "+00:00", "-05:30", "+0530", "+05", "+05:30:15", "+053015", "+05:30:15.25", "-23:59:59.999999", "+24:00", "+23:99", "+00:00:00.5", "+5", "+",
             "-", "+05:3", "+05:30:", "Zx", "+05x", "-053015123", "+0530151"]
    texts = [d + s + t + z for d in dates for s in ("T", " ") for t in times[:6] for z in zones[:4]]
    texts += ["2024-02-29T" + t + z for t in times for z in zones] + dates + ["2024-W09" + s + "10:30" for s in "T -1é"]
    texts += [d + s for d in dates[:7] for s in ("T", "é", "😀", "\n", "-", "1")] + [d + s + "12:30" for d in dates[:7] for s in ("é", "😀", "\n", "-", "1", "11")]
    letters = "0123456789-:+.,WTZ "
    for _ in range(6000):
        text = list(rng.choice(dates) + rng.choice("TT -1é") + rng.choice(times) + rng.choice(zones))
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randrange(2)] = rng.choice(letters) if rng.random() < 0.7 else ""
        texts.append("".join(text))
    return sorted(set(texts))


def fromisoformat(text):
    try:
        at = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return at.replace(tzinfo=None), None if at.tzinfo is None else at.utcoffset() // timedelta(microseconds=1)


@pytest.mark.skipif(sys.version_info[:2] != (3, 13), reason="compares with Python 3.13")
def test_iso_text_as_python_reads_it(spark):
    texts = iso_texts()
    spelled = spark.createDataFrame([(t,) for t in texts], "t string").select("t", iso_spelling(F.col("t")).alias("iso"))
    wall, offset = F.substring("iso", 1, 26).try_cast("timestamp_ntz"), F.nullif(F.substring("iso", 28, 30), F.lit(""))
    got = {r.t: r.wall and (r.wall, r.offset and int(r.offset)) for r in spelled.select("t", wall.alias("wall"), offset.alias("offset")).collect()}
    wrong = {t: (got[t], fromisoformat(t)) for t in texts if got[t] != fromisoformat(t)}
    assert not wrong, (len(wrong), list(wrong.items())[:10])
    assert len(texts) > 6000 and 1000 < sum(g is not None for g in got.values()) < len(texts) - 1000


def test_age_of_zoned_and_week_text(spark):
    clock = Clock(datetime(2024, 3, 1, 12))
    ages = spark.createDataFrame([("2024-W09-4T12:00",), ("20240301T120000+01:00:36",), ("2024-03-01T12-23:59:59.999999",), ("2024-W60",)], "t string")
    got = [r[0] for r in ages.select(iso_age_hours(iso_spelling(F.col("t")), clock)).collect()]
    assert got[0] == 24.0 and got[1] == pytest.approx(1.01) and got[2] == pytest.approx(-23 - 59 / 60 - 59.999999 / 3600) and got[3] is None


# --------------------------------------------------------------------------- nested keys

NESTED = {
    "pair": ("struct<a: string, b: string>", [("x", "yz"), ("xy", "z"), ("x", "yz"), (None, None), None, (None, None), ("~", None), (None, "~")], 2),
    "words": ("array<string>", [["a", "b"], ["a,b"], ["a", "b"], [], None, [None], ["~"], [None], ["a", None, "b"]], 2),
    "deep": ("array<struct<k: int, v: array<array<string>>>>", [[(1, [["a"], []])], [(1, [["a"]])], [(1, [["a"], []])], [(1, None)], [None], None, [None]], 2),
    "named": ("map<string, int>", [{"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": 1}, {"a": 1, "b": None}, {}, None, {}], 2),
    "number": ("struct<x: double>", [(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.0,), (None,)], 2),
    "raw": ("array<binary>", [[b"a"], [b"\x00"], [b"a"], [b""], []], 1),
}


@pytest.mark.parametrize("name", NESTED)
def test_nested_keys(spark, name):
    kind, values, surplus = NESTED[name]
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    row = key_profiles([(0, df, "x")]).first()
    assert (row["n_rows"], row["nulls"], row["surplus"]) == (len(values), values.count(None), surplus)


def test_variant_keys(spark):
    texts = ['{"a": 1, "b": [1, null]}', '{"b":[1,null],"a":1}', '"x"', "null", None, '{"a": "1"}', "1", "1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("parse_json(t) AS x", "array(parse_json(t)) AS xs")
    assert [tuple(r)[1:] for r in key_profiles([(0, df, "x"), (1, df, "xs")]).orderBy("number").collect()] == [(8, 1, 2), (8, 0, 2)]
    assert [r.status for r in uniqueness(df, ["x"]).collect()] == ["Failed"]


def test_nested_keys_are_shuffled_as_digests(spark):
    df = spark.createDataFrame([(("x" * 1000, ["y"] * 100),)], "x struct<a: string, b: array<string>>")
    plan = key_profiles([(0, df, "x")])._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(sha2(" in plan and "Aggregate [x#" not in plan


# --------------------------------------------------------------------------- evidence


def test_sketches_rule_columns_out(spark, monkeypatch):
    grouped, plain = [], suggest.key_profiles
    monkeypatch.setattr(suggest, "key_profiles", lambda keys: grouped.append([k[2] for k in keys]) or plain(keys))
    names = spark.range(5000).selectExpr("concat('n', id % 4900) AS name_id", "CAST(id % 10 AS DECIMAL(9, 2)) AS price_id", "concat('k', id) AS key_id", "id AS pk_id", "id AS other_id")
    tables = {("s", "t"): names}
    catalog = catalog_of(spark, tables)
    candidate_evidence(catalog, tables)
    assert grouped == [["name_id", "price_id", "key_id", "pk_id", "other_id"]]
    grouped.clear()
    candidate_evidence(catalog, tables, exact=False)
    assert grouped == [["name_id"], ["key_id"]]
    evidence = {r.column: r for r in candidate_evidence(catalog, tables, exact=False).collect()}
    # 4,900 of 5,000 is too close for a sketch; once a key is found, no other column is grouped.
    assert evidence["name_id"].surplus == 100 and evidence["price_id"].surplus is None and not evidence["price_id"].usable
    assert evidence["key_id"].usable and evidence["key_id"].surplus == 0 and evidence["pk_id"].surplus is None
    both = [suggest_checks(catalog, suggestions_from_evidence(candidate_evidence(catalog, tables, exact=e))).collect() for e in (True, False)]
    assert both[0] == both[1] and both[0][0].completeness_col == "key_id"


def test_one_bad_column_costs_only_itself(spark):
    events = spark.range(20).selectExpr("id", "timestamp'2024-01-01' AS created_at", "timestamp'2024-01-01' AS CREATED_AT", "timestamp'2024-01-02' AS updated_at")
    unread = F.when(F.col("id") < 30, F.raise_error(F.lit("storage is away"))).otherwise(F.col("id"))
    tables = {("s", "twins"): events, ("s", "broken"): spark.range(20).select(unread.alias("bad_id"), "id", F.col("id").cast("string").alias("text_id"))}
    for exact in (True, False):
        found = {(r.table, r.column): r for r in candidate_evidence(catalog_of(spark, tables), tables, exact=exact).collect()}
        assert found["twins", "id"].usable and found["twins", "updated_at"].usable and ("twins", "created_at") not in found
        assert found["broken", "id"].usable and "storage is away" in found["broken", "bad_id"].reason
    entries = {r.table: r for r in generate_checks(spark, tables).collect()}
    assert (entries["s.twins"].freshness_col, entries["s.twins"].completeness_col) == ("updated_at", "id")


# --------------------------------------------------------------------------- catalogs


def test_catalog_of_a_million_columns(spark):
    one = spark.createDataFrame([], ", ".join(f"c{i} int" for i in range(995)) + ", user_id int, created_at timestamp, s struct<a: int, b: int>")
    tables = {("lake", f"t{i}"): one for i in range(1000)}
    catalog = catalog_of(spark, tables)
    assert catalog.rdd.getNumPartitions() > 1 and catalog.count() == 1_000_000
    entries = suggest_checks(catalog)
    assert entries.select("freshness_col", "completeness_col").distinct().collect() == [("created_at", "user_id")]
    assert entries.count() == 1000


def test_both_kinds_of_catalog_agree(spark):
    tables = {("a", "x"): spark.createDataFrame([], "id int, s struct<`é`: string>"), ("b", "y"): spark.createDataFrame([], "z map<int, int>")}
    assert catalog_of(spark, tables, 0).orderBy("table_pos", "ordinal").collect() == catalog_of(spark, tables).orderBy("table_pos", "ordinal").collect()
