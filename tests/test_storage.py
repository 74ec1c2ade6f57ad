"""Configurations, descriptions and logs that are replaced in place."""

import os
import time

import pytest
from pyspark.sql import functions as F

from plumbline.plans.quality import run_and_log
from plumbline.sources import snapshots
from plumbline.sources.configs import append_checks, append_config, config_from_entries, read_config, write_config
from plumbline.sources.descriptions import (
    FRAGMENT_COLUMNS,
    document_entries,
    flatten_entries,
    flatten_fragments,
    missing_fragments,
    read_document,
    read_fragments,
    read_stored,
    refresh_stored,
    write_document,
    write_fragments,
    write_stored,
)
from plumbline.sources.results_log import append_log, read_log
from plumbline.sources.tables import frames

FLAT = "schema string, table string, column string, ordinal long, description string, data_type string, entry_pos struct<source_pos: long, table_pos: long>"


def entries(spark, *tables):
    return config_from_entries(spark, [{"table": t, "completeness_col": "id"} for t in tables])


def tables_of(spark, path):
    return [r.table for r in read_config(spark, path).orderBy("pos").collect()]


def failing(df):
    """The same rows, but reading the last of them fails."""
    return df.withColumn("table", F.when(F.col("pos") < F.lit(df.count() - 1), F.col("table")).otherwise(F.raise_error(F.lit("storage is away"))))


def test_append_in_place(spark, tmp_path):
    path = str(tmp_path / "checks")
    write_config(entries(spark, "a.x", "a.y"), path)
    write_config(append_config(read_config(spark, path), entries(spark, "a.z")), path)
    assert tables_of(spark, path) == ["a.x", "a.y", "a.z"]
    assert append_checks(entries(spark, "b.x", "b.y"), path) == 3
    assert tables_of(spark, path) == ["a.x", "a.y", "a.z", "b.x", "b.y"]
    assert append_checks(entries(spark, "n.x"), str(tmp_path / "new")) == 1
    assert tables_of(spark, str(tmp_path / "new")) == ["n.x"]


def test_failed_write_leaves_the_configuration(spark, tmp_path):
    path = str(tmp_path / "checks")
    write_config(entries(spark, "a.x", "a.y"), path)
    before = sorted(os.listdir(path))
    with pytest.raises(Exception, match="storage is away"):
        write_config(failing(append_config(read_config(spark, path), entries(spark, "a.z"))), path)
    assert tables_of(spark, path) == ["a.x", "a.y"] and sorted(os.listdir(path)) == before


def test_plain_files_are_the_first_state(spark, tmp_path):
    path = str(tmp_path / "checks")
    entries(spark, "a.x").write.json(path)
    started = read_config(spark, path)
    append_checks(entries(spark, "a.y"), path)
    assert tables_of(spark, path) == ["a.x", "a.y"]
    assert started.count() == 1  # a plan that began with the old state still reads it
    for i in range(snapshots.KEPT + 2):
        append_checks(entries(spark, f"b.{i}"), path)
    assert len(tables_of(spark, path)) == snapshots.KEPT + 4
    assert len([n for n in os.listdir(path) if n.startswith("snapshot-")]) == snapshots.KEPT + 1
    assert not [n for n in os.listdir(path) if n.endswith(".json")]


def test_writers_that_meet(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "checks")
    append_checks(entries(spark, "a.x"), path)
    base = snapshots.latest(spark, path)
    append_checks(entries(spark, "a.y"), path)
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(spark, path, entries(spark, "lost.z").write.json, base)
    folder = snapshots._Folder(spark, path)
    with pytest.raises(snapshots.Conflict):
        folder.commit(2, "snapshot-late")
    (tmp_path / "checks" / "_commits" / f"{9:020d}").touch()  # a writer died between creating and naming its commit
    assert tables_of(spark, path) == ["a.x", "a.y"]
    latest, stale = snapshots.latest, [base]
    monkeypatch.setattr(snapshots, "latest", lambda s, p: stale.pop() if stale else latest(s, p))
    assert append_checks(entries(spark, "a.z"), path) == 10
    assert tables_of(spark, path) == ["a.x", "a.y", "a.z"]


def test_document_refreshed_in_place(spark, tmp_path):
    path = str(tmp_path / "document")
    rows = [("s", "t", None, 0, "Table.", None, (0, 0)), ("s", "t", "c", 1, "Column.", "int", (0, 0))]
    write_document(spark.createDataFrame(rows, FLAT), path)
    back = flatten_entries(document_entries(read_document(spark, path, lines=True)))
    write_document(back.withColumn("description", F.concat("description", F.lit(" New."))), path)
    again = flatten_entries(document_entries(read_document(spark, path, lines=True))).orderBy("ordinal").collect()
    assert [r.description for r in again] == ["Table. New.", "Column. New."]


def wide(spark, n_columns, n_tables):
    """One source with columns dealt to tables, all places in reverse order of names."""
    place = F.struct(F.lit(3).cast("long").alias("source_pos"), (F.lit(n_tables) - F.col("t")).cast("long").alias("table_pos"))
    numbered = spark.range(n_columns).select((F.col("id") % n_tables).alias("t"), F.floor(F.col("id") / n_tables).alias("c"))
    columns = numbered.selectExpr("t", "concat('col_', c) AS column", "c + 1 AS ordinal", "concat('About ', t, ' ', c) AS description", "'int' AS data_type")
    own = spark.range(n_tables).selectExpr("id AS t", "CAST(NULL AS STRING) AS column", "0L AS ordinal", "concat('Table ', id) AS description", "CAST(NULL AS STRING) AS data_type")
    rows = columns.unionByName(own).withColumn("entry_pos", place)
    return rows.select(F.lit("lake").alias("schema"), F.concat(F.lit("t"), F.lpad(F.col("t").cast("string"), 5, "0")).alias("table"), "column", "ordinal", "description", "data_type", "entry_pos")


def test_source_of_a_million_columns(spark, tmp_path):
    flat, path = wide(spark, 1_000_000, 40), str(tmp_path / "wide")
    write_fragments(flat, path)
    fragments = read_fragments(spark, path)
    largest = fragments.agg(F.max(F.size("columns")), F.count("*")).first()
    assert largest[0] <= FRAGMENT_COLUMNS and largest[1] == 40 * 25
    assert missing_fragments(spark, path).count() == 0
    back = flatten_fragments(fragments)
    assert back.exceptAll(flat.select(back.columns)).count() == 0 and back.count() == 1_000_040
    folder = snapshots.latest(spark, path).folder.removeprefix("file:")
    read = []
    for name in sorted(n for n in os.listdir(f"{folder}/fragments") if n.startswith("part-")):  # as a reader that streams files meets them
        with open(f"{folder}/fragments/{name}") as lines:
            read += [(r["entry_pos"]["table_pos"], r["table"], r["fragment"]) for r in map(__import__("json").loads, lines)]
    assert read == sorted(read)
    lost = sorted(n for n in os.listdir(f"{folder}/fragments") if n.startswith("part-"))[0]
    os.rename(f"{folder}/fragments/{lost}", tmp_path / lost)
    assert [r.schema for r in missing_fragments(spark, path).collect()] == ["lake"]


def test_fragments_of_odd_rows(spark, tmp_path):
    rows = [
        ("s", "t", "b", None, "No ordinal.", "int", (0, 1)), ("s", "t", "a", 5000, None, None, (0, 2)), ("s", "t", None, 0, None, None, (0, 1)),
        ("s", "u", "x", -3, "Below.", "", (0, 0)), (None, "t", "c", 1, "No source.", "int", None), ("s", "t", "b", None, "No ordinal.", "int", (0, 1)),
    ]
    flat, path = spark.createDataFrame(rows, FLAT), str(tmp_path / "odd")
    write_fragments(flat, path)
    assert sorted(map(repr, flatten_fragments(read_fragments(spark, path)).select(flat.columns).collect())) == sorted(map(repr, flat.collect()))
    write_fragments(flat.limit(0), path)
    assert read_fragments(spark, path).count() == 0 and missing_fragments(spark, path).count() == 0


def test_refresh_leaves_other_sources_alone(spark, tmp_path):
    path = str(tmp_path / "stored")
    rows = [(s, t, f"c{i}", i, f"{s} {t} {i}", "int", (0, 0)) for s in ("a", "b", "c", "2024") for t in ("x", "y") for i in range(3)]
    rows.append((None, "x", "c", 1, "No source.", None, None))
    write_stored(spark.createDataFrame(rows, FLAT), path)
    files = {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}
    time.sleep(0.05)
    now = [("a", "x", "new", 1, "New.", "int", (0, 0)), ("d", "z", "new", 1, "New.", "int", (0, 0)), (None, "x", "new", 1, "New.", None, None)]
    refresh_stored(spark.createDataFrame(now, FLAT), path)
    after = {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}
    kept = {f: t for f, t in files.items() if "schema=a" not in f and "DEFAULT" not in f}
    assert len(kept) >= 3 and kept == {f: t for f, t in after.items() if f in files}
    expected = [r for r in rows if (r[0], r[1]) != ("a", "x")] + now  # without a source there is no telling which table is meant
    got = read_stored(spark, path).select("schema", "table", "column", "ordinal", "description").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((r[:5] for r in expected), key=repr)


def test_failed_refresh_leaves_everything(spark, tmp_path):
    path = str(tmp_path / "stored")
    write_stored(spark.createDataFrame([("a", "x", "c", 1, "Old.", "int", (0, 0))], FLAT), path)
    now = spark.createDataFrame([("a", "x", "c", 1, "New.", "int", (0, 0))], FLAT)
    with pytest.raises(Exception, match="storage is away"):
        refresh_stored(now.withColumn("description", F.raise_error(F.lit("storage is away"))), path)
    assert [r.description for r in read_stored(spark, path).collect()] == ["Old."]


@pytest.fixture
def checked(spark):
    config = config_from_entries(spark, [{"table": "s.t", "completeness_col": "id", "uniqueness_col": "id"}])
    return config, frames({"s.t": spark.createDataFrame([(1,), (None,), (1,)], "id long")})


def test_run_repeated_under_its_id(spark, tmp_path, checked):
    path, (config, tables) = str(tmp_path / "log"), checked
    for run in ("2024-01-01", "2024-01-01", "it's {b}", "it's {b}"):
        assert run_and_log(spark, config, tables, path=path, run_id=run) == run
    other = run_and_log(spark, config, tables, path=path)
    counts = {r.run_id: r["count"] for r in read_log(spark, path).groupBy("run_id").count().collect()}
    assert counts == {"2024-01-01": 2, "it's {b}": 2, other: 2}


def test_table_log_repeated_under_its_id(spark, checked):
    config, tables = checked
    for run in ("first", "it's {b}", "first", "it's {b}"):
        run_and_log(spark, config, tables, table="repeated_logs", run_id=run)
    run_and_log(spark, config, tables, table="repeated_logs")
    counts = [r["count"] for r in spark.table("repeated_logs").groupBy("run_id").count().collect()]
    assert counts == [2, 2, 2]


def test_run_repeated_in_a_log_of_plain_files(spark, tmp_path, checked):
    path, (config, tables) = str(tmp_path / "a log"), checked
    first = run_and_log(spark, config, tables, path=path)
    for run in ("2024-01-01", "it's {b}", "2024-01-01"):
        run_and_log(spark, config, tables, path=path, run_id=run)
    read_log(spark, path).coalesce(1).write.parquet(str(tmp_path / "one file"))
    run_and_log(spark, config, tables, path=str(tmp_path / "one file"), run_id="it's {b}")
    for log in (path, str(tmp_path / "one file")):
        counts = {r.run_id: r["count"] for r in read_log(spark, log).groupBy("run_id").count().collect()}
        assert counts == {first: 2, "2024-01-01": 2, "it's {b}": 2}


def test_old_logs_are_appended_to(spark, tmp_path, checked):
    path, (config, tables) = str(tmp_path / "log"), checked
    run_and_log(spark, config, tables, path=str(tmp_path / "new"), run_id="old")
    read_log(spark, str(tmp_path / "new")).write.parquet(path)
    run_and_log(spark, config, tables, path=path, run_id="next")
    assert read_log(spark, path).groupBy("run_id").count().count() == 2
    with pytest.raises(ValueError):
        append_log(read_log(spark, path))
