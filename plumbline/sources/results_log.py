"""Log of result rows, one run id and one time per run; a run that is repeated under its id replaces itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.ages import Clock
from plumbline.functions.text import strip_backticks

_COLUMNS = (
    "run_id", "run_at", "dataset_name", "table_name", "column_name", "check_type",
    "status", "result_value", "metadata", "pos", "check_pos", "severity", "metric",
)


def new_run_id() -> str:
    """Time-ordered where this Python offers it."""
    return str(getattr(uuid, "uuid7", uuid.uuid4)())


def stamp_results(results: DataFrame, run_id: str, clock: Clock = Clock()) -> DataFrame:
    return (
        results.withColumn("run_id", F.lit(run_id))
        .withColumn("run_at", clock.instant)
        .withColumn("dataset_name", strip_backticks(F.col("dataset_name")))
        .select(*_COLUMNS)
    )


LOG_SCHEMA = (
    "run_at timestamp, dataset_name string, table_name string, column_name string, check_type string, status string, "
    "result_value string, metadata string, pos long, check_pos int, severity string, metric double, run_id string"
)


def _by_run(spark: SparkSession, path: str, new: bool) -> bool:
    """Whether the log at ``path`` has a folder per run; ``new`` if it is yet to be written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    written = [name for name in names if not name.startswith(("_", "."))]
    return all(name.startswith("run_id=") for name in written) if written else new


def _append_files(rows: DataFrame, path: str, fresh: bool) -> None:
    """Adds to a log without folders. Unless ``fresh``, files that hold a run of ``rows`` are written anew without it, then deleted."""
    spark, old = rows.sparkSession, []
    if not fresh:
        runs = rows.select("run_id").distinct()
        log = spark.read.schema(LOG_SCHEMA).parquet(path)
        found = log.select("run_id", F.col("_metadata.file_path").alias("file")).join(runs, "run_id", "left_semi").select("file").distinct()
        jvm = spark._jvm
        old = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file"])) for row in found.collect()]
    if old:
        kept = spark.read.schema(LOG_SCHEMA).parquet(*[file.toString() for file in old]).join(runs, "run_id", "left_anti")
        rows = rows.unionByName(kept.select(*rows.columns)).hint("rebalance")
    rows.write.mode("append").parquet(path)
    for file in old:
        file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def append_log(
    stamped: DataFrame, path: str | None = None, table: str | None = None, run_id: str | None = None, fresh: bool = False
) -> None:
    """One write to a Parquet folder or a catalog table, created when absent, with a folder per run.

    Only folders of the runs in ``stamped`` are replaced, so a run that is logged again under its id leaves one copy. A table needs
    ``run_id`` for that. ``fresh`` tells that the run was never logged before: such runs begin a log of plain files. A run that is logged
    again in a log of plain files replaces its files once it is written. The rebalance hint lets Spark write a small run as one file
    and split a large one.
    """
    spark, rows = stamped.sparkSession, stamped.hint("rebalance")
    if table is not None:
        if not spark.catalog.tableExists(table):
            rows.write.partitionBy("run_id").saveAsTable(table)
        elif run_id is None or _partitions(spark, table) != ["run_id"]:
            rows.write.mode("append").saveAsTable(table)
        else:
            columns = [c.name for c in spark.catalog.listColumns(table) if c.name != "run_id"]
            run = rows.where(F.col("run_id") == run_id).select(*columns)
            named = run_id.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}")
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run_id = '{named}') SELECT * FROM {{run}}", run=run)
    elif path is None:
        raise ValueError("append_log needs a path or a table")
    elif _by_run(spark, path, new=not fresh):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    else:
        _append_files(rows, path, fresh)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log at a path; run ids stay text whatever they look like."""
    return spark.read.schema(LOG_SCHEMA).parquet(path).select(*_COLUMNS)
