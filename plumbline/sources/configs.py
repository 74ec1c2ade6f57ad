"""Check configuration: read, unpivot to one row per check, append and write."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.literals import local_rows
from plumbline.functions.names import is_temporal_name, is_valid_name, is_vetoed_name, schema_part, table_part
from plumbline.operators.checks import COMPLETENESS, FRESHNESS, UNIQUENESS
from plumbline.sources import snapshots

CONFIG_SCHEMA = "pos long, table string, freshness_col string, completeness_col string, uniqueness_col string"
_FIELDS = ("table", "freshness_col", "completeness_col", "uniqueness_col")
DEFAULT_SCHEMA = "public"


def config_from_entries(spark: SparkSession, entries: Iterable[Mapping[str, str]]) -> DataFrame:
    rows = [{"pos": i, **{f: entry.get(f) for f in _FIELDS}} for i, entry in enumerate(entries)]
    return local_rows(spark, rows, CONFIG_SCHEMA)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """A configuration table: the last that ``write_config`` or ``append_checks`` put there, else JSON lines as they stand."""
    return spark.read.schema(CONFIG_SCHEMA).json(snapshots.latest(spark, path).folder)


def read_yaml_config(spark: SparkSession, path: str) -> DataFrame:
    """The ``checks`` list of a YAML file; needs PyYAML on the driver."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        document = yaml.safe_load(handle) or {}
    return config_from_entries(spark, document.get("checks") or [])


def unpivot_checks(config: DataFrame) -> DataFrame:
    """One row per configured check in file order, freshness first, with its name flags."""
    first_table = config.agg(F.min_by("table", "pos")).scalar()
    default_schema: Column = schema_part(first_table, F.lit(DEFAULT_SCHEMA))
    kinds = F.array(
        F.struct(F.lit(FRESHNESS).alias("check_type"), F.col("freshness_col").alias("column_name")),
        F.struct(F.lit(COMPLETENESS).alias("check_type"), F.col("completeness_col").alias("column_name")),
        F.struct(F.lit(UNIQUENESS).alias("check_type"), F.col("uniqueness_col").alias("column_name")),
    )
    return (
        config.select("pos", F.col("table").alias("table_name"), F.posexplode(kinds).alias("check_pos", "kind"))
        .select("pos", "check_pos", "table_name", "kind.check_type", "kind.column_name")
        .where(F.col("column_name").isNotNull())
        .select(
            "*",
            schema_part(F.col("table_name"), default_schema).alias("schema"),
            table_part(F.col("table_name")).alias("table"),
            is_valid_name(F.col("column_name")).alias("valid_name"),
            is_temporal_name(F.col("column_name")).alias("temporal_name"),
            is_vetoed_name(F.col("column_name")).alias("vetoed_name"),
        )
    )


def append_config(existing: DataFrame, generated: DataFrame) -> DataFrame:
    """Generated entries after the existing ones, nothing removed."""
    after = F.coalesce(existing.agg(F.max("pos") + 1).scalar(), F.lit(0))
    shifted = generated.withColumn("pos", (F.col("pos") + after).cast("long"))
    return existing.unionByName(shifted, allowMissingColumns=True)


def write_config(config: DataFrame, path: str) -> None:
    """Replaces the configuration at ``path``, from which ``config`` may have been read; a failed write leaves it as it was."""
    snapshots.replace(config.sparkSession, path, config.write.json)


def append_checks(generated: DataFrame, path: str, attempts: int = 5) -> int:
    """Appends generated entries to the configuration at ``path`` in place; returns how many writes the path has seen.

    Entries that another run appends meanwhile stay: this one then starts anew from them.
    """
    spark = generated.sparkSession
    for left in reversed(range(attempts)):
        base = snapshots.latest(spark, path)
        existing = spark.read.schema(CONFIG_SCHEMA).json(base.folder) if base.exists else config_from_entries(spark, [])
        try:
            return snapshots.replace(spark, path, append_config(existing, generated).write.json, base)
        except snapshots.Conflict:
            if not left:
                raise
    raise ValueError("append_checks needs an attempt")
