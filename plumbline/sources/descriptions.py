"""Description documents: nested sources, tables and columns, to flat rows and back.

Flat rows hold one described object each: ``schema, table, column, ordinal, description, data_type, entry_pos``. The table
itself has no column and ordinal 0; its columns have the ordinal that they are given, gaps and nulls included.
``entry_pos`` (``source_pos, table_pos``) tells where an entry stands: later ones count, and entries are written in
its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.names import last_segment
from plumbline.operators.merge import merge_descriptions
from plumbline.sources import snapshots

_COLUMNS = "columns array<struct<name string, description string, data_type string>>"
ENTRY_SCHEMA = (
    "schema string, table string, description string, "
    "columns array<struct<ordinal long, name string, description string, data_type string>>"
)
DOCUMENT_SCHEMA = (
    "version int, sources array<struct<name string, schema string, "
    f"tables array<struct<name string, description string, {_COLUMNS}>>>>"
)
DEFAULT_SCHEMA = "public"
VERSION = 2  # fixed value: the version written into a document


def entry_pos(source_pos: Column, table_pos: Column) -> Column:
    return F.struct(source_pos.cast("long").alias("source_pos"), table_pos.cast("long").alias("table_pos")).alias("entry_pos")


def read_document(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Nested documents as JSON: one per file, or with ``lines`` one per line, as ``write_document`` writes them."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(snapshots.latest(spark, path).folder, multiLine=not lines)


def read_yaml_document(spark: SparkSession, path: str) -> DataFrame:
    """A nested document as YAML; needs PyYAML on the driver."""
    import json

    import yaml

    with open(path, encoding="utf-8") as handle:
        text = json.dumps(yaml.safe_load(handle) or {})
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(F.from_json(F.lit(text), DOCUMENT_SCHEMA))))


def document_entries(document: DataFrame) -> DataFrame:
    """One row per table entry, keyed by schema and plain table name, with its place in the document."""
    tables = document.select(F.posexplode("sources").alias("source_pos", "source")).select(
        "source_pos", "source.name", "source.schema", F.posexplode("source.tables").alias("table_pos", "entry")
    )
    named = [F.when(F.col(c) != "", F.col(c)) for c in ("name", "schema")]
    columns = F.transform(
        "entry.columns",
        lambda c, i: F.struct((i + 1).cast("long").alias("ordinal"), c["name"], c["description"], c["data_type"]),
    )
    return tables.select(
        F.coalesce(*named, F.lit(DEFAULT_SCHEMA)).alias("schema"),
        last_segment(F.col("entry.name")).alias("table"),
        "entry.description",
        columns.alias("columns"),
        entry_pos(F.col("source_pos"), F.col("table_pos")),
    )


def flatten_entries(entries: DataFrame) -> DataFrame:
    """One row per described object; other columns of an entry, such as its place, are repeated."""
    carried = [c for c in entries.columns if c not in ("schema", "table", "description", "columns")]
    table_row = F.struct(
        F.lit(None).cast("string").alias("column"),
        F.lit(0).cast("long").alias("ordinal"),
        F.col("description"),
        F.lit(None).cast("string").alias("data_type"),
    )
    column_rows = F.transform(
        F.coalesce("columns", F.array()),
        lambda c: F.struct(c["name"].alias("column"), c["ordinal"], c["description"], c["data_type"]),
    )
    return entries.select("schema", "table", F.inline(F.concat(F.array(table_row), column_rows)), *carried)


def latest_descriptions(flat: DataFrame) -> DataFrame:
    """One row per object; of several the last in the document counts."""
    last = F.struct("entry_pos", "ordinal", "description", "data_type")
    return flat.groupBy("schema", "table", "column").agg(F.max(last).alias("last")).select(
        "schema", "table", "column", "last.ordinal", "last.description", "last.data_type", "last.entry_pos"
    )


def nest_entries(flat: DataFrame) -> DataFrame:
    """One entry per table, its columns ordered by their ordinals (nulls first), then by name.

    A row holds one table whole, so it is as wide as a catalog table: not for tables made of data rows without bound.
    """
    column = F.struct("ordinal", F.col("column").alias("name"), "description", "data_type")
    return flat.groupBy("schema", "table").agg(
        F.max(F.when(F.col("column").isNull(), F.col("description"))).alias("description"),
        F.sort_array(F.collect_list(F.when(F.col("column").isNotNull(), column))).alias("columns"),
    )


def nest_document(flat: DataFrame) -> DataFrame:
    """One document per source, in the shape that ``read_document`` reads: tables in the order of their places.

    A document holds a source whole, as the files do that people write; sources never meet.
    """
    places = flat.groupBy("schema", "table").agg(F.min("entry_pos").alias("entry_pos"))
    entries = nest_entries(flat).join(places, ["schema", "table"])
    plain = F.transform("columns", lambda c: F.struct(c["name"], c["description"], c["data_type"]))
    table = F.struct(F.col("table").alias("name"), "description", plain.alias("columns"))
    sources = entries.groupBy("schema").agg(F.sort_array(F.collect_list(F.struct("entry_pos", table.alias("entry")))).alias("tables"))
    source = F.struct(
        F.col("schema").alias("name"), F.lit(None).cast("string").alias("schema"), F.transform("tables", lambda t: t["entry"]).alias("tables")
    )
    return sources.select(F.lit(VERSION).alias("version"), F.array(source).alias("sources"))


def write_document(flat: DataFrame, path: str) -> None:
    """The documents of ``flat``, one per line and source; ``read_document(..., lines=True)`` reads them.

    A line holds a source whole, for tools that take such files; ``write_fragments`` writes sources of any width. ``flat`` may come from
    ``path`` itself, and a failed write leaves it as it was.
    """
    snapshots.replace(flat.sparkSession, path, nest_document(flat).write.json)


def write_entries(entries: DataFrame, path: str) -> None:
    """One JSON line per table entry, so that a large document is written and read in parallel; ``path`` is replaced as a whole."""
    snapshots.replace(entries.sparkSession, path, entries.write.json)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENTRY_SCHEMA).json(snapshots.latest(spark, path).folder)


# --------------------------------------------------------------------------- sources of any width

#: Ordinals that a fragment of a table spans.
FRAGMENT_COLUMNS = 1000
FRAGMENT_SCHEMA = (
    "schema string, table string, entry_pos struct<source_pos long, table_pos long>, fragment long, "
    "described boolean, description string, data_type string, "
    "columns array<struct<ordinal long, name string, description string, data_type string, entry_pos struct<source_pos long, table_pos long>>>"
)
MANIFEST_SCHEMA = "schema string, tables long, columns long, fragments long"


def fragment_rows(flat: DataFrame) -> DataFrame:
    """One row per table and range of ordinals, so that no row holds a source or a wide table.

    ``entry_pos`` is the first place of the table; ``described`` tells whether the table has a row of its own, which its
    first fragment holds. Columns without ordinal belong to the first fragment too.
    """
    span = F.lit(FRAGMENT_COLUMNS)
    fragment = F.coalesce(F.floor((F.greatest("ordinal", F.lit(1)) - 1) / span), F.lit(0)).cast("long").alias("fragment")
    own = F.col("column").isNull()
    column = F.struct("ordinal", F.col("column").alias("name"), "description", "data_type", "entry_pos")
    fragments = flat.groupBy("schema", "table", fragment).agg(
        F.bool_or(own).alias("described"),
        F.max(F.when(own, F.struct("entry_pos", "description", "data_type"))).alias("own"),
        F.sort_array(F.collect_list(F.when(~own, column))).alias("columns"),
    )
    places = flat.groupBy("schema", "table").agg(F.min("entry_pos").alias("entry_pos"))
    placed = fragments.join(places, (fragments["schema"].eqNullSafe(places["schema"])) & (fragments["table"].eqNullSafe(places["table"])))
    return placed.select(
        fragments["schema"], fragments["table"], "entry_pos", "fragment", "described", "own.description", "own.data_type", "columns"
    )


def _manifest(fragments: DataFrame) -> DataFrame:
    tables = fragments.groupBy("schema", "table").agg(F.sum(F.size("columns")).alias("columns"), F.count("*").alias("fragments"))
    return tables.groupBy("schema").agg(
        F.count("*").alias("tables"), F.sum("columns").alias("columns"), F.sum("fragments").alias("fragments")
    )


def write_fragments(flat: DataFrame, path: str) -> None:
    """The document of ``flat`` as JSON lines in its order, a fragment each, and a manifest with a line per source.

    Files follow each other by source, table and fragment, so a reader that streams them meets every table in its place. The
    path is replaced as a whole once both are written.
    """
    spark = flat.sparkSession
    order = ["schema", "entry_pos", "table", "fragment"]

    def write(folder: str) -> None:
        fragment_rows(flat).repartitionByRange(*order).sortWithinPartitions(*order).write.json(f"{folder}/fragments")
        _manifest(_fragments(spark, folder)).write.json(f"{folder}/manifest")

    snapshots.replace(spark, path, write)


def _fragments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FRAGMENT_SCHEMA).json(f"{folder}/fragments")


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """The fragments that ``write_fragments`` wrote, each a row."""
    return _fragments(spark, snapshots.latest(spark, path).folder)


def flatten_fragments(fragments: DataFrame) -> DataFrame:
    """The rows that the fragments were made of: one per described object, with its place."""
    own = F.struct(
        F.lit(None).cast("string").alias("column"), F.lit(0).cast("long").alias("ordinal"), "description", "data_type", "entry_pos"
    )
    columns = F.transform(
        "columns", lambda c: F.struct(c["name"].alias("column"), c["ordinal"], c["description"], c["data_type"], c["entry_pos"])
    )
    rows = F.concat(F.when(F.col("described"), F.array(own)).otherwise(F.array()), columns)
    return fragments.select("schema", "table", F.inline(rows))


def missing_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Sources whose fragments aren't those of the manifest, with the counts of both; none if all is there."""
    folder = snapshots.latest(spark, path).folder
    promised = spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/manifest").alias("promised")
    found = _manifest(_fragments(spark, folder)).alias("found")
    both = promised.join(found, F.expr("promised.schema <=> found.schema"), "full")
    counts = ("tables", "columns", "fragments")
    differ = F.struct(*[f"promised.{c}" for c in counts]) != F.struct(*[f"found.{c}" for c in counts])
    name = F.coalesce("promised.schema", "found.schema").alias("schema")
    return both.where(F.coalesce(differ, F.lit(True))).select(
        name, *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in counts for side in ("promised", "found")]
    )


# --------------------------------------------------------------------------- rows stored by source

STORED_SCHEMA = (
    "table string, column string, ordinal long, description string, data_type string, "
    "entry_pos struct<source_pos long, table_pos long>, schema string"
)
#: Up to so many sources are named in the filter of a refresh, so that Spark lists only their folders.
NAMED_SOURCES = 1000


def write_stored(flat: DataFrame, path: str) -> None:
    """Description rows as Parquet, a folder per source; sources that ``path`` holds already are replaced, others stay.

    Rows of a large source are spread over several files. An empty source name is stored as a missing one.
    """
    rows = flat.select("table", "column", "ordinal", "description", "data_type", "entry_pos", "schema")
    writer = rows.hint("rebalance", "schema").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("schema").parquet(path)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def refresh_stored(now: DataFrame, path: str) -> None:
    """Tables in ``now`` replace their rows stored at ``path``; only folders of its sources are read and written.

    The new files are written beside the old ones, which go when the job is committed.
    """
    stored = read_stored(now.sparkSession, path)
    sources = now.select("schema").distinct()
    named = [row["schema"] for row in sources.limit(NAMED_SOURCES + 1).collect()]
    if len(named) <= NAMED_SOURCES:
        wanted = F.col("schema").isin([n for n in named if n is not None])
        stored = stored.where(wanted | F.col("schema").isNull() if None in named else wanted)
    else:
        stored = stored.join(sources, stored["schema"].eqNullSafe(sources["schema"]), "left_semi")
    write_stored(merge_descriptions(stored, now.select(*stored.columns)), path)
