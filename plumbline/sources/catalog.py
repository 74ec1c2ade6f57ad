"""Column catalog: one row per column in table order, struct fields as dotted names."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plumbline.functions.literals import local_rows
from plumbline.sources.tables import open_tables, quoted_name

_LOG = logging.getLogger(__name__)

CATALOG_SCHEMA = "schema string, table string, table_pos long, ordinal long, column string, data_type string"


def column_types(schema: StructType, prefix: str = "") -> Iterator[tuple[str, str]]:
    """Name and type text of each column; structs are followed by their fields, arrays are not."""
    for field in schema:
        name = f"{prefix}{field.name}"
        yield name, field.dataType.simpleString()
        if isinstance(field.dataType, StructType):
            yield from column_types(field.dataType, f"{name}.")


#: Columns up to which a catalog is one literal in the plan, which Catalyst can fold.
LITERAL_COLUMNS = 10_000
_ARROW = pa.schema(
    [("schema", pa.string()), ("table", pa.string()), ("table_pos", pa.int64()), ("ordinal", pa.int64()), ("column", pa.string()), ("data_type", pa.string())]
)


def catalog_of(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], literal_columns: int = LITERAL_COLUMNS) -> DataFrame:
    """The catalog of named DataFrames; reads schemas only.

    Small catalogs are one literal. Beyond ``literal_columns`` rows are handed over as Arrow batches in as many partitions as the
    session has cores, so that no plan and no task holds a large catalog.
    """
    rows = [
        (schema, table, table_pos, ordinal, column, data_type)
        for table_pos, ((schema, table), df) in enumerate(tables.items())
        for ordinal, (column, data_type) in enumerate(column_types(df.schema), start=1)
    ]
    if len(rows) <= literal_columns:
        return local_rows(spark, [dict(zip(_ARROW.names, row, strict=True)) for row in rows], CATALOG_SCHEMA)
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return spark.createDataFrame(pa.table(columns, schema=_ARROW))


def session_tables(spark: SparkSession, schema: str, at_once: int = 8) -> dict[tuple[str, str], DataFrame]:
    """The tables of a schema of the session catalog that can be opened; the reasons of others are logged as warnings."""
    keys = [(schema, t.name) for t in spark.catalog.listTables(schema) if not t.isTemporary]
    opened = open_tables(spark, lambda s, t: spark.table(quoted_name(s, t)), keys, at_once)
    for (_, name), found in opened.items():
        if isinstance(found, str):
            _LOG.warning("skipping %s.%s: %s", schema, name, found)
    return {key: found for key, found in opened.items() if not isinstance(found, str)}
