"""Refresh a description document from a catalog and returned descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import clean_description
from plumbline.operators.coverage import catalog_objects, with_descriptions
from plumbline.operators.merge import join_tables, merge_descriptions
from plumbline.sources.descriptions import entry_pos

DESCRIPTION_COLUMNS = ["schema", "table", "column", "ordinal", "description", "data_type", "entry_pos"]
_TABLE = ["schema", "table"]
#: Places of new entries begin here: after all that a document has.
NEW = 1 << 40


def _places(catalog: DataFrame, stored: DataFrame) -> DataFrame:
    """Where the cataloged tables stand: at their first place, else in catalog order after all others of their source."""
    tables = catalog.groupBy(*_TABLE).agg(F.min("table_pos").alias("table_pos"))
    known = stored.groupBy(*_TABLE).agg(F.min("entry_pos").alias("known_pos"))
    new = entry_pos(F.lit(NEW), F.col("table_pos"))
    return tables.join(known, _TABLE, "left").select(*_TABLE, F.coalesce("known_pos", new).alias("entry_pos"))


def refresh_documentation(
    catalog: DataFrame, stored: DataFrame, answers: DataFrame, overwrite: bool | None = None
) -> DataFrame:
    """The stored rows with every cataloged table rebuilt, each at its place in the document.

    ``answers`` holds raw returned text by ``schema, table, column``, the last by ``entry_pos`` counting. An object takes its
    cleaned answer when it has no description yet, or always with ``overwrite``; columns that a table no longer has vanish
    with its old entry. Of several stored descriptions of an object the last counts.
    """
    objects = join_tables(catalog_objects(catalog), _places(catalog, stored), "inner")
    objects = with_descriptions(objects, stored, "existing")
    objects = with_descriptions(objects, answers, "answer")
    kept = F.when(F.col("existing") != "", F.col("existing"))
    answer = F.when(F.col("answer").isNotNull(), clean_description(F.col("answer")))
    order = (answer, F.col("existing")) if overwrite else (kept, answer, F.col("existing"))
    described = objects.withColumn("description", F.coalesce(*order))
    return merge_descriptions(
        stored.select(*DESCRIPTION_COLUMNS), described.select(*DESCRIPTION_COLUMNS), replaced=catalog
    )
