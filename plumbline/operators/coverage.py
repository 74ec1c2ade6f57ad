"""Match cataloged tables and columns with their descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import description_prompt
from plumbline.sources.descriptions import latest_descriptions

_TABLE = ["schema", "table"]


def catalog_objects(catalog: DataFrame) -> DataFrame:
    """The columns of a catalog and the tables they belong to; a table has no column and ordinal 0."""
    tables = catalog.select(*_TABLE).distinct()
    return (
        tables.withColumn("column", F.lit(None).cast("string"))
        .withColumn("ordinal", F.lit(0).cast("long"))
        .withColumn("data_type", F.lit(None).cast("string"))
        .unionByName(catalog.select(*_TABLE, "column", "ordinal", "data_type"))
    )


def _same_object(left: DataFrame, right: DataFrame) -> Column:
    return (
        (left["schema"] == right["schema"])
        & (left["table"] == right["table"])
        & left["column"].eqNullSafe(right["column"])
    )


def _has_description(description: Column) -> Column:
    return F.coalesce(description != "", F.lit(False))


def with_descriptions(objects: DataFrame, descriptions: DataFrame, name: str = "description") -> DataFrame:
    """Each object once, with its last description by ``entry_pos``; null where there is none."""
    left, latest = objects.alias("object"), latest_descriptions(descriptions)
    right = latest.select(*_TABLE, "column", F.col("description").alias(name))
    return left.join(right, _same_object(left, right), "left").select("object.*", right[name])


def _documented(descriptions: DataFrame) -> DataFrame:
    """The objects that have a non-empty description, each once."""
    return descriptions.where(_has_description(F.col("description"))).select(*_TABLE, "column").distinct()


def undocumented(objects: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Objects without a non-empty description."""
    documented = _documented(descriptions)
    return objects.join(documented, _same_object(objects, documented), "left_anti")


def coverage(objects: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Per table: objects, documented objects and their ratio.

    Only the keys of the non-empty descriptions take part in the join, never their text.
    """
    documented = _documented(descriptions).withColumn("is_documented", F.lit(True))
    return (
        objects.join(documented, _same_object(objects, documented), "left")
        .groupBy(*(objects[c] for c in _TABLE))
        .agg(F.count(F.lit(1)).alias("objects"), F.count("is_documented").alias("documented"))
        .withColumn("ratio", F.col("documented") / F.col("objects"))
    )


def worklist(objects: DataFrame, descriptions: DataFrame, overwrite: bool | None = None) -> DataFrame:
    """Objects that need a description, each with the prompt that asks for one.

    Existing descriptions are kept unless ``overwrite`` is true.
    """
    needed = objects if overwrite else undocumented(objects, descriptions)
    is_table = F.col("column").isNull()
    item_type = F.when(is_table, F.lit("table")).otherwise(F.lit("column"))
    context = F.when(is_table, F.lit("")).otherwise(F.concat(F.lit("Table: "), F.col("table")))
    prompt = description_prompt(item_type, F.coalesce("column", "table"), context)
    return needed.select(*_TABLE, "column", "ordinal", item_type.alias("item_type"), prompt.alias("prompt"))


def _with_items(counted: DataFrame) -> DataFrame:
    return counted.withColumn("items", F.col("tables") + F.col("columns"))


def count_items(entries: DataFrame) -> DataFrame:
    """Table entries and columns of description documents, counted without unnesting them."""
    size = F.size(F.coalesce("columns", F.array()))
    return _with_items(
        entries.agg(F.count("*").alias("tables"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("columns"))
    )


def count_objects(flat: DataFrame) -> DataFrame:
    """The same of flat rows, whose tables may be of any size: tables with a row of their own or of a column, and columns."""
    by_table = flat.groupBy(*_TABLE).agg(F.count("column").alias("n"))
    return _with_items(by_table.agg(F.count("*").alias("tables"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("columns")))
