"""Null and duplicate counts of columns, each from a single grouped pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegralType,
    MapType,
    StringType,
    StructType,
    TimestampType,
    VariantType,
)

from plumbline.functions.literals import local_rows

NESTED = (ArrayType, MapType, StructType, VariantType)


def _spelled(value: Column, data_type: DataType) -> Column | None:
    """Text of a value that isn't null, equal exactly for equal values; None for types whose equality no text has.

    Parts are counted or preceded by their length, so that no two values run into the same text: ``["a", "b"]`` is
    ``[2:1:a1:b]``. A null is ``~``. Map entries are put in the order of their keys' texts.
    """
    if isinstance(data_type, ArrayType):
        parts = _marked(data_type.elementType)
        return parts and F.concat(F.lit("["), F.size(value).cast("string"), F.lit(":"), F.array_join(F.transform(value, parts), ""), F.lit("]"))
    if isinstance(data_type, StructType):
        fields = [_marked(f.dataType) for f in data_type]
        if None in fields:
            return None
        return F.concat(F.lit("("), *[spell(value.getField(f.name)) for spell, f in zip(fields, data_type, strict=True)], F.lit(")"))
    if isinstance(data_type, MapType):
        key, item = _marked(data_type.keyType), _marked(data_type.valueType)
        if key is None or item is None:
            return None
        entries = F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(key(e["key"]).alias("k"), item(e["value"]).alias("v"))))
        joined = F.array_join(F.transform(entries, lambda e: F.concat(e["k"], e["v"])), "")
        return F.concat(F.lit("{"), F.size(value).cast("string"), F.lit(":"), joined, F.lit("}"))
    if isinstance(data_type, VariantType):
        text = F.to_json(value)  # fields of objects come in the order of their names
    elif isinstance(data_type, BinaryType):
        text = F.hex(value)
    elif isinstance(data_type, (FloatType, DoubleType)):
        text = (value + F.lit(0).cast(data_type)).cast("string")  # takes the sign off a zero
    elif isinstance(data_type, TimestampType):
        text = F.unix_micros(value).cast("string")  # a local time may stand for two instants
    elif isinstance(data_type, StringType) and data_type != StringType():
        return None  # a collation may call different texts equal
    else:
        text = value.cast("string")
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def _marked(data_type: DataType) -> Callable[[Column], Column] | None:
    """A function that spells values of a type, nulls too."""
    if _spelled(F.lit(None).cast(data_type), data_type) is None:
        return None
    return lambda value: F.when(value.isNotNull(), _spelled(value, data_type)).otherwise(F.lit("~"))


def grouping_key(name: str, data_type: DataType) -> Column:
    """A key that is equal exactly when the values are, at most 32 bytes for text, binary and nested values.

    Long values are replaced by their SHA-256 digest, so a shuffle of whole documents moves
    32 bytes per value. Text and binary shorter than a digest stay as they are; the two never meet,
    as only a digest has 32 bytes. Arrays, structs, maps and variants are digested from one canonical text, which also lets
    variants be grouped. Collated strings keep their own notion of equality, also inside nested values.
    """
    value = F.col(f"`{name}`")
    if isinstance(data_type, ArrayType) and isinstance(data_type.elementType, (IntegralType, FractionalType, BooleanType)):
        # JSON keeps nulls, tells every number from every other and writes all NaN alike; adding 0 takes the sign off a zero.
        plain = "x" if isinstance(data_type.elementType, BooleanType) else "x + 0"
        json = f"to_json(struct(transform(`{name}`, x -> {plain}) AS a))"
        return F.expr(f"IF(`{name}` IS NULL, NULL, unhex(sha2({json}, 256)))")
    if isinstance(data_type, NESTED):
        text = _spelled(value, data_type)
        return value if text is None else F.when(value.isNotNull(), F.unhex(F.sha2(text, 256)))
    if data_type not in (StringType(), BinaryType()):
        return value
    as_bytes = f"CAST(`{name}` AS BINARY)"
    return F.expr(f"IF(octet_length(`{name}`) < 32, {as_bytes}, unhex(sha2({as_bytes}, 256)))")


def key_profiles(columns: Sequence[tuple[int, DataFrame, str]]) -> DataFrame:
    """``number, n_rows, nulls, surplus`` of numbered columns, of one table or of several.

    Surplus rows are the non-null rows beyond the first of each value. Each column is grouped by
    its value, so that a hot value is counted before the shuffle and several columns do not
    multiply the rows of one plan as several distinct counts would. One last small exchange adds
    up the groups of all columns; a first group without rows keeps empty tables in.
    """
    spark = columns[0][1].sparkSession
    groups = [local_rows(spark, [{"number": n, "n": 0} for n, _, _ in columns], "number int, is_null boolean, n long")]
    for number, df, name in columns:
        key = grouping_key(name, df.schema[name].dataType)
        counts = df.groupBy(key.alias("value")).agg(F.expr("count(1) AS n"))
        groups.append(counts.selectExpr(f"{number} AS number", "value IS NULL AS is_null", "n"))
    return (
        reduce(DataFrame.union, groups)
        .groupBy("number")
        .agg(
            F.expr("sum(n) AS n_rows"),
            F.expr("coalesce(sum(n) FILTER (WHERE is_null), 0L) AS nulls"),
            F.expr("coalesce(sum(n - 1) FILTER (WHERE NOT is_null), 0L) AS surplus"),
        )
    )
