"""Helpers that several operators share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts name it.
SPACES = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below the session's checkpoint folder, else below its warehouse.

    A warehouse on a host's own disk is shared by nobody, so off a local master that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        one_host = re.match(r"local(\[|$)", spark.sparkContext.master)
        if not one_host and re.match(r"file:|/", base):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/plumbline-llm-{uuid.uuid4()}"


_written: list[list[str]] = []


@contextmanager
def dropping_stored(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what operators have stored within it; read their results before that."""
    _written.append([])
    try:
        yield
    finally:
        for folder in _written.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """The rows written to a shared folder and read from there, which cuts the lineage and fixes what was drawn at random."""
    path = shared_folder(df.sparkSession)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text, as two longs ``k1`` and ``k2``."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


#: Most bytes of texts that a Python worker is handed at once.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's bytes per Arrow batch, so that a worker's memory doesn't grow with the length of texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    known = (spark.conf.get(name, None) or "").rstrip("bB")
    if not known.isdigit() or int(known) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Most bytes of keys that are sent to every executor.
BROADCAST_BYTES = 64 << 20


def hinted(keys: DataFrame, n_bytes: int) -> DataFrame:
    """``keys`` to be broadcast if their measured size is within the bound and the session allows broadcasts.

    Otherwise as they are: the join then goes by a shuffle.
    """
    threshold = str(keys.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return F.broadcast(keys) if not threshold.startswith("-") and n_bytes <= BROADCAST_BYTES else keys
