"""Best-fit packing of documents into sequences of several permitted lengths.

Each task packs the documents that it reads, longest first, block by block, so nothing is shuffled and memory is
bounded. A piece goes into the open bin that it fills best. If none has room, a bin is opened at the permitted length
of least cost: the length plus a fixed price per sequence, less what the free room is worth to the pieces still to
come. At the end each bin is cut down to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CAPACITIES = (256, 512, 1024, 2048)
SEQUENCE_PRICE = 16
BLOCK_ROWS = 100_000
ADDED = "piece int, piece_start long, piece_length long, bin_id string, bin_capacity long, bin_offset long"


def pack(lengths: Sequence[int], capacities: Sequence[int], price: float) -> tuple[list[tuple[int, int]], list[int]]:
    """Bin number and offset of each length, and each bin's capacity. No length may exceed the largest capacity."""
    sizes = sorted(capacities)
    worth = min((c + price) / c for c in sizes)  # the least price of room for one token
    still = sum(lengths)
    places: list[tuple[int, int]] = [(-1, -1)] * len(lengths)
    room: list[tuple[int, int]] = []  # free room and bin, in order
    used: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        still -= need
        at = bisect_left(room, (need, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fitting = [c for c in sizes if c >= need]
            free = min(fitting, key=lambda c: (c + price - worth * min(c - need, still), c))
            b = len(used)
            used.append(0)
        places[i] = (b, used[b])
        used[b] += need
        if free > need:
            insort(room, (free - need, b))
    return places, [sizes[bisect_left(sizes, u)] for u in used]


def pack_documents(
    docs: DataFrame, length: str, capacities: Sequence[int] = CAPACITIES, price: float = SEQUENCE_PRICE, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per piece of a document: ``keys``, piece, its start and length, and its bin, capacity and offset there.

    ``length`` names a column with the documents' lengths; null, 0 and less count as 0. A document longer than the
    largest capacity is cut into pieces of that capacity and a rest. A document of length 0 has one piece of length 0
    without a bin. Rows with equal keys are packed each; of equal lengths the row read first is placed first. Other
    columns of ``docs`` are not carried. A key with the name of an added column comes back as ``key_`` and that name. An empty
    table gives no rows.
    """
    sizes = sorted(set(capacities))
    if not sizes or sizes[0] < 1:
        raise ValueError("capacities must be positive")
    top = sizes[-1]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, n = 0, [], 0
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        for batch in batches:
            # Columns: the keys and the length. Very long batches are cut, so that a block stays bounded.
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                cut = batch.slice(at, BLOCK_ROWS)
                rows.append(cut)
                n += cut.num_rows
                if n >= BLOCK_ROWS:
                    yield of_block(rows, f"{part}-{block}")
                    block, rows, n = block + 1, [], 0
        if rows:
            yield of_block(rows, f"{part}-{block}")

    def of_block(rows: list[pa.RecordBatch], name: str) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        source, piece, start, size = [], [], [], []
        for i, total in enumerate(table.column(table.num_columns - 1).to_pylist()):
            for k, s in enumerate(range(0, total, top) if total > 0 else [0]):
                source.append(i)
                piece.append(k)
                start.append(s)
                size.append(max(0, min(top, total - s)))
        filled = [i for i, s in enumerate(size) if s]
        places, capacity = pack([size[i] for i in filled], sizes, price)
        bins: list[tuple[str | None, int | None, int | None]] = [(None, None, None)] * len(size)
        for i, (b, offset) in zip(filled, places, strict=True):
            bins[i] = (f"{name}-{b}", capacity[b], offset)
        taken = table.select(range(table.num_columns - 1)).take(pa.array(source, pa.int64()))
        added = [
            pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
            *[pa.array([b[k] for b in bins], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))],
        ]
        names = [f.name for f in fields]
        return pa.Table.from_arrays([*taken.columns, *added], names).combine_chunks().to_batches()[0]

    added_fields = StructType.fromDDL(ADDED).fields
    taken_names = {f.name for f in added_fields}
    narrow = docs.select(*[F.col(f"`{k}`").alias(f"key_{k}" if k.lower() in taken_names else k) for k in keys])
    fields = narrow.schema.fields + added_fields
    measured = docs.select(*[F.col(f"`{k}`") for k in keys], F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)))
    return measured.toDF(*[f"c{i}" for i in range(len(keys) + 1)]).mapInArrow(packed, StructType(fields))
