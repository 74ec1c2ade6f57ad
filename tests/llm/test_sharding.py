"""Shards against a running sum over sorted rows."""

import random

from plumbline.llm.queries import op3_byte_range_shards
from plumbline.llm.sharding import assign_shards


def brute(sizes, n):
    total, before, out, slots = sum(sizes), 0, [], {}
    for s in sizes:
        shard = min(n - 1, before * n // max(total, 1))
        out.append((shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        before += s
    return out


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, 5, 1000, None]), "x", 1) for i in range(500)]
    rng.shuffle(rows)
    got = assign_shards(spark.createDataFrame(rows, "id long, size long, shard string, tie int"), 8, "size", ["id"]).collect()
    expected = brute([s or 0 for _, s, *_ in sorted(rows, key=lambda r: r[0])], 8)
    assert [(r.shard, r.slot) for r in sorted(got, key=lambda r: r.id)] == expected
    assert all(r.tie == 1 for r in got)


def test_ties_nulls_and_repeated_rows(spark):
    rows = [(None, 10)] * 300 + [(5, 10)] * 300 + [(i, 0) for i in range(5)]
    got = assign_shards(spark.createDataFrame(rows, "id long, size long"), 4, "size", ["id"]).collect()
    assert len(got) == len(rows)
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
        assert abs(sum(r["size"] for r in got if r.shard == shard) - 1500) <= 10
    assert {r.shard for r in got if r.id is None} == {0, 1}
    zero = assign_shards(spark.createDataFrame([(i, 0) for i in range(9)], "id long, size long"), 4, "size", ["id"]).collect()
    assert {r.shard for r in zero} == {0}


def test_empty_table(spark):
    assert assign_shards(spark.createDataFrame([], "id long, size long"), 4, "size", ["id"]).count() == 0


def test_query(spark):
    docs = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = sorted(op3_byte_range_shards(spark, "/root/testdata/sf0.001").collect())
    sizes = [len((t or "").encode()) + 1 for _, t in docs]
    assert [r["size"] for r in got] == sizes
    assert [(r.shard, r.slot) for r in got] == brute(sizes, 8)
