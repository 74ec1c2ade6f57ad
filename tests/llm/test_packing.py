"""Packing: every piece once, no bin over its capacity, little room left, and each step as stated."""

import random
from collections import defaultdict

from plumbline.llm.packing import CAPACITIES, SEQUENCE_PRICE, pack, pack_documents
from plumbline.llm.queries import op7_best_fit_packing


def plain(lengths, capacities, price):
    """Best fit by looking at every bin."""
    sizes, bins, places = sorted(capacities), [], {}
    worth, still = min((c + price) / c for c in sizes), sum(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        still -= need
        open_ = [(b[0] - b[1], k) for k, b in enumerate(bins) if b[0] - b[1] >= need]
        if open_:
            k = min(open_)[1]
        else:
            k = len(bins)
            bins.append([min((c for c in sizes if c >= need), key=lambda c: (c + price - worth * min(c - need, still), c)), 0])
        places[i] = (k, bins[k][1])
        bins[k][1] += need
    return [places[i] for i in range(len(lengths))], [min(c for c in sizes if c >= used) for _, used in bins]


def test_equals_a_plain_best_fit():
    rng = random.Random(2)
    for _ in range(200):
        capacities = rng.sample([8, 16, 32, 64, 100], rng.randrange(1, 5))
        lengths = [rng.randrange(1, max(capacities) + 1) for _ in range(rng.randrange(40))]
        assert pack(lengths, capacities, rng_price := rng.choice([0, 1, 16])) == plain(lengths, capacities, rng_price)


def test_bins_are_cut_down_and_sizes_mixed():
    assert pack([5], [8, 64], 4) == ([(0, 0)], [8])
    assert pack([60, 30, 3], [8, 64], 4)[1] == [64, 64]


def test_documents(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 1, 7, 90, 256, 2048, 2049, 5000, None, -4]), "x") for i in range(400)] + [(7, 100, "x")] * 3 + [(None, 50, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, n long, bin_id string").repartition(3)
    got = pack_documents(docs, "n").collect()
    used, capacity, pieces = defaultdict(list), {}, defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        if r.bin_id is None:
            assert r.piece_length == 0 and r.bin_capacity is None
            continue
        used[r.bin_id].append((r.bin_offset, r.piece_length))
        assert capacity.setdefault(r.bin_id, r.bin_capacity) == r.bin_capacity
    for b, parts in used.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity[b] and not any(at <= c < capacity[b] for c in (256, 512, 1024, 2048))
    for doc_id, n, _ in rows[:400]:
        if doc_id != 7:
            parts = sorted(pieces[doc_id], key=lambda r: r.piece)
            assert sum(r.piece_length for r in parts) == max(0, n or 0)
            assert [r.piece_start for r in parts] == [2048 * k for k in range(len(parts))]
    assert len([r for r in got if r.doc_id == 7]) >= 4
    assert sum(sum(p for _, p in v) for v in used.values()) / sum(capacity.values()) > 0.95


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, n long"), "n").count() == 0


def test_query_equals_a_plain_best_fit(spark):
    """One file is one block, so all pieces of the table are packed together."""
    sf_dir = "/root/testdata/sf0.001"
    sizes = [(r.doc_id, len((r.text or "").split())) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    top = max(CAPACITIES)
    pieces = [(i, k, min(top, n - at)) for i, n in sizes for k, at in enumerate(range(0, n, top))]
    places, capacity = plain([n for _, _, n in pieces], CAPACITIES, SEQUENCE_PRICE)
    expected = {(i, k): (n, capacity[b], offset, b) for (i, k, n), (b, offset) in zip(pieces, places, strict=True)}
    got = {(r.doc_id, r.piece): r for r in op7_best_fit_packing(spark, sf_dir).collect()}
    assert {k: (r.piece_length, r.bin_capacity, r.bin_offset) for k, r in got.items() if r.bin_id} == {k: v[:3] for k, v in expected.items()}
    assert len({(got[k].bin_id, v[3]) for k, v in expected.items()}) == len(capacity) == len({r.bin_id for r in got.values() if r.bin_id})
    assert sorted(i for (i, _), r in got.items() if not r.bin_id) == sorted(i for i, n in sizes if not n)
