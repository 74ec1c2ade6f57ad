"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import ranked_search
from plumbline.llm.ranked_search import Postings, best_of_shard, build_index, packed_lists, query_terms, search, search_documents, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            n, score = c.total(), 0
            m = 25 + (75 * n * n_docs) // n_terms
            for t in words(text):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, n, i, -s) for n, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_terms():
    for text in ("", "a-b_C9", "Ünï ÀB\x00c", "日本語 x y", "A" * 200, "\x7f~`z"):
        assert [t.decode() for t in terms_of(text.encode()) if t[0] != 32] == [t for t in words(text) if len(t) <= 64]
    long = terms_of(b"x" * 10_000_000 + b" y")
    assert len(long) == 2 and long[0].startswith(b" ") and long[0] == terms_of(b"X" * 10_000_000)[0]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SHARD_TERMS", 3000), ("BLOCK", 4), ("WINDOW", 16), ("QUERY_BLOCK", 7)):
        monkeypatch.setattr(ranked_search, name, value)


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 60)))) for i in range(n)]
    docs += [(None, "w1 W2-w3"), (n, None), (n + 1, ""), (n + 2, "?!"), (3, "w1 w2 w3 w59"), (3, "w1 w2 w3 w59"), (n + 3, "é" * 9 + " w5")]
    docs += [(1000 + i, "w7 w8 w9") for i in range(40)]  # ties
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 12)))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "none of these"), (53, "w9 W9 w8"), (53, "w9 W9 w8"), (None, "w9 w7"), (54, "é" * 9)]
    return docs, items


def test_equals_brute_force(spark, small, monkeypatch):
    docs, items = corpus(random.Random(3), 400)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, term string").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    expected = brute(docs, items, 10)
    assert got(search_documents(d, q)) == expected
    monkeypatch.setattr(ranked_search, "FILTER_BYTES", 0)  # the whole vocabulary is indexed
    assert got(search_documents(d, q)) == expected


def test_index_is_searched_again_and_takes_other_ids(spark, small):
    docs = [(f"d{i}", t) for i, t in corpus(random.Random(4), 100)[0]]
    index = build_index(spark.createDataFrame(docs, "doc_id string, text string"))
    for text in ("w1 w30", "w59"):
        items = spark.createDataFrame([(0, text)], "item_id long, text string")
        found = search(index, query_terms(items), 5).select("rank", "doc_id", "score")
        assert got(found) == sorted((n, i, s) for _, n, i, s in brute(docs, [(0, text)], 5))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search_documents(docs.limit(0), items).count() == 0
    assert search_documents(docs, items.limit(0)).count() == 0
    assert search_documents(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_lists_survive_packing_and_blocks_stay_packed(small):
    """Every posting comes back; a rare strong term leaves most blocks of a frequent one packed."""
    rng = np.random.default_rng(5)
    n = 2000
    sizes = rng.integers(50, 70_000, n)
    frequent, rare = np.arange(0, n, 2), np.array([700, 702])
    tfs = np.concatenate([np.where(frequent == 704, 70_000, 1), [3, 300]])
    terms, places = np.repeat([0, 1], [len(frequent), 2]), np.concatenate([frequent, rare])
    lists = []
    for number, n_docs, heads, fronts, payload in packed_lists(terms, places, tfs, sizes):
        lists.append(Postings(heads, fronts, payload, sizes, n, int(sizes.sum())))
        unpacked = [lists[-1].block(i) for i in range(len(lists[-1].heads))]
        assert np.concatenate([p for p, _ in unpacked]).tolist() == places[terms == number].tolist()
        impact = ranked_search.impacts(tfs[terms == number], sizes[places[terms == number]], n, int(sizes.sum()))
        assert np.concatenate([i for _, i in unpacked]).tolist() == impact.tolist()
        assert [int(i.max()) for _, i in unpacked] == lists[-1].top.tolist()
        assert n_docs == (terms == number).sum()
        lists[-1].unpacked.clear()
    weighted = [(lists[0], 1), (lists[1], 1000)]
    found, scores = best_of_shard(weighted, [p.window_tops(-(-n // 16)) for p in lists], n, 2)
    assert found.tolist() == [702, 700] and scores[0] > scores[1]
    assert 0 < len(lists[0].unpacked) < 12 < len(lists[0].heads)
