"""Near duplicates against comparing every document with every other."""

import random

import pytest

from plumbline.llm.components import connected_components
from plumbline.llm.near_dedup import near_duplicates


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def brute(docs, size):
    sets = [sets_of(t, size) for _, t in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    out = []
    for i, (d, _) in enumerate(docs):
        component = least.get(root(i)) if sets[i] else d
        out.append((d, len(sets[i]), component, not sets[i] or (d is not None and d == component)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "ZZ", "zz"]
    docs = []
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 6, 20, 40, 80]))]
        for _ in range(rng.randrange(1, 9)):  # chains: each a little further from the first
            docs.append(" ".join(words) if rng.random() < 0.8 else "\t\n".join(words).upper())
            for _ in range(rng.choice([0, 1, 2])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
    docs += [None, "", "  \n", "same", "SAME ", "a b", "a b a b a b", "x y", "x y"]
    rows = list(enumerate(docs, 100))
    rng.shuffle(rows)
    return rows + [rows[0], (None, docs[3]), (None, "without id"), (None, None), (3, "long " * 50_000 + "text")]


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, size):
    docs = corpus()
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, k1 string, n int")
    got = near_duplicates(frame, shingle=size).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == brute(docs, size)
    assert {(r.k1, r.n) for r in got} == {("x", 1)}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    rng.shuffle(edges)
    group = {}

    def root(i):
        while group.setdefault(i, i) != i:
            i = group[i]
        return i

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        group[high] = low
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for e in edges if e[0] != e[1] for i in e}


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
