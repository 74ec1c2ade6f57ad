"""Decontamination against comparing every item with every window."""

import random
from collections import Counter

from plumbline.llm.decontaminate import decontaminate


def shingles(words, n):
    s = min(5, n)
    return Counter(tuple(words[i : i + s]) for i in range(len(words) - s + 1))


def brute(text, items):
    words, found = (text or "").lower().split(), {}
    for item_id, item in items:
        target = (item or "").lower().split()
        n = len(target)
        if not n:
            continue
        b = shingles(target, n)
        size = min(n, len(words))
        for i in range(len(words) - size + 1):
            a = shingles(words[i : i + size], n)
            both, every = sum((a & b).values()), sum((a | b).values())
            if every and both * 100 >= every * 80:
                found[item_id] = max(found.get(item_id, 0), both / every)
    return found


def test_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 12, 20, 30, 41, 60])]
    items[0] = (0, "unheard")
    items += [(50, items[8][1].upper()), (51, None), (52, " "), (53, "a a a a a a a a a a a a")]
    docs = []
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        if i % 2:
            part = (items[rng.randrange(len(items))][1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if part:
                    part[rng.choice([0, -1, rng.randrange(len(part))])] = "other"
            if rng.random() < 0.2:
                part = part[rng.randrange(3) :]
            at = rng.choice([0, len(words), rng.randrange(len(words) + 1)])
            words[at:at] = part
        docs.append((i, "  ".join(words)))
    docs += [(500, None), (501, ""), (502, "a " * 12), (503, "a " * 15), (None, items[9][1]), (505, "x " * 30_000 + items[8][1])]
    docs += [docs[1], docs[3]]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, words int")
    got = decontaminate(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    texts = {}
    for d in docs:
        texts.setdefault(d[0], d[1])
    held = 0
    for r in got:
        expected = brute(texts[r.doc_id], items) if r.doc_id != 505 else {8: 1.0, 50: 1.0}
        assert r["items"] == sorted(expected), (r, expected)
        assert r.contaminated == bool(expected) and r.words == 1
        assert r.similarity == (max(expected.values()) if expected else None)
        held += r.contaminated
    assert held > 30


def test_items_without_id(spark):
    alone, shared = "an item that has no id of its own", "an item once with and once without an id"
    items = spark.createDataFrame([(None, alone), (None, shared), (4, shared)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {alone} too"), (2, shared), (3, f"{alone} {shared}"), (4, "nothing")], "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r["items"], r.similarity) for r in decontaminate(docs, items).collect()}
    assert got == {1: (True, [], 1.0), 2: (True, [4], 1.0), 3: (True, [4], 1.0), 4: (False, [], None)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text of a document here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some text of a document here")], "item_id long, text string")
    assert [r.contaminated for r in decontaminate(docs, items.limit(0)).collect()] == [False]
    assert decontaminate(docs.limit(0), items).count() == 0
