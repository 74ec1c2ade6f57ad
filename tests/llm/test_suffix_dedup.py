"""Suffix dedup against looking up every string."""

import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as spark_entry
from plumbline.llm import suffix_dedup
from plumbline.llm.suffix_dedup import remove_repeats
from plumbline.llm.suffix_sort import blind_trie_order, deep_shallow_order, neighbours_prefix


def brute(texts, size):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + size] for d in datas for i in range(len(d) - size + 1))
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - size + 1):
            if seen[d[i : i + size]] > 1:
                gone[i : i + size] = True
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((kept, len(d), len(d) - len(kept), int((np.diff(gone.astype(int), prepend=0) == 1).sum())))
    return out


def corpus(rng, size):
    letters = "ab é"
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([size - 1, size, size + 1, 2 * size, 4 * size]))) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2 * size))))
            parts.append(rng.choice(passages)[rng.randrange(3) :])
        texts.append("".join(parts))
    texts += [None, "", "x" * (3 * size), "x" * size, "yz" * (2 * size), texts[3], texts[3], texts[4] + "!"]
    return texts


@pytest.mark.parametrize(("size", "large"), [(12, 2000), (40, 2000), (12, 2), (40, 1)])
def test_equals_brute_force(spark, size, large, monkeypatch):
    texts = corpus(random.Random(size), size)
    frame = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, at int")
    got = {r.doc_id: r for r in remove_repeats(frame, min_bytes=size, large_class=large).collect()}
    for i, expected in enumerate(brute(texts, size)):
        r = got[i]
        assert (bytes(r.kept_bytes), r.n_bytes, r.n_removed, r.n_spans) == expected, i
        assert r.at == 7


def test_chunks_and_pools(monkeypatch):
    """Long texts in small chunks give the same anchors."""
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = [b for rows in suffix_dedup.Anchors(40).blocks([text]) for b in rows]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    cut = [b for rows in suffix_dedup.Anchors(40).blocks([text]) for b in rows]

    def anchors(blocks):
        return {(start + k, start + left, h) for _, h, _, start, left, many in blocks for k in range(many)}

    assert anchors(whole) == anchors(cut) and len(anchors(whole)) == 5000 - 39


def test_production_length(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("etaoins") for _ in range(rng.randrange(1, 9)))
    passage = " ".join(word() for _ in range(150))
    texts = [" ".join(word() for _ in range(rng.randrange(300))) for _ in range(12)]
    texts += [f"{t} {passage[k:]} {t[:50]}" for k, t in enumerate(texts)] + [passage, passage[:399], passage[200:600]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeats(frame).collect()}
    for i, expected in enumerate(brute(texts, 400)):
        assert (bytes(got[i].kept_bytes), *got[i][3:]) == expected


def test_planted_passages_go_from_400_bytes_on(spark, tmp_path):
    """Passages of over 50 words, by the query: bytes decide, words don't, and ``n_bytes`` is the input's length."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("etaoins") for _ in range(n))
    texts, lost = [], []
    for n_bytes in (310, 399, 400, 600):
        passage = " ".join(word(5) for _ in range(n_bytes // 6 + 1))[:n_bytes]
        assert len(passage) == n_bytes and len(passage.split()) > 50
        for i in range(3):  # other bytes on both sides of each copy
            texts.append(f"{word(rng.randrange(200))}{i}{passage}{i}{word(rng.randrange(200))}")
            lost.append(n_bytes if n_bytes >= 400 else 0)
    texts.append(word(900))
    lost.append(0)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(spark_entry.queries()["op8_suffix_dedup"](spark, str(tmp_path)).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans) for r in got] == [
        (len(t), n, int(n > 0)) for t, n in zip(texts, lost, strict=True)
    ]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sorting():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (400, 24), np.uint8)
    rows[100:300, :16] = rows[0, :16]
    rows[50:60] = rows[50]
    classes = rng.integers(0, 4, 400)
    expected = sorted(range(400), key=lambda i: (classes[i], rows[i].tobytes()))
    for shallow in (8, 16, 24, 99):
        order = deep_shallow_order(rows, classes, shallow)
        assert [(classes[i], rows[i].tobytes()) for i in order] == [(classes[i], rows[i].tobytes()) for i in expected]
    prefix = neighbours_prefix(rows, classes, order)
    for j in range(1, 400):
        a, b = rows[order[j - 1]], rows[order[j]]
        same = next((k for k in range(24) if a[k] != b[k]), 24)
        assert prefix[j] == (same if classes[order[j]] == classes[order[j - 1]] else -1)
    strings = [r.tobytes() for r in rows]
    assert [strings[i] for i in blind_trie_order(strings)] == sorted(strings)
    assert len(deep_shallow_order(rows[:0], classes[:0], 8)) == 0
