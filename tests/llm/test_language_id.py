"""Language ID against a plain computation of all vectors, and its accuracy on documents held out."""

import random
import zlib

import numpy as np

from plumbline.llm.language_id import Space, identify_languages, learn
from plumbline.llm.queries import op10_language_id

SF_DIR = "/root/testdata/sf0.01"


def vector(text, dimensions):
    space, total = Space(dimensions), np.zeros(dimensions, np.int64)
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    if not clean.strip():
        return None
    padded = " " + " ".join(clean.split()) + " "
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        x, y, z = (space.letter(ord(k)).astype(np.int64) for k in (a, b, c))
        total += np.roll(x, 2) * np.roll(y, 1) * z
    return total


def test_equals_a_plain_computation(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice([["the", "and", "Of."], ["der", "und", "Für1"]][i % 2]) for _ in range(rng.randrange(1, 30))) for i in range(40)]
    rows = [(i, t, "en" if i % 2 == 0 else "de") for i, t in enumerate(texts)]
    rows += [(90, None, "en"), (91, "", "de"), (92, "12 !? 3", "de"), (93, "the und " * 40_000, None), (94, "日本語 and", "ja")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    profiles = learn(docs, dimensions=256)
    sums = {}
    for _, text, lang in rows:
        v = vector(text or "", 256)
        if lang and v is not None:
            sums[lang] = sums.get(lang, 0) + v
    assert profiles.languages == sorted(sums)
    got = {r.doc_id: r for r in identify_languages(docs, profiles).collect()}
    for i, text, _ in rows:
        v = vector(text or "", 256)
        if v is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cosines = {lang: v @ s / np.linalg.norm(v) / np.linalg.norm(s) for lang, s in sums.items()}
        best = max(cosines, key=lambda k: cosines[k])
        assert got[i].lang_pred == best and abs(got[i].score - min(1, max(0, cosines[best]))) < 1e-9


def test_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify_languages(docs, learn(docs)).collect()} == {"und"}
    assert identify_languages(docs.limit(0), learn(docs)).count() == 0


def test_accuracy_on_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op10_language_id(spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
