"""Every stage against brute force on what the stage before it kept."""

import numpy as np
import pytest

import corpus_pipeline
from plumbline.llm.common import stored
from plumbline.llm.language_id import learn
from plumbline.llm.queries import held_out
from tests.llm.test_decontaminate import brute as decontaminated
from tests.llm.test_language_id import vector
from tests.llm.test_line_dedup import brute as dedup_lines
from tests.llm.test_near_dedup import brute as near

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def kept_by(name, docs, spark):
    texts = [(d, t) for d, t, *_ in docs]
    if name == "language_id":
        frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
        profiles = learn(frame.where(~held_out("doc_id")))
        keep = []
        for row in docs:
            v = vector(row[1] or "", profiles.vectors.shape[1])
            if v is not None and (profiles.vectors @ v).max() / np.linalg.norm(v) >= corpus_pipeline.LEAST_SCORE:
                keep.append(row)
        return keep
    if name == "line_dedup":
        found = zip(docs, dedup_lines(texts), strict=True)
        return [(d[0], t, d[2], d[3], None if t is None else len(t)) for d, (t, n, gone) in found if not n or gone < n]
    if name == "near_dedup":
        keep = {d for d, _, _, kept in near(texts, 5) if kept}
        return [d for d in docs if d[0] in keep]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {tuple(w[i : i + 5]) for w in (t.lower().split() for _, t in items) for i in range(len(w) - 4)}

    def shares(text):
        w = text.lower().split()
        return any(tuple(w[i : i + 5]) in grams for i in range(len(w) - 4))

    return [d for d in docs if not (shares(d[1]) and decontaminated(d[1], items))]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert docs.columns == COLUMNS
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs = stored(stage(spark, docs, SF_DIR))
        assert docs.columns == COLUMNS
        assert sorted(tuple(r) for r in docs.collect()) == sorted(kept_by(name, before, spark)), name
    words = {r.doc_id: len(r.text.split()) for r in docs.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(words)
    for doc_id, n in words.items():
        assert sum(r.piece_length for r in rows if r.doc_id == doc_id) == n
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(r.doc_id for r in rows)


def test_one_of_each_group_stays(spark):
    body = "some words of a text that stands in this table more than once and so belongs to a group of its own"
    near_body, other = body.replace("some", "a few"), "another text that nobody has copied and that says something else altogether here"
    rows = [(None, body)] * 50 + [(None, f"{body} {body}")] + [(7, near_body)] * 3 + [(8, near_body)] + [(None, other)] * 5
    rows += [(9, "left alone by all of the others since no word of it is anywhere else"), (3, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs.repartition(5), SF_DIR)
    assert got.columns == COLUMNS
    groups = {d: c for d, _, c, _ in near([r for r in rows if r[0] != 8], 5)}
    assert groups[7] == 7
    expected = [(7, near_body), (None, other), rows[-3], rows[-2], rows[-1]]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(expected, key=repr)
    twice = corpus_pipeline.near_dedup(spark, docs.where("doc_id = 9").union(docs.where("doc_id = 9")), SF_DIR)
    assert [r.doc_id for r in twice.collect()] == [9]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (None, "a few words that stand alone here", "en", "s", 1), (3, "", "en", None, 0)]])
def test_nulls_and_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR))
    docs.collect()
