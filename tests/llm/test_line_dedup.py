"""Line dedup against comparing every line with every other."""

import random

from plumbline.llm.line_dedup import BLANKS, dedup_lines, variant_hashes


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(a[i + 1 if len(a) == len(b) else i :] == b[i + 1 :] and a[:i] == b[:i] for i in range(len(b)))


def brute(docs):
    lines = []
    for i, (doc_id, text) in enumerate(docs):
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(BLANKS):
                lines.append(((doc_id is None, doc_id or 0, k), i, k, line.strip(BLANKS)))
    gone = {
        (i, k)
        for place, i, k, line in lines
        if any(
            other < place and (line == o or (len(line) >= 20 and len(o) >= 20 and within_one(line, o)))
            for other, _, _, o in lines
        )
    }
    out = []
    for i, (_, text) in enumerate(docs):
        parts = None if text is None else [line for k, line in enumerate(text.split("\n")) if (i, k) not in gone]
        out.append((None if parts is None else "\n".join(parts), sum(x[1] == i for x in lines), sum(g[0] == i for g in gone)))
    return out


def edited(rng, line):
    i = rng.randrange(len(line) + 1)
    return rng.choice([line[:i] + "ж" + line[i:], line[:i] + line[i + 1 :], line[:i] + "q" + line[i + 1 :], line])


def test_equals_brute_force(spark):
    rng = random.Random(3)
    pool = ["".join(rng.choice("ab é") for _ in range(rng.choice([1, 5, 18, 19, 20, 21, 22, 40]))) for _ in range(40)]
    docs = []
    for i in range(120):
        lines = [rng.choice(pool) for _ in range(rng.randrange(6))]
        for _ in range(rng.randrange(3)):
            lines = [edited(rng, line) if line and rng.random() < 0.3 else line for line in lines]
        docs.append((i * 3 if i % 7 else i * 3 + 1, rng.choice(["\n", "\n\n"]).join(lines)))
    docs += [(1000, None), (1001, ""), (1002, "  \n\t"), (1003, " " + pool[0] + "\r\n" + pool[0]), (None, "only in a row without id, once")]
    docs.append((2000, "x" * 30_000 + "\n" + "x" * 29_999 + "y"))
    rows = [(d, t, "clash", "n") for d, t in docs]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, line string, n_lines string")).collect()
    assert sorted(((r.doc_id or -1, r.text, r.n_lines, r.n_removed) for r in got), key=repr) == sorted(
        ((d or -1, *o) for (d, _), o in zip(docs, brute(docs), strict=True)), key=repr
    )
    assert all(r.line == "clash" for r in got)


def test_repeated_rows_keep_the_same_lines(spark):
    docs = [(1, "first line of text\nsecond"), (1, "first line of text\nsecond"), (2, "second\nthird")]
    rows = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.text for r in rows) == ["first line of text\nsecond", "first line of text\nsecond", "third"]


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_variant_hashes():
    hashes, whole = variant_hashes("abcde")
    for i in range(5):
        short = "abcde"[:i] + "abcde"[i + 1 :]
        assert variant_hashes(short)[1] == hashes[i]
    assert variant_hashes("abcde")[1] == whole and len(set(hashes.tolist())) == 5


def test_without_broadcasts(spark):
    """Where a session turns broadcasts off, the joins are shuffled and give the same."""
    docs = spark.createDataFrame([(i, f"a line that many share\nline number {i} of them all\n{'x' * 30}{i % 3}") for i in range(30)], "doc_id long, text string")
    before = sorted(dedup_lines(docs).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(dedup_lines(docs).collect()) == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r.n_removed for r in before) == 29 + 29 + 29
