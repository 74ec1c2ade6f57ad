"""Base spans against a plain search, terms against a plain count."""

import math
import random
import re

from plumbline.llm.pii import KINDS, sanitise, span_list

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, kind in enumerate(KINDS)
        for m in re.finditer(PATTERNS[kind], text or "")
        if passes(kind, m.group())
    ]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


CARD = "4111 1111 1111 1111"
TEXTS = [
    None,
    "",
    "no data",
    "a@b.c d@e.f.g. %x@y.z",
    "x@y.com%z@w.org@q.net",
    "aé@b.c 😀 mail me: é.j@k-l.mn!",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 9.9.9",
    "00000000000000000000001.2.3.4 99999999999999999999.1.1.1",
    f"pay {CARD}, 4111111111111112 or 4111-1111-1111-1111 7",
    "+1 (555) 123-4567 +12 3 +44.20.7946.0958- ++1 23456789012 +1()",
    f"{CARD} {CARD}",
    "+4111 1111 1111 1111",
    "w" * 2_000,
    "1" * 2_000,
    "1 " * 2_000,
    "a@" + "b." * 40_000 + "c",
    "+1" * 5_000 + "(" * 20_000,
    " ".join(f"u{i}@h{i}.org" for i in range(700)),
]


def test_base_spans_equal_a_plain_search(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, spans string, k1 int")
    rows = sanitise(docs).select("doc_id", "k1", span_list("base_spans").alias("base"), *[f"n_{k}" for k in KINDS], "clean_text").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r["base"] == base_spans(TEXTS[r["doc_id"]]), r["doc_id"]
        assert [r[f"n_{k}"] for k in KINDS] == [r["base"].count(k + ":") for k in KINDS]
        assert r["k1"] == 1
    clean = {r["doc_id"]: r["clean_text"] for r in rows}
    assert clean[0] is None and clean[1] == "" and clean[2] == "no data"
    assert clean[3] == "[EMAIL] [EMAIL]. [EMAIL]"
    assert clean[10] == f"{CARD} {CARD}"  # one chain of 32 digits


def test_very_long_texts(spark):
    """A plain search takes time with the square of these lengths; their answers are known."""
    texts = ["w" * 200_000, "1" * 100_000, "1 " * 50_000, "w" * 200_000 + "@b.c", "1" * 100_000 + ".2.3.4", "a@" + "b." * 40_000 + "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r[0]: r[1] for r in sanitise(docs).select("doc_id", span_list("base_spans")).collect()}
    assert found == {0: "", 1: "", 2: "", 3: "email:0:200004", 4: "", 5: "email:0:80003"}


def test_terms_that_reveal_an_entity(spark):
    entity = "ann@x.org"
    texts = [f"the ledger of Zorblax {entity} the {w}" for w in ("red", "blue", "green")] * 2
    texts += [f"the common {w} text" for w in ("one", "two", "three", "four", "five", "six")] * 3
    texts += ["the b@c.de alone", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in sanitise(docs).collect()}
    for i, text in enumerate(texts[:6]):
        terms = [s["value"] for s in rows[i]["spans"] if s["kind"] == "term"]
        n, n_e = len(texts), 6
        share = {
            t: math.log2(n * 6 / (n_e * sum(t in (x or "").lower().split() for x in texts))) / -math.log2(n_e / n)
            for t in ("ledger", "zorblax", "the")
        }
        assert terms == ["ledger", "zorblax"] and share["ledger"] >= 0.9 and share["the"] < 0.6
        assert rows[i]["clean_text"] == text.replace("ledger", "").replace("Zorblax", "").replace(entity, "[EMAIL]")
    assert all(s["kind"] != "term" for i in range(6, len(texts)) for s in rows[i]["spans"])


def test_entities_of_one_text_are_judged(spark):
    texts = ["the ledger of Zorblax ann@x.org", *["the common text with nothing in it"] * 2_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    row = sanitise(docs).where("doc_id = 0").first()
    assert [(s["value"], s["action"]) for s in row["spans"] if s["kind"] == "term"] == [("ledger", "generalise"), ("zorblax", "generalise")]
    assert row["clean_text"] == "the [TERM] of [TERM] [EMAIL]"


def test_all_documents_that_hold_an_entity_count(spark):
    texts = ["the ledger 10.0.0.1"] * 4 + [f"10.0.0.1 {i}" for i in range(60)] + ["the common text"] * 64
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Half of all documents hold the address, so even a term that always stands with it tells one bit. Four meetings of
    # four documents: 16 / 22 of the way from one half to one, 79 % of that bit, not all.
    rows = sanitise(docs).where("doc_id < 64").collect()
    terms = {(r["doc_id"] < 4, s["value"], s["action"]) for r in rows for s in r["spans"] if s["kind"] == "term"}
    assert terms == {(True, "ledger", "generalise")}


def test_terms_far_from_the_entity(spark):
    far = " ".join(["common"] * 100)
    texts = [f"Zorblax {far} ann@x.org Zorblax"] * 3 + [f"ZORBLAX, {far} {far} ann@x.org {w}" for w in ("one", "two")]
    texts += [f"{far} bob@x.org zorblax@y.org"] + [far] * 100
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in sanitise(docs).collect()}
    n, n_e, n_et, n_t = len(texts), 5, 5, 6
    weight = n_et**2 / (n_et**2 + 6)
    share = math.log2((weight * n_et / n_t + (1 - weight) * n_e / n) * n / n_e) / math.log2(n / n_e)
    assert 0.6 <= share < 0.9
    for i in range(5):
        terms = [(s["start"], s["value"], s["action"]) for s in rows[i]["spans"] if s["value"] == "zorblax"]
        assert [t[0] for t in terms] == [m.start() for m in re.finditer("zorblax", texts[i].lower())]
        assert {t[1:] for t in terms} == {("zorblax", "generalise")}
        assert rows[i]["clean_text"].startswith("[TERM]") and "orblax" not in rows[i]["clean_text"]
    assert rows[5]["clean_text"] == f"{far} [EMAIL] [EMAIL]"
    assert all(not rows[i]["spans"] for i in range(6, n))


def plain_terms(texts):
    """Terms and actions of each text by counting every pair."""
    words = [set(re.findall(r"[^\W\d_]{3,}", t.lower())) for t in texts]
    entities = [{m.group().lower() for m in re.finditer(PATTERNS["email"], t)} for t in texts]
    n, out = len(texts), []
    for ws, es in zip(words, entities, strict=True):
        found = {}
        for e in es:
            holds = [e in other for other in entities]
            for w in ws:
                n_e, n_t = sum(holds), sum(w in other for other in words)
                n_et = sum(h and w in other for h, other in zip(holds, words, strict=True))
                weight = n_et**2 / (n_et**2 + 6)
                share = math.log2((weight * n_et / n_t + (1 - weight) * n_e / n) * n / n_e) / -math.log2(n_e / n)
                if share >= 0.6:
                    found[w] = max(found.get(w, ""), "remove" if share >= 0.9 else "generalise")
        out.append(found)
    return out


def test_terms_equal_a_plain_count(spark):
    rng = random.Random(4)
    letters = "bcdfghjklm"
    names = ["".join(rng.choice(letters) for _ in range(5)) for _ in range(150)]
    texts = []
    for _ in range(300):
        body = [names[min(rng.randrange(150), rng.randrange(150))] for _ in range(rng.randrange(1, 12))]
        body += [f"{rng.randrange(12)}@1.2" for _ in range(rng.choice([0, 0, 0, 1, 2, 3]))]
        body += [f"{rng.randrange(10**6)}@3.4" for _ in range(rng.choice([0, 0, 0, 1, 2]))]
        rng.shuffle(body)
        texts += [" ".join(body)] * rng.choice([1, 1, 1, 2, 5])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected, kinds = plain_terms(texts), set()
    for r in sanitise(docs).collect():
        got = {s["value"]: s["action"] for s in r["spans"] if s["kind"] == "term"}
        assert got == expected[r["doc_id"]], r["doc_id"]
        kinds |= set(got.values())
    assert kinds == {"generalise", "remove"}


def test_empty_table(spark):
    assert sanitise(spark.createDataFrame([], "doc_id long, text string")).count() == 0
