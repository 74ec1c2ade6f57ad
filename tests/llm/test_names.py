"""Operators on tables whose columns have the names that operators use themselves."""

from pyspark.sql import functions as F

from plumbline.llm import cross_tokens, decontaminate, html_text, language_id, line_dedup, near_dedup, packing, pii, queries, ranked_search, sharding, suffix_dedup, token_counts

ODD = ["row", "kept", "k1", "k2", "__key", "__found", "piece", "body", "f", "found", "row_key", "base", "term", "pair", "place", "raw", "h", "component", "score", "n"]
TEXTS = ["One line that is long enough.\nTwo lines.", "One line that is long enough.\nThree lines, of which one is new.", None, "", "Zwei Zeilen und nichts weiter."]


def table(spark, text="text"):
    rows = spark.createDataFrame([(i, t, "en" if i < 2 else "de") for i, t in enumerate(TEXTS)], f"doc_id long, {text} string, lang string")
    return rows.select("*", *[F.lit(f"own {c}").alias(c) for c in ODD])


def operators(spark):
    items = table(spark).withColumnRenamed("doc_id", "item_id")
    return {
        "decontaminate": lambda d: decontaminate.decontaminate(d, items.select("item_id", "text")),
        "line_dedup": line_dedup.dedup_lines,
        "sharding": lambda d: sharding.assign_shards(d.withColumn("size", F.lit(1).cast("long")), 2, size="size", order=["doc_id"]),
        "pii": pii.sanitise,
        "near_dedup": near_dedup.near_duplicates,
        "suffix_dedup": suffix_dedup.remove_repeats,
        "token_counts": lambda d: token_counts.count_tokens(d, [("<unk>", 0.0), ("▁", -1.0), ("e", -1.0)]),
        "language_id": lambda d: language_id.identify_languages(d, language_id.learn(table(spark))),
        "html_text": lambda d: html_text.extract_text(d.withColumn("html", F.col("text"))),
    }


def test_columns_of_any_name_stay(spark):
    replaced = {"near_dedup": {"kept"}, "language_id": {"score"}}
    for name, operator in operators(spark).items():
        rows = operator(table(spark)).collect()
        assert len(rows) == len(TEXTS), name
        for c in set(ODD) - replaced.get(name, set()):
            assert {r[c] for r in rows} == {f"own {c}"}, (name, c)


def test_operators_with_their_own_columns(spark):
    docs = table(spark)
    items = docs.withColumnRenamed("doc_id", "item_id")
    assert ranked_search.search_documents(docs, items, 1).count() == 3
    assert cross_tokens.align_tokens(docs, queries.BYTE_LEVEL, queries.PIECES).where("n_links > 0").count() == 3
    packed = packing.pack_documents(docs.withColumn("piece", F.lit(7)), "doc_id", keys=["doc_id", "piece", "row"])
    assert packed.columns[:4] == ["doc_id", "key_piece", "row", "piece"] and {r.key_piece for r in packed.collect()} == {7}


def test_text_is_found_by_the_case_rule(spark):
    found = line_dedup.dedup_lines(table(spark, "Text")).orderBy("doc_id").collect()
    assert found[1].Text == "Three lines, of which one is new." and found[1].n_removed == 1
    again = language_id.identify_languages(table(spark, "TEXT"), language_id.learn(table(spark)))
    assert [r.lang_pred for r in again.orderBy("doc_id").collect()] == ["en", "en", "und", "und", "de"]
