"""

Each query reads whole tables of ``sf_dir``. Queries about catalogs and description documents
derive these from the tables, so that they grow with the data: a conversation is a documented
table with its turns as columns, and a document is a column of the table of its source and language.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.ages import Clock
from plumbline.functions.names import (
    is_excluded,
    is_valid_name,
    passes_freshness_gate,
    split_patterns,
    suggests_completeness,
    suggests_freshness,
)
from plumbline.functions.text import clean_description as clean
from plumbline.operators.checks import completeness, freshness, uniqueness
from plumbline.operators.coverage import catalog_objects, count_items, count_objects, coverage, worklist
from plumbline.operators.merge import merge_descriptions, publishable
from plumbline.operators.report import report_summary as summarize
from plumbline.operators.report import top_findings
from plumbline.operators.suggest import candidate_evidence as evidence_of
from plumbline.operators.suggest import suggest_checks as suggest_from
from plumbline.plans.config import generate_checks
from plumbline.plans.documentation import refresh_documentation
from plumbline.plans.quality import run_and_log, run_checks
from plumbline.sources.catalog import catalog_of
from plumbline.sources.configs import append_checks, append_config, config_from_entries, read_config, write_config
from plumbline.sources.descriptions import (
    document_entries,
    entry_pos,
    flatten_entries,
    flatten_fragments,
    latest_descriptions,
    missing_fragments,
    nest_entries,
    read_document,
    read_entries,
    read_fragments,
    read_stored,
    refresh_stored,
    write_document,
    write_entries,
    write_fragments,
    write_stored,
)
from plumbline.sources.results_log import read_log
from plumbline.sources.tables import frames, parquet_tables

TABLES = (
    "region nation customer supplier part orders lineitem events documents labels embeddings pages "
    "benchmark conversations"
).split()

AS_OF = datetime(2024, 1, 31, 12)
BEFORE = datetime(1995, 1, 1)
AFTER = datetime(2001, 11, 5, 6, 30)

RESULT = ["column_name", "check_type", "result_value", "status", "severity", "metric"]
REPORT = ["pos", "check_pos", "dataset_name", "table_name", *RESULT]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names for shared files, else below the session's data."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/plumbline-{uuid.uuid4()}"


def _union(*parts: DataFrame) -> DataFrame:
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


# --------------------------------------------------------------------------- checks


def completeness_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    return completeness(orders, orders.columns).select(RESULT)


def completeness_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select(F.expr("nullif(event_type, 'error') AS event_type"), "user_id")
    lineitem = _read(spark, sf_dir, "lineitem").select(F.expr("nullif(l_returnflag, 'R') AS l_returnflag"))
    return _union(completeness(events, events.columns), completeness(lineitem, lineitem.columns)).select(RESULT)


_KEYS = [
    ("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("lineitem", "l_shipdate"),
    ("documents", "text"), ("events", "user_id"), ("embeddings", "embedding"), ("pages", "html"),
]


def uniqueness_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = config_from_entries(spark, [{"table": t, "uniqueness_col": c} for t, c in _KEYS])
    return run_checks(spark, config, parquet_tables(spark, f"{sf_dir}/{{table}}.parquet")).select(RESULT)


def uniqueness_ignores_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        F.expr("nullif(o_orderpriority, '5-LOW') AS o_orderpriority"),
        F.expr("CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS open_custkey"),
    )
    return uniqueness(orders, orders.columns).select(RESULT)


# Columns of nested types: table, name, and the value in Spark and in SQL.
_NESTED_KEYS = [
    ("orders", "class_id", "IF(o_orderstatus = 'F', NULL, struct(o_orderpriority AS p, o_orderstatus AS s))",
     "CASE WHEN o_orderstatus <> 'F' THEN {'p': o_orderpriority, 's': o_orderstatus} END"),
    ("lineitem", "flags_id", "array(array(l_returnflag), array(l_linestatus, l_returnflag, NULL))",
     "[[l_returnflag], [l_linestatus, l_returnflag, NULL]]"),
    ("customer", "segment_id", "map(c_mktsegment, c_nationkey, 'all', 0)", "MAP {c_mktsegment: c_nationkey, 'all': 0}"),
    ("events", "props_id", "parse_json(props)", "props"),
    ("events", "sets_id", "array(parse_json(props), parse_json(NULL))", "props"),
    ("documents", "words_id", "split(text, ' ')", "string_split(text, ' ')"),
    ("embeddings", "vector_id", "named_struct('v', embedding, 'l', label)", "{'v': embedding, 'l': label}"),
]


def uniqueness_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs, maps, nested arrays and variants, which are told apart by a digest."""
    return _union(*[
        uniqueness(_read(spark, sf_dir, table).select(F.expr(value).alias(name)), [name]).select(RESULT)
        for table, name, value, _ in _NESTED_KEYS
    ])


def freshness_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(_read(spark, sf_dir, "events"), ["ts"], Clock(AS_OF)).select(RESULT)


def _order_dates(spark: SparkSession, sf_dir: str, as_of: datetime) -> DataFrame:
    orders, lineitem = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    clock = Clock(as_of)
    return _union(freshness(orders, ["o_orderdate"], clock), freshness(lineitem, ["l_shipdate"], clock)).select(RESULT)


def freshness_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_dates(spark, sf_dir, AFTER)


def freshness_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_dates(spark, sf_dir, BEFORE)


def freshness_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = _read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    return freshness(dates, ["order_date"], Clock(AFTER)).select(RESULT)


def freshness_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    zoned = _read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    return freshness(zoned, ["ts"], Clock(AS_OF)).select(RESULT)


def freshness_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events = _read(spark, sf_dir, "events").select(
        text.alias("created_at"),
        F.concat(text, F.lit("Z")).alias("updated_at"),
        F.date_format("ts", "yyyyMMdd").alias("ingested"),
        F.col("event_type").alias("modified_at"),
    )
    local = freshness(events, ["created_at", "ingested", "modified_at"], Clock(AS_OF))
    zoned = freshness(events, ["updated_at"], Clock(AS_OF.replace(tzinfo=timezone.utc)))
    return _union(local, zoned).select(RESULT)


def freshness_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week dates in both forms, and an offset with seconds."""
    week = [F.extract(F.lit("YEAROFWEEK"), "ts").cast("string"), F.lpad(F.weekofyear("ts").cast("string"), 2, "0"), (F.weekday("ts") + 1).cast("string")]
    events = _read(spark, sf_dir, "events").select(
        F.concat(week[0], F.lit("-W"), week[1], F.lit("-"), week[2], F.date_format("ts", "'T'HH:mm:ss")).alias("created_at"),
        F.concat(week[0], F.lit("W"), week[1], week[2], F.date_format("ts", "' 'HHmmss")).alias("ingested"),
        F.concat(F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("+010203")).alias("updated_at"),
    )
    local = freshness(events, ["created_at", "ingested"], Clock(AS_OF))
    return _union(local, freshness(events, ["updated_at"], Clock(AS_OF.replace(tzinfo=timezone.utc)))).select(RESULT)


def freshness_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_type = 'never' THEN ts END AS ts"),
        F.expr("CASE WHEN event_type = 'never' THEN event_type ELSE '' END AS updated_at"),
    )
    return freshness(events, events.columns, Clock(AS_OF)).select(RESULT)


def freshness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness asked of every column of every table: names and types decide which run."""
    tables = {t: _read(spark, sf_dir, t) for t in TABLES}
    tables["events"] = tables["events"].withColumn("status_updated_at", F.col("ts"))
    entries = [{"table": f"lake.{t}", "freshness_col": c} for t in TABLES for c in tables[t].columns]
    entries += [{"table": "lake.events", "freshness_col": c} for c in ("bad-name", "a.b", "2nd_date")]
    return run_checks(spark, config_from_entries(spark, entries), frames(tables), AS_OF).select(REPORT)


_EXCLUDED = "ING, on,"


def name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents taken as a column name: how many names each rule lets through."""
    words = _read(spark, sf_dir, "documents").select(F.explode(F.split("text", r"\s+")).alias("word"))
    word = F.col("word")
    rules = [
        is_valid_name(word).alias("valid_name"),
        passes_freshness_gate(word, F.lit("string")).alias("freshness_check"),
        suggests_freshness(word).alias("freshness_candidate"),
        suggests_completeness(word).alias("completeness_candidate"),
        is_excluded(F.lit("words"), word, split_patterns(_EXCLUDED)).alias("excluded"),
    ]
    names = words.groupBy("word").agg(F.count("*").alias("n")).select("n", *rules)
    return names.groupBy(names.columns[1:]).agg(F.count("*").alias("names"), F.sum("n").alias("uses"))


# --------------------------------------------------------------------------- runs and reports

_QUALITY = [
    {"table": "sales.orders", "freshness_col": "o_orderdate", "completeness_col": "o_orderkey",
     "uniqueness_col": "o_orderkey"},
    {"table": "sales.lineitem", "freshness_col": "l_shipdate", "completeness_col": "l_orderkey"},
    {"table": "sales.lineitem", "completeness_col": "l_returnflag", "uniqueness_col": "l_partkey"},
    {"table": "sales.customer", "completeness_col": "c_custkey", "uniqueness_col": "c_custkey"},
    {"table": "sales.supplier", "completeness_col": "s_suppkey", "uniqueness_col": "s_acctbal"},
    {"table": "sales.part", "freshness_col": "p_size", "completeness_col": "p_name", "uniqueness_col": "p_name"},
    {"table": "sales.nation", "completeness_col": "n_name", "uniqueness_col": "n_regionkey"},
    {"table": "region", "completeness_col": "r_regionkey", "uniqueness_col": "r_regionkey"},
    {"table": "web.events", "freshness_col": "ts", "completeness_col": "event_id", "uniqueness_col": "user_id"},
    {"table": "web.pages", "completeness_col": "url", "uniqueness_col": "url"},
    {"table": "text.documents", "completeness_col": "text", "uniqueness_col": "text"},
    {"table": "text.labels", "completeness_col": "quality", "uniqueness_col": "doc_id"},
    {"table": "text.embeddings", "completeness_col": "embedding", "uniqueness_col": "vec_id"},
    {"table": "text.benchmark", "completeness_col": "item_id", "uniqueness_col": "text"},
    {"table": "text.conversations", "completeness_col": "role", "uniqueness_col": "conv_id"},
    {"table": "text.conversations"},
]


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = parquet_tables(spark, f"{sf_dir}/{{table}}.parquet")
    return run_checks(spark, config_from_entries(spark, _QUALITY), tables, AS_OF).select(REPORT)


_ERRORS = [
    {"table": "web.events", "freshness_col": "Timestamp_lost", "completeness_col": "no_such", "uniqueness_col": "none"},
    {"table": "web.missing", "freshness_col": "loaded_at", "completeness_col": "id"},
    {"table": "web.events", "freshness_col": "event-time", "completeness_col": "a.b", "uniqueness_col": "1st"},
    {"table": "web.events", "freshness_col": "TS", "completeness_col": "EVENT_ID", "uniqueness_col": "Event_Type"},
    {"table": "sales.orders", "freshness_col": "o_orderstatus", "completeness_col": "o_totalprice"},
    {"table": "web.broken", "freshness_col": "loaded_at", "uniqueness_col": "id"},
    {"table": "web.twins", "freshness_col": "ts", "completeness_col": "id", "uniqueness_col": "ID"},
    {"table": "web.typed", "completeness_col": "payload_id", "uniqueness_col": "payload_id"},
]


def quality_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can't be read, found, named without doubt or grouped, next to checks that run."""
    parquet = parquet_tables(spark, f"{sf_dir}/{{table}}.parquet")

    def tables(schema: str, table: str) -> DataFrame:
        events = parquet("web", "events")
        if table == "broken":
            raise RuntimeError("storage is away\nfor now")
        if table == "twins":
            return events.select("ts", F.col("event_id").alias("id"), F.col("user_id").alias("ID"))
        if table == "typed":
            return events.select(F.expr("IF(event_type = 'view', NULL, parse_json(string(event_id))) AS payload_id"))
        return parquet(schema, table)

    return run_checks(spark, config_from_entries(spark, _ERRORS), tables, AS_OF).select(REPORT)


def report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(quality_report(spark, sf_dir))


# A value of each column that the report query treats as missing.
_SPOILED = [
    ("orders", "o_orderstatus", "'F'"), ("orders", "o_orderpriority", "'5-LOW'"),
    ("lineitem", "l_returnflag", "'R'"), ("lineitem", "l_linestatus", "'F'"), ("lineitem", "l_linenumber", "1"),
    ("lineitem", "l_quantity", "23"), ("lineitem", "l_discount", "0.05D"), ("lineitem", "l_tax", "0"),
    ("customer", "c_mktsegment", "'BUILDING'"), ("customer", "c_nationkey", "2"),
    ("part", "p_type", "'ECONOMY'"), ("part", "p_size", "11"), ("events", "event_type", "'error'"),
]
_DATED = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"), ("part", "p_brand")]


def report_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More failures than a section shows, and a few warnings."""
    tables = {t: _read(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "part", "events")}
    for table, column, value in _SPOILED:
        tables[table] = tables[table].withColumn(column, F.expr(f"nullif({column}, {value})"))
    entries = [{"table": f"lake.raw.{t}", "completeness_col": c} for t, c, _ in _SPOILED]
    entries += [{"table": f"lake.raw.{t}", "freshness_col": c} for t, c in _DATED]
    by_name = frames({f"lake.raw.{t}": df for t, df in tables.items()})
    return top_findings(run_checks(spark, config_from_entries(spark, entries), by_name, AS_OF))


def quality_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two logged runs read back: every result once under each of two run ids."""
    path = _shared_folder(spark)
    config = config_from_entries(spark, _QUALITY)
    tables = parquet_tables(spark, f"{sf_dir}/{{table}}.parquet")
    for _ in range(2):
        run_and_log(spark, config, tables, path=path, as_of=AS_OF)
    return read_log(spark, path).groupBy(REPORT).agg(F.count_distinct("run_id").alias("runs"))


def log_repeated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is tried again under its id leaves one copy beside the results of another run."""
    path = _shared_folder(spark)
    config = config_from_entries(spark, _QUALITY)
    tables = parquet_tables(spark, f"{sf_dir}/{{table}}.parquet")
    for run_id in ("2024-01-31", "2024-01-31", "other"):
        run_and_log(spark, config, tables, path=path, as_of=AS_OF, run_id=run_id)
    return read_log(spark, path).groupBy(REPORT).agg(F.count("*").alias("copies"), F.min("run_id").alias("first_run"))


_QUOTED = [{**e, "table": "`" + e["table"].replace(".", "`.")} for e in _QUALITY if "." in e["table"]]


def log_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quoted dataset name is logged plain, metadata goes with it, and a run without checks writes nothing."""
    path = _shared_folder(spark)
    tables = parquet_tables(spark, f"{sf_dir}/{{table}}.parquet")
    nothing = run_and_log(spark, config_from_entries(spark, [{"table": "text.conversations"}]), tables, path=path, as_of=AS_OF)
    run_id = run_and_log(spark, config_from_entries(spark, _QUOTED), tables, path=path, as_of=AS_OF)
    log = read_log(spark, path).where((F.col("run_id") == run_id) & F.lit(nothing is None))
    value = F.from_json("metadata", "metric double, rows long, as_of string, reason string")
    return log.select("pos", "check_pos", "dataset_name", "column_name", F.col("run_at").isNotNull().alias("timed"), value.alias("v")).select(
        "pos", "check_pos", "dataset_name", "column_name", "timed", "v.*"
    )


# --------------------------------------------------------------------------- check suggestion


def _lake(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    tables = {("lake", t): _read(spark, sf_dir, t) for t in TABLES}
    tables["lake", "events"] = tables["lake", "events"].withColumnRenamed("ts", "event_ts")
    tables["lake", "orders"] = tables["lake", "orders"].withColumnRenamed("o_orderdate", "order_date")
    return tables


def candidate_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _lake(spark, sf_dir)
    return evidence_of(catalog_of(spark, tables), tables)


def suggest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate_checks(spark, _lake(spark, sf_dir))


def suggest_excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate_checks(spark, _lake(spark, sf_dir), exclude=split_patterns("Item, events,"))


def _named_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as columns whose names suggest a key, a time or nothing, by their role."""
    name = F.expr("CASE data_type WHEN 'user' THEN 'user_id_' WHEN 'assistant' THEN 'Updated_' ELSE 'note_' END")
    return _turns(spark, sf_dir).withColumn("column", F.concat(name, F.col("ordinal").cast("string")))


def suggest_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suggestions for every conversation, most of columns that it doesn't have; some tables keep a bare entry."""
    turns = _named_turns(spark, sf_dir).where("data_type <> 'user' OR table_pos % 2 = 0")
    suggestions = turns.select("schema", "table").distinct().select(
        "schema", "table", F.lit("note_1").alias("freshness_col"), F.lit("Updated_4").alias("completeness_col")
    )
    return suggest_from(turns, suggestions)


def suggest_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of structs are listed, but are no evidence; a table whose columns suggest nothing keeps a bare entry."""
    orders, nation = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "nation")
    tables = {
        ("lake", "bare"): _read(spark, sf_dir, "region").select(F.col("r_name").alias("name")),
        ("lake", "nested"): nation.select(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id")).alias("attributes")),
        ("lake", "orders"): orders.select(
            F.struct(F.col("o_orderdate").alias("created")).alias("times"), "o_custkey", F.expr("nullif(o_orderkey, 1) AS half_key"),
            F.col("o_orderkey").alias("pk"),
        ),
    }
    return generate_checks(spark, tables)


_EXISTING = [
    {"table": "lake.orders", "freshness_col": "order_date", "completeness_col": "o_custkey"},
    {"table": "lake.orders", "completeness_col": "o_orderkey"},
    {"table": "lake.events", "freshness_col": "event_ts"},
]


def checks_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated entries after existing ones, written and read back."""
    path = _shared_folder(spark)
    existing = config_from_entries(spark, _EXISTING)
    write_config(generate_checks(spark, _lake(spark, sf_dir), existing=existing), path)
    return read_config(spark, path)


def checks_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path read, appended to and written twice in place."""
    path = _shared_folder(spark)
    write_config(config_from_entries(spark, _EXISTING), path)
    write_config(append_config(read_config(spark, path), generate_checks(spark, _lake(spark, sf_dir))), path)
    append_checks(generate_checks(spark, _lake(spark, sf_dir), exclude=split_patterns("Item, events,")), path)
    return read_config(spark, path)


_TEXT_KEYS = {
    "orders": ["CAST(o_custkey AS STRING) AS cust_id", "CAST(o_totalprice AS DECIMAL(18, 2)) AS price_id", "concat('o', o_orderkey) AS order_id", "o_orderkey AS pk"],
    "documents": ["lang AS lang_id", "text AS text_id", "concat(source, '-', doc_id) AS doc_id"],
    "customer": ["c_mktsegment AS segment_id", "c_acctbal AS balance_id", "c_name AS name_key"],
    "pages": ["nullif(page_id, 3) AS page_id", "url AS url_id", "html AS html_id"],
}


def suggest_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys among text and decimal columns, most of which a sketch of their values rules out."""
    tables = {("lake", t): _read(spark, sf_dir, t).selectExpr(*columns) for t, columns in _TEXT_KEYS.items()}
    return generate_checks(spark, tables)


def catalog_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog of all tables, handed over in batches as that of a large lake is."""
    tables = {("lake", t): _read(spark, sf_dir, t) for t in TABLES}
    return catalog_of(spark, tables, literal_columns=0).select("schema", "table", "table_pos", "ordinal", "column")


# --------------------------------------------------------------------------- descriptions


def clean_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(
        F.lit("  ## "), "source", F.lit("\n**"), "lang", F.lit(":**  "), "text", F.lit("\nDescription: "), "source"
    )
    return _read(spark, sf_dir, "documents").select("doc_id", clean(wrapped).alias("description"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of conversations: a table each, with its turns as columns."""
    return _read(spark, sf_dir, "conversations").select(
        F.lit("chat").alias("schema"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("table"),
        F.col("conv_id").alias("table_pos"),
        (F.col("turn") + 1).alias("ordinal"),
        F.concat(F.lit("turn_"), F.col("turn").cast("string")).alias("column"),
        F.col("role").alias("data_type"),
        F.col("text").alias("description"),
        entry_pos(F.lit(0), F.col("conv_id")),
    )


def _answers(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("data_type") == "assistant")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Description rows of documents: a column each in the table of their source and language."""
    return _read(spark, sf_dir, "documents").select(
        F.col("source").alias("schema"),
        F.col("lang").alias("table"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("column"),
        (F.col("doc_id") + 1).alias("ordinal"),
        F.col("text").alias("description"),
        F.lit("text").alias("data_type"),
        "doc_id",
        entry_pos(F.lit(1), F.lit(0)),
    )


def doc_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir)
    return coverage(catalog_objects(turns), _answers(turns))


def doc_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _turns(spark, sf_dir)
    return worklist(catalog_objects(turns), _answers(turns))


def doc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with a document labeled toxic are replaced by just those documents."""
    stored = _documents(spark, sf_dir).drop("entry_pos")
    toxic = _read(spark, sf_dir, "labels").where("toxic = 1")
    now = stored.join(toxic, "doc_id", "left_semi").drop("doc_id")
    return merge_descriptions(stored.drop("doc_id"), now)


def doc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested into table entries, written, read back and flattened again."""
    path = _shared_folder(spark)
    turns = _turns(spark, sf_dir)
    tables = catalog_objects(turns).where("column IS NULL")
    described = tables.withColumn("description", F.concat(F.lit("Turns of "), "table"))
    write_entries(nest_entries(_union(described, turns.drop("table_pos", "entry_pos"))), path)
    return flatten_entries(read_entries(spark, path))


def doc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_items(nest_entries(_turns(spark, sf_dir)))


def doc_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns keep their stored text, other objects take cleaned answers, documents stay."""
    turns = _turns(spark, sf_dir)
    columns = [*DESCRIPTION, "entry_pos"]
    stored = _union(turns.where(F.col("data_type") == "user").select(columns), _documents(spark, sf_dir).select(columns))
    raw = F.concat(F.lit("**Answer:** "), F.col("description"))
    table_answer = catalog_objects(turns).where("column IS NULL").withColumn("description", F.lit("# Chat\nOne chat."))
    table_answer = table_answer.withColumn("entry_pos", entry_pos(F.lit(0), F.lit(0)))
    answers = _union(turns.select(columns).withColumn("description", raw), table_answer)
    return refresh_documentation(turns, stored, answers).select(DESCRIPTION)


def doc_items_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with gaps in their ordinals, in tables too wide for one row."""
    return count_objects(_documents(spark, sf_dir))


def doc_worklist_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``overwrite`` every object is asked for again."""
    turns = _turns(spark, sf_dir)
    return worklist(catalog_objects(turns), turns, overwrite=True)


def doc_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested document per conversation with a column per turn, named by its role: of equal names the last counts."""
    turn = F.struct("turn", F.col("role").alias("name"), F.col("text").alias("description"), F.col("role").alias("data_type"))
    chats = _read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    columns = F.transform("turns", lambda t: F.struct(t["name"], t["description"], t["data_type"]))
    table = F.struct(F.lit("raw.chat.turns").alias("name"), F.lit("A chat.").alias("description"), columns.alias("columns"))
    source = F.struct(F.lit("").alias("name"), F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("schema"), F.array(table).alias("tables"))
    documents = chats.select(F.lit(2).alias("version"), F.array(source).alias("sources"))
    return latest_descriptions(flatten_entries(document_entries(documents))).select(DESCRIPTION)


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as descriptions of their role in the conversation, so that keys repeat; later turns stand further down."""
    return _turns(spark, sf_dir).select(
        "schema", "table", F.col("data_type").alias("column"), F.lit(1).cast("long").alias("ordinal"), "description",
        F.lit("text").alias("data_type"), entry_pos(F.lit(0), F.col("ordinal")), "table_pos",
    )


def doc_repeated_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = _roles(spark, sf_dir)
    catalog = roles.select("schema", "table", "table_pos", "column", "ordinal", "data_type").distinct()
    return coverage(catalog_objects(catalog), roles.where("column <> 'system'"))


def doc_repeated_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stored text of a role stays, else its last answer is taken, and no object comes twice."""
    roles = _roles(spark, sf_dir)
    catalog = roles.select("schema", "table", "table_pos", "column", "ordinal", "data_type").distinct()
    stored = roles.where("column = 'user'").drop("table_pos")
    return refresh_documentation(catalog, stored, roles.drop("table_pos")).select(DESCRIPTION)


def doc_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merged document per conversation, with a table per role, written and read back in order."""
    path = _shared_folder(spark)
    turns = _read(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("schema"), F.col("role").alias("table"),
        F.expr("CASE role WHEN 'assistant' THEN 0 WHEN 'system' THEN 1 ELSE 2 END").alias("table_pos"),
        F.concat(F.lit("turn_"), F.col("turn").cast("string")).alias("column"), ((F.col("turn") + 1) * 3000).alias("ordinal"),
        F.col("text").alias("description"), F.col("role").alias("data_type"), entry_pos(F.lit(0), F.lit(0)),
    )
    merged = refresh_documentation(turns, turns.where("table = 'user'").drop("table_pos"), turns.drop("table_pos"))
    write_document(merged, path)
    back = flatten_entries(document_entries(read_document(spark, path, lines=True)))
    return back.select(*DESCRIPTION, "entry_pos.table_pos")


DESCRIPTION = ["schema", "table", "column", "ordinal", "description", "data_type"]


def doc_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as wide as there are documents, written in fragments and read back; nothing is missing."""
    path = _shared_folder(spark)
    documents = _documents(spark, sf_dir).drop("doc_id")
    own = documents.select("schema", "table").distinct().select(
        "schema", "table", F.lit(None).cast("string").alias("column"), F.lit(0).cast("long").alias("ordinal"),
        F.concat(F.lit("Texts from "), "schema").alias("description"), F.lit(None).cast("string").alias("data_type"), entry_pos(F.lit(0), F.lit(0)),
    )
    write_fragments(_union(documents, own), path)
    back = flatten_fragments(read_fragments(spark, path)).select(*DESCRIPTION)
    lost = missing_fragments(spark, path).select("schema", *[F.lit(None).cast(t).alias(c) for c, t in back.dtypes[1:]])
    return _union(back, lost)


def doc_replace_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored by source, then refreshed in place with the tables that have documents labeled toxic."""
    path = _shared_folder(spark)
    documents = _documents(spark, sf_dir)
    write_stored(documents, path)
    toxic = _read(spark, sf_dir, "labels").where("toxic = 1")
    refresh_stored(documents.join(toxic, "doc_id", "left_semi").drop("doc_id"), path)
    return read_stored(spark, path).select(*DESCRIPTION)


def push_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions that are empty, missing or error messages are held back."""
    text = (
        "CASE event_type WHEN 'error' THEN 'ERROR: no key' WHEN 'view' THEN '' WHEN 'click' THEN NULL "
        "WHEN 'signup' THEN 'Connection Error: ' || user_id ELSE 'An ERROR: told by ' || user_id END"
    )
    described = _read(spark, sf_dir, "events").select(
        F.lit("web").alias("schema"), F.lit("a.b.events").alias("table"), F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("column"),
        F.expr(text).alias("description"),
    )
    return publishable(described)


def push_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of events by user; those that begin with an error are held back."""

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    described = _read(spark, sf_dir, "events").select(
        F.lit("web").alias("schema"),
        F.concat(F.lit("web.user_"), text("user_id")).alias("table"),
        F.concat(F.lit("event_"), text("event_id")).alias("column"),
        F.concat(F.initcap("event_type"), F.lit(" by user "), text("user_id")).alias("description"),
    )
    return publishable(described)


# --------------------------------------------------------------------------- SQL equivalents

_STATUS = "CASE WHEN n = 0 THEN '✅' ELSE 'Failed' END"


def _row(kind: str, column: str, value: str, status: str, metric: str, source: str, identity: str = "") -> str:
    severity = (
        f"CASE WHEN {status} IN ('Failed', '❌') THEN 'FAIL' WHEN {status} IN ('⚠️', '⚠️ OLD') THEN 'WARN' "
        "ELSE 'PASS' END"
    )
    return (
        f"SELECT {identity}'{column}' AS column_name, '{kind}' AS check_type, {value} AS result_value, "
        f"{status} AS status, {severity} AS severity, CAST({metric} AS DOUBLE) AS metric FROM ({source})"
    )


def _completeness_sql(table: str, column: str, expression: str = "", identity: str = "") -> str:
    value = "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (' || n || ')' END"
    source = f"SELECT count(*) - count({expression or column}) AS n FROM {table}"
    return _row("Completeness", column, value, _STATUS, "n", source, identity)


def _uniqueness_sql(table: str, column: str, expression: str = "", identity: str = "") -> str:
    value = "CASE WHEN n = 0 THEN 'PASS' ELSE n || ' duplicates' END"
    c = expression or column
    source = f"SELECT count({c}) - count(DISTINCT {c}) AS n FROM {table}"
    return _row("Uniqueness", column, value, _STATUS, "n", source, identity)


def _freshness_sql(
    table: str, column: str, as_of: datetime = AS_OF, expression: str = "", time: str = "m", identity: str = ""
) -> str:
    source = (
        f"SELECT m, (epoch_us(TIMESTAMP '{as_of}') - epoch_us(CAST({time} AS TIMESTAMP)))::DOUBLE / 1e6 / 3600 AS h "
        f"FROM (SELECT max({expression or column}) AS m FROM {table})"
    )
    value = (
        "CASE WHEN m IS NULL OR m::VARCHAR = '' THEN 'EMPTY' "
        "WHEN h IS NULL THEN 'Bad fmt: ' || left(m::VARCHAR, 10) || '...' "
        "WHEN h < 0 THEN 'Future: ' || printf('%.1f', abs(h)) || 'h' ELSE printf('%.1f', h) || 'h ago' END"
    )
    status = (
        "CASE WHEN m IS NULL OR m::VARCHAR = '' THEN '⚪' WHEN h IS NULL OR h < 0 THEN '⚠️' "
        "WHEN h < 24 THEN '✅' ELSE '⚠️ OLD' END"
    )
    return _row("Freshness", column, value, status, "h", source, identity)


def _union_sql(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _identity(pos: int, check_pos: int, dataset: str, table: str) -> str:
    return (
        f"{pos}::BIGINT AS pos, {check_pos}::INTEGER AS check_pos, '{dataset}' AS dataset_name, "
        f"'{table}' AS table_name, "
    )


def _known(kind: str, column: str, value: str, status: str, identity: str) -> str:
    return _row(kind, column, f"'{value}'", f"'{status}'", "NULL", "SELECT 1", identity)


def _quality_sql() -> str:
    parts = []
    for pos, entry in enumerate(_QUALITY):
        schema, _, table = entry["table"].rpartition(".")
        ids = [_identity(pos, kind, schema or "sales", entry["table"]) for kind in range(3)]
        if entry.get("freshness_col") == "p_size":
            parts.append(_known("Freshness", "p_size", "Skipped (Not Temporal)", "⚠️", ids[0]))
        elif "freshness_col" in entry:
            parts.append(_freshness_sql(table, entry["freshness_col"], identity=ids[0]))
        if "completeness_col" in entry:
            parts.append(_completeness_sql(table, entry["completeness_col"], identity=ids[1]))
        if "uniqueness_col" in entry:
            parts.append(_uniqueness_sql(table, entry["uniqueness_col"], identity=ids[2]))
    return _union_sql(parts)


def _errors_sql() -> str:
    ids = [[_identity(pos, kind, e["table"].split(".")[0], e["table"]) for kind in range(3)]
           for pos, e in enumerate(_ERRORS)]
    bad, veto = ("Skipped (Bad Name)", "⚠️"), ("Skipped (Not Temporal)", "⚠️")
    return _union_sql([
        _known("Freshness", "Timestamp_lost", "Err: missing column Timestamp_lost", "❌", ids[0][0]),
        _known("Completeness", "no_such", "SQL Error", "Failed", ids[0][1]),
        _known("Uniqueness", "none", "SQL Error", "Failed", ids[0][2]),
        _known("Freshness", "loaded_at", "Err: missing table web.missing", "❌", ids[1][0]),
        _known("Completeness", "id", "SQL Error", "Failed", ids[1][1]),
        _known("Freshness", "event-time", *bad, ids[2][0]),
        _known("Completeness", "a.b", *bad, ids[2][1]),
        _known("Uniqueness", "1st", *bad, ids[2][2]),
        _freshness_sql("events", "TS", identity=ids[3][0]),
        _completeness_sql("events", "EVENT_ID", identity=ids[3][1]),
        _uniqueness_sql("events", "Event_Type", identity=ids[3][2]),
        _known("Freshness", "o_orderstatus", *veto, ids[4][0]),
        _completeness_sql("orders", "o_totalprice", identity=ids[4][1]),
        _known("Freshness", "loaded_at", "Err: storage is away", "❌", ids[5][0]),
        _known("Uniqueness", "id", "SQL Error", "Failed", ids[5][2]),
        _freshness_sql("events", "ts", identity=ids[6][0]),
        _known("Completeness", "id", "SQL Error", "Failed", ids[6][1]),
        _known("Uniqueness", "ID", "SQL Error", "Failed", ids[6][2]),
        _completeness_sql("events", "payload_id", "nullif(event_type, 'view')", ids[7][1]),
        _uniqueness_sql("events", "payload_id", "CASE WHEN event_type <> 'view' THEN event_id END", ids[7][2]),
    ])


def _summary_sql() -> str:
    return f"""
    SELECT *, CASE overall WHEN 'FAIL' THEN '🚨' WHEN 'WARN' THEN '⚠️' ELSE '✅' END || ' Data Quality Report' AS header,
           CASE overall WHEN 'PASS' THEN '✅ *All ' || passes || ' checks passed successfully.*'
                ELSE passes || ' checks passed.' END AS closing
    FROM (SELECT *, CASE WHEN fails > 0 THEN 'FAIL' WHEN warns > 0 THEN 'WARN' ELSE 'PASS' END AS overall
          FROM (SELECT count(*) FILTER (WHERE severity = 'FAIL') AS fails,
                       count(*) FILTER (WHERE severity = 'WARN') AS warns,
                       count(*) FILTER (WHERE severity = 'PASS') AS passes
                FROM ({_quality_sql()})))"""


def _top10_sql() -> str:
    parts = []
    for pos, (table, column, value) in enumerate(_SPOILED):
        spoiled = f"nullif({column}, {value.removesuffix('D')})"
        parts.append(_completeness_sql(table, column, spoiled, _identity(pos, 1, "lake", f"lake.raw.{table}")))
    for pos, (table, column) in enumerate(_DATED, start=len(_SPOILED)):
        identity = _identity(pos, 0, "lake", f"lake.raw.{table}")
        if column == "p_brand":
            parts.append(_known("Freshness", column, "Skipped (Not Temporal)", "⚠️", identity))
        else:
            parts.append(_freshness_sql(table, column, identity=identity))
    return f"""
    SELECT severity, CASE severity WHEN 'FAIL' THEN '*❌ Critical Failures*' ELSE '*⚠️ Warnings*' END AS section,
           rank::INTEGER AS rank,
           '• *' || split_part(table_name, '.', -1) || '*' || chr(10) || '   ↳ ' || check_type || ' on `'
           || column_name || '`: *' || result_value || '*' AS line
    FROM (SELECT *, row_number() OVER (PARTITION BY severity ORDER BY pos, check_pos) AS rank
          FROM ({_union_sql(parts)}) WHERE severity <> 'PASS')
    WHERE rank <= 10"""


_POSITIONS = ", ".join(f"('{t}', {i})" for i, t in enumerate(TABLES))


def _gate_sql() -> str:
    # The identifier pattern and the word lists.
    measured = _union_sql([
        f"SELECT 'lake.{t}' AS table_name, column_name, result_value, status, severity, metric "
        f"FROM ({_freshness_sql(t, c)})"
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ])
    return f"""
    WITH listed AS (
      SELECT DISTINCT p.i, c.ordinal_position AS o, c.table_name AS t, c.column_name AS c, c.data_type AS d
      FROM information_schema.columns c JOIN (VALUES {_POSITIONS}) AS p(t, i) ON c.table_name = p.t
      UNION ALL
      VALUES (7, 99, 'events', 'status_updated_at', 'TIMESTAMP'), (99, 1, 'events', 'bad-name', ''),
             (99, 2, 'events', 'a.b', ''), (99, 3, 'events', '2nd_date', '')),
    gated AS (
      SELECT row_number() OVER (ORDER BY i, o) - 1 AS pos, t, c,
             regexp_matches(c, '^[a-zA-Z_][a-zA-Z0-9_]*$') AS valid,
             (d LIKE 'TIMESTAMP%' OR d = 'DATE' OR regexp_matches(lower(c),
                'date|time|timestamp|created|updated|modified|ingested|_at|_ts')) AND NOT contains(lower(c), 'status')
                AS passes
      FROM listed),
    measured AS ({measured})
    SELECT pos::BIGINT AS pos, 0::INTEGER AS check_pos, 'lake' AS dataset_name, 'lake.' || t AS table_name,
           c AS column_name, 'Freshness' AS check_type,
           CASE WHEN NOT valid THEN 'Skipped (Bad Name)' WHEN NOT passes THEN 'Skipped (Not Temporal)'
                ELSE result_value END AS result_value,
           CASE WHEN valid AND passes THEN m.status ELSE '⚠️' END AS status,
           CASE WHEN valid AND passes THEN m.severity ELSE 'WARN' END AS severity,
           CASE WHEN valid AND passes THEN m.metric END AS metric
    FROM gated g LEFT JOIN measured m ON m.table_name = 'lake.' || g.t AND m.column_name = g.c"""


# The identifier pattern and the word lists.
_NAMES_SQL = r"""
    WITH names AS (SELECT word, lower(word) AS w, count(*) AS n
                   FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents) GROUP BY ALL)
    SELECT regexp_matches(word, '^[a-zA-Z_][a-zA-Z0-9_]*$') AS valid_name,
           regexp_matches(word, '^[a-zA-Z_][a-zA-Z0-9_]*$') AND NOT contains(w, 'status') AND regexp_matches(w,
             'date|time|timestamp|created|updated|modified|ingested|_at|_ts') AS freshness_check,
           regexp_matches(w, 'ingested|updated|created|_ts|_date|timestamp') AS freshness_candidate,
           regexp_matches(w, 'id|key|uuid|pk') AS completeness_candidate,
           contains('words.' || w, 'ing') OR contains('words.' || w, 'on') AS excluded,
           count(*) AS names, sum(n)::BIGINT AS uses
    FROM names GROUP BY ALL"""


# Candidate key columns of the tables, in table order.
_KEY_COLUMNS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey", "s_nationkey"], "part": ["p_partkey"], "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "events": ["event_id", "user_id"],
    "documents": ["doc_id"], "labels": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "conversations": ["conv_id"],
}


def _evidence_sql() -> str:
    parts = []
    for table, columns in _KEY_COLUMNS.items():
        for c in columns:
            parts.append(
                f"SELECT '{table}' AS t, '{c}' AS c, 'completeness' AS kind, count(*) AS n_rows, "
                f"count(*) - count({c}) AS nulls, count({c}) - count(DISTINCT {c}) AS surplus FROM {table}"
            )
    for table, column in (("orders", "o_orderdate"), ("events", "ts")):
        parts.append(
            f"SELECT '{table}', '{column}', 'freshness', count(*), count(*) - count({column}), NULL::BIGINT FROM {table}"
        )
    return f"""
    SELECT 'lake' AS schema, e.t AS "table", p.i::BIGINT AS table_pos, i.o::BIGINT AS ordinal,
           CASE e.c WHEN 'ts' THEN 'event_ts' WHEN 'o_orderdate' THEN 'order_date' ELSE e.c END AS "column",
           CASE WHEN i.d LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' WHEN i.d = 'BIGINT' THEN 'bigint' ELSE 'int' END
             AS data_type, e.kind, e.n_rows, e.nulls, e.surplus,
           CASE e.kind WHEN 'freshness' THEN e.nulls < e.n_rows
                ELSE e.n_rows > 0 AND e.nulls = 0 AND e.surplus = 0 END AS usable, NULL::VARCHAR AS reason
    FROM ({_union_sql(parts)}) e JOIN (VALUES {_POSITIONS}) AS p(t, i) ON e.t = p.t
    JOIN (SELECT DISTINCT table_name AS t, column_name AS c, ordinal_position AS o, data_type AS d
          FROM information_schema.columns) i ON i.t = e.t AND i.c = e.c"""


def _suggest_sql(where: str = "TRUE") -> str:
    return f"""
    WITH evidence AS ({_evidence_sql()}),
    usable AS (SELECT "table" AS t, min_by("column", ordinal) FILTER (WHERE usable AND kind = 'freshness') AS f,
                      min_by("column", ordinal) FILTER (WHERE usable AND kind = 'completeness') AS k
               FROM evidence GROUP BY ALL),
    -- Fixed values: the word lists.
    listed AS (
      SELECT DISTINCT c.table_name AS t, p.i, c.ordinal_position AS o, CASE c.column_name WHEN 'ts' THEN 'event_ts'
             WHEN 'o_orderdate' THEN 'order_date' ELSE c.column_name END AS c
      FROM information_schema.columns c JOIN (VALUES {_POSITIONS}) AS p(t, i) ON c.table_name = p.t),
    named AS (
      SELECT t, i, min_by(c, o) FILTER (WHERE regexp_matches(c, 'ingested|updated|created|_ts|_date|timestamp')) AS f,
             min_by(c, o) FILTER (WHERE regexp_matches(c, 'id|key|uuid|pk')) AS k
      FROM listed GROUP BY ALL)
    SELECT n.i::BIGINT AS pos, 'lake.' || n.t AS "table", coalesce(u.f, n.f) AS freshness_col,
           coalesce(u.k, n.k) AS completeness_col
    FROM named n LEFT JOIN usable u ON u.t = n.t WHERE {where}"""


def _append_sql() -> str:
    rows = ", ".join(
        f"({i}, '{e['table']}', {_text(e.get('freshness_col'))}, {_text(e.get('completeness_col'))})"
        for i, e in enumerate(_EXISTING)
    )
    return f"""
    SELECT pos::BIGINT AS pos, "table", freshness_col, completeness_col, NULL::VARCHAR AS uniqueness_col
    FROM (SELECT * FROM (VALUES {rows}) AS x(pos, "table", freshness_col, completeness_col)
          UNION ALL SELECT pos + {len(_EXISTING)}, "table", freshness_col, completeness_col FROM ({_suggest_sql()}))"""


def _text(value: str | None) -> str:
    return "NULL::VARCHAR" if value is None else f"'{value}'"


def _append_twice_sql() -> str:
    excluded = _suggest_sql("n.t NOT IN ('lineitem', 'events')")
    return f"""
    WITH once AS ({_append_sql()})
    SELECT * FROM once
    UNION ALL SELECT pos + 1 + (SELECT max(pos) FROM once), "table", freshness_col, completeness_col, NULL FROM ({excluded})"""


def _sketched_sql() -> str:
    """The first column without nulls and duplicates, else the first column of each table; all their names suggest keys."""
    parts = []
    for pos, (table, columns) in enumerate(_TEXT_KEYS.items()):
        names = [c.rpartition(" AS ")[2] for c in columns]
        keys = " ".join(f"WHEN count({n}) = count(*) AND count(DISTINCT {n}) = count(*) THEN '{n}'" for n in names)
        parts.append(
            f"SELECT {pos}::BIGINT AS pos, 'lake.{table}' AS \"table\", NULL::VARCHAR AS freshness_col, "
            f"CASE {keys} ELSE '{names[0]}' END AS completeness_col FROM (SELECT {', '.join(columns)} FROM {table})"
        )
    return _union_sql(parts)


_TURNS_SQL = """
    SELECT 'chat' AS schema, 'conv_' || conv_id AS "table", 'turn_' || turn AS "column", turn + 1 AS ordinal,
           role AS data_type, text AS description FROM conversations"""
_OBJECTS_SQL = f"""
    SELECT schema, "table", "column", ordinal, data_type, description FROM ({_TURNS_SQL})
    UNION ALL SELECT DISTINCT 'chat', 'conv_' || conv_id, NULL, 0::BIGINT, NULL, NULL FROM conversations"""
_DOCUMENTS_SQL = """
    SELECT source AS schema, lang AS "table", 'doc_' || doc_id AS "column", doc_id + 1 AS ordinal,
           text AS description, 'text' AS data_type FROM documents"""


def _clean_sql(text: str) -> str:
    blank = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    for pattern in (rf"(?m)^[{blank}]*#+ .*", rf"(?m)\*\*.*?\*\*[:{blank}]*", rf"(?m)^Description:[{blank}]*"):
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    return f"trim(regexp_replace({text}, '[{blank}]+', ' ', 'g'))"


def _refresh_sql() -> str:
    answer = _clean_sql("'**Answer:** ' || description")
    return f"""
    SELECT schema, "table", "column", ordinal, data_type,
           CASE WHEN "column" IS NULL THEN 'One chat.' WHEN data_type = 'user' AND description <> '' THEN description
                ELSE {answer} END AS description
    FROM ({_OBJECTS_SQL})
    UNION ALL SELECT schema, "table", "column", ordinal, data_type, description FROM ({_DOCUMENTS_SQL})"""


# The wording of the prompt.
_ASKED_SQL = f"""
    SELECT schema, "table", "column", ordinal, item_type,
           'Write a single, concise 1-sentence business description for the ' || item_type || ' '''
           || coalesce("column", "table") || '''. Context: '
           || CASE item_type WHEN 'table' THEN '' ELSE 'Table: ' || "table" END
           || '. Rules: Return ONLY the description text. Do NOT use Markdown, headers, or labels like ''Description:''.'
           AS prompt
    FROM (SELECT *, CASE WHEN "column" IS NULL THEN 'table' ELSE 'column' END AS item_type FROM ({_OBJECTS_SQL}))"""
_WORKLIST_SQL = f"{_ASKED_SQL} WHERE data_type IS DISTINCT FROM 'assistant' OR description = ''"

_GIVEN_SQL = """
    WITH named AS (
      SELECT 'conv_' || conv_id AS t, conv_id, turn + 1 AS o, role,
             CASE role WHEN 'user' THEN 'user_id_' WHEN 'assistant' THEN 'Updated_' ELSE 'note_' END || (turn + 1) AS c
      FROM conversations WHERE role <> 'user' OR conv_id % 2 = 0)
    SELECT conv_id AS pos, 'chat.' || t AS "table",
           coalesce(max(c) FILTER (WHERE c = 'note_1'), min_by(c, o) FILTER (WHERE contains(lower(c), 'updated'))) AS freshness_col,
           coalesce(max(c) FILTER (WHERE c = 'Updated_4'), min_by(c, o) FILTER (WHERE contains(lower(c), 'id'))) AS completeness_col
    FROM named GROUP BY conv_id, t"""

_NESTED_SQL = """
    WITH turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS o FROM conversations)
    SELECT 'conv_' || conv_id AS schema, 'turns' AS "table", role AS "column", max(o) AS ordinal,
           max_by(text, o) AS description, role AS data_type FROM turns GROUP BY conv_id, role
    UNION ALL SELECT DISTINCT 'conv_' || conv_id, 'turns', NULL, 0::BIGINT, 'A chat.', NULL FROM conversations"""

_ROLES_SQL = """SELECT conv_id, role, max_by(text, turn) AS text FROM conversations GROUP BY conv_id, role"""


def _repeated_refresh_sql() -> str:
    return f"""
    SELECT 'chat' AS schema, 'conv_' || conv_id AS "table", role AS "column", 1::BIGINT AS ordinal,
           CASE WHEN role = 'user' AND text <> '' THEN text ELSE {_clean_sql('text')} END AS description, 'text' AS data_type
    FROM ({_ROLES_SQL})
    UNION ALL SELECT DISTINCT 'chat', 'conv_' || conv_id, NULL, 0::BIGINT, NULL, NULL FROM conversations"""


def _written_sql() -> str:
    return f"""
    WITH turns AS (
      SELECT conv_id, role, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS o,
             CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS place FROM conversations),
    placed AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY place) - 1 AS table_pos
               FROM (SELECT DISTINCT conv_id, role, place FROM turns))
    SELECT 'conv_' || conv_id AS schema, role AS "table", 'turn_' || turn AS "column", o AS ordinal,
           CASE WHEN role = 'user' AND text <> '' THEN text ELSE {_clean_sql('text')} END AS description, role AS data_type, table_pos
    FROM turns JOIN placed USING (conv_id, role)
    UNION ALL SELECT 'conv_' || conv_id, role, NULL, 0::BIGINT, NULL, NULL, table_pos FROM placed"""


def _metadata_sql() -> str:
    kept = [e for e in _QUALITY if "." in e["table"]]
    parts = []
    for pos, entry in enumerate(kept):
        dataset, _, table = entry["table"].partition(".")
        for check_pos, kind in enumerate(("freshness_col", "completeness_col", "uniqueness_col")):
            if kind not in entry:
                continue
            c = entry[kind]
            what = f"SELECT {pos}::BIGINT AS pos, {check_pos}::INTEGER AS check_pos, '{dataset}' AS dataset_name, '{c}' AS column_name, true AS timed, "
            if c == "p_size":
                parts.append(f"{what} NULL::DOUBLE AS metric, NULL::BIGINT AS rows, NULL AS as_of, 'neither type nor name is temporal' AS reason")
                continue
            metric = {
                0: f"epoch_us(TIMESTAMP '{AS_OF}' - max({c})::TIMESTAMP) / 3600000000.0",
                1: f"count(*) - count({c})",
                2: f"count({c}) - count(DISTINCT {c})",
            }[check_pos]
            parts.append(f"{what} ({metric})::DOUBLE AS metric, count(*) AS rows, '{AS_OF}' AS as_of, NULL AS reason FROM {table}")
    return _union_sql(parts)

_MERGE_SQL = f"""
    WITH stored AS ({_DOCUMENTS_SQL}),
    now AS (SELECT * FROM stored WHERE ordinal - 1 IN (SELECT doc_id FROM labels WHERE toxic = 1))
    SELECT * FROM stored WHERE (schema, "table") NOT IN (SELECT (schema, "table") FROM now)
    UNION ALL SELECT * FROM now"""


def entry(spark: SparkSession) -> DataFrame:
    """The quality report over all tables at the smallest scale."""
    return quality_report(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the subpackage ``llm`` and of the pipeline built from it, as far as they are there."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql: dict[str, str] = {}
    for module in ("plumbline.llm.queries", "corpus_pipeline"):
        try:
            part = importlib.import_module(module)
        except ModuleNotFoundError as missing:
            if missing.name not in ("plumbline.llm", "plumbline.llm.queries", "corpus_pipeline"):
                raise
            continue
        found |= part.QUERIES
        sql |= part.SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        completeness_orders, completeness_failing, uniqueness_keys, uniqueness_ignores_null,
        freshness_events, freshness_old, freshness_future, freshness_date, freshness_zoned, freshness_string,
        freshness_empty, freshness_gate, name_rules, quality_report, quality_errors, report_summary, report_top10,
        quality_log_roundtrip, log_metadata, candidate_evidence, suggest_checks, suggest_excluding, suggest_given,
        suggest_nested, suggest_sketched, catalog_batches, checks_append, checks_append_twice, uniqueness_nested, freshness_iso,
        log_repeated_run, doc_fragments, doc_replace_sources,
        clean_description, doc_coverage, doc_worklist, doc_merge, doc_flatten, doc_items, doc_refresh, push_changes,
        doc_items_documents, doc_worklist_overwrite, doc_nested, doc_repeated_coverage, doc_repeated_refresh, doc_written,
        push_errors,
    )
    return {query.__name__: query for query in registered} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    iso = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
    latest = "(SELECT date_trunc('second', max(ts)) FROM events)"
    order_columns = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
    library = {
        "completeness_orders": _union_sql([_completeness_sql("orders", c) for c in order_columns]),
        "completeness_failing": _union_sql([
            _completeness_sql("events", "event_type", "nullif(event_type, 'error')"),
            _completeness_sql("events", "user_id"),
            _completeness_sql("lineitem", "l_returnflag", "nullif(l_returnflag, 'R')"),
        ]),
        "uniqueness_keys": _union_sql([_uniqueness_sql(t, c) for t, c in _KEYS]),
        "uniqueness_ignores_null": _union_sql([
            _uniqueness_sql("orders", "o_orderpriority", "nullif(o_orderpriority, '5-LOW')"),
            _uniqueness_sql("orders", "open_custkey", "CASE WHEN o_orderstatus <> 'F' THEN o_custkey END"),
        ]),
        "freshness_events": _freshness_sql("events", "ts"),
        "freshness_old": _union_sql([
            _freshness_sql("orders", "o_orderdate", AFTER), _freshness_sql("lineitem", "l_shipdate", AFTER)
        ]),
        "freshness_future": _union_sql([
            _freshness_sql("orders", "o_orderdate", BEFORE), _freshness_sql("lineitem", "l_shipdate", BEFORE)
        ]),
        "freshness_date": _freshness_sql("orders", "order_date", AFTER, "o_orderdate::DATE"),
        "freshness_zoned": _freshness_sql("events", "ts"),
        "freshness_string": _union_sql([
            _freshness_sql("events", "created_at", expression=iso),
            _freshness_sql("events", "updated_at", expression=f"{iso} || 'Z'", time="rtrim(m, 'Z')"),
            _freshness_sql("events", "ingested", expression="strftime(ts, '%Y%m%d')", time="strptime(m, '%Y%m%d')"),
            _freshness_sql("events", "modified_at", expression="event_type", time="NULL"),
        ]),
        "freshness_empty": _union_sql([
            _freshness_sql("events", "ts", expression="CASE WHEN event_type = 'never' THEN ts END"),
            _freshness_sql("events", "updated_at", time="NULL",
                           expression="CASE WHEN event_type = 'never' THEN event_type ELSE '' END"),
        ]),
        "freshness_gate": _gate_sql(),
        "name_rules": _NAMES_SQL,
        "quality_report": _quality_sql(),
        "quality_errors": _errors_sql(),
        "report_summary": _summary_sql(),
        "report_top10": _top10_sql(),
        "quality_log_roundtrip": f"SELECT *, 2::BIGINT AS runs FROM ({_quality_sql()})",
        "candidate_evidence": _evidence_sql(),
        "suggest_checks": _suggest_sql(),
        "suggest_excluding": _suggest_sql("n.t NOT IN ('lineitem', 'events')"),
        "checks_append": _append_sql(),
        "clean_description": "SELECT doc_id, "
        + _clean_sql("'  ## ' || source || chr(10) || '**' || lang || ':**  ' || text || chr(10) || 'Description: ' || source")
        + " AS description FROM documents",
        "doc_coverage": f"""
            SELECT schema, "table", count(*) AS objects,
                   count(*) FILTER (WHERE data_type = 'assistant' AND description <> '') AS documented,
                   count(*) FILTER (WHERE data_type = 'assistant' AND description <> '')::DOUBLE / count(*) AS ratio
            FROM ({_OBJECTS_SQL}) GROUP BY ALL""",
        "doc_worklist": _WORKLIST_SQL,
        "doc_merge": _MERGE_SQL,
        "doc_flatten": f"""
            SELECT schema, "table", "column", ordinal, CASE WHEN "column" IS NULL THEN 'Turns of ' || "table"
                   ELSE description END AS description, data_type FROM ({_OBJECTS_SQL})""",
        "doc_items": """
            SELECT count(DISTINCT conv_id) AS tables, count(*) AS columns, count(DISTINCT conv_id) + count(*) AS items
            FROM conversations""",
        "doc_refresh": _refresh_sql(),
        "log_metadata": _metadata_sql(),
        "suggest_given": _GIVEN_SQL,
        "suggest_nested": """
            SELECT 0::BIGINT AS pos, 'lake.bare' AS "table", NULL::VARCHAR AS freshness_col, NULL::VARCHAR AS completeness_col
            UNION ALL SELECT 1, 'lake.nested', NULL, 'attributes.id'
            UNION ALL SELECT 2, 'lake.orders', 'times.created', CASE
                WHEN count(DISTINCT o_custkey) = count(*) THEN 'o_custkey'
                WHEN count(DISTINCT nullif(o_orderkey, 1)) = count(*) THEN 'half_key'
                WHEN count(DISTINCT o_orderkey) = count(*) THEN 'pk' ELSE 'o_custkey' END FROM orders""",
        "suggest_sketched": _sketched_sql(),
        "catalog_batches": f"""
            SELECT DISTINCT 'lake' AS schema, c.table_name AS "table", p.i::BIGINT AS table_pos,
                   c.ordinal_position::BIGINT AS ordinal, c.column_name AS "column"
            FROM information_schema.columns c JOIN (VALUES {_POSITIONS}) AS p(t, i) ON c.table_name = p.t""",
        "checks_append_twice": _append_twice_sql(),
        "uniqueness_nested": _union_sql([_uniqueness_sql(t, c, e) for t, c, _, e in _NESTED_KEYS]),
        "freshness_iso": _union_sql([
            _freshness_sql("events", "created_at", expression="strftime(ts, '%G-W%V-%uT%H:%M:%S')", time=latest),
            _freshness_sql("events", "ingested", expression="strftime(ts, '%GW%V%u %H%M%S')", time=latest),
            _freshness_sql("events", "updated_at", expression="strftime(ts, '%Y%m%dT%H%M%S') || '+010203'", time=f"{latest} - INTERVAL 3723 SECOND"),
        ]),
        "log_repeated_run": f"SELECT *, 2::BIGINT AS copies, '2024-01-31' AS first_run FROM ({_quality_sql()})",
        "doc_fragments": f"""
            {_DOCUMENTS_SQL}
            UNION ALL SELECT DISTINCT source, lang, NULL, 0::BIGINT, 'Texts from ' || source, NULL FROM documents""",
        "doc_replace_sources": _MERGE_SQL,
        "doc_items_documents": """
            SELECT count(DISTINCT (source, lang)) AS tables, count(*) AS columns, count(DISTINCT (source, lang)) + count(*) AS items
            FROM documents""",
        "doc_worklist_overwrite": _ASKED_SQL,
        "doc_nested": _NESTED_SQL,
        "doc_repeated_coverage": f"""
            SELECT 'chat' AS schema, 'conv_' || conv_id AS "table", 1 + count(*) AS objects,
                   count(*) FILTER (WHERE role <> 'system' AND text <> '') AS documented,
                   count(*) FILTER (WHERE role <> 'system' AND text <> '')::DOUBLE / (1 + count(*)) AS ratio
            FROM ({_ROLES_SQL}) GROUP BY conv_id""",
        "doc_repeated_refresh": _repeated_refresh_sql(),
        "doc_written": _written_sql(),
        "push_errors": """
            SELECT 'web' AS schema, 'events' AS "table", 'event_' || event_id AS "column", 'An ERROR: told by ' || user_id AS description
            FROM events WHERE event_type NOT IN ('error', 'view', 'click', 'signup')""",
        "push_changes": """
            SELECT 'web' AS schema, 'user_' || user_id AS "table", 'event_' || event_id AS "column",
                   upper(event_type[1]) || event_type[2:] || ' by user ' || user_id AS description
            FROM events WHERE event_type <> 'error'""",
    }
    return library | _training_data()[1]
