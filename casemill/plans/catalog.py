"""The query catalogue: every operator, run over the sample tables.

Each entry takes (spark, folder of Parquet tables) and returns a DataFrame.
Dates and flags are emitted as text and integers, instants as microseconds, so
that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemill import CleanSpec, RuleSpec, StreamSpec, Zones, commits, schemas, sinks
from casemill.files import sizes
from casemill.functions import nested, values
from casemill.layout import scratch_folder
from casemill.operators import clean as cleaning
from casemill.operators import dedup, dictionary, evaluate, ingest, model, profile, reports, score, summary
from casemill.plans import jobs
from casemill.plans.samples import (
    AS_OF,
    NOW,
    SOURCE,
    VERSION,
    iso_text,
    messages,
    scored_events,
    table,
    wrapped_reports,
)
from casemill.sources import read_table, spread
from casemill.streaming import run_clean_stream, write_batch
from casemill.streaming.clean_stream import LATE, compact_zones, stage_batch
from casemill.streaming.windows import WINDOW, run_window_stream, sessions, tumbling

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _comparable(df: DataFrame) -> DataFrame:
    """Types every engine renders alike; processing times are dropped."""
    shown: list[Column] = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if name in ("created_at", "scoring_timestamp"):
            continue
        if kind == "date":
            column = column.cast("string")
        elif kind == "boolean":
            column = column.cast("int")
        elif kind == "timestamp":
            column = F.unix_micros(column)
        shown.append(column.alias(name))
    return df.select(*shown)


# ---- scans, parsing and ingest ----


@query
def scan_project_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")


@query
def read_many_paths(spark, sf_dir):
    base = scratch_folder(spark, "paths")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    errors = F.col("event_type").eqNullSafe("error")
    sinks.overwrite_snapshot(events.filter(errors), f"{base}/errors")
    sinks.overwrite_snapshot(events.filter(~errors), f"{base}/others")
    return read_table(spark, f"{base}/errors", None, "", f"{base}/others")


@query
def json_parse_field(spark, sf_dir):
    parsed = nested.parse_once(spread(table(spark, sf_dir, "events")), "props", {"k": "int"}, "parsed")
    return parsed.select("event_id", F.col("parsed.k").alias("k"))


@query
def envelope_roundtrip(spark, sf_dir):
    record = {"event_id": "bigint", "event_type": "string", "value": "double"}
    events = spread(table(spark, sf_dir, "events"))
    records = events.select(
        F.to_json(F.struct(*record)).alias("record"),
        F.dayofmonth("ts").alias("batch_number"),
        F.col("event_id").alias("record_offset"),
    )
    wrapped = ingest.envelopes(
        records, source=SOURCE, endpoint="feed", fetched_at=F.lit(NOW).cast("timestamp"), id_path="event_id"
    )
    received = ingest.from_messages(ingest.to_messages(wrapped))
    parsed = cleaning.parse(received, CleanSpec(record=record))
    return parsed.select(
        "source_api", "ingestion_timestamp", "batch_number", *(F.col(f"record.{name}") for name in record)
    )


@query
def ingest_messages(spark, sf_dir):
    wrapped = wrapped_reports(spark, sf_dir).drop("event_type", "k")
    sent = ingest.to_messages(wrapped)
    body = nested.json_struct(F.col("value").cast("string"), schemas.ENVELOPE)
    return sent.select(
        F.col("key").cast("string").alias("key"),
        F.md5(body.getField("raw_data")).alias("record_md5"),
        body.getField("batch_number").alias("batch_number"),
    )


@query
def nested_first_item(spark, sf_dir):
    words = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("word")))
    items = F.when(F.col("p_type") == "SMALL", F.filter(words, lambda _: F.lit(False))).otherwise(words)
    texts = table(spark, sf_dir, "part").select(
        "p_partkey", F.to_json(F.struct(F.struct(items.alias("items")).alias("part"))).alias("text")
    )
    contract = {"part": "struct<items: array<struct<word: string>>>"}
    parsed = nested.parse_once(texts, "text", contract, "parsed")
    return parsed.select(
        "p_partkey",
        nested.at(F.col("parsed"), "part.items[0].word").alias("first_word"),
        nested.at(F.col("parsed"), "part.items[9].word").alias("tenth_word"),
    )


def _line_pages(spark, sf_dir):
    """Each document a page of its lines, with the digest of its text."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("line")))
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    body = F.to_json(F.struct(lines.alias("results"))).alias("value")
    return documents.select(F.col("doc_id").alias("page"), "lang", F.md5("text").alias("text_md5"), body)


@query
def page_explode(spark, sf_dir):
    records = ingest.explode_pages(_line_pages(spark, sf_dir), page_size=100)
    line = nested.json_struct(F.col("record"), {"line": "string"}).getField("line")
    return records.select("page", "position", "record_offset", F.md5(line).alias("line_md5"))


@query
def page_bad(spark, sf_dir):
    """French pages arrive cut short; each is set aside whole."""
    cut = F.when(F.col("lang") == "fr", F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    pages = _line_pages(spark, sf_dir).withColumn("value", cut)
    return ingest.broken_pages(pages).select("page", "text_md5", "error_reason")


@query
def page_cycle_with_broken_page(spark, sf_dir):
    """A user's reading goes on behind a broken page and ends at the first without results."""
    one = F.to_json(F.struct(F.array(F.struct("event_id")).alias("results")))
    body = (
        F.when(F.col("value") > 450, F.to_json(F.struct(F.lit(1).alias("meta"))))
        .when(F.col("value") > 100, F.expr("left('{\"results\":[{}]}', 12)"))
        .otherwise(one)
    )
    pages = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("page"), body.alias("value"))
    records = ingest.explode_pages(pages, page_size=1, cycle="user_id", stop_at_empty=True)
    kept = records.select("user_id", "page", F.lit("record").alias("kind"))
    return kept.unionByName(ingest.broken_pages(pages).select("user_id", "page", F.col("error_reason").alias("kind")))


@query
def page_explode_until_empty(spark, sf_dir):
    """Each event a page of its user; reading a user stops at the first page without results."""
    events = table(spark, sf_dir, "events")
    body = F.when(
        F.col("value") > 250, F.to_json(F.struct(F.lit(1).alias("meta")))
    ).otherwise(F.to_json(F.struct(F.array(F.struct("event_id")).alias("results"))))
    pages = events.select("user_id", F.col("event_id").alias("page"), body.alias("value"))
    records = ingest.explode_pages(pages, page_size=1, cycle="user_id", stop_at_empty=True)
    return records.select("user_id", "page", "position", "record")


@query
def pages_to_messages(spark, sf_dir):
    """Landed pages to keyed messages and back: one event per page, a cycle per day."""
    given = F.when(F.col("event_type") == "click", "").when(
        F.col("event_type") != "view", F.concat(F.lit("e-"), F.col("event_id").cast("string"))
    )
    record = F.struct(given.alias("safetyreportid"), F.col("event_type").alias("kind"))
    pages = spread(table(spark, sf_dir, "events")).select(
        F.dayofmonth("ts").alias("batch_number"),
        F.col("event_id").alias("page"),
        F.to_json(F.struct(F.array(record).alias("results"))).alias("value"),
    )
    wrapped = ingest.envelopes(
        ingest.explode_pages(pages, page_size=100),
        source=SOURCE,
        endpoint="feed",
        fetched_at=F.lit(NOW).cast("timestamp"),
    )
    sent = ingest.to_messages(wrapped)
    body = nested.json_struct(F.col("value").cast("string"), schemas.ENVELOPE)
    return sent.select(F.col("key").cast("string").alias("key"), body.alias("body")).select(
        "key", "body.batch_number", "body.ingestion_timestamp", "body.raw_data"
    )


@query
def message_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    given = (
        F.when(F.col("event_type") == "click", "")
        .when(F.col("event_type") != "view", F.concat(F.lit("e-"), F.col("event_id").cast("string")))
    )
    key = values.message_key(given, F.dayofmonth("ts"), F.col("event_id"))
    return events.select("event_id", key.alias("message_key"))


# ---- scalar semantics ----


@query
def normalize_text(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("p_brand"), F.lit(" "))
    blanked = F.when(F.col("p_type") == "SMALL", "  ").when(F.col("p_type") != "ECONOMY", F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        values.category(padded).alias("brand"),
        values.category(blanked).alias("kind"),
        values.category(blanked, blank_as_null=True).alias("kind_or_unknown"),
        values.decode(values.category(padded), {"brand#1": "first brand"}).alias("named"),
    )


@query
def flag_truthy(spark, sf_dir):
    token = (
        F.when(F.col("event_type") == "error", "YES")
        .when(F.col("event_type") == "purchase", "True")
        .when(F.col("event_type") == "click", " 1")
        .when(F.col("event_type") == "view", "1")
    )
    return table(spark, sf_dir, "events").select(
        "event_id", values.truthy(token).cast("int").alias("flag")
    )


@query
def outlier_null(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", values.non_negative(F.col("c_acctbal")).alias("c_acctbal")
    )


@query
def try_numeric(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        values.number(F.substring_index("p_brand", "#", -1)).alias("brand_number"),
        values.number(F.col("p_type")).alias("type_number"),
    )


@query
def date_compact_parse(spark, sf_dir):
    dashed = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderstatus") == "P", dashed).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    fallback = F.date_format("o_orderdate", "yyyy0101")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        values.first_date([text, fallback]).cast("string").alias("first_present"),
        values.first_date([text, fallback], parse_first=True).cast("string").alias("first_parsed"),
    )


@query
def timestamp_iso_parse(spark, sf_dir):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    text = F.when(F.col("event_type") == "error", "yesterday").otherwise(text)
    moment = values.iso_timestamp(text)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(moment).cast("double").alias("micros"),
        values.utc_iso(moment).alias("iso"),
        values.version_stamp(moment).alias("stamp"),
    )


@query
def fallback_id(spark, sf_dir):
    given = F.when(F.col("lang") == "fr", " ").when(
        F.col("lang") != "en", F.concat(F.lit("d-"), F.col("doc_id").cast("string"))
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        values.record_id(given, F.col("text")).alias("id"),
        values.record_id(given, F.col("text"), blank_is_missing=False).alias("lenient_id"),
    )


# ---- cleaning ----


@query
def dedup_keep_first(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("text_md5"))
    return dedup.keep_one(keyed, ["text_md5"], [F.asc("doc_id")])


@query
def dedup_keys(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select(F.md5("text").alias("text_md5"))
    return dedup.keep_any(keyed, ["text_md5"])


@query
def new_keys_only(spark, sf_dir):
    """Orders no line refers to: a batch of keys against the stored ones."""
    batch = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stored = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return dedup.new_keys_only(batch, stored, "o_orderkey")


@query
def bronze_raw(spark, sf_dir):
    rows = cleaning.raw_rows(cleaning.open_envelopes(messages(spark, sf_dir)), now=NOW)
    return _comparable(rows.withColumn("raw_data", F.md5("raw_data")))


@query
def silver_clean(spark, sf_dir):
    rows = cleaning.clean(messages(spark, sf_dir), now=NOW).clean
    return _comparable(rows.withColumn("raw_record", F.md5("raw_record")))


@query
def silver_clean_lenient(spark, sf_dir):
    spec = CleanSpec.compat()
    rows = cleaning.clean(messages(spark, sf_dir), spec, NOW).clean
    return _comparable(rows.withColumn("raw_record", F.md5("raw_record")))


@query
def quarantine_bad(spark, sf_dir):
    return _comparable(cleaning.clean(messages(spark, sf_dir), now=NOW).bad)


@query
def quarantine_split_counts(spark, sf_dir):
    parsed = cleaning.parse(messages(spark, sf_dir))
    return parsed.groupBy(F.coalesce("error_reason", F.lit("ok")).alias("route")).agg(
        F.count(F.lit(1)).alias("records")
    )


# ---- scoring ----


def _scored(spark, sf_dir) -> DataFrame:
    return score.score(cleaning.clean(messages(spark, sf_dir), now=NOW).clean, VERSION, now=NOW)


@query
def risk_label(spark, sf_dir):
    return scored_events(spark, sf_dir).select("event_id", "risk_label")


@query
def rule_score(spark, sf_dir):
    return scored_events(spark, sf_dir).select("event_id", "risk_label", "prediction_probability")


@query
def predictions(spark, sf_dir):
    return _comparable(_scored(spark, sf_dir).drop("features"))


@query
def predictions_slim(spark, sf_dir):
    return score.slim(_scored(spark, sf_dir))


@query
def features_string(spark, sf_dir):
    return _scored(spark, sf_dir).select("report_id", "features")


# ---- summaries and reports ----


@query
def summary_overall(spark, sf_dir):
    rows = summary.summary(scored_events(spark, sf_dir), as_of=AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def summary_by_category(spark, sf_dir):
    rows = summary.summary(scored_events(spark, sf_dir), "event_type", AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def summary_by_product(spark, sf_dir):
    rows = summary.summary(scored_events(spark, sf_dir), "user_id", AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def risk_summary_long(spark, sf_dir):
    rows = summary.long_summary(scored_events(spark, sf_dir), ["event_type", "user_id"], AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def risk_summary_union(spark, sf_dir):
    rows = summary.union_summary(scored_events(spark, sf_dir), ["event_type", "user_id"], AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def risk_summary_reports(spark, sf_dir):
    """The whole way from messages to the summary, as one plan."""
    rows = summary.long_summary(_scored(spark, sf_dir), as_of=AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def high_risk_rate(spark, sf_dir):
    rows = reports.rates(scored_events(spark, sf_dir), "user_id")
    return _rounded(rows, "average_probability", "high_risk_rate")


@query
def batch_volume(spark, sf_dir):
    return reports.batch_volume(wrapped_reports(spark, sf_dir))


@query
def top20_products(spark, sf_dir):
    returned = (F.col("l_returnflag") == "R").cast("int")
    return reports.top_k(table(spark, sf_dir, "lineitem"), "l_partkey", F.sum(returned), 20)


@query
def extremes(spark, sf_dir):
    rows = reports.extremes(scored_events(spark, sf_dir), "user_id", k=5, min_records=20)
    return _rounded(rows, "average_probability", "high_risk_rate")


@query
def risk_distribution(spark, sf_dir):
    return _rounded(reports.distribution(scored_events(spark, sf_dir)), "share")


@query
def risk_over_time(spark, sf_dir):
    label = values.any_flag(F.col("o_totalprice") > 200000)
    orders = table(spark, sf_dir, "orders").withColumn("risk_label", label)
    rows = orders.withColumn("prediction_probability", score.rule_probability(label))
    return _comparable(_rounded(reports.over_time(rows, "o_orderdate"), "average_probability"))


# ---- evaluation ----


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(table(spark, sf_dir, "labels"), "toxic", "quality")


@query
def eval_metrics(spark, sf_dir):
    return _rounded(evaluate.metrics(table(spark, sf_dir, "labels"), "toxic", "quality"), "metric_value")


def _metrics_by_lang(spark, sf_dir) -> DataFrame:
    langs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("model_version"))
    rows = table(spark, sf_dir, "labels").join(langs, "doc_id").withColumn("model_name", F.lit("quality"))
    return evaluate.metric_rows(rows, "all", "toxic", "quality")


@query
def metrics_by_version(spark, sf_dir):
    return _rounded(_metrics_by_lang(spark, sf_dir), "metric_value")


@query
def latest_metrics(spark, sf_dir):
    return _rounded(reports.latest_metrics(_metrics_by_lang(spark, sf_dir)), "metric_value")


@query
def rule_metrics(spark, sf_dir):
    return _rounded(evaluate.metric_rows(_scored(spark, sf_dir), RuleSpec().split_name), "metric_value")


# ---- profiling ----


@query
def nonnull_counts(spark, sf_dir):
    parsed = cleaning.clean(messages(spark, sf_dir), now=NOW).clean
    return profile.non_null_counts(parsed, ["report_id", "receipt_date", "patient_age", "patient_weight"])


@query
def numeric_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.non_null_counts(lines, profile.columns_of(lines, "number", but=["l_orderkey"]))


@query
def categorical_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return profile.non_null_counts(orders, profile.columns_of(orders, "category", but=["o_orderstatus"]))


@query
def non_empty_columns(spark, sf_dir):
    names = ["c_custkey", "nothing", "c_mktsegment"]
    customers = table(spark, sf_dir, "customer").withColumn("nothing", F.lit(None).cast("double"))
    return customers.select(*profile.with_values(customers, names))


@query
def quality_rates(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn(
        "lang", F.when(F.col("lang") != "fr", F.col("lang"))
    )
    rates = profile.quality(documents, ["lang", "source"], F.md5("text"), F.col("n_chars") < 200)
    return _rounded(rates, "rate")


@query
def distinct_dimension(spark, sf_dir):
    return profile.distinct(table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def median_fill(spark, sf_dir):
    kept = table(spark, sf_dir, "customer").select(
        "c_custkey", values.non_negative(F.col("c_acctbal")).alias("c_acctbal")
    )
    return _rounded(profile.fill_median(kept, ["c_acctbal"]), "c_acctbal")


# ---- contracts, sinks and jobs ----


@query
def schema_conform(spark, sf_dir):
    contract = {"p_partkey": "string", "p_size": "double", "p_brand": "int", "note": "string"}
    return schemas.conform(table(spark, sf_dir, "part"), contract, fill_missing=True).withColumn(
        "p_brand", F.col("p_brand").cast("double")
    )


@query
def schema_misfits(spark, sf_dir):
    """Values of documents and their labels that a contract of numbers would lose."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return schemas.misfits(docs, {"doc_id": "string", "lang": "int", "source": "double", "text": "int", "absent": "int"})


@query
def median_columns(spark, sf_dir):
    """Exact medians of several columns at once, of a few distinct values and of many."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    found = profile.exact_medians(lines, lines.columns)
    return spark.createDataFrame(list(found.items()), "column_name string, median double")


@query
def sink_roundtrip_parquet(spark, sf_dir):
    path = scratch_folder(spark, "bronze")
    events = table(spark, sf_dir, "events").withColumn("batch_number", F.dayofmonth("ts"))
    rows = events.select("event_id", "event_type", "batch_number")
    sinks.append_partitioned(rows.filter("event_type <=> 'error'"), path)
    sinks.append_partitioned(rows.filter("NOT event_type <=> 'error'"), path)
    return read_table(spark, path)


@query
def partition_overwrite(spark, sf_dir):
    """All days written, then the first ten rewritten with errors only."""
    path = scratch_folder(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.dayofmonth("ts").alias("day"))
    sinks.overwrite_partitions(events, path, "day")
    sinks.overwrite_partitions(events.filter("day <= 10 AND event_type = 'error'"), path, "day")
    return read_table(spark, path)


@query
def quarantine_sink(spark, sf_dir):
    path = scratch_folder(spark, "quarantine")
    bad = cleaning.clean(messages(spark, sf_dir), now=NOW).bad
    sinks.append_if_nonempty(bad, path)
    sinks.append_if_nonempty(bad.filter("error_reason = 'none'"), path)
    return read_table(spark, path, contract=schemas.BAD).groupBy("error_reason").agg(F.count(F.lit(1)).alias("records"))


@query
def snapshot_overwrite(spark, sf_dir):
    path = scratch_folder(spark, "snapshot")
    rows = scored_events(spark, sf_dir).select("event_id", "risk_label")
    sinks.overwrite_snapshot(rows, path)
    sinks.overwrite_snapshot(rows.filter("risk_label = 1"), path)
    return read_table(spark, path)


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    sinks.export_csv(rows, path)
    return spark.read.option("header", True).schema("event_id BIGINT, event_type STRING, value DOUBLE").csv(path)


def _streamed(spark, sf_dir, cycles: int = 1, **options) -> Zones:
    """All messages sent and cleaned as a stream; later cycles re-send them and
    go through a query restarted on the same checkpoint."""
    base = scratch_folder(spark, "stream")
    source, zones = StreamSpec(kind="files", path=f"{base}/inbox"), Zones(f"{base}/zones")
    for cycle in range(cycles):
        sent = messages(spark, sf_dir, batch_shift=cycle).select(F.col("value").cast("binary"))
        sent.write.mode("append").parquet(source.path)
        for stream in run_clean_stream(spark, source, zones, now=NOW, **options):
            stream.awaitTermination()
    return zones


def _silver_rows(spark, zones: Zones) -> DataFrame:
    return _comparable(jobs.read_silver(spark, zones).withColumn("raw_record", F.md5("raw_record")))


def _silver_ids(spark, zones: Zones) -> DataFrame:
    return jobs.read_silver(spark, zones).select("report_id")


@query
def stream_clean_equals_batch(spark, sf_dir):
    """One micro-batch over everything: the same rows as ``silver_clean``."""
    return _silver_rows(spark, _streamed(spark, sf_dir))


@query
def stream_bronze(spark, sf_dir):
    zones = _streamed(spark, sf_dir, dedup="per_batch")
    return _comparable(commits.read(spark, zones, "bronze").withColumn("raw_data", F.md5("raw_data")))


@query
def stream_dedup_per_batch(spark, sf_dir):
    """The same reports sent in two cycles: silver holds every id once per cycle."""
    return _silver_rows(spark, _streamed(spark, sf_dir, cycles=2, dedup="per_batch"))


@query
def stream_dedup_global(spark, sf_dir):
    """The same reports sent in two cycles: silver holds every id once, as the first cycle had it."""
    return _silver_rows(spark, _streamed(spark, sf_dir, cycles=2, dedup="global"))


@query
def stream_dedup_state(spark, sf_dir):
    """As ``stream_dedup_global``, by state: the best row of the first cycle stays."""
    return _silver_rows(spark, _streamed(spark, sf_dir, cycles=2, dedup="state"))


@query
def stream_dedup_watermark(spark, sf_dir):
    return _silver_ids(spark, _streamed(spark, sf_dir, cycles=2, dedup="watermark", delay="40 days"))


@query
def stream_replay(spark, sf_dir):
    """A batch written twice under the same id leaves one copy, in every zone."""
    base = scratch_folder(spark, "replay")
    zones = Zones(f"{base}/zones")
    messages(spark, sf_dir).write.parquet(f"{base}/inbox")  # a replay reads its batch again, nobody makes it anew
    batch = spread(spark.read.parquet(f"{base}/inbox"))
    for _ in range(2):
        write_batch(batch, zones, "run-1", 0, now=NOW)
    zone = {"raw": "bronze", "clean": "silver", "bad": "quarantine"}
    stored = [commits.read(spark, zones, held).select(F.lit(name).alias("zone")) for name, held in zone.items()]
    rows = stored[0].unionByName(stored[1]).unionByName(stored[2])
    return rows.groupBy("zone").agg(F.count(F.lit(1)).alias("records"))


# ---- the lake: commits, index, late rows, compaction, incremental sums ----


def _stream_files(spark, sf_dir, parts: list[tuple[int, str]], **options) -> Zones:
    """Messages sent in one file for each (batch shift, events), a micro-batch for each file."""
    base = scratch_folder(spark, "files")
    source, zones = StreamSpec(kind="files", path=f"{base}/inbox", max_per_trigger=1), Zones(f"{base}/zones", key_buckets=8)
    for shift, where in parts:
        sent = messages(spark, sf_dir, shift, where).select(F.col("value").cast("binary"))
        sent.repartition(1).write.mode("append").parquet(source.path)
    for stream in run_clean_stream(spark, source, zones, now=NOW, **options):
        stream.awaitTermination()
    return zones


@query
def stream_dedup_indexed(spark, sf_dir):
    """Five micro-batches, each with all events of the ones before, looked up in the index of keys."""
    files = [(n, f"event_id % 5 <= {n}") for n in range(5)]
    zones = _stream_files(spark, sf_dir, files, dedup="indexed", compact_every=3)
    return _silver_rows(spark, zones)


def _zone_rows(spark, zones: Zones, moment: str) -> DataFrame:
    """The rows of the three zones that count now, as text digests."""
    text = {"bronze": "raw_data", "silver": "raw_record", "quarantine": "raw_data"}
    rows = [
        commits.read(spark, zones, zone).select(
            F.lit(moment).alias("moment"), F.lit(zone).alias("zone"), F.md5(column).alias("text_md5"), "batch_number"
        )
        for zone, column in text.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def stream_commit(spark, sf_dir):
    """What readers see after a batch that was written to every zone but not recorded, and once it is."""
    zones = Zones(scratch_folder(spark, "commit"))
    even, odd = (messages(spark, sf_dir, where=f"event_id % 2 = {rest}") for rest in (0, 1))
    options = {"dedup": "per_batch", "now": NOW}
    write_batch(even, zones, "run-1", 0, **options)
    stage_batch(odd, zones, "run-1", 1, **options)
    crashed = _zone_rows(spark, zones, "crashed")
    write_batch(odd, zones, "run-1", 1, **options)
    return crashed.unionByName(_zone_rows(spark, zones, "repaired"))


@query
def stream_late_rows(spark, sf_dir):
    """Three files out of order: a row five days behind the latest one of the files before it is late."""
    middle = "day(ts) BETWEEN 11 AND 20"
    files = [f"event_id % 3 < 2 AND {middle}", "event_id % 3 = 2", f"event_id % 3 < 2 AND NOT ({middle})"]
    zones = _stream_files(
        spark, sf_dir, [(0, f) for f in files], dedup="indexed", late=True, delay="5 days", compact_every=2
    )
    silver = jobs.read_silver(spark, zones).withColumn("watermark", F.lit(None).cast("timestamp"))
    late = commits.read_zone(spark, zones, "late", LATE)
    rows = silver.withColumn("zone", F.lit("silver")).unionByName(late.withColumn("zone", F.lit("late")))
    return _comparable(rows.withColumn("raw_record", F.md5("raw_record")))


@query
def snapshot_staged(spark, sf_dir):
    """Readers of a snapshot before, while and after it is replaced, with an attempt that failed."""
    zones = Zones(scratch_folder(spark, "staged"))
    rows = scored_events(spark, sf_dir).select("event_id", "risk_label")

    def seen(moment: str) -> DataFrame:
        contract = dict(rows.dtypes)
        return commits.read_zone(spark, zones, "predictions", contract).withColumn("moment", F.lit(moment))

    commits.publish({"predictions": rows}, zones)
    commits.stage(rows.filter("risk_label = 0"), zones, "predictions", commits.new_attempt())
    failed = seen("failed")
    commits.publish({"predictions": rows.filter("risk_label = 1")}, zones)
    return failed.unionByName(seen("replaced"))


@query
def stream_compaction(spark, sf_dir):
    """Five batches gathered into fewer files; one of them, written again, still replaces its rows."""
    zones = Zones(scratch_folder(spark, "compact"))
    options = {"dedup": "per_batch", "now": NOW}

    def files() -> int:
        live = {e.attempt for e in commits.latest(commits.read_log(spark, zones), "silver").values()}
        return len(sizes(spark, *(f"{zones.silver}/attempt={attempt}" for attempt in live)))

    for n in range(5):
        write_batch(messages(spark, sf_dir, where=f"event_id % 5 = {n}"), zones, "run-1", n, **options)
    before = files()
    compact_zones(spark, zones, small_bytes=1 << 30)
    fewer = F.lit(int(files() < before))
    write_batch(messages(spark, sf_dir, where="event_id % 5 = 0 AND event_type <> 'view'"), zones, "run-1", 0, **options)
    rows = jobs.read_silver(spark, zones).withColumn("fewer_files", fewer)
    return _comparable(rows.withColumn("raw_record", F.md5("raw_record")))


@query
def summary_incremental(spark, sf_dir):
    """Summed batch by batch, with batches that are new, repeated and replaced by other rows."""
    zones = Zones(scratch_folder(spark, "sums"))
    name = "coalesce(get_json_object(record, '$.safetyreportid'), record)"

    def write(batch_id: int, *parts: int) -> None:
        where = f"record IS NULL OR pmod(xxhash64({name}), 3) IN ({', '.join(map(str, parts))})"
        write_batch(messages(spark, sf_dir, where=where), zones, "run-1", batch_id, dedup="per_batch", now=NOW)

    write(0, 0, 1)
    write(1, 2)
    jobs.refresh_sums(spark, zones)
    write(0, 0)
    write(1, 1)
    jobs.refresh_sums(spark, zones)
    write(1, 1)
    write(2, 2)
    rows = jobs.run_incremental_report(spark, zones, as_of=AS_OF)
    return _comparable(_rounded(rows, "average_probability"))


@query
def distinct_stored(spark, sf_dir):
    """Distinct counts from sketches per batch, one batch replaced, beside the exact ones."""
    zones = Zones(scratch_folder(spark, "sketches"))

    def write(batch_id: int, where: str) -> None:
        write_batch(messages(spark, sf_dir, where=where), zones, "run-1", batch_id, dedup="per_batch", now=NOW)

    write(0, "event_id % 2 = 0")
    write(1, "event_id % 4 = 1")
    jobs.distinct_counts(spark, zones)
    write(1, "event_id % 2 = 1 AND event_type <> 'view'")
    told = jobs.distinct_counts(spark, zones)
    silver = jobs.read_silver(spark, zones)
    names = ["report_id", "patient_sex", "medicinal_product"]
    exact = silver.agg(*(F.count_distinct(n).alias(n) for n in names)).unpivot([], names, "column_name", "exact")
    off = F.abs(F.col("estimate") - F.col("exact"))
    within = (off <= profile.SKETCH_ERROR * F.col("exact")).cast("int").alias("within")
    return told.join(exact, "column_name").select("column_name", "exact", within)


def _windowed(spark, sf_dir, build) -> DataFrame:
    """Windows emitted from three files of events, one by users, so that the third comes late."""
    base = scratch_folder(spark, "windows")
    kinds = "event_id BIGINT, user_id BIGINT, event_type STRING, ts TIMESTAMP"
    events = table(spark, sf_dir, "events")
    utc = F.to_timestamp_ltz(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")))
    for part in range(3):
        sent = events.where(F.col("user_id") % 3 == part).withColumn("ts", utc)
        sent.select("event_id", "user_id", "event_type", "ts").repartition(1).write.mode("append").parquet(f"{base}/inbox")
    stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(f"{base}/inbox")
    zones = Zones(base)
    windows = build(stream)
    run_window_stream(windows, zones).awaitTermination()
    keys = {n: t for n, t in windows.dtypes if n not in WINDOW}
    return _comparable(commits.read_zone(spark, zones, "windows", {**keys, **WINDOW}))


@query
def stream_windows(spark, sf_dir):
    """Events per type in windows of six hours, a day's delay."""
    return _windowed(spark, sf_dir, lambda rows: tumbling(rows, "ts", "6 hours", "1 day", ["event_type"]))


@query
def stream_sessions(spark, sf_dir):
    """Sessions of users, ended by two days without an event, with five days' delay."""
    return _windowed(spark, sf_dir, lambda rows: sessions(rows, "ts", "2 days", "5 days", ["user_id"]))


@query
def model_dictionary(spark, sf_dir):
    """Indexes of two categories by frequency, made and looked up without passing the driver."""
    rows, _ = _quality_rows(spark, sf_dir)
    rows = rows.select("doc_id", F.when(F.col("lang") != "fr", F.col("lang")).alias("lang"), "source")
    learned = rows.where("doc_id % 3 > 0 OR lang <> 'de'")
    for name in ("lang", "source"):
        index = dictionary.frequency_index(learned, name)
        rows = dictionary.with_index(rows, name, index, f"{name}_index", hot=3)
    return rows.select("doc_id", "lang_index", "source_index")


@query
def warehouse_rejects(spark, sf_dir):
    """Events loaded into typed columns; those with a value that does not fit, with each such value."""
    amount = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    level = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("L"), "event_type")).otherwise(F.dayofmonth("ts").cast("string"))
    rows = table(spark, sf_dir, "events").select("event_id", amount.alias("amount"), level.alias("level"))
    fitting, rejected = schemas.sift(rows, {"event_id": "bigint", "amount": "double", "level": "int"})
    loaded = fitting.select("event_id", "amount", "level", F.lit("").alias("column_name"), F.lit("").alias("value"))
    event = F.get_json_object("row", "$.event_id").cast("bigint").alias("event_id")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("amount", "double"), ("level", "int"))]
    return loaded.unionByName(rejected.select(event, *none, "column_name", "value"))


@query
def run_everything(spark, sf_dir):
    """Stream, score and report through the stored zones."""
    base = scratch_folder(spark, "everything")
    messages(spark, sf_dir).select(F.col("value").cast("binary")).write.parquet(f"{base}/inbox")
    source = StreamSpec(kind="files", path=f"{base}/inbox")
    rows = jobs.run_all(spark, source, Zones(base), version=VERSION, as_of=AS_OF, now=NOW)
    return _comparable(_rounded(rows, "average_probability"))


# ---- trained models ----


@query
def hash_split(spark, sf_dir):
    train, _ = model.split(table(spark, sf_dir, "labels"), model.ModelSpec(key="doc_id"))
    return train.select("doc_id")


def _quality_rows(spark, sf_dir) -> tuple[DataFrame, model.ModelSpec]:
    """Labelled documents, and what to learn from them."""
    spec = model.ModelSpec(
        key="doc_id", label="quality", numeric=("n_chars",), categorical=("lang", "source"), trees=20, depth=5
    )
    facts = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, sf_dir, "labels").select("doc_id", "quality").join(facts, "doc_id"), spec


@query
def model_features(spark, sf_dir):
    """The fitted feature stages: filled numbers, category indexes, one-hot positions."""
    rows, spec = _quality_rows(spark, sf_dir)
    # A number in seven is unknown, and takes the median of the others.
    rows = rows.withColumn("n_chars", F.when(F.col("doc_id") % 7 > 0, F.col("n_chars")))
    prepared = model.prepare(rows, spec)
    features = Pipeline(stages=model.feature_stages(prepared, spec)).fit(prepared).transform(prepared)
    return features.select(
        "doc_id",
        "n_chars_filled",
        "lang_index",
        (F.array_position(vector_to_array("lang_hot"), 1.0) - 1).cast("double").alias("lang_hot_position"),
    )


@query
def hash_split_sides(spark, sf_dir):
    """Both sides of the split; a label in nine has no key and is a test row."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("doc_id") % 9 > 0, F.col("doc_id")).alias("key"))
    train, test = model.split(labels, model.ModelSpec(key="key"))
    sides = [part.select("doc_id", F.lit(name).alias("side")) for name, part in (("train", train), ("test", test))]
    return sides[0].unionByName(sides[1])


@query
def model_vectors(spark, sf_dir):
    """The other category's index, and the width of the assembled vector."""
    rows, spec = _quality_rows(spark, sf_dir)
    prepared = model.prepare(rows, spec)
    features = Pipeline(stages=model.feature_stages(prepared, spec)).fit(prepared).transform(prepared)
    return features.select("doc_id", "source_index", F.size(vector_to_array("feature_vector")).alias("width"))


@query
def model_saved_equals_loaded(spark, sf_dir):
    """Every labelled document scored by a trained model and by its stored copy."""
    rows, spec = _quality_rows(spark, sf_dir)
    train, _ = model.split(rows, spec)
    fitted = model.train(train, spec)["random_forest"]
    path = scratch_folder(spark, "model")
    model.save(fitted, path)
    told = [model.predict(m, rows, "random_forest", VERSION, spec, NOW) for m in (fitted, model.load(path))]
    given = told[1].select("doc_id", F.col("prediction").alias("again"), F.col("prediction_probability").alias("p_again"))
    same = (F.col("prediction") == F.col("again")) & (F.col("prediction_probability") == F.col("p_again"))
    return told[0].join(given, "doc_id").select(
        "doc_id",
        "risk_label",
        F.col("prediction_probability").between(0, 1).cast("int").alias("in_range"),
        same.cast("int").alias("same"),
    )


@query
def model_folds(spark, sf_dir):
    """The fold of each labelled document in cross-validation."""
    return table(spark, sf_dir, "labels").select("doc_id", values.hash_fold(F.col("doc_id"), 3).alias("fold"))


@query
def model_choice(spark, sf_dir):
    """The choice among candidates, given a metric of each on each fold; here shares of good documents by source."""
    rows, _ = _quality_rows(spark, sf_dir)
    folds = rows.withColumn("fold", values.hash_fold(F.col("doc_id"), 3))
    tried = folds.groupBy(F.col("source").alias("parameters"), "fold").agg(F.avg("quality").alias("metric_value"))
    best = model.choose(tried.withColumn("metric_name", F.lit("f1_score")))
    return tried.where(F.col("parameters") == best).groupBy("parameters").agg(F.round(F.avg("metric_value"), 6).alias("mean"))


@query
def model_optimum(spark, sf_dir):
    """Of each coefficient of the logistic regression, whether the loss is flat there."""
    rows, spec = _quality_rows(spark, sf_dir)
    spec = replace(spec, max_iter=500, tolerance=1e-12, reg_param=0.01, trees=1, depth=1)
    train, _ = model.split(rows, spec)
    found = model.optimum(model.train(train, spec)["logistic_regression"], train, spec)
    # The widest column, the number of characters, sets the scale.
    scale = train.agg(F.stddev("n_chars")).first()[0]
    return found.select("coefficient", (F.abs("gradient") <= 1e-6 * scale).cast("int").alias("flat"))


@query
def model_test_scores(spark, sf_dir):
    """The held-out rows of both learners' scores, and that the metrics are those of the scores."""
    rows, spec = _quality_rows(spark, sf_dir)
    train, test = model.split(rows, spec)
    models = model.train(train, spec)
    told = [model.predict(m, test, name, VERSION, spec, NOW) for name, m in models.items()]
    scores = told[0].unionByName(told[1])
    hits = scores.groupBy("model_name").agg(F.avg((F.col("risk_label") == F.col("prediction")).cast("int")).alias("hits"))
    given = model.evaluate_all(models, test, VERSION, spec).where("metric_name = 'accuracy'")
    agree = given.join(hits, "model_name").select(
        "model_name", (F.abs(F.col("metric_value") - F.col("hits")) < 1e-9).cast("int").alias("agrees")
    )
    return scores.join(F.broadcast(agree), "model_name").select("model_name", "doc_id", "risk_label", "agrees")


@query
def model_metrics(spark, sf_dir):
    """Both learners trained and tested on whether a labelled document is good."""
    rows, spec = _quality_rows(spark, sf_dir)
    train, test = model.split(rows, spec)
    return model.evaluate_all(model.train(train, spec), test, VERSION, spec)


@query
def model_best_scores(spark, sf_dir):
    """The better learner, tuned, saved, loaded and applied to every labelled document."""
    rows, spec = _quality_rows(spark, sf_dir)
    train, test = model.split(rows, spec)
    models = model.train(train, spec, {"logistic_regression": {"regParam": [0.0, 0.01]}})
    best = model.select_best(model.evaluate_all(models, test, VERSION, spec))
    path = scratch_folder(spark, "model")
    model.save(models[best], path)
    return _comparable(model.predict(model.load(path), rows, best, VERSION, spec, NOW))
