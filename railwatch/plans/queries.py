"""One query per operator over the given tables; ``oracles`` has the SQL to check them with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railwatch import schemas
from railwatch.config import BANK_METHODS, ForestConfig, MonitorConfig, WindowConfig
from railwatch.operators import anomaly, attribution, health, marts, monitor, quality, readside, reconcile
from railwatch.operators.parse import PAYOUTS, SETTLEMENTS, TRANSACTIONS, EventSpec, parse_events, parse_topic, staged_transactions
from railwatch.plans import tables
from railwatch.plans.jobs import register_payment_views
from railwatch.plans.stream_tables import topic_table
from railwatch.sources import progress
from railwatch.sources.streams import decode_envelope, event_stream
from railwatch.sources.tables import (
    append_json_log,
    append_log,
    export_csv,
    read_log,
    read_or_empty,
    read_table,
    scratch_path,
    sql_table,
    store,
    write_mart,
)
from railwatch.streaming.pipelines import (
    ROWS,
    WINDOWS,
    WINDOWS_BY_DATE,
    Sink,
    finish,
    reconcile_stream,
    settle_salts,
    start_pipeline,
    untimed,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-01 00:00:00"
HOURLY = WindowConfig(length="1 hour", slide="15 minutes")
PROPS = EventSpec("events", "k INT", "k", None)
STREAM_DELAY_DAYS = 365
HOT_ORDER = "2"
REPORT_DAYS = [date(2024, 1, d) for d in range(1, 31)]
LATE_BEFORE, LAST_FROM = "2024-01-11", "2024-01-21"
FILES_OF_RUN = (2, 1, 3)
#: More rows of a batch than that come in several files.
ROWS_OF_FILE = 1_000_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _plain(c: str) -> Column:
    """A time as a zone-less one, the type of the given tables."""
    return F.col(c).cast("timestamp_ntz").alias(c.split(".")[-1])


def _flat(df: DataFrame) -> DataFrame:
    """Bounds of ``window`` as two columns."""
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *[c for c in df.columns if c != "window"],
    )


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums of doubles vary in their last bits with the order of rows."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _recon_inputs(spark: SparkSession, sf_dir: str):
    return reconcile.read_for_join(
        lambda position: (
            tables.order_transactions(spark, sf_dir, position),
            tables.lineitem_settlements(spark, sf_dir, position),
        ),
        keys=tables.stored_ids(spark, sf_dir),
    )


# --- parsing -------------------------------------------------------------------------------------------------


@query
def json_parse_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction JSON to staged typed rows; malformed records are gone."""
    bronze = decode_envelope(tables.raw_transactions(tables.table(spark, sf_dir, "events")))
    valid = parse_topic(bronze, TRANSACTIONS).valid
    return valid.drop("kafka_timestamp").withColumn("event_time", _plain("event_time"))


@query
def dlq_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw record on exactly one of the two branches."""
    bronze = tables.raw_props(tables.table(spark, sf_dir, "events"))
    valid, dlq = parse_events(bronze, PROPS.schema, PROPS.key)
    typed = valid.select(F.lit("valid").alias("route"), "k", _plain("kafka_timestamp"))
    malformed = dlq.select(F.lit("dlq").alias("route"), "json_value", _plain("kafka_timestamp"))
    return typed.unionByName(malformed, allowMissingColumns=True)


@query
def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tables.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return decode_envelope(records).select("key", "value", _plain("kafka_timestamp"))


# --- windows and attribution ---------------------------------------------------------------------------------


@query
def window_health_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(health.window_health(tables.event_transactions(spark, sf_dir)))


@query
def window_health_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(health.window_health(tables.event_transactions(spark, sf_dir), HOURLY, tumbling=True))


@query
def bank_health_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.bank_health(tables.event_transactions(spark, sf_dir)).withColumn("hour_bucket", _plain("hour_bucket"))


@query
def bank_health_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days put together from hourly sketches, and whether the ranks of their percentiles are within twice the error that 99 of
    100 sketches keep."""
    txns = tables.event_transactions(spark, sf_dir)
    hourly = store(health.latency_sketches(txns), "sketches")
    daily = health.health_of_sketches(health.merge_sketches(hourly))
    rows = txns.select(F.col("payment_method").alias("bank"), F.date_trunc("day", "event_time").alias("bucket"), "response_time_ms")
    ranks, within = [], []
    for p, name in ((0.5, "p50"), (0.95, "p95")):
        estimate = F.col(f"{name}_response_time_ms")
        ranks += [F.avg((F.col("response_time_ms") < estimate).cast("int")).alias(f"{name}_from")]
        ranks += [F.avg((F.col("response_time_ms") <= estimate).cast("int")).alias(f"{name}_to")]
        slack = 2 * health.SKETCH_RANK_ERROR
        within += [((F.col(f"{name}_from") <= p + slack) & (F.col(f"{name}_to") >= p - slack)).alias(f"{name}_within")]
    found = daily.join(rows, ["bank", "bucket"]).groupBy("bank", "bucket").agg(*ranks)
    counts = daily.select("bank", "bucket", "total_transactions", "success_count", "success_rate_pct", "avg_response_time_ms")
    return counts.join(found.select("bank", "bucket", *within), ["bank", "bucket"]).withColumn("bucket", _plain("bucket"))


@query
def latest_window_per_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = health.window_health(tables.event_transactions(spark, sf_dir))
    return _flat(health.latest_snapshot(silver))


@query
def failure_attribution_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = health.window_health(tables.event_transactions(spark, sf_dir))
    return attribution.attribute_failures(health.latest_snapshot(silver), as_of=AS_OF)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = health.window_health(tables.event_transactions(spark, sf_dir), HOURLY, tumbling=True)
    return attribution.bank_history(silver)


@query
def failure_attribution_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_history(spark, sf_dir))


@query
def alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.alert_feed(_history(spark, sf_dir))


@query
def severity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = attribution.with_severity(_history(spark, sf_dir))
    return events.select("detected_at", "classification", "severity", "affected_display")


@query
def mart_correlation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_correlation(_history(spark, sf_dir))


@query
def recent_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = readside.recent(_history(spark, sf_dir), n=5, ties=("classification", "affected_banks"))
    return readside.event_lines(newest)


@query
def latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = readside.recent(_history(spark, sf_dir), n=1, ties=("classification", "affected_banks"))
    return newest.select("classification", "affected_banks", "detected_at")


@query
def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events as one text, and the text where there are none."""
    history = _history(spark, sf_dir)
    some = readside.events_text(history).withColumn("of", F.lit("all events"))
    return some.unionByName(readside.events_text(history.filter("classification IS NULL")).withColumn("of", F.lit("no events")))


@query
def classification_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest first over the whole history."""
    events = readside.recent(_history(spark, sf_dir), ties=("classification", "affected_banks"))
    return events.select("classification", "affected_banks", "detected_at")


# --- reconciliation ------------------------------------------------------------------------------------------


@query
def payment_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    return reconcile.enrich_payments(txns, settlements, skew=skew)


@query
def settlement_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    return reconcile.overdue(txns, settlements, as_of=AS_OF, skew=skew)


@query
def orphan_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    found = reconcile.orphans(txns, settlements, skew=skew)
    return found.select("settlement_id", "transaction_id", "merchant_id", "settled_amount_inr")


@query
def amount_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    return reconcile.amount_mismatch(txns, settlements, skew=skew)


@query
def settlement_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    return reconcile.mismatch_log(txns, settlements, as_of=AS_OF, skew=skew)


@query
def mismatch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    return reconcile.mismatch_counts(reconcile.mismatch_log(txns, settlements, as_of=AS_OF, skew=skew))


# --- marts ---------------------------------------------------------------------------------------------------


def _ops_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_ops(tables.categorised_transactions(spark, sf_dir))


def _recon_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    return marts.mart_recon(txns, settlements, skew=skew)


_RECON_SUMS = ("total_txn_amount", "total_settled_amount", "amount_discrepancy")


@query
def mart_ops_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_ops_mart(spark, sf_dir), 2, "total_volume_inr")


@query
def mart_settlement_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_recon_mart(spark, sf_dir), 2, *_RECON_SUMS)


@query
def mart_settlement_recon_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mart from the row-level view."""
    return _rounded(marts.mart_recon_from_rows(payment_enriched(spark, sf_dir)), 2, *_RECON_SUMS)


@query
def mart_payout_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(marts.mart_payout(tables.lineitem_payouts(spark, sf_dir)), 2, "total_payout_volume_inr")


# --- read side -----------------------------------------------------------------------------------------------


@query
def kpi_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(readside.kpi_ops(_ops_mart(spark, sf_dir)), 2, "total_volume_inr")


@query
def ops_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readside.ops_summary(readside.kpi_ops(_ops_mart(spark, sf_dir)))


@query
def kpi_by_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(readside.kpi_by_method(_ops_mart(spark, sf_dir)).drop("band"), 4, "avg_response_time_ms")


@query
def kpi_by_method_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(readside.kpi_by_method(_ops_mart(spark, sf_dir), weighted=True).drop("band"), 4, "avg_response_time_ms")


@query
def success_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.mart_ops(tables.event_transactions(spark, sf_dir))
    return readside.kpi_by_method(mart).select("payment_method", "success_rate_pct", "band")


@query
def volume_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(readside.volume_by(_ops_mart(spark, sf_dir)), 2, "total_volume_inr")


@query
def bank_health_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days a report asks for."""
    return readside.health_pivot(marts.mart_ops(tables.event_transactions(spark, sf_dir)), REPORT_DAYS)


@query
def kpi_settlement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(readside.kpi_settlement(_recon_mart(spark, sf_dir)), 2, "amount_discrepancy")


@query
def settlement_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readside.settlement_summary(readside.kpi_settlement(_recon_mart(spark, sf_dir)))


@query
def top_discrepancy_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(readside.top_merchants(_recon_mart(spark, sf_dir)), 2, "amount_discrepancy")


# --- SQL access ----------------------------------------------------------------------------------------------


@query
def sql_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sql_table(f"{sf_dir}/events.parquet")
    return spark.sql(
        f"SELECT event_type, count(*) AS n, max(event_id) AS newest FROM {events} GROUP BY event_type"
    )


@query
def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the registered views."""
    txns, settlements, skew = _recon_inputs(spark, sf_dir)
    register_payment_views(txns, settlements, skew=skew)
    return spark.sql(
        """
        SELECT payment_method, count(*) AS payments, count_if(is_delayed) AS delayed,
               count(settlement_id) AS settlements
        FROM payment_enriched
        GROUP BY payment_method
        """
    )


# --- quality and monitoring ----------------------------------------------------------------------------------


def _dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_ops_mart(spark, sf_dir).unionByName(dq_recon_mart(spark, sf_dir))


@query
def dq_ops_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(_ops_mart(spark, sf_dir), "mart_ops_dashboard_metrics", quality.ops_mart_checks())


@query
def dq_recon_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite of the mart, and a check the data violates: without settlements the sum is missing."""
    checks = quality.recon_mart_checks()
    checks += [quality.not_null("total_settled_amount"), quality.between("amount_discrepancy", None, 0)]
    mart = _rounded(_recon_mart(spark, sf_dir), 2, *_RECON_SUMS)
    return quality.run_checks(mart, "mart_settlement_reconciliation", checks)


@query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarise(_dq_results(spark, sf_dir))


@query
def dlq_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the events, written as a table; the second table does not exist."""
    dlq = parse_events(tables.raw_props(tables.table(spark, sf_dir, "events")), PROPS.schema, PROPS.key).dlq
    root = scratch_path(spark, "dlq")
    append_log(dlq, f"{root}/dlq_transactions")
    names = ("dlq_transactions", "dlq_settlements")
    return quality.dlq_health(spark, {name: f"{root}/{name}" for name in names})


@query
def missing_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart that was never built reads as no rows; together with one that was, its rows are all there is."""
    absent = read_or_empty(spark, f"{sf_dir}/no_such_mart", schemas.MART_OPS)
    both = absent.unionByName(marts.mart_ops(tables.event_transactions(spark, sf_dir)))
    return _rounded(both, 2, "total_volume_inr")


@query
def lag_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer-group listings made of line items: one group per part, with headings and unreadable ones among them."""
    lag = F.col("l_quantity").cast("int")
    listing = F.concat_ws("   ", "l_returnflag", "l_linenumber", "l_orderkey", F.col("l_orderkey") + lag, lag)
    line = (
        F.when(F.col("l_partkey") % 50 == 0, None)
        .when(F.col("l_linenumber") == 7, "TOPIC PARTITION CURRENT-OFFSET LOG-END-OFFSET LAG")
        .otherwise(listing)
    )
    group = F.concat(F.lit("part-"), "l_partkey")
    lines = tables.table(spark, sf_dir, "lineitem").select(group.alias("group_id"), line.alias("line"))
    return monitor.lag_severity(progress.lag_from_listing(lines), MonitorConfig(lag_alert=600, lag_critical=800))


@query
def lag_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.lag_alerts(lag_severity(spark, sf_dir))


def _staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user is a stream that should make progress, each purchase is progress of it."""
    events = tables.table(spark, sf_dir, "events").withColumn("stream_name", F.concat(F.lit("user-"), "user_id"))
    purchases = events.filter(F.col("event_type") == "purchase")
    done = purchases.select("stream_name", F.col("ts").cast("timestamp").alias("progress_time"))
    streams = events.select("stream_name").distinct()
    return monitor.stream_staleness(streams, done, as_of=AS_OF, cfg=MonitorConfig(stale_minutes=14400))


@query
def checkpoint_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_staleness(spark, sf_dir), 3, "age_minutes")


@query
def staleness_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.staleness_alerts(checkpoint_staleness(spark, sf_dir))


@query
def latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports are logged, the newest is shown."""
    path = scratch_path(spark, "reports")
    for made, time in ((ops_summary_text(spark, sf_dir), "2024-01-31T08:00:00"), (settlement_summary_text(spark, sf_dir), AS_OF)):
        append_log(made.select(F.col("summary").alias("report"), F.lit(time).alias("generated_at")), path)
    return readside.latest_report(read_or_empty(spark, path, schemas.REPORT))


# --- anomaly model -------------------------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.window_features(tables.event_transactions(spark, sf_dir), BANK_METHODS, HOURLY, baseline_windows=24)


@query
def window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _rounded(_features(spark, sf_dir), 4, "volume_zscore")
    return features.withColumns({"window_start": _plain("window_start"), "window_end": _plain("window_end")})


@query
def window_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand windows, the same in every run."""
    sample = _rounded(anomaly.hash_sample(_features(spark, sf_dir), "window_start", 1000), 4, "volume_zscore")
    return sample.withColumns({"window_start": _plain("window_start"), "window_end": _plain("window_end")})


def _model_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of four digits: the last bits of a mean depend on the order of its rows."""
    return store(_rounded(_features(spark, sf_dir), 4, *health.FEATURES), "features")


@query
def iforest_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the forest."""
    nodes = anomaly.fit_iforest(_model_features(spark, sf_dir), "window_start").nodes
    return _rounded(nodes, 6, "split")


@query
def iforest_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _model_features(spark, sf_dir)
    model = anomaly.fit_iforest(features, "window_start")
    scored = anomaly.score_iforest(features, model)
    return scored.withColumns({"window_start": _plain("window_start"), "window_end": _plain("window_end")})


@query
def iforest_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the model are saved; the older one, asked for by name, and the newest score all windows."""
    features, path = _model_features(spark, sf_dir), scratch_path(spark, "model")
    model = anomaly.fit_iforest(features, "window_start")
    older = anomaly.save_iforest(model, path)
    anomaly.save_iforest(model._replace(threshold=0.0), path)
    parts = [
        anomaly.score_iforest(features, anomaly.load_iforest(spark, path, version)).select(
            F.lit(label).alias("version"), _plain("window_start"), "score", "is_anomaly"
        )
        for label, version in (("older", older), ("newest", None))
    ]
    return parts[0].unionByName(parts[1])


@query
def iforest_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out windows as they are, and once more with a bank outage planted; the model has seen neither."""
    train, held_out = anomaly.hash_split(_model_features(spark, sf_dir), "window_start", held_out=0.2)
    planted = held_out.withColumns(
        {
            "success_rate_pct": F.col("success_rate_pct") * 0.5,
            "avg_response_time_ms": F.col("avg_response_time_ms") * 5,
            "timeout_rate_pct": F.col("timeout_rate_pct") + 40,
            "max_single_bank_failure_rate": F.lit(100.0),
        }
    )
    labelled = held_out.withColumn("label", F.lit(0)).unionByName(planted.withColumn("label", F.lit(1)))
    model = anomaly.fit_iforest(train, "window_start", cfg=ForestConfig())
    return anomaly.evaluate(anomaly.score_iforest(labelled, model))


# --- streams -------------------------------------------------------------------------------------------------


def _sink(spark: SparkSession, name: str) -> Sink:
    root = scratch_path(spark, name)
    return Sink(f"{root}/tables", f"{root}/checkpoints", once=True)


def _run_stream(spark: SparkSession, name: str, raw: DataFrame, spec: EventSpec, outputs=ROWS) -> str:
    sink = _sink(spark, name)
    finish(start_pipeline(raw, spec, sink, outputs))
    return sink.tables


def _raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_envelope(tables.raw_transactions(tables.table_stream(spark, sf_dir, "events")))


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_stream(spark, "bronze", _raw_transactions(spark, sf_dir), TRANSACTIONS)
    return topic_table(spark, out, "bronze_transactions").select("key", "value", _plain("kafka_timestamp"))


@query
def stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.raw_props(tables.table_stream(spark, sf_dir, "events"))
    out = _run_stream(spark, "dlq", raw, PROPS)
    return topic_table(spark, out, "dlq_events", spec=PROPS).select("json_value", _plain("kafka_timestamp"))


@query
def stream_silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.raw_props(tables.table_stream(spark, sf_dir, "events"))
    out = _run_stream(spark, "silver", raw, PROPS)
    return topic_table(spark, out, "silver_events", spec=PROPS).select("k", _plain("kafka_timestamp"))


@query
def stream_silver_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _run_stream(spark, "windows", _raw_transactions(spark, sf_dir), TRANSACTIONS, WINDOWS)
    return _flat(read_table(spark, f"{out}/silver_transactions"))


@query
def stream_newest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest window of each bank in the table of the stream, of which only the last date is read."""
    out = _run_stream(spark, "newest", _raw_transactions(spark, sf_dir), TRANSACTIONS, WINDOWS_BY_DATE)
    return _flat(health.newest_windows(spark, f"{out}/silver_transactions"))


@query
def stream_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions by date, written by the stream; the ops mart over all days."""
    out = _run_stream(spark, "typed", _raw_transactions(spark, sf_dir), TRANSACTIONS)
    return _rounded(marts.mart_ops(topic_table(spark, out, "typed_transactions")), 2, "total_volume_inr")


@query
def stream_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settlement topic: staged rows by route, dead letters with their text."""
    raw = tables.raw_settlements(tables.table_stream(spark, sf_dir, "lineitem"))
    out = _run_stream(spark, "settlements", raw, SETTLEMENTS)
    staged = topic_table(spark, out, "typed_settlements").withColumn("route", F.lit("valid")).withColumn("event_time", _plain("event_time"))
    dlq = topic_table(spark, out, "dlq_settlements").select(F.lit("dlq").alias("route"), "json_value")
    return staged.unionByName(dlq, allowMissingColumns=True)


def _replay(spark: SparkSession, sf_dir: str, name: str, outputs=ROWS) -> tuple[Sink, list[int]]:
    """Events of January in three runs of one pipeline, each a restart from the checkpoint with more files in the source, read
    one file at a time, or as many as hold one file's share of large tables; and the batches of each run. Some of the first
    days come in the last run only."""
    events = tables.table(spark, sf_dir, "events")
    run = F.when((F.col("ts") < LATE_BEFORE) & (F.col("event_id") % 50 != 7), 0).when(F.col("ts") < LATE_BEFORE, 2)
    run = run.when(F.col("ts") < LAST_FROM, 1).otherwise(2)
    raw, sink, batches = scratch_path(spark, f"{name}-source"), _sink(spark, name), []
    rows = dict(events.groupBy(run.alias("run")).count().collect())
    for number, count in enumerate(FILES_OF_RUN):
        part = decode_envelope(tables.raw_transactions(events.filter(run == number)))
        at_once = max(1, -(-rows.get(number, 0) // (count * ROWS_OF_FILE)))
        files = count * at_once
        # Row by row to one file after the other; without a key, Spark would first sort all rows of a task.
        part.repartitionById(files, F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")).write.mode("append").parquet(raw)
        source = event_stream(spark, "transactions", "parquet", path=raw, schema=schemas.BRONZE, max_per_trigger=at_once)
        queries = start_pipeline(source, TRANSACTIONS, sink, outputs)
        finish(queries)
        batches.append(sum(p["numInputRows"] > 0 for p in queries[0].recentProgress))
    return sink, batches


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table after three runs, late ones too, by date; and the batches of each run."""
    sink, batches = _replay(spark, sf_dir, "restart")
    typed = topic_table(spark, sink.tables, "typed_transactions").groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    counts = typed.select(F.lit("typed").alias("table"), F.col("event_date").cast("string").alias("part"), "n")
    for name in ("bronze", "dlq"):
        found = topic_table(spark, sink.tables, f"{name}_transactions").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.unionByName(found.select(F.lit(name).alias("table"), F.lit("all").alias("part"), "n"))
    runs = [(f"run {i}", n) for i, n in enumerate(batches)]
    return counts.unionByName(spark.createDataFrame(runs, "part string, n long").withColumn("table", F.lit("batches")))


@query
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows after three runs. What comes after the watermark has passed its windows is in none."""
    sink, _ = _replay(spark, sf_dir, "late", WINDOWS)
    return _flat(read_table(spark, f"{sink.tables}/silver_transactions"))


@query
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that has just run and one that never did, judged by their checkpoints and by a log of their progress."""
    raw = tables.raw_props(tables.table_stream(spark, sf_dir, "events"))
    sink = _sink(spark, "health")
    queries = start_pipeline(raw, PROPS, sink)
    finish(queries)
    names = ("landed_events", "landed_nothing")
    streams = spark.createDataFrame([(n,) for n in names], "stream_name string")
    times = progress.checkpoint_times(spark, {n: f"{sink.checkpoints}/{n}" for n in names})
    log = f"{sink.tables}/progress"
    progress.append_progress(spark, queries, log)
    lag = monitor.stream_lag(streams, progress.lag_from_progress(progress.latest_progress(read_log(spark, log))))
    states = monitor.stream_staleness(streams, times)
    alerts = monitor.staleness_alerts(states).select("stream_name", "message")
    batches = times.groupBy("stream_name").agg(F.count(F.lit(1)).alias("batches"))
    found = states.select("stream_name", "status").join(lag, "stream_name").join(alerts, "stream_name", "left")
    return found.join(batches, "stream_name", "left")


@query
def stream_payout_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payout mart from the table its stream writes."""
    raw = tables.raw_payouts(tables.table_stream(spark, sf_dir, "lineitem"))
    out = _run_stream(spark, "payouts", raw, PAYOUTS)
    return _rounded(marts.mart_payout(topic_table(spark, out, "silver_payouts")), 2, "total_payout_volume_inr")


@query
def stream_recon_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and line items as both arrive. A tenth of the line items settles one and the same order, some of either have
    no time or no id."""
    order_time = F.when(F.col("o_orderkey") % 101 != 0, F.col("o_orderdate").cast("timestamp"))
    orders = tables.table_stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("merchant_"), (F.col("o_custkey") % 100).cast("string")).alias("merchant_id"),
        F.col("o_totalprice").alias("amount_inr"),
        F.when(F.col("o_orderstatus") == "O", "success").otherwise("failed").alias("status"),
        order_time.alias("event_time"),
    )
    order_id = F.when(F.col("l_suppkey") % 10 == 0, F.lit(HOT_ORDER)).when(F.col("l_partkey") % 89 != 0, F.col("l_orderkey").cast("string"))
    lines = tables.table_stream(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("settlement_id"),
        order_id.alias("transaction_id"),
        F.col("l_extendedprice").alias("settled_amount_inr"),
        F.when(F.col("l_partkey") % 97 != 0, F.col("l_shipdate").cast("timestamp")).alias("event_time"),
    )
    joined = reconcile_stream(orders, lines, max_delay=f"{STREAM_DELAY_DAYS} days", hot=[HOT_ORDER])
    sink = _sink(spark, "recon")
    finish([sink.start(joined, "reconciled"), sink.start(untimed(orders, lines), "untimed")])
    out = settle_salts(read_table(spark, f"{sink.tables}/reconciled"))
    untimed_rows = read_table(spark, f"{sink.tables}/untimed").select(*out.columns)
    return out.unionByName(untimed_rows).withColumns({"txn_time": _plain("txn_time"), "settled_time": _plain("settled_time")})


# --- sinks ---------------------------------------------------------------------------------------------------


@query
def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    export_csv(mart_ops_metrics(spark, sf_dir), path)
    return spark.read.schema(schemas.MART_OPS).option("header", True).csv(path)


@query
def append_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second with a further column."""
    path = scratch_path(spark, "log")
    events = marts.mart_correlation(_history(spark, sf_dir))
    append_log(events, path)
    append_log(attribution.with_severity(events).drop("affected_display"), path)
    return read_log(spark, path)


@query
def json_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    append_json_log(_staleness(spark, sf_dir), path)
    return _rounded(spark.read.schema(schemas.STREAM_HEALTH).json(path), 3, "age_minutes")


@query
def mart_write_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart, and the rows its write counted."""
    path = scratch_path(spark, "mart")
    written = write_mart(_ops_mart(spark, sf_dir), path)
    return read_table(spark, path).agg(F.count(F.lit(1)).alias("rows_read"), F.lit(written).alias("rows_written"))


@query
def typed_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transactions stored by date; the dates asked for are the only ones read."""
    path = scratch_path(spark, "typed")
    write_mart(tables.event_transactions(spark, sf_dir), path, partition_by="event_date")
    days = read_table(spark, path).filter(F.col("event_date") >= F.lit("2024-01-16").cast("date"))
    return days.groupBy("event_date").agg(F.count(F.lit(1)).alias("transactions"))
