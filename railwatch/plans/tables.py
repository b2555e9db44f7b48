"""The given tables as payment data: transactions, settlements, payouts and their raw JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railwatch.sources.tables import ROW_POSITION, read_table

# Which payment method stands for which value of the given tables.
EVENT_METHODS = {
    "click": "upi_hdfc",
    "error": "upi_axis",
    "purchase": "upi_sbi",
    "signup": "upi_icici",
    "view": "card_visa",
}
PRIORITY_METHODS = {
    "1-URGENT": "upi_hdfc",
    "2-HIGH": "upi_axis",
    "3-MEDIUM": "upi_sbi",
    "4-NOT SPECIFIED": "upi_icici",
    "5-LOW": "card_visa",
}
ORDER_STATUS = {"F": "failed", "P": "timeout", "O": "success"}


def table(spark: SparkSession, sf_dir: str, name: str, row_position: bool = False) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", row_position=row_position)


def _lookup(column: str, mapping: dict[str, str]) -> Column:
    chain = F
    for source, target in mapping.items():
        chain = chain.when(F.col(column) == source, target)
    return chain


def as_transactions(events: DataFrame) -> DataFrame:
    """Events, of a batch or a stream, as transactions."""
    status = (
        F.when(F.col("event_id") % 20 == 0, "timeout")
        .when((F.col("event_id") % 20 == 1) | ((F.col("event_type") == "error") & (F.col("event_id") % 4 == 1)), "failed")
        .otherwise("success")
    )
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.lit("merchant_"), (F.col("user_id") % 100).cast("string")).alias("merchant_id"),
        F.concat(F.lit("category_"), (F.col("user_id") % 5).cast("string")).alias("merchant_category"),
        _lookup("event_type", EVENT_METHODS).alias("payment_method"),
        F.col("value").alias("amount_inr"),
        status.alias("status"),
        (F.floor(F.col("value") * 10) + 200).cast("int").alias("response_time_ms"),
        F.col("ts").alias("event_time"),
        F.to_date("ts").alias("event_date"),
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"))


def order_transactions(spark: SparkSession, sf_dir: str, row_position: bool = False) -> DataFrame:
    """Orders as transactions, without the merchant category."""
    return _as_orders(table(spark, sf_dir, "orders", row_position), [ROW_POSITION] if row_position else [])


def stored_ids(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The transaction ids of successful orders and of line items, without the join that settlements take."""
    orders = table(spark, sf_dir, "orders").filter(_lookup("o_orderstatus", ORDER_STATUS) == "success")
    ids = lambda df, column: df.select(F.col(column).cast("string").alias("transaction_id"))
    return ids(orders, "o_orderkey"), ids(table(spark, sf_dir, "lineitem"), "l_orderkey")


def categorised_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions, with the customer's segment as merchant category."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return _as_orders(orders, [F.col("c_mktsegment").alias("merchant_category")])


def _as_orders(orders: DataFrame, extra: list) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("merchant_"), (F.col("o_custkey") % 100).cast("string")).alias("merchant_id"),
        _lookup("o_orderpriority", PRIORITY_METHODS).alias("payment_method"),
        _lookup("o_orderstatus", ORDER_STATUS).alias("status"),
        F.col("o_totalprice").alias("amount_inr"),
        (F.lit(200) + (F.col("o_orderkey") * 37) % 1300).cast("int").alias("response_time_ms"),
        F.col("o_orderdate").alias("event_time"),
        F.to_date("o_orderdate").alias("event_date"),
        *extra,
    )


def lineitem_settlements(spark: SparkSession, sf_dir: str, row_position: bool = False) -> DataFrame:
    """Line items as settlements: a fifth of the line numbers failed and carries 0, the rest the order's amount."""
    lines = table(spark, sf_dir, "lineitem", row_position)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    failed = F.col("l_linenumber") % 5 == 0
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("settlement_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("merchant_"), (F.col("o_custkey") % 100).cast("string")).alias("merchant_id"),
        F.when(failed, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("settled_amount_inr"),
        F.when(failed, "failed").otherwise("settled").alias("settlement_status"),
        (F.col("l_quantity") * 10).cast("int").alias("delay_seconds"),
        F.col("l_shipdate").alias("event_time"),
        *([ROW_POSITION] if row_position else []),
    )


def lineitem_payouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("platform"),
        F.col("l_linestatus").alias("recipient_type"),
        F.col("l_extendedprice").alias("payout_amount_inr"),
        F.when(F.col("l_quantity") > 40, "delayed").otherwise("paid").alias("payout_status"),
        (F.col("l_quantity") * 10).cast("int").alias("delay_minutes"),
        F.col("l_shipdate").alias("expected_payout_time"),
    )


def _iso_time(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def raw_transactions(events: DataFrame) -> DataFrame:
    """Events as broker records of transaction JSON, some of them malformed: cut off, without id, or no object."""
    number = F.col("transaction_id").cast("bigint")
    txn = as_transactions(events).withColumns(
        {
            "user_id": F.concat(F.lit("user_"), (number % 1000).cast("string")),
            "currency": F.lit("INR"),
            "bank_response_code": F.when(F.col("status") == "success", "00").otherwise(F.concat(F.lit("U"), (number % 90 + 10).cast("string"))),
            "is_international": number % 7 == 0,
            "device_type": F.when(number % 3 == 0, "ios").when(number % 3 == 1, "android"),
            "city": F.concat(F.lit("city_"), (number % 12).cast("string")),
            "timestamp": _iso_time("event_time"),
        }
    )
    fields = [c for c in txn.columns if c not in ("event_time", "event_date")]
    body = F.to_json(F.struct(*fields))
    kind = number % 17
    cut_off = F.substring(body, F.lit(1), F.length(body) - 1)
    value = F.when(kind == 0, cut_off).when(kind == 1, "{}").when(kind == 2, "[1]").otherwise(body)
    return txn.select(
        F.col("transaction_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("event_time").cast("timestamp").alias("timestamp"),
    )


def raw_settlements(lines: DataFrame) -> DataFrame:
    """Line items as raw settlement JSON, some of them malformed."""
    failed = F.col("l_linenumber") % 5 == 0
    event = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("settlement_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.concat(F.lit("merchant_"), (F.col("l_suppkey") % 100).cast("string")).alias("merchant_id"),
        F.when(failed, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("settled_amount_inr"),
        F.when(failed, "failed").otherwise("settled").alias("settlement_status"),
        F.concat(F.lit("ref"), "l_partkey").alias("bank_reference_number"),
        _iso_time("l_shipdate").alias("settlement_timestamp"),
        _iso_time(F.col("l_shipdate") - F.expr("INTERVAL 1 DAY")).alias("expected_settlement_time"),
        F.when(~failed, _iso_time("l_shipdate")).alias("actual_settlement_time"),
        (F.col("l_quantity") * 10).cast("int").alias("delay_seconds"),
    )
    body = F.to_json(event)
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 23
    value = F.when(kind == 0, F.concat(F.lit("["), F.col("l_orderkey"), F.lit("]"))).when(kind == 1, F.lit("{")).otherwise(body)
    return lines.select(
        event["settlement_id"].alias("key"), value.alias("value"), F.col("l_shipdate").cast("timestamp").alias("kafka_timestamp")
    )


def raw_props(events: DataFrame) -> DataFrame:
    """The events' own JSON as raw records, some of them malformed."""
    kind = F.col("event_id") % 17
    value = (
        F.when(kind == 0, F.substring("props", F.lit(1), F.length("props") - 1))
        .when(kind == 1, "{}")
        .when(kind == 2, "[1]")
        .otherwise(F.col("props"))
    )
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
    )


def raw_payouts(lines: DataFrame) -> DataFrame:
    """Line items as raw payout JSON."""
    time = _iso_time("l_shipdate")
    event = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payout_id"),
        F.col("l_returnflag").alias("platform"),
        F.col("l_linestatus").alias("recipient_type"),
        F.col("l_extendedprice").alias("payout_amount_inr"),
        F.when(F.col("l_quantity") > 40, "delayed").otherwise("paid").alias("payout_status"),
        (F.col("l_quantity") * 10).cast("int").alias("delay_minutes"),
        time.alias("expected_payout_time"),
    )
    return lines.select(
        event["payout_id"].alias("key"),
        F.to_json(event).alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("kafka_timestamp"),
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a file stream. The source wants a pattern, not the name of one file."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")
