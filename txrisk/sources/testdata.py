"""Adapters from the driver's parquet tables to the transaction model.

The transaction pipeline needs payment-shaped rows (customer, time,
amount, channel, merchant, bank, location, age band, label).  The test
tables are TPC-H-like, so two adapters derive such rows with plain joins
and projections; everything downstream (features, silver, gold, reports)
runs on the derived DataFrame and grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LINE = ["lineitem", "part", "orders", "customer", "nation", "region"]
SOURCE_TABLES = {"line": _LINE, "gaps": _LINE, "event": ["events"]}

#: Channel of an order priority, and the factor on the quantity that gives
#: the amount of an order's first lines (the others keep their price).
LINE_CHANNELS = {"1-URGENT": "Mobile", "2-HIGH": "Web", "3-MEDIUM": "POS", "4-NOT SPECIFIED": "ECOM", "5-LOW": "ATM"}
LINE_AMOUNTS = {1: 1000.0, 2: 1.0, 3: 10.0, 4: 40.0}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table (Catalyst prunes columns and pushes filters)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def txn_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order line.

    Order priorities stand for channels, the first lines of an order have
    small amounts or whole thousands, and order and line give a time of day,
    so that every category of the layers occurs.

    lineitem x part x orders x customer x nation x region, all inner joins.
    Customers meet the orders first, which are fewer than the lines, so that
    a line is shuffled for its part and its order alone; nation/region are a
    few rows and are broadcast by AQE from their real size (no unchecked hint).
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    geo = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
           .join(region, nation.n_regionkey == region.r_regionkey)
           .select("c_custkey", "c_mktsegment", "n_name", "r_name"))
    bought = orders.join(geo, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    rows = (li.join(part, li.l_partkey == part.p_partkey)
            .join(bought, F.col("l_orderkey") == F.col("o_orderkey")))
    fraud = F.col("l_returnflag") == "R"
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    minute = (order % 24 * 60 + (order * 7 + line * 13) % 60).cast("int")
    channel = F.col("o_orderpriority")
    for priority, name in LINE_CHANNELS.items():
        channel = F.when(F.col("o_orderpriority") == priority, name).otherwise(channel)
    amount = F.col("l_extendedprice")
    for number, factor in LINE_AMOUNTS.items():
        amount = F.when(line == number, F.col("l_quantity") * F.lit(factor)).otherwise(amount)
    return rows.select(
        F.concat(F.lit("TXN_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.timestamp_add("MINUTE", minute, F.col("l_shipdate")).alias("timestamp"),
        amount.alias("amount"),
        channel.alias("channel"),
        F.col("p_type").alias("merchant_category"),
        F.col("n_name").alias("bank"),
        F.col("r_name").alias("location"),
        F.col("c_mktsegment").alias("age_group"),
        fraud.cast("int").alias("is_fraud"),
        F.when(fraud, F.col("p_brand")).alias("fraud_technique"),
        (F.col("l_discount") * F.lit(10.0)).alias("merchant_risk_score"),
    )


def txn_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line transactions with values missing: NULL customers, NULL and
    NaN amounts, NULL categories."""
    rows = txn_line(spark, sf_dir)
    k = F.floor("amount").cast("long")
    return rows.withColumns({
        "customer_id": F.when(F.col("customer_id") % 10 != 0, F.col("customer_id")),
        "amount": F.when(k % 7 == 0, F.lit(None)).when(k % 211 == 1, F.lit(float("nan"))).otherwise(F.col("amount")),
        "bank": F.when(k % 5 != 2, F.col("bank")),
        "location": F.when(k % 3 != 1, F.col("location")),
        "merchant_category": F.when(k % 11 != 4, F.col("merchant_category")),
        "age_group": F.lit(None).cast("string"),
    })


def txn_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event (real times of day).

    Merchant, bank, location and age band do not exist in ``events``: they
    stay NULL, which exercises the mode-imputation fallback of gold.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    fraud = k >= 90
    null_str = F.lit(None).cast("string")
    return ev.select(
        F.concat(F.lit("TXN_"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("channel"),
        null_str.alias("merchant_category"),
        null_str.alias("bank"),
        null_str.alias("location"),
        null_str.alias("age_group"),
        fraud.cast("int").alias("is_fraud"),
        F.when(fraud, F.col("event_type")).alias("fraud_technique"),
        ((k % 10) / F.lit(10.0)).alias("merchant_risk_score"),
    )


def transactions(spark: SparkSession, sf_dir: str, source: str = "line") -> DataFrame:
    """Base transaction rows from the chosen adapter."""
    if source == "line":
        return txn_line(spark, sf_dir)
    if source == "event":
        return txn_event(spark, sf_dir)
    if source == "gaps":
        return txn_gaps(spark, sf_dir)
    raise ValueError(f"unknown transaction source {source!r}")


def doc_label_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: real NULLs in numeric columns."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left")


def event_type_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, user_id) of every event: many exact duplicate rows."""
    return read_table(spark, sf_dir, "events").select("event_type", "user_id")
