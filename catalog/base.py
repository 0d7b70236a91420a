"""Registry of named queries, each with the SQL that gives the same table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.session import attach_groups

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: str
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the inventory items it covers and its SQL."""

    def add(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(name, covers, fn, sql)
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r(c: Column | str, digits: int = 4) -> Column:
    """Rounded double."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All double columns rounded."""
    return df.select(*[r(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


# Frames shaped like the job's inputs, derived from the given tables, with the same
# definition in SQL.


def holed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events in which some values, types and times are null."""
    e = table(spark, folder, "events")
    k = F.col("event_id")
    return e.select(
        "event_id", "user_id",
        F.when(k % 7 != 0, F.col("value")).alias("value"),
        F.when(k % 5 != 0, F.col("event_type")).alias("event_type"),
        F.when(k % 3 != 0, F.col("ts").cast("timestamp")).alias("ts"),
    )


HOLED = """holed AS (
    SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
           CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
           CASE WHEN event_id % 3 <> 0 THEN ts END AS ts
    FROM events)"""


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders seen as listings: a host is a customer, its reviews follow from its balance."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    n = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").where("o_custkey is not null")
    hosts = o.groupBy("o_custkey").agg(F.count("*").alias("host_listings"))
    # Before the joins, which the counting of large groups would repeat.
    counted = attach_groups(o, hosts, ["o_custkey"])
    base = counted.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return base.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("host_id"),
        F.col("c_mktsegment").alias("region"), "area", F.col("o_orderstatus").alias("room_type"),
        F.col("o_totalprice").alias("price"),
        F.least("o_totalprice", F.lit(300000.0)).alias("price_capped"),
        F.dayofyear("o_orderdate").cast("long").alias("availability"),
        F.dayofmonth("o_orderdate").cast("long").alias("min_nights"),
        F.greatest(F.floor(F.col("c_acctbal") / 100), F.lit(0)).cast("long").alias("reviews"),
        F.when(F.col("c_acctbal") >= 100, F.floor(F.col("c_acctbal") / 1000) / 10).alias("reviews_per_month"),
        "host_listings",
        F.col("o_orderdate").cast("date").alias("last_review"),
        (F.least("o_totalprice", F.lit(300000.0)) * F.dayofyear("o_orderdate")).alias("revenue"),
    )


LISTING = """listing AS (
    SELECT o_orderkey AS id, o_custkey AS host_id, c_mktsegment AS region, n_name AS area,
           o_orderstatus AS room_type, o_totalprice AS price, least(o_totalprice, 300000.0::DOUBLE) AS price_capped,
           dayofyear(o_orderdate)::BIGINT AS availability, day(o_orderdate)::BIGINT AS min_nights,
           greatest(floor(c_acctbal / 100), 0)::BIGINT AS reviews,
           CASE WHEN c_acctbal >= 100 THEN floor(c_acctbal / 1000) / 10 END AS reviews_per_month,
           count(*) OVER (PARTITION BY o_custkey) AS host_listings, o_orderdate::DATE AS last_review,
           least(o_totalprice, 300000.0::DOUBLE) * dayofyear(o_orderdate) AS revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines seen as hospital stays."""
    li, o = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    whole = lambda c: F.round(F.col(c) * 100, 0).cast("int").cast("string")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").cast("long").alias("line"),
        F.round(F.col("l_quantity") * 1.8, 0).cast("long").alias("age"),
        F.col("l_linestatus").alias("gender"),
        F.concat(F.lit("B"), whole("l_tax")).alias("blood_type"),
        F.col("o_orderpriority").alias("condition"),
        F.col("o_orderdate").cast("date").alias("admitted"),
        F.col("l_shipdate").cast("date").alias("discharged"),
        F.greatest(F.datediff("l_shipdate", "o_orderdate"), F.lit(0)).cast("long").alias("stay"),
        F.concat(F.lit("Hospital "), F.col("l_suppkey").cast("string")).alias("hospital"),
        F.concat(F.lit("Plan "), whole("l_discount")).alias("insurer"),
        (F.col("l_extendedprice") - 2000).alias("billing"),
        F.col("o_orderstatus").alias("admission"),
        F.concat(F.lit("M"), F.col("l_linenumber").cast("string")).alias("medication"),
        F.when(F.col("l_returnflag") == "A", "Abnormal").when(F.col("l_returnflag") == "N", "Normal")
        .otherwise("Inconclusive").alias("result"),
    )


PATIENT = """patient AS (
    SELECT l_orderkey AS order_key, l_linenumber::BIGINT AS line, round(l_quantity * 1.8::DOUBLE)::BIGINT AS age,
           l_linestatus AS gender, 'B' || round(l_tax * 100)::INT::VARCHAR AS blood_type,
           o_orderpriority AS condition, o_orderdate::DATE AS admitted, l_shipdate::DATE AS discharged,
           greatest(date_diff('day', o_orderdate::DATE, l_shipdate::DATE), 0)::BIGINT AS stay,
           'Hospital ' || l_suppkey::VARCHAR AS hospital,
           'Plan ' || round(l_discount * 100)::INT::VARCHAR AS insurer, l_extendedprice - 2000 AS billing,
           o_orderstatus AS admission, 'M' || l_linenumber::VARCHAR AS medication,
           CASE l_returnflag WHEN 'A' THEN 'Abnormal' WHEN 'N' THEN 'Normal' ELSE 'Inconclusive' END AS result
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
