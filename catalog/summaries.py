"""Joins, set operations, ordering, aggregates, profiles and windows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import functions as F

from catalog.base import HOLED, holed_events, query, r, rounded, table
from fieldbook.operators import applying, grouping, imputing, positions, profile, quantiles, running, shaping
from fieldbook.session import materialise

# --- flagship ---------------------------------------------------------------

SEGMENTS = """WITH g AS (SELECT c_mktsegment, count(*) AS n, avg(o_totalprice) AS mean, median(o_totalprice) AS median,
        sum(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)
    SELECT c_mktsegment, n, round(mean, 4) AS mean, round(median, 4) AS median, round(total, 2) AS total,
        round(total / sum(total) OVER () * 100, 6) AS pct FROM g"""


@query("segment_revenue", "G8 G5 W2 K6", SEGMENTS)
def segment_revenue(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    # The ranks take several passes; they read two stored columns, not the join.
    joined = materialise(o.join(c, o.o_custkey == c.c_custkey).select("c_mktsegment", "o_totalprice"), "segments")
    g = grouping.group_with_median(
        joined, ["c_mktsegment"], "o_totalprice", n=F.count("*"), mean=F.avg("o_totalprice"), total=F.sum("o_totalprice")
    )
    shares = running.share_of_total(g, "total", "pct")
    return shares.select(
        "c_mktsegment", "n", r("mean").alias("mean"), r("median").alias("median"), r("total", 2).alias("total"),
        r(F.col("pct") * 100, 6).alias("pct"),
    ).orderBy(F.desc("total"), "c_mktsegment")


# --- joins -------------------------------------------------------------------


def _join(kind: str, sql: str):
    text = f"""WITH o AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT user_id AS k, count(*) AS events FROM events GROUP BY 1)
        SELECT k, n, events FROM o {sql} JOIN e USING (k)"""

    @query(f"join_{kind}", "J1", text)
    def run(spark, sf):
        o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
        e = table(spark, sf, "events").groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("events"))
        return o.join(e, "k", kind).select("k", "n", "events")

    return run


for _kind, _sql in (("inner", ""), ("left", "LEFT"), ("right", "RIGHT"), ("outer", "FULL")):
    _join(_kind, _sql)


@query("concat_by_position", "J2", """WITH o AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders),
    e AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id DESC) - 1 AS position FROM events)
    SELECT coalesce(o.position, e.position) AS position, o_orderkey, o_totalprice, event_id, value FROM o FULL JOIN e ON o.position = e.position""")
def concat_by_position(spark, sf):
    o, e = table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), table(spark, sf, "events").select("event_id", "value")
    return positions.concat_by_position(o, e, ["o_orderkey"], [("event_id", True)])


@query("numbered_rows", "J2 P2", "SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS place FROM customer")
def numbered_rows(spark, sf):
    return positions.number_rows(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "place", [("c_acctbal", True), "c_custkey"])


@query("concat_columns", "J2", """SELECT coalesce(o.k, e.k) AS k, orders, events FROM
    (SELECT o_custkey AS k, count(*) AS orders FROM orders GROUP BY 1) o FULL JOIN
    (SELECT user_id AS k, count(*) AS events FROM events GROUP BY 1) e ON o.k = e.k""")
def concat_columns(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("events"))
    return o.join(e, "k", "outer")


@query("align_to_keys", "J3", """SELECT c_custkey, n FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey""")
def align_to_keys(spark, sf):
    n = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").groupBy(
        F.col("o_custkey").alias("c_custkey")
    ).agg(F.count("*").alias("n"))
    return shaping.align_to(table(spark, sf, "customer").select("c_custkey"), n, ["c_custkey"])


@query("rows_of_top_keys", "J4 K3 P12", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN
    (SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 20)""")
def rows_of_top_keys(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return shaping.keep_groups(li, shaping.top_groups(li, ["l_partkey"], F.count("*"), 20), ["l_partkey"])


@query("above_overall_mean", "J6", """SELECT o_orderstatus, count(*) AS n FROM orders
    WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY o_orderstatus""")
def above_overall_mean(spark, sf):
    o = table(spark, sf, "orders")
    return o.filter(F.col("o_totalprice") > o.agg(F.avg("o_totalprice")).scalar()).groupBy("o_orderstatus").agg(
        F.count("*").alias("n")
    )


@query("action_filter_members", "J8", "SELECT DISTINCT p_type, p_brand FROM part")
def action_filter_members(spark, sf):
    return table(spark, sf, "part").select("p_type", "p_brand").distinct()


# --- sets and order ------------------------------------------------------------


@query("stack_by_name", "U1", """SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def stack_by_name(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return shaping.stack_by_name([c, s])


@query("union_of_filters", "U2", """SELECT l_orderkey, l_linenumber, 'cheap' AS matched FROM lineitem WHERE l_extendedprice <= 3000
    UNION ALL SELECT l_orderkey, l_linenumber, 'few' FROM lineitem WHERE l_quantity <= 3
    UNION ALL SELECT l_orderkey, l_linenumber, 'full price' FROM lineitem WHERE l_discount = 0 AND l_tax = 0""")
def union_of_filters(spark, sf):
    c = F.col
    return shaping.union_of_filters(
        table(spark, sf, "lineitem"),
        {"cheap": c("l_extendedprice") <= 3000, "few": c("l_quantity") <= 3, "full price": (c("l_discount") == 0) & (c("l_tax") == 0)},
    ).select("l_orderkey", "l_linenumber", "matched")


@query("flatten_lists", "U3", """SELECT o_custkey, count(*) AS n, sum(x)::BIGINT AS total FROM (
        SELECT o_custkey, unnest([o_orderkey, o_custkey, year(o_orderdate)::BIGINT]) AS x FROM orders) GROUP BY o_custkey""")
def flatten_lists(spark, sf):
    lists = F.array(F.array("o_orderkey", "o_custkey"), F.array(F.year("o_orderdate").cast("long")))
    return table(spark, sf, "orders").select("o_custkey", F.explode(F.flatten(lists)).alias("x")).groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum("x").alias("total")
    )


@query("sorted_rows", "K1", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sorted_rows(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query("top_rows", "K2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("top_third_of_rows", "K2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT (SELECT count(*) // 3 FROM orders)")
def top_third_of_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return positions.first_rows(o, [("o_totalprice", True), "o_orderkey"], o.count() // 3)


@query("top_keys_by_mean", "K3", """SELECT o_custkey, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY o_custkey
    ORDER BY avg(o_totalprice) DESC, o_custkey LIMIT 20""")
def top_keys_by_mean(spark, sf):
    return rounded(shaping.top_groups(table(spark, sf, "orders"), ["o_custkey"], F.avg("o_totalprice"), 20, name="mean"))


@query("lowest_keys_by_mean", "K3", """SELECT l_partkey, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY l_partkey
    ORDER BY avg(l_extendedprice), l_partkey LIMIT 20""")
def lowest_keys_by_mean(spark, sf):
    return rounded(
        shaping.top_groups(table(spark, sf, "lineitem"), ["l_partkey"], F.avg("l_extendedprice"), 20, False, "mean")
    )


@query("top_key", "K4", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 1")
def top_key(spark, sf):
    return shaping.top_groups(table(spark, sf, "lineitem"), ["l_suppkey"], F.count("*"), 1, name="n")


@query("largest_per_group", "K3 W5", """SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)::INT AS rank FROM lineitem)
    WHERE rank <= 5""")
def largest_per_group(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return shaping.largest_per_group(li, ["l_returnflag"], order, 5)


# --- aggregates ----------------------------------------------------------------


@query("global_statistics", "G3", """SELECT round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS low, max(o_totalprice) AS high,
    round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS std, round(var_samp(o_totalprice) / 1e6, 4) AS var_millions,
    round(sum(o_totalprice), 2) AS total FROM orders""")
def global_statistics(spark, sf):
    o = table(spark, sf, "orders")
    x = F.col("o_totalprice")
    middle = quantiles.medians(o, ["o_totalprice"])
    return o.agg(
        r(F.avg(x)).alias("mean"), F.min(x).alias("low"), F.max(x).alias("high"), r(F.stddev_samp(x)).alias("std"),
        r(F.var_samp(x) / 1e6).alias("var_millions"), r(F.sum(x), 2).alias("total"),
    ).withColumn("median", r(middle.scalar()))


@query("group_mean", "G4 K6", "SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS mean FROM lineitem GROUP BY 1, 2")
def group_mean(spark, sf):
    return rounded(
        grouping.group(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], mean=F.avg("l_extendedprice")).orderBy(F.desc("mean"))
    )


@query("group_median", "G5", "SELECT l_partkey, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY l_partkey")
def group_median(spark, sf):
    return rounded(grouping.group_with_median(table(spark, sf, "lineitem"), ["l_partkey"], "l_extendedprice"))


@query("group_sum", "G6", "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def group_sum(spark, sf):
    return rounded(grouping.group(table(spark, sf, "orders"), ["o_orderpriority"], total=F.sum("o_totalprice")), 2)


@query("group_variance", "G7", "SELECT event_type, round(var_samp(value), 4) AS variance FROM events GROUP BY 1")
def group_variance(spark, sf):
    return rounded(grouping.group(table(spark, sf, "events"), ["event_type"], variance=F.var_samp("value")).orderBy(F.desc("variance")))


@query("group_many", "G8 X4", """SELECT l_returnflag, round(median(l_extendedprice), 4) AS median, round(avg(l_extendedprice), 4) AS mean,
    count(*) AS n, round(stddev_samp(l_quantity), 4) AS spread, max(l_discount) AS discount FROM lineitem GROUP BY 1""")
def group_many(spark, sf):
    return rounded(
        grouping.group_with_median(
            table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", mean=F.avg("l_extendedprice"),
            n=F.count("*"), spread=F.stddev_samp("l_quantity"), discount=F.max("l_discount"),
        )
    )


@query("group_size", "G9", f"WITH {HOLED} SELECT event_type, count(*) AS n FROM holed WHERE event_type IS NOT NULL GROUP BY 1")
def group_size(spark, sf):
    return grouping.group(holed_events(spark, sf), ["event_type"], n=F.count("*"))


@query("conditional_counts", "G10 X1", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS finished,
    count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_totalprice > 400000) AS large FROM orders GROUP BY 1""")
def conditional_counts(spark, sf):
    c = F.col
    return grouping.group(
        table(spark, sf, "orders"), ["o_orderpriority"], finished=F.count_if(c("o_orderstatus") == "F"),
        open=F.count_if(c("o_orderstatus") == "O"), large=F.count_if(c("o_totalprice") > 400000),
    )


def _describe_sql(relation: str, columns: list[str]) -> str:
    part = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}, 0.1)::DOUBLE, 4) AS p10, round(quantile_cont({c}, 0.25)::DOUBLE, 4) AS p25,
        round(quantile_cont({c}, 0.5)::DOUBLE, 4) AS p50, round(quantile_cont({c}, 0.75)::DOUBLE, 4) AS p75,
        round(quantile_cont({c}, 0.9)::DOUBLE, 4) AS p90, round(max({c})::DOUBLE, 4) AS max, round(skewness({c}), 4) AS skewness,
        round(kurtosis({c}), 4) AS kurtosis, round(stddev_samp({c}) / avg({c}) * 100, 2) AS cv_pct FROM {t}"""
    return " UNION ALL ".join(part.format(c=c, t=relation) for c in columns)


@query("describe_lines", "G11 G12 G13 G14 G15", _describe_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def describe_lines(spark, sf):
    return rounded(profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("describe_with_nulls", "G11", f"WITH {HOLED} " + _describe_sql("holed", ["value", "user_id"]))
def describe_with_nulls(spark, sf):
    return rounded(profile.describe(holed_events(spark, sf), ["value", "user_id"]))


@query("quantiles_whole_table", "G15", """SELECT round(quantile_cont(l_extendedprice, 0.02), 4) AS p02,
    round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.98), 4) AS p98 FROM lineitem""")
def quantiles_whole_table(spark, sf):
    q = quantiles.quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], [0.02, 0.5, 0.98], bracket=True)
    x = F.col("l_extendedprice")
    return q.select(r(x[0]).alias("p02"), r(x[1]).alias("p50"), r(x[2]).alias("p98"))


@query("quantiles_per_group", "G5 G15", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1,
    round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, round(quantile_cont(l_quantity, 0.25), 4) AS quantity_q1,
    round(quantile_cont(l_quantity, 0.75), 4) AS quantity_q3 FROM lineitem GROUP BY l_returnflag""")
def quantiles_per_group(spark, sf):
    q = quantiles.quantiles(
        table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], [0.25, 0.75], ["l_returnflag"], bracket=True
    )
    p, n = F.col("l_extendedprice"), F.col("l_quantity")
    return q.select(
        "l_returnflag", r(p[0]).alias("q1"), r(p[1]).alias("q3"), r(n[0]).alias("quantity_q1"), r(n[1]).alias("quantity_q3")
    )


@query("value_counts", "G16 G17", """SELECT l_suppkey, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM lineitem), 6) AS pct
    FROM lineitem GROUP BY l_suppkey""")
def value_counts(spark, sf):
    return rounded(grouping.value_counts(table(spark, sf, "lineitem"), "l_suppkey"), 6)


@query("top_value_counts", "G16 F20", f"""WITH {HOLED} SELECT event_type, count(*) AS count,
    round(count(*) * 100.0 / (SELECT count(event_type) FROM holed), 4) AS pct FROM holed WHERE event_type IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 3""")
def top_value_counts(spark, sf):
    return rounded(grouping.value_counts(holed_events(spark, sf), "event_type", 3))


_CATEGORY = """SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM {t}) AS unique_count,
    first(v ORDER BY n DESC, v) AS top_value, max(n) AS top_freq,
    round(max(n) * 100.0 / (SELECT count(*) FROM {t}), 2) AS top_pct,
    string_agg(v || '=' || n, '|' ORDER BY n DESC, v) AS listed
    FROM (SELECT {c} AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 10)"""


@query("categorical_summary", "G18", " UNION ALL ".join(_CATEGORY.format(c=c, t="part") for c in ("p_name", "p_brand", "p_type")))
def categorical_summary(spark, sf):
    s = profile.categorical_summary(table(spark, sf, "part"))
    text = F.transform(F.map_entries("value_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return s.withColumn("listed", F.array_join(text, "|")).drop("value_counts")


@query("distinct_counts", "G19", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def distinct_counts(spark, sf):
    found = profile.distinct_counts(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], ["l_returnflag"])
    number = lambda c: F.max(F.when(F.col("column") == c, F.col("n_unique")))
    return found.groupBy("l_returnflag").agg(number("l_partkey").alias("parts"), number("l_suppkey").alias("suppliers"))


@query("distinct_counts_of_lines", "G19", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique FROM lineitem""" for c in (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")))
def distinct_counts_of_lines(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"))


@query("predicate_shares", "G20", f"""WITH {HOLED} SELECT round(avg(coalesce(value <= 20, false)::INT) * 100, 4) AS low,
    round(avg(coalesce(value > 100, false)::INT) * 100, 4) AS high FROM holed""")
def predicate_shares(spark, sf):
    v = F.col("value")
    return holed_events(spark, sf).agg(
        r(grouping.share_where(v <= 20)).alias("low"), r(grouping.share_where(v > 100)).alias("high")
    )


@query("conditional_aggregates", "G21", """SELECT round(avg(l_extendedprice) FILTER (l_returnflag = 'R'), 4) AS returned_mean,
    round(avg(l_extendedprice) FILTER (l_returnflag <> 'R'), 4) AS kept_mean,
    round(median(l_extendedprice) FILTER (l_quantity = 1), 4) AS single_median,
    round(median(l_extendedprice) FILTER (l_quantity >= 30), 4) AS bulk_median FROM lineitem""")
def conditional_aggregates(spark, sf):
    li = table(spark, sf, "lineitem")
    x, q = F.col("l_extendedprice"), F.col("l_quantity")
    returned = F.col("l_returnflag") == "R"
    mids = quantiles.medians(
        li.select(F.when(q == 1, x).alias("single_median"), F.when(q >= 30, x).alias("bulk_median")),
        ["single_median", "bulk_median"],
    )
    means = li.agg(r(F.avg(F.when(returned, x))).alias("returned_mean"), r(F.avg(F.when(~returned, x))).alias("kept_mean"))
    return means.withColumn("m", mids.select(F.struct("*")).scalar()).select(
        "returned_mean", "kept_mean", r("m.single_median").alias("single_median"), r("m.bulk_median").alias("bulk_median")
    )


@query("group_extremes", "G22", """WITH g AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1)
    SELECT (SELECT k FROM g ORDER BY n DESC, k LIMIT 1) AS top_key, max(n) AS top_value,
        (SELECT k FROM g ORDER BY n, k LIMIT 1) AS low_key, min(n) AS low_value FROM g""")
def group_extremes(spark, sf):
    return grouping.extremes(grouping.group(table(spark, sf, "orders"), ["o_custkey"], n=F.count("*")), "o_custkey", "n")


@query("crosstab_counts", "G23", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F",
    count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def crosstab_counts(spark, sf):
    return grouping.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("crosstab_percent", "G24", """SELECT l_linestatus, round(avg((l_returnflag = 'A')::INT) * 100, 4) AS "A",
    round(avg((l_returnflag = 'N')::INT) * 100, 4) AS "N", round(avg((l_returnflag = 'R')::INT) * 100, 4) AS "R" FROM lineitem GROUP BY 1""")
def crosstab_percent(spark, sf):
    return rounded(grouping.crosstab_percent(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag", ["A", "N", "R"]))


@query("pivot_mean", "G25", """SELECT l_returnflag, round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 4) AS "F",
    round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 4) AS "O" FROM lineitem GROUP BY 1""")
def pivot_mean(spark, sf):
    return rounded(grouping.pivot_mean(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_extendedprice", ["F", "O"]))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _pairs_sql(relation: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM {relation}"
        for i, a in enumerate(columns) for b in columns[i + 1:]
    )


@query("correlation_matrix", "G26", _pairs_sql("lineitem", _NUMBERS))
def correlation_matrix(spark, sf):
    return rounded(profile.correlations(table(spark, sf, "lineitem"), _NUMBERS), 6)


@query("top_correlations", "G27", f"SELECT * FROM ({_pairs_sql('lineitem', _NUMBERS)}) ORDER BY abs(r) DESC, x, y LIMIT 4")
def top_correlations(spark, sf):
    return rounded(profile.top_correlations(table(spark, sf, "lineitem"), _NUMBERS, 4), 6)


@query("date_ranges", "G28 F16", """SELECT 'o_orderdate' AS "column", strftime(min(o_orderdate), '%Y-%m-%d') AS first,
    strftime(max(o_orderdate), '%Y-%m-%d') AS last, date_diff('day', min(o_orderdate), max(o_orderdate))::INT AS days FROM orders""")
def date_ranges(spark, sf):
    d = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return profile.date_ranges(table(spark, sf, "orders")).select("column", d("first"), d("last"), "days")


@query("geo_summary", "G29", """SELECT round(min(lat), 6) AS lat_min, round(max(lat), 6) AS lat_max, round(min(lon), 6) AS lon_min,
    round(max(lon), 6) AS lon_max, round(avg(lat), 6) AS center_lat, round(avg(lon), 6) AS center_lon
    FROM (SELECT embedding[1]::DOUBLE AS lat, embedding[2]::DOUBLE AS lon FROM embeddings)""")
def geo_summary(spark, sf):
    e = table(spark, sf, "embeddings").select(
        F.col("embedding")[0].cast("double").alias("lat"), F.col("embedding")[1].cast("double").alias("lon")
    )
    return rounded(profile.geo_summary(e, "lat", "lon"), 6)


@query("data_quality", "G1", f"""WITH {HOLED} SELECT count(*) AS total_rows, 5::BIGINT AS total_columns, count(*) * 5 AS total_cells,
    count(*) * 5 - count(event_id) - count(user_id) - count(value) - count(event_type) - count(ts) AS null_cells,
    round((count(event_id) + count(user_id) + count(value) + count(event_type) + count(ts)) * 100.0 / (count(*) * 5), 2) AS completeness_pct,
    3::BIGINT AS numeric_columns, 1::BIGINT AS categorical_columns, 1::BIGINT AS datetime_columns FROM holed""")
def data_quality(spark, sf):
    return profile.data_quality(holed_events(spark, sf))


_SCHEMA = """SELECT '{c}' AS "column", '{d}' AS dtype, count(DISTINCT {c}) AS n_unique,
    round(avg(({c} IS NULL)::INT) * 100, 2) AS null_pct FROM holed"""


@query("schema_profile", "G2 G19 P36", f"WITH {HOLED} " + " UNION ALL ".join(
    _SCHEMA.format(c=c, d=d) for c, d in
    (("event_id", "bigint"), ("user_id", "bigint"), ("value", "double"), ("event_type", "string"), ("ts", "timestamp"))))
def schema_profile(spark, sf):
    return profile.schema_profile(holed_events(spark, sf)).select("column", "dtype", "n_unique", "null_pct")


@query("top_tenth_share", "G31", """WITH x AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice DESC) AS i,
        count(*) OVER () AS n FROM lineitem)
    SELECT max(n) AS n, max(n) // 10 AS k, round(sum(v) FILTER (i <= n // 10), 2) AS top_sum, round(sum(v), 2) AS total,
        round(sum(v) FILTER (i <= n // 10) / sum(v), 6) AS share FROM x""")
def top_tenth_share(spark, sf):
    t = quantiles.top_share(table(spark, sf, "lineitem"), "l_extendedprice", 0.1, bracket=True)
    return t.select("n", "k", r("top_sum", 2).alias("top_sum"), r("total", 2).alias("total"), r("share", 6).alias("share"))


@query("ratio_by_key", "G32", """SELECT o_orderpriority, count(*) FILTER (o_totalprice > 250000) AS hits, count(*) AS n,
    round(100.0 * count(*) FILTER (o_totalprice > 250000) / count(*), 2) AS pct FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""")
def ratio_by_key(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"))
    return grouping.ratio_by_key(o, "o_orderpriority", F.col("o_totalprice") > 250000)


@query("column_and_row_functions", "G33 X2", """SELECT l_returnflag, round(avg(greatest(l_discount, l_tax)), 6) AS row_max,
    round(avg(l_discount), 6) AS discount, round(avg(l_tax), 6) AS tax FROM lineitem GROUP BY 1""")
def column_and_row_functions(spark, sf):
    return rounded(
        grouping.group(
            table(spark, sf, "lineitem"), ["l_returnflag"], row_max=F.avg(F.greatest("l_discount", "l_tax")),
            discount=F.avg("l_discount"), tax=F.avg("l_tax"),
        ), 6,
    )


#: The days of a group's rows; a day counts once.
DAYS = applying.GroupFunction(
    start=lambda: np.zeros(0, np.int64),
    add=lambda days, batch: np.union1d(days, pc.drop_null(batch.column(0)).cast("int32").to_numpy()),
    merge=np.union1d,
    finish=lambda days: (int(np.diff(days).max()) if len(days) > 1 else None, len(days)),
)


@query("group_function_gaps", "X1", """WITH d AS (SELECT DISTINCT l_suppkey, l_shipdate::DATE AS d FROM lineitem WHERE l_suppkey IS NOT NULL AND l_shipdate IS NOT NULL),
    g AS (SELECT l_suppkey, (d - lag(d) OVER (PARTITION BY l_suppkey ORDER BY d))::BIGINT AS gap FROM d)
    SELECT l_suppkey, max(gap) AS longest_gap, count(*) AS days FROM g GROUP BY 1""")
def group_function_gaps(spark, sf):
    """The longest time without a shipment: a state that no built-in aggregate has."""
    li = table(spark, sf, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
    return applying.apply_groups(li, ["l_suppkey"], ["day"], DAYS, "longest_gap long, days long")


@query("group_function_count", "X1", "SELECT year(o_orderdate)::INT AS year, count(*) FILTER (o_orderstatus = 'F') AS closed FROM orders GROUP BY 1")
def group_function_count(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    closed = applying.summed(lambda rows: pc.sum(pc.equal(rows.column(0), "F")).as_py() or 0)
    return applying.apply_groups(o, ["year"], ["o_orderstatus"], closed, "closed long")


@query("group_function_whole", "X1", """WITH x AS (SELECT o_custkey, o_totalprice AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS i,
        count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    SELECT o_custkey, round(avg(v) FILTER (i > n // 10 AND i <= n - n // 10), 8) AS trimmed, count(*) AS n FROM x GROUP BY 1""")
def group_function_whole(spark, sf):
    """A mean without the lowest and highest tenth, from whole groups."""

    def trimmed(rows):
        v, cut = np.sort(rows["o_totalprice"].to_numpy()), len(rows) // 10
        return float(v[cut : len(v) - cut].mean()), len(v)

    found = applying.apply_whole_groups(table(spark, sf, "orders"), ["o_custkey"], ["o_totalprice"], trimmed, "trimmed double, n long")
    return rounded(found, 8)


@query("row_function", "X2 G33", f"""WITH {HOLED}, x AS (SELECT event_type, list_sort([value, user_id::DOUBLE, (event_id % 100)::DOUBLE]) AS s FROM holed WHERE value IS NOT NULL)
    SELECT event_type, round(avg(s[2]), 6) AS middle, round(avg(s[3] - s[1]), 6) AS spread, count(*) AS n FROM x GROUP BY 1""")
def row_function(spark, sf):
    """Functions along the rows of three columns; rows with a null among them have no value."""
    e = holed_events(spark, sf).withColumn("step", (F.col("event_id") % 100).cast("double"))
    three = ["value", "user_id", "step"]
    rows = applying.apply_rows(e, three, lambda f: f.median(axis=1), "middle", nulls="null")
    rows = applying.apply_rows(rows, three, lambda f: f.max(axis=1) - f.min(axis=1), "spread", nulls="null")
    return rounded(rows.groupBy("event_type").agg(F.avg("middle").alias("middle"), F.avg("spread").alias("spread"), F.count("middle").alias("n")), 6)


#: Number of values and sum of their logarithms.
LOGS = applying.GroupFunction(
    start=lambda: (0, 0.0),
    add=lambda s, batch: (s[0] + batch.num_rows - batch.column(0).null_count, s[1] + (pc.sum(pc.ln(batch.column(0))).as_py() or 0.0)),
    merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    finish=lambda s: (math.exp(s[1] / s[0]) if s[0] else None, s[0]),
)


@query("column_function", "X2 G33", f"WITH {HOLED} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(exp(avg(ln({c} + 1))), 6) AS geometric_mean, count({c}) AS n FROM holed""" for c in ("value", "user_id", "event_id")))
def column_function(spark, sf):
    """One function along each of three columns, in one pass."""
    e = holed_events(spark, sf)
    raised = e.select(*[(F.col(c) + 1.0).alias(c) for c in ("value", "user_id", "event_id")])
    return rounded(applying.apply_columns(raised, raised.columns, LOGS, "geometric_mean double, n long"), 6)


@query("map_columns", "X2 G33", f"""WITH {HOLED} SELECT event_id, round(value / (1 + abs(value)), 6) AS value, round(user_id / (1.0 + abs(user_id)), 6) AS user_id FROM holed""")
def map_columns(spark, sf):
    e = holed_events(spark, sf).select("event_id", "value", "user_id")
    return rounded(applying.map_columns(e, ["value", "user_id"], lambda v: v / (1 + v.abs()), "double"), 6)


@query("keys_with_many_rows", "G34", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 35")
def keys_with_many_rows(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).filter("n >= 35")


@query("aggregate_range_filter", "G35", """SELECT l_suppkey, round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY 1
    HAVING avg(l_discount) BETWEEN 0.049 AND 0.051""")
def aggregate_range_filter(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg("l_discount").alias("discount"))
    return rounded(g.filter(F.col("discount").between(0.049, 0.051)), 6)


@query("share_of_named_groups", "G36", "SELECT round(avg((o_orderstatus IN ('F', 'P'))::INT) * 100, 6) AS pct FROM orders")
def share_of_named_groups(spark, sf):
    return table(spark, sf, "orders").agg(r(grouping.share_where(F.col("o_orderstatus").isin("F", "P")), 6).alias("pct"))


@query("ratio_between_groups", "G37", """SELECT round(median(o_totalprice) FILTER (o_orderstatus = 'F') /
    median(o_totalprice) FILTER (o_orderstatus = 'P'), 6) AS ratio FROM orders""")
def ratio_between_groups(spark, sf):
    m = quantiles.medians(table(spark, sf, "orders"), ["o_totalprice"], ["o_orderstatus"])
    pick = lambda s: F.max(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")))
    return m.agg(r(F.try_divide(pick("F"), pick("P")), 6).alias("ratio"))


@query("modes", "P21 G16", """WITH c AS (SELECT 'p_type' AS "column", p_type AS value, count(*) AS n FROM part GROUP BY ALL
        UNION ALL SELECT 'p_name', p_name, count(*) FROM part GROUP BY ALL)
    SELECT "column", value, n FROM c QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) = 1""")
def modes(spark, sf):
    return imputing.modes(table(spark, sf, "part"), ["p_type", "p_name"])


# --- windows ---------------------------------------------------------------------


@query("share_of_total", "W2", """SELECT p_brand, round(sum(p_retailprice), 2) AS total,
    round(sum(p_retailprice) / sum(sum(p_retailprice)) OVER (), 6) AS share FROM part GROUP BY p_brand""")
def share_of_total(spark, sf):
    g = table(spark, sf, "part").groupBy("p_brand").agg(F.sum("p_retailprice").alias("total"))
    return running.share_of_total(g, "total").select("p_brand", r("total", 2).alias("total"), r("share", 6).alias("share"))


@query("cumulative_sum", "W3", """SELECT event_id, row_number() OVER (ORDER BY event_id) AS running_n,
    round(sum(value) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING), 2) AS running_sum FROM events""")
def cumulative_sum(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return running.running_totals(e, "value", ["event_id"], chunks=16).select(
        "event_id", "running_n", r("running_sum", 2).alias("running_sum")
    )


@query("cumulative_sum_per_key", "W3", """SELECT event_id, round(sum(value) OVER
    (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running_sum FROM events""")
def cumulative_sum_per_key(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    return running.running_totals(e, "value", ["ts", "event_id"], ["event_type"], chunks=16).select(
        "event_id", r("running_sum", 2).alias("running_sum")
    )


@query("limit_ledger", "W6", """WITH w AS (SELECT *, row_number() OVER o AS n, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS total FROM events
        WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)),
    v AS (SELECT *, max((n > 30 OR total > 600)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS broken,
        max((n > 30 OR total > 600)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ended FROM w)
    SELECT event_id, user_id, (broken = 0)::INT AS accepted, CASE WHEN broken = 0 THEN 'accepted' WHEN ended = 1 THEN 'session ended'
        WHEN n > 30 THEN 'count limit passed' ELSE 'total limit passed' END AS reason FROM v""")
def limit_ledger(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return running.limit_ledger(e, "user_id", "value", ["ts", "event_id"], 30, 600.0, chunks=16).select(
        "event_id", "user_id", "accepted", "reason"
    )
