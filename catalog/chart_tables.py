"""Tables behind charts."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import LISTING, listings, query, r, rounded, table
from fieldbook.operators import charts, cleaning, quantiles
from fieldbook.session import materialise

HISTOGRAM = """b AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS n, (max(v) - min(v)) / {bins} AS w FROM x),
    c AS (SELECT least(floor((v - lo) / w), {bins} - 1)::INT AS bin, count(*) AS c FROM x, b WHERE v IS NOT NULL GROUP BY 1)
    SELECT i::INT AS bin, round(lo + i * w, 4) AS low, round(lo + (i + 1) * w, 4) AS high, coalesce(c, 0) AS count,
        round(coalesce(c, 0) / (n * w), 8) AS density FROM range({bins}) s(i) CROSS JOIN b LEFT JOIN c ON bin = i"""


def _histogram(df, column, bins):
    h = charts.histogram(df, column, bins)
    return h.select("bin", r("low").alias("low"), r("high").alias("high"), "count", r("density", 8).alias("density"))


@query("histogram", "V1", "WITH x AS (SELECT l_extendedprice AS v FROM lineitem), " + HISTOGRAM.format(bins=50))
def histogram(spark, sf):
    return _histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50)


@query("histogram_after_clip", "V1 P23", """WITH q AS (SELECT quantile_cont(value, 0.95) AS hi FROM events),
    x AS (SELECT least(value, hi) AS v FROM events, q), """ + HISTOGRAM.format(bins=30))
def histogram_after_clip(spark, sf):
    e = table(spark, sf, "events")
    high = quantiles.quantiles(e, ["value"], [0.95]).first()["value"][0]
    return _histogram(e.select(cleaning.clip(F.col("value"), upper=F.lit(high)).alias("v")), "v", 30)


DENSITY = """k AS (SELECT g, v, count(*) AS k FROM x GROUP BY g, v),
    s AS (SELECT g, count(v) AS n, stddev_samp(v) * power(count(v), -0.2) AS h, min(v) - (max(v) - min(v)) / 2 AS a, 2 * (max(v) - min(v)) / {last} AS step FROM x GROUP BY g),
    p AS (SELECT g, i::INT AS point, a + i * step AS px, h, n FROM s, range({last} + 1) r(i))
    SELECT {key}point, round(px, 4) AS x, round(sum(k * exp(-0.5 * power((px - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
    FROM p JOIN k USING (g) GROUP BY p.g, point, px"""


@query("density_curve", "V2", "WITH x AS (SELECT 0 AS g, value AS v FROM events), " + DENSITY.format(last=999, key=""))
def density_curve(spark, sf):
    d = charts.density_curve(table(spark, sf, "events"), "value")
    return d.select("point", r("x").alias("x"), r("density", 9).alias("density"))


@query("density_per_group", "V2 V4", "WITH x AS (SELECT c_mktsegment AS g, c_acctbal AS v FROM customer), " + DENSITY.format(last=999, key="p.g AS c_mktsegment, "))
def density_per_group(spark, sf):
    d = charts.density_curve(table(spark, sf, "customer"), "c_acctbal", "c_mktsegment")
    return d.select("c_mktsegment", "point", r("x").alias("x"), r("density", 9).alias("density"))


BOX = """q AS (SELECT g, quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3 FROM x GROUP BY g),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT g AS {g}, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3, count(*) AS n,
        min(v) FILTER (v BETWEEN lo AND hi) AS whisker_low, max(v) FILTER (v BETWEEN lo AND hi) AS whisker_high,
        count(*) FILTER (NOT v BETWEEN lo AND hi) AS outliers FROM x JOIN f USING (g) GROUP BY g"""


@query("box_statistics", "V3", "WITH x AS (SELECT event_type AS g, value AS v FROM events), " + BOX.format(g="event_type"))
def box_statistics(spark, sf):
    return rounded(charts.box_statistics(table(spark, sf, "events"), "value", "event_type"))


@query("box_statistics_lines", "V3", "WITH x AS (SELECT l_returnflag AS g, l_extendedprice AS v FROM lineitem), " + BOX.format(g="l_returnflag"))
def box_statistics_lines(spark, sf):
    return rounded(charts.box_statistics(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag"))


@query("violin_statistics", "V4", "WITH x AS (SELECT c_mktsegment AS g, c_acctbal AS v FROM customer), d AS (" + DENSITY.format(last=99, key="p.g AS c_mktsegment, ").replace("k AS (SELECT g, v, count(*) AS k FROM x GROUP BY g, v),", "WITH k AS (SELECT g, v, count(*) AS k FROM x GROUP BY g, v),", 1) + """)
    SELECT d.*, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3 FROM d JOIN
    (SELECT g, quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3 FROM x GROUP BY g) ON g = c_mktsegment""")
def violin_statistics(spark, sf):
    v = charts.violin_statistics(table(spark, sf, "customer"), "c_acctbal", "c_mktsegment")
    return v.select(
        "c_mktsegment", "point", r("x").alias("x"), r("density", 9).alias("density"), r("q1").alias("q1"),
        r("median").alias("median"), r("q3").alias("q3"),
    )


@query("count_shares", "V5", "SELECT o_orderpriority, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct FROM orders GROUP BY 1")
def count_shares(spark, sf):
    from fieldbook.operators.grouping import value_counts

    return rounded(value_counts(table(spark, sf, "orders"), "o_orderpriority"))


@query("stacked_shares", "V6", """SELECT p_type, p_brand, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY p_type), 4) AS pct
    FROM part GROUP BY 1, 2""")
def stacked_shares(spark, sf):
    from fieldbook.operators.grouping import cross_counts

    return rounded(cross_counts(table(spark, sf, "part"), "p_type", "p_brand"))


@query("scatter_sample", "V7 P31", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, (SELECT round(quantile_cont(o_totalprice, 0.98), 4) FROM orders) AS y_limit
    FROM orders ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey LIMIT 300""")
def scatter_sample(spark, sf):
    s = charts.scatter_sample(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderkey", 300, "o_orderstatus", 0.98)
    return rounded(s)


PAIRED = ["p_size", "p_retailprice", "p_partkey"]


@query("pair_plot_diagonal", "V8", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", * FROM (WITH x AS (SELECT {c}::DOUBLE AS v FROM part), {HISTOGRAM.format(bins=12)})" for c in PAIRED))
def pair_plot_diagonal(spark, sf):
    panels = charts.pair_plot(table(spark, sf, "part"), PAIRED, "p_partkey", 200, 12)
    return reduce(DataFrame.unionByName, [
        panels[f"hist_{c}"].select(F.lit(c).alias("column"), "bin", r("low").alias("low"), r("high").alias("high"), "count", r("density", 8).alias("density"))
        for c in PAIRED
    ])


@query("pair_plot_scatter", "V8", "WITH s AS (SELECT * FROM part ORDER BY md5(p_partkey::VARCHAR || ':42'), p_partkey LIMIT 200) " + " UNION ALL ".join(
    f"SELECT '{a}' AS x_column, '{b}' AS y_column, p_partkey AS key, {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM s" for a, b in combinations(PAIRED, 2)))
def pair_plot_scatter(spark, sf):
    panels = charts.pair_plot(table(spark, sf, "part"), PAIRED, "p_partkey", 200)
    return reduce(DataFrame.unionByName, [
        panels[f"scatter_{a}_{b}"].toDF("key", "x", "y").select(
            F.lit(a).alias("x_column"), F.lit(b).alias("y_column"), "key", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
        for a, b in combinations(PAIRED, 2)
    ])


# Dates of March are moved to February, so that the calendar has gaps to fill.
@query("month_ends", "V9 F18", """WITH x AS (SELECT CASE WHEN month(o_orderdate) = 3 THEN o_orderdate::DATE - INTERVAL 31 DAY ELSE o_orderdate::DATE END::DATE AS d, o_totalprice FROM orders),
    m AS (SELECT last_day(d) AS m, count(*) AS n, avg(o_totalprice) AS mean FROM x GROUP BY 1),
    c AS (SELECT last_day(d::DATE) AS m FROM (SELECT unnest(generate_series(date_trunc('month', (SELECT min(m) FROM m)), date_trunc('month', (SELECT max(m) FROM m)), INTERVAL 1 MONTH)) AS d))
    SELECT strftime(c.m, '%Y-%m-%d') AS month_end, coalesce(n, 0) AS n, round(mean, 4) AS mean FROM c LEFT JOIN m ON c.m = m.m""")
def month_ends(spark, sf):
    day = F.col("o_orderdate").cast("date")
    o = table(spark, sf, "orders").withColumn("day", F.when(F.month(day) == 3, F.date_sub(day, 31)).otherwise(day))
    m = charts.month_ends(o, "day", n=F.count("*"), mean=F.avg("o_totalprice"))
    return m.select(F.date_format("month_end", "yyyy-MM-dd").alias("month_end"), "n", r("mean").alias("mean"))


@query("weekday_profile", "V10 F15", "SELECT (isodow(ts) - 1)::INT AS part, count(*) AS n FROM events GROUP BY 1")
def weekday_profile(spark, sf):
    return charts.calendar_profile(table(spark, sf, "events"), "ts", F.weekday("ts"))


@query("quarter_profile", "V10", "SELECT quarter(o_orderdate)::INT AS part, count(*) AS n FROM orders GROUP BY 1")
def quarter_profile(spark, sf):
    return charts.calendar_profile(table(spark, sf, "orders"), "o_orderdate", F.quarter("o_orderdate"))


@query("month_profile", "V10", "SELECT month(o_orderdate)::INT AS part, count(*) AS n FROM orders GROUP BY 1")
def month_profile(spark, sf):
    return charts.calendar_profile(table(spark, sf, "orders"), "o_orderdate", F.month("o_orderdate"))


@query("kpi_tiles", "V11", f"""WITH {LISTING} SELECT count(*) AS listings, round(avg(availability), 4) AS availability, round(avg(reviews), 4) AS reviews,
    max(price) AS highest FROM listing""")
def kpi_tiles(spark, sf):
    return rounded(
        charts.kpi_tiles(
            listings(spark, sf), listings=F.count("*"), availability=F.avg("availability"), reviews=F.avg("reviews"), highest=F.max("price")
        )
    )


MEASURES = ["price", "price_capped", "availability", "min_nights", "reviews", "reviews_per_month", "host_listings", "revenue"]


@query("correlation_triangle", "V12", f"""WITH {LISTING} """ + " UNION ALL ".join(
    f"""SELECT '{b}' AS "row", '{a}' AS "column", round(corr({a}, {b}), 6) AS r FROM listing"""
    for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]
))
def correlation_triangle(spark, sf):
    return rounded(charts.correlation_triangle(listings(spark, sf)), 6)


@query("dual_ranking", "V13 K3 J4 G5", f"""WITH {LISTING}, t AS (SELECT area, count(*) AS c FROM listing GROUP BY 1 ORDER BY c DESC, area LIMIT 20)
    SELECT area, any_value(c) AS count, round(median(price), 4) AS median,
        (median(price) > (SELECT median(price) FROM listing))::INT AS above_overall FROM listing JOIN t USING (area) GROUP BY area""")
def dual_ranking(spark, sf):
    stored = materialise(listings(spark, sf).select("area", "price"), "areas")
    return rounded(charts.dual_ranking(stored, "area", "price"))
