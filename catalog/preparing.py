"""Sources, sinks, projection, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import HOLED, holed_events, query, r, rounded, table
from fieldbook.functions.text import strip, title_case
from fieldbook.operators import binning, cleaning, imputing, shaping
from fieldbook.plans.job import PRICE_TIERS
from fieldbook.session import scratch_path
from fieldbook.sources import nested, readers, sinks

PART_SUMMARY = """SELECT p_type, count(*) AS n, min(p_size)::BIGINT AS smallest,
    round(sum(p_retailprice), 2) AS total FROM part GROUP BY p_type"""


def _part_summary(df):
    return df.groupBy("p_type").agg(
        F.count("*").alias("n"), F.min("p_size").cast("long").alias("smallest"),
        r(F.sum("p_retailprice"), 2).alias("total"),
    )


@query("csv_scan", "S1 S7 S8", PART_SUMMARY)
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv") + "/part.csv"
    table(spark, sf, "part").write.option("header", True).csv(path)
    return _part_summary(readers.require_rows(readers.read_any(spark, path)))


@query("declared_schema_scan", "S10", PART_SUMMARY)
def declared_schema_scan(spark, sf):
    path = scratch_path(spark, "csv") + "/part.csv"
    part = table(spark, sf, "part")
    part.write.option("header", True).csv(path)
    return _part_summary(readers.read_csv(spark, path, part.schema))


@query("tsv_scan", "S2", """SELECT s_nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS balance
    FROM supplier GROUP BY s_nationkey""")
def tsv_scan(spark, sf):
    path = scratch_path(spark, "tsv") + "/supplier.tsv"
    table(spark, sf, "supplier").write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_any(spark, path).groupBy("s_nationkey").agg(
        F.count("*").alias("n"), r(F.sum("s_acctbal"), 2).alias("balance")
    )


@query("json_scan", "S3", """SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer GROUP BY c_mktsegment""")
def json_scan(spark, sf):
    path = scratch_path(spark, "json") + "/customer.json"
    customer = table(spark, sf, "customer")
    customer.write.json(path)
    return readers.read_any(spark, path, schema=customer.schema, lines=True).groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), r(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("parquet_scan", "S4 S7", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def parquet_scan(spark, sf):
    return readers.read_any(spark, f"{sf}/orders.parquet").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("sql_scan", "S6", """SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS largest
    FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority""")
def sql_scan(spark, sf):
    return readers.read_sql(
        spark,
        """SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS largest
           FROM {orders} WHERE o_totalprice > 100000 GROUP BY o_orderpriority""",
        orders=table(spark, sf, "orders"),
    )


@query("literal_lookup", "S9 P7 J1", """SELECT label, count(*) AS n FROM customer
    JOIN (VALUES ('BUILDING', 'property'), ('MACHINERY', 'industry'), ('HOUSEHOLD', 'home')) v(segment, label)
    ON c_mktsegment = segment GROUP BY label""")
def literal_lookup(spark, sf):
    labels = readers.literal_frame(
        spark, {"c_mktsegment": ["BUILDING", "MACHINERY", "HOUSEHOLD"], "label": ["property", "industry", "home"]}
    )
    return table(spark, sf, "customer").join(labels, "c_mktsegment").groupBy("label").agg(F.count("*").alias("n"))


@query("materialised_extract", "S11", """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def materialised_extract(spark, sf):
    path = scratch_path(spark, "extract")
    sinks.write_partitioned(table(spark, sf, "orders"), path, ["o_orderstatus"])
    return readers.read_parquet(spark, path).filter(F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), r(F.sum("o_totalprice"), 2).alias("total")
    )


NESTED = """WITH m AS (
        SELECT o_custkey::VARCHAR AS enrollment, year(o_orderdate)::INT AS sem, o_orderstatus AS sub, o_totalprice / 5000 AS mark
        FROM orders),
    s AS (SELECT enrollment, sem, avg(mark) AS spi FROM m GROUP BY ALL),
    c AS (SELECT *, avg(spi) OVER (PARTITION BY enrollment ORDER BY sem) AS cpi FROM s)
    SELECT enrollment, sem, sub, count(*) AS n, round(sum(mark), 6) AS total, round(min(spi), 10) AS spi, round(min(cpi), 10) AS cpi
    FROM m JOIN c USING (enrollment, sem) GROUP BY enrollment, sem, sub"""


def _nested(spark, sf, saved=None):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("enrollment"), F.col("o_custkey").cast("string").alias("name"),
        F.year("o_orderdate").alias("sem"), F.col("o_orderstatus").alias("sub"), (F.col("o_totalprice") / 5000).alias("mark"),
    )
    flat = nested.marks_round_trip(spark, rows, scratch_path(spark, "marks"), saved)
    return flat.groupBy("enrollment", "sem", "sub").agg(
        F.count("*").alias("n"), r(F.sum("mark"), 6).alias("total"), r(F.min("spi"), 10).alias("spi"), r(F.min("cpi"), 10).alias("cpi")
    )


@query("nested_marks", "S15", NESTED)
def nested_marks(spark, sf):
    return _nested(spark, sf)


@query("nested_marks_table", "S15", NESTED)
def nested_marks_table(spark, sf):
    """The same by way of a saved table."""
    path = scratch_path(spark, "marks_table")
    return _nested(spark, sf, path.rsplit("/", 1)[-1].replace("-", "_"))


@query("project_columns", "P1", "SELECT o_orderkey, o_totalprice FROM orders")
def project_columns(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@query("row_at_position", "P2", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_orderkey LIMIT 1 OFFSET 1234""")
def row_at_position(spark, sf):
    return shaping.row_at(table(spark, sf, "orders"), 1234, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("columns_by_type", "P3 M12", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def columns_by_type(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*shaping.columns_of(li, "numeric"))


@query("drop_listed_columns", "P4", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_listed_columns(spark, sf):
    return cleaning.drop_listed(table(spark, sf, "customer"), ["C_Name", "C_AcctBal", "absent"])


@query("tidy_names", "P5 P6 F2", """SELECT p_partkey AS part_key, p_name AS product_name, p_size AS size_cm, p_type AS kind
    FROM part""")
def tidy_names(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias(" Part  Key "), F.col("p_name").alias("Product\tName"),
        F.col("p_size").alias("Size (cm)"), F.col("p_type").alias("TYPE"),
    )
    return cleaning.tidy_columns(p).withColumnRenamed("type", "kind")


@query("cast_columns", "P8", """SELECT o_orderkey, o_custkey::DOUBLE AS custkey, floor(o_totalprice)::BIGINT AS price,
    try_cast(o_orderpriority AS BIGINT) AS priority FROM orders""")
def cast_columns(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("double").alias("custkey"),
        F.floor("o_totalprice").cast("long").alias("price"), F.col("o_orderpriority").try_cast("long").alias("priority"),
    )


@query("range_filter", "P9", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 30000 AND o_totalprice <= 60000""")
def range_filter(spark, sf):
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").filter((p > 30000) & (p <= 60000)).select("o_orderkey", "o_totalprice")


@query("conjunctive_filter", "P10", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 30 AND l_discount < 0.03""")
def conjunctive_filter(spark, sf):
    c = F.col
    return table(spark, sf, "lineitem").filter(
        (c("l_returnflag") == "R") & (c("l_quantity") >= 30) & (c("l_discount") < 0.03)
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("derived_filter", "P11", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_quantity - l_linenumber + 1 = 33 AND l_extendedprice / l_quantity < 1500""")
def derived_filter(spark, sf):
    return table(spark, sf, "lineitem").filter(
        "l_quantity - l_linenumber + 1 = 33 AND l_extendedprice / l_quantity < 1500"
    ).select("l_orderkey", "l_linenumber")


@query("membership_filter", "P12", """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""")
def membership_filter(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("positive_rows", "P13", """SELECT count(*) AS rows_in, count(*) FILTER (c_acctbal > 0) AS kept,
    count(*) FILTER (NOT c_acctbal > 0) AS removed FROM customer""")
def positive_rows(spark, sf):
    ok = F.col("c_acctbal") > 0
    return table(spark, sf, "customer").agg(
        F.count("*").alias("rows_in"), F.count_if(ok).alias("kept"), F.count_if(~ok).alias("removed")
    )


@query("drop_duplicates", "P14", """WITH d AS (SELECT event_id, user_id, event_type FROM events
        UNION ALL SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click')
    SELECT event_type, count(*) AS n FROM (SELECT DISTINCT * FROM d) GROUP BY event_type""")
def drop_duplicates(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    doubled = e.unionByName(e.filter(F.col("event_type") == "click"))
    return doubled.dropDuplicates().groupBy("event_type").agg(F.count("*").alias("n"))


@query("drop_null_rows", "P15 J5", f"""WITH {HOLED} SELECT event_id, value, event_type FROM holed
    WHERE value IS NOT NULL AND event_type IS NOT NULL""")
def drop_null_rows(spark, sf):
    return holed_events(spark, sf).na.drop(subset=["value", "event_type"]).select("event_id", "value", "event_type")


@query("drop_null_columns", "P16", "SELECT event_id, user_id FROM events")
def drop_null_columns(spark, sf):
    return cleaning.drop_null_columns(holed_events(spark, sf))


@query("null_mask", "P17", f"""WITH {HOLED} SELECT event_id, 0 AS user_id, (value IS NULL)::INT AS value,
    (event_type IS NULL)::INT AS event_type, (ts IS NULL)::INT AS ts FROM holed""")
def null_mask(spark, sf):
    return cleaning.null_mask(holed_events(spark, sf), keep=["event_id"])


@query("null_map", "P17", f"""WITH {HOLED}, b AS (
        SELECT *, least(floor((event_id - (SELECT min(event_id) FROM holed)) * 20.0 /
            (SELECT max(event_id) - min(event_id) FROM holed)), 19)::BIGINT AS bucket FROM holed)
    SELECT bucket, 'value' AS "column", count(*) FILTER (value IS NULL) AS nulls FROM b GROUP BY bucket
    UNION ALL SELECT bucket, 'ts', count(*) FILTER (ts IS NULL) FROM b GROUP BY bucket""")
def null_map(spark, sf):
    return cleaning.null_map(holed_events(spark, sf), "event_id", 20, ["value", "ts"])


@query("fill_constant", "P18", f"WITH {HOLED} SELECT event_id, coalesce(value, 0) AS value, coalesce(event_type, 'none') AS event_type FROM holed")
def fill_constant(spark, sf):
    return holed_events(spark, sf).na.fill({"value": 0.0, "event_type": "none"}).select("event_id", "value", "event_type")


@query("fill_mean", "P18 J6", f"WITH {HOLED} SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM holed)), 4) AS value FROM holed")
def fill_mean(spark, sf):
    return rounded(imputing.fill_mean(holed_events(spark, sf), ["value"]).select("event_id", "value"))


@query("fill_median", "P19", f"WITH {HOLED} SELECT event_id, round(coalesce(value, (SELECT median(value) FROM holed)), 4) AS value FROM holed")
def fill_median(spark, sf):
    return rounded(imputing.fill_median(holed_events(spark, sf), ["value"]).select("event_id", "value"))


@query("fill_previous", "P20 W1", f"""WITH {HOLED} SELECT event_id, strftime(last_value(ts IGNORE NULLS) OVER
    (ORDER BY event_id ROWS UNBOUNDED PRECEDING), '%Y-%m-%d %H:%M:%S') AS ts FROM holed""")
def fill_previous(spark, sf):
    return imputing.fill_previous(holed_events(spark, sf), ["ts"], "event_id").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")
    )


@query("fill_previous_per_key", "P20 W1", f"""WITH {HOLED} SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER
    (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS value FROM holed""")
def fill_previous_per_key(spark, sf):
    from fieldbook.operators.running import carry_forward

    e = holed_events(spark, sf).select("event_id", "user_id", "value")
    return carry_forward(e, "value", ["event_id"], ["user_id"], chunks=16).select(
        "event_id", "user_id", F.col("carried").alias("value")
    )


@query("fill_mode", "P21", f"""WITH {HOLED}, m AS (SELECT event_type FROM holed WHERE event_type IS NOT NULL
        GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
    SELECT event_id, coalesce(event_type, (SELECT event_type FROM m)) AS event_type FROM holed""")
def fill_mode(spark, sf):
    return imputing.fill_mode(holed_events(spark, sf), ["event_type"]).select("event_id", "event_type")


@query("replace_values", "P22", """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted'
    WHEN 'R' THEN 'returned' ELSE l_returnflag END AS l_returnflag FROM lineitem""")
def replace_values(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").replace(
        {"A": "accepted", "R": "returned"}, subset=["l_returnflag"]
    )


@query("clip_values", "P23", f"""WITH {HOLED}, q AS (SELECT quantile_cont(value, 0.98) AS hi FROM holed)
    SELECT event_id, CASE WHEN value IS NOT NULL THEN greatest(least(value, 100), 5) END AS capped,
        round(CASE WHEN value IS NOT NULL THEN least(value, (SELECT hi FROM q)) END, 4) AS below_p98 FROM holed""")
def clip_values(spark, sf):
    from fieldbook.operators.quantiles import quantiles

    e = holed_events(spark, sf)
    high = quantiles(e, ["value"], [0.98]).select(F.col("value")[0].alias("v"))
    v = F.col("value")
    return e.withColumn("hi", high.scalar()).select(
        "event_id", cleaning.clip(v, F.lit(5.0), F.lit(100.0)).alias("capped"),
        r(cleaning.clip(v, upper=F.col("hi"))).alias("below_p98"),
    )


@query("derived_columns", "P24", """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
    l_extendedprice / nullif(date_diff('day', o_orderdate, l_shipdate), 0) AS per_day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def derived_columns(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.try_divide(F.col("l_extendedprice"), F.datediff("l_shipdate", "o_orderdate")).alias("per_day"),
    )


@query("indicator_column", "P25", "SELECT c_custkey, (c_acctbal > 0)::INT AS in_credit FROM customer")
def indicator_column(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") > 0).cast("int").alias("in_credit"))


@query("explicit_bins", "P26 K5", """SELECT size_class, rank, count(*) AS n FROM (
        SELECT CASE WHEN p_size > 1 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 25 THEN 'medium'
                    WHEN p_size > 25 AND p_size <= 49 THEN 'large' END AS size_class,
               CASE WHEN p_size > 1 AND p_size <= 10 THEN 0 WHEN p_size > 10 AND p_size <= 25 THEN 1
                    WHEN p_size > 25 AND p_size <= 49 THEN 2 END AS rank FROM part)
    GROUP BY size_class, rank""")
def explicit_bins(spark, sf):
    labels = ("small", "medium", "large")
    binned = table(spark, sf, "part").select(binning.cut(F.col("p_size"), (1, 10, 25, 49), labels).alias("size_class"))
    return binned.withColumn("rank", binning.label_rank(F.col("size_class"), labels)).groupBy("size_class", "rank").agg(
        F.count("*").alias("n")
    ).orderBy("rank")


@query("quantile_tiers", "P27", """WITH q AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS e FROM orders)
    SELECT tier, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM (
        SELECT o_totalprice, CASE WHEN o_totalprice <= e[1] THEN 'Budget' WHEN o_totalprice <= e[2] THEN 'Mid-Range'
            WHEN o_totalprice <= e[3] THEN 'Premium' ELSE 'Luxury' END AS tier FROM orders, q) GROUP BY tier""")
def quantile_tiers(spark, sf):
    labels = PRICE_TIERS
    tiers = binning.quantile_cut(table(spark, sf, "orders").select("o_totalprice"), "o_totalprice", labels, "tier")
    return tiers.groupBy("tier").agg(
        F.count("*").alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high")
    )


@query("fixed_bins", "P28", "SELECT round(floor(p_size / 11.4::DOUBLE) * 11.4::DOUBLE, 4) AS bin, count(*) AS n FROM part GROUP BY 1")
def fixed_bins(spark, sf):
    return table(spark, sf, "part").groupBy(r(binning.fixed_bin(F.col("p_size"), 11.4)).alias("bin")).agg(F.count("*").alias("n"))


@query("log_columns", "P29 F19", "SELECT p_partkey, round(ln(1 + p_retailprice), 6) AS log_p_retailprice, round(ln(1 + p_size), 6) AS log_p_size FROM part")
def log_columns(spark, sf):
    p = binning.log_columns(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return p.select("p_partkey", r("log_p_retailprice", 6).alias("log_p_retailprice"), r("log_p_size", 6).alias("log_p_size"))


EVENT_FENCES = """f AS (SELECT q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi
        FROM (SELECT quantile_cont(value, [0.25, 0.75]) AS q FROM holed))"""


@query("outlier_flags", "P30 J6", f"""WITH {HOLED}, {EVENT_FENCES}
    SELECT event_id, coalesce(value < lo OR value > hi, false)::INT AS value_is_outlier FROM holed, f""")
def outlier_flags(spark, sf):
    return binning.flag_outliers(holed_events(spark, sf), ["value", "user_id"]).select("event_id", "value_is_outlier")


@query("outlier_totals", "G30", f"""WITH {HOLED}, {EVENT_FENCES}
    SELECT 'value' AS "column", count(*) FILTER (value < lo OR value > hi) AS outliers FROM holed, f""")
def outlier_totals(spark, sf):
    return binning.outlier_totals(binning.flag_outliers(holed_events(spark, sf), ["value", "user_id"]))


@query("sample_rows", "P31", """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey LIMIT 200""")
def sample_rows(spark, sf):
    return shaping.sample_rows(table(spark, sf, "orders"), 200, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("sample_tenth_of_lines", "P31", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ORDER BY md5(l_orderkey || ',' || l_linenumber || ',' || l_partkey || ',' || l_suppkey || ':42') LIMIT (SELECT count(*) // 10 FROM lineitem)""")
def sample_tenth_of_lines(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    keyed = li.withColumn("key", F.concat_ws(",", *li.columns))
    return shaping.sample_rows(keyed, li.count() // 10, "key").drop("key")


@query("distinct_values", "P32", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_values(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("promote_dates", "P33 F14", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
    strftime(o_orderdate, '%d of %B') AS due_text, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ship_date
    FROM orders""")
def promote_dates(spark, sf):
    from fieldbook.config import JobConfig

    config = JobConfig()
    o = table(spark, sf, "orders")
    text = o.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.date_format("o_orderdate", "dd 'of' MMMM").alias("due_time"),
        F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("unknown")).alias("ship_date"),
    )
    dated = cleaning.promote_dates(text, config.date_formats, config.date_hints, config.date_parse_rate)
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return dated.select(
        "o_orderkey", day("order_date").alias("order_date"), F.col("due_time").cast("string").alias("due_text"),
        day("ship_date").alias("ship_date"),
    )


@query("strip_text", "P34 F1", "SELECT doc_id, md5(regexp_replace(regexp_replace(e, '^\\s+', ''), '\\s+$', '')) AS text FROM (SELECT doc_id, E' \\t' || text || E' \\n ' AS e FROM documents)")
def strip_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit(" \t"), "text", F.lit(" \n ")).alias("text"))
    return cleaning.strip_text(d).select("doc_id", F.md5("text").alias("text"))


@query("strip_and_title", "P35 F6", """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
    lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name FROM part""")
def strip_and_title(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t")).alias("name"))
    return cleaning.strip_text(p, title=True)


@query("head_rows", "P36 K1", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def head_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query("tail_rows", "P36", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def tail_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_orderkey")).limit(5)
