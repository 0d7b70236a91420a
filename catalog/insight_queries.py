"""Insights, reports, the end-to-end job and the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import LISTING, PATIENT, listings, patients, query, r, table
from fieldbook.config import JobConfig
from fieldbook.operators import grouping, profile
from fieldbook.operators.binning import flag_outliers
from fieldbook.plans import insights, job
from fieldbook.session import ROW_GROUP, materialise, scratch_path
from fieldbook.sources import sinks
from fieldbook.streaming import live

M = "format('{{:,}}', round({})::BIGINT)"  # whole number with separators
P1 = "printf('%.1f', round({}, 1))"


def m(e: str) -> str:
    return M.format(e)


def p(e: str, digits: int = 1) -> str:
    return f"printf('%.{digits}f', round({e}, {digits}))"


def _told(frame, name, fn, value):
    """The insight's sentence. The columns it reads are stored once, as its passes over
    a joined frame would otherwise repeat the joins."""
    if name != "overview":
        frame = materialise(frame.select(*[c for c in insights.INSIGHT_COLUMNS[name] if c in frame.columns]), name)
    if name.startswith("anomalous"):
        # Sixth powers have the long tail that the default fences need to flag some rows.
        frame = flag_outliers(frame.withColumn(value, F.pow(F.col(value) / 100_000, 6)), [value])
    return fn(frame).select("body")


def _listing(name: str, covers: str, body: str, source: str, extra: str = ""):
    fn, value = insights.LISTING_INSIGHTS[name], "price"

    @query(f"listing_{name}", covers, f"WITH {LISTING}{extra} SELECT {body} AS body {source}")
    def run(spark, sf):
        return _told(listings(spark, sf), name, fn, value)


def _patient(name: str, covers: str, body: str, source: str, extra: str = ""):
    fn, value = insights.PATIENT_INSIGHTS[name], "billing"

    @query(f"patient_{name}", covers, f"WITH {PATIENT}{extra} SELECT {body} AS body {source}")
    def run(spark, sf):
        return _told(patients(spark, sf), name, fn, value)


def _ranked(frame: str, key: str, value: str) -> str:
    """CTE g with keys and a metric, and CTE e with both extremes, first key on a tie."""
    return f""", g AS (SELECT {key} AS k, {value} AS v FROM {frame} WHERE {key} IS NOT NULL GROUP BY 1),
        e AS (SELECT first(k ORDER BY v DESC, k) AS hk, max(v) AS hv, first(k ORDER BY v, k) AS lk, min(v) AS lv FROM g)"""


_NULLS = "(SELECT 100 - round((1 - (14 * count(*) - count(reviews_per_month) - 13 * count(*)) / (14.0 * count(*))) * 100, 2) FROM listing)"
_listing(
    "overview", "IA1",
    f"{m('count(*)')} || ' listings across ' || {m('count(DISTINCT region)')} || ' regions with 14 attributes; ' || {p(f'100 - {_NULLS}')} || '% of cells are filled; 10 numeric and 3 categorical columns.'",
    "FROM listing",
)
_listing(
    "price_distribution", "IA2",
    f"'Half of the listings cost ' || {m('median(price)')} || ' or less, half of them between ' || {m('quantile_cont(price, 0.25)')} || ' and ' || {m('quantile_cont(price, 0.75)')}"
    f" || ', and the mean is ' || {m('avg(price)')} || ' (lowest ' || {m('min(price)')} || ', highest ' || {m('max(price)')} || '). ' || {p('avg((price <= 75)::INT) * 100')}"
    f" || '% cost at most 75, ' || {p('avg((price > 300)::INT) * 100')} || '% more than 300.'",
    "FROM listing",
)
_listing(
    "region_prices", "IA3 G22 G37",
    f"hk || ' has the highest median price (' || {m('hv')} || '), ' || {p('hv / lv', 2)} || ' times that of ' || lk || ' (' || {m('lv')} || ').'",
    "FROM e", _ranked("listing", "region", "median(price)"),
)
_listing(
    "room_types", "IA4",
    f"'Supply by type: ' || (SELECT string_agg(t || ' ' || {p('s')} || '%', ', ' ORDER BY s DESC, t) FROM (SELECT room_type AS t, count(*) * 100.0 / (SELECT count(*) FROM listing) AS s FROM listing GROUP BY 1))"
    f" || '. ' || hk || ' has ' || {p('hv / lv', 2)} || ' times the median price of ' || lk || '.'",
    "FROM e", _ranked("listing", "room_type", "median(price)"),
)
_listing(
    "availability", "IA5",
    f"'On ' || {m('median(availability)')} || ' days of a year half of the listings can be booked, on ' || {m('avg(availability)')} || ' on average; ' || {p('avg((availability = 0)::INT) * 100')}"
    f" || '% on none, ' || {p('avg((availability = 365)::INT) * 100')} || '% on all.'",
    "FROM listing",
)
_listing(
    "reviews", "IA6",
    f"{p('avg((reviews = 0)::INT) * 100')} || '% have no reviews, ' || {p('avg((reviews >= 50)::INT) * 100')} || '% have 50 or more. Median ' || {m('median(reviews)')}"
    f" || ', mean ' || {p('avg(reviews)')} || '; correlation with price ' || {p('corr(reviews, price_capped)', 3)} || '.'",
    "FROM listing",
)
_listing(
    "host_scale", "IA7",
    f"{p('avg((host_listings = 1)::INT) * 100')} || '% of listings belong to single-listing hosts, ' || {p('avg((host_listings > 5)::INT) * 100')}"
    f" || '% to hosts with six or more; the largest host has ' || {m('max(host_listings)')} || '.'",
    "FROM listing",
)
_listing(
    "top_areas", "IA8",
    f"'Half of the listings in ' || hk || ' cost more than ' || {m('hv')} || ', a level no other area reaches. Supply is largest in '"
    f" || (SELECT string_agg(a || ' (' || {m('n')} || ')', ', ' ORDER BY n DESC, a) FROM (SELECT area AS a, count(*) AS n FROM listing GROUP BY 1 ORDER BY n DESC, a LIMIT 5)) || '.'",
    "FROM e", _ranked("listing", "area", "median(price)"),
)
_listing(
    "minimum_nights", "IA9 G21",
    f"{p('avg((min_nights = 1)::INT) * 100')} || '% accept one night (median ' || {m('median(price) FILTER (min_nights = 1)')} || '), ' || {p('avg((min_nights >= 30)::INT) * 100')}"
    f" || '% ask for 30 or more (median ' || {m('median(price) FILTER (min_nights >= 30)')} || ').'",
    "FROM listing",
)
_listing(
    "revenue_concentration", "IA10 G31",
    f"'The top 10% of listings earn ' || {p('(SELECT sum(revenue) FILTER (i <= n // 10) / sum(revenue) * 100 FROM x)')} || '% of the revenue proxy; its median is ' || {m('(SELECT median(revenue) FROM listing)')} || '; ' || hk || ' earns the most.'",
    "FROM e",
    _ranked("listing", "region", "sum(revenue)") + ", x AS (SELECT revenue, row_number() OVER (ORDER BY revenue DESC) AS i, count(*) OVER () AS n FROM listing)",
)
_listing(
    "room_type_test", "IA11 M1",
    f"'One-way ANOVA: F = ' || {p('f', 2)} || '; prices ' || CASE WHEN power(d2 / (d2 + 2 * f), d2 / 2.0) < 0.05 THEN 'differ significantly' ELSE 'do not differ significantly' END || ' across room types.'",
    "FROM t",
    """, g AS (SELECT room_type AS k, count(*) AS n, avg(price) AS a, var_pop(price) AS v FROM listing GROUP BY 1),
       t AS (SELECT sum(n) - 3 AS d2, (sum(n * power(a - (SELECT avg(price) FROM listing), 2)) / 2) / (sum(n * v) / (sum(n) - 3)) AS f FROM g)""",
)
_listing(
    "density", "IA12 G36",
    f"'The densest regions are ' || string_agg(k || ' (' || {m('v')} || ')', ', ' ORDER BY v DESC, k) || ', together ' || {p('sum(v) * 100.0 / (SELECT count(*) FROM listing)')} || '% of all supply.'",
    "FROM (SELECT * FROM g ORDER BY v DESC, k LIMIT 2)", _ranked("listing", "region", "count(*)"),
)
_listing(
    "commercial_hosts", "IA13 G37",
    f"'Median price by kind of host: ' || {m('s')} || ' with a single listing, ' || {m('c')} || ' with more than 20; for each 100 asked by the former the latter ask ' || {p('c / s * 100', 0)} || '.'",
    "FROM (SELECT median(price) FILTER (host_listings > 20) AS c, median(price) FILTER (host_listings = 1) AS s FROM listing) WHERE c / s IS NOT NULL",
)
_listing(
    "review_recency", "IA14",
    f"{p('avg((d <= 90)::INT) * 100')} || '% were reviewed within 90 days of the latest review, ' || {p('avg((d > 365)::INT) * 100')} || '% more than a year before it.'",
    "FROM (SELECT date_diff('day', last_review, (SELECT max(last_review) FROM listing)) AS d FROM listing)",
)


def _flagged(frame: str, value: str) -> str:
    return f""", c AS (SELECT power({value} / 100000, 6) AS x FROM {frame}), q AS (SELECT quantile_cont(x, [0.25, 0.75]) AS q FROM c),
        f AS (SELECT x, (x < q[1] - 1.5 * (q[2] - q[1]) OR x > q[2] + 1.5 * (q[2] - q[1])) AS o FROM c, q)"""


_ANOMALY = (
    f"'IQR fences flag ' || {m('count(*) FILTER (o)')} || ' rows (' || {p('avg(o::INT) * 100')} || '%); they average ' || {m('avg(x) FILTER (o)')}"
    f" || ' against ' || {m('avg(x) FILTER (NOT o)')} || ' for the rest.'"
)
_listing("anomalous_prices", "IA15 P30", _ANOMALY, "FROM f", _flagged("listing", "price"))

_patient(
    "overview", "IH1",
    f"{m('count(*)')} || ' patient records across 15 attributes; 100.0% of cells are filled; 5 numeric, 8 categorical and 2 date columns.'",
    "FROM patient",
)
_patient(
    "billing_distribution", "IH2",
    f"'Half of the bills are ' || {m('median(billing)')} || ' or less, half of them between ' || {m('quantile_cont(billing, 0.25)')} || ' and ' || {m('quantile_cont(billing, 0.75)')}"
    f" || '; one in ten is above ' || {m('quantile_cont(billing, 0.9)')} || ' (lowest ' || {m('min(billing)')} || ', highest ' || {m('max(billing)')} || ').'",
    "FROM patient",
)
_patient(
    "ages", "IH3 P26",
    f"'From age 65 on: ' || {p('avg((age >= 65)::INT) * 100')} || '% of patients. Most fall into the band ' || any_value(hk) || '; the oldest is ' || {m('max(age)')} || ', the youngest ' || {m('min(age)')}"
    f" || ', on average ' || {p('avg(age)')} || ' (spread ' || {p('stddev_samp(age)')} || ').'",
    "FROM patient, e",
    _ranked("(SELECT CASE WHEN age > 0 AND age <= 18 THEN '<18' WHEN age > 18 AND age <= 35 THEN '18-35' WHEN age > 35 AND age <= 50 THEN '36-50' WHEN age > 50 AND age <= 65 THEN '51-65' WHEN age > 65 THEN '65+' END AS band FROM patient)", "band", "count(*)"),
)
_patient(
    "genders", "IH4",
    f"'Shares: ' || string_agg(k || ' ' || {p('v * 100.0 / (SELECT count(*) FROM patient)')} || '%', ', ' ORDER BY v DESC, k) || '.'",
    "FROM g", _ranked("patient", "gender", "count(*)"),
)
_COST = ", c AS (SELECT first(k ORDER BY v DESC, k) AS ck, max(v) AS cv, first(k ORDER BY v, k) AS lck, min(v) AS lcv FROM (SELECT {0} AS k, avg(billing) AS v FROM patient GROUP BY 1))"
_patient(
    "conditions", "IH5 G22",
    f"'Bills average ' || {m('cv')} || ' for ' || ck || ', more than for any other diagnosis. Seen least: ' || lk || ', ' || {m('lv')} || ' times; seen most: ' || hk"
    f" || ', ' || {m('hv')} || ' times or ' || {p('hv * 100.0 / (SELECT count(*) FROM patient)')} || '% of all stays.'",
    "FROM e, c", _ranked("patient", "condition", "count(*)") + _COST.format("condition"),
)
_patient(
    "admissions", "IH6",
    f"'Shares: ' || (SELECT string_agg(k || ' ' || {p('v * 100.0 / (SELECT count(*) FROM patient)')} || '%', ', ' ORDER BY v DESC, k) FROM g) || '. ' || ck || ' has the highest mean bill (' || {m('cv')} || '), ' || lck || ' the lowest (' || {m('lcv')} || ').'",
    "FROM c", _ranked("patient", "admission", "count(*)") + _COST.format("admission"),
)
_patient(
    "insurers", "IH7 G22",
    f"hk || ' has the highest mean bill (' || {m('hv')} || '), ' || lk || ' the lowest (' || {m('lv')} || ').'",
    "FROM e", _ranked("patient", "insurer", "avg(billing)"),
)
_patient(
    "blood_types", "IH8",
    f"hk || ' is the most common blood type (' || {p('hv * 100.0 / (SELECT count(*) FROM patient)')} || '%).'",
    "FROM e", _ranked("patient", "blood_type", "count(*)"),
)
_patient(
    "stays", "IH9",
    f"'Median stay ' || {m('median(stay)')} || ' days, mean ' || {p('avg(stay)')} || ' with deviation ' || {p('stddev_samp(stay)')} || '; 90% stay up to ' || {m('quantile_cont(stay, 0.9)')} || ' days, the longest ' || {m('max(stay)')} || '.'",
    "FROM patient",
)
_patient(
    "abnormal_results", "IH10 G24",
    f"hk || ' has the highest rate of abnormal results (' || {p('hv')} || '%).'",
    "FROM e", _ranked("patient", "condition", "avg((result = 'Abnormal')::INT) * 100"),
)
_patient(
    "medications", "IH11",
    f"hk || ' is prescribed most (' || {p('hv * 100.0 / (SELECT count(*) FROM patient)')} || '%; the least is ' || {p('lv * 100.0 / (SELECT count(*) FROM patient)')} || '%). ' || ck || ' goes with the highest mean bill (' || {m('cv')} || ').'",
    "FROM e, c", _ranked("patient", "medication", "count(*)") + _COST.format("medication"),
)
_patient(
    "age_and_billing", "IH12 M7",
    f"'Pearson r = ' || {p('corr(age, billing)', 3)} || '; ' || CASE WHEN abs(corr(age, billing) * sqrt(count(*) / (1 - power(corr(age, billing), 2)))) > 1.96 THEN 'a significant linear relation' ELSE 'no significant linear relation' END || '.'",
    "FROM patient",
)
_patient(
    "seasons", "IH13 F17",
    f"'Most patients come in ' || strftime(make_date(2000, hk::INT, 1), '%b') || ' (' || {m('hv')} || '), fewest in ' || strftime(make_date(2000, lk::INT, 1), '%b') || ' (' || {m('lv')} || ').'",
    "FROM e", _ranked("patient", "month(admitted)", "count(*)"),
)
_patient("anomalous_bills", "IH14 P30", _ANOMALY, "FROM f", _flagged("patient", "billing"))
_patient(
    "top_hospitals", "IH15",
    "'The five hospitals with the highest mean bill are ' || string_agg(k, ', ' ORDER BY v DESC, k) || '.'",
    "FROM (SELECT * FROM g ORDER BY v DESC, k LIMIT 5)", _ranked("patient", "hospital", "avg(billing)"),
)


# --- registry, reports and jobs ---------------------------------------------------


@query("insight_categories", "X5 S14", """SELECT * FROM (VALUES (1, 'table', 1), (2, 'money', 3), (3, 'people', 2), (5, 'care', 4),
    (6, 'operation', 3), (12, 'tests', 1)) t(first, category, insights)""")
def insight_categories(spark, sf):
    found = insights.patient_insights(patients(spark, sf))
    s = sinks.insight_summary(found)
    return s.select(F.col("ord").alias("first"), "category", F.size("items").alias("insights"))


def _listing_job(spark, sf):
    """The listing job up to its prepared table, on text input with defects."""
    base = materialise(listings(spark, sf).drop("price_capped", "revenue"), "listings", ROW_GROUP)  # read five times
    raw = base.withColumns(
        {
            "last_review": F.when(F.col("id") % 11 != 0, F.col("last_review").cast("string")),
            "area": F.concat(F.lit("  "), "area", F.lit(" ")),
            "reviews": F.when(F.col("id") % 13 != 0, F.col("reviews")),
            "region": F.when(F.col("id") % 17 != 0, F.col("region")),
        }
    ).withColumnRenamed("last_review", "Last Review Date").withColumnRenamed("min_nights", "Min Nights")
    doubled = raw.unionByName(raw.filter(F.col("room_type") == "P"))
    config = JobConfig(price_cap=400000.0, exclude_columns=("Host ID",))
    cleaned = job.clean(doubled, config, order="id", positive="price")
    frame = job.listing_features(cleaned.frame.withColumnRenamed("last_review_date", "last_review"), config)
    features = ["price_capped", "price_tier", "log_price", "availability_cat", "has_reviews", "host_type", "revenue", "days_since_review"]
    return job.finish(job.Prepared(frame, cleaned.quality), ["price", "min_nights", "reviews", "host_listings", "availability"], config, features), config


_RAW = f"""WITH {LISTING}, raw AS (SELECT id, CASE WHEN id % 17 <> 0 THEN region END AS region, room_type, price, least(price, 400000.0::DOUBLE) AS price_capped, availability, min_nights,
        CASE WHEN id % 13 <> 0 THEN reviews END AS reviews, host_listings, CASE WHEN id % 11 <> 0 THEN last_review END AS last_review FROM listing),
    done AS (SELECT * REPLACE (coalesce(reviews, (SELECT median(reviews) FROM raw)) AS reviews,
        coalesce(region, (SELECT region FROM raw WHERE region IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, region LIMIT 1)) AS region,
        last_value(last_review IGNORE NULLS) OVER (ORDER BY id ROWS UNBOUNDED PRECEDING) AS last_review) FROM raw)"""


def _fence_count(c: str) -> str:
    return f"""SELECT 'outliers_flagged' AS metric, '{c}' AS "column", count(*) AS value FROM done,
        (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM done) WHERE {c} < q[1] - 1.5 * (q[2] - q[1]) OR {c} > q[2] + 1.5 * (q[2] - q[1]) HAVING count(*) > 0"""


@query("listing_quality_report", "G38 P4 P14 P19 P20 P21 P30", _RAW + """
    SELECT 'rows_in' AS metric, '' AS "column", (SELECT count(*) + count(*) FILTER (room_type = 'P') FROM listing) AS value
    UNION ALL SELECT 'duplicates_removed', '', (SELECT count(*) FROM listing WHERE room_type = 'P')
    UNION ALL SELECT 'rows_out', '', (SELECT count(*) FROM done WHERE price > 0)
    UNION ALL SELECT 'nulls_imputed', 'region', (SELECT count(*) FROM raw WHERE region IS NULL)
    UNION ALL SELECT 'nulls_imputed', 'reviews', (SELECT count(*) FROM raw WHERE reviews IS NULL)
    UNION ALL SELECT 'nulls_imputed', 'reviews_per_month', (SELECT count(*) FROM listing WHERE reviews_per_month IS NULL)
    UNION ALL SELECT 'nulls_imputed', 'last_review_date', (SELECT count(*) FROM raw WHERE last_review IS NULL)
    UNION ALL SELECT 'feature', f, 1 FROM (SELECT unnest(['price_capped', 'price_tier', 'log_price', 'availability_cat', 'has_reviews', 'host_type', 'revenue', 'days_since_review']) AS f)
    UNION ALL """ + " UNION ALL ".join(_fence_count(c) for c in ("price", "min_nights", "reviews", "host_listings", "availability")))
def listing_quality_report(spark, sf):
    return _listing_job(spark, sf)[0].quality


@query("listing_features", "P23 P25 P26 P27 P24 F16", _RAW + """, e AS (SELECT quantile_cont(price_capped, [0.25, 0.5, 0.75]) AS q FROM done)
    SELECT id, CASE WHEN price_capped <= q[1] THEN 'Budget' WHEN price_capped <= q[2] THEN 'Mid-Range' WHEN price_capped <= q[3] THEN 'Premium' ELSE 'Luxury' END AS price_tier,
        CASE WHEN availability <= 0 THEN 'Unavailable' WHEN availability <= 90 THEN 'Low' WHEN availability <= 180 THEN 'Medium' WHEN availability <= 365 THEN 'High' END AS availability_cat,
        (reviews > 0)::INT AS has_reviews, CASE WHEN host_listings <= 1 THEN 'Solo' WHEN host_listings <= 5 THEN 'Small' WHEN host_listings <= 20 THEN 'Medium' ELSE 'Commercial' END AS host_type,
        date_diff('day', last_review, (SELECT max(last_review) FROM done))::INT AS days_since_review FROM done, e""")
def listing_features(spark, sf):
    prepared, _ = _listing_job(spark, sf)
    return prepared.frame.select("id", "price_tier", "availability_cat", "has_reviews", "host_type", "days_since_review")


@query("listing_report_lines", "S12 S13 S14")
def listing_report_lines(spark, sf):
    prepared, config = _listing_job(spark, sf)
    found = insights.listing_insights(prepared.frame)
    folder = scratch_path(spark, "report")
    job.report(prepared.frame, job.listing_tests(prepared.frame, config), found, folder, "LISTING ANALYTICS", "orders")
    names = ["analytics_report", "analytics_report_json", "insight_summary"]
    lines = [
        spark.read.text(f"{folder}/{n}").groupBy(F.lit(n).alias("report")).agg(F.count("*").alias("lines")) for n in names
    ]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


_ORDERS = """counts AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1),
    shares AS (SELECT o_orderpriority, n, n / sum(n) OVER () * 100 AS pct FROM counts),
    quality AS (SELECT count(*) AS n, count(*) * (SELECT count(*) FROM (DESCRIBE orders)) AS cells FROM orders)"""
_CELL = "lpad({}, 20, ' ')"


def _order_parts(spark, sf):
    """Small results for the two reports: the quality of orders, and its priorities."""
    o = table(spark, sf, "orders")
    return profile.data_quality(o).select("total_rows", "total_cells", "null_cells", "completeness_pct"), grouping.value_counts(o, "o_orderpriority")


@query("text_report_lines", "S13", f"""WITH {_ORDERS}, lines AS (
    SELECT 0 AS part, '0' AS item, unnest([0, 1, 2, 3]) AS pos, unnest([repeat('=', 80), '  ORDER REPORT', '  Dataset   : orders', repeat('=', 80)]) AS line
    UNION ALL SELECT 1, '', -1, '── DATA QUALITY ──' UNION ALL SELECT 2, '', -1, '── PRIORITIES ──'
    UNION ALL SELECT 1, '', unnest([0, 1, 2, 3]), unnest(['    ' || rpad('total_rows', 30, ' ') || ': ' || n, '    ' || rpad('total_cells', 30, ' ') || ': ' || cells,
        '    ' || rpad('null_cells', 30, ' ') || ': 0', '    ' || rpad('completeness_pct', 30, ' ') || ': 100.0']) FROM quality
    UNION ALL SELECT 2, '0', 0, {_CELL.format("'o_orderpriority'")} || {_CELL.format("'count'")} || {_CELL.format("'pct'")}
    UNION ALL SELECT 2, '1' || o_orderpriority, 0, {_CELL.format("o_orderpriority")} || {_CELL.format("n::VARCHAR")} || {_CELL.format("round(pct, 6)::VARCHAR")} FROM shares)
    SELECT (row_number() OVER (ORDER BY part, item, pos) - 1)::INT AS line_no, line FROM lines""")
def text_report_lines(spark, sf):
    """The lines of a written text report, as they stand in the file."""
    quality, counts = _order_parts(spark, sf)
    sections = [("data quality", sinks.key_value_lines(quality, "data quality")), ("priorities", sinks.table_lines(counts, "priorities", "o_orderpriority"))]
    path = scratch_path(spark, "text-report")
    sinks.write_text_report(sinks.text_report("ORDER REPORT", "orders", sections), path)
    lines = F.split(F.regexp_replace("value", "\n$", ""), "\n")
    return spark.read.text(path, wholetext=True).select(F.posexplode(lines).alias("line_no", "line"))


@query("json_report_rows", "S12", f"""WITH {_ORDERS} SELECT 'orders' AS dataset, q.n AS total_rows, q.cells AS total_cells, s.o_orderpriority, s.n AS count, round(s.pct, 6) AS pct
    FROM quality q, shares s""")
def json_report_rows(spark, sf):
    """A written JSON report, read back by its declared schema."""
    quality, counts = _order_parts(spark, sf)
    path = scratch_path(spark, "json-report")
    sinks.write_json_report(sinks.json_report("orders", {"data_quality": quality, "priorities": counts}), path)
    schema = """metadata struct<dataset: string>, data_quality array<struct<total_rows: long, total_cells: long>>,
        priorities array<struct<o_orderpriority: string, count: long, pct: double>>"""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"))
    rows = whole.select("r.metadata.dataset", F.col("r.data_quality")[0].alias("q"), F.explode("r.priorities").alias("p"))
    return rows.select("dataset", "q.*", "p.o_orderpriority", "p.count", r("p.pct", 6).alias("pct"))


@query("patient_features", "F15 F16 P26 P27 P29", f"""WITH {PATIENT}, e AS (SELECT quantile_cont(greatest(billing, 0), [0.25, 0.5, 0.75]) AS q FROM patient)
    SELECT order_key, line, stay, month(admitted)::INT AS admitted_month, (isodow(discharged) - 1)::INT AS discharged_dow, round(ln(1 + age), 6) AS log_age,
        CASE WHEN greatest(billing, 0) <= q[1] THEN 'Low' WHEN greatest(billing, 0) <= q[2] THEN 'Medium' WHEN greatest(billing, 0) <= q[3] THEN 'High' ELSE 'Premium' END AS billing_band,
        CASE WHEN age <= 18 THEN '<18' WHEN age <= 35 THEN '18-35' WHEN age <= 50 THEN '36-50' WHEN age <= 65 THEN '51-65' ELSE '65+' END AS age_group FROM patient, e""")
def patient_features(spark, sf):
    base = patients(spark, sf).drop("stay").withColumns(
        {"admitted": F.col("admitted").cast("timestamp"), "discharged": F.col("discharged").cast("timestamp")}
    )
    f = job.patient_features(base)
    return f.select(
        "order_key", "line", F.col("stay").cast("long").alias("stay"), "admitted_month", "discharged_dow",
        r("log_age", 6).alias("log_age"), "billing_band", "age_group",
    )


# --- streams -----------------------------------------------------------------------


def _fed(spark, parts, made, mode):
    """What a stream writes whose source grows by one part after the other: each part is one
    trigger or more, and the stream goes on from its checkpoint."""
    path, out, state = (scratch_path(spark, name) for name in ("stream", "out", "state"))

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for part in parts:
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(part.schema).parquet(path)
        made(stream).writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.parquet(out)


def _drained(spark, sf, made, mode):
    """What a stream over the events writes. The events arrive in four quarters by id, rows
    without one in the first."""
    e = table(spark, sf, "events")
    low, high = e.agg(F.min("event_id"), F.max("event_id")).first()
    quarter = F.coalesce(F.floor((F.col("event_id") - low) * 4 / ((high or 0) - (low or 0) + 1)), F.lit(0))
    return _fed(spark, [e.where(quarter == part) for part in range(4)], made, mode)


@query("stream_daily_counts", "V9 stream", """WITH d AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
    SELECT strftime(day, '%Y-%m-%d') AS day, event_type, n FROM d""")
def stream_daily_counts(spark, sf):
    counts = _drained(spark, sf, lambda events: live.daily_counts(events, "ts", ["event_type"]), "update")
    latest = counts.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))
    return latest.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("stream_ledger", "W6 stream", """WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id NULLS FIRST) AS n,
        round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id NULLS FIRST ROWS UNBOUNDED PRECEDING), 6) AS total FROM events),
    v AS (SELECT *, max((n > 30 OR total > 600)::INT) OVER (PARTITION BY user_id ORDER BY event_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS broken FROM w)
    SELECT user_id AS account, sum(1 - broken)::BIGINT AS accepted, count(*) AS n, round(coalesce(sum(value) FILTER (broken = 0), 0), 2) AS total FROM v GROUP BY user_id""")
def stream_ledger(spark, sf):
    out = _drained(spark, sf, lambda events: live.live_ledger(events, "user_id", "event_id", "value", 30, 600.0), "append")
    kept = F.col("accepted") == 1
    return out.groupBy("account").agg(
        F.sum("accepted").alias("accepted"), F.count("*").alias("n"),
        r(F.coalesce(F.sum(F.when(kept, F.col("amount"))), F.lit(0.0)), 2).alias("total"),
    )


@query("stream_timed_ledger", "W6 stream", """WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id NULLS FIRST) AS n,
        round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id NULLS FIRST ROWS UNBOUNDED PRECEDING), 6) AS total FROM events WHERE ts IS NOT NULL),
    v AS (SELECT *, max((n > 30 OR total > 600)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS broken FROM w)
    SELECT user_id AS account, sum(1 - broken)::BIGINT AS accepted, count(*) AS n, round(coalesce(sum(value) FILTER (broken = 0), 0), 2) AS total, 0::BIGINT AS late
    FROM v GROUP BY user_id""")
def stream_timed_ledger(spark, sf):
    """The ledger by event time. Events arrive up to a day after their time, in four parts, so
    every part goes back in time; a last row moves the watermark past them all."""
    e = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value").where("ts is not null")
    day = 24 * 3600
    low, high = e.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    low, high = low or 0, high or 0
    arrival = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(day))
    part = F.floor((arrival - low) * 4 / (high - low + day + 1))
    types = dict(e.dtypes)
    last = spark.range(1).select(
        *[(F.timestamp_seconds(F.lit(high + 2 * day)) if c == "ts" else F.lit(None).cast(types[c])).alias(c) for c in e.columns])
    kept = {key: spark.conf.get(key, None) for key in live.STATE_STORE}
    for key, value in live.STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        told = _fed(
            spark, [*[e.where(part == k) for k in range(4)], last],
            lambda events: live.timed_ledger(events, "user_id", "ts", "event_id", "value", 30, 600.0, "1 day"), "append")
    finally:
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    accepted = F.col("accepted") == 1
    return told.groupBy("account").agg(
        F.sum("accepted").alias("accepted"), F.count("*").alias("n"),
        r(F.coalesce(F.sum(F.when(accepted, F.col("amount"))), F.lit(0.0)), 2).alias("total"), F.count(F.when(F.col("status") == "late", 1)).alias("late"),
    )
