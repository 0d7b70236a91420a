"""Dashboard worksheets over frames derived from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import LISTING, listings, query, r, rounded, table
from fieldbook.plans import worksheets
from fieldbook.session import materialise


def sales(spark, sf):
    """Order lines as sales facts."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    c, p = table(spark, sf, "customer"), table(spark, sf, "part")
    n, g = table(spark, sf, "nation"), table(spark, sf, "region")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(p, li.l_partkey == p.p_partkey)
        .join(n, c.c_nationkey == n.n_nationkey).join(g, n.n_regionkey == g.r_regionkey)
        .select(
            F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"), F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("ship_mode"), F.col("r_name").alias("country"), F.col("n_name").alias("state"),
            F.concat(F.lit("City "), (F.col("c_custkey") / 100).cast("int").cast("string")).alias("city"),
            F.col("o_orderdate").alias("order_date"), F.col("l_extendedprice").alias("sales"),
        )
    )


SALES = """sales AS (SELECT p_type AS category, p_brand AS sub_category, c_mktsegment AS segment, o_orderpriority AS ship_mode, r_name AS country,
        n_name AS state, 'City ' || (c_custkey // 100)::VARCHAR AS city, o_orderdate AS order_date, l_extendedprice AS sales
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def staff(spark, sf):
    """Labelled documents as staff records."""
    d, b = table(spark, sf, "documents"), table(spark, sf, "labels")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return d.join(b, "doc_id").select(
        F.col("source").alias("department"), F.col("lang").alias("salary"), F.col("toxic").cast("long").alias("left_flag"),
        F.col("quality").cast("long").alias("promoted"), F.floor(F.col("n_chars") / 500).cast("long").alias("hours"),
        lines.cast("long").alias("projects"), (F.floor(F.sqrt("n_chars")) / 200).alias("satisfaction"),
        (F.length("source") / 10).alias("evaluation"),
    )


STAFF = """staff AS (SELECT source AS department, lang AS salary, toxic::BIGINT AS left_flag, quality::BIGINT AS promoted, (n_chars // 500)::BIGINT AS hours,
        (length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS projects, floor(sqrt(n_chars)) / 200 AS satisfaction, length(source) / 10 AS evaluation
    FROM documents JOIN labels USING (doc_id))"""


def portfolio(spark, sf):
    """Order lines as portfolio positions."""
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    c = F.col
    return li.join(p, c("l_partkey") == c("p_partkey")).select(
        c("l_partkey").alias("asset_id"), c("p_type").alias("asset_class"), c("p_brand").alias("sector"),
        c("l_shipdate").alias("valuation_date"), (c("l_quantity") * c("p_retailprice")).alias("cost"),
        c("l_extendedprice").alias("market_value"), (c("l_discount") * 100).alias("return_pct"),
        (c("l_discount") + c("l_tax")).alias("risk"), (c("l_tax") * 100).alias("benchmark_pct"),
    )


PORTFOLIO = """portfolio AS (SELECT l_partkey AS asset_id, p_type AS asset_class, p_brand AS sector, l_shipdate AS valuation_date,
        l_quantity * p_retailprice AS cost, l_extendedprice AS market_value, l_discount * 100 AS return_pct, l_discount + l_tax AS risk, l_tax * 100 AS benchmark_pct
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FRAMES = {"sales": sales, "staff": staff, "listings": listings, "portfolio": portfolio}
CTES = {"sales": SALES, "staff": STAFF, "listings": LISTING, "portfolio": PORTFOLIO}


def _sheet(board: str, sheet: str, covers: str, sql: str, digits: int = 4, selected=None):
    name = f"{board}_{sheet}" if selected is None else f"{board}_{sheet}_selected"

    @query(f"sheet_{name}", covers, f"WITH {CTES[board]}{sql}")
    def run(spark, sf):
        sheets = worksheets.DASHBOARDS[board]()
        out = worksheets.dashboard(FRAMES[board](spark, sf), {sheet: sheets[sheet]}, selected)[sheet]
        for column in ("month",):
            if dict(out.dtypes).get(column, "").startswith("timestamp"):
                out = out.withColumn(column, F.date_format(column, "yyyy-MM-dd"))
        return rounded(out, digits)


SUM = "round(sum(sales), 2) AS sales FROM sales GROUP BY ALL"
_sheet("sales", "category_sales", "TS1", f" SELECT category, {SUM}", 2)
_sheet("sales", "sub_category_treemap", "TS2", f" SELECT category, sub_category, {SUM}", 2)
_sheet("sales", "place_by_category", "TS3", f" SELECT country, state, city, category, {SUM}", 2)
_sheet("sales", "place_by_segment", "TS4", f" SELECT country, city, segment, {SUM}", 2)
_sheet("sales", "segment_sales", "TS5", f" SELECT segment, {SUM}", 2)
_sheet("sales", "month_by_category", "TS6 F18", f" SELECT month(order_date)::INT AS month, category, {SUM}", 2)
_sheet("sales", "ship_mode_sales", "TS7", f" SELECT ship_mode, {SUM}", 2)
_sheet("sales", "year_by_place", "TS8", f" SELECT year(order_date)::INT AS year, country, state, city, {SUM}", 2)
_sheet(
    "sales", "segment_sales", "TI17 TD", " SELECT segment, round(sum(sales), 2) AS sales FROM sales WHERE category IN ('ECONOMY', 'PROMO') GROUP BY ALL", 2,
    selected={"category": ["ECONOMY", "PROMO"]},
)

_SALES_DIMS = {
    "category_sales": "category", "sub_category_treemap": "category, sub_category", "place_by_category": "country, state, city, category",
    "place_by_segment": "country, city, segment", "segment_sales": "segment", "month_by_category": "month(order_date)::INT, category",
    "ship_mode_sales": "ship_mode", "year_by_place": "year(order_date)::INT, country, state, city",
}


@query("dashboard_sales_selected", "TD TI17", f"WITH {SALES}, s AS (SELECT * FROM sales WHERE category IN ('ECONOMY', 'PROMO')) " + " UNION ALL ".join(
    f"SELECT '{sheet}' AS sheet, concat_ws('|', {dims}) AS place, round(sum(sales), 2) AS sales FROM s GROUP BY ALL" for sheet, dims in _SALES_DIMS.items()))
def dashboard_sales_selected(spark, sf):
    """All sheets of the dashboard over one stored base frame, under one selection."""
    base = materialise(sales(spark, sf), "sales")
    board = worksheets.dashboard(base, worksheets.sales_sheets(), {"category": ["ECONOMY", "PROMO"]})
    return reduce(DataFrame.unionByName, [
        out.select(F.lit(sheet).alias("sheet"), F.concat_ws("|", *[F.col(c).cast("string") for c in out.columns if c != "sales"]).alias("place"), r("sales", 2).alias("sales"))
        for sheet, out in board.items()
    ])


_sheet("staff", "headline", "TE1", " SELECT count(*) AS staff, round(avg(satisfaction), 4) AS satisfaction, sum(left_flag)::BIGINT AS leavers FROM staff")
_sheet("staff", "satisfaction_marks", "TE2", " SELECT satisfaction, evaluation, left_flag, count(*) AS staff FROM staff GROUP BY ALL")
_sheet(
    "staff", "hours_leavers", "TE4 G35",
    " SELECT hours, sum(left_flag)::BIGINT AS leavers, round(sum(satisfaction), 4) AS satisfaction, round(avg(left_flag), 4) AS left_rate FROM staff GROUP BY hours HAVING avg(left_flag) BETWEEN 0 AND 1",
)
_sheet("staff", "hours_by_salary", "TE5", " SELECT salary, round(avg(hours), 4) AS hours FROM staff GROUP BY ALL")
_sheet("staff", "projects_by_department", "TE6", " SELECT department, sum(projects)::BIGINT AS projects FROM staff GROUP BY ALL")
_sheet("staff", "promotions_by_department", "TE7", " SELECT department, sum(promoted)::BIGINT AS promotions FROM staff GROUP BY ALL")
_sheet("staff", "leavers_by_department", "TE8", " SELECT department, sum(left_flag)::BIGINT AS leavers FROM staff GROUP BY ALL")
_sheet(
    "staff", "leavers_by_salary", "TE9 W2",
    " SELECT salary, sum(left_flag)::BIGINT AS leavers, round(sum(left_flag) / sum(sum(left_flag)) OVER (), 4) AS share FROM staff GROUP BY salary",
)
_sheet("staff", "satisfaction_by_department", "TE10", " SELECT department, round(avg(satisfaction), 4) AS satisfaction FROM staff GROUP BY ALL")
_sheet("staff", "projects_by_salary", "TE11", " SELECT salary, round(avg(projects), 4) AS projects FROM staff GROUP BY ALL")


@query("sheet_staff_measure_names", "TE3", f"""WITH {STAFF} SELECT 'leavers' AS measure, sum(left_flag)::DOUBLE AS value FROM staff
    UNION ALL SELECT 'projects', sum(projects)::DOUBLE FROM staff""")
def sheet_staff_measure_names(spark, sf):
    return worksheets.measure_names(staff(spark, sf), {"leavers": F.sum("left_flag"), "projects": F.sum("projects")})


_sheet("listings", "reviews_by_area", "TL2", " SELECT area, reviews_per_month, sum(reviews)::BIGINT AS reviews FROM listing GROUP BY ALL")
_sheet("listings", "headline", "TL3", " SELECT count(host_id) AS hosts, round(avg(price), 4) AS price FROM listing")
_sheet("listings", "room_types", "TL4", " SELECT room_type, count(host_id) AS hosts FROM listing GROUP BY ALL")
_sheet("listings", "region_counts", "TL5 K6", " SELECT region, count(id) AS listings FROM listing GROUP BY ALL")
_sheet("listings", "region_prices", "TL6", " SELECT region, round(avg(price), 4) AS price FROM listing GROUP BY ALL")
_sheet("listings", "large_hosts", "TL7 G34", " SELECT host_id, count(id) AS listings FROM listing GROUP BY ALL HAVING count(id) >= 100")
_sheet("listings", "price_and_reviews", "TL8", " SELECT id, room_type, round(sum(price), 4) AS price, sum(reviews)::BIGINT AS reviews FROM listing GROUP BY ALL")
_sheet(
    "listings", "availability_bins", "TL9 P28",
    " SELECT round(floor(availability / 11.4::DOUBLE) * 11.4::DOUBLE, 4) AS availability_bin, count(*) AS listings FROM listing GROUP BY 1",
)
_sheet(
    "listings", "reviewed_by_region", "TL10",
    " SELECT region, count(reviews_per_month) AS reviewed, round(count(reviews_per_month) / sum(count(reviews_per_month)) OVER (), 4) AS share FROM listing GROUP BY region",
)

_avg = lambda key, m: f" SELECT {key}, round(avg({m}), 4) AS {m} FROM portfolio GROUP BY {key}"
_sum = lambda key, m: f" SELECT {key}, round(sum({m}), 1) AS {m} FROM portfolio GROUP BY {key}"
_sheet("portfolio", "class_return", "TI1", _avg("asset_class", "return_pct"))
_sheet("portfolio", "class_benchmark", "TI2", _avg("asset_class", "benchmark_pct"))
_sheet("portfolio", "class_cost", "TI3", " SELECT asset_class, round(sum(cost), 2) AS cost FROM portfolio GROUP BY 1", 2)
_sheet("portfolio", "sector_benchmark", "TI4", _avg("sector", "benchmark_pct"))
_sheet("portfolio", "sector_cost", "TI5", " SELECT sector, round(sum(cost), 2) AS cost FROM portfolio GROUP BY 1", 2)
_sheet("portfolio", "sector_risk", "TI6", _avg("sector", "risk"))
_sheet("portfolio", "sector_return", "TI7", _avg("sector", "return_pct"))


@query("sheet_portfolio_sector_concentration", "TI8 W2", f"""WITH {PORTFOLIO} SELECT sector, round(sum(market_value), 2) AS market_value,
    round(sum(market_value) / sum(sum(market_value)) OVER (), 6) AS share FROM portfolio GROUP BY sector""")
def sheet_portfolio_sector_concentration(spark, sf):
    s = worksheets.run_sheet(portfolio(spark, sf), worksheets.portfolio_sheets()["sector_concentration"])
    return s.select("sector", r("market_value", 2).alias("market_value"), r("share", 6).alias("share"))


_sheet("portfolio", "sector_value", "TI9", " SELECT sector, round(sum(market_value), 2) AS market_value FROM portfolio GROUP BY 1", 2)


@query("sheet_portfolio_risk_and_return", "TI10 W4", f"""WITH {PORTFOLIO}, g AS (SELECT sector, avg(risk) AS risk, avg(return_pct) AS return_pct, sum(market_value) AS market_value FROM portfolio GROUP BY 1)
    SELECT sector, round(risk, 6) AS risk, round(return_pct, 6) AS return_pct, round(market_value, 2) AS market_value,
        round(avg(risk) OVER (), 6) AS avg_risk, round(avg(return_pct) OVER (), 6) AS avg_return_pct FROM g""")
def sheet_portfolio_risk_and_return(spark, sf):
    s = worksheets.run_sheet(portfolio(spark, sf), worksheets.portfolio_sheets()["risk_and_return"])
    return s.select("sector", r("market_value", 2).alias("market_value"), *[r(c, 6).alias(c) for c in ("risk", "return_pct", "avg_risk", "avg_return_pct")])


_sheet("portfolio", "class_risk", "TI11", _avg("asset_class", "risk"))
_sheet(
    "portfolio", "top_assets", "TI12 J7 W5",
    """, t AS (SELECT asset_id FROM portfolio GROUP BY 1 ORDER BY sum(market_value) DESC, asset_id LIMIT 10)
    SELECT asset_id, asset_class, round(sum(market_value), 2) AS market_value FROM portfolio JOIN t USING (asset_id) GROUP BY ALL""", 2,
)
_sheet(
    "portfolio", "value_over_time", "TI13 F18",
    " SELECT strftime(date_trunc('month', valuation_date), '%Y-%m-%d') AS month, asset_class, round(sum(market_value), 2) AS market_value FROM portfolio GROUP BY ALL", 2,
)
for _name, _covers, _m in (("return_trend", "TI14 J7", "return_pct"), ("benchmark_trend", "TI15 J7", "benchmark_pct")):
    _sheet(
        "portfolio", _name, _covers,
        f""", t AS (SELECT sector FROM portfolio GROUP BY 1 ORDER BY avg({_m}) DESC, sector LIMIT 5)
        SELECT strftime(date_trunc('month', valuation_date), '%Y-%m-%d') AS month, sector, round(avg({_m}), 4) AS {_m} FROM portfolio JOIN t USING (sector) GROUP BY ALL""",
    )
