"""Dashboard worksheets: dimensions, measures, filters, top-n, sorting and shares."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.running import share_of_total
from fieldbook.operators.shaping import keep_groups, top_groups


@dataclass(frozen=True)
class Sheet:
    """One worksheet.

    ``dims`` and ``measures`` map output names to columns and aggregates;
    ``having`` filters the aggregated rows; ``top`` is (dimension column,
    aggregate, n) and keeps the rows of the n best keys; ``share`` and
    ``reference`` name measures to add a share of total or a table average for.
    """

    dims: Mapping[str, Column] = field(default_factory=dict)
    measures: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None
    having: Column | None = None
    top: tuple[str, Column, int] | None = None
    sort: Sequence[Column] = ()
    share: str | None = None
    reference: Sequence[str] = ()


def run_sheet(df: DataFrame, sheet: Sheet) -> DataFrame:
    """The worksheet's table. Dimensions keep null members, as a dashboard does."""
    if sheet.where is not None:
        df = df.filter(sheet.where)
    if sheet.top:
        key, metric, n = sheet.top
        df = keep_groups(df, top_groups(df, [key], metric, n), [key])
    dims = [c.alias(name) for name, c in sheet.dims.items()]
    out = df.groupBy(*dims).agg(*[m.alias(name) for name, m in sheet.measures.items()])
    if sheet.having is not None:
        out = out.filter(sheet.having)
    if sheet.share:
        out = share_of_total(out, sheet.share)
    if sheet.reference:
        line = out.agg(F.struct(*[F.avg(m).alias(m) for m in sheet.reference])).scalar()
        out = out.withColumn("_line", line).withColumns(
            {f"avg_{m}": F.col("_line")[m] for m in sheet.reference}
        ).drop("_line")
    return out.orderBy(*sheet.sort) if sheet.sort else out


def dashboard(
    df: DataFrame, sheets: Mapping[str, Sheet], selected: Mapping[str, Sequence[object]] | None = None
) -> dict[str, DataFrame]:
    """All worksheets over one base frame. ``selected`` is a filter action: members
    picked per column, applied ahead of every sheet."""
    for column, members in (selected or {}).items():
        df = df.filter(F.col(column).isin(list(members)))
    return {name: run_sheet(df, sheet) for name, sheet in sheets.items()}


def total(column: str) -> Column:
    return F.sum(column)


def sales_sheets() -> dict[str, Sheet]:
    """Orders dashboard; columns category, sub_category, segment, ship_mode, country,
    state, city, order_date, sales."""
    c, s = F.col, {"sales": total("sales")}
    place = {"country": c("country"), "state": c("state"), "city": c("city")}
    return {
        "category_sales": Sheet({"category": c("category")}, s),
        "sub_category_treemap": Sheet({"category": c("category"), "sub_category": c("sub_category")}, s),
        "place_by_category": Sheet({**place, "category": c("category")}, s),
        "place_by_segment": Sheet({"country": c("country"), "city": c("city"), "segment": c("segment")}, s),
        "segment_sales": Sheet({"segment": c("segment")}, s),
        "month_by_category": Sheet({"month": F.month("order_date"), "category": c("category")}, s),
        "ship_mode_sales": Sheet({"ship_mode": c("ship_mode")}, s),
        "year_by_place": Sheet({"year": F.year("order_date"), **place}, s),
    }


def staff_sheets() -> dict[str, Sheet]:
    """Staff dashboard; columns department, salary, satisfaction, evaluation, projects,
    hours, left_flag, promoted."""
    c = F.col
    department, salary = {"department": c("department")}, {"salary": c("salary")}
    return {
        "headline": Sheet(
            {}, {"staff": F.count("*"), "satisfaction": F.avg("satisfaction"), "leavers": total("left_flag")}
        ),
        "satisfaction_marks": Sheet(
            {"satisfaction": c("satisfaction"), "evaluation": c("evaluation"), "left_flag": c("left_flag")},
            {"staff": F.count("*")},
        ),
        "hours_leavers": Sheet(
            {"hours": c("hours")},
            {"leavers": total("left_flag"), "satisfaction": total("satisfaction"), "left_rate": F.avg("left_flag")},
            having=c("left_rate").between(0, 1),
        ),
        "hours_by_salary": Sheet(salary, {"hours": F.avg("hours")}),
        "projects_by_department": Sheet(department, {"projects": total("projects")}),
        "promotions_by_department": Sheet(department, {"promotions": total("promoted")}),
        "leavers_by_department": Sheet(department, {"leavers": total("left_flag")}),
        "leavers_by_salary": Sheet(salary, {"leavers": total("left_flag")}, share="leavers"),
        "satisfaction_by_department": Sheet(department, {"satisfaction": F.avg("satisfaction")}),
        "projects_by_salary": Sheet(salary, {"projects": F.avg("projects")}),
    }


def measure_names(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Several totals as rows (measure, value)."""
    one = df.agg(*[m.cast("double").alias(name) for name, m in measures.items()])
    return one.unpivot([], list(measures), "measure", "value")


def listing_sheets() -> dict[str, Sheet]:
    """Listings dashboard; columns id, host_id, region, area, room_type, price, reviews,
    reviews_per_month, availability."""
    from fieldbook.operators.binning import fixed_bin

    c = F.col
    return {
        "reviews_by_area": Sheet(
            {"area": c("area"), "reviews_per_month": c("reviews_per_month")}, {"reviews": total("reviews")}
        ),
        "headline": Sheet({}, {"hosts": F.count("host_id"), "price": F.avg("price")}),
        "room_types": Sheet({"room_type": c("room_type")}, {"hosts": F.count("host_id")}),
        "region_counts": Sheet(
            {"region": c("region")}, {"listings": F.count("id")}, sort=[F.desc("listings"), F.asc("region")]
        ),
        "region_prices": Sheet({"region": c("region")}, {"price": F.avg("price")}),
        "large_hosts": Sheet(
            {"host_id": c("host_id")}, {"listings": F.count("id")}, having=c("listings") >= 100
        ),
        "price_and_reviews": Sheet(
            {"id": c("id"), "room_type": c("room_type")}, {"price": total("price"), "reviews": total("reviews")}
        ),
        "availability_bins": Sheet(
            {"availability_bin": fixed_bin(c("availability"), 11.4)}, {"listings": F.count("*")}
        ),
        "reviewed_by_region": Sheet(
            {"region": c("region")}, {"reviewed": F.count("reviews_per_month")}, share="reviewed"
        ),
    }


def portfolio_sheets() -> dict[str, Sheet]:
    """Portfolio dashboard; columns asset_id, asset_class, sector, valuation_date, cost,
    market_value, return_pct, risk, benchmark_pct."""
    c = F.col
    sector, klass = {"sector": c("sector")}, {"asset_class": c("asset_class")}
    month = {"month": F.date_trunc("month", "valuation_date")}
    value = {"market_value": total("market_value")}
    return {
        "class_return": Sheet(klass, {"return_pct": F.avg("return_pct")}),
        "class_benchmark": Sheet(klass, {"benchmark_pct": F.avg("benchmark_pct")}),
        "class_cost": Sheet(klass, {"cost": total("cost")}),
        "sector_benchmark": Sheet(sector, {"benchmark_pct": F.avg("benchmark_pct")}),
        "sector_cost": Sheet(sector, {"cost": total("cost")}),
        "sector_risk": Sheet(sector, {"risk": F.avg("risk")}, sort=[F.desc("risk"), F.asc("sector")]),
        "sector_return": Sheet(
            sector, {"return_pct": F.avg("return_pct")}, sort=[F.desc("return_pct"), F.asc("sector")]
        ),
        "sector_concentration": Sheet(
            sector, value, share="market_value", sort=[F.desc("market_value"), F.asc("sector")]
        ),
        "sector_value": Sheet(sector, value),
        "risk_and_return": Sheet(
            sector, {"risk": F.avg("risk"), "return_pct": F.avg("return_pct"), **value},
            reference=["risk", "return_pct"],
        ),
        "class_risk": Sheet(klass, {"risk": F.avg("risk")}),
        "top_assets": Sheet(
            {"asset_id": c("asset_id"), **klass}, value, top=("asset_id", total("market_value"), 10)
        ),
        "value_over_time": Sheet({**month, **klass}, value),
        "return_trend": Sheet(
            {**month, **sector}, {"return_pct": F.avg("return_pct")}, top=("sector", F.avg("return_pct"), 5)
        ),
        "benchmark_trend": Sheet(
            {**month, **sector}, {"benchmark_pct": F.avg("benchmark_pct")},
            top=("sector", F.avg("benchmark_pct"), 5),
        ),
    }


SheetSet = Callable[[], dict[str, Sheet]]
DASHBOARDS: dict[str, SheetSet] = {
    "sales": sales_sheets, "staff": staff_sheets, "listings": listing_sheets, "portfolio": portfolio_sheets,
}
