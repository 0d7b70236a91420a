"""The end-to-end job: prepare a table, profile it, test it, describe it, report it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from fieldbook.config import JobConfig
from fieldbook.operators import binning, cleaning, imputing, inference, models, profile
from fieldbook.operators.shaping import columns_of, present
from fieldbook.session import ROW_GROUP, materialise
from fieldbook.sources import sinks


@dataclass(frozen=True)
class Prepared:
    """A cleaned frame with its quality report ``(metric, column, value)``."""

    frame: DataFrame
    quality: DataFrame


def _metrics(df: DataFrame, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, "metric string, column string, value long")


def clean(
    raw: DataFrame, config: JobConfig, order: str | None = None, positive: str | None = None,
    title: bool = False,
) -> Prepared:
    """Drop listed columns, tidy names and text, promote dates, remove duplicate rows,
    impute, and (with ``positive``) keep only rows where that column is above zero.

    The counts of rows and nulls come from observers on the write of the cleaned
    table, not from extra passes.
    """
    df = cleaning.nan_to_null(raw)
    df = cleaning.drop_listed(df, config.exclude_columns, raw_names=config.compat)
    df = cleaning.tidy_columns(df)
    if not config.compat:
        df = cleaning.promote_dates(
            df, config.date_formats, config.date_hints, config.date_parse_rate, config.date_columns
        )
    df = cleaning.strip_text(df, title)
    before, after = Observation(), Observation()
    df = df.observe(before, F.count(F.lit(1)).alias("rows")).dropDuplicates()
    missing = [F.count_if(F.col(c).isNull()).alias(f"null{i}") for i, c in enumerate(df.columns)]
    df = df.observe(after, F.count(F.lit(1)).alias("rows"), *missing)
    df = materialise(df, "deduplicated", ROW_GROUP)
    rows_in, rows_kept = before.get["rows"], after.get["rows"]
    nulls = {c: after.get[f"null{i}"] for i, c in enumerate(df.columns)}
    holes = [c for c in df.columns if nulls[c]]
    if not config.compat and holes:
        numeric = [c for c in holes if c in columns_of(df, "numeric")]
        dates = [c for c in holes if c in columns_of(df, "datetime")]
        others = [c for c in holes if c not in numeric and c not in dates]
        if numeric:
            df = imputing.fill_median(df, numeric)
        if dates and order:
            df = imputing.fill_previous(df, dates, order)
        if others:
            df = imputing.fill_mode(df, others)
    if positive and positive in df.columns:
        df = df.filter(F.col(positive) > 0)
    df = materialise(df, "imputed", ROW_GROUP)
    quality = _metrics(
        df,
        [("rows_in", "", rows_in), ("duplicates_removed", "", rows_in - rows_kept)]
        + [("nulls_imputed" if not config.compat else "nulls_kept", c, nulls[c]) for c in holes],
    )
    return Prepared(df, quality)


def finish(prepared: Prepared, columns: Sequence[str], config: JobConfig, features: Sequence[str] = ()) -> Prepared:
    """Add outlier flags, store the result, and complete the quality report."""
    df = binning.flag_outliers(prepared.frame, columns, config.fence)
    df = materialise(df, "prepared", ROW_GROUP)
    flags = binning.outlier_totals(df).select(
        F.lit("outliers_flagged").alias("metric"), "column", F.col("outliers").alias("value")
    )
    rows = df.agg(
        F.lit("rows_out").alias("metric"), F.lit("").alias("column"), F.count(F.lit(1)).alias("value")
    )
    made = _metrics(df, [("feature", f, 1) for f in present(df, features)])
    return Prepared(df, reduce(DataFrame.unionByName, [prepared.quality, rows, made, flags]))


# Bin edges and labels of the listing features (fixed values).
AVAILABILITY = ((-1, 0, 90, 180, 365), ("Unavailable", "Low", "Medium", "High"))
HOST_SIZE = ((0, 1, 5, 20, float("inf")), ("Solo", "Small", "Medium", "Commercial"))
PRICE_TIERS = ("Budget", "Mid-Range", "Premium", "Luxury")
BILL_TIERS = ("Low", "Medium", "High", "Premium")
AGE_GROUPS = ((0, 18, 35, 50, 65, float("inf")), ("<18", "18-35", "36-50", "51-65", "65+"))


def listing_features(df: DataFrame, config: JobConfig) -> DataFrame:
    """Capped and logged price, price tier, availability and host classes, review flag,
    revenue proxy and days since the latest review, for the columns present."""
    has = set(df.columns)
    if "price" in has:
        df = df.withColumn("price_capped", cleaning.clip(F.col("price"), upper=F.lit(config.price_cap)))
        df = binning.quantile_cut(df, "price_capped", PRICE_TIERS, "price_tier")
        df = df.withColumn("log_price", F.log1p("price"))
    if "availability" in has:
        df = df.withColumn("availability_cat", binning.cut(F.col("availability"), *AVAILABILITY))
    if "reviews" in has:
        df = df.withColumn("has_reviews", (F.col("reviews") > 0).cast("int"))
    if "host_listings" in has:
        df = df.withColumn("host_type", binning.cut(F.col("host_listings"), *HOST_SIZE))
    if {"price", "availability"} <= has:
        df = df.withColumn("revenue", F.col("price_capped") * F.col("availability"))
    if "last_review" in columns_of(df, "datetime"):
        latest = df.agg(F.max("last_review")).scalar()
        df = df.withColumn("days_since_review", F.datediff(latest, "last_review"))
    return df


def patient_features(df: DataFrame) -> DataFrame:
    """Date parts, length of stay, logged numbers, bill tier and age group."""
    for c in columns_of(df, "datetime"):
        name = c.replace("_", "")
        df = df.withColumns(
            {f"{name}_year": F.year(c), f"{name}_month": F.month(c), f"{name}_dow": F.weekday(c), f"{name}_quarter": F.quarter(c)}
        )
    if {"admitted", "discharged"} <= set(columns_of(df, "datetime")):
        df = df.withColumn("stay", F.greatest(F.datediff("discharged", "admitted"), F.lit(0)))
    df = binning.log_columns(df)
    if "billing" in df.columns:
        floor = df.withColumn("_b", cleaning.clip(F.col("billing"), lower=F.lit(0.0)))
        df = binning.quantile_cut(floor, "_b", BILL_TIERS, "billing_band").drop("_b")
    if "age" in df.columns:
        df = df.withColumn("age_group", binning.cut(F.col("age"), *AGE_GROUPS))
    return df


def listing_tests(df: DataFrame, config: JobConfig) -> dict[str, DataFrame]:
    """The listing tests that the frame has the columns for."""
    has, tests = set(df.columns), {}
    if {"price_capped", "region"} <= has:
        tests["anova_price_region"] = inference.anova(df, "price_capped", "region", config.alpha)
    if {"price_capped", "room_type"} <= has:
        tests["anova_price_room_type"] = inference.anova(df, "price_capped", "room_type", config.alpha)
        two = [r[0] for r in df.groupBy("room_type").count().orderBy(F.desc("count"), "room_type").limit(2).collect()]
        if len(two) == 2:
            tests["ttest_two_largest_types"] = inference.welch(df, "price_capped", "room_type", *two, config.alpha)
    if {"room_type", "region"} <= has:
        tests["chi2_room_region"] = inference.chi_square(df, "room_type", "region", config.alpha)
    predictors = present(df, ["min_nights", "reviews", "host_listings", "availability"])
    if "price_capped" in has and predictors:
        tests["regression_price"] = inference.ridge(df, "price_capped", predictors)
    groups = cluster_quality(df, LISTING_SHAPE, config)
    if groups is not None:
        tests["cluster_quality"] = groups
    return tests


def patient_tests(df: DataFrame, config: JobConfig) -> dict[str, DataFrame]:
    """The patient tests that the frame has the columns for."""
    has, tests = set(df.columns), {}
    if {"billing", "condition"} <= has:
        tests["anova_billing_condition"] = inference.anova(df, "billing", "condition", config.alpha)
    if {"condition", "result"} <= has:
        tests["chi2_condition_result"] = inference.chi_square(df, "condition", "result", config.alpha)
    if {"billing", "age"} <= has:
        tests["regression_billing_age"] = inference.linear_fit(df, "billing", "age")
    if {"billing", "gender"} <= has:
        two = [r[0] for r in df.groupBy("gender").count().orderBy(F.desc("count"), "gender").limit(2).collect()]
        if len(two) == 2:
            tests["ttest_two_largest_genders"] = inference.welch(df, "billing", "gender", *two, config.alpha)
    return tests


def cluster_quality(df: DataFrame, columns: Sequence[str], config: JobConfig) -> DataFrame | None:
    """k-means on the scaled columns present and how far its clusters lie apart:
    ``clusters, rows, silhouette, reading``; nothing for fewer than three columns.

    The silhouette is over all rows, under squared distance to scaled columns.
    """
    usable = [c for c in present(df, columns) if c in columns_of(df, "numeric")]
    if len(usable) < 3:
        return None
    scaled = materialise(models.standard_scale(df.select(*usable).dropna(), usable), "scaled", ROW_GROUP)
    rows, _ = models.kmeans_clusters(scaled, usable, config.clusters, config.restarts, config.seed)
    value = models.silhouette_squared(rows, usable, "cluster")
    reading = "the rows fall into separate groups" if value > 0.2 else "the groups run into each other"
    return rows.agg(
        F.count_distinct("cluster").alias("clusters"), F.count("*").alias("rows"),
        F.lit(value).alias("silhouette"), F.lit(reading).alias("reading"),
    )


#: Columns that tell listings apart.
LISTING_SHAPE = ("price_capped", "availability", "reviews", "min_nights", "host_listings")


def test_rows(tests: dict[str, DataFrame]) -> DataFrame:
    """All test results as (test, result) with the result as JSON text."""
    frames = [
        t.select(F.lit(name).alias("test"), F.to_json(F.struct("*")).alias("result")) for name, t in tests.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def report(
    df: DataFrame, tests: dict[str, DataFrame], insights: DataFrame, folder: str, title: str, dataset: str,
    correlations: bool = False, top_pairs: int = JobConfig.top_pairs, alpha: float = JobConfig.alpha,
) -> None:
    """Write the text report, the JSON report and the insight summary below a folder."""
    quality = profile.data_quality(df)
    numbers = profile.describe(df)
    results = test_rows(tests)
    shapes = inference.normality(df, columns_of(df, "numeric"), alpha)
    # Each small result is computed once and read by both reports.
    quality, numbers, results, insights, shapes = (
        materialise(part, name)
        for part, name in ((quality, "quality"), (numbers, "numbers"), (results, "tests"), (insights, "insights"), (shapes, "shapes"))
    )
    sections = [
        ("data quality", sinks.key_value_lines(quality, "data quality")),
        ("descriptive statistics", sinks.table_lines(numbers, "descriptive statistics", "column")),
        ("distributions", sinks.table_lines(shapes, "distributions", "column")),
    ]
    if correlations:
        pairs = profile.top_correlations(df, n=top_pairs).select(
            F.lit("top correlations").alias("section"),
            F.format_string("%08.6f", 2 - F.abs("r")).alias("item"), F.lit(0).alias("pos"),
            F.format_string("  %s ~ %s: %.4f", "x", "y", "r").alias("line"),
        )
        sections.append(("top correlations", pairs))
    sections += [
        ("statistical test results", sinks.key_value_lines(results, "statistical test results", "test")),
        ("analytical insights", sinks.insight_lines(insights, "analytical insights")),
    ]
    sinks.write_text_report(sinks.text_report(title, dataset, sections), f"{folder}/analytics_report")
    parts = {
        "data_quality": quality, "categorical_summary": profile.categorical_summary(df).drop("value_counts"),
        "numeric_summary": numbers, "distributions": shapes, "statistical_tests": results, "insights": insights,
    }
    sinks.write_json_report(sinks.json_report(dataset, parts), f"{folder}/analytics_report_json")
    sinks.write_insight_summary(insights, f"{folder}/insight_summary", f"{title} — INSIGHT SUMMARY")
