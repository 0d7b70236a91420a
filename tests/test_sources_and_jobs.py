import datetime as dt
import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldbook.config import JobConfig
from fieldbook.plans import insights, job, worksheets
from fieldbook.session import ROW_GROUP, materialise
from fieldbook.sources import nested, readers, sinks


def test_dispatch_by_suffix(spark, tmp_path):
    (tmp_path / "a.CSV").write_text('id,name\n1,"x, y"\n2,z\n')
    (tmp_path / "a.tsv").write_text("id\tname\n1\tx y\n")
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    assert [tuple(r) for r in readers.read_any(spark, str(tmp_path / "a.CSV")).collect()] == [(1, "x, y"), (2, "z")]
    assert readers.read_any(spark, str(tmp_path / "a.tsv")).first()["name"] == "x y"
    assert readers.read_any(spark, str(tmp_path / "a.json")).count() == 2
    with pytest.raises(ValueError, match="no reader"):
        readers.read_any(spark, "x.dat")


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError, match="no rows"):
        readers.require_rows(spark.createDataFrame([], "a int"))


def test_excel_needs_its_parser(spark, tmp_path):
    with pytest.raises(NotImplementedError, match="openpyxl"):
        readers.read_any(spark, str(tmp_path / "a.xlsx"), schema="a int")


def test_nested_marks(spark, tmp_path):
    rows = spark.createDataFrame(
        [("e1", "n", 1, "math", 80.0), ("e1", "n", 1, "math", 60.0), ("e1", "n", 1, "art", 70.0), ("e1", "n", 2, "art", 90.0)],
        "enrollment string, name string, sem int, sub string, mark double",
    )
    out = nested.marks_round_trip(spark, rows, str(tmp_path))
    got = sorted((r["sem"], r["sub"], r["mark"], r["spi"], r["cpi"]) for r in out.collect())
    assert got == [(1, "art", 70.0, 70.0, 70.0), (1, "math", 60.0, 70.0, 70.0), (1, "math", 80.0, 70.0, 70.0), (2, "art", 90.0, 90.0, 80.0)]


def test_large_students_get_several_records(spark):
    rows = spark.range(1000).select(
        F.lit("e1").alias("enrollment"), F.lit("n").alias("name"), (F.col("id") % 2).cast("int").alias("sem"),
        F.lit("math").alias("sub"), (F.col("id") % 400).cast("double").alias("mark"),
    )
    records = nested.nest_marks(rows, record_marks=100)
    assert records.count() == 10
    flat = nested.flatten_marks(records)
    assert flat.count() == 1000 and flat.agg(F.sum("mark")).first()[0] == rows.agg(F.sum("mark")).first()[0]


RAW = [
    (1, " ann ", "p", "2024-01-01", 100.0, 10), (1, " ann ", "p", "2024-01-01", 100.0, 10),
    (2, "bob", None, "2024-01-03", None, 0), (3, "cy", "q", None, 0.0, 365), (4, "di", "q", "2024-01-05", 900.0, 90),
    (5, "ed", "p", "2024-01-06", 5000.0, 200), (6, "flo", "p", "2024-01-08", 300.0, 181), (7, "gil", "q", "2024-01-09", 600.0, 20),
]


def test_listing_job(spark, tmp_path):
    raw = spark.createDataFrame(RAW, ["Id", "Host Name", "Region", "Last Review", "Price", "Availability"])
    config = JobConfig(exclude_columns=("Host Name",), date_columns=("last_review",))
    prepared = job.clean(raw, config, order="id", positive="price")
    df = prepared.frame
    assert df.columns == ["id", "region", "last_review", "price", "availability"]
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {1, 2, 4, 5, 6, 7}  # price 0 removed after imputation
    assert rows[2]["price"] == 450.0 and rows[2]["region"] == "p"
    assert rows[4]["last_review"] == dt.datetime(2024, 1, 5)
    done = job.finish(job.Prepared(job.listing_features(df, config), prepared.quality), ["price"], config, ["price_tier"])
    got = {(r["metric"], r["column"]): r["value"] for r in done.quality.collect()}
    assert got[("rows_in", "")] == 8 and got[("duplicates_removed", "")] == 1 and got[("rows_out", "")] == 6
    assert got[("outliers_flagged", "price")] == 1 and got[("nulls_imputed", "last_review")] == 1
    assert done.frame.filter("id = 5").first()["price_capped"] == 1000.0
    found = insights.listing_insights(done.frame)
    job.report(done.frame, job.listing_tests(done.frame, config), found, str(tmp_path), "LISTINGS", "raw", correlations=True)
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "analytics_report")).collect()]
    heads = [x for x in lines if x.startswith("──")]
    assert heads == [
        "── DATA QUALITY ──", "── DESCRIPTIVE STATISTICS ──", "── DISTRIBUTIONS ──", "── TOP CORRELATIONS ──", "── STATISTICAL TEST RESULTS ──", "── ANALYTICAL INSIGHTS ──"
    ]
    report = json.loads(spark.read.text(str(tmp_path / "analytics_report_json")).first()["value"])
    assert report["metadata"]["dataset"] == "raw" and report["data_quality"][0]["total_rows"] == 6
    summary = [r["value"] for r in spark.read.text(str(tmp_path / "insight_summary")).collect()]
    assert summary[0] == "LISTINGS — INSIGHT SUMMARY" and "▶ PRICES" in summary


def test_compat_job_keeps_nulls_and_text_dates(spark):
    raw = spark.createDataFrame(RAW, ["Id", "Host Name", "Region", "Last Review", "Price", "Availability"])
    prepared = job.clean(raw, JobConfig(exclude_columns=("host_name",), compat=True), order="id")
    assert "host_name" in prepared.frame.columns
    assert dict(prepared.frame.dtypes)["last_review"] == "string"
    assert prepared.frame.filter("price is null").count() == 1


def test_insights_skip_missing_columns(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "region string, price double")
    titles = [r["title"] for r in insights.listing_insights(df).orderBy("ord").collect()]
    assert titles == ["What the listings table holds", "How prices spread", "Dearest and cheapest region", "Busiest regions"]


def test_categories_keep_first_seen_order(spark):
    df = spark.createDataFrame([(1, "t1", "b1", "B"), (2, "t2", "b2", "A"), (3, "t3", "b3", "B")], "ord int, title string, body string, category string")
    got = sinks.insight_summary(df).orderBy("ord").collect()
    assert [(r["category"], [x["title"] for x in r["items"]]) for r in got] == [("B", ["t1", "t3"]), ("A", ["t2"])]


def test_sheet_filters_and_top(spark):
    df = spark.createDataFrame([("a", "x", 5.0), ("a", "y", 1.0), ("b", "x", 4.0), ("c", "y", 2.0), (None, "y", 9.0)], "k string, d string, v double")
    sheet = worksheets.Sheet({"d": F.col("d")}, {"v": F.sum("v")}, top=("k", F.sum("v"), 2), share="v", reference=["v"])
    got = {r["d"]: r for r in worksheets.run_sheet(df, sheet).collect()}
    assert {k: r["v"] for k, r in got.items()} == {"x": 9.0, "y": 1.0}
    assert got["x"]["share"] == pytest.approx(0.9) and got["x"]["avg_v"] == 5.0
    board = worksheets.dashboard(df, {"s": worksheets.Sheet({"k": F.col("k")}, {"v": F.sum("v")})}, {"d": ["y"]})
    assert {r["k"]: r["v"] for r in board["s"].collect()} == {"a": 1.0, "c": 2.0, None: 9.0}


def test_local_disks_are_no_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from fieldbook.session import shared_folder

    def held(master, **settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: settings.get(key.replace(".", "_"), *default)), sparkContext=SimpleNamespace(master=master))

    here = {"spark_sql_warehouse_dir": "file:/home/x/warehouse"}
    assert shared_folder(held("local[4]", **here)) == "file:///home/x/warehouse"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(held("yarn", **here))
    assert shared_folder(held("yarn", spark_checkpoint_dir="hdfs://n/tmp/", **here)) == "hdfs://n/tmp"
    assert shared_folder(held("yarn", spark_sql_warehouse_dir="s3a://b/w")) == "s3a://b/w"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_insights_repeat_no_join(spark):
    from fieldbook.plans import insights

    left = spark.createDataFrame([(i, i % 90, float(i), "FM"[i % 2]) for i in range(40)], "id int, age int, billing double, gender string")
    joined = left.join(spark.createDataFrame([(i, f"H{i % 3}") for i in range(40)], "id int, hospital string"), "id")
    found = insights.patient_insights(joined)
    assert "Join" not in _plan(found)
    assert found.count() == 6


def test_the_listing_job_joins_its_tables_once(spark, monkeypatch, tmp_path):
    import catalog.insight_queries as queries

    spark.createDataFrame([(0, "X"), (1, "Y")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    customers = [(i, i % 2, "AB"[i % 2], 500.0 * i) for i in range(1, 9)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.range(1, 81).selectExpr(
        "id AS o_orderkey", "CASE WHEN id % 40 <> 0 THEN id % 9 END AS o_custkey", "CASE WHEN id % 3 = 0 THEN 'P' ELSE 'F' END AS o_orderstatus",
        "1000.0D * id AS o_totalprice", "timestamp_seconds(id * 86400) AS o_orderdate")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    raws, clean = [], queries.job.clean
    monkeypatch.setattr(queries.job, "clean", lambda raw, *a, **k: raws.append(raw) or clean(raw, *a, **k))
    made = queries.listing_features(spark, str(tmp_path))
    assert "Join" not in _plan(raws[0])
    known = orders.where("o_custkey BETWEEN 1 AND 8")
    assert sorted(r["id"] for r in made.collect()) == sorted(r["o_orderkey"] for r in known.collect())
    sizes = {r["o_custkey"]: r["count"] for r in known.groupBy("o_custkey").count().collect()}
    assert {(r["host_id"], r["host_listings"]) for r in queries.listings(spark, str(tmp_path)).collect()} == set(sizes.items())


def test_a_stored_step_is_read_by_several_tasks(spark):
    kept = materialise(spark.range(3_000_000).select(F.xxhash64("id").alias("h")).coalesce(1), "split", ROW_GROUP)
    (file,) = [f.removeprefix("file:") for f in kept.inputFiles()]
    assert pq.ParquetFile(re.sub("^/+", "/", file)).num_row_groups > 1
    assert kept.agg(F.bit_xor("h")).first()[0] == spark.range(3_000_000).agg(F.bit_xor(F.xxhash64("id"))).first()[0]
