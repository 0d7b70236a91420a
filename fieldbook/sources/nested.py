"""Nested records: student → semesters → subjects, written as JSON, read back,
flattened to rows, saved as CSV and as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldbook.session import attach_groups

NESTED_SCHEMA = """
    enrollment string, name string, part long,
    semesters array<struct<sem: int, spi: double, cpi: double,
        subjects: array<struct<sub: string, marks: array<struct<mark: double, times: long>>>>>>
"""
# Marks per record; a student with more gets several records.
RECORD_MARKS = 100_000
# Equal marks stored under one number; more are stored as several.
EQUAL_MARKS = 1_000


def nest_marks(rows: DataFrame, record_marks: int = RECORD_MARKS) -> DataFrame:
    """Rows (enrollment, name, sem, sub, mark) as nested records.

    ``spi`` is the mean mark of a semester, ``cpi`` the mean of the semesters so
    far. Equal marks are stored once with their number, and the marks of a large
    student are split over parts, so no record grows with the table.
    """
    student = ["enrollment", "name"]
    counted = rows.groupBy(*student, "sem", "sub", "mark").agg(F.count("*").alias("times"))
    so_far = Window.partitionBy(*student).orderBy("sem").rowsBetween(Window.unboundedPreceding, 0)
    semesters = rows.groupBy(*student, "sem").agg(F.avg("mark").alias("spi"), F.count("*").alias("_n")).select(
        *student, "sem", "spi", F.avg("spi").over(so_far).alias("cpi"),
        F.ceil(F.sum("_n").over(Window.partitionBy(*student)) / record_marks).alias("_parts"),
    )
    # At most EQUAL_MARKS of them together, and those over the parts.
    pile = F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / EQUAL_MARKS)))
    counted = counted.withColumn("_pile", pile).withColumn("times", F.least(F.col("times") - F.col("_pile") * EQUAL_MARKS, F.lit(EQUAL_MARKS)))
    placed = attach_groups(counted, semesters, [*student, "sem"]).withColumn(
        "part", F.pmod(F.xxhash64("sem", "sub", "mark", "_pile"), F.col("_parts"))
    )
    subjects = placed.groupBy(*student, "part", "sem", "spi", "cpi", "sub").agg(
        F.collect_list(F.struct("mark", "times")).alias("marks")
    )
    terms = subjects.groupBy(*student, "part", "sem", "spi", "cpi").agg(
        F.collect_list(F.struct("sub", "marks")).alias("subjects")
    )
    return terms.groupBy(*student, "part").agg(
        F.collect_list(F.struct("sem", "spi", "cpi", "subjects")).alias("semesters")
    )


def flatten_marks(nested: DataFrame) -> DataFrame:
    """One row per mark, with the semester's averages."""
    return (
        nested.select("enrollment", "name", F.explode("semesters").alias("s"))
        .select("enrollment", "name", "s.sem", "s.spi", "s.cpi", F.explode("s.subjects").alias("t"))
        .select("enrollment", "name", "sem", "spi", "cpi", "t.sub", F.explode("t.marks").alias("m"))
        .select("enrollment", "name", "sem", "spi", "cpi", "sub", "m.mark", F.explode(F.sequence(F.lit(1), F.col("m.times"))).alias("_i"))
        .drop("_i")
    )


def marks_round_trip(spark: SparkSession, rows: DataFrame, folder: str, table: str | None = None) -> DataFrame:
    """Write nested JSON, read it, flatten it to CSV, and read that (or the saved table)."""
    nest_marks(rows).write.json(f"{folder}/nested")
    flat = flatten_marks(spark.read.schema(NESTED_SCHEMA).json(f"{folder}/nested"))
    flat.write.option("header", True).csv(f"{folder}/flat")
    back = spark.read.schema(flat.schema).option("header", True).csv(f"{folder}/flat")
    if table:
        back.write.mode("overwrite").option("path", f"{folder}/table").saveAsTable(table)
        return spark.table(table)
    return back
