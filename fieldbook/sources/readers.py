"""Reading tables: files by suffix, declared schemas, SQL, literals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Reader = Callable[..., DataFrame]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """Header CSV. Give a schema where possible: inference reads the data twice."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("multiLine", False)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Tab-separated text with a header."""
    return read_csv(spark, path, schema, sep="\t")


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, lines: bool = False
) -> DataFrame:
    """JSON records: arrays of objects per file, or one object per line (splittable)."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet files."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_excel(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, sheet: int | str = 0
) -> DataFrame:
    """Workbooks under a path, one task per file; needs a declared schema and openpyxl."""
    try:
        import openpyxl  # noqa: F401
    except ImportError as missing:
        raise NotImplementedError("reading .xlsx/.xls needs the openpyxl package on every executor") from missing
    if schema is None:
        raise ValueError("read_excel needs a schema: workbooks carry none that is known before reading")
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def decode(batches):
        import io

        for pdf in batches:
            for content in pdf["content"]:
                yield pd.read_excel(io.BytesIO(content), sheet_name=sheet)[target.names]

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(decode, target)


# File suffix to reader (fixed values).
READERS: dict[str, Reader] = {
    ".csv": read_csv,
    ".tsv": read_tsv,
    ".json": read_json,
    ".parquet": read_parquet,
    ".xlsx": read_excel,
    ".xls": read_excel,
}


def read_any(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Choose the reader by the lower-cased suffix."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix not in READERS:
        raise ValueError(f"no reader for '{suffix}' files; known: {', '.join(READERS)}")
    return READERS[suffix](spark, path, **options)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """The frame itself, or an error when it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def read_sql(
    spark: SparkSession, query: str, url: str | None = None, partition: Mapping[str, object] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """A SQL query over the given frames, or over a JDBC database when ``url`` is set.

    For JDBC, ``partition`` (partitionColumn, lowerBound, upperBound,
    numPartitions) makes the read parallel.
    """
    if url is None:
        return spark.sql(query, **tables)
    options = {"url": url, "dbtable": f"({query}) q", **(partition or {})}
    return spark.read.format("jdbc").options(**options).load()


def literal_frame(spark: SparkSession, columns: Mapping[str, Sequence[object]], schema: str | None = None) -> DataFrame:
    """A small frame from a mapping of column name to values."""
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, schema or list(columns))
