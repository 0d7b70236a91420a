"""What the operators share: input shape, learning folds, the registry of their queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL giving the same table."""

    def add(fn: Query) -> Query:
        REGISTRY[name] = Entry(fn, sql)
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns an operator works on; anything else in the table, whatever its
    name, stays out of the operator's plan."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def raw_texts(docs: DataFrame) -> DataFrame:
    """Texts as UTF-8 bytes, null as empty. Byte methods lower-case and split by ASCII
    rules only, which is what the operators' word and line definitions ask for."""
    return texts(docs).select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def fold(parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def hand_back() -> None:
    """Give memory that is free again back to the system: a Python process lives on beside a
    heap that may need it."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def mapped(frame: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """mapInArrow that hands memory back when a task ends, as its worker lives on for others."""

    def whole(batches):
        yield from run(batches)
        hand_back()

    return frame.mapInArrow(whole, schema)


def free_name(frame: DataFrame, wanted: str) -> str:
    """The name, with underscores before it until the frame has no column of that name."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
