"""Session helpers: settings the jobs rely on and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_ROOTS: set[str] = set()


def build_session(master: str | None = None, app: str = "fieldbook", **settings: str) -> SparkSession:
    """A session with UTC times, AQE (with skew-join splitting) and no web UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # No call-site capture per column expression: it doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**base, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a local session takes its warehouse; on a cluster a
    warehouse on local disks would not be shared, and that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and re.match(r"(file:)?/", shared):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {shared} is on local disks")
    return re.sub("^file:/+", "file:///", shared.rstrip("/"))


def scratch_root(spark: SparkSession) -> str:
    """A folder of this session below the shared one. It goes when the driver ends."""
    shared = shared_folder(spark)
    root = f"{shared}/fieldbook-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Row groups of steps that hold all rows of a table: files of Parquet's usual 128 MB have one, and
#: a row group is read by one task.
ROW_GROUP = 8 * 1024 * 1024


def materialise(df: DataFrame, label: str = "step", row_group: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here
    and a lost executor costs a re-read instead of a re-run. ``row_group``: bytes that
    are read by one task, where files are to be read by several."""
    path = scratch_path(df.sparkSession, label)
    (df.write.option("parquet.block.size", row_group) if row_group else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str = "step") -> DataFrame:
    """The frame itself if its plan is no more than the scan of a table, else a stored copy: for
    steps that read a frame several times."""
    return df if df._jdf.queryExecution().optimizedPlan().children().isEmpty() else materialise(df, label, ROW_GROUP)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, the number its own broadcast rule uses.
    No job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def scanned_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables below a plan, None if one has no known size. Unlike the estimate
    for the plan as a whole, joins do not multiply it. No job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if any(x >= 1 << 60 for x in sizes) else sum(sizes)


# A group table up to this decoded size goes to every task; it is measured after it was written.
BROADCAST_BYTES = 16 * 1024 * 1024
SALTS = 64
# A key is hot if it has more than this share of the rows, so there are few of them.
HOT_SHARE = 1 / (4 * SALTS)


def decoded_bytes(df: DataFrame) -> int:
    """About the size of a frame's rows in memory: the length of their text form, twice."""
    return 2 * (df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0)


def _matched(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on equal keys, null keys included, keeping the left side's keys."""
    renamed = right.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(on)})
    cond = F.lit(True)
    for i, k in enumerate(on):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return left.join(renamed, cond, how).drop(*[f"_key_{i}" for i in range(len(on))])


def attach_groups(rows: DataFrame, groups: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a table holding one row per group, without gathering a group.

    The group table is written first, so its size is known: a small one is
    broadcast and the rows stay where they are. With a larger one, the rows of hot
    keys, at most ``1 / HOT_SHARE`` of them, are salted and those keys' groups
    repeated per salt; all others are joined as they are.
    """
    groups = materialise(groups, "groups")
    if estimated_bytes(groups) <= BROADCAST_BYTES and decoded_bytes(groups) <= BROADCAST_BYTES:
        return _matched(rows, F.broadcast(groups), on, how)
    sizes = materialise(rows.groupBy(*on).agg(F.count("*").alias("_n")), "group-sizes")
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(sizes.where(F.col("_n") > total * HOT_SHARE).select(*on, F.lit(True).alias("_hot")))
    others = [c for c in rows.columns if c not in on]
    # The input partition is part of the salt, so equal rows spread out as well; a task
    # that runs again gives its rows the same salts.
    place = F.pmod(F.xxhash64(*others), F.lit(SALTS)) + F.spark_partition_id()
    salt = F.when(F.col("_hot"), F.pmod(place, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    salted = _matched(rows, hot, on, "left").withColumn("_salt", salt).drop("_hot")
    repeat = F.when(F.col("_hot"), F.lit(SALTS - 1)).otherwise(F.lit(0))
    spread = _matched(groups, hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), repeat))).drop("_hot")
    return _matched(salted, spread, [*on, "_salt"], how).drop("_salt")
