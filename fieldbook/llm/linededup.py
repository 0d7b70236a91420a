"""Line dedup against levelled sorted runs of line hashes.

Documents are taken in batches of ascending id. A run is a stored table of line hashes that
earlier batches have seen, dealt out by hash and sorted, so that a batch's own hashes meet it
without the run moving. For each batch its hashes are reduced to the smallest document of each and
merge-joined with the runs: those found were seen before, and the rest, which no run has, is added
as a run of its own. ``FANOUT`` runs of a level are merged into one of the next, bucket by bucket:
runs are joined in their order, so neither a lookup nor a merge sorts or moves them, and a merged
run has one file per bucket like any other. A hash's owner, its first document, keeps its lines;
all other documents lose theirs.

Runs can be kept in a folder (``Runs(spark, folder)``) and opened again by a later call, which
then drops lines that documents of earlier calls have. Ids should ascend from call to call for
the result to be that of one call; where they do not, the earlier call's document keeps the line.

A hash is 128 bits wide. A line that is in a great many documents is combined to one row per
task before it is shuffled, and the join that tells its documents what to drop is one whose
large partitions Spark splits.

Lines: a text is split at newlines; a null or empty text is one empty line. A line's key is the
line without ASCII white space at its ends, A-Z lower-cased; only keys of at least ``LEAST`` code
points count. Null ids: such rows keep all lines and take none from others. Repeated rows: equal
ids are one document, which keeps or loses its lines in all its rows. Empty table: no rows. No
line left: an empty text. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm.common import free_name, mapped, raw_texts
from fieldbook.session import materialise, scratch_path

LEAST = 10  # code points of a key
BATCHES, FANOUT = 4, 2


def keys_of(text: bytes) -> list[bytes | None]:
    """For each line, the hash of its key, or None for a short one."""
    from xxhash import xxh3_128_digest

    out: list[bytes | None] = []
    for line in text.lower().split(b"\n"):
        key = line.strip()
        long = len(key) >= 4 * LEAST or len(key) >= LEAST and len(key.decode("utf-8", "replace")) >= LEAST
        out.append(xxh3_128_digest(key) if long else None)
    return out


def line_hashes(docs: DataFrame) -> DataFrame:
    """doc_id and each distinct line hash of every row, as two longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            own, found = [], []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                distinct = {k for k in keys_of(t.as_py()) if k is not None}
                own += [i] * len(distinct)
                found += distinct
            both = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], names=["doc_id", "h", "g"])

    return mapped(raw_texts(docs).where("doc_id is not null"), run, "doc_id long, h long, g long")


#: What a stored run holds: a hash, its first and last document in the batch, and the owner that
#: an earlier run has for it, null if it is new.
RUN = "h BIGINT, g BIGINT, owner BIGINT, last BIGINT, earlier BIGINT"
#: Bucketed scans tell Spark their order if each bucket is one file.
IN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def ordered_scans(spark: SparkSession):
    before = spark.conf.get(IN_ORDER)
    spark.conf.set(IN_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(IN_ORDER, before)


class Runs:
    """Levels of stored runs (h, g, owner), each bucketed and sorted by hash.

    folder: where they stay for later calls, a path that all executors reach; without one they
    go with the session. ``close`` takes their tables out of the catalog; files stay.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.paths: list[list[str]] = []
        self.tables: list[str] = []
        self.version = 0
        if folder:
            self._open()

    def __enter__(self) -> Runs:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = []

    def _open(self) -> None:
        """Read the latest list of runs in the folder, if there is one."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in store.listStatus(path)] if store.exists(path) else []
        done = [n for n in names if n.startswith("state-") and store.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}/_SUCCESS"))]
        if not done:
            return
        self.version = max(int(n.removeprefix("state-")) for n in done)
        held = self.spark.read.parquet(f"{self.folder}/state-{self.version}").orderBy("level", "place").collect()  # a row per run
        for row in held:
            self.buckets = row["buckets"]
            while len(self.levels) <= row["level"]:
                self.levels.append([])
                self.paths.append([])
            if row["run"]:
                path = f"{self.folder}/{row['run']}"
                name = self._named(path)
                self.spark.sql(
                    f"CREATE TABLE {name} ({RUN}) USING parquet CLUSTERED BY (h, g) SORTED BY (h, g) INTO {self.buckets} BUCKETS LOCATION '{path}'"
                )
                self.levels[row["level"]].append(self.spark.table(name))
                self.paths[row["level"]].append(path)

    def save(self) -> None:
        """Write the list of runs into the folder; from then on later calls find them."""
        if not self.folder:
            return
        rows = [(level, k, path.rsplit("/", 1)[-1], self.buckets) for level, paths in enumerate(self.paths) for k, path in enumerate(paths)]
        rows += [(level, 0, None, self.buckets) for level, paths in enumerate(self.paths) if not paths]
        self.version += 1
        frame = self.spark.createDataFrame(rows, "level int, place int, run string, buckets int")
        frame.coalesce(1).write.parquet(f"{self.folder}/state-{self.version}")

    def _named(self, path: str) -> str:
        """A table name of this session for a run; the same folder may be open twice."""
        self.tables.append(f"line_run_{uuid.uuid4().hex}")
        return self.tables[-1]

    def _store(self, rows: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.folder}/run-{uuid.uuid4().hex}" if self.folder else scratch_path(self.spark, "line-run")
        name = self._named(path)
        with ordered_scans(self.spark):
            rows.select("h", "g", "owner", "last", "earlier").write.option("path", path).bucketBy(self.buckets, "h", "g").sortBy("h", "g").saveAsTable(name)
        return self.spark.table(name), path

    def looked_up(self, firsts: DataFrame) -> DataFrame:
        """The batch's hashes with ``earlier``, the owner that a run has for them, null if unseen."""
        found = firsts.withColumn("earlier", F.lit(None).cast("long"))
        for level in self.levels:
            for run in level:
                one = run.where("earlier is null").select("h", "g", F.col("owner").alias("_owner")).hint("merge")
                found = found.join(one, ["h", "g"], "left").withColumn("earlier", F.coalesce("earlier", "_owner")).drop("_owner")
        return found

    def merged(self, runs: list[DataFrame]) -> DataFrame:
        """Runs as one: joined in their order, bucket with bucket. No hash is new in two of them."""
        new = [run.where("earlier is null").select("h", "g", "owner", "last") for run in runs]
        out = new[0]
        for other in new[1:]:
            right = other.withColumnsRenamed({"owner": "_owner", "last": "_last"}).hint("merge")
            out = out.join(right, ["h", "g"], "full_outer").select(
                "h", "g", F.coalesce("owner", "_owner").alias("owner"), F.coalesce("last", "_last").alias("last")
            )
        return out.withColumn("earlier", F.lit(None).cast("long"))

    def add(self, batch: DataFrame) -> DataFrame:
        """Look a batch up and store it as a run; what was stored. Hashes seen before are in it
        with their earlier owner, but are no part of the run. A level that is full becomes one
        run of the next."""
        if "last" not in batch.columns:
            batch = batch.withColumn("last", F.col("owner"))
        found = self.looked_up(batch.repartition(self.buckets, "h", "g"))
        stored, path = self._store(found)
        run = stored
        for level in range(len(self.levels) + 1):
            if level == len(self.levels):
                self.levels.append([])
                self.paths.append([])
            self.levels[level].append(run)
            self.paths[level].append(path)
            if len(self.levels[level]) < self.fanout:
                break
            run, path = self._store(self.merged(self.levels[level]))
            self.levels[level], self.paths[level] = [], []
        return stored


def batch_bounds(hashes: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into batches of about equal size; where exactly does not change results."""
    cuts = hashes.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def shared_lines(hashes: DataFrame, runs: Runs, batches: int = BATCHES) -> DataFrame:
    """The line hashes that at least two documents have, those of the runs included, each with
    the first of them. The hashes are added to the runs."""
    cuts, told = batch_bounds(hashes, batches), []
    for low, high in zip([None, *cuts], [*cuts, None]):
        batch = hashes
        if low is not None:
            batch = batch.where(F.col("doc_id") > low)
        if high is not None:
            batch = batch.where(F.col("doc_id") <= high)
        firsts = batch.groupBy("h", "g").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
        stored = runs.add(firsts)
        again = stored.where(F.col("earlier").isNotNull() | (F.col("last") > F.col("owner")))
        told.append(again.select("h", "g", F.coalesce("earlier", "owner").alias("owner")))
    return reduce(DataFrame.unionByName, told).distinct()


def lines_to_drop(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, folder: str | None = None) -> DataFrame:
    """doc_id and gone, the hashes of the lines that the document loses."""
    hashes = materialise(line_hashes(docs), "line-hashes")
    with Runs(docs.sparkSession, folder, fanout) as runs:
        # Stored, so that both sides of the join come straight from a shuffle, whose large partitions
        # Spark then splits.
        shared = materialise(shared_lines(hashes, runs, batches), "shared-lines")
        runs.save()
    lost = hashes.join(shared, ["h", "g"]).where("doc_id <> owner")
    return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h", "g")).alias("gone"))


def without(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    """Texts without their lost lines, with the numbers of lines before and lost."""
    import numpy as np

    rows = []
    for text, lost in zip(texts, gone):
        text = bytes(text)
        if lost is None or not len(lost):
            rows.append((text.count(b"\n") + 1, 0, text))
            continue
        dropped = {np.array([x["h"], x["g"]], "<i8").tobytes() for x in lost}
        lines, keys = text.split(b"\n"), keys_of(text)
        kept = [line for line, key in zip(lines, keys) if key not in dropped]
        rows.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
    return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, folder: str | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept, the text left over as UTF-8 bytes, of every row.

    folder: where the runs of earlier calls are, and those of this one go."""
    gone = lines_to_drop(docs, batches, fanout, folder)
    cut = F.pandas_udf(without, "n_lines long, n_dropped long, kept binary")
    joined = raw_texts(docs).join(gone, "doc_id", "left")
    return joined.select("doc_id", cut("text", "gone").alias("c")).select("doc_id", "c.*")


def drop_repeated_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, folder: str | None = None) -> DataFrame:
    """The documents with their repeated lines removed, all columns as they are but ``text`` and,
    where present, ``n_chars``. Documents that lose no line are passed on as they are."""
    of, lost, left = (free_name(docs, x) for x in ("of_doc", "lost_lines", "left_over"))
    gone = lines_to_drop(docs, batches, fanout, folder).select(F.col("doc_id").alias(of), F.col("gone").alias(lost))
    cut = F.pandas_udf(without, "n_lines long, n_dropped long, kept binary")
    joined = docs.join(gone, docs["doc_id"] == gone[of], "left")
    raw = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    joined = joined.withColumn(left, cut(raw, lost)["kept"].cast("string"))
    changed = F.col(lost).isNotNull()
    out = {"text": F.when(changed, F.col(left)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.char_length(left)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[out.get(c, F.col(c)).alias(c) for c in docs.columns])


SQL = r"""
WITH cut AS (
    SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
    SELECT doc_id, row, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM cut),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
owner AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 AND doc_id IS NOT NULL
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
    SELECT k.*, (o.owner IS NOT NULL AND k.doc_id <> o.owner) IS TRUE AS lost FROM keyed k LEFT JOIN owner o ON k.key = o.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE lost)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row"""
