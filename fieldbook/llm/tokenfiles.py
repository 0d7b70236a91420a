"""Flat token files: encode every text, write ids and offsets, read them back by memory map.

Documents are dealt into ranges of ascending id. Each range becomes one shard of three
files: ``.bin`` (unsigned ids, 16 or 32 bits by the vocabulary), ``.idx`` (64-bit offsets
into it, one more than documents) and ``.doc`` (64-bit document ids). A task writes under
a name of its own, and the manifest, committed by Spark, names the files that count, so a
task that ran twice leaves nothing wrong. Where a shard begins among all ids is the prefix
sum of the shards before it.

Null text: an empty document, which holds the end id only. Null id: comes first, and is
null again when read. Repeated rows: documents of their own, side by side. Empty table:
an empty manifest and no files. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import mapped, texts
from fieldbook.llm.encoding import encoder_of
from fieldbook.session import materialise, scratch_path

MANIFEST = "shard int, file string, width int, docs long, tokens long"
NO_ID = np.iinfo(np.int64).min
BATCH_BYTES = 32 << 20  # of text encoded together


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold about ``limit`` bytes of text each, or one row."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total + size > limit and i > begin:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after every document, and the new bounds."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end_id, dtype="<u4")
    inner = np.ones(len(out), bool)
    ends = bounds + np.arange(n + 1)
    inner[ends[1:] - 1] = False
    out[inner] = ids
    return out, ends


def shard_writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        files, name, encoder = {}, "", None
        docs = tokens = width = 0
        for batch in batches:
            for part in slices(batch):
                if encoder is None:
                    encoder = encoder_of(tokenizer)
                    width = 2 if max(len(encoder.edge) - 1, end_id) < 1 << 16 else 4
                    name = f"shard-{uuid.uuid4().hex}"
                    files = {x: store.open_output_stream(f"{root}/{name}.{x}") for x in ("bin", "idx", "doc")}
                    files["idx"].write(np.zeros(1, "<i8").tobytes())
                ids, bounds = with_end(*encoder.encode(pa.compute.fill_null(part.column("text"), "")), end_id)
                files["bin"].write(ids.astype(f"<u{width}").tobytes())
                files["idx"].write((bounds[1:] + tokens).astype("<i8").tobytes())
                own = pa.compute.fill_null(part.column("doc_id"), int(NO_ID))
                files["doc"].write(own.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                docs, tokens = docs + part.num_rows, tokens + len(ids)
        for f in files.values():
            f.close()
        if docs:
            row = {"shard": [TaskContext.get().partitionId()], "file": [name], "width": [width], "docs": [docs], "tokens": [tokens]}
            types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents in ascending id order below ``folder``; the manifest, one row per
    shard with ``base``, the number of ids in all shards before it."""
    ordered = texts(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    made = mapped(ordered.drop("_tie"), shard_writer(folder, tokenizer, end_id), MANIFEST)
    manifest = materialise(made, "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def shard_reader(folder: str, with_ids: bool):
    def mapped(store, path: str, kind: str, held: list) -> np.ndarray:
        import os
        import tempfile

        if store.get_file_info(path).size == 0:
            return np.zeros(0, kind)
        if store.type_name == "local":
            return np.memmap(path, dtype=kind, mode="r")
        # A file of a remote store is mapped from a copy that goes when the shard is done.
        copy = tempfile.NamedTemporaryFile()
        with store.open_input_stream(path) as source:
            while block := source.read(8 << 20):
                copy.write(block)
        copy.flush()
        os.fsync(copy.fileno())
        held.append(copy)
        return np.memmap(copy.name, dtype=kind, mode="r")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held: list = []
                path = f"{root}/{row['file']}"
                ids = mapped(store, f"{path}.bin", f"<u{row['width']}", held)
                bounds = mapped(store, f"{path}.idx", "<i8", held)
                doc = mapped(store, f"{path}.doc", "<i8", held)
                step = 4096
                for i in range(0, row["docs"], step):
                    b = np.asarray(bounds[i : i + step + 1])
                    block = np.asarray(ids[b[0] : b[-1]]).astype("<u4")
                    raw = memoryview(block.tobytes())
                    at = ((b - b[0]) * 4).tolist()
                    own = np.asarray(doc[i : i + step])
                    columns = [
                        pa.array(own, pa.int64(), mask=own == NO_ID),
                        pa.array(b[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(b), pa.int64()),
                        pa.array([zlib.crc32(raw[x:y]) for x, y in zip(at, at[1:])], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(b - b[0], pa.int32()), pa.array(block.astype("i8"))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return read


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """Every document as the files have it: its id, where it starts among all ids, its number
    of ids, their crc32 as 32-bit integers and, if asked for, the ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    shards = max(1, manifest.count())
    return mapped(manifest.repartitionByRange(shards, "shard"), shard_reader(folder, with_ids), schema)


def token_round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write all documents to a fresh folder among the shared scratch files and read them back."""
    folder = scratch_path(spark, "token-files")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    spark.range(0).write.mode("overwrite").parquet(f"{folder}/_made")  # the store makes the folder
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id), folder)
