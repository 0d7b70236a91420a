"""Functions of the caller's own over groups, rows and columns.

A function over a group is given in a form that can be merged: begin a state, add a batch of
rows to it, merge two states, turn the last one into the result. Rows are sorted by key within
their partition, where they are, and each task makes one state for each group it meets; only
states are shuffled. So a group may hold nearly all rows: no task sees more than its own share
of them, and memory holds one state at a time, however many groups there are.

For functions that cannot be merged, ``apply_whole_groups`` hands over whole groups, after
looking whether they fit.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, FloatType, IntegerType, IntegralType, StructField, StructType
from pyspark.sql.window import Window

from fieldbook.operators import running
from fieldbook.session import scanned_bytes

#: States of more tasks than this are merged in two steps.
FAN_IN = 64
#: Rows of the largest group that a function gets as a whole.
WHOLE_ROWS = 1_000_000


@dataclass(frozen=True)
class GroupFunction:
    """A function over any number of rows, computed in parts.

    start() gives an empty state, add(state, batch) the state with an Arrow batch of rows,
    merge(a, b) that of both, finish(state) the result: one value, or a tuple of values.
    States must be picklable; parts come in no particular order, and merging with an empty
    state changes nothing.
    """

    start: Callable[[], Any]
    add: Callable[[Any, pa.RecordBatch], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any] = lambda state: state


def summed(fn: Callable[[pa.RecordBatch], Any], zero: Any = 0) -> GroupFunction:
    """A function whose results on parts add up, such as a count of rows that meet a condition."""
    return GroupFunction(lambda: zero, lambda s, batch: s + fn(batch), lambda a, b: a + b)


def _changes(columns: Sequence[pa.Array]) -> np.ndarray:
    """Places at which any of the columns differs from the row before; nulls and NaNs are equal."""
    n = len(columns[0])
    differs = np.zeros(max(n - 1, 0), bool)
    for column in columns:
        code = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        differs |= code[1:] != code[:-1]
    return np.flatnonzero(differs) + 1


def _same_row(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    both = pa.Table.from_batches([a, b]).combine_chunks()
    return not len(both.columns) or not len(_changes([c.chunk(0) for c in both.columns]))


def by_key(keys: int, start: Callable, add: Callable, out: Callable, schema: StructType):
    """mapInArrow over rows sorted by their first ``keys`` columns: one output row per key, made
    by ``out`` from the state over the key's rows. Without keys, one row per task."""
    arrow = to_arrow_schema(schema)
    results = list(arrow)[keys:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = None, None  # of the last key seen, and its row

        def rows(heads: list[pa.RecordBatch], states: list) -> pa.RecordBatch:
            made = [out(s) for s in states]
            made = [m if isinstance(m, tuple) and len(results) > 1 else (m,) for m in made]
            head = pa.Table.from_batches(heads).combine_chunks()
            columns = [c.chunk(0).cast(arrow.field(i).type) for i, c in enumerate(head.columns)] if keys else []
            columns += [pa.array([m[i] for m in made], f.type) for i, f in enumerate(results)]
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            head, body = batch.select(names[:keys]), batch.select(names[keys:])
            begin = np.concatenate([[0], _changes(head.columns)]) if keys else np.array([0])
            end = np.append(begin[1:], batch.num_rows)
            heads, states = [], []
            for k, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
                if held is not None and (k or not _same_row(held, head.slice(0, 1))):
                    heads.append(held)
                    states.append(state)
                    held = None
                if held is None:
                    held, state = head.slice(a, 1), start()
                state = add(state, body.slice(a, b - a))
            if heads:
                yield rows(heads, states)
        if held is not None:
            yield rows([held], [state])

    return run


def _key(df: DataFrame, name: str) -> Column:
    """A key column; the two zeros of a floating type are one."""
    kind = df.schema[name].dataType
    return (F.col(name) + F.lit(0.0).cast(kind)).alias(name) if isinstance(kind, DoubleType | FloatType) else F.col(name)


def _merged(states: DataFrame, keys: list[str], fn: GroupFunction, returns: StructType, steps: int) -> DataFrame:
    """One row per key from the states of all tasks, merged in one step or two."""
    key_fields = [states.schema[k] for k in keys]

    def add(state, batch):
        for raw in batch.column(0).to_pylist():
            other = pickle.loads(raw)
            state = other if state is None else fn.merge(state, other)
        return state

    if steps > 1:
        # A group of many states is merged in FAN_IN parts first.
        part = F.pmod(F.spark_partition_id(), F.lit(FAN_IN))
        dealt = states.withColumn("_part", part).repartition(*([F.col(k) for k in keys] + [F.col("_part")])).drop("_part")
        kept = StructType([*key_fields, StructField("_state", BinaryType())])
        states = (dealt.sortWithinPartitions(*keys) if keys else dealt).mapInArrow(by_key(len(keys), lambda: None, add, pickle.dumps, kept), kept)
    gathered = states.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys) if keys else states.repartition(1)
    schema = StructType([*key_fields, *returns.fields])
    return gathered.mapInArrow(by_key(len(keys), lambda: None, add, fn.finish, schema), schema)


def apply_groups(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], fn: GroupFunction, returns: str, steps: int | None = None
) -> DataFrame:
    """One row per group: its keys and what the function makes of its rows' ``columns``.

    returns: names and types of the results, such as "gap long, days long". Rows with a null or NaN
    key are left out; without keys all rows are one group, and an empty table gives no row.
    Each batch a function adds holds the given columns in their order. steps: merge states in
    one step or two; by default the size of the tables below decides.
    """
    keys = list(keys)
    rows = df.select(*[_key(df, k) for k in keys], *columns).dropna(subset=keys) if keys else df.select(*columns)
    if steps is None:
        size = scanned_bytes(df)
        steps = 2 if size is None or size > FAN_IN * running.CHUNK_BYTES else 1
    kept = StructType([*[rows.schema[k] for k in keys], StructField("_state", BinaryType())])
    ordered = rows.sortWithinPartitions(*keys) if keys else rows
    states = ordered.mapInArrow(by_key(len(keys), fn.start, fn.add, pickle.dumps, kept), kept)
    return _merged(states, keys, fn, StructType.fromDDL(returns), steps)


def apply_whole_groups(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], fn: Callable[[pd.DataFrame], Any], returns: str,
    most_rows: int = WHOLE_ROWS,
) -> DataFrame:
    """As ``apply_groups``, for a function that needs all rows of its group at once, as a pandas
    frame of the given columns.

    Groups are counted first. One of more than ``most_rows`` rows would have to fit into one
    task; it is refused with its key and size, not cut. Rows of a group come in no
    particular order.
    """
    keys, fields = list(keys), StructType.fromDDL(returns)
    rows = df.select(*keys, *columns).dropna(subset=keys)
    large = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most_rows).limit(1).collect()
    if large:
        found = large[0].asDict()
        size = found.pop("_n")
        raise ValueError(f"group {found} has {size} rows, more than {most_rows}; use a function that can be merged")
    # Rows come to a task group by group, many groups in a batch, with the row that begins each
    # group marked. Numbers that may be null go with a mark of their own, as a null elsewhere
    # in a batch must not change the type that a group's frame has.
    schema, at = StructType([*[rows.schema[k] for k in keys], *fields.fields]), range(len(columns))
    kinds = [rows.schema[c].dataType for c in columns]
    marked = [i for i in at if rows.schema[columns[i]].nullable and isinstance(kinds[i], IntegralType | BooleanType)]
    begins = Window.partitionBy(*keys).orderBy(*keys)
    sent = rows.withColumn("_first", F.row_number().over(begins) == 1).select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
        *[(F.coalesce(c, F.lit(0).cast(kinds[i])) if i in marked else F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)],
        *[F.col(columns[i]).isNull().alias(f"n{i}") for i in marked], F.col("_first").alias("first"),
    )

    def results(frame: pd.DataFrame, edges: np.ndarray) -> pd.DataFrame:
        values = frame[[f"c{i}" for i in at]].set_axis(list(columns), axis=1)
        nulls = [(i, frame[f"n{i}"].to_numpy()) for i in marked if frame[f"n{i}"].any()]
        made = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = values.iloc[a:b].reset_index(drop=True)
            for i, null in nulls:
                if null[a:b].any():
                    holed = own[columns[i]].to_numpy(float if isinstance(kinds[i], IntegralType) else object, copy=True)
                    holed[null[a:b]] = None
                    own[columns[i]] = holed
            found = fn(own)
            made.append(found if isinstance(found, tuple) and len(fields) > 1 else (found,))
        out = frame.iloc[edges[:-1]][[f"k{i}" for i in range(len(keys))]].reset_index(drop=True)
        for i, field in enumerate(fields):
            values = pd.Series([m[i] for m in made], dtype=object)
            out[f"r{i}"] = values.infer_objects() if values.notna().all() else values
        return out.set_axis(schema.names, axis=1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the group that may go on
        for frame in frames:
            edges = np.flatnonzero(frame["first"].to_numpy())
            if not len(edges):
                held.append(frame)
                continue
            if held or edges[0]:
                whole = pd.concat([*held, frame.iloc[: edges[0]]], ignore_index=True)
                yield results(whole, np.array([0, len(whole)]))
            if len(edges) > 1:
                yield results(frame, edges)
            held = [frame.iloc[edges[-1] :]]
        if held:
            whole = pd.concat(held, ignore_index=True)
            yield results(whole, np.array([0, len(whole)]))

    return sent.mapInPandas(run, schema)


def apply_columns(df: DataFrame, columns: Sequence[str], fn: GroupFunction, returns: str) -> DataFrame:
    """One row per column, ``column`` and the results of the function over all its values.

    All columns are done in one pass; a batch that a function adds holds the one column, nulls
    included. A table without rows gives the function's result for no rows.
    """
    columns, fields = list(columns), StructType.fromDDL(returns)
    kept = StructType([StructField("_at", IntegerType()), StructField("_state", BinaryType())])
    arrow = to_arrow_schema(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = [fn.start() for _ in columns]
        for batch in batches:
            states = [fn.add(s, batch.select([i])) for i, s in enumerate(states)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(columns)), pa.int32()), pa.array(map(pickle.dumps, states), pa.binary())], schema=arrow)

    size = scanned_bytes(df)
    none = df.sparkSession.createDataFrame([(i, bytearray(pickle.dumps(fn.start()))) for i in range(len(columns))], kept)
    made = _merged(df.select(*columns).mapInArrow(run, kept).union(none), ["_at"], fn, fields, 2 if size is None or size > FAN_IN * running.CHUNK_BYTES else 1)
    names = F.array(*[F.lit(c) for c in columns])
    return made.select(names[F.col("_at")].alias("column"), *fields.names)


def apply_rows(df: DataFrame, columns: Sequence[str], fn: Callable[[pd.DataFrame], Any], name: str, returns: str = "double", nulls: str = "pass") -> DataFrame:
    """Add a column: the function along each row's ``columns``.

    The function gets a pandas frame of many rows and gives one value per row. nulls: "pass"
    hands nulls on as pandas shows them; "null" gives null for rows with a null in any of the
    columns, without showing them to the function.
    """
    if nulls not in ("pass", "null"):
        raise ValueError(f"nulls is {nulls!r}, not 'pass' or 'null'")

    def along(frame: pd.DataFrame) -> pd.Series:
        whole = frame.notna().all(axis=1).to_numpy() if nulls == "null" else np.ones(len(frame), bool)
        out = pd.Series([None] * len(frame), dtype=object)
        if whole.any():
            out[whole] = list(fn(frame[whole].reset_index(drop=True)))
        return out

    return df.withColumn(name, F.pandas_udf(along, returns)(F.struct(*columns)))


def map_columns(df: DataFrame, columns: Sequence[str], fn: Callable[[pd.Series], pd.Series], returns: str | None = None) -> DataFrame:
    """Replace each of the columns by the function of its values, batch by batch; the function
    must not depend on other rows. returns: the new type, by default the column's own."""
    types = dict(df.dtypes)

    def udf(kind: str):
        def mapped(values: pd.Series) -> pd.Series:
            return fn(values)

        return F.pandas_udf(mapped, kind)

    return df.withColumns({c: udf(returns or types[c])(F.col(c)) for c in columns})
