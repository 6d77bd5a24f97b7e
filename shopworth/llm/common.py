"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopworth.sources import read_table

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return read_table(spark, f"{folder}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it while the table already has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` that reads columns by position, so that their names may hold dots."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(function, schema)


def row_hash(*names: str) -> Column:
    """A hash of the columns together, as texts; a null is told from an empty text."""
    parts = [x for n in names for x in (col(n).isNull(), F.coalesce(col(n).cast("string"), F.lit("")))]
    return F.xxhash64(*parts)


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType | str
) -> DataFrame:
    """``function`` over every Arrow batch."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return map_batches(df, over, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def binary_column(buffers: list[bytes]) -> pa.Array:
    return pa.array(buffers, pa.binary())


def flat(table: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's bytes as one array, without a copy, and where each row begins in it."""
    column = table.column(name).cast(pa.binary()).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    size = np.dtype(kind).itemsize
    return values[ends[0] : ends[-1]].view(kind), (ends - ends[0]) // size


class Ragged:
    """Rows of unequal length over flat arrays; a row is the tuple of its slices."""

    def __init__(self, starts: np.ndarray, *flats: np.ndarray):
        self.starts, self.flats = starts, flats

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __getitem__(self, i: int) -> tuple[np.ndarray, ...]:
        part = slice(self.starts[i], self.starts[i + 1])
        return tuple(x[part] for x in self.flats)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of ``lengths`` over the flat ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
