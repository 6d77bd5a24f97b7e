"""Pack tokenized documents into fixed windows: concatenate and cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from shopworth.llm.common import col, fresh, map_batches
from shopworth.llm.tokens import word_encoder
from shopworth.sources import pin

#: Ids written to one Arrow batch at most, but for one longer document.
BATCH_IDS = 1 << 20


def encode(df: DataFrame, definition: str, end_id: int, text: str = "text") -> DataFrame:
    """All columns of ``df`` but the text, with the partition each row lies in, the
    ids of the partition's documents before it, and its own ids with ``end_id`` last.

    A null or empty text has the end id alone.
    """
    keep = [c for c in df.columns if c != text]
    schema = StructType(
        [df.schema[c] for c in keep]
        + [
            StructField("_part", IntegerType(), False),
            StructField("_before", LongType(), False),
            StructField("_ids", BinaryType(), False),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = word_encoder(definition), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = (t.as_py() for t in batch.column(len(keep)))
            ids = [(encoder.encode(t) if t else b"") + end for t in texts]
            sizes = np.array([len(x) // 4 for x in ids], np.int64)
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(df.select(*map(col, keep), col(text).alias("_text")), run, schema)


def pack(
    df: DataFrame, tokenizer_path: str, end_id: int, length: int = 4096, text: str = "text"
) -> DataFrame:
    """Every document's ids, cut at multiples of ``length`` of the concatenation.

    The order is that of the input's partitions and of the rows in them. The first
    pass encodes each document once and writes its ids with the count of ids before
    it in its partition; the second adds up the partition totals, one row per
    partition, and cuts each document where a window ends. A document that crosses
    a boundary gives one piece on either side. Nothing is shuffled but the totals.

    Returns the other columns and, for each piece, ``start`` and ``length`` in its
    document, ``doc_tokens`` of the document, ``sequence_id``, ``offset`` in the
    sequence and ``ids`` (little-endian unsigned 32-bit). All sequences but the last
    hold exactly ``length`` ids, so only the last is ever padded. Null and empty
    texts are a document of the end id alone; repeated rows are documents of their
    own; an empty table has no pieces. Columns called like a result are dropped.
    """
    results = ["start", "length", "doc_tokens", "sequence_id", "offset", "ids", "_part", "_before", "_ids"]
    keep = [c for c in df.columns if c != text and c.lower() not in results]
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    written = pin(encode(df.select(*map(col, [*keep, text])), definition, end_id, text))
    totals = written.groupBy("_part").agg(
        F.max(F.col("_before") + F.octet_length("_ids") / 4).cast("bigint").alias("_total")
    )
    # One row per input partition, 16 bytes each: a million of them for 100 TB.
    shift = F.sum("_total").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select(
        F.col("_part").alias("_base_part"), F.coalesce(shift, F.lit(0)).cast("bigint").alias("_base")
    )
    placed = written.join(F.broadcast(bases), F.col("_part") == F.col("_base_part")).select(
        *map(col, keep), (F.col("_base") + F.col("_before")).alias("_at"), "_ids"
    )
    return cut(placed, keep, length)


def cut(placed: DataFrame, keep: list[str], length: int) -> DataFrame:
    """Pieces of documents that begin at ``_at`` in the concatenation."""
    longs = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    schema = StructType(
        [placed.schema[c] for c in keep]
        + [StructField(c, LongType(), False) for c in longs]
        + [StructField("ids", BinaryType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch):
                at = rows.column(len(keep)).to_numpy()
                ids = rows.column(len(keep) + 1).to_pylist()
                size = np.array([len(x) // 4 for x in ids], np.int64)
                windows = (at + size - 1) // length - at // length + 1
                of = np.repeat(np.arange(len(ids)), windows)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
                sequence = at[of] // length + nth
                begin = np.maximum(sequence * length, at[of])
                end = np.minimum((sequence + 1) * length, at[of] + size[of])
                start = begin - at[of]
                pieces = [ids[d][4 * s : 4 * e] for d, s, e in zip(of, start, end - at[of], strict=True)]
                taken = pa.array(of)
                columns = [rows.column(i).take(taken) for i in range(len(keep))]
                columns += map(pa.array, (start, end - begin, size[of], sequence, begin - sequence * length))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(pieces, pa.binary())], names=schema.names)

    return map_batches(placed, run, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum([len(x) // 4 for x in batch.column(batch.num_columns - 1).to_pylist()])
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + BATCH_IDS, "right")))
        yield batch.slice(start, end - start)
        start = end


def sequences(pieces: DataFrame, length: int, pad_id: int) -> DataFrame:
    """Whole sequences, padded to ``length``, with one row for each ``sequence_id``.

    ``pieces`` come from :func:`pack`; a group has ``length`` ids at most.
    """
    part = fresh(pieces, "part")
    grouped = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias(part)
    )
    joined = F.aggregate(part, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    padding = np.array([pad_id], "<u4").tobytes() * length
    filled = F.concat(joined, F.lit(padding))
    return grouped.select(
        "sequence_id",
        F.substring(filled, 1, 4 * length).alias("ids"),
        (F.octet_length(joined) / 4).cast("bigint").alias("n_ids"),
    )


def with_crc32(pieces: DataFrame) -> DataFrame:
    """Adds ``ids_crc32``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids"))
