"""Byte-level BPE over whole texts, with offsets, and back."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from shopworth.llm.common import binary_column, col, lists, map_arrow, map_batches
from shopworth.llm.tokens import byte_bpe_json, byte_encoder, read_ranks

#: Bytes of text that are encoded at a time, about: their ids and offsets take several times that.
AT_ONCE = 4 << 20


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes in the last column, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + size, "right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop


def encode(
    df: DataFrame,
    ranks_path: str,
    text: str = "text",
    keep: list[str] | None = None,
    offsets: bool = True,
) -> DataFrame:
    """The columns ``keep`` with the ids of ``text``.

    ``ids`` holds little-endian unsigned 32-bit integers. With ``offsets``,
    ``starts`` and ``ends`` give each token's span in characters of the text: a
    byte belongs to the character it is part of, so the tokens of a character
    split between them share its span. A null or empty text has no ids. Repeated
    rows stay. Without ``keep``, all columns but the text and those called like a
    result are kept. ``ranks_path`` is read on the driver.
    """
    ranks = read_ranks(ranks_path)
    definition = byte_bpe_json(ranks)
    sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    results = ["ids", "starts", "ends"] if offsets else ["ids"]
    keep = [c for c in df.columns if c != text and c.lower() not in results] if keep is None else keep
    fields = [df.schema[c] for c in keep] + [StructField("ids", BinaryType(), False)]
    if offsets:
        fields += [StructField(c, ArrayType(IntegerType(), False), False) for c in ("starts", "ends")]
    schema = StructType(fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = byte_encoder(definition)
        texts = batch.column(batch.num_columns - 1)
        ids = [encoder.encode(t) if t else b"" for t in (x.as_py() for x in texts)]
        columns = [batch.column(i) for i in range(len(keep))] + [binary_column(ids)]
        if offsets:
            starts, ends, lengths = [], [], []
            for t, x in zip(texts, ids, strict=True):
                data = np.frombuffer((t.as_py() or "").encode(), np.uint8)
                after = np.cumsum(sizes[np.frombuffer(x, "<u4")])
                # character of each byte: how many characters have begun by then
                begun = np.cumsum((data & 0xC0) != 0x80)
                begun = begun.astype(np.int32)
                starts.append(begun[after - sizes[np.frombuffer(x, "<u4")]] - 1 if len(x) else begun)
                ends.append(begun[after - 1] if len(x) else begun)
                lengths.append(len(after))
            columns += [
                lists(np.concatenate(side), np.array(lengths), pa.int32())
                for side in (starts, ends)
            ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, AT_ONCE):
                yield run(part)

    return map_batches(df.select(*map(col, keep), col(text).alias("_text")), over, schema)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``bytes``, what the ids stand for, and ``text``, read from it as UTF-8.

    Bytes of one character may lie in several tokens; they are joined before they
    are read, and bytes that are no UTF-8 become U+FFFD. Null ids give an empty
    text; an id without a token is an error.
    """
    ranks = read_ranks(ranks_path)
    table = {rank: token for token, rank in ranks.items()}
    schema = StructType(
        [*df.schema.fields, StructField("bytes", BinaryType(), False), StructField("text", StringType(), False)]
    )
    at = df.columns.index(ids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        joined = []
        for value in batch.column(at):
            numbers = np.frombuffer(value.as_py() or b"", "<u4").tolist()
            joined.append(b"".join([table[i] for i in numbers]))
        texts = [codecs.decode(b, "utf-8", "replace") for b in joined]
        columns = [*batch.columns, binary_column(joined), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(df, run, schema)


def with_spans_hash(df: DataFrame) -> DataFrame:
    """``starts`` and ``ends`` as one number, ``spans_hash``."""
    return df.withColumn("spans_hash", F.xxhash64("starts", "ends")).drop("starts", "ends")


def digest(df: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded rows, and their ``spans_hash``."""
    return df.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast(LongType()).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        "spans_hash",
    )
