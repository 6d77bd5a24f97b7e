"""Lempel-Ziv phrase fingerprints: compression-like likeness from least phrase hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from shopworth.llm.common import GOLDEN, col, map_arrow, map_batches, mix
from shopworth.llm.near_dup import _powers

#: Least phrase hashes in a fingerprint.
KEPT = 128


def parse(text: str, seen: set[str], start: int = 0) -> list[int]:
    """Ends of the phrases of ``text`` from ``start`` on; ``seen`` is the dictionary and grows.

    A phrase is the shortest stretch not in the dictionary yet. All beginnings of a
    phrase are in it, so the search begins at the length of the last phrase and
    moves up or down. What is left at the end and known already makes no phrase.
    """
    ends, i, n, guess = [], start, len(text), 1
    add, append = seen.add, ends.append
    while i < n:
        j = min(i + guess, n)
        if text[i:j] in seen:
            while j < n and text[i : j + 1] in seen:
                j += 1
            if j == n:
                break
            j += 1
        else:
            while j - 1 > i and text[i : j - 1] not in seen:
                j -= 1
        add(text[i:j])
        append(j)
        guess, i = j - i, j
    return ends


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """Distinct hashes of the phrases, from sums over code points."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    up, down = _powers_for(len(points) + 1)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points * up[: len(points)], out=sums[1:])
    last = np.array(ends, np.int64)
    first = np.concatenate([[0], last[:-1]]).astype(np.int64) if len(last) else last
    return np.unique(mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * GOLDEN))


_KNOWN = _powers(1 << 12)


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _KNOWN
    if len(_KNOWN[0]) < n:
        _KNOWN = _powers(2 * n)
    return _KNOWN


def signature(text: str, ends: list[int]) -> np.ndarray:
    """The ``KEPT`` least phrase hashes in order, or all where there are fewer."""
    hashes = phrase_hashes(text, ends)  # sorted
    return hashes[:KEPT]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two phrase sets from their least hashes.

    It is the share of the least hashes of the union that both sets have; exact
    for sets that fit. Two empty sets are alike, an empty one is unlike any other.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    union = both[np.concatenate([[True], ~twice])][:KEPT]
    shared = both[1:][twice]
    return float(np.searchsorted(shared, union[-1], "right") / len(union))


def as_text(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u8").tobytes()).decode()


def fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns with ``fingerprint``, the text's least phrase hashes in base64.

    Equal texts have equal fingerprints; a null or empty text has the empty one.
    """
    rest = [c for c in df.columns if c.lower() != "fingerprint"]
    schema = StructType([*(df.schema[c] for c in rest), StructField("fingerprint", StringType(), False)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = (x.as_py() or "" for x in batch.column(len(rest)))
        made = [as_text(signature(t, parse(t, set()))) for t in texts]
        columns = [batch.column(i) for i in range(len(rest))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string())], names=schema.names)

    return map_arrow(df.select(*map(col, rest), col(text).alias("_text")), run, schema)


def in_order(df: DataFrame, id: str, text: str) -> DataFrame:
    """``_id, _text, _guest``, dealt and sorted by descending id, each part with its successor.

    Bounds between the parts are quantiles of the ids, one for each shuffle
    partition. The rows with a part's greatest id are also sent to the part before
    as guests, and those of the first part to the last. Within a part the rows are
    sorted, guests last; equal ids by text, null ids after all others.
    """
    spark = df.sparkSession
    rows = df.select(
        F.coalesce(col(id).cast("long"), F.lit(-(1 << 63))).alias("_key"),
        col(id).cast("long").alias("_id"),
        F.coalesce(col(text), F.lit("")).alias("_text"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    asked = rows.agg(F.percentile_approx("_key", shares, max(10_000, 20 * parts))).first()[0]
    bounds = np.unique(np.array(asked or [], np.int64))

    def part_of(keys: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, keys, "right")

    def parted(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0)
        part = part_of(keys.to_numpy(zero_copy_only=False))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), keys], names=["part", "key"])

    # one row per part, of which there are at most as many as shuffle partitions
    tops = map_arrow(rows.select("_key"), parted, "part int, key long").groupBy("part").agg(F.max("key"))
    first = dict(sorted(tuple(r) for r in tops.collect()))
    filled = list(first)
    before = dict(zip(filled, [filled[-1], *filled[:-1]], strict=True)) if filled else {}

    def sent(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        part = part_of(keys)
        tops_here = np.array([first[p] for p in part.tolist()], np.int64)
        guests = np.flatnonzero(keys == tops_here)
        to = np.concatenate([part, [before[p] for p in part[guests].tolist()]]).astype(np.int32)
        twice = batch.take(pa.array(np.concatenate([np.arange(len(keys)), guests])))
        guest = np.arange(len(to)) >= len(keys)
        return pa.RecordBatch.from_arrays([pa.array(to), pa.array(guest), *twice.columns], names=names)

    names = ["_part", "_guest", "_key", "_id", "_text"]
    dealt = map_arrow(rows, sent, "_part int, _guest boolean, _key long, _id long, _text string")
    dealt = dealt.repartitionByRange(parts, "_part")
    ordered = dealt.sortWithinPartitions("_part", "_guest", F.desc("_key"), "_text")
    return ordered.select("_part", "_guest", "_id", "_text")


def edited_fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    In the order of descending ids, the last half (rounded down) of a text's code
    points is replaced by as many, or all, of the next document's; the last
    document is followed by the first. Returns ``id`` and ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``. A null text counts as empty; among rows of one id the order is
    that of their texts; null ids come last. A single document follows itself.

    Texts are shuffled once. The phrases of the kept half are those of the whole
    text, so only the replaced half is parsed anew.
    """
    schema = StructType(
        [
            StructField(id, LongType(), True),
            StructField("n_chars", LongType(), False),
            *(StructField(c, StringType(), False) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
            *(StructField(c, DoubleType(), False) for c in ("near_edited", "near_next")),
        ]
    )

    def edited(text: str, ends: list[int], following: str) -> tuple[str, np.ndarray]:
        half = len(text) // 2
        whole = text[: len(text) - half] + following[:half]
        kept = ends[: int(np.searchsorted(ends, len(text) - half, "right"))]
        seen = {text[a:b] for a, b in zip([0, *kept], kept, strict=False)}
        more = parse(whole, seen, kept[-1] if kept else 0)
        return whole, signature(whole, kept + more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting = None, None
        for batch in batches:
            made = []
            for p, guest, number, value in zip(*batch.columns, strict=True):
                p, guest, number, value = p.as_py(), guest.as_py(), number.as_py(), value.as_py()
                if p == part and waiting is None:
                    continue  # a further guest
                ends = parse(value, set())
                own = signature(value, ends)
                if p == part:
                    last_number, last_text, last_ends, last = waiting
                    whole, changed = edited(last_text, last_ends, value)
                    digest = hashlib.sha256(whole.encode()).hexdigest()
                    near = likeness(last, changed), likeness(last, own)
                    made.append((last_number, len(last_text), digest, as_text(last), as_text(changed), *near))
                part, waiting = p, None if guest else (number, value, ends, own)
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row, strict=True)) for row in made], schema=arrow
            )

    texts = [pa.field(c, pa.string()) for c in schema.names[2:5]]
    doubles = [pa.field(c, pa.float64()) for c in schema.names[5:]]
    arrow = pa.schema([pa.field(id, pa.int64()), pa.field("n_chars", pa.int64()), *texts, *doubles])
    return map_batches(in_order(df, id, text), run, schema)
