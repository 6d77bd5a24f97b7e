"""Reversible line deduplication: exact reference counts behind sharded cuckoo filters.

A line's key is a digest of the line without outer white space, A-Z lower-cased. A table
counts the documents that hold each key. Keys held by many documents are *common*; a
cuckoo filter per shard of keys knows them, and unlike a Bloom filter forgets them again
when documents are taken out. Beside each filter stand the few uncommon keys that it takes
for common ones, so for all lines of the indexed documents the answer is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shopworth.llm.common import col, fresh, map_arrow
from shopworth.sources import pin

#: Keys of a shard, about.
SHARD = 1 << 18
#: Bytes of all filters up to which they are broadcast.
BROADCAST = 32 << 20
#: Copies of each common key in the join that takes the place of the broadcast.
SALTS = 16

_SPACE = b" \t\n\v\f\r"
_SLOTS = 4
_KICKS = 500


def line_key(line: bytes, least: int) -> bytes | None:
    """The digest of a line, or None if fewer than ``least`` code points are left of it."""
    key = line.strip(_SPACE).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return blake2b(key, digest_size=16).digest()


def _parts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard number, fingerprint (not 0) and hash of digests given as rows of two 64-bit numbers."""
    shard = keys[:, 0] & np.uint64(0xFFFFFFFF)
    fingerprint = (keys[:, 0] >> np.uint64(32)).astype(np.uint32)
    return shard.astype(np.int64), np.where(fingerprint == 0, np.uint32(1), fingerprint), keys[:, 1]


def as_numbers(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def _other(fingerprint: np.ndarray) -> np.ndarray:
    """What the two buckets of a fingerprint differ by."""
    return (fingerprint.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


class Cuckoo:
    """A cuckoo filter: each key's fingerprint lies in one of two buckets of four places."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, _SLOTS)
        self.mask = np.uint64(len(self.slots) - 1)

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A filter that holds the keys, at most three quarters full if it can be."""
        size = 1 << max(0, (len(keys) - 1) // (_SLOTS * 3 // 4)).bit_length()
        while True:
            made = cls(np.zeros(size * _SLOTS, np.uint32))
            if made.insert(keys):
                return made
            size *= 2

    def _buckets(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, fingerprint, number = _parts(keys)
        first = number & self.mask
        return fingerprint, first, (first ^ _other(fingerprint)) & self.mask

    def holds(self, keys: np.ndarray) -> np.ndarray:
        fingerprint, first, second = self._buckets(keys)
        mark = fingerprint[:, None]
        return (self.slots[first] == mark).any(axis=1) | (self.slots[second] == mark).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if there was no room; the filter must then be made anew."""
        for mark, *buckets in zip(*(x.tolist() for x in self._buckets(keys)), strict=True):
            for bucket in buckets:
                free = np.flatnonzero(self.slots[bucket] == 0)
                if len(free):
                    self.slots[bucket, free[0]] = mark
                    break
            else:
                if not self._push(mark, buckets[0]):
                    return False
        return True

    def _push(self, mark: int, bucket: int) -> bool:
        for kick in range(_KICKS):
            slot = (mark + kick) % _SLOTS
            mark, self.slots[bucket, slot] = int(self.slots[bucket, slot]), mark
            bucket = int((bucket ^ int(_other(np.array([mark]))[0])) & int(self.mask))
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return True
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Takes out one fingerprint for each key; the keys must be in the filter."""
        for mark, *buckets in zip(*(x.tolist() for x in self._buckets(keys)), strict=True):
            for bucket in buckets:
                found = np.flatnonzero(self.slots[bucket] == mark)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break


@dataclass
class LineIndex:
    """``refs``: ``key, docs``. ``filters``: ``shard, slots, doubtful`` for each of ``shards`` shards.

    A key is common if ``docs >= common``. Both tables are written ones; an index is never
    changed, :meth:`insert` and :meth:`delete` return the next.
    """

    refs: DataFrame
    filters: DataFrame
    shards: int
    common: int
    least: int

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index with these documents counted as well."""
        return self._fold(docs, text, 1)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """The index without these documents; counts that would fall below none are none."""
        return self._fold(docs, text, -1)

    def _fold(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        change = key_counts(docs, text, self.least).select("key", F.lit(0).cast("long"), F.col("n") * sign)
        both = self.refs.select("key", "docs", F.lit(0).cast("long")).union(change).toDF("key", "was", "change")
        merged = both.groupBy("key").agg(F.sum("was").alias("was"), F.sum("change").alias("change"))
        now = F.greatest(F.col("was") + F.col("change"), F.lit(0).cast("long"))
        merged = pin(merged.select("key", "was", now.alias("now")).where("was > 0 OR now > 0"))
        refs = merged.where("now > 0").select("key", F.col("now").alias("docs"))
        shards = max(1, -(-refs.count() // SHARD))
        # Shards neither overflow nor dwindle: with another number of them, filters are made anew.
        keep = self.shards / 2 <= shards <= self.shards * 2
        shards = self.shards if keep else shards
        old = self.filters if keep else self.filters.limit(0)
        return LineIndex(refs, pin(_refiltered(merged, old, shards, self.common)), shards, self.common, self.least)


def empty(docs: DataFrame, common: int = 10, least: int = 1) -> LineIndex:
    """An index of no documents; ``docs`` only gives the session."""
    spark = docs.sparkSession
    refs = spark.createDataFrame([], "key binary, docs long")
    return LineIndex(refs, spark.createDataFrame([], "shard long, slots binary, doubtful binary"), 1, common, least)


def key_counts(docs: DataFrame, text: str, least: int) -> DataFrame:
    """``key, n``: in how many documents each key is; counted in the workers before the shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted: Counter[bytes] = Counter()
        for value in batch.column(0):
            lines = set((value.as_py() or "").encode().split(b"\n"))
            counted.update({key for line in lines if (key := line_key(line, least))})
        columns = [pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "n"])

    return map_arrow(docs.select(col(text).cast("string")), run, "key binary, n long").groupBy("key").agg(
        F.sum("n").alias("n")
    )


def _refiltered(merged: DataFrame, old: DataFrame, shards: int, common: int) -> DataFrame:
    """Each shard's filter after its keys' counts went from ``was`` to ``now``."""

    def shard_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        shard, _, _ = _parts(as_numbers(batch.column(0).to_pylist()))
        return pa.RecordBatch.from_arrays([pa.array(shard % shards), *batch.columns], names=["shard", *names])

    def update(keys: pa.Table, before: pa.Table) -> pa.Table:
        digests = keys["key"].to_pylist()
        number, was, now = as_numbers(digests), keys["was"].to_numpy(), keys["now"].to_numpy()
        is_common = now >= common
        slots = before["slots"][0].as_py() if before.num_rows else None
        if slots is None:
            made = Cuckoo.of(number[is_common])
        else:
            made = Cuckoo(np.frombuffer(slots, np.uint32).copy())
            made.delete(number[(was >= common) & ~is_common])
            if not made.insert(number[(was < common) & is_common]):
                made = Cuckoo.of(number[is_common])
        doubtful = np.flatnonzero((now > 0) & ~is_common & made.holds(number))
        shard = keys["shard"][0] if keys.num_rows else before["shard"][0]
        kept = b"".join(digests[i] for i in doubtful)
        return pa.table({"shard": [shard.as_py()], "slots": [made.slots.tobytes()], "doubtful": [kept]}, schema=kind)

    names = ["key", "was", "now"]
    kind = pa.schema([("shard", pa.int64()), ("slots", pa.binary()), ("doubtful", pa.binary())])
    dealt = map_arrow(merged, shard_of, "shard long, key binary, was long, now long")
    pairs = dealt.groupBy("shard").cogroup(old.groupBy("shard"))
    return pairs.applyInArrow(update, "shard long, slots binary, doubtful binary")


class _Probe:
    """All filters side by side."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]], shards: int):
        filters = {shard: np.frombuffer(slots, np.uint32) for shard, slots, _ in rows}
        none = np.zeros(_SLOTS, np.uint32)
        parts = [filters.get(i, none) for i in range(shards)]
        self.shards = shards
        self.slots = np.concatenate(parts).reshape(-1, _SLOTS)
        sizes = np.array([len(p) // _SLOTS for p in parts], np.int64)
        self.first, self.mask = np.cumsum(sizes) - sizes, (sizes - 1).astype(np.uint64)
        self.doubtful = {d[i : i + 16] for _, _, d in rows for i in range(0, len(d), 16)}

    def common(self, keys: list[bytes]) -> list[bool]:
        number = as_numbers(keys)
        shard, fingerprint, hashed = _parts(number)
        shard %= self.shards
        mark, mask, first = fingerprint[:, None], self.mask[shard], self.first[shard]
        one = hashed & mask
        two = (one ^ _other(fingerprint)) & mask
        held = np.zeros(len(keys), bool)
        for bucket in (one, two):
            held |= (self.slots[first + bucket.astype(np.int64)] == mark).any(axis=1)
        return [h and key not in self.doubtful for h, key in zip(held.tolist(), keys, strict=True)]


def _cutter(schema: StructType, least: int, common: Callable) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Cuts lines out of the texts in the last column but one; ``common(keys, row)`` says which."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, n_lines, n_dropped = [], [], []
        for i, value in enumerate(batch.column(batch.num_columns - 2)):
            lines = (value.as_py() or "").encode().split(b"\n")
            keys = [line_key(line, least) for line in lines]
            asked = list({k for k in keys if k})
            drop = {k for k, c in zip(asked, common(asked, batch, i), strict=True) if c} if asked else set()
            left = [line for line, k in zip(lines, keys, strict=True) if k not in drop] if drop else lines
            kept.append(b"\n".join(left).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
        columns = [batch.column(i) for i in range(len(schema) - 3)]
        columns += [pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return run


def cut(docs: DataFrame, lines: LineIndex, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text by default) with ``kept, n_lines, n_dropped``.

    All lines with a common key go, the others stay in order, joined by newlines. The
    documents must be among those indexed. A null or empty text is one empty line, which
    has no key. Repeated rows count as documents of their own and stay. Columns called
    like a result are dropped.

    Filters are broadcast while they take ``BROADCAST`` bytes in all. Beyond that, texts
    are joined with the common keys among their lines; the results are the same.
    """
    results = ["kept", "n_lines", "n_dropped"]
    keep = [c for c in docs.columns if c != text and c.lower() not in results] if keep is None else keep
    schema = StructType(
        [docs.schema[c] for c in keep]
        + [StructField("kept", StringType(), False)]
        + [StructField(c, LongType(), False) for c in results[1:]]
    )
    size = lines.filters.agg(F.sum(F.length("slots") + F.length("doubtful"))).first()[0] or 0
    texts, least = col(text).cast("string"), lines.least
    if size <= BROADCAST:
        rows = [tuple(map(_plain, r)) for r in lines.filters.toLocalIterator()]
        shared = docs.sparkSession.sparkContext.broadcast(_Probe(rows, lines.shards))
        run = _cutter(schema, least, lambda keys, batch, i: shared.value.common(keys))
        return map_arrow(docs.select(*map(col, keep), texts, F.lit(0)), run, schema)

    row = fresh(docs, "row")
    numbered = pin(docs.withColumn(row, F.monotonically_increasing_id()))

    def keys_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for number, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            lines_of = set((value.as_py() or "").encode().split(b"\n"))
            found += [(number, k) for k in {line_key(line, least) for line in lines_of} if k]
        columns = [pa.array([n for n, _ in found], pa.int64()), pa.array([k for _, k in found], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["row", "key"])

    held = map_arrow(numbered.select(col(row), texts), keys_of, "row long, key binary")
    known = lines.refs.where(F.col("docs") >= lines.common).select("key")
    known = known.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    hits = held.withColumn("salt", F.col("row") % SALTS).join(known, ["key", "salt"])
    hits = hits.groupBy("row").agg(F.collect_set("key").alias("drop")).toDF("r", "drop")
    joined = numbered.join(hits, col(row) == F.col("r"), "left").select(*map(col, keep), texts, "drop")

    def listed(keys, batch, i):
        drop = set(batch.column(batch.num_columns - 1)[i].as_py() or ())
        return [k in drop for k in keys]

    return map_arrow(joined, _cutter(schema, least, listed), schema)


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value


def dedup(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, common: int = 10, least: int = 1
) -> DataFrame:
    """:func:`cut` with an index of the documents themselves."""
    return cut(docs, empty(docs, common, least).insert(docs, text), text, keep)
