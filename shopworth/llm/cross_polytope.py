"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from shopworth.llm.common import col, lists, map_batches, mix
from shopworth.llm.components import components
from shopworth.sources import pin

#: Tables, hashes that make a bucket in each, and buckets looked into besides one's own.
TABLES, HASHES, PROBES = 8, 3, 3
#: Vectors of a bucket that are compared with one another in one task at a time.
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, n = x.shape
    h = 1
    while h < n:
        y = x.reshape(rows, n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, n)
        h *= 2
    return x


class Hasher:
    """Buckets of vectors of one width."""

    def __init__(self, width: int):
        self.width = 1 << max(1, (width - 1).bit_length())
        draw = np.random.default_rng(width)
        self.signs = draw.choice((-1.0, 1.0), (TABLES, HASHES, 3, self.width))
        self.salt = np.uint64(draw.integers(1 << 62))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """For each vector and table its own bucket, then the next likely ones.

        A rotation is three rounds of random signs and a Hadamard transform. A hash
        is the closest of the axes' ends. A probe takes the second closest for one
        of the hashes; where that is nearly as close comes first.
        """
        x = np.pad(x / np.abs(x).max(axis=1, keepdims=True), ((0, 0), (0, self.width - x.shape[1])))
        found = np.empty((len(x), TABLES, 1 + PROBES), np.uint64)
        for t in range(TABLES):
            best, loss = np.empty((len(x), HASHES, 2), np.uint64), np.empty((len(x), HASHES))
            for k in range(HASHES):
                y = x
                for signs in self.signs[t, k]:
                    y = hadamard(y * signs)
                size = np.abs(y)
                top = np.argpartition(-size, 1, axis=1)[:, :2]
                values = np.take_along_axis(size, top, 1)
                swap = (values[:, 1] > values[:, 0]) | ((values[:, 1] == values[:, 0]) & (top[:, 1] < top[:, 0]))
                top[swap], values[swap] = top[swap][:, ::-1], values[swap][:, ::-1]
                best[:, k] = 2 * top + (np.take_along_axis(y, top, 1) < 0)
                loss[:, k] = values[:, 0] ** 2 - values[:, 1] ** 2
            order = np.argsort(loss, axis=1, kind="stable")
            for p in range(1 + PROBES):
                chosen = best[:, :, 0].copy()
                if p:
                    rows = np.arange(len(x))
                    chosen[rows, order[:, p - 1]] = best[rows, order[:, p - 1], 1]
                code = np.full(len(x), np.uint64(t) + self.salt, np.uint64)
                for k in range(HASHES):
                    code = mix(code * np.uint64(2 * self.width + 1) + chosen[:, k])
                found[:, t, p] = code
        return found


def _matrix(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


def _hashed(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, a row number, the label's hash, the vector's bytes, and keys for all tables."""
    schema = StructType(
        [df.schema[c] for c in keep]
        + [
            StructField("_uid", LongType(), False),
            StructField("_label", LongType(), True),
            StructField("_vector", BinaryType(), True),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, label in zip(batch.column(len(keep) + 2), batch.column(len(keep) + 1), strict=True):
                v = value.as_py() if label.is_valid else None
                good = bool(v) and None not in v
                v = np.array(v, "<f8") if good else None
                out.append(v.tobytes() if good and np.isfinite(v).all() and v.any() else None)
            columns = [batch.column(i) for i in range(len(keep) + 2)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], names=schema.names)

    return map_batches(df.select(*map(col, keep), "_uid", "_label", "_embedding"), run, schema)


def _keyed(classes: DataFrame) -> DataFrame:
    """``_class, _key, _own``: the buckets of a class, its own ones marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            data = batch.column(2).to_pylist()
            sizes = np.array([len(d) // 8 for d in data])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                for part in np.array_split(at, -(-len(at) // 2048)):
                    hasher = hashers.setdefault(size, Hasher(size))
                    keys = hasher.keys(_matrix([data[i] for i in part]))
                    keys = mix(keys + labels[part].astype(np.int64).view(np.uint64)[:, None, None]).view(np.int64)
                    flat = keys.reshape(len(part), -1)
                    owns = np.zeros((TABLES, 1 + PROBES), bool)
                    owns[:, 0] = True
                    each = np.full(len(part), flat.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[part].astype(np.int64)),
                            lists(flat.ravel(), each, pa.int64()),
                            lists(np.tile(owns.ravel(), len(part)), each, pa.bool_()),
                        ],
                        names=["_class", "keys", "owns"],
                    )

    keyed = map_batches(
        classes.select("_class", "_label", "_vector"), run, "_class long, keys array<long>, owns array<boolean>"
    )
    pairs = F.explode(F.arrays_zip("keys", "owns")).alias("p")
    return keyed.select("_class", pairs).select("_class", F.col("p.keys").alias("_key"), F.col("p.owns").alias("_own"))


def _first_meeting(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The key at which each pair meets first: in its first table, there the least key."""
    own, all_ = keys[:, :, 0], keys
    meets = np.full(len(a), np.iinfo(np.int64).max)
    open_ = np.ones(len(a), bool)
    for t in range(keys.shape[1]):
        here = np.full(len(a), np.iinfo(np.int64).max)
        for x, y in ((a, b), (b, a)):
            hit = (all_[y, t] == own[x, t][:, None]).any(axis=1)
            here = np.where(hit, np.minimum(here, own[x, t]), here)
        new = open_ & (here != np.iinfo(np.int64).max)
        meets[new] = here[new]
        open_ &= ~new
    return meets


def _compared(blocks: DataFrame, cosine: float) -> DataFrame:
    """``_class, links, root`` of each block, from rows dealt and sorted by ``_key, _i, _j``."""

    def compare(key: int, i: int, j: int, rows: list[tuple]) -> list[tuple[int, int, int]]:
        out = []
        by_size: dict[tuple, list[tuple]] = {}
        for row in rows:
            by_size.setdefault((row[2], len(row[4])), []).append(row)
        for (label, width), same in by_size.items():
            if len(same) < 2:
                continue
            own = np.array([r[1] for r in same])
            place = np.array([r[5] for r in same])
            count = np.array([r[3] for r in same], np.int64)
            x = _matrix([r[4] for r in same])
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            near = np.triu(x @ x.T >= cosine, 1) & (own[:, None] | own[None, :])
            near &= ((place[:, None] == i) & (place[None, :] == j)) | ((place[:, None] == j) & (place[None, :] == i))
            a, b = np.nonzero(near)
            if not len(a):
                continue
            hasher = hashers.setdefault(width, Hasher(width // 8))
            keys = mix(hasher.keys(_matrix([r[4] for r in same])) + np.array([label]).view(np.uint64)).view(np.int64)
            here = np.concatenate(
                [_first_meeting(keys, a[s : s + 65536], b[s : s + 65536]) == key for s in range(0, len(a), 65536)]
            )
            a, b = a[here], b[here]
            links = np.bincount(a, count[b], len(same)) + np.bincount(b, count[a], len(same))
            root = np.arange(len(same))
            while True:
                least = np.minimum(root[a], root[b])
                new = root.copy()
                np.minimum.at(new, a, least)
                np.minimum.at(new, b, least)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            for k in np.flatnonzero(links):
                out.append((same[k][0], int(links[k]), same[root[k]][0]))
        return out

    hashers: dict[int, Hasher] = {}
    names = ["_class", "links", "root"]

    def made(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        table = np.array(found, np.int64).reshape(-1, 3)
        return pa.RecordBatch.from_arrays([pa.array(table[:, k]) for k in range(3)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            found = []
            for *at, c, own, label, count, vector, place in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if at != block:
                    found += compare(*block, rows) if rows else []
                    block, rows = at, []
                rows.append((c, own, label, count, vector, place))
            yield made(found)
        yield made(compare(*block, rows) if rows else [])

    columns = ["_key", "_i", "_j", "_class", "_own", "_label", "_count", "_vector", "_place"]
    return map_batches(blocks.select(columns), run, "_class long, links long, root long")


def near_vectors(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = 0.98,
    keep: list[str] | None = None,
) -> DataFrame:
    """Vectors of equal label whose cosine is ``cosine`` or more, linked.

    A null label, or a vector that is null, empty, zero or holds a null or
    non-finite component, links with nothing; nor do vectors of unequal width.

    Equal vectors of a label are one class with a count. Each class goes to its own
    bucket in every table and looks into the next likely ones. Buckets without a
    possible pair are dropped by their counts before any vector moves. In the
    others all pairs are compared in double precision; large buckets are cut into
    blocks and all pairs of blocks compared, so that no task holds a whole bucket
    and no candidate is left out. A pair that meets in several buckets counts in
    the first alone. Blocks return a row per class, not per pair.

    Returns ``keep`` (all but the vector by default) with ``n_links``, other vectors
    linked directly; ``component_id``, the least id reachable; ``kept``, whether the
    id is that; null ids come last. Columns called like a result are dropped.
    """
    keep = [c for c in df.columns if c != vector] if keep is None else keep
    names = ["_uid", "_label", "_vector", "_id", "_embedding", "n_links", "component_id", "kept"]
    keep = [c for c in keep if c.lower() not in names]
    hashed = F.when(col(label).isNotNull(), F.xxhash64(col(label)))
    rows = df.select(
        *map(col, keep),
        col(id).alias("_id"),
        F.monotonically_increasing_id().alias("_uid"),
        hashed.alias("_label"),
        col(vector).alias("_embedding"),
    )
    table = pin(_hashed(rows, [*keep, "_id"]))
    usable = table.where(F.col("_vector").isNotNull())
    classes = usable.groupBy("_label", "_vector").agg(F.min("_uid").alias("_class"), F.count("*").alias("_count"))
    classes = pin(classes)
    keyed = pin(_keyed(classes))

    # buckets where a pair can meet: two classes at least, one of them in its own
    full = keyed.groupBy("_key").agg(F.count("*").alias("_size"), F.max("_own").alias("_any"))
    full = full.where("_size > 1 AND _any").select("_key", F.ceil(F.col("_size") / BLOCK).cast("int").alias("_blocks"))
    meeting = keyed.join(full, "_key").join(classes, "_class")
    place = F.pmod(F.xxhash64("_class"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    placed = meeting.select("*", place.alias("_place"), other.alias("_other"))
    placed = placed.select(
        "*", F.least("_place", "_other").alias("_i"), F.greatest("_place", "_other").alias("_j")
    )
    dealt = placed.repartition("_key", "_i", "_j").sortWithinPartitions("_key", "_i", "_j", "_class")
    found = pin(_compared(dealt, cosine))
    links = found.groupBy("_class").agg(F.sum("links").alias("_links"))
    roots = components(found.select(F.col("_class").alias("a"), F.col("root").alias("b"))).toDF("_class", "_root")

    known = classes.join(links, "_class", "left").join(roots, "_class", "left").select(
        F.col("_label").alias("_l"),
        F.col("_vector").alias("_v"),
        F.coalesce("_root", "_class").alias("_root"),
        (F.coalesce("_links", F.lit(0)) + F.col("_count") - 1).alias("n_links"),
    )
    same = (F.col("_label") == F.col("_l")) & (F.col("_vector") == F.col("_v"))
    of_row = table.select("_uid", "_id", "_label", "_vector").join(known, same, "left").select(
        "_uid", "_id", F.coalesce("_root", "_uid").alias("_root"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    of_row = pin(of_row)
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"))
    leads = of_row.groupBy("_root").agg(F.min(order)["id"].alias("component_id"))
    out = of_row.join(leads, "_root").select("_uid", "n_links", "component_id")
    return table.select(*map(col, keep), "_uid", "_id").join(out, "_uid").select(
        *map(col, keep),
        "n_links",
        "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
