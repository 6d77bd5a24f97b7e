"""Near duplicates by word shingles: a multi-index Hamming join of MinHash signatures."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from shopworth.llm.common import GOLDEN, col, lists, map_arrow, map_batches, mix
from shopworth.llm.components import components
from shopworth.sources import pin

#: Symbols in a chunk of the signature, and bits in a symbol.
WIDTH = 6
BITS = 16
#: Further symbols of a signature, of eight bits, which make no keys: a pair that shares a key is compared over all.
CHECKED = 96
#: Chance to miss a pair whose similarity is just the threshold; more similar pairs are missed far less.
MISSED = 1e-4
#: Shingles and rows that are compared in one task at a time, about.
BLOCK = 4_000_000
ROWS = 16_384

#: Polynomial over the bytes of a word; odd, so that it has an inverse.
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SLICE = 1 << 20


def chunks_for(similarity: float) -> int:
    """Chunks needed so that a pair at the threshold has one with an error at most."""
    s = similarity
    chunk = s**WIDTH + WIDTH * (1 - s) * s ** (WIDTH - 1)
    return math.ceil(math.log(MISSED) / math.log1p(-chunk)) if chunk < 1 else 1


def distance_for(similarity: float, symbols: int) -> int:
    """Symbols in which a pair at the threshold differs at most, but for a tenth of ``MISSED``."""
    if similarity >= 1:
        return 0
    up, down = math.log(1 - similarity), math.log(similarity)
    choose = [math.lgamma(symbols + 1) - math.lgamma(k + 1) - math.lgamma(symbols - k + 1) for k in range(symbols + 1)]
    beyond = 0.0
    for k in range(symbols, 0, -1):
        beyond += math.exp(choose[k] + k * up + (symbols - k) * down)
        if beyond > MISSED / 10:
            return k
    return 0


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    if n > 1:
        up[1:], down[1:] = _BASE, _INVERSE
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_UP, _DOWN = np.ones(1, np.uint64), np.ones(1, np.uint64)


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of lower-cased ``data``, in order."""
    global _UP, _DOWN
    found, start = [], 0
    while start < len(data):
        stop = len(data)
        if stop - start > _SLICE:  # end at white space, so that no word is cut
            stop = start + _SLICE
            while stop < len(data) and not _SPACE[data[stop]]:
                stop += 1
        part = np.frombuffer(data, np.uint8, stop - start, start)
        if len(_UP) <= len(part):
            _UP, _DOWN = _powers(len(part) + 1)
        inside = np.concatenate([[False], ~_SPACE[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        found.append(mix((sums[last] - sums[first]) * _DOWN[first] + (last - first).astype(np.uint64) * GOLDEN))
        start = stop
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _words_of(data: bytes) -> bytes:
    """Lower-cased words between single blanks."""
    return b" ".join(data.lower().split())


def shingle_set(data: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of lower-cased ``data``."""
    w = word_hashes(data)
    if not len(w):
        return w
    n = len(w) - words + 1
    if n < 1:
        w, n, words = np.append(w, np.uint64(len(w))), 1, len(w) + 1
    total = np.zeros(n, np.uint64)
    for i in range(words):
        total = mix(total + w[i : i + n])
    return np.unique(total)


class Sketcher:
    """Keys under which texts with similar signatures meet."""

    def __init__(self, words: int, chunks: int):
        draw = np.random.default_rng(20240229)
        k = chunks * WIDTH + CHECKED
        self.words, self.chunks = words, chunks
        self.flip = draw.integers(0, 1 << 63, (k, 1), np.uint64)
        self.times = draw.integers(0, 1 << 63, (k, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        self.weights = draw.integers(0, 1 << 63, (chunks, WIDTH), np.uint64) * np.uint64(2) + np.uint64(1)
        self.salts = draw.integers(0, 1 << 63, (chunks, WIDTH), np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """``BITS`` bits of the least shingle under each of the permutations, first those that make keys."""
        least = None
        for i in range(0, len(shingles), 4096):
            part = (((shingles[None, i : i + 4096] ^ self.flip) * self.times)).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        return mix(least) & np.uint64((1 << BITS) - 1)

    def keys(self, signature: np.ndarray) -> np.ndarray:
        """For each chunk, its symbols with each one left out in turn.

        Two chunks with one error at most agree in at least one of these. By the
        pigeonhole principle, signatures that differ in fewer than twice as many
        symbols as there are chunks share a key.
        """
        terms = signature[: self.chunks * WIDTH].reshape(self.chunks, WIDTH) * self.weights
        return mix(terms.sum(axis=1, keepdims=True) - terms + self.salts).ravel()

    @staticmethod
    def brief(signature: np.ndarray) -> bytes:
        """Eight bits of every symbol, to compare signatures by."""
        return signature.astype(np.uint8).tobytes()


def _sketched(df: DataFrame, keep: list[str], text: str, words: int, chunks: int) -> DataFrame:
    schema = StructType(
        [df.schema[c] for c in keep]
        + [
            StructField("_uid", LongType(), False),
            StructField("_packed", BinaryType(), True),
            StructField("_sequence", BinaryType(), True),
            StructField("_n", LongType(), False),
            StructField("_keys", ArrayType(LongType(), False), False),
            StructField("_brief", BinaryType(), True),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher, packer = Sketcher(words, chunks), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed, sequences, sizes, keys, briefs = [], [], [], [], []
            for value in batch.column(len(keep) + 1):
                value = value.as_py()
                packed.append(None if value is None else packer.compress(value.encode()))
                data = _words_of((value or "").encode())
                shingles = shingle_set(data, words)
                sizes.append(len(shingles))
                sequences.append(blake2b(data, digest_size=16).digest() if data else None)
                signature = sketcher.signature(shingles) if data else None
                briefs.append(None if signature is None else sketcher.brief(signature))
                if signature is not None:
                    keys.append(sketcher.keys(signature))
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            each = np.array([chunks * WIDTH if s else 0 for s in sizes])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep) + 1)]
                + [pa.array(packed, pa.binary()), pa.array(sequences, pa.binary())]
                + [pa.array(sizes, pa.int64()), lists(flat, each, pa.int64()), pa.array(briefs, pa.binary())],
                names=schema.names,
            )

    numbered = df.select(*map(col, keep), F.monotonically_increasing_id().alias("_uid"), col(text).alias("_text"))
    return map_batches(numbered, run, schema)


class _Rows(NamedTuple):
    """Key rows in the order of their buckets: bucket, part of it, id, set size, signature."""

    bucket: np.ndarray
    own: np.ndarray
    uid: np.ndarray
    n: np.ndarray
    brief: np.ndarray

    def part(self, start: int, stop: int | None) -> _Rows:
        return _Rows(*(x[start:stop] for x in self))


def _close(rows: _Rows, at: np.ndarray | int, others: np.ndarray, percent: int, distance: int) -> np.ndarray:
    """Whether rows may be similar, by their sizes and signatures; rows of one part only in a bucket of one."""
    n, m = rows.n[at], rows.n[others]
    good = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    good &= (rows.own[at] != rows.own[others]) | (rows.bucket[others, 1] == rows.bucket[others, 2])
    return good & (np.count_nonzero(rows.brief[at] != rows.brief[others], axis=1) <= distance)


def _bucket_edges(rows: _Rows, percent: int, distance: int) -> Iterator[np.ndarray]:
    """For whole buckets, edges from each row to the first that close signatures lead to."""
    starts = np.flatnonzero(np.concatenate([[True], (rows.bucket[1:] != rows.bucket[:-1]).any(axis=1)]))
    sizes = np.diff(np.append(starts, len(rows.uid)))
    two = starts[sizes == 2]
    for i in range(0, len(two), ROWS):
        first = two[i : i + ROWS]
        first = first[_close(rows, first, first + 1, percent, distance)]
        yield np.stack([rows.uid[first + 1], rows.uid[first]], axis=1)
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        yield _walked(rows.part(start, start + size), percent, distance)


def _walked(rows: _Rows, percent: int, distance: int) -> np.ndarray:
    """Edges of one bucket: a breadth-first walk, each row compared with those not reached yet.

    Symbols lie in rows and texts in columns, so that comparing is done in long runs. Columns
    that have been reached go when they are half of all.
    """
    apart = bool(rows.bucket[0, 1] != rows.bucket[0, 2])
    at, columns = np.arange(len(rows.uid)), np.ascontiguousarray(rows.brief.T)
    count = np.uint8 if len(columns) < 256 else np.uint16
    unseen, label = np.ones(len(at), bool), np.arange(len(at))
    for first in range(len(label)):
        place = int(np.searchsorted(at, first))
        if place == len(at) or at[place] != first or not unseen[place]:
            continue
        unseen[place] = False
        queue = [first]
        while queue:
            if 2 * int(unseen.sum()) <= len(at):
                at, columns, unseen = at[unseen], np.ascontiguousarray(columns[:, unseen]), unseen[unseen]
            if not len(at):
                break
            one = queue.pop()
            low = int(np.searchsorted(at, first, "right"))  # all before have been reached
            for i in range(low, len(at), 4096):
                part = slice(i, min(i + 4096, len(at)))
                other = columns[:, part] != rows.brief[one][:, None]
                near = unseen[part] & (np.add.reduce(other.view(np.uint8), axis=0, dtype=count) <= distance)
                if not near.any():
                    continue
                found = np.flatnonzero(near) + i
                n, m = rows.n[one], rows.n[at[found]]
                good = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
                if apart:
                    good &= rows.own[at[found]] != rows.own[one]
                found = found[good]
                unseen[found], label[at[found]] = False, first
                queue.extend(at[found].tolist())
    reached = np.flatnonzero(label != np.arange(len(label)))
    return np.stack([rows.uid[reached], rows.uid[label[reached]]], axis=1)


def _compared(keyed: DataFrame, percent: int, distance: int) -> DataFrame:
    """Edges between classes of one key whose signatures are close.

    ``keyed`` has ``_key, _i, _j, _own, _uid, _n, _brief`` and is dealt and sorted by
    the first three. A bucket of similar rows costs about one pass and gives an edge per
    row; one of unlike rows gives none.
    """

    def read(batch: pa.RecordBatch) -> _Rows:
        key, i, j, own, uid, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(6))
        bucket = np.stack([key, i.astype(np.int64), j.astype(np.int64)], axis=1)
        brief = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        return _Rows(bucket, own, uid, n, brief)

    def found(rows: _Rows) -> pa.RecordBatch:
        edges = [e for e in _bucket_edges(rows, percent, distance) if len(e)]
        pairs = np.unique(np.concatenate(edges), axis=0) if edges else np.empty((0, 2), np.int64)
        return _edges(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = read(batch)
            if held is not None:
                rows = _Rows(*(np.concatenate(x) for x in zip(held, rows)))
            last = np.flatnonzero((rows.bucket != rows.bucket[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield found(rows.part(0, cut))
            held = rows.part(cut, None)
        if held is not None:
            yield found(held)

    return map_batches(keyed, run, "a long, b long")


def _dealt(df: DataFrame, by: str, blocks: Column, columns: list[str]) -> DataFrame:
    """Rows in pairs of blocks ``_i <= _j`` of the groups ``by``, and the block ``_own`` of each row.

    Each row is in as many pairs as its group has blocks, so two rows of a group meet
    in the pair of their blocks and nowhere else.
    """
    own = F.pmod(F.xxhash64(F.lit("block"), "_uid"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))
    placed = df.select(by, own.alias("_own"), other.alias("_other"), *columns)
    placed = placed.select(
        by, F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", *columns
    )
    return placed.repartition(by, "_i", "_j").sortWithinPartitions(by, "_i", "_j", "_uid")


def linked(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """For each set, the index of the first set that similar ones lead to.

    With ``side``, only sets of different sides are compared.

    A breadth-first walk: each set is compared with those not reached yet, by
    counting through the lists of the sets that hold each of its shingles. The
    lists are made anew when half of the sets in them have been reached.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    label = np.full(n, -1, np.int64)
    lists_of = None
    for first in range(n):
        if label[first] >= 0:
            continue
        label[first] = first
        queue = [first]
        while queue:
            at = queue.pop()
            open_now = int((label < 0).sum())
            if not open_now:
                break
            if lists_of is None or open_now * 2 <= lists_of[3]:
                rest = np.flatnonzero(label < 0)
                flat = np.concatenate([sets[i] for i in rest])
                owner = np.repeat(rest, sizes[rest])
                order = np.argsort(flat, kind="stable")
                lists_of = flat[order], owner[order], None, open_now
            flat, owner, _, _ = lists_of
            low = np.searchsorted(flat, sets[at], "left")
            counts = np.searchsorted(flat, sets[at], "right") - low
            ends = np.cumsum(counts)
            if not len(ends) or not ends[-1]:
                continue
            index = np.arange(ends[-1]) + np.repeat(low - (ends - counts), counts)
            shared = np.bincount(owner[index], minlength=n)
            near = (label < 0) & (100 * shared >= percent * (sizes + sizes[at] - shared)) & (shared > 0)
            if side is not None:
                near &= side != side[at]
            reached = np.flatnonzero(near)
            label[reached] = first
            queue.extend(reached.tolist())
    return label


def _verified(blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges from each text to the first one of its block that confirmed links lead to.

    ``blocks`` has ``_group, _i, _j, _own, _uid, _packed`` and is dealt and sorted by the
    first three, so that a block's rows follow one another. In a pair of two blocks only
    rows of different ones are compared.
    """

    def edges(block: list, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int]]:
        unpack = zstandard.ZstdDecompressor()
        sets = [shingle_set(_words_of(unpack.decompress(data)), words) for *_, data in rows]
        side = np.array([own for own, *_ in rows]) if block and block[1] != block[2] else None
        label = linked(sets, percent, side)
        for i in np.flatnonzero(label != np.arange(len(rows))):
            yield rows[i][1], rows[label[i]][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            found = []
            for *key, own, uid, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != block:
                    found += edges(block, rows)
                    block, rows = key, []
                rows.append((own, uid, data))
            yield _edges(found)
        yield _edges(list(edges(block, rows)))

    return map_batches(blocks, run, "a long, b long")


def _edges(found: list[tuple[int, int]] | np.ndarray) -> pa.RecordBatch:
    pairs = np.ascontiguousarray(np.array(found, np.int64).reshape(-1, 2))
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def near_duplicates(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    keep: list[str] | None = None,
) -> DataFrame:
    """Documents that share ``percent`` of their distinct ``words``-word shingles, linked.

    ASCII letters are lower-cased and words lie between ASCII white space. Fewer
    words than ``words`` are one shingle; a null or wordless text links with nothing.

    1. Texts of equal words are one class, found by a digest, and stay one node.
    2. The first symbols of a class's MinHash signature are cut into chunks, and a key
       is made of each chunk with each of its symbols left out. Every two signatures that
       differ there in fewer than twice as many symbols as there are chunks share a key.
    3. Classes that share a key are compared by size and whole signature, and only those
       within ``distance_for`` are joined, with one edge per class and not one per
       pair. A key that very many classes share is cut into blocks of about ``ROWS``.
    4. Only the texts of the groups so connected move. Links are confirmed on full
       shingle sets; large groups are cut into blocks of about ``BLOCK`` shingles and
       ``ROWS`` rows, and all pairs of blocks compared, so no task holds a whole group.

    Returns the columns ``keep`` (all but the text by default) with ``n_shingles``,
    ``component_id`` (the least id reachable; null if none has one), ``kept`` (the
    id is that) and ``first_copy``, true for just one row per component also where
    ids repeat. The text may be kept; it moves compressed. Null ids come last. Columns called like a result are dropped,
    all others stay whatever their names.
    """
    results = ["n_shingles", "component_id", "kept", "first_copy"]
    keep = [c for c in df.columns if c != text] if keep is None else keep
    order = [c for c in keep if c.lower() not in results]
    # columns travel under plain names, so that no name can clash with one used here
    named = {f"_keep{i}": c for i, c in enumerate(order) if c != text}
    chunks = chunks_for(percent / 100)
    distance = distance_for(percent / 100, chunks * WIDTH + CHECKED)
    carried = [col(c).alias(k) for k, c in named.items()]
    rows = df.select(*carried, col(text).alias("_words"), col(id).alias("_id"))
    table = pin(_sketched(rows, [*named, "_id"], "_words", words, chunks))

    # Tables of documents, classes, keys and links have no bound: the hints keep them
    # from being broadcast while they happen to be small.
    # classes of equal texts; rows without words stay alone
    firsts = table.where("_n > 0").groupBy("_sequence").agg(F.min("_uid").alias("_class"))
    of_class = table.where("_n > 0").select("_uid", "_id", "_sequence").join(firsts.hint("merge"), "_sequence")
    alone = table.where("_n = 0").select("_uid", "_id", F.col("_uid").alias("_class"))
    members = pin(of_class.select("_uid", "_id", "_class").union(alone))
    heads = members.where("_uid = _class").select("_uid")
    keyed = table.where("_n > 0").select("_uid", "_keys").join(heads.hint("merge"), "_uid", "left_semi")
    keyed = keyed.select("_uid", F.explode("_keys").alias("_key"))

    # classes that may be similar: of one key, and with signatures that are close
    shared = keyed.groupBy("_key").agg(F.count("*").alias("_rows")).where("_rows > 1")
    maybe = keyed.join(shared.hint("merge"), "_key")
    maybe = maybe.join(table.select("_uid", "_n", "_brief").hint("merge"), "_uid")
    maybe = _dealt(maybe, "_key", F.ceil(F.col("_rows") / ROWS), ["_uid", "_n", "_brief"])
    groups = components(_compared(maybe, percent, distance))

    # confirmed links
    of_group = groups.toDF("_uid", "_group").hint("merge").join(table.select("_uid", "_packed", "_n"), "_uid")
    sizes = pin(of_group.select("_group", "_uid", "_packed", "_n"))
    needed = F.ceil(F.greatest(F.sum("_n") / BLOCK, F.count("*") / ROWS))
    blocks = sizes.groupBy("_group").agg(needed.alias("_blocks"))
    dealt = _dealt(sizes.join(blocks, "_group"), "_group", F.col("_blocks"), ["_uid", "_packed"])
    roots = components(_verified(dealt, words, percent)).toDF("_class", "_root")

    # back to all rows
    rooted = members.join(roots.hint("merge"), "_class", "left").select(
        "_uid", "_id", F.coalesce("_root", "_class").alias("_root")
    )
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_uid").alias("uid"))
    leads = rooted.groupBy("_root").agg(F.min(first).alias("_lead"))
    found = rooted.join(leads.hint("merge"), "_root").select("_uid", "_lead")
    packed = ["_packed"] if text in order else []
    out = table.select(*named, *packed, "_uid", "_id", "_n").join(found.hint("merge"), "_uid").select(
        *named,
        *packed,
        F.col("_n").alias("n_shingles"),
        F.col("_lead.id").alias("component_id"),
        F.coalesce(F.col("_id") == F.col("_lead.id"), F.lit(False)).alias("kept"),
        (F.col("_uid") == F.col("_lead.uid")).alias("first_copy"),
    )
    out = _unpacked(out, "_words") if packed else out
    inner = {c: k for k, c in named.items()} | {text: "_words"}
    return out.select(*(F.col(inner[c]).alias(c) for c in order), *results)


def _unpacked(df: DataFrame, text: str) -> DataFrame:
    """The text in the place of its compressed form."""
    at = df.columns.index("_packed")
    fields = [StructField(text, StringType(), True) if f.name == "_packed" else f for f in df.schema.fields]
    schema = StructType(fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        unpack = zstandard.ZstdDecompressor()
        texts = [None if x is None else unpack.decompress(x).decode() for x in batch.column(at).to_pylist()]
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(df, run, schema)
