"""Ranked lexical search: posting lists blocked by document similarity, skipped by exact bounds.

Documents lie in shards of a bounded size, in the order of a similarity code, so that
documents with like vectors are neighbours. In a shard each posting list is cut along that
order into blocks, and a block keeps the greatest value of each coordinate among its
documents. No document of a block can score more than the query's product with that
summary, so a block is passed over only if this product is under a score that as many
documents as are asked for are known to reach.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from shopworth.llm.common import col, map_arrow, map_batches, mix
from shopworth.sources import pin

#: Query terms, repeats included, that are searched for at a time; what is broadcast holds so many or one item's.
TERMS = 1 << 18
#: Documents and vector entries of a shard, at most (one document may have more entries).
SHARD, ENTRIES = 4096, 1 << 20
#: Documents of a block, at most.
BLOCK = 32
#: Rarest terms of a query whose documents are scored first, to learn a threshold.
SEEDS = 3

_TERM = bytes(
    ord(chr(b).lower()) if b >= 128 or chr(b).isalnum() else 32 for b in range(128)
) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all beyond ASCII; only A-Z are lower-cased."""
    return text.encode().translate(_TERM).split() if text else []


@dataclass
class Queries:
    """A block of items: ``vectors[q]`` has an item's term numbers and how often each occurs."""

    ids: list
    vocabulary: dict[bytes, int]
    vectors: list[tuple[np.ndarray, np.ndarray]]


def query_blocks(items: DataFrame, id: str, text: str) -> Iterator[Queries]:
    """The items in blocks of ``TERMS`` terms or of one item; those without terms are left out."""
    block, size = Queries([], {}, []), 0
    for item, value in items.select(col(id), col(text)).toLocalIterator():
        counted = Counter(terms(value))
        if not counted:
            continue
        if size and size + len(counted) > TERMS:
            yield block
            block, size = Queries([], {}, []), 0
        size += len(counted)
        numbers = [block.vocabulary.setdefault(t, len(block.vocabulary)) for t in counted]
        block.ids.append(item)
        block.vectors.append((np.array(numbers, np.int64), np.array(list(counted.values()), np.int64)))
    if block.ids:
        yield block


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, np.int32).tobytes()


def _ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int32)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    """Running sums from 0 on."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + lengths[i] - 1`` one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(first - before, lengths) + np.arange(lengths.sum())


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches."""
    total, after = _offsets(values), np.cumsum(lengths)
    return total[after] - total[after - lengths]


def counts(docs: DataFrame, vocabulary: dict[bytes, int], id: str, text: str) -> DataFrame:
    """``id, n`` (all terms of the text), and the vocabulary's terms in it with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = StructType(
        [StructField("id", docs.schema[id].dataType), StructField("n", LongType())]
        + [StructField(c, BinaryType()) for c in ("tid", "tf")]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, n, tids, tfs = shared.value, [], [], []
        for value in batch.column(1):
            found = terms(value.as_py())
            counted = Counter(found)
            held = sorted((known[t], counted[t]) for t in counted.keys() & known.keys())
            n.append(len(found))
            tids.append(_blob(np.array([t for t, _ in held])))
            tfs.append(_blob(np.array([c for _, c in held])))
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(tids, pa.binary()), pa.array(tfs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs.select(col(id), col(text)), run, schema)


def statistics(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and each vocabulary term's documents."""
    documents, occurrences = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(_ints(b"".join(batch.column(0).to_pylist())), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["t", "df"])

    df = np.zeros(size, np.int64)
    per_task = map_batches(counted.select("tid"), run, "t long, df long")
    for t, n in per_task.groupBy("t").agg(F.sum("df")).toLocalIterator():
        df[t] = n
    return documents, occurrences, df


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def saturated(tf: np.ndarray, n: int, documents: int, occurrences: int) -> np.ndarray:
    """A document's value at each term; times the term's weight it is what the term adds to a score."""
    length = 25 + 75 * n * documents // occurrences
    return 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 8 * length)


def vectors(counted: DataFrame, documents: int, occurrences: int, weight: np.ndarray) -> DataFrame:
    """``id, code, at, tid, value``: vectors, and a code whose leading bits like vectors share.

    A bit of the code tells on which side of a random plane through the origin the
    vector lies. ``at`` tells rows apart.
    """
    schema = StructType(
        [counted.schema["id"], StructField("code", LongType())] + [StructField(c, BinaryType()) for c in ("tid", "value")]
    )
    bits = np.arange(32, dtype=np.uint64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, values = [], []
        for n, tids, tfs in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            tid, value = _ints(tids), saturated(_ints(tfs), n, documents, occurrences)
            side = (mix(tid.astype(np.uint64) + np.uint64(1))[:, None] >> bits) & np.uint64(1)
            total = (weight[tid] * value).astype(np.float64) @ (side.astype(np.float64) - 0.5)
            codes.append(int((total > 0) @ (1 << np.arange(31, -1, -1))))
            values.append(_blob(value))
        columns = [batch.column(0), pa.array(codes, pa.int64()), batch.column(2), pa.array(values, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    held = counted.where(F.length("tid") > 0)
    return map_arrow(held, run, schema).withColumn("at", F.monotonically_increasing_id())


class _Rows:
    """Vectors of some documents, one after the other."""

    def __init__(self, starts: np.ndarray, tid: np.ndarray, value: np.ndarray):
        self.starts, self.tid, self.value = starts, tid, value
        self.lengths = np.diff(starts)

    @classmethod
    def of(cls, tids: list[bytes], values: list[bytes]) -> _Rows:
        starts = _offsets(np.array([len(x) // 4 for x in tids], np.int64))
        return cls(starts, _ints(b"".join(tids)), _ints(b"".join(values)))

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The terms present, where the list of each starts, and the documents in the lists."""
        order = np.argsort(self.tid, kind="stable")
        found, first = np.unique(self.tid[order], return_index=True)
        document = np.repeat(np.arange(len(self.lengths)), self.lengths)[order]
        return found, np.append(first, len(order)), document

    def entries(self, documents: np.ndarray) -> np.ndarray:
        return _ranges(self.starts[documents], self.lengths[documents])

    def scores(self, documents: np.ndarray, query: np.ndarray) -> np.ndarray:
        at = self.entries(documents)
        return _sums(query[self.tid[at]] * self.value[at], self.lengths[documents])


def _dense(vector: tuple[np.ndarray, np.ndarray], weight: np.ndarray, into: np.ndarray) -> np.ndarray:
    into[vector[0]] = weight[vector[0]] * vector[1]
    return into


def thresholds(vectors: DataFrame, queries: Queries, weight: np.ndarray, df: np.ndarray, k: int):
    """For each query a score that ``k`` documents reach (1 if unknown), and each term's greatest value.

    The documents that hold one of a query's rarest terms are scored in full. Which ones
    these are decides how many blocks can be skipped later, not what is found.
    """
    seeds = []
    for numbers, _ in queries.vectors:
        present = numbers[(df[numbers] > 0) & (weight[numbers] > 0)]
        seeds.append(present[np.argsort(df[present], kind="stable")][:SEEDS])
    shared = vectors.sparkSession.sparkContext.broadcast((queries.vectors, seeds, weight))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        asked, rarest, weight = shared.value
        rows = _Rows.of(*(batch.column(i).to_pylist() for i in (0, 1)))
        found, first, document = rows.postings()
        keys, values = [-1 - found], [np.maximum.reduceat(rows.value[np.argsort(rows.tid, kind="stable")], first[:-1])]
        query = np.zeros(len(weight), np.int64)
        for q, terms in enumerate(rarest):
            at = np.searchsorted(found, terms)
            at = at[(at < len(found)) & (found[np.minimum(at, len(found) - 1)] == terms)]
            if not len(at):
                continue
            documents = np.unique(document[_ranges(first[at], first[at + 1] - first[at])])
            best = np.sort(rows.scores(documents, _dense(asked[q], weight, query)))[-k:]
            query[asked[q][0]] = 0
            keys.append(np.full(len(best), q))
            values.append(best)
        columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (keys, values)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "value"])

    said = pin(map_arrow(vectors.select("tid", "value"), run, "key long, value long"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("value")))
    least = said.where("key >= 0").withColumn("place", place).where(F.col("place") <= k)
    most = said.where("key < 0").groupBy("key").agg(F.max("value"))
    theta, greatest = np.ones(len(queries.ids), np.int64), np.zeros(len(weight), np.int64)
    for key, value in least.where(F.col("place") == k).select("key", "value").toLocalIterator():
        theta[key] = max(1, value)
    for key, value in most.toLocalIterator():
        greatest[-1 - key] = value
    return theta, greatest


def leading(queries: Queries, weight: np.ndarray, greatest: np.ndarray, theta: np.ndarray) -> list[np.ndarray]:
    """For each query the terms of which a document must hold one to reach the threshold.

    The others together, taken from the least on, add less than the threshold at most.
    """
    needed = []
    for q, (numbers, times) in enumerate(queries.vectors):
        most = weight[numbers] * greatest[numbers] * times
        order = np.argsort(most, kind="stable")
        needed.append(np.sort(numbers[order[np.cumsum(most[order]) >= theta[q]]]))
    return needed


_LISTS = ("starts", "tid", "value", "term", "first", "members", "edges", "at", "most")


def index(vectors: DataFrame, queries: Queries, needed: list[np.ndarray], size: int) -> DataFrame:
    """One row per shard: its vectors, and the blocks of the posting lists some query needs.

    A block's summary has the greatest value of every coordinate that the queries
    needing its list can ask for.
    """
    together: dict[int, list] = {}
    for (numbers, _), terms in zip(queries.vectors, needed, strict=True):
        for t in terms.tolist():
            together.setdefault(t, []).append(numbers)
    coordinates = {t: np.unique(np.concatenate(x)) for t, x in together.items()}
    shared = vectors.sparkSession.sparkContext.broadcast(coordinates)
    schema = StructType(
        [StructField("ids", ArrayType(vectors.schema["id"].dataType)), StructField("place", BinaryType())]
        + [StructField(c, BinaryType()) for c in _LISTS]
    )

    def summaries(rows: _Rows) -> list[np.ndarray]:
        wanted, position = shared.value, np.full(size, -1, np.int64)
        found, first, document = rows.postings()
        term, sizes, members, widths, at, most = [], [], [], [], [], []
        for i, t in enumerate(found.tolist()):
            asked = wanted.get(t)
            if asked is None:
                continue
            held = document[first[i] : first[i + 1]]
            number = np.arange(len(held)) // BLOCK
            blocks = number[-1] + 1
            position[asked] = np.arange(len(asked))
            entries = rows.entries(held)
            place = position[rows.tid[entries]]
            position[asked] = -1
            cell = np.repeat(number, rows.lengths[held]) * len(asked) + place
            summary = np.zeros(blocks * len(asked), np.int32)
            np.maximum.at(summary, cell[place >= 0], rows.value[entries][place >= 0])
            filled = np.flatnonzero(summary)
            term.append(np.full(blocks, t))
            sizes.append(np.bincount(number))
            members.append(held)
            widths.append(np.bincount(filled // len(asked), minlength=blocks))
            at.append(asked[filled % len(asked)])
            most.append(summary[filled])
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (term, sizes, members, widths, at, most)]
        return [flat[0], _offsets(flat[1]), flat[2], _offsets(flat[3]), *flat[4:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = np.cumsum([len(x) // 4 for x in batch.column(1).to_pylist()])
            start = 0
            while start < batch.num_rows:
                before = after[start - 1] if start else 0
                stop = min(start + SHARD, max(start + 1, int(np.searchsorted(after, before + ENTRIES, "right"))))
                part = batch.slice(start, stop - start)
                ids = part.column(0).to_pylist()
                place = np.empty(len(ids), np.int64)
                place[sorted(range(len(ids)), key=lambda i: _order(ids[i]))] = np.arange(len(ids))
                rows = _Rows.of(*(part.column(i).to_pylist() for i in (1, 2)))
                blobs = [place, rows.starts, rows.tid, rows.value, *summaries(rows)]
                columns = [pa.array([ids], pa.list_(batch.column(0).type))]
                columns += [pa.array([_blob(x)], pa.binary()) for x in blobs]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                start = stop

    near = vectors.repartitionByRange("code", "at").sortWithinPartitions("code", "at")
    return map_batches(near.select("id", "tid", "value"), run, schema)


def _order(id):
    """Sorts ids as Spark does: null first, texts by their bytes."""
    return (id is not None, id.encode() if isinstance(id, str) else id if id is not None else 0)


def ranked(shards: DataFrame, queries: Queries, weight, theta, needed, k: int, first: int) -> DataFrame:
    """``q, item_id, doc_id, score`` of the ``k`` best documents of each shard for each query."""
    shared = shards.sparkSession.sparkContext.broadcast((queries.ids, queries.vectors, weight, theta, needed))
    item = queries.ids[0]
    kind = "string" if isinstance(item, str) else "bigint"
    schema = StructType(
        [StructField("q", IntegerType()), StructField("item_id", StructType.fromDDL(f"x {kind}")["x"].dataType)]
        + [StructField("doc_id", shards.schema["ids"].dataType.elementType), StructField("score", LongType())]
    )

    def search(ids, place, rows, term, sizes, members, edges, at, most):
        items, asked, weight, theta, needed = shared.value
        query = np.zeros(len(weight), np.int64)
        for q, vector in enumerate(asked):
            low, high = np.searchsorted(term, needed[q], "left"), np.searchsorted(term, needed[q], "right")
            blocks = _ranges(low, high - low)
            if not len(blocks):
                continue
            _dense(vector, weight, query)
            widths = edges[blocks + 1] - edges[blocks]
            entries = _ranges(edges[blocks], widths)
            bound = _sums(query[at[entries]] * most[entries], widths)
            blocks = blocks[bound >= theta[q]]
            documents = np.unique(members[_ranges(sizes[blocks], sizes[blocks + 1] - sizes[blocks])])
            score = rows.scores(documents, query)
            query[vector[0]] = 0
            reach = score >= theta[q]
            documents, score = documents[reach], score[reach]
            for i in np.lexsort((place[documents], -score))[:k].tolist():
                yield first + q, items[q], ids[documents[i]], int(score[i])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for i in range(batch.num_rows):
            ids = batch.column(0)[i].as_py()
            place, starts, tid, value, *rest = (_ints(batch.column(j)[i].as_py()) for j in range(1, batch.num_columns))
            found += search(ids, place, _Rows(starts.astype(np.int64), tid, value), *rest)
        columns = [pa.array([f[j] for f in found], t) for j, t in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    kinds = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in schema.fields]).types
    return map_arrow(shards, run, schema)


def _arrow(kind) -> pa.DataType:
    named = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return named[kind.simpleString()]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents for each row of ``items``.

    Items are taken in blocks of a bounded number of terms; texts are read once for
    each block. Ids are whole numbers or texts. Equal scores go by ascending id, a null id
    first; each row of either table counts by itself, repeated ones too. A null or empty
    text has no terms: such an item has no result, such a document is never found and
    does not count. Terms in (nearly) all documents weigh 0, and documents that score 0
    are not listed. Other columns play no part.
    """
    docs, items = _known(docs, id, text), _known(items, item_id, item_text)
    schema = f"item_id {items.schema['id'].dataType.simpleString()}, rank int, "
    schema += f"doc_id {docs.schema['id'].dataType.simpleString()}, score bigint"
    found, first = [], 0
    for queries in query_blocks(items, "id", "text"):
        counted = pin(counts(docs, queries.vocabulary, "id", "text"))
        documents, occurrences, df = statistics(counted, len(queries.vocabulary))
        if not documents:
            break
        weight = weights(documents, df)
        table = pin(vectors(counted, documents, occurrences, weight))
        theta, greatest = thresholds(table, queries, weight, df, k)
        needed = leading(queries, weight, greatest, theta)
        shards = pin(index(table, queries, needed, len(weight)))
        found.append(ranked(shards, queries, weight, theta, needed, k, first))
        first += len(queries.ids)
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("doc_id"))
    every = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return every.select("item_id", "rank", "doc_id", "score")


def _known(df: DataFrame, id: str, text: str) -> DataFrame:
    """Ids as long numbers or texts, and the text."""
    kind = "bigint" if df.schema[id].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else "string"
    return df.select(col(id).cast(kind).alias("id"), col(text).cast("string").alias("text"))
