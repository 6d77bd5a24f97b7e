"""Toxicity as ordered severity grades: cumulative-link regression on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from shopworth.llm.common import col, map_arrow, map_batches, row_hash
from shopworth.llm.langid import SLICE, _tables

BUCKETS = 1 << 18
GRAM = 5
#: Letters of a word's beginning that are features of their own.
BEGINNINGS = (4, 5)
#: Severity grades above none.
GRADES = 3
_TIMES = np.uint32(0x9E3779B1)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of words, their beginnings and the five-letter stretches within them, in slices.

    Letters are lower-cased; all else parts words. A slice ends where a word does.
    """
    lower, letter = _tables()
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), "<u4")
    start = 0
    while start < len(points):
        stop = min(start + SLICE, len(points))
        while stop < len(points) and letter[points[stop]]:
            stop += 1
        part = lower[points[start:stop]]
        inside = np.concatenate([[False], letter[points[start:stop]], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        mixed = (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)
        # place within the word, so that anagrams differ
        at = np.arange(len(part), dtype=np.int64)
        begun = np.zeros(len(part), np.int64)
        begun[first] = first
        place = (at - np.maximum.accumulate(begun)).astype(np.uint64)
        np.cumsum(mixed * (np.uint64(2) * place + np.uint64(3)) * (place + np.uint64(7)), out=sums[1:])
        words = sums[last] - sums[first]
        words ^= words >> np.uint64(29)
        words *= np.uint64(0xBF58476D1CE4E5B9)
        yield ((words >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)
        for size in BEGINNINGS:
            long = first[last - first >= size]
            total = np.full(len(long), size + 1000, np.uint32)
            for i in range(size):
                total = (total ^ part[long + i]) * _TIMES
                total ^= total >> np.uint32(15)
            yield (total % np.uint32(BUCKETS)).astype(np.int64)
        count = len(part) - GRAM + 1
        if count > 0:
            total, whole = np.full(count, GRAM, np.uint32), np.ones(count, bool)
            for i in range(GRAM):
                total = (total ^ part[i : i + count]) * _TIMES
                total ^= total >> np.uint32(15)
                whole &= inside[1 + i : 1 + i + count]
            yield (total[whole] % np.uint32(BUCKETS)).astype(np.int64)
        start = stop


@dataclass
class SeverityModel:
    """``place`` maps a bucket to its weight's index or -1; thresholds rise."""

    place: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def counts(self, text: str) -> np.ndarray:
        total = np.zeros(len(self.weights))
        for part in buckets(text):
            at = self.place[part]
            total += np.bincount(at[at >= 0], minlength=len(self.weights))
        return total

    def beyond(self, counts: np.ndarray) -> np.ndarray:
        """Chance of each grade or a higher one."""
        return 1 / (1 + np.exp(-np.clip(np.log1p(counts) @ self.weights - self.thresholds, -50, 50)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    sample: int = 20_000,
    z: float = 5.0,
    steps: int = 100_000,
    sample_bytes: int = 32 << 20,
) -> SeverityModel:
    """Learn from at most ``sample`` labelled documents, half of them toxic if there are so many.

    The labels taken have the least hashes of their ids; being bounded, they are
    broadcast, so no text moves to be labelled. An id may have many rows: all choose the
    features, rows alike in id and text teach the weights once, and Spark cuts each class to its share of ``sample`` and
    of ``sample_bytes`` of features, by the least hashes of id and text, before the driver gets them. Features are the buckets that more
    toxic documents hold, by ``z`` standard errors. The labels only tell toxic from
    not, so a toxic document's grade comes from how many such features it holds,
    by thirds of the toxic ones. Rows with a null id, label or text teach nothing;
    without toxic rows every severity is 0.
    """
    named = labels.where(col(toxic).isNotNull() & col(id).isNotNull())
    named = named.groupBy(col(id).alias("_of")).agg(F.max(col(toxic).cast("int")).alias("_toxic"))
    counts = {r[0]: r[1] for r in named.groupBy((F.col("_toxic") > 0).alias("t")).count().collect()}
    if not counts.get(True):
        return SeverityModel(np.full(BUCKETS, -1), np.zeros(0), np.full(GRADES, 5.0))
    want = min(counts[True], sample // 2)
    rate = F.when(F.col("_toxic") > 0, want / counts[True]).otherwise(
        min(1.0, (sample - want) / max(1, counts.get(False, 0)))
    )
    chosen = named.where(F.shiftrightunsigned(F.xxhash64(F.col("_of").cast("string")), 11) / float(1 << 53) < rate)
    texts = docs.select(col(id).alias("_doc"), col(text).alias("x")).where("x IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_of"))
    rows = rows.select((F.col("_toxic") > 0).alias("t"), "x", row_hash("_doc", "x").alias("h"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = np.zeros((2, BUCKETS + 1), np.int64), np.arange(BUCKETS + 1)
        for batch in batches:
            for t, x in zip(*batch.columns[:2], strict=True):
                seen = np.unique(np.concatenate(list(buckets(x.as_py()))))
                held[int(t.as_py()), seen] += 1
                held[int(t.as_py()), BUCKETS] += 1  # documents
        used = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(number[used]), pa.array(held[1, used]), pa.array(held[0, used])], names=["b", "bad", "fine"]
        )

    tallied = map_batches(rows, tally, "b long, bad long, fine long").groupBy("b").agg(
        F.sum("bad").alias("bad"), F.sum("fine").alias("fine")
    )
    table = tallied.toPandas()  # at most one row per bucket
    total = table[table.b == BUCKETS]
    bad, fine = (float(total[c].sum()) for c in ("bad", "fine"))
    if not bad:
        return SeverityModel(np.full(BUCKETS, -1), np.zeros(0), np.full(GRADES, 5.0))
    table = table[(table.b < BUCKETS) & (table.bad >= 3)]
    share = (table.bad + table.fine) / (bad + fine)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / bad + 1 / max(fine, 1)))
    excess = table.bad / bad - table.fine / max(fine, 1)
    used = np.sort(table.b[(excess / spread > z) & (table.bad / bad > 10 * table.fine / max(fine, 1))].to_numpy())
    place = np.full(BUCKETS, -1, np.int64)
    place[used] = np.arange(len(used))
    model = SeverityModel(place, np.zeros(len(used)), np.arange(1.0, GRADES + 1))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.counts(x.as_py()) for x in batch.column(1)]
        at = [np.flatnonzero(f) for f in found]
        columns = [
            pa.array([a.astype(np.int32).tobytes() for a in at], pa.binary()),
            pa.array([f[a].tobytes() for f, a in zip(found, at, strict=True)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["t", "h", "at", "n"])

    counted = map_arrow(rows, count, "t boolean, h long, at binary, n binary").dropDuplicates(["h", "t"])
    by_hash = Window.partitionBy("t").orderBy("h")
    size = F.sum(F.length("at") + F.length("n")).over(by_hash)
    counted = counted.select("t", "at", "n", F.row_number().over(by_hash).alias("place"), size.alias("size"))
    fits = F.col("place") <= F.when(F.col("t"), want).otherwise(sample - want)
    found = counted.where(fits & (F.col("size") <= sample_bytes // 2)).select("t", "at", "n").toArrow()
    x = sorted(zip(*(c.to_pylist() for c in found.columns), strict=True))
    return _train(model, x, steps)


def _train(model: SeverityModel, rows: list, wanted: int) -> SeverityModel:
    """Stochastic gradient descent on the cumulative-link likelihood, weights shared by all thresholds."""
    x = [(np.frombuffer(a, np.int32), np.log1p(np.frombuffer(n))) for _, a, n in rows]
    toxic = np.array([t for t, *_ in rows])
    hits = np.array([np.expm1(n).sum() for _, n in x])
    levels = np.quantile(hits[toxic], np.arange(1, GRADES) / GRADES) if toxic.any() else np.zeros(GRADES - 1)
    grade = np.where(toxic, 1 + np.searchsorted(levels, hits, "left"), 0)
    draw = np.random.default_rng(5)
    weights, first, gaps = model.weights, 2.0, np.zeros(GRADES - 1)
    epochs = min(20, max(3, -(-wanted // max(1, len(x)))))
    steps, step = max(1, epochs * len(x)), 0
    for _ in range(epochs):
        for i in draw.permutation(len(x)):
            rate = 0.3 * (1 - step / steps)
            step += 1
            at, value = x[i]
            thresholds = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
            # P(grade > k): with open ends, the chance of a grade is a difference
            over = 1 / (1 + np.exp(-np.clip(value @ weights[at] - thresholds, -30, 30)))
            ends = np.concatenate([[1.0], over, [0.0]])
            slopes = ends * (1 - ends)
            g = grade[i]
            chance = max(ends[g] - ends[g + 1], 1e-6)
            slope = np.clip((slopes[g] - slopes[g + 1]) / chance, -3, 3)
            weights[at] += rate * (slope * value - 1e-4 * weights[at])
            weights[at] = np.maximum(weights[at], 0)
            moved = np.zeros(GRADES)
            if g > 0:
                moved[g - 1] -= slopes[g] / chance
            if g < GRADES:
                moved[g] += slopes[g + 1] / chance
            moved = np.clip(moved, -3, 3)
            first += rate * moved.sum()
            tail = moved[::-1].cumsum()[::-1][1:]
            gaps = np.clip(gaps + rate * tail * np.exp(gaps), -2, 2)
    model.thresholds = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    return model


def predict(df: DataFrame, model: SeverityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``expected_severity`` (the sum of the
    chances of each grade or a higher one, 0 to the number of grades), ``severity``
    (the most likely grade) and ``toxic`` (that grade is not 0).

    The whole text counts. A null or empty text, or one without any learned
    feature, holds nothing that speaks for toxicity and has severity 0. Columns
    called like a result are dropped.
    """
    results = ["expected_severity", "severity", "toxic"]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in results]
    kinds = (DoubleType(), IntegerType(), BooleanType())
    schema = StructType(
        [df.schema[c] for c in keep] + [StructField(c, k, False) for c, k in zip(results, kinds, strict=True)]
    )
    shared = df.sparkSession.sparkContext.broadcast(model)  # one entry per bucket

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, expected, grades = shared.value, [], []
        for value in batch.column(len(keep)):
            counts = model.counts(value.as_py() or "")
            over = model.beyond(counts) if counts.any() else np.zeros(GRADES)
            expected.append(float(over.sum()))
            grades.append(int(np.argmax(-np.diff(np.concatenate([[1.0], over, [0.0]])))))
        columns = [batch.column(i) for i in range(len(keep))]
        columns += [
            pa.array(expected, pa.float64()),
            pa.array(grades, pa.int32()),
            pa.array([g > 0 for g in grades], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(df.select(*map(col, keep), col(text).alias("_text")), run, schema)
