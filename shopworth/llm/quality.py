"""Document quality from weak labels: heuristic votes, their accuracies, a hashed scorer."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from shopworth.llm.common import Ragged, col, flat, map_arrow, row_hash
from shopworth.llm.near_dup import word_hashes

BUCKETS = 1 << 14
#: The labellers, in the order of their votes.
LABELLERS = ("shouting", "symbols", "cells", "stutter", "capitals", "signs", "monotony", "prose")
_GOOD, _BAD, _NONE = 1, -1, 0
SLICE = 1 << 19
#: Words among which the distinct ones are counted.
WINDOW = 1000

# Classes of bytes: 0 blank, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 bar, 6 !, 7 other symbol, 8 beyond ASCII
_CLASS = np.full(256, 8, np.uint32)
_CLASS[:128] = 7
for _set, _number in ((b" \t\n\r\x0b\x0c", 0), (b".,;:?'\"()-", 4), (b"|", 5), (b"!", 6)):
    _CLASS[list(_set)] = _number
_CLASS[48:58] = 3
_CLASS[97:123] = 1
_CLASS[65:91] = 2


def _counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """How often each hashed feature occurs, by family: runs of byte classes, and words.

    A run is a sequence of four changes of class, so lengths of words do not matter.
    Of words there are their buckets and whether they repeat one of the last three.
    """
    shapes = np.zeros(BUCKETS)
    for start in range(0, len(data), SLICE):
        part = _CLASS[np.frombuffer(data, np.uint8, min(SLICE, len(data) - start), start)]
        runs = part[np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))]
        if len(runs) > 3:
            code = ((runs[:-3] * 9 + runs[1:-2]) * 9 + runs[2:-1]) * 9 + runs[3:]
            shapes += np.bincount(code, minlength=BUCKETS)
    words = np.zeros(BUCKETS)
    hashes = word_hashes(data.lower())
    if len(hashes):
        words += np.bincount((hashes >> np.uint64(32)) % np.uint64(BUCKETS - 8), minlength=BUCKETS)
        for lag in (1, 2, 3):
            if len(hashes) > lag:
                again = int((hashes[lag:] == hashes[:-lag]).sum())
                words[BUCKETS - 2 * lag] = again
                words[BUCKETS - 2 * lag + 1] = len(hashes) - lag - again
    return shapes, words


def _features(data: bytes) -> np.ndarray:
    """Shares within each family, so that a text's length does not matter."""
    shapes, words = _counts(data)
    return np.concatenate([x / max(1.0, x.sum()) for x in (shapes, words)])


def _monotonous(hashes: np.ndarray) -> float:
    """The share of a text's windows in which 15 of 100 words at most are distinct.

    Windows follow each other over the whole text; the last ends with it, so it may
    overlap the one before. A text shorter than a window is one.
    """
    n, size = len(hashes), min(len(hashes), WINDOW)
    windows = hashes[: n - n % size].reshape(-1, size)
    if n % size:
        windows = np.concatenate([windows, hashes[None, -size:]])
    ordered = np.sort(windows, axis=1)
    distinct = 1 + (ordered[:, 1:] != ordered[:, :-1]).sum(axis=1)
    return float((distinct / size <= 0.15).mean())


def votes(data: bytes) -> list[int]:
    """What each labeller says of a text: 1 good, -1 bad, 0 nothing.

    All but the last look for a fault and never praise; several overlap, as capitals
    do with shouting or monotony with stutter. Monotony wants half of a text's windows
    to be monotonous, wherever they lie. The last counts words of letters with
    one mark after them at most, and praises too. Texts of fewer than eight words
    give no ground to call them bad.
    """
    hashes = word_hashes(data.lower())
    n = len(hashes)
    if n < 8:
        return [_NONE] * len(LABELLERS)
    signs = _CLASS[np.frombuffer(data, np.uint8)]
    classes = np.bincount(signs, minlength=9)
    letters = max(1, classes[1] + classes[2] + classes[8])
    framed = np.concatenate([[0], signs, [0]])
    ends = np.flatnonzero((framed[1:-1] != 0) & (framed[2:] == 0)) + 1
    letter = np.isin(framed, (1, 2, 8))
    plain = letter[ends] | ((framed[ends] == 4) & letter[ends - 1])

    share = float(plain.mean())
    faults = [
        max(classes[2] / letters, classes[6] / n) >= 0.3,
        classes[7] / n >= 0.4,
        classes[5] / n >= 0.2,
        float((hashes[1:] == hashes[:-1]).mean()) >= 0.2,
        classes[2] / letters >= 0.5,
        letters / max(1, len(data) - classes[0]) <= 0.5,
        _monotonous(hashes) >= 0.5,
        share <= 0.6,
    ]
    given = [_BAD if fault else _NONE for fault in faults]
    if share >= 0.85:
        given[-1] = _GOOD
    return given


@dataclass
class LabelModel:
    """``given[j, c, v]``: chance that labeller ``j`` says ``v - 1`` of class ``c`` (0 bad, 1 good)."""

    given: np.ndarray
    prior: np.ndarray
    rounds: int

    def accuracy(self) -> np.ndarray:
        """Of each labeller's good and bad votes, the share that is right."""
        joint = self.given * self.prior[None, :, None]
        right = joint[:, 0, 0] + joint[:, 1, 2]
        return right / np.maximum(right + joint[:, 1, 0] + joint[:, 0, 2], 1e-12)

    def good(self, patterns: np.ndarray) -> np.ndarray:
        """Posterior chance of being good for each row of votes."""
        logs = np.log(self.prior)[None, :] + sum(
            np.log(self.given[j][:, patterns[:, j] + 1]).T for j in range(patterns.shape[1])
        )
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over the counted vote patterns.

    It starts from labellers that are right more often than not, with bad documents
    the fewer, and smooths by one vote, so that no chance is 0. Without documents the start stays.
    """
    j = patterns.shape[1]
    given = np.tile(np.array([[0.4, 0.4, 0.2], [0.02, 0.28, 0.7]]), (j, 1, 1))
    model, last = LabelModel(given, np.array([0.2, 0.8]), 0), None
    total = counts.sum()
    for model.rounds in range(1, rounds + 1):
        if not total:
            break
        good = model.good(patterns)
        weight = np.stack([1 - good, good]) * counts
        model.prior = (weight.sum(axis=1) + 1) / (total + 2)
        for k in range(j):
            told = np.stack([np.bincount(patterns[:, k] + 1, weight[c], 3) for c in (0, 1)]) + 1 / 3
            model.given[k] = told / told.sum(axis=1, keepdims=True)
        if last is not None and np.abs(good - last).max() < 1e-9:
            break
        last = good
    return model


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float
    threshold: float

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -50, 50))))


def _voted(batch: pa.RecordBatch) -> list[list[int]]:
    return [votes((t or "").encode()) for t in batch.column(batch.num_columns - 1).to_pylist()]


def fit(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    sample: int = 6000,
    epochs: int = 8,
    threshold: float = 0.5,
    sample_bytes: int = 32 << 20,
) -> QualityModel:
    """Estimate the labellers on all documents and teach the scorer on a sample.

    The votes of every document are counted by pattern on the executors; there are
    at most three to the number of labellers patterns. The scorer, a logistic
    regression on hashed features, learns the posterior labels of at most
    ``sample`` documents, those with the least hash of id and text, as far as their features
    take ``sample_bytes``; rows alike in both count once there. Spark cuts the sample before it
    comes to the driver.
    """
    vote_columns = [f"v{i}" for i in range(len(LABELLERS))]

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        given = np.array(_voted(batch), np.int32).reshape(-1, len(LABELLERS))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in given.T], names=vote_columns)

    said = map_arrow(df.select(col(text)), count, ", ".join(f"{v} int" for v in vote_columns))
    rows = said.groupBy(*vote_columns).count().collect()
    patterns = np.array([r[:-1] for r in rows], np.int64).reshape(-1, len(LABELLERS))
    counts = np.array([r[-1] for r in rows], np.float64)
    labels = estimate(patterns, counts)
    number = int(counts.sum())
    if not number:
        return QualityModel(labels, np.zeros(2 * BUCKETS), 0.0, threshold)

    order = row_hash(id, text)
    near = (F.shiftrightunsigned(order, 11) / float(1 << 53)) < min(1.0, 1.2 * sample / number)

    def featurise(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_features((t or "").encode()) for t in batch.column(1).to_pylist()]
        used = [np.flatnonzero(f) for f in found]
        columns = [
            pa.array([u.astype(np.uint16).tobytes() for u in used], pa.binary()),
            pa.array([f[u].astype(np.float32).tobytes() for f, u in zip(found, used, strict=True)], pa.binary()),
            pa.array([np.array(v, np.int8).tobytes() for v in _voted(batch)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["h", "at", "value", "votes"])

    taken = df.where(near).select(order.alias("h"), col(text).alias("x")).dropDuplicates(["h"])
    featured = map_arrow(taken, featurise, "h long, at binary, value binary, votes binary")
    by_hash = Window.orderBy("h")  # over few more rows than the sample
    size = F.sum(F.length("at") + F.length("value")).over(by_hash)
    first = featured.orderBy("h").limit(sample).withColumn("size", size).where(F.col("size") <= sample_bytes)
    table = first.select("h", "at", "value", "votes").toArrow()
    table = table.take(pa.array(np.argsort(table.column("h").to_numpy(), kind="stable")))
    at, starts = flat(table, "at", np.uint16)
    value, _ = flat(table, "value", np.float32)
    said_of = flat(table, "votes", np.int8)[0].astype(np.int64).reshape(-1, len(LABELLERS))
    weights, bias = _teach(Ragged(starts, at, value), labels.good(said_of), epochs)
    del table, at, value
    pa.default_memory_pool().release_unused()
    return QualityModel(labels, weights, bias, threshold)


def _teach(x: Ragged, y: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent with steps fitted to each weight (AdaGrad)."""
    draw = np.random.default_rng(11)
    weights, seen, bias = np.zeros(2 * BUCKETS), np.full(2 * BUCKETS, 1e-6), 1.0
    bad = max(1.0, (1 - y).sum())
    heavy = min(10.0, max(1.0, y.sum() / bad))  # bad documents are few
    for _ in range(epochs):
        for i in draw.permutation(len(x)):
            at, value = x[i]
            value = value.astype(np.float64)
            score = 1 / (1 + np.exp(-np.clip(value @ weights[at] + bias, -30, 30)))
            error = (score - y[i]) * (heavy if y[i] < 0.5 else 1.0)
            step = error * value + 1e-6 * weights[at]
            seen[at] += step * step
            weights[at] -= 0.5 * step / np.sqrt(seen[at])
            bias -= 0.02 * error
    return weights, bias


def score(df: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with each labeller's vote, ``label`` (the
    posterior of the votes), ``quality`` (the scorer's) and ``kept``.

    A document goes when both the scorer and the label model call it bad, so that
    neither alone loses a clean one. A null or empty text, or one of fewer than
    eight words, has no votes against it and stays. Columns called like a result
    are dropped.
    """
    results = [*LABELLERS, "label", "quality", "kept"]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in results]
    schema = StructType(
        [df.schema[c] for c in keep]
        + [StructField(c, IntegerType(), False) for c in LABELLERS]
        + [StructField(c, DoubleType(), False) for c in ("label", "quality")]
        + [StructField("kept", BooleanType(), False)]
    )
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        said = np.array(_voted(batch), np.int32).reshape(-1, len(LABELLERS))
        label = model.labels.good(said.astype(np.int64))
        texts = batch.column(len(keep)).to_pylist()
        quality = np.array([model.score(_features((t or "").encode())) for t in texts])
        kept = (np.maximum(label, quality) >= model.threshold) | ~said.any(axis=1)
        columns = [batch.column(i) for i in range(len(keep))] + [pa.array(v) for v in said.T]
        return pa.RecordBatch.from_arrays([*columns, *map(pa.array, (label, quality, kept))], names=schema.names)

    return map_arrow(df.select(*map(col, keep), col(text).alias("_text")), run, schema)
