"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from shopworth.llm.common import Ragged, col, flat, map_arrow, row_hash

UNKNOWN = "und"
BUCKETS = 1 << 16
SIZES = (2, 3, 4)
DIMENSIONS = 16
#: Characters featurised at a time.
SLICE = 1 << 19
#: Subwords beyond which a text's familiarity is taken to vary no less than with so many.
_STEADY = 400
#: Subwords of one text that count for a language's frequencies at most, by their shares.
_WEIGHT = 2000
_TIMES = np.uint32(0x9E3779B1)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form of every code point, blanks for all but letters; and which are letters."""
    lower, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            lower[i], letter[i] = ord(small) if len(small) == 1 else i, True
    return lower, letter


def subwords(text: str) -> Iterator[np.ndarray]:
    """Buckets of the text's subwords, with repeats, in slices.

    Subwords are runs of two to four characters of the lower-cased text in which
    all but letters are blanks; those of blanks alone do not count.
    """
    lower, letter = _tables()
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), "<u4")
    longest = max(SIZES)
    for start in range(0, len(points), SLICE):
        part = lower[points[start : start + SLICE + longest - 1]]
        alive = letter[points[start : start + SLICE + longest - 1]]
        for n in SIZES:
            count = min(len(part) - n + 1, SLICE)
            if count < 1:
                continue
            total, any_letter = np.full(count, n, np.uint32), np.zeros(count, bool)
            for i in range(n):
                total = (total ^ part[i : i + count]) * _TIMES
                total ^= total >> np.uint32(15)
                any_letter |= alive[i : i + count]
            yield (total % np.uint32(BUCKETS))[any_letter]


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(BUCKETS, np.int64)
    for part in subwords(text):
        total += np.bincount(part, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found.astype(np.uint16), total[found].astype(np.uint32)


@dataclass
class LanguageModel:
    """``table`` is embeddings times the softmax layer, one row per subword bucket.

    ``usual`` holds a row per language: the logarithm of each bucket's frequency in it.
    ``level`` and ``spread`` are the mean of that over texts of the language and its
    deviation from subword to subword. Predictions are rejected under ``threshold`` in
    probability, or under ``least`` in familiarity.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    usual: np.ndarray
    level: np.ndarray
    spread: np.ndarray
    least: float = -np.inf

    def familiarity(self, buckets: np.ndarray, counts: np.ndarray, language: int) -> float:
        """How usual a text's subwords are in the language, in deviations from its level."""
        n = counts.sum()
        mean = float(self.usual[language, buckets].astype(float) @ counts) / n
        return (mean - self.level[language]) * np.sqrt(min(n, _STEADY)) / self.spread[language]

    def judge(self, text: str) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether the prediction is rejected."""
        total = np.zeros(BUCKETS, np.int64)
        for part in subwords(text):
            total += np.bincount(part, minlength=BUCKETS)
        buckets = np.flatnonzero(total)
        if not len(buckets) or not self.languages:
            return UNKNOWN, 0.0, True
        counts = total[buckets]
        chances = _softmax((counts @ self.table[buckets] / counts.sum() + self.bias) / self.temperature)
        best = int(chances.argmax())
        low = chances[best] < self.threshold or self.familiarity(buckets, counts, best) < self.least
        return self.languages[best], float(chances[best]), bool(low)


def _nothing_learned() -> LanguageModel:
    return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.5, np.zeros((0, BUCKETS)), np.zeros(0), np.zeros(0))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(
    labelled: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = 4000,
    epochs: int = 6,
    rejected: float = 0.003,
    sample_bytes: int = 32 << 20,
    most: int = 1000,
) -> LanguageModel:
    """Learn from at most ``sample`` of the labelled rows, counted on the executors.

    The rows with the least hash of id and text are taken, rows alike in both and in
    language once, in equal shares of the languages as far as they have rows; Spark
    cuts the shares, by rows and so that their subword counts take ``sample_bytes`` in
    all, before they come to the driver. Counts, not texts, come there. The ``most`` frequent
    languages are learned. A fifth of the sample calibrates the temperature and two bounds under
    which predictions are rejected: of probability, and of familiarity, which is how usual the
    subwords are in the predicted language. Each would lose ``rejected`` / 3 and ``rejected``
    of the right predictions at most; probability is never asked for more than one half. The texts
    of each language in turn, predicted without it, and random subwords stand for unknown
    text: where they lie apart from the right predictions, familiarity is bounded in the
    middle between both. Rows with a null label or without
    letters teach nothing; without any rows, all predictions are ``und``.
    """
    rows = labelled.where(col(lang).isNotNull() & col(text).isNotNull())
    order = row_hash(id, text)
    frequent = rows.groupBy(col(lang).cast("string").alias("lang")).count().orderBy(F.desc("count"), "lang")
    counts = {r[0]: r[1] for r in frequent.limit(min(most, sample)).collect()}
    if not counts:
        return _nothing_learned()
    share, byte_share = sample / len(counts), sample_bytes // len(counts)
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.2 * share / n))])
    taken = rows.where((F.shiftrightunsigned(order, 11) / float(1 << 53)) < rate[col(lang)])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_counted(t) for t in batch.column(2).to_pylist()]
        columns = [pa.array([f[i].tobytes() for f in found], pa.binary()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    names = ["h", "lang", "buckets", "counts"]
    schema = "h long, lang string, buckets binary, counts binary"
    taken = taken.select(order.alias("h"), col(lang).alias("lang"), col(text).alias("x")).dropDuplicates(["h", "lang"])
    counted = map_arrow(taken, count, schema).where(F.length("buckets") > 0)
    by_hash = Window.partitionBy("lang").orderBy("h")
    size = F.sum(F.length("buckets") + F.length("counts")).over(by_hash)
    counted = counted.select(*names, F.row_number().over(by_hash).alias("place"), size.alias("size"))
    fits = (F.col("place") <= int(share)) & ((F.col("size") <= byte_share) | (F.col("place") == 1))
    return _train(sorted(counts), counted.where(fits).select(*names).toArrow(), epochs, rejected)


def _train(languages: list[str], table: pa.Table, epochs: int, rejected: float) -> LanguageModel:
    draw = np.random.default_rng(7)
    number = {name: i for i, name in enumerate(languages)}
    buckets_of, starts = flat(table, "buckets", np.uint16)
    counted = Ragged(starts, buckets_of, flat(table, "counts", np.uint32)[0])
    y = np.array([number[name] for name in table.column("lang").to_pylist()], np.int64)
    by_hash = np.lexsort((y, table.column("h").to_numpy()))

    def text(i: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a text of the sample, and their shares."""
        buckets, counts = counted[i]
        return buckets, (counts / counts.sum())[:, None]

    order = by_hash[draw.permutation(len(y))]
    held = order[: len(y) // 5]
    taught = order[len(y) // 5 :]
    # One bucket's embedding moves by its share of a text, so steps are long.
    embeddings = draw.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, step = max(1, epochs * len(taught)), 0
    for _ in range(epochs):
        for i in draw.permutation(taught):
            rate = 0.5 * (1 - step / steps)
            step += 1
            buckets, share = text(i)
            mean = (embeddings[buckets] * share).sum(axis=0)
            error = _softmax(mean @ weights + bias)
            error[y[i]] -= 1
            back = weights @ error
            weights -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            embeddings[buckets] -= 20 * rate * share * back
    learned = embeddings @ weights
    model = LanguageModel(languages, learned, bias, 1.0, 0.5, *_usual(counted, y, taught, len(languages)))
    if len(held):
        logits = np.array([(learned[b] * share).sum(axis=0) + bias for b, share in map(text, held)])
        truth = y[held]

        def loss(t: float) -> float:
            return -np.log(_softmax(logits / t)[np.arange(len(held)), truth] + 1e-12).mean()

        model.temperature = float(min(np.geomspace(0.05, 5, 60), key=loss))
        scores = _softmax(logits / model.temperature)
        is_right = scores.argmax(axis=1) == truth
        right = scores.max(axis=1)[is_right]
        model.threshold = float(min(0.5, np.quantile(right, rejected / 3))) if len(right) else 0.0
        model.least = _least_familiar(model, [counted[i] for i in held], truth, logits, is_right, rejected)
    del table, buckets_of, counted
    pa.default_memory_pool().release_unused()
    return model


def _usual(counted: Ragged, y: np.ndarray, taught: np.ndarray, languages: int) -> tuple[np.ndarray, ...]:
    """Log frequencies of buckets by language, their mean and deviation."""
    usual = np.zeros((languages, BUCKETS), np.float32)
    level, spread = np.zeros(languages), np.ones(languages)
    for k in range(languages):
        total = np.zeros(BUCKETS)
        for i in taught[y[taught] == k]:
            buckets, counts = counted[i]
            n = float(counts.sum())
            total[buckets] += counts * (min(n, _WEIGHT) / n)
        share = (total + 0.1) / (total.sum() + 0.1 * BUCKETS)
        usual[k] = np.log(share)
        used = total / max(total.sum(), 1.0)
        level[k] = used @ usual[k]
        spread[k] = max(np.sqrt(used @ (usual[k] - level[k]) ** 2), 0.1)
    return usual, level, spread


def _least_familiar(
    model: LanguageModel, held: list, truth: np.ndarray, logits: np.ndarray, is_right: np.ndarray, rejected: float
) -> float:
    """The familiarity under which predictions are rejected; sets the levels by texts not learned from."""
    for k in range(len(model.languages)):
        own = [(model.usual[k, b].astype(float) @ c) / c.sum() for (b, c), t in zip(held, truth, strict=True) if t == k]
        if own:
            model.level[k] = float(np.median(own))
    known = [model.familiarity(*held[i], truth[i]) for i in np.flatnonzero(is_right)]
    if not known:
        return -np.inf
    draw = np.random.default_rng(11)
    foreign = []
    for i, (buckets, counts) in enumerate(held):
        others = logits[i].copy()
        others[truth[i]] = -np.inf
        if len(others) > 1:
            foreign.append(model.familiarity(buckets, counts, int(others.argmax())))
        noise = np.unique(draw.integers(0, BUCKETS, len(buckets)))
        foreign.append(model.familiarity(noise, np.ones(len(noise), np.int64), int(logits[i].argmax())))
    lost = float(np.quantile(known, rejected))
    return min(lost, (lost + float(np.quantile(foreign, 0.95))) / 2)


def predict(df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``lang_pred``, ``score`` and ``rejected``.

    Only the text, read whole, decides. ``und`` with score 0 stands for a null text,
    one without letters, or a model without languages; it is rejected, as is a score
    under the model's threshold and a text whose subwords are not usual in the language
    predicted, so that text of an unlearned language or noise goes. Columns called like a result are dropped.
    """
    results = ["lang_pred", "score", "rejected"]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in results]
    schema = StructType(
        [df.schema[c] for c in keep]
        + [
            StructField("lang_pred", StringType(), False),
            StructField("score", DoubleType(), False),
            StructField("rejected", BooleanType(), False),
        ]
    )
    shared = df.sparkSession.sparkContext.broadcast(model)  # buckets times languages

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        judged = [shared.value.judge(x.as_py() or "") for x in batch.column(len(keep))]
        names, best, low = map(list, zip(*judged, strict=True))
        columns = [batch.column(i) for i in range(len(keep))]
        columns += [pa.array(names, pa.string()), pa.array(best, pa.float64()), pa.array(low, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(df.select(*map(col, keep), col(text).alias("_text")), run, schema)


def held_out(id: str = "doc_id") -> Column:
    """True for the fifth of the ids that is never learned from; a null id counts as empty."""
    return F.crc32(F.coalesce(col(id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
