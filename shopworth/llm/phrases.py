"""Phrase collocations: padded longest windows are counted once, ROLLUP sums their prefixes.

Every word starts one window of the words that follow it in its piece, padded where
the piece ends. A phrase is a prefix of exactly one window for each of its occurrences,
so the counts of all shorter phrases are sums over the windows that start with them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from shopworth.llm.common import GOLDEN, col, map_batches, mix
from shopworth.sources import pin

#: Bits of a filter, at least and at most: what is broadcast is 16 MB a filter at most.
FEWEST_BITS, MOST_BITS = 13, 27
#: Characters of the corpus for one bit of a filter, about.
LOAD = 96
#: Windows of one to so many words have filters.
FILTERS = 3
#: Characters of text that are counted together in a worker.
TOGETHER = 1 << 24
#: Distinct windows that a worker sums up, about, before it hands them on.
HELD = 1 << 19

_BREAK = b"."
_FOLD = bytes(
    ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else ord(chr(b).lower()) if b < 128 else b for b in range(256)
)
#: Filters and windows are put together in so many pieces (a power of two), each in one task.
_PIECES = 10


class _Words(dict):
    """Numbers of words, in the order they come up; 0 stands between pieces."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def numbers(self, text: str) -> np.ndarray:
        """The numbers of a text's words, with a break wherever a piece may end and at the end."""
        found = text.encode().translate(_FOLD).replace(_BREAK, b" . ").split()
        found.append(_BREAK)
        return np.fromiter(map(self.__getitem__, found), np.int32, len(found))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Words, np.ndarray]]:
    """``lang``, its words and the numbers of consecutive texts, a bounded amount of text at a time."""
    texts: dict[str, list[np.ndarray]] = {}
    words: dict[str, _Words] = {}
    size = 0

    def drain():
        for lang, parts in texts.items():
            yield lang, words[lang], np.concatenate(parts)
        texts.clear()
        words.clear()

    for batch in batches:
        for lang, text in zip(*batch.columns, strict=True):
            if not (value := text.as_py()):
                continue
            lang = lang.as_py()
            texts.setdefault(lang, []).append(words.setdefault(lang, _Words()).numbers(value))
            size += len(value)
            if size > TOGETHER:
                yield from drain()
                size = 0
    yield from drain()


def filter_bits(characters: int) -> int:
    return min(MOST_BITS, max(FEWEST_BITS, (characters // LOAD).bit_length()))


def _hashes(lang: str, words: _Words) -> np.ndarray:
    """A hash of each word in its language; 0 for the break."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([0, *(xxhash.xxh64_intdigest(w, seed) for w in list(words)[1:])], np.uint64)


def _set(table: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return (table[buckets >> 3] >> (buckets & 7).astype(np.uint8)) & 1 == 1


class _Windows:
    """Which windows of consecutive numbers may be frequent, by their length.

    A window of some words may be frequent if both windows of one word fewer in it may
    be, and if it has a set bit in the filter of its length, as far as there are filters.
    """

    def __init__(self, lang: str, words: _Words, numbers: np.ndarray, filters: list[np.ndarray], bits: int):
        self.numbers, self.bits, self.mask = numbers, bits, np.uint64((1 << bits) - 1)
        word = _hashes(lang, words)
        self.word_of, self.length = word[numbers], 1
        self.hash = mix(self.word_of)
        self.may = numbers > 0
        for i, table in enumerate(filters):
            if i:
                self.longer()
            self.sift(table)

    def longer(self) -> None:
        """Windows of one word more."""
        self.length += 1
        self.may[:-1] &= self.may[1:]
        self.may[-1:] = False
        at = np.flatnonzero(self.may)
        self.hash[at] = mix(self.hash[at] * GOLDEN + self.word_of[at + self.length - 1])

    def sift(self, table: np.ndarray) -> None:
        at = np.flatnonzero(self.may)
        self.may[at] = _set(table, self.buckets(at))

    def buckets(self, at: np.ndarray) -> np.ndarray:
        return (self.hash[at] & self.mask).astype(np.int64)

    def inside(self) -> np.ndarray:
        """Buckets of the words in the windows."""
        at = np.flatnonzero(self.may)
        words = np.unique(np.concatenate([self.numbers[at + i] for i in range(self.length)]), return_index=True)[1]
        hashes = np.concatenate([self.word_of[at + i] for i in range(self.length)])[words]
        return np.unique((mix(hashes) & self.mask).astype(np.int64))


def _bucket_counts(df: DataFrame, filters: list[np.ndarray], bits: int, least: int) -> DataFrame:
    """Counts by bucket of the windows one longer than there are filters for, and words by language.

    The rows with a ``lang`` have its words as ``total``. The others have, for a piece
    of the buckets, those in use (low and high parts of their numbers) and how often.
    With a filter of pairs, a second set of pieces has the words in pairs that may be
    frequent, each as if counted often enough.
    """
    shared = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _groups(batches):
            windows = _Windows(lang, words, numbers, shared.value, bits)
            used = windows.inside() if windows.length > 1 else np.empty(0, np.int64)
            if shared.value:
                windows.longer()
            bucket, n = np.unique(windows.buckets(np.flatnonzero(windows.may)), return_counts=True)
            bucket = np.concatenate([bucket, used + (1 << bits)])
            n = np.concatenate([n, np.full(len(used), least)])
            piece, first = np.unique(bucket >> (bits - _PIECES), return_index=True)
            bucket &= (1 << (bits - _PIECES)) - 1
            parts = ((bucket & 0xFFFF).astype(np.uint16), (bucket >> 16).astype(np.uint8), n.astype(np.uint32))
            pieces = len(piece)
            blobs = [[x.tobytes() for x in np.split(part, first[1:])][:pieces] for part in parts]
            columns = [
                pa.array([lang] + [None] * pieces, pa.string()),
                pa.array([int((numbers > 0).sum())] + [None] * pieces, pa.int64()),
                pa.array([None, *piece.tolist()], pa.int64()),
                *(pa.array([None, *blob], pa.binary()) for blob in blobs),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "total", "piece", "low", "high", "n"])

    return map_batches(df, run, "lang string, total long, piece long, low binary, high binary, n binary")


def _filter(counted: DataFrame, bits: int, least: int) -> np.ndarray:
    """A table of bits for both sets of buckets, set where one counts ``least`` or more.

    Pieces are added up one after the other in the order of a sort, so a worker holds
    one at a time; packed, they come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for piece, low, high, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if piece != now:
                    if now is not None:
                        yield packed(now, total)
                    now, total = piece, np.zeros(8 * step, np.int64)
                at = np.frombuffer(low, np.uint16).astype(np.int64) | np.frombuffer(high, np.uint8).astype(np.int64) << 16
                total[at] += np.frombuffer(n, np.uint32)
        if now is not None:
            yield packed(now, total)

    def packed(piece: int, total: np.ndarray) -> pa.RecordBatch:
        bits_of = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays([pa.array([piece]), pa.array([bits_of], pa.binary())], names=["p", "bits"])

    step, tables = 1 << (bits - 3 - _PIECES), 2
    pieces = counted.where("piece IS NOT NULL").select("piece", "low", "high", "n")
    dealt = pieces.repartition("piece").sortWithinPartitions("piece")
    table = np.zeros(tables << (bits - 3), np.uint8)
    for p, piece in map_batches(dealt, run, "p long, bits binary").toLocalIterator():
        table[p * step : (p + 1) * step] = np.frombuffer(piece, np.uint8)
    return table


def _window_blocks(df: DataFrame, filters: list[np.ndarray], used: np.ndarray, bits: int, longest: int) -> DataFrame:
    """``lang, piece, windows, n``: distinct windows by pieces of their hashes, and how often each.

    A window is padded from the first word on that no frequent phrase from its start goes on
    with, as the filters tell: counts of frequent phrases stay whole. Of windows of one word,
    only those of ``used`` words, which frequent pairs may hold, are wanted. A worker sums up
    its texts before it hands them on, up to ``HELD`` windows; a row has those of one piece,
    so rows are at most as many as workers' sums times languages times pieces.
    """
    shared = df.sparkSession.sparkContext.broadcast((filters, used))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}
        for lang, words, numbers in _groups(batches):
            filters, used = shared.value
            windows = _Windows(lang, words, numbers, filters[:1], bits)
            start, lead, single = np.flatnonzero(windows.may), [], None
            for length in range(2, longest + 1):
                windows.longer()
                if length <= len(filters):
                    windows.sift(filters[length - 1])
                alive = windows.may[start]
                if single is None:  # most windows end here, and are counted by their one word
                    single = np.bincount(numbers[start[~alive]], minlength=len(words))
                    start = start[alive]
                    lead, alive = [numbers[start].astype(np.int64)], alive[alive]
                lead.append(np.where(alive, numbers[np.minimum(start + length - 1, len(numbers) - 1)], 0))
            code = lead[0]
            for column in lead[1:]:  # windows get numbers, column by column, so that they fit 64 bits
                _, code = np.unique(code * len(words) + column, return_inverse=True)
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            bucket = (mix(_hashes(lang, words)) & windows.mask).astype(np.int64)
            alone = np.flatnonzero((single > 0) & _set(used, bucket))
            texts = np.array([b"", *list(words)[1:]], object)
            after = np.array([b"", *(b" " + w for w in list(words)[1:])], object)
            found = texts[lead[0][first]]
            for column in lead[1:]:
                found = found + after[column[first]]
            sums = held.setdefault(lang, {})
            for some, counts in ((found, n), (texts[alone], single[alone])):
                for window, count in zip(some.tolist(), counts.tolist(), strict=True):
                    sums[window] = sums.get(window, 0) + count
            if sum(map(len, held.values())) > HELD:
                yield from map(blocks, held, held.values())
                held = {}
        yield from map(blocks, held, held.values())

    def blocks(lang: str, sums: dict[bytes, int]) -> pa.RecordBatch:
        pieces: dict[int, list[bytes]] = {}
        for window in sorted(sums):
            pieces.setdefault(xxhash.xxh64_intdigest(window) & ((1 << _PIECES) - 1), []).append(window)
        columns = [
            pa.array([lang] * len(pieces), pa.string()),
            pa.array(pieces, pa.int64()),
            pa.array([b"\n".join(windows) for windows in pieces.values()], pa.binary()),  # words have no blanks
            pa.array([np.array([sums[w] for w in x], np.int64).tobytes() for x in pieces.values()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "piece", "windows", "n"])

    return map_batches(df, run, "lang string, piece long, windows binary, n binary")


def _padded_windows(blocks: DataFrame, longest: int) -> DataFrame:
    """``lang, w1, w2, ..., n``: each window of lead columns once, padded with empty words.

    Pieces are added up one after the other in the order of a sort, so a worker holds one at a time.
    """
    names = [f"w{i + 1}" for i in range(longest)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, {}
        for batch in batches:
            for lang, piece, windows, n in zip(*batch.columns, strict=True):
                if (key := (lang.as_py(), piece.as_py())) != now:
                    if sums:
                        yield rows(now[0], sums)
                    now, sums = key, {}
                counts = np.frombuffer(n.as_py(), np.int64).tolist()
                for window, count in zip(windows.as_py().split(b"\n"), counts, strict=True):
                    sums[window] = sums.get(window, 0) + count
        if sums:
            yield rows(now[0], sums)

    def rows(lang: str, sums: dict[bytes, int]) -> pa.RecordBatch:
        words = [window.decode().split(" ") for window in sums]
        lead = zip(*(w + [""] * (longest - len(w)) for w in words), strict=True)
        columns = [pa.array([lang] * len(sums), pa.string()), *(pa.array(w, pa.string()) for w in lead)]
        columns.append(pa.array(list(sums.values()), pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["lang", *names, "n"])

    schema = ", ".join(["lang string", *(f"{w} string" for w in names), "n long"])
    dealt = blocks.repartition("lang", "piece").sortWithinPartitions("lang", "piece")
    return map_batches(dealt, run, schema)


def frequent_phrases(docs: DataFrame, lang: str, text: str, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, f`` of phrases up to ``longest`` words, and ``lang, n`` of all words.

    The filters of words, pairs and triples each take a pass over the texts. They have a
    bit for some characters of the corpus up to a bound; a fuller filter lets more
    windows pass and changes no count.
    """
    known = F.coalesce(col(lang).cast("string"), F.lit("und"))
    df = docs.select(known.alias("lang"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    bits = filter_bits(df.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0])
    filters: list[np.ndarray] = []
    for length in range(min(FILTERS, longest)):
        counted = _bucket_counts(df, filters, bits, least)
        if not length:
            counted = pin(counted)
            totals = counted.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("n"))
        table, used = np.split(_filter(counted, bits, least), 2)
        filters.append(table)
    used = used if len(filters) > 2 else np.full_like(used, 255)
    windows = _padded_windows(_window_blocks(df, filters, used, bits, longest), longest)
    names = [f"w{i + 1}" for i in range(longest)]
    rolled = windows.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # The level of k words rolls up the others; a padded prefix is a shorter window, not a phrase.
    k = F.lit(longest) - F.length(F.regexp_replace(F.bin("g"), "0", ""))
    rolled = rolled.withColumn("k", k.cast("int")).where((F.col("k") >= 1) & (F.col("f") >= least))
    rolled = rolled.where(F.element_at(F.array(*names), F.col("k")) != "")
    phrase = F.array_join(F.slice(F.array(*names), F.lit(1), F.col("k")), " ")
    return rolled.select("lang", phrase.alias("phrase"), "k", "f"), totals


def mine(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 5, least: int = 100, top: int = 2000
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` collocations.

    Candidates are phrases of two to ``longest`` words that occur ``least`` times. A
    cut into two parts scores ``floor(1000 a n / (l r))``, from the counts of the phrase, all words
    and both parts; the worst cut counts, of equal ones the first. A candidate that
    occurs only within one longer candidate is dropped. Equal scores go by count, then
    by the phrase's bytes. A null language is ``und``, a null text has no words; repeated
    rows count again; other columns play no part; without candidates there are no rows.
    """
    phrases, totals = map(pin, frequent_phrases(docs, lang, text, longest, least))
    candidates = phrases.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"))
    words = F.split("phrase", " ", -1)
    inner = candidates.where("k >= 3").select(
        "lang",
        F.explode(
            F.array(
                F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " "),
                F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " "),
            )
        ).alias("phrase"),
        "a",
    )
    # Counts never rise with length, so a longer candidate with the same count shows one word longer.
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    alone = candidates.join(around, ["lang", "phrase"], "left").where("around IS NULL OR around < a")
    cut = alone.select("lang", "phrase", "k", "a", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cut = cut.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("cut")), " "))
    cut = cut.withColumn("rest", F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " "))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = {c: F.col(c).cast(DecimalType(38, 0)) for c in "anlr"}
    cut = cut.withColumns({f"_{c}": x for c, x in wide.items()})
    cut = cut.withColumn("score", F.expr("(1000 * _a * _n) div (_l * _r)"))
    worst = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = worst.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")
    ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
