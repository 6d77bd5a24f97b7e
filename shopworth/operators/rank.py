"""Exact ranks, n-tiles and quantiles without sorting a whole table in one task.

An n-tile over all customers only depends on the few rows that end each tile.
Those rows are found by counting: a sketch of a sample suggests a bracket around
each wanted rank, one pass over all rows counts those below, at, between and above
its two ends, and only the rows of the part that holds the rank are looked at again,
until few are left to group and order. Every other row is compared with the
boundaries where it already lies, so assigning tiles shuffles nothing. The counts
decide, so the result is exact whatever the sketch says, and a value that most rows
share is a part of its own that never hides its neighbours.

``df`` is read several times; :func:`shopworth.sources.pin` a costly one first.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType

# Brackets holding more rows than this are narrowed before their rows are ordered.
BRACKET_ROWS = 500_000
# Sampled rows per sketch; enough for the accuracy below, however many rows there are.
SKETCH_ROWS = 2_000_000
SKETCH_ACCURACY = 1_000
SEED = 20
# Bytes of a text that are compared at a time; with their count they fit a double.
_LEVEL = 6


class Tile(NamedTuple):
    """One n-tile column: ``k`` tiles over ``value``; NULL values get no tile."""

    value: str
    k: int
    desc: bool = False


class Found(NamedTuple):
    """The key at a rank, how many rows share it, and the rank among those."""

    key: float
    position: int
    ties: int


@dataclass
class _Bracket:
    """Rows of one key column between ``low`` and ``high``, both left out, and the ranks wanted there.

    Without an end the bracket is open on that side. ``single`` brackets hold the rows
    whose key is ``low``. ``below`` counts the rows before the bracket.
    """

    owner: int
    key: Column
    ranks: list[int]
    rows: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    single: bool = False
    missed: bool = False
    stuck: bool = False

    def suggestions(self, ends: list[float]) -> Column:
        """Keys near these shares of the rows; the least and greatest key where sketches did not help.

        Sketches work in doubles, so whole numbers and decimals count from the bracket's low end.
        """
        inside = self.inside()
        if self.stuck:
            return F.array(F.min(F.when(inside, self.key)), F.max(F.when(inside, self.key)))
        key = F.try_subtract(self.key, F.lit(self.low)) if self.shifted() else self.key
        return F.percentile_approx(F.when(inside, key), ends, SKETCH_ACCURACY)

    def shifted(self) -> bool:
        return isinstance(self.low, (int, Decimal)) and not self.stuck

    def inside(self) -> Column:
        if self.single:
            return self.key == F.lit(self.low)
        found = self.key.isNotNull()
        if self.low is not None:
            found = found & (self.key > F.lit(self.low))
        if self.high is not None:
            found = found & (self.key < F.lit(self.high))
        return found


def _narrowed(df: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """One bracket per rank, cut down to the neighbourhood of that rank.

    The first suggestions come from a sample. Where it misled they come from all rows:
    such a sketch errs by less than its margin, so the part between its ends, which are
    parts of their own, holds under a hundredth of the bracket.
    """
    margin = 2 / SKETCH_ACCURACY
    sketches = []
    for i, b in enumerate(brackets):
        shares = [(rank - b.below) / b.rows for rank in b.ranks]
        ends = [end for s in shares for end in (max(s - margin, 0.0), min(s + margin, 1.0))]
        sketches.append(b.suggestions(ends).alias(f"s{i}"))
    fraction = SKETCH_ROWS / min(b.rows for b in brackets)
    whole = fraction >= 1 or any(b.missed or b.stuck for b in brackets)
    sampled = df if whole else df.sample(fraction, seed=SEED)
    suggested = sampled.agg(*sketches).first()
    parts = []
    for b, ends in zip(brackets, suggested):
        if ends and b.shifted():
            ends = [b.low + end for end in ends]
        for j, rank in enumerate(b.ranks):
            at = (ends if b.stuck else ends[2 * j : 2 * j + 2]) if ends else (None, None)
            parts.append((replace(b, ranks=[rank]), *at))
    counts = []
    for i, (b, low, high) in enumerate(parts):
        inside, low, high = b.inside(), F.lit(low), F.lit(high)
        counts.append(F.count_if(inside & (b.key < low)).alias(f"before{i}"))
        counts.append(F.count_if(inside & (b.key == low)).alias(f"low{i}"))
        counts.append(F.count_if(inside & (b.key > low) & (b.key < high)).alias(f"between{i}"))
        counts.append(F.count_if(inside & (b.key == high) & (b.key > low)).alias(f"high{i}"))
    counted = df.agg(*counts).first()
    narrowed = []
    for i, (b, low, high) in enumerate(parts):
        if low is None:  # no row of the sample lies inside
            narrowed.append(replace(b, missed=True))
            continue
        before, at_low, between, at_high = counted[4 * i : 4 * i + 4]
        after = b.rows - before - at_low - between - at_high
        below = b.below
        for rows, bounds in (
            (before, {"high": low}),
            (at_low, {"low": low, "high": low, "single": True}),
            (between, {"low": low, "high": high}),
            (at_high, {"low": high, "high": high, "single": True}),
            (after, {"low": high}),
        ):
            if b.ranks[0] <= below + rows:
                missed, stuck = not whole and rows > 0.5 * b.rows, whole and rows > 0.9 * b.rows
                narrowed.append(replace(b, below=below, rows=rows, missed=missed, stuck=stuck, **bounds))
                break
            below += rows
    return narrowed


def _wide(bracket: _Bracket, limit: int) -> bool:
    return not bracket.single and bracket.rows > limit


def order_statistics(
    df: DataFrame, wanted: Sequence[tuple[Column, int, Sequence[int]]], limit: int = BRACKET_ROWS
) -> list[dict[int, Found]]:
    """For each ``(key, rows, ranks)``, the keys at those 1-based ascending ranks.

    ``key`` is NULL for rows that take no part and ``rows`` counts the others.
    Equal keys collapse to a count before the shuffle, so a key shared by a third
    of all rows costs no more than any other.
    """
    brackets = [
        _Bracket(i, key, sorted(set(ranks)), rows) for i, (key, rows, ranks) in enumerate(wanted) if ranks
    ]
    while wide := [b for b in brackets if _wide(b, limit)]:
        brackets = [b for b in brackets if not _wide(b, limit)] + _narrowed(df, wide)
    found: list[dict[int, Found]] = [{} for _ in wanted]
    for b in brackets:
        if b.single:
            found[b.owner][b.ranks[0]] = Found(b.low, b.ranks[0] - b.below, b.rows)
    brackets = [b for b in brackets if not b.single]
    if not brackets:
        return found

    members = [
        F.when(b.inside(), F.struct(F.lit(slot).alias("slot"), b.key.alias("key")))
        for slot, b in enumerate(brackets)
    ]
    taking_part = reduce(or_, [b.inside() for b in brackets])
    counts = (
        df.filter(taking_part)
        .select(F.explode(F.array_compact(F.array(*members))).alias("member"))
        .groupBy("member.slot", "member.key")
        .agg(F.count("*").alias("ties"))
    )
    ordered = Window.partitionBy("slot").orderBy("key")
    upto = F.sum("ties").over(ordered)
    hit = F.lit(False)
    for slot, b in enumerate(brackets):
        for rank in b.ranks:
            local = rank - b.below
            hit = hit | (
                (F.col("slot") == slot) & (F.col("upto") >= local) & (F.col("upto") - F.col("ties") < local)
            )
    for row in counts.withColumn("upto", upto).filter(hit).collect():
        b = brackets[row["slot"]]
        before = b.below + row["upto"] - row["ties"]
        for rank in b.ranks:
            if before < rank <= before + row["ties"]:
                found[b.owner][rank] = Found(row["key"], rank - before, row["ties"])
    return found


def _counts(df: DataFrame, keys: Sequence[Column]) -> list[int]:
    return list(df.agg(*[F.count(key).alias(f"n{i}") for i, key in enumerate(keys)]).first())


def _tile_ends(n: int, k: int) -> list[int]:
    """Rank of the last row of every tile but the final one, as SQL ``ntile`` sizes them."""
    size, extra = divmod(n, k)
    ends = [t * size + min(t, extra) for t in range(1, k)]
    return [end for end in ends if 0 < end < n]


def _text_key(id: Column, level: int) -> Column:
    """A whole number in the order of the bytes of a text at ``level``, a shorter end first."""
    part = F.substring(F.encode(id, "UTF-8"), _LEVEL * level + 1, _LEVEL)
    number = F.conv(F.rpad(F.hex(part), 2 * _LEVEL, "0"), 16, 10).cast("bigint")
    return number * 8 + F.octet_length(part)


@dataclass
class _Cut:
    """The end of a tile among rows of one value: the id ``position`` decides, in the order of ids."""

    tied: Column
    position: int
    ties: int
    prefix: bytes = b""
    ended: bool = False
    key: float | None = None

    def beyond(self, id: Column, text: bool) -> Column:
        if not text:
            return id > F.lit(self.key)
        data = F.encode(id, "UTF-8")
        data = data if self.ended else F.substring(data, 1, len(self.prefix))
        return data > F.lit(bytearray(self.prefix))


def _cut_ties(df: DataFrame, id: str, cuts: list[_Cut], text: bool, limit: int) -> None:
    """Find the id at each cut. Texts are compared some bytes at a time, all cuts in the same passes."""
    level, open_cuts = 0, cuts
    while open_cuts:
        wanted = []
        for c in open_cuts:
            tied, key = c.tied, F.col(id)
            if text:
                key = _text_key(key, level)
                if level:
                    begun = F.substring(F.encode(F.col(id), "UTF-8"), 1, _LEVEL * level)
                    tied = tied & (begun == F.lit(bytearray(c.prefix)))
            wanted.append((F.when(tied, key), c.ties, [c.position]))
        for c, places in zip(open_cuts, order_statistics(df, wanted, limit)):
            place = places[c.position]
            if text:
                number, size = divmod(place.key, 8)
                c.prefix += number.to_bytes(_LEVEL, "big")[:size]
                c.ended = size < _LEVEL
            c.key, c.position, c.ties = place.key, place.position, place.ties
        open_cuts = [c for c in open_cuts if text and not c.ended and c.ties > 1]
        level += 1


def ntiles(
    df: DataFrame,
    id: str,
    tiles: Mapping[str, Tile],
    limit: int = BRACKET_ROWS,
    by: str | None = None,
    groups: Sequence | None = None,
) -> DataFrame:
    """Add one column per entry of ``tiles``: ``ntile(k)`` over ``(value, id)``.

    ``id`` is unique and breaks ties in ascending order, also under ``desc``; text ids
    by their bytes. Whole numbers and decimals keep their type. With ``by``, each of its
    values has tiles of its own, in which ``id`` is unique; ``groups`` lists the values if they
    are known, and there should be some hundreds at most, as each adds to the
    expressions. All columns and groups are found in the same passes.
    """
    if by is not None and groups is None:
        groups = sorted(row[0] for row in df.select(by).where(F.col(by).isNotNull()).distinct().collect())
    owners, keys = [], []
    for name in tiles:
        kind = df.schema[tiles[name].value].dataType
        exact = isinstance(kind, (IntegralType, DecimalType))
        value = F.col(tiles[name].value)
        value = value if exact else value.cast("double")
        value = -value if tiles[name].desc else value
        for group in [None] if by is None else groups:
            owners.append((name, group))
            keys.append(value if by is None else F.when(F.col(by) == F.lit(group), value))
    text = isinstance(df.schema[id].dataType, StringType)
    sizes = _counts(df, keys) if keys else []
    ends = [_tile_ends(n, tiles[name].k) for (name, _), n in zip(owners, sizes)]
    found = order_statistics(df, list(zip(keys, sizes, ends)), limit)

    # A tile may end among rows of one value; the id at that place settles it.
    cuts = {
        (i, end): _Cut(keys[i] == F.lit(place.key), place.position, place.ties)
        for i, places in enumerate(found)
        for end, place in places.items()
        if place.position < place.ties
    }
    _cut_ties(df, id, list(cuts.values()), text, limit)

    columns: dict[str, list[Column]] = {name: [] for name in tiles}
    for i, (name, _) in enumerate(owners):
        tile = F.lit(1)
        for end in ends[i]:
            place = found[i][end]
            beyond = keys[i] > F.lit(place.key)
            if (i, end) in cuts:
                cut = cuts[i, end]
                beyond = beyond | (cut.tied & cut.beyond(F.col(id), text))
            tile = tile + beyond.cast("int")
        columns[name].append(F.when(keys[i].isNotNull(), tile))
    none = F.lit(None).cast("int")
    return df.withColumns({name: F.coalesce(*tiled, none) for name, tiled in columns.items()})


def quantiles(
    df: DataFrame, probabilities: Mapping[str, Sequence[float]], limit: int = BRACKET_ROWS
) -> dict[str, list[float | None]]:
    """Exact quantiles by linear interpolation between neighbouring ranks."""
    names = list(probabilities)
    keys = [F.col(name).cast("double") for name in names]
    sizes = _counts(df, keys)
    ranks = []
    for name, n in zip(names, sizes):
        places = [(n - 1) * p for p in probabilities[name]] if n else []
        ranks.append([int(f(place)) + 1 for place in places for f in (math.floor, math.ceil)])
    found = order_statistics(df, list(zip(keys, sizes, ranks)), limit)
    result: dict[str, list[float | None]] = {}
    for name, n, places in zip(names, sizes, found):
        result[name] = []
        for p in probabilities[name]:
            if n == 0:
                result[name].append(None)
                continue
            place = (n - 1) * p
            low = places[math.floor(place) + 1].key
            high = places[math.ceil(place) + 1].key
            result[name].append(low + (high - low) * (place - math.floor(place)))
    return result


def segment(
    df: DataFrame,
    value: str,
    labels: Sequence[str] = ("D", "C", "B", "A"),
    id: str = "customer_id",
    limit: int = BRACKET_ROWS,
    by: str | None = None,
    groups: Sequence | None = None,
) -> DataFrame:
    """Label equal-sized groups of customers, lowest value first, as ``segment``.

    Customers without a value stay without a label. With ``by``, each of its values has
    segments of its own, all found in the same passes.
    """
    tiled = ntiles(df, id, {"segment": Tile(value, len(labels))}, limit, by, groups)
    names = F.array(*[F.lit(label) for label in labels])
    return tiled.withColumn("segment", F.get(names, F.col("segment") - 1))
