import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopworth.operators import rank
from shopworth.operators.rank import Tile, ntiles, order_statistics, quantiles, segment

SCHEMA = "id bigint, value double"


def brute_ntile(rows, k, desc=False):
    present = sorted((-v if desc else v, i) for i, v in rows if v is not None)
    size, extra = divmod(len(present), k)
    tiles, place = {i: None for i, v in rows if v is None}, 0
    for tile in range(1, k + 1):
        for _ in range(size + (tile <= extra)):
            tiles[present[place][1]] = tile
            place += 1
    return tiles


def spark_ntile(spark, rows, k, desc=False, limit=500_000):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    tiled = ntiles(df, "id", {"tile": Tile("value", k, desc)}, limit)
    return {row["id"]: row["tile"] for row in tiled.collect()}


def skewed(n, seed=1):
    """A third of all rows share one value, the rest are nearly distinct."""
    rng = random.Random(seed)
    values = [7.0 if rng.random() < 0.34 else rng.choice([rng.gauss(7, 3), 100 * rng.random()]) for _ in range(n)]
    ids = list(range(n))
    rng.shuffle(ids)
    return list(zip(ids, values))


@pytest.mark.parametrize("limit", [500_000, 40])
@pytest.mark.parametrize("desc", [False, True])
def test_ntile_with_a_hot_value(spark, limit, desc):
    rows = skewed(3000)
    for k in (4, 7):
        assert spark_ntile(spark, rows, k, desc, limit) == brute_ntile(rows, k, desc)


@pytest.mark.parametrize("limit", [500_000, 10])
def test_ntile_with_one_value_only(spark, limit):
    rows = [(i, 1.0) for i in range(1003)]
    assert spark_ntile(spark, rows, 5, limit=limit) == brute_ntile(rows, 5)


@pytest.mark.parametrize("sampled", [1, 30, 400])
def test_ntile_is_exact_whatever_the_sample_suggests(spark, monkeypatch, sampled):
    monkeypatch.setattr(rank, "SKETCH_ROWS", sampled)
    rows = skewed(2500, seed=9)
    assert spark_ntile(spark, rows, 5, limit=30) == brute_ntile(rows, 5)


def test_ntile_leaves_nulls_without_a_tile(spark):
    rows = [(1, None), (2, 3.0), (3, 1.0), (4, None), (5, 2.0)]
    assert spark_ntile(spark, rows, 2) == {1: None, 2: 2, 3: 1, 4: None, 5: 1}


def test_ntile_of_nothing(spark):
    assert spark_ntile(spark, [], 4) == {}
    assert spark_ntile(spark, [(1, None)], 4) == {1: None}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.integers(-3, 3).map(float), min_size=1, max_size=40),
    k=st.integers(1, 8),
    desc=st.booleans(),
    limit=st.sampled_from([2, 500_000]),
)
def test_ntile_equals_brute_force(spark, values, k, desc, limit):
    rows = list(enumerate(values))
    assert spark_ntile(spark, rows, k, desc, limit) == brute_ntile(rows, k, desc)


def test_several_tiles_in_one_call(spark):
    rows = skewed(900, seed=3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("other", -F.col("value") * F.col("id"))
    tiles = {"up": Tile("value", 5), "down": Tile("value", 3, True), "by_other": Tile("other", 4)}
    found = ntiles(df, "id", tiles, limit=60).collect()
    others = [(row["id"], row["other"]) for row in found]
    assert {row["id"]: row["up"] for row in found} == brute_ntile(rows, 5)
    assert {row["id"]: row["down"] for row in found} == brute_ntile(rows, 3, True)
    assert {row["id"]: row["by_other"] for row in found} == brute_ntile(others, 4)


def test_large_ids_stay_exact(spark):
    big = 2**60
    rows = [(big + i, 5.0) for i in range(200)]
    assert spark_ntile(spark, rows, 3, limit=5) == brute_ntile(rows, 3)


@pytest.mark.parametrize("limit", [500_000, 25])
def test_quantiles_equal_interpolation(spark, limit):
    rows = skewed(1001, seed=5)
    df = spark.createDataFrame(rows, SCHEMA)
    probabilities = [0.0, 0.01, 0.25, 0.333, 0.5, 0.9, 1.0]
    found = quantiles(df, {"value": probabilities}, limit)["value"]
    assert np.allclose(found, np.quantile([v for _, v in rows], probabilities), rtol=1e-12)


def test_order_statistics_report_ties(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([3, 1, 3, 3, 2])], SCHEMA)
    found = order_statistics(df, [(F.col("value"), 5, [1, 4])])[0]
    assert (found[1].key, found[1].position, found[1].ties) == (1.0, 1, 1)
    assert (found[4].key, found[4].position, found[4].ties) == (3.0, 2, 3)


def test_segment_labels_from_lowest_to_highest(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(8)], "customer_id bigint, value double")
    labels = {row["customer_id"]: row["segment"] for row in segment(df, "value").collect()}
    assert "".join(labels[i] for i in range(8)) == "DDCCBBAA"


@pytest.mark.parametrize("limit", [500_000, 20])
@pytest.mark.parametrize("desc", [False, True])
def test_text_ids_break_ties_in_their_order(spark, limit, desc):
    rng = random.Random(4)
    ids = {"", "a", "a\0", "a\0\0", "abcdefg", "abcdefgh", "abcdefg\0", "é", "zzzzzzz", "\U0001f600"}
    ids |= {"customer number " + str(i) for i in range(700)}
    ids |= {"".join(rng.choices("ab", k=rng.randrange(20))) for _ in range(200)}
    rows = [(i, float(rng.randrange(3))) for i in ids]
    df = spark.createDataFrame(rows, "id string, value double").repartition(3)
    found = ntiles(df, "id", {"tile": Tile("value", 5, desc)}, limit)
    expected = brute_ntile([(i.encode(), v) for i, v in rows], 5, desc)
    assert {row["id"].encode(): row["tile"] for row in found.collect()} == expected


@pytest.mark.parametrize("share", [0.95, 0.7495, 0.2505])
def test_ends_beside_a_dominant_value_stay_small(spark, monkeypatch, share):
    """All rows but the dominant ones are distinct; a tile ends just beside the dominant value."""
    n, limit, seen = 20_000, 200, []
    hot = int(n * share)
    values = [5.0] * hot + [5.0 + (i + 1) / n * (-1 if i % 3 else 1) for i in range(n - hot)]
    random.Random(2).shuffle(values)
    rows = list(enumerate(values))
    narrowed = rank._narrowed
    monkeypatch.setattr(rank, "_narrowed", lambda df, b: seen.append(out := narrowed(df, b)) or out)
    ends = [1, 500, hot, n - 500, n]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ordered = sorted(values)
    found = order_statistics(df, [(F.col("value"), n, ends)], limit)[0]
    assert {e: found[e].key for e in ends} == {e: ordered[e - 1] for e in ends}
    assert len(seen) <= 5
    last = {b.ranks[0]: b for brackets in seen for b in brackets}
    assert all(b.single or b.rows <= limit for b in last.values())
    assert spark_ntile(spark, rows, 4, limit=limit) == brute_ntile(rows, 4)


def test_groups_have_tiles_of_their_own_in_the_same_passes(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, g, float(rng.randrange(40)) if rng.random() < 0.9 else None) for g in ("a", "b", None) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, g string, value double").repartition(3)
    passes = []
    statistics = rank.order_statistics
    monkeypatch.setattr(rank, "order_statistics", lambda *a: passes.append(1) or statistics(*a))
    found = ntiles(df, "id", {"tile": Tile("value", 7)}, 50, by="g").collect()
    assert len(passes) == 2  # values, then ids
    for g in ("a", "b"):
        got = {r["id"]: r["tile"] for r in found if r["g"] == g}
        assert got == brute_ntile([(i, v) for i, h, v in rows if h == g], 7)
    assert {r["tile"] for r in found if r["g"] is None} == {None}
