"""Rows of one key: signatures are compared before anything is chained or moved."""

import random
from math import comb

import numpy as np
import pytest

from shopworth.llm import near_dup


def test_distance_leaves_a_tenth_of_the_chance_out():
    for similarity, symbols in [(0.8, 150), (0.85, 138), (0.5, 96)]:
        limit = near_dup.distance_for(similarity, symbols)
        beyond = sum(
            comb(symbols, k) * (1 - similarity) ** k * similarity ** (symbols - k) for k in range(limit + 1, symbols + 1)
        )
        assert beyond <= near_dup.MISSED / 10
    assert near_dup.distance_for(1.0, 150) == 0


@pytest.mark.parametrize("blocks", [(0, 0), (0, 1)])
def test_a_bucket_by_hand(blocks):
    draw, n = np.random.default_rng(3), 300
    base = draw.integers(0, 256, (20, 150), dtype=np.uint8)
    noise = draw.integers(0, 256, (n, 150), dtype=np.uint8)
    brief = np.where(draw.random((n, 150)) < 0.8, base[draw.integers(0, 20, n)], noise)
    own, sizes = draw.integers(0, 2, n), draw.integers(90, 111, n)
    bucket = np.tile(np.array([[7, *blocks]]), (n, 1))
    edges = near_dup._walked(near_dup._Rows(bucket, own, np.arange(n), sizes, brief), 90, 52)

    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            sized = 100 * min(sizes[i], sizes[j]) >= 90 * max(sizes[i], sizes[j])
            met = blocks == (0, 0) or own[i] != own[j]
            if sized and met and (brief[i] != brief[j]).sum() <= 52:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    found = dict(edges.tolist())
    assert [found.get(i, i) for i in range(n)] == [find(i) for i in range(n)]


def common_words(n):
    draw = random.Random(5)
    return [(i, "one two three four five six seven eight " + " ".join(f"r{draw.randrange(10**9)}" for _ in range(3))) for i in range(n)]


def test_texts_that_only_share_keys_form_no_group(documents, monkeypatch):
    """Hot keys without any link: cut into blocks, and no text is moved for them."""
    monkeypatch.setattr(near_dup, "ROWS", 64)
    moved, verified = [], near_dup._verified

    def counted(blocks, words, percent):
        moved.append(blocks.count())
        return verified(blocks, words, percent)

    monkeypatch.setattr(near_dup, "_verified", counted)
    found = near_dup.near_duplicates(documents(common_words(1500)).repartition(4)).collect()
    assert all(r.kept and r.first_copy for r in found) and len(found) == 1500
    assert moved == [0]


def test_near_copies_over_many_blocks_of_a_key(documents, monkeypatch):
    """Copies of one text meet across the blocks of their keys and of their group."""
    monkeypatch.setattr(near_dup, "ROWS", 16)
    draw = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*words[:297], *(f"e{draw.randrange(10**9)}" for _ in range(3))])) for i in range(150)]
    rows += [(1000 + i, t) for i, t in common_words(50)]
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(documents(rows).repartition(3)).collect()}
    assert found == {i: 0 if i < 1000 else i for i, _ in rows}


def test_columns_called_like_inner_ones_stay(spark):
    names = ["_uid", "_key", "_own", "_id", "_n", "_lead", "_packed", "_words", "_keep0"]
    df = spark.createDataFrame(
        [(1, "a b c d e f", *range(9)), (2, "A b c d e f", *range(9, 18)), (3, None, *[None] * 9)],
        "doc_id long, text string, " + ", ".join(f"{n} int" for n in names),
    )
    found = near_dup.near_duplicates(df, keep=df.columns)
    assert found.columns == [*df.columns, "n_shingles", "component_id", "kept", "first_copy"]
    rows = {r.doc_id: r for r in found.collect()}
    assert [rows[2][n] for n in names] == list(range(9, 18)) and rows[3]["_lead"] is None
    assert (rows[2].component_id, rows[2].text, rows[1].kept, rows[3].kept) == (1, "A b c d e f", True, True)
