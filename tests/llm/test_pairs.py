"""Near duplicates, near vectors and components against brute force."""

import random
import re

import numpy as np
import pytest

from shopworth.llm import cross_polytope, near_dup
from shopworth.llm.components import components
from shopworth.llm.queries import op5_cross_polytope, op9_minhash

DATA = "/root/testdata/sf0.01"


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    draw = random.Random(2)
    links = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(100)] + [(7, 7), (3, None)],
        "random": [(draw.randrange(300), draw.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    links = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert found == least_reachable({n for link in links for n in link}, links)


def shingles(text, n):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links.append((i, j))
    return {i: len(s) for i, s in sets}, least_reachable({i for i, _ in sets}, links)


def test_op9_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    sizes, roots = brute(rows, 3, 85)
    found = {tuple(r) for r in op9_minhash(spark, DATA).select("doc_id", "n_shingles", "component_id", "kept").collect()}
    assert found == {(i, sizes[i], roots[i], roots[i] == i) for i, _ in rows}


def edited(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_near_copies_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 3000)  # many blocks per group
    draw = random.Random(4)
    base = [f"b{draw.randrange(10**6)}" for _ in range(150)]
    rows = [(i, edited(draw, base, draw.randrange(5))) for i in range(120)]
    rows += [(1000 + i, " ".join(f"u{draw.randrange(50)}" for _ in range(40))) for i in range(40)]
    rows += [(2000 + i, "all of them the same text") for i in range(50)]
    found = near_dup.near_duplicates(documents(rows).repartition(4))
    _, roots = brute(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in found.collect()} == roots


def test_near_duplicate_edges(documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Two words"), (5, "two  WORDS"), (6, "É words"), (7, "é words")]
    rows += [(8, "x " * 60_000), (9, "x y " * 30_000), (None, "no id here"), (10, "no id here"), (11, "same row"), (11, "same row")]
    df = near_dup.near_duplicates(documents(rows), keep=["doc_id", "text", "a.b", "score"])
    found = df.collect()
    roots = {r.doc_id: r.component_id for r in found}
    assert roots == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9, None: 10, 10: 10, 11: 11}
    assert {(r.doc_id, r.text) for r in found} == set(rows)
    assert sum(r.first_copy for r in found) == len(set(roots.values())) and df.columns[:4] == ["doc_id", "text", "a.b", "score"]
    assert near_dup.near_duplicates(documents([])).count() == 0


def test_linked_by_hand():
    a, b, c = (np.array(x, np.uint64) for x in ([1, 2, 3, 4], [1, 2, 3, 5], [9]))
    assert near_dup.linked([a, b, c], 60).tolist() == [0, 0, 2]
    assert near_dup.linked([a, b, c], 61).tolist() == [0, 1, 2]


def brute_vectors(rows, cosine):
    good = [(i, np.array(v, float), k) for i, v, k in rows if k is not None and v and None not in v]
    good = [(i, v / np.abs(v).max(), k) for i, v, k in good if np.isfinite(v).all() and v.any()]
    links = []
    for k, (i, a, x) in enumerate(good):
        for j, b, y in good[:k]:
            if x == y and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links.append((i, j))
    count = dict.fromkeys([r[0] for r in rows], 0)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    return count, least_reachable(count, links)


def compare_vectors(df, rows, cosine=0.98):
    count, roots = brute_vectors(rows, cosine)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}
    assert found == {i: (count[i], roots[i], roots[i] == i) for i in count}


def test_op5_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    compare_vectors(op5_cross_polytope(spark, DATA), rows)


def test_near_vectors_in_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    draw = np.random.default_rng(0)
    centre = draw.normal(size=(4, 48))
    rows = []
    for i in range(240):
        v = centre[i % 4] + draw.normal(size=48) * draw.choice([0.02, 0.1, 0.25])
        rows.append((i, [float(x) for x in v], int(i % 3 == 0)))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    compare_vectors(cross_polytope.near_vectors(df.repartition(3)), rows)


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1)]
    rows += [(7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 2), (11, [1.0, 0.0, 0.0], 1)]
    rows += [(12, [3.0], 5), (13, [4.0], 5), (14, [-4.0], 5), (15, [1e300, 1e300], 7), (16, [1e-300, 1e-300], 7)]
    schema = "vec_id long, embedding array<double>, label int, n_links string, `a.b` int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    out = cross_polytope.near_vectors(df)
    compare_vectors(out, rows)
    assert "a.b" in out.columns
    assert cross_polytope.near_vectors(df.limit(0)).count() == 0
