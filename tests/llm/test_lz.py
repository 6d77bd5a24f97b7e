"""Fingerprints against a plain reading of their definition."""

import hashlib

import pytest

from shopworth.llm import lz
from shopworth.llm.queries import op2_lempel_ziv

DATA = "/root/testdata/sf0.001"


def plain_phrases(text):
    seen, current = [], ""
    for c in text:
        current += c
        if current not in seen:
            seen.append(current)
            current = ""
    return seen


@pytest.mark.parametrize("text", ["", "a", "aaaaaaaaaaaa", "abracadabra abracadabra", "àé😀é😀àé😀", "the the then there"])
def test_phrases(text):
    ends = lz.parse(text, set())
    cut = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    assert cut == plain_phrases(text)


def test_likeness():
    def sign(t):
        return lz.signature(t, lz.parse(t, set()))

    assert lz.likeness(sign(""), sign("")) == 1 and lz.likeness(sign(""), sign("a")) == 0
    a, b = set(plain_phrases("banana bandana")), set(plain_phrases("banana cabana"))
    assert lz.likeness(sign("banana bandana"), sign("banana cabana")) == len(a & b) / len(a | b)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        sign = [lz.signature(t, lz.parse(t, set())) for t in (text, edited, following)]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = lz.likeness(sign[0], sign[1]), lz.likeness(sign[0], sign[2])
        out.append((i, len(text), digest, lz.as_text(sign[0]), lz.as_text(sign[1]), *near))
    return sorted(out, key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    found = sorted((tuple(r) for r in op2_lempel_ziv(spark, DATA).collect()), key=str)
    assert found == expected([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(5, "one text alone")],
        [(1, None), (2, ""), (3, "x"), (None, "no id"), (None, "none either"), (7, "abc" * 50_000)],
        [(4, "same id"), (4, "same id"), (4, "another"), (9, "😀é" * 40), (-3, "below zero")],
        [(i % 3, f"text {i} " * (i % 5)) for i in range(40)],
    ],
)
def test_edges(documents, rows):
    found = lz.edited_fingerprints(documents(rows).repartition(3))
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)


def test_equal_texts_equal_fingerprints(documents):
    df = lz.fingerprint(documents([(1, "abc abc"), (2, "abc abc"), (3, None), (4, "")]))
    made = {r.doc_id: r.fingerprint for r in df.collect()}
    assert made[1] == made[2] and made[3] == made[4] == "" and "a.b" in df.columns
