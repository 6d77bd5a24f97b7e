"""Language, quality, toxicity, licences and the pipeline: held-out results and edge cases."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from shopworth.llm import langid, licences, quality, secrets, toxicity
from shopworth.llm.queries import op3_toxicity, op4_language, op6_licences, op10_quality

DATA, SMALL = "/root/testdata/sf0.1", "/root/testdata/sf0.001"
EDGES = [(1, None), (2, ""), (3, "12 34 ... !!"), (4, "the word " * 40_000), (5, "the word"), (5, "the word"), (None, "été à la ville")]


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()}
    rows = op4_language(spark, DATA).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.98 * len(held)
    for r in rows:
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert sum(r.rejected for r in held) <= 0.005 * len(held)


def test_language_edges(documents):
    learned = documents([(i, "the small word of this") for i in range(30)]).withColumnRenamed("lang", "l")
    model = langid.fit(learned, lang="l", sample=20)
    out = langid.predict(documents(EDGES), model)
    found = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert out.count() == len(EDGES) and "a.b" in out.columns
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[4][0] == found[5][0] == "en"
    none = langid.predict(documents(EDGES), langid.fit(documents([])))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert langid.predict(documents([]), model).count() == 0


def test_subwords_in_slices(monkeypatch):
    text = "Été, the Straße and 中文 " * 20
    whole = np.sort(np.concatenate(list(langid.subwords(text))))
    monkeypatch.setattr(langid, "SLICE", 17)
    assert (np.sort(np.concatenate(list(langid.subwords(text)))) == whole).all()


def test_quality_against_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = op10_quality(spark, DATA).collect()
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    assert np.mean(bad) < 0.05 and np.mean(good) > 0.998


def test_expectation_maximisation_finds_accuracies():
    draw = np.random.default_rng(1)
    good = draw.random(20_000) < 0.85
    said = np.zeros((20_000, 4), np.int64)
    for j, right in enumerate((0.9, 0.8, 0.7, 0.95)):
        said[:, j] = np.where(draw.random(20_000) < right, 1, -1) * np.where(good, 1, -1)
    patterns, counts = np.unique(said, axis=0, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float))
    assert np.allclose(model.accuracy(), (0.9, 0.8, 0.7, 0.95), atol=0.02) and abs(model.prior[1] - 0.85) < 0.02


def test_monotony_is_judged_over_whole_texts():
    clean = " ".join(f"word{i * 7919 % 3001}" for i in range(19_000))
    dull = "the same line once again\n" * 3800
    opening = "a table row of cells\n" * 200
    monotony = quality.LABELLERS.index("monotony")
    for text, vote in (
        (clean[: clean.index("word1 ")] + dull, -1), (" ".join(clean.split()[:1000]) + "\n" + dull, -1), (dull + "end", -1),
        (opening + clean, 0), (clean, 0), ("word " * 30, -1), ("one two three four five six seven eight", 0),
    ):
        assert quality.votes(text.encode())[monotony] == vote


def test_quality_edges(documents):
    model = quality.fit(documents([(i, f"some clean words of text number {i} and more of it.") for i in range(40)]))
    out = quality.score(documents(EDGES), model)
    rows = out.collect()
    assert len(rows) == len(EDGES) and "a.b" in out.columns
    assert all(r.kept for r in rows if r.doc_id != 4)
    assert quality.score(documents(EDGES), quality.fit(documents([]))).where("NOT kept AND doc_id < 4").count() == 0


@pytest.mark.parametrize("hot", [None, 7])
def test_samples_are_bounded_with_a_hot_id(documents, monkeypatch, hot):
    rows = [(hot if i % 3 == 0 else i, f"some clean words of text number {i} and more of it.") for i in range(900)]
    taught = []
    monkeypatch.setattr(quality, "_teach", lambda x, y, epochs: taught.append(len(x)) or (np.zeros(2 * quality.BUCKETS), 0.0))
    monkeypatch.setattr(langid, "_train", lambda languages, rows, *rest: taught.append(len(rows)))
    collected, arrow = [], type(documents([])).toArrow
    monkeypatch.setattr(type(documents([])), "toArrow", lambda df: collected.append(arrow(df)) or collected[-1])
    quality.fit(documents(rows), sample=60)
    langid.fit(documents(rows), sample=60)
    assert all(40 <= n <= 60 for n in taught) and [t.num_rows for t in collected] == taught
    hashes = [set(t.column("h").to_pylist()) for t in collected]
    assert all(len(h) == n for h, n in zip(hashes, taught, strict=True))


def test_toxicity_against_labels(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = op3_toxicity(spark, DATA).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 10_000
    toxic = [r for r in rows if labels.get(r.doc_id) == 1]
    clean = [r for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean([r.toxic for r in toxic]) > 0.8 and np.mean([r.toxic for r in clean]) < 0.005
    assert np.mean([r.expected_severity for r in toxic]) > 20 * np.mean([r.expected_severity for r in clean])


def test_toxicity_edges(spark, documents):
    docs = documents([(i, "nasty vile words here" if i % 4 == 0 else f"plain words here {i}") for i in range(200)])
    schema = "doc_id long, toxic int"
    labels = spark.createDataFrame([*((i, int(i % 4 == 0)) for i in range(200)), (7, None), (None, 1), (8, 1)], schema)
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all() and (model.weights >= 0).all()
    found = toxicity.predict(documents([*EDGES, (9, "such NASTY vile ones")]), model)
    severity = {r.doc_id: r.expected_severity for r in found.collect()}
    assert severity[9] > 0.5 and severity[1] == severity[2] == severity[5] == 0 and "a.b" in found.columns
    assert toxicity.predict(documents(EDGES), toxicity.fit(docs, labels.limit(0))).where("toxic").count() == 0
    assert toxicity.predict(documents([]), model).count() == 0


def test_word_features_in_slices(monkeypatch):
    text = "Nasty, vile wörds; and étés again " * 30
    whole = np.sort(np.concatenate(list(toxicity.buckets(text))))
    monkeypatch.setattr(toxicity, "SLICE", 19)
    assert (np.sort(np.concatenate(list(toxicity.buckets(text)))) == whole).all()


LINES = {"MIT": "Released under the MIT License.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
LINES |= {"GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
LINES |= {"Apache-2.0": "Licensed under the Apache License, Version 2.0."}


def test_licences_of_whole_table(spark):
    texts = dict(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    for r in op6_licences(spark, "/root/testdata/sf0.01").collect():
        named = {k for k, line in LINES.items() if line in (texts[r.doc_id] or "").split("\n")}
        assert (r.licence in named) if named else (r.cosine is None)


def test_licences_are_inherited_from_the_nearest_directory(spark):
    rows = [
        ("a/LICENSE", LINES["MIT"], 1), ("a/x.py", "code", 1), ("a/b/y.py", "code", 1), ("a/b/c/z.py", "code", 1),
        ("a/b/COPYING", "Preface. " * 50 + LINES["GPL-3.0"], 1), ("a/b/own.py", f"code\n{LINES['Apache-2.0']}\nmore code and more of it", 1),
        ("ab/x.py", "code", 1), ("top.py", None, 1), (None, LINES["MIT"] + " word" * 90, 1), ("a/x.py", "code", 1), ("e/empty", "", 1),
    ]
    df = spark.createDataFrame(rows, "path string, text string, cosine int").withColumnRenamed("cosine", "`licence")
    found = {r.path: (r.licence, r.inherited_from) for r in licences.scan(df).collect()}
    assert found == {
        "a/LICENSE": ("MIT", None), "a/x.py": ("MIT", "a"), "a/b/y.py": ("GPL-3.0", "a/b"), "a/b/c/z.py": ("GPL-3.0", "a/b"),
        "a/b/COPYING": ("GPL-3.0", None), "a/b/own.py": ("Apache-2.0", None), "ab/x.py": (None, None), "top.py": (None, None),
        None: ("MIT", None), "e/empty": (None, None),
    }
    assert licences.scan(df).count() == len(rows) and licences.scan(df.limit(0)).count() == 0


def test_whole_licence_texts_are_licence_files(spark):
    texts = licences.whole_texts()
    assert {"MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"} <= set(texts)
    rows = [(f"{k}/12", f"Copyright (c) 2024 Jane Quux\n\n{v}") for k, v in texts.items()]
    rows += [(f"{k}/src/a.py", "code") for k in texts] + [("two/1", f"{LINES['MIT']}\nLicensed under the MIT License.")]
    rows += [("two/a.py", "code"), ("prose/1", "words of prose about no law at all " * 300 + texts["MIT"]), ("prose/2", "code")]
    rows += [(f"plain/{i}", f"word number {i} of a text") for i in range(300)]
    found = {r.path: (r.licence, r.inherited_from) for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    for k in texts:
        assert found[f"{k}/12"] == (k, None) and found[f"{k}/src/a.py"] == (k, k)
    assert found["two/1"] == ("MIT", None) and found["two/a.py"] == ("MIT", "two")
    assert found["prose/1"] == ("MIT", None) and found["prose/2"] == (None, None)


WRAPPED = {
    "MPL-2.0": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "GPL-3.0": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.""",
    "LGPL-3.0": """# This library is free software: you can redistribute it and/or modify
# it under the terms of the GNU Lesser General Public License as published by
# the Free Software Foundation, either version 3 of the License, or""",
    "Apache-2.0": """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.""",
    "MIT": """-- Permission is hereby granted, free of
-- charge, to any person obtaining a copy of this
-- software and associated documentation files""",
}


def test_wrapped_headers_are_joined():
    matcher = licences.Matcher(1000, {"the": 500, "of": 400, "a": 400, "to": 300, "is": 300}, 0.6, 0.95)
    for name, header in WRAPPED.items():
        found = matcher.find(f"x = 1\n{header}\n" + "def some(code): return other\n" * 40)
        assert found[0] == name and found[1] > 0.95 and found[2] < 0.5
    assert matcher.find("The file is licensed.\n" + "def some(code): return other\n" * 40) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "near_duplicates", "secrets", "packing"]
    kept = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.01").collect()
        docs = spark.createDataFrame(out, docs.schema)
        kept.append(len(out))
        assert len({r.doc_id for r in out}) == len(out)
    assert kept[0] > kept[1] >= kept[2] > kept[3] == kept[4] > 0.7 * kept[0]
    assert all(not secrets.base_spans(r.text) for r in out)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in out}


@pytest.mark.parametrize("rows", [[], EDGES])
def test_pipeline_stages_on_edges(spark, documents, rows):
    docs = documents(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= min(1, len(rows)) * docs.count()


def test_samples_are_bounded_by_bytes(documents, spark):
    """Long texts do not make a sample large: shares are cut by the size of their counts too."""
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}o" for j in range(600))) for i in range(60)]
    docs = documents(rows)
    seen = []
    train, teach = langid._train, quality._teach
    try:
        langid._train = lambda languages, table, *rest: seen.append(table.nbytes) or train(languages, table, *rest)
        quality._teach = lambda x, y, epochs: seen.append(sum(f.nbytes for f in x.flats)) or teach(x, y, epochs)
        langid.fit(docs, sample_bytes=60_000, epochs=1)
        quality.fit(docs, sample_bytes=30_000, epochs=1)
        whole = langid.fit(docs, epochs=1)
    finally:
        langid._train, quality._teach = train, teach
    assert 20_000 < seen[0] <= 70_000 and 5_000 < seen[1] <= 30_000 and seen[2] > 2 * seen[0]
    assert whole.languages == ["en"]


def test_flat_buffers_equal_lists():
    import pyarrow as pa

    from shopworth.llm.common import Ragged, flat

    parts = [np.arange(n, dtype=np.uint16) for n in (3, 0, 5)]
    column = pa.chunked_array([pa.array([p.tobytes() for p in parts[:2]], pa.binary()), pa.array([parts[2].tobytes()], pa.binary())])
    values, starts = flat(pa.table({"x": column}), "x", np.uint16)
    rows = Ragged(starts, values)
    assert len(rows) == 3 and [r.tolist() for (r,) in (rows[i] for i in range(3))] == [p.tolist() for p in parts]
    values, starts = flat(pa.table({"x": column}).slice(2), "x", np.uint16)
    assert values.tolist() == [0, 1, 2, 3, 4] and starts.tolist() == [0, 5]
    values, starts = flat(pa.table({"x": pa.array([], pa.binary())}), "x", np.uint16)
    assert len(values) == 0 and len(Ragged(starts, values)) == 0
