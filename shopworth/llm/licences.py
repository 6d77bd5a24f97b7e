"""Licence scans: TF-IDF cosine of headers to templates, inherited along directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopworth.llm.common import col, map_arrow, map_batches
from shopworth.sources import pin

# The wording by which licences are named, or their opening words.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
#: Passages that hold none of these are no header and are not weighed.
HINT = r"(?i)licen[cs]|copyright|spdx|permission is hereby|free software|redistribution and use|creative commons"
#: Begins the keys of rows without a path; a digest of their text follows.
_NOWHERE = "\0"
#: Characters searched for words at a time.
_SLICE = 1 << 20
#: A directory with more than one in so many rows is joined by broadcast; there are fewer than that.
_HOT = 1000
_TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
_STRETCH = re.compile(r"\n+|(?<=[.!?])[ \t\n\x0b\f\r]+")
_WORD, _HINT = re.compile(_TOKEN), re.compile(HINT)
_JOINED = re.compile(r"[a-z0-9.-]{2}")


def _tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@cache
def whole_texts() -> dict[str, str]:
    """The licence texts beside this file, by name."""
    folder = files("shopworth.llm") / "licence_texts"
    return {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in sorted(folder.iterdir(), key=lambda f: f.name)}


@cache
def vocabulary() -> list[str]:
    texts = [*(text for texts in TEMPLATES.values() for text in texts), *whole_texts().values()]
    return sorted({t for text in texts for t in _tokens(text)})


def _distinct_words(text: str, known: set[str]) -> set[str]:
    """Those of ``known`` that the whole text holds, searched in slices that end between words."""
    text, start, found = text.lower(), 0, set()
    while start < len(text):
        stop = start + _SLICE
        while stop < len(text) and _JOINED.match(text, stop - 1):
            stop += 1
        found.update(known.intersection(_WORD.findall(text, start, stop)))
        start = stop
    return found


def document_frequency(df: DataFrame, text: str = "text") -> tuple[int, dict[str, int]]:
    """How many of all texts hold each word of the templates, and how many texts there are.

    Both are counted over whole texts, within each task first; the result has a row per
    template word.
    """
    known = set(vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counter()
        for batch in batches:
            held[""] += batch.num_rows
            for value in batch.column(0):
                held.update(_distinct_words(value.as_py() or "", known))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    rows = map_batches(df.select(col(text)), run, "word string, n long").groupBy("word").agg(F.sum("n")).collect()
    counts = {r[0]: r[1] for r in rows}
    return counts.pop("", 0), counts


class Matcher:
    """The templates as vectors of weighed words, and what in a text is like them.

    Words weigh by their number and rarity; a word in no template weighs as one that
    no text holds. Comment marks are no words, so they part nothing.
    """

    def __init__(self, total: int, frequency: dict[str, int], least: float, alike: float):
        self.least, self.alike = least, alike
        self.place = {w: i for i, w in enumerate(vocabulary())}
        weights = [math.log((1 + total) / (1 + frequency.get(w, 0))) + 1 for w in self.place]
        self.weights = np.array([*weights, math.log1p(total) + 1])  # the last is that of all other words
        self.headers = [(name, *self._vector(x)) for name, texts in TEMPLATES.items() for x in texts]
        self.whole = [(name, self._vector(x)[0]) for name, x in whole_texts().items()]

    def _vector(self, text: str) -> tuple[np.ndarray, int]:
        tokens = _tokens(text)
        value = np.bincount([self.place[t] for t in tokens], minlength=len(self.weights)) * self.weights
        return value / np.sqrt(value @ value), len(tokens)

    def _length(self, tokens: list[str]) -> float:
        return math.sqrt(sum((n * self.weights[self.place.get(t, -1)]) ** 2 for t, n in Counter(tokens).items()))

    def find(self, text: str) -> tuple[str, float, float] | None:
        """Licence, cosine and share of the text that is licence.

        A text that is like a whole licence text is one, share 1. Else lines, sentences
        and, as headers may be wrapped, all runs of as many words as a header has are
        compared with headers if they hold a hint. All words of lines and sentences that
        match count in the share, of runs those that the header has too.
        """
        tokens, likely, lines = [], [], []
        for stretch in _STRETCH.split(text):
            found = _tokens(stretch)
            if found and _HINT.search(stretch):
                lines.append((len(tokens), len(tokens) + len(found)))
            tokens += found
        if not tokens:
            return None
        at = np.array([self.place.get(t, -1) for t in tokens])
        value = np.bincount(at % len(self.weights), minlength=len(self.weights)).astype(float)
        other = Counter(t for t, i in zip(tokens, at, strict=True) if i < 0)
        value[-1] = math.sqrt(sum(n * n for n in other.values()))
        value *= self.weights
        value /= np.sqrt(value @ value)
        cosine, name = min((-round(float(value[:-1] @ v[:-1]), 9), name) for name, v in self.whole)
        if -cosine >= self.alike:
            return name, -cosine, 1.0

        covered = np.zeros(len(tokens), bool)
        squares = np.concatenate([[0.0], np.cumsum(self.weights[at] ** 2)])
        for name, vector, size in self.headers:
            size = min(size, len(tokens))
            dots = np.concatenate([[0.0], np.cumsum(self.weights[at] * vector[at])])
            # a word's repeats make a run only longer, so this is the most its cosine can be
            most = (dots[size:] - dots[:-size]) / np.sqrt(squares[size:] - squares[:-size])
            runs = [(i, i + size, False) for i in np.flatnonzero(most >= self.least - 1e-6)]
            for start, stop, line in [*((*x, True) for x in lines), *runs]:
                dot = dots[stop] - dots[start]
                if dot <= 0 or not line and not _HINT.search(" ".join(tokens[start:stop])):
                    continue
                cosine = round(float(dot) / self._length(tokens[start:stop]), 9)
                if cosine >= self.least:
                    likely.append((-cosine, name))
                    covered[start:stop] |= line | (vector[at[start:stop]] > 0)
        if not likely:
            return None
        cosine, name = min(likely)
        return name, -cosine, float(covered.mean())


def headers(
    df: DataFrame, text: str, total: int, frequency: dict[str, int], least: float, alike: float = 0.95
) -> DataFrame:
    """``_key, licence, cosine, _share`` of the text of each key that is most like a template."""
    shared = df.sparkSession.sparkContext.broadcast(Matcher(total, frequency, least, alike))  # templates by words

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, found = batch.column(0), [shared.value.find(x.as_py()) for x in batch.column(1)]
        held = [i for i, f in enumerate(found) if f]
        columns = [pa.array([found[i][k] for i in held], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays([keys.take(pa.array(held, pa.int64())), *columns], names=names)

    names = ["_key", "licence", "cosine", "_share"]
    hinted = df.where(F.col(text).rlike(HINT)).select("_key", text)
    likely = map_arrow(hinted, run, "_key string, licence string, cosine double, _share double")
    best = F.min(F.struct((-F.col("cosine")).alias("c"), F.col("licence"), (-F.col("_share")).alias("s")))
    return likely.groupBy("_key").agg(best.alias("b")).select(
        "_key", F.col("b.licence").alias("licence"), (-F.col("b.c")).alias("cosine"), (-F.col("b.s")).alias("_share")
    )


def _parent(path: Column) -> Column:
    """The directory of a path, '' for the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``_dir`` with the licence of the nearest directory above it, itself included, that has one.

    Each directory is joined with the licensed ones by every beginning of its path,
    so the rows are directories times their depth.
    """
    parts = F.split("_dir", "/")
    above = F.explode(
        F.concat(
            F.array(F.lit("")),
            F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")),
        )
    ).alias("_at")
    pairs = directories.select("_dir", above).distinct()
    met = pairs.join(licensed.hint("merge"), "_at")
    nearest = F.max(F.struct(F.length("_at").alias("n"), F.col("_at"), F.col("_licence"))).alias("m")
    return met.groupBy("_dir").agg(nearest).select(
        "_dir", F.col("m._licence").alias("_licence"), F.col("m._at").alias("_from")
    )


def scan(
    df: DataFrame, path: str = "path", text: str = "text", least: float = 0.6, file_share: float = 0.8, alike: float = 0.95
) -> DataFrame:
    """All columns but the text with ``licence``, ``cosine`` and ``inherited_from``.

    A text's own licence is that of the licence text it is like as a whole, at a cosine
    of ``alike`` or more, or else of the header most like one of its lines, sentences or
    runs of words, at ``least`` or more, ties by name. A text that is like a whole licence
    text, or of which all that matches is ``file_share`` of the words or more, or whose
    name is LICENSE, LICENCE or COPYING, is a licence file of its directory; of several the
    one most alike counts, ties by name. Texts without a licence of their own inherit that
    of the nearest directory above; ``cosine`` is then null. Without one both are
    null. Rows of one path are one file and share their results; a null path is no path, so
    such a row has a licence only by its own text and no directory. Null and empty texts hold
    no header. Columns called like a result are dropped; all others are kept.

    Headers are looked for once and written. A directory with more than a thousandth of the rows
    is joined by broadcast, so no task gets all rows of one.
    """
    results = ["licence", "cosine", "inherited_from"]
    keep = [c for c in df.columns if c != text and c.lower() not in results]
    # a text without a path is its own file; the digest spreads such rows
    key = F.coalesce(col(path), F.concat(F.lit(_NOWHERE), F.sha2(F.coalesce(col(text), F.lit("")), 256)))
    named = df.select(key.alias("_key"), col(text).alias("_text"))
    total, frequency = document_frequency(named, "_text")
    own = pin(headers(named, "_text", total, frequency, least, alike))
    name = F.regexp_extract("_key", r"([^/]*)$", 1)
    is_file = (F.col("_share") >= file_share) | name.rlike(r"(?i)^(licen[sc]e|copying)(\.[a-z]+)?$")
    found = own.where(is_file & ~F.startswith("_key", F.lit(_NOWHERE)))
    first = F.min(F.struct((-F.col("cosine")).alias("c"), "licence"))
    licensed = found.groupBy(_parent(F.col("_key")).alias("_at")).agg(first["licence"].alias("_licence"))
    kept = F.struct(F.lit(0).alias("_none"), *map(col, keep)).alias("_row")  # so that no name can clash
    rows = df.select(kept, key.alias("_key"), _parent(col(path)).alias("_dir"))
    directories = rows.where(F.col("_dir").isNotNull()).groupBy("_dir").agg(F.count("*").alias("_rows"))
    directories = pin(directories)
    above = inherited(directories.select("_dir"), licensed)
    hot = directories.where(F.col("_rows") > total / _HOT).select("_dir")  # fewer than _HOT
    own = own.select("_key", "licence", "cosine").hint("merge")
    out = rows.join(own, "_key", "left")
    marked = out.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "_dir", "left")
    spread = F.col("_hot").isNotNull() | F.col("_dir").isNull()
    of_hot = F.broadcast(above.join(F.broadcast(hot), "_dir", "left_semi"))
    columns = ["_row", "licence", "cosine", "_licence", "_from"]
    out = marked.where(spread).join(of_hot, "_dir", "left").select(*columns).unionByName(
        marked.where(~spread).join(above.hint("merge"), "_dir", "left").select(*columns)
    )
    return out.select(
        *(F.col("_row").getField(c).alias(c) for c in keep),
        F.coalesce("licence", "_licence").alias("licence"),
        "cosine",
        F.when(F.col("licence").isNull(), F.col("_from")).alias("inherited_from"),
    )
