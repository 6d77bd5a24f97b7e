"""Lexical search, phrases and line dedup against brute force, SQL and themselves."""

import glob
import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import WORDS

from shopworth.llm import lexical, line_dedup, phrases, queries

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    result = con.execute(SQL[name])
    columns = [c[0] for c in result.description]
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(result.fetchall(), key=str)


# --- Search ------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_search(rows, items, k):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            m = 25 + (75 * n * n_docs) // total
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        for rank, (score, known, i) in enumerate(sorted(scores)[:k], 1):
            found.append((item, rank, i if known else None, -score))
    return found


def test_terms():
    assert lexical.terms("Ab-cÉd ß\tx_1\x7f—y") == ["ab".encode(), "cÉd".encode(), "ß".encode()] + [
        b"x",
        b"1",
        "—y".encode(),
    ]
    assert lexical.terms(None) == lexical.terms("") == lexical.terms("-- ..") == []


def corpus(draw, n):
    rows = []
    for i in range(n):
        words = draw.choices(WORDS, [1 / (j + 1) for j in range(len(WORDS))], k=draw.randrange(1, 60))
        rows.append((i, " ".join([*words, f"rare{draw.randrange(40)}"])))
    return rows


@pytest.mark.parametrize("k", [1, 10])
def test_search_equals_brute_force(spark, documents, monkeypatch, k):
    monkeypatch.setattr(lexical, "SHARD", 64)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    draw = random.Random(3)
    rows = corpus(draw, 500)
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a third are copies: ties by id
    rows += [rows[3], rows[3], (None, rows[5][1]), (2000, None), (2001, ""), (2002, "...")]
    rows.append((2003, "alpha rare1 " * 20_000))
    items = [(i, " ".join(t.split()[:12]).upper()) for i, t in corpus(draw, 40)]
    items += [(0, "alpha alpha rare1"), (90, None), (91, "unheard"), (92, rows[7][1]), (None, "beta rare2")]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id int, text string, q int, score string")
    found = lexical.search(documents(rows), asked, k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_search(rows, items, k), key=str)


def test_search_in_blocks_of_items_gives_the_same(documents, spark, monkeypatch):
    draw = random.Random(5)
    docs = documents(corpus(draw, 200))
    items = spark.createDataFrame(corpus(draw, 12), "item_id bigint, text string")
    whole = sorted(lexical.search(docs, items, 3).collect())
    monkeypatch.setattr(lexical, "TERMS", 30)
    assert len(list(lexical.query_blocks(items, "item_id", "text"))) > 3
    assert sorted(lexical.search(docs, items, 3).collect()) == whole


def test_search_text_ids_and_empty_tables(documents, spark):
    docs = spark.createDataFrame([("b", "one two"), ("B", "one two"), (None, "one"), ("é", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "two ONE")], "item_id string, text string")
    assert [tuple(r)[:3] for r in lexical.search(docs, items).orderBy("rank").collect()] == [
        ("i", 1, "B"),
        ("i", 2, "b"),
        ("i", 3, None),
    ]
    none = documents([])
    asked = spark.createDataFrame([(1, "x")], "item_id bigint, text string")
    assert lexical.search(none, asked).count() == 0
    assert lexical.search(documents([(1, None)]), asked).count() == 0
    assert lexical.search(documents([(1, "x")]), asked.limit(0)).count() == 0


def test_blocks_are_skipped_and_summaries_bound_their_documents(documents, spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    rows = corpus(random.Random(9), 600)
    items = spark.createDataFrame([(i, rows[i * 37][1]) for i in range(10)], "item_id bigint, text string")
    asked = next(lexical.query_blocks(items, "item_id", "text"))
    counted = lexical.counts(documents(rows), asked.vocabulary, "doc_id", "text")
    documents_, occurrences, df = lexical.statistics(counted, len(asked.vocabulary))
    weight = lexical.weights(documents_, df)
    table = lexical.vectors(counted, documents_, occurrences, weight)
    theta, greatest = lexical.thresholds(table, asked, weight, df, 10)
    needed = lexical.leading(asked, weight, greatest, theta)
    tested = skipped = 0
    for row in lexical.index(table, asked, needed, len(weight)).collect():
        _, starts, tid, value, term, first, members, edges, at, most = (
            np.frombuffer(row[c], np.int32) for c in ("place", *lexical._LISTS)
        )
        held = lexical._Rows(starts.astype(np.int64), tid, value)
        for q, vector in enumerate(asked.vectors):
            query = lexical._dense(vector, weight, np.zeros(len(weight), np.int64))
            for b in np.flatnonzero(np.isin(term, needed[q])):
                bound = (query[at[edges[b] : edges[b + 1]]] * most[edges[b] : edges[b + 1]]).sum()
                block = members[first[b] : first[b + 1]].astype(np.int64)
                assert 1 <= len(block) <= 4
                assert held.scores(block, query).max() <= bound
                tested, skipped = tested + 1, skipped + (bound < theta[q])
    assert 0 < skipped < tested


# --- Phrases -----------------------------------------------------------------


def plain_phrases(rows, least, top, longest=5):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        f[lang, tuple(words[i : i + k])] += 1
    many = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    found = []
    for (lang, words), a in many.items():
        inside = any(
            other == lang and len(w) > len(words) and 100 * b >= 100 * a
            and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))
            for (other, w), b in many.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranks, result = Counter(), []
    for lang, score, a, phrase, left, right in sorted(found):
        ranks[lang] += 1
        if ranks[lang] <= top:
            result.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return result


def phrase_rows(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = draw.choices(WORDS, [3 / (j + 1) for j in range(len(WORDS))], k=draw.randrange(0, 50))
        glue = draw.choices([" ", "  ", "\t", ", ", ".", "\n", "\x1c"], [20, 2, 2, 1, 1, 1, 1], k=len(words))
        text = "".join(w + g for w, g in zip(words, glue, strict=True))
        rows.append((draw.choice(["en", "fr", None, "und", "a.b"]), text + " New York City hall"))
    return rows


@pytest.mark.parametrize(("least", "top"), [(5, 10_000), (30, 7)])
def test_phrases_equal_brute_force(spark, monkeypatch, least, top):
    rows = phrase_rows(least, 300)
    rows += [(None, None), ("en", ""), ("xx", "?!"), rows[0], rows[0]]
    rows += [("copies", "ÄB äb  Straße straße one\x00two")] * 60
    rows.append(("long", "la di da " * 30_000))
    docs = spark.createDataFrame([(t, lang, 1, "x") for lang, t in rows], "text string, lang string, n int, score string")
    expected = plain_phrases(rows, least, top)
    for together, load, filters in ((phrases.TOGETHER, phrases.LOAD, phrases.FILTERS), (500, 1, 1), (2000, 10**9, 2)):
        monkeypatch.setattr(phrases, "TOGETHER", together)
        monkeypatch.setattr(phrases, "LOAD", load)
        monkeypatch.setattr(phrases, "FILTERS", filters)
        found = phrases.mine(docs, least=least, top=top)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == expected


def test_rows_of_windows_do_not_grow_with_frequent_phrases(spark, monkeypatch):
    """A worker sums up windows and hands them on in pieces; each then comes out once."""
    pairs, least = [f"x{i} y{i}" for i in range(3000)], 12
    rows = [(lang, ". ".join(pairs)) for lang in ("en", "fr") for _ in range(least)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2).cache()
    made, through = [], phrases.map_batches

    def noted(*args):
        made.append(through(*args))
        return made[-1]

    monkeypatch.setattr(phrases, "map_batches", noted)
    monkeypatch.setattr(phrases, "pin", lambda df: df)
    for held in (None, 1000):  # with the second, a worker's languages do not meet
        if held:
            monkeypatch.setattr(phrases, "HELD", held)
        made.clear()
        found, totals = phrases.frequent_phrases(docs, "lang", "text", longest=5, least=least)
        counts = {(r.lang, r.phrase, r.k): r.f for r in found.collect()}
        assert counts == {(g, x, len(x.split())): least for g in ("en", "fr") for p in pairs for x in (p, *p.split())}
        assert sorted(totals.collect()) == [(g, least * 2 * len(pairs)) for g in ("en", "fr")]
        emitted = next(df for df in made if {"windows", "w1"} & set(df.columns))
        assert emitted.count() <= 2 * 2 << phrases._PIECES  # workers' sums, languages, pieces
        assert made[-1].count() == made[-1].select("lang", "w1", "w2").distinct().count() == 2 * 2 * len(pairs)


def test_phrases_of_nothing(documents):
    assert phrases.mine(documents([])).count() == 0
    assert phrases.mine(documents([(1, None), (2, "one two")])).count() == 0


# --- Lines -------------------------------------------------------------------


def plain_cut(rows, common, least=1):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(LOWER)

    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(key(x)) < least or held[key(x)] < common]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def line_rows(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lines = [f"line {draw.randrange(400)}" for _ in range(draw.randrange(6))]
        lines += [draw.choice(["  Menu\t", "menu", "MENU\r", "", " ", "é", "É"]) for _ in range(3)]
        draw.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("broadcast", [line_dedup.BROADCAST, -1])
@pytest.mark.parametrize("least", [1, 5])
def test_cut_equals_brute_force(documents, monkeypatch, broadcast, least):
    monkeypatch.setattr(line_dedup, "BROADCAST", broadcast)
    monkeypatch.setattr(line_dedup, "SHARD", 40)
    rows = line_rows(1, 300)
    rows += [(None, None), (None, "menu"), (7, ""), rows[3], rows[3]]
    rows += [(1000 + i, "one same line\nand another") for i in range(150)]
    rows.append((5000, "menu\n" * 50_000 + "x" * 100_000))
    found = line_dedup.dedup(documents(rows), common=5, least=least)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "ids", "score", "a.b", "kept", "n_lines", "n_dropped"]
    got = found.select("doc_id", "kept", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_cut(rows, 5, least), key=str)


def test_lines_of_nothing(documents):
    assert line_dedup.dedup(documents([])).count() == 0


def state(index):
    refs = sorted((bytes(k), n) for k, n in index.refs.collect())
    rows = [(s, bytes(a), bytes(b)) for s, a, b in index.filters.collect()]
    probe = line_dedup._Probe(rows, index.shards)
    return refs, [c for c in (probe.common([k])[0] for k, _ in refs)]


def test_insertions_and_deletions_can_be_undone(documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD", 60)
    first, second, third = (documents(line_rows(seed, 120)) for seed in (11, 12, 13))
    one = line_dedup.empty(first, common=6).insert(first)
    two = one.insert(second).insert(third)
    back = two.delete(third).delete(second)
    assert state(back) == state(one)
    assert state(one.insert(second)) == state(line_dedup.empty(first, common=6).insert(first.union(second)))
    for index, docs in ((one, first), (two, second), (back, first)):
        refs, probed = state(index)
        assert probed == [n >= 6 for _, n in refs]
        assert line_dedup.cut(docs, index, keep=["doc_id"]).count() == 120
    assert state(back.delete(first)) == ([], [])
    assert state(back.delete(first).delete(first)) == ([], [])  # counts do not fall below none


def test_cuckoo_filter_forgets_what_is_deleted():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (5000, 2), np.uint64)
    made = line_dedup.Cuckoo.of(keys[:4000])
    assert made.holds(keys[:4000]).all() and not made.holds(keys[4000:]).any()
    made.delete(keys[:2000])
    assert not made.holds(keys[:2000]).any() and made.holds(keys[2000:4000]).all()
    assert made.insert(keys[4000:]) and made.holds(keys[2000:]).all()
    full = line_dedup.Cuckoo(np.zeros(64, np.uint32))
    assert not full.insert(keys[:200])  # the caller then makes a larger one


def test_doubtful_keys_are_told_apart(documents, monkeypatch):
    """With fingerprints of two values nearly every key looks common, and results stay exact."""
    parts = line_dedup._parts
    monkeypatch.setattr(line_dedup, "_parts", lambda k: (parts(k)[0], parts(k)[1] % np.uint32(2) + np.uint32(1), parts(k)[2]))
    keys = line_dedup.as_numbers([line_dedup.line_key(f"line {i}".encode(), 1) for i in range(400)])
    made = line_dedup.Cuckoo.of(keys[:40])
    assert made.holds(keys[40:]).mean() > 0.3
    none = np.zeros((0, 2), np.uint64)
    assert line_dedup.Cuckoo.of(none).holds(keys).sum() == 0
    held = [keys[i].tobytes() for i in range(40, 400) if made.holds(keys[i : i + 1])[0]]
    probe = line_dedup._Probe([(0, made.slots.tobytes(), b"".join(held))], 1)
    assert probe.common([k.tobytes() for k in keys]) == [True] * 40 + [False] * 360
