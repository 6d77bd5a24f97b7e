"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import os
from functools import cache
from importlib.util import find_spec

from pyspark.sql import functions as F

from shopworth.llm import (
    byte_bpe,
    cross_polytope,
    langid,
    lexical,
    licences,
    line_dedup,
    lz,
    near_dup,
    packing,
    phrases,
    quality,
    secrets,
    toxicity,
)
from shopworth.llm.common import load

#: Where the public tokenizers lie; the files are never copied.
TOKENIZERS = os.environ.get("TOKENIZER_DIR")
END_ID = 2
SEQUENCE = 4096


OP11_SQL = r"""
WITH terms AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
),
held AS MATERIALIZED (SELECT d, doc_id, t, len(t)::BIGINT AS n FROM terms WHERE len(t) > 0),
size AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM held),
tf AS MATERIALIZED (
  SELECT d, doc_id, n, t, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(t) AS t FROM held) GROUP BY ALL
),
weight AS (
  SELECT t, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY t
),
asked AS (
  SELECT q, item_id, t, count(*) AS times
  FROM (
    SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark
  )
  GROUP BY ALL
),
scored AS (
  SELECT q, item_id, d, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weight USING (t), size
  GROUP BY ALL
),
placed AS (
  SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 10
"""


OP12_SQL = r"""
WITH pieces AS MATERIALIZED (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
words AS MATERIALIZED (
  SELECT p, lang, i, word FROM (
    SELECT p, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i
    FROM (SELECT p, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces)
  )
),
windows AS MATERIALIZED (
  SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3,
    lead(word, 3) OVER o AS w4, lead(word, 4) OVER o AS w5
  FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM windows
  UNION ALL SELECT lang, 2, concat_ws(' ', w1, w2) FROM windows WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3) FROM windows WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) FROM windows WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, concat_ws(' ', w1, w2, w3, w4, w5) FROM windows WHERE w5 IS NOT NULL
),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS p1, array_to_string(w[cut + 1:], ' ') AS p2
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
),
scored AS (
  SELECT c.lang, c.phrase, a, l.f AS l, r.f AS r, n, cut,
    ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = p1 JOIN f r ON r.lang = c.lang AND r.phrase = p2
    JOIN total t ON t.lang = c.lang
),
worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
alone AS (
  SELECT * FROM worst w WHERE NOT EXISTS (
    SELECT 1 FROM candidates c
    WHERE c.lang = w.lang AND c.phrase <> w.phrase AND 100 * c.a >= 100 * w.a
      AND contains(' ' || c.phrase || ' ', ' ' || w.phrase || ' ')
  )
),
placed AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
  FROM alone
)
SELECT * FROM placed WHERE rank <= 2000
"""


OP13_SQL = r"""
WITH lines AS MATERIALIZED (
  SELECT d, doc_id, i, line, translate(trim(line, E' \t\n\x0B\f\r'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT d, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
    FROM (
      SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    )
  )
),
common AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT d) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.key = c.key
GROUP BY d, doc_id
"""


@cache
def tokenizer_file(name: str) -> str:
    folder = TOKENIZERS or os.path.dirname(find_spec("public_tokenizers").origin)
    return os.path.join(folder, name)


def op1_packing(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"), END_ID, SEQUENCE)
    return packing.with_crc32(pieces).drop("ids")


def op2_lempel_ziv(spark, d):
    return lz.edited_fingerprints(load(spark, d, "documents").select("doc_id", "text"))


def op3_toxicity(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return toxicity.predict(docs, toxicity.fit(docs, load(spark, d, "labels")), keep=["doc_id"])


def op4_language(spark, d):
    docs = load(spark, d, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where("not held_out"))
    return langid.predict(docs, model, keep=["doc_id", "held_out"])


def op5_cross_polytope(spark, d):
    return cross_polytope.near_vectors(load(spark, d, "embeddings"), keep=["vec_id"])


def op6_licences(spark, d):
    docs = load(spark, d, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licences.scan(docs.select("doc_id", path.alias("path"), "text"))


def op7_byte_bpe(spark, d):
    docs = load(spark, d, "documents")
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.with_spans_hash(byte_bpe.encode(docs, ranks, keep=["doc_id"]))
    return byte_bpe.digest(byte_bpe.decode(encoded, ranks))


def op8_secrets(spark, d):
    found = secrets.scan(load(spark, d, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(secrets.count("base_spans", k).alias(f"n_{k}") for k in secrets.BASE),
        F.sha2(secrets.as_text("base_spans"), 256).alias("base_sha256"),
        secrets.as_text("spans").alias("spans"),
    )


def op9_minhash(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs, words=3, percent=85).drop("first_copy")


def op10_quality(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs), keep=["doc_id"])


def op11_lexical(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return lexical.search(docs, load(spark, d, "benchmark"))


def op12_phrases(spark, d):
    return phrases.mine(load(spark, d, "documents"))


def op13_line_dedup(spark, d):
    cut = line_dedup.dedup(load(spark, d, "documents"), keep=["doc_id"])
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def queries():
    return {
        "op1_packing": op1_packing,
        "op2_lempel_ziv": op2_lempel_ziv,
        "op3_toxicity": op3_toxicity,
        "op4_language": op4_language,
        "op5_cross_polytope": op5_cross_polytope,
        "op6_licences": op6_licences,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_secrets": op8_secrets,
        "op9_minhash": op9_minhash,
        "op10_quality": op10_quality,
        "op11_lexical": op11_lexical,
        "op12_phrases": op12_phrases,
        "op13_line_dedup": op13_line_dedup,
    }


def oracle_sql():
    return {"op11_lexical": OP11_SQL, "op12_phrases": OP12_SQL, "op13_line_dedup": OP13_SQL}
