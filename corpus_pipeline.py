"""From raw documents to packed training sequences.

Each stage gets the documents its predecessor kept and returns them in the same
columns; the last returns the pieces of the packed sequences. A stage's result is
written and read again before the next begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopworth.llm import langid, near_dup, packing, quality, secrets
from shopworth.llm.common import col, load
from shopworth.llm.queries import END_ID, SEQUENCE, tokenizer_file
from shopworth.sources import pin

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Columns that stages read; the others travel in one, so that no name can clash with a result.
_READ = ("doc_id", "text", "lang")


def _bundled(docs: DataFrame) -> DataFrame:
    rest = [F.lit(0).alias("_none"), *(col(c) for c in docs.columns if c not in _READ)]
    return docs.select(F.struct(*rest).alias("_rest"), *_READ)


def _restored(df: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""

    def restored(name: str) -> Column:
        return changed.get(name, F.col(name) if name in _READ else F.col("_rest").getField(name))

    return df.select(*(restored(c).alias(c) for c in docs.columns))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier does not reject."""
    scored = quality.score(_bundled(docs), quality.fit(docs))
    return _restored(scored.where("kept"), docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with confidence."""
    model = langid.fit(docs.where(~langid.held_out()))
    return _restored(langid.predict(_bundled(docs), model).where("NOT rejected"), docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    found = near_dup.near_duplicates(_bundled(docs), words=5, percent=80, keep=["_rest", *_READ])
    return _restored(found.where("first_copy"), docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret and ``n_chars`` counted anew."""
    found = secrets.scan(_bundled(docs), keep=["_rest", *_READ])
    clean = found.withColumn("_clean", secrets.redacted("text", "spans"))
    changed = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        number = F.length("_clean").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("spans") > 0, number).otherwise(F.col("_rest").getField("n_chars"))
    return _restored(clean, docs, **changed)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_file("word_bpe_49k.json"), END_ID, SEQUENCE)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", without_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: SQL cannot express the learned and the hashed stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written before the next."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
