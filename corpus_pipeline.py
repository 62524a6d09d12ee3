"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; its result is written as
Parquet and reread as the next one's ``docs``. All stages but the last return the columns they got. None of
them stumbles over NULLs, empty texts, repeated rows, empty tables or extra columns of any name; the docstrings
of the operators say what each case gives.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import langid, mixing, packing, simhash, substring
from shelfmark.llm.common import columns_of, free_name, read_table, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach.

    Rejected are texts that are NULL or have no letter, and texts whose two best languages are as good as even.
    Without any labelled document only the former go.
    """
    model = langid.fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, model)
    language = F.col(free_name(docs, "language"))
    return found.filter((language["lang"] != langid.UNKNOWN) & ~language["ambiguous"]).select(*columns_of(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints that chains of at most two differing bits join."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages of 35 words or more that occur twice; ``n_chars`` follows.

    A document that loses all its words stays, with an empty text.
    """
    cleaned = substring.remove_repeated(docs)
    result = F.col(free_name(docs, "dedup"))
    changed = cleaned.withColumn("text", result["text"])
    if "n_chars" in docs.columns:
        length = F.when(result["n_removed"] > 0, F.length(result["text"])).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return changed.select(*columns_of(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(packing.BYTE_BPE))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no language identification, fingerprints or tokenizer; tests/llm holds brute-force versions.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
