"""A corpus pipeline over ``documents``: STAGES of (name, function).

Every function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of
documents.

1. language    texts whose language is unknown or mixed beyond MIN_SHARE go
2. quality     texts that break a base rule, or are of a host that fails too often, go
3. near_dedup  of each component of near duplicates one row stays
4. mix         sources are taken to target weights: a row for each pass over a document
5. encode      SentencePiece ids, and the text that they decode to

Empty tables pass through. Rows with nulls are judged as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import encoding, language, mixing, near_dup, quality
from cartwheel.llm.common import documents, with_package, written

#: Least share of a text's letters in its main language.
MIN_SHARE = 0.5


def _columns(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a known language that has at least MIN_SHARE of their letters."""
    model = language.train(language.labelled_rows(docs))
    found = language.identify(docs, model, "__lang", "__share", "__spans")
    return found.where((F.col("__lang") != language.UNKNOWN) & (F.col("__share") >= MIN_SHARE)).select(*_columns(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that pass the rules, of hosts that pass."""
    return quality.judge(docs, "source").where("__kept").select(*_columns(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates."""
    return near_dup.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, token_ids, n_tokens and the decoded text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encoding.encode_documents(docs.select("doc_id", "text", "lang", "source"), path)
    decoded = encoding.decode_documents(encoded.drop("text"), path)
    return decoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("language", with_package(language_stage)),
    ("quality", with_package(quality_stage)),
    ("near_dedup", with_package(near_dedup_stage)),
    ("mix", with_package(mix_stage)),
    ("encode", with_package(encode_stage)),
]

#: The model of the first stage, signatures and subword merges are beyond SQL.
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
