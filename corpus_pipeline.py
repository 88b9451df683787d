"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.common import stored, table
from martwright.llm.mixing import take_share
from martwright.llm.near_dedup import Plan, keep_first
from martwright.llm.packing import pack_sequences
from martwright.llm.pii import redact
from martwright.llm.quality import fit_quality, keep_quality

# Expected tokens of each domain after mixing, as multiples of those before. Nothing that is surely toxic
# stays; clean text may grow, so that clean documents get rates above 1 and nearly all stay.
MULTIPLES = {"clean": 1.5, "junk": 0.25, "toxic": 0.0}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio against the labelled trusted texts.

    Null and empty texts fail the base. Without labels of both kinds only the base decides.
    """
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates (five words, 0.8).

    Documents without words all stay, as do rows with a null id; of rows that repeat an id one stays.
    """
    return keep_first(docs, Plan(words=5))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind; n_chars follows the text.

    Texts without spans stay as they are, null and empty ones too; repeated rows and null ids each keep
    their row, and spans are looked for in whole texts of any length. No documents give none.
    """
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that stay when the domains are brought to MULTIPLES of their tokens.

    A document stays or goes by the hash of its id and text, so repeated rows share their fate. Null and
    empty texts have no words and are judged like others. Without labels of two domains all stay.
    """
    return take_share(docs, table(spark, sf_dir, "labels"), MULTIPLES)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 4096 tokens.

    A null or empty text is one piece of the end token; repeated rows and null ids have pieces of their
    own; only a text longer than a sequence is cut. No documents give no pieces.
    """
    return pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("PII", pii),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", best_fit_packing),
]
# Fitted models and tokenizers decide here, which SQL cannot express; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are stored before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
