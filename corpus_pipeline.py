"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept, written and read again, and applies one
operator of ``marquee.llm`` with its decisions: poor documents go, one of equal texts stays, one of
each group of near duplicates stays, secrets are masked, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import cuckoo, packing, quality, secrets, simhash
from marquee.llm.common import table
from marquee.session import stages


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose base rules and likelihood ratio pass; the model is fitted on these documents and ``labels``.

    A null or empty text has no words and goes. Every row is judged by its own text, so repeated rows and ids
    stay or go together. An empty table stays empty.
    """
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return cuckoo.drop_exact_duplicates(docs)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that fingerprints of four-word shingles link at four or fewer bits, the one with the smallest id."""
    return simhash.keep_one(docs, size=4, radius=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan finds masked and ``n_chars`` counted anew."""
    masked = secrets.mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its ids and its place in a sequence of 1024 tokens.

    A null text is empty and gives one piece with the end id; rows that repeat an id or text are documents of
    their own. An empty table gives no row.
    """
    return packing.pack_documents(docs, capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_quality),
    ("exact dedup", keep_distinct),
    ("SimHash near dedup", keep_one_of_near),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]

#: Likelihood ratios, SimHash and byte-level BPE are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed rows, saved. A stage's documents are deleted once the next stage is written."""
    with stages(spark) as whole:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            with stages(spark) as own:
                after = own.keep(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
            whole.release(docs)
            docs = after
        return whole.keep(docs)
