"""Training-data pipeline over ``documents``: stages that each call one operator of ``shockwell.llm``.

Every stage takes the stored result of the one before and works on all of it.
All but the last return the columns of ``documents``; extra columns travel
along.  Rows are told apart by their place in the stored files, so repeated
rows and rows without identifier are handled each for itself.  An empty table
passes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shockwell.llm import common, exact_dedup, packing, pii, simhash, toxicity
from shockwell.plans.storage import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.  Null text counts as empty; without labels none goes."""
    return toxicity.without_toxic(docs, common.table(spark, sf_dir, "labels"))


def kept_rows(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The whole rows that an operator keeps."""
    kept = decisions.filter("kept").selectExpr("row_id AS row_key")
    return rows.join(kept, "row_key", "left_semi").select("source.*")


def texts_of(rows: DataFrame) -> DataFrame:
    return rows.select("row_key", F.col("source.doc_id").alias("doc_id"), F.col("source.text").alias("text"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest identifier stays, of repeated rows one; null text counts as empty."""
    rows = common.keyed(docs)
    return kept_rows(rows, exact_dedup.exact_dedup(texts_of(rows), row_col="row_key"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, the one with the smallest identifier."""
    rows = common.keyed(docs)
    return kept_rows(rows, simhash.near_duplicates(texts_of(rows), row_col="row_key"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in angle brackets; ``n_chars`` follows the text; null text stays null."""
    found = pii.find_pii(docs, carry=True)
    masked = found.withColumn("masked", F.expr(pii.redacted("source.text", "array_sort(concat(base, found))")))
    changed = {"text": "masked", "n_chars": "cast(if(size(base) + size(found) = 0, source.n_chars, char_length(masked)) AS BIGINT)"}
    return masked.select(*(F.expr(changed[c]).alias(c) if c in changed else F.col("source").getField(c).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row per piece with its ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("PII", mask_personal_data),
    ("packing", pack),
]

#: SimHash and the learned stages have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
