"""From raw documents to encoded training text, stage by stage.

``STAGES`` lists names and functions; each function takes the session, the documents so far and the
folder of the tables, and returns a frame that is written as Parquet and read again for the next.
All stages but the last return the columns of documents.

Edge cases: null and empty texts are the empty text, which the classifier scores like any other
and which the mix never takes; a null ``doc_id`` is kept like any other; rows equal in all columns
count as one from the exact stage on; of equal or near texts with the same ``doc_id`` the lowest by
the remaining columns stays; very long texts are read whole; extra columns are carried along,
whatever their names, but for those that the encoding replaces; empty ``documents`` give an empty
result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftwell.llm.exact_dedup import drop_exact_duplicates
from siftwell.llm.mixing import mix
from siftwell.llm.pieces import encode_documents
from siftwell.llm.quality import drop_low_quality
from siftwell.llm.simhash import RADIUS, WORDS, drop_near_duplicates
from siftwell.sources.workspace import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link within three bits."""
    return drop_near_duplicates(docs, RADIUS, WORDS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their text."""
    return encode_documents(docs)


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mix", mixed),
    ("encode", encoded),
]

#: SQL can express neither the classifier nor the encoding; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
