"""Documents to token ids: quality, near copies, source mix, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again for the next stage. Each works on all rows its predecessor kept. The first three
return whole rows with the columns they were given; the last returns doc_id, ids and n_ids.

Rows with NULL text are judged and compared as empty texts and leave with the mix, which takes
words; an empty table passes through. Other columns may be NULL and are passed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelift.llm import dart_minhash, fair_mix, quality, sentencepiece_viterbi
from quotelift.llm.common import materialize, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``labels``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return dart_minhash.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (none, once or twice)."""
    return fair_mix.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    return sentencepiece_viterbi.encode(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode),
]

#: The stages learn, hash and encode; SQL expresses none of them as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
