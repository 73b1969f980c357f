"""The registered query of each operator, over its whole table, with its SQL where it has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelift.llm import (
    adaptive_scan,
    bloom_lm,
    dart_minhash,
    divergence,
    fair_mix,
    html_template,
    itq,
    prefix_trie,
    quality,
    sentencepiece_viterbi,
    shard_table,
    url_filter,
    winnow,
)
from quotelift.llm.common import table

#: Hosts whose pages make up the list of URLs in ``op10_url_filter``.
LISTED_HOSTS = "adult-|casino-|cheap-pills|free-bets|ads-track|spam-farm"


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode(table(spark, sf_dir, "documents"), check=True)


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.classes(table(spark, sf_dir, "documents"))


def op4_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return adaptive_scan.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op5_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table.assign(table(spark, sf_dir, "documents"))


def op6_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = fair_mix.queue(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "source_size", "target", "taken")


def op7_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.held_out_scores(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_copies(table(spark, sf_dir, "embeddings"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = pages.select("url").filter(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS))
    return url_filter.judge(pages, listed)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_html_template": op1_html_template,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_adaptive_scan": op4_adaptive_scan,
    "op5_shard_table": op5_shard_table,
    "op6_fair_mix": op6_fair_mix,
    "op7_bloom_lm": op7_bloom_lm,
    "op8_quality": op8_quality,
    "op9_itq": op9_itq,
    "op10_url_filter": op10_url_filter,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_divergence": op12_divergence,
    "op13_winnow": op13_winnow,
}
