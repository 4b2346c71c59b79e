"""The thin ``opN_<name>`` queries: each runs its operator over its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import table
from tallyframe.session import shared_dir


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.bpe import encode_documents

    coded = encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_multi_50k.tiktoken"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages"))


def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.exact_dedup import content_sort_dedup

    return content_sort_dedup(table(spark, sf_dir, "documents"), keep="max")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.quality import judge, trusted_ids

    return judge(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.warc import read_warc, write_warc

    folder = shared_dir(spark, "llm", "warc", unique=True)
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op7_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.sharding import stratified_shards

    placed = stratified_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("spans")


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.substring_dedup import remove_repeats

    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.ngram_join import jaccard_groups

    return jaccard_groups(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op11_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.harmonic import pack_harmonic

    return pack_harmonic(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.importance import importance_resample

    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.llm.repair import damaged, repair_conversations

    return repair_conversations(damaged(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_bpe, op2_packing, op3_html, op4_content_sort, op5_quality, op6_warc, op7_stratified, op8_toxicity, op9_suffix, op10_ngram_join,
             op11_harmonic, op12_importance, op13_repair]
    return {f.__name__: f for f in found}
