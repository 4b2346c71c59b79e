"""The operators as stages over a documents table: what each decides takes effect on the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, reach_workers, without_rows, written


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c != "doc_id")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the n-gram score go.

    Null and empty texts have too few words and go; repeated rows and null ids
    are judged like others (a null id is never trusted).
    """
    from tallyframe.llm.quality import judge, trusted_ids

    reach_workers(spark)
    others = _others(docs)
    renamed = docs.select("doc_id", *[F.col(c).alias(f"own_{c}") for c in others])
    judged = judge(renamed, trusted_ids(spark, sf_dir), text_col="own_text", carry=tuple(f"own_{c}" for c in others)).where("kept")
    return judged.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"own_{c}").alias(c) for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays.

    A null text equals the empty one and comes out empty; null ids lose against
    others; of repeated rows one stays.
    """
    from tallyframe.llm.exact_dedup import content_sort_dedup

    reach_workers(spark)
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    renamed = docs.select("doc_id", "text", *[F.col(c).alias(f"own_{c}") for c in others])
    kept = content_sort_dedup(renamed, keep="max", carry=tuple(f"own_{c}" for c in others), text_as="text").where("kept")
    return kept.select(*[c if c in ("doc_id", "text") else F.col(f"own_{c}").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a Jaccard similarity of 0.8, one row stays: that of the smallest doc_id.

    Rows are told apart by id and text.  Null ids come after all others; rows of
    one id in one group go by a hash of their texts; of repeated rows (equal id
    and text) the one with the smallest other columns stays.  Null, empty and
    wordless texts are linked with nothing and all stay.
    """
    from tallyframe.llm.ngram_join import jaccard_groups

    groups = written(jaccard_groups(docs, words=5, num=80, den=100, detail=True).where("n_shingles > 0"), "near_groups")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    heads = groups.where(own)
    tied = heads.groupBy("component").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
    gone = groups.where(~own).select("doc_id", "key").unionAll(
        heads.join(tied, "component").where("key <> first").select("doc_id", "key"))
    key = {"doc_id": F.col("doc_id"), "key": F.xxhash64(F.coalesce("text", F.lit("")))}
    kept = without_rows(docs, key, gone)
    repeated = groups.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "key")
    if repeated.isEmpty():
        return kept
    name = free_name(docs, "_others")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    single = without_rows(kept, key, repeated)
    rep_id, rep_key = free_name(docs, "_rep_id"), free_name(docs, "_rep_key")
    copies = (kept.join(repeated.select(F.col("doc_id").alias(rep_id), F.col("key").alias(rep_key)),
                        kept["doc_id"].eqNullSafe(F.col(rep_id)) & (key["key"] == F.col(rep_key)), "left_semi")
              .groupBy("doc_id", "text").agg(F.min(F.struct(*others) if others else F.lit(0)).alias(name)))
    return single.unionByName(copies.select(*[c if c in ("doc_id", "text") else F.col(f"{name}.`{c}`").alias(c) for c in docs.columns]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 200 bytes or more are cut out; bytes of characters cut in two go with them.

    Every row stays, also one that loses all its text; a null text becomes
    empty; repeated rows of 200 bytes or more lose their text, each of them;
    ``n_chars`` is counted anew.
    """
    from tallyframe.llm.substring_dedup import remove_repeats

    reach_workers(spark)
    others = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    renamed = docs.select("text", *[F.col(c).alias(f"own_{c}") for c in others])
    cut = remove_repeats(renamed, carry=tuple(f"own_{c}" for c in others), whole_characters=True)
    cut = cut.withColumn("text", F.col("kept").cast("string")).withColumn("n_chars", F.char_length("text").cast("long"))
    return cut.select(*[c if c in ("text", "n_chars") else F.col(f"own_{c}").alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: one row per piece; a null or empty text is one piece, null ids and repeated rows have their own."""
    from tallyframe.llm.packing import pack_documents
    from tallyframe.llm.queries import tokenizer_file

    reach_workers(spark)
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))
