"""Proportional stratified interleaving into shards, with DataFrame functions only.

Rows of each source are shuffled by a seeded hash and ranked; a row's
fractional rank is (rank - u) / (rows of its source), where u in (0, 1) is a
seeded constant of the source (one half for all would put every source of a
single row at the same place).  All rows sorted by fractional rank form one
sequence in which every stretch holds the sources in their global proportions;
cutting it into equal stretches gives shards whose row counts differ by one at
most and whose mixtures match the whole.

Neither ranking sorts a source or the table in one task.  The seeded hash cuts
each source into buckets of at most about ``bucket_rows`` rows, and the
fractional rank cuts the sequence likewise; a row's rank is the number of rows
in earlier buckets (from a table of bucket counts) plus its row number in its
own bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import written

BUCKET_ROWS = 20_000
HOT_SHARE = 10               # rows equal to more than a tenth of a bucket are spread
HASH_SPACE = 1 << 31
OFFSET_SPACE = 1 << 20


def stratified_shards(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                      shards: int = 16, seed: int = 42, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``id_col``, ``source``, size, text_crc32, shard and slot (gapless from 0 in each shard) per row.

    Defined cases: a null text has size 1 and the checksum of the empty text; a
    null source is a source of its own; repeated rows and null ids each take a
    slot (ties are broken by every column of the result, so equal rows are
    interchangeable); an empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("_size"), F.crc32(text.cast("binary")).alias("_crc"))
    rows = rows.withColumns({
        "_mix": F.xxhash64(F.lit(seed), "_id", "_crc"),                                # the seeded shuffle
        "_stratum": F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("n")),           # null is a stratum too
        "_row": F.monotonically_increasing_id()})
    rows = written(rows, "shard_rows")        # narrow rows: no later step reads the texts again
    n_rows = rows.count()
    buckets = max(1, -(-n_rows // bucket_rows))
    # Equal rows share a place in the shuffle; many of them are spread by their row numbers.  At most
    # HOT_SHARE * buckets hashes are that frequent.
    hot = (rows.groupBy("_mix").agg(F.count(F.lit(1)).alias("_n_equal")).where(F.col("_n_equal") > bucket_rows // HOT_SHARE).select("_mix", F.lit(True).alias("_hot")))
    rows = (rows.join(F.broadcast(hot), "_mix", "left")
            .withColumn("_mix", F.when(F.col("_hot"), F.xxhash64("_mix", "_row")).otherwise(F.col("_mix"))).drop("_hot", "_row"))

    # 1. Rank inside the source: offset of the hash bucket + row number in it.
    rows = rows.withColumn("_bucket", F.expr(f"pmod(_mix, {HASH_SPACE}L) * {buckets}L div {HASH_SPACE}L"))
    by_stratum = Window.partitionBy("_stratum")
    offsets = (rows.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_in"))
               .select("_stratum", "_bucket",
                       (F.sum("_in").over(by_stratum.orderBy("_bucket")) - F.col("_in")).alias("_before"),
                       F.sum("_in").over(by_stratum).alias("_n")))
    in_bucket = Window.partitionBy("_stratum", "_bucket").orderBy("_mix", "_id", "_crc", "_size")
    ranked = (rows.join(offsets, ["_stratum", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.row_number().over(in_bucket)))
    u = (F.expr(f"pmod(xxhash64({seed}, _stratum), {OFFSET_SPACE}L)") + F.lit(0.5)) / F.lit(float(OFFSET_SPACE))
    ranked = (ranked.withColumn("_frac", (F.col("_rank") - u) / F.col("_n"))
              .withColumn("_part", F.least(F.floor(F.col("_frac") * F.lit(buckets)), F.lit(buckets - 1)).cast("long"))
              .drop("_bucket", "_before", "_n", "_rank"))
    ranked = written(ranked, "shard_ranks")

    # 2. Place in the whole sequence, the same way over the buckets of the fractional rank.
    places = (ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_in"))
              .select("_part", (F.sum("_in").over(Window.orderBy("_part")) - F.col("_in")).alias("_before")))
    in_part = Window.partitionBy("_part").orderBy("_frac", "_mix", "_id", "_crc", "_size", "_stratum")
    placed = (ranked.join(places, "_part")
              .withColumn("_place", F.col("_before") + F.row_number().over(in_part) - 1)
              .withColumn("_shard", F.expr(f"_place * {shards}L div {max(n_rows, 1)}L")))

    # 3. Cut: shard s starts at place ceil(s * rows / shards).
    start = F.expr(f"(_shard * {n_rows}L + {shards - 1}L) div {shards}L")
    return placed.select(
        F.col("_id").alias(id_col), F.col("_source").alias("source"), F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"), F.col("_shard").cast("int").alias("shard"),
        (F.col("_place") - start).alias("slot"))
