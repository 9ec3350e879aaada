"""Exact duplicates by sorting contents.

Rows are dealt to range partitions by sampled splitters and sorted by their normalised text
within each; equal texts then lie next to each other and each row is compared with its
neighbour in full. The splitters see a bounded beginning of the text and a digest of the
whole, so that sampling never moves whole texts to the driver. Groups known to be large are
cut into parts of bounded size, sorted apart and merged by their winners.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from quadrat.session import cut_lineage

BLANK = r"[\x20\x09-\x0D]+"
LEAD = 32  # code points of the text among the sort keys that are sampled
PART_ROWS = 1000  # rows of one group that are sorted together


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    Texts are equal when identical without ASCII space characters; a null text is empty. The row
    with the longest original text stays, then the smallest key; a null key comes last, and of
    repeated rows with one key a single one stays. Other columns are not looked at.
    """
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "key", F.length("text").alias("size"), F.regexp_replace("text", BLANK, "").alias("norm")).withColumn("digest", F.sha2("norm", 256))
    large = cut_lineage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PART_ROWS)
                        .select("digest", F.ceil(F.col("n") / PART_ROWS).alias("parts")))
    dealt = rows.join(large, "digest", "left").withColumn("part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("key"), "parts")))
    dealt = dealt.withColumn("lead", F.left("norm", F.lit(LEAD)))
    near = W.partitionBy("lead", "digest", "part", "norm").orderBy(F.desc("size"), F.asc_nulls_last("key"))
    whole = near.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = dealt.repartitionByRange("lead", "digest", "part").select(
        "key", "size", "digest", "parts", "norm", F.row_number().over(near).alias("place"),
        F.first("key").over(whole).alias("keep_id"), F.count(F.lit(1)).over(whole).alias("group_size"))
    head = (F.col("place") == 1) & F.col("parts").isNotNull()
    local = cut_lineage(ranked.withColumn("norm", F.when(head, F.col("norm"))))
    best = F.min(F.struct((-F.col("size")).alias("shortness"), F.col("key").isNull().alias("unnamed"), F.col("key").alias("key")))
    merged = local.filter(head).groupBy("digest", "norm").agg(best.alias("best"), F.sum("group_size").alias("total"))
    out = local.join(merged.select("digest", F.col("best.key").alias("overall"), "total"), "digest", "left")
    keep = F.when(F.col("total").isNull(), F.col("keep_id")).otherwise(F.col("overall"))
    return out.withColumn("keep_id", keep).select(
        F.col("key").alias(key), "keep_id", F.coalesce("total", "group_size").alias("group_size"),
        ((F.col("place") == 1) & F.col("key").eqNullSafe(F.col("keep_id"))).alias("kept"), F.col("digest").alias("text_sha256"))
