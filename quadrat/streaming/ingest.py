"""Incremental ingest: each run processes the files that arrived since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quadrat.plans import papers as P
from quadrat.session import cut_lineage
from quadrat.sources.readers import file_part, parse_record, with_line_numbers


def ingest_papers(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = P.PAPER_SCHEMA,
    year: int = 1980, exclude_doc: str = "Patent", lang: str = "en", detector=None,
) -> None:
    """Process the new files of ``source`` and stop.

    The batch jobs' transforms are reused unchanged.  Every micro-batch writes under its
    own batch number, so a batch that is repeated after a failure replaces itself.
    """
    lines = spark.readStream.text(source).select(
        F.col("value").alias("raw"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def write(batch: DataFrame, number: int) -> None:
        numbered = with_line_numbers(batch.withColumn("pos", F.monotonically_increasing_id()))
        good, bad = P.records(numbered.select("raw", file_part("file").alias("file_idx"), "line_no", parse_record("raw", schema).alias("record")))
        place = f"{target}/prepared/batch={number}"
        P.prepare(good, year, exclude_doc, detector).write.mode("overwrite").parquet(place)
        out = P.route(batch.sparkSession.read.parquet(place), lang, bad)
        out.subset.write.mode("overwrite").parquet(f"{target}/subset/batch={number}")
        out.errors.write.mode("overwrite").parquet(f"{target}/errors/batch={number}")
        out.titles.write.mode("overwrite").parquet(f"{target}/titles/batch={number}")

    stream = (
        lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    stream.awaitTermination()


def title_map(spark: SparkSession, target: str) -> DataFrame:
    """``(id, title)`` over all batches so far: the title of an id's latest batch.

    Batches are versions of the map. They are merged here by id, with one partial aggregation;
    :func:`compact_titles` merges them for good, so that the work does not grow with the number
    of runs. An empty folder is an error, as for any table.
    """
    versions = spark.read.option("recursiveFileLookup", "false").parquet(f"{target}/titles")
    latest = versions.groupBy("id").agg(F.max_by("title", "batch").alias("title"))
    return latest


def compact_titles(spark: SparkSession, target: str, upto: int) -> None:
    """Merge the title versions of batches ``0..upto`` into that of batch ``upto``.

    The merged version is written beside the others and only then put in their place; a run
    that is lost in between leaves versions that merge to the same map.
    """
    old = spark.read.parquet(f"{target}/titles").filter(F.col("batch") <= upto)
    merged = cut_lineage(old.groupBy("id").agg(F.max_by("title", "batch").alias("title")))
    merged.write.mode("overwrite").parquet(f"{target}/titles/batch={upto}")
    for (number,) in old.select("batch").distinct().filter(F.col("batch") < upto).collect():  # one row per batch
        spark.createDataFrame([], merged.schema).write.mode("overwrite").parquet(f"{target}/titles/batch={number}")
