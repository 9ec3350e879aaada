"""Texts reach Python in bounded batches, lines get their numbers without a shuffle, papers are joined before they are indexed."""

from pyspark.sql import functions as F

from quadrat.functions import language as L
from quadrat.queries.registry import Tables
from quadrat.queries.text import as_papers, by_language
from quadrat.session import RUNTIME_CONF
from quadrat.sources.readers import with_line_numbers


def test_detector_sees_few_texts_at_once(spark):
    def load():
        return lambda texts: [str(len(texts))] * len(texts)

    df = spark.range(2000, numPartitions=1).select(F.col("id").cast("string").alias("t"), "id", F.array("id").alias("other"))
    got = L.detect_with(df, "t", load).collect()
    assert max(int(r.lang) for r in got) <= L.AT_ONCE
    assert [(r.t, r.id, r.other) for r in sorted(got, key=lambda r: r.id)] == [(str(i), i, [i]) for i in range(2000)]
    assert "spark.sql.execution.arrow.maxBytesPerBatch" in RUNTIME_CONF


def test_lines_are_not_shuffled_for_their_numbers(spark):
    raw = spark.createDataFrame([("a", 0, 7, "x"), ("a", 0, 8, "y"), ("a", 50, 3, "z"), ("b", 0, 1, "w")], "file string, block bigint, pos bigint, raw string")
    numbered = with_line_numbers(raw)
    assert sorted((r.raw, r.line_no) for r in numbered.collect()) == [("w", 0), ("x", 0), ("y", 1), ("z", 2)]
    plan = numbered._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_papers_by_language_keep_every_pair_of_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", "en"), (1, "c", "es"), (2, "d", None), (None, "e", "en")], "doc_id bigint, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    t = Tables(spark, str(tmp_path))
    got = as_papers(by_language(t), "lang")
    want = as_papers(docs).join(docs.select(F.col("doc_id").cast("string").alias("id"), "lang"), "id").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 5
