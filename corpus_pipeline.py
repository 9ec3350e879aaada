"""A training corpus from raw documents: known language, no repeated lines, no near copies, no benchmark text, token ids."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quadrat.llm import langid, lines, pieces, simhash, windows
from quadrat.llm.queries import tokenizer_path
from quadrat.session import cut_lineage, tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _stage(make: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that anybody may call alone: it sets the session as :func:`run` does, so that whole texts reach Python in bounded batches."""
    @functools.wraps(make)
    def tuned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return make(tune(spark), docs, sf_dir)

    return tuned


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from the rows outside the held-out fold.

    Null texts and texts without a letter go, rows without an id are judged like others, repeated
    rows alike, and very long texts as a whole.
    """
    model = langid.fit(docs.filter(~langid.held_out("doc_id")))
    return langid.predict(docs, model).filter("not rejected").select(*COLUMNS)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that another document keeps; ``n_chars`` follows the text.

    Every row stays: null texts become empty, repeated rows are treated alike, rows without an
    id are not changed.
    """
    kept = lines.drop_repeated_lines(docs).withColumn("text", F.col("kept"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (three-word shingles, two bits or fewer)."""
    return simhash.one_of_each_group(docs).select(*COLUMNS)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Null and empty texts hold none and stay, as do all repeats of a clean row."""
    found = windows.find(docs, windows.patterns(spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
    return found.filter(F.size("spans") == 0).select(*COLUMNS)


@_stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and digests of the ids and of the text decoded from them.

    One row for each row, repeated ones and those without an id too; a null text counts as empty.
    """
    coded = pieces.encode_decode(docs.select("doc_id", "text"), tokenizer_path())
    return coded.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), pieces.digest("ids").alias("ids_sha256"),
                        pieces.digest(F.col("decoded").cast("binary")).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

ORACLE_SQL = None  # fingerprints and token ids are beyond SQL; tests hold the rows against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
