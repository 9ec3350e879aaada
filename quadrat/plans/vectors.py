"""Embedding job: input variants, output splits, vectors by id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from quadrat.operators import infer as I
from quadrat.operators.groups import last_row
from quadrat.operators.numbering import floor_splits
from quadrat.sources.writers import write_vectors


def embed_papers(
    papers: DataFrame, target: str, key: str = "id", order: str | None = None, splits: int = 10,
    input_types: Mapping[str, Sequence[str]] = I.INPUT_TYPES, load=I.hashed_words, batch_rows: int = 16,
) -> DataFrame:
    """Compose the inputs, cut each variant into splits, embed, and write (variant, split, id, vector).

    Splits are worked out on the keys alone and joined to the papers, so a text is moved
    once at most, however many variants it has. Of a repeated id in a split the last one in
    ``order`` is embedded.
    """
    at = order or key
    rows = papers.withColumn("__row", F.struct(F.col(key).alias("key"), F.col(at).alias("at")))
    keys = I.compose_inputs(rows, "__row", input_types, spread=False).select("variant", F.col("__row.key").alias(key), F.col("__row.at").alias("__at"))
    cut = last_row(floor_splits(keys, ["__at"], splits, by=["variant"]), ["variant", "split", key], ["__at"])
    places = cut.groupBy(F.struct(F.col(key).alias("key"), F.col("__at").alias("at")).alias("__row")).agg(
        F.collect_list(F.struct("variant", "split")).alias("places"))  # at most one for every variant and split
    placed = rows.join(places, "__row").withColumn("__row", F.struct("__row.key", "__row.at", "places"))
    inputs = I.compose_inputs(placed, "__row", input_types, spread=False)
    here = F.filter("__row.places", lambda x: x["variant"] == F.col("variant"))
    inputs = inputs.select("variant", F.explode(F.transform(here, lambda x: x["split"])).alias("split"), F.col("__row.key").alias(key), F.col("__row.at").alias("__at"), "text")
    vectors = I.embed_texts(inputs, ["variant", "split", key, "__at"], "text", load, batch_rows, spread=False)
    write_vectors(vectors, target, key, "__at")
    return vectors.sparkSession.read.parquet(target)
