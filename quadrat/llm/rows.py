"""Row-wise Python steps over Arrow batches, shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


STEP = 512


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns called like ``names`` in any letter case: results replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def append_columns(df: DataFrame, column: str, fields: str, make: Callable[[], Callable[[list], list[tuple]]]) -> DataFrame:
    """Add ``fields`` computed from the values of ``column``.

    ``make`` runs once per task and returns a function from a list of values to a list of
    tuples, one per value. Other columns pass through untouched; one whose name clashes with
    a new field is replaced by it.
    """
    added = T._parse_datatype_string(fields)
    kept = without(df, [f for f in added.names if f.lower() != column.lower()])
    schema = T.StructType([f for f in kept.schema if f.name.lower() not in {a.lower() for a in added.names}] + list(added))
    position = [c.lower() for c in kept.columns].index(column.lower())
    arrow = to_arrow_schema(added)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):  # few rows at a time exist as Python objects
                batch = whole.slice(at, STEP)
                found = apply(batch.column(position).to_pylist())
                old = [i for i, n in enumerate(batch.schema.names) if n.lower() not in {a.lower() for a in added.names}]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in old] + [pa.array(c, f.type) for c, f in zip(zip(*found), arrow)],
                    names=[batch.schema.names[i] for i in old] + arrow.names)

    return kept.mapInArrow(step, schema)


def joined_rows(df: DataFrame, key: str, text: str, found: DataFrame, name: str, fields: str, of: Callable[[object, object], tuple]) -> DataFrame:
    """Add ``fields`` computed by ``of`` from the text of each row and what ``found`` (``of``, ``name``) has for its key.

    The row travels in one column, so its own names cannot clash with those of the join.
    """
    rows = df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("row"), F.col(key).alias("key"))
    both = rows.join(found, F.col("key") == F.col("of"), "left").select("row", F.struct(F.col("row")[text].alias("text"), F.col(name).alias("found")).alias("both"))
    made = append_columns(both, "both", fields, lambda: lambda values: [of(v["text"], v["found"]) for v in values])
    added = T._parse_datatype_string(fields).names
    return made.select("row.*", *added)
