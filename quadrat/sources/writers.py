"""Writers for tables, keyed files, ledgers, vectors and typeset bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def safe_key(*parts: Column | str) -> Column:
    """File-name key: underscores and slashes removed from the parts, parts joined by underscores."""
    return F.concat_ws("_", *[
        F.regexp_replace(F.col(p) if isinstance(p, str) else p, r"[/_]", "") for p in parts
    ])


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Save a result and go on from the saved files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv_by_key(df: DataFrame, path: str, key: Column, name: str = "file_key", max_rows: int = 5_000_000) -> None:
    """One folder of CSV files per key; a big key is cut into files of at most ``max_rows``."""
    df.withColumn(name, key).write.mode("overwrite").option("header", True).option(
        "maxRecordsPerFile", max_rows).partitionBy(name).csv(path)


def write_matrix(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """A small result table as one CSV file."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_by_file(df: DataFrame, path: str, file_idx: str = "file_idx") -> None:
    """JSON lines, one folder per input file."""
    df.write.mode("overwrite").partitionBy(file_idx).json(path)


def write_map(df: DataFrame, path: str, key: str, value: str) -> None:
    """(key, value) rows of a map or ledger as JSON lines."""
    df.select(key, value).write.mode("overwrite").json(path)


def write_vectors(df: DataFrame, path: str, key: str = "id", order: str | None = None) -> None:
    """Vectors by variant and split; of a repeated id the last one in ``order`` stays."""
    from quadrat.operators.groups import last_row

    kept = last_row(df, ["variant", "split", key], [order]) if order else df
    kept.select("variant", "split", key, "embedding").write.mode("overwrite").partitionBy("variant", "split").parquet(path)


def write_lines(lines: DataFrame, path: str, append: bool = False) -> None:
    """Typeset body rows as text."""
    lines.select("line").coalesce(1).write.mode("append" if append else "overwrite").text(path)


def write_statistical(df: DataFrame, path: str) -> None:
    """Rows as statistical files, one per Arrow batch of a task; missing text becomes empty text.

    A file is named after its task and batch, so an attempt that is run again writes over its
    own files. Names and types must be such as the format has.
    """
    from collections.abc import Iterator

    import pandas as pd

    from quadrat.sources.readers import _store

    store, folder = _store(path)
    store.create_dir(folder, recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from io import BytesIO

        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for i, batch in enumerate(b for b in batches if len(b)):
            made = BytesIO()
            batch.to_stata(made, write_index=False, version=118)
            store, folder = _store(path)
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/part-{task:05d}-{i:05d}.dta") as sink:
                sink.write(made.getvalue())
            yield pd.DataFrame({"n": [len(batch)]})

    df.mapInPandas(run, "n bigint").write.format("noop").mode("overwrite").save()
