"""Resumable batch work: per-row failures, bounded retries, completion reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from quadrat.session import cut_lineage, fan_out, new_folder

BatchFn = Callable[[pd.DataFrame], pd.DataFrame]


def attempt_rows(
    df: DataFrame, keys: Sequence[str], load: Callable[[], BatchFn], result: str, batch_rows: int | None = None
) -> DataFrame:
    """Run a batch function over Arrow batches and keep each row's outcome.

    ``load`` runs once per task and returns the function; the function adds the
    ``result`` column (a DDL field such as ``"ner string"``).  A batch that fails is
    halved until the error is booked on the row that caused it.
    """
    value = T.StructType.fromDDL(result)[0]
    schema = T.StructType([
        *[df.schema[k] for k in keys], value, T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType()),
    ])
    columns = schema.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = load()
        for batch in batches:
            step = batch_rows or max(len(batch), 1)
            for at in range(0, len(batch), step):
                waiting = [batch.iloc[at:at + step]]
                while waiting:
                    part = waiting.pop()
                    try:
                        yield fn(part).assign(ok=True, error=None)[columns]
                    except Exception as problem:
                        half = len(part) // 2
                        if half:
                            waiting += [part.iloc[half:], part.iloc[:half]]
                        else:
                            yield part[list(keys)].assign(**{value.name: None, "ok": False, "error": str(problem)})[columns]

    return fan_out(df).mapInPandas(run, schema)


def run_until_done(
    df: DataFrame, keys: Sequence[str], load: Callable[[], BatchFn], result: str, ledger: str | None = None,
    max_tries: int = 32, batch_rows: int | None = None, attempt_arg: bool = False,
) -> DataFrame:
    """Process every key, retrying failures at most ``max_tries`` times.

    Each round appends its outcomes to the ``ledger`` folder (shared storage), so a
    restarted run goes on with the keys that have no good outcome yet.  Returns one row
    per key: the good outcome, or the last failure.
    """
    spark = df.sparkSession
    ledger = ledger or new_folder(spark, "ledger")
    value = T.StructType.fromDDL(result)[0]
    schema = T.StructType([
        *[df.schema[k] for k in keys], value, T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()), T.StructField("attempt", T.IntegerType()),
    ])
    booked = read_ledger(spark, ledger, schema)
    first = (booked.agg(F.max("attempt")).first()[0] or 0) + 1
    pending = df.join(booked.filter("ok").select(*keys), list(keys), "left_anti")
    for attempt in range(first, first + max_tries):
        make = (lambda n=attempt: load(n)) if attempt_arg else load
        outcome = attempt_rows(pending, keys, make, result, batch_rows).withColumn("attempt", F.lit(attempt))
        outcome.write.mode("append").parquet(ledger)
        booked = read_ledger(spark, ledger, schema)
        failed = booked.filter((F.col("attempt") == attempt) & ~F.col("ok")).select(*keys).distinct()
        if failed.isEmpty():
            break
        again = failed.withColumnsRenamed({k: f"__failed_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__failed_{k}")) for k in keys])
        pending = cut_lineage(pending.join(again, same, "left_semi"))  # the next round reads only what failed in this one
    from quadrat.operators.groups import first_rows

    return first_rows(booked, keys, [F.col("ok").desc(), F.col("attempt").desc()])


def read_ledger(spark, path: str, schema: T.StructType) -> DataFrame:
    """All outcomes booked so far (none when the folder does not exist yet)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def split_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantine of failed rows."""
    return outcomes.filter("ok").drop("ok", "error"), outcomes.filter("not ok")


def completion_report(outcomes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(status, key) rows sorted within status."""
    status = F.when(F.col("ok"), "completed").otherwise("errors").alias("status")
    return outcomes.select(status, *keys).orderBy("status", *keys)


def error_counts(quarantine: DataFrame, stage: str = "stage") -> DataFrame:
    return quarantine.groupBy(stage).agg(F.count(F.lit(1)).alias("n"))


def fold_log(log: DataFrame, keys: Sequence[str], attempt: str, message: str, out: str = "log") -> DataFrame:
    """Messages of each key joined in order of the attempt; a key has as many as it had attempts."""
    folded = log.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(attempt).alias("a"), F.col(message).alias("m")))).alias("l"))
    return folded.select(*keys, F.array_join(F.transform("l", lambda x: x["m"]), " >>> ").alias(out))


def unresolved(work: DataFrame, done: DataFrame, unit: Sequence[str], item: str, out: str = "unresolved") -> DataFrame:
    """Items of each unit that are not done; finished units are left out.

    The comparison is an anti-join on (unit, item); only what is left is listed.
    """
    rest = work.select(*unit, item).distinct().join(done.select(*unit, item), [*unit, item], "left_anti")
    return rest.groupBy(*unit).agg(F.sort_array(F.collect_list(item)).alias(out))
