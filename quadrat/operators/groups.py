"""Group statistics, spreading them back to rows, and picking rows per group.

Statistics are computed by a partially aggregated ``groupBy`` and joined back, never
by a window that would hold a whole group in one task.  Row picking goes through
``row_number() <= k``, which Spark limits per group before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quadrat.functions.missing import ColumnLike, col


def _order(columns: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns]


def sum_by(df: DataFrame, by: Sequence[str], **sums: ColumnLike) -> DataFrame:
    """Group sums; rows with a missing key are left out."""
    return (
        df.na.drop("any", subset=list(by)).groupBy(*by)
        .agg(*[F.sum(col(c)).alias(n) for n, c in sums.items()])
    )


def spread(df: DataFrame, by: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Attach group statistics to every row of the group (a missing key is a group too).

    The grouped side has one row per key and the rows stay on the left of an outer
    join, so adaptive execution may split the partition of a hot key.
    """
    grouped = df.groupBy(*[F.col(k).alias(f"__{k}") for k in by]).agg(*[s.alias(n) for n, s in stats.items()])
    on = None
    for k in by:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    kept = [c for c in df.columns if c not in stats]
    return df.select(*kept).join(grouped, on, "left").drop(*[f"__{k}" for k in by])


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[ColumnLike], n: int = 1) -> DataFrame:
    """The first ``n`` rows per group in ``order`` (end it in a unique column)."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*_order(order)))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def last_row(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per group; a missing order value counts as the largest."""
    return first_rows(df, by, [F.col(c).desc_nulls_first() for c in order])


def counts_by(df: DataFrame, by: Sequence[str], count_of: str | None = None, out: str = "n") -> DataFrame:
    counted = F.count(F.lit(1)) if count_of is None else F.count(count_of)
    return df.groupBy(*by).agg(counted.alias(out))


def rows_at_maximum(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """All rows whose value equals the group maximum (ties are kept)."""
    top = spread(df, by, {"__top": F.max(value)})
    return top.filter(F.col(value).eqNullSafe(F.col("__top"))).select(*df.columns)


def mode_by(
    df: DataFrame, by: Sequence[str], category: str, tie_rank: Column, count_of: str | None = None
) -> DataFrame:
    """Most frequent category per group; ties go to the smallest ``tie_rank``.

    Only the (group, category) counts are ranked, not the rows.
    """
    counted = counts_by(df, [*by, category], count_of).withColumn("__tie", tie_rank)
    return first_rows(
        counted, by, [F.col("n").desc(), F.col("__tie").asc_nulls_last(), F.col(category).asc_nulls_last()]
    ).drop("__tie")


def share_by(df: DataFrame, by: Sequence[str], part: Column, out: str = "pct") -> DataFrame:
    """100 * total of ``part`` / rows, per group."""
    return df.groupBy(*by).agg(
        F.try_divide(F.lit(100.0) * F.coalesce(F.sum(part), F.lit(0)), F.count(F.lit(1))).alias(out)
    )


def category_shares(df: DataFrame, by: str, whole: Column, parts: Mapping[str, Column]) -> DataFrame:
    """Percent of the ``whole`` total each part makes up; parts may overlap."""
    total = F.coalesce(F.sum(whole), F.lit(0))
    return df.groupBy(by).agg(*[
        (F.try_divide(F.coalesce(F.sum(p), F.lit(0)).cast("double"), total) * 100).alias(n)
        for n, p in parts.items()
    ])


def merge_entities(
    df: DataFrame, key: str, absorbed: Sequence[str], into: str, counts: Sequence[str]
) -> DataFrame:
    """Sum the counts of several entities into one new entity."""
    mapped = F.when(F.col(key).isin(list(absorbed)), F.lit(into)).otherwise(F.col(key))
    return df.groupBy(mapped.alias(key)).agg(*[F.sum(c).alias(c) for c in counts])


def share_above(
    counts: DataFrame, by: Sequence[str], rank: str, n: str, out: str = "share_above"
) -> DataFrame:
    """Share of the group in categories ranked strictly above the row's own.

    ``counts`` holds one row per (group, category), so a group is as small as the
    category list.
    """
    above = W.partitionBy(*by).orderBy(rank).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn(
        out,
        F.try_divide(
            F.coalesce(F.sum(n).over(above), F.lit(0)).cast("double"),
            F.sum(n).over(W.partitionBy(*by)),
        ),
    )


def latest_value_map(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """Keyed map as a two-column table; the last entry in ``order`` wins."""
    return last_row(df, [key], order).select(key, value)


def frequencies(df: DataFrame, c: str, out: str = "freq") -> DataFrame:
    return counts_by(df.filter(F.col(c).isNotNull()), [c], out=out)
