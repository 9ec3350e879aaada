"""Positions, chunks and fills over an ordered table without a single-task window.

Rows are range-partitioned on the order, sorted inside their partition and numbered
there; the offsets come from one count per partition (and key).  No group, however
hot, is ever held by one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quadrat.functions.missing import ColumnLike
from quadrat.session import cut_lineage

_POS, _PART, _FIRST, _BEFORE, _ALL = "__pos", "__part", "__first", "__before", "__all"


def _ascending(columns: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns]


def with_row_numbers(
    df: DataFrame, order: Sequence[ColumnLike], out: str = "rn", start: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Number rows 0.. (or 1.. with ``start=1``) in ``order``, restarting for each ``by`` key.

    ``order`` must end in a unique column so that the numbering is reproducible.
    """
    return _numbered(df, order, by, out, start, None)


def _numbered(df: DataFrame, order: Sequence[ColumnLike], by: Sequence[str], out: str, start: int, size: str | None) -> DataFrame:
    """Row numbers, and the number of rows of the key if ``size`` names a column for it."""
    keys = list(by)
    sort = _ascending([*keys, *order])
    ranged = cut_lineage(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_PART, F.spark_partition_id())
    )
    counts = ranged.groupBy(_PART, *keys).agg(F.count(F.lit(1)).alias("n"), F.min(_POS).alias(_FIRST))
    earlier = (
        W.partitionBy(*keys).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
        if keys else W.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = counts.withColumn(_BEFORE, F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    offsets = offsets.withColumn(_ALL, F.sum("n").over(W.partitionBy(*(keys or [F.lit(0)])))).drop("n")
    if keys:
        offsets = offsets.withColumnsRenamed({c: f"__of_{c}" for c in [_PART, *keys]})
        on = F.col(_PART) == F.col(f"__of_{_PART}")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
        numbered = ranged.join(offsets, on)
    else:
        # one row per partition: the size is bounded by the number of partitions
        numbered = ranged.join(F.broadcast(offsets), _PART)
    number = (F.col(_POS) - F.col(_FIRST) + F.col(_BEFORE) + F.lit(start)).cast("bigint")
    return numbered.select(*df.columns, number.alias(out), *([F.col(_ALL).cast("bigint").alias(size)] if size else []))


def with_group_position(
    df: DataFrame, by: Sequence[str], order: Sequence[ColumnLike],
    number: str = "position", size: str = "group_size",
) -> DataFrame:
    """1-based position and size of the group on every row; both come from the counts per partition and key."""
    return _numbered(df, order, by, number, 1, size)


def even_chunks(df: DataFrame, order: Sequence[ColumnLike], chunks: int, out: str = "chunk") -> DataFrame:
    """Contiguous chunks 1..k; the first ``n % k`` chunks hold one row more."""
    numbered = _numbered(df, order, (), "__rn", 0, "__n")  # the number of rows comes with the offsets
    rn, size, extra = F.col("__rn"), F.floor(F.col("__n") / chunks), F.col("__n") % chunks
    wide = extra * (size + 1)
    chunk = F.when(rn < wide, F.floor(rn / (size + 1))).otherwise(extra + F.floor((rn - wide) / F.greatest(size, F.lit(1))))
    return numbered.withColumn(out, (chunk + 1).cast("int")).drop("__rn", "__n")


def floor_splits(df: DataFrame, order: Sequence[ColumnLike], splits: int, out: str = "split", by: Sequence[str] = ()) -> DataFrame:
    """Splits of ``n // k`` rows of each ``by`` key, the remainder in the last; fewer rows than splits all go there."""
    numbered = with_group_position(df, by, order, "__rn", "__n")
    size = F.floor(F.col("__n") / splits)
    split = F.when(size == 0, splits).otherwise(F.least(F.floor(F.try_divide(F.col("__rn") - 1, size)), F.lit(splits - 1)) + 1)
    return numbered.withColumn(out, split.cast("int")).drop("__rn", "__n")


def round_robin(df: DataFrame, order: Sequence[ColumnLike], ways: int, out: str = "slot") -> DataFrame:
    """Deal rows out in order: row i goes to slot ``i % ways``."""
    numbered = with_row_numbers(df, order, out="__rn")
    return numbered.withColumn(out, F.pmod(F.col("__rn"), F.lit(ways)).cast("int")).drop("__rn")


_FAN = 1 << 16  # blocks, blocks of blocks, .. that one window sees


def _floor_div(c: str, n: int) -> Column:
    """Whole-number division towards minus infinity, exact beyond the precision of doubles."""
    whole = F.col(c).cast("bigint")
    return F.call_function("div", whole - F.pmod(whole, F.lit(n).cast("bigint")), F.lit(n).cast("bigint"))


def _opening(closing: DataFrame, keys: Sequence[str], levels: int) -> DataFrame:
    """``(keys, __block, __opening)``: the last value that an earlier block of the key closed with.

    Blocks are taken in groups of ``_FAN``; inside a group a window looks back, and what the
    group opens with comes from the same step over the groups, which are ``_FAN`` times fewer.
    On the last level all groups of a key fit in one window.
    """
    if levels == 0:
        back = W.partitionBy(*keys, F.col("__block") * 0).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
        return closing.select(*keys, "__block", F.last("__closing", ignorenulls=True).over(back).alias("__opening"))
    grouped = closing.withColumn("__group", _floor_div("__block", _FAN))
    upper = grouped.groupBy(*keys, F.col("__group").alias("__block")).agg(
        F.max_by("__closing", F.when(F.col("__closing").isNotNull(), F.col("__block"))).alias("__closing"))
    above = _opening(cut_lineage(upper), keys, levels - 1)
    back = W.partitionBy(*keys, "__group").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    inside = grouped.withColumn("__near", F.last("__closing", ignorenulls=True).over(back))
    above = above.select(*[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)], F.col("__block").alias("__of_group"), F.col("__opening").alias("__far"))
    on = F.col("__group") == F.col("__of_group")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__a{i}"))
    return inside.join(above, on, "left").select(*keys, "__block", F.coalesce("__near", "__far").alias("__opening"))


def forward_fill(
    df: DataFrame, value: str, line: str, by: Sequence[str] = (), out: str | None = None,
    block_lines: int = 1_000_000,
) -> DataFrame:
    """Carry the last non-missing ``value`` down the lines of each ``by`` group.

    Lines are cut into blocks of ``block_lines`` consecutive numbers. Each block is filled on
    its own and takes its opening value from a scan over the blocks, the blocks of blocks, and
    so on, so that no window sees all blocks of a table or of a hot group.
    """
    keys = list(by)
    blocked = df.withColumn("__block", _floor_div(line, block_lines))
    closing = cut_lineage(blocked.groupBy(*keys, "__block").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(line))).alias("__closing")
    ))
    levels = max(1, math.ceil((63 - math.log2(block_lines)) / math.log2(_FAN)))
    opening = _opening(closing, keys, levels).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__block").alias("__b"), "__opening")
    on = F.col("__block") == F.col("__b")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inside = W.partitionBy(*keys, "__block").orderBy(line).rowsBetween(W.unboundedPreceding, 0)
    filled = blocked.withColumn("__local", F.last(value, ignorenulls=True).over(inside)).join(opening, on, "left")
    result = F.coalesce(F.col("__local"), F.col("__opening"))
    target = out or value
    kept = [c for c in df.columns if c != target]
    return filled.select(*kept, result.alias(target))


def first_n(df: DataFrame, order: Sequence[ColumnLike], n: int) -> DataFrame:
    """The first ``n`` rows; asking for more rows than there are is an error."""
    head = df.orderBy(*_ascending(order)).limit(n)
    if head.count() < n:
        raise ValueError(f"sample of {n} rows is larger than the table")
    return head


def sort_missing_last(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*_ascending(columns))
