"""Exact quantiles and value-based quantile bins from a sketch and one counting pass.

The column is written once, so that whatever computes it runs once.  The first pass keeps
a mergeable quantile sketch, whose error bound gives an interval around every wanted
quantile.  The second pass counts the rows between the intervals and the values inside
them; the intervals hold a few hundred-thousandths of the rows.  Ranks are read from these
counts, so the result is exact whatever the sketch said.

Where an interval misses its rank or holds very many different values, histogram passes
narrow it down: bins are counted (nothing but the counts is shuffled), and ranges reach
the scan as filters.  No sort and no window of the whole table is needed; a value held by
a third of all rows is a single value.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quadrat.functions.missing import gt_m
from quadrat.session import cut_lineage

_LARGEST = sys.float_info.max
ACCURACY = 50_000  # the sketch is off by one rank in so many at most


def quantile_ranks(n: int, percent: float) -> list[int]:
    """1-based ranks whose mean is the quantile."""
    position = Fraction(percent).limit_denominator(10**6) * n / 100
    whole = position.numerator // position.denominator
    return [whole, whole + 1] if position == whole else [whole + 1]


def _numbers(df: DataFrame, c: str) -> DataFrame:
    return df.select(F.col(c).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))


def _finite() -> Column:
    return F.when(F.col("x").between(-_LARGEST, _LARGEST), F.col("x"))


def _extent(x: DataFrame, fractions: Sequence[float] = ()) -> tuple[float, float, int, int, int, list[float]]:
    """Smallest and largest finite value, how many are finite, how many are minus infinity, how many there are; sketched quantiles."""
    finite = _finite()
    sketch = [F.percentile_approx(finite, list(fractions), ACCURACY)] if fractions else []
    row = x.agg(F.min(finite), F.max(finite), F.count(finite), F.count(F.when(F.col("x") < -_LARGEST, 1)), F.count("x"), *sketch).first()
    return (*row[:5], list(row[5] or []) if fractions else [])


def _apart(intervals: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """The intervals in order, overlapping ones joined."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _counted(x: DataFrame, intervals: Sequence[tuple[float, float]]) -> DataFrame:
    """``(region, x, n)``: regions 1, 3, .. are the intervals, with their values; 0, 2, .. lie between them, without."""
    region = F.lit(2 * len(intervals))
    for i, (lo, hi) in reversed(list(enumerate(intervals))):
        region = F.when(F.col("x") < lo, 2 * i).when(F.col("x") <= hi, 2 * i + 1).otherwise(region)
    placed = x.withColumn("region", region)
    return placed.groupBy("region", F.when(F.col("region") % 2 == 1, F.col("x")).alias("x")).agg(F.count(F.lit(1)).alias("n"))


def _bracketed(x: DataFrame, low: float, high: float, below: int, ranks: Sequence[int], guesses: Sequence[tuple[float, float]], small: int):
    """Values of the ranks that the guessed intervals hold, and the intervals still open for the others."""
    intervals = _apart(guesses)
    counted = cut_lineage(_counted(x, intervals))
    sizes = {r["region"]: (r["rows"], r["values"]) for r in counted.groupBy("region").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values")).collect()}
    ends = [low, *[v for interval in intervals for v in interval], high]
    found, wanted, open_, before = {}, {}, [], below
    for region in range(2 * len(intervals) + 1):
        rows, values = sizes.get(region, (0, 0))
        own = [r for r in ranks if before < r <= before + rows]
        if own and region % 2 and values <= small:
            wanted[region] = (before, own)
        elif own:
            open_.append((ends[region], ends[region + 1], before, rows, own) if region % 2 else _between(x, ends[region], ends[region + 1], region, 2 * len(intervals), before, rows, own))
        before += rows
    if wanted:
        found = _read_counted(counted, wanted)
    return found, open_


def _between(x: DataFrame, lo: float, hi: float, region: int, last: int, before: int, rows: int, own: list[int]):
    """An open interval of the values strictly between two guessed ones."""
    inside = F.lit(True)
    if region > 0:
        inside = inside & (F.col("x") > lo)
    if region < last:
        inside = inside & (F.col("x") < hi)
    least, most = x.filter(inside).agg(F.min("x"), F.max("x")).first()
    return least, most, before, rows, own


def _read_counted(counted: DataFrame, wanted) -> dict[int, float]:
    rows = counted.filter(F.col("region").isin(list(wanted)))
    upto = F.sum("n").over(W.partitionBy("region").orderBy("x"))
    below, ranks = F.lit(0), F.array().cast("array<bigint>")
    for region, (before, own) in wanted.items():
        below = F.when(F.col("region") == region, F.lit(before)).otherwise(below)
        ranks = F.when(F.col("region") == region, F.array(*[F.lit(r).cast("bigint") for r in own])).otherwise(ranks)
    hits = (
        rows.withColumn("last", upto + below)
        .withColumn("hit", F.filter(ranks, lambda r: (r <= F.col("last")) & (r > F.col("last") - F.col("n"))))
        .filter(F.size("hit") > 0).select("x", "hit")
    )
    return {rank: row.x for row in hits.collect() for rank in row.hit}


def values_at_ranks(
    df: DataFrame, c: str, ranks: Sequence[int], bins: int = 4096, small: int = 100_000,
    extent: tuple[float, float, int, int] | None = None, guesses: Sequence[tuple[float, float]] = (),
) -> dict[int, float]:
    """Exact values at 1-based ranks of the non-missing values of ``c``; ``guesses`` are intervals that may hold them."""
    x = _numbers(df, c)
    low, high, n, below = extent or _extent(x)[:4]
    found = {r: -math.inf for r in ranks if r <= below} | {r: math.inf for r in ranks if r > below + n}
    inner = sorted({r for r in ranks if below < r <= below + n})
    x = x.filter(F.col("x").between(-_LARGEST, _LARGEST))
    # (low, high, rows below, rows inside, ranks) for every interval still open
    open_ = [(low, high, below, n, inner)] if inner else []
    if open_ and guesses:
        read, open_ = _bracketed(x, low, high, below, inner, guesses, small)
        found |= read
    while open_:
        for lo, hi, _, _, wanted in open_:
            if lo == hi:
                found.update(dict.fromkeys(wanted, lo))
        open_ = [iv for iv in open_ if iv[0] != iv[1]]
        small_ = {i for i, iv in enumerate(open_) if iv[3] <= small or iv[1] / 2 == iv[0] / 2}
        done = [iv for i, iv in enumerate(open_) if i in small_]
        if done:
            found.update(_read_ranks(x, done))
        open_ = _narrow(x, [iv for i, iv in enumerate(open_) if i not in small_], bins)
    return found


def _tag(intervals) -> Column:
    tag = None
    for i, (lo, hi, *_) in enumerate(intervals):
        hit = F.col("x").between(lo, hi)
        tag = F.when(hit, i) if tag is None else tag.when(hit, i)
    return tag


def _within(x: DataFrame, intervals) -> DataFrame:
    inside = None
    for lo, hi, *_ in intervals:
        hit = F.col("x").between(lo, hi)
        inside = hit if inside is None else inside | hit
    return x.filter(inside).withColumn("iv", _tag(intervals))


def _read_ranks(x: DataFrame, intervals) -> dict[int, float]:
    counted = _within(x, intervals).groupBy("iv", "x").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("iv").orderBy("x"))
    below, wanted = F.lit(0), F.array().cast("array<bigint>")
    for i, iv in enumerate(intervals):
        below = F.when(F.col("iv") == i, F.lit(iv[2])).otherwise(below)
        wanted = F.when(F.col("iv") == i, F.array(*[F.lit(r).cast("bigint") for r in iv[4]])).otherwise(wanted)
    hits = (
        counted.withColumn("last", upto + below)
        .withColumn("hit", F.filter(wanted, lambda r: (r <= F.col("last")) & (r > F.col("last") - F.col("n"))))
        .filter(F.size("hit") > 0)
        .select("x", "hit")
    )
    return {rank: row.x for row in hits.collect() for rank in row.hit}


def _narrow(x: DataFrame, intervals, bins: int):
    if not intervals:
        return []
    low, width = F.lit(0.0), F.lit(1.0)
    for i, (lo, hi, *_) in enumerate(intervals):
        low = F.when(F.col("iv") == i, F.lit(lo)).otherwise(low)
        width = F.when(F.col("iv") == i, F.lit(hi / 2 - lo / 2)).otherwise(width)
    # halves, because the distance of two large numbers may be no number
    bin_ = F.least(F.floor((F.col("x") / 2 - low / 2) / width * bins), F.lit(bins - 1))
    rows = (
        _within(x, intervals).groupBy("iv", bin_.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        .orderBy("iv", "bin").collect()
    )
    out = []
    for i, (_, _, below, _, wanted) in enumerate(intervals):
        mine = [r for r in rows if r.iv == i]
        for r, end in zip(mine, accumulate(r.n for r in mine)):
            start = below + end - r.n
            inside = [k for k in wanted if start < k <= start + r.n]
            if inside:
                out.append((r.lo, r.hi, start, r.n, inside))
    return out


def percentiles(df: DataFrame, c: str, percents: Sequence[float], **options) -> list[float | None]:
    """Exact percentiles: the mean of two neighbours when the position is whole."""
    x = cut_lineage(_numbers(df, c))
    around = [[min(max(p / 100 + d / ACCURACY, 0.0), 1.0) for d in (-2, 2)] for p in percents]
    low, high, finite, below, n, sketched = _extent(x, [f for pair in around for f in pair])
    if not n:
        return [None] * len(percents)
    wanted = [[min(max(r, 1), n) for r in quantile_ranks(n, p)] for p in percents]
    guesses = list(zip(sketched[::2], sketched[1::2]))
    values = values_at_ranks(
        x, "x", [r for ranks in wanted for r in ranks], extent=(low, high, finite, below), guesses=guesses, **options
    )
    return [_mean([values[r] for r in ranks]) for ranks in wanted]


def _mean(values: list[float]) -> float:
    return values[0] if len(set(values)) == 1 else sum(v / len(values) for v in values) if max(map(abs, values)) > 1e300 else sum(values) / len(values)


def bin_by_cuts(c: str, cuts: Sequence[float]) -> Column:
    """Bin 1..k+1 for k ascending cut points; equal values share a bin, missing stays missing."""
    out = None
    for i, cut in enumerate(cuts, start=1):
        hit = F.col(c) <= F.lit(cut)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    last = F.when(F.col(c).isNotNull(), len(cuts) + 1)
    return last if out is None else out.otherwise(last)


def quantile_bins(df: DataFrame, c: str, bins: int, out: str) -> DataFrame:
    """Attach value-based quantile bins 1..``bins``."""
    cuts = percentiles(df, c, [100 * i / bins for i in range(1, bins)])
    if cuts and cuts[0] is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    return df.withColumn(out, bin_by_cuts(c, cuts))


def tiered_bins(
    df: DataFrame, c: str, bins: int, tiers: Sequence[tuple[float, int]], out: str
) -> DataFrame:
    """Quantile bins, then hard tiers ``value > bound`` from the highest bound down.

    A missing value ranks above every bound and so lands in the top tier.
    """
    binned = quantile_bins(df, c, bins, out)
    tier = None
    for bound, code in sorted(tiers, reverse=True):
        hit = gt_m(c, bound)
        tier = F.when(hit, code) if tier is None else tier.when(hit, code)
    return binned.withColumn(out, tier.otherwise(F.col(out)))
