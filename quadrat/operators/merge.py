"""Keyed merges with the cardinality rules of statistical packages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class DuplicateKeyError(ValueError):
    """A key that must be unique occurs more than once."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def ensure_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    bad = duplicate_keys(df, keys).take(1)
    if bad:
        raise DuplicateKeyError(f"{list(keys)} is not unique: {bad[0].asDict()}")
    return df


def declare_panel(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Check that an entity appears at most once per time."""
    return ensure_unique(df.select("*"), [entity, time])


def _same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def merge_one_to_many(
    master: DataFrame, using: DataFrame, on: Sequence[str], keep: Sequence[int] = (2, 3),
    indicator: str | None = None, validate: bool = True,
) -> DataFrame:
    """Merge a unique master onto many using rows.

    ``keep`` lists the wanted origins: 1 master only, 2 using only, 3 both.  Missing
    keys match missing keys.  A column found on both sides takes the master value on
    matched rows.  The using side is the left of the join, so a hot key can be split; rows
    of the master alone come from an anti-join with the distinct keys, not from a full join.
    """
    keys = list(on)
    if validate:
        ensure_unique(master.select(*keys), keys)
    m, u = master.withColumn("__m", F.lit(True)).alias("m"), using.alias("u")
    kept = {int(k) for k in keep}
    rest = [c for c in master.columns if c not in keys]
    own = [c for c in using.columns if c not in master.columns]
    legs = []
    if kept & {2, 3}:
        joined = u.join(m, _same_keys(keys, "u", "m"), "left" if 2 in kept else "inner")
        both = F.col("m.__m").isNotNull()
        out = []
        for c in [*keys, *rest]:
            side = F.when(both, F.col(f"m.`{c}`"))
            out.append((side.otherwise(F.col(f"u.`{c}`")) if c in using.columns else side).alias(c))
        out += [F.col(f"u.`{c}`") for c in own]
        picked = joined if kept & {2, 3} != {2} else joined.filter(~both)
        legs.append(picked.select(*out, *([F.when(both, 3).otherwise(2).alias(indicator)] if indicator else [])))
    if 1 in kept:  # the master rows that no using row has; every using key counts once here
        seen = using.select(*keys).distinct().alias("u")
        alone = m.join(seen, _same_keys(keys, "m", "u"), "left_anti")
        empty = [F.lit(None).cast(using.schema[c].dataType).alias(c) for c in own]
        legs.append(alone.select(*[F.col(f"m.`{c}`") for c in [*keys, *rest]], *empty, *([F.lit(1).alias(indicator)] if indicator else [])))
    return reduce(lambda x, y: x.unionByName(y), legs)


def left_join_chain(base: DataFrame, tables: Sequence[DataFrame], on: str) -> DataFrame:
    """Left-join many per-key tables onto one base."""
    return reduce(lambda acc, t: acc.join(t, on, "left"), tables, base)


def join_hierarchy(tables: Sequence[DataFrame], keys: Sequence[Sequence[str]]) -> DataFrame:
    """Walk down a hierarchy; parents without children disappear.

    ``keys[i]`` are the cumulative columns that tie ``tables[i]`` to ``tables[i + 1]``.
    """
    out = tables[0]
    for child, on in zip(tables[1:], keys):
        out = out.join(child, list(on), "inner")
    return out


def strict_lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], value: str
) -> tuple[DataFrame, DataFrame]:
    """Look up ``value``; returns the rows that were found and the rows that were not."""
    probe = table.select(*on, value).withColumn("__hit", F.lit(True))
    joined = df.join(probe, list(on), "left")
    return joined.filter("__hit").drop("__hit"), joined.filter("__hit is null").drop("__hit", value)


def keep_in(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_semi")


def drop_in(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_anti")


def append(*tables: DataFrame) -> DataFrame:
    """Union by name; a column missing from one table is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def expand_list(df: DataFrame, items: str, out: str) -> DataFrame:
    """One row per list element; rows with an empty list disappear."""
    return df.withColumn(out, F.explode(items)).drop(items)
