"""Long to wide, wide to long, transposition, set difference of list elements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def to_wide(
    df: DataFrame, i: Sequence[str], j: str, values: Sequence[str], names: Sequence,
    unique: bool = True,
) -> DataFrame:
    """One row per ``i``; column ``value`` + name for each listed ``j`` value.

    With ``unique`` a repeated (i, j) pair raises while the query runs.
    """
    def cell(v: str) -> Column:
        first = F.first(v)
        if not unique:
            return first
        return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"repeated key in reshape of {v}"))).otherwise(first)

    wide = df.groupBy(*i).pivot(j, list(names)).agg(*[cell(v).alias(v) for v in values])
    rename = (
        {str(n): f"{values[0]}{n}" for n in names}
        if len(values) == 1 else {f"{n}_{v}": f"{v}{n}" for n in names for v in values}
    )
    return wide.withColumnsRenamed(rename)


def to_long(df: DataFrame, i: Sequence[str], stub: str, j: str, value: str | None = None) -> DataFrame:
    """One row per (i, suffix) for all columns starting with ``stub``; missing cells stay."""
    wide = [c for c in df.columns if c.startswith(stub) and c not in i]
    long = df.unpivot(list(i), wide, j, value or stub)
    return long.withColumn(j, F.substr(F.col(j), F.lit(len(stub) + 1)))


def fill_zero(df: DataFrame, prefix: str) -> DataFrame:
    numeric = [
        f.name for f in df.schema.fields
        if f.name.startswith(prefix) and isinstance(f.dataType, T.NumericType)
    ]
    return df.na.fill(0, subset=numeric)


def transpose(df: DataFrame, header: str, names: Sequence, varname: str = "varname") -> DataFrame:
    """Turn columns into rows; the listed ``header`` values become the columns."""
    columns = [c for c in df.columns if c != header]
    long = df.unpivot([header], columns, varname, "__v")
    return long.groupBy(varname).pivot(header, list(names)).agg(F.first("__v"))


def columns_like(df: DataFrame, *patterns: str) -> list[str]:
    """Column names matching shell-style patterns, in table order."""
    from fnmatch import fnmatchcase

    return [c for c in df.columns if any(fnmatchcase(c, p) for p in patterns)]


def rename_prefixed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def insert_constants(df: DataFrame, position: int, **constants) -> DataFrame:
    """Constant columns placed at a 0-based position."""
    names = df.columns
    new = [F.lit(v).alias(n) for n, v in constants.items()]
    return df.select(*names[:position], *new, *names[position:])
