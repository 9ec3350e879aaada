"""Missing-value semantics of statistical packages, as column expressions.

A numeric missing value ranks above every number, a blank string is missing and
an inequality is two-valued.  Spark has one NULL with three-valued logic, so each
rule is spelled out here and used wherever an operator depends on it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


# --- comparisons where missing counts as +infinity -------------------------------------


def gt_m(c: ColumnLike, bound) -> Column:
    return col(c).isNull() | (col(c) > bound)


def ge_m(c: ColumnLike, bound) -> Column:
    return col(c).isNull() | (col(c) >= bound)


def lt_m(c: ColumnLike, bound) -> Column:
    return col(c).isNotNull() & (col(c) < bound)


def le_m(c: ColumnLike, bound) -> Column:
    return col(c).isNotNull() & (col(c) <= bound)


def ne_m(c: ColumnLike, value) -> Column:
    """Two-valued ``!=``: a missing value differs from every value."""
    return ~col(c).eqNullSafe(F.lit(value))


def nonblank(c: ColumnLike) -> Column:
    return F.coalesce(col(c), F.lit("")) != ""


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(col(c), F.lit(""))


# --- recoding sentinels -----------------------------------------------------------------


def _names(df: DataFrame, wanted: type | tuple[type, ...], subset: Sequence[str] | None) -> set[str]:
    return {
        f.name for f in df.schema.fields
        if isinstance(f.dataType, wanted) and (subset is None or f.name in subset)
    }


def recode_sentinel_strings(
    df: DataFrame, sentinels: Iterable[str], subset: Sequence[str] | None = None
) -> DataFrame:
    """Turn listed markers and blanks into NULL in every string column (one projection)."""
    markers = [*sentinels, ""]
    strings = _names(df, T.StringType, subset)
    return df.select(*[
        F.when(F.col(f"`{n}`").isin(markers), None).otherwise(F.col(f"`{n}`")).alias(n)
        if n in strings else F.col(f"`{n}`")
        for n in df.columns
    ])


def recode_sentinel_numbers(
    df: DataFrame, sentinels: Iterable[float], subset: Sequence[str] | None = None
) -> DataFrame:
    """Turn listed codes into NULL in every numeric column; other types are skipped."""
    codes = list(sentinels)
    numbers = _names(df, T.NumericType, subset)
    return df.select(*[
        F.when(F.col(f"`{n}`").isin(codes), None).otherwise(F.col(f"`{n}`")).alias(n)
        if n in numbers else F.col(f"`{n}`")
        for n in df.columns
    ])


def zero_then_missing(c: ColumnLike, zero_code: float = -100) -> Column:
    """``zero_code`` means nothing spent, any other negative code means unknown."""
    return F.when(col(c) == zero_code, 0).when(col(c) < 0, None).otherwise(col(c))


def clamp_negative(c: ColumnLike) -> Column:
    return F.when(col(c) < 0, 0).otherwise(col(c))


# --- indicators -------------------------------------------------------------------------


def yes_no(c: ColumnLike, yes: str = "Y", no: str = "N") -> Column:
    return F.when(col(c) == yes, 1).when(col(c) == no, 0)


def flag(condition: Column, known: Column | None = None) -> Column:
    """1 when true; 0 otherwise, or only where ``known`` holds when it is given."""
    positive = F.when(F.coalesce(condition, F.lit(False)), 1)
    return positive.otherwise(0) if known is None else positive.when(known, 0)


def dummy(condition: Column, source: ColumnLike) -> Column:
    """0/1 value of ``condition``, missing where ``source`` is missing."""
    return F.when(col(source).isNotNull(), condition.cast("int"))


def overwrite_when(c: ColumnLike, condition: Column, value=None) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(value)).otherwise(col(c))


# --- filters ----------------------------------------------------------------------------


def keep_when(df: DataFrame, condition: Column) -> DataFrame:
    """Keep rows where the two-valued condition holds (an unknown condition is false)."""
    return df.filter(F.coalesce(condition, F.lit(False)))


def drop_when(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(~F.coalesce(condition, F.lit(False)))


def drop_all_missing(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listwise deletion over ``columns``."""
    return df.na.drop("any", subset=list(columns))


def all_present(columns: Sequence[str]) -> Column:
    """Every text component exists and is not empty."""
    return reduce(lambda a, b: a & b, [nonblank(c) for c in columns])


def has_prefix(c: ColumnLike, prefix: str) -> Column:
    return F.coalesce(col(c).startswith(prefix), F.lit(False))


def slice_equals(c: ColumnLike, start: int, value: str) -> Column:
    """Characters from the 0-based ``start`` equal ``value``."""
    return F.substring(col(c), start + 1, len(value)) == value


def mentions(c: ColumnLike, needle: str) -> Column:
    return F.coalesce(col(c).contains(needle), F.lit(False))


def known_year_and_type(
    year: ColumnLike, max_year: int, doc_type: ColumnLike, excluded: str
) -> Column:
    """Reject an unknown year, accept an unknown document type."""
    return F.coalesce(col(year) <= max_year, F.lit(False)) & ne_m(doc_type, excluded)


# --- aggregates -------------------------------------------------------------------------


def total(c: ColumnLike) -> Column:
    """Sum that counts missing as zero, also for an all-missing group."""
    return F.coalesce(F.sum(col(c)), F.lit(0))
