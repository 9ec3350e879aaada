"""Summary tables, weighted tabulations and group comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quadrat.functions import stats
from quadrat.functions.missing import complete_cases
from quadrat.session import cut_lineage

# statistic name -> aggregate of one column
_STATISTICS = {
    "mean": lambda c: F.avg(c),
    "sd": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "n": lambda c: F.count(c),
}


def summarise(
    df: DataFrame, columns: Sequence[str], statistics: Sequence[str] = ("mean", "sd", "n"),
    listwise: bool = False,
) -> DataFrame:
    """One row per variable with the asked statistics, from a single aggregation."""
    rows = complete_cases(df, columns) if listwise else df
    one = rows.agg(*[
        F.struct(
            F.lit(c).alias("variable"),
            *[
                _STATISTICS[s](F.col(c).cast("double")).cast("bigint" if s == "n" else "double").alias(s)
                for s in statistics
            ],
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ])
    return one.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def tabulate(df: DataFrame, c: str, weight: str | None = None) -> DataFrame:
    """One-way percent; rows with a missing value or weight are left out."""
    w = F.lit(1.0) if weight is None else F.col(weight)
    rows = complete_cases(df, [c] if weight is None else [c, weight])
    counted = cut_lineage(rows.groupBy(c).agg(F.sum(w).alias("w")))  # a row per category, read twice
    return counted.select(c, (F.lit(100.0) * F.col("w") / counted.agg(F.sum("w")).scalar()).alias("pct"))


def crosstab(df: DataFrame, row: str, column: str, weight: str | None = None) -> DataFrame:
    """Two-way percent of the grand total in long form, margins marked ``Total``."""
    w = F.lit(1.0) if weight is None else F.col(weight)
    rows = complete_cases(df, [row, column] if weight is None else [row, column, weight])
    cube = cut_lineage(rows.cube(row, column).agg(
        F.sum(w).alias("w"), F.grouping(row).alias("__gr"), F.grouping(column).alias("__gc")
    ))
    grand = cube.filter("__gr = 1 and __gc = 1").select("w").agg(F.max("w")).scalar()

    def shown(c: str) -> Column:
        return F.when(F.col("__gr" if c == row else "__gc") == 1, "Total").otherwise(F.col(c).cast("string")).alias(c)

    return cube.select(shown(row), shown(column), (F.lit(100.0) * F.col("w") / grand).alias("pct"))


def crosstab_wide(df: DataFrame, row: str, column: str, names: Sequence, weight: str | None = None) -> DataFrame:
    """The two-way table laid out with one column per category plus Total."""
    long = crosstab(df, row, column, weight)
    return long.groupBy(row).pivot(column, [*[str(n) for n in names], "Total"]).agg(F.first("pct"))


def t_tests(df: DataFrame, columns: Sequence[str], by: str, first, second, p_value: bool = True) -> DataFrame:
    """Equal-variance two-sample t tests, one row per variable, missing per variable.

    ``b`` is the mean of the first group minus the mean of the second.
    """
    def side(c: str, value) -> list[Column]:
        x = F.when(F.col(by) == F.lit(value), F.col(c).cast("double"))
        return [F.count(x), F.avg(x), F.var_samp(x)]

    pieces = []
    for i, c in enumerate(columns):
        for tag, value in (("1", first), ("2", second)):
            pieces += [a.alias(f"{n}{tag}_{i}") for n, a in zip(("n", "m", "v"), side(c, value))]
    one = df.agg(*pieces)
    rows = one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), *[
            F.col(f"{n}{tag}_{i}").alias(f"{n}{tag}") for tag in "12" for n in "nmv"
        ])
        for i, c in enumerate(columns)
    ])))
    n1, n2 = F.col("n1"), F.col("n2")
    pooled = F.try_divide((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2"), n1 + n2 - 2)
    out = (
        rows.withColumn("mu_1", F.col("m1")).withColumn("mu_2", F.col("m2"))
        .withColumn("b", F.col("m1") - F.col("m2"))
        .withColumn("se", F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2))))
        .withColumn("t", F.try_divide(F.col("b"), F.col("se")))
        .withColumn("df", (n1 + n2 - 2).cast("bigint"))
        .select("variable", "n1", "n2", "mu_1", "mu_2", "b", "se", "t", "df")
    )
    return out.withColumn("p", stats.t_p_value("t", F.col("df").cast("double"))) if p_value else out


def summary_lines(
    summary: DataFrame, labels: Mapping[str, str], cells: Sequence[tuple[str, int]], headings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typeset body rows of a summary table; ``headings`` puts a line of its own before a variable."""
    from quadrat.functions.keys import recode

    label = F.coalesce(recode("variable", labels), F.col("variable")) if labels else F.col("variable")
    line = stats.table_line(label, *[stats.fixed_comma(F.col(c), d) for c, d in cells])
    if not headings:
        return summary.select(line.alias("line"))
    heading = stats.table_line(recode("variable", headings), *[F.lit("") for _ in cells])
    return summary.select(F.explode(F.when(F.col("variable").isin(*headings), F.array(heading, line)).otherwise(F.array(line))).alias("line"))


def t_test_lines(tests: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """Typeset body rows: means, starred difference, standard error, t."""
    from quadrat.functions.keys import recode

    label = F.coalesce(recode("variable", labels), F.col("variable")) if labels else F.col("variable")
    return tests.select(stats.table_line(
        label, stats.fixed(F.col("mu_1")), stats.fixed(F.col("mu_2")),
        stats.starred(F.col("b"), F.col("p")), stats.parenthesised(F.col("se")), stats.fixed(F.col("t")),
    ).alias("line"))
