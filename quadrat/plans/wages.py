"""Wage regressions: a ladder of six fixed-effect specifications, twice."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quadrat.operators.regress import Factor, Fit, ladder_on_common_sample, regression_lines
from quadrat.operators.reshape import columns_like

_PLACE = ("state", "SOC")
# Absorbed effects per model; ``state`` is the one state a posting belongs to.
SPECIFICATIONS = {
    "A": ["monthYear"],
    "B": ["monthYear", _PLACE],
    "C": ["monthYear", _PLACE, (*_PLACE, "month"), (*_PLACE, "year")],
    "D": ["monthYear", _PLACE, (*_PLACE, "month"), (*_PLACE, "year"), "companyId"],
    "E": ["monthYear", _PLACE, (*_PLACE, "month"), (*_PLACE, "year"), "companyId", (*_PLACE, "companyId")],
    "F": ["monthYear", _PLACE, (*_PLACE, "month"), (*_PLACE, "year"), "companyId", (*_PLACE, "companyId"),
          (*_PLACE, "month", "companyId"), (*_PLACE, "year", "companyId")],
}
# Lines on absorbed effects and the key each one names (fixed values); states are regressors of every model.
EFFECTS = {
    "State FE": None, "Month-Yr FE": "monthYear", r"State $\times$ SOC FE": _PLACE, r"State $\times$ SOC $\times$ Month FE": (*_PLACE, "month"),
    r"State $\times$ SOC $\times$ Year FE": (*_PLACE, "year"), "Company FE": "companyId", r"State $\times$ SOC $\times$ Company FE": (*_PLACE, "companyId"),
    r"State $\times$ SOC $\times$ Company $\times$ Month FE": (*_PLACE, "month", "companyId"),
    r"State $\times$ SOC $\times$ Company $\times$ Year FE": (*_PLACE, "year", "companyId"),
}
CONTROLS = ["minExperience", "minExp2", Factor("minEducationBranch", base=1)]


def with_state(jobs: DataFrame) -> DataFrame:
    """The exclusive ``state_*`` indicators as one column; no indicator set is its own group.

    A row with two states set is an error, because it would count for one of them only.
    """
    from pyspark.sql import functions as F

    names = columns_like(jobs, "state_*")
    picked = F.coalesce(*[F.when(F.col(n) == 1, F.lit(n)) for n in names], F.lit("none"))
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull()
    several = sum((F.when(F.col(n) == 1, 1).otherwise(0) for n in names), F.lit(0)) > 1
    wrong = F.raise_error(F.lit("a posting has more than one state")).cast("string")
    return jobs.withColumn("state", F.when(several, wrong).when(known, picked))


def wage_ladders(jobs: DataFrame, specifications=None) -> tuple[dict[str, Fit], dict[str, Fit]]:
    """Models A-F on all rows and on the sample of the last one, clustered on occupation."""
    rows = with_state(jobs)
    terms = [*columns_like(jobs, "tech_*"), *CONTROLS, *columns_like(jobs, "state_*")]
    return ladder_on_common_sample(rows, "ln_avgSalary_real", terms, specifications or SPECIFICATIONS, cluster="SOC")


def wage_table(fits: dict[str, Fit], specifications=None) -> DataFrame:
    """Typeset body: technology coefficients, statistics and absorbed effects, one column per model."""
    specifications = specifications or SPECIFICATIONS
    terms = [t for f in fits.values() for t in f.terms if t.startswith("tech_")]
    effects = {text: [m for m in fits if key is None or key in specifications[m]] for text, key in EFFECTS.items()}
    return regression_lines(list(fits.values()), keep=list(dict.fromkeys(terms)), effects=effects)
