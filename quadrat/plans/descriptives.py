"""Descriptive tables of job postings and technology matrices by company size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from quadrat.functions import missing as M
from quadrat.operators import describe as D, groups as G, quantiles as Q, reshape as R
from quadrat.session import cut_lineage

# Upper tiers (bound, code) above the quintiles (fixed values).
POST_TIERS = ((500, 8), (200, 7), (100, 6))
VACANCY_TIERS = ((4500, 8), (1000, 7), (450, 6))
TECHNOLOGIES = {
    "pct_additiveMfg": "tech_additiveManufacturing", "pct_ai": "tech_aiInfoSystems", "pct_computing": "tech_computing",
    "pct_dataAcq": "tech_dataAcquisition", "pct_dataMgmt": "tech_dataManagement", "pct_networking": "tech_networking",
    "pct_robotics": "tech_robotics", "pct_ui": "tech_ui",
}
JOB_LABELS = {"vacancy": "No. of vacancies per ad", "minExperience": "Min. Experience", "maxExperience": "Max. Experience", "avgSalary": "Yearly Wage"}
# Indicator -> (source, lowest code, highest code) (fixed values).
CATEGORIES: Mapping[str, Mapping[str, tuple[str, int, int]]] = {
    "Job Type": {"FullTime": ("jobAgreementType", 1, 1), "PartTime": ("jobAgreementType", 2, 2)},
    "Job Sector": {n: ("sector", i, i) for i, n in enumerate(("Agriculture", "Construction", "Manufacturing", "Services"), 1)},
    "Education": {
        "Schooled_Diploma": ("minEducationBranch", 1, 1), "Graduate_STEM": ("minEducationBranch", 2, 2),
        "Graduate_NonSTEM": ("minEducationBranch", 3, 3), "Graduate_Others": ("minEducationBranch", 4, 4),
        "PostGraduate": ("minEducationBranch", 5, 8), "PostGraduate_Above": ("minEducationBranch", 9, 9),
    },
}
STATISTICS = [("mean", 3), ("sd", 3), ("n", 0)]


def job_summary(jobs: DataFrame) -> DataFrame:
    """(section, variable, mean, sd, n): continuous variables, then each block of indicators listwise."""
    out = D.summarise(jobs, list(JOB_LABELS)).withColumn("section", F.lit(""))
    for section, block in CATEGORIES.items():
        rows = jobs.select(*[M.dummy(F.col(src).between(low, high), src).alias(n) for n, (src, low, high) in block.items()])
        out = out.unionByName(D.summarise(rows, list(block), listwise=True).withColumn("section", F.lit(section)))
    return out.select("section", "variable", "mean", "sd", "n")


def job_summary_lines(jobs: DataFrame) -> DataFrame:
    """The typeset table, with a line naming each block of indicators before its first one."""
    headings = {next(iter(block)): rf"\textbf{{\textit{{{section}:}}}}" for section, block in CATEGORIES.items()}
    return D.summary_lines(job_summary(jobs), JOB_LABELS, STATISTICS, headings)


def company_bins(sizes: DataFrame) -> DataFrame:
    """Companies binned by postings and by vacancies."""
    binned = Q.tiered_bins(cut_lineage(sizes), "size_post", 5, POST_TIERS, "bins_post")
    return Q.tiered_bins(binned, "size_vac", 5, VACANCY_TIERS, "bins_vac")


def postings_with_bins(binned: DataFrame, postings: DataFrame) -> DataFrame:
    from quadrat.operators.merge import merge_one_to_many

    return merge_one_to_many(binned, postings, ["companyId"], keep=(3,))


def technology_matrix(postings: DataFrame, bins: str, names: Sequence[int] = range(1, 9)) -> DataFrame:
    """Percent of emerging-technology postings per year, one column per bin."""
    shares = G.share_by(postings, ["year", bins], F.col("emergingTech"), out="bin")
    return R.to_wide(shares, ["year"], bins, ["bin"], list(names)).orderBy(F.col("year").asc_nulls_last())


def category_matrix(postings: DataFrame, bins: str, names: Sequence[int] = range(1, 9)) -> DataFrame:
    """Technology categories as rows, bins as columns, percent of emerging-technology postings."""
    shares = G.category_shares(postings, bins, F.col("emergingTech"), {n: F.col(c) for n, c in TECHNOLOGIES.items()})
    return R.transpose(shares, bins, list(names), varname="_varname")
