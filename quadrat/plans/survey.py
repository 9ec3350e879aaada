"""Survey analysis: recodes, summary tables, weighted tables, regressions, t tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadrat.functions import keys as K, missing as M
from quadrat.operators import describe as D, groups as G
from quadrat.operators.regress import Cross, Factor, Fit, absorb_regression, regression_lines
from quadrat.operators.reshape import columns_like

WEIGHT = "poi_adj_weight_mem"
# Age ranges and codes; the last one is open and takes unknown ages (fixed values).
AGE_RANGES = [
    (15, 25, 1), (26, 30, 26), (31, 35, 31), (36, 40, 36), (41, 45, 41), (46, 50, 46), (51, 55, 51), (56, 60, 56), (61, None, 61),
]
CASTE_ORDER = {1: "GEN", 2: "OBC", 3: "SC", 4: "ST"}
FULL_CASTE_ORDER = {1: "Upper Caste", 2: "Intermediate Caste", 3: "OBC", 4: "SC", 5: "ST"}
EDUCATION_ORDER = {1: "No Education", 2: "Primary & Above"}
# Income groups in order (fixed values).
INCOME_ORDER = {
    0: "<=36000", 1: "36000 - 48000", 2: "48000 - 60000", 3: "60000 - 72000", 4: "72000 - 84000", 5: "84000 - 100000", 6: "100000 - 120000",
    7: "120000 - 150000", 8: "150000 - 200000", 9: "200000 - 250000", 10: "250000 - 300000", 11: "300000 - 400000", 12: "400000 - 500000",
    13: "500000 - 600000", 14: "600000 - 700000", 15: "700000 - 800000", 16: "800000 - 900000", 17: "900000 - 1000000", 18: "1000000 - 1200000",
    19: "1200000 - 1500000", 20: "1500000 - 1800000", 21: "1800000 - 2000000", 22: "2000000 - 2400000", 23: "2400000 - 3600000", 24: ">3600000",
}
RELIGIONS = ("Hindu", "Muslim", "Christian", "Sikh")
LABELS = {
    "female": "Female", "rural": "Rural", "literacy": "Literate", "married": "Married", "emp_work_force": "In Work Force",
    "labour_force": "In Labor Force", "employed": "Employed", "self_employed": "Self-Employed",
    "time_spent_on_work": "Time Spent Working", "time_spent_on_hh": "Time Spent on Household Work",
    "time_spent_on_self": "Time Spent on Self", "time_spent_on_learning": "Time Spent Learning",
    "hh_monthly_income": "HH Monthly Income", "hh_monthly_expense": "HH Monthly Expense",
    "hh_has_outstanding_borrowing": "HH has Outstanding Borrowings",
}
TIME_AND_WORK = [
    "time_spent_on_work", "time_spent_on_hh", "time_spent_on_self", "time_spent_on_learning", "employed", "emp_work_force", "labour_force"]
CONTROLS = ["married", "literacy", "hh_adult_15_size", "hh_has_outstanding_borrowing"]
WEALTH_BY_CASTE = Cross((Factor("hh_wealth_index1_quintile"), Factor("ordered_std_caste_category")))
LAND_BY_CASTE = Cross((Factor("hh_extra_land_owned"), Factor("ordered_std_caste_category")))
LAND_CASTE_ONLY = Cross((Factor("hh_extra_land_owned"), Factor("ordered_std_caste_category")), full=False)


def recode(raw: DataFrame) -> DataFrame:
    """Derived variables, dummies and ordered codes."""
    status = F.col("employment_status")
    rows = raw.withColumns({
        "education_level": K.keep_categories("education", ["No Education"], "Primary & Above"),
        "religion": K.keep_categories("religion", RELIGIONS, "Other Religion"),
        "time_spent_on_work": M.overwrite_when("time_spent_on_work", M.ne_m(status, "Employed")),
        "emp_work_force": F.col("employed"), "age_group": K.range_code("age_yrs", AGE_RANGES),
    }).withColumn("employed", M.flag(status == "Employed"))
    rows = G.spread(rows, ["hh_id"], {"hh_adult_15_size": F.count("mem_id")})
    for source, prefix in (("age_group", "agbinary"), ("std_caste_category", "castebinary"), ("religion", "religionbinary"), ("education_level", "edubinary")):
        rows = K.one_hot(rows, source, prefix)
    rows = rows.withColumns({
        "ordered_caste_category": K.label_codes("caste_category", FULL_CASTE_ORDER),
        "ordered_std_caste_category": K.label_codes("std_caste_category", CASTE_ORDER),
        "ordered_education_level": K.label_codes("education_level", EDUCATION_ORDER),
        "ordered_hh_income_group": K.label_codes("hh_income_group", INCOME_ORDER),
    })
    return K.set_label(rows, {n: text for n, text in LABELS.items() if n in rows.columns}, {
        "ordered_caste_category": FULL_CASTE_ORDER, "ordered_std_caste_category": CASTE_ORDER,
        "ordered_education_level": EDUCATION_ORDER, "ordered_hh_income_group": INCOME_ORDER,
    })


def summary(rows: DataFrame) -> DataFrame:
    """Unweighted mean, sd, minimum and maximum of the binary variables."""
    names = ["female", "rural", "married", "literacy", *columns_like(rows, "agbinary*", "religionbinary*", "castebinary*", "edubinary*"),
             "labour_force", "emp_work_force", "employed", "self_employed"]
    return D.summarise(rows, names, ["mean", "sd", "min", "max"])


def weighted_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Weighted percents: employment by sex, category distribution, wealth and education by category."""
    pairs = {
        "employed": ("female", "employed"), "work_force": ("female", "emp_work_force"), "labour_force": ("female", "labour_force"),
        "pca_caste": ("hh_wealth_index1_quintile", "ordered_std_caste_category"),
        "education_caste": ("ordered_education_level", "ordered_std_caste_category"),
        "education_pca": ("ordered_education_level", "hh_wealth_index1_quintile"),
    }
    out = {n: D.crosstab(rows, r, c, WEIGHT) for n, (r, c) in pairs.items()}
    return {**out, "caste": D.tabulate(rows, "ordered_std_caste_category", WEIGHT)}


def regressions(rows: DataFrame, absorb: str = "psu_id", extra: list[str] | None = None) -> dict[str, Fit]:
    """Ten weighted models for rural women: wealth, land and time use by category.

    ``absorb`` is also the cluster; ``extra`` controls enter the models with controls.
    """
    women = rows.filter("female = 1 and rural = 1")
    working = women.filter("employed = 1")
    extra = extra or []
    land = ["hh_extra_land_owned"]
    out = {}

    def fit(name, frame, y, terms):
        out[name] = absorb_regression(frame, y, terms, [absorb], weight=WEIGHT, cluster=absorb, model=name)

    for y in ("employed", "labour_force"):
        fit(f"{y}_wealth", women, y, [WEALTH_BY_CASTE])
        fit(f"{y}_wealth_controls", women, y, [WEALTH_BY_CASTE, *CONTROLS, *land, *extra])
        fit(f"{y}_land", women, y, [LAND_BY_CASTE])
        fit(f"{y}_land_controls", women, y, [LAND_BY_CASTE, *CONTROLS, *extra])
    fit("time", working, "time_spent_on_work", [WEALTH_BY_CASTE, *land, LAND_CASTE_ONLY])
    fit("time_controls", working, "time_spent_on_work", [WEALTH_BY_CASTE, *land, LAND_CASTE_ONLY, *CONTROLS, *land, *extra])
    return out


def regression_table(fits: dict[str, Fit]) -> DataFrame:
    """Typeset body of the models, with their F statistic."""
    return regression_lines(list(fits.values()), statistics=("n", "ymean", "r2", "f"))


def t_tests(rows: DataFrame) -> dict[str, DataFrame]:
    """Nine tables: three groupings, each for everyone, rural men and rural women."""
    subsets = {"all": F.lit(True), "rural_men": (F.col("rural") == 1) & (F.col("female") == 0), "rural_women": (F.col("rural") == 1) & (F.col("female") == 1)}
    groupings = {"caste": ("castebinary1", 0, 1), "religion": ("religionbinary2", 0, 1), "education": ("ordered_education_level", 1, 2)}
    return {
        f"{g}_{s}": D.t_tests(rows.filter(cond), TIME_AND_WORK, by, a, b)
        for g, (by, a, b) in groupings.items() for s, cond in subsets.items()
    }
