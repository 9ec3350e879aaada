"""Four household survey files to a person panel and a household panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quadrat.functions import keys as K, missing as M
from quadrat.operators import groups as G, merge as J, reshape as R

# Markers of a missing answer (fixed values).
UNKNOWN = ("Data Not Available", "Not Applicable", "Not Stated")
UNKNOWN_PERSON = (*UNKNOWN, "Religion not stated")
UNKNOWN_HOUSEHOLD = (*UNKNOWN, "Not applicable")
MISSING_CODES = (-99, -100)
FARMER_JOBS = ("Small Farmer", "Organised Farmer")
FARM_INDUSTRIES = (
    "Crop Cultivation", "Poultry Farming, Animal Husbandry and Vermiculture", "Plantation Crop Cultivation",
    "Fruits and Vegetable Farming", "Agriculture- allied activities", "Fishing",
)
FARM_JOBS = ("Agricultural Labourer", *FARMER_JOBS)
# Social categories from the highest down (fixed values).
CASTES = ("Upper Caste", "Intermediate Caste", "OBC", "SC", "ST")
OPEN_INCOME_LABELS = {"<=36000": "36000", ">3600000": "3600000"}
# Household columns of the asset file (fixed values).
ASSETS = (
    "air_conditioners_owned", "cars_owned", "cattle_owned", "computers_owned", "coolers_owned", "genset_inverters_owned", "houses_owned",
    "refrigerators_owned", "televisions_owned", "tractors_owned", "two_wheelers_owned", "washing_machines_owned",
)
GROUPS = ("age_group", "education_group", "gender_group", "income_group")
BORROWING = (
    "has_outstanding_borrowing", "borrowed_from_bank", "borrowed_from_money_lender", "borrowed_from_employer", "borrowed_from_rel_friends",
    "borrowed_from_nbfc_dealer", "borrowed_from_shg", "borrowed_from_mfi", "borrowed_from_chitfunds", "borrowed_from_credit_cards",
    "borrowed_from_shops", "borrowed_from_other_sources",
)
YES_NO_PERSON = ("literacy", "has_bank_ac", "has_creditcard", "has_kisan_creditcard", "has_mobile")


def persons(raw: DataFrame) -> DataFrame:
    """Accepted members aged 15 and over (or of unknown age) with indicators and weight."""
    rows = raw.filter(
        M.blank_to_null("response_status").eqNullSafe(F.lit("Accepted"))
        & M.blank_to_null("member_status").eqNullSafe(F.lit("Member of the household")) & M.ge_m("age_yrs", 15))
    rows = M.recode_sentinel_strings(rows, UNKNOWN_PERSON)
    rows = rows.withColumns({c: M.zero_then_missing(c) for c in R.columns_like(rows, "time*")})
    status, arrangement, job, industry = (F.col(c) for c in (
        "employment_status", "employment_arrangement", "nature_of_occupation", "industry_of_occupation"))
    owns = (F.col("place_of_work") == "Own-farm") | ((arrangement == "Self-employed") & job.isin(*FARMER_JOBS))
    rows = rows.withColumns({
        "personal_id": F.substring(K.compose_key("hh_id", "mem_id", sep="_"), 1, 20),
        "poi_adj_weight_mem": F.col("ge15_mem_weight_w") * F.col("ge15_mem_non_response_w"),
        **{c: M.yes_no(c) for c in YES_NO_PERSON},
        "labour_force": M.flag(status != "Unemployed, not willing and not looking for a job", status.isNotNull()),
        "currently_employed": M.flag(status == "Employed", status.isNotNull()),
        "self_employed": M.flag(arrangement == "Self-employed", arrangement.isNotNull()),
        "female": M.flag(F.col("gender") == "F", F.col("gender").isNotNull()),
        "married": M.flag(F.col("marital_status") == "Married", F.col("marital_status").isNotNull()),
        "rural": M.flag(F.col("region_type") == "RURAL"), "owns_farm": M.flag(owns),
        "agricultural_work": M.flag(F.coalesce(industry.isin(*FARM_INDUSTRIES), F.lit(False)) | F.coalesce(job.isin(*FARM_JOBS), F.lit(False))),
        "time_spent_on_self": F.lit(24.0) - F.col("time_spent_on_work_for_employer") - F.col("time_spent_on_work_for_hh_and_me"),
    }).withColumnsRenamed({"time_spent_on_work_for_employer": "time_spent_on_work", "time_spent_on_work_for_hh_and_me": "time_spent_on_hh"})
    rows = rows.drop("response_status", "member_status", "ge15_mem_weight_w", "ge15_mem_non_response_w", "gender", "marital_status", "region_type", "place_of_work")
    return G.spread(rows, ["hh_id"], {"hh_owns_farm": F.max("owns_farm")})


def caste_ranks(people: DataFrame) -> DataFrame:
    """Share of a sampling unit that belongs to higher-ranked categories, per (unit, category)."""
    counts = people.filter("caste_category is not null").groupBy("psu_id", "caste_category").agg(F.count("personal_id").alias("n_"))
    wide = R.fill_zero(R.to_wide(counts, ["psu_id"], "caste_category", ["n_"], CASTES), "n_")
    total = sum((F.col(f"`n_{c}`") for c in CASTES[1:]), F.col(f"`n_{CASTES[0]}`"))
    above, shares = F.lit(0), []
    for c in CASTES:
        shares.append((F.lit(0.0) if c == CASTES[0] else F.try_divide(above.cast("double"), total)).alias(f"rank_{c}"))
        above = above + F.col(f"`n_{c}`")
    return R.to_long(wide.select("psu_id", *shares), ["psu_id"], "rank_", "caste_category", value="caste_rank")


def monthly_means(months: DataFrame, amounts: dict[str, str], weight: str) -> DataFrame:
    """Household means over the months; ``months`` is the monthly files read as one table."""
    rows = M.recode_sentinel_strings(months.filter(M.blank_to_null("response_status").eqNullSafe(F.lit("Accepted"))), UNKNOWN_HOUSEHOLD)
    rows = M.recode_sentinel_numbers(rows, MISSING_CODES)
    return rows.groupBy("hh_id").agg(
        *[F.avg(c).alias(n) for c, n in amounts.items()],
        F.avg(F.col("hh_weight_ms") * F.col("hh_non_response_ms")).alias(weight),
    )


def income_means(months: DataFrame) -> DataFrame:
    return monthly_means(months, {"total_income": "hh_monthly_income"}, "income_adj_avg_weight_hh")


def expense_means(months: DataFrame) -> DataFrame:
    return monthly_means(
        months, {"total_expenditure": "hh_monthly_expense", "monthly_expense_on_house_rent": "hh_monthly_rent_expense"}, "expense_adj_avg_weight_hh")


def assets(raw: DataFrame) -> DataFrame:
    """Household assets, borrowing and the upper end of the income group."""
    rows = M.recode_sentinel_strings(raw.filter(M.blank_to_null("response_status").eqNullSafe(F.lit("Accepted"))), UNKNOWN_HOUSEHOLD)
    saved, outstanding = F.col("has_saved_in_real_estate"), F.col("has_outstanding_saving_in_real_e")
    return rows.select(
        "hh_id", (F.col("hh_non_response_w") * F.col("hh_weight_w")).alias("aspirational_adj_weight_hh"),
        *[F.col(g).alias(f"hh_{g}") for g in GROUPS], *[F.col(a).alias(f"hh_{a}") for a in ASSETS],
        F.when((saved == "Y") | (outstanding == "Y"), 1).when((saved == "N") & (outstanding == "N"), 0).alias("hh_real_estate"),
        M.clamp_negative("power_availability_in_hours_per_").alias("hh_daily_electricity_hrs"),
        (M.clamp_negative("water_availability_in_days_per_w") * M.clamp_negative("water_availability_in_hours_per_")).alias("hh_weekly_water_hrs"),
        *[M.yes_no(c).alias(f"hh_{c}") for c in BORROWING],
        K.interval_ceiling("income_group", OPEN_INCOME_LABELS).alias("hh_income_group_ceil"),
    )


def person_panel(people: DataFrame, income_months: DataFrame, expense_months: DataFrame, aspirations: DataFrame) -> DataFrame:
    """Persons with category rank, household income, expenses and assets."""
    panel = J.merge_one_to_many(caste_ranks(people), people, ["psu_id", "caste_category"], validate=False)
    panel = J.merge_one_to_many(income_means(income_months), panel, ["hh_id"], validate=False)
    panel = J.merge_one_to_many(expense_means(expense_months), panel, ["hh_id"], validate=False)
    panel = J.merge_one_to_many(assets(aspirations), panel, ["hh_id"])
    estate, houses, rent = F.col("hh_real_estate") == 1, "hh_houses_owned", "hh_monthly_rent_expense"
    land = (
        (estate & M.gt_m(houses, 1) & F.coalesce(F.col(rent) == 0, F.lit(False)))
        | (estate & M.gt_m(houses, 0) & M.gt_m(rent, 0)) | (F.col("hh_owns_farm") == 1)
    )
    return panel.withColumn("hh_extra_land_owned", M.flag(land)).drop(rent)


def household_panel(panel: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per household with its modal category; ties go to the higher category."""
    rank = K.recode("caste_category", {c: i for i, c in enumerate(CASTES, 1)}, default=len(CASTES) + 1)
    mode = G.mode_by(panel, ["hh_id"], "caste_category", rank, count_of="personal_id").select("hh_id", "caste_category")
    first = G.first_rows(panel, ["hh_id", "caste_category"], ["mem_id"])
    keys = F.col("f.hh_id").eqNullSafe(F.col("m.hh_id")) & F.col("f.caste_category").eqNullSafe(F.col("m.caste_category"))
    one = first.alias("f").join(mode.alias("m"), keys, "left_semi")
    households = one.select(*keep) if keep else one
    return J.declare_panel(households, "hh_id", "wave_no")
