"""County and state tables to one wide county table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from quadrat.functions import keys as K
from quadrat.functions.missing import slice_equals
from quadrat.operators import groups as G
from quadrat.operators.merge import ensure_unique, left_join_chain
from quadrat.operators.numbering import forward_fill
from quadrat.operators.reshape import to_wide
from quadrat.session import cut_lineage

# Age group -> category; 0 is all ages, 2 is 15-29, 3 is 30-49 (fixed values).
AGE_CATEGORY = {
    0: 0, 1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2, 7: 3, 8: 3, 9: 3, 10: 3, 11: 1, 12: 1, 13: 1, 14: 1, 15: 1, 16: 1, 17: 1, 18: 1,
}
AGE_NAMES = {0: "AllAges", 2: "Ages15_29", 3: "Ages30_49"}
# Two counties that were one entity in the other sources (fixed values).
SPLIT_COUNTIES, JOINED_COUNTY = ["02063", "02066"], "02261"
TERRITORY_PREFIX = "72"
FINAL_COLUMNS = [
    "FIPS", "State", "County", "TotalPopulation", "DeathRate", "PovertyEstimate", "MedHHIncome", "Employed", "Unemployed",
    "DemocratVoteShare", "DemocratHouseReps", "RepublicanHouseReps", "LawOfficers", "OpioidDispRate", "WhitePct",
    "Age15-29Pct", "Age30-49Pct", "LessThanHighSchoolPct", "HighSchoolPct", "AssociateDegreePct", "BachelorOrHigherPct",
]
EDUCATION_COLUMNS = {
    "%Less than High School Graduate": "LessThanHighSchoolPct", "%High School Graduate": "HighSchoolPct",
    "%Some College or Associate's Degree": "AssociateDegreePct", "%Bachelor's degree or higher": "BachelorOrHigherPct",
}


def _fips(state: str, county: str):
    return K.compose_key(K.zero_pad(F.col(f"`{state}`"), 2), K.zero_pad(F.col(f"`{county}`"), 3))


def _pct(part: str, whole: str):
    return F.try_divide(F.col(part) * 100.0, F.col(whole))


def age_shares(people: DataFrame) -> DataFrame:
    """Percent aged 15-29 and 30-49; the split counties are joined on counts, before shares."""
    coded = people.select(
        _fips("STATE", "COUNTY").alias("FIPS"), K.recode("AGEGRP", AGE_CATEGORY, strict=True).alias("cat"), "TOT_POP")
    counts = G.sum_by(coded.filter(F.col("cat").isin(list(AGE_NAMES))), ["FIPS", "cat"], n="TOT_POP")
    wide = to_wide(counts.withColumn("cat", K.recode("cat", AGE_NAMES)), ["FIPS"], "cat", ["n"], list(AGE_NAMES.values()))
    wide = G.merge_entities(wide, "FIPS", SPLIT_COUNTIES, JOINED_COUNTY, [f"n{v}" for v in AGE_NAMES.values()])
    return wide.select("FIPS", _pct("nAges15_29", "nAllAges").alias("Age15-29Pct"), _pct("nAges30_49", "nAllAges").alias("Age30-49Pct"))


def white_share(people: DataFrame) -> DataFrame:
    rows = people.filter("AGEGRP = 0").select(
        _fips("STATE", "COUNTY").alias("FIPS"), F.col("TOT_POP").alias("TotalPopulation"), (F.col("WA_MALE") + F.col("WA_FEMALE")).alias("White"))
    joined = G.merge_entities(rows, "FIPS", SPLIT_COUNTIES, JOINED_COUNTY, ["TotalPopulation", "White"])
    return joined.select("FIPS", "TotalPopulation", _pct("White", "TotalPopulation").alias("WhitePct"))


def education_shares(education: DataFrame) -> DataFrame:
    rows = education.withColumn("FIPS", K.take_part("GEO_ID", "US", 1)).filter(~slice_equals("FIPS", 0, TERRITORY_PREFIX))
    return rows.select("FIPS", *[(F.col(f"`{c}`") * 100).alias(n) for c, n in EDUCATION_COLUMNS.items()])


def house_representatives(states: DataFrame, reps: DataFrame) -> DataFrame:
    """Representatives by state code; a state without a code keeps a missing code."""
    rows = states.select("State", "FIPS").join(reps, "State", "right")
    return rows.select(K.zero_pad("FIPS", 2).alias("StateFIPS"), F.col("Democatric").alias("DemocratHouseReps"), F.col("Republican").alias("RepublicanHouseReps"))


def vote_shares(votes: DataFrame) -> DataFrame:
    total = F.col("democratic") + F.col("independent") + F.col("other") + F.col("republican")
    return votes.select(K.zero_pad(F.col("`county number`"), 5).alias("FIPS"), F.try_divide(F.col("democratic") * 100.0, total).alias("DemocratVoteShare"))


def income_and_poverty(table: DataFrame) -> DataFrame:
    """County rows only (code 000 is the state); ``.`` and zero are missing."""
    rows = table.withColumn("FIPS", _fips("State FIPS Code", "County FIPS Code")).filter(~slice_equals("FIPS", 2, "000"))
    return rows.select(
        "FIPS", K.number_from_text(F.col("`Poverty Estimate`"), blank_mark=".").alias("PovertyEstimate"),
        K.number_from_text(F.col("`Median Household Income`"), blank_mark=".").alias("MedHHIncome"))


def law_officers(table: DataFrame, counties: DataFrame, line: str = "line_no") -> DataFrame:
    """State names run down the file; officers are summed per county and matched by name."""
    rows = forward_fill(table, "State", line).select(
        K.title_case("State").alias("State"), K.text_before("County", " County", " Police Department", " Public Safety").alias("County"),
        K.number_from_text(F.col("`Total officers`")).alias("n"))
    officers = G.sum_by(rows, ["State", "County"], LawOfficers="n")
    return officers.join(counties, ["State", "County"], "left").select("FIPS", "LawOfficers").filter("FIPS is not null")


def unemployment_counts(table: DataFrame) -> DataFrame:
    rows = table.withColumn("FIPS", _fips("State FIPS", "County FIPS")).filter(~slice_equals("FIPS", 0, TERRITORY_PREFIX))
    return rows.select("FIPS", K.number_from_text("Employed").alias("Employed"), K.number_from_text("Unemployed").alias("Unemployed"))


def county_table(t: Mapping[str, DataFrame]) -> DataFrame:
    """One row per county with a death rate; every joined table has unique county codes."""
    counties = t["county_fips"].select(K.zero_pad("FIPS", 5).alias("FIPS"), "State", "County")
    deaths = t["drug_overdose"].select(K.zero_pad("FIPS", 5).alias("FIPS"), F.col("`Model-based Death Rate`").alias("DeathRate"))
    base = deaths.join(counties, "FIPS", "inner").withColumn("StateFIPS", F.substring("FIPS", 1, 2))
    base = base.join(house_representatives(t["state_fips"], t["house_reps"]), "StateFIPS", "left").drop("StateFIPS")
    opioids = t["opioid_disp"].select(
        K.zero_pad(F.col("`County FIPS Code`"), 5).alias("FIPS"), F.col("`Opioid Dispensing Rate per 100`").alias("OpioidDispRate"))
    parts = [
        age_shares(t["age_sex_race"]), white_share(t["age_sex_race"]), income_and_poverty(t["income_poverty"]),
        law_officers(t["law_employees"], counties), opioids, unemployment_counts(t["unemployment"]),
        education_shares(t["education"]), vote_shares(t["party_votes"]),
    ]
    joined = left_join_chain(base, [ensure_unique(cut_lineage(p), ["FIPS"]) for p in parts], "FIPS")  # a row per county
    return joined.select(*[F.col(f"`{c}`") for c in FINAL_COLUMNS]).orderBy(F.col("State").asc_nulls_last(), F.col("County").asc_nulls_last())
