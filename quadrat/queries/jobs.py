"""Composed jobs and file sources over whole tables, each with its own way to the same rows in SQL."""

from functools import reduce

from pyspark.sql import functions as F

from quadrat.functions import keys as K, text as X
from quadrat.operators import infer as I
from quadrat.plans import county, entities, markets, panel, survey, vectors, villages
from quadrat.queries.registry import Tables, query
from quadrat.queries.text import _COMPONENTS, components, village_lines, village_page
from quadrat.session import cut_lineage, new_folder
from quadrat.sources import readers as S, writers as O

_TITLE = "array_to_string(list_transform(string_split(lower({c}), ' '), lambda x: upper(x[1]) || x[2:]), ' ')"
_VOTES = {
    "democratic": "l_orderkey % 5 < 2", "independent": "l_orderkey % 5 = 2", "other": "l_orderkey % 5 = 3", "republican": "l_orderkey % 5 = 4",
}
_LATE, _RETURNED, _ACCEPTED = "l_shipdate >= DATE '1997-01-01'", "l_returnflag = 'R'", "l_returnflag = 'A'"


@query("county_job", f"""
    WITH m AS (
        SELECT l_suppkey AS k, count(*) AS n, count(*) FILTER ({_RETURNED}) AS returned, count(*) FILTER ({_ACCEPTED}) AS accepted, count(*) FILTER ({_LATE}) AS late,
               count(*) FILTER (l_linenumber = 1) AS first, count(*) FILTER ((l_orderkey + l_linenumber) % 18 IN (3, 4, 5)) AS young, count(*) FILTER ((l_orderkey + l_linenumber) % 18 IN (6, 7, 8, 9)) AS middle,
               {", ".join(f"count(*) FILTER ({c}) AS {v}" for v, c in _VOTES.items())} FROM lineitem GROUP BY 1),
    counties AS (SELECT *, lpad(s_suppkey::VARCHAR, 5, '0') AS fips, {_TITLE.format(c="n_name")} AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    people AS (SELECT CASE WHEN lpad(k::VARCHAR, 5, '0') IN ('02063', '02066') THEN '02261' ELSE lpad(k::VARCHAR, 5, '0') END AS fips, sum(n) AS n, sum(accepted + first) AS white, sum(young) AS young, sum(middle) AS middle FROM m GROUP BY 1),
    reps AS (SELECT lpad(c_nationkey::VARCHAR, 2, '0') AS code, count(*) FILTER (c_acctbal > 0) AS dem, count(*) FILTER (c_acctbal <= 0) AS rep FROM customer GROUP BY 1),
    officers AS (SELECT state, s_name, sum(late) AS officers FROM m JOIN counties ON k = s_suppkey GROUP BY 1, 2)
    SELECT c.fips AS "FIPS", c.state AS "State", c.s_name AS "County", p.n::BIGINT AS "TotalPopulation", round(100.0 * returned / m.n, 6) AS "DeathRate",
           CASE WHEN k % 1000 <> 0 AND k % 10 <> 0 THEN nullif(m.n * 10, 0) END AS "PovertyEstimate", CASE WHEN k % 1000 <> 0 THEN nullif(late * 100, 0) END AS "MedHHIncome",
           CASE WHEN left(c.fips, 2) <> '72' THEN returned END AS "Employed", CASE WHEN left(c.fips, 2) <> '72' THEN accepted END AS "Unemployed",
           round(100.0 * democratic / (democratic + independent + other + republican), 6) AS "DemocratVoteShare", dem AS "DemocratHouseReps", rep AS "RepublicanHouseReps",
           officers::BIGINT AS "LawOfficers", round(100.0 * late / m.n, 6) AS "OpioidDispRate", round(100.0 * p.white / p.n, 6) AS "WhitePct", round(100.0 * p.young / p.n, 6) AS "Age15-29Pct",
           round(100.0 * p.middle / p.n, 6) AS "Age30-49Pct", {", ".join(f"CASE WHEN left(c.fips, 2) <> '72' THEN round(100.0 * {v} / m.n, 6) END AS {chr(34)}{n}{chr(34)}" for v, n in (("returned", "LessThanHighSchoolPct"), ("accepted", "HighSchoolPct"), ("late", "AssociateDegreePct"), ("first", "BachelorOrHigherPct")))}
    FROM m JOIN counties c ON k = s_suppkey LEFT JOIN people p ON p.fips = c.fips LEFT JOIN reps ON code = left(c.fips, 2) LEFT JOIN officers o ON o.state = c.state AND o.s_name = c.s_name
""")
def county_job(t: Tables):
    """The whole county job: suppliers stand for counties, their order lines for what is counted there."""
    of = lambda c: F.count(F.when(F.expr(c), 1))
    group = (F.lit(1) + (F.col("l_orderkey") + F.col("l_linenumber")) % 18).cast("int").alias("AGEGRP")
    cells = cut_lineage(t.lineitem.groupBy(F.col("l_suppkey").alias("k"), group).agg(
        F.count(F.lit(1)).alias("TOT_POP"), of(_ACCEPTED).alias("WA_MALE"), of("l_linenumber = 1").alias("WA_FEMALE"), of(_RETURNED).alias("returned"),
        of(_LATE).alias("late"), *[of(c).alias(v) for v, c in _VOTES.items()]))
    sums = ["TOT_POP", "WA_MALE", "WA_FEMALE", "returned", "late", *_VOTES]
    m = cut_lineage(cells.groupBy("k").agg(*[F.sum(c).alias(c) for c in sums]))
    code = [F.floor(F.col("k") / 1000).cast("string").alias("{0}"), (F.col("k") % 1000).cast("string").alias("{1}")]
    at = lambda state, place: [c.alias(n) for c, n in zip(code, (state, place))]
    share = lambda c: F.col(c) / F.col("TOT_POP")
    people = ["AGEGRP", "TOT_POP", "WA_MALE", "WA_FEMALE"]
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("k"), "s_name", "n_name", "n_nationkey")
    first = places.groupBy("n_nationkey").agg(F.min("k").alias("first"))
    suffix = F.element_at(F.array(F.lit(" County"), F.lit(" Police Department"), F.lit(" Public Safety")), (F.col("k") % 3 + 1).cast("int"))
    law = places.join(first, "n_nationkey").join(m.select("k", "late"), "k").select(
        (F.col("n_nationkey").cast("bigint") * 1_000_000_000 + F.col("k")).alias("line_no"), F.when(F.col("k") == F.col("first"), F.col("n_name")).alias("State"),
        F.concat("s_name", suffix).alias("County"), F.format_number("late", 0).alias("Total officers"))
    side = lambda c, name: F.count(F.when(F.expr(c), 1)).alias(name)
    seats = t.customer.groupBy("c_nationkey").agg(side("c_acctbal > 0", "Democatric"), side("c_acctbal <= 0", "Republican"))
    out = county.county_table({
        "county_fips": places.select(F.col("k").cast("string").alias("FIPS"), K.title_case("n_name").alias("State"), F.col("s_name").alias("County")),
        "drug_overdose": m.select(F.col("k").cast("string").alias("FIPS"), (share("returned") * 100).alias("Model-based Death Rate")),
        "state_fips": t.nation.select(F.col("n_name").alias("State"), F.col("n_nationkey").cast("string").alias("FIPS")),
        "house_reps": t.nation.join(seats, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("State"), "Democatric", "Republican"),
        "opioid_disp": m.select(F.col("k").cast("string").alias("County FIPS Code"), (share("late") * 100).alias("Opioid Dispensing Rate per 100")),
        "age_sex_race": cells.select(*at("STATE", "COUNTY"), *people).unionByName(m.select(*at("STATE", "COUNTY"), F.lit(0).alias("AGEGRP"), *people[1:])),
        "income_poverty": m.select(*at("State FIPS Code", "County FIPS Code"), F.when(F.col("k") % 10 == 0, ".").otherwise(F.format_number(F.col("TOT_POP") * 10, 0)).alias("Poverty Estimate"),
                                   F.format_number(F.col("late") * 100, 0).alias("Median Household Income")),
        "law_employees": law,
        "unemployment": m.select(*at("State FIPS", "County FIPS"), F.format_number("returned", 0).alias("Employed"), F.format_number("WA_MALE", 0).alias("Unemployed")),
        "education": m.select(F.concat(F.lit("0500000US"), K.zero_pad(F.col("k").cast("string"), 5)).alias("GEO_ID"), *[
            share(c).alias(n) for c, n in zip(("returned", "WA_MALE", "late", "WA_FEMALE"), county.EDUCATION_COLUMNS)]),
        "party_votes": m.select(F.col("k").cast("string").alias("county number"), *_VOTES),
    })
    return out.select(*[F.round(f"`{c}`", 6).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in out.dtypes])


@query("household_months", """
    WITH r AS (SELECT o_custkey AS hh_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS income, (1 + o_orderkey % 3) / 2.0 AS w, (1 + o_custkey % 4) / 4.0 AS nr FROM orders WHERE o_orderstatus <> 'P' AND year(o_orderdate) IN (1993, 1994))
    SELECT hh_id, round(avg(income), 4) AS hh_monthly_income, round(avg(w * nr), 6) AS weight FROM r GROUP BY 1
""")
def household_months(t: Tables):
    """Monthly files of orders read as one table; household means with their composite weight."""
    root = new_folder(t.spark, "months")
    rows = t.orders.filter(F.year("o_orderdate").isin(1993, 1994)).select(
        F.col("o_custkey").alias("hh_id"), F.when(F.col("o_orderstatus") == "P", "Non-response").otherwise("Accepted").alias("response_status"),
        F.when(F.col("o_orderkey") % 11 == 0, -99.0).otherwise(F.col("o_totalprice").cast("double")).alias("total_income"),
        ((F.col("o_orderkey") % 3 + 1) / 2).alias("hh_weight_ms"), ((F.col("o_custkey") % 4 + 1) / 4).alias("hh_non_response_ms"),
        F.date_format(F.last_day("o_orderdate"), "yyyyMMdd").alias("stamp"))
    rows.withColumn("file", F.concat(F.lit("income_"), "stamp")).drop("stamp").write.partitionBy("file").option("header", True).csv(root)
    months = S.read_monthly(t.spark, root, "hh_id bigint, response_status string, total_income double, hh_weight_ms double, hh_non_response_ms double")
    means = panel.income_means(months)
    return means.select("hh_id", F.round("hh_monthly_income", 4).alias("hh_monthly_income"), F.round("income_adj_avg_weight_hh", 6).alias("weight"))


@query("monthly_files", """
    SELECT month(o_orderdate)::INTEGER AS file_month, count(*) AS n, sum(o_custkey)::BIGINT AS customers FROM orders GROUP BY 1
""")
def monthly_files(t: Tables):
    """Orders in one folder per month, the month read back from the folder's name."""
    root = new_folder(t.spark, "months")
    rows = t.orders.select("o_custkey", F.concat(F.lit("orders_"), F.date_format(F.last_day("o_orderdate"), "yyyyMMdd")).alias("file"))
    rows.write.partitionBy("file").option("header", True).csv(root)
    return S.read_monthly(t.spark, root, "o_custkey bigint").groupBy("file_month").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"))


@query("file_part_index", "SELECT lang AS file_idx, count(*) AS n, count(DISTINCT doc_id) AS documents FROM documents GROUP BY 1")
def file_part_index(t: Tables):
    """The index part of the name of the file that each document would stand in."""
    name = F.concat(F.lit("raw_papers_"), "lang", F.lit(".txt"))
    return t.documents.select(S.file_part(name).alias("file_idx"), "doc_id").groupBy("file_idx").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("documents"))


@query("prompt_file", """
    SELECT doc_id, md5('List the names.' || chr(10) || 'One a line.' || ' | ' || text) AS digest FROM documents WHERE text IS NOT NULL
""")
def prompt_file(t: Tables):
    """A prompt kept in a text file, trimmed on reading, before every whole text."""
    path = new_folder(t.spark, "prompt")
    t.spark.range(1).select(F.lit("\n List the names.\nOne a line. \n").alias("value")).coalesce(1).write.text(path)
    prompt = S.read_prompt(t.spark, path)
    made = X.render_prompt("{system} | {user}", system=F.lit(prompt), user="text")
    return t.documents.filter("text is not null").select("doc_id", F.md5(made.cast("binary")).alias("digest"))


@query("table_sink", """
    SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_orderdate) AS last FROM orders GROUP BY 1
""")
def table_sink(t: Tables):
    """A result saved as a table, saved again over itself, and read on."""
    path = new_folder(t.spark, "table")
    O.write_table(t.orders.limit(0), path)
    saved = O.write_table(t.orders, path)
    return saved.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_orderdate").alias("last"))


# Households are customers, their members the orders, sampling units the nations; each answer follows from the keys.
_PEOPLE = """
    SELECT o_custkey AS hh_id, o_orderkey AS k, c_nationkey AS psu_id, CASE WHEN o_orderkey % 11 <> 0 THEN left(o_orderpriority, 1)::INTEGER END AS caste,
           CASE WHEN o_orderkey % 19 <> 0 THEN 5 + o_orderkey % 70 END AS age, (1 + o_orderkey % 4) * (1 + o_custkey % 3) / 2.0 AS weight,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS female, CASE WHEN o_orderkey % 10 = 1 THEN NULL ELSE (o_orderkey % 2 = 0)::INTEGER END AS married,
           CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS working, (o_orderkey % 4 < 2)::INTEGER AS self_employed, (c_nationkey % 2 = 0)::INTEGER AS rural,
           (o_orderkey % 23 = 0 OR (o_orderkey % 4 < 2 AND o_orderkey % 5 = 0))::INTEGER AS owns_farm, (o_orderkey % 7 = 0 OR o_orderkey % 5 < 2)::INTEGER AS farm_work,
           CASE o_orderkey % 6 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE o_orderkey % 6 END AS work, CASE o_orderkey % 9 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE o_orderkey % 9 END AS home
    FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND (o_orderkey % 19 = 0 OR o_orderkey % 70 >= 10)"""
_HOUSES = """
    SELECT c_custkey AS hh_id, CASE WHEN c_custkey % 5 < 4 THEN c_custkey % 5 END AS houses,
           CASE WHEN c_custkey % 3 = 0 OR c_custkey % 7 = 0 THEN 1 WHEN c_custkey % 3 = 1 THEN 0 END AS estate, greatest(0, c_custkey % 8 - 2) * (c_custkey % 6) AS water,
           CASE c_custkey % 4 WHEN 0 THEN 36000.0 WHEN 1 THEN 48000.0 WHEN 2 THEN 3600000.0 END AS ceiling, CASE c_custkey % 9 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 0 END AS borrows
    FROM customer WHERE c_custkey % 10 <> 3"""
_PANEL = f"""
    WITH p AS ({_PEOPLE}), h AS ({_HOUSES}),
    ranks AS (SELECT a.psu_id, a.caste, sum(CASE WHEN b.caste < a.caste THEN b.n ELSE 0 END) / sum(b.n) AS caste_rank
              FROM (SELECT psu_id, caste, count(*) AS n FROM p WHERE caste IS NOT NULL GROUP BY 1, 2) a
              JOIN (SELECT psu_id, caste, count(*) AS n FROM p WHERE caste IS NOT NULL GROUP BY 1, 2) b ON a.psu_id = b.psu_id GROUP BY 1, 2),
    months AS (SELECT o_custkey AS hh_id, avg(CASE WHEN o_orderkey % 11 <> 0 THEN cents END) AS income, avg(CASE WHEN o_orderkey % 12 <> 0 THEN cents * 3 END) AS expense,
                      avg(CASE WHEN o_custkey % 2 = 0 THEN 0.0 WHEN o_orderkey % 12 <> 0 THEN cents END) AS rent,
                      avg((1 + o_orderkey % 3) / 2.0 * (1 + o_custkey % 4) / 4.0) AS weight FROM (SELECT *, round(o_totalprice * 100)::DOUBLE AS cents FROM orders) WHERE o_orderstatus <> 'P' GROUP BY 1),
    panel AS (SELECT p.*, caste_rank, max(owns_farm) OVER (PARTITION BY p.hh_id) AS hh_farm, m.income, m.expense, m.weight AS hh_weight, h.estate, h.houses, h.water, h.ceiling, h.borrows, m.rent
              FROM p LEFT JOIN ranks USING (psu_id, caste) LEFT JOIN months m ON m.hh_id = p.hh_id LEFT JOIN h ON h.hh_id = p.hh_id)
"""


def _panel(t: Tables):
    """The four survey files, made from orders and customers, as one person panel."""
    pick = lambda key, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))
    k, hh = F.col("o_orderkey"), F.col("o_custkey")
    coded = lambda n: F.when(k % n == 0, -100.0).when(k % n == 1, -5.0).otherwise((k % n).cast("double"))
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    people = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("psu_id")), "o_custkey").select(
        hh.alias("hh_id"), k.alias("mem_id"), "psu_id", F.lit(18).alias("wave_no"), F.when(k % 13 == 0, "Refused").otherwise("Accepted").alias("response_status"),
        F.when(k % 17 == 0, "Emigrated").otherwise("Member of the household").alias("member_status"), F.when(k % 19 != 0, 5 + k % 70).alias("age_yrs"),
        (1.0 + k % 4).alias("ge15_mem_weight_w"), ((1 + hh % 3) / 2).alias("ge15_mem_non_response_w"),
        F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "O", "M").otherwise("Not Stated").alias("gender"),
        F.when(k % 10 == 1, "Not Stated").when(k % 2 == 0, "Married").otherwise("Unmarried").alias("marital_status"),
        F.when(F.col("psu_id") % 2 == 0, "RURAL").otherwise("URBAN").alias("region_type"), pick("o_orderkey", "Hindu", "Religion not stated", "Sikh").alias("religion"),
        F.when(k % 11 == 0, "Not Stated").otherwise(F.element_at(F.array(*[F.lit(c) for c in panel.CASTES]), rank)).alias("caste_category"),
        *[pick("o_orderkey", "Y", "N", "Not Stated").alias(c) for c in panel.YES_NO_PERSON],
        pick("o_orderkey", "Small Farmer", "Agricultural Labourer", "Clerk", "Clerk", "").alias("nature_of_occupation"),
        pick("o_orderkey", "Fishing", "Data Not Available", *["Trade"] * 5).alias("industry_of_occupation"),
        pick("o_orderkey", "Employed", "Unemployed, not willing and not looking for a job", "Not Applicable").alias("employment_status"),
        pick("o_orderkey", "Self-employed", "Self-employed", "Casual", "Casual").alias("employment_arrangement"), F.when(k % 23 == 0, "Own-farm").otherwise("home").alias("place_of_work"),
        coded(6).alias("time_spent_on_work_for_employer"), coded(9).alias("time_spent_on_work_for_hh_and_me"), F.lit(1.0).alias("time_spent_on_learning"))
    cents = F.round(F.col("o_totalprice") * 100).cast("double")  # whole numbers, so that means are exact
    months = t.orders.select(
        hh.alias("hh_id"), F.when(F.col("o_orderstatus") == "P", "").otherwise("Accepted").alias("response_status"), F.when(k % 11 == 0, -99.0).otherwise(cents).alias("total_income"),
        F.when(k % 12 == 0, -100.0).otherwise(cents * 3).alias("total_expenditure"),
        F.when(hh % 2 == 0, 0.0).when(k % 12 == 0, -99.0).otherwise(cents).alias("monthly_expense_on_house_rent"),
        ((k % 3 + 1) / 2).alias("hh_weight_ms"), ((hh % 4 + 1) / 4).alias("hh_non_response_ms"))
    c = F.col("c_custkey")
    owned = F.when(c % 5 < 4, c % 5)
    aspirations = t.customer.select(
        c.alias("hh_id"), F.when(c % 10 == 3, "Refused").otherwise("Accepted").alias("response_status"), F.lit(1.0).alias("hh_non_response_w"), F.lit(1.0).alias("hh_weight_w"),
        *[pick("c_custkey", "<=36000", "36000 - 48000", ">3600000", "Not Stated").alias(g) for g in panel.GROUPS], *[owned.alias(a) for a in panel.ASSETS],
        F.when(c % 3 == 0, "Y").when(c % 3 == 1, "N").otherwise("Not applicable").alias("has_saved_in_real_estate"), F.when(c % 7 == 0, "Y").otherwise("N").alias("has_outstanding_saving_in_real_e"),
        (c % 8 - 2).alias("power_availability_in_hours_per_"), (c % 8 - 2).alias("water_availability_in_days_per_w"), (c % 6).alias("water_availability_in_hours_per_"),
        *[F.when(c % 9 == 0, "Y").when(c % 9 == 1, "Not Stated").otherwise("N").alias(b) for b in panel.BORROWING])
    return panel.person_panel(panel.persons(people), months, months, aspirations)


@query("person_panel_job", f"""{_PANEL}
    SELECT hh_id || '_' || k AS personal_id, round(weight, 6) AS weight, round(caste_rank, 6) AS caste_rank, female, married, rural, working AS currently_employed, working AS labour_force,
           self_employed, owns_farm, hh_farm AS hh_owns_farm, farm_work AS agricultural_work, round(24.0 - work - home, 4)::DOUBLE AS time_spent_on_self,
           income, expense, round(hh_weight, 6) AS hh_weight, estate AS hh_real_estate, water::DOUBLE AS water, ceiling::DOUBLE AS ceiling, borrows,
           CASE WHEN (estate = 1 AND (houses IS NULL OR houses > 1) AND coalesce(rent = 0, false)) OR (estate = 1 AND (houses IS NULL OR houses > 0) AND (rent IS NULL OR rent > 0)) OR hh_farm = 1
                THEN 1 ELSE 0 END AS extra_land
    FROM panel
""")
def person_panel_job(t: Tables):
    """The panel job up to its persons."""
    r = lambda name, digits, out=None: F.round(name, digits).alias(out or name)
    return _panel(t).select(
        "personal_id", r("poi_adj_weight_mem", 6, "weight"), r("caste_rank", 6), "female", "married", "rural", "currently_employed", "labour_force", "self_employed", "owns_farm",
        "hh_owns_farm", "agricultural_work", r("time_spent_on_self", 4), F.col("hh_monthly_income").alias("income"), F.col("hh_monthly_expense").alias("expense"),
        r("income_adj_avg_weight_hh", 6, "hh_weight"), "hh_real_estate", F.col("hh_weekly_water_hrs").cast("double").alias("water"), F.col("hh_income_group_ceil").alias("ceiling"),
        F.col("hh_borrowed_from_bank").alias("borrows"), F.col("hh_extra_land_owned").alias("extra_land"))


@query("household_panel_job", f"""{_PANEL},
    modes AS (SELECT hh_id, caste FROM panel GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY hh_id ORDER BY count(*) DESC, coalesce(caste, 9)) = 1)
    SELECT p.hh_id, p.caste, min(k) AS mem_id, round(any_value(caste_rank), 6) AS caste_rank, count(*) AS members FROM panel p JOIN modes m ON p.hh_id = m.hh_id AND p.caste IS NOT DISTINCT FROM m.caste
    GROUP BY 1, 2
""")
def household_panel_job(t: Tables):
    """The whole panel job: one row per household under its modal category, with the members in it."""
    people = cut_lineage(_panel(t))
    homes = panel.household_panel(people, ["hh_id", "wave_no", "caste_category", "mem_id", "caste_rank"])
    members = people.groupBy("hh_id", "caste_category").agg(F.count(F.lit(1)).alias("members")).alias("n")
    same = F.col("h.hh_id").eqNullSafe(F.col("n.hh_id")) & F.col("h.caste_category").eqNullSafe(F.col("n.caste_category"))
    caste = K.recode("h.caste_category", {c: i for i, c in enumerate(panel.CASTES, 1)})
    return homes.alias("h").join(members, same).select("h.hh_id", caste.cast("int").alias("caste"), "h.mem_id", F.round("h.caste_rank", 6).alias("caste_rank"), "n.members")


# Survey rows are order lines; a line's answers follow from its number ``k``.
_ANSWERS = """
    SELECT l_orderkey AS hh, CASE WHEN k % 29 <> 0 THEN 15 + k % 60 END AS age, k % 2 AS female, (l_suppkey % 3 < 2)::INTEGER AS rural, (k % 5 < 3)::INTEGER AS married, (k % 4 < 3)::INTEGER AS literacy,
           CASE WHEN k % 31 <> 0 AND k % 4 = 3 THEN 1 ELSE 2 END AS education, CASE k % 7 % 4 WHEN 0 THEN 'Hindu' WHEN 1 THEN 'Muslim' WHEN 2 THEN 'Other Religion' ELSE 'Sikh' END AS religion,
           CASE WHEN k % 37 <> 0 THEN 1 + k // 3 % 4 END AS caste, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS employed, (k % 8 < 5)::INTEGER AS emp_work_force, (k % 7 < 4)::INTEGER AS labour_force,
           CASE WHEN k % 6 < 5 THEN (k % 6 < 2)::INTEGER END AS self_employed, CASE WHEN k % 3 = 0 THEN l_quantity END AS time_spent_on_work, round(l_discount * 100) AS time_spent_on_hh,
           (24 - k % 9)::DOUBLE AS time_spent_on_self, round(l_tax * 100) AS time_spent_on_learning, 1 + l_orderkey % 5 AS wealth, l_quantity AS w
    FROM (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem)"""
_BANDS = [(low, high) for low, high, _ in survey.AGE_RANGES]
_BINARY = {
    **{c: c for c in ("female", "rural", "married", "literacy")},
    **{f"agbinary{i}": f"coalesce(age BETWEEN {low} AND {high}, false)::INTEGER" if high else f"(age >= {low} OR age IS NULL)::INTEGER" for i, (low, high) in enumerate(_BANDS, 1)},
    **{f"religionbinary{i}": f"(religion = '{r}')::INTEGER" for i, r in enumerate(("Hindu", "Muslim", "Other Religion", "Sikh"), 1)},
    **{f"castebinary{i}": f"(caste = {i})::INTEGER" for i in range(1, 5)}, **{f"edubinary{i}": f"(education = {i})::INTEGER" for i in (1, 2)},
    **{c: c for c in ("labour_force", "emp_work_force", "employed", "self_employed")},
}
_PAIRS = {"employed": ("female", "employed"), "work_force": ("female", "emp_work_force"), "labour_force": ("female", "labour_force"), "pca_caste": ("wealth", "caste"),
          "education_caste": ("education", "caste"), "education_pca": ("education", "wealth")}
_SUBSETS = {"all": "true", "rural_men": "rural = 1 AND female = 0", "rural_women": "rural = 1 AND female = 1"}
_SIDES = {"caste": _BINARY["castebinary1"], "religion": _BINARY["religionbinary2"], "education": "education - 1"}


def _survey(t: Tables):
    """Order lines as answers of a survey, recoded."""
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    number = lambda condition: condition.cast("int")
    pick = lambda at, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))
    raw = t.lineitem.select(
        F.col("l_suppkey").alias("psu_id"), F.col("l_orderkey").alias("hh_id"), F.col("l_linenumber").alias("mem_id"), F.when(k % 29 != 0, 15 + k % 60).alias("age_yrs"),
        number(k % 2).alias("female"), number(F.col("l_suppkey") % 3 < 2).alias("rural"), number(k % 5 < 3).alias("married"), number(k % 4 < 3).alias("literacy"),
        F.when(k % 31 == 0, None).when(k % 4 == 3, "No Education").otherwise("Graduate").alias("education"), pick(k % 7, "Hindu", "Muslim", "Jain", "Sikh").alias("religion"),
        pick(k, *panel.CASTES).alias("caste_category"), F.when(k % 37 != 0, pick(F.floor(k / 3), "GEN", "OBC", "SC", "ST")).alias("std_caste_category"),
        F.when(k % 3 == 0, "Employed").when(k % 3 == 1, "Unemployed").alias("employment_status"), number(k % 8 < 5).alias("employed"), number(k % 7 < 4).alias("labour_force"),
        F.when(k % 6 < 5, number(k % 6 < 2)).alias("self_employed"), F.col("l_quantity").cast("double").alias("time_spent_on_work"), F.round(F.col("l_discount") * 100).alias("time_spent_on_hh"),
        (24.0 - k % 9).alias("time_spent_on_self"), F.round(F.col("l_tax") * 100).alias("time_spent_on_learning"), number(k % 9 < 4).alias("hh_has_outstanding_borrowing"),
        number(k % 4 == 1).alias("hh_extra_land_owned"), (1 + F.col("l_orderkey") % 5).alias("hh_wealth_index1_quintile"), F.lit("<=36000").alias("hh_income_group"),
        F.col("l_quantity").cast("double").alias(survey.WEIGHT))
    return survey.recode(raw)


@query("survey_summary_job", f"""
    WITH s AS ({_ANSWERS}) {" UNION ALL ".join(
        f"SELECT '{n}' AS variable, round(avg({e}), 8) AS mean, round(stddev_samp({e}), 8) AS sd, min({e})::DOUBLE AS min, max({e})::DOUBLE AS max FROM s" for n, e in _BINARY.items())}
""")
def survey_summary_job(t: Tables):
    """Recodes, dummies and the summary table of the survey job."""
    return survey.summary(_survey(t)).select("variable", F.round("mean", 8).alias("mean"), F.round("sd", 8).alias("sd"), "min", "max")


@query("survey_tables_job", f"""
    WITH s AS ({_ANSWERS}) {" UNION ALL ".join(
        f"SELECT '{n}' AS tab, CASE WHEN grouping({r}) = 1 THEN 'Total' ELSE {r}::VARCHAR END AS r, CASE WHEN grouping({c}) = 1 THEN 'Total' ELSE {c}::VARCHAR END AS c, "
        f"round(100.0 * sum(w) / (SELECT sum(w) FROM s WHERE {r} IS NOT NULL AND {c} IS NOT NULL), 6) AS pct FROM s WHERE {r} IS NOT NULL AND {c} IS NOT NULL GROUP BY CUBE ({r}, {c})"
        for n, (r, c) in _PAIRS.items())}
    UNION ALL SELECT 'caste', caste::VARCHAR, NULL, round(100.0 * sum(w) / (SELECT sum(w) FROM s WHERE caste IS NOT NULL), 6) FROM s WHERE caste IS NOT NULL GROUP BY caste
""")
def survey_tables_job(t: Tables):
    """The seven weighted tables of the survey job."""
    tables = survey.weighted_tables(cut_lineage(_survey(t)))
    column = lambda df, i: F.col(df.columns[i]).cast("string") if len(df.columns) > i + 1 else F.lit(None).cast("string")
    long = [df.select(F.lit(n).alias("tab"), column(df, 0).alias("r"), column(df, 1).alias("c"), F.round("pct", 6).alias("pct")) for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), long)


@query("survey_tests_job", f"""
    WITH s AS ({_ANSWERS}), x AS ({" UNION ALL ".join(
        f"SELECT '{g}_{n}' AS test, '{v}' AS variable, {e} AS side, {v}::DOUBLE AS x FROM s WHERE {cond}" for g, e in _SIDES.items() for n, cond in _SUBSETS.items() for v in survey.TIME_AND_WORK)}),
    m AS (SELECT test, variable, count(x) FILTER (side = 0) AS n1, count(x) FILTER (side = 1) AS n2, avg(x) FILTER (side = 0) AS a, avg(x) FILTER (side = 1) AS b,
                 var_samp(x) FILTER (side = 0) AS v, var_samp(x) FILTER (side = 1) AS w FROM x GROUP BY 1, 2)
    SELECT test, variable, n1, n2, round(a - b, 6) AS b, round(sqrt(((n1 - 1) * v + (n2 - 1) * w) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS se, n1 + n2 - 2 AS df FROM m
""")
def survey_tests_job(t: Tables):
    """The nine tables of t tests of the survey job."""
    tests = survey.t_tests(cut_lineage(_survey(t)))
    long = [df.select(F.lit(n).alias("test"), "variable", "n1", "n2", F.round("b", 6).alias("b"), F.round("se", 6).alias("se"), "df") for n, df in tests.items()]
    return reduce(lambda a, b: a.unionByName(b), long)


_BARE = "replace(replace({c}, '_', ''), '/', '')"


@query("village_job", f"""
    WITH w AS (SELECT o_orderkey AS k, concat_ws('_', {", ".join(_BARE.format(c=c) for c in ("r_name", "n_name", "c_mktsegment"))}, o_orderkey) AS file_key FROM orders JOIN customer ON c_custkey = o_custkey
               JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_orderkey % 10 <> 2),
    v AS (SELECT l_orderkey AS k, 'Village O''' || concat_ws('-', l_returnflag, l_linenumber, l_partkey, l_suppkey, l_linestatus) AS village, l_quantity AS new_groups, l_partkey::VARCHAR AS code FROM lineitem)
    SELECT file_key, village, new_groups, code, NULL AS error FROM w JOIN v USING (k) WHERE k % 10 NOT IN (0, 1)
    UNION ALL SELECT file_key, NULL, NULL, NULL, CASE WHEN k % 10 = 0 OR min(village) IS NULL THEN 'no page' ELSE 'no link for ' || min(village) END
              FROM w LEFT JOIN v USING (k) GROUP BY k, file_key HAVING k % 10 < 2 OR min(village) IS NULL
""")
def village_job(t: Tables):
    """The whole village job: councils (orders) of the hierarchy, their pages, and the councils that failed."""
    names = [F.col(c).alias(n) for c, n in zip(("r_name", "n_name", "c_mktsegment"), villages.LEVELS)]
    places = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).join(t.customer, F.col("n_nationkey") == F.col("c_nationkey"))
    council = F.col("o_orderkey").cast("string").alias(villages.LEVELS[3])
    grams = t.orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(*names, council, "o_orderkey")
    done = grams.filter("o_orderkey % 10 = 2").select(villages.safe_key(*villages.LEVELS).alias("file_key"))
    work = cut_lineage(villages.gram_worklist(
        t.region.select(names[0]), places.select(*names[:2]).distinct(), places.select(*names).distinct(), grams.select(*villages.LEVELS), done), "zstd")
    councils = work.select("file_key", *villages.LEVELS, F.col("Grampanchayat").cast("bigint").alias("l_orderkey"))
    pages = village_lines(t).filter("l_orderkey % 10 <> 0").join(councils, "l_orderkey")
    html = F.when(F.col("l_orderkey") % 10 == 1, F.replace(village_page(), F.lit("SHGList("), F.lit("Other("))).otherwise(village_page())
    good, errors = villages.village_table(work, pages, html)
    rows = good.select("file_key", F.col("Village").alias("village"), F.col("New").alias("new_groups"), "code", F.lit(None).cast("string").alias("error"))
    return rows.unionByName(errors, allowMissingColumns=True)


@query("market_job", """
    SELECT r_name AS state, c_mktsegment || '-' || c_custkey // 50 AS district, c_name AS market, n_name AS commodity, n_nationkey::VARCHAR AS commodity_code, (c_custkey % 97)::VARCHAR AS arrival,
           '01-Feb-2024' AS first_day, (c_custkey // 50)::VARCHAR AS district_code
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = c_custkey // 50 % 6
""")
def market_job(t: Tables):
    """Commodities (nations) by state (regions): the work list, and the market tables of the pages stored for it."""
    states = t.region.groupBy().agg(F.sort_array(F.collect_list("r_name")).alias("states"))  # one row
    report = t.nation.select(F.col("n_nationkey").cast("string").alias("ccode"), F.col("n_name").alias("name")).withColumn(
        "states", F.concat(states.scalar(), F.array(F.lit("Nowhere"))))
    work, _ = markets.work_list(report, t.region.select(F.col("r_regionkey").cast("string").alias("scode"), F.col("r_name").alias("name")), "01-02-2024", "05-02-2024", slots=3)
    part = F.floor(F.col("c_custkey") / 50)
    row = F.concat(F.lit("<tr><td>"), F.col("c_name"), F.lit("</td><td>"), (F.col("c_custkey") % 97).cast("string"), F.lit("</td></tr>"))
    tables = t.customer.groupBy(F.col("c_nationkey").cast("string").alias("ccode"), (part % 6).cast("string").alias("scode"), "c_mktsegment", part.alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list(row)), "").alias("rows"))
    pages = tables.select("ccode", "scode", F.concat_ws("-", "c_mktsegment", F.col("part").cast("string")).alias("district"), F.concat(
        F.lit("<table title='x,"), F.col("part").cast("string"), F.lit("'><tr><th>Market</th><th>Arrivall</th></tr>"), "rows", F.lit("</table>")).alias("html"))
    found = markets.market_rows(work, pages)
    return found.select(F.col("State").alias("state"), "district", F.col("Market").alias("market"), F.col("Commodity").alias("commodity"), F.col("Commodity Code").alias("commodity_code"),
                        F.col("Arrival").alias("arrival"), F.col("Start").alias("first_day"), F.col("District Code").alias("district_code"))


@query("entity_job", """
    SELECT conv_id AS paper, turn, role AS dates, trim(array_to_string(regexp_extract_all(text, '\\b[A-Z][a-z]+\\b'), ', ')) AS ner FROM conversations WHERE text IS NOT NULL
""")
def entity_job(t: Tables):
    """The entity job with its ledger, over every turn that has a text."""
    rows = t.conversations.filter("text is not null").select(
        F.col("conv_id").alias("paperId"), F.col("turn").alias("excerptId"), F.col("role").alias("dateRange"), F.col("text").alias("excerpt"))
    found, _ = entities.extract_entities(rows, "List the names.", ledger=new_folder(t.spark, "ledger"), batch_rows=64, max_tries=2)
    return found.select(F.col("paperId").alias("paper"), F.col("excerptId").alias("turn"), F.col("dateRange").alias("dates"), "ner")


@query("vector_job", f"""
    WITH c AS ({_COMPONENTS}), v AS ({" UNION ALL ".join(f"SELECT '{v}' AS variant, doc_id FROM c WHERE " + " AND ".join(f"coalesce({'refs' if p == 'references' else p}, '') <> ''" for p in ps) for v, ps in I.INPUT_TYPES.items())}),
         r AS (SELECT variant, doc_id, row_number() OVER (PARTITION BY variant ORDER BY doc_id) - 1 AS rn, count(*) OVER (PARTITION BY variant) // 10 AS size FROM v)
    SELECT variant, (CASE WHEN size = 0 THEN 10 ELSE least(rn // size, 9) + 1 END)::INTEGER AS split, doc_id FROM r
""")
def vector_job(t: Tables):
    """The embedding job as written and read back: the ids of every variant and split."""
    saved = vectors.embed_papers(components(t), new_folder(t.spark, "vectors"), key="doc_id", batch_rows=64)
    return saved.filter(F.size("embedding") > 0).select("variant", F.col("split").cast("int").alias("split"), "doc_id")
