"""Readers, writers, incremental ingest and the composed jobs on small fixtures."""

import json

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from quadrat.plans import county, descriptives, entities, markets, panel, papers, survey, vectors, villages, wages
from quadrat.sources import readers as S, writers as O


def test_csv_and_months(spark, tmp_path):
    (tmp_path / "a.csv").write_text("FIPS,n\n01001,5\n")
    assert rows(S.read_csv(spark, str(tmp_path / "a.csv"), "FIPS string, n int")) == [("01001", 5)]
    months = tmp_path / "m"
    months.mkdir()
    for stamp, v in (("20190930", 1), ("20191031", 2)):
        (months / f"income_{stamp}_MS.csv").write_text(f"hh_id,total\n1,{v}\n")
    got = S.read_monthly(spark, str(months), "hh_id long, total double")
    assert rows(got, "file_month") == [(1, 1.0, 9), (1, 2.0, 10)]


def test_ragged_latin1(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes('café,cafe,"a, b",\r\nx,y\n'.encode("latin1"))
    assert rows(S.read_ragged(spark, str(tmp_path / "w.csv")), "row_no") == [(0, ["café", "cafe", "a, b"]), (1, ["x", "y"])]


def test_json_lines_keep_their_origin(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in (3, 12):
        lines = [json.dumps({"id": f"{n}-{i}", "year": 1970}) for i in range(3)] + ["not json", "5"]
        (folder / f"papers_{n}.txt").write_text("\n".join(lines) + "\n")
    got = S.read_json_lines(spark, str(folder), "id string, year int")
    assert rows(got.select("file_idx", "line_no", F.col("record.id")), "file_idx", "line_no") == [
        (n, i, f"{n}-{i}" if i < 3 else None) for n in ("12", "3") for i in range(5)]
    good, bad = papers.records(got)
    assert good.count() == 6 and {r.payload for r in bad.collect()} == {"not json", "5"}


def test_maps_prompts_and_statistical_files(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"AP": {"name": "Andhra"},\n "GA": {"name": "Goa"}}')
    assert rows(S.read_json_map(spark, str(tmp_path / "l.json"), "struct<name:string>", key="scode"), "scode") == [("AP", "Andhra"), ("GA", "Goa")]
    (tmp_path / "p.txt").write_text("\n Find names.\n")
    assert S.read_prompt(spark, str(tmp_path / "p.txt")) == "Find names."
    chunks = tmp_path / "chunks"
    chunks.mkdir()
    for i in (1, 2):
        pd.DataFrame({"uniqueId": [i, i + 10], "name": ["a", "b"], "other": [1.0, 2.0]}).to_stata(chunks / f"{i}.dta", write_index=False)
    got = S.read_statistical(spark, str(chunks), ["uniqueId", "name"], "uniqueId int, name string")
    assert rows(got, "uniqueId") == [(1, "a", "1.dta"), (2, "a", "2.dta"), (11, "b", "1.dta"), (12, "b", "2.dta")]


def test_json_map_of_one_line_is_read_by_several_tasks(spark, tmp_path):
    tricky = {'a,"b': {"name": 'x},"y\\', "tags": ["[", "{,", '"'], "inner": {"n": 1}}, "": {"name": "", "tags": [], "inner": None}, "é,": {"name": ",,", "tags": None}}
    made = {**tricky, **{f"k{i}": {"name": f'{i}, "{i}" }}{{ ' + "," * (i % 7), "tags": ["]"] * (i % 3), "inner": {"n": i}} for i in range(3000)}}
    (tmp_path / "one.json").write_text(json.dumps(made, ensure_ascii=False))
    (tmp_path / "two.json").write_text(json.dumps({"z": {"name": "last"}}, indent=2) + "\n")
    (tmp_path / "none.json").write_text(" {\n} \n")
    (tmp_path / "empty.json").write_text("")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9999")
    try:
        got = S.read_json_map(spark, str(tmp_path / "*.json"), "struct<name:string,tags:array<string>,inner:struct<n:int>>")
        found = {r.key: (r.name, r.tags, r.inner and r.inner.n) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    made["z"] = {"name": "last"}
    assert found == {k: (v["name"], v.get("tags"), (v.get("inner") or {}).get("n")) for k, v in made.items()}
    (tmp_path / "bad").write_text('{"a": {"name": "x"}, oops}')
    with pytest.raises(Exception, match="no JSON object"):
        S.read_json_map(spark, str(tmp_path / "bad"), "struct<name:string>").collect()


def test_statistical_file_is_read_in_ranges(spark, tmp_path):
    n = 5000
    made = pd.DataFrame({"id": range(n), "name": [f"é{i}" for i in range(n)], "x": [i / 4 if i % 5 else None for i in range(n)]})
    for version in (114, 118):
        made.assign(name=made["name"].str.replace("é", "e") if version == 114 else made["name"]).to_stata(tmp_path / f"v{version}.dta", write_index=False, version=version)
    made.head(0).to_stata(tmp_path / "none.dta", write_index=False)
    got = S.read_statistical(spark, str(tmp_path), ["x", "id"], "x double, id bigint", part_bytes=10_000)
    assert got.rdd.getNumPartitions() > 8
    found = got.withColumn("task", F.spark_partition_id()).toPandas()
    for name in ("v114.dta", "v118.dta"):
        of = found[found["file"] == name].sort_values("id")
        assert of["id"].tolist() == list(range(n)) and of["x"].fillna(-1).tolist() == made["x"].fillna(-1).tolist() and of["task"].nunique() > 3
    assert set(found["file"]) == {"v114.dta", "v118.dta"}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a/b_c", "x", 1), ("d", "y", 2)], "k string, s string, n int")
    O.write_csv_by_key(df, str(tmp_path / "csv"), O.safe_key("k", "s"))
    assert sorted(p.name for p in (tmp_path / "csv").glob("file_key=*")) == ["file_key=abc_x", "file_key=d_y"]
    assert rows(O.write_table(df, str(tmp_path / "t")), "n") == [("a/b_c", "x", 1), ("d", "y", 2)]
    O.write_matrix(df, str(tmp_path / "m"), ["n"])
    assert next((tmp_path / "m").glob("*.csv")).read_text() == "k,s,n\na/b_c,x,1\nd,y,2\n"
    O.write_json_by_file(df.withColumn("file_idx", F.col("n").cast("string")), str(tmp_path / "j"))
    O.write_map(df, str(tmp_path / "map"), "k", "n")
    assert spark.read.json(str(tmp_path / "j")).count() == spark.read.json(str(tmp_path / "map")).count() == 2
    vec = spark.createDataFrame([("v", 1, "p", [1.0], 0), ("v", 1, "p", [2.0], 1)], "variant string, split int, id string, embedding array<float>, o int")
    O.write_vectors(vec, str(tmp_path / "vec"), order="o")
    assert [r.embedding for r in spark.read.parquet(str(tmp_path / "vec")).collect()] == [[2.0]]
    O.write_lines(spark.createDataFrame([("a & b",)], "line string"), str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).first()[0] == "a & b"


def test_ingest_takes_only_new_files(spark, tmp_path):
    from quadrat.streaming.ingest import ingest_papers

    raw = tmp_path / "raw"
    raw.mkdir()
    out = [str(raw), str(tmp_path / "out"), str(tmp_path / "state")]
    (raw / "p_1.txt").write_text(json.dumps({"id": "1", "year": 1970, "title": "the cat is here"}) + "\nbroken\n")
    ingest_papers(spark, *out)
    (raw / "p_2.txt").write_text(json.dumps({"id": "2", "year": 1970, "title": "the dog is there"}) + "\n")
    ingest_papers(spark, *out)
    ingest_papers(spark, *out)
    assert rows(spark.read.parquet(out[1] + "/subset").select("id", "file_idx", "batch"), "id") == [("1", "1", 0), ("2", "2", 1)]
    assert [r.payload for r in spark.read.parquet(out[1] + "/errors").collect()] == ["broken"]


def test_county(spark):
    mk = spark.createDataFrame
    people = [(s, c, g, 100 if g == 0 else 10, 30, 20) for s, c in ((1, 1), (2, 63), (2, 66)) for g in (0, 4, 5, 7, 12)]
    education = ["GEO_ID string", *[f"`{c}` double" for c in county.EDUCATION_COLUMNS]]
    t = {
        "state_fips": mk([("Alabama", 1), ("Alaska", 2)], "State string, FIPS int"),
        "county_fips": mk([(1001, "Alabama", "Autauga"), (2261, "Alaska", "Valdez")], "FIPS int, State string, County string"),
        "drug_overdose": mk([(1001, 1.5), (2261, 2.5), (99999, 9.0)], "FIPS int, `Model-based Death Rate` double"),
        "age_sex_race": mk(people, "STATE int, COUNTY int, AGEGRP int, TOT_POP long, WA_MALE long, WA_FEMALE long"),
        "education": mk([("0500US01001", .1, .2, .3, .4), ("0500US72001", 1., 1., 1., 1.)], ", ".join(education)),
        "house_reps": mk([("Alabama", 1, 6), ("Nowhere", 9, 9)], "State string, Democatric int, Republican int"),
        "party_votes": mk([(1001.0, 30, 10, 10, 50), (2261.0, 0, 0, 0, 0)], "`county number` double, democratic long, independent long, other long, republican long"),
        "income_poverty": mk([(1, 0, "9", "9"), (1, 1, "1,234", "."), (2, 261, "5", "50,000")],
                             "`State FIPS Code` int, `County FIPS Code` int, `Poverty Estimate` string, `Median Household Income` string"),
        "law_employees": mk([(0, "ALABAMA", "Autauga County Police Department", "1,000"), (1, None, "Autauga", "5"), (2, "ALASKA", "Valdez Public Safety", "7")],
                            "line_no long, State string, County string, `Total officers` string"),
        "opioid_disp": mk([(1001, 3.5)], "`County FIPS Code` int, `Opioid Dispensing Rate per 100` double"),
        "unemployment": mk([(1, 1, "1,000", "50"), (72, 1, "1", "1")], "`State FIPS` int, `County FIPS` int, Employed string, Unemployed string"),
    }
    out = [r.asDict() for r in county.county_table(t).collect()]
    assert [r["FIPS"] for r in out] == ["01001", "02261"] and list(out[0]) == county.FINAL_COLUMNS
    first, second = out
    assert (first["LawOfficers"], first["PovertyEstimate"], first["MedHHIncome"], first["RepublicanHouseReps"]) == (1005, 1234, None, 6)
    assert (first["DemocratVoteShare"], first["Age15-29Pct"], first["HighSchoolPct"], first["Employed"]) == (30.0, 20.0, 20.0, 1000)
    assert (second["TotalPopulation"], second["WhitePct"], second["Age30-49Pct"], second["DemocratVoteShare"]) == (200, 50.0, 10.0, None)


def survey_files(spark):
    base = dict(response_status="Accepted", member_status="Member of the household", age_yrs=30, wave_no=18, hh_id=1, mem_id=1, state="S", district="D",
                region_type="RURAL", psu_id=7, month_slot="m", ge15_mem_weight_w=2.0, ge15_mem_non_response_w=1.5, gender="F", relation_with_hoh="x",
                marital_status="Married", religion="Hindu", caste="c", caste_category="OBC", literacy="Y", education="e", nature_of_occupation="Small Farmer",
                industry_of_occupation="Fishing", occupation="o", employment_status="Employed", employment_arrangement="Self-employed", place_of_work="home",
                time_spent_on_work_for_hh_and_me=4.0, time_spent_on_work_for_employer=8.0, time_spent_on_learning=-100.0,
                has_bank_ac="Y", has_creditcard="N", has_kisan_creditcard="Not Stated", has_mobile="Y")
    people = [
        base, {**base, "mem_id": 2, "caste_category": "SC", "nature_of_occupation": "Clerk", "time_spent_on_learning": -5.0},
        {**base, "hh_id": 2, "mem_id": 1, "caste_category": "Not Stated", "age_yrs": None, "gender": "M", "nature_of_occupation": "Clerk",
         "employment_status": "Unemployed, not willing and not looking for a job"},
        {**base, "mem_id": 3, "age_yrs": 10}, {**base, "mem_id": 4, "response_status": "Refused"}, {**base, "hh_id": 3, "mem_id": 1, "caste_category": "Upper Caste"},
    ]
    months = [("Accepted", 1, 1.0, 2.0, 100.0), ("Accepted", 1, 3.0, 2.0, -99.0), ("Refused", 1, 1.0, 1.0, 999.0), ("Accepted", 2, 1.0, 1.0, 50.0)]
    income = spark.createDataFrame(months, "response_status string, hh_id long, hh_weight_ms double, hh_non_response_ms double, total_income double")
    spending = income.withColumnRenamed("total_income", "total_expenditure").withColumn("monthly_expense_on_house_rent", F.lit(5.0))
    asset = {"response_status": "Accepted", "hh_id": 1, "hh_weight_w": 2.0, "hh_non_response_w": 3.0, **{g: "g" for g in panel.GROUPS}, "income_group": "36000 - 48000",
             **{a: 1 for a in panel.ASSETS}, "power_availability_in_hours_per_": -1.0, "water_availability_in_days_per_w": 7.0,
             "water_availability_in_hours_per_": 2.0, "has_saved_in_real_estate": "N", "has_outstanding_saving_in_real_e": "Y", **{b: "N" for b in panel.BORROWING}}
    assets = spark.createDataFrame(pd.DataFrame([asset, {**asset, "hh_id": 2, "income_group": ">3600000", "has_outstanding_saving_in_real_e": "N"}]))
    schema = ", ".join(f"{k} {'int' if k == 'age_yrs' else 'long' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in base.items())
    return spark.createDataFrame([tuple(p.values()) for p in people], schema), income, spending, assets


def test_panel(spark):
    raw, income, spending, assets = survey_files(spark)
    people = panel.persons(raw)
    out = {r.personal_id: r for r in panel.person_panel(people, income, spending, assets).collect()}
    assert set(out) == {"1_1", "1_2", "2_1", "3_1"}
    one = out["1_1"]
    assert (one.poi_adj_weight_mem, one.time_spent_on_learning, one.time_spent_on_self, out["1_2"].time_spent_on_learning) == (3.0, 0.0, 12.0, None)
    assert (one.owns_farm, one.hh_owns_farm, out["1_2"].owns_farm, out["1_2"].hh_owns_farm) == (1, 1, 0, 1)
    assert (one.has_bank_ac, one.has_creditcard, one.has_kisan_creditcard, one.labour_force, out["2_1"].labour_force) == (1, 0, None, 1, 0)
    # one Upper Caste, one OBC, one SC among those with a category
    assert [round(out[p].caste_rank, 4) if out[p].caste_rank is not None else None for p in ("3_1", "1_1", "1_2", "2_1")] == [0.0, 0.3333, 0.6667, None]
    assert (one.hh_monthly_income, one.income_adj_avg_weight_hh, out["3_1"].hh_monthly_income) == (100.0, 4.0, None)
    assert (one.hh_income_group_ceil, out["2_1"].hh_income_group_ceil, one.hh_daily_electricity_hrs, one.hh_weekly_water_hrs) == (48000.0, 3600000.0, 0.0, 14.0)
    assert (one.hh_extra_land_owned, out["2_1"].hh_extra_land_owned) == (1, 0)
    home = panel.household_panel(panel.person_panel(people, income, spending, assets), ["wave_no", "hh_id", "caste_category"])
    assert rows(home.select("hh_id", "caste_category"), "hh_id") == [(1, "OBC"), (2, None), (3, "Upper Caste")]


def test_descriptives(spark):
    jobs = spark.createDataFrame([(1.0, 1, 2, 10.0, 1, 1, 2), (3.0, 2, 4, None, 2, None, 6), (2.0, 1, 1, 20.0, None, 2, 9)],
                                 "vacancy double, minExperience int, maxExperience int, avgSalary double, jobAgreementType int, sector int, minEducationBranch int")
    got = {r.variable: r for r in descriptives.job_summary(jobs).collect()}
    assert (got["avgSalary"].n, got["FullTime"].mean, got["FullTime"].n, got["PostGraduate"].mean) == (2, 0.5, 2, pytest.approx(1 / 3))
    sizes = spark.createDataFrame([(str(i), float(i), float(i * 100)) for i in range(1, 11)] + [("x", None, 500.0)], "companyId string, size_post double, size_vac double")
    binned = descriptives.company_bins(sizes)
    assert dict(rows(binned.select("companyId", "bins_post")))["x"] == 8
    tech = ", ".join(f"{c} int" for c in descriptives.TECHNOLOGIES.values())
    postings = spark.createDataFrame([("1", 2020, 1, *[1] * 8), ("1", 2020, 0, *[0] * 8), ("x", 2021, 0, *[0] * 8), ("gone", 2020, 1, *[1] * 8)], f"companyId string, year int, emergingTech int, {tech}")
    joined = descriptives.postings_with_bins(binned, postings)
    matrix = {r.year: r for r in descriptives.technology_matrix(joined, "bins_post").collect()}
    assert (matrix[2020].bin1, matrix[2021].bin8, matrix[2020].bin8) == (50.0, 0.0, None)
    shares = {r["_varname"]: r for r in descriptives.category_matrix(joined, "bins_post").collect()}
    assert (shares["pct_ai"]["1"], shares["pct_ai"]["8"]) == (100.0, None)


def test_wages(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    n = 240
    pdf = pd.DataFrame({"SOC": rng.choice(list("abc"), n), "companyId": rng.choice(list("pqr"), n), "tech_ai": rng.integers(0, 2, n), "state_x": rng.integers(0, 2, n),
                        "minExperience": rng.integers(0, 5, n), "minEducationBranch": rng.integers(1, 4, n), "month": rng.integers(1, 3, n), "year": rng.integers(2019, 2021, n)})
    pdf["state_y"] = 1 - pdf.state_x
    pdf["minExp2"], pdf["monthYear"] = pdf.minExperience ** 2, pdf.year * 100 + pdf.month
    pdf["ln_avgSalary_real"] = 2 + 0.3 * pdf.tech_ai + rng.normal(0, .1, n)
    specs = {k: wages.SPECIFICATIONS[k] for k in ("A", "E")}
    full, common = wages.wage_ladders(spark.createDataFrame(pdf), specs)
    assert abs(full["A"].b[0] - 0.3) < 0.05 and full["A"].omitted and common["A"].n == full["E"].n
    assert wages.wage_table(full).first().line.startswith("tech_ai & 0.")


def test_survey(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    n = 300
    pdf = pd.DataFrame({
        "psu_id": rng.integers(0, 12, n), "hh_id": rng.integers(0, 90, n), "mem_id": range(n), "age_yrs": rng.integers(15, 70, n), "female": rng.integers(0, 2, n),
        "rural": 1, "married": rng.integers(0, 2, n), "literacy": rng.integers(0, 2, n), "education": rng.choice(["No Education", "Graduate"], n),
        "religion": rng.choice(["Hindu", "Muslim", "Jain"], n), "caste_category": rng.choice(["OBC", "SC"], n), "std_caste_category": rng.choice(["GEN", "OBC"], n),
        "employment_status": rng.choice(["Employed", "Unemployed"], n), "employed": rng.integers(0, 2, n), "labour_force": rng.integers(0, 2, n),
        "self_employed": rng.integers(0, 2, n), "time_spent_on_work": rng.uniform(0, 9, n), "time_spent_on_hh": rng.uniform(0, 9, n), "time_spent_on_self": 5.0,
        "time_spent_on_learning": rng.uniform(0, 2, n), "hh_has_outstanding_borrowing": rng.integers(0, 2, n), "hh_extra_land_owned": rng.integers(0, 2, n),
        "hh_wealth_index1_quintile": rng.integers(1, 3, n), "hh_income_group": "<=36000", "poi_adj_weight_mem": rng.uniform(1, 2, n)})
    data = survey.recode(spark.createDataFrame(pdf)).cache()
    assert survey.INCOME_ORDER[1] == "36000 - 48000" and survey.INCOME_ORDER[23] == "2400000 - 3600000" and survey.INCOME_ORDER[24] == ">3600000"
    assert rows(data.select("ordered_hh_income_group").distinct()) == [(0,)]
    assert {r.religion for r in data.select("religion").distinct().collect()} == {"Hindu", "Muslim", "Other Religion"}
    assert {r.variable: r for r in survey.summary(data).collect()}["agbinary9"].max == 1.0
    tables = survey.weighted_tables(data)
    assert abs(sum(r.pct for r in tables["caste"].collect()) - 100) < 1e-9
    assert data.filter("employment_status <> 'Employed' and time_spent_on_work is not null").count() == 0
    tests = survey.t_tests(data)
    assert len(tests) == 9 and tests["caste_all"].count() == 7
    women = data.filter("female = 1")
    fit = survey.absorb_regression(women, "labour_force", [survey.WEALTH_BY_CASTE, *survey.CONTROLS], ["psu_id"], weight=survey.WEIGHT, cluster="psu_id")
    assert fit.clusters == 12 and "2.hh_wealth_index1_quintile#2.ordered_std_caste_category" in fit.terms


def test_vectors_and_entities(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"t{i}", "a", "r" if i else "", "f") for i in range(5)], "id string, title string, abstract string, references string, fos string")
    out = vectors.embed_papers(df, str(tmp_path / "v"), splits=2)
    counts = {(r.variant, r.split): r["count"] for r in out.groupBy("variant", "split").count().collect()}
    assert (counts[("titleAbstract", 1)], counts[("titleAbstract", 2)], counts[("titleRefs", 1)]) == (2, 3, 2)
    ex = spark.createDataFrame([(1, 1, "1900", "Met Albert in Zurich "), (1, 2, "1901", "nobody")], "paperId int, excerptId int, dateRange string, excerpt string")
    got, report = entities.extract_entities(ex, " Find. ")
    assert rows(got, "excerptId") == [(1, 1, "1900", "Met, Albert, Zurich"), (1, 2, "1901", "")]
    assert rows(report) == [("completed", 1, 1), ("completed", 1, 2)]


def test_villages(spark):
    mk = spark.createDataFrame
    names = ["State", "District", "Block", "Grampanchayat"]
    levels = [mk([("s",)], "State string"), mk([("s", "d")], "State string, District string"), mk([("s", "d", "b"), ("s", "d", "empty")], "State string, District string, Block string"),
              mk([("s", "d", "b", g) for g in ("g_1", "g2", "g3", "done")], ", ".join(f"{n} string" for n in names))]
    work = villages.gram_worklist(*levels, done=mk([("s_d_b_done",)], "file_key string"))
    assert {r.file_key for r in work.collect()} == {"s_d_b_g1", "s_d_b_g2", "s_d_b_g3"}
    link = "<a href=\"javascript:SHGList('1','x','Foo')\">Foo</a>"
    page = "<table id='example'><tr><th>h</th></tr><tr><td>1</td><td>{}</td><td>2</td></tr></table>"
    pages = mk([("s_d_b_g1", page.format(link)), ("s_d_b_g2", page.format("Bar"))], "file_key string, html string")
    good, errors = villages.village_table(work, pages)
    assert [(r.Grampanchayat, r.Village, r.New, r.code) for r in good.collect()] == [("g_1", "Foo", 2.0, "1")]
    assert rows(errors, "file_key") == [("s_d_b_g2", "no link for Bar"), ("s_d_b_g3", "no page")]


def test_markets(spark):
    report = spark.createDataFrame([("1", "Rice", ["Goa", "Mars"]), ("2", "Tea", ["Goa"])], "ccode string, name string, states array<string>")
    places = spark.createDataFrame([("GA", "Goa")], "scode string, name string")
    work, missed = markets.work_list(report, places, "01-02-2024", "05-02-2024", slots=2)
    assert work.count() == 2 and [r.state for r in missed.collect()] == ["Mars"]
    assert "Tx_Commodity=1&Tx_State=GA&Tx_District=0&Tx_Market=0&DateFrom=01-Feb-2024" in work.filter("ccode = '1'").first().query
    html = "<table title='x,77'><tr><th>Market</th><th>Arrivall</th></tr><tr><td>M1</td><td>3.5</td></tr></table>"
    got = markets.market_rows(work, spark.createDataFrame([("1", "GA", "North", html)], "ccode string, scode string, district string, html string"))
    assert rows(got) == [("01-Feb-2024", "05-Feb-2024", "Goa", "GA", "North", "77", "M1", "Rice", "1", "3.5")]
    done = spark.createDataFrame([("1", "Rice", "Goa")], "ccode string, name string, state string")
    log = spark.createDataFrame([("2", "Goa", 1, "Server Error"), ("2", "Goa", 2, "Market Table Error")], "ccode string, state string, attempt int, message string")
    assert rows(markets.rerun_report(work, done, log)) == [("2", "Tea", "Goa", "Server Error >>> Market Table Error")]
