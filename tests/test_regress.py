"""Estimators against explicit dummy-variable least squares."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrat.operators import regress as E


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    n = 500
    pdf = pd.DataFrame({
        "g": rng.integers(0, 25, n), "h": rng.integers(0, 12, n), "x": rng.normal(size=n), "z": rng.normal(size=n),
        "a": rng.integers(0, 3, n), "b": rng.integers(0, 2, n), "w": rng.uniform(0.5, 2, n)})
    pdf.loc[:150, "g"] = 3
    pdf["y"] = 1.5 * pdf.x - 0.5 * pdf.z + 0.3 * pdf.g + 0.2 * pdf.h + 0.7 * pdf.a * pdf.b + rng.normal(size=n)
    pdf["x"] = pdf.x + 0.1 * pdf.g
    single = pd.DataFrame({"g": [100], "h": [0], "x": [9.0], "z": [9.0], "a": [1], "b": [1], "w": [1.0], "y": [99.0]})
    return pd.concat([pdf, single], ignore_index=True).astype({c: "int64" for c in "ghab"})


def dummies(pdf, keys):
    blocks = [pd.get_dummies(pdf[k].astype(str) if isinstance(k, str) else pdf[list(k)].astype(str).agg("|".join, axis=1)).to_numpy(float) for k in keys]
    return np.hstack(blocks)


def explicit(pdf, y, xs, keys, w, cluster=None, absorbed=None, nested=0):
    d = np.hstack([xs, dummies(pdf, keys)])
    sw = np.sqrt(w)[:, None]
    beta, _, rank, _ = np.linalg.lstsq(d * sw, pdf[y].to_numpy() * sw[:, 0], rcond=None)
    k = xs.shape[1]
    f = dummies(pdf, keys) * sw
    proj = lambda m: m - f @ np.linalg.lstsq(f, m, rcond=None)[0]
    xt, e = proj(xs * sw), proj((pdf[y].to_numpy() * sw[:, 0])[:, None])[:, 0]
    e = e - xt @ beta[:k]
    inv = np.linalg.inv(xt.T @ xt)
    if cluster is None:
        return beta[:k], None, rank
    s = np.vstack([(xt[pdf[cluster] == c] * e[pdf[cluster] == c][:, None]).sum(0) for c in pdf[cluster].unique()])
    m, n = len(s), len(pdf)
    v = m / (m - 1) * (n - 1) / (n - k - absorbed - nested) * inv @ s.T @ s @ inv
    return beta[:k], np.sqrt(np.diag(v)), rank


def test_one_way_weighted_clustered(spark, data):
    fit = E.absorb_regression(spark.createDataFrame(data), "y", ["x", "z"], ["g"], weight="w", cluster="g")
    kept = data[data.g != 100]
    b, se, _ = explicit(kept, "y", kept[["x", "z"]].to_numpy(), ["g"], kept.w.to_numpy(), "g", 0, 1)
    assert fit.n == len(kept) and fit.sample.count() == len(kept)
    assert np.allclose(fit.b, b, atol=1e-9) and np.allclose(np.sqrt(np.diag(fit.vcov)), se, atol=1e-9)


def test_two_way_iterated(spark, data):
    fit = E.absorb_regression(spark.createDataFrame(data), "y", ["x", "z"], ["g", "h"], cluster="g")
    kept = data[data.g != 100]
    b, se, _ = explicit(kept, "y", kept[["x", "z"]].to_numpy(), ["g", "h"], np.ones(len(kept)), "g", 12, 1)
    assert np.allclose(fit.b, b, atol=1e-7) and np.allclose(np.sqrt(np.diag(fit.vcov)), se, atol=1e-6)
    assert fit.absorbed == 12


def test_two_way_degrees_of_freedom(spark, data):
    """Without clusters both keys count, less the redundancy between them."""
    fit = E.absorb_regression(spark.createDataFrame(data), "y", ["x"], ["g", "h"])
    kept = data[data.g != 100]
    rank = np.linalg.matrix_rank(dummies(kept, ["g", "h"]))
    assert fit.absorbed == rank and fit.df_resid == len(kept) - 1 - rank


def test_interactions_and_collinearity(spark, data):
    a, b = E.Factor("a"), E.Factor("b")
    frame = spark.createDataFrame(data.assign(copy=2 * data.x, gfix=1.0 * data.g))
    fit = E.absorb_regression(frame, "y", [E.Cross((a, b)), "x", "copy", "gfix", E.Cross((a, b), full=False)], ["g"], cluster="g")
    assert fit.omitted == ["copy", "gfix"]
    assert fit.terms == ["1.a", "2.a", "1.b", "1.a#1.b", "2.a#1.b", "x"]
    kept = data[data.g != 100]
    xs = np.column_stack([kept.a == 1, kept.a == 2, kept.b == 1, (kept.a == 1) & (kept.b == 1), (kept.a == 2) & (kept.b == 1), kept.x]).astype(float)
    want, se, _ = explicit(kept, "y", xs, ["g"], np.ones(len(kept)), "g", 0, 1)
    assert np.allclose(fit.b, want, atol=1e-9) and np.allclose(np.sqrt(np.diag(fit.vcov)), se, atol=1e-9)


def test_base_level(spark, data):
    fit = E.absorb_regression(spark.createDataFrame(data), "y", [E.Factor("a", base=1)], ["g"], cluster="g")
    assert fit.terms == ["0.a", "2.a"]


def test_chained_singletons(spark):
    """Dropping one singleton makes another one."""
    pdf = pd.DataFrame({"g": [1, 1, 1, 2, 2, 3], "h": [1, 2, 1, 2, 3, 3], "x": [1.0, 2, 4, 3, 5, 1], "y": [1.0, 3, 2, 5, 4, 9]})
    fit = E.absorb_regression(spark.createDataFrame(pdf), "y", ["x"], ["g", "h"])
    # g=3 goes, then h=3 is alone, then g=2 is alone, then h=2 is alone
    assert fit.n == 2


def test_ladder_on_common_sample(spark, data):
    specs = {"A": ["h"], "B": ["h", "g"]}
    full, common = E.ladder_on_common_sample(spark.createDataFrame(data), "y", ["x"], specs, cluster="h")
    assert full["A"].n == len(data) and common["A"].n == common["B"].n == full["B"].n == len(data) - 1
    lines = [r.line for r in E.regression_lines(list(full.values())).collect()]
    assert lines[0].startswith("x & ") and lines[-1].startswith("Observations & 501 & 500")
    assert [r.model for r in E.fit_statistics(list(full.values())).collect()] == ["A", "B"]


def test_table_lines_with_labels_headings_and_effects(spark, data):
    from quadrat.functions.keys import set_label

    frame = set_label(spark.createDataFrame(data), {"x": "Exposure", "a": "Arm"}, {"b": {1: "Treated"}})
    a, b = E.Factor("a"), E.Factor("b")
    fits = [E.absorb_regression(frame, "y", ["x", E.Cross((a, b))], [k], cluster="g", model=k) for k in ("h", "g")]
    lines = [r.line for r in E.regression_lines(
        fits, headings={"1.a": "Design:"}, statistics=("n", "f"), effects={"H": ["h"], "G": ["g"]}).collect()]
    labels = [line.split(" & ")[0] for line in lines]
    assert labels == ["Exposure", "", "Design:", "Arm=1", "", "Arm=2", "", "Treated", "", r"Arm=1 $\times$ Treated", "", r"Arm=2 $\times$ Treated", "",
                      "Observations", "F", "H", "G"]
    assert lines[2] == r"Design: &  &  \\" and lines[-2:] == [r"H & Yes & No \\", r"G & No & Yes \\"]
    assert E.regression_lines(fits, keep=["x"], labels={"x": "X"}).first().line.startswith("X & ")


def test_components_of_a_long_chain(spark):
    """A chain needs many rounds; labels have to settle everywhere before the components are counted."""
    cells = spark.createDataFrame([(i // 2, (i + 1) // 2) for i in range(1, 9)] + [(100, 100)], "a int, b int")
    assert E._components(cells, ("a",), ("b",)) == 2


def test_wage_and_survey_tables(spark, data):
    from quadrat.plans import survey, wages

    frame = spark.createDataFrame(data.rename(columns={"x": "tech_ai"}))
    fits = {m: E.absorb_regression(frame, "y", ["tech_ai"], ["g"], cluster="g", model=m) for m in ("A", "D")}
    lines = [r.line for r in wages.wage_table(fits).collect()]
    assert lines[0].startswith("tech_ai & ") and len(lines) == 14
    assert lines[5] == r"State FE & Yes & Yes \\" and lines[7] == r"State $\times$ SOC FE & No & Yes \\" and lines[10] == r"Company FE & No & Yes \\"
    assert [r.line.split(" & ")[0] for r in survey.regression_table(fits).collect()] == [
        "tech_ai", "", "Observations", "Mean of dependent variable", "R-Squared", "F"]


def test_components_of_a_long_chain_and_a_star(spark):
    from quadrat.operators.graph import components

    chain = [(i, i + 1) for i in range(10_000)]
    rows = chain + [(50_000, i) for i in range(50_001, 53_000)] + [(60_000, 60_000), (None, 3), (7, 6), (7, 6)]
    found, rounds = components(spark.createDataFrame(rows, "u bigint, v bigint").repartition(4))
    got = {r["node"]: r["root"] for r in found.collect()}
    assert got == {i: 0 for i in range(10_001)} | {i: 50_000 for i in range(50_000, 53_000)} | {60_000: 60_000}
    assert rounds <= 20
    empty, rounds = components(spark.createDataFrame([], "u bigint, v bigint"))
    assert empty.count() == 0


def test_step_folders_are_removed(spark, data):
    from pathlib import Path

    from quadrat.session import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = len(list(folder.glob("step-*")))
    fit = E.absorb_regression(spark.createDataFrame(data), "y", ["x", "z"], ["g", "h", "a"], cluster="g")
    assert 0 < fit.steps <= 20
    assert len(list(folder.glob("step-*"))) - before < 15  # cells, effects and products, nothing of the steps


def test_three_hundred_terms(spark):
    made = np.random.default_rng(3)
    n, k = 1500, 300
    x, g, w = made.normal(size=(n, k)), made.integers(0, 40, n), made.uniform(0.5, 2, n)
    y = x @ made.normal(size=k) + g + made.normal(size=n)
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"t{i}" for i in range(k)]).assign(g=g, w=w, y=y))
    fit = E.absorb_regression(df, "y", [f"t{i}" for i in range(k)], ["g"], weight="w", cluster="g")

    def within(v):
        return v - np.array([np.average(v[g == level], axis=0, weights=w[g == level]) for level in range(40)])[g]

    xd, yd = within(x), within(y)
    inverse = np.linalg.inv(xd.T @ (xd * w[:, None]))
    b = inverse @ (xd.T @ (w * yd))
    scores = np.array([(xd[g == level] * (w * (yd - xd @ b))[g == level, None]).sum(axis=0) for level in range(40)])
    se = np.sqrt(np.diag(40 / 39 * (n - 1) / (n - k - 1) * inverse @ (scores.T @ scores) @ inverse))
    assert np.allclose(fit.b, b, atol=1e-8) and np.allclose(np.sqrt(np.diag(fit.vcov)), se, atol=1e-8) and fit.clusters == 40 and fit.n == n


def _counted(spark, frame):
    """The same rows, and a count of how many were read."""
    seen = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return frame.mapInPandas(through, frame.schema), seen


def test_a_ladder_reads_the_rows_a_few_times(spark, data):
    df, seen = _counted(spark, spark.createDataFrame(data))
    specs = {"A": ["h"], "B": ["g"], "C": ["g", "h"]}
    E.ladder(df, "y", ["x", "z"], specs, cluster="g")
    assert 0 < seen.value <= 2 * len(data)  # whatever the number of models


def test_models_of_a_ladder_leave_out_their_own_null_keys(spark, data):
    df = spark.createDataFrame(data).withColumn("h", F.when(F.col("x") < 2.5, F.col("h")))
    fits = E.ladder(df, "y", ["x"], {"A": ["g"], "C": ["g", "h"]}, cluster="g")
    alone = E.absorb_regression(df.filter("h is not null"), "y", ["x"], ["g", "h"], cluster="g")
    assert alone.n == fits["C"].n < fits["A"].n
    assert np.allclose(alone.vcov, fits["C"].vcov, rtol=1e-7, atol=0)


def _by_dummies(pdf, x, keys):
    """Slopes by least squares on indicators of all levels, singletons dropped."""
    while True:
        kept = pdf[np.all([pdf.groupby(k)[x[0]].transform("size") > 1 for k in keys], axis=0)]
        if len(kept) == len(pdf):
            break
        pdf = kept
    dummies = [np.asarray(pd.get_dummies(pdf.groupby(k).ngroup()), "float64") for k in keys]
    m = np.column_stack([pdf[x], *dummies])
    return np.linalg.lstsq(m, pdf["y"].to_numpy(), rcond=None)[0][:len(x)], len(pdf)


def test_ladder_on_common_sample_against_indicators(spark):
    rng = np.random.default_rng(11)
    n = 900
    pdf = pd.DataFrame({"g": rng.integers(0, 90, n), "h": rng.integers(0, 40, n), "a": rng.integers(0, 6, n), "f": rng.choice(["p", "q", "r"], n),
                        "x": rng.normal(size=n), "z": rng.normal(size=n) * 3 + 5})
    pdf["y"] = 100 + pdf.x - pdf.z / 2 + pdf.g / 10 + pdf.h / 50 + (pdf.f == "q") + rng.normal(size=n)
    pdf.loc[0, "f"] = "o"  # base level of all rows, on a row that the last model drops
    pdf.loc[0, "h"] = 9999
    specs = {"D": ["g", "a"]}
    for rare in (False, True):
        frame = pdf if rare else pdf.iloc[1:]
        full, common = E.ladder_on_common_sample(spark.createDataFrame(frame), "y", ["x", E.Factor("f"), "z"], specs, cluster="h")
        last = full["D"].sample.toPandas()
        for fits, rows in ((full, frame), (common, last)):
            levels = sorted(rows.f.unique())[1:]
            terms = ["x", *[f"{v}.f" for v in levels], "z"]
            wide = rows.assign(**{f"{v}.f": (rows.f == v) * 1.0 for v in levels})
            for name, keys in specs.items():
                b, used = _by_dummies(wide, terms, keys)
                assert fits[name].terms == terms and fits[name].n == used
                assert np.allclose(fits[name].b, b, atol=1e-7)
        assert common["D"].n == full["D"].n == len(last)
