"""Groups, merges, numbering, quantiles, reshaping against plain Python."""

import math
import random
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quadrat.operators import describe as D, groups as G, merge as J, numbering as N, quantiles as Q, reshape as R


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds about half of the rows, another key is missing."""
    rng = random.Random(7)
    data = [(i, rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([None, 1.0, 2.0, 3.5, 3.5, 9.0])) for i in range(600)]
    return data, spark.createDataFrame(data, "id int, k string, x double").repartition(7)


def test_row_numbers_match_sorting(skewed):
    data, df = skewed
    got = {r.id: r.rn for r in N.with_row_numbers(df, ["x", "id"]).collect()}
    want = sorted(data, key=lambda r: (r[2] is None, r[2] or 0, r[0]))
    assert got == {r[0]: i for i, r in enumerate(want)}


def test_group_positions_match_sorting(skewed):
    data, df = skewed
    got = {r.id: (r.position, r.group_size) for r in N.with_group_position(df, ["k"], ["id"]).collect()}
    for key in {r[1] for r in data}:
        ids = sorted(r[0] for r in data if r[1] == key)
        assert [got[i] for i in ids] == [(n, len(ids)) for n in range(1, len(ids) + 1)]


@pytest.mark.parametrize("n", [3, 10, 35])
def test_chunks_and_splits(spark, n):
    df = spark.range(n)
    sizes = lambda out, c: [r["count"] for r in out.groupBy(c).count().orderBy(c).collect()]
    assert sizes(N.even_chunks(df, ["id"], 4), "chunk") == [n // 4 + (i < n % 4) for i in range(4) if n // 4 + (i < n % 4)]
    small = n // 4
    assert sizes(N.floor_splits(df, ["id"], 4), "split") == ([small] * 3 + [n - 3 * small] if small else [n])
    assert {r.slot for r in N.round_robin(df, ["id"], 3).filter("id % 3 = 1").collect()} <= {1}


@pytest.mark.parametrize("block", [5, 1000])
def test_forward_fill(skewed, block):
    data, df = skewed
    got = {r.id: r.y for r in N.forward_fill(df, "x", "id", by=["k"], out="y", block_lines=block).collect()}
    last = {}
    for i, k, x in sorted(data):
        last[k] = x if x is not None else last.get(k)
        assert got[i] == last[k]


def brute_percentile(values, p):
    xs, pos = sorted(values), Fraction(p) * len(values) / 100
    whole = math.floor(pos)
    return (xs[whole - 1] + xs[whole]) / 2 if pos == whole else xs[whole]


@pytest.mark.parametrize("small", [2, 1000])
def test_percentiles_by_refinement(spark, small):
    rng = random.Random(3)
    xs = [7.0] * 200 + [rng.choice([rng.gauss(0, 1), rng.uniform(-1e6, 1e6), 3.25]) for _ in range(400)] + [None] * 5
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    known = [x for x in xs if x is not None]
    percents = [5, 20, 50, 80, 99]
    assert Q.percentiles(df, "x", percents, bins=16, small=small) == [brute_percentile(known, p) for p in percents]


def test_bins_are_monotone_and_value_based(spark):
    xs = [1.0, 1.0, 1.0, 2.0, 3.0, 3.0, 4.0, 5.0, 6.0, 7.0, None]
    out = rows(Q.quantile_bins(spark.createDataFrame([(x,) for x in xs], "x double"), "x", 5, "b").filter("x is not null"), "x")
    bins = [b for _, b in out]
    assert bins == sorted(bins) and len({b for x, b in out if x == 1.0}) == 1


def test_missing_lands_in_the_top_tier(spark):
    df = spark.createDataFrame([(1.0,), (500.0,), (500.5,), (None,), (150.0,)], "x double")
    got = dict(rows(Q.tiered_bins(df, "x", 5, [(500, 8), (200, 7), (100, 6)], "b")))
    assert (got[500.0], got[500.5], got[None], got[150.0]) == (7, 8, 8, 6)


def test_spread_includes_the_missing_group(skewed):
    data, df = skewed
    got = {r.id: (r.n, r.top) for r in G.spread(df, ["k"], {"n": F.count("x"), "top": F.max("x")}).collect()}
    for i, k, _ in data:
        xs = [x for _, kk, x in data if kk == k and x is not None]
        assert got[i] == (len(xs), max(xs))


def test_first_last_mode(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 3), (1, "a", None), (2, "c", 5)], "g int, c string, m int")
    assert rows(G.first_rows(df, ["g"], ["m", "c"]).select("g", "m"), "g") == [(1, 1), (2, 5)]
    assert rows(G.last_row(df, ["g"], ["m"]).select("g", "m"), "g") == [(1, None), (2, 5)]
    tie = F.when(F.col("c") == "b", 1).otherwise(2)
    assert rows(G.mode_by(df, ["g"], "c", tie), "g") == [(1, "b", 2), (2, "c", 1)]
    counts = G.counts_by(df, ["g", "c"])
    assert rows(G.rows_at_maximum(counts, ["g"], "n"), "g", "c") == [(1, "a", 2), (1, "b", 2), (2, "c", 1)]


def test_first_row_is_limited_before_the_shuffle(skewed):
    _, df = skewed
    plan = G.first_rows(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sum_by_drops_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 5), ("a", 2)], "k string, x int")
    assert rows(G.sum_by(df, ["k"], t="x")) == [("a", 3)]


def test_share_above(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 5)], "g int, r int, n int")
    assert [r.share_above for r in G.share_above(df, ["g"], "r", "n").orderBy("r").collect()] == [0.0, 0.2, 0.5]


def test_merge_one_to_many(spark):
    master = spark.createDataFrame([(1, "m1", 10), (None, "mn", 20), (9, "m9", 30)], "k int, tag string, v int")
    using = spark.createDataFrame([(1, "u1"), (1, "u2"), (None, "un"), (5, "u5")], "k int, tag string")
    got = rows(J.merge_one_to_many(master, using, ["k"], keep=(1, 2, 3), indicator="_merge"))
    assert sorted(got, key=str) == sorted([(1, "m1", 10, 3)] * 2 + [(None, "mn", 20, 3), (5, "u5", None, 2), (9, "m9", 30, 1)], key=str)
    assert J.merge_one_to_many(master, using, ["k"]).count() == 4
    with pytest.raises(J.DuplicateKeyError):
        J.merge_one_to_many(using, using, ["k"])
    with pytest.raises(J.DuplicateKeyError):
        J.declare_panel(using.withColumnRenamed("tag", "t").withColumn("w", F.lit(1)), "k", "w")


def test_lookup_and_hierarchy(spark):
    df, table = spark.createDataFrame([("a",), ("z",)], "k string"), spark.createDataFrame([("a", 1)], "k string, v int")
    hit, miss = J.strict_lookup(df, table, ["k"], "v")
    assert rows(hit) == [("a", 1)] and rows(miss) == [("z",)]
    states, districts = spark.createDataFrame([("s",), ("t",)], "S string"), spark.createDataFrame([("s", "d")], "S string, D string")
    assert rows(J.join_hierarchy([states, districts], [["S"]])) == [("s", "d")]
    assert rows(J.expand_list(spark.createDataFrame([(1, ["x", "y"]), (2, [])], "k int, l array<string>"), "l", "i"), "i") == [(1, "x"), (1, "y")]


def test_reshape_round_trip(spark):
    long = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], "i int, j string, v int")
    wide = R.to_wide(long, ["i"], "j", ["v"], ["a", "b"])
    assert rows(wide, "i") == [(1, 5, 6), (2, 7, None)]
    assert rows(R.to_long(wide, ["i"], "v", "j").filter("v is not null"), "i", "j") == [(1, "a", 5), (1, "b", 6), (2, "a", 7)]
    assert rows(R.fill_zero(wide, "v"), "i")[1] == (2, 7, 0)
    with pytest.raises(Exception, match="repeated key"):
        R.to_wide(long.union(long), ["i"], "j", ["v"], ["a", "b"]).collect()
    assert rows(R.transpose(R.fill_zero(wide, "v"), "i", [1, 2]), "varname") == [("va", 5, 7), ("vb", 6, 0)]
    assert R.insert_constants(long, 1, c=3).columns == ["i", "c", "j", "v"]


def test_crosstab_sums_to_100(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", 4.0), (None, "x", 9.0), ("a", "x", None)], "r string, c string, w double")
    got = {(a, b): p for a, b, p in rows(D.crosstab(df, "r", "c", "w"))}
    assert got[("Total", "Total")] == 100.0 and got[("a", "Total")] == 50.0 and got[("b", "x")] == 50.0
    assert abs(sum(p for (a, b), p in got.items() if "Total" not in (a, b)) - 100) < 1e-9


def test_t_test_and_stars(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 6.0]
    df = spark.createDataFrame([(0, x) for x in a] + [(1, x) for x in b] + [(0, None)], "g int, x double")
    r = D.t_tests(df, ["x"], "g", 0, 1).first()
    ma, mb = sum(a) / 4, sum(b) / 3
    pooled = (sum((x - ma) ** 2 for x in a) + sum((x - mb) ** 2 for x in b)) / 5
    assert r.n1 == 4 and r.df == 5 and abs(r.se - math.sqrt(pooled * (1 / 4 + 1 / 3))) < 1e-12 and abs(r.b - (ma - mb)) < 1e-12
    density = lambda u: (1 + u * u / 5) ** -3 * math.gamma(3) / (math.gamma(2.5) * math.sqrt(5 * math.pi))
    step = abs(r.t) / 2000
    assert abs(r.p - (1 - 2 * step * sum(density((i + 0.5) * step) for i in range(2000)))) < 1e-6


def test_p_values_against_known_points():
    from quadrat.functions.stats import f_upper, t_two_sided

    assert abs(t_two_sided(2.228138852, 10) - 0.05) < 1e-8 and abs(t_two_sided(12.7062047, 1) - 0.05) < 1e-8
    assert abs(f_upper(4.102821015, 2, 10) - 0.05) < 1e-8


def test_listwise(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 5.0)], "a double, b double")
    assert [r.n for r in D.summarise(df, ["a", "b"]).orderBy("variable").collect()] == [3, 2]
    assert [r.n for r in D.summarise(df, ["a", "b"], listwise=True).collect()] == [2, 2]


def test_first_n_too_large(spark):
    with pytest.raises(ValueError):
        N.first_n(spark.range(3), ["id"], 5)


def test_quantiles_when_the_sketch_misses(spark):
    rng = random.Random(8)
    xs = [round(rng.gauss(0, 100), 1) for _ in range(3000)] + [5.0] * 2000
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    ordered, ranks = sorted(xs), [1, 2, 700, 2500, 2501, 4999, 5000]
    want = {r: ordered[r - 1] for r in ranks}
    for guesses in ([(-50.0, -40.0), (-45.0, 5.0), (90.0, 91.0)], [(1e6, 2e6)], [(-1e6, 1e6)], [(5.0, 5.0)]):
        for small in (10, 100_000):
            assert Q.values_at_ranks(df, "x", ranks, bins=16, small=small, guesses=guesses) == want


def test_quantiles_read_their_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(float(i),) for i in range(1000)], "x double").mapInArrow(counted, "x double")
    assert Q.percentiles(df, "x", [10, 25, 50, 75, 90]) == [99.5, 249.5, 499.5, 749.5, 899.5] and reads.value == 1000


@pytest.mark.parametrize("by", [(), ("g",)])
def test_forward_fill_of_sparse_lines(spark, by, monkeypatch):
    monkeypatch.setattr(N, "_FAN", 1 << 12)
    rng = random.Random(12)
    lines = sorted(rng.sample(range(-500, 100_000), 400) + [2**62])
    data = [(n, rng.choice(["a", "b", None]), rng.choice(["x", "y"]) if rng.random() < 0.2 else None) for n in lines]
    got = N.forward_fill(spark.createDataFrame(data, "line bigint, g string, v string"), "v", "line", by=by, block_lines=10)
    last, want = {}, []
    for n, g, v in data:
        last[g if by else 0] = v or last.get(g if by else 0)
        want.append((n, g, last[g if by else 0]))
    assert rows(got.select("line", "g", "v"), "line") == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
