"""Fixed-effects regressions on the shared tables."""

from pyspark.sql import functions as F

from quadrat.functions.keys import set_label
from quadrat.operators import regress as E
from quadrat.queries.elimination import clustered, p_value
from quadrat.queries.registry import Tables, query


def _round(df, digits=6):
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


def _lines(t: Tables):
    return t.lineitem.select(
        "l_suppkey", "l_returnflag", "l_linestatus", (F.col("l_extendedprice") / 1000).alias("price"),
        F.col("l_quantity").alias("qty"), (F.col("l_discount") * 100).alias("disc"), (F.col("l_tax") * 100).alias("tax"),
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_partkey")


@query("wls_one_way_fe", """
    WITH r AS (SELECT l_suppkey AS g, l_extendedprice / 1000 AS y, l_discount * 100 AS x, l_tax * 100 AS z, l_quantity AS w FROM lineitem
               QUALIFY count(*) OVER (PARTITION BY l_suppkey) > 1),
    d AS (SELECT g, w, y - sum(w * y) OVER p / sum(w) OVER p AS y, x - sum(w * x) OVER p / sum(w) OVER p AS x, z - sum(w * z) OVER p / sum(w) OVER p AS z
          FROM r WINDOW p AS (PARTITION BY g)),
    m AS (SELECT sum(w * x * x) AS xx, sum(w * x * z) AS xz, sum(w * z * z) AS zz, sum(w * x * y) AS xy, sum(w * z * y) AS zy, count(*) AS n,
                 count(DISTINCT g) AS m FROM d),
    b AS (SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM m),
    s AS (SELECT g, sum(w * x * (y - b1 * x - b2 * z)) AS s1, sum(w * z * (y - b1 * x - b2 * z)) AS s2 FROM d, b GROUP BY g),
    q AS (SELECT sum(s1 * s1) AS q11, sum(s1 * s2) AS q12, sum(s2 * s2) AS q22 FROM s),
    v AS (SELECT *, (m / (m - 1.0)) * ((n - 1.0) / (n - 3.0)) AS c FROM b, q),
    f AS (SELECT 'disc' AS term, b1 AS b, sqrt(c * (zz * zz * q11 - 2 * zz * xz * q12 + xz * xz * q22)) / det AS se, n FROM v
          UNION ALL SELECT 'tax', b2, sqrt(c * (xz * xz * q11 - 2 * xx * xz * q12 + xx * xx * q22)) / det, n FROM v)
    SELECT term, round(b, 6) AS b, round(se, 6) AS se, round(b / se, 5) AS t, n FROM f
""")
def wls_one_way_fe(t: Tables):
    """Weighted regression with one absorbed key and errors clustered on it."""
    fit = E.absorb_regression(_lines(t), "price", ["disc", "tax"], ["l_suppkey"], weight="qty", cluster="l_suppkey")
    return E.coefficients([fit]).select(
        "term", F.round("b", 6).alias("b"), F.round("se", 6).alias("se"), F.round("t", 5).alias("t"), F.lit(fit.n).cast("bigint").alias("n"))


@query("fe_fit_statistics", """
    WITH r AS (SELECT l_suppkey AS g, l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_suppkey) > 1),
    d AS (SELECT g, y AS y0, y - avg(y) OVER p AS y, x - avg(x) OVER p AS x FROM r WINDOW p AS (PARTITION BY g)),
    b AS (SELECT regr_slope(y, x) AS b, count(*) AS n, avg(y0) AS ymean, var_pop(y0) * count(*) AS tss, sum(y * y) AS yy, count(DISTINCT g) AS m FROM d),
    e AS (SELECT sum((y - b * x) * (y - b * x)) AS rss FROM d, b)
    SELECT n, round(ymean, 6) AS ymean, round(1 - rss / tss, 6) AS r2, round(1 - rss / yy, 6) AS r2_within, m AS clusters, round(b, 6) AS b FROM b, e
""")
def fe_fit_statistics(t: Tables):
    fit = E.absorb_regression(_lines(t), "price", ["qty"], ["l_suppkey"], cluster="l_suppkey")
    return _round(E.fit_statistics([fit]).select("n", "ymean", "r2", "r2_within", "clusters", F.lit(float(fit.b[0])).alias("b")))


@query("fe_two_way", """
    WITH RECURSIVE r AS (SELECT l_suppkey AS g, year(l_shipdate) AS h, l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem),
    c AS (SELECT g, h, count(*) AS n, avg(y) AS y, avg(x) AS x FROM r GROUP BY 1, 2),
    it AS (SELECT 0 AS k, g, h, n, y, x FROM c
           UNION ALL
           SELECT k + 1, g, h, n, y - sum(n * y) OVER ph / sum(n) OVER ph, x - sum(n * x) OVER ph / sum(n) OVER ph FROM
             (SELECT k, g, h, n, y - sum(n * y) OVER pg / sum(n) OVER pg AS y, x - sum(n * x) OVER pg / sum(n) OVER pg AS x
              FROM it WHERE k < 40 WINDOW pg AS (PARTITION BY g)) WINDOW ph AS (PARTITION BY h)),
    d AS (SELECT r.y - c.y + it.y AS y, r.x - c.x + it.x AS x FROM r JOIN c USING (g, h) JOIN it ON it.g = r.g AND it.h = r.h AND it.k = 40)
    SELECT 'qty' AS term, round(sum(x * y) / sum(x * x), 6) AS b, count(*) AS n FROM d
""")
def fe_two_way(t: Tables):
    """Two absorbed keys that are not nested: the effects are found by iteration."""
    fit = E.absorb_regression(_lines(t), "price", ["qty"], ["l_suppkey", "year"], cluster="l_suppkey")
    return E.coefficients([fit]).select("term", F.round("b", 6).alias("b"), F.lit(fit.n).cast("bigint").alias("n"))


_CROSSED = ["N.l_returnflag", "R.l_returnflag", "O.l_linestatus", "N.l_returnflag#O.l_linestatus", "R.l_returnflag#O.l_linestatus", "disc"]


@query("fe_interactions", f"""
    WITH RECURSIVE r AS (
        SELECT l_suppkey AS g, l_quantity AS w, l_extendedprice / 1000 AS y, (l_returnflag = 'N')::DOUBLE AS x1, (l_returnflag = 'R')::DOUBLE AS x2,
               (l_linestatus = 'O')::DOUBLE AS x3, (l_returnflag = 'N' AND l_linestatus = 'O')::DOUBLE AS x4,
               (l_returnflag = 'R' AND l_linestatus = 'O')::DOUBLE AS x5, l_discount * 100 AS x6
        FROM lineitem WHERE l_quantity > 5 QUALIFY count(*) OVER (PARTITION BY l_suppkey) > 1),
    d AS (SELECT 'one' AS m, g, w, 1 AS dfa, {", ".join(f"{c} - sum(w * {c}) OVER p / sum(w) OVER p AS {c}" for c in ["y", *[f"x{i}" for i in range(1, 7)]])}
          FROM r WINDOW p AS (PARTITION BY g)),
    {clustered(_CROSSED)}
    SELECT term, round(b, 5) AS b, round(se, 5) AS se, round(t, 5) AS t, round({p_value("t", "df")}, 5) AS p FROM est
""")
def fe_interactions(t: Tables):
    """Full factorial of two factors, an extra interaction, on a subgroup."""
    rows = _lines(t).filter("qty > 5")
    flag, status = E.Factor("l_returnflag"), E.Factor("l_linestatus")
    fit = E.absorb_regression(
        rows, "price", [E.Cross((flag, status)), "disc", E.Cross((flag, status), full=False)], ["l_suppkey"], weight="qty", cluster="l_suppkey")
    return _round(E.coefficients([fit]).select("term", "b", "se", "t", "p"), 5)


# sample, model and its second key beside the year; the last model's singletons are left out of the common sample
_LADDER = [(sample, model, key) for sample in ("all", "common") for model, key in (
    ("A", "0"), ("B", "l_suppkey::VARCHAR"), ("C", "l_suppkey || '|' || l_returnflag"))]
_VALUES = ["y", "x1", "x2", "x3"]


def _less_mean(key: str) -> str:
    return ", ".join(f"{c} - sum(n * {c}) OVER {key} / sum(n) OVER {key} AS {c}" for c in _VALUES)


@query("fe_two_way_ladder", f"""
    WITH RECURSIVE base AS (
        SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_returnflag) > 1 AS common, year(l_shipdate) AS a, l_extendedprice / 1000 AS y, l_quantity AS x1,
               l_discount * 100 AS x2, (l_linestatus = 'O')::DOUBLE AS x3 FROM lineitem),
    r AS ({" UNION ALL ".join(
        f"SELECT '{sample}' AS sample, '{model}' AS model, l_suppkey AS g, a, {key} AS z, y, x1, x2, x3 FROM base"
        + (" WHERE common" if sample == "common" or model == "C" else "") + f" QUALIFY count(*) OVER (PARTITION BY {key}) > 1" for sample, model, key in _LADDER)}),
    c AS (SELECT sample, model, a, z, count(*) AS n, {", ".join(f"avg({v}) AS {v}" for v in _VALUES)} FROM r GROUP BY ALL),
    it AS (SELECT 0 AS k, * FROM c
           UNION ALL
           SELECT k + 1, sample, model, a, z, n, {_less_mean("pa")} FROM
             (SELECT k, sample, model, a, z, n, {_less_mean("pz")} FROM it WHERE k < 40 WINDOW pz AS (PARTITION BY sample, model, z))
             WINDOW pa AS (PARTITION BY sample, model, a)),
    years AS (SELECT sample, model, count(DISTINCT a) AS levels FROM r GROUP BY ALL),
    d AS (SELECT sample || ' ' || model AS m, r.g, 1 AS w, levels + CASE model WHEN 'A' THEN 0 ELSE 1 END AS dfa,
                 {", ".join(f"r.{v} - c.{v} + it.{v} AS {v}" for v in _VALUES)}
          FROM r JOIN c USING (sample, model, a, z) JOIN it USING (sample, model, a, z) JOIN years USING (sample, model) WHERE it.k = 40),
    {clustered(["qty", "disc", "O.l_linestatus"])}
    SELECT split_part(m, ' ', 1) AS sample, split_part(m, ' ', 2) AS model, term, round(b, 5) AS b, round(se, 5) AS se, round(t, 5) AS t FROM est
""")
def fe_two_way_ladder(t: Tables):
    """Nested fixed-effect specifications, again on the sample of the last one."""
    specs = {
        "A": ["year"],
        "B": ["year", "l_suppkey"],
        "C": ["year", "l_suppkey", ("l_suppkey", "l_returnflag")],
    }
    full, common = E.ladder_on_common_sample(_lines(t), "price", ["qty", "disc", E.Factor("l_linestatus")], specs, cluster="l_suppkey")
    both = E.coefficients(list(full.values())).withColumn("sample", F.lit("all")).unionByName(
        E.coefficients(list(common.values())).withColumn("sample", F.lit("common")))
    return _round(both.select("sample", "model", "term", "b", "se", "t"), 5)


@query("publication_table", f"""
    WITH RECURSIVE r AS (
        SELECT * FROM (
            SELECT 'A' AS m, l_suppkey AS g, 1 AS w, year(l_shipdate) AS z, l_extendedprice / 1000 AS y, (l_linestatus = 'O')::DOUBLE AS x1 FROM lineitem
            UNION ALL SELECT 'B', l_suppkey, 1, l_suppkey, l_extendedprice / 1000, (l_linestatus = 'O')::DOUBLE FROM lineitem)
        QUALIFY count(*) OVER (PARTITION BY m, z) > 1),
    d AS (SELECT m, g, w, CASE m WHEN 'A' THEN (SELECT count(DISTINCT z) FROM r WHERE m = 'A') ELSE 1 END AS dfa,
                 y AS y0, y - avg(y) OVER p AS y, x1 - avg(x1) OVER p AS x1 FROM r WINDOW p AS (PARTITION BY m, z)),
    {clustered(["O.l_linestatus"])},
    fit AS (SELECT e.*, ymean, 1 - rss / tss AS r2, {p_value("t", "df")} AS p FROM est e JOIN
        (SELECT d.m, avg(y0) AS ymean, var_pop(y0) * count(*) AS tss, sum((d.y - b1 * d.x1) ** 2) AS rss FROM d JOIN slopes USING (m) GROUP BY d.m) USING (m)),
    cells AS (
        SELECT m, unnest(['Status: open', '', 'Observations', 'Mean of dependent variable', 'R-Squared', 'F']) AS label,
               unnest([format('{{:.3f}}', b) || CASE WHEN p < 0.01 THEN '***' WHEN p < 0.05 THEN '**' WHEN p < 0.1 THEN '*' ELSE '' END, '(' || format('{{:.3f}}', se) || ')',
                       format('{{:,}}', n), format('{{:.3f}}', ymean), format('{{:.3f}}', r2), format('{{:.3f}}', t * t)]) AS cell FROM fit)
    SELECT label || ' & ' || max(cell) FILTER (m = 'A') || ' & ' || max(cell) FILTER (m = 'B') || ' \\\\' AS line FROM cells GROUP BY label
    UNION ALL SELECT unnest(['\\textit{{Line:}} &  &  \\\\', 'Year FE & Yes & No \\\\', 'Supplier FE & No & Yes \\\\'])
""")
def publication_table(t: Tables):
    """Two models side by side: labelled terms under a heading, statistics with F, absorbed effects."""
    rows = set_label(_lines(t), {}, {"l_linestatus": {"O": "Status: open"}})
    fits = [E.absorb_regression(rows, "price", [E.Factor("l_linestatus")], [key], cluster="l_suppkey", model=m) for m, key in (("A", "year"), ("B", "l_suppkey"))]
    return E.regression_lines(
        fits, headings={"O.l_linestatus": r"\textit{Line:}"}, statistics=("n", "ymean", "r2", "f"), effects={"Year FE": ["A"], "Supplier FE": ["B"]})
