"""Summary tables, tabulations, t tests, typeset lines."""

from pyspark.sql import functions as F

from quadrat.functions import stats as S
from quadrat.operators import describe as D
from quadrat.queries.elimination import p_value
from quadrat.queries.registry import Tables, query

_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rounded(df, digits=6):
    return df.select(*[
        (F.round(f.name, digits) + 0.0).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields
    ])


@query("summary_stats", " UNION ALL ".join(f"""
    SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, round(min({c}), 6) + 0.0 AS min, max({c}) AS max,
           count({c}) AS n FROM lineitem""" for c in _NUMERIC))
def summary_stats(t: Tables):
    return _rounded(D.summarise(t.lineitem, _NUMERIC, ["mean", "sd", "min", "max", "n"]))


@query("summary_listwise", " UNION ALL ".join(f"""
    SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, count({c}) AS n
    FROM (SELECT CASE WHEN value >= 10 THEN value END AS value, length(event_type)::DOUBLE AS len,
                 CASE WHEN event_type <> 'error' THEN user_id::DOUBLE END AS member FROM events)
    WHERE value IS NOT NULL AND member IS NOT NULL""" for c in ("value", "len", "member")))
def summary_listwise(t: Tables):
    """Rows with any missing variable are left out of every statistic."""
    rows = t.events.select(
        F.when(F.col("value") >= 10, F.col("value")).alias("value"), F.length("event_type").cast("double").alias("len"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("double")).alias("member"))
    return _rounded(D.summarise(rows, ["value", "len", "member"], listwise=True))


@query("summary_lines", " UNION ALL ".join(f"""
    SELECT '{l} & ' || format('{{:,.2f}}', avg({c})) || ' & ' || format('{{:,.1f}}', stddev_samp({c})) || ' & ' || format('{{:,}}', count({c})) || ' \\\\' AS line
    FROM lineitem""" for c, l in (("l_quantity", "Quantity"), ("l_extendedprice", "l_extendedprice"))))
def summary_lines(t: Tables):
    """Typeset body rows of a summary table."""
    stats = D.summarise(t.lineitem, ["l_quantity", "l_extendedprice"])
    return D.summary_lines(stats, {"l_quantity": "Quantity"}, [("mean", 2), ("sd", 1), ("n", 0)])


@query("weighted_crosstab", """
    WITH c AS (SELECT o_orderstatus, o_orderpriority, sum(o_totalprice) AS w, grouping(o_orderstatus) AS a, grouping(o_orderpriority) AS b
               FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority))
    SELECT CASE WHEN a = 1 THEN 'Total' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN b = 1 THEN 'Total' ELSE o_orderpriority END AS o_orderpriority,
           round(100.0 * w / (SELECT w FROM c WHERE a = 1 AND b = 1), 6) AS pct FROM c
""")
def weighted_crosstab(t: Tables):
    return _rounded(D.crosstab(t.orders, "o_orderstatus", "o_orderpriority", "o_totalprice"))


@query("crosstab_wide", """
    WITH c AS (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS w, grouping(l_returnflag) AS a, grouping(l_linestatus) AS b
               FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)),
         p AS (SELECT CASE WHEN a = 1 THEN 'Total' ELSE l_returnflag END AS r, CASE WHEN b = 1 THEN 'Total' ELSE l_linestatus END AS s,
                      round(100.0 * w / (SELECT w FROM c WHERE a = 1 AND b = 1), 6) AS pct FROM c)
    SELECT r AS l_returnflag, max(pct) FILTER (s = 'F') AS "F", max(pct) FILTER (s = 'O') AS "O", max(pct) FILTER (s = 'Total') AS "Total" FROM p GROUP BY r
""")
def crosstab_wide(t: Tables):
    return _rounded(D.crosstab_wide(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O"], "l_quantity"))


@query("weighted_tabulate", """
    SELECT o_orderpriority, round(100.0 * sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 6) AS pct FROM orders GROUP BY 1
""")
def weighted_tabulate(t: Tables):
    return _rounded(D.tabulate(t.orders, "o_orderpriority", "o_totalprice"))


def _quality_rows(t: Tables):
    docs = t.documents.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                              F.when(F.col("lang") != "en", F.col("n_chars").cast("double")).alias("foreign_chars"))
    return docs.join(t.labels, "doc_id")


_TTEST = """
    SELECT '{c}' AS variable, count({c}) FILTER (quality = 0) AS n1, count({c}) FILTER (quality = 1) AS n2,
           avg({c}) FILTER (quality = 0) AS mu_1, avg({c}) FILTER (quality = 1) AS mu_2,
           var_samp({c}) FILTER (quality = 0) AS v1, var_samp({c}) FILTER (quality = 1) AS v2
    FROM (SELECT n_chars::DOUBLE AS n_chars, CASE WHEN lang <> 'en' THEN n_chars::DOUBLE END AS foreign_chars, quality
          FROM documents JOIN labels USING (doc_id))"""


@query("ttest_groups", f"""
    WITH s AS ({_TTEST.format(c="n_chars")} UNION ALL {_TTEST.format(c="foreign_chars")}),
         e AS (SELECT *, sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS se FROM s)
    SELECT variable, n1, n2, round(mu_1, 6) AS mu_1, round(mu_2, 6) AS mu_2, round(mu_1 - mu_2, 6) AS b, round(se, 6) AS se,
           round((mu_1 - mu_2) / se, 6) AS t, (n1 + n2 - 2) AS df FROM e
""")
def ttest_groups(t: Tables):
    tests = D.t_tests(_quality_rows(t), ["n_chars", "foreign_chars"], "quality", 0, 1, p_value=False)
    return _rounded(tests)


@query("format_stars", f"""
    WITH s AS ({_TTEST.format(c="n_chars")} UNION ALL {_TTEST.format(c="foreign_chars")}),
         e AS (SELECT *, mu_1 - mu_2 AS b, n1 + n2 - 2 AS df, sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS se FROM s),
         p AS (SELECT *, b / se AS t, {p_value("(b / se)", "df")} AS p FROM e)
    SELECT CASE variable WHEN 'n_chars' THEN 'Length' ELSE variable END || ' & ' || format('{{:.3f}}', mu_1) || ' & ' || format('{{:.3f}}', mu_2) || ' & '
        || format('{{:.3f}}', b) || CASE WHEN p < 0.01 THEN '***' WHEN p < 0.05 THEN '**' WHEN p < 0.1 THEN '*' ELSE '' END
        || ' & (' || format('{{:.3f}}', se) || ') & ' || format('{{:.3f}}', t) || ' \\\\' AS line FROM p
""")
def format_stars(t: Tables):
    """Typeset t tests with significance marks."""
    return D.t_test_lines(D.t_tests(_quality_rows(t), ["n_chars", "foreign_chars"], "quality", 0, 1), {"n_chars": "Length"})


@query("star_marks", """
    SELECT o_orderkey, CASE WHEN p < 0.01 THEN '***' WHEN p < 0.05 THEN '**' WHEN p < 0.1 THEN '*' ELSE '' END AS mark,
           '(' || format('{:.2f}', o_totalprice) || ')' AS shown
    FROM (SELECT *, o_totalprice / 1000000 AS p FROM orders)
""")
def star_marks(t: Tables):
    """The mark and cell formats on given values."""
    return t.orders.select("o_orderkey", S.stars(F.col("o_totalprice") / 1000000).alias("mark"), S.parenthesised(F.col("o_totalprice"), 2).alias("shown"))


_JOBS = """SELECT l_quantity AS vacancy, l_linenumber::INTEGER AS minExperience, (l_linenumber + 2)::INTEGER AS maxExperience, l_extendedprice AS avgSalary,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS jobAgreementType, quarter(l_shipdate)::INTEGER AS sector,
    (l_linenumber + CASE l_linestatus WHEN 'O' THEN 2 ELSE 0 END)::INTEGER AS minEducationBranch FROM lineitem"""


def _job_sql() -> str:
    from quadrat.plans.descriptives import CATEGORIES, JOB_LABELS

    one = "SELECT '{s}' AS section, '{v}' AS variable, round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS sd, count({x}) AS n FROM j"
    parts = [one.format(s="", v=v, x=v) for v in JOB_LABELS]
    parts += [one.format(s=s, v=v, x=f"CASE WHEN {src} IS NOT NULL THEN ({src} BETWEEN {a} AND {b})::INTEGER END")
              for s, block in CATEGORIES.items() for v, (src, a, b) in block.items()]
    return f"WITH j AS ({_JOBS}) " + " UNION ALL ".join(parts)


def _job_rows(t: Tables):
    flag = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2)
    return t.lineitem.select(
        F.col("l_quantity").alias("vacancy"), F.col("l_linenumber").alias("minExperience"), (F.col("l_linenumber") + 2).alias("maxExperience"),
        F.col("l_extendedprice").alias("avgSalary"), flag.alias("jobAgreementType"), F.quarter("l_shipdate").alias("sector"),
        (F.col("l_linenumber") + F.when(F.col("l_linestatus") == "O", 2).otherwise(0)).alias("minEducationBranch"))


@query("job_summary_table", _job_sql())
def job_summary_table(t: Tables):
    """The descriptive table of postings: continuous variables, then blocks of indicators listwise."""
    from quadrat.plans.descriptives import job_summary

    return _rounded(job_summary(_job_rows(t)))


def _job_lines_sql() -> str:
    from quadrat.plans.descriptives import CATEGORIES, JOB_LABELS

    label = "CASE variable " + " ".join(f"WHEN '{v}' THEN '{text}'" for v, text in JOB_LABELS.items()) + " ELSE variable END"
    heads = [f"SELECT '\\textbf{{\\textit{{{section}:}}}} &  &  &  \\\\' AS line" for section in CATEGORIES]
    return (f"SELECT {label} || ' & ' || format('{{:,.3f}}', mean) || ' & ' || format('{{:,.3f}}', sd) || ' & ' || format('{{:,}}', n) || ' \\\\' AS line "
            f"FROM ({_job_sql()}) UNION ALL " + " UNION ALL ".join(heads))


@query("job_summary_lines", _job_lines_sql())
def job_summary_lines(t: Tables):
    """The same table typeset, with a line before each block."""
    from quadrat.plans.descriptives import job_summary_lines as lines

    return lines(_job_rows(t))
