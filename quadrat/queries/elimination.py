"""SQL text for regressions: elimination over summed products, clustered errors and p values."""

from __future__ import annotations

from collections.abc import Sequence


def p_value(t: str, df: str) -> str:
    """Two-sided p value of a t statistic with whole degrees of freedom, as a finite sum."""
    angle, c2 = f"atan(abs({t}) / sqrt({df}))", f"({df} / ({df} + {t} * {t}))"
    even = f"list_sum([exp(lgamma(q + 0.5) - lgamma(q + 1.0) + q * ln({c2})) / sqrt(pi()) FOR q IN range(0, ({df} // 2)::BIGINT)])"
    odd = f"coalesce(list_sum([exp(lgamma(q + 1.0) - lgamma(q + 1.5) + q * ln({c2})) * sqrt(pi()) / 2 FOR q IN range(0, (({df} - 1) // 2)::BIGINT)]), 0)"
    return (f"(CASE WHEN {df} % 2 = 0 THEN 1 - sin({angle}) * {even} "
            f"ELSE 1 - 2 / pi() * ({angle} + sin({angle}) * cos({angle}) * {odd}) END)")


def clustered(terms: Sequence[str]) -> str:
    """Tables that end in ``est`` (m, term, b, se, t, df, n, clusters) from a table ``d``.

    ``d`` has one row per observation: model ``m``, cluster ``g``, weight ``w``, degrees of
    freedom of the absorbed keys ``dfa``, and ``y, x1 .. xk`` without the absorbed effects.
    The matrix of products is inverted one column at a time; a column that the earlier ones
    explain is passed over.
    """
    k = len(terms)
    value = [*[f"x{i}" for i in range(1, k + 1)], "y"]
    cells = [(i, j) for i in range(k + 1) for j in range(k + 1)]
    sums = ", ".join(f"sum(w * {value[i]} * {value[j]})" for i, j in cells)
    residual = "y" + "".join(f" - b{i} * x{i}" for i in range(1, k + 1))
    return f"""
    products AS (SELECT m, [{sums}] AS l FROM d GROUP BY m),
    gram AS (SELECT m, unnest({[i + 1 for i, _ in cells]}) AS i, unnest({[j + 1 for _, j in cells]}) AS j, unnest(l) AS v FROM products),
    swept AS (
        SELECT 0 AS k, g.m, g.i, g.j, g.v, x.v AS own, []::INTEGER[] AS kept FROM gram g JOIN gram x ON x.m = g.m AND x.i = g.i AND x.j = g.i
        UNION ALL
        SELECT k + 1, m, i, j, CASE WHEN NOT good THEN v WHEN i = k + 1 AND j = k + 1 THEN 1 / p WHEN j = k + 1 THEN -c / p
                                    WHEN i = k + 1 THEN r / p ELSE v - c * r / p END, own, CASE WHEN good THEN list_append(kept, k + 1) ELSE kept END
        FROM (SELECT *, p > 1e-9 * o AS good FROM
            (SELECT *, max(CASE WHEN i = k + 1 AND j = k + 1 THEN v END) OVER (PARTITION BY m) AS p, max(CASE WHEN i = k + 1 THEN own END) OVER (PARTITION BY m) AS o,
                    max(CASE WHEN j = k + 1 THEN v END) OVER (PARTITION BY m, i) AS c, max(CASE WHEN i = k + 1 THEN v END) OVER (PARTITION BY m, j) AS r
             FROM swept WHERE k < {k}))),
    solved AS (SELECT m, i, j, v, len(kept) AS used FROM swept WHERE k = {k} AND i <= {k} AND list_contains(kept, i) AND (j = {k + 1} OR list_contains(kept, j))),
    slopes AS (SELECT m, {", ".join(f"coalesce(max(v) FILTER (i = {i}), 0) AS b{i}" for i in range(1, k + 1))} FROM solved WHERE j = {k + 1} GROUP BY m),
    scores AS (SELECT m, g, [{", ".join(f"sum(w * x{i} * ({residual}))" for i in range(1, k + 1))}] AS l FROM d JOIN slopes USING (m) GROUP BY m, g),
    score AS (SELECT m, g, unnest(range(1, {k + 1})) AS j, unnest(l) AS s FROM scores),
    pull AS (SELECT m, i, g, sum(v * s) AS h FROM solved JOIN score USING (m, j) GROUP BY m, i, g),
    spread AS (SELECT m, i, sum(h * h) AS v FROM pull GROUP BY m, i),
    sizes AS (SELECT m, count(*) AS n, count(DISTINCT g) AS clusters, max(dfa) AS dfa FROM d GROUP BY m),
    est AS (SELECT *, b / se AS t FROM
        (SELECT m, {list(terms)}[i] AS term, s.v AS b, sqrt((clusters / (clusters - 1.0)) * ((n - 1.0) / (n - used - dfa)) * spread.v) AS se, clusters - 1 AS df, n, clusters
         FROM solved s JOIN spread USING (m, i) JOIN sizes USING (m) WHERE j = {k + 1}))"""
