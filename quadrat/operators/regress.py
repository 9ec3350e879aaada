"""Weighted least squares with absorbed fixed effects and clustered errors.

However many iterations are needed, the rows are read twice: for the overall means, and
to collapse them to cells (one per combination of the absorbed keys and the cluster) with
the sums of every column and of the products of every two.  The effects, and the products
of what they leave, come from the cells, and the models of a ladder share those of all
their keys.  With more than ``CELL_VALUES`` columns, or errors that are robust without
clusters, each model reads the rows a third time to subtract the effects, and writes them
once.  Only sums of products leave the executors; the k x k algebra happens on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadrat.functions import stats
from quadrat.functions.keys import label_of, levels, value_label_of
from quadrat.operators.graph import components
from quadrat.session import Scratch, cut_lineage

CELL_VALUES = 8  # columns whose products the cells carry
FEW_LEVELS = 64  # of all keys but the one with the most: their effects are solved for at once

# --- design -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Factor:
    """Categorical regressor; ``base`` is the omitted level (the lowest by default)."""

    name: str
    base: object = None


@dataclass(frozen=True)
class Cross:
    """Interaction of factors; ``full`` adds the main effects."""

    parts: tuple[Factor, ...]
    full: bool = True


Term = str | Factor | Cross


def _levels(df: DataFrame, f: Factor) -> tuple[list, object]:
    found = levels(df, f.name)
    return found, (found[0] if f.base is None else f.base)


def design(df: DataFrame, terms: Sequence[Term]) -> dict[str, Column]:
    """Ordered regressor expressions; a repeated regressor is kept once."""
    out: dict[str, Column] = {}
    cache: dict[Factor, tuple[list, object]] = {}

    def of(f: Factor):
        if f not in cache:
            cache[f] = _levels(df, f)
        return cache[f]

    def indicator(f: Factor, level) -> Column:
        return F.when(F.col(f.name).isNotNull(), (F.col(f.name) == F.lit(level)).cast("double"))

    def add_factor(f: Factor):
        found, base = of(f)
        for level in found:
            if level != base:
                out.setdefault(f"{level}.{f.name}", indicator(f, level))

    for term in terms:
        if isinstance(term, str):
            out.setdefault(term, F.col(term).cast("double"))
        elif isinstance(term, Factor):
            add_factor(term)
        else:
            if term.full:
                for f in term.parts:
                    add_factor(f)
            choices = [[(f, lv) for lv in of(f)[0] if lv != of(f)[1]] for f in term.parts]
            for combo in product(*choices):
                name = "#".join(f"{lv}.{f.name}" for f, lv in combo)
                out.setdefault(name, reduce(lambda a, b: a * b, [indicator(f, lv) for f, lv in combo]))
    return out


# --- results ----------------------------------------------------------------------------


@dataclass
class Fit:
    """Estimates of one model; ``sample`` holds the rows that were used."""

    depvar: str
    terms: list[str]
    omitted: list[str]
    b: np.ndarray
    vcov: np.ndarray
    n: int
    r2: float
    r2_within: float
    f: float | None
    ymean: float
    df_model: int
    df_resid: int
    clusters: int | None
    absorbed: int
    sample: DataFrame = field(repr=False)
    model: str = ""
    steps: int = 0  # iterations of the fixed effects
    levels: tuple[tuple[tuple[str, ...], DataFrame], ...] = field(default=(), repr=False)  # absorbed keys and their levels in the sample

    def rows(self) -> list[tuple]:
        out = []
        for i, term in enumerate(self.terms):
            se = float(np.sqrt(max(self.vcov[i, i], 0.0)))
            t = float(self.b[i] / se) if se else None
            out.append((self.model, term, float(self.b[i]), se, t, stats.t_two_sided(t, self.df_resid)))
        return out

    def stat_row(self) -> tuple:
        return (
            self.model, self.depvar, self.n, float(self.ymean), float(self.r2), float(self.r2_within),
            None if self.f is None else float(self.f), self.clusters, self.df_model, self.df_resid,
        )


COEFFICIENT_SCHEMA = "model string, term string, b double, se double, t double, p double"
STATISTIC_SCHEMA = (
    "model string, depvar string, n bigint, ymean double, r2 double, r2_within double, f double, "
    "clusters bigint, df_model int, df_resid bigint"
)


def coefficients(fits: Sequence[Fit]) -> DataFrame:
    spark = fits[0].sample.sparkSession
    return spark.createDataFrame([r for f in fits for r in f.rows()], COEFFICIENT_SCHEMA)


def fit_statistics(fits: Sequence[Fit]) -> DataFrame:
    spark = fits[0].sample.sparkSession
    return spark.createDataFrame([f.stat_row() for f in fits], STATISTIC_SCHEMA)


# --- sample -----------------------------------------------------------------------------


def _effective_keys(absorb: Sequence[Sequence[str]]) -> list[tuple[str, ...]]:
    """Absorbed keys that are not coarser versions of another absorbed key."""
    keys = list(dict.fromkeys(tuple(dict.fromkeys(k)) for k in absorb))
    return [k for k in keys if not any(set(k) < set(o) or (set(k) == set(o) and o != k and keys.index(o) < keys.index(k)) for o in keys)]


def _prune_singletons(cells: DataFrame, keys: Sequence[tuple[str, ...]]) -> DataFrame:
    """Drop cells whose level of some absorbed key has one row, until none is left."""
    while True:
        found = False
        kept = cells
        for k in keys:
            single = cells.groupBy(*k).agg(F.sum("__n").alias("__size")).filter("__size = 1").select(*k)
            if single.limit(1).count():
                found = True
                kept = kept.join(single, list(k), "left_anti")
        if not found:
            return cells
        cells = cut_lineage(kept)


def _components(cells: DataFrame, a: tuple[str, ...], b: tuple[str, ...]) -> int:
    """Connected components of the graph that links levels of two absorbed keys."""
    def node(side: str, k: tuple[str, ...]) -> Column:
        return F.to_json(F.struct(F.lit(side).alias("side"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(k)]))

    found, _ = components(cells.select(node("a", a).alias("u"), node("b", b).alias("v")))
    return found.filter("node = root").count()


def _nested_in(cells: DataFrame, key: tuple[str, ...], cluster: str | None) -> bool:
    """Every level of the key lies in one cluster."""
    if cluster is None:
        return False
    if cluster in key:
        return True
    split = cells.groupBy(*key).agg((F.min("__cmin") != F.max("__cmax")).alias("s")).filter("s")
    return split.limit(1).count() == 0


def _absorbed_df(cells: DataFrame, keys: Sequence[tuple[str, ...]], cluster: str | None) -> tuple[int, int]:
    """Degrees of freedom taken by the absorbed keys, and 1 if some are nested in the cluster."""
    used, nested, counted = 0, 0, []
    for k in keys:
        if _nested_in(cells, k, cluster):
            nested = 1
            continue
        n_levels = cells.select(*k).distinct().count()
        redundant = max([_components(cells, o, k) for o in counted], default=0)
        used += n_levels - redundant
        counted.append(k)
    return used, nested


# --- within transformation --------------------------------------------------------------


def _level_means(cells: DataFrame, key: tuple[str, ...], residual: Mapping[str, Column], name: str) -> DataFrame:
    """Weighted mean of the residual cell means per level of ``key``."""
    return cells.groupBy(*key).agg(*[
        F.try_divide(F.sum(F.col("__w") * r), F.sum("__w")).alias(f"{name}_{c}") for c, r in residual.items()
    ])


def _with_effects(rows: DataFrame, keys: Sequence[tuple[str, ...]], effects: Sequence[DataFrame], names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Attach the level effects ``name_c`` of every key as ``name<j>_c``."""
    for j, (k, table) in enumerate(zip(keys, effects)):
        rows = rows.join(
            table.select(*k, *[F.col(f"{n}_{c}").alias(f"{n}{j}_{c}") for n in names for c in columns]), list(k))
    return rows


def _solve_few(
    scratch: Scratch, placed: DataFrame, state: DataFrame, n_keys: int, columns: Sequence[str], scale: Mapping[str, float], tol: float,
) -> DataFrame | None:
    """``k, level, v_c`` without iterations, or None if several keys have many levels.

    Less the means by the levels of the largest key, the indicators of the few other levels
    have a small matrix of products, which is solved on the driver.
    """
    sizes = {r["k"]: r["count"] for r in state.groupBy("k").count().collect()}
    if len(sizes) < n_keys or sum(sizes.values()) - max(sizes.values()) > FEW_LEVELS:
        return None
    big = max(sizes, key=lambda k: (sizes[k], -k))
    few = [(r["k"], tuple(r["level"])) for r in state.filter(F.col("k") != big).select("k", "level").collect()]
    place = {at: j for j, at in enumerate(few)}
    others = [k for k in range(n_keys) if k != big]

    # products of the indicators with each other and with the columns, from the few combinations of their levels
    products, right = np.zeros((len(few), len(few))), np.zeros((len(few), len(columns)))
    combined = placed.groupBy(*[f"l{k}" for k in others]).agg(F.sum("__w").alias("w"), *[F.sum(F.col("__w") * F.col(f"m_{c}")).alias(f"r_{c}") for c in columns])
    for r in combined.collect():
        at = [place[k, tuple(r[f"l{k}"])] for k in others]
        products[np.ix_(at, at)] += r["w"]
        right[at] += [r[f"r_{c}"] for c in columns]
    weights = np.diag(products)

    def of(j: int) -> Column:
        k, level = few[j]
        return F.sum(F.when(F.col(f"l{k}") == F.array(*map(F.lit, level)), F.col("__w")).otherwise(0.0))

    n, r = [f"n{j}" for j in range(len(few))], [f"r_{c}" for c in columns]
    wide = scratch.cut(placed.groupBy(F.col(f"l{big}").alias("level")).agg(
        F.sum("__w").alias("d"), *[of(j).alias(n[j]) for j in range(len(few))], *[F.sum(F.col("__w") * F.col(f"m_{c}")).alias(f"r_{c}") for c in columns]))
    means = _products(wide, [*n, *r], 1 / F.col("d"))
    matrix, right = products - means[:len(few), :len(few)], right - means[:len(few), len(few):]
    root = 1 / np.sqrt(weights)
    values, vectors = np.linalg.eigh(matrix * np.outer(root, root))
    turned = vectors[:, values > 1e-12]  # one effect of each component is free
    solved = root[:, None] * (turned @ ((turned.T @ (root[:, None] * right)) / values[values > 1e-12][:, None]))
    left = np.abs(right - matrix @ solved).max(axis=0, initial=0.0, where=np.isfinite(right)) / weights.min()
    if not np.isfinite(solved).all() or any(v >= tol * scale[c] for v, c in zip(left, columns)):
        return None
    own = {c: reduce(lambda a, b: a - b, [F.col(n[j]) * F.lit(float(solved[j, i])) for j in range(len(few))], F.col(f"r_{c}")) / F.col("d") for i, c in enumerate(columns)}
    shape = f"k int, level array<string>, {', '.join(f'v_{c} double' for c in columns)}"
    small = placed.sparkSession.createDataFrame([(k, list(level), *map(float, solved[j])) for j, (k, level) in enumerate(few)], shape)
    return wide.select(F.lit(big).alias("k"), "level", *[e.alias(f"v_{c}") for c, e in own.items()]).unionByName(small)


def _solve_effects(
    cells: DataFrame, keys: Sequence[tuple[str, ...]], columns: Sequence[str], scale: Mapping[str, float],
    tol: float, max_steps: int,
) -> tuple[list[DataFrame], int]:
    """One table per key with the effects ``v_c`` whose sum is the projection of each column, and the steps taken.

    If all keys but one have ``FEW_LEVELS`` levels together at most, the effects of that one are
    eliminated and the others solved for at once. Else the normal equations of the level effects
    are solved by conjugate gradients, preconditioned with the level weights, for all columns at
    once. A step joins each cell
    with the directions of its levels and adds the products up by level, all keys in one
    shuffle; it writes one table with a row per level, and the table of the step before is
    removed. It ends when no level's mean of what is left over exceeds ``tol`` times the
    column's spread.
    """
    means = {c: F.col(f"m_{c}") for c in columns}
    if len(keys) == 1:
        return [cut_lineage(_level_means(cells, keys[0], means, "v"))], 0

    def level(k: tuple[str, ...]) -> Column:
        return F.array(*[F.col(c).cast("string") for c in k])

    def by_level(rows: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
        levels_ = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"l{i}").alias("level")) for i in range(len(keys))]))
        spread = rows.select(levels_.alias("at"), *[e.alias(n) for n, e in sums.items()])
        return spread.groupBy(F.col("at.k").alias("k"), F.col("at.level").alias("level")).agg(*[F.sum(n).alias(n) for n in sums])

    scratch = Scratch(cells.sparkSession)
    placed = scratch.cut(cells.select(*[level(k).alias(f"l{i}") for i, k in enumerate(keys)], "__w", *means.values()))
    start = by_level(placed, {"d": F.col("__w"), **{f"r_{c}": F.col("__w") * m for c, m in means.items()}})
    state = scratch.cut(start.filter("d > 0").withColumns({**{f"x_{c}": F.lit(0.0) for c in columns}, **{f"p_{c}": F.col(f"r_{c}") / F.col("d") for c in columns}}))

    def tables(found: DataFrame) -> list[DataFrame]:
        return [cut_lineage(
            cells.select(*k).distinct().withColumn("level", level(k)).join(found.filter(F.col("k") == i).drop("k"), "level").drop("level"))
            for i, k in enumerate(keys)]

    at_once = _solve_few(scratch, placed, state, len(keys), columns, scale, tol)
    if at_once is not None:
        effects = tables(at_once)
        scratch.drop()
        return effects, 1
    size = state.agg(*[F.sum(F.col(f"r_{c}") * F.col(f"r_{c}") / F.col("d")).alias(c) for c in columns]).first()
    energy = {c: size[c] or 0.0 for c in columns}
    largest = float("inf")
    for steps in range(1, max_steps + 1):
        rows = placed
        for i in range(len(keys)):
            rows = rows.join(state.filter(F.col("k") == i).select(F.col("level").alias(f"l{i}"), *[F.col(f"p_{c}").alias(f"p{i}_{c}") for c in columns]), f"l{i}")
        total = {c: reduce(lambda a, b: a + b, [F.col(f"p{i}_{c}") for i in range(len(keys))]) for c in columns}
        turned = by_level(rows, {f"q_{c}": F.col("__w") * e for c, e in total.items()})
        met = scratch.cut(state.join(turned, ["k", "level"]))
        scratch.drop(keep=(placed, met))
        along = met.agg(*[F.sum(F.col(f"p_{c}") * F.col(f"q_{c}")).alias(c) for c in columns]).first()
        alpha = {c: energy[c] / along[c] if along[c] and along[c] > 0 else 0.0 for c in columns}
        x = {c: F.col(f"x_{c}") + F.lit(alpha[c]) * F.col(f"p_{c}") for c in columns}
        r = {c: F.col(f"r_{c}") - F.lit(alpha[c]) * F.col(f"q_{c}") for c in columns}
        seen = met.agg(
            *[F.sum(r[c] * r[c] / F.col("d")).alias(f"e_{c}") for c in columns], *[F.max(F.abs(r[c]) / F.col("d")).alias(f"m_{c}") for c in columns]).first()
        largest = max((seen[f"m_{c}"] or 0.0) / scale[c] for c in columns)
        if largest < tol:
            effects = tables(met.select("k", "level", *[x[c].alias(f"v_{c}") for c in columns]))
            scratch.drop()
            return effects, steps
        beta = {c: seen[f"e_{c}"] / energy[c] if energy[c] else 0.0 for c in columns}
        energy = {c: seen[f"e_{c}"] for c in columns}
        state = met.select("k", "level", "d", *[x[c].alias(f"x_{c}") for c in columns], *[r[c].alias(f"r_{c}") for c in columns],
                           *[(r[c] / F.col("d") + F.lit(beta[c]) * F.col(f"p_{c}")).alias(f"p_{c}") for c in columns])
    raise ArithmeticError(f"fixed effects did not converge in {max_steps} steps (last mean left over {largest:.3g})")


# --- products ---------------------------------------------------------------------------


def _products(frame: DataFrame, columns: Sequence[str], weight: Column) -> np.ndarray:
    """Sums over the rows of ``weight`` times the product of every two columns, as a matrix.

    A task multiplies its Arrow batches into one block, whose entries are then added up
    by place: one aggregation column, however many terms there are.
    """
    k = len(columns)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            x = np.column_stack(x)
            total += x.T @ (x * w[:, None])
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype("int32")), pa.array(j.astype("int32")), pa.array(total[i, j])], ["i", "j", "v"])

    placed = frame.select(weight.alias("__by"), *columns).mapInArrow(blocks, "i int, j int, v double")
    found = placed.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((k, k))
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v
    return out


# --- estimator --------------------------------------------------------------------------


@dataclass(frozen=True)
class _Rows:
    """The rows of one or several models and what these share."""

    df: DataFrame
    y: str
    weight: str | None
    cluster: str | None
    x: dict[str, Column]
    sums: DataFrame | None  # by all keys and the cluster; None if the products come from the rows
    shift: Mapping[str, float]

    @property
    def values(self) -> list[str]:
        return ["y", *[f"x{i}" for i in range(len(self.x))]]

    @property
    def w(self) -> Column:
        return F.lit(1.0) if self.weight is None else F.col(self.weight).cast("double")

    def carried(self, keys: Sequence[tuple[str, ...]]) -> list[str]:
        """Columns of the keys, and the cluster."""
        return list(dict.fromkeys([*[c for k in keys for c in k], *([self.cluster] if self.cluster else [])]))

    def complete(self, carried: Sequence[str]) -> DataFrame:
        needed = F.lit(True)
        for c in [F.col(self.y), self.w, *self.x.values(), *[F.col(c) for c in carried]]:
            needed = needed & c.isNotNull()
        return self.df.filter(needed & (self.w > 0)) if self.weight is not None else self.df.filter(needed)

    def of(self, frame: DataFrame, carried: Sequence[str]) -> DataFrame:
        return frame.select(*carried, self.w.alias("__w"), F.col(self.y).cast("double").alias("y"), *[e.alias(n) for n, e in zip(self.values[1:], self.x.values())])

    def overall(self, carried: Sequence[str]) -> Mapping[str, float]:
        # shift by overall means: the cell means stay small and the products well scaled
        return self.of(self.complete(carried), carried).agg(
            *[F.avg(c).alias(c) for c in self.values], *[F.stddev_pop(c).alias(f"s_{c}") for c in self.values]).first().asDict()

    def centred(self, carried: Sequence[str], missing: Sequence[str] = (), shift: Mapping[str, float] | None = None) -> DataFrame:
        """The rows less ``shift``; columns of ``missing`` may be null."""
        shift = self.shift if shift is None else shift
        needed = [c for c in carried if c not in missing]
        return self.of(self.complete(needed), carried).withColumns({c: F.col(c) - F.lit(shift[c] or 0.0) for c in self.values})


def _pairs(values: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(values) for b in values[i:]]


def _gathered(df: DataFrame, y: str, terms: Sequence[Term], absorbs: Sequence[Sequence[Sequence[str] | str]], weight: str | None, cluster: str | None) -> _Rows:
    """What the models that absorb ``absorbs`` share: the design and, with few columns, the cells by all their keys."""
    data = _Rows(df, y, weight, cluster, design(df, terms), None, {})
    if len(data.values) > CELL_VALUES or (weight is not None and not cluster):
        return data
    of_models = [data.carried(_keys(absorb)) for absorb in absorbs]
    every = list(dict.fromkeys(c for carried in of_models for c in carried))
    shift = data.overall(every)
    missing = [c for c in every if any(c not in carried for carried in of_models)]  # a model without the column keeps its rows
    sums = data.centred(every, missing, shift).groupBy(*every).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("__w").alias("__w"), *[F.sum(F.col("__w") * F.col(c)).alias(f"__s_{c}") for c in data.values],
        *[F.sum(F.col("__w") * F.col(a) * F.col(b)).alias(f"__p_{a}_{b}") for a, b in _pairs(data.values)])
    return replace(data, sums=cut_lineage(sums), shift=shift)


def _keys(absorb: Sequence[Sequence[str] | str]) -> list[tuple[str, ...]]:
    return _effective_keys([(k,) if isinstance(k, str) else tuple(k) for k in absorb])


def _cells_of_sums(data: _Rows, carried: Sequence[str]) -> DataFrame:
    """The cells of one model from the shared ones."""
    added = [c for c in data.sums.columns if c.startswith("__")]
    cells = data.sums.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in carried], F.lit(True)))  # other models may keep these rows
    if set(cells.columns) - set(added) != set(carried):
        cells = cut_lineage(cells.groupBy(*carried).agg(*[F.sum(c).alias(c) for c in added]))
    return cells.select(
        "*", *[F.try_divide(f"__s_{c}", "__w").alias(f"m_{c}") for c in data.values], *[F.col(f"__p_{c}_{c}").alias(f"q_{c}") for c in data.values],
        *([F.col(data.cluster).alias("__cmin"), F.col(data.cluster).alias("__cmax")] if data.cluster else []))


def _moments(within: DataFrame, values: Sequence[str]) -> np.ndarray:
    """Sums of the cells' products as a matrix."""
    found = within.agg(*[F.sum(f"g_{a}_{b}").alias(f"g_{a}_{b}") for a, b in _pairs(values)]).first()
    at = {c: i for i, c in enumerate(values)}
    out = np.zeros((len(values), len(values)))
    for a, b in _pairs(values):
        out[at[a], at[b]] = out[at[b], at[a]] = found[f"g_{a}_{b}"] or 0.0
    return out


def absorb_regression(
    df: DataFrame, y: str, terms: Sequence[Term], absorb: Sequence[Sequence[str] | str],
    weight: str | None = None, cluster: str | None = None, tol: float = 1e-9, max_sweeps: int = 1000,
    model: str = "",
) -> Fit:
    """Regress ``y`` on ``terms`` with absorbed fixed effects.

    ``absorb`` lists columns, or column tuples for interacted effects.  Incomplete rows
    and singleton groups are dropped.  Errors are clustered on ``cluster``.
    """
    return _fitted(_gathered(df, y, terms, [absorb], weight, cluster), absorb, tol, max_sweeps, model)


def _fitted(data: _Rows, absorb: Sequence[Sequence[str] | str], tol: float = 1e-9, max_sweeps: int = 1000, model: str = "") -> Fit:
    y, x, weight, cluster, values = data.y, data.x, data.weight, data.cluster, data.values
    names = values[1:]
    keys = _keys(absorb)
    key_columns = list(dict.fromkeys(c for k in keys for c in k))
    carried = data.carried(keys)
    by_cell = data.sums is not None
    if by_cell:
        shift = data.shift
        cells = _cells_of_sums(data, carried)
    else:
        shift = data.overall(carried)
        centred = data.centred(carried, shift=shift)
        cells = cut_lineage(centred.groupBy(*key_columns).agg(
            F.count(F.lit(1)).alias("__n"), F.sum("__w").alias("__w"),
            *[F.try_divide(F.sum(F.col("__w") * F.col(c)), F.sum("__w")).alias(f"m_{c}") for c in values],
            *[F.sum(F.col("__w") * F.col(c) * F.col(c)).alias(f"q_{c}") for c in values],
            *([F.min(cluster).alias("__cmin"), F.max(cluster).alias("__cmax")] if cluster else []),
        ))
    scale = {c: shift[f"s_{c}"] or 1.0 for c in values}
    cells = _prune_singletons(cells, keys)
    effects, steps = _solve_effects(cells, keys, values, scale, tol, max_sweeps)
    # rows or cells of dropped singletons have no level here and leave with the inner joins
    within = _with_effects(cells if by_cell else centred, keys, effects, "v", values)
    residual = {c: reduce(lambda x, j: x - F.col(f"v{j}_{c}"), range(len(keys)), F.col(f"m_{c}" if by_cell else c)) for c in values}
    if by_cell:  # products within a cell, and of what the effects leave of its means
        left_over = {f"g_{a}_{b}": F.col(f"__p_{a}_{b}") + F.col("__w") * (residual[a] * residual[b] - F.col(f"m_{a}") * F.col(f"m_{b}")) for a, b in _pairs(values)}
    else:
        left_over = {"__w": F.col("__w"), **residual}
    within = cut_lineage(within.select(*([cluster] if cluster else []), *[e.alias(c) for c, e in left_over.items()]))

    totals = cells.agg(
        F.sum("__n").alias("n"), F.sum("__w").alias("w"), F.sum(F.col("__w") * F.col("m_y")).alias("wy"), *[F.sum(f"q_{c}").alias(f"q_{c}") for c in values]).first()
    n = totals["n"]
    if not n:
        raise ValueError("no observations left")
    moments = _moments(within, values) if by_cell else _products(within, values, F.col("__w"))
    gram, cross = moments[1:, 1:], moments[0, 1:]
    kept = _independent(gram, np.array([totals[f"q_{a}"] for a in names]))
    inverse = np.linalg.inv(gram[np.ix_(kept, kept)]) if kept else np.zeros((0, 0))
    b = inverse @ cross[kept]

    yy = moments[0, 0]
    rss = yy - 2 * b @ cross[kept] + b @ gram[np.ix_(kept, kept)] @ b
    tss = totals["q_y"] - totals["wy"] ** 2 / totals["w"]
    absorbed, nested = _absorbed_df(cells, keys, cluster)
    k = len(kept)
    if cluster:
        scores, m = (_cell_scores if by_cell else _scores)(within, cluster, names, kept, b)
        meat = _products(scores, scores.columns, F.lit(1.0)) if k else np.zeros((0, 0))
        small = (m / (m - 1)) * ((n - 1) / (n - k - absorbed - nested)) if m > 1 else float("nan")
        vcov, df_resid = small * inverse @ meat @ inverse, min(m - 1, n - k - absorbed)
    else:
        m, df_resid = None, n - k - absorbed
        vcov = inverse * (rss / df_resid if df_resid > 0 else np.nan)
        if weight is not None and k:
            vcov = _robust(within, names, kept, b, inverse, n, df_resid)
    wald = None
    if k:
        try:
            wald = float(b @ np.linalg.solve(vcov, b) / k)
        except np.linalg.LinAlgError:
            wald = None
    labels = list(x)
    sample = reduce(lambda d, e: d.join(e[1].select(*e[0]), list(e[0]), "left_semi"), zip(keys, effects), data.complete(carried))
    return Fit(
        depvar=y, terms=[labels[i] for i in kept], omitted=[labels[i] for i in range(len(names)) if i not in kept],
        b=b, vcov=vcov, n=n, r2=1 - rss / tss if tss else float("nan"), r2_within=1 - rss / yy if yy else float("nan"),
        f=wald, ymean=totals["wy"] / totals["w"] + (shift["y"] or 0.0), df_model=k, df_resid=int(df_resid), clusters=m, absorbed=absorbed,
        sample=sample, model=model, steps=steps, levels=tuple((k, e.select(*k)) for k, e in zip(keys, effects)),
    )


def _left_over(names: Sequence[str], kept: Sequence[int], b: np.ndarray) -> Column:
    """What the estimates leave of ``y``."""
    parts = [F.col("y"), *[F.col(names[i]) * F.lit(-float(c)) for i, c in zip(kept, b)]]
    while len(parts) > 1:  # added up in pairs, so that the expression stays shallow
        parts = [reduce(lambda p, q: p + q, parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def _scores(within: DataFrame, cluster: str, names: Sequence[str], kept: Sequence[int], b: np.ndarray) -> tuple[DataFrame, int]:
    """One row of weighted residual sums per cluster, and the number of clusters."""
    left = within.withColumn("__u", F.col("__w") * _left_over(names, kept, b))
    found = cut_lineage(left.groupBy(cluster).agg(*[F.sum(F.col(names[i]) * F.col("__u")).alias(f"s{i}") for i in kept], F.lit(1).alias("one")))
    return found.select(*[f"s{i}" for i in kept]), found.count()


def _cell_scores(within: DataFrame, cluster: str, names: Sequence[str], kept: Sequence[int], b: np.ndarray) -> tuple[DataFrame, int]:
    """``_scores`` from the products of the cells."""
    def score(i: int) -> Column:
        parts = [F.col(f"g_y_{names[i]}"), *[F.col(f"g_{names[min(i, j)]}_{names[max(i, j)]}") * F.lit(-float(c)) for j, c in zip(kept, b)]]
        return reduce(lambda p, q: p + q, parts)

    found = cut_lineage(within.groupBy(cluster).agg(*[F.sum(score(i)).alias(f"s{i}") for i in kept], F.lit(1).alias("one")))
    return found.select(*[f"s{i}" for i in kept]), found.count()


def _robust(within: DataFrame, names: Sequence[str], kept: Sequence[int], b: np.ndarray, inverse: np.ndarray, n: int, df_resid: int) -> np.ndarray:
    """Heteroskedasticity-robust covariance for weighted models without clusters."""
    scored = within.withColumn("__u", F.col("__w") * _left_over(names, kept, b))
    meat = _products(scored, [names[i] for i in kept], F.col("__u") * F.col("__u"))
    return (n / df_resid) * inverse @ meat @ inverse


def _independent(gram: np.ndarray, raw: np.ndarray, tol: float = 1e-9) -> list[int]:
    """Columns kept in order; one that the absorbed effects or earlier columns explain is dropped."""
    kept: list[int] = []
    for i in range(len(raw)):
        if raw[i] <= 0 or gram[i, i] <= tol * raw[i]:
            continue
        rest = gram[i, i]
        if kept:
            g = gram[np.ix_(kept, kept)]
            rest = rest - gram[i, kept] @ np.linalg.solve(g, gram[kept, i])
        if rest > tol * gram[i, i]:
            kept.append(i)
    return kept


def ladder(
    df: DataFrame, y: str, terms: Sequence[Term], specs: Mapping[str, Sequence[Sequence[str] | str]],
    weight: str | None = None, cluster: str | None = None, **options,
) -> dict[str, Fit]:
    """The same regression under a list of absorbed-effect specifications."""
    data = _gathered(df, y, terms, list(specs.values()), weight, cluster)
    return {name: _fitted(data, absorb, model=name, **options) for name, absorb in specs.items()}


def ladder_on_common_sample(
    df: DataFrame, y: str, terms: Sequence[Term], specs: Mapping[str, Sequence[Sequence[str] | str]],
    weight: str | None = None, cluster: str | None = None, **options,
) -> tuple[dict[str, Fit], dict[str, Fit]]:
    """The ladder on all rows, and again on the sample of its last model."""
    data = _gathered(df, y, terms, list(specs.values()), weight, cluster)
    full = {name: _fitted(data, absorb, model=name, **options) for name, absorb in specs.items()}
    last = list(full.values())[-1]
    shared = _part(data, last, terms)
    if shared is None:
        return full, ladder(cut_lineage(last.sample), y, terms, specs, weight, cluster, **options)
    return full, {name: _fitted(shared, absorb, model=name, **options) for name, absorb in specs.items()}


def _part(data: _Rows, last: Fit, terms: Sequence[Term]) -> _Rows | None:
    """The cells in the sample of a model, or None if there are none or a factor has other levels there, and so another design."""
    if data.sums is None:
        return None
    factors = {f for t in terms if not isinstance(t, str) for f in (t.parts if isinstance(t, Cross) else (t,))}
    if any(levels(last.sample, f.name) != levels(data.df, f.name) for f in factors):
        return None
    known = data.sums.filter(F.col(data.cluster).isNotNull()) if data.cluster else data.sums
    sums = cut_lineage(reduce(lambda d, e: d.join(e[1], list(e[0]), "left_semi"), last.levels, known))
    mean = {c: F.try_divide(F.sum(f"__s_{c}"), F.sum("__w")) for c in data.values}
    spread = sums.agg(*[F.sqrt(F.greatest(F.try_divide(F.sum(f"__p_{c}_{c}"), F.sum("__w")) - mean[c] * mean[c], F.lit(0.0))).alias(f"s_{c}") for c in data.values]).first()
    return replace(data, df=last.sample, sums=sums, shift={**data.shift, **spread.asDict()})


# Statistics at the foot of a table: label and cell (labels are fixed values)
_FOOT = {
    "ymean": ("Mean of dependent variable", lambda: stats.fixed(F.col("ymean"))),
    "r2": ("R-Squared", lambda: stats.fixed(F.col("r2"))),
    "f": ("F", lambda: stats.fixed(F.col("f"))),
    "n": ("Observations", lambda: stats.fixed_comma(F.col("n"), 0)),
}


def term_label(df: DataFrame, term: str) -> str:
    """Display text of a term from the labels of its columns: a level shows its value label."""
    def part(name: str) -> str:
        level, dot, column = name.partition(".")
        if name in df.columns or not dot or column not in df.columns:
            return label_of(df, name) if name in df.columns else name
        return value_label_of(df, column, level) or f"{label_of(df, column)}={level}"

    return r" $\times$ ".join(part(p) for p in term.split("#"))


def regression_lines(
    fits: Sequence[Fit], keep: Sequence[str] | None = None, labels: Mapping[str, str] | None = None,
    headings: Mapping[str, str] | None = None, statistics: Sequence[str] = ("ymean", "r2", "n"),
    effects: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Typeset body rows: starred coefficients, standard errors below, then statistics and effects.

    A term shows the text of ``labels`` or the label of its column.  ``headings`` puts a line
    before a term, ``effects`` lists the models that absorb an effect, for a Yes/No line each.
    """
    spark = fits[0].sample.sparkSession
    order = list(dict.fromkeys(t for f in fits for t in f.terms if keep is None or t in keep))
    shown = {t: term_label(f.sample, t) for f in reversed(fits) for t in f.terms} | dict(labels or {})
    models = [f.model for f in fits]
    cells = coefficients(fits)
    place = spark.createDataFrame([(t, i, shown[t]) for i, t in enumerate(order)], "term string, pos int, shown string")
    cells = cells.join(place, "term").select(
        "pos", "model", "shown", stats.starred(F.col("b"), F.col("p")).alias("b"), stats.parenthesised(F.col("se")).alias("se")
    )
    blank = F.lit("")

    def laid_out(value: str, label: Column, sub: int) -> DataFrame:
        wide = cells.groupBy("pos", "shown").pivot("model", models).agg(F.first(value))
        body = [F.coalesce(F.col(f"`{m}`"), blank) for m in models]
        return wide.select((F.col("pos") * 3 + sub).alias("pos"), stats.table_line(label, *body).alias("line"))

    def fixed_line(label: str, body: Sequence[str]) -> str:
        return " & ".join([label, *body]) + r" \\"

    given = [(order.index(t) * 3, fixed_line(text, [""] * len(fits))) for t, text in (headings or {}).items() if t in order]
    given += [(2_000_000 + i, fixed_line(text, ["Yes" if m in of else "No" for m in models])) for i, (text, of) in enumerate((effects or {}).items())]
    foot = fit_statistics(fits)
    foot = foot.select("model", F.inline(F.array(*[
        F.struct(F.lit(1_000_000 + i).alias("pos"), F.lit(_FOOT[name][0]).alias("label"), _FOOT[name][1]().alias("cell"))
        for i, name in enumerate(statistics)
    ])))
    foot = foot.groupBy("pos", "label").pivot("model", models).agg(F.first("cell")).select(
        "pos", stats.table_line(F.col("label"), *[F.coalesce(F.col(f"`{m}`"), blank) for m in models]).alias("line"))
    body = laid_out("b", F.col("shown"), 1).unionByName(laid_out("se", blank, 2)).unionByName(foot)
    return body.unionByName(spark.createDataFrame(given, "pos int, line string")).orderBy("pos").select("line")
