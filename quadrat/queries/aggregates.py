"""Group statistics, shares, composition, reshaping."""

from pyspark.sql import functions as F

from quadrat.functions import missing as M
from quadrat.operators import groups as G, merge as J, quantiles as Q, reshape as R
from quadrat.queries.ordering import CUTS
from quadrat.queries.registry import Tables, query
from quadrat.session import cut_lineage


@query("group_total_mean_max", """
    WITH g AS (SELECT l_partkey, sum(l_quantity) AS total_qty, avg(l_quantity) AS mean_qty, max(l_extendedprice) AS max_price,
                      count(nullif(l_tax, 0)) AS taxed, count(*) AS rows, coalesce(sum(CASE WHEN l_quantity > 49 THEN l_quantity END), 0) AS big
               FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, total_qty, round(mean_qty, 6) AS mean_qty, max_price, taxed, rows, big
    FROM lineitem JOIN g USING (l_partkey)
""")
def group_total_mean_max(t: Tables):
    """Group statistics on every row."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_tax")
    out = G.spread(rows, ["l_partkey"], {
        "total_qty": F.sum("l_quantity"), "mean_qty": F.round(F.avg("l_quantity"), 6), "max_price": F.max("l_extendedprice"),
        "taxed": F.count(F.nullif("l_tax", F.lit(0.0))), "rows": F.count(F.lit(1)),
        "big": M.total(F.when(F.col("l_quantity") > 49, F.col("l_quantity"))),
    })
    return out.drop("l_quantity", "l_extendedprice", "l_tax")


def size_bins(t: Tables):
    """Customers binned by their order count: quintiles, then hard tiers."""
    size = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("size"))
    return Q.tiered_bins(cut_lineage(size), "size", 5, [(13, 6), (15, 7), (17, 8)], "bin")


@query("share_matrix_pivot", f"""
    WITH s AS (SELECT o_custkey, count(*) AS size FROM orders GROUP BY 1), src AS (SELECT size AS v FROM s), {CUTS.format(src="src")},
    b AS (SELECT o_custkey, CASE WHEN size > 17 THEN 8 WHEN size > 15 THEN 7 WHEN size > 13 THEN 6
                                 ELSE 1 + (SELECT count(*) FROM cuts WHERE size > cut) END AS bin FROM s),
    m AS (SELECT year(o_orderdate)::INTEGER AS year, bin, 100.0 * count(*) FILTER (o_orderpriority = '1-URGENT') / count(*) AS pct
          FROM orders JOIN customer ON c_custkey = o_custkey JOIN b USING (o_custkey) GROUP BY 1, 2)
    SELECT year, {", ".join(f"round(max(pct) FILTER (bin = {i}), 6) AS bin{i}" for i in range(1, 9))} FROM m GROUP BY year
""")
def share_matrix_pivot(t: Tables):
    """Percent of urgent orders per year and customer size bin, one column per bin."""
    orders = t.orders.select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderpriority")
    rows = orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey").join(size_bins(t), "o_custkey")
    shares = G.share_by(rows, ["year", "bin"], (F.col("o_orderpriority") == "1-URGENT").cast("int"))
    return R.to_wide(shares.withColumn("pct", F.round("pct", 6)), ["year"], "bin", ["pct"], range(1, 9)).withColumnsRenamed(
        {f"pct{i}": f"bin{i}" for i in range(1, 9)})


_PARTS = {
    "pct_returned": "l_returnflag = 'R'", "pct_accepted": "l_returnflag = 'A'", "pct_none": "l_returnflag = 'N'",
    "pct_discounted": "l_discount > 0.05", "pct_bulk": "l_quantity > 40", "pct_late": "l_shipdate >= DATE '1998-01-01'",
}


@query("category_share_transpose", f"""
    WITH s AS (SELECT l_linestatus AS h, {", ".join(f"100.0 * count(*) FILTER ({c}) / count(*) AS {n}" for n, c in _PARTS.items())}
               FROM lineitem GROUP BY 1)
    SELECT varname, round(max(v) FILTER (h = 'F'), 6) AS "F", round(max(v) FILTER (h = 'O'), 6) AS "O"
    FROM (UNPIVOT s ON {", ".join(_PARTS)} INTO NAME varname VALUE v) GROUP BY varname
""")
def category_share_transpose(t: Tables):
    """Overlapping shares per group, variables as rows."""
    shares = G.category_shares(t.lineitem, "l_linestatus", F.lit(1), {n: F.expr(c).cast("int") for n, c in _PARTS.items()})
    shares = shares.select("l_linestatus", *[F.round(n, 6).alias(n) for n in _PARTS])
    return R.transpose(shares, "l_linestatus", ["F", "O"])


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("composition_rank", """
    WITH n AS (SELECT n_nationkey, s.seg, count(c_custkey) AS n
               FROM nation CROSS JOIN (VALUES ('AUTOMOBILE', 1), ('BUILDING', 2), ('FURNITURE', 3), ('HOUSEHOLD', 4), ('MACHINERY', 5)) s(seg, rk)
               LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = s.seg AND c_acctbal >= 0 GROUP BY 1, 2)
    SELECT n_nationkey AS nation, seg AS segment, n,
           round(coalesce(sum(n) OVER (PARTITION BY n_nationkey ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 / sum(n) OVER (PARTITION BY n_nationkey), 6) AS share_above
    FROM n QUALIFY sum(n) OVER (PARTITION BY n_nationkey) > 0
""")
def composition_rank(t: Tables):
    """Pivot counts, fill gaps with zero, back to long, share of higher-ranked categories."""
    counts = t.customer.filter("c_acctbal >= 0").groupBy(F.col("c_nationkey").alias("nation"), "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_"))
    wide = R.fill_zero(R.to_wide(counts, ["nation"], "c_mktsegment", ["n_"], _SEGMENTS), "n_")
    long = R.to_long(wide, ["nation"], "n_", "segment", value="n")
    ranked = G.share_above(long, ["nation"], "segment", "n")
    return ranked.withColumn("share_above", F.round("share_above", 6))


@query("group_mode_tiebreak", """
    WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT o_custkey, o_orderstatus, n FROM c
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END) = 1
""")
def group_mode_tiebreak(t: Tables):
    rank = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(3)
    return G.mode_by(t.orders, ["o_custkey"], "o_orderstatus", rank)


@query("rows_at_maximum", """
    WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT * FROM c QUALIFY n = max(n) OVER (PARTITION BY o_custkey)
""")
def rows_at_maximum(t: Tables):
    counts = G.counts_by(t.orders, ["o_custkey", "o_orderstatus"])
    return G.rows_at_maximum(counts, ["o_custkey"], "n")


@query("monthly_union_mean", """
    WITH u AS (SELECT o_custkey, o_orderkey, o_orderdate, month(o_orderdate)::INTEGER AS month,
                      CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS total,
                      CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority FROM orders)
    SELECT o_custkey, o_orderkey, month, priority, round(avg(total) OVER (PARTITION BY o_custkey), 6) AS mean_total
    FROM u QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY month DESC, o_orderkey DESC) = 1
""")
def monthly_union_mean(t: Tables):
    """Tagged tables with differing columns appended, group mean, last row per group."""
    month = F.month("o_orderdate").alias("month")
    full = t.orders.filter("o_orderstatus <> 'F'").select(
        "o_custkey", "o_orderkey", month, F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"))
    bare = t.orders.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", month)
    rows = J.append(full, bare)
    means = rows.groupBy("o_custkey").agg(F.round(F.avg("total"), 6).alias("mean_total"))
    last = G.last_row(rows.drop("total"), ["o_custkey"], ["month", "o_orderkey"])
    return last.join(means, "o_custkey")


@query("keyed_map_last_wins", """
    SELECT props, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1
""")
def keyed_map_last_wins(t: Tables):
    return G.latest_value_map(t.events, "props", "event_type", ["event_id"])


@query("sum_by_key", """
    SELECT src, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM
      (SELECT nullif(o_orderstatus, 'P') AS src, * FROM orders) WHERE src IS NOT NULL GROUP BY 1, 2
""")
def sum_by_key(t: Tables):
    """Group sums that leave out rows with a missing key."""
    rows = t.orders.withColumn("src", F.nullif("o_orderstatus", F.lit("P")))
    return G.sum_by(rows, ["src", "o_orderpriority"], total="o_totalprice").withColumn("total", F.round("total", 2))
