"""Positions, fills, quantile bins."""

from pyspark.sql import functions as F

from quadrat.operators import groups as G, numbering as N, quantiles as Q
from quadrat.queries.registry import Tables, query
from quadrat.session import cut_lineage

# Exact percentile cut points of column ``v`` of relation ``src`` as SQL.
CUTS = """
    r AS (SELECT v, row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n FROM {src} WHERE v IS NOT NULL),
    cuts AS (SELECT p, CASE WHEN (n * p) % 100 = 0
                            THEN (max(v) FILTER (i = n * p // 100) + max(v) FILTER (i = n * p // 100 + 1)) / 2.0
                            ELSE max(v) FILTER (i = n * p // 100 + 1) END AS cut
             FROM r, (VALUES (20), (40), (60), (80)) q(p) GROUP BY p, n)
"""


@query("forward_fill", """
    SELECT event_id, last_value(CASE WHEN value >= 100 THEN event_type END IGNORE NULLS) OVER (ORDER BY event_id) AS state FROM events
""")
def forward_fill(t: Tables):
    rows = t.events.select("event_id", F.when(F.col("value") >= 100, F.col("event_type")).alias("state"))
    return N.forward_fill(rows, "state", "event_id", block_lines=100_000)


@query("forward_fill_by_key", """
    SELECT event_id, user_id, last_value(CASE WHEN value >= 100 THEN event_type END IGNORE NULLS)
           OVER (PARTITION BY user_id ORDER BY event_id) AS state FROM events
""")
def forward_fill_by_key(t: Tables):
    rows = t.events.select("event_id", "user_id", F.when(F.col("value") >= 100, F.col("event_type")).alias("state"))
    return N.forward_fill(rows, "state", "event_id", by=["user_id"], block_lines=100_000)


@query("group_position", """
    SELECT o_orderkey, row_number() OVER w AS position, count(*) OVER (PARTITION BY o_custkey) AS group_size
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def group_position(t: Tables):
    """Position and size inside the group, numbered over range partitions."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return N.with_group_position(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "position", "group_size")


@query("quantile_bins", f"""
    WITH src AS (SELECT c_acctbal AS v FROM customer), {CUTS.format(src="src")}
    SELECT c_custkey, (1 + (SELECT count(*) FROM cuts WHERE c_acctbal > cut))::INTEGER AS bin, (SELECT cut FROM cuts WHERE p = 80) AS p80
    FROM customer
""")
def quantile_bins(t: Tables):
    rows = t.customer.select("c_custkey", "c_acctbal")
    p80 = Q.percentiles(rows, "c_acctbal", [80])[0]
    return Q.quantile_bins(rows, "c_acctbal", 5, "bin").select("c_custkey", "bin", F.lit(p80).alias("p80"))


@query("quantile_tiers", f"""
    WITH s AS (SELECT l_partkey, sum(l_quantity) AS size, nullif(count(*), 1) AS n FROM lineitem GROUP BY 1),
         src AS (SELECT size AS v FROM s), {CUTS.format(src="src")}
    SELECT l_partkey, CASE WHEN size > 1200 THEN 8 WHEN size > 1000 THEN 7 WHEN size > 900 THEN 6
                           ELSE 1 + (SELECT count(*) FROM cuts WHERE size > cut) END::INTEGER AS bin
    FROM s
""")
def quantile_tiers(t: Tables):
    size = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("size"))
    return Q.tiered_bins(cut_lineage(size), "size", 5, [(1200, 8), (1000, 7), (900, 6)], "bin").select("l_partkey", "bin")


@query("even_chunks", "SELECT doc_id, ntile(32) OVER (ORDER BY doc_id)::INTEGER AS chunk FROM documents")
def even_chunks(t: Tables):
    return N.even_chunks(t.documents.select("doc_id"), ["doc_id"], 32)


@query("floor_splits", """
    SELECT doc_id, (least((row_number() OVER (ORDER BY doc_id) - 1) // ((SELECT count(*) FROM documents) // 7), 6) + 1)::INTEGER AS split
    FROM documents
""")
def floor_splits(t: Tables):
    return N.floor_splits(t.documents.select("doc_id"), ["doc_id"], 7)


@query("round_robin", "SELECT doc_id, ((row_number() OVER (ORDER BY n_chars, doc_id) - 1) % 12)::INTEGER AS slot FROM documents")
def round_robin(t: Tables):
    return N.round_robin(t.documents.select("doc_id", "n_chars"), ["n_chars", "doc_id"], 12).select("doc_id", "slot")


@query("latest_per_group", """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_group(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return G.last_row(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("first_n_sample", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100")
def first_n_sample(t: Tables):
    """The sampling option: a fixed number of rows in order."""
    return N.first_n(t.documents.select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], 100)
