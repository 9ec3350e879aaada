"""Merges, hierarchies, lookups, work lists."""

from pyspark.sql import functions as F

from quadrat.functions import keys as K
from quadrat.operators import groups as G, ledger as L, merge as J
from quadrat.queries.registry import Tables, query


@query("left_join_chain", """
    SELECT n.n_nationkey, n.n_name, r_name, customers, balance, suppliers, orders
    FROM nation n LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN (SELECT c_nationkey AS k, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1) a ON a.k = n_nationkey
    LEFT JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) b ON b.k = n_nationkey
    LEFT JOIN (SELECT c_nationkey AS k, count(*) AS orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1) c ON c.k = n_nationkey
""")
def left_join_chain(t: Tables):
    base = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name")
    customers = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    orders = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("n").alias("orders"))
    return J.left_join_chain(base, [customers, suppliers, orders], "n_nationkey")


@query("validated_merge_indicator", """
    WITH m AS (SELECT c_custkey AS id, c_mktsegment AS tag, c_acctbal FROM customer WHERE c_acctbal >= 0),
         u AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS id, o_orderpriority AS tag, o_orderkey FROM orders)
    SELECT coalesce(m.id, u.id) AS id, CASE WHEN m.id IS NOT NULL THEN m.tag ELSE u.tag END AS tag, c_acctbal, o_orderkey,
           CASE WHEN m.id IS NULL THEN 2 WHEN o_orderkey IS NULL THEN 1 ELSE 3 END AS origin
    FROM m FULL JOIN u ON m.id = u.id
""")
def validated_merge_indicator(t: Tables):
    """One-to-many merge with its origin; the shared column takes the master value."""
    master = t.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("tag"), "c_acctbal")
    using = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("id"),
                            F.col("o_orderpriority").alias("tag"), "o_orderkey")
    return J.merge_one_to_many(master, using, ["id"], keep=(1, 2, 3), indicator="origin")


@query("hierarchy_lookup", """
    SELECT r_name, n_name, count(*) AS orders, count(DISTINCT c_custkey) AS customers
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
    GROUP BY 1, 2
""")
def hierarchy_lookup(t: Tables):
    """Region, nation, customer, order: cumulative keys down the hierarchy."""
    region = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    nation = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = J.join_hierarchy([region, nation, t.customer, orders], [["n_regionkey"], ["c_nationkey"], ["c_custkey"]])
    return rows.groupBy("r_name", "n_name").agg(F.sum("n").alias("orders"), F.count(F.lit(1)).alias("customers"))


@query("strict_lookup_misses", """
    SELECT o_orderstatus, count(*) FILTER (c_custkey IS NOT NULL) AS found, count(*) FILTER (c_custkey IS NULL) AS missed
    FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey GROUP BY 1
""")
def strict_lookup_misses(t: Tables):
    """Dictionary lookup with a quarantine of the keys that are not there."""
    table = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    found, missed = J.strict_lookup(t.orders.select("o_custkey", "o_orderstatus"), table, ["o_custkey"], "c_name")
    both = J.append(found.withColumn("hit", F.lit(1)), missed.withColumn("hit", F.lit(0)))
    return both.groupBy("o_orderstatus").agg(F.sum("hit").alias("found"), F.sum(1 - F.col("hit")).alias("missed"))


@query("lookup_invert", """
    SELECT n_regionkey::VARCHAR AS value, arg_max(n_name, n_nationkey) AS key FROM nation GROUP BY 1
    UNION ALL SELECT r_name, r_regionkey::VARCHAR FROM region
""")
def lookup_invert(t: Tables):
    nations = K.swap_key_value(t.nation, "n_name", "n_regionkey", order="n_nationkey")
    regions = K.swap_key_value(t.region, "r_regionkey", "r_name")
    text = [F.col("value").cast("string"), F.col("key").cast("string")]
    return J.append(nations.select(*text), regions.select(*text))


@query("resume_antijoin", """
    SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
                            THEN 'completed' ELSE 'pending' END AS state
    FROM orders
""")
def resume_antijoin(t: Tables):
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    orders = t.orders.select("o_orderkey")
    pending = J.drop_in(orders, done, ["o_orderkey"]).withColumn("state", F.lit("pending"))
    return J.append(J.keep_in(orders, done, ["o_orderkey"]).withColumn("state", F.lit("completed")), pending)


_KINDS = ("click", "error", "purchase", "signup", "view")


@query("worklist_expand_report", """
    WITH users AS (SELECT DISTINCT user_id FROM events),
         work AS (SELECT user_id, unnest(['click', 'error', 'purchase', 'signup', 'view']) AS kind FROM users),
         done AS (SELECT DISTINCT user_id, event_type AS kind FROM events WHERE value >= 100),
         rest AS (SELECT user_id, string_agg(kind, ',' ORDER BY kind) AS unresolved FROM work ANTI JOIN done USING (user_id, kind) GROUP BY 1),
         msgs AS (SELECT user_id, event_type AS kind, event_type || ' ' || count(*) AS msg FROM events GROUP BY 1, 2)
    SELECT user_id, unresolved, string_agg(msg, ' >>> ' ORDER BY kind) AS log FROM rest JOIN msgs USING (user_id) GROUP BY 1, 2
""")
def worklist_expand_report(t: Tables):
    """Expand a work list, subtract what is done, list the rest with its folded log."""
    users = t.events.select("user_id").distinct().withColumn("kinds", F.array(*[F.lit(k) for k in _KINDS]))
    work = J.expand_list(users, "kinds", "kind")
    done = t.events.filter("value >= 100").select("user_id", F.col("event_type").alias("kind")).distinct()
    rest = L.unresolved(work, done, ["user_id"], "kind")
    rest = rest.select("user_id", F.array_join("unresolved", ",").alias("unresolved"))
    messages = G.counts_by(t.events, ["user_id", "event_type"]).select(
        "user_id", K.recode("event_type", {k: i for i, k in enumerate(_KINDS, 1)}).alias("attempt"),
        F.concat_ws(" ", "event_type", F.col("n").cast("string")).alias("msg"))
    return rest.join(L.fold_log(messages, ["user_id"], "attempt", "msg"), "user_id")
