"""Further sources, sinks and injected models, each over a whole table."""

from pyspark.sql import functions as F

from quadrat.functions import language as D
from quadrat.operators import numbering as N, regress as E
from quadrat.plans import county
from quadrat.queries.registry import Tables, query
from quadrat.session import new_folder
from quadrat.sources import readers as S, writers as O

MAP_KEYS = 10_000  # keys of one JSON object, so that no object grows with the table


@query("ragged_rows", """
    SELECT CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 2 END AS cells, count(*) AS n, sum(c_custkey)::BIGINT AS keys,
           min(c_mktsegment || ', "x"') AS first_segment FROM customer GROUP BY 1
""")
def ragged_rows(t: Tables):
    """Customers as rows of differing length with quoted and empty cells, read back."""
    path = new_folder(t.spark, "ragged")
    quoted = F.concat(F.lit('"'), "c_mktsegment", F.lit(', ""x"""'))
    more = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(",,"), "c_name")).otherwise(",")
    t.customer.select(F.concat(F.col("c_custkey").cast("string"), F.lit(","), quoted, more).alias("value")).write.text(path)
    rows = S.read_ragged(t.spark, path)
    return rows.groupBy(F.size("cells").alias("cells")).agg(
        F.count_distinct("row_no").alias("n"), F.sum(F.get("cells", F.lit(0)).cast("bigint")).alias("keys"), F.min(F.get("cells", F.lit(1))).alias("first_segment"))


@query("json_map_round_trip", """
    SELECT nation, count(*) AS n, count(DISTINCT c_custkey) AS customers, min(c_name) AS first_name
    FROM (SELECT c_custkey, c_name, c_nationkey AS nation FROM customer) GROUP BY 1
""")
def json_map_round_trip(t: Tables):
    """Customers as JSON objects keyed by customer number, read back as rows."""
    path = new_folder(t.spark, "maps")
    entry = F.struct(F.col("c_custkey").cast("string"), F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")))
    part = F.floor(F.col("c_custkey") / MAP_KEYS).alias("part")
    t.customer.groupBy(part).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).write.partitionBy("part").text(path)
    rows = S.read_json_map(t.spark, path, "struct<name:string,nation:int>", "customer")
    return rows.groupBy("nation").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("customer").alias("customers"), F.min("name").alias("first_name"))


@query("statistical_files", """
    SELECT l_returnflag AS flag, count(*) AS n, sum(l_orderkey)::BIGINT AS keys, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1
""")
def statistical_files(t: Tables):
    """Order lines saved as statistical files, three of their columns read back by ranges of rows."""
    path = new_folder(t.spark, "statistical")
    O.write_statistical(t.lineitem.select("l_orderkey", "l_returnflag", F.col("l_extendedprice").cast("double").alias("price"), F.col("l_quantity").cast("double").alias("qty")), path)
    rows = S.read_statistical(t.spark, path, ["l_orderkey", "l_returnflag", "price"], "l_orderkey bigint, l_returnflag string, price double")
    return rows.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"), F.round(F.sum("price"), 2).alias("price"))


@query("json_by_file", """
    SELECT source AS file_idx, count(*) AS n, sum(doc_id)::BIGINT AS ids, sum(length(coalesce(text, '')))::BIGINT AS characters FROM documents GROUP BY 1
""")
def json_by_file(t: Tables):
    """Documents as JSON lines by origin, read back."""
    path = new_folder(t.spark, "by_file")
    O.write_json_by_file(t.documents.select("doc_id", "text", F.col("source").alias("file_idx")), path)
    rows = t.spark.read.schema("doc_id bigint, text string, file_idx string").json(path)
    return rows.groupBy("file_idx").agg(
        F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("characters"))


@query("map_and_matrix", """
    SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def map_and_matrix(t: Tables):
    """A ledger of orders as JSON lines, then its totals as one CSV table."""
    path = new_folder(t.spark, "ledger")
    O.write_map(t.orders.select("o_orderkey", F.struct("o_orderstatus", "o_totalprice").alias("entry")), f"{path}/map", "o_orderkey", "entry")
    back = t.spark.read.schema("o_orderkey bigint, entry struct<o_orderstatus:string,o_totalprice:double>").json(f"{path}/map")
    totals = back.groupBy(F.col("entry.o_orderstatus").alias("status")).agg(F.count("o_orderkey").alias("n"), F.round(F.sum("entry.o_totalprice"), 2).alias("total"))
    O.write_matrix(totals, f"{path}/matrix", ["status"])
    return S.read_csv(t.spark, f"{path}/matrix", "status string, n bigint, total double")


@query("vector_sink", """
    SELECT (label % 2)::VARCHAR AS variant, (vec_id % 3)::INTEGER AS split, count(*) AS n, sum(vec_id)::BIGINT AS ids, sum(len(embedding) + 1)::BIGINT AS numbers
    FROM embeddings GROUP BY 1, 2
""")
def vector_sink(t: Tables):
    """Vectors by variant and split; of two versions of an id the later one stays."""
    path = new_folder(t.spark, "vectors")
    first = t.embeddings.select((F.col("label") % 2).cast("string").alias("variant"), (F.col("vec_id") % 3).cast("int").alias("split"),
                                F.col("vec_id").alias("id"), "embedding", F.lit(0).alias("version"))
    later = first.withColumns({"version": F.lit(1), "embedding": F.concat("embedding", F.array(F.lit(1.0).cast("float")))})
    O.write_vectors(first.unionByName(later), path, order="version")
    rows = t.spark.read.schema("id bigint, embedding array<float>, variant string, split int").parquet(path)
    return rows.groupBy("variant", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.sum(F.size("embedding")).alias("numbers"))


@query("right_join_codes", """
    SELECT CASE WHEN n_regionkey < 3 THEN lpad(n_nationkey::VARCHAR, 2, '0') END AS "StateFIPS",
           count(*) FILTER (c_acctbal > 0) AS "DemocratHouseReps", count(*) FILTER (c_acctbal <= 0) AS "Republican"
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_regionkey
""")
def right_join_codes(t: Tables):
    """Counts by state next to codes that only some states have."""
    states = t.nation.filter("n_regionkey < 3").select(F.col("n_name").alias("State"), F.col("n_nationkey").cast("string").alias("FIPS"))
    side = lambda c, name: F.count(F.when(c, 1)).alias(name)
    seats = t.customer.groupBy("c_nationkey").agg(side(F.col("c_acctbal") > 0, "Democatric"), side(F.col("c_acctbal") <= 0, "Republican"))
    reps = t.nation.join(seats, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("State"), "Democatric", "Republican")
    return county.house_representatives(states, reps).withColumnRenamed("RepublicanHouseReps", "Republican")


@query("fe_singletons", """
    WITH r AS (SELECT l_orderkey AS g, l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey) > 1),
    d AS (SELECT g, y - avg(y) OVER p AS y, x - avg(x) OVER p AS x FROM r WINDOW p AS (PARTITION BY g))
    SELECT count(*) AS n, count(DISTINCT g)::BIGINT AS clusters, round(sum(x * y) / sum(x * x), 6) AS b FROM d
""")
def fe_singletons(t: Tables):
    """Orders of a single line leave the estimation sample."""
    lines = t.lineitem.select("l_orderkey", (F.col("l_extendedprice") / 1000).alias("price"), F.col("l_quantity").alias("qty"))
    fit = E.absorb_regression(lines, "price", ["qty"], ["l_orderkey"], cluster="l_orderkey")
    return E.fit_statistics([fit]).select("n", F.col("clusters").cast("bigint").alias("clusters"), F.round(F.lit(float(fit.b[0])), 6).alias("b"))


@query("missing_sorted_last", """
    SELECT count(*) AS n, count(*) FILTER (o_custkey % 10 = 0) AS missing, true AS missing_last FROM orders
""")
def missing_sorted_last(t: Tables):
    """Sorted prices with gaps: every missing one stands behind the last number."""
    rows = t.orders.select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice")).alias("price"), "o_orderkey")
    placed = N.sort_missing_last(rows, "price", "o_orderkey").withColumn("place", F.monotonically_increasing_id())
    gone = F.col("price").isNull()
    return placed.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(gone, 1)).alias("missing"),
                      (F.min(F.when(gone, F.col("place"))) > F.max(F.when(~gone, F.col("place")))).alias("missing_last"))


def _length_model():
    """Stands for a model that is loaded once per worker and sees whole batches."""
    def predict(texts):
        return ["long" if len(x) > 1000 else "short" for x in texts]

    return predict


@query("worker_model", """
    SELECT CASE WHEN coalesce(text, '') = '' THEN 'nan' WHEN length(text) > 1000 THEN 'long' ELSE 'short' END AS lang, count(*) AS n FROM documents GROUP BY 1
""")
def worker_model(t: Tables):
    """An injected model over every whole text, loaded once per task."""
    return D.detect_with(t.documents.select("doc_id", "text"), "text", _length_model).groupBy(F.col("lang")).agg(F.count(F.lit(1)).alias("n"))
