"""Round trips through the readers and writers, over whole tables."""

from pyspark.sql import functions as F

from quadrat.operators import ledger as L
from quadrat.plans import papers as P
from quadrat.queries.registry import Tables, query
from quadrat.queries.text import as_papers, by_language
from quadrat.session import cut_lineage, new_folder
from quadrat.sources import readers as S, writers as O


@query("csv_by_key_round_trip", """
    SELECT replace(replace(o_orderpriority, '_', ''), '/', '') || '_' || o_orderstatus AS file_key, count(*) AS n,
           round(sum(o_totalprice), 2) AS total, min(lpad(o_custkey::VARCHAR, 6, '0')) AS first_customer FROM orders GROUP BY 1
""")
def csv_by_key_round_trip(t: Tables):
    """Orders as one CSV folder per key, read back with a declared schema."""
    from quadrat.functions.keys import zero_pad

    path = new_folder(t.spark, "csv")
    key = O.safe_key("o_orderpriority", "o_orderstatus")
    rows = t.orders.select("o_orderkey", zero_pad("o_custkey", 6).alias("customer"), "o_totalprice", key.alias("file_key"))
    O.write_csv_by_key(rows, path, F.col("file_key"))
    back = S.read_csv(t.spark, path, "o_orderkey bigint, customer string, o_totalprice double, file_key string")
    return back.groupBy("file_key").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("customer").alias("first_customer"))


@query("json_lines_round_trip", """
    SELECT count(*) AS lines, count(*) FILTER (n_chars < 400) AS broken,
           sum(CASE WHEN n_chars >= 400 THEN doc_id END)::BIGINT AS ids, sum(CASE WHEN n_chars >= 400 THEN length(text) END)::BIGINT AS characters FROM documents
""")
def json_lines_round_trip(t: Tables):
    """Texts as JSON lines, some of them cut off; good and broken lines add up."""
    path = new_folder(t.spark, "lines")
    record = F.to_json(F.struct("doc_id", "text"))
    lines = t.documents.select(F.when(F.col("n_chars") >= 400, record).otherwise(F.left(record, F.length(record) - 2)).alias("value"))
    lines.write.text(path)
    rows = S.read_json_lines(t.spark, path, "doc_id bigint, text string")
    return rows.agg(
        F.count_distinct("file", "line_no").alias("lines"), F.sum(F.col("record").isNull().cast("int")).alias("broken"),
        F.sum("record.doc_id").alias("ids"), F.sum(F.length("record.text")).alias("characters"))


@query("paper_errors", """
    SELECT error, count(*) AS n, min(line_no) AS first_line FROM
      (SELECT 'abstract' AS error, doc_id AS line_no FROM documents WHERE 1950 + doc_id % 61 <= 1980 AND doc_id % 7 <> 3 AND lang = 'es') GROUP BY 1
""")
def paper_errors(t: Tables):
    """Indexes cut off in the middle end up in the quarantine, counted by error."""
    papers = as_papers(by_language(t), "lang")
    cut = F.when(F.col("lang") == "es", F.expr("substring(indexed_abstract, 1, length(indexed_abstract) - 2)")).otherwise(F.col("indexed_abstract"))
    errors = P.route(P.prepare(papers.withColumn("indexed_abstract", cut).drop("lang"))).errors
    errors = cut_lineage(errors.select("error", "line_no"))  # read twice
    first = errors.groupBy("error").agg(F.min("line_no").alias("first_line"))
    return L.error_counts(errors, stage="error").join(first, "error")
