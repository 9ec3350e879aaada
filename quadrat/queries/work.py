"""Model batches, prompts, retries, incremental ingest."""

from pyspark.sql import functions as F

from quadrat.functions import text as X
from quadrat.operators import groups as G, infer as I, ledger as L, numbering as N
from quadrat.queries.registry import Tables, query
from quadrat.queries.text import _COMPONENTS, _SQUEEZED, _digest, as_papers, by_language, components
from quadrat.session import new_folder


@query("embed_hash", f"""
    WITH tk AS (SELECT doc_id, unnest(string_split({_SQUEEZED.format(c="text")}, ' ')[1:512]) AS w FROM documents),
         h AS (SELECT doc_id, (('0x' || md5(lower(w))[1:8])::BIGINT % 64)::INTEGER AS slot, count(*) AS n FROM tk WHERE w <> '' GROUP BY 1, 2)
    SELECT doc_id, count(*)::INTEGER AS used, string_agg(slot::VARCHAR, ' ' ORDER BY slot) AS slots, round(max(n) / sqrt(sum(n * n)), 2) AS largest FROM h GROUP BY 1
""")
def embed_hash(t: Tables):
    """Batched vectors of whole inputs, summarised per text."""
    vectors = I.embed_texts(t.documents, ["doc_id"], "text")
    used = F.filter(F.transform("embedding", lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
    return vectors.select("doc_id", F.size(used).alias("used"), F.array_join(used.cast("array<string>"), " ").alias("slots"),
                          F.round(F.array_max("embedding").cast("double"), 2).alias("largest"))


@query("embed_variants", f"""
    WITH c AS ({_COMPONENTS}), v AS ({" UNION ALL ".join(f"SELECT '{v}' AS variant, doc_id FROM c WHERE " + " AND ".join(f"coalesce({'refs' if p == 'references' else p}, '') <> ''" for p in ps) for v, ps in I.INPUT_TYPES.items())}),
         r AS (SELECT variant, row_number() OVER (PARTITION BY variant ORDER BY doc_id) - 1 AS rn, count(*) OVER (PARTITION BY variant) // 10 AS size FROM v)
    SELECT variant, (CASE WHEN size = 0 THEN 10 ELSE least(rn // size, 9) + 1 END)::INTEGER AS split, count(*) AS n, 64.0::DOUBLE AS dimensions FROM r GROUP BY 1, 2
""")
def embed_variants(t: Tables):
    """All seven input variants, each cut into output splits of its own rows, one vector per (variant, id)."""
    inputs = I.compose_inputs(components(t), "doc_id")
    splits = N.floor_splits(inputs.select("variant", "doc_id"), ["doc_id"], 10, by=["variant"])
    vectors = I.embed_texts(inputs.join(splits, ["variant", "doc_id"]), ["variant", "split", "doc_id"], "text")
    return vectors.groupBy("variant", "split").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.size("embedding")), 3).alias("dimensions"))


_SYSTEM = "List the names in the text.\n"


@query("prompt_render", """
    SELECT conv_id, turn, md5('<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || 'List the names in the text.'
           || '<|eot_id|>' || chr(10) || '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || trim(text) || '<|eot_id|>' || chr(10)
           || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)) AS digest FROM conversations
""")
def prompt_render(t: Tables):
    rows = t.conversations.select("conv_id", "turn", X.render_prompt(I.CHAT_TEMPLATE, system=F.lit(_SYSTEM.strip()), user="text").alias("p"))
    return rows.select("conv_id", "turn", _digest("p").alias("digest"))


@query("entity_extract", """
    SELECT conv_id, turn, array_to_string(regexp_extract_all(text, '\\b[A-Z][a-z]+\\b'), ', ') AS ner, true AS ok FROM conversations
""")
def entity_extract(t: Tables):
    rows = L.attempt_rows(t.conversations, ["conv_id", "turn"], I.capitalised_terms("text"), "ner string", batch_rows=64)
    return rows.select("conv_id", "turn", "ner", "ok")


def _flaky(attempt: int):
    """Fails on quoted text always and on mail-like text in the first attempt."""
    def load():
        def count_words(batch):
            bad = batch["text"].str.contains('"') | (batch["text"].str.contains("@") & (attempt == 1))
            if bad.any():
                raise ValueError(f"cannot read text {int(batch.loc[bad, 'doc_id'].iloc[0])}")
            return batch.assign(words=batch["text"].str.split().str.len().astype("int64"))

        return count_words

    return load()


@query("retry_ledger", f"""
    SELECT doc_id, CASE WHEN contains(text, '"') THEN NULL ELSE len(string_split({_SQUEEZED.format(c="text")}, ' '))::BIGINT END AS words,
           NOT contains(text, '"') AS ok, CASE WHEN contains(text, '"') THEN 'cannot read text ' || doc_id END AS error,
           CASE WHEN contains(text, '"') THEN 3 WHEN contains(text, '@') THEN 2 ELSE 1 END AS attempt FROM documents
""")
def retry_ledger(t: Tables):
    """Rows that fail are booked by key and retried a bounded number of times."""
    return L.run_until_done(t.documents.select("doc_id", "text"), ["doc_id"], _flaky, "words bigint", max_tries=3, batch_rows=64, attempt_arg=True)


@query("completion_report", """
    SELECT status, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM
      (SELECT doc_id, CASE WHEN contains(text, '"') OR contains(text, '@') THEN 'errors' ELSE 'completed' END AS status FROM documents) GROUP BY 1
""")
def completion_report(t: Tables):
    outcomes = L.attempt_rows(t.documents.select("doc_id", "text"), ["doc_id"], lambda: _flaky(1), "words bigint", batch_rows=64)
    report = L.completion_report(outcomes, ["doc_id"])
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("error_fold", """
    SELECT o_custkey, string_agg(msg, ' >>> ' ORDER BY a) AS log FROM
      (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS a, o_orderstatus || count(*) AS msg FROM orders GROUP BY 1, o_orderstatus) GROUP BY 1
""")
def error_fold(t: Tables):
    counts = G.counts_by(t.orders, ["o_custkey", "o_orderstatus"])
    messages = counts.select("o_custkey", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("a"),
                             F.concat("o_orderstatus", F.col("n").cast("string")).alias("msg"))
    return L.fold_log(messages, ["o_custkey"], "a", "msg")


@query("ingest_incremental", """
    SELECT doc_id::VARCHAR AS id, batch FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS batch FROM documents
    WHERE 1950 + doc_id % 61 <= 1980 AND doc_id % 7 <> 3)
""")
def ingest_incremental(t: Tables):
    """Two runs over a growing folder; the second one reads only the new files."""
    from quadrat.streaming.ingest import ingest_papers

    root = new_folder(t.spark, "ingest")
    for group in ("lang = 'en'", "lang <> 'en'"):
        papers = as_papers(by_language(t).filter(group)).drop("file_idx", "line_no")
        papers.write.mode("append").json(f"{root}/raw")
        ingest_papers(t.spark, f"{root}/raw", f"{root}/out", f"{root}/state")
    return t.spark.read.parquet(f"{root}/out/prepared").select("id", "batch")


@query("title_map_runs", """
    WITH kept AS (SELECT doc_id::VARCHAR AS id, doc_id % 5 = 0 AS changed, string_split(text, chr(10))[1] AS line FROM documents WHERE lang = 'en' AND 1950 + doc_id % 61 <= 1980 AND doc_id % 7 <> 3)
    SELECT id, CASE WHEN changed THEN 'revised ' || id ELSE trim(regexp_replace(line, '\\s+', ' ', 'g')) END AS title FROM kept
""")
def title_map_runs(t: Tables):
    """The title map after two runs, the second with new titles for some papers, and a compaction between reads."""
    from quadrat.operators.ngrams import detector, fit
    from quadrat.streaming.ingest import compact_titles, ingest_papers, title_map

    root = new_folder(t.spark, "ingest")
    papers = as_papers(by_language(t).filter("lang = 'en'")).drop("file_idx", "line_no")
    english = detector(fit(t.documents.filter("lang = 'en'"), "lang", "text"))
    revised = papers.filter("id % 5 = 0").withColumn("title", F.concat(F.lit("revised "), "id"))
    for run in (papers, revised):
        run.write.mode("append").json(f"{root}/raw")
        ingest_papers(t.spark, f"{root}/raw", f"{root}/out", f"{root}/state", detector=english)
    compact_titles(t.spark, f"{root}/out", 1)
    return title_map(t.spark, f"{root}/out")
