"""Entity extraction job: prompts, batched generation, completed and failed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadrat.functions.text import render_prompt
from quadrat.operators import infer as I, ledger as L
from quadrat.operators.numbering import first_n

KEYS = ["paperId", "excerptId"]


def extract_entities(
    excerpts: DataFrame, system_prompt: str, load=None, sample: int | None = None, ledger: str | None = None,
    batch_rows: int = 4, max_tries: int = 32,
) -> tuple[DataFrame, DataFrame]:
    """Returns (paperId, excerptId, dateRange, ner) and the report of completed and failed keys.

    ``load`` returns the generator; it sees the rendered ``prompt`` and the raw
    ``excerpt``.  The default extracts capitalised words from the excerpt.
    """
    rows = first_n(excerpts, KEYS, sample) if sample is not None else excerpts
    prompts = rows.withColumn("prompt", render_prompt(I.CHAT_TEMPLATE, system=F.lit(system_prompt.strip()), user="excerpt"))
    outcomes = L.run_until_done(
        prompts, KEYS, load or I.capitalised_terms("excerpt"), "ner string", ledger, max_tries, batch_rows)
    good = outcomes.filter("ok").select(*KEYS, F.trim("ner").alias("ner"))
    return rows.select(*KEYS, "dateRange").join(good, KEYS), L.completion_report(outcomes, KEYS)
