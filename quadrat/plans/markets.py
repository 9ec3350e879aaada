"""Commodity arrivals: work list per commodity and state, market tables, re-run report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadrat.functions import keys as K, text as X
from quadrat.operators import ledger as L, merge as J, numbering as N, pages as H


def work_list(report: DataFrame, locations: DataFrame, start: str, end: str, slots: int = 1) -> tuple[DataFrame, DataFrame]:
    """One row per (commodity, state) with its query string and slot, and the states without a code.

    ``report`` has (ccode, name, states), ``locations`` (scode, name); dates are dd-mm-yyyy.
    """
    codes = K.swap_key_value(locations, "scode", "name").select(F.col("value").alias("state"), F.col("key").alias("scode"))
    dealt = N.round_robin(report, ["ccode"], slots)
    found, missed = J.strict_lookup(J.expand_list(dealt, "states", "state"), codes, ["state"], "scode")
    first, last = (X.reformat_date(F.lit(d)) for d in (start, end))
    query = X.query_string({
        "Tx_Commodity": "ccode", "Tx_State": "scode", "Tx_District": F.lit(0), "Tx_Market": F.lit(0), "DateFrom": first, "DateTo": last,
        "Fr_Date": first, "To_Date": last, "Tx_Trend": F.lit(1), "Tx_CommodityHead": "name", "Tx_StateHead": "state",
        "Tx_DistrictHead": F.lit("--Select--"), "Tx_MarketHead": F.lit("--Select--"),
    })
    return found.withColumns({"start": first, "end": last, "query": query}), missed


def market_rows(work: DataFrame, pages: DataFrame) -> DataFrame:
    """Market tables of stored pages (ccode, scode, district, html) with their codes."""
    keyed = pages.withColumn("page", F.concat_ws("|", "ccode", "scode", "district"))
    rows = H.with_header(H.extract_tables(keyed, "page", "html"), "page", ["Market", "Arrivall"])
    rows = rows.join(keyed.select("page", "ccode", "scode", "district"), "page").join(
        work.select("ccode", "scode", "name", "state", "start", "end"), ["ccode", "scode"])
    return rows.select(
        F.col("start").alias("Start"), F.col("end").alias("End"), F.col("state").alias("State"), F.col("scode").alias("State Code"),
        F.col("district").alias("District"), H.title_part("table_title", 1).alias("District Code"), "Market",
        F.col("name").alias("Commodity"), F.col("ccode").alias("Commodity Code"), F.col("Arrivall").alias("Arrival"))


def rerun_report(work: DataFrame, done: DataFrame, log: DataFrame, max_tries: int = 2) -> DataFrame:
    """Commodities with unfinished states: the states and the folded log of each."""
    rest = L.unresolved(work, done, ["ccode", "name"], "state", "states")
    states = J.expand_list(rest, "states", "state")
    folded = L.fold_log(log, ["ccode", "state"], "attempt", "message")
    return states.join(folded, ["ccode", "state"], "left").select("ccode", "name", "state", F.col("log").alias("error"))
