"""Village pages: administrative hierarchy, page rows with their links, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quadrat.operators import merge as J, pages as H
from quadrat.operators.groups import last_row
from quadrat.session import cut_lineage
from quadrat.sources.writers import safe_key

LEVELS = ["State", "District", "Block", "Grampanchayat"]


def gram_worklist(states: DataFrame, districts: DataFrame, blocks: DataFrame, grams: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Local councils to process: blocks without councils vanish, finished councils are skipped."""
    keys = [LEVELS[:1], LEVELS[:2], LEVELS[:3]]
    work = J.join_hierarchy([states, districts, blocks, grams], keys).withColumn("file_key", safe_key(*LEVELS))
    return work if done is None else J.drop_in(work, done, ["file_key"])


def village_table(work: DataFrame, pages: DataFrame, html: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Village rows with link codes, and the councils that failed with the reason.

    ``pages`` has (file_key, html).  A village without a link fails its whole council,
    as does a council without a page or table.

    A page settles its own council, so its rows are written with their links and are not
    shuffled to find them.  Councils with several pages, or listed several times, are put
    together from all of these by joins.  Pages may name the council they were stored for
    (the columns of ``LEVELS``); its rows are then not joined to the list either.  Pages
    that joins put together can come without ``html``, as the columns that ``html`` is made
    of: it is made where it is parsed, and does not travel.
    """
    named = [n for n in LEVELS if n in pages.columns] if set(LEVELS) <= set(pages.columns) else []
    here = J.keep_in(pages, work, ["file_key"])
    if html is not None:
        here = here.withColumn("html", html)
    entries = cut_lineage(H.village_entries(here, "file_key", "html", named, spread=html is None), "zstd")
    stored = entries.groupBy("file_key").agg(F.count(F.lit(1)).alias("pages"), F.max("filled").alias("filled"), F.min("lost").alias("village"))
    listed = work.filter("file_key is not null").groupBy("file_key").agg(F.count(F.lit(1)).alias("times"))
    councils = listed.join(stored, "file_key", "left")
    odd = councils.select("file_key", "filled", F.expr("coalesce(times > 1 or pages > 1, false)").alias("several"), _failure().alias("error"))
    odd = cut_lineage(odd.filter("several or error is not null"))  # the other councils have one page each, and all of its rows are good
    errors = odd.filter("not several").select("file_key", "error")
    errors = errors.unionByName(work.filter("file_key is null").select("file_key", F.lit("no page").alias("error")))
    shared = odd.filter("several").select("file_key", "filled")
    columns = ["file_key", *LEVELS, F.col("village").alias("Village"), *H.VILLAGE_COUNTS, "code", "short_name"]

    def of_councils(rows: DataFrame) -> DataFrame:
        return rows.drop(*named).join(work.select("file_key", *LEVELS), "file_key")

    whole, some = entries.filter("lost is null"), not shared.isEmpty()
    if some:
        shared = cut_lineage(shared)  # few as a rule: joined without a shuffle then
        whole = J.drop_in(whole, shared, ["file_key"])
    good = whole.select("file_key", *named, F.inline("rows")).filter("link_no is not null")
    good = (good if named else of_councils(good)).select(*columns)
    if not some:
        return good, errors
    more, failed = _shared_councils(J.keep_in(entries, shared, ["file_key"]), J.keep_in(work, shared, ["file_key"]), shared)
    return good.unionByName(of_councils(more).select(*columns)), errors.unionByName(failed)


def _failure() -> Column:
    """Why a council failed, from its pages: ``filled`` is missing without a page, ``village`` is the first one without a link."""
    return F.when(F.col("filled").isNull(), "no page").when(~F.col("filled"), "no table").when(
        F.col("village").isNotNull(), F.concat(F.lit("no link for "), "village"))


def _shared_councils(entries: DataFrame, work: DataFrame, councils: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and failures of councils whose rows and links may stand on different pages."""
    rows = entries.select("file_key", F.inline("rows"))
    links = rows.filter("link_no is not null").unionByName(entries.select("file_key", F.inline("links")), allowMissingColumns=True)
    links = last_row(links, ["file_key", "village"], ["link_no"]).select("file_key", "village", F.struct("code", "short_name").alias("link"))
    rows = rows.select("file_key", "village", *H.VILLAGE_COUNTS)
    found, missed = J.strict_lookup(rows, links, ["file_key", "village"], "link")
    reason = councils.join(missed.groupBy("file_key").agg(F.min("village").alias("village")), "file_key", "left")
    failed = reason.select("file_key", _failure().alias("error")).filter("error is not null")
    good = J.drop_in(found, failed, ["file_key"]).select("file_key", "village", *H.VILLAGE_COUNTS, "link.code", "link.short_name")
    return good, work.select("file_key").join(failed, "file_key")
