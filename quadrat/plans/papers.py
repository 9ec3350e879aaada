"""Paper records: year and type filter, abstract rebuild, language filter, subset and errors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quadrat.functions import language as L
from quadrat.functions.missing import known_year_and_type
from quadrat.functions.text import squeeze, with_normal_form
from quadrat.operators.abstracts import rebuild_text
from quadrat.operators.groups import latest_value_map
from quadrat.session import cut_lineage, fan_out

PAPER_SCHEMA = "id string, year int, doc_type string, title string, indexed_abstract string"


@dataclass
class PaperSubset:
    subset: DataFrame
    errors: DataFrame
    titles: DataFrame


def records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed JSON lines as flat rows, and the lines that are no record.

    Fields of a record beyond the declared ones are kept as text in the map ``other``.
    """
    rows = lines.filter("record is not null")
    declared = rows.schema["record"].dataType.names
    other = F.map_filter(F.from_json("raw", "map<string,string>"), lambda k, _: ~k.isin(declared))
    good = rows.select("file_idx", "line_no", "record.*", other.alias("other"))
    bad = lines.filter("record is null").select(
        F.lit("json").alias("error"), "file_idx", "line_no", F.col("raw").alias("payload"))
    return good, bad


def prepare(papers: DataFrame, year: int = 1980, exclude_doc: str = "Patent", detector=None) -> DataFrame:
    """Filtered papers with rebuilt abstract and detected language.

    The cheap filter comes first: everything after it is per-row text work.  ``detector``
    is a loader for :func:`quadrat.functions.language.detect_with`; without one the
    function-word scorer is used.
    """
    kept = fan_out(papers.filter(known_year_and_type("year", year, "doc_type", exclude_doc)))
    rebuilt = rebuild_text(kept, "indexed_abstract", "abstract", "abstract_failed")
    clean = rebuilt.withColumns({
        "title": squeeze(F.coalesce(F.col("title"), F.lit(""))), "abstract": squeeze("abstract"),
    })
    clean = with_normal_form(clean.withColumn("detect_text", L.detection_text("title", "abstract")), "detect_text", "NFKC")
    if detector is None:
        return clean.withColumn("lang", L.language("detect_text")).withColumn("lang_failed", F.lit(False)).drop("detect_text")
    return L.detect_with(clean, "detect_text", detector).drop("detect_text")


def route(prepared: DataFrame, lang: str = "en", bad_lines: DataFrame | None = None) -> PaperSubset:
    """Subset, quarantine and id -> title table of prepared papers."""
    subset = prepared.filter((F.col("lang") == lang) & ~F.col("lang_failed")).drop(
        "indexed_abstract", "abstract_failed", "lang_failed", "lang")
    where = ["file_idx", "line_no"]
    errors = prepared.filter("abstract_failed").select(
        F.lit("abstract").alias("error"), *where, F.col("indexed_abstract").alias("payload")
    ).unionByName(prepared.filter("lang_failed").select(
        F.lit("langdetect").alias("error"), *where, F.concat_ws(": ", "title", "abstract").alias("payload")))
    if bad_lines is not None:
        errors = errors.unionByName(bad_lines)
    return PaperSubset(subset, errors, latest_value_map(subset, "id", "title", where))


def subset_papers(
    papers: DataFrame, year: int = 1980, exclude_doc: str = "Patent", lang: str = "en", detector=None,
    bad_lines: DataFrame | None = None,
) -> PaperSubset:
    """The whole job; the prepared rows are written once because three outputs read them."""
    return route(cut_lineage(prepare(papers, year, exclude_doc, detector)), lang, bad_lines)
