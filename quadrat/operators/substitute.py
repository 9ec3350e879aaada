"""Simultaneous term substitution and gazetteer removal.

An automaton over all terms finds the ones a text can contain, and the text is rewritten
with these few. Terms go to the executors in parts of bounded size, usually one; each part
is one pass over the texts, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quadrat.functions.text import clean_place
from quadrat.session import cut_lineage, fan_out

# Terms sent to the executors at a time.
TERMS_AT_ONCE = 200_000


def substitution_table(cells: DataFrame, row: str = "row_no", items: str = "cells") -> DataFrame:
    """Rows of ``[canonical, variant, ...]`` -> (variant, canonical, rank); a later row wins.

    ``rank`` keeps the place where a variant was first listed: it decides which of two
    overlapping variants is tried first.
    """
    listed = (
        cells.withColumn("cells", F.filter(items, lambda x: x.isNotNull() & (x != "")))
        .select(F.col(row).alias("row"), F.col("cells")[0].alias("canonical"),
                F.posexplode(F.slice("cells", F.lit(2), F.size("cells"))).alias("place", "variant"))
        .withColumn("at", F.struct("row", "place"))
    )
    return listed.groupBy(F.lower("variant").alias("variant")).agg(
        F.max_by("canonical", "at").alias("canonical"), F.min("at").alias("rank")
    )


def _rewrite(text: Column, pattern: Column, table: Column) -> Column:
    """The text between the matches and, for each match, what the table has for it."""
    between, met = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(1))
    return F.array_join(F.zip_with(between, met, lambda x, m: F.concat(x, F.coalesce(F.try_element_at(table, F.lower(m)), m, F.lit("")))), "")


def _parts(terms: DataFrame, limit: int) -> list[DataFrame]:
    terms = cut_lineage(terms)
    n = -(-terms.count() // limit)
    return [terms] if n == 1 else [terms.filter(F.pmod(F.xxhash64(*terms.columns), F.lit(n)) == k) for k in range(n)]


def _listed(c: str | Sequence[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def with_terms(df: DataFrame, text: str | Sequence[str], terms: DataFrame, out: str | Sequence[str], limit: int | None = None) -> DataFrame:
    """Add ``out``: an array of the rows of ``terms`` whose first column occurs in the text, in any case of A-Z.

    A term occurs wherever its characters do; whether it stands as a whole word is left to the
    pattern built from it. A null text has none. Several texts of a row (with as many names in
    ``out``) are searched in the same pass, by one automaton.
    """
    texts, outs = _listed(text), _listed(out)
    kind = T.ArrayType(terms.schema)
    done = df.withColumns({o: F.array().cast(kind) for o in outs})
    for part in _parts(terms, limit or TERMS_AT_ONCE):
        sent = df.sparkSession.sparkContext.broadcast([r.asDict(recursive=True) for r in part.toLocalIterator()])
        done = done.mapInArrow(_finder(done, texts, terms.columns[0], outs, sent), done.schema)
    return done


def _finder(df: DataFrame, texts: list[str], term_name: str, outs: list[str], sent):
    places = [(df.columns.index(t), df.columns.index(o)) for t, o in zip(texts, outs)]
    field = to_arrow_schema(T.StructType([df.schema[outs[0]]]))[0].type

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        rows = sent.value
        automaton = ahocorasick.Automaton()
        by_term: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            if r[term_name]:
                by_term.setdefault(_plain(r[term_name]), []).append(i)
        for term, own in by_term.items():
            automaton.add_word(term, own)
        automaton.make_automaton()
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                columns = list(batch.columns)
                for at, to in places:
                    met = []
                    for value, before in zip(batch.column(at).to_pylist(), batch.column(to).to_pylist()):
                        hits = {i for _, own in automaton.iter(_plain(value)) for i in own} if value and by_term else ()
                        met.append(before + [rows[i] for i in sorted(hits)])
                    columns[to] = pa.array(met, field)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return find


def _plain(text: str) -> str:
    """A-Z lower-cased and nothing else, as in a case-insensitive pattern."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def _quoted(term: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(term, F.lit(r"\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E"))


def substitute_by_table(df: DataFrame, key: str, text: str | Sequence[str], table: DataFrame, out: str | Sequence[str]) -> DataFrame:
    """Replace whole-word variants (any case) in one pass; replacements are not rescanned."""
    texts, outs = _listed(text), _listed(out)
    hit = [f"__hits{i}" for i in range(len(texts))]
    found = with_terms(fan_out(df), texts, table.select("variant", "canonical", "rank"), hit)

    def changed(t: str, h: str) -> Column:
        hits = F.array_sort(F.transform(h, lambda x: F.struct(x["rank"].alias("rank"), x["variant"].alias("variant"), x["canonical"].alias("canonical"))))
        pattern = F.concat(F.lit(r"(?i)\b("), F.array_join(F.transform(hits, lambda x: _quoted(x["variant"])), "|"), F.lit(r")\b"))
        lookup = F.map_from_entries(F.transform(hits, lambda x: F.struct(x["variant"], x["canonical"])))
        return F.when(F.size(h) > 0, _rewrite(F.col(t), pattern, lookup)).otherwise(F.col(t))

    return found.withColumns({o: changed(t, h) for t, o, h in zip(texts, outs, hit)}).drop(*hit)


def cleaned_places(places: DataFrame, c: str) -> DataFrame:
    """Distinct cleaned place names."""
    return places.select(clean_place(c).alias("place")).filter("place is not null").distinct()


def remove_places(df: DataFrame, key: str, text: str | Sequence[str], places: DataFrame, out: str | Sequence[str]) -> DataFrame:
    """Remove every listed place name from the text, of nested names the longer one first."""
    texts, outs = _listed(text), _listed(out)
    hit = [f"__hits{i}" for i in range(len(texts))]
    found = with_terms(fan_out(df), texts, places.select("place").distinct(), hit)

    def changed(t: str, h: str) -> Column:
        longest = F.array_sort(F.transform(h, lambda x: F.struct((-F.length(x["place"])).alias("n"), x["place"].alias("place"))))
        pattern = F.concat(F.lit(r"(?i)\b("), F.array_join(F.transform(longest, lambda x: _quoted(x["place"])), "|"), F.lit(r")\b\s*"))
        return F.when(F.size(h) > 0, F.regexp_replace(F.col(t), pattern, F.lit(" "))).otherwise(F.col(t))

    return found.withColumns({o: changed(t, h) for t, o, h in zip(texts, outs, hit)}).drop(*hit)
