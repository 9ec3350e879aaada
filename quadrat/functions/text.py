"""Text cleaning as column expressions; the two Arrow functions wrap standard-library
code for which Spark has no built-in (Unicode normal forms, markup removal)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quadrat.functions.missing import ColumnLike, col

# Organisation abbreviations dropped from names (fixed values).
ORG_ABBREVIATIONS = ("pvt", "ltd", "inc", "lc", "llc", "pc", "corp", "co")
# Answers that stand for an empty name (fixed values).
PLACEHOLDERS = ("other", "not mentioned")


def squeeze(c: ColumnLike) -> Column:
    """Collapse any Unicode white space to one blank and trim."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def _once(function):
    """Keep filters from being pushed through (and so repeating) an Arrow function."""
    return function.asNondeterministic()


def normalise(form: str):
    """Unicode normal form as an Arrow function."""
    @F.pandas_udf(T.StringType())
    def _normalise(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    return _once(_normalise)


def with_normal_form(df: DataFrame, c: str, form: str) -> DataFrame:
    """Replace a column by its Unicode normal form, as a step that expressions on it cannot be moved into."""
    at = df.columns.index(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pc.utf8_normalize(columns[at], form=form)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


class _TextOnly(HTMLParser):
    """Collects character data outside script and style elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


def strip_markup(text: str | None) -> str | None:
    """Text of a markup fragment; text without markup or entities is returned as is."""
    if text is None or ("<" not in text and "&" not in text):
        return text
    parser = _TextOnly()
    parser.feed(text)
    parser.close()
    return "".join(parser.parts)


@_once
@F.pandas_udf(T.StringType())
def html_text(s: pd.Series) -> pd.Series:
    return s.map(strip_markup)


@_once
@F.pandas_udf(T.StringType())
def decomposed_text(s: pd.Series) -> pd.Series:
    """Compatibility decomposition, then markup removal, in one Arrow pass."""
    return s.map(lambda t: None if t is None else strip_markup(unicodedata.normalize("NFKD", t)))


def drop_bullets(c: ColumnLike) -> Column:
    return F.replace(col(c), F.lit("•"), F.lit(""))


def keep_letters(c: ColumnLike) -> Column:
    """Every run of other characters than ASCII letters and hyphens becomes a blank."""
    return F.regexp_replace(col(c), r"[^A-Za-z\-]+", " ")


def keep_name_characters(c: ColumnLike) -> Column:
    return F.regexp_replace(col(c), r"[^A-Za-z.,'+&()\-/:;]+", " ")


def sentence_marks(c: ColumnLike) -> Column:
    """Runs of exclamation or question marks end a sentence."""
    return F.regexp_replace(F.regexp_replace(col(c), r"!+", ". "), r"\?+", ". ")


def space_after_comma(c: ColumnLike) -> Column:
    return F.regexp_replace(col(c), ",", ", ")


def collapse_dots(c: ColumnLike) -> Column:
    """Single pass over ``. .`` pairs and dot runs."""
    return F.regexp_replace(col(c), r"(\.\s+\.|\.+)", ".")


def word_pattern(words: Sequence[str]) -> str:
    """Case-insensitive whole-word alternation with its trailing blanks."""
    return r"(?i)\b(" + "|".join(re.escape(w) for w in words) + r")\b\s*"


def drop_words(c: ColumnLike, words: Sequence[str]) -> Column:
    """Replace each listed word and the blanks behind it by one blank."""
    return F.regexp_replace(col(c), word_pattern(words), " ") if words else col(c)


def english_stopwords() -> list[str]:
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")


def clean_place(c: ColumnLike) -> Column:
    """Place name reduced to letters, hyphens and single blanks; nothing left is missing."""
    return F.nullif(squeeze(keep_letters(squeeze(c))), F.lit(""))


def drop_placeholder(c: ColumnLike) -> Column:
    text = F.coalesce(col(c), F.lit(""))
    return F.when(F.lower(text).isin(list(PLACEHOLDERS)), "").otherwise(text)


def join_name_parts(*parts: ColumnLike) -> Column:
    """Sentences joined, dots collapsed; a lone dot is empty."""
    joined = F.concat_ws(". ", *[F.coalesce(col(p), F.lit("")) for p in parts])
    text = squeeze(collapse_dots(joined))
    return F.when(text == ".", "").otherwise(text)


def title_and_body(title: ColumnLike, body: ColumnLike) -> Column:
    """``title: body`` without the colon left over when one part is empty."""
    text = F.concat(F.coalesce(col(title), F.lit("")), F.lit(": "), F.coalesce(col(body), F.lit("")))
    return F.trim(F.btrim(F.trim(text), F.lit(":")))


def prefixed(c: ColumnLike, prefix: str) -> Column:
    return F.concat(F.lit(prefix + " "), col(c), F.lit("."))


def join_components(columns: Sequence[ColumnLike], sep: str) -> Column:
    """Components joined by a separator, blanks squeezed."""
    return squeeze(F.concat_ws(sep, *[col(c) for c in columns]))


def first_tokens(c: ColumnLike, n: int) -> Column:
    """The first ``n`` blank-separated tokens (the model input limit)."""
    return F.array_join(F.slice(F.split(squeeze(c), " "), 1, n), " ")


def render_prompt(template: str, **fields: ColumnLike) -> Column:
    """Fill ``{name}`` slots of a template with trimmed columns."""
    pieces = []
    for piece in re.split(r"(\{\w+\})", template):
        slot = piece[1:-1] if piece.startswith("{") and piece.endswith("}") else None
        pieces.append(F.trim(col(fields[slot])) if slot in fields else F.lit(piece))
    return F.concat(*[p for p in pieces])


def query_string(params: dict[str, ColumnLike]) -> Column:
    """Form-encoded ``key=value`` pairs in the given order."""
    return F.concat_ws("&", *[
        F.concat(F.url_encode(F.lit(k)), F.lit("="), F.url_encode(col(v).cast("string")))
        for k, v in params.items()
    ])


def reformat_date(c: ColumnLike, source: str = "dd-MM-yyyy", target: str = "dd-MMM-yyyy") -> Column:
    return F.date_format(F.to_date(col(c), source), target)


def capture(c: ColumnLike, pattern: str, group: int, fallback: ColumnLike | None = None) -> Column:
    """Regex group; where it does not match, try ``fallback`` with line breaks and tabs removed."""
    found = F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))
    if fallback is None:
        return found
    flat = F.translate(col(fallback), "\n\t\r", "")
    return F.coalesce(found, F.nullif(F.regexp_extract(flat, pattern, group), F.lit("")))
