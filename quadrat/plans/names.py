"""Name and description cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quadrat.functions import text as X
from quadrat.operators.substitute import remove_places, substitute_by_table
from quadrat.session import fan_out


def clean_text(
    df: DataFrame, key: str, c: str | Sequence[str], out: str | Sequence[str], places: DataFrame, phrases: DataFrame, words: DataFrame,
    stopwords: Sequence[str] | None = None,
) -> DataFrame:
    """Add the cleaned text of ``c``; the order of the steps is part of the result.

    Markup and Unicode first, then character classes, stopwords, places, organisation
    abbreviations, and at last the phrase and the word dictionary. Several texts of a row go
    through each list together.
    """
    given, outs = ([c], [out]) if isinstance(c, str) else (list(c), list(out))
    stop = X.english_stopwords() if stopwords is None else stopwords

    def rough(name: str) -> Column:
        text = X.squeeze(F.coalesce(X.decomposed_text(F.col(name)), F.lit("")))
        return X.squeeze(X.drop_words(X.space_after_comma(X.keep_name_characters(X.sentence_marks(text))), stop))

    step = df.withColumns({o: rough(g) for g, o in zip(given, outs)})
    step = remove_places(step, key, outs, places, outs)
    step = step.withColumns({o: X.squeeze(X.collapse_dots(X.drop_words(o, X.ORG_ABBREVIATIONS))) for o in outs})
    step = substitute_by_table(step, key, outs, phrases, outs)
    step = substitute_by_table(step, key, outs, words, outs)
    return step.withColumns({o: X.squeeze(X.collapse_dots(o)) for o in outs})


def clean_names(
    df: DataFrame, key: str, name: str, description: str, places: DataFrame, phrases: DataFrame, words: DataFrame,
    stopwords: Sequence[str] | None = None,
) -> DataFrame:
    """(key, nameDesc_clean): both texts cleaned, placeholders dropped, joined."""
    both = (name, description)
    rows = clean_text(fan_out(df.select(key, *both)), key, both, [f"{c}_clean" for c in both], places, phrases, words, stopwords)
    parts = [X.drop_placeholder(f"{c}_clean") for c in (name, description)]
    return rows.select(key, X.join_name_parts(*parts).alias("nameDesc_clean"))
