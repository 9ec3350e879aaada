"""Language identification: a function-word scorer, or an injected model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quadrat.functions.missing import ColumnLike, col, let
from quadrat.functions.text import drop_bullets, title_and_body

# Frequent function words per language (fixed values).
FUNCTION_WORDS: Mapping[str, Sequence[str]] = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "mit", "ein", "eine", "auf", "den", "von", "zu", "für", "im", "sich", "dem", "auch"),
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "are", "this", "be", "by", "at"),
    "es": ("el", "los", "las", "y", "que", "en", "un", "una", "por", "con", "para", "del", "se", "no", "es", "al", "como", "más"),
    "fr": ("le", "les", "et", "des", "du", "une", "dans", "est", "pour", "que", "qui", "sur", "au", "par", "avec", "pas", "la", "un"),
}
NO_LANGUAGE = "nan"
AT_ONCE = 256  # texts shown to a detector at once


def words(c: ColumnLike) -> Column:
    return F.split(F.lower(col(c)), r"[^\p{L}]+")


def language_scores(c: ColumnLike, profiles: Mapping[str, Sequence[str]] = FUNCTION_WORDS) -> Column:
    """(hits, language) per profile."""
    def hits(tokens: Column, listed: Sequence[str]) -> Column:
        return F.size(F.filter(tokens, lambda w: w.isin(list(listed))))

    return let(words(c), lambda tokens: F.array(*[
        F.struct(hits(tokens, listed).alias("hits"), F.lit(lang).alias("lang"))
        for lang, listed in sorted(profiles.items())
    ]))


def language(c: ColumnLike, profiles: Mapping[str, Sequence[str]] = FUNCTION_WORDS) -> Column:
    """Language with most function words; ties go to the last label, no text gives ``nan``."""
    return let(F.array_max(language_scores(F.coalesce(col(c), F.lit("")), profiles)), lambda best: F.when(
        best["hits"] == 0, NO_LANGUAGE).otherwise(best["lang"]))


def detection_text(title: ColumnLike, body: ColumnLike) -> Column:
    """The text shown to the detector, before its Unicode form is settled."""
    return drop_bullets(title_and_body(title, body))


def detect_with(
    df: DataFrame, text: str, load: Callable[[], Callable[[Sequence[str]], Sequence[str]]],
    out: str = "lang", failed: str = "lang_failed",
) -> DataFrame:
    """Run an injected detector, loaded once per worker task, over batches of at most ``AT_ONCE`` texts.

    A batch the detector rejects is halved; a text it rejects alone gets no language and a
    set failure flag. The other columns pass through as they are.
    """
    at = df.columns.index(text)

    def detected(predict: Callable[[Sequence[str]], Sequence[str]], texts: list) -> tuple[list, list]:
        langs: list = [None if t else NO_LANGUAGE for t in texts]
        bad = [False] * len(texts)
        waiting = [[i for i, t in enumerate(texts) if t]]
        while waiting:
            part = waiting.pop()
            try:
                for i, lang in zip(part, predict([texts[i] for i in part]) if part else [], strict=True):
                    langs[i] = lang
            except Exception:
                half = len(part) // 2
                if half:
                    waiting += [part[:half], part[half:]]
                else:
                    bad[part[0]] = True
        return langs, bad

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()
        for whole in batches:
            for start in range(0, whole.num_rows, AT_ONCE):  # few texts at a time exist as Python objects
                batch = whole.slice(start, AT_ONCE)
                langs, bad = detected(predict, batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(bad)], names=[*batch.schema.names, out, failed])

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType()), T.StructField(failed, T.BooleanType())])
    return df.mapInArrow(run, schema)
