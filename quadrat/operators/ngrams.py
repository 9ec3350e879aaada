"""Language identification by hashed character trigrams, in two levels: script, then language.

The model is a table of integer weights learned from a labelled table (naive Bayes, add-one
smoothing, thousandths of a natural logarithm), so that a score is an exact sum. Counting is
one pass with partial sums per batch; the shuffle carries one row per task, language and
bucket. Scoring sends the weights, ``BUCKETS`` numbers for each language, to the executors
and adds them up by whole Arrow batches. Any number of languages can be learned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quadrat.functions.language import NO_LANGUAGE

BUCKETS = 1 << 16
STEP = 1 << 20  # code points of a text weighed at once
DEFAULT = -1  # bucket that holds a language's weight of trigrams it was not seen with

# First code point, last code point, script. Letters elsewhere count as "other".
SCRIPTS = (
    (0x41, 0x5A, "latin"), (0x61, 0x7A, "latin"), (0xC0, 0xD6, "latin"), (0xD8, 0xF6, "latin"), (0xF8, 0x24F, "latin"), (0x1E00, 0x1EFF, "latin"),
    (0x370, 0x3FF, "greek"), (0x1F00, 0x1FFF, "greek"), (0x400, 0x52F, "cyrillic"), (0x531, 0x58F, "armenian"), (0x5D0, 0x5F4, "hebrew"),
    (0x620, 0x6FF, "arabic"), (0x750, 0x77F, "arabic"), (0x900, 0x97F, "devanagari"), (0x980, 0x9FF, "bengali"), (0xB80, 0xBFF, "tamil"),
    (0xE00, 0xE7F, "thai"), (0x10A0, 0x10FF, "georgian"), (0x3040, 0x30FF, "kana"), (0x3400, 0x4DBF, "han"), (0x4E00, 0x9FFF, "han"), (0xAC00, 0xD7A3, "hangul"),
)
_NAMES = sorted({name for _, _, name in SCRIPTS})


def code_points(text: str) -> np.ndarray:
    """Code points with A-Z lower-cased."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").copy()
    points[(points >= 65) & (points <= 90)] += 32
    return points


def buckets_of(points: np.ndarray) -> np.ndarray:
    """Bucket of every trigram, overlapping ones included."""
    if len(points) < 3:
        return np.zeros(0, np.int64)
    return ((points[:-2] * np.uint32(961) + points[1:-1] * np.uint32(31) + points[2:]) % np.uint32(BUCKETS)).astype(np.int64)


def script_of(points: np.ndarray) -> str | None:
    """Script with most letters, the last name among equals; None without letters of the listed scripts."""
    first = np.array([s[0] for s in SCRIPTS])
    order = np.argsort(first)
    at = np.searchsorted(first[order], points, side="right") - 1
    listed = order[np.maximum(at, 0)]
    inside = (at >= 0) & (points <= np.array([s[1] for s in SCRIPTS])[listed])
    n = np.bincount(np.array([_NAMES.index(s[2]) for s in SCRIPTS])[listed[inside]], minlength=len(_NAMES))
    best = n.max()
    return None if best == 0 else _NAMES[int(np.flatnonzero(n == best)[-1])]


def fit(df: DataFrame, label: str, text: str) -> DataFrame:
    """The model ``(script, lang, bucket, weight)`` of a labelled table.

    Rows without label, text or letters teach nothing. Each language has one row more, for
    bucket ``DEFAULT``, in each script it was seen in.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                points = code_points(value)
                script = script_of(points)
                if script is not None:
                    own = seen.setdefault((script, lang), np.zeros(BUCKETS, np.int64))
                    for at in range(0, len(points), STEP):
                        own += np.bincount(buckets_of(points[at:at + STEP + 2]), minlength=BUCKETS)
        for (script, lang), n in seen.items():
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([script] * len(met)), pa.array([lang] * len(met)), pa.array(met.astype(np.int32)), pa.array(n[met])], names=["script", "lang", "bucket", "n"])

    labelled = df.select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    counts = labelled.mapInArrow(count, "script string, lang string, bucket int, n bigint").groupBy("script", "lang", "bucket").agg(F.sum("n").alias("n"))
    size = counts.groupBy("script", "lang").agg(F.sum("n").alias("size"))
    every = counts.unionByName(size.select("script", "lang", F.lit(DEFAULT).alias("bucket"), F.lit(0).cast("bigint").alias("n")))
    weight = F.floor(F.ln((F.col("n") + 1).cast("double") / (F.col("size") + BUCKETS).cast("double")) * 1000 + 0.5)
    return every.join(size, ["script", "lang"]).select("script", "lang", "bucket", weight.cast("int").alias("weight"))


class Scorer:
    """Weights by script: languages in order, and one row of numbers for each."""

    def __init__(self, model: DataFrame):
        found: dict[str, dict[str, np.ndarray]] = {}
        for batch in model.orderBy("script", "lang", "bucket").select("script", "lang", "bucket", "weight").toArrow().to_batches():  # BUCKETS + 1 rows for each language at most
            script, lang, bucket, weight = (c.to_pylist() for c in batch.columns)
            for s, name, b, w in zip(script, lang, bucket, weight):
                own = found.setdefault(s, {}).setdefault(name, np.zeros(BUCKETS, np.int32))
                if b == DEFAULT:
                    own[:] = w
                else:
                    own[b] = w
        self.by_script = {s: (sorted(own), np.stack([own[name] for name in sorted(own)])) for s, own in found.items()}

    def best(self, text: str | None) -> tuple[str, str | None, int | None]:
        """Language, script, and by how much the language leads; ties go to the last name."""
        points = code_points(text or "")
        script = script_of(points) if len(points) else None
        if script not in self.by_script:
            return NO_LANGUAGE, script, None
        names, weights = self.by_script[script]
        score = np.zeros(len(names), np.int64)
        for at in range(0, len(points), STEP):
            met, n = np.unique(buckets_of(points[at:at + STEP + 2]), return_counts=True)
            score += (weights[:, met].astype(np.int64) * n).sum(axis=1)
        first = int(np.flatnonzero(score == score.max())[-1])
        second = np.delete(score, first)
        return names[first], script, int(score[first] - second.max()) if len(second) else None


def predict(df: DataFrame, model: DataFrame, text: str = "text", lang: str = "detected", script: str = "script", lead: str = "lead") -> DataFrame:
    """Add the language, the script and the lead over the next language of the script.

    A text without letters of a learned script has language ``nan`` and no lead; null counts as
    empty. Whole texts are weighed. Columns called like the new ones are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(Scorer(model))
    new = [lang, script, lead]
    kept = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in {n.lower() for n in new}])
    schema = T.StructType([*kept.schema.fields, T.StructField(lang, T.StringType()), T.StructField(script, T.StringType()), T.StructField(lead, T.LongType())])
    at = kept.columns.index(text)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                found = [scorer.best(t) for t in batch.column(at).to_pylist()]
                columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *new])

    return kept.mapInArrow(step, schema)


def detector(model: DataFrame) -> Callable[[], Callable[[Sequence[str]], Sequence[str]]]:
    """The model as a loader for :func:`quadrat.functions.language.detect_with`."""
    sent = model.sparkSession.sparkContext.broadcast(Scorer(model))

    def load() -> Callable[[Sequence[str]], Sequence[str]]:
        scorer = sent.value
        return lambda texts: [scorer.best(t)[0] for t in texts]

    return load
