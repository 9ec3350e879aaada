"""Language identification by the nearest of several centroids per language.

A text is the normalised TF-IDF vector of the runs of three bytes of its lower-cased words,
counted in hashed buckets. Training vectors of a language are clustered on the sphere; a text
gets the language of the centroid with the greatest cosine, and is rejected where even that
one is so far away that hardly a training text of this language and length is as far from its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quadrat.llm.rows import append_columns
from quadrat.session import cut_lineage

BUCKETS = 1 << 13
CLUSTERS = 3
SAMPLE = 600  # training texts of a language, the ones with the smallest hash of their id
HANDS = 16  # groups of tasks whose samples are cut down before they meet
ROUNDS = 12
CHUNK = 1 << 20  # bytes counted at once
AT_ONCE = 128  # texts whose counts exist at once
FLOOR = 0.03  # cosine under which a text of any length has next to nothing in common with any language
JUDGED = 7  # from 2^7 trigrams on the training texts of similar length set the floor; the cosine of a shorter text says too little
LOW, PART = 0.01, 0.5  # the floor is this part of this quantile of their cosines
LEAST, MANY = 20, 200  # taken from half of the texts of a language, but no fewer than the one and no more than the other if they suffice
BANDS = 40
UNKNOWN = "und"
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def counts(text: str | None) -> np.ndarray | None:
    """Bucket counts of a whole text, None if it has no letter."""
    if not text or not any(map(str.isalpha, text[:64])) and not any(map(str.isalpha, text)):
        return None
    plain = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    total = np.zeros(BUCKETS, np.int64)
    codes = np.frombuffer(plain, np.uint8)
    for i in range(0, max(len(codes) - 2, 0), CHUNK):
        part = codes[i:i + CHUNK + 2].astype(np.uint32)
        grams = (part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]) * np.uint32(2654435761)
        total += np.bincount(grams >> np.uint32(19), minlength=BUCKETS)
    return total


def unit(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf)
    v *= idf
    v = v.astype(np.float32, copy=False)
    size = np.sqrt((v * v).sum(axis=-1, keepdims=True))
    v /= np.where(size > 0, size, 1)
    return v


def cluster(vectors: np.ndarray, k: int = CLUSTERS) -> np.ndarray:
    """Spherical k-means; starts from the text nearest the mean, then the farthest from those chosen."""
    centre = vectors.mean(axis=0)
    chosen = [int((vectors @ centre).argmax())]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centres = vectors[chosen]
    for _ in range(ROUNDS):
        own = (vectors @ centres.T).argmax(axis=1)
        means = np.stack([vectors[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


def band(tf: np.ndarray) -> np.ndarray:
    """Powers of two in the number of trigrams of each row."""
    return np.minimum(np.log2(np.maximum(tf.sum(axis=-1, dtype=np.float64), 1)).astype(np.int64), BANDS - 1)


def floors(bands: np.ndarray, cosines: np.ndarray) -> np.ndarray:
    """The least accepted cosine of each band of lengths, from the training texts of one language and their cosines.

    A band takes its neighbours too, and still shorter ones until there are enough texts: the cosine
    rises with the length, so shorter texts never make a floor too strict.
    """
    out, enough = np.full(BANDS, FLOOR), max(LEAST, min(MANY, len(bands) // 2))
    for b in range(JUDGED, BANDS):
        for low in range(b - 1, JUDGED - 2, -1):
            near = cosines[(bands >= low) & (bands <= b + 1)]
            if len(near) >= (enough if low > JUDGED - 1 else LEAST):
                out[b] = max(FLOOR, PART * float(np.quantile(near, LOW)))
                break
    return out


class Model:
    def __init__(self, idf: np.ndarray, names: list[str], centres: np.ndarray, least: np.ndarray):
        self.idf, self.names, self.centres, self.least = idf, names, centres, least  # least: a row of floors per centroid

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        out: list[tuple[str, float, bool]] = []
        for i in range(0, len(texts), AT_ONCE):
            found = [counts(t) for t in texts[i:i + AT_ONCE]]
            some = [c for c in found if c is not None]
            if not some or not self.names:
                out.extend((UNKNOWN, 0.0, True) for _ in found)
                continue
            tf = np.stack(some)
            near = unit(tf, self.idf) @ self.centres.T
            best, rows = near.argmax(axis=1), iter(range(len(some)))
            least = self.least[best, band(tf)]
            for c in found:
                if c is None:
                    out.append((UNKNOWN, 0.0, True))
                else:
                    r = next(rows)
                    score = float(min(max(near[r, best[r]], 0.0), 1.0))
                    out.append((self.names[best[r]], score, bool(score < least[r])))
        return out


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, counts) of the texts with a letter, few at a time."""
    for whole in batches:
        for start in range(0, whole.num_rows, AT_ONCE):
            batch = whole.slice(start, AT_ONCE)
            found = [(i, c.astype(np.float32).tobytes()) for i, t in enumerate(batch.column(2).to_pylist()) if (c := counts(t)) is not None]
            at = pa.array([i for i, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([c for _, c in found], pa.binary())], names=["lang", "key", "tf"])


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` texts of each language; rows without language, key or letters are passed over.

    Of repeated rows with one key and language a single one counts. Vectors are clustered on the
    executors, one bounded group per language; the driver gets document frequencies and centroids.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("key is not null and lang is not null and text rlike '\\\\p{L}'")
    picked = rows.select("lang", "key").distinct()  # places are for texts, not for their repeated rows
    picked = picked.withColumn("hand", F.pmod(F.spark_partition_id(), F.lit(HANDS)))
    for by in (["lang", "hand"], ["lang"]):  # however many tasks there are, the last step sees at most HANDS samples of a language
        order = W.partitionBy(*by).orderBy(F.xxhash64(F.col("key").cast("string")), "key")
        picked = picked.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample).drop("place")
    picked = picked.select("lang", "key")
    picked = cut_lineage(picked)  # small and of known size, so that no text is shuffled to meet it
    chosen = rows.join(picked, ["lang", "key"], "left_semi").select("lang", "key", "text")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for tf in batch.column(1):
                n += 1
                total += np.frombuffer(tf.as_buffer(), np.float32) > 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["n", "df"])

    made = chosen.mapInArrow(_vectors, f"lang string, key {dict(rows.dtypes)['key']}, tf binary")
    table = cut_lineage(made.groupBy("lang", "key").agg(F.min("tf").alias("tf")).select("lang", "tf"))
    parts = table.coalesce(8).mapInArrow(frequencies, "n bigint, df binary").collect()  # at most eight rows
    n = sum(r["n"] for r in parts)
    seen = sum((np.frombuffer(r["df"], np.int64) for r in parts), np.zeros(BUCKETS, np.int64))
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    def centroids(group: pa.Table) -> pa.Table:
        packed = group.column("tf")
        vectors = np.empty((len(packed), BUCKETS), np.float32)
        for row, i in enumerate(pc.sort_indices(packed).to_pylist()):  # one order, one outcome
            vectors[row] = np.frombuffer(packed[i].as_buffer(), np.float32)
        bands = band(vectors)
        for i in range(0, len(vectors), AT_ONCE):  # vectors take the place of their counts
            vectors[i:i + AT_ONCE] = unit(vectors[i:i + AT_ONCE], idf)
        centres = cluster(vectors)
        least = floors(bands, (vectors @ centres.T).max(axis=1)).tobytes()
        return pa.table({"lang": pa.array([group.column("lang")[0].as_py()] * len(centres), pa.string()),
                         "centre": pa.array([c.tobytes() for c in centres], pa.binary()), "least": pa.array([least] * len(centres), pa.binary())})

    found = table.groupBy("lang").applyInArrow(centroids, "lang string, centre binary, least binary").collect()  # a few rows per language
    found.sort(key=lambda r: (r["lang"], bytes(r["centre"])))
    centres = np.stack([np.frombuffer(r["centre"], np.float32) for r in found]) if found else np.zeros((0, BUCKETS), np.float32)
    least = np.stack([np.frombuffer(r["least"], np.float64) for r in found]) if found else np.zeros((0, BANDS))
    return Model(idf, [r["lang"] for r in found], centres, least)


def held_out(key: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine) and ``rejected`` from the whole text.

    A null text, or one without a letter, is ``und`` with score 0 and rejected. Columns called
    like the new ones are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # buckets times centroids, whatever the corpus
    return append_columns(df, text, "lang_pred string, score double, rejected boolean", lambda: sent.value.predict)
