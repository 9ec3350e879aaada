"""Text quality learned from trusted positives and unlabelled web text.

A linear model minimises the non-negative unbiased risk: the risk of positives, weighted by
the class prior, plus the part of the unlabelled risk that positives do not explain, which is
kept from falling under zero. The prior comes from the two samples alone: over all cuts of a
first model's scores, the smallest ratio between the shares of unlabelled and positive texts
above the cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quadrat.llm.rows import append_columns
from quadrat.session import cut_lineage

BUCKETS = 1 << 8
SAMPLE = 8000  # positives, and as many unlabelled texts: those with the smallest hash of their id
STEPS = 600
BATCH = 512
CHUNK = 1 << 20
CUT = 0.3
# Classes of characters: small letter, capital, digit, beyond ASCII; others stand for themselves.
_SHAPE = bytes(97 if 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 120 if c >= 128 else c for c in range(256))


def features(text: str | None) -> np.ndarray:
    """Shape trigrams by frequency, and shares that tell prose from lists, noise and repetition."""
    raw = (text or "").encode()
    shape = np.frombuffer(b"\n" + raw.translate(_SHAPE) + b"\n", np.uint8)
    grams = np.zeros(BUCKETS, np.float64)
    for i in range(0, max(len(shape) - 2, 0), CHUNK):
        part = shape[i:i + CHUNK + 2].astype(np.uint32)
        mixed = (part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]) * np.uint32(2654435761)
        grams += np.bincount(mixed >> np.uint32(24), minlength=BUCKETS)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, w, k = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    kinds = np.bincount(shape, minlength=256)
    mean = len(raw) / w
    extra = [
        np.log1p(len(words)), np.log1p(len(lines)), kinds[65] / n, kinds[97] / n, kinds[48] / n, kinds[120] / n, kinds[32] / n,
        1 - (kinds[65] + kinds[97] + kinds[48] + kinds[120] + kinds[32] + kinds[10]) / n, min(mean, 30) / 10, len(set(words)) / w, len(set(lines)) / k,
        min(w / k, 200) / 50, sum(x.isupper() for x in words) / w, sum(not x.isalpha() and x.isascii() for x in words) / w, float(not words),
        sum(a == b for a, b in zip(words, words[1:])) / w,
    ]
    return np.concatenate([np.sqrt(grams / n), extra]).astype(np.float32)


class Model:
    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.spread, self.weights, self.prior = mean, spread, weights, prior

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return z @ self.weights[:-1] + self.weights[-1]

    def score(self, texts: list[str | None]) -> list[tuple[float]]:
        out: list[tuple[float]] = []
        for i in range(0, len(texts), 256):
            part = np.stack([features(t) for t in texts[i:i + 256]])
            out.extend((float(p),) for p in 1 / (1 + np.exp(-np.clip(self.raw(part).astype(np.float64), -60, 60))))
        return out


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights after Adam steps on the non-negative risk with the logistic loss; ``prior`` 0 tells the samples apart instead."""
    rng = np.random.default_rng(0)
    w = np.zeros(positive.shape[1] + 1, np.float64)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = positive[rng.integers(0, len(positive), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        fp, fu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
        sp, su = 1 / (1 + np.exp(-np.clip(fp, -30, 30))), 1 / (1 + np.exp(-np.clip(fu, -30, 30)))
        # slopes of the logistic losses: as positive s - 1, as negative s
        if prior:
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            gp, gu = (prior * (sp - 1) - prior * sp, su) if negative >= 0 else (prior * sp, -su)
        else:
            gp, gu = sp - 1, su
        slope = np.append(p.T @ gp + u.T @ gu, gp.sum() + gu.sum()) / BATCH
        slope[:-1] += 5 / len(positive) * w[:-1]  # the fewer the texts, the flatter the model
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        w -= 0.02 * (1 - 0.9 * t / steps) * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of texts the first model did not see; kept between 0.05 and 0.98."""
    w = _descend(positive[::2], unlabelled[::2], 0)
    p, u = (np.sort(x[1::2] @ w[:-1] + w[-1]) for x in (positive, unlabelled))
    cuts = p[:max(len(p) // 2, 1)]  # cuts that keep at least half of the positives
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = int(((above_u + slack) / above_p).argmin())
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    both = np.concatenate([positive, unlabelled])
    mean, spread = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / spread, -8, 8) for x in (positive, unlabelled))
    prior = estimate_prior(p, u) if min(len(p), len(u)) >= 4 else 0.5
    return Model(mean, spread, _descend(p, u, prior).astype(np.float32), prior)


def fit(df: DataFrame, positives: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """Learn from at most ``sample`` trusted texts (keys in ``positives``) and ``sample`` of all texts.

    Null keys take no part; of repeated rows with one key a single one counts. The features of the bounded samples are made on the executors; the
    driver minimises the risk. Without positives there is no model.
    """
    order = [F.xxhash64(F.col("key").cast("string")), F.col("key")]
    keys = df.select(F.col(key).alias("key")).filter("key is not null")
    trusted = positives.select(F.col(key).alias("key")).filter("key is not null").distinct()
    chosen = keys.join(trusted, "key", "left_semi").distinct().orderBy(*order).limit(sample).select("key", F.lit(True).alias("positive"))
    chosen = cut_lineage(chosen.union(keys.distinct().orderBy(*order).limit(sample).select("key", F.lit(False))))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).join(chosen, "key").select("positive", "key", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([features(t).tobytes() for t in batch.column(2).to_pylist()], pa.binary())], names=["positive", "key", "x"])

    made = rows.mapInArrow(make, f"positive boolean, key {dict(rows.dtypes)['key']}, x binary").groupBy("positive", "key").agg(F.min("x").alias("x"))
    found = sorted((r["positive"], bytes(r["x"])) for r in made.select("positive", "x").collect())
    size = len(features(""))
    p, u = (np.frombuffer(b"".join(x for is_p, x in found if is_p == side), np.float32).reshape(-1, size) for side in (True, False))
    if not len(p) or not len(u):
        return None
    rng = np.random.default_rng(1)
    return train(p[rng.permutation(len(p))], u[rng.permutation(len(u))])


def score(df: DataFrame, model: Model | None, text: str = "text", cut: float = CUT) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on) from the whole text.

    A null text is scored as an empty one; without a model every score is 0.5. Columns called
    like the new ones are replaced.
    """
    if model is None:
        return append_columns(df, text, "score double, predicted int", lambda: lambda texts: [(0.5, int(0.5 >= cut)) for _ in texts])
    sent = df.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    return append_columns(df, text, "score double, predicted int", lambda: lambda texts: [(s, int(s >= cut)) for (s,) in sent.value.score(texts)])
