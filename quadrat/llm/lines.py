"""Removal of lines repeated across documents, with two Bloom filters before the exact step.

The first pass over the texts sends 64-bit hashes of line keys, each at most twice per batch,
to the slices of two filters: a key whose bits are all set in the "once" filter is entered
into the "twice" filter. The second pass lets through only lines found in the "twice" filter;
these are counted exactly by their whole keys. A filter that is too small for its lines lets
more through and changes no result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quadrat.llm.rows import STEP, joined_rows, without
from quadrat.session import cut_lineage

SPACE = " \t\n\x0b\x0c\r"
SHORTEST = 20  # code points of a key that counts
HOLDERS = 3  # documents that make a key repeated
SLICES = 64
BITS = 1 << 27  # of one filter over all slices: 16 MiB, the size of what is broadcast
PROBES = 4
FLUSH = 1 << 18


def keys_of(text: str | None, shortest: int = SHORTEST) -> list[bytes | None]:
    """The key of each line, None where it is too short to count."""
    keys: list[bytes | None] = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip().lower()  # of bytes: ASCII space and A-Z only
        keys.append(key if len(key) >= shortest and (len(key) >= 4 * shortest or len(key.decode()) >= shortest) else None)
    return keys


def _hashes(keys: list[bytes]) -> np.ndarray:
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(k) for k in keys], np.uint64)


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers (probe by hash) within a slice of ``bits`` bits."""
    high, low = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)
    step = low | np.uint64(1)
    return np.stack([((high + np.uint64(k) * step) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(bits) for k in range(PROBES)])


def _slice(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(58)).astype(np.int64) % SLICES


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(filter_, places >> np.uint64(3), np.left_shift(1, (places & np.uint64(7)).astype(np.uint8), dtype=np.uint8))


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (filter_[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).all(axis=0).astype(bool)


def _send_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = array("Q")  # hashes, not lines: eight bytes each
    hashed = xxhash.xxh64_intdigest

    def flush() -> Iterator[pa.RecordBatch]:
        once, n = np.unique(np.array(kept, np.uint64), return_counts=True)
        slices = _slice(once)
        for s in np.unique(slices).tolist():
            own = slices == s
            h = np.concatenate([once[own], once[own & (n > 1)]])
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([h.tobytes()], pa.binary())], names=["slice", "hashes"])
        del kept[:]

    for batch in batches:
        for text in batch.column(0):
            kept.extend(map(hashed, {k for k in keys_of(text.as_py()) if k is not None}))
            if len(kept) >= FLUSH:
                yield from flush()
    if kept:
        yield from flush()


def _fill_filters(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                once, twice = filters.setdefault(s, (np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)))
                h, n = np.unique(np.frombuffer(packed, np.uint64), return_counts=True)
                places = _places(h, bits)
                again = _has(once, places) | (n > 1)
                _set(twice, places[:, again])
                _set(once, places)
        for s, (_, twice) in filters.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["slice", "twice"])

    return fill


def suspects(df: DataFrame, key: str = "key", text: str = "text", bits: int = BITS) -> DataFrame:
    """``(key, line)`` of lines whose hash the "twice" filter holds; all lines in several documents are among them."""
    sliced = df.select(text).mapInArrow(_send_hashes, "slice int, hashes binary").repartition(SLICES, "slice")
    rows = sliced.mapInArrow(_fill_filters(bits // SLICES), "slice int, twice binary").collect()  # SLICES rows of a fixed size
    sent = df.sparkSession.sparkContext.broadcast({r["slice"]: bytes(r["twice"]) for r in rows})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = {s: np.frombuffer(b, np.uint8) for s, b in sent.value.items()}
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):  # the lines of few texts exist at once
                batch = whole.slice(start, STEP)
                names = batch.column(0)
                lines, owner = [], []
                for row, value in enumerate(batch.column(1)):
                    own = {k for k in keys_of(value.as_py()) if k is not None}
                    lines.extend(own)
                    owner.extend([row] * len(own))
                h = _hashes(lines)
                slices, found = _slice(h), np.zeros(len(h), bool)
                for s in np.unique(slices).tolist():
                    at = np.flatnonzero(slices == s)
                    found[at] = _has(twice[s], _places(h[at], bits // SLICES))
                at = np.flatnonzero(found).tolist()
                yield pa.RecordBatch.from_arrays([names.take(pa.array([owner[i] for i in at], pa.int64())), pa.array([lines[i] for i in at], pa.binary())], names=["key", "line"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("key is not null")
    return rows.mapInArrow(probe, f"key {dict(rows.dtypes)['key']}, line binary")


def _keep(text: str | None, dropped: list[bytes] | None) -> tuple[int, int, str]:
    text = text or ""
    if not dropped:
        return text.count("\n") + 1, 0, text
    gone, lines = set(dropped), text.split("\n")
    kept = [line for line, k in zip(lines, keys_of(text)) if k not in gone]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", holders: int = HOLDERS, bits: int = BITS) -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` and ``kept``, the text without its repeated lines.

    A line counts if its key (space stripped, A-Z lower-cased) has 20 code points or more. Where
    ``holders`` or more keys of documents hold it, only the largest one keeps its lines. A null
    or empty text is one empty line. A repeated row counts once, and each copy is treated
    alike; rows with a null key are neither counted nor changed. Columns called like the new
    ones are replaced.
    """
    df = without(df, ["n_lines", "n_dropped", "kept"])
    lines = cut_lineage(suspects(df, key, text, bits).distinct())
    repeated = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("owner")).filter(F.col("n") >= holders)
    dropped = lines.join(repeated.select("line", "owner"), "line").filter("key <> owner").groupBy(F.col("key").alias("of")).agg(F.collect_list("line").alias("dropped"))
    return joined_rows(df, key, text, dropped, "dropped", "n_lines bigint, n_dropped bigint, kept string", _keep)
