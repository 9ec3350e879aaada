"""Passages repeated across documents, by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the top bits of the hash of
the last 16 bytes are zero. Boundaries depend on those bytes alone, so text inserted before
a passage moves none of the boundaries inside it. Two neighbouring chunks together are
compared by 64-bit digest, so that whatever counts as known stands in line somewhere else, and
only a run of such pairs, each overlapping the next by a chunk, with enough words is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quadrat.llm.rows import joined_rows, without
from quadrat.session import cut_lineage

WINDOW = 16  # bytes that decide on a boundary
CUT_BITS = 5  # a boundary every 32 bytes on average
RUN_WORDS = 15  # words of the shortest run that is a passage
LONG, UNIT = 30, 6  # code points of the longest single word; a longer piece without a blank counts a word for every UNIT
BLOCK = 1 << 20
_GEAR = np.random.default_rng(20).integers(0, 1 << 16, 256).astype(np.uint16)


def ends(raw: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text; none falls inside a character."""
    codes = np.frombuffer(raw, np.uint8)
    found = []
    for at in range(0, len(codes), BLOCK):
        part = codes[max(0, at - WINDOW + 1):at + BLOCK]
        h, width = _GEAR[part], 1
        while width < WINDOW:  # h of 1, 2, 4 ... bytes
            older = np.zeros_like(h)
            older[width:] = h[:-width]
            h, width = h + (older << np.uint16(width)), 2 * width
        places = np.flatnonzero(h >> np.uint16(16 - CUT_BITS) == 0) + max(0, at - WINDOW + 1) + 1
        found.extend(places[places > at].tolist())
    return [e for e in found if e < len(raw) and raw[e] & 0xC0 != 0x80] + ([len(raw)] if raw else [])


def chunks(raw: bytes) -> tuple[list[int], list[int]]:
    """Chunk ends, and signed 64-bit digests of every two neighbours (of the only chunk, if there is one)."""
    stops = ends(raw)
    starts = [0, *stops]
    digests = [xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(starts, stops[1:] or stops)]
    return stops, np.array(digests, np.uint64).view(np.int64).tolist()


def _words(part: bytes) -> int:
    """Words of a run; scripts without blanks, minified code and encoded blocks are counted by their length."""
    return sum(1 if len(w) <= LONG or (n := len(w.decode())) <= LONG else n // UNIT for w in part.split())


def runs(stops: list[int], digests: list[int], known: set[int]) -> list[tuple[int, int]]:
    """Chunks [first, after last) of every run of known pairs; pairs overlap, so two runs may share no chunk but touch."""
    found, first, width = [], None, 2 if len(stops) > 1 else 1
    for i, d in enumerate([*digests, None]):
        if d is not None and d in known:
            first = i if first is None else first
        elif first is not None:
            found.append((first, i - 1 + width))
            first = None
    return [(a if k == 0 else max(a, found[k - 1][1]), b) for k, (a, b) in enumerate(found)]


def _drop(text: str | None, known: list[int] | None) -> tuple[int, int, int, str]:
    raw = (text or "").encode()
    stops, digests = chunks(raw)
    kept, at, n, passages = [], 0, 0, 0
    for a, b in runs(stops, digests, set(known)) if known else []:
        start, end = stops[a - 1] if a else 0, stops[b - 1]
        if _words(raw[start:end]) >= RUN_WORDS:
            kept.append(raw[at:start])
            at, n, passages = end, n + b - a, passages + 1
    return len(stops), n, passages, b"".join([*kept, raw[at:]]).decode()


def drop_repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``n_chunks``, ``n_dropped``, ``n_passages`` and ``kept``, the text without passages that a smaller key has.

    A null text is empty and has no chunks. Repetition within one text is left alone, repeated
    rows of one key do not count against each other, and rows with a null key are neither
    counted nor changed. Columns called like the new ones are replaced.
    """
    df = without(df, ["n_chunks", "n_dropped", "n_passages", "kept"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                owner, found = [], []
                for row, value in enumerate(batch.column(1).to_pylist()):
                    own = set(chunks((value or "").encode())[1])
                    found.extend(own)
                    owner.extend([row] * len(own))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array(found, pa.int64())], names=["key", "digest"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter("key is not null")
    sent = cut_lineage(rows.mapInArrow(send, f"key {dict(rows.dtypes)['key']}, digest bigint"))
    shared = sent.groupBy("digest").agg(F.min("key").alias("owner"), F.max("key").alias("last")).filter("owner <> last").select("digest", "owner")
    known = sent.join(shared, "digest").filter("key <> owner").groupBy("key").agg(F.collect_set("digest").alias("known"))
    return joined_rows(df, key, text, known.withColumnRenamed("key", "of"), "known", "n_chunks bigint, n_dropped bigint, n_passages bigint, kept string", _drop)
