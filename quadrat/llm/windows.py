"""Benchmark passages in documents, found by a block shift search over words.

Patterns are runs of words. All patterns of one length are searched together: the last two
words under the search window name a block. A shift table says how far the window may move
without passing the end of a pattern; a block that ends some pattern leads to the bucket of
patterns with that ending, which are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quadrat.llm.rows import append_columns, without
from quadrat.session import cut_lineage

WORDS = 10
PATTERNS_AT_ONCE = 200_000  # (pattern, item) rows sent to the executors at a time
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words: runs of ASCII letters (lower-cased), digits and all characters beyond ASCII."""
    return (text or "").encode().translate(_PLAIN).split()


class Search:
    """All patterns of one length; ``items`` of each pattern come back with its occurrences."""

    def __init__(self, size: int, patterns: dict[tuple[bytes, ...], list]):
        self.size, self.block = size, min(2, size)
        self.far = size - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[list[bytes], list]]] = {}
        for words, items in patterns.items():
            for end in range(self.block, size + 1):
                block = b" ".join(words[end - self.block:end])
                self.shift[block] = min(self.shift.get(block, self.far), size - end)
            self.bucket.setdefault(block, []).append((list(words), items))

    def over(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """(first word, items) of every occurrence, in order."""
        size, shift, far, bucket = self.size, self.shift, self.far, self.bucket
        at, single = size - 1, self.block == 1
        while at < len(words):
            block = words[at] if single else words[at - 1] + b" " + words[at]
            move = shift.get(block, far)
            if move:
                at += move
                continue
            start = at - size + 1
            here = words[start:at + 1]
            for pattern, items in bucket[block]:
                if pattern == here:
                    yield start, items
            at += 1


def searches(rows: list[tuple[list[bytes], object]]) -> list[Search]:
    by_size: dict[int, dict[tuple[bytes, ...], list]] = {}
    for words, item in rows:
        by_size.setdefault(len(words), {}).setdefault(tuple(words), []).append(item)
    return [Search(size, patterns) for size, patterns in by_size.items()]


def scan(text: str | None, found: list[Search]) -> tuple[int, list[int], list]:
    """Number of words, hit words as [first, after last, ...] in order, and items met."""
    words = words_of(text)
    spans, items = [], set()
    for search in found:
        for start, met in search.over(words):
            spans.append((start, start + search.size))
            items.update(met)
    return len(words), merged(spans), list(items)


def merged(spans: list[tuple[int, int]]) -> list[int]:
    flat: list[int] = []
    for start, end in sorted(spans):
        if flat and start <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [start, end]
    return flat


def patterns(items: DataFrame, item: str = "item_id", text: str = "text", size: int = WORDS) -> DataFrame:
    """``(item, words)``: every run of ``size`` words of an item once, or all words of a shorter item.

    An item without words gives nothing. A null item id is an id of its own, the empty string.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(value)
                if words:
                    runs = list({b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))})
                    for i in range(0, len(runs), 10_000):
                        part = runs[i:i + 10_000]
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(part), pa.string()), pa.array(part, pa.binary())], names=["item", "words"])

    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "item string, words binary").distinct()


def _blocks(table: DataFrame, limit: int) -> list[DataFrame]:
    """The patterns in parts of about ``limit`` rows, dealt by the hash of the pattern and item."""
    table = cut_lineage(table)
    parts = -(-table.count() // limit) or 1
    if parts == 1:
        return [table]
    part = F.pmod(F.xxhash64("words", "item"), F.lit(parts))
    return [table.filter(part == k) for k in range(parts)]


def find(df: DataFrame, table: DataFrame, text: str = "text", limit: int = PATTERNS_AT_ONCE) -> DataFrame:
    """Add ``n_words``, ``spans`` and ``items`` to every row: hit words as [first, after last, ...], and the items met.

    The patterns go to the executors in parts of bounded size, usually one; each part is one
    pass over the texts. A null or empty text has no words; every row is judged by itself, so
    ties and repeated rows need no rule; an empty table stays empty, and without patterns nothing
    is hit. Very long texts are searched whole. Columns called like the new ones are replaced.
    """
    context = df.sparkSession.sparkContext
    fields = "n_words bigint, spans array<bigint>, items array<string>"
    kept = without(df, ["n_words", "spans", "items"])
    rows = kept.select(F.struct(*[f"`{c}`" for c in kept.columns]).alias("row"), F.col(text).alias("text"))
    found = None
    for part in _blocks(table, limit):
        sent = context.broadcast([(bytes(r["words"]).split(b" "), r["item"]) for r in part.toLocalIterator()])

        def make(sent=sent):
            ready = searches(sent.value)
            return lambda texts: [scan(t, ready) for t in texts]

        if found is None:
            found = append_columns(rows, "text", fields, make)
            continue
        before = cut_lineage(found.withColumnsRenamed({"spans": "spans_so_far", "items": "items_so_far"}))
        found = append_columns(before, "text", fields, make)
        found = found.select("row", "text", "n_words", _union(F.concat("spans_so_far", "spans")).alias("spans"),
                             F.array_distinct(F.concat("items_so_far", "items")).alias("items"))
    return found.select("row.*", "n_words", "spans", "items")


def _union(flat: Column) -> Column:
    """Spans [first, after last, ...] joined where they touch or overlap."""
    pairs = F.sort_array(F.transform(F.sequence(F.lit(0), (F.size(flat) / 2).cast("int") - 1), lambda i: F.struct(F.get(flat, 2 * i).alias("a"), F.get(flat, 2 * i + 1).alias("b"))))

    def add(done: Column, span: Column) -> Column:
        return F.when((F.size(done) > 0) & (span["a"] <= F.try_element_at(done, F.lit(-1))), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.greatest(F.try_element_at(done, F.lit(-1)), span["b"])))).otherwise(F.concat(done, F.array(span["a"], span["b"])))

    return F.when(F.size(flat) > 0, F.aggregate(pairs, F.array().cast("array<bigint>"), add)).otherwise(F.array().cast("array<bigint>"))


def hit_words() -> Column:
    """Number of words inside the spans."""
    return F.aggregate(F.transform(F.col("spans"), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("bigint"), lambda a, x: a + x)
