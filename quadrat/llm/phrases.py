"""Collocations of two to four words by Toivonen's sampling algorithm.

A sample of the documents proposes frequent words and phrases at a lowered threshold. The full
pass counts, exactly and over all documents, every word and every phrase whose two shorter
parts (without its last and without its first word) are both proposed: the proposals and their
negative border. A phrase of the border that turns out frequent is a failure of the sample: it
joins the proposals, and an expansion pass counts the phrases that it opens, and those that these
open in turn, until nothing is left to open. What is frequent is then known completely, whatever
the sample proposed.

The proposals reach the tasks as a Bloom filter over hashes of (language, phrase), sized for
their number up to ``MOST_BITS``. Its rare false answers, and any beyond a full filter, only
let more phrases be counted. The filters alone say in which pass a phrase is counted, so that
every phrase is counted in one pass only. Phrases are counted as strings, not as hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from quadrat.session import cut_lineage

LONGEST = 4
THRESHOLD = 30
SAMPLE = 8  # one document of so many proposes
PROPOSED = 3  # occurrences in the sample that make a proposal
COVERED = 80  # percent of a phrase's occurrences inside one longer phrase that make it redundant
TOP = 2000
SCALE = 2_000_000
NO_LANGUAGE = "und"
ALL_WORDS = b""  # stands for the number of all words; no phrase is empty

STEP = 64  # documents whose words exist at once
WORDS_AT_ONCE = 1 << 18
ENTRIES = 1 << 18  # words and counts held by a task before they are sent on
PAIRS = 3 << 20  # pairs of words held by a task, 8 bytes each, before they are counted and sent on
SLICES = 64
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29  # of the filter: 128 KiB to 64 MiB
BITS_EACH = 12
PROBES = 4

# A-Z to a-z, piece ends to a full stop, tab to space; other bytes stay.
_FOLD = bytes(ord(".") if b in b".,;:!?\n\x0b\x0c\r" else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK, _TOP_BITS = np.uint64(29), np.uint64(58)


def _tokens(text: bytes) -> list[bytes]:
    """Words of a text with a full stop, which no word holds, at the end of every piece."""
    return text.translate(_FOLD).replace(b".", b" . ").split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _STEP_BACK)) * _MIX
    return h ^ (h >> np.uint64(32))


def _joined(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word and that of its last word."""
    return _mixed(head * np.uint64(3) + last)


def _phrase_hash(lang: str, phrase: str) -> int:
    """The hash that ``_joined`` gives for the words of a phrase, one number at a time."""
    seed, all_bits = xxhash.xxh64_intdigest(lang.encode()), (1 << 64) - 1
    out = None
    for w in phrase.encode().split(b" "):
        h = xxhash.xxh64_intdigest(w) ^ seed
        if out is not None:
            h = (out * 3 + h) & all_bits
            h = ((h ^ (h >> 29)) * int(_MIX)) & all_bits
            h ^= h >> 32
        out = h
    return out


class Filter:
    """Bloom filter in slices, each of which one task can build."""

    def __init__(self, bits: int, slices: dict[int, bytes] | None = None):
        self.bits = bits
        self.per_slice = bits // SLICES
        self.bytes = np.zeros(bits // 8, np.uint8)
        for s, packed in (slices or {}).items():
            self.bytes[s * self.per_slice // 8:(s + 1) * self.per_slice // 8] = np.frombuffer(packed, np.uint8)

    def place(self, h: np.ndarray, k: int) -> np.ndarray:
        """Bit number of the k-th probe; slices have a power of two of bits."""
        return (h >> _TOP_BITS) * np.uint64(self.per_slice) + ((h + np.uint64(k) * ((h >> np.uint64(26)) | np.uint64(1))) & np.uint64(self.per_slice - 1))

    def add(self, h: np.ndarray) -> None:
        for k in range(PROBES):
            p = self.place(h, k)
            np.bitwise_or.at(self.bytes, p >> np.uint64(3), np.left_shift(1, (p & np.uint64(7)).astype(np.uint8), dtype=np.uint8))

    def has(self, h: np.ndarray) -> np.ndarray:
        size, at = len(h), np.arange(len(h))  # those that all probes so far have found
        for k in range(PROBES):
            p = self.place(h, k)
            hit = np.flatnonzero(self.bytes[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1)
            at, h = at[hit], h[hit]
        found = np.zeros(size, bool)
        found[at] = True
        return found

    def slice(self, s: int) -> bytes:
        return self.bytes[s * self.per_slice // 8:(s + 1) * self.per_slice // 8].tobytes()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = np.array([_phrase_hash(lang, p) for lang, p in zip(*(c.to_pylist() for c in batch.columns))], np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((h >> _TOP_BITS).astype(np.int32)), pa.array(h.view(np.int64))], names=["slice", "h"])


def _build(bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled, seen = Filter(bits), set()
        for batch in batches:
            seen.update(batch.column(0).unique().to_pylist())
            filled.add(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
        for s in sorted(seen):
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([filled.slice(s)], pa.binary())], names=["slice", "bits"])

    return build


def make_filter(proposals: DataFrame, bits: int) -> Filter:
    """Filter over ``(lang, phrase)`` rows; the slices that come to the driver have ``bits`` bits in all."""
    hashed = proposals.select("lang", "phrase").mapInArrow(_hashes, "slice int, h bigint").repartition(SLICES, "slice")
    return Filter(bits, {r["slice"]: bytes(r["bits"]) for r in hashed.mapInArrow(_build(bits), "slice int, bits binary").collect()})


def _bits_for(n: int) -> int:
    return min(max(LEAST_BITS, 1 << (BITS_EACH * n).bit_length()), MOST_BITS)


class _Words:
    """Hash of every word seen, and whether the filters hold it; the full stop between pieces is in none."""

    def __init__(self, lang: str, now: Filter, before: Filter | None):
        self.seed, self.now, self.before = np.uint64(xxhash.xxh64_intdigest(lang.encode())), now, before
        self.number: dict[bytes, int] = {b".": 0}
        self.words = [b"."]
        self.hash, self.new, self.old = np.zeros(1, np.uint64), np.zeros(1, bool), np.zeros(1, bool)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        fresh = list(set(words).difference(self.number))
        if fresh:
            self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
            self.words += fresh
            h = np.array([xxhash.xxh64_intdigest(w) for w in fresh], np.uint64) ^ self.seed
            self.hash = np.concatenate([self.hash, h])
            self.new = np.concatenate([self.new, self.now.has(h)])
            self.old = np.concatenate([self.old, np.zeros(len(h), bool) if self.before is None else self.before.has(h)])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


class _Counts:
    """Phrases of texts in one language after another, counted as far as the filters of this pass say.

    The first pass (``before`` is None) counts all words and the phrases whose parts ``now``
    holds. A later one counts what ``before`` left out: phrases whose parts ``now`` holds or
    that are counted in this pass themselves.
    """

    def __init__(self, now: Filter, before: Filter | None, longest: int):
        self.now, self.before, self.longest = now, before, longest
        self.counted: dict[str, Counter] = {}
        self.known: dict[str, _Words] = {}
        self.pairs: dict[str, list[np.ndarray]] = {}  # by language, as two word numbers in one

    def add(self, lang: str, words: list[bytes]) -> None:
        counted = self.counted.setdefault(lang, Counter())
        if self.before is None:
            counted.update(words)
            counted[ALL_WORDS] += len(words) - counted.pop(b".", 0)
        known = self.known.setdefault(lang, _Words(lang, self.now, self.before))
        at = known.numbers(words)
        h1, new, old = known.hash[at], known.new[at], known.old[at]
        h = h1
        for k in range(2, self.longest + 1):  # h, new, old: of the phrases of k - 1 words that start here
            both, held = new[:-1] & new[1:], old[:-1] & old[1:]
            fresh = both & ~held
            if k == 2:
                self.pairs.setdefault(lang, []).append((at[:-1] << 32 | at[1:])[fresh])
            else:
                counted.update([b" ".join(words[i:i + k]) for i in np.flatnonzero(fresh).tolist()])
            if k < self.longest:
                h = _joined(h[:-1], h1[k - 1:])
                new, old = np.zeros(len(h), bool), np.zeros(len(h), bool)
                some = np.flatnonzero(both)
                new[some] = self.now.has(h[some])
                if self.before is not None:
                    some = np.flatnonzero(held & new)
                    old[some] = self.before.has(h[some])
                    new |= fresh

    def full(self) -> bool:
        held = sum(map(len, self.counted.values())) + sum(len(w.words) for w in self.known.values())
        return held > ENTRIES or sum(len(p) for parts in self.pairs.values() for p in parts) > PAIRS

    def flush(self) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.pairs.items():
            met, n = np.unique(np.concatenate(parts), return_counts=True)
            words = self.known[lang].words
            for i in range(0, len(met), 1 << 16):
                part = met[i:i + (1 << 16)]
                said = [words[a] + b" " + words[b] for a, b in zip((part >> 32).tolist(), (part & 0xFFFFFFFF).tolist())]
                yield _rows(lang, said, n[i:i + (1 << 16)])
        for lang, counted in self.counted.items():
            items = list(counted.items())
            for i in range(0, len(items), 1 << 16):
                said, n = zip(*items[i:i + (1 << 16)])
                yield _rows(lang, said, n)
        self.counted.clear()
        self.pairs.clear()
        if sum(len(w.words) for w in self.known.values()) > ENTRIES // 2:
            self.known.clear()


def _rows(lang: str, said, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(said)), pa.array(said, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])


def _counts(docs: DataFrame, now: Filter, before: Filter | None, longest: int) -> DataFrame:
    """``(lang, phrase, f)`` of the phrases that this pass is to count; the first one (``before`` is None) counts all words too."""
    send = docs.sparkSession.sparkContext.broadcast((now, before))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(*send.value, longest)
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch, held = whole.slice(at, STEP), {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words = held.setdefault(lang, [])
                    words += _tokens(text)
                    words.append(b".")
                    if len(words) > WORDS_AT_ONCE:
                        counts.add(lang, held.pop(lang))
                for lang, words in held.items():
                    counts.add(lang, words)
                if counts.full():
                    yield from counts.flush()
        yield from counts.flush()

    return docs.mapInArrow(count, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _with_held(rows: DataFrame, proposed: Filter) -> DataFrame:
    """``rows`` with ``held``: whether the filter has them."""
    send = rows.sparkSession.sparkContext.broadcast(proposed)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.array([_phrase_hash(lang, p) for lang, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(send.value.has(h))], names=["lang", "phrase", "f", "held"])

    return rows.select("lang", "phrase", "f").mapInArrow(ask, "lang string, phrase string, f bigint, held boolean")


def _frequent(docs: DataFrame, now: Filter, before: Filter | None, threshold: int, longest: int) -> DataFrame:
    """What a pass finds frequent, written: ``(lang, phrase, f, held)``, ``held`` if ``now`` has it."""
    found = _counts(docs, now, before, longest).filter((F.col("f") >= threshold) | (F.col("phrase") == ALL_WORDS.decode()))
    return cut_lineage(_with_held(found, now))


def _failed(frequent: DataFrame, longest: int) -> DataFrame:
    """Frequent phrases that were not proposed and that longer ones may build on."""
    return frequent.filter(~F.col("held") & (F.col("phrase") != ALL_WORDS.decode()) & (F.size(F.split("phrase", " ")) < longest))


def _proposals(part: DataFrame, threshold: int) -> DataFrame:
    """What the sample finds frequent, level by level; phrases of the greatest length need no proposal."""
    words = _frequent(part, Filter(LEAST_BITS), None, threshold, 1)
    found, now, before = words, make_filter(_failed(words, LONGEST), _bits_for(16 * words.count())), Filter(LEAST_BITS)
    for longest in range(2, LONGEST):
        level = _frequent(part, now, before, threshold, longest)
        found = found.unionByName(level)
        grown = make_filter(level, now.bits)
        grown.bytes |= now.bytes
        now, before = grown, now
    return found.filter(F.col("phrase") != ALL_WORDS.decode()).select("lang", "phrase").distinct()


def _mine(docs: DataFrame, proposals: DataFrame, threshold: int) -> DataFrame:
    """All ``(lang, phrase, f)`` with ``f >= threshold``; the phrase ``ALL_WORDS`` has the number of all words.

    The first pass counts the proposals and their border. Failures of the border call for an
    expansion pass, which goes on from a phrase that it opens to longer ones at once, without
    waiting for its count: every phrase with frequent parts alone is then counted, so the
    search is closed.
    """
    now = make_filter(proposals, _bits_for(2 * proposals.count()))
    counted = _frequent(docs, now, None, threshold, LONGEST)
    failed = _failed(counted, LONGEST)
    if not failed.isEmpty():
        grown = make_filter(failed, now.bits)
        grown.bytes |= now.bytes
        counted = counted.unionByName(_frequent(docs, grown, now, threshold, LONGEST))
    return counted.select("lang", "phrase", "f")


def frequent_phrases(df: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", threshold: int = THRESHOLD, proposed: int = PROPOSED) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, f)`` of every word and phrase of up to four words with ``f >= threshold``, and ``(lang, n)``, all words of a language.

    Letters A-Z are lower-cased; a piece ends at a line end or one of ``.,;:!?``; blanks and tabs
    part words. A null language is ``und``. Null and empty texts hold no word; repeated rows
    count each; a row is sampled by its key (rows without one are all sampled alike). Neither
    ``proposed`` nor the sample changes the result.
    """
    text_bytes = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    rows = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), text_bytes, F.col(key).cast("string").alias("key"))
    part = rows.filter(F.xxhash64("key").bitwiseAND(F.lit(SAMPLE - 1)) == 0).select("lang", "text")
    proposals = cut_lineage(_proposals(cut_lineage(part), proposed))
    counted = _mine(rows.select("lang", "text"), proposals, threshold)
    every = F.col("phrase") == ALL_WORDS.decode()
    return counted.filter(~every), counted.filter(every).select("lang", F.col("f").alias("n"))


def cuts(counted: DataFrame) -> DataFrame:
    """Candidates ``(lang, phrase, k, a, l, r, score)`` with their lowest-scoring cut, the smallest place among equals."""
    candidates = counted.withColumn("k", F.size(F.split("phrase", " "))).filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    at = candidates.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    place = F.length(F.call_function("substring_index", "phrase", F.lit(" "), F.col("cut")))
    at = at.withColumn("first", F.substr("phrase", F.lit(1), place)).withColumn("rest", F.substr("phrase", place + 2))
    part = lambda side, f: counted.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    both = at.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    wide = "decimal(19,0)"
    score = F.expr(f"({SCALE} * cast(a AS {wide})) div (cast(l AS {wide}) + cast(r AS {wide}))").alias("score")
    best = both.select("lang", "phrase", "k", "a", "cut", "l", "r", score).groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")


def collocations(df: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", threshold: int = THRESHOLD, top: int = TOP, proposed: int = PROPOSED) -> DataFrame:
    """Each language's ``top`` phrases of two to four words: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the phrase's frequency, ``l`` and ``r`` those of the two parts at its worst cut. A
    phrase is left out if a longer frequent phrase holds it and has at least 80 % of its
    occurrences. Ties in score go by ``a``, then by the phrase's bytes. An empty table has no
    row. Only a language's best ``top`` rows of each task meet in one task.
    """
    counted, size = frequent_phrases(df, key, lang, text, threshold, proposed)
    scored = cut_lineage(cuts(counted))
    word = F.split("phrase", " ")
    inner = scored.filter("k > 2").select("lang", F.col("a").alias("longer"), word.alias("w"), "k")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    held = inner.select("lang", "longer", F.explode(F.array_distinct(spans)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = "decimal(19,0)"
    free = scored.join(held, ["lang", "phrase"], "left").filter(f"longer is null or 100 * cast(longer as {wide}) < {COVERED} * cast(a as {wide})")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
