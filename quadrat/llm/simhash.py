"""SimHash fingerprints linked through a grid of per-segment bit counts.

A fingerprint is cut into segments and mapped to the counts of ones in each. The Manhattan
distance of two such points never exceeds the number of differing bits, so fingerprints that
differ in few bits lie close on the grid. Two within distance 2 have a grid cell at distance
1 or less from both: every fingerprint is entered into its own cell and the cells one step
away, and only cells that hold two different fingerprints go on. There the exact test is
made without listing pairs: in a shared cell, each fingerprint is replaced by the bit
strings of that cell that differ from it in one bit or none. Two fingerprints differ in two
bits or less exactly when they have such a bit string in common, and at most 65 fingerprints
have any one bit string, so a large group of near copies costs no more than its rows.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quadrat.llm.components import components
from quadrat.llm.rows import append_columns
from quadrat.session import cut_lineage

BITS = 64
SEGMENT = 4  # bits per segment: 16 segments, whose counts fill a 64-bit number, four bits each
SEED = 42
CHUNK = 1 << 15  # shingles whose bits are unpacked at once


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """The SimHash of a whole text as a signed 64-bit number; 0 without words."""
    tokens = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*[tokens[i:] for i in range(words)])))
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(shingles), CHUNK):
        h = np.array([hashed(s, SEED) for s in shingles[i:i + CHUNK]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fp", words: int = 3) -> DataFrame:
    """Add the fingerprint (signed 64-bit) of every whole text; a null text has none of the words, so 0."""
    return append_columns(df, text, f"`{out}` bigint", lambda: lambda texts: [(fingerprint_of(t, words),) for t in texts])


def _counts(fp: Column) -> Column:
    """Ones in each segment of four bits, side by side in one 64-bit number."""
    odd, even = fp.bitwiseAND(F.lit(0x5555555555555555)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(0x5555555555555555))
    pairs = odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))  # no sum may reach the sign bit
    low = F.lit(0x3333333333333333)
    return pairs.bitwiseAND(low) + F.shiftrightunsigned(pairs, 2).bitwiseAND(low)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _cells(fp: Column) -> Column:
    """The fingerprint's own cell and those one step away."""
    point = _counts(fp)
    cells = [point]
    for k in range(BITS // SEGMENT):
        unit = F.lit(1 << (SEGMENT * k))
        count = F.shiftrightunsigned(point, SEGMENT * k).bitwiseAND(F.lit(15))
        cells += [F.when(count < SEGMENT, point + unit), F.when(count > 0, point - unit)]
    return F.array_compact(F.array(*cells))


def _strings(fp: Column, cell: Column) -> Column:
    """Bit strings of a cell that differ from a fingerprint entered there in one bit or none."""
    step = cell - _counts(fp)
    moved = [F.when(step == 0, fp)]
    for k in range(BITS):
        bit, unit = F.lit(_signed(1 << k)), F.lit(1 << (SEGMENT * (k // SEGMENT)))
        moved.append(F.when(step == F.when(fp.bitwiseAND(bit) == 0, unit).otherwise(-unit), fp.bitwiseXOR(bit)))
    return F.array_compact(F.array(*moved))


def links(fingerprints: DataFrame, fp: str = "fp") -> DataFrame:
    """Links ``(a, b)`` between different fingerprints that join exactly those 2 or fewer bits apart.

    Not every pair is listed: fingerprints around one bit string are all linked to the smallest
    of them. The links have the same connected components as all pairs. Nulls are ignored.
    """
    points = cut_lineage(fingerprints.select(F.col(fp).alias("fp")).filter("fp is not null").distinct())
    spread = points.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")  # each row becomes some thirty
    entered = spread.select("fp", F.explode(_cells(F.col("fp"))).alias("cell"))
    shared = entered.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("cell")
    close = entered.join(shared, "cell", "left_semi")
    around = close.select("fp", F.explode(_strings(F.col("fp"), F.col("cell"))).alias("string")).groupBy("string").agg(F.collect_set("fp").alias("fps")).filter("size(fps) > 1")
    pairs = around.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).distinct()


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``fp``, and ``component_id``, the smallest key reachable over links.

    Rows of one fingerprint are one group from the start, however many they are; a fingerprint
    of a text without words (null texts too) is 0 and links like any other. Repeated rows stay
    repeated. A null key keeps its row and gets the group's smallest key that is not null. Very
    long texts are read whole, some thousand shingles at a time; an empty table gives no row.
    """
    docs = cut_lineage(with_fingerprint(df.select(F.col(key).alias("key"), F.col(text).alias("text"))).select("key", "fp"))
    first = cut_lineage(docs.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(links(first))
    grouped = first.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs.join(grouped.select("fp", "root"), "fp").join(smallest, "root").select(F.col("key").alias(key), "fp", "component_id")


def one_of_each_group(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stand for their group of near copies: the one with the group's smallest key.

    Groups go by the text, not by the key: a key repeated with unlike texts is judged for each
    of them. Of several rows with that key in the group one stays, whichever columns it has: the
    smallest fingerprint, then the smallest text. Rows with a null key stay only where nobody in
    their group has a key, one for each fingerprint. Other columns pass through.
    """
    groups = near_groups(df, key, text)
    stays = groups.filter(F.col(key).eqNullSafe(F.col("component_id"))).groupBy("component_id").agg(F.min("fp").alias("fp")).filter("component_id is not null")
    alone = groups.filter("component_id is null").select("component_id", "fp").distinct()
    chosen = stays.unionByName(alone).select(F.col("component_id").alias("__of_key"), F.col("fp").alias("__of_fp"))
    marked = with_fingerprint(df, text, "__fp")
    kept = marked.join(chosen, F.col(key).eqNullSafe(F.col("__of_key")) & (F.col("__fp") == F.col("__of_fp")), "left_semi")
    first = W.partitionBy(key, "__fp").orderBy(F.asc_nulls_last(text))
    return kept.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").select(*[f"`{c}`" for c in df.columns])


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
