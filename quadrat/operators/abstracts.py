"""Texts stored as an inverted word index: repair, parse, rebuild, and the inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quadrat.functions.missing import ColumnLike, col, let
from quadrat.session import fan_out

INDEX_SCHEMA = "struct<IndexLength:int,InvertedIndex:map<string,array<int>>>"
# A quote is structural at the start of a key (after "{" or "],") and at its end (before ":[" or, for
# the two field names, before ":").
_STRUCTURAL = r'(?<=\{)"|(?<=\],)"|"(?=:\[)|(?<="IndexLength)"(?=:)|(?<=,)"(?=InvertedIndex":\{)|(?<=,"InvertedIndex)"(?=:\{)'


def repair_index(c: ColumnLike) -> Column:
    """Make a loosely quoted index valid JSON.

    The text is cut at its structural quotes; in the pieces between them quotes become
    apostrophes and backslashes are doubled, so that both stay literal text.
    """
    pieces = F.split(col(c), _STRUCTURAL)
    literal = F.transform(pieces, lambda p: F.translate(F.replace(p, F.lit("\\"), F.lit("\\\\")), '"', "'"))
    return F.array_join(literal, '"')


def parse_index(c: ColumnLike) -> Column:
    """Parsed index; NULL when the text is no complete JSON index."""
    parsed = F.from_json(repair_index(c), INDEX_SCHEMA, {"allowUnquotedControlChars": "true"})
    return let(parsed, lambda p: F.when(p["IndexLength"].isNotNull() & p["InvertedIndex"].isNotNull(), p))


def _placed(index: Column) -> Column:
    """(position, entry number, word) for every occurrence, sorted."""
    entries = F.map_entries(index["InvertedIndex"])
    return F.sort_array(F.flatten(F.transform(
        entries, lambda e, n: F.transform(e["value"], lambda p: F.struct(p.alias("at"), n.alias("n"), e["key"].alias("word")))
    )))


def index_in_range(index: Column) -> Column:
    """Every position lies inside the declared length."""
    length = index["IndexLength"]
    return ~F.exists(
        F.flatten(F.map_values(index["InvertedIndex"])), lambda p: p.isNull() | (p < 0) | (p >= length)
    )


def index_text(index: Column) -> Column:
    """Words in position order; the last entry wins a contested position, gaps close up."""
    def words(placed: Column) -> Column:
        kept = F.filter(placed, lambda e, i: F.coalesce(F.get(placed, i + 1)["at"] != e["at"], F.lit(True)))
        return F.array_join(F.transform(kept, lambda e: e["word"]), " ")

    return let(_placed(index), words)


def rebuild_text(df: DataFrame, index: str, out: str, failed: str) -> DataFrame:
    """Add the rebuilt text and a failure flag.

    A missing index gives an empty text; a broken one gives an empty text and the flag.
    """
    def outcome(ix: Column) -> Column:
        good = F.coalesce(index_in_range(ix), F.lit(False))
        return F.struct(F.when(good, index_text(ix)).otherwise("").alias("text"), good.alias("good"))

    done = df.withColumn("__done", let(parse_index(index), outcome))
    return done.select(
        *[c for c in df.columns if c != out],
        F.col("__done.text").alias(out), (F.col(index).isNotNull() & ~F.col("__done.good")).alias(failed),
    )


def inverted_index(c: ColumnLike) -> Column:
    """Inverted index of a blank-separated text, in the loosely quoted form, built in the row.

    (word, position) pairs are sorted; each opens an entry or goes on with the one before it.
    """
    words = F.split(col(c), " ")

    def entries(pairs: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            at = p["at"].cast("string")
            opened = F.concat(F.when(i == 0, "").otherwise("],"), F.lit('"'), p["word"], F.lit('":['), at)
            return F.when(p["word"] == F.get(pairs, i - 1)["word"], F.concat(F.lit(","), at)).otherwise(opened)

        return F.concat(F.array_join(F.transform(pairs, one), ""), F.lit("]"))

    pairs = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))))
    return F.concat(F.lit('{"IndexLength":'), F.size(words).cast("string"), F.lit(',"InvertedIndex":{'), let(pairs, entries), F.lit("}}"))


def build_index(df: DataFrame, key: str, text: str, out: str) -> DataFrame:
    """(key, inverted index) of every text; null texts have none."""
    return fan_out(df.select(key, text)).filter(F.col(text).isNotNull()).select(key, inverted_index(text).alias(out))

