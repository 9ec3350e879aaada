"""Identifier and code construction: padding, composition, parsing, encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from quadrat.functions.missing import ColumnLike, col


def zero_pad(c: ColumnLike, width: int) -> Column:
    """Left-pad with zeros; a longer value stays whole (``lpad`` alone would cut it)."""
    text = number_text(c)
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def number_text(c: ColumnLike) -> Column:
    """Text of an identifier that may have been read as a floating-point number."""
    text = col(c).cast("string")
    return F.regexp_replace(text, r"^(-?\d+)\.0$", "$1")


def compose_key(*parts: ColumnLike, sep: str = "") -> Column:
    """Concatenate parts; missing as soon as one part is missing."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i and sep:
            pieces.append(F.lit(sep))
        pieces.append(col(part).cast("string"))
    return F.concat(*pieces)


def take_part(c: ColumnLike, sep: str, index: int) -> Column:
    """Part ``index`` (0-based) after splitting on ``sep``; missing when there is none."""
    return F.get(F.split(col(c), rf"\Q{sep}\E"), F.lit(index))


def text_before(c: ColumnLike, *markers: str) -> Column:
    """Cut at the first occurrence of each marker in turn and trim."""
    out = col(c)
    for marker in markers:
        out = F.trim(F.substring_index(out, marker, 1))
    return out


def number_from_text(c: ColumnLike, to: str = "bigint", blank_mark: str | None = None) -> Column:
    """Parse ``1,234``; the whole-cell ``blank_mark`` and zero then mean missing."""
    text = col(c).cast("string")
    if blank_mark is not None:
        text = F.when(F.trim(text) == blank_mark, "0").otherwise(text)
    number = F.trim(F.regexp_replace(text, ",", "")).try_cast(to)
    return F.nullif(number, F.lit(0).cast(to)) if blank_mark is not None else number


def title_case(c: ColumnLike) -> Column:
    """Capitalise after every non-letter, also after apostrophes, hyphens and digits."""
    runs = F.regexp_extract_all(col(c), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def last_token(c: ColumnLike) -> Column:
    """Last run without blanks or hyphens (the upper end of ``36000 - 48000``)."""
    return F.nullif(F.regexp_extract(col(c), r"([^- ]+)$", 1), F.lit(""))


def interval_ceiling(c: ColumnLike, overrides: Mapping[str, str]) -> Column:
    """Upper bound of a labelled interval; open-ended labels come from ``overrides``."""
    out = last_token(c)
    for label, value in overrides.items():
        out = F.when(col(c) == label, value).otherwise(out)
    return out.try_cast("double")


def recode(c: ColumnLike, mapping: Mapping, default=None, strict: bool = False) -> Column:
    """Look a value up in a literal dictionary."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, col(c))
    if strict:
        missing = F.raise_error(F.concat(F.lit("no code for "), col(c).cast("string")))
        return F.when(col(c).isNull() | found.isNotNull(), found).otherwise(missing)
    return found if default is None else F.coalesce(found, F.lit(default))


def label_codes(c: ColumnLike, labels: Mapping[int, str], strict: bool = False) -> Column:
    """Encode a label by its position in an ordered label set."""
    return recode(c, {text: code for code, text in labels.items()}, strict=strict)


def range_code(c: ColumnLike, ranges: Sequence[tuple[float, float | None, int]]) -> Column:
    """Code closed ranges; an open upper end also takes missing values."""
    out = None
    for low, high, code in ranges:
        hit = (col(c).isNull() | (col(c) >= low)) if high is None else col(c).between(low, high)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out


def keep_categories(c: ColumnLike, kept: Sequence[str], other: str) -> Column:
    """Everything but the kept categories, also missing, becomes ``other``."""
    return F.when(col(c).isin(list(kept)), col(c)).otherwise(F.lit(other))


def swap_key_value(df: DataFrame, key: str, value: str, order: ColumnLike | None = None) -> DataFrame:
    """Invert a lookup; when several keys share a value the last one in order wins."""
    rank = col(order) if order is not None else col(key)
    return (
        df.groupBy(F.col(value).alias("value"))
        .agg(F.max_by(F.col(key), rank).alias("key"))
        .select("value", "key")
    )


def distinct_codes(df: DataFrame, c: str, code: str = "code") -> DataFrame:
    """Codes 1..k by ascending value, numbered on the distinct values only."""
    from quadrat.operators.numbering import with_row_numbers

    values = df.select(c).filter(F.col(c).isNotNull()).distinct()
    return with_row_numbers(values, [c], out=code, start=1).select(c, code)


def encode_sorted(df: DataFrame, c: str, code: str) -> DataFrame:
    """Attach the alphabetical code of ``c``; missing stays missing."""
    return df.join(distinct_codes(df, c, code), c, "left")


def group_id(df: DataFrame, columns: Sequence[str], code: str) -> DataFrame:
    """Attach a dense id of the column combination; rows with a missing part get none."""
    from quadrat.operators.numbering import with_row_numbers

    values = df.select(*columns).na.drop("any").distinct()
    ids = with_row_numbers(values, list(columns), out=code, start=1).select(*columns, code)
    return df.join(ids, list(columns), "left")


def levels(df: DataFrame, c: str, limit: int = 500) -> list:
    """Sorted distinct values of a categorical column, refused above ``limit``."""
    rows = df.select(c).filter(F.col(c).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{c} has more than {limit} levels; it is not a categorical column")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, c: str, prefix: str, values: Sequence | None = None) -> DataFrame:
    """Indicators ``prefix1..prefixk`` in ascending value order; missing gives missing."""
    values = levels(df, c) if values is None else list(values)
    return df.withColumns({
        f"{prefix}{i}": F.when(F.col(c).isNotNull(), (F.col(c) == F.lit(v)).cast("int"))
        for i, v in enumerate(values, start=1)
    })


def set_label(df: DataFrame, labels: Mapping[str, str], values: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Attach display labels of columns, and of their values, as column metadata."""
    for name, text in labels.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "label": text})
    for name, texts in (values or {}).items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "values": {str(v): t for v, t in texts.items()}})
    return df


def label_of(df: DataFrame, name: str) -> str:
    return df.schema[name].metadata.get("label", name)


def value_label_of(df: DataFrame, name: str, value) -> str | None:
    return df.schema[name].metadata.get("values", {}).get(str(value))
