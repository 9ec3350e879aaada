"""Readers: every source yields a DataFrame with a declared schema."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

Paths = str | list[str]


def read_csv(spark: SparkSession, path: Paths, schema: T.StructType | str, encoding: str = "UTF-8") -> DataFrame:
    """CSV with a header; declare identifiers as strings so leading zeros survive."""
    return (
        spark.read.schema(schema).option("header", True).option("encoding", encoding)
        .option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    )


# A quoted cell's text, and any number of whole cells with their commas; possessive, so matching needs no recursion.
_QUOTED = r'(?:[^"]++|"")*+'
_CELLS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'


def read_ragged(spark: SparkSession, path: Paths, encoding: str = "ISO-8859-1") -> DataFrame:
    """Headerless rows of differing length: (row_no, cells); empty cells are dropped.

    A quoted cell may hold commas, doubled quotes and line ends, and be of any length; a quote
    inside an unquoted cell is an ordinary character. ``row_no`` follows file and first line.
    An unclosed quote takes the rest of its file into one cell.
    """
    text = spark.read.text(path, lineSep="\n")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")]
    line = F.regexp_replace(F.decode(F.col("value").cast("binary"), encoding), "\r$", "").alias("line")
    lines = with_line_numbers(text.select(line, *place).withColumn("part", F.col("block")))
    records = _whole_records(lines)
    files = lines.groupBy("file").agg((F.max("line_no") + 1).alias("lines"))
    numbered = records.join(_lines_before(files), "file").withColumn("row_no", F.col("line_no") + F.col("before"))
    cell = F.regexp_extract_all(F.concat(F.lit(","), F.col("line")), F.lit(rf',("{_QUOTED}"|[^,]*+)'), F.lit(1))
    plain = F.transform(cell, lambda x: F.trim(F.replace(F.regexp_replace(x, r'^"|"\z', ""), F.lit('""'), F.lit('"'))))
    return numbered.select("row_no", F.filter(plain, lambda x: x != "").alias("cells"))


def _lines_before(files: DataFrame) -> DataFrame:
    """``(file, before)``: how many lines stand in the files of smaller name. One row per file."""
    before = F.sum("lines").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
    return files.select("file", F.coalesce(before, F.lit(0)).alias("before"))


def _whole_records(lines: DataFrame) -> DataFrame:
    """``(file, line_no, line)`` with the lines of a quoted cell joined, under the number of the first.

    Whether a line ends inside a quoted cell depends on whether it began inside one, so each
    line is a function of one bit: it fixes the bit, keeps it, or turns it. The bit before a
    line is what the last fixing line left, turned once for each turning line since. It is
    worked out inside each file block, from a table with one row per block.
    """
    from_outside = F.col("line").rlike(rf'^{_CELLS}"{_QUOTED}\z')
    from_inside = F.col("line").rlike(rf'^{_QUOTED}\z') | F.col("line").rlike(rf'^{_QUOTED}"[^,]*+,{_CELLS}"{_QUOTED}\z')
    bits = lines.withColumns({"outside": from_outside, "inside": from_inside})
    own = W.partitionBy("file", "part").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    turns = F.coalesce(F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(own), F.lit(0))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turns"))
    bits = bits.withColumn("turns", turns).withColumn("fixed", F.last(fixed, ignorenulls=True).over(own))
    after = bits.groupBy("file", "part").agg(
        F.sum((F.col("outside") & ~F.col("inside")).cast("int")).alias("all_turns"), F.max_by(fixed, F.when(fixed.isNotNull(), F.col("line_no"))).alias("last_fixed"))
    earlier = W.partitionBy("file").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum("all_turns").over(earlier), F.lit(0))
    left = F.when(F.col("last_fixed").isNotNull(), F.struct(F.col("last_fixed.outside").alias("bit"), (F.col("so_far") + F.col("last_fixed.turns")).alias("turns")))
    entry = after.withColumn("so_far", so_far).withColumn("before", F.last(left, ignorenulls=True).over(earlier))
    turned = lambda bit, n: (bit.cast("int") + n) % 2 == 1
    entered = F.when(F.col("before").isNotNull(), turned(F.col("before.bit"), F.col("so_far") - F.col("before.turns"))).otherwise(F.col("so_far") % 2 == 1)
    known = bits.join(entry.select("file", "part", entered.alias("entered")), ["file", "part"])
    began = F.when(F.col("fixed").isNotNull(), turned(F.col("fixed.outside"), F.col("turns") - F.col("fixed.turns"))).otherwise(turned(F.col("entered"), F.col("turns")))
    known = known.select("file", "part", "line_no", "line", began.alias("began"), F.when(began, F.col("inside")).otherwise(F.col("outside")).alias("open"))
    single = known.filter("not began and not open").select("file", "line_no", "line")
    pieces = known.filter("began or open")
    first = W.partitionBy("file", "part").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    pieces = pieces.withColumn("own_first", F.last(F.when(~F.col("began"), F.col("line_no")), ignorenulls=True).over(first))
    parts = pieces.groupBy("file", "part").agg(F.max("own_first").alias("last_first"))
    parts = parts.select("file", "part", F.last("last_first", ignorenulls=True).over(earlier).alias("carried"))
    joined = pieces.join(parts, ["file", "part"]).groupBy("file", F.coalesce("own_first", "carried").alias("line_no")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("line"))
    return single.unionByName(joined)


def file_part(file_name: Column | str = "file") -> Column:
    """The part of a file name between the last underscore and its suffix."""
    return F.regexp_extract(file_name, r"([^_./]*)\.[^./]*$", 1)


def read_json_lines(spark: SparkSession, path: Paths, schema: T.StructType | str) -> DataFrame:
    """JSON lines with their origin: (file, file_idx, line_no, raw, record).

    A line that is no JSON object keeps its text in ``raw`` and has a null ``record``.
    Line numbers come from the byte order inside each file.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("raw"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"),
    )
    return with_line_numbers(raw).select(
        "file", file_part("file").alias("file_idx"), "line_no", "raw", parse_record("raw", schema).alias("record")
    )


def parse_record(raw: Column | str, schema: T.StructType | str) -> Column:
    """Parsed object; NULL when the line is not a JSON object."""
    text = F.col(raw) if isinstance(raw, str) else raw
    looks_whole = F.get_json_object(text, "$").isNotNull() & F.trim(text).startswith("{")
    return F.when(looks_whole, F.from_json(text, schema))


def with_line_numbers(raw: DataFrame) -> DataFrame:
    """0-based line number per file for rows carrying (file, block, pos).

    Lines are counted inside each file block (the split of a file scan is the same on
    every read); the blocks of a file are then added up from a table with one row per
    block, which is sent to the lines, so that these are not shuffled.
    """
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    before = F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    offsets = blocks.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    return raw.join(F.broadcast(offsets), ["file", "block"]).withColumn(
        "line_no", (F.col("pos") - F.col("first") + F.col("before")).cast("bigint")
    ).drop("block", "pos", "first", "before")


def read_json_map(spark: SparkSession, path: Paths, value_schema: str, key: str = "key") -> DataFrame:
    """JSON objects with dynamic keys, one a file, as (key, fields of the value) rows.

    An object may be of any size and on one line: files are cut at commas by the scan, and
    commas between entries are told from those inside values by string state and depth. A
    key that stands twice gives two rows, an empty file none; text that is no JSON object is
    an error.
    """
    text = spark.read.text(path, lineSep=",")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")]
    pieces = with_line_numbers(text.select(F.col("value").alias("piece"), *place).withColumn("part", F.col("block")))
    entries = _whole_entries(pieces)
    parsed = F.from_json("entry", f"map<string,{value_schema}>")
    wrong = F.raise_error(F.concat(F.lit("no JSON object with whole entries in "), F.col("file"))).cast(f"map<string,{value_schema}>")
    return entries.select(F.explode(F.coalesce(parsed, wrong)).alias(key, "v")).select(key, "v.*")


def _whole_entries(pieces: DataFrame) -> DataFrame:
    """``(file, entry)``: each entry of a file's object as an object of its own.

    A piece turns the string state by its quotes and changes the depth by its brackets
    outside strings, so it is known for both states it may be entered in. Pieces are added
    up inside each file block for both, and the blocks of a file from a table with one row
    per block.
    """
    bare = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"')

    def change(odd: int) -> Column:
        outside = F.array_join(F.filter(bare, lambda x, i: i % 2 == odd), "")
        return F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]}]", ""))

    known = pieces.select("file", "part", "line_no", "piece", ((F.size(bare) - 1) % 2).alias("turn"), change(0).alias("c0"), change(1).alias("c1"))
    own = W.partitionBy("file", "part").orderBy("line_no")
    before, upto = own.rowsBetween(W.unboundedPreceding, -1), own.rowsBetween(W.unboundedPreceding, 0)
    known = known.withColumn("turned", F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2)
    same = F.col("turned") == 0
    known = known.withColumns({"c0": F.when(same, F.col("c0")).otherwise(F.col("c1")), "c1": F.when(same, F.col("c1")).otherwise(F.col("c0"))})
    known = known.withColumns({"d0": F.sum("c0").over(upto), "d1": F.sum("c1").over(upto)})
    blocks = known.groupBy("file", "part").agg(F.sum("turn").alias("turn"), F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    earlier = W.partitionBy("file").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("turn").over(earlier), F.lit(0)) % 2)
    depth = F.sum(F.when(F.col("inside") == 0, F.col("c0")).otherwise(F.col("c1"))).over(earlier)
    blocks = blocks.select("file", "part", "inside", F.coalesce(depth, F.lit(0)).alias("depth"))
    placed = known.join(blocks, ["file", "part"])
    outer = F.col("inside") == 0
    after = F.col("depth") + F.when(outer, F.col("d0")).otherwise(F.col("d1"))
    at = after - F.when(outer, F.col("c0")).otherwise(F.col("c1"))
    opens = (F.col("line_no") == 0) | ((at == 1) & ((F.col("inside") + F.col("turned")) % 2 == 0))
    placed = placed.select("file", "part", "line_no", "piece", (after == 0).alias("closed"), F.last(F.when(opens, F.col("line_no")), ignorenulls=True).over(upto).alias("own_first"))
    carried = placed.groupBy("file", "part").agg(F.max("own_first").alias("first"))
    carried = carried.select("file", "part", F.last("first", ignorenulls=True).over(earlier).alias("carried"))
    lead = F.when(F.col("line_no") == 0, F.regexp_replace("piece", r"^\s*\{", "")).otherwise(F.concat(F.when(F.col("line_no") == F.col("first"), "").otherwise(","), "piece"))
    cut = F.when(F.col("closed"), F.regexp_replace("text", r"\}\s*\z", "")).otherwise(F.col("text"))
    rows = placed.join(carried, ["file", "part"]).withColumn("first", F.coalesce("own_first", "carried")).withColumn("text", lead).withColumn("text", cut)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    return rows.groupBy("file", "first").agg(F.concat(F.lit("{"), F.array_join(in_order, ""), F.lit("}")).alias("entry")).select("file", "entry")


_PART_BYTES = 64 << 20  # of a statistical file in one task


def _store(path: str):
    """File system and name of a path, for tasks that read a file from some place on."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _seekable(path: str) -> bool:
    """Whether tasks can open the file themselves; some stores are reached by Spark only."""
    try:
        store, name = _store(path)
        return store.get_file_info(name).is_file
    except (OSError, ValueError, NotImplementedError):
        return False


def read_statistical(spark: SparkSession, path: Paths, columns: Sequence[str], schema: str, part_bytes: int = _PART_BYTES) -> DataFrame:
    """Statistical files as one table, only the asked columns, with the ``file`` a row comes from.

    Rows have a fixed width, so a file of any size is cut into ranges of rows of about
    ``part_bytes``, each read by a task of its own from its place on. Long strings kept
    outside the rows are loaded by every task of their file. A file in a store that only
    Spark reaches is read whole by one task, which ends at 2 GB.
    """
    files = spark.read.format("binaryFile").load(path)
    wanted, out = list(columns), f"{schema}, file string"
    first = files.select("path").first()

    def chunks(reader, name: str, left: int | None = None) -> Iterator[pd.DataFrame]:
        while left is None or left > 0:
            try:
                chunk = reader.read(min(100_000, left) if left else 100_000)
            except StopIteration:
                return
            if chunk.empty:
                return
            yield chunk[wanted].assign(file=name.rsplit("/", 1)[-1])
            left = left - len(chunk) if left else None

    def options(source) -> dict:
        return {"filepath_or_buffer": source, "columns": wanted, "convert_categoricals": False, "iterator": True}

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from io import BytesIO

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with pd.read_stata(**options(BytesIO(content))) as reader:
                    yield from chunks(reader, name)

    if first is None or not _seekable(first[0]):
        return files.select("path", "content").mapInPandas(whole, out)

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, size in zip(batch["path"], batch["length"]):
                store, at = _store(name)
                with store.open_input_file(at) as source, pd.read_stata(**options(source)) as reader:
                    reader._ensure_open()
                    rows = reader._nobs
                step = max(1, rows * part_bytes // max(size, 1))
                starts = range(0, rows, step)
                yield pd.DataFrame({"path": name, "start": starts, "n": [min(step, rows - s) for s in starts]})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, start, n in zip(batch["path"], batch["start"], batch["n"]):
                store, at = _store(name)
                with store.open_input_file(at) as source, pd.read_stata(**options(source)) as reader:
                    reader._lines_read = int(start)  # pandas has no public way to begin at a row
                    yield from chunks(reader, name, int(n))

    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // part_bytes))
    parts = files.select("path", "length").mapInPandas(ranges, "path string, start bigint, n bigint")
    return parts.repartition(tasks, "path", "start").mapInPandas(read, out)


def read_prompt(spark: SparkSession, path: str) -> str:
    """A parameter text file, trimmed."""
    return spark.read.text(path, wholetext=True).first()[0].strip()


def read_monthly(spark: SparkSession, path: Paths, schema: T.StructType | str) -> DataFrame:
    """Monthly CSV files read as one table, the month taken from the date in the name of the file or its folder."""
    rows = spark.read.schema(schema).option("header", True).csv(path)
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r".*_(\d{8})(?=[_./])", 1)
    return rows.select("*", F.month(F.to_date(stamp, "yyyyMMdd")).alias("file_month"))
