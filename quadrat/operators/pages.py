"""Tables, links and attributes out of stored web pages."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quadrat.functions.keys import number_from_text, title_case
from quadrat.functions.missing import blank_to_null, mentions
from quadrat.functions.text import capture, squeeze
from quadrat.session import cut_lineage, fan_out


# Tags as most pages have them: quoted attributes, nothing else. A table cell without markup is one match.
# What holds text instead of tags is left to the parser.
_SPACE, _NAMED = r"[ \t\r\n]", r"[a-zA-Z][-a-zA-Z0-9_:.]*+"
_ATTRIBUTES = rf"""(?:{_SPACE}++{_NAMED}=(?:"[^"]*+"|'[^']*+'))*+"""
_PLAIN_TAG = re.compile(
    rf"<(t[dh]){_ATTRIBUTES}{_SPACE}*+>([^<]*+)</\1{_SPACE}*+>|(<(/)?([a-zA-Z][a-zA-Z0-9]*+)((?(4)|{_ATTRIBUTES})){_SPACE}*+>)")
_ATTRIBUTE = re.compile(rf"""({_NAMED})=("[^"]*+"|'[^']*+')""")
_RAW_TEXT = frozenset({"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"})


class _Tables(HTMLParser):
    """Rows of every table; a nested table is a table of its own, numbered by opening tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.opened = 0
        self.stack: list[dict] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.stack.append({"no": self.opened, "row": 0, "head": None, "cells": None, "cell": None, "attrs": dict(attrs)})
            self.opened += 1
        elif self.stack:
            top = self.stack[-1]
            if tag == "tr":
                self._end_row(top)
                top["cells"] = []
            elif tag in ("td", "th") and top["cells"] is not None:
                self._end_cell(top)
                top["cell"] = []
            elif tag == "br" and top["cell"] is not None:
                top["cell"].append(" ")

    def handle_endtag(self, tag):
        if not self.stack:
            return
        top = self.stack[-1]
        if tag in ("td", "th"):
            self._end_cell(top)
        elif tag == "tr":
            self._end_row(top)
        elif tag == "table":
            self._end_row(top)
            self.stack.pop()

    def handle_data(self, data):
        if self.stack and self.stack[-1]["cell"] is not None:
            self.stack[-1]["cell"].append(data)

    def _end_cell(self, t):
        if t["cell"] is not None and t["cells"] is not None:
            t["cells"].append(" ".join("".join(t["cell"]).split()))
        t["cell"] = None

    def _end_row(self, t):
        self._end_cell(t)
        if t["cells"]:
            t["head"] = t["head"] or t["cells"]
            self.rows.append((t["no"], t["row"], t["cells"], t["head"], t["attrs"].get("id"), t["attrs"].get("title")))
            t["row"] += 1
        t["cells"] = None

    def close(self):
        super().close()
        while self.stack:
            self._end_row(self.stack.pop())


class _Page(_Tables):
    """Tables and anchors in one pass; ``within`` limits the anchors to an element."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self, within: tuple[str, str, str] | None = None):
        super().__init__()
        self.within, self.tags, self.inside = within, [], []  # inside: places of wanted elements among the open tags
        self.links: list[list] = []
        self.open = None

    def read(self, text: str) -> None:
        """The whole page. Plain tags are cut out by one pattern; a page with anything else goes through the parser."""
        pieces = _PLAIN_TAG.split(text)  # text, cell, text in the cell, whole tag, slash, name, attributes, text, ...
        names = {name.lower() for name in set(pieces[5::7]) if name}
        if "<" in "".join(pieces[::7]) or not _RAW_TEXT.isdisjoint(names) or (self.within is not None and self.within[0] in ("td", "th")):
            self.feed(text)
            self.close()
            return
        data, start, end, stack = self.handle_data, self._start, self.handle_endtag, self.stack
        if pieces[0]:
            data(unescape(pieces[0]))
        columns = [pieces[i::7] for i in range(1, 8)]
        for cell, inner, raw, slash, name, attributes, after in zip(*columns):
            if cell:
                if "&" in inner:
                    inner = unescape(inner)
                if inner and self.open is not None:
                    self.open[1].append(inner)
                if stack and (cells := stack[-1]["cells"]) is not None:
                    if stack[-1]["cell"] is not None:
                        self._end_cell(stack[-1])
                    cells.append(" ".join(inner.split()))
            elif slash:
                end(name.lower())
            else:
                start(name.lower(), [(n.lower(), unescape(v[1:-1])) for n, v in _ATTRIBUTE.findall(attributes)] if attributes else (), raw)
            if after:
                data(unescape(after) if "&" in after else after)
        self.close()

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, self.get_starttag_text())

    def _start(self, tag, attrs, raw):
        super().handle_starttag(tag, attrs)
        if tag not in self.VOID:
            if self.within is not None and tag == self.within[0] and dict(attrs).get(self.within[1]) == self.within[2]:
                self.inside.append(len(self.tags))
            self.tags.append(tag)
        if tag == "a" and (self.within is None or self.inside):
            self.open = [dict(attrs).get("href"), [], raw]
            self.links.append(self.open)

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        # An end tag closes the last element of its name and all that was left open in it; it
        # does not reach out of a wanted element, which only its own end tag closes.
        first = self.inside[-1] if self.inside else 0
        at = len(self.tags) - 1
        while at >= first and self.tags[at] != tag:
            at -= 1
        if at >= first:
            del self.tags[at:]
            while self.inside and self.inside[-1] >= at:
                self.inside.pop()
        if tag == "a":
            self.open = None

    def handle_data(self, data):
        super().handle_data(data)
        if self.open is not None:
            self.open[1].append(data)


_ROW = ["table_no", "row_no", "cells", "header", "table_id", "table_title"]
_LINK = ["link_no", "href", "anchor_text", "raw_tag"]
_DDL = (
    "table_no int, row_no int, cells array<string>, header array<string>, table_id string, table_title string, "
    "link_no int, href string, anchor_text string, raw_tag string")
_TEXTS = pa.list_(pa.string())
_TYPES = {n: _TEXTS if n in ("cells", "header") else pa.int32() if n.endswith("_no") else pa.string() for n in (*_ROW, *_LINK)}
PAGES_AT_ONCE = 256


def parse_pages(
    pages: DataFrame, page: str, html: str, within: tuple[str, str, str] | None = None,
    keep: Sequence[str] = (), wanted: Sequence[str] = (*_ROW, *_LINK), page_no: str | None = None, spread: bool = True,
) -> DataFrame:
    """Every table row and every anchor of each page, from one parse.

    Table rows have a ``table_no``, anchors have a ``link_no``; the other columns are
    missing.  Columns of the page named in ``keep`` stay, and only the ``wanted`` ones are
    made.  With ``page_no``, what belongs to a page comes in one piece under its number in
    the task: the page itself (neither row nor anchor), its rows, its anchors; only the
    first has the columns of the page.  Pages that a shuffle has dealt out already need no
    ``spread``.
    """
    own = [page, *keep]
    read = pages.select(*own, html)

    def parsed(batch: pa.RecordBatch, first: int) -> pa.RecordBatch:
        rows, links, headers, header = [], [], [], []
        of_row, of_link, row_at, link_at, page_at, numbers = [], [], [], [], [], []
        for k, text in enumerate(batch.column(len(own)).to_pylist()):
            reader = _Page(within)
            reader.read(text or "")
            last = None
            for row in reader.rows:  # a table's header is written once and taken for all its rows
                if row[3] is not last:
                    last = row[3]
                    headers.append(last)
                header.append(len(headers) - 1)
            n, m = len(reader.rows), len(reader.links)
            if page_no:
                row_at += [None, *range(len(rows), len(rows) + n), *[None] * m]
                link_at += [None] * (1 + n) + [*range(len(links), len(links) + m)]
                page_at += [k, *[None] * (n + m)]
                numbers += [first + k] * (1 + n + m)
            rows += reader.rows
            of_row += [k] * n
            links += [(i, h, "".join(t), raw) for i, (h, t, raw) in enumerate(reader.links)]
            of_link += [k] * m
        if not page_no:
            row_at, link_at, page_at = [*range(len(rows)), *[None] * len(links)], [None] * len(rows) + [*range(len(links))], of_row + of_link
        at_row, at_link, at_page = (pa.array(x, pa.int64()) for x in (row_at, link_at, page_at))
        made = {}
        for names, values, at in ((_ROW, rows, at_row), (_LINK, links, at_link)):
            for i, n in enumerate(names):
                if n in wanted:
                    given, of = (headers, pa.array(header, pa.int64()).take(at)) if n == "header" else ([v[i] for v in values], at)
                    made[n] = pa.array(given, _TYPES[n]).take(of)
        number = {page_no: pa.array(numbers, pa.int64())} if page_no else {}
        return pa.RecordBatch.from_pydict(number | {n: batch.column(i).take(at_page) for i, n in enumerate(own)} | {n: made[n] for n in wanted})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = 0
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                yield parsed(batch.slice(at, PAGES_AT_ONCE), first + at)
            first += batch.num_rows

    made = {f.name: f for f in T.StructType.fromDDL(_DDL).fields}
    numbered = [T.StructField(page_no, T.LongType())] if page_no else []
    given = [T.StructField(n, pages.schema[n].dataType, pages.schema[n].nullable or bool(page_no)) for n in own]
    return (fan_out(read) if spread else read).mapInArrow(run, T.StructType([*numbered, *given, *[made[n] for n in wanted]]))


def table_rows(parsed: DataFrame, page: str) -> DataFrame:
    return parsed.filter("table_no is not null").select(page, *_ROW)


def anchors(parsed: DataFrame, page: str) -> DataFrame:
    return parsed.filter("link_no is not null").select(page, *_LINK)


def extract_tables(pages: DataFrame, page: str, html: str) -> DataFrame:
    """One row per table row: page, table and row number, cells, first row, table id and title."""
    return table_rows(parse_pages(pages, page, html), page)


def extract_links(pages: DataFrame, page: str, html: str, within: tuple[str, str, str] | None = None) -> DataFrame:
    """One row per anchor, optionally only inside an element (tag, attribute, value)."""
    return anchors(parse_pages(pages, page, html, within), page)


def with_header(rows: DataFrame, page: str, names: Sequence[str]) -> DataFrame:
    """Use the first row of each table as its header and pick columns by header text."""
    return rows.filter("row_no > 0").select(page, "table_no", "row_no", "table_title", *[
        F.try_element_at("cells", F.nullif(F.array_position("header", n), F.lit(0)).cast("int")).alias(n) for n in names
    ])


def title_part(c: str, index: int) -> Column:
    """Part of a comma-separated attribute."""
    return F.get(F.split(c, ","), F.lit(index))


# Cell columns of a village table and the script link behind each village (fixed values).
VILLAGE_COUNTS = ("New", "Revived", "PreNRLM", "Total", "Members")
VILLAGE_LINK = r"javascript:SHGList\('(\d+)','(.*?)','(.*?)'\)"


def clean_village_name(c) -> Column:
    return squeeze(title_case(c))


def parse_village_pages(pages: DataFrame, page: str, html: str, table_id: str = "example") -> DataFrame:
    """Village pages parsed once and written, because rows and links are both read from them."""
    return cut_lineage(parse_pages(pages, page, html, within=("table", "id", table_id)))


def _village_cells(raw: str = "village") -> list[Column]:
    """Cells of a row by name, the village under ``raw``; blank ones are missing."""
    return [blank_to_null(F.get("cells", F.lit(i))).alias(n) for i, n in enumerate((raw, *VILLAGE_COUNTS), start=1)]


def _linked(group: int) -> Column:
    return capture("href", VILLAGE_LINK, group, fallback="raw_tag")


def village_rows(parsed: DataFrame, page: str) -> DataFrame:
    """First table of each page as village rows: no totals, no empty rows, numbers coerced."""
    rows = table_rows(parsed, page).filter("table_no = 0 and row_no > 0")
    cells = rows.select(page, "row_no", *_village_cells())
    kept = cells.na.drop("all", subset=["village", *VILLAGE_COUNTS]).filter(~mentions("village", "Total"))
    return kept.select(
        page, "row_no", clean_village_name("village").alias("village"),
        *[number_from_text(n, "double").alias(n) for n in VILLAGE_COUNTS],
    )


def village_links(parsed: DataFrame, page: str) -> DataFrame:
    """(page, village, code, short name) per village link; the last link of a village wins."""
    named = anchors(parsed, page).select(
        page, "link_no", *[_linked(i).alias(n) for i, n in ((1, "code"), (2, "short_name"), (3, "name"))],
    ).withColumn("village", clean_village_name("name"))
    from quadrat.operators.groups import last_row

    return last_row(named, [page, "village"], ["link_no"]).select(page, "village", "code", "short_name")


def village_entries(
    pages: DataFrame, page: str, html: str, keep: Sequence[str] = (), table_id: str = "example", spread: bool = True
) -> DataFrame:
    """One row per page: the rows of :func:`village_rows` with the last link of their village on the page.

    A row of ``rows`` without a ``link_no`` has no link; ``lost`` is the smallest village of
    such rows, ``filled`` says whether there are rows at all.  ``links`` has the last link of
    every other village, for rows on other pages.  Nothing is shuffled.
    """
    parsed = parse_pages(
        pages, page, html, ("table", "id", table_id), keep, ["table_no", "row_no", "cells", "link_no", "href", "raw_tag"], "page_no", spread)
    own, of_link = [page, *keep], ["link_no", "code", "short_name"]
    row, link = F.col("table_no").isNotNull(), F.col("link_no").isNotNull()
    cells = parsed.select("page_no", *own, "table_no", "row_no", *_village_cells("cell"), "link_no", "href", "raw_tag")
    filled = F.coalesce("cell", *VILLAGE_COUNTS).isNotNull() & ~mentions("cell", "Total")
    named = cells.filter(F.col("table_no").isNull() | ((F.col("table_no") == 0) & (F.col("row_no") > 0) & filled)).select(
        "page_no", *own, F.when(row, 1).when(link, 2).otherwise(0).cast("byte").alias("kind"),
        clean_village_name(F.when(link, _linked(3)).otherwise(F.col("cell"))).alias("village"),
        *[number_from_text(n, "double").alias(n) for n in VILLAGE_COUNTS],
        "link_no", *[F.when(link, _linked(i)).alias(n) for i, n in ((1, "code"), (2, "short_name"))])
    of_rows, of_links = (T.StructType([named.schema[n] for n in names]) for names in (["village", *VILLAGE_COUNTS, *of_link], ["village", *of_link]))
    schema = T.StructType([
        *[named.schema[n] for n in own], T.StructField("rows", T.ArrayType(of_rows)), T.StructField("links", T.ArrayType(of_links)),
        T.StructField("lost", T.StringType()), T.StructField("filled", T.BooleanType())])

    def linked(entries: pa.RecordBatch) -> pa.RecordBatch:
        kinds, villages = entries.column("kind").to_numpy(), entries.column("village").to_pylist()
        starts = (kinds == 0).nonzero()[0]
        ends = [*starts[1:].tolist(), len(kinds)]
        first_links = [start + 1 + n for start, n in zip(starts.tolist(), np.add.reduceat(kinds == 1, starts, dtype=int).tolist())]
        row_at, found, rest, lost, rows_to, links_to = [], [], [], [], [0], [0]
        for start, first, end in zip(starts.tolist(), first_links, ends):
            last = dict(zip(villages[first:end], range(first, end)))
            last.pop(None, None)
            hits = [last.get(v) for v in villages[start + 1:first]]
            row_at += range(start + 1, first)
            found += hits
            rest += sorted(set(last.values()).difference(hits))
            lost.append(min((v for v, h in zip(villages[start + 1:first], hits) if h is None and v is not None), default=None) if None in hits else None)
            rows_to.append(len(row_at))
            links_to.append(len(rest))
        row_at, found, rest = (pa.array(x, pa.int64()) for x in (row_at, found, rest))
        taken = {n: entries.column(n).take(row_at) for n in ("village", *VILLAGE_COUNTS)} | {n: entries.column(n).take(found) for n in of_link}
        others = {n: entries.column(n).take(rest) for n in ("village", *of_link)}
        lists = [
            pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.StructArray.from_arrays([*columns.values()], [*columns]))
            for to, columns in ((rows_to, taken), (links_to, others))]
        values = [*[entries.column(n).take(pa.array(starts)) for n in own], *lists, pa.array(lost, pa.string()), pc.greater(pc.list_value_length(lists[0]), 0)]
        return pa.RecordBatch.from_arrays(values, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = pc.index(batch.column("page_no"), batch.column("page_no")[-1]).as_py()  # where the last page of the batch begins
            if last or (waiting and waiting[-1].column("page_no")[-1] != batch.column("page_no")[0]):
                yield linked(pa.concat_batches([*waiting, batch.slice(0, last)]))
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield linked(pa.concat_batches(waiting))

    return named.mapInArrow(run, schema)
