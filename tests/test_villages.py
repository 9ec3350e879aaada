"""The village job: rows and links of councils, however their pages and their places in the list repeat."""

import random

import pytest
from pyspark.sql import functions as F

from quadrat.operators import merge as J, pages as H
from quadrat.plans import villages

WORK = "file_key string, " + ", ".join(f"{n} string" for n in villages.LEVELS)
NAMES = ["FOO", "o'bar-2", "Foo ", "béta", "SUBTOTAL", "Grand Total"]


def _by_joins(work, pages):
    """Every rule as a join over whole tables."""
    parsed = H.parse_village_pages(pages.join(work.select("file_key"), "file_key", "left_semi"), "file_key", "html")
    rows, links = H.village_rows(parsed, "file_key"), H.village_links(parsed, "file_key")
    found, missed = J.strict_lookup(rows, links.withColumn("link", F.struct("code", "short_name")), ["file_key", "village"], "link")
    reason = work.select("file_key").join(pages.select("file_key").distinct().withColumn("page", F.lit(True)), "file_key", "left")
    reason = reason.join(rows.select("file_key").distinct().withColumn("table", F.lit(True)), "file_key", "left")
    reason = reason.join(missed.groupBy("file_key").agg(F.min("village").alias("village")), "file_key", "left")
    text = F.when(F.col("page").isNull(), "no page").when(F.col("table").isNull(), "no table").when(
        F.col("village").isNotNull(), F.concat(F.lit("no link for "), "village"))
    errors = reason.select("file_key", text.alias("error")).filter("error is not null")
    good = J.drop_in(found, errors, ["file_key"]).join(work.select("file_key", *villages.LEVELS), "file_key")
    return good.select("file_key", *villages.LEVELS, F.col("village").alias("Village"), *H.VILLAGE_COUNTS, "link.code", "link.short_name"), errors


def _page(draw, k):
    """A page with 0 to 5 rows; now and then a row without a link, a link without a row, nothing at all."""
    if draw.random() < 0.1:
        return draw.choice([None, "", "no table", "<table id='example'><tr><td>only a head</td></tr></table>", "<table id='other'><tr><td>1</td></tr><tr><td>2</td><td>x</td></tr></table>"])
    out = "<a href=\"javascript:SHGList('9','z','Outside')\">Outside</a>"
    for i in range(draw.randint(0, 5)):
        name = draw.choice(NAMES)
        # codes follow from place and name: links of one place on two pages are alike or of unlike villages
        link = f"<a href=\"javascript:SHGList('{i}{len(name)}','s{i}','{name}')\">{name}</a>"
        link = draw.choice([link] * 6 + [name, link.replace("SHGList(", "SHG\nList("), link.replace("SHGList", "Other"), f"{link}<br>x", ""])
        cells = [str(i), link, draw.choice(["1,234", "", "n/a"]), draw.choice(["5", ""]), "", draw.choice(["7", "0"])][:draw.randint(2, 6)]
        out += "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    extra = "<tr><td><table><tr><td>in</td><td>Inner</td></tr><tr><td>in</td><td>Inner</td></tr></table></td></tr>" if draw.random() < 0.1 else ""
    return f"<table id='example'><tr><th>h</th></tr>{out}{extra}<tr><td></td><td>Total</td><td>9</td></tr><tr><td></td><td></td></tr></table>"


def _same(got, wanted):
    for a, b in zip(got, wanted, strict=True):
        assert a.columns == b.columns
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("repeats", [False, True])
def test_village_table_equals_joins(spark, tmp_path, repeats):
    draw = random.Random(7)
    keys = [f"s_d_b_{k}" for k in range(150)]
    listed = [(k, "s", "d", "b", f"{k}/{i}") for k in keys[:120] for i in range(draw.choice([1, 1, 2, 3]) if repeats else 1)] + [(None, "s", "d", "b", "x")] * 2
    stored = [(k, _page(draw, k)) for k in keys[10:] for _ in range(draw.choice([1, 1, 2, 3]) if repeats else 1)] + [(None, _page(draw, ""))]
    work = spark.createDataFrame(listed, WORK)
    spark.createDataFrame(stored, "file_key string, html string").write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    wanted = _by_joins(work, pages)
    assert wanted[0].count() > 50 and {e.error[:7] for e in wanted[1].collect()} == {"no page", "no tabl", "no link"}
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # pages go on from batch to batch
    try:
        _same(villages.village_table(work, pages), wanted)
        named = work.dropDuplicates(["file_key"]).join(pages, "file_key")
        _same(villages.village_table(work, named.withColumnRenamed("html", "text"), F.col("text")), wanted)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_link_on_another_page(spark):
    work = spark.createDataFrame([("k", "s", "d", "b", "g"), ("l", "s", "d", "b", "h")], WORK)
    table = "<table id='example'><tr><th>h</th></tr>{}</table>"
    row, link = "<tr><td>1</td><td>{}</td><td>2</td></tr>", "<a href=\"javascript:SHGList('{}','x','Foo')\">Foo</a>"
    texts = {"rows": table.format(row.format("FOO")), "links": table.format(link.format(1) + link.format(2))}
    good, errors = villages.village_table(work, spark.createDataFrame([("k", texts["rows"]), ("k", texts["links"]), ("l", texts["rows"])], "file_key string, html string"))
    assert [(r.file_key, r.Village, r.code) for r in good.collect()] == [("k", "Foo", "2")]
    assert [tuple(r) for r in errors.collect()] == [("l", "no link for Foo")]


def test_page_of_many_rows(spark):
    rows = "".join(f"<tr><td>{i}</td><td><a href=\"javascript:SHGList('{i}','x','v {i}')\">V {i}</a></td><td>{i}</td></tr>" for i in range(25_000))
    pages = spark.createDataFrame([("k", f"<table id='example'><tr><th>h</th></tr>{rows}</table>"), ("l", None)], "file_key string, html string")
    entries = H.village_entries(pages.coalesce(1).withColumn("State", F.lit("s")), "file_key", "html", ["State"])
    assert [r.State for r in entries.select("State").collect()] == ["s", "s"]
    rows = entries.select("file_key", F.inline("rows"))
    found = rows.agg(F.count("link_no"), F.sum((F.concat(F.lit("V "), "code") == F.col("village")).cast("int")), F.sum("New")).first()
    assert tuple(found) == (25_000, 25_000, sum(range(25_000)))
    assert sorted((r.file_key, r.filled, len(r.links)) for r in entries.collect()) == [("k", True, 0), ("l", False, 0)]


def test_job_neither_writes_pages_nor_shuffles_rows(spark, tmp_path, monkeypatch):
    from quadrat.queries import QUERIES, jobs

    written, tables = [], []
    monkeypatch.setattr(villages, "village_table", lambda *a, table=villages.village_table: tables.append(table(*a)) or tables[-1])
    for module in (m for m in (jobs, villages, H) if hasattr(m, "cut_lineage")):
        monkeypatch.setattr(module, "cut_lineage", lambda df, *a, cut=module.cut_lineage: written.append(set(df.columns)) or cut(df, *a))
    mk = spark.createDataFrame
    mk([(0, "ASIA")], "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    mk([(0, "A/B", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    mk([(1, 0, "M_1")], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    mk([(k, 1) for k in (3, 10, 11, 12, 13)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(k, 5, 6, n, 2.0 + n, 0.01 * n, "R", "O") for k in (3, 10, 11, 12) for n in (1, 2)]
    mk(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_linestatus string").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    out = QUERIES["village_job"](spark, str(tmp_path))
    got = sorted(map(tuple, out.collect()), key=str)
    key = "ASIA_AB_M1_"
    assert got == sorted([
        (f"{key}3", "Village O'R-1-5-6-O", 3.0, "5", None), (f"{key}3", "Village O'R-2-5-6-O", 4.0, "5", None), (f"{key}10", None, None, None, "no page"),
        (f"{key}11", None, None, None, "no link for Village O'R-1-5-6-O"), (f"{key}13", None, None, None, "no page")], key=str)
    assert written and not any({"html", "cells", "raw_tag"} & columns for columns in written)
    (good, errors), = tables
    assert ["Exchange" in df._jdf.queryExecution().executedPlan().toString() for df in (good, errors)] == [False, False]
