"""Substitution, gazetteers, inverted indexes, pages, ledgers, model batches."""

import json
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quadrat.operators import abstracts as A, infer as I, ledger as L, pages as H, substitute as U
from quadrat.plans import names as N, papers as P


def term_table(spark, cells):
    return U.substitution_table(spark.createDataFrame(list(enumerate(cells)), "row_no int, cells array<string>"))


def python_substitute(pairs, text):
    table = dict(pairs)
    pattern = re.compile(r"\b(%s)\b" % "|".join(map(re.escape, table)), re.IGNORECASE)
    return pattern.sub(lambda m: table[m.group().lower()], text)


TEXTS = ["a b c", "New York city, new york", "b a; B-A", "york new", "", "the new york city hall", "x.y (c++)", "abc"]


@pytest.mark.parametrize("limit", [200_000, 2])
def test_substitution_is_simultaneous(spark, monkeypatch, limit):
    """In one part or several it equals one pass of a Python alternation."""
    monkeypatch.setattr(U, "TERMS_AT_ONCE", limit)
    table = term_table(spark, [["b", "a", "zzz"], ["a", "b"], ["NYC", "new york city", "new york"], ["last", "zzz"]])
    pairs = [("a", "b"), ("zzz", "last"), ("b", "a"), ("new york city", "NYC"), ("new york", "NYC")]
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    got = [r.o for r in U.substitute_by_table(df, "id", "t", table, "o").orderBy("id").collect()]
    assert got == [python_substitute(pairs, t) for t in TEXTS]


def test_variants_of_any_characters(spark):
    """Accented, punctuated and quoted variants among more than 2,000 others."""
    table = term_table(spark, [["and", "&"], ["cafe", "café"], ["ete", "é"], ["quoted", "a\\Eb"], *[[f"w{i}", f"v{i}"] for i in range(2500)]])
    df = spark.createDataFrame([(0, "x&y café é a\\Eb c++ d"), (1, "V7 v2499 v2500 v7v"), (2, None), (3, "")], "id int, t string")
    got = [r.o for r in U.substitute_by_table(df, "id", "t", table, "o").orderBy("id").collect()]
    assert got == ["xandy cafe ete quoted c++ d", "w7 w2499 v2500 v7v", None, ""]


@pytest.mark.parametrize("limit", [200_000, 1])
def test_longer_place_goes_first(spark, monkeypatch, limit):
    monkeypatch.setattr(U, "TERMS_AT_ONCE", limit)
    places = U.cleaned_places(spark.createDataFrame([("York",), ("New York ",), ("12",), (None,), ("baden-baden",)], "l string"), "l")
    df = spark.createDataFrame([(0, "in New York now"), (1, "york x"), (2, "Baden-Baden baden"), (3, "none")], "id int, t string")
    assert [r.o for r in U.remove_places(df, "id", "t", places, "o").orderBy("id").collect()] == ["in  now", " x", " baden", "none"]


def test_names_end_to_end(spark):
    df = spark.createDataFrame([
        (1, "ABC Pvt Ltd!!", "<b>Sales&nbsp;and</b> mktg in Delhi, the best?"), (2, "Other", "not mentioned"), (3, "", "Dr. X"), (4, None, None),
    ], "id int, name string, desc string")
    places = U.cleaned_places(spark.createDataFrame([("Delhi",)], "l string"), "l")
    out = N.clean_names(df, "id", "name", "desc", places, term_table(spark, [["best in class", "the best"]]), term_table(spark, [["marketing", "mktg"]]))
    assert rows(out, "id") == [(1, "ABC . Sales marketing , best."), (2, ". mentioned"), (3, ". Dr. X"), (4, "")]


def index(words):
    at = {}
    for i, w in enumerate(words):
        at.setdefault(w, []).append(i)
    return '{"IndexLength":%d,"InvertedIndex":{%s}}' % (len(words), ",".join(f'"{w}":{json.dumps(p)}'.replace(" ", "") for w, p in at.items()))


def test_rebuild_edge_cases(spark):
    data = [
        ("plain", index(["to", "be", "or", "not", "to", "be"])), ("quote", index(['say', '"hi"', "back\\slash"])),
        ("gap", '{"IndexLength":4,"InvertedIndex":{"a":[0],"b":[3]}}'), ("empty", '{"IndexLength":0,"InvertedIndex":{}}'),
        ("broken", '{"IndexLength":3,"InvertedIndex":{"a":[0'), ("beyond", '{"IndexLength":1,"InvertedIndex":{"a":[5]}}'),
        ("clash", '{"IndexLength":2,"InvertedIndex":{"a":[0,1],"b":[1]}}'), ("missing", None),
    ]
    out = A.rebuild_text(spark.createDataFrame(data, "k string, ix string"), "ix", "text", "bad")
    got = {r.k: (r.text, r.bad) for r in out.collect()}
    assert got == {
        "plain": ("to be or not to be", False), "quote": ("say 'hi' back\\slash", False), "gap": ("a b", False), "empty": ("", False),
        "broken": ("", True), "beyond": ("", True), "clash": ("a b", False), "missing": ("", False)}


def test_paper_subset(spark):
    data = [
        ("1", 1970, "Journal", " The  title of it ", index("the cat is on the mat".split()), "0", 0),
        ("2", 1990, "Journal", "late", None, "0", 1), ("3", 1970, "Patent", "patent", None, "0", 2), ("4", None, None, "no year", None, "0", 3),
        ("5", 1970, None, "the one with a broken index", "{oops", "0", 4), ("6", 1970, None, "le titre est dans la page", None, "1", 0),
        ("7", 1970, None, None, None, "1", 1), ("1", 1971, None, "the newer title is this", None, "1", 2),
    ]
    papers = spark.createDataFrame(data, "id string, year int, doc_type string, title string, indexed_abstract string, file_idx string, line_no long")
    out = P.subset_papers(papers)
    assert rows(out.subset.select("id", "title", "abstract"), "id", "title") == [
        ("1", "The title of it", "the cat is on the mat"), ("1", "the newer title is this", ""), ("5", "the one with a broken index", "")]
    assert rows(out.errors.select("error", "file_idx", "line_no", "payload")) == [("abstract", "0", 4, "{oops")]
    assert dict(rows(out.titles)) == {"1": "the newer title is this", "5": "the one with a broken index"}


PAGE = """<html><a href="/skip">x</a><table id="example" title="a,42"><tr><th>Sr</th><th>Village</th><th>New</th></tr>
<tr><td>1</td><td><a href="javascript:SHGList('7','ab','ram PUR')">ram
 PUR</a></td><td>1,200</td><td>x</td></tr><tr><td></td><td>Total</td><td>3</td></tr><tr><td></td><td></td></tr>
<tr><td>2</td><td><a href="javascript:SHGList('8','cd',
'o'nagar')">o'nagar</a><table><tr><td>inner</td></tr></table></td><td>5</td></tr></table></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "no table"), (3, None)], "id int, html string")
    tables = H.extract_tables(pages, "id", "html")
    assert rows(tables.filter("table_no = 0").select("row_no", "cells"), "row_no")[1] == (1, ["1", "ram PUR", "1,200", "x"])
    assert rows(tables.filter("table_no = 1").select("cells")) == [(["inner"],)]
    assert {r.t for r in tables.filter("table_no = 0").select(H.title_part("table_title", 1).alias("t")).collect()} == {"42"}
    links = H.extract_links(pages, "id", "html", within=("table", "id", "example"))
    assert links.count() == 2 and H.extract_links(pages, "id", "html").count() == 3
    parsed = H.parse_village_pages(pages, "id", "html")
    village = H.village_rows(parsed, "id").select("village", "New", "Revived")
    assert rows(village, "village") == [("O'Nagar", 5.0, None), ("Ram Pur", 1200.0, None)]
    got = rows(H.village_links(parsed, "id").select("village", "code", "short_name"), "code")
    assert got == [("Ram Pur", "7", "ab"), ("O'Nagar", "8", "cd")]


def fail_on(words):
    def load(attempt):
        def run(batch):
            if batch["t"].isin([w for w, until in words.items() if attempt < until]).any():
                raise RuntimeError("bad " + batch["t"].iloc[0])
            return batch.assign(out=batch["t"].str.upper())
        return run
    return load


def test_ledger_blames_the_failing_row(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "x", "b", "y", "c"])], "id int, t string")
    place = str(tmp_path / "ledger")
    out = L.run_until_done(df, ["id"], fail_on({"x": 99, "y": 3}), "out string", place, max_tries=4, batch_rows=2, attempt_arg=True)
    assert rows(out.select("id", "out", "ok", "error", "attempt"), "id") == [
        (0, "A", True, None, 1), (1, None, False, "bad x", 4), (2, "B", True, None, 1), (3, "Y", True, None, 3), (4, "C", True, None, 1)]
    # a second run resumes: only the open key is tried again
    again = L.run_until_done(df, ["id"], fail_on({}), "out string", place, max_tries=4, attempt_arg=True)
    assert rows(again.select("id", "out", "attempt").filter("id = 1")) == [(1, "X", 5)] and again.filter("ok").count() == 5
    good, bad = L.split_outcomes(out)
    assert good.count() + bad.count() == df.count()
    assert [r[0] for r in rows(L.completion_report(out, ["id"]))] == ["completed"] * 4 + ["errors"]
    assert rows(L.error_counts(bad.withColumn("stage", F.lit("s")))) == [("s", 1)]


def test_work_reports(spark):
    work = spark.createDataFrame([("c", "s1"), ("c", "s2"), ("d", "s1")], "c string, s string")
    done = spark.createDataFrame([("c", "s1"), ("d", "s1")], "c string, s string")
    assert rows(L.unresolved(work, done, ["c"], "s")) == [("c", ["s2"])]
    log = spark.createDataFrame([("c", 2, "late"), ("c", 1, "early")], "c string, a int, m string")
    assert rows(L.fold_log(log, ["c"], "a", "m")) == [("c", "early >>> late")]


def test_compose_and_embed(spark):
    data = [("p", "T", "A", "R", ""), ("q", "", "A", "R", "F")]
    df = spark.createDataFrame(data, "id string, title string, abstract string, references string, fos string")
    got = dict(rows(I.compose_inputs(df, "id").select("variant", "text")))
    assert got == {"titleAbstract": "T[SEP]A", "titleRefs": "T[SEP]References: R.", "titleAbstractRefs": "T[SEP]A[SEP]References: R."}
    vec = I.embed_texts(spark.createDataFrame([(1, "a b a"), (2, "")], "id int, t string"), ["id"], "t").orderBy("id").collect()
    assert abs(sum(v * v for v in vec[0].embedding) - 1) < 1e-6 and max(vec[1].embedding) == 0
