"""Queries under other actions than a full read, and corrected corner cases."""

import math

import pytest
from compare import DATA
from conftest import rows

import __spark_entry__ as entry_points
from quadrat.functions import language as L
from quadrat.operators import abstracts as A, infer as I, ledger as R, pages as H, quantiles as Q
from quadrat.plans import papers as P, wages
from quadrat.queries.registry import Tables
from quadrat.sources import readers as S

PAPER_QUERIES = ["paper_subset", "paper_titles", "paper_errors", "abstract_rebuild", "language_detect", "name_clean"]


@pytest.mark.skipif(not DATA.exists(), reason="shared tables are not here")
@pytest.mark.parametrize("name", PAPER_QUERIES)
def test_counts_and_single_columns(spark, name):
    df = entry_points.queries()[name](spark, str(DATA / "sf0.001"))
    n = len(df.collect())
    assert df.count() == n
    for c in df.columns:
        assert len(df.select(c).collect()) == n


def test_one_literal_paper(spark):
    row = spark.createDataFrame([("1", 1970, None, "The title", A_TEXT, "0", 3)], P.PAPER_SCHEMA + ", file_idx string, line_no bigint")
    out = P.route(P.prepare(row))
    assert out.subset.count() == 1 and out.subset.select("id").count() == 1 and out.titles.count() == 1


A_TEXT = '{"IndexLength":4,"InvertedIndex":{"it":[0],"is":[1],"the":[2],"end":[3]}}'


def test_index_in_the_row(spark):
    texts = ["to be or not to be", "a", "", 'say "hi" there, ["x"]: {y} a\\b', "w " * 5000 + "w"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    out = A.rebuild_text(df.select("k", A.inverted_index("t").alias("ix")), "ix", "text", "bad")
    assert rows(out.select("k", "text", "bad"), "k") == [(i, t.replace('"', "'"), False) for i, t in enumerate(texts)]


def test_unknown_fields_of_a_record_stay(spark, tmp_path):
    (tmp_path / "p_7.json").write_text('{"id":"1","year":1970,"title":"T","venue":"V","authors":["a","b"]}\nbroken\n')
    good, bad = P.records(S.read_json_lines(spark, str(tmp_path), P.PAPER_SCHEMA))
    one = good.collect()[0]
    assert (one.id, one.file_idx, one.line_no, one.other) == ("1", "7", 0, {"venue": "V", "authors": '["a","b"]'})
    assert [r.line_no for r in bad.collect()] == [1]


def test_ingest_writes_titles_and_line_numbers(spark, tmp_path):
    from quadrat.streaming.ingest import ingest_papers

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "p_3.json").write_text(
        "nonsense\n" + '{"id":"1","year":1970,"title":"The end of it","indexed_abstract":' + A_TEXT.replace('"', '\\"').join('""') + "}\nmore nonsense\n")
    ingest_papers(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert rows(spark.read.parquet(str(tmp_path / "out" / "errors")).select("file_idx", "line_no"), "line_no") == [("3", 0), ("3", 2)]
    assert [r.title for r in spark.read.parquet(str(tmp_path / "out" / "titles")).collect()] == ["The end of it"]


def test_links_inside_an_element_with_open_tags(spark):
    html = "<a href='0'>a</a><table id='t'><tr><td><p>x<a href='1'>b</a><tr><td><a href='2'>c</a></div></table><p><a href='3'>d</a><table><tr><td><a href='4'>e</a></table>"
    df = spark.createDataFrame([(1, html)], "k int, html string")
    assert [r.href for r in H.extract_links(df, "k", "html", ("table", "id", "t")).collect()] == ["1", "2"]


def test_quantiles_with_infinities(spark):
    values = [float(i) for i in range(980)] + [math.inf] * 15 + [-math.inf] * 5
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "x double")
    ordered = sorted(values)
    got = Q.values_at_ranks(df, "x", [1, 5, 6, 500, 985, 986, 1000], bins=16, small=10)
    assert got == {r: ordered[r - 1] for r in (1, 5, 6, 500, 985, 986, 1000)}
    assert Q.percentiles(df, "x", [0.1, 50, 99.9], bins=16, small=10) == [-math.inf, (ordered[499] + ordered[500]) / 2, math.inf]


def test_quantiles_of_huge_numbers(spark):
    values = [-1.7e308, 1.7e308] + [i * 1e306 for i in range(-100, 100)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert Q.values_at_ranks(df, "x", [1, 101, 202], bins=16, small=5) == {r: sorted(values)[r - 1] for r in (1, 101, 202)}


def test_ragged_rows_follow_file_names(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"1,one\n2\n")
    (tmp_path / "b.csv").write_bytes(b"3," + b"x" * 500 + b"\n")
    got = rows(S.read_ragged(spark, str(tmp_path)), "row_no")
    assert [(r[0], r[1][0]) for r in got] == [(0, "1"), (1, "2"), (2, "3")]


def test_two_states_are_an_error(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 1)], "state_a int, state_b int")
    assert sorted(r.state for r in wages.with_state(df).collect()) == ["none", "state_a", "state_b"]
    with pytest.raises(Exception, match="more than one state"):
        wages.with_state(spark.createDataFrame([(1, 1)], "state_a int, state_b int")).collect()


def test_failed_batches_are_halved(spark):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def fn(batch):
            calls.add(1)
            if (batch["k"] == 37).any():
                raise ValueError("bad row")
            return batch.assign(out=batch["k"] * 2)

        return fn

    out = R.attempt_rows(spark.range(128).toDF("k").coalesce(1), ["k"], load, "out bigint", batch_rows=128).collect()
    assert sorted((r.k, r.out, r.ok) for r in out) == [(k, None if k == 37 else 2 * k, k != 37) for k in range(128)]
    assert calls.value < 60


def test_detector_gets_batches(spark):
    def load():
        def predict(texts):
            if "bad" in texts:
                raise ValueError
            return [f"{t}!" for t in texts]

        return predict

    df = spark.createDataFrame([("a",), ("bad",), ("",), (None,), ("c",)], "t string").coalesce(1)
    got = sorted(((r.t or "", r.lang, r.lang_failed) for r in L.detect_with(df, "t", load).collect()), key=str)
    assert got == sorted([("", "nan", False), ("", "nan", False), ("a", "a!", False), ("bad", None, True), ("c", "c!", False)], key=str)


def test_all_names_are_found(spark):
    text = " ".join(f"Name{'x' * i}" for i in range(40)) + " Al"
    df = spark.createDataFrame([(1, text)], "k int, t string")
    assert R.attempt_rows(df, ["k"], I.capitalised_terms("t"), "ner string").first().ner.count(",") == 40


def test_tables_reader_reads_by_name(spark):
    with pytest.raises(AttributeError):
        Tables(spark, "/nowhere")._private
