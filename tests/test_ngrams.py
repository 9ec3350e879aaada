"""The trigram language model: accuracy, odd rows, the loader for batches."""

import pytest
from compare import DATA
from pyspark.sql import functions as F

from quadrat.functions import language as L
from quadrat.operators import ngrams as N


@pytest.fixture(scope="module")
def model(spark):
    rows = [("en", "the cat sat on the mat and looked at the other dog with great interest"), ("de", "der Hund und die Katze sind nicht in dem großen Haus gewesen"),
            ("ru", "кошка сидела на большом столе и смотрела в окно"), ("uk", "кішка сиділа на великому столі і дивилася у вікно"), ("ja", "これはペンです"), (None, "no label"), ("xx", None), ("yy", "12 34")]
    return N.fit(spark.createDataFrame(rows, "label string, text string"), "label", "text")


def test_script_first_then_language(spark, model):
    rows = [(1, "the dog and the cat"), (2, "die Katze und der Hund"), (3, "большая кошка на столе"), (4, "велика кішка і вікно"), (5, "です"), (6, "日本"), (7, ""), (8, None), (9, "123 456"), (10, "x" * 2_500_000), (11, "ab")]
    df = spark.createDataFrame([(*r, "", "") for r in rows], "id int, text string, Script string, lead string").repartition(3)
    got = {r["id"]: (r["detected"], r["script"]) for r in N.predict(df, model).collect()}
    assert [got[i][0] for i in range(1, 6)] == ["en", "de", "ru", "uk", "ja"]
    assert got[6] == ("nan", "han") and got[7] == got[8] == got[9] == ("nan", None)
    assert got[10][1] == "latin" and got[11] == ("en", "latin")  # no trigram: all tie, the last name
    assert N.predict(df.limit(0), model).count() == 0


def test_as_detector_for_batches(spark, model):
    df = spark.createDataFrame([("the cat and the dog",), ("кошка на столе",), (None,)], "text string")
    assert [r["lang"] for r in L.detect_with(df, "text", N.detector(model)).collect()] == ["en", "ru", "nan"]


@pytest.mark.skipif(not DATA.exists(), reason="shared tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").filter("lang is not null and text rlike '[a-z]{3}'")
    held = F.col("doc_id") % 3 == 1
    found = N.predict(docs.filter(held), N.fit(docs.filter(~held), "lang", "text"))
    assert found.agg(F.avg((F.col("detected") == F.col("lang")).cast("int"))).first()[0] >= 0.95
