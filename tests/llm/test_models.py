"""Held-out accuracy of the two trained models, and their odd rows."""

import random
import zlib

import numpy as np

from quadrat.llm import langid, quality
from quadrat.llm.queries import QUERIES
from tables import table  # noqa: F401

DATA = "/root/testdata/sf0.01"


def test_language_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op3_language_centroids"](spark, DATA).collect()
    assert len(got) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert not any(r["rejected"] for r in got)


def test_language_of_odd_rows(table):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog " * 3, "en"), ("le chat et le chien " * 3, "fr"), ("der hund und die katze " * 3, "de")] * 4)]
    train += [(None, "x", "en"), (50, None, "en"), (51, "123", "fr"), (52, "und", None), (3, train[3][1], "en"), (3, train[3][1], "en")]
    df = table("doc_id bigint, text string, lang string", train)
    model = langid.fit(df)
    assert sorted(set(model.names)) == ["de", "en", "fr"]
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "the dog"), (4, "the dog"), (None, "le chien"), (5, "der hund " * 100_000), (6, "☃☃☃ 你好")]
    out = langid.predict(table("doc_id bigint, text string, Score int, lang_pred int", [(*r, 0, 0) for r in rows]), model).collect()
    by = {(r["doc_id"], r["text"]): (r["lang_pred"], r["rejected"]) for r in out}
    assert len(out) == len(rows)
    assert by[1, None] == by[2, ""] == by[3, "12 !?"] == ("und", True)
    assert by[4, "the dog"] == ("en", False) and by[None, "le chien"] == ("fr", False) and by[5, "der hund " * 100_000] == ("de", False)
    assert by[6, "☃☃☃ 你好"][1]  # nothing in common with any language
    empty = langid.fit(df.limit(0))
    assert [tuple(r)[-3:] for r in langid.predict(df.filter("doc_id = 4"), empty).collect()] == [("und", 0.0, True)]
    assert langid.predict(df.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = QUERIES["op4_quality_positive_unlabelled"](spark, DATA).collect()
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good, bad = ([s for s, y in held if y == side] for side in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.95


def test_prior_from_two_samples():
    rng = np.random.default_rng(0)
    positive = rng.normal(1.5, 1, (3000, 4))
    unlabelled = np.concatenate([rng.normal(1.5, 1, (1800, 4)), rng.normal(-1.5, 1, (1200, 4))])
    assert abs(quality.estimate_prior(positive, rng.permutation(unlabelled)) - 0.6) < 0.06
    model = quality.train(positive.astype(np.float32), rng.permutation(unlabelled).astype(np.float32))
    assert (model.raw(rng.normal(1.5, 1, (500, 4))) > 0).mean() > 0.95 and (model.raw(rng.normal(-1.5, 1, (500, 4))) < 0).mean() > 0.95


def test_quality_of_odd_rows(table):
    rows = [(i, "some plain words in a line" if i % 3 else "*** !!! ***", 1) for i in range(40)] + [(None, "x", 1), (3, "a", 1), (3, "a", 1), (60, None, 1), (61, "", 1), (62, "z " * 300_000, 1)]
    df = table("doc_id bigint, text string, SCORE int", rows)
    model = quality.fit(df, df.filter("doc_id % 3 <> 0").select("doc_id"))
    out = quality.score(df, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score(df.limit(0), model).count() == 0
    assert quality.fit(df, df.filter("doc_id < 0").select("doc_id")) is None
    assert {(r["score"], r["predicted"]) for r in quality.score(df, None).collect()} == {(0.5, 1)}


def test_language_sample_is_the_same_from_any_partitions(table):
    rows = [(i, f"{'abc'[i % 3] * 3} word{i} text", "xyz"[i % 3]) for i in range(400)] + [(7, "bbb word7 text", "y")] * 200
    models = [langid.fit(table("doc_id bigint, text string, lang string", rows, parts), sample=20) for parts in (1, 40)]
    assert models[0].names == models[1].names and np.allclose(models[0].centres, models[1].centres, atol=1e-5)
    assert np.array_equal(models[0].idf, models[1].idf)


def test_unlearned_languages_and_random_letters_are_rejected(spark, table):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out("doc_id")))
    italian = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, perché la diritta via era smarrita. Quanto a dir qual era è cosa "
               "dura questa selva selvaggia e aspra e forte che nel pensier rinnova la paura. Tanto è amara che poco è più morte. ")
    finnish = ("Mieleni minun tekevi, aivoni ajattelevi lähteäni laulamahan, saa'ani sanelemahan, sukuvirttä suoltamahan, lajivirttä laulamahan. "
               "Sanat suussani sulavat, puhe'et putoelevat, kielelleni kerkiävät, hampahilleni hajoovat. ")
    polish = ("Litwo! Ojczyzno moja! ty jesteś jak zdrowie. Ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Dziś piękność twą w całej "
              "ozdobie widzę i opisuję, bo tęsknię po tobie. ")
    rng = random.Random(1)
    unlike = [t * n for t in (italian, finnish, polish) for n in (1, 5, 40)]
    unlike += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (704, 3_500, 21_000, 100_000)]
    unlike += ["".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n)) for n in (704, 5_000, 30_000)]
    assert all(rejected for _, _, rejected in model.predict(unlike))
    letters = docs.filter("text rlike '\\\\p{L}'")
    assert langid.predict(letters, model).filter("rejected").count() == 0


def test_a_repeated_id_counts_once_in_the_quality_sample(table, monkeypatch):
    rows = [(i, f"some plain words in line {i}" if i % 3 else "*** !!! ***") for i in range(40)] + [(3, f"many rows {i}") for i in range(300)]
    df = table("doc_id bigint, text string", rows)
    sizes = []
    monkeypatch.setattr(quality, "train", lambda p, u: sizes.append((len(p), len(u))))
    quality.fit(df, df.filter("doc_id < 10").select("doc_id"), sample=20)
    assert sizes == [(10, 20)]


def test_repeated_rows_take_one_place_of_the_language_sample(table):
    rows = [(i, f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} text", "x") for i in range(100)]
    first = langid.fit(table("doc_id bigint, text string, lang string", rows), sample=20)
    again = langid.fit(table("doc_id bigint, text string, lang string", rows + rows * 9, 8), sample=20)
    assert np.array_equal(first.idf, again.idf) and np.allclose(first.centres, again.centres, atol=1e-5)
