"""The pipeline's rows next to a brute-force version of every stage."""

import hashlib
import struct
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from test_copies_lines import brute_lines
from test_simhash import brute_fingerprint, roots
from test_windows import brute as brute_windows

import corpus_pipeline
from quadrat.llm import langid, lines
from quadrat.llm.queries import tokenizer_path
from quadrat.session import RUNTIME_CONF, tune

DATA = "/root/testdata/sf0.001"


def test_rows_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    known = corpus_pipeline.language_id(spark, docs, DATA)
    assert known.columns == corpus_pipeline.COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in known.select("doc_id", "text").collect()]
    lined = [(k, kept) for k, _, _, kept in brute_lines(rows)]
    fps = [brute_fingerprint(t) for _, t in sorted(lined)]
    lined.sort()
    own = roots(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    single = [d for i, d in enumerate(lined) if own[i] == i]
    hit = {k for k, _, n, _ in brute_windows(single, bench) if n}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    want = []
    for key, text in single:
        if key not in hit:
            ids = library.encode(text, add_bos=True, add_eos=True)
            packed = struct.pack(f"<{len(ids)}I", *ids)
            want.append((key, packed, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = sorted((r[0], bytes(r[1]), *r[2:]) for r in corpus_pipeline.run(spark, DATA).collect())
    assert got == sorted(want) and 0 < len(got) < docs.count()


def test_unlike_texts_of_one_id_stay_apart(spark):
    a, b, c = "the cat sat on the mat and looked at the dog", "le chien court dans la rue avec un chat noir", "der Hund und die Katze sind in dem Haus"
    rows = [(1, a), (5, a), (5, b), (5, b), (None, a), (None, c), (None, c), (9, None), (10, ""), (2, "w " * 100_000), (3, "w " * 200_000)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0, "x") for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, FP string").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, DATA).select("doc_id", "text").collect()
    assert sorted((str(r[0]), r[1]) for r in kept) == sorted([("1", a), ("5", b), ("None", c), ("9", None), ("2", "w " * 100_000)], key=lambda r: (r[0], r[1]))


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, f"the cat number {i} sat on the mat and looked at the dog for a while", "en", "s", 0) for i in range(30)]
    rows += [(100 + i, f"le chat {i} est sur la table et regarde le chien dans la rue", "fr", "s", 0) for i in range(30)]
    rows += [(None, "the cat and the dog", None, None, None), (200, None, "en", "s", 0), (201, "", None, None, 0), (3, rows[3][1], "en", "s", 0), (202, "the dog " * 50_000, "en", "t", 0)]
    odd = spark.createDataFrame(rows, schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, DATA)
            assert docs.columns == corpus_pipeline.COLUMNS and docs.schema["n_chars"].dataType.simpleString() == "bigint"
        last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
        assert last.select(F.count("ids")).first()[0] == docs.count()


def test_every_stage_bounds_the_batches_it_sends_to_python(spark):
    docs = spark.createDataFrame([(i, f"the cat {i} sat on the mat", "en", "s", 20) for i in range(9)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(name, "1g")
            stage(spark, docs, DATA)
            assert spark.conf.get(name) == RUNTIME_CONF[name]
    finally:
        tune(spark)


def test_steps_hold_few_texts_and_no_lines(spark):
    rows = 1500
    text = [" ".join(f"w{i}x{k} some words of the text" for k in range(20)) + f"\na line of text number {i} that is long enough\nthe one line that all texts have" for i in range(rows)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * rows), pa.array(range(rows)), pa.array(text)], names=["lang", "key", "text"])
    tracemalloc.start()
    try:
        seen = [(b.num_rows, bytes(b.column(2)[0].as_py())) for b in langid._vectors(iter([batch]))]
        assert sum(n for n, _ in seen) == rows and max(n for n, _ in seen) <= langid.AT_ONCE
        assert seen[0][1] == langid.counts(text[0]).astype("f4").tobytes()
        assert tracemalloc.get_traced_memory()[1] < 32e6  # counts of all texts at once take 98 MB
        single = batch.select(["text"])
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        sent = b"".join(b.column(1)[0].as_py() for b in lines._send_hashes(iter([single])))
        assert tracemalloc.get_traced_memory()[1] - before < 700e3
    finally:
        tracemalloc.stop()
    want = Counter(xxhash.xxh64_intdigest(k) for t in text for k in set(lines.keys_of(t)) if k)
    assert Counter(np.frombuffer(sent, np.uint64).tolist()) == {h: min(n, 2) for h, n in want.items()}
