import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankweave.llm import fill_in_middle as fim


def plainly(doc_id, text):
    """The contract, character by character."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@given(st.text(st.sampled_from("ab é日😀\x00\U0010ffff"), max_size=40))
def test_index_converts_every_place(text):
    data = text.encode()
    index = fim.CharIndex(np.frombuffer(data, np.uint8))
    places = [len(text[:i].encode()) for i in range(len(text) + 1)]
    assert index.bytes(np.arange(len(text) + 1)).tolist() == places
    assert index.chars(np.array(places)).tolist() == list(range(len(text) + 1))


def test_texts_come_back_and_equal_a_plain_version(spark):
    texts = [None, "", "a", "<", "<P", "S>", "<<P", "x<M>y", "P><S", "é", "日本語 text 😀 mixed", "a\r\n\tb\x00c", "word " * 40_000, "😀é" * 20_000, "<S" * 9, "M>" * 9]
    rows = [(i, texts[i % len(texts)], "keep", i % 3) for i in range(640)] + [(None, "no id", None, 0), (None, None, None, 1), (5, "same id", "x", 2), (5, "same id", "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `own.name` string, n int").repartition(3)
    made = fim.fill_in_middle(docs)
    assert made.columns == ["doc_id", "own.name", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("restored", fim.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: (str(r[0]), r[-1])
    want = sorted((((i, *plainly(i, t), t or "")) for i, t, _, _ in rows), key=key)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got), key=key) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_batches_are_cut_between_texts(spark, monkeypatch):
    monkeypatch.setattr(fim, "PART", 50)
    rows = [(i, "é" * i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.output for r in fim.fill_in_middle(docs).collect()}
    assert got == {i: plainly(i, t)[-1] for i, t in rows}


def test_rates_and_seed(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some words in a row").alias("text"))
    forms = {r.form: r["count"] for r in fim.fill_in_middle(docs, seed=7, rate=50, spm_rate=50).groupBy("form").count().collect()}
    assert all(400 < forms[k] for k in ("psm", "spm")) and 900 < forms["plain"] < 1100
    assert fim.fill_in_middle(docs, rate=0).where("form <> 'plain'").count() == 0


def test_query_equals_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = fim.op13_fill_in_middle(spark, folder)
    want = db.sql(fim.ORACLE_SQL["op13_fill_in_middle"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
