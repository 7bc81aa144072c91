import math

import numpy as np
import regex

from rankweave.llm import language_id as li


def plain_predict(model, text):
    """The mean of the rows of a text's subwords, one subword after the other, and a softmax over it."""
    if text is None or not regex.search(r"\p{L}", text):
        return "und", 0.0
    flat = "_" + regex.sub(r"[^\p{L}\p{M}]+", "_", text.lower()) + "_"
    total, count = [0.0] * len(model.languages), 0
    for i in range(len(flat)):
        for n in range(1, 5):
            if i + n <= len(flat):
                h = 0
                for c in flat[i : i + n]:
                    h = (h * 0x9E3779B1 + ord(c)) % 2**32
                h = ((h ^ (h >> 15)) * 0x85EBCA6B + n - 1) % 2**32
                row = model.table[(h >> 16) % li.BUCKETS]
                total = [a + float(b) for a, b in zip(total, row, strict=True)]
                count += 1
    z = [(t / count + float(b)) / model.temperature for t, b in zip(total, model.bias, strict=True)]
    e = [math.exp(x - max(z)) for x in z]
    best = max(range(len(e)), key=e.__getitem__)
    return model.languages[best], e[best] / sum(e)


def test_predictions_equal_a_plain_loop():
    rng = np.random.default_rng(3)
    samples = [(lang, li.subwords(" ".join(rng.choice(words, 12)))) for _ in range(30) for lang, words in (("en", ["the", "and", "this"]), ("de", ["der", "und", "für"]))]
    model = li.fit(samples)
    for text in ["the and", "und für die", "", "12", None, "é", "The  AND, this! " * 40, "ein Wort"]:
        lang, score, _ = model.predict(text)
        want = plain_predict(model, text)
        assert lang == want[0] and abs(score - want[1]) < 1e-6


def test_copies_and_many_languages_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(li, "FIT_DOCUMENTS", 60)
    seen = []
    monkeypatch.setattr(li, "fit", lambda samples, seed=5: seen.extend(samples))
    rows = [(1, "the same old text", "en")] * 500 + [(i, f"text number {i} of some words", f"l{i % 40}") for i in range(400)]
    li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=10)
    assert len([x for x in seen if x[0] == "en"]) <= 1 and 20 <= len(seen) <= 120


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = li.op5_language_id(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == li.is_held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 200
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) > 0.97


def test_texts_without_letters_and_empty_tables(spark):
    data = [(i, "the one and the other of these" if i % 2 else "der eine und die andere von diesen", "en" if i % 2 else "de") for i in range(40)]
    odd = [(100, None, "en"), (101, "", "en"), (102, "12 !? 3", None), (103, "é", None), (104, "the other " * 20_000, None), (104, "the other", None)]
    docs = spark.createDataFrame([(*d, "x") for d in data + odd], "doc_id long, text string, lang string, lang_pred string")
    model = li.train(docs)
    got = {r.doc_id: r for r in li.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert got[104].lang_pred == "en"
    assert got[103].lang_pred in ("en", "de")
    assert li.identify(docs.limit(0), model).count() == 0
    nothing = li.train(docs.limit(0))
    assert {r.lang_pred for r in li.identify(docs, nothing).collect()} == {"und"}


def test_rejection_is_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = li.identify(docs, li.train(docs)).where("lang_pred <> 'und'")
    assert got.where("accepted").count() >= 0.9 * got.count()
