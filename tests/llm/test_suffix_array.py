import random

import numpy as np
import pytest

from rankweave.llm import suffix_array as sa


def brute(texts, length=100):
    """(n_bytes, n_removed, n_spans, sha256) of each document, by a set of windows in order."""
    seen, out = set(), {}
    for key in sorted(texts):
        raw = (texts[key] or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = [True] * length
            seen.add(w)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(raw), sum(gone), spans, sa.digest(bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("depth", [1, 4, 10, 100])
def test_suffix_order(depth):
    rng = random.Random(depth)
    for _ in range(120):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 250])
        s = np.array([rng.randrange(k) for _ in range(n)], np.uint8)
        got = sa.suffix_order(s, depth)
        assert sorted(got.tolist()) == list(range(n))
        heads = [bytes(s[i : i + depth]) for i in got]
        assert heads == sorted(heads)


def test_codes_keep_the_order_of_pairs():
    high = np.array([1 << 60, 3, 3, 1 << 60, 0], np.int64)
    low = np.array([5, 7, 1, 4, 9], np.int64)
    assert np.argsort(sa._code(high, low, 10)).tolist() == [4, 2, 1, 3, 0]


def made():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    texts = {0: None, 1: "", 2: "x" * 99, 3: "x" * 100, 4: "x" * 450, 5: "ab" * 900, 6: "b" * 30 + "ab" * 100}
    for i in range(7, 60):
        parts = [rng.choice(words) for _ in range(rng.randint(5, 200))]
        if i > 12 and rng.random() < 0.7:
            old = (texts[rng.randrange(7, i)] or "").split()
            at = rng.randrange(len(old))
            parts[3:3] = old[at : at + 60]
        texts[i] = " ".join(parts)
    texts[60] = texts[20]
    texts[61] = "é" * 120 + texts[20][:150]
    return texts


@pytest.mark.parametrize("group", [10_000, 1])
def test_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(sa, "GROUP", group)
    texts = made()
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, st int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, sa.digest(bytes(r.kept))) for r in sa.remove_repeats(docs.repartition(5)).collect()}
    assert got == brute(texts)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sa.op4_suffix_array_dedup(spark, folder).collect()}
    assert got == brute(texts)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sa.remove_repeats(empty).count() == 0


def test_ids_that_repeat_or_lack(spark):
    long = "the same long passage " * 3 + "with one more part that makes it a hundred bytes in all, and then some more"
    docs = spark.createDataFrame([(1, long), (1, long), (2, "short"), (None, long), (3, long)], "doc_id long, text string")
    rows = sa.remove_repeats(docs).collect()
    assert len(rows) == 5
    assert [r.n_removed for r in rows if r.doc_id == 3] == [len(long)]
    assert [r.n_removed for r in rows if r.doc_id is None] == [0]
