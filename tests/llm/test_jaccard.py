import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as cp
from rankweave.llm import jaccard


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain_kept(texts):
    """Smallest doc_id of each group that links of Jaccard 0.8 or more make, by comparing all pairs that share a shingle."""
    sets = {k: plain_set(t) for k, t in texts.items()}
    up = {k: k for k in texts}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        up[b] = a

    lists = {}
    for k in sorted(sets):
        for s in sets[k] or {()}:
            lists.setdefault(s, []).append(k)
    shared = {}
    for ks in lists.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if not sets[a] or n / len(sets[a] | sets[b]) >= 0.8:
            join(a, b)
    return {k for k in texts if root(k) == k}


def odd_texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = {1: None, 2: "", 3: " \n", 4: "One two", 5: "one\ttwo", 6: "one two three"}
    while len(texts) < 500:
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 5, 8, 30, 120, 400]))]
        for _ in range(rng.randint(1, 8)):
            texts[len(texts) + 1] = " ".join(words)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return texts


def one_common_passage():
    """Near copies of one text, chains among them, and texts that share a passage only."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(90)]
    texts = {}
    for i in range(150):
        words = list(base)
        for j in rng.sample(range(90), rng.randint(0, 3)):
            words[j] = f"x{rng.randrange(9)}"
        texts[i] = " ".join(words)
    for i in range(150, 220):
        texts[i] = " ".join(base[:40] + [f"y{rng.randrange(60)}" for _ in range(rng.randint(4, 40))])
    return texts


@pytest.mark.parametrize("make", [odd_texts, one_common_passage])
def test_near_dedup_keeps_one_of_each_jaccard_group(spark, make):
    texts = make()
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string").repartition(5)
    assert {r.doc_id for r in cp.near_dedup(spark, docs, "").collect()} == plain_kept(texts)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id for r in cp.near_dedup(spark, docs, "").collect()} == plain_kept(texts)


def test_order_loses_no_pair(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ORDER_SHINGLES", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_KEYS", 1)
    test_near_dedup_keeps_one_of_each_jaccard_group(spark, odd_texts)


def test_no_documents(spark):
    assert cp.near_dedup(spark, spark.createDataFrame([], "doc_id long, text string"), "").count() == 0


def test_large_family_is_linked_before_all_its_pairs_are_taken(spark, monkeypatch):
    """Near copies of one text whose pairs lie around 0.8: few of the pairs across components are left, and whole sets are joined for few of these."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(150)]
    texts = {}
    for i in range(400):
        words = list(base)
        for j in rng.sample(range(150), 2):
            words[j] = f"x{rng.randrange(10_000)}"
        texts[i] = " ".join(words)
    seen = {"candidates": 0, "possible": 0, "confirmed": 0}
    stage = jaccard.stage

    def counted(df, name, *args, **options):
        out = stage(df, name, *args, **options)
        if name in seen:
            seen[name] += out.count()
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {r.doc_id for r in cp.near_dedup(spark, docs, "").collect()} == plain_kept(texts)
    assert seen["candidates"] < 400 * 399 / 2 / 2, seen
    assert 0 < seen["possible"] <= 2 * seen["confirmed"], seen


def test_a_pair_comes_once_for_a_run_of_tokens_that_both_share():
    names = ["token", "key", "n", "pos", "prev", "prev2", "root"]
    rows = [[(t, k, 200, t - 10, t - 1 if t > 10 else 0, t - 2 if t > 11 else 0, k) for k in (1, 2)] for t in range(10, 20)]
    batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*own, strict=True)], names=names) for own in rows]
    assert [r for b in jaccard._across(batches) for r in b.to_pylist()] == [{"a": 1, "b": 2}]


def test_parities_refuse_no_pair_that_reaches_the_similarity():
    rng = random.Random(8)
    for _ in range(2000):
        n = rng.randint(1, 400)
        a = {rng.randrange(1 << 62) for _ in range(n)}
        b = set(rng.sample(sorted(a), n - rng.randint(0, n // 6))) | {rng.randrange(1 << 62) for _ in range(rng.randint(0, n // 5))}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        if 9 * len(a & b) >= 4 * (len(a) + len(b)):
            assert jaccard.may_reach(jaccard.parities(x), jaccard.parities(y), len(a), len(b))
