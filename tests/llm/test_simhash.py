import random

import numpy as np
import pytest
import xxhash

from rankweave.llm import simhash
from rankweave.llm.common import connected_components


def plain_groups(fps):
    """Smallest doc_id that links of two bits or fewer reach, by comparing all pairs."""
    keys = sorted(fps)
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    v = np.array([fps[k] for k in keys], np.uint64)
    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(v ^ v[i]) <= 2):
            a, b = sorted((root(keys[i]), root(keys[int(j)])))
            up[b] = a
    return {k: root(k) for k in keys}


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "One", "one two", "ÀB c\u00a0d E", "a " * 20_000]
    texts += [" ".join(rng.choice(["A", "b", "Cé", "d"]) for _ in range(rng.randint(1, 30))) for _ in range(100)]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def clustered(rng, n):
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 8))]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_trie_pairs_equal_all_pairs(budget):
    v = clustered(random.Random(budget), 400)
    got = {(int(a), int(b)) for x, y in simhash.trie_pairs(v, v, 64, 0, budget) for a, b in zip(x, y, strict=True)}
    want = {(int(v[i]), int(w)) for i in range(len(v)) for w in v[i + 1 :] if np.bitwise_count(v[i] ^ w) <= budget}
    assert got == want


@pytest.mark.parametrize("leaf", [40_000, 20, 1])
def test_links_connect_what_all_pairs_connect(spark, leaf):
    v = clustered(random.Random(9), 300)
    fps = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    rows = connected_components(simhash.near_links(fps, 2, leaf)).collect()
    own = {int(x): int(x) for x in v.view(np.int64)} | {r.node: r.root for r in rows}
    want = plain_groups({int(x): int(x) & (1 << 64) - 1 for x in v.view(np.int64)})
    assert own == want


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(7, 7)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == root(k) for k in got) and {k for e in edges if e[0] != e[1] for k in e} == got.keys()
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    fps = {k: plain_fingerprint(t) for k, t in texts.items()}
    rows = {r.doc_id: r for r in simhash.op3_simhash_near_dedup(spark, folder).collect()}
    assert {k: r.fingerprint for k, r in rows.items()} == {k: f"{v:016x}" for k, v in fps.items()}
    assert {k: r.component_id for k, r in rows.items()} == plain_groups(fps)
    odd = spark.createDataFrame([(4, None, 1), (2, "", 1), (9, "a b", 1), (9, "a b", 1)], "doc_id long, text string, fp int")
    assert sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()) == [(2, 2), (4, 2), (9, 9), (9, 9)]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
