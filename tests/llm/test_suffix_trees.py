import hashlib
import random

import pytest

from rankweave.llm import suffix_trees as st


def brute(texts, length=20):
    seen, out = set(), {}
    for key in sorted(texts):
        words = (texts[key] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            w = tuple(words[i : i + length])
            if w in seen:
                gone[i : i + length] = [True] * length
            seen.add(w)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[key] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_deep_nodes():
    rng = random.Random(2)
    for _ in range(200):
        depth = rng.randint(1, 3)
        rows = sorted([[rng.choice([b"a", b"b"]) for _ in range(3)] for _ in range(rng.randint(0, 9))])
        want, i = [], 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j][:depth] == rows[i][:depth]:
                j += 1
            if j - i > 1:
                want.append((i, j))
            i = j
        assert st.deep_nodes(rows, depth) == want


def made():
    rng = random.Random(6)
    words = [f"w{i}é" for i in range(30)]
    texts = {0: None, 1: "", 2: " \n", 3: "a " * 19, 4: "a " * 20, 5: "a " * 300, 6: "a b " * 60, 7: "b a  " * 60}
    for i in range(8, 60):
        parts = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        if i > 14 and rng.random() < 0.7:
            old = texts[rng.randrange(8, i)].split(" ")
            at = rng.randrange(len(old))
            parts[3:3] = old[at : at + 40]
        texts[i] = " ".join(parts)
    texts[60] = texts[20]
    for i in range(61, 90):  # one passage in many places, other words around it
        texts[i] = " ".join([f"x{i}", *words[:25], f"y{i}"])
    return texts


@pytest.mark.parametrize("tree", [2000, 3])
def test_equals_brute_force(spark, tree):
    texts = made()
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, pos int")
    rows = st.remove_repeats(docs.repartition(5), tree).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in rows} == brute(texts)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in st.op6_suffix_tree_dedup(spark, folder).collect()}
    assert got == brute(texts)
    assert st.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
