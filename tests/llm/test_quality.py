import itertools
import random

import numpy as np

from rankweave.llm import quality as q


def plain_repeat(words, w=8):
    places = {}
    for i in range(len(words) - w + 1):
        places.setdefault(tuple(words[i : i + w]), []).append(i)
    hit = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + w)}
    return len(hit)


def test_repeated_words_equal_brute_force():
    rng = random.Random(3)
    for n in [0, 1, 7, 8, 9, 40, 200]:
        for k in (1, 2, 3):
            words = [rng.randrange(k) for _ in range(n)]
            assert q.repeated_words(np.array(words, np.int64)) == plain_repeat(words)


def test_counts():
    assert q.text_counts(None) == q.text_counts("") == (0, 0, 0, 0, 0)
    assert q.text_counts(" \n\t ")[0] == 0
    n, chars, symbols, dups, repeat = q.text_counts("\u00e9 a b # x\n\n\n\u00e9 a\nend\n\u00e9 a\n\u00a0|")
    assert (n, chars, symbols, dups, repeat) == (11, 14, 2, 1, 0)  # a no-break space is part of a word


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(30):
        crf = q.LineCrf(rng.normal(size=(len(q.FEATURES), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        x = rng.normal(size=(rng.integers(1, 7), len(q.FEATURES)))
        s = x @ crf.emit

        def score(path):
            return crf.start[path[0]] + sum(s[i, y] for i, y in enumerate(path)) + sum(crf.move[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=len(x)), key=score)
        assert tuple(crf.decode(x)) == best


def test_gradient_is_the_likelihoods():
    rng = np.random.default_rng(1)
    x, move, start = rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    node, edge = q._marginals(x, move, start)
    total, nodes, edges = 0, np.zeros((4, 2)), np.zeros((2, 2))
    for p in itertools.product((0, 1), repeat=4):
        z = np.exp(start[p[0]] + sum(x[i, y] for i, y in enumerate(p)) + sum(move[a, b] for a, b in itertools.pairwise(p)))
        total += z
        for i, y in enumerate(p):
            nodes[i, y] += z
        for a, b in itertools.pairwise(p):
            edges[a, b] += z
    assert np.allclose(node, nodes / total)
    assert np.allclose(edge, edges / total)


def test_lines_of_one_document_get_different_labels():
    plain = [f"This is a plain line of words, number {i} of them all." for i in range(4)]
    loud = ["BUY!! NOW!! ALL!! OF!! IT!!", "GO!! ON!! AND!! BUY!! MORE!!", "HURRY!! UP!! IT!! ENDS!! SOON!!"]
    assert q.line_labels(q.line_features([*plain, *loud]), good=False).tolist() == [0, 0, 0, 0, 1, 1, 1]
    assert q.line_labels(q.line_features(plain), good=False).tolist() == [1, 1, 1, 1]
    assert q.line_labels(q.line_features([*plain, plain[0]]), good=True).tolist() == [0, 0, 0, 0, 1]
    made = [(x := q.line_features(lines), q.line_labels(x, good)) for lines, good in [(plain, True), ([*plain[:2], *loud], False), ([*loud, *plain], False)] * 20]
    crf = q.fit_crf(made)
    assert crf.decode(q.line_features([*plain, *loud, *plain])).tolist() == [0] * 4 + [1] * 3 + [0] * 4


def test_lines_drawn_for_fitting_are_bounded():
    lines = [f"line {i}" for i in range(5000)]
    some = q.some_lines(lines, "\n".join(lines))
    assert len(some) == q.FIT_LINES and some == lines[(at := lines.index(some[0])) : at + q.FIT_LINES]
    assert q.some_lines(lines[:7], "x") == lines[:7] and q.some_lines([], "") == []


def test_edge_cases_and_labels(spark):
    good = "The plain words of a good text go on and on for a while here and there, so that it has enough.\n" + "More of it, then the end of this text comes near."
    bad = "\n".join("x### | y*** | z$$$ | w%%% | v&&& | u*** | t###" + str(i) for i in range(6))
    texts = [None, "", " \n ", good, good, bad, "few words only"] + [good + f" {i}." for i in range(20)] + [bad + f"\n{i}|" for i in range(20)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(i < 27), 0) for i in range(7, 47)] + [(99, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in q.assess(docs, q.train(docs, labels)).collect()}
    assert len(rows) == len(texts)
    assert [rows[i].kept for i in range(7)] == [False, False, False, True, True, False, False]
    assert q.assess(docs.limit(0), q.neutral_crf()).count() == 0
    assert np.array_equal(q.train(docs, labels.limit(0)).start, q.neutral_crf().start)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = q.op9_quality_rules(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        words = texts[r.doc_id].encode().split()
        lines = [x for x in texts[r.doc_id].split("\n") if x.encode().split()]
        assert r.n_words == len(words)
        assert r.n_repeat_words == plain_repeat(words)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert r.word_chars == len("".join(w.decode() for w in words))
        assert r.n_symbols == sum(c in q.SYMBOLS for c in texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    crf = q.train(docs, labels)
    for r in rows:
        lines = q._lines(texts[r.doc_id])
        marks = crf.decode(q.line_features(lines)) if lines else []
        size = [len(b"".join(x.encode().split())) for x in lines]
        share = sum(n for n, m in zip(size, marks, strict=True) if m == q.CONTENT) / max(1, sum(size))
        assert abs(r.content_share - share) < 1e-12 and r.kept == (share >= q.CONTENT_SHARE and not r.base_failed)
