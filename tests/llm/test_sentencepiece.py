import hashlib
import itertools
import random

import pytest
import sentencepiece

from rankweave.llm import sentencepiece_lattice as sl

PATH = sl.model_path()


@pytest.fixture(scope="module")
def pieces():
    return sl.read_model(PATH)


def made():
    rng = random.Random(4)
    bits = ["the", "ing", "é", "日本", "😀", " ", "  ", "   ", "\n", "\t", "▁", "\r", "x" * 70, "12.5", "<s>", ", ", "thating", "a"]
    texts = [None, "", " ", "\n", "a b", " lead and trail ", "▁", "z" * 500, "ab" * 200, "the " * 3000]
    texts += ["a\nb", "a \nb", "a\n b", "\na b\n", "a\n\n\nb c.\nD", "a \0b", "\0\nx y"]
    return texts + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(300)]


def test_ids_equal_the_librarys_and_decode(spark, pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = made()
    docs = spark.createDataFrame([(i % 50, t, [i], "x") for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>, word string")
    for frequent in (100_000, 3):
        rows = sl.decode(sl.encode(docs, pieces, frequent), pieces).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert r.ids == sp.encode(r.text or ""), repr(r.text)
            assert r.decoded == (r.text or "").replace("▁", " ")


def test_units_are_the_text_and_no_piece_goes_beyond_one(pieces):
    cut = sl.Cutter(pieces)
    normal = {p for p, _, _ in pieces.normal}
    for text in [*made(), "a\nb", "a \nb", "a\n b", "\na", "a\n", "a\n\nb ", "a\0b c", "a \0b c", "\0", "\0\nx", "a\n\nb c", "\n", "a \n b", "x\ty", "b "]:
        units = [u for w in cut.words(text) for u in cut.units(w)]
        whole = sl.normalize(text)
        assert "".join(units) == whole, repr(text)
        ends = set(itertools.accumulate(map(len, units)))
        for at in ends if len(whole) < 300 else ():
            assert not any(whole[a:b] in normal for a in range(max(0, at - 16), at) for b in range(at + 1, min(len(whole), a + 16) + 1))


def test_words_of_many_texts_are_told_apart_at_once(pieces):
    cut, texts = sl.Cutter(pieces), [*made(), "", None, "the cat, the cat"]
    words, places, at = cut.split(texts)
    assert len(words) == len(set(words))
    assert [[words[i] for i in places[a:b]] for a, b in itertools.pairwise(at)] == [cut.words(t) for t in texts]
    names, text, unit = sl._rare([cut.units(w) for w in words], places, at, {"▁the": b""})
    found = [[names[u] for u in unit[text == i]] for i in range(len(texts))]
    assert found == [list(dict.fromkeys(u for w in cut.words(t) for u in cut.units(w) if u != "▁the")) for t in texts]
    assert [x.tolist() for x in sl._rare([], *cut.split([None])[1:], {})[1:]] == [[], []]


def test_long_units_and_runs_of_blanks_take_the_same_fold(spark, pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(8)
    texts = [" " * k + "the" * (k % 3) for k in range(1, 70)] + ["a" * 20_000, "".join(rng.choice("etaoinshr") for _ in range(20_000)), "é" * 3000, "日本" * 3000]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß,.") for _ in range(n)) for n in (59, 60, 61, 400, 20_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sl.encode(docs, pieces).collect():
        assert r.ids == sp.encode(r.text), repr(r.text[:80])


def test_long_units_are_cut_where_no_piece_goes_on(pieces, monkeypatch):
    cut = sl.Cutter(pieces)
    rng = random.Random(3)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))
    parts = cut.units(word)
    assert "".join(parts) == sl.BLANK + word and len(parts) > 10
    assert all(a[-1] + b[0] not in cut.pairs for a, b in itertools.pairwise(parts))
    monkeypatch.setattr(sl, "END", 8)
    with pytest.raises(ValueError, match="more than 255 characters"):
        cut.units("a" * 300)


def test_models_whose_parts_do_not_go_first_are_refused():
    sl.check_order((("ab", 0, -1.0), ("abc", 1, -2.0)))
    with pytest.raises(ValueError, match="go before"):
        sl.check_order((("bc", 0, -3.0), ("abc", 1, -2.0)))


def test_the_registered_query_folds_in_spark(spark, pieces):
    words = spark.createDataFrame([("▁the",)], "word string")
    plan = sl.encode_words(words, pieces)._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" in plan and "BroadcastHashJoin" in plan and "collect_list" in plan
    assert "Arrow" not in plan and "CartesianProduct" not in plan


def test_the_vocabulary_starts_no_python_workers(spark, pieces):
    words = spark.range(1).selectExpr("'▁the' AS word")
    assert "ExistingRDD" not in sl.lattice(words, pieces)._jdf.queryExecution().executedPlan().toString()


def test_viterbi_fold_equals_all_paths(spark, pieces):
    model = sl.Pieces((("▁a", 0, -1.0), ("a", 1, -1.5), ("ab", 2, -2.0), ("b", 3, -1.2), ("▁ab", 4, -4.0), ("ba", 5, -0.9), ("▁", 6, -0.7)), tuple(range(100, 356)), (), False)
    rng = random.Random(1)
    words = {"▁" + "".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(40)}
    edges = sl.lattice(spark.createDataFrame([(w,) for w in words], "word string"), model)
    score = {p: (s, i) for p, i, s in model.normal}

    def best(w):
        found = None
        for cut in itertools.product((0, 1), repeat=len(w) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cut) if c), len(w)]
            parts = [w[a:b] for a, b in itertools.pairwise(at)]
            if all(p in score or len(p) == 1 for p in parts):
                total = sum(score[p][0] if p in score else -1e6 for p in parts)
                found = max(found or (-1e18,), (total,))
        return found[0]

    names = {i: s for _, i, s in model.normal}
    for r in sl.fold_viterbi(edges, model).collect():
        assert sum(names.get(x.id, -1e6) for x in r.path) == pytest.approx(best(r.word))
        assert "".join(r.word[x.e - x.size : x.e] for x in r.path) == r.word
    coded = {r.word: r.ids for r in sl.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), model).collect()}
    assert coded.keys() == words
    assert all((100 + ord("c")) in coded[w] for w in words if "c" in w)


def test_whole_table(spark, pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = sl.op10_sentencepiece(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = sp.encode(texts[r.doc_id])
        assert (r.n_ids, r.ids_sha256, r.round_trip) == (len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), True)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sl.encode(empty, pieces).count() == 0
