import re

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rankweave.llm import decontaminate as dc
from rankweave.llm import quality, sentencepiece_lattice
from tests.llm.test_jaccard import plain_kept, plain_set
from tests.llm.test_pii import plain


def test_stages_equal_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    after = [docs]
    for _, step in cp.STAGES:
        after.append(step(spark, after[-1], folder).persist())
    for out in after[1:-1]:
        assert out.columns == docs.columns
    kept = [{r.doc_id: r.text for r in out.select("doc_id", "text").collect()} for out in after[1:-1]]
    crf = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = set()
    for k, t in texts.items():
        lines = quality._lines(t)
        size = [len("".join(x.encode().decode().split())) for x in lines]
        marks = crf.decode(quality.line_features(lines)) if lines else []
        share = sum(s for s, m in zip(size, marks, strict=True) if m == 0) / max(1, sum(size))
        if share >= 0.5 and not quality.base_fails(*quality.text_counts(t)):
            good.add(k)
    assert len(good ^ kept[0].keys()) <= 2  # shares are of bytes there, of characters here
    assert kept[1].keys() == plain_kept(kept[0])
    leaks = {r.doc_id for r in dc.contaminated(after[2], spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert leaks and kept[2].keys() == kept[1].keys() - leaks
    assert kept[3].keys() == kept[2].keys()
    for k, t in kept[3].items():
        assert not plain(t)
        if t != kept[2][k]:
            assert re.search("<(EMAIL|IP|CARD|PHONE|IBAN|SSN|SECRET)>", t)
        else:
            assert not plain(kept[2][k])
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_lattice.model_path())
    last = after[-1].collect()
    assert {r.doc_id for r in last} == kept[3].keys()
    assert all(r.ids == sp.encode(kept[3][r.doc_id]) for r in last)


def test_odd_documents(spark, tmp_path):
    text = "A fine text of many plain words that goes on long enough to be kept by all of the rules that there are here. " * 2
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, text, None, None, None), (2, text, "en", "s", 1), (3, text + "\n" + "w " * 40_000, "en", "s", 1)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, pii_base string")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for start in (docs, docs.limit(0)):
        out = start
        for name, step in cp.STAGES:
            out = step(spark, out, str(tmp_path))
            if name != "sentencepiece":
                assert out.columns == docs.columns
                assert {(r.kept, r.pii_base) for r in out.collect()} <= {("x", "y")}
        keys = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(keys) == len(set(keys))
        assert {r.doc_id for r in out.select(F.col("doc_id")).collect()} <= {2, 3}


def test_no_text_is_lost_where_ids_repeat_or_are_null(spark):
    """Rows as groups of near-duplicate texts, by comparing all pairs: each group keeps one row, of its smallest id, null last."""
    fine = [" ".join(f"{w}{i}" for i in range(20)) for w in ("a", "b", "c", "d", "e")]
    near = fine[4] + " end"
    rows = [(5, fine[0], "x"), (5, fine[1], "x"), (None, fine[2], "x"), (None, fine[3], "x"), (None, fine[3], "y"), (7, fine[3], "z"), (7, fine[3], "w"),
            (None, near, "x"), (None, fine[4], "x"), (None, fine[4], "x"), (9, None, "x"), (8, "", "x"), (None, " ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = sorted(((r.doc_id, r.text, r.source) for r in cp.near_dedup(spark, docs, "").collect()), key=str)
    left = list(rows)
    groups = []
    while left:
        group = [left.pop()]
        for own in group:
            a = plain_set(own[1])
            more = [r for r in left if (b := plain_set(r[1])) == a or (a and b and len(a & b) / len(a | b) >= 0.8)]
            left = [r for r in left if r not in more]
            group += more
        groups.append(group)
    assert len(out) == len(groups) == 6
    for group in groups:
        (kept,) = [r for r in out if r in group]
        assert kept[0] == min((r[0] for r in group if r[0] is not None), default=None)
    assert [tuple(r) for r in cp.near_dedup(spark, docs.repartition(2), "").orderBy("text", "source").collect()] == sorted(out, key=lambda r: (r[1] or "", r[2]))


def test_decontamination_takes_texts_and_not_ids(spark, tmp_path):
    item = "Which old bridge over the long river was built first by the town and its people in that year?"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(5, "Well. " + item), (5, "a clean text"), (None, item), (None, "another clean text")], "doc_id long, text string")
    out = cp.benchmark_decontamination(spark, docs, str(tmp_path))
    assert sorted(r.text for r in out.collect()) == ["a clean text", "another clean text"]


def test_texts_go_to_python_once_and_few_at_a_time(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(name)
    docs = spark.range(6000).selectExpr("id AS doc_id", "'a b' AS text")
    kept = cp.quality_rules(spark, docs, "/root/testdata/sf0.001")
    assert 0 < int(spark.conf.get(name)) <= 2000
    assert "__text" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 0


def test_coding_sends_few_texts_and_none_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(name)
    docs = spark.createDataFrame([(i, "a fine day", "en", "s", 10) for i in range(5)], "doc_id long, text string, lang string, source string, n_chars int")
    coded = cp.sentencepiece_ids(spark, docs, "")
    assert 0 < int(spark.conf.get(name)) <= 500
    (last,) = [x for x in coded._jdf.queryExecution().optimizedPlan().toString().split("\n") if "MapInArrow join(" in x]
    assert "text" not in last.rpartition("[")[2] and "n_chars" not in last, last
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_lattice.model_path())
    assert sorted((r.doc_id, r.n_ids, r.ids) for r in coded.collect()) == [(i, len(ids := sp.encode("a fine day")), ids) for i in range(5)]
