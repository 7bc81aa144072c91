import random
import re
from collections import Counter

import pytest

from rankweave.llm import collocations as co


def plainly(rows, longest=3, least=10, cover=50, top=2000):
    """The contract over lists of words."""
    counts = {}
    for group, text in rows:
        own = counts.setdefault("und" if group is None else group, Counter())
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for group, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        often = {p: c for p, c in own.items() if len(p) > 1 and c >= least}
        gone = {q for p, c in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * c >= cover * own[q := p[i : i + k]]}
        rows = []
        for p, a in often.items():
            if p not in gone:
                score, _, left, right = min((1_000_000 * a * a // (own[p[:j]] * own[p[j:]]), j, own[p[:j]], own[p[j:]]) for j in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((group, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = "the The cat sat on mat é日 a x1 of\tsalt of new york city \x85odd in".split(" ")
    marks = [" ", " ", " ", "  ", ", ", ".", "\n", "\r\n", "\x0b", ": ", "\t"]
    return [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize(("block", "longest", "least"), [(1 << 21, 3, 10), (7, 3, 10), (50, 4, 3), (1, 2, 5)])
def test_phrases_equal_a_plain_version(spark, monkeypatch, block, longest, least):
    monkeypatch.setattr(co, "BLOCK", block)
    rows = texts(block) + [("en", None), (None, ""), ("fr", "lone words"), ("en", "New York City " * 40), ("en", "new york city. " * 40), ("en", "the\x00cat " * 30)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = co.collocations(docs, longest, least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plainly(rows, longest, least)


def test_very_long_pieces_are_split_in_parts(spark, monkeypatch):
    monkeypatch.setattr(co, "CHUNK", 64)
    monkeypatch.setattr(co, "BLOCK", 10)
    monkeypatch.setattr(co, "TEXT", 100)
    rows = [("en", " ".join(random.Random(1).choice("abc") for _ in range(2000))), ("en", "w" * 500 + " a b c" * 30)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, co.collocations(docs).collect())) == plainly(rows)


def test_files_of_the_relation_have_few_blocks(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(co, "BLOCK", 20)
    sizes = []

    def unstage(*staged):
        sizes.extend(pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for df in staged if "codes" in df.columns for f in df.inputFiles())

    monkeypatch.setattr(co, "unstage", unstage)
    rows = texts(3)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert sorted(map(tuple, co.collocations(docs).collect())) == plainly(rows)
    assert len(sizes) > 50 and max(sizes) <= 4  # a task has a hundred blocks and more


def test_top_and_empty_tables(spark):
    rows = texts(9, 500)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, text string, f long, `group` string")
    assert sorted(map(tuple, co.collocations(docs, top=5).collect())) == plainly(rows, top=5)
    assert co.collocations(docs.limit(0)).count() == 0
    by = docs.withColumnRenamed("lang", "my.kind")
    assert {tuple(r)[1:] for r in co.collocations(by, top=5, by="my.kind").collect()} == {r[1:] for r in plainly(rows, top=5)}


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, left, right = 3_037_000_500_123, 3_037_000_500_999, 4_000_000_000_001
    row = spark.createDataFrame([(a, left, right)], "f long, l long, r long")
    quotient = F.call_function("div", co._exact("f") * co._exact("f") * F.lit(1_000_000).cast("decimal(7,0)"), F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)"))
    assert row.select(quotient).first()[0] == 1_000_000 * a * a // (left * right)


def test_query_equals_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = co.op12_collocations(spark, folder)
    want = db.sql(co.ORACLE_SQL["op12_collocations"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
