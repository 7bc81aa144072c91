import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import hnsw


def plainly(rows, every, k):
    """All pairs, products summed in the order of components."""
    out = {}
    for q, x in rows:
        if q % every == 0:
            near = sorted((-sum_in_order(x, y), i) for i, y in rows if i != q and len(x) == len(y))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def sum_in_order(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += float(a) * float(b)
    return total


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in found.get(q, [])}) for q in want)
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("shard", [8192, 60])
def test_recall_against_all_pairs(spark, shard):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plainly([(r.vec_id, r.embedding) for r in df.collect()], 20, 20)
    found = got(hnsw.nearest_neighbours(df, shard=shard))
    assert found.keys() == want.keys() and recall(found, want) >= 0.95
    scores = {q: dict(rows) for q, rows in plainly([(r.vec_id, r.embedding) for r in df.collect()], 20, 10**6).items()}
    assert all(scores[q][i] == s for q, rows in found.items() for i, s in rows)
    assert all(rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == 20 for rows in found.values())


def test_lengths_differ_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.1, 1, 30])).tolist()) for i in range(200)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(150)]  # copies
    rows += [(2000 + i, [1.0, -1.0]) for i in range(5)] + [(2020, [0.5, 0.5]), (2040, [3.0, 4.0, 5.0])]  # other lengths, a lone one
    odd = [(3000, None), (3020, []), (3040, [0.0] * 6), (3060, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3080, [float("nan")] * 6), (3100, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd + rows[:30]], "vec_id long, embedding array<double>, dim string, score int").repartition(5)
    found = got(hnsw.nearest_neighbours(df, shard=40, width=400))
    want = plainly(rows, 20, 20)
    assert found == {q: near for q, near in want.items() if near}  # a beam as wide as a shard finds all
    assert got(hnsw.nearest_neighbours(df.limit(0))) == {}


def test_rows_of_one_id_count_by_the_least_vector(spark):
    df = spark.createDataFrame([(0, [2.0, 1.0]), (0, [1.0, 5.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert got(hnsw.nearest_neighbours(df)) == {0: [(2, 5.0), (1, 1.0)]}


def test_graph_is_flat_connected_and_hierarchical():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 5
    vectors = hnsw._even((centres[rng.integers(20, size=3000)] + rng.normal(size=(3000, 16)) * 0.01).astype(np.float32))  # tight clusters
    sizes = hnsw.level_sizes(3000)
    graph = hnsw.build_graph(vectors, sizes)
    assert len(sizes) >= 3 and sizes == sorted(sizes, reverse=True) and [len(g) for g in graph] == sizes
    for h, links in enumerate(graph):
        assert links.max() < sizes[h] and links.shape[1] == (hnsw.LINKS if h else 2 * hnsw.LINKS) + 1
        seen, front = {0}, [0]
        while front:
            front = [int(x) for x in np.unique(links[front]) if x >= 0 and int(x) not in seen]
            seen.update(front)
        assert len(seen) == sizes[h]
    found = hnsw.search_graph(vectors, graph, vectors[:100], hnsw.BEAM)
    assert (found[:, 0] == np.arange(100)).mean() >= 0.9  # single precision hardly tells vectors of one cluster apart


def test_index_has_every_vector_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    index = hnsw.build_index(hnsw.proper(df), shard=100)
    ids = [i for r in index.select("ids").collect() for i in r.ids]
    assert sorted(ids) == sorted(r.vec_id for r in df.select("vec_id").collect())
    assert index.count() == index.first().n_shards == 5


def test_copies_are_cut_before_the_exchange(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    df.write.parquet(str(tmp_path / "copies"))
    df = spark.read.parquet(str(tmp_path / "copies"))
    plan = hnsw.first_copies(df, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert got(hnsw.nearest_neighbours(df)) == plainly([(r.vec_id, r.embedding) for r in df.collect()], 20, 20)
