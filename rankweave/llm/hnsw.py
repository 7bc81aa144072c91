"""Approximate nearest neighbours (operator 11): a hierarchical navigable small-world graph for each shard, as flat neighbour arrays, with the shards' results merged.

Nearness is the inner product. Vectors of a shard get one more component, which
gives them all one length, so that the nearest by product are the nearest by angle
and the graph may be built by angle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settings, stage, table, unstage

#: Vectors of a shard, links of a node above the ground level (twice as many on it), width of the beam when a node is
#: inserted and when a query is searched, and queries that meet a shard at a time. All are parameters of :func:`build_index` and :func:`search`.
SHARD, LINKS, BUILD, BEAM, AT_ONCE = 8192, 16, 96, 160, 1024
#: Open nodes that a beam expands at once, and nodes that are inserted at once.
STEP, WAVE = 4, 512
FOUND = "query_id long, vec_id long, score double"


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``width`` nodes of one level for each query, by descending similarity, from its entry nodes ``ids``; -1 and -inf where there are fewer."""
    n = len(queries)
    found, near = np.full((n, width), -1, np.int64), np.full((n, width), -np.inf, np.float32)
    closed, seen, live = np.ones((n, width), bool), np.zeros((n, len(links)), bool), np.arange(n)
    found[:, 0], near[:, 0], closed[:, 0] = ids, np.einsum("ad,ad->a", vectors[ids], queries), False
    seen[live, ids] = True
    step = min(STEP, width)
    while live.size:
        open_ = np.where(closed[live], -np.inf, near[live])
        at = np.argpartition(-open_, step - 1, axis=1)[:, :step] if step < width else np.argsort(-open_, axis=1)
        good = np.take_along_axis(open_, at, 1) > -np.inf
        some = good.any(1)
        live, at, good = live[some], at[some], good[some]
        if not live.size:
            break
        rows = live[:, None]
        closed[rows, at] |= good
        new = np.sort(np.where(good[:, :, None], links[found[rows, at]], -1).reshape(len(live), -1), axis=1)
        ok = new >= 0
        ok[:, 1:] &= new[:, 1:] != new[:, :-1]
        ok &= ~seen[rows, new]  # -1 looks at the last node, and isn't ok anyway
        new = new[:, ok.any(0)]
        ok = ok[:, ok.any(0)]
        at_row, at_col = np.nonzero(ok)
        nodes = new[at_row, at_col]
        seen[live[at_row], nodes] = True
        sims = np.full(new.shape, -np.inf, np.float32)
        sims[at_row, at_col] = np.einsum("ed,ed->e", vectors[nodes], queries[live[at_row]])
        sims = np.concatenate([near[live], sims], axis=1)
        top = np.argpartition(-sims, width - 1, axis=1)[:, :width] if sims.shape[1] > width else np.broadcast_to(np.arange(width), (len(live), width))
        near[live] = np.take_along_axis(sims, top, 1)
        found[live] = np.take_along_axis(np.concatenate([found[live], new], axis=1), top, 1)
        closed[live] = np.take_along_axis(np.concatenate([closed[live], np.zeros(new.shape, bool)], axis=1), top, 1)
    found[near == -np.inf] = -1
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)


def _diverse(vectors: np.ndarray, found: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """``most`` neighbours of each row's candidates (by descending similarity): those nearer to the row's node than to any chosen one, then the nearest others."""
    found, near = found[:, : 3 * most], near[:, : 3 * most]
    own = vectors[found]
    between = own @ own.transpose(0, 2, 1)
    chosen, crowd = np.zeros(found.shape, bool), np.full(found.shape, -np.inf, np.float32)
    for c in range(found.shape[1]):
        take = (found[:, c] >= 0) & (near[:, c] > crowd[:, c]) & (chosen.sum(1) < most)
        chosen[:, c] = take
        crowd = np.where(take[:, None], np.maximum(crowd, between[:, c]), crowd)
    rank = np.where(found < 0, 2 * found.shape[1], np.arange(found.shape[1]) + np.where(chosen, 0, found.shape[1]))
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(np.where(found < 0, -1, found), order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _connect(vectors: np.ndarray, links: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Writes the nodes' links and the links back; a node with too many keeps a diverse set. The last column is left alone."""
    most = links.shape[1] - 1
    links[nodes, : chosen.shape[1]] = chosen
    source, target = np.repeat(nodes, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    near = np.einsum("ed,ed->e", vectors[source], vectors[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    ends, at = np.unique(target, return_index=True)
    place = np.arange(len(target)) - np.repeat(at, np.diff(np.append(at, len(target))))
    few = place < 2 * most
    back = np.full((len(ends), 2 * most), -1, np.int64)
    back[np.searchsorted(ends, target[few]), place[few]] = source[few]
    for part in range(0, len(ends), 256):
        own = ends[part : part + 256]
        both = np.sort(np.concatenate([links[own, :most], back[part : part + 256]], axis=1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        sims = np.where(both >= 0, np.einsum("acd,ad->ac", vectors[both], vectors[own]), -np.inf).astype(np.float32)
        by = np.argsort(-sims, axis=1, kind="stable")
        both, sims = np.take_along_axis(both, by, 1), np.take_along_axis(sims, by, 1)
        full = (both >= 0).sum(1) > most
        kept = both[:, :most]
        if full.any():
            kept[full] = _diverse(vectors, both[full], sims[full], most)
        links[own, : kept.shape[1]] = kept


def _reach(vectors: np.ndarray, links: np.ndarray) -> None:
    """Makes every node of a level reachable from the first: a part that isn't hangs in the last column of the nearest reachable node that has it free."""
    reached = np.zeros(len(links), bool)
    front = np.array([0])
    while True:
        while front.size:
            reached[front] = True
            front = np.unique(links[front])
            front = front[front >= 0]
            front = front[~reached[front]]
        lost = np.flatnonzero(~reached)
        if not lost.size:
            return
        hosts = np.flatnonzero(reached & (links[:, -1] < 0))
        links[hosts[np.argmax(vectors[hosts] @ vectors[lost[0]])], -1] = lost[0]
        front = lost[:1]


def level_sizes(n: int, links: int = LINKS, seed: int = 0) -> list[int]:
    """How many nodes each level has, all on the first; a node's level is geometric."""
    heights = np.floor(np.random.default_rng(seed).exponential(size=n) / np.log(links)).astype(int)
    return [int((heights >= h).sum()) for h in range(heights.max() + 1)]


def build_graph(vectors: np.ndarray, sizes: list[int], links: int = LINKS, width: int = BUILD) -> list[np.ndarray]:
    """Neighbour arrays of each level over unit ``vectors``; the first ``sizes[h]`` nodes are on level h.

    Nodes are inserted in waves, highest first: a wave is searched for in the graph so
    far, and its nodes among each other, and links go both ways.
    """
    graph = [np.full((m, (links if h else 2 * links) + 1), -1, np.int64) for h, m in enumerate(sizes)]
    done = 0
    while done < sizes[0]:
        end = min(sizes[0], done + min(WAVE, max(done, links)))
        wave, entry = np.arange(done, end), np.zeros(end - done, np.int64)
        for h in range(len(sizes) - 1, -1, -1):
            on = min(max(sizes[h] - done, 0), len(wave))  # of the wave, those that have this level
            if done:
                if on < len(wave):
                    entry[on:] = _beam(vectors, graph[h], vectors[wave[on:]], entry[on:], 1)[0][:, 0]
                found, near = _beam(vectors, graph[h], vectors[wave[:on]], entry[:on], width) if on else (None, None)
            else:
                found, near = np.full((on, 1), -1, np.int64), np.full((on, 1), -np.inf, np.float32)
            if not on:
                continue
            if done:
                entry[:on] = found[:, 0]
            mutual = vectors[wave[:on]] @ vectors[wave[:on]].T
            np.fill_diagonal(mutual, -np.inf)
            few = min(on, links)
            mates = np.argpartition(-mutual, few - 1, axis=1)[:, :few]
            close = np.take_along_axis(mutual, mates, 1)
            found = np.concatenate([found, np.where(close > -np.inf, wave[mates], -1)], axis=1)
            near = np.concatenate([near, close], axis=1)
            order = np.argsort(-near, axis=1, kind="stable")
            _connect(vectors, graph[h], wave[:on], _diverse(vectors, np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1), links))
        done = end
    for own in graph:
        _reach(vectors, own)
    return graph


def search_graph(vectors: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, width: int) -> np.ndarray:
    """Nodes near each query, -1 where there are fewer than ``width``."""
    entry = np.zeros(len(queries), np.int64)
    for own in graph[:0:-1]:
        entry = _beam(vectors, own, queries, entry, 1)[0][:, 0]
    return _beam(vectors, graph[0], queries, entry, width)[0]


def _even(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors that order every query's products alike: one component more makes all of one length."""
    scaled = vectors.astype(np.float64) / np.abs(vectors).max()
    square = (scaled**2).sum(1)
    return (np.column_stack([scaled, np.sqrt(np.maximum(square.max() - square, 0))]) / np.sqrt(square.max())).astype(np.float32)


def proper(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows ``vec_id, embedding`` of vectors that take part: with an id, not null, not empty, finite throughout and not zero. Of rows that share an id the least vector counts."""
    kind = df.schema[vector].dataType.elementType.typeName()
    typed = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast(f"array<{'float' if kind == 'float' else 'double'}>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return typed.where(F.col("vec_id").isNotNull() & fine).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _apart(df: DataFrame):
    """While it holds, small partitions stay apart: shards have few bytes for their work."""
    return settings(df.sparkSession, spark__sql__adaptive__coalescePartitions__enabled="false")


def first_copies(vectors: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` smallest ids of each vector; Spark cuts copies in each task before the exchange."""
    first = Window.partitionBy("embedding").orderBy("vec_id")
    return vectors.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)


def build_index(vectors: DataFrame, k: int = 20, shard: int = SHARD, links: int = LINKS, width: int = BUILD) -> DataFrame:
    """The index of ``vectors(vec_id, embedding)``, a row a shard: ``dim, shard, n_shards, ids, ends, vectors, sizes, links``.

    Equal vectors are one node, which has the ``k + 1`` smallest ids of its copies: no
    query can return more of them. Nodes are dealt over shards by a hash, so that a
    shard has about ``shard`` of them; vectors of other lengths have shards of their own.
    Every vector is indexed, none is sampled.
    """
    nodes = first_copies(vectors, k).groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = stage(nodes.select(F.size("embedding").alias("dim"), "ids", "embedding"), "nodes")
    # a row a length of vectors, so broadcast; a join by length would send all vectors of one length to one task
    totals = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("n_shards"))
    placed = nodes.join(F.broadcast(totals), "dim").withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.col("n_shards")).cast("int"))
    kind = nodes.schema["embedding"].dataType.simpleString()

    def run(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        ids = part["ids"].chunk(0)
        order = np.argsort(np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offset])
        seed = int(part["shard"][0].as_py())
        order = order[np.random.default_rng(seed).permutation(len(order))]  # alike however rows came
        ids, own = ids.take(pa.array(order)), np.asarray(part["embedding"].chunk(0).flatten()).reshape(len(order), -1)[order]
        sizes = level_sizes(len(own), links, seed)
        graph = build_graph(_even(own), sizes, links, width)
        lists = [np.asarray(ids.flatten()), np.asarray(ids.value_lengths()).cumsum().astype(np.int32), own.ravel(), np.array(sizes, np.int32), np.concatenate([g.ravel() for g in graph]).astype(np.int32)]
        rows = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists]
        return pa.table([*(part[c][:1] for c in ("dim", "shard", "n_shards")), *rows], names=["dim", "shard", "n_shards", "ids", "ends", "vectors", "sizes", "links"])

    schema = f"dim int, shard int, n_shards int, ids array<long>, ends array<int>, vectors {kind}, sizes array<int>, links array<int>"
    with _apart(vectors):
        index = stage(placed.groupBy("dim", "shard").applyInArrow(run, schema), "index")
    unstage(nodes)
    return index


def _search_shard(row: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int, links: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query_id, vec_id, score`` of the k nearest of a shard for each query, itself left out."""
    own = row["vectors"].reshape(-1, row["dim"])
    widths = [2 * links + 1] + [links + 1] * (len(row["sizes"]) - 1)
    cuts = np.cumsum([m * w for m, w in zip(row["sizes"], widths, strict=True)])[:-1]
    graph = [x.reshape(-1, w) for x, w in zip(np.split(row["links"], cuts), widths, strict=True)]
    starts = np.concatenate([[0], row["ends"][:-1]])
    asked = np.column_stack([queries / np.abs(queries).max(1, keepdims=True), np.zeros(len(queries))]).astype(np.float32)
    nodes = search_graph(_even(own), graph, asked, max(width, k + 1))
    score = np.zeros(nodes.shape)
    for d in range(row["dim"]):  # in the order of components, so that equal vectors have equal scores
        score += queries[:, d, None].astype(np.float64) * own[:, d].astype(np.float64)[nodes]
    score[nodes < 0] = -np.inf
    order = np.lexsort((row["ids"][starts[nodes]], -score), axis=1)[:, : k + 1]
    nodes, score = np.take_along_axis(nodes, order, 1), np.take_along_axis(score, order, 1)
    copies = starts[nodes][:, :, None] + np.arange(k + 1)
    there = (copies < row["ends"][nodes][:, :, None]) & (nodes >= 0)[:, :, None]
    vec_id = np.where(there, row["ids"][np.minimum(copies, len(row["ids"]) - 1)], -1)
    there &= vec_id != query_ids[:, None, None]
    score = np.where(there, score[:, :, None], -np.inf).reshape(len(nodes), -1)
    vec_id = vec_id.reshape(len(nodes), -1)
    order = np.lexsort((vec_id, -score), axis=1)[:, :k]
    score, vec_id = np.take_along_axis(score, order, 1), np.take_along_axis(vec_id, order, 1)
    at = score > -np.inf
    return np.broadcast_to(query_ids[:, None], at.shape)[at], vec_id[at], score[at]


def search(index: DataFrame, queries: DataFrame, k: int = 20, width: int = BEAM, links: int = LINKS, at_once: int = AT_ONCE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of ``index`` for each of ``queries(vec_id, embedding)``, which :func:`proper` has made.

    Blocks of about ``at_once`` queries meet every shard, one block and one shard at a
    time; each gives its own k nearest, and the nearest of all shards are kept. Scores
    are inner products in double precision, summed in the order of components; ties
    go to the smaller vec_id; a row isn't its own neighbour. ``links`` must be the index's.
    """
    named = queries.select(F.size("embedding").alias("dim"), F.struct("vec_id", "embedding").alias("q"))
    totals = named.groupBy("dim").agg(F.ceil(F.count("*") / at_once).cast("int").alias("n_blocks"))
    block = F.pmod(F.xxhash64("q.vec_id"), F.col("n_blocks")).cast("int").alias("block")
    blocks = stage(named.join(F.broadcast(totals), "dim").select("dim", block, "n_blocks", "q").groupBy("dim", "block").agg(F.collect_list("q").alias("asked")), "queries")
    counts = index.groupBy("dim").agg(F.max("n_shards").alias("n_shards"))
    to_shards = blocks.join(F.broadcast(counts), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1))).drop("n_shards")
    to_blocks = index.join(F.broadcast(totals), "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks", "n_shards")
    pairs = to_blocks.join(to_shards, ["dim", "shard", "block"]).select("dim", "ids", "ends", "vectors", "sizes", "links", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: np.asarray(batch.column(name)[i].values) for name in ("ids", "ends", "vectors", "sizes", "links")}
                row["dim"], asked = batch.column("dim")[i].as_py(), batch.column("asked")[i].values
                own = np.asarray(asked.field("embedding").flatten()).reshape(len(asked), -1)
                yield pa.record_batch([pa.array(x) for x in _search_shard(row, np.asarray(asked.field("vec_id")), own, k, width, links)], names=["query_id", "vec_id", "score"])

    with _apart(index):
        found = stage(pairs.mapInArrow(run, FOUND), "found", rows=1)
    unstage(blocks)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(df: DataFrame, every: int = 20, k: int = 20, shard: int = SHARD, links: int = LINKS, build: int = BUILD, width: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``df(vec_id, embedding)`` for each row whose vec_id is divisible by ``every``, against all other rows.

    Vectors that are null, empty, zero, or hold null or non-finite components take no
    part, nor do rows without an id; of rows that share an id the least vector counts,
    so repeated rows count once. Copies of a vector are rows of their own and each
    other's nearest; ties go to the smaller vec_id. Vectors of different lengths are
    never compared. With fewer than ``k`` candidates all are returned, and an empty table gives no rows.
    """
    vectors = stage(proper(df), "vectors")
    index = build_index(vectors, k, shard, links, build)
    found = search(index, vectors.where(F.col("vec_id") % every == 0), k, width, links)
    unstage(vectors, index)
    return found


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


#: The graph's results can't be said in SQL; tests/llm/test_hnsw.py holds them against all pairs.
ORACLE_SQL: dict[str, str] = {}
QUERIES = {"op11_nearest_neighbours": op11_nearest_neighbours}
