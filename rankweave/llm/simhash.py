"""SimHash near-duplicates (operator 3): fingerprints, and a self-join of their binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard
from .common import connected_components, stage, table, text_key, unstage

#: A pair of trie nodes goes to one task once both hold so many fingerprints or fewer.
LEAF = 40_000
#: Bits by which the trie's upper part, walked by Spark, grows in a step.
STEP = 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a whole text: a bit is 1 if over half the shingle hashes have it; 0 if there is no word."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return 0
    flat = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(parts))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(flat[s:e], seed) for s, e in spans), np.uint64, len(parts) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):  # unpacked bits stay small for very long texts
        block = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)``; fp is the fingerprint's 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def trie_pairs(a: np.ndarray, b: np.ndarray, bit: int, spent: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Walk two subtrees of the trie together; yields the pairs of fingerprints that differ in ``budget`` bits or fewer.

    ``a`` and ``b`` are sorted distinct uint64, each of one subtree whose undecided
    bits are those below ``bit``; ``spent`` bits differ above. A node is an interval
    of its array. A pair of nodes has up to four pairs of children; those whose
    differing bits exceed the budget are pruned. Small pairs are compared directly.
    """
    same = a is b
    one = np.array([0], np.int64)
    todo = [(bit, one, one + len(a), one, one + len(b), np.array([spent], np.int8))]
    while todo:
        bit, alo, ahi, blo, bhi, dist = todo.pop()
        small = ((ahi - alo) * (bhi - blo) <= 64) | (bit == 0)
        if small.any():
            x, y = _all(alo[small], ahi[small], blo[small], bhi[small])
            near = np.bitwise_count(a[x] ^ b[y]) <= budget
            near &= (x < y) | (not same)
            if near.any():
                yield a[x[near]], b[y[near]]
            alo, ahi, blo, bhi, dist = (v[~small] for v in (alo, ahi, blo, bhi, dist))
        if not len(alo):
            continue
        bit -= 1
        amid, bmid = _split(a, alo, bit), _split(b, blo, bit)
        own = (alo == blo) & (ahi == bhi) & same
        halves = []
        for (al, ah), (bl, bh), more, skip in (
            ((alo, amid), (blo, bmid), 0, None),
            ((amid, ahi), (bmid, bhi), 0, None),
            ((alo, amid), (bmid, bhi), 1, None),
            ((amid, ahi), (blo, bmid), 1, own),
        ):
            ok = (al < ah) & (bl < bh) & (dist + more <= budget)
            if skip is not None:
                ok &= ~skip
            if ok.any():
                halves.append((al[ok], ah[ok], bl[ok], bh[ok], (dist[ok] + more).astype(np.int8)))
        if halves:
            cols = [np.concatenate(c) for c in zip(*halves, strict=True)]
            for at in range(0, len(cols[0]), 200_000):  # depth first in blocks, so that the frontier stays bounded
                todo.append((bit, *(c[at : at + 200_000] for c in cols)))


def _split(v: np.ndarray, lo: np.ndarray, bit: int) -> np.ndarray:
    """Where the children with ``bit`` set begin."""
    low = np.uint64((1 << (bit + 1)) - 1)
    return np.searchsorted(v, (v[lo] & ~low) | np.uint64(1 << bit)).astype(np.int64)


def _all(alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray]:
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(nb, n)
    return np.repeat(alo, n) + k // wide, np.repeat(blo, n) + k % wide


def _forest(pairs) -> tuple[np.ndarray, np.ndarray]:
    """Of the links found in one task, those that join two parts: the components stay, the repeats go."""
    up: dict[int, int] = {}

    def root(v: int) -> int:
        while (w := up.get(v, v)) != v:
            up[v] = up.get(w, w)
            v = w
        return v

    kept: list[tuple[int, int]] = []
    for x, y in pairs:
        for p, q in zip(x.tolist(), y.tolist(), strict=True):
            if (r := root(p)) != (s := root(q)):
                up[max(r, s)] = min(r, s)
                kept.append((p, q))
    out = np.array(kept, np.uint64).reshape(-1, 2).view(np.int64)
    return out[:, 0], out[:, 1]


def near_links(fps: DataFrame, budget: int = 2, leaf: int = LEAF) -> DataFrame:
    """Links ``(a, b)`` that connect whatever fingerprints of ``fps(fp)`` lie within ``budget`` bits, through chains at most.

    ``fps`` holds distinct fingerprints. Spark walks the trie's upper part: node
    pairs that are too large for one task are joined with the nodes' children, with
    the differing bits accumulated and pruned. The pairs that remain are walked in
    tasks of at most ``2 * leaf`` fingerprints; each returns a spanning forest of
    its links.
    """
    done, depth = [], 0
    pairs = fps.sparkSession.range(0, 1, 1, 1).select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).alias("dist"))  # made without Python workers
    while depth < 64:
        nodes = fps.groupBy(_prefix(depth).alias("p")).agg(F.count("*").alias("n"))
        sized = pairs.join(nodes.select(F.col("p").alias("a"), F.col("n").alias("na")), "a").join(
            nodes.select(F.col("p").alias("b"), F.col("n").alias("nb")), "b"
        )
        sized = stage(sized.withColumn("small", (F.col("na") <= leaf) & (F.col("nb") <= leaf)), "trie")
        done.append((depth, sized.where("small")))
        large = sized.where("not small")
        if large.isEmpty():
            break
        depth += STEP
        kids = fps.select(_prefix(depth).alias("p")).distinct()
        left = kids.select(F.shiftrightunsigned("p", STEP).alias("a"), F.col("p").alias("ca"))
        right = kids.select(F.shiftrightunsigned("p", STEP).alias("b"), F.col("p").alias("cb"))
        low = (1 << STEP) - 1
        more = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit(low)))
        pairs = (
            large.join(left, "a").join(right, "b")
            .select(F.col("ca").alias("a"), F.col("cb").alias("b"), (F.col("dist") + more).alias("dist"))
            .where((F.col("dist") <= budget) & (F.col("a") <= F.col("b")))
        )
    else:
        done.append((64, pairs))  # whole fingerprints are left
    sides = None
    for depth, part in done:
        mine = fps.select("fp", _prefix(depth).alias("p"))
        key = F.concat_ws(":", F.lit(depth), "a", "b").alias("pair")
        for role, only in (("a", F.lit(True)), ("b", F.col("a") != F.col("b"))):
            side = mine.join(
                part.where(only).select(key, F.col(role).alias("p"), "dist", F.lit(64 - depth).alias("bit"),
                                        F.lit(role).alias("role")), "p").drop("p")
            sides = side if sides is None else sides.unionByName(side)

    def walk(pdf):
        import pandas as pd

        a = np.sort(pdf.fp.to_numpy()[(pdf.role == "a").to_numpy()].view(np.uint64))
        b = np.sort(pdf.fp.to_numpy()[(pdf.role == "b").to_numpy()].view(np.uint64))
        x, y = _forest(trie_pairs(a, b if len(b) else a, int(pdf.bit.iloc[0]), int(pdf.dist.iloc[0]), budget))
        return pd.DataFrame({"a": x, "b": y})

    return sides.groupBy("pair").applyInPandas(walk, "a long, b long")


def _prefix(depth: int):
    """The upper ``depth`` bits of fp."""
    return F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 2, seed: int = 42, leaf: int = LEAF) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``.

    Documents whose fingerprints differ in ``budget`` bits or fewer are linked, and
    ``component_id`` is the smallest doc_id that links reach. Copies share a
    fingerprint and count once in the join. Null, empty and blank texts have
    fingerprint 0, which links like any other. Texts of fewer words than a shingle
    are one shingle. Only doc_id and text are read. An empty table gives no rows.
    """
    own = stage(fingerprints(docs, shingle, seed), "fingerprints")
    each = stage(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = connected_components(near_links(each.select("fp"), budget, leaf))
    named = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stage(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return own.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def similar_groups(docs: DataFrame, shingle: int = 5, budget: int = 3) -> DataFrame:
    """``docs`` with ``group``: rows of one group are near-duplicates, which 5-word shingles of Jaccard similarity 0.8 or more link.

    The trie join links the texts whose fingerprints lie within ``budget`` bits, and
    whole shingle sets confirm each link. Pairs of 0.8 may differ in more bits than a
    trie can prune by (some ten of 64), so a second pass over all texts finds the
    links between the trie's groups from their shingles (``jaccard.linked_roots``):
    no pair of 0.8 or more is lost. Null, empty and blank texts are copies of each
    other. Rows may share a doc_id or lack one; only ``text`` is read.
    """
    keyed = docs.withColumn("__key", text_key())
    texts = keyed.select(F.col("__key").alias("doc_id"), "text")
    own = stage(fingerprints(texts, shingle).where("doc_id <> 0").distinct(), "fingerprints")
    each = stage(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    close = near_links(each.select("fp"), budget)
    a, b = (each.select(F.col("fp").alias(x), F.col("first").alias(y)) for x, y in (("a", "x"), ("b", "y")))
    across = close.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    within = own.join(each, "fp").where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    pairs = stage(across.unionByName(within), "pairs")
    links = jaccard.confirmed(pairs, docs.select(text_key().alias("key"), "text"))
    roots = jaccard.linked_roots(docs, stage(connected_components(links), "roots"))
    unstage(own, each, pairs)
    named = keyed.join(roots.withColumnRenamed("node", "__key"), "__key", "left")
    return named.withColumn("group", F.coalesce("root", "__key")).drop("__key", "root")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op3_simhash_near_dedup": op3_simhash_near_dedup}
ORACLE_SQL: dict[str, str] = {}
