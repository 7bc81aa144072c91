"""Substring dedup (operator 6): suffix trees of the word suffixes that can repeat, partitioned by prefixes of variable length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table, unstage
from .repeats import Unit, covered, gram_hashes, pack_words, ranges, settle, slices, with_marks, words_of

LENGTH = 20
WORDS = Unit(LENGTH, 8, 1 << 17, words_of, pack_words, b" ".join)
#: Prefix lengths tried in turn; the last is the whole window.
PREFIXES = (2, 5, 10, LENGTH)
#: Suffixes in one tree at most.
TREE = 2000


def suffixes(opened: DataFrame) -> DataFrame:
    """``doc_id, pos, suffix, p0 ... p3``: the suffixes (LENGTH words) of the open runs, with hashes of their prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            yield from (_suffixes(*part) for part in _few(batch))

    def _few(batch: pa.RecordBatch) -> Iterator[tuple]:
        rows, size = [], 0
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size > 1 << 20:  # a run of periodic text has hundreds of suffixes
                yield tuple(zip(*rows, strict=True))
                rows, size = [], 0
            rows.append(row)
            size += len(row[2])
        if rows:
            yield tuple(zip(*rows, strict=True))

    def _suffixes(doc, st, texts) -> pa.RecordBatch:
        parts = [t.split(b" ") for t in texts]
        flat, begin, finish, values = pack_words(parts)
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        fits = n - LENGTH + 1
        which = np.repeat(np.arange(len(n)), fits)
        nth = np.arange(fits.sum()) - np.repeat(np.cumsum(fits) - fits, fits)
        at = (np.cumsum(n) - n)[which] + nth
        suffix = [flat[s:e] for s, e in zip(begin[at].tolist(), finish[at + LENGTH - 1].tolist(), strict=True)]
        cols = [np.array(doc, np.int64)[which], (np.array(st, np.int64)[which] + nth).astype(np.int32)]
        prefix = [gram_hashes(values, k)[at].view(np.int64) for k in PREFIXES]
        names = ["doc_id", "pos", "suffix", *(f"p{i}" for i in range(len(PREFIXES)))]
        return pa.record_batch([pa.array(cols[0]), pa.array(cols[1]), pa.array(suffix, pa.binary()), *map(pa.array, prefix)], names=names)

    schema = "doc_id long, pos int, suffix binary, " + ", ".join(f"p{i} long" for i in range(len(PREFIXES)))
    return opened.select("doc_id", "st", "text").mapInArrow(run, schema)


def deep_nodes(ordered: list[list[bytes]], depth: int) -> list[tuple[int, int]]:
    """Leaf intervals of a suffix tree's topmost internal nodes of ``depth`` words or more.

    ``ordered`` holds the tree's suffixes in order. The tree is built from left to
    right: a stack has the right-most path, and the longest common prefix of two
    neighbours says where the next leaf branches off. An internal node of that depth
    is a maximal repeat with all its occurrences below it.
    """
    out: list[tuple[int, int]] = []
    path: list[tuple[int, int]] = [(0, 0)]  # depth and first leaf of each internal node
    for i in range(1, len(ordered) + 1):
        common = 0
        if i < len(ordered):
            for x, y in zip(ordered[i - 1], ordered[i], strict=False):
                if x != y:
                    break
                common += 1
        first = i - 1
        while path and path[-1][0] > common:
            node, first = path.pop()
            if node >= depth and (not path or max(path[-1][0], common) < depth):
                out.append((first, i))
        if not path or path[-1][0] < common:
            path.append((common, first))
    return out


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that start earlier too, of suffixes that come sorted by tree."""

    def done(rows: list[tuple]) -> None:
        if len(rows) > 1:
            rows.sort(key=lambda r: r[2])
            for lo, hi in deep_nodes([r[2].split(b" ") for r in rows], LENGTH):
                later.extend(sorted(r[:2] for r in rows[lo:hi])[1:])

    rows, last, later = [], None, []
    for batch in batches:
        for doc, pos, suffix, tree in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if tree != last:
                done(rows)
                rows, last = [], tree
            rows.append((doc, pos, suffix))
        if len(later) > 200_000:
            yield _ranges(later)
            later = []
    done(rows)
    yield _ranges(later)


def _ranges(places: list[tuple]) -> pa.RecordBatch:
    at = np.array(places, np.int64).reshape(-1, 2)
    doc, st, en = ranges(at[:, 0], at[:, 1])
    return pa.record_batch([pa.array(doc), pa.array(st.astype(np.int32)), pa.array(en.astype(np.int32))], names=["doc_id", "st", "en"])


def repeated(docs: DataFrame, tree: int = TREE) -> DataFrame:
    """Ranges ``(doc_id, st, en)`` of 20-word windows that start earlier too.

    Suffixes are split by their first words; a prefix with more than ``tree``
    suffixes is split further by more words, and one that is still too large is a
    whole window, whose places Spark groups without a tree.
    """
    later, opened = settle(docs, WORDS)
    own = stage(suffixes(opened), "suffixes")
    unstage(opened)
    placed, heavy, kept = [], own, []
    for i in range(len(PREFIXES)):
        big = stage(heavy.groupBy(f"p{i}").agg(F.count("*").alias("n")).where(F.col("n") > tree).select(f"p{i}"), "heavy")
        kept.append(big)
        light = heavy.join(big, f"p{i}", "left_anti")
        placed.append(light.select("doc_id", "pos", "suffix", F.xxhash64(F.lit(i), f"p{i}").alias("tree")))
        heavy = heavy.join(big, f"p{i}", "left_semi")
        if big.isEmpty():
            heavy = None
            break
    rows = placed[0]
    for more in placed[1:]:
        rows = rows.unionByName(more)
    marks = later.unionByName(
        rows.repartition("tree").sortWithinPartitions("tree").mapInArrow(_trees, "doc_id long, st int, en int")
    )
    if heavy is not None:
        place = F.struct("doc_id", "pos")
        whole = heavy.select("doc_id", "pos", F.sha2("suffix", 256).alias("h"))
        # a row for each node too large for a task; as a table, so that Spark can broadcast it or split the other side
        first = stage(whole.groupBy("h").agg(F.min(place).alias("first")), "nodes")
        kept.append(first)
        again = whole.join(first, "h").where(place != F.col("first"))
        marks = marks.unionByName(again.select("doc_id", F.col("pos").alias("st"), (F.col("pos") + 1).alias("en")))
    out = stage(marks, "marks")
    unstage(later, own, *kept)
    return out


def remove_repeats(docs: DataFrame, tree: int = TREE) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (the words left, joined by one blank).

    A word goes if a window of 20 words that also starts earlier covers it: in a
    document of smaller doc_id, or before in its own. Null, empty and blank texts
    have no words. Rows that share a doc_id share their marks, clipped to each text;
    rows without one are kept whole. Other columns aren't read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, text, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = words_of(text)
                if not marks:
                    rows.append((key, len(parts), 0, b" ".join(parts)))
                    continue
                gone = covered(len(parts), marks, LENGTH)
                rows.append((key, len(parts), int(gone.sum()), b" ".join(w for w, g in zip(parts, gone.tolist(), strict=True) if not g)))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    return with_marks(docs, repeated(docs, tree)).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")


def op6_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


QUERIES = {"op6_suffix_tree_dedup": op6_suffix_tree_dedup}
ORACLE_SQL: dict[str, str] = {}
