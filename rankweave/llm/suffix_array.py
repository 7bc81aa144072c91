"""Suffix-array dedup (operator 4): difference-cover suffix sorting of the texts that can repeat, in tasks of bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table, unstage
from .repeats import Unit, bytes_of, covered, pack_bytes, ranges, settle, slices, with_marks

LENGTH = 100
BYTES = Unit(LENGTH, 32, 1 << 19, bytes_of, pack_bytes, bytes)
#: Runs of one minimizer that are sorted together at most; the windows of larger groups are grouped by Spark one by one.
GROUP = 10_000
#: Bytes that are sorted at once.
BLOCK = 1 << 20


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``s`` in the order of their suffixes, as far as ``depth`` symbols tell: equal prefixes of that length are neighbours.

    Kärkkäinen and Sanders' difference cover modulo 3. Sampled positions are those
    not divisible by 3: their triples are sorted and named, the names are sorted by
    recursion unless they differ or reach as deep as asked, and the remaining third
    is sorted by a symbol and the next sample's rank, then merged.
    """
    n = len(s)
    if n < 8:
        text = s.tolist()
        return np.array(sorted(range(n), key=lambda i: text[i:]), np.int64)
    top = int(s.max()) + 2
    t = np.concatenate([s.astype(np.int64) + 1, np.zeros(3, np.int64)])
    # one sampled position past the end keeps the two thirds apart in the recursion
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    key = _code(t[sample] * top + t[sample + 1], t[sample + 2], top)
    order = np.argsort(key)
    new = np.concatenate([[False], key[order][1:] != key[order][:-1]])
    name = np.empty(len(sample), np.int64)
    name[order] = np.cumsum(new)
    rank = np.zeros(n + 3, np.int64)
    if depth <= 3 or new.sum() + 1 == len(sample):
        rank[sample] = name + 1
        sa12 = sample[order]
    else:
        deep = suffix_order(name, -(-depth // 3))
        sa12 = sample[deep]
        rank[sa12] = np.arange(1, len(sa12) + 1)
    sa12 = sa12[sa12 < n]
    zero = np.arange(0, n, 3)
    wide = n + 3
    key0 = t[zero] * wide + rank[zero + 1]
    order0 = np.argsort(key0)
    sa0, key0 = zero[order0], key0[order0]
    is1 = sa12 % 3 == 1
    sa1, sa2 = sa12[is1], sa12[~is1]
    before1 = np.searchsorted(t[sa1] * wide + rank[sa1 + 1], key0)
    both = np.concatenate([sa2, sa0])
    codes = _code(t[both] * top + t[both + 1], rank[both + 2], wide)
    before2 = np.searchsorted(codes[: len(sa2)], codes[len(sa2) :])
    # ties deeper than asked may be ordered one way here and another there; the running maximum keeps places apart
    before = np.maximum.accumulate(before1 + before2)
    out = np.full(n, -1, np.int64)
    out[np.arange(len(sa0)) + before] = sa0
    out[out < 0] = sa12
    return out


def _code(high: np.ndarray, low: np.ndarray, wide: int) -> np.ndarray:
    """One number for each pair, in the order of the pairs; low is below ``wide``."""
    if int(high.max()) * wide > 1 << 61:
        high = np.unique(high, return_inverse=True)[1]
    return high * wide + low


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Of the joined texts' positions where a window of ``length`` bytes fits into its text: ``(position, leader)`` rows of those that equal another.

    Suffixes are sorted, and neighbours' prefixes compared; ``leader`` numbers the equal ones.
    """
    size = np.array([len(x) for x in texts])
    raw = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    n = int(size.sum())
    room = np.repeat(np.cumsum(size), size) - np.arange(n)
    sa = suffix_order(raw[:n], length)
    sa = sa[room[sa] >= length]
    same = np.ones(max(0, len(sa) - 1), bool)
    eight = np.ndarray((n,), "<u8", raw, strides=(1,))  # the eight bytes from each position
    for at in [*range(0, length - 8, 8), length - 8]:
        left = np.flatnonzero(same)
        same[left] = eight[sa[left] + at] == eight[sa[left + 1] + at]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(sa) else np.zeros(0, np.int64)
    alone = np.bincount(group)[group] == 1 if len(sa) else np.zeros(0, bool)
    return np.stack([sa[~alone], group[~alone]])


def _later(batch_rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of windows that start earlier in another place of the same rows ``(doc_id, st, text)``."""
    texts = [r[2] for r in batch_rows]
    size = np.array([len(x) for x in texts])
    at, group = repeated_windows(texts)
    row = np.searchsorted(np.cumsum(size), at, side="right")
    doc = np.array([r[0] for r in batch_rows], np.int64)[row]
    pos = np.array([r[1] for r in batch_rows], np.int64)[row] + at - (np.cumsum(size) - size)[row]
    order = np.lexsort((pos, doc, group))
    g = group[order]
    again = order[np.concatenate([[False], g[1:] == g[:-1]])] if len(g) else order
    return ranges(doc[again], pos[again])


def repeated(docs: DataFrame) -> DataFrame:
    """Ranges ``(doc_id, st, en)`` of 100-byte windows that start earlier too, in smaller documents or before in the same one."""
    later, opened = settle(docs, BYTES)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            doc, st, en = _later(rows)
            return pa.record_batch([pa.array(doc), pa.array(st.astype(np.int32)), pa.array(en.astype(np.int32))], names=["doc_id", "st", "en"])

        rows, size, last = [], 0, None
        for batch in batches:
            for doc, st, a, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != last and size > BLOCK // 2:  # a minimizer's runs stay together
                    yield done(rows)
                    rows, size = [], 0
                rows.append((doc, st, text))
                size += len(text)
                last = a
        if rows:
            yield done(rows)

    few = opened.where(F.col("kinds") <= GROUP).select("doc_id", "st", "a", "text")
    small = few.repartition("a").sortWithinPartitions("a").mapInArrow(sort, "doc_id long, st int, en int")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, st, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(text) - LENGTH + 1
                h = np.array([xxhash.xxh3_128_digest(text[i : i + LENGTH]) for i in range(n)])
                yield pa.record_batch([pa.array(np.full(n, doc, np.int64)), pa.array(np.arange(st, st + n, dtype=np.int32)), pa.array(h.tolist(), pa.binary())], names=["doc_id", "pos", "h"])

    windows = opened.where(F.col("kinds") > GROUP).select("doc_id", "st", "text").mapInArrow(explode, "doc_id long, pos int, h binary")
    place = F.struct("doc_id", "pos")
    first = windows.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    large = windows.join(first, "h").where(place != F.col("first")).select("doc_id", F.col("pos").alias("st"), (F.col("pos") + 1).alias("en"))
    out = stage(later.unionByName(small).unionByName(large), "marks")
    unstage(later, opened)
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left).

    A byte goes if a 100-byte string that also starts earlier covers it: in a
    document of smaller doc_id, or before in its own. Null and empty texts have no
    bytes. Rows that share a doc_id share their marks, clipped to each text; rows
    without one are kept whole. Other columns aren't read. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for key, text, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = bytes_of(text)
                if not marks:
                    rows.append((key, len(raw), 0, 0, raw))
                    continue
                gone = covered(len(raw), marks, LENGTH)
                spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
                rows.append((key, len(raw), int(gone.sum()), spans, kept))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return with_marks(docs, repeated(docs)).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def digest(kept: bytes) -> str:
    return hashlib.sha256(kept).hexdigest()


QUERIES = {"op4_suffix_array_dedup": op4_suffix_array_dedup}
ORACLE_SQL: dict[str, str] = {}
