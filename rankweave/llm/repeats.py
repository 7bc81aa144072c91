"""Where a window of L symbols can repeat: the parse that both exact-repeat operators work on.

Every window of L symbols is filed under its smallest K-gram hash (a minimizer).
Equal windows have equal minimizers, so a window whose minimizer occurs in one
place only is settled. Consecutive windows of one minimizer are a run; runs of
equal content repeat as a whole, so all but the first are settled too. What is
left, one run of each content whose minimizer has several contents, is small and
goes to the operator's own algorithm with its text. Nothing is dropped: the
parse only decides which windows need no comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage

#: Windows in a run at most; longer ones, of periodic texts, are cut.
RUN = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Unit:
    """What a text is a sequence of: bytes, or words."""

    length: int
    gram: int
    #: Symbols that are parsed at once; longer texts are cut into blocks of so many windows, from their start.
    block: int
    symbols: Callable[[str | None], Sequence]
    #: Some texts' symbols to (joined bytes, start of each symbol in them, end of each symbol, a 64-bit value of each symbol).
    pack: Callable[[list[Sequence]], tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]
    join: Callable[[Sequence], bytes]

    @property
    def span(self) -> int:
        return self.length - self.gram + 1


def bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def words_of(text: str | None) -> list[bytes]:
    return bytes_of(text).split()


def pack_bytes(texts: list[bytes]):
    raw = b"".join(texts)
    at = np.arange(len(raw) + 1)
    return raw, at[:-1], at[1:], np.frombuffer(raw, np.uint8).astype(np.uint64)


def pack_words(texts: list[list[bytes]]):
    parts = list(chain.from_iterable(texts))
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size + 1) - 1
    return b" ".join(parts), ends - size, ends, np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive values, by doubling."""
    h = (values + np.uint64(1)) * _ODD
    done = 1
    while done < k:
        step = min(done, k - done)
        right = h[step:]
        h = h[: len(h) - step] * np.uint64(0xD6E8FEB86659FD93 + 2 * done) + (right ^ (right >> np.uint64(31)))
        h ^= h >> np.uint64(32)
        h *= _ODD
        done += step
    return h


def _slide(v: np.ndarray, w: int, pick) -> np.ndarray:
    m, s = v, 1
    while 2 * s <= w:
        m = pick(m[:-s], m[s:])
        s *= 2
    return pick(m[: len(v) - w + 1], m[w - s : w - s + len(v) - w + 1]) if s < w else m


def minimizer_runs(h: np.ndarray, span: int, text: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of ``span`` hashes with one minimum: first window, end, the minimum, and whether it occurs twice in the run's text.

    ``text`` numbers the text of each window, and ``fits`` tells whether it lies within that text; a run goes over windows of one text that fit.
    """
    m = _slide(h, span, np.minimum)
    start = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (text[1:] != text[:-1]) | (fits[1:] != fits[:-1])]))
    end = np.append(start[1:], len(m))
    start, end = start[fits[start]], end[fits[start]]
    if not len(start):
        return start, end, m[:0], np.zeros(0, bool)
    edge = np.zeros(span - 1, np.uint64)
    chosen = np.flatnonzero(h == _slide(np.concatenate([edge, np.where(fits, m, 0), edge]), span, np.maximum))
    value = h[chosen]
    lo, hi = np.searchsorted(chosen, start), np.searchsorted(chosen, end + span - 1)
    n = hi - lo
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    twice = np.add.reduceat((value[at] == np.repeat(m[start], n)).astype(np.int32), np.cumsum(n) - n) > 1
    long = end - start > RUN
    if long.any():
        pieces = np.where(long, -(-(end - start) // RUN), 1)
        which = np.repeat(np.arange(len(start)), pieces)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = start[which] + nth * RUN
        return first, np.minimum(first + RUN, end[which]), m[start][which], twice[which]
    return start, end, m[start], twice


def runs(docs: DataFrame, unit: Unit) -> DataFrame:
    """``doc_id, st, en, a, c, twice``: the runs of each whole text; a is the minimizer, c a hash of the run's text.

    Short texts are parsed many at a time; a longer one goes in blocks that overlap
    by a window less one symbol, so that what a task holds doesn't grow with a text.
    """

    def parse(keys: list[int], offsets: list[int], parts: list[Sequence]) -> pa.RecordBatch:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        begins, ends = np.cumsum(size) - size, np.cumsum(size)
        flat, begin, finish, values = unit.pack(parts)
        text = np.repeat(np.arange(len(parts)), size)[: len(values) - unit.length + 1]
        fits = np.arange(len(text)) + unit.length <= ends[text]
        st, en, a, twice = minimizer_runs(gram_hashes(values, unit.gram), unit.span, text, fits)
        digest = xxhash.xxh3_64_intdigest
        where = zip(begin[st].tolist(), finish[en + unit.length - 2].tolist(), strict=True)
        c = np.fromiter((digest(flat[s:e]) for s, e in where), np.uint64, len(st))
        own = text[st]
        shift = np.array(offsets, np.int64)[own] - begins[own]
        cols = (np.array(keys, np.int64)[own], (st + shift).astype(np.int32), (en + shift).astype(np.int32), a.view(np.int64), c.view(np.int64), twice)
        return pa.record_batch([pa.array(x) for x in cols], names=["doc_id", "st", "en", "a", "c", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, offsets, parts, held = [], [], [], 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                symbols = unit.symbols(value.as_py())
                for at in range(0, len(symbols) - unit.length + 1, unit.block):
                    part = symbols[at : at + unit.block + unit.length - 1]
                    if held + len(part) > unit.block + unit.length and parts:
                        yield parse(keys, offsets, parts)
                        keys, offsets, parts, held = [], [], [], 0
                    keys.append(key)
                    offsets.append(at)
                    parts.append(part)
                    held += len(part)
        if parts:
            yield parse(keys, offsets, parts)

    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(run, "doc_id long, st int, en int, a long, c long, twice boolean")


def settle(docs: DataFrame, unit: Unit) -> tuple[DataFrame, DataFrame]:
    """``(later, open)``, both staged: runs ``(doc_id, st, en)`` whose windows all start earlier too, and runs ``(doc_id, st, en, a, kinds, text)`` left to compare.

    ``kinds`` counts the different contents of the run's minimizer; ``text`` holds
    the run's symbols, joined as ``unit`` joins them.
    """
    parsed = stage(runs(docs, unit), "runs")
    many = parsed.groupBy("a").agg(F.count("*").alias("n"), F.max("twice").alias("any")).where("n > 1 or any").select("a")
    many = stage(many, "repeated")
    alive = stage(parsed.join(many, "a"), "alive")
    unstage(parsed, many)
    place = F.struct("doc_id", "st")
    first = alive.groupBy("a", "c").agg(F.min(place).alias("first"), F.max("twice").alias("any"))
    kinds = first.groupBy("a").agg(F.count("*").alias("kinds"))
    marked = alive.join(first.select("a", "c", "first"), ["a", "c"])
    later = stage(marked.where(place != F.col("first")).select("doc_id", "st", "en"), "later")
    left = first.join(kinds, "a").where("kinds > 1 or any").select("a", "c", "first", "kinds")
    rest = alive.join(left, ["a", "c"]).where(place == F.col("first"))
    by_doc = stage(rest.groupBy("doc_id").agg(F.collect_set(F.struct("st", "en", "a", "kinds")).alias("runs")), "open")
    unstage(alive)
    opened = stage(_texts(docs, by_doc, unit), "texts")
    unstage(by_doc)
    return later, opened


def _texts(docs: DataFrame, by_doc: DataFrame, unit: Unit) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for key, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                symbols = unit.symbols(text)
                for r in own:
                    if (end := r["en"] + unit.length - 1) <= len(symbols):
                        rows.append((key, r["st"], r["en"], r["a"], r["kinds"], unit.join(symbols[r["st"] : end])))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "st", "en", "a", "kinds", "text"])

    joined = docs.select(F.col("doc_id").cast("long"), "text").join(by_doc, "doc_id").select("doc_id", "text", "runs")
    return joined.mapInArrow(cut, "doc_id long, st int, en int, a long, kinds long, text binary")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows, a few at a time: what Python makes of long texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ranges(doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places as maximal ranges: doc, first, end."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    if not len(pos):
        return doc, pos, pos
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1] + 1)])
    last = np.append(np.flatnonzero(new)[1:], len(pos)) - 1
    return doc[new], pos[new], pos[last] + 1


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``doc_id, text, marks``: each document with its ranges of repeated windows, null for none."""
    by_doc = marks.groupBy("doc_id").agg(F.collect_list(F.struct("st", "en")).alias("marks"))
    return docs.select(F.col("doc_id").cast("long"), "text").join(by_doc, "doc_id", "left").select("doc_id", "text", "marks")


def covered(n: int, marks: list[dict] | None, length: int) -> np.ndarray:
    """Which of n symbols lie in a marked window."""
    edge = np.zeros(n + 1, np.int64)
    for r in marks or ():
        if r["st"] < n:
            edge[r["st"]] += 1
            edge[min(n, r["en"] + length - 1)] -= 1
    return np.cumsum(edge[:-1]) > 0
