"""The exact part of near-duplicate groups: Jaccard similarity of word shingles, and a prefix-filtered self-join for links beyond a fingerprint's reach."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, most_frequent, stage, text_key, unstage

#: Distinct texts whose shingles are counted to put common ones last. The order bounds the work; no order loses a pair.
ORDER_TEXTS = 8_000
#: So many of the most common shingles, at most, have a place of their own in the order.
ORDER_SHINGLES = 200_000
#: Keys that are sent to all tasks; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Orders in which each token's texts are paired with their neighbours, beside the one by size.
ORDERS = 8
_COLUMNS = ("token", "key", "n", "pos", "prev", "prev2")
_POSTING = "token long, key long, n int, pos int, prev long, prev2 long"
_LINK = "a long, b long"


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's runs of ``size`` words; a shorter text is one shingle, a blank one has none."""
    parts = (text or "").encode().translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    words = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    k = min(size, len(parts))
    out = np.full(len(parts) - k + 1, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(out)]
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    return np.unique(out)


def _sets(keyed: DataFrame) -> DataFrame:
    """``(key, tokens)`` of ``keyed(key, text)``; copies that meet in a task come once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, keys, sets = batch.slice(at, 500), [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if key not in seen:
                        seen.add(key)
                        keys.append(key)
                        sets.append(shingles(text.as_py()).view(np.int64))
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "tokens"])

    return keyed.select("key", "text").mapInArrow(run, "key long, tokens array<long>")


def parities(tokens: np.ndarray) -> bytes:
    """A set as bits, four a token or more: a bit is 1 if an odd number of tokens fall on it."""
    size = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def may_reach(a: bytes, b: bytes, na: int, nb: int) -> bool:
    """False if sets of these ``parities`` and sizes are surely below 0.8: each bit that differs is a token that only one of them has."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) != len(y):  # the longer one is folded: its bits' numbers are the tokens' lower bits
        few = min(len(x), len(y))
        x, y = (np.bitwise_xor.reduce(v.reshape(-1, few), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum()) <= na + nb - 2 * ((4 * (na + nb) + 8) // 9)


def _parities(keyed: DataFrame) -> DataFrame:
    """``(key, n, bits)`` of ``keyed(key, text)``: the set's size and parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, sizes, bits = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key not in seen:
                    seen.add(key)
                    tokens = shingles(text.as_py())
                    keys.append(key)
                    sizes.append(len(tokens))
                    bits.append(parities(tokens))
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary())], names=["key", "n", "bits"])

    return keyed.select("key", "text").mapInArrow(run, "key long, n int, bits binary")


def _common(keyed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most common shingles, sorted, and in how many of the texts counted they are."""
    n = keyed.agg(F.approx_count_distinct("key")).first()[0]
    some = keyed.where(F.pmod(F.xxhash64("key"), F.lit(max(1, n // ORDER_TEXTS))) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, sets = batch.slice(at, 500), []
                for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if key not in seen:
                        seen.add(key)
                        sets.append(shingles(text.as_py()))
                if sets:
                    tokens, n = np.unique(np.concatenate(sets), return_counts=True)
                    yield pa.record_batch([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

    parts = some.select("key", "text").mapInArrow(count, "token long, n long")
    seen = stage(parts.groupBy("token").agg(F.sum("n").alias("n")).where("n > 2"), "shingles")
    rows = most_frequent(seen, ORDER_SHINGLES).toArrow()
    unstage(seen)
    tokens, counts = rows.column("token").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    by = np.argsort(tokens)
    return tokens[by], counts[by]


def prefix(tokens: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set's first tokens, rare ones before common ones: two sets of Jaccard 0.8 or more share one of them."""
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        tokens = tokens[np.lexsort((tokens, np.where(common[at] == tokens, counts[at], 0)))]
    return tokens[: len(tokens) - (4 * len(tokens) + 4) // 5 + 1]


def _postings(keyed: DataFrame) -> DataFrame:
    """``token, key, n, pos, prev, prev2`` of all prefixes: the set's size, the token's place in it and the two tokens before it."""
    common = keyed.sparkSession.sparkContext.broadcast(_common(keyed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                keys, sizes, first = [], [], []
                part = batch.slice(at, 500)
                for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    if key and key not in seen:
                        seen.add(key)
                        tokens = shingles(text.as_py())
                        keys.append(key)
                        sizes.append(len(tokens))
                        first.append(prefix(tokens, *common.value))
                if keys:
                    n = np.fromiter(map(len, first), np.int64, len(first))
                    pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    cols = (np.concatenate(first).view(np.int64), np.repeat(np.array(keys, np.int64), n))
                    cols += (np.repeat(np.array(sizes, np.int32), n), pos.astype(np.int32), *(np.where(pos >= back, np.roll(cols[0], back), 0) for back in (1, 2)))
                    yield pa.record_batch([pa.array(c) for c in cols], names=_COLUMNS)

    return keyed.select("key", "text").mapInArrow(run, _POSTING)


def _by_token(postings: DataFrame) -> DataFrame:
    return postings.repartition("token").sortWithinPartitions("token", "n", "key")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of whole tokens that have two keys or more, each key once; rows are sorted by token, n and key."""
    rest = None
    for batch in _ended(batches):
        if batch is not None:
            now = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            rest = now if rest is None else {c: np.concatenate([rest[c], now[c]]) for c in now}
        if rest is None or not len(rest["token"]):
            continue
        cut = len(rest["token"]) if batch is None else int(np.flatnonzero(rest["token"] == rest["token"][-1])[0])
        own, rest = {c: v[:cut] for c, v in rest.items()}, {c: v[cut:] for c, v in rest.items()}
        if not cut:
            continue
        new = np.ones(cut, bool)
        new[1:] = (own["token"][1:] != own["token"][:-1]) | (own["key"][1:] != own["key"][:-1])
        own = {c: v[new] for c, v in own.items()}
        same = own["token"][1:] == own["token"][:-1]
        many = np.zeros(len(own["token"]), bool)
        many[1:] |= same
        many[:-1] |= same
        if many.any():
            yield {c: v[many] for c, v in own.items()}


def _ended(batches):
    yield from batches
    yield None


def _can(own: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets can reach 0.8 if this token is the first that they share; a pair is kept at its first one at least."""
    left = np.minimum(own["n"][i] - own["pos"][i], own["n"][j] - own["pos"][j]).astype(np.int64)
    return 9 * left >= 4 * (own["n"][i].astype(np.int64) + own["n"][j])


def _had(own: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sets share one of the two tokens before this one."""
    found = np.zeros(len(i), bool)
    for x, a in (("prev", 1), ("prev2", 2)):
        for y, b in (("prev", 1), ("prev2", 2)):
            found |= (own[x][i] == own[y][j]) & (own["pos"][i] >= a) & (own["pos"][j] >= b)
    return found


def _links(own: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    a, b = own["key"][i], own["key"][j]
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return pa.record_batch([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for own in _groups(batches):
        yield pa.record_batch([pa.array(own[c]) for c in _COLUMNS], names=_COLUMNS)


def _beside(own: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand side by side under one token, whose components differ and that can reach 0.8."""
    i = np.flatnonzero((own["token"][1:] == own["token"][:-1]) & (own["root"][1:] != own["root"][:-1]))
    i = i[_can(own, i, i + 1)]
    return i, i + 1


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each token, the pairs of neighbours in size whose components differ: as many as there are rows at most."""
    for own in _groups(batches):
        i, j = _beside(own)
        if len(i):
            yield _links(own, i, j)


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_neighbours``, but by ``ORDERS`` orders at random: a text of a large family meets several others of it, and not the same two at each token."""
    for own in _groups(batches):
        found = []
        for which in range(ORDERS):
            mixed = (own["key"].view(np.uint64) ^ np.uint64(which * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
            order = np.lexsort((mixed ^ mixed >> np.uint64(33), own["token"]))
            i, j = _beside({c: v[order] for c, v in own.items()})
            found.append((order[i], order[j]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(i):
            yield _links(own, i, j)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each token, all pairs that can reach 0.8 and whose components differ, but those that share one of the two tokens before it, too: that one has the pair already."""
    for own in _groups(batches):
        ends = np.flatnonzero(np.append(own["token"][1:] != own["token"][:-1], True)) + 1
        last = np.repeat(ends, np.diff(ends, prepend=0))  # the end of each row's group
        step, i = 1, np.arange(len(last))
        while len(i := i[i + step < last[i]]):
            # rows are in order of size: once a neighbour is too large, so are those behind it
            i = i[5 * own["n"][i].astype(np.int64) >= 4 * own["n"][i + step].astype(np.int64)]
            k = i[own["root"][i] != own["root"][i + step]]
            k = k[_can(own, k, k + step)]
            k = k[~_had(own, k, k + step)]
            if len(k):
                yield _links(own, k, k + step)
            step += 1


def _with_root(postings: DataFrame, roots: DataFrame) -> DataFrame:
    named = postings.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    return named.select(*_COLUMNS, F.coalesce("root", "key").alias("root"))


def _texts_of(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    keys = stage(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "keys")
    few = keys.count() <= BROADCAST_KEYS
    return keyed.select("key", "text").join(F.broadcast(keys) if few else keys, "key", "left_semi")


def possible(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs that the parities of their shingle sets don't refuse: all of 0.8 or more, and few others. A set's parities have a sixteenth of its size, or an eighth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, x, nb, y = (c.to_pylist() for c in batch.columns[2:])
            yield batch.select(["a", "b"]).filter(pa.array(list(map(may_reach, x, y, na, nb)), pa.bool_()))

    bits = _parities(_texts_of(pairs, keyed)).dropDuplicates(["key"])
    left = bits.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x"))
    right = bits.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y"))
    return stage(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "x", "nb", "y").mapInArrow(run, _LINK), "possible")


def confirmed(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of 0.8 or more, by whole sets and whole numbers; their parities refuse most others before."""
    pairs = possible(pairs, keyed)
    sets = _sets(_texts_of(pairs, keyed)).dropDuplicates(["key"])  # dealt out by key once, for both sides
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return stage(pairs.join(left, "a").join(right, "b").where(9 * both >= 4 * (F.size("x") + F.size("y"))).select("a", "b"), "confirmed")


def linked_roots(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` of the text keys of ``docs(text)`` that have near-duplicates, from ``roots`` that are known already.

    Texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more
    are linked. Words are what ASCII white space separates, ASCII letters
    lower-cased. A text of fewer words is one shingle; null, empty and blank texts
    are copies of each other. Every such pair is found unless ``roots`` has it in one
    group: of two sets of similarity 0.8, the first ``n - ceil(0.8 n) + 1`` tokens
    in any one order share a token, and whole sets decide. Texts and shingles are
    told apart by 64-bit hashes.
    """
    keyed = docs.select(text_key().alias("key"), "text")
    postings = stage(_by_token(_postings(keyed)).mapInArrow(_repeated, _POSTING), "postings")
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    tried = None
    # Neighbours first, so that large groups of near copies are one component before all pairs across components are taken.
    for step in (_neighbours, _mixed, _across):
        pairs = _by_token(_with_root(postings, roots)).mapInArrow(step, _LINK)
        pairs = pairs.distinct() if tried is None else pairs.distinct().join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "candidates")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = links.unionByName(confirmed(pairs, keyed))
        roots = stage(connected_components(links), "roots")
    unstage(postings)
    return roots
