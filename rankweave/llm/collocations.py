"""Phrase collocation mining (operator 12): frequent phrases by set-oriented relational mining.

The occurrence relation is kept sorted by piece and position, packed as one row a
block of consecutive words, and its next length is made from it: adjacent
positions are merged, groups are counted, and occurrences of groups that are not
frequent leave the relation before the next length is made.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table, unstage

#: Occurrences in a row of the relation, bytes of text that it may stand for, bytes of a piece beyond which it is split
#: in parts, merged pairs that are counted in a task at a time, and rows of the relation in a file, which are written and read
#: at once; they bound a task's memory and not a result.
BLOCK, TEXT, CHUNK, PAIRS, ROWS = 1 << 19, 32 << 20, 4 << 20, 1 << 20, 4
#: A-Z to a-z, and each byte that ends a piece to a line end, the only one left.
_FOLDED = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b"\n" * 9)
#: Salts over which a group's candidates are ranked before its first ones are ranked together.
SALTS = 64
RELATION = "block long, own int, codes array<int>, ids array<long>"
COUNTS = "bucket int, block long, a array<long>, b array<long>, n array<int>"
GROUPS = "block long, a array<long>, b array<long>, id array<long>, f array<long>"


class _Own(dict):
    """Numbers of one group's words in a block, in the order of their first look-up."""

    def __init__(self, group: str, block: _Block):
        super().__init__()
        self.group, self.block = group, block

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.block.words)
        self.block.words.append(word)
        self.block.of.append(self.group)
        return number


class _Block:
    """Words as numbers of (group, word), -1 where a piece ends. Positions up to ``own`` count; those after it belong to the next block too."""

    def __init__(self):
        self.codes, self.own, self.size, self.groups = array("i"), 0, 0, {}
        self.words, self.of = [], []

    def add(self, group: str, words: list[bytes]) -> None:
        numbers = self.groups.get(group)
        if numbers is None:
            numbers = self.groups[group] = _Own(group, self)
        self.codes.extend([numbers[w] for w in words])
        self.size += sum(map(len, words)) + len(words)

    def row(self, block: int) -> pa.RecordBatch:
        codes = np.array(self.codes, np.int32)
        counts = np.bincount(codes[: self.own][codes[: self.own] >= 0], minlength=len(self.words))
        column = pa.StructArray.from_arrays([pa.array(self.of, pa.string()), pa.array(self.words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=["group", "word", "n"])
        return pa.record_batch([pa.array([block], pa.int64()), pa.array([self.own], pa.int32()), _one(codes), _one(column)], names=["block", "own", "codes", "words"])


def _one(values: np.ndarray | pa.Array) -> pa.ListArray:
    """A column of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values) if isinstance(values, np.ndarray) else values)


def _chunks(piece: bytes, follow: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """A piece's words, in parts if it is very long, and the ``follow`` words after each part."""
    if len(piece) < CHUNK:
        yield piece.split(), []
        return
    found = (m.group() for m in re.finditer(rb"[^ \t]+", piece))
    now = list(islice(found, CHUNK >> 4))
    while now:
        after = list(islice(found, CHUNK >> 4))
        yield now, after[:follow]
        now = after


def occurrences(docs: DataFrame, longest: int) -> DataFrame:
    """The occurrence relation of ``docs(group, text)``: ``block, own, codes, words``, the words' groups, texts and counts in the order of their codes.

    A block that ends within a piece also has the ``longest - 1`` words after it, so
    that phrases which begin in it are whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for group, text in zip(batch.column(0), batch.column(1), strict=True):
                group = group.as_py()
                for piece in text.as_buffer().to_pybytes().translate(_FOLDED).split(b"\n"):
                    for words, after in _chunks(piece, longest - 1):
                        while words:
                            room = max(1, BLOCK - len(block.codes))
                            block.add(group, words[:room])
                            block.own, words = len(block.codes), words[room:]
                            if block.own >= BLOCK or block.size >= TEXT:
                                block.add(group, (words[: longest - 1] + after)[: longest - 1])
                                yield block.row(number)
                                number, block = number + 1, _Block()
                    if block.codes:
                        block.codes.append(-1)
        if block.codes:
            yield block.row(number)

    return docs.mapInArrow(run, "block long, own int, codes array<int>, words array<struct<group:string,word:string,n:long>>")


def _flat(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The elements of a column of lists."""
    return np.asarray((column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten())


def _merged(codes: np.ndarray, size: int) -> np.ndarray:
    """For each position, a key of its phrase and the one at the next position; -1 where either is missing."""
    a, b = codes[:-1].astype(np.int64), codes[1:]
    return np.append(np.where((a >= 0) & (b >= 0), a * size + b, -1), -1)


def counted(relation: DataFrame, buckets: int) -> DataFrame:
    """Phrases one word longer than those of ``relation``, counted within each block and dealt over ``buckets`` by a hash of the ids ``a, b`` of the two merged phrases.

    Phrases that only begin after the block's own positions are named with a count of 0, as
    the next length needs them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                codes, ids = _flat(row.column(2)), _flat(row.column(3))
                own, keys = row.column(1)[0].as_py(), _merged(codes, len(ids))
                after = np.unique(keys[own:])
                keys, n = np.unique(keys[:own][keys[:own] >= 0], return_counts=True)
                place = np.searchsorted(keys, after)
                after = after[(after >= 0) & (np.append(keys, -1)[place] != after)]
                keys, n = np.concatenate([keys, after]), np.concatenate([n, np.zeros(len(after), n.dtype)])
                if not len(keys):
                    continue
                a, b = ids[keys // len(ids)], ids[keys % len(ids)]
                mixed = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                bucket = (((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for own_bucket in np.flatnonzero(np.diff(edges)):
                    at = order[edges[own_bucket] : edges[own_bucket + 1]]
                    yield pa.record_batch([pa.array([own_bucket], pa.int32()), row.column(0), _one(a[at]), _one(b[at]), _one(n[at].astype(np.int32))], names=["bucket", "block", "a", "b", "n"])

    return relation.mapInArrow(run, COUNTS)


def grouped(counts: DataFrame, least: int, again: bool) -> DataFrame:
    """Groups of ``counts`` that occur ``least`` times, with new ids, as lists a bucket (block -1), and with ``again`` also those of each block that has them.

    A bucket has a row's part for each block, and a phrase occurs once in each, so a
    bucket's size doesn't depend on how often phrases occur.
    """

    def run(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        blocks, sizes = np.asarray(part["block"]), np.asarray(part["a"].combine_chunks().value_lengths())
        a, b, n = _flat(part["a"]), _flat(part["b"]), _flat(part["n"])
        order = np.lexsort((b, a))
        new = np.append(True, (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0))
        first = np.flatnonzero(new)
        f = np.add.reduceat(n[order].astype(np.int64), first)
        often = f >= least
        number = np.where(often, np.cumsum(often) - 1, -1)
        base = np.int64(part["bucket"][0].as_py()) << 32
        tables = [(-1, a[order][first[often]], b[order][first[often]], base + np.arange(often.sum()), f[often])]
        if again:
            own = np.empty(len(a), np.int64)
            own[order] = number[np.cumsum(new) - 1]
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            for block, x, y in zip(blocks.tolist(), cuts[:-1], cuts[1:], strict=True):
                at = x + np.flatnonzero(own[x:y] >= 0)
                if len(at):
                    tables.append((block, a[at], b[at], base + own[at], np.empty(0, np.int64)))
        rows = [pa.record_batch([pa.array([block], pa.int64()), *map(_one, lists)], names=["block", "a", "b", "id", "f"]) for block, *lists in tables]
        return pa.Table.from_batches(rows)

    return counts.groupBy("bucket").applyInArrow(run, GROUPS)


def _recoded(left: pa.Table, keys: np.ndarray, ids: np.ndarray, at: np.ndarray) -> pa.Table:
    """A block's row with the codes of ``at`` among ``keys``, whose ids become the block's, ascending; -1 for others."""
    order = np.argsort(ids)
    code = np.empty(len(ids), np.int32)
    code[order] = np.arange(len(ids), dtype=np.int32)
    by = np.argsort(keys)
    keys, code = keys[by], code[by]
    place = np.minimum(np.searchsorted(keys, at), max(0, len(keys) - 1))
    found = np.where(keys[place] == at, code[place], -1) if len(keys) else np.full(len(at), -1)
    return pa.table([left["block"], left["own"], _one(found.astype(np.int32)), _one(ids[order])], names=["block", "own", "codes", "ids"])


def kept_words(base: DataFrame, frequent: DataFrame) -> DataFrame:
    """The relation of frequent words: semi-join of the occurrences with ``frequent(block, key, id)``, whose key is a word's code. Both sides meet by block, which is bounded."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _recoded(left, np.asarray(right["key"]), np.asarray(right["id"]), _flat(left["codes"]).astype(np.int64))

    named = frequent.select(F.col("block").alias("home"), "key", "id")
    return base.select("block", "own", "codes").groupBy("block").cogroup(named.groupBy("home")).applyInArrow(run, RELATION)


def kept_phrases(relation: DataFrame, frequent: DataFrame) -> DataFrame:
    """The relation of the next length: adjacent positions merged, semi-joined with the frequent groups ``block, a, b, id`` (lists) of the block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, ids = _flat(left["codes"]), _flat(left["ids"])
        a, b = (np.searchsorted(ids, _flat(right[c])) for c in ("a", "b"))
        return _recoded(left, a * max(1, len(ids)) + b, _flat(right["id"]), _merged(codes, len(ids)))

    named = frequent.select(F.col("block").alias("home"), "a", "b", "id")
    return relation.groupBy("block").cogroup(named.groupBy("home")).applyInArrow(run, RELATION)


def _staged(blocks: DataFrame, name: str) -> DataFrame:
    """The relation as a table of few rows a file: a task that has many blocks neither writes nor reads them at once."""
    return stage(blocks, name, maxRecordsPerFile=str(ROWS))


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, by: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Tables of phrases of 1 to ``longest`` words that occur ``least`` times in their group, and ``group, n``: the words of each group.

    A table has ``id, a, b, group, phrase, last, f, heads, tails``: the ids of the phrases
    without its last and first word, and how often its first (last) 1, 2, ... words
    occur, itself included.
    """
    group = F.coalesce(F.col(f"`{by}`").cast("string"), F.lit("und")).alias("group")
    base = _staged(occurrences(docs.select(group, F.coalesce(F.col("text"), F.lit("")).alias("text")), longest), "occurrences")
    entries = base.select("block", F.posexplode("words").alias("key", "w")).select("block", F.col("key").cast("long").alias("key"), "w.*")
    all_words = stage(entries.groupBy("group", "word").agg(F.sum("n").alias("f")), "words")
    totals = all_words.groupBy("group").agg(F.sum("f").alias("n"))
    f = F.array("f")
    one = all_words.where(F.col("f") >= least).select(
        F.monotonically_increasing_id().alias("id"), F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"),
        "group", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", f.alias("heads"), f.alias("tails"))
    tables = [stage(one, "phrases")]
    own = entries.join(tables[0].select("group", F.col("phrase").alias("word"), "id"), ["group", "word"]).select("block", "key", "id")
    relation = _staged(kept_words(base, own), "relation")
    unstage(base)
    for length in range(2, longest + 1):
        positions = relation.agg(F.sum("own")).first()[0] or 0
        found = stage(grouped(counted(relation, 1 + positions // PAIRS), least, length < longest), "groups", rows=1)
        zipped = F.explode(F.arrays_zip("a", "b", "id", "f")).alias("x")
        often = found.where("block = -1").select(zipped).select("x.*")
        head = tables[-1].select(F.col("id").alias("a"), "group", "phrase", F.col("heads").alias("h"))
        tail = tables[-1].select(F.col("id").alias("b"), "last", F.col("tails").alias("t"))
        made = often.join(head, "a").join(tail, "b").select(
            "id", "a", "b", "group", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f", F.concat("h", f).alias("heads"), F.concat("t", f).alias("tails"))
        tables.append(stage(made, "phrases"))
        if length < longest:
            after = _staged(kept_phrases(relation, found.where("block >= 0")), "relation")
            unstage(relation)
            relation = after
        unstage(found)
    unstage(relation)
    return tables, totals


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, cover: int = 50, top: int = 2000, by: str = "lang") -> DataFrame:
    """``by, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``longest`` words of each group of ``docs(by, text)``.

    ``a`` counts a phrase's occurrences, ``n`` all words of the group; of the cuts in
    two parts that occur ``l`` and ``r`` times the one of lowest score
    ``floor(1000000 a a / (l r))`` counts, the first of equal ones. A phrase is dropped
    if a longer frequent one that contains it has ``cover`` percent of its occurrences
    or more; as counts fall with length, one word more tells. Arithmetic is in decimals
    of 38 digits, exact below 10 ** 15 occurrences. Null groups are ``und``; null and
    empty texts have no words; repeated rows count each; groups without a frequent phrase
    give no rows. Words of any length and texts of any length go whole.
    """
    tables, totals = frequent_phrases(docs, longest, least, by)
    parts = []
    for k, phrases in enumerate(tables[1:], 2):
        left = phrases.select("group", "phrase", "id", "f", "heads", "tails")
        if k < longest:
            above = tables[k].select(F.explode(F.array("a", "b")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("above"))
            left = left.join(above, "id", "left").where(F.col("above").isNull() | (F.col("above") * 100 < F.col("f") * cover))
        scored = F.transform(
            F.sequence(F.lit(1), F.lit(k - 1)),
            lambda j: F.struct(F.call_function("div", _exact("f") * _exact("f") * F.lit(1_000_000).cast("decimal(7,0)"), F.element_at("heads", j).cast("decimal(19,0)") * F.element_at("tails", k - j).cast("decimal(19,0)")).alias("score"),
                               j.alias("cut"), F.element_at("heads", j).alias("l"), F.element_at("tails", k - j).alias("r")))
        parts.append(left.select("group", "phrase", F.col("f").alias("a"), F.array_min(scored).alias("best")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    order = [F.col("best.score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("group", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "group").select(F.col("group").alias(by), "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")


def _exact(count: str):
    return F.col(count).cast("decimal(15,0)")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text")).withColumn("rank", F.col("rank").cast("long"))


QUERIES = {"op12_collocations": op12_collocations}
ORACLE_SQL = {
    "op12_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
o AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM i, (VALUES (1), (2), (3)) v(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
big AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE k = 3),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN big USING (lang, phrase) WHERE 100 * big.a >= 50 * c.a),
cut AS (SELECT c.lang, c.phrase, c.a, j, array_to_string(ws[1:j], ' ') AS h, array_to_string(ws[j + 1 :], ' ') AS t
  FROM c, (VALUES (1), (2)) v(j) WHERE j < k AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.lang = c.lang AND g.phrase = c.phrase)),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, h.f AS l, t.f AS r, (1000000::HUGEINT * cut.a * cut.a // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = cut.h JOIN f t ON t.lang = cut.lang AND t.phrase = cut.t),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
x AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM x JOIN n USING (lang) WHERE rank <= 2000""",
}
