"""Benchmark decontamination (operator 2): template canonicalisation, a hash join of template windows, and slot consistency."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage, table

#: Template words in a window, of which half must be literal.
WINDOW = 8
#: Items without such a window are matched in their whole length; those of fewer words than this say nothing of a document and match none.
SHORTEST = 3
#: Share of an item's windows that a document must hold, in places whose slots agree; or as many windows of one place as a passage has.
SHARE, PASSAGE = 0.5, 25
#: Benchmark windows up to this number are broadcast (some 40 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 200_000
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNIT_WORDS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles g kg gram grams kilogram kilograms ounce ounces pound pounds "
    "ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years dollar dollars cent cents euro euros percent degree degrees mph kph kw w v watt watts volts".split()
)
_BARE = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}%]+$")
_NUMERIC = regex.compile(r"[\p{N}.,:/%]*\p{N}[\p{N}.,:/%]*\p{L}{0,3}")
_MARKS = "!\"#$&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CACHE = 200_000
_NAME_HASH = np.uint64(xxhash.xxh3_64_intdigest(NAME))


class Templates(dict):
    """Words as template tokens: the number of each word seen, and arrays of what is known of it."""

    def __init__(self):
        super().__init__()
        self.hash = np.zeros(_CACHE, np.uint64)
        #: 0 no token, 1 literal, 2 number or unit, 3 a name unless a sentence begins with it; and whether a sentence ends with it.
        self.kind = np.zeros(_CACHE, np.int8)
        self.ends = np.zeros(_CACHE, bool)
        self.core: dict[int, str] = {}

    def __missing__(self, word: str) -> int:
        core = word.strip(_MARKS)
        if not core.isalpha():
            core = _BARE.sub("", word)
        low = core.lower()
        kind, token = 1, low
        if not core:
            kind = 0
        elif low in NUMBER_WORDS or not core.isalpha() and _NUMERIC.fullmatch(core):
            kind, token = 2, NUMBER
        elif low in UNIT_WORDS:
            kind, token = 2, UNIT
        elif core[0] != low[0] and len(core) > 1 and core[1:] == low[1:]:
            kind = 3
        i = len(self)
        if i == len(self.hash):
            for name in ("hash", "kind", "ends"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self.hash[i], self.kind[i] = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")), kind
        self.ends[i] = word[-1] in ".!?:" or word[-2:-1] in (".", "!", "?")
        if kind > 1:
            self.core[i] = low
        self[word] = i
        return i

    def template(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A whole text as template words: the number of each word, its token's hash, and whether it is a slot."""
        if len(self) > _CACHE:  # begin anew between texts, so that memory is bounded
            self.clear()
            self.core.clear()
        words = (text or "").split()
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        kind = self.kind[ids]
        if not kind.all():
            ids, kind = ids[kind > 0], kind[kind > 0]
        token, slot = self.hash[ids], kind > 1
        if slot.any():
            name = kind == 3
            name[0] = False
            name[1:] &= ~self.ends[ids[:-1]]
            slot = name | (kind == 2)
            token[name] = _NAME_HASH
        return ids, token, slot

    def windows(self, template: tuple, size: int = WINDOW, sparse: bool = False) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
        """Hash, place and slots of each window of ``size`` template words; slots are the placeholders' values in order, or None.

        At least half the words are literal. ``sparse`` windows may have one literal
        word only; the slots of those with fewer than half count by their values, as
        so short a template would be found anywhere.
        """
        ids, token, slot = template
        n = len(ids) - size + 1
        if n < 1:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        h = self._roll(token, size, size if sparse else 0)
        if not slot.any():
            return h, np.arange(n), [None] * n
        before = np.concatenate([[0], np.cumsum(slot)])
        filled = before[size:] - before[:-size]
        if sparse:
            values = token.copy()
            for i in np.flatnonzero(slot).tolist():
                values[i] = xxhash.xxh3_64_intdigest(self.core[int(ids[i])].encode("utf-8", "surrogatepass"))
            h = np.where(2 * filled > size, self._roll(values, size, -size), h)
        at = np.flatnonzero(size - filled >= (1 if sparse else (size + 1) // 2))
        slots: list[str | None] = [None] * len(at)
        for i in np.flatnonzero(filled[at] > 0).tolist():
            here = range(at[i], at[i] + size)
            slots[i] = "\x1f".join(self.core[int(ids[j])] for j in here if slot[j])
        return h[at], at, slots

    @staticmethod
    def _roll(token: np.ndarray, size: int, start: int) -> np.ndarray:
        n = len(token) - size + 1
        h = np.full(n, start, np.int64).view(np.uint64)
        for j in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + token[j : j + n]
            h ^= h >> np.uint64(29)
        return h


@functools.lru_cache(maxsize=1)
def templates() -> Templates:
    """One for each worker process, whatever number of tasks it runs."""
    return Templates()


def whole_sizes(items: DataFrame) -> list[int]:
    """Lengths, in template words, of the items that have no window of WINDOW words: as few as such items are, and mostly none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = templates()
        for batch in batches:
            made = [own.template(t.as_py()) for t in batch.column(0)]
            sizes = {len(m[0]) for m in made if len(m[0]) >= SHORTEST and not m[2].all() and not len(own.windows(m)[0])}
            yield pa.record_batch([pa.array(sorted(sizes), pa.int32())], names=["size"])

    return sorted(r["size"] for r in items.select("text").mapInArrow(run, "size int").distinct().collect())


def template_windows(texts: DataFrame, key: str, whole: tuple[int, ...] = (), items: bool = False) -> DataFrame:
    """``key, pos, h, slots``: the template windows of ``texts(key, text)``.

    For each size in ``whole`` there are the windows of that size too, with a literal
    word or more. ``items`` have their own whole template as such a window, and only if they have no other.
    """

    def of(own: Templates, text: str | None) -> Iterator[tuple]:
        made = own.template(text)
        usual = own.windows(made)
        yield usual
        if not items:
            yield from (own.windows(made, size, True) for size in whole)
        elif len(made[0]) in whole and not len(usual[0]):
            yield own.windows(made, len(made[0]), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = templates()
        for batch in batches:
            keys, parts, size = [], [], 0
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for found in of(own, t.as_py()):
                    keys.append((k, len(found[0])))
                    parts.append(found)
                    size += len(found[0])
                if size > 500_000:
                    yield _batch(keys, parts)
                    keys, parts, size = [], [], 0
            yield _batch(keys, parts)

    def _batch(keys, parts) -> pa.RecordBatch:
        ids = np.repeat(np.array([k if k is not None else -1 for k, _ in keys], np.int64), np.array([n for _, n in keys], np.int64))
        h = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint64)]).view(np.int64)
        pos = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]).astype(np.int32)
        slots = [s for p in parts for s in p[2]]
        return pa.record_batch([pa.array(ids), pa.array(pos), pa.array(h), pa.array(slots, pa.string())], names=[key, "pos", "h", "slots"])

    keyed = texts.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), "text")
    return keyed.mapInArrow(run, f"{key} long, pos int, h long, slots string")


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, matched, share, exact``: the benchmark items that documents hold, re-parameterised ones included.

    A place is a document, an item and an offset between them. Its slots agree if
    every value of the item stands for one value in the document and the other way
    round; places whose slots disagree don't count. A row needs ``share`` of the
    item's windows in places that count, or a passage of PASSAGE windows in one
    place; ``exact`` says that no slot was changed. Items that are shorter than a
    window, or whose windows are mostly slots, are matched in their whole length.
    Null texts match nothing, nor do items of fewer than SHORTEST words or without a
    literal one; rows without an id are left out; a doc_id that occurs twice counts as one document.
    """
    whole = tuple(whole_sizes(benchmark))
    bench = template_windows(benchmark.select("item_id", "text"), "item_id", whole, items=True)
    bench = bench.select("item_id", F.col("pos").alias("ipos"), "h", F.col("slots").alias("islots")).distinct()
    bench = stage(bench, "benchmark")
    size = bench.groupBy("item_id").agg(F.countDistinct("ipos").alias("windows"))
    if bench.count() <= BROADCAST_WINDOWS:
        bench, size = F.broadcast(bench), F.broadcast(size)
    hits = template_windows(docs.select("doc_id", "text"), "doc_id", whole).join(bench, "h")
    pairs = F.when(
        F.col("islots").isNotNull(),
        F.arrays_zip(F.split("islots", "\x1f").alias("i"), F.split("slots", "\x1f").alias("d")),
    )
    place = hits.groupBy("doc_id", "item_id", (F.col("pos") - F.col("ipos")).alias("offset")).agg(
        F.collect_set("ipos").alias("at"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    n = F.size("pairs")
    agree = (F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))) == n) & (
        F.size(F.array_distinct(F.transform("pairs", lambda p: p["d"]))) == n
    )
    same = F.forall("pairs", lambda p: p["i"] == p["d"])
    found = (
        place.where(agree).select("doc_id", "item_id", F.explode("at").alias("ipos"), same.alias("same"), F.size("at").alias("n"))
        .groupBy("doc_id", "item_id").agg(F.countDistinct("ipos").alias("matched"), F.every("same").alias("exact"), F.max("n").alias("longest"))
        .join(size, "item_id").withColumn("share", F.col("matched") / F.col("windows"))
    )
    return found.where((F.col("share") >= share) | (F.col("longest") >= PASSAGE)).select("doc_id", "item_id", "matched", "share", "exact")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLE_SQL: dict[str, str] = {}
