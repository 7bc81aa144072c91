"""SentencePiece encoding and decoding (operator 10): a relational lattice over the distinct units of the corpus, folded in Spark."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lay_out, most_frequent, settings, stage, table, unstage

BLANK = "▁"
#: At most so many frequent units, of a sample of so many texts, have their codes in every task; codes of all other units
#: come by a join. Which units these are bears on speed alone.
FREQUENT, SAMPLE = 150_000, 20_000
#: Bits of an edge's fields within its long: rank of the score, end, size, id. Their order is the order of the merges.
RANK, END, SIZE, ID = 18, 22, 5, 18
NO_PIECE = (1 << ID) - 1
#: Characters from which on a unit is cut where no piece goes on; shorter ones aren't worth the look.
LONG = 60
#: Distinct units, or keys of texts, that a task holds before it begins anew.
HELD = 60_000
#: Bytes of texts, or of packed ones, that a task cuts at a time, whatever the rows' lengths.
BLOCK, PACKED_BLOCK = 8_000_000, 3_000_000


@dataclass(frozen=True)
class Pieces:
    """A model's pieces: text, id and score of the normal ones, ids of the 256 byte pieces, and all in order of id for decoding."""

    normal: tuple[tuple[str, int, float], ...]
    bytes: tuple[int, ...]
    text: tuple[str, ...]
    merges: bool

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.normal), default=1)

    @cached_property
    def unit(self) -> str:
        """Pattern of the units that no piece goes beyond: blanks, then characters that pieces have side by side.

        Characters are of one class if a chain of neighbours within pieces links
        them; in most models letters of one script are a class, and punctuation another.
        """
        up: dict[str, str] = {}

        def root(c: str) -> str:
            while up.setdefault(c, c) != c:
                c = up[c]
            return c

        for piece, _, _ in self.normal:
            for a, b in pairwise(piece.lstrip(BLANK)):
                up[root(a)] = root(b)
        classes = defaultdict(list)
        for c in up:
            classes[root(c)].append(regex.escape(c, special_only=False))
        runs = [f"[{''.join(sorted(own))}]+" for own in classes.values() if len(own) > 1]
        return f"{BLANK}*(?:{'|'.join([*runs, f'[^{BLANK}]'])})|{BLANK}+"


def read_model(path: str) -> Pieces:
    """Pieces of a model file with identity normalisation and byte fallback; others raise."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sp.serialized_model_proto())
    spec = proto.normalizer_spec
    if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
        raise ValueError("only identity normalisation with a dummy prefix is handled")
    ids = range(sp.get_piece_size())
    normal = tuple((p.piece, i, p.score) for i, p in enumerate(proto.pieces) if p.type == p.NORMAL or p.type == p.USER_DEFINED)
    if any(BLANK in p.lstrip(BLANK) for p, _, _ in normal):
        raise ValueError("a piece goes beyond a word")
    fallback = tuple(i for i in ids if sp.is_byte(i))
    if len(fallback) != 256:
        raise ValueError("byte fallback is needed")
    merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE
    if merges:
        check_order(normal)
    return Pieces(normal, fallback, tuple(sp.id_to_piece(i) for i in ids), merges)


def check_order(normal: tuple[tuple[str, int, float], ...]) -> None:
    """Raise if a piece comes from parts that don't go before it: then one pass over the edges by score isn't the merges.

    A part may have the piece's own score, as in runs of blanks: of equal scores the
    edge that ends first goes first, of those the shortest, which is a part's place.
    """
    score = {p: s for p, _, s in normal}
    for piece in score:
        parts = list(piece)
        while unions := [(score[a + b], -i) for i, (a, b) in enumerate(pairwise(parts)) if a + b in score]:
            best, i = max(unions)
            left, right = parts[-i : 2 - i]
            if any(len(p) > 1 and score[p] < best for p in (left, right)):
                raise ValueError(f"the parts of {piece!r} don't go before it")
            parts[-i : 2 - i] = [left + right]


def normalize(text: str | None) -> str:
    """A leading blank, and blanks as the model shows them; null and empty texts stay empty."""
    return BLANK + text.replace(" ", BLANK) if text else ""


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, edges``: of distinct ``words(word)``, the substrings that are pieces, each a long of rank, end, size and id.

    Substrings up to the longest piece's length are exploded and joined to the
    piece table by equality; ``rank`` orders pieces by falling score. Single
    characters stay even if they are no pieces, as NO_PIECE. The words are dealt
    out once, by word; the join's other side is the vocabulary, whose size the model
    fixes, so that grouping the edges by word needs no second exchange.
    """
    if pieces.longest >= 1 << SIZE or len(pieces.text) >= NO_PIECE:
        raise ValueError("too long pieces, or too many")
    spark = words.sparkSession
    ranks = {s: i for i, s in enumerate(sorted({s for _, _, s in pieces.normal}, reverse=True))}
    coded = [(ranks[s] << END + SIZE + ID) + i for _, i, s in pieces.normal]
    # from Arrow, as a list of rows would start Python workers of another kind beside those of the other steps
    vocab = F.broadcast(spark.createDataFrame(pa.table({"piece": pa.array([p for p, _, _ in pieces.normal], pa.string()), "coded": pa.array(coded, pa.int64())})))
    n = F.length("word")
    count = max(words.count() // 20_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = words.select("word").repartition(count, "word")
    starts = dealt.select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
    spans = starts.select("word", "s", F.explode(F.sequence(F.col("s") + 1, F.least(n, F.col("s") + pieces.longest))).alias("e"))
    size = F.col("e") - F.col("s")
    edges = spans.withColumn("piece", F.substr("word", F.col("s") + 1, size)).join(vocab, "piece", "left").where("coded IS NOT NULL OR e = s + 1")
    place = F.shiftleft(F.col("e").cast("long"), SIZE + ID) + F.shiftleft(size.cast("long"), ID)
    edge = F.coalesce("coded", F.lit((((1 << RANK) - 1) << END + SIZE + ID) + NO_PIECE)) + place
    return edges.groupBy("word").agg(F.collect_list(edge).alias("edges"))


def _field(edge: Column, below: int, bits: int) -> Column:
    return F.shiftright(edge, below).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _end(edge: Column) -> Column:
    return _field(edge, SIZE + ID, END)


def _size(edge: Column) -> Column:
    return _field(edge, ID, SIZE)


def _id(edge: Column) -> Column:
    return _field(edge, 0, ID)


def fold_viterbi(edges: DataFrame, pieces: Pieces, penalty: float = -1e6) -> DataFrame:
    """``word, path``: the best sum of scores over paths through ``lattice``'s edges, as parts ``struct<e, size, id>``.

    A higher-order aggregate goes over the edges in order of their ends and keeps
    the best score, and the path, to each place: the segmentation of unigram models.
    A character that is no piece costs ``penalty``.
    """
    at0 = F.struct(F.lit(0.0).alias("v"), F.array().cast("array<struct<e:int,size:int,id:int>>").alias("p"))
    by_rank = F.array(*(F.lit(float(s)) for s in sorted({s for _, _, s in pieces.normal}, reverse=True)))
    rank = lambda x: F.shiftright(x, END + SIZE + ID).cast("int")
    score = lambda x: F.when(_id(x) == NO_PIECE, penalty).otherwise(F.element_at(by_rank, F.least(rank(x), F.size(by_rank) - 1) + 1))
    ordered = F.array_sort(F.transform("edges", lambda x: F.struct(_end(x).alias("e"), _size(x).alias("size"), _id(x).alias("id"), score(x).alias("score"))))

    def step(best, x):
        # best holds the places so far; each end's first edge appends, later ones replace
        come = F.element_at(best, x["e"] - x["size"] + 1)
        part = F.struct(x["e"].alias("e"), x["size"].alias("size"), x["id"].alias("id"))
        new = F.struct((come["v"] + x["score"]).alias("v"), F.concat(come["p"], F.array(part)).alias("p"))
        old = F.element_at(best, -1)
        better = F.when(new["v"] > old["v"], new).otherwise(old)
        fresh = F.size(best) == x["e"]
        return F.when(fresh, F.concat(best, F.array(new))).otherwise(F.concat(F.slice(best, 1, F.size(best) - 1), F.array(better)))

    return edges.select("word", F.aggregate(ordered, F.array(at0), step, lambda best: F.element_at(best, -1)["p"]).alias("path"))


def fold_merges(edges: DataFrame) -> DataFrame:
    """``word, path`` of BPE models, as parts ``struct<e, size, id>``: a higher-order aggregate over the edges, best score first, of equals the one that ends first.

    The state has a mark for each place between characters that is still a boundary:
    the bits of a long, or the bytes of a binary for words of more than 60
    characters. An edge whose ends are boundaries, with a single one between them,
    is the union of two neighbouring parts: that one goes. A piece's parts score
    better than it does (``check_order``), so that one pass makes the same merges as
    choosing the best union again and again, for words of any length.
    """
    one = F.lit(1).cast("long")
    left, right = (lambda v, n, f=f: F.call_function(f, v, n) for f in ("shiftleft", "shiftright"))
    begin = lambda x: _end(x) - _size(x)

    def holds(marks, x, inside: int):
        """Whether the edge's ends are marked, and so many places between them."""
        ends = (right(marks, begin(x)).bitwiseAND(one) == 1) & (right(marks, _end(x)).bitwiseAND(one) == 1)
        return ends & (F.bit_count(right(marks, begin(x)).bitwiseAND(left(one, _size(x)) - 1)) == inside + 1)

    def step(marks, x):
        between = left(left(one, _size(x)) - 2, begin(x))
        return F.when(holds(marks, x, 1), marks.bitwiseAND(F.bitwise_not(between))).otherwise(marks)

    def holds_long(marks, x, inside: int):
        part = F.substring(marks, begin(x) + 1, _size(x) + 1).cast("string")
        return part.rlike("^10*10*1$" if inside else "^10*1$")

    def step_long(marks, x):
        merged = F.rpad(F.lit("1"), _size(x), F.lit("0")).cast("binary")
        return F.when(holds_long(marks, x, 1), F.overlay(marks, merged, begin(x) + 1)).otherwise(marks)

    def parts(marks, check):
        by_end = F.transform(F.filter("edges", lambda x: check(marks, x, 0)), lambda x: x.bitwiseAND(F.lit((1 << END + SIZE + ID) - 1)))
        return F.transform(F.sort_array(by_end), lambda x: F.struct(_end(x).alias("e"), _size(x).alias("size"), _id(x).alias("id")))

    n = F.length("word")
    ordered = edges.select("word", F.sort_array("edges").alias("edges"))
    short = F.aggregate("edges", left(one, n + 1) - 1, step, lambda marks: parts(marks, holds))
    long = F.aggregate("edges", F.repeat(F.lit("1"), n + 1).cast("binary"), step_long, lambda marks: parts(marks, holds_long))
    return ordered.select("word", F.when(n <= 60, short).otherwise(long).alias("path"))


def encode_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, ids`` of distinct ``words(word)`` of normalised text; characters without a piece become the pieces of their UTF-8 bytes."""
    edges = lattice(words, pieces)
    path = fold_merges(edges) if pieces.merges else fold_viterbi(edges, pieces)
    fallback = F.array(*(F.lit(b) for b in pieces.bytes))

    def utf8(part):
        hexed = F.hex(F.encode(F.substr(F.col("word"), part["e"], F.lit(1)), "UTF-8"))
        at = F.sequence(F.lit(1), F.length(hexed), F.lit(2))
        return F.transform(at, lambda i: F.element_at(fallback, F.conv(F.substr(hexed, i, F.lit(2)), 16, 10).cast("int") + 1))

    spelt = F.flatten(F.transform("path", lambda p: F.when(p["id"] == NO_PIECE, utf8(p)).otherwise(F.array(p["id"]))))
    ids = F.when(F.exists("path", lambda p: p["id"] == NO_PIECE), spelt).otherwise(F.transform("path", lambda p: p["id"]))
    return path.select("word", ids.alias("ids"))


#: A text's units that aren't in every task, in the order in which they first occur: the number of ids of each, the ids one after the other.
_TAIL = ("__sizes", "__ids")
#: Texts are told apart by these two hashes, 96 bits.
_KEY = ("__key", "__crc")


class Cutter:
    """Texts to words, and words to units that no piece goes beyond.

    A word stands without the blank that begins it; one that begins with a zero
    character stands for a line end and what follows it without a blank. Texts with
    runs of blanks, or with these two characters, give words with all their blanks.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pattern = regex.compile(pieces.unit, regex.DOTALL).findall
        self.blanks = regex.compile(f"{BLANK}+[^{BLANK}]*").findall
        beside = {c for p, _, _ in pieces.normal for a, b in pairwise(p) if a.isalpha() != b.isalpha() for c in (a, b)}
        #: Marks that no piece has beside a letter.
        self.marks = "".join(c for c in ".,;:!?$%&#*()\"'" if c not in beside)
        #: Characters that some piece has side by side; a unit may be cut between any others.
        self.pairs = {a + b for p, _, _ in pieces.normal for a, b in pairwise(p)}
        #: Whether no piece has a line end beside another character.
        self.lines = not any("\n" in p and len(p) > 1 for p, _, _ in pieces.normal)

    def _line(self, text: str | None) -> str | None:
        """The text's words, a blank between two; none for a text without words."""
        if not text:
            return None
        if text[0] == " " or text[-1] == " " or "  " in text or BLANK in text or "\0" in text:
            return " ".join(self.blanks(normalize(text)))
        return text.replace("\n", " \0") if self.lines else text

    def words(self, text: str | None) -> list[str]:
        line = self._line(text)
        return [] if line is None else line.split(" ")

    def split(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct words of the texts; the number of the word at each place, text after text; where each text begins, and the last ends.

        Arrow tells the words apart, so that Python looks at each distinct one only.
        """
        lists = pc.split_pattern(pa.array(list(map(self._line, texts)), pa.string()), " ")
        coded = lists.values.dictionary_encode()
        return coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64), np.asarray(lists.offsets).astype(np.int64)

    def units(self, word: str) -> list[str]:
        """A word of letters is one unit, and so are the marks after it; others go by the pattern. Long units are cut where no piece goes on."""
        own = self._units(word)
        return own if len(word) < LONG else [part for u in own for part in self._parts(u)]

    def _parts(self, unit: str) -> list[str]:
        cuts = [0, *(i for i, (a, b) in enumerate(pairwise(unit), 1) if a + b not in self.pairs), len(unit)] if len(unit) >= LONG else [0, len(unit)]
        parts = [unit[a:b] for a, b in pairwise(cuts)]
        if any(len(p) >= 1 << END for p in parts):
            raise ValueError(f"more than {(1 << END) - 1} characters that pieces join without a break")
        return parts

    def _units(self, word: str) -> list[str]:
        first = word[:1]
        if first == "\0":
            return ["\n", *self._cut("", word[1:])]
        return self.pattern(word) if first == BLANK else self._cut(BLANK, word)

    def _cut(self, lead: str, word: str) -> list[str]:
        if word.isalpha():
            return [lead + word]
        letters = word.rstrip(self.marks)
        if letters.isalpha():
            return [lead + letters, word[len(letters) :]]
        return self.pattern(lead + word)


def vocabulary_of(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, n``: distinct units of all texts, with their number of occurrences. A task sends a unit once for many texts; Spark sums before it shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Cutter(pieces)
        units: Counter[str] = Counter()
        for batch in batches:
            for part in _blocks(batch, 0, BLOCK):
                words, places, _ = cut.split(part.column(0).to_pylist())
                for w, n in zip(words, np.bincount(places, minlength=len(words)).tolist(), strict=True):
                    for u in cut.units(w):
                        units[u] += n
                if len(units) > HELD:
                    yield _counts(units)
        yield _counts(units)

    def _counts(units: Counter[str]) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(units), pa.string()), pa.array(list(units.values()), pa.int64())], names=["word", "n"])
        units.clear()
        return out

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _blocks(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows, whose texts in ``column`` have about ``most`` bytes or are a single one."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)), dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _rare(units: list[list[str]], places: np.ndarray, at: np.ndarray, known: dict[str, bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of ``Cutter.split``'s texts, the units that aren't ``known``; and each text with each such unit of it, by text and first occurrence, as two columns of numbers.

    ``units`` are those of the distinct words.
    """
    names: dict[str, int] = {}
    flat, sizes = [], []
    for own in units:
        before = len(flat)
        for u in own:
            if u not in known:
                flat.append(names.setdefault(u, len(names)))
        sizes.append(len(flat) - before)
    size = np.array(sizes, np.int64)
    where = np.flatnonzero(size[places]) if len(places) else places
    word, n = places[where], size[places[where]] if len(places) else places
    spans = np.repeat((np.cumsum(size) - size)[word] - (np.cumsum(n) - n), n) + np.arange(n.sum()) if len(word) else word
    unit, text = np.array(flat, np.int64)[spans], np.repeat(np.searchsorted(at, where, "right") - 1, n)
    first = np.sort(np.unique(text * len(names) + unit, return_index=True)[1])
    return list(names), text[first], unit[first]


def _slices(flat: pa.Array, offsets: pa.Array) -> list[bytes]:
    """The lists of an integer column as bytes."""
    raw, at = np.asarray(flat, np.int32).tobytes(), (4 * (np.asarray(offsets) - offsets[0].as_py())).tolist()
    return [raw[a:b] for a, b in pairwise(at)]


def _codes(words: pa.Array, ids: pa.ListArray) -> dict[str, bytes]:
    return dict(zip(words.to_pylist(), _slices(ids.flatten(), ids.offsets), strict=True))


def encode(docs: DataFrame, pieces: Pieces, frequent: int = FREQUENT, text: bool = True, rows: int = 2000) -> DataFrame:
    """``docs`` with ``ids`` (array of int) for ``text``, or in place of it; an ``ids`` column of its own is replaced.

    Null and empty texts have no ids. Every distinct unit is encoded once, through
    the lattice. Frequent units, ``frequent`` at most, go to every task; the others
    are joined to their codes by unit, come together as one row per distinct text,
    and meet the texts in a plain join that adaptive execution can split where
    copies of one text are many. Rows may share a doc_id or lack one. The staged
    steps hand Python ``rows`` texts at a time; the last one goes by the session.
    """

    def emit(texts: list[str | None], flat: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
        return [pa.array(texts, pa.string()), ids] if text else [ids]

    made = _assemble(docs, pieces, frequent, "text string, ids array<int>" if text else "ids array<int>", emit, rows)
    return made.select(*(c for c in docs.columns if c != "ids" and (text or c != "text")), "ids")


def _assemble(docs: DataFrame, pieces: Pieces, frequent: int, fields: str, emit, rows: int = 2000) -> DataFrame:
    """The columns of ``docs`` but text and ids, and ``fields`` that ``emit`` makes of some texts, all their ids one after the other, and where each text's begin."""
    spark = docs.sparkSession
    # a word's edges come one after the other: they are gathered in memory, without a sort
    together = {"spark__sql__objectHashAggregate__sortBased__fallbackThreshold": "100000"}
    some = docs.select("text").sample(min(1.0, SAMPLE / max(1, docs.count())), seed=1)
    words = stage(vocabulary_of(some, pieces), "words", rows)
    with settings(spark, **together):
        top = pa.Table.combine_chunks(encode_words(most_frequent(words, frequent), pieces).toArrow())
    unstage(words)
    hot = spark.sparkContext.broadcast({k: v for b in top.to_batches() for k, v in _codes(b.column(0), b.column(1)).items()})

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cut = hot.value, Cutter(pieces)
        seen: set[tuple[int, int]] = set()  # copies of one text that meet in a task
        for batch in batches:
            for part in _blocks(batch, 2, BLOCK):
                own = {}
                for row, key in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    if key not in seen:
                        seen.add(key)
                        own[row] = key
                part = part.take(pa.array(list(own), pa.int64()))
                words, places, at = cut.split(part.column(2).to_pylist())
                names, text, unit = _rare([cut.units(w) for w in words], places, at, known)
                columns = [part.column(0).take(pa.array(text)), part.column(1).take(pa.array(text))]
                columns.append(pa.array((np.arange(len(text)) - np.searchsorted(text, text)).astype(np.int32)))
                columns.append(pa.array(names, pa.string()).take(pa.array(unit)))
                yield pa.record_batch(columns, names=[*_KEY, "at", "word"])
                if len(seen) > HELD:
                    seen.clear()

    keep = [c for c in docs.columns if c not in ("ids", "text")]
    keyed = docs.select(*keep, "text", F.xxhash64("text").alias("__key"), (F.crc32(F.col("text").cast("binary")) - (1 << 31)).cast("int").alias("__crc"))
    wanted = stage(keyed.select(*_KEY, "text").mapInArrow(rare, "__key long, __crc int, at int, word string"), "wanted", rows, compression="zstd")
    with settings(spark, **together):
        codes = stage(encode_words(stage(wanted.select("word").distinct(), "words"), pieces), "codes")
    # joined and gathered in two steps, so that the shuffle files of one are gone when the other makes its own
    coded = stage(wanted.join(codes, "word").select(*_KEY, "at", "ids"), "coded", compression="zstd")
    unstage(wanted, codes)
    tail = coded.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.struct("at", "ids"))).alias("t"))
    columns = (F.transform("t", lambda x: F.size(x["ids"])), F.flatten(F.transform("t", lambda x: x["ids"])))
    by_text = stage(tail.select(*_KEY, *(c.alias(n) for c, n in zip(columns, _TAIL, strict=True))), "tails", compression="zstd")
    unstage(coded)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack_one = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack_one(t.as_py().encode("utf-8", "surrogatepass")) if t.is_valid else None for t in batch.column(len(keep))]
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(packed, pa.binary()), *batch.columns[len(keep) + 1 :]], names=[*keep, "__packed", *_KEY])

    names_out = [*keep, *T.StructType.fromDDL(fields).names]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        known, cut = hot.value, Cutter(pieces)
        for batch in batches:
            for part in _blocks(batch, len(keep) + 2, PACKED_BLOCK):
                sizes, ids, packed = part.columns[len(keep) :]
                texts = [unpack(p.as_py()).decode("utf-8", "surrogatepass") if p.is_valid else None for p in packed]
                words, places, at = cut.split(texts)
                units = [cut.units(w) for w in words]
                names, text, unit = _rare(units, places, at, known)
                # a text's rare units and its codes are in the same order; a unit's code is that of any text that has it
                n = np.asarray(pc.fill_null(pc.list_value_length(sizes), 0))
                if not np.array_equal(np.bincount(text, minlength=len(texts)), n):
                    raise ValueError("two texts share their hashes")
                raw, ends = np.asarray(ids.flatten(), np.int32).tobytes(), 4 * np.cumsum(np.asarray(sizes.flatten(), np.int64))
                where = np.unique(unit, return_index=True)[1]
                spans = zip(np.append(0, ends)[where].tolist(), ends[where].tolist(), strict=True)
                own = dict(zip(names, (raw[a:b] for a, b in spans), strict=True))
                codes = [b"".join([known[u] if u in known else own[u] for u in us]) for us in units]
                flat, offsets = lay_out(codes, places, at)
                yield pa.record_batch([*part.columns[: len(keep)], *emit(texts, flat.view(np.int32), offsets)], names=names_out)

    own = docs.select(*keep).schema.fields
    packed = keyed.mapInArrow(pack, T.StructType([*own, T.StructField("__packed", T.BinaryType()), T.StructField("__key", T.LongType()), T.StructField("__crc", T.IntegerType())]))
    joined = packed.join(by_text, list(_KEY), "left").select(*keep, *_TAIL, "__packed")
    return joined.mapInArrow(join, T.StructType([*own, *T.StructType.fromDDL(fields).fields]))


def _spelt(pieces: Pieces) -> list[bytes]:
    """The bytes that each id stands for: pieces with blanks, byte pieces as they are."""
    byte_of = {i: b for b, i in enumerate(pieces.bytes)}
    return [bytes([byte_of[i]]) if i in byte_of else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces.text)]


def _decoder(pieces: Pieces) -> Callable[[list[int]], bytes]:
    """Function of a list of ids to its text's bytes, without the leading blank."""
    raw = _spelt(pieces)
    return lambda ids: b"".join(map(raw.__getitem__, ids))[1:]


def decode(coded: DataFrame, pieces: Pieces) -> DataFrame:
    """``coded`` with ``decoded``: the text of ``ids``; null ids give an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = _decoder(pieces)
        for batch in batches:
            where = batch.schema.get_field_index("ids")
            out = [text_of(np.asarray(ids.values).tolist() if ids.is_valid else []).decode("utf-8", "replace") for ids in batch.column(where)]
            yield pa.record_batch([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])

    rest = coded.drop("decoded")
    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("decoded", T.StringType())]))


def digest(docs: DataFrame, pieces: Pieces, frequent: int = FREQUENT) -> DataFrame:
    """``docs`` without text, and ``n_ids, ids_sha256, round_trip``: the SHA-256 of the ids as little-endian 32-bit integers, and whether decoding gives the text back."""
    spelt = None

    def emit(texts: list[str | None], flat: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        nonlocal spelt
        spelt = spelt or pa.array(_spelt(pieces), pa.binary())
        ids, raw = memoryview(flat.tobytes()), spelt.take(pa.array(flat))
        spans = list(pairwise(np.append(0, np.cumsum(np.asarray(pc.binary_length(raw)), dtype=np.int64))[offsets].tolist()))
        whole = raw.buffers()[2].to_pybytes() if len(raw) else b""
        same = [whole[a:b][1:] == (t or "").encode("utf-8", "surrogatepass") for t, (a, b) in zip(texts, spans, strict=True)]
        digests = [hashlib.sha256(ids[4 * a : 4 * b]).hexdigest() for a, b in pairwise(offsets.tolist())]
        return [pa.array(np.diff(offsets)), pa.array(digests, pa.string()), pa.array(same, pa.bool_())]

    return _assemble(docs, pieces, frequent, "n_ids long, ids_sha256 string, round_trip boolean", emit)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_model(model_path())
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return digest(docs, pieces)


QUERIES = {"op10_sentencepiece": op10_sentencepiece}
ORACLE_SQL: dict[str, str] = {}
