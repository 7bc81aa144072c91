"""Token-ID output (operator 7): documents encoded once into Parquet list columns, in document order, for selective reads."""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lay_out, stage, table

END = 2
#: Parts whose ids a process keeps; they go when it has so many, so that its memory is bounded.
CACHE = 400_000
#: Writer settings: small row groups and pages with column indexes let a reader fetch a few documents' ids; ids are
#: delta-encoded (format v2 without a dictionary), lang and source dictionary-encoded.
LAYOUT = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#ids.list.element": "false",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#place": "false",
}
#: How byte-level BPE splits a text (fixed value of the vocabulary file).
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters on whose classes all Unicode versions agree; texts with others go whole to the tokenizer.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u024f]")
#: Begins a part that has no blank before it; no text that is cut into parts holds it.
NO_BLANK = "\x01"
#: Where texts are cut besides blanks: between a letter and marks, and after a single line end.
CUTS = ((r"(\pL)([.,;:!?]+)", rf"\1 {NO_BLANK}\2"), (r"([^\t\n\r ])\n(\pL)", f"\\1\n {NO_BLANK}\\2"))


class _Memo(dict):
    """Values of ``make``, of ``CACHE`` keys at most and those of the last call."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def all(self, keys: list[str]) -> list[bytes]:
        """The values of distinct ``keys``."""
        found = list(map(self.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        for i in new:
            found[i] = self.make(keys[i])
        if len(self) + len(new) > CACHE:
            self.clear()
            self.update(zip(keys, found, strict=True))
        else:
            self.update((keys[i], found[i]) for i in new)
        return found


class PieceEncoder:
    """Encodes whole texts with the tokenizers library; parts that came before in the process aren't encoded again.

    The vocabulary's splitting never lets a merge cross a piece. A blank between two
    other characters always begins a piece, and so do a mark after a letter and a
    letter after a single line end, so the ids of a text are those of its parts cut
    at these places. Texts that hold an added token's string, runs of blanks, or
    characters outside the common ones, go whole to the library.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        split = json.loads(self.tokenizer.to_str())
        pre = split.get("pre_tokenizer") or {}
        #: Whether the file splits texts as SPLIT does and changes nothing before; otherwise all texts go whole to the library.
        self.splits = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not split.get("normalizer")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}  # byte-level BPE shows these bytes as they are, the others from 256 on
        rest = iter(range(256, 512))
        self.alphabet = {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}
        self.bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        model = self.tokenizer.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # parts come once each: the library's own cache would only be filled
        self.tokenize = model.tokenize
        self.parts = _Memo(self._part)

    def _known(self, shown: str) -> bytes:
        return b"".join([self.bytes[t.id] for t in self.tokenize(shown)])

    def _shown(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.alphabet)

    def _pieces(self, text: str) -> bytes:
        return b"".join([self._known(self._shown(p)) for p in SPLIT.findall(text)])

    def _part(self, part: str) -> bytes:
        """Ids of a part with the blank before it, or without one after NO_BLANK; most are a word, which is one piece."""
        if part.isalpha():
            return self._known("\u0120" + (part if part.isascii() else self._shown(part)))
        return self._pieces(part[1:] if part[:1] == NO_BLANK else " " + part)

    def _whole(self, text: str) -> bool:
        return not self.splits or "  " in text or text[-1:] == " " or any(a in text for a in self.added) or _OTHER.search(text) is not None

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, END after each, and the offsets of the texts in them.

        Parts are told apart by Arrow for all texts at once, so that each distinct one
        is looked up once; numpy lays out their ids in the order of the texts.
        """
        whole = {i: t for i, t in enumerate(texts) if self._whole(t)}
        marked = pa.array([NO_BLANK if i in whole else NO_BLANK + t for i, t in enumerate(texts)], pa.string())
        for pattern, cut in CUTS:
            marked = pc.replace_substring_regex(marked, pattern, cut)
        lists = pc.split_pattern(marked, " ")
        at = np.asarray(lists.offsets)
        coded = lists.values.dictionary_encode()
        known = self.parts.all(coded.dictionary.to_pylist())
        order = np.full(at[-1] + len(texts), len(known), np.int64)
        known.append(np.array([END], "<u4").tobytes())
        number = np.arange(len(texts))
        order[np.arange(at[-1]) + np.repeat(number, np.diff(at))] = coded.indices.to_numpy()
        for i, text in whole.items():
            order[at[i] + i] = len(known)
            known.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
        return lay_out(known, order, np.append(at[:-1] + number, len(order)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, offsets = self.encode_flat(texts)
        return [flat[a:b] for a, b in pairwise(offsets.tolist())]


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> PieceEncoder:
    """One for each worker process, whatever number of tasks it runs."""
    return PieceEncoder(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``ids`` (array of int, END last) for ``text``; other columns stay. Null texts count as empty."""
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    schema = docs.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            begin = 0
            while begin < len(texts):  # a few megabytes of text at a time, whatever the rows' lengths
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) < 8_000_000):
                    size += len(texts[end])
                    end += 1
                flat, offsets = coder.encode_flat(texts[begin:end])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(np.int32)))
                part = batch.slice(begin, end - begin)
                yield pa.record_batch([*part.columns[: len(keep)], ids], names=[*keep, "ids"])
                begin = end

    return docs.select(*keep, "text").mapInArrow(run, schema)


def write_token_files(docs: DataFrame, path: str, columns: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Encode ``docs``, write token files in ascending doc_id order, and return them as read back: ``doc_id, place, n_tokens, columns, ids``.

    Files hold disjoint ranges of doc_id and are sorted within; their row groups'
    and pages' statistics on doc_id let a reader skip. Rows of equal doc_id are
    ordered by text, and ``place`` keeps each row's place in its file. ``path`` is
    the tokenizer's file; workers open it.
    """
    keep = [c for c in columns if c in docs.columns]
    narrow = docs.select(F.col("doc_id").cast("long"), *keep, "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = narrow.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    coded = encode(sorted_, path)
    return stage(coded.select("doc_id", F.monotonically_increasing_id().alias("place"), F.size("ids").cast("long").alias("n_tokens"), *keep, "ids"), "tokens", **LAYOUT)


def read_tokens(files: DataFrame, lo: int, hi: int) -> DataFrame:
    """``doc_id, ids`` of the documents within ``[lo, hi]``: the range reaches the scan, and no other column is read."""
    return files.where(F.col("doc_id").between(lo, hi)).select("doc_id", "ids")


def digest(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files; start counts the ids of all documents before it.

    Sums run within a file first; the files' own totals, a row each, are summed in
    the order of their first doc_id.
    """
    named = files.select("doc_id", "n_tokens", "ids", F.input_file_name().alias("file"), "place")
    totals = named.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min("doc_id").alias("first"))
    before = Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = np.array(batch.column(2).offsets)
            flat = np.asarray(batch.column(2).values).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.record_batch([*batch.columns[:2], *batch.columns[3:], pa.array(crc, pa.int64())], names=["doc_id", "n_tokens", "file", "place", "ids_crc32"])

    rows = named.mapInArrow(run, "doc_id long, n_tokens long, file string, place long, ids_crc32 long")
    within = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("own", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return own.join(base, "file").select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {"op7_token_files": op7_token_files}
ORACLE_SQL: dict[str, str] = {}
