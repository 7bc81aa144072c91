"""Language identification (operator 5): averaged hashed subword embeddings with a linear softmax, fitted by SGD in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Labelled documents of each language, at most about, that the model is fitted on and calibrated with.
FIT_PER_LANGUAGE = 600
#: Subwords of one fitted document that count, drawn from its whole text.
FIT_SUBWORDS = 1500
#: Documents drawn in all, whatever the number of languages (expected; repeated rows count once).
FIT_DOCUMENTS = 20_000
BUCKETS, WIDTH, EPOCHS, RATE, BATCH = 1 << 16, 16, 6, 2.0, 16
#: Few samples are gone through more often, for so many steps in all.
MIN_STEPS = 400
SIZES = (1, 2, 3, 4)
#: Languages up to this number are broadcast, with two short columns each.
BROADCAST_LANGUAGES = 10_000
UNKNOWN = "und"
#: Share of correct calibration documents that may be rejected at most.
REJECT = 0.01
_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint32(0x9E3779B1)


def subwords(text: str) -> np.ndarray:
    """Bucket of each character sequence of 1 to 4 within a whole text, letters lower-cased, every other run of characters one blank."""
    flat = "_" + regex.sub(r"[^\p{L}\p{M}]+", "_", text.lower()) + "_"
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], np.zeros(len(codes), np.uint32)
    for n in range(max(SIZES)):
        h = h[: max(0, len(codes) - n)] * _MIX + codes[n:]
        if n + 1 in SIZES and len(h):
            mixed = h ^ (h >> np.uint32(15))
            mixed = mixed * np.uint32(0x85EBCA6B) + np.uint32(n)
            out.append((mixed >> np.uint32(16)) & np.uint32(BUCKETS - 1))
    return np.concatenate(out)


@dataclass(frozen=True)
class LanguageModel:
    """``table`` is the embeddings times the softmax weights, so a text's logits are the mean of its subwords' rows."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, text: str) -> np.ndarray:
        total, ids = np.zeros(len(self.languages)), subwords(text)
        for at in range(0, len(ids), 1 << 16):
            total += self.table[ids[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total / len(ids) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether that reaches the threshold; ``und`` for null and for texts without a letter."""
        if not self.languages or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        p = _softmax(self.logits(text)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list[tuple[str, np.ndarray]], seed: int = 5) -> LanguageModel:
    """Fit on four fifths of ``(language, subword buckets)``; the rest set the temperature and the rejection threshold."""
    languages = tuple(sorted({lang for lang, _ in samples}))
    if not languages:
        return LanguageModel((), np.zeros((1, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    samples = [samples[i] for i in rng.permutation(len(samples))]
    held, used = samples[::5], [s for i, s in enumerate(samples) if i % 5] or samples
    code = {lang: i for i, lang in enumerate(languages)}
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // len(used)))
    for epoch in range(epochs):
        order, rate = rng.permutation(len(used)), RATE * (1 - epoch / epochs)
        for at in range(0, len(order), BATCH):
            batch = [used[i] for i in order[at : at + BATCH]]
            ids = np.concatenate([x for _, x in batch])
            size = np.array([len(x) for _, x in batch])
            mean = np.add.reduceat(embed[ids], np.cumsum(size) - size, axis=0) / size[:, None]
            p = _softmax(mean @ weight + bias)
            p[np.arange(len(batch)), [code[lang] for lang, _ in batch]] -= 1
            p /= len(batch)
            back = (p @ weight.T) / size[:, None]
            weight -= rate * (mean.T @ p).astype(np.float32)
            bias -= rate * p.sum(axis=0).astype(np.float32)
            np.subtract.at(embed, ids, (rate * WIDTH * np.repeat(back, size, axis=0)).astype(np.float32))
    model = LanguageModel(languages, embed @ weight, bias, 1.0, 0.0)
    z = np.array([model.table[x].mean(axis=0) + bias for _, x in held], float)
    y = np.array([code[lang] for lang, _ in held])
    grid = np.exp(np.linspace(-4, 2, 49))
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    return LanguageModel(languages, model.table, bias, temperature, float(np.quantile(right, REJECT)) if len(right) else 0.0)


def train(docs: DataFrame, per_language: int = FIT_PER_LANGUAGE) -> LanguageModel:
    """Fit on ``docs(doc_id, text, lang)``: rows without a language or a letter don't count.

    Of each language about ``per_language`` documents are drawn by the hash of id
    and text, at a rate that follows from its count, and about FIT_DOCUMENTS in all;
    rows that repeat count once. Executors turn each into at most FIT_SUBWORDS buckets,
    drawn from its whole text; only those reach the driver.
    """
    known = docs.where("lang is not null and text is not null")
    rates = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(per_language)) / F.count("*")).alias("rate"))
    languages = rates.count()
    if languages <= BROADCAST_LANGUAGES:  # else the join deals the texts out by language
        rates = F.broadcast(rates)
    share = min(1.0, FIT_DOCUMENTS / max(1, languages * per_language))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    picked = known.select("doc_id", "lang", "text").join(rates, "lang").where(draw < F.col("rate") * share)
    picked = picked.select("doc_id", "lang", "text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids = [], []
            for key, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if _LETTER.search(text):
                    own = subwords(text)
                    if len(own) > FIT_SUBWORDS:
                        own = np.random.default_rng(key & 0xFFFFFFFF).choice(own, FIT_SUBWORDS, replace=False)
                    langs.append(lang)
                    ids.append(own.astype(np.uint32).tobytes())
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(ids, pa.binary())], names=["lang", "ids"])

    rows = picked.select(F.xxhash64("doc_id").alias("k"), "lang", "text").mapInArrow(run, "lang string, ids binary").collect()
    return fit([(lang, np.frombuffer(ids, np.uint32)) for lang, ids in sorted((r.lang, bytes(r.ids)) for r in rows)])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` for each row, from the text alone.

    Null texts and texts without a letter give ``und`` with score 0. ``accepted`` is
    false there, and where the calibrated probability is below the threshold that
    rejects few right answers. Without training rows every text is ``und``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            cols = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.record_batch([batch.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())], names=["doc_id", "lang_pred", "score", "accepted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")


def held_out(doc_id):
    """Column: true for the documents that the query's model must not learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


QUERIES = {"op5_language_id": op5_language_id}
ORACLE_SQL: dict[str, str] = {}
