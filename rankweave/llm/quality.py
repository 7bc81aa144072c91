"""Quality rules (operator 9): counts of a text, and a linear-chain CRF that marks its lines content or boilerplate."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

SYMBOLS = "#*$%&|<>"
#: Labelled documents of each class that the CRF is fitted on, those of lowest hash; and lines of each at most, a block of
#: them from a place that depends on the text.
FIT_DOCUMENTS, FIT_LINES = 1000, 400
#: A document is kept if content lines hold at least this share of its words' characters.
CONTENT_SHARE = 0.5
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
_UPPER, _LETTERS, _DIGITS = (bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)]), bytes(range(48, 58)))
_MARKS = SYMBOLS.encode()
FEATURES = ("bias", "symbols", "capitals", "digits", "bars", "shouts", "short", "repeated")
CONTENT, BOILERPLATE = 0, 1


def line_features(lines: list[str]) -> np.ndarray:
    """A row of FEATURES, each within 0 to 1, for each line."""
    out = np.zeros((len(lines), len(FEATURES)))
    seen: set[str] = set()
    for row, line in zip(out, lines, strict=True):
        raw = line.encode()
        parts = raw.split()
        n = max(1, len(parts))
        size = len(raw)
        letters = size - len(raw.translate(None, _LETTERS))
        row[0] = 1
        row[1] = min(1, (size - len(raw.translate(None, _MARKS))) / n)
        row[2] = (size - len(raw.translate(None, _UPPER))) / max(1, letters)
        row[3] = (size - len(raw.translate(None, _DIGITS))) / size
        row[4] = min(1, 2 * raw.count(b"|") / n)
        row[5] = min(1, raw.count(b"!") / n)
        row[6] = len(parts) < 4
        row[7] = line in seen
        seen.add(line)
    return out


def line_labels(features: np.ndarray, good: bool) -> np.ndarray:
    """Weak labels of a document's lines: those with many marks, shouts or capitals, or that came before, are boilerplate, others content.

    The document's own label is the prior: where none of a bad document's lines
    stands out, all are boilerplate.
    """
    name = {n: i for i, n in enumerate(FEATURES)}
    x = features
    stands_out = (x[:, name["symbols"]] > 0.3) | (x[:, name["bars"]] > 0.2) | (x[:, name["shouts"]] > 0.3) | (x[:, name["capitals"]] > 0.5) | (x[:, name["repeated"]] > 0)
    if not good and not stands_out.any():
        return np.full(len(x), BOILERPLATE, np.int8)
    return stands_out.astype(np.int8)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of consecutive words that occur twice or more, the first occurrence included; exact."""
    if len(ids) < window:
        return 0
    names, width = ids, 1
    while width < window:  # names of twice the width, by pairs of names: no hash that could collide
        step = min(width, window - width)
        pair = names[:-step] * np.int64(len(ids) + 1) + names[step:]
        names, width = np.unique(pair, return_inverse=True)[1].astype(np.int64), width + step
    twice = np.bincount(names)[names] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; null counts as empty."""
    text = text or ""
    parts = text.encode().split()
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in parts), np.int64, len(parts))
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    seen: set[str] = set()
    dups = 0
    for line in text.split("\n"):
        if line in seen:
            dups += 1
        elif line.encode().split():
            seen.add(line)
    return len(parts), len(text) - spaces, sum(map(text.count, SYMBOLS)), dups, repeated_words(ids)


def base_fails(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


@dataclass(frozen=True)
class LineCrf:
    """Emission weights (features x 2 labels), transition scores (2 x 2) and start scores of a linear-chain CRF."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """Viterbi: the best label sequence; ties go to content."""
        scores = features @ self.emit
        back = np.zeros(scores.shape, np.int8)
        (m00, m01), (m10, m11) = self.move.tolist()
        rows = scores.tolist()
        c, b = rows[0][0] + self.start[0], rows[0][1] + self.start[1]
        for t in range(1, len(rows)):
            cc, bc, cb, bb = c + m00, b + m10, c + m01, b + m11
            back[t] = (bc > cc, bb > cb)
            c, b = max(cc, bc) + rows[t][0], max(cb, bb) + rows[t][1]
        at = int(b > c)
        out = np.empty(len(rows), np.int8)
        for t in range(len(rows) - 1, -1, -1):
            out[t] = at
            at = back[t, at]
        return out


def neutral_crf() -> LineCrf:
    """Marks every line content; used where there are no labelled documents of both classes."""
    return LineCrf(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.array([1.0, 0.0]))


def fit_crf(sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, rate: float = 0.2, decay: float = 1e-3, seed: int = 1) -> LineCrf:
    """Maximum likelihood by stochastic gradients, from the features and the labels of each sequence's lines.

    Returns the average of the weights over the steps.
    """
    k = len(FEATURES)
    theta, mean, steps = np.zeros(2 * k + 6), np.zeros(2 * k + 6), 0
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        for i in rng.permutation(len(sequences)):
            x, y = sequences[i]
            emit, move, start = theta[: 2 * k].reshape(k, 2), theta[2 * k : 2 * k + 4].reshape(2, 2), theta[2 * k + 4 :]
            node, edge = _marginals(x @ emit, move, start)
            gold = np.zeros_like(node)
            gold[np.arange(len(y)), y] = 1
            moves = np.bincount(2 * y[:-1].astype(np.int64) + y[1:], minlength=4)
            down = np.concatenate([(x.T @ (gold - node)).ravel(), moves - edge.ravel(), gold[0] - node[0]])
            theta = theta + rate / (1 + epoch) * (down / len(x) - decay * theta)
            mean += theta
            steps += 1
    theta = mean / max(1, steps)
    return LineCrf(theta[: 2 * k].reshape(k, 2), theta[2 * k : 2 * k + 4].reshape(2, 2), theta[2 * k + 4 :])


def _marginals(scores: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward, scaled: label marginals of each line and expected transitions in total."""
    n = len(scores)
    e, m = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(move)
    f, b = np.empty((n, 2)), np.ones((n, 2))
    f[0] = e[0] * np.exp(start - start.max())
    f[0] /= f[0].sum()
    for t in range(1, n):
        f[t] = (f[t - 1] @ m) * e[t]
        f[t] /= f[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = m @ (e[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    node = f * b
    node /= node.sum(axis=1, keepdims=True)
    edge = f[:-1, :, None] * m * (e[1:] * b[1:])[:, None, :]
    total = edge.sum(axis=(1, 2), keepdims=True)
    return node, (edge / total).sum(axis=0) if n > 1 else np.zeros((2, 2))


def some_lines(lines: list[str], text: str) -> list[str]:
    """FIT_LINES lines at most, from a place that the text's checksum names."""
    at = zlib.crc32(text.encode("utf-8", "surrogatepass")) % max(1, len(lines) - FIT_LINES + 1)
    return lines[at : at + FIT_LINES]


def _lines(text: str | None) -> list[str]:
    return [line for line in (text or "").split("\n") if line.encode().split()]


def train(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCUMENTS) -> LineCrf:
    """A CRF from ``labels(doc_id, quality)``: a document's label and each line's looks make weak labels of its lines (``line_labels``).

    At most ``per_class`` labelled documents of each class count, those whose id
    hashes lowest, with FIT_LINES lines each; those that the base rule fails say
    nothing of their lines. Their lines' features are made by the executors; the
    driver gets eight small numbers a line. Rows that share a picked id all count.
    Without both classes the CRF is neutral.
    """
    picked = None
    for quality in (0, 1):
        ids = labels.where(F.col("quality") == quality).groupBy("doc_id").agg(F.lit(1 - quality).alias("y"))
        some = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    # per_class bounds this side
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(y, line_features(some_lines(lines, t))) for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if (lines := _lines(t)) and not base_fails(*text_counts(t))]
            yield pa.record_batch([pa.array([y for y, _ in kept], pa.int32()), pa.array([x.astype(np.float32).tobytes() for _, x in kept], pa.binary())], names=["y", "x"])

    found = sorted((r.y, bytes(r.x)) for r in rows.mapInArrow(run, "y int, x binary").collect())
    rows_of = [(y, np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)).astype(float)) for y, x in found]
    return fit_crf([(x, line_labels(x, y == CONTENT)) for y, x in rows_of]) if {y for y, _ in rows_of} == {0, 1} else neutral_crf()


def assess(docs: DataFrame, crf: LineCrf, carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept``.

    ``carry`` names columns to pass on in place of doc_id, so that the verdict needs no join with the texts.

    Null, empty and blank texts have no words and fail the base rule. Only doc_id
    and text are read; repeated rows give repeated results; an empty table none.
    """
    send = (crf.emit, crf.move, crf.start)
    own = [c for c in carry or ["doc_id"] if c not in OUT[1:]]
    text_at = own.index("text") if "text" in own else len(own)  # a text that is passed on anyway isn't sent twice
    rows = docs.select(*own) if "text" in own else docs.select(*own, F.col("text").alias("__text"))
    if carry is None:
        rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LineCrf(*send)
        for batch in batches:
            counts, share = [], []
            for value in batch.column(text_at):
                text = value.as_py()
                counts.append(text_counts(text))
                lines = _lines(text)
                if lines:
                    size = np.array([len(b"".join(line.encode().split())) for line in lines])
                    share.append(float(size[model.decode(line_features(lines)) == CONTENT].sum() / size.sum()))
                else:
                    share.append(0.0)
            cols = np.array(counts, np.int64).reshape(-1, 5)
            failed = base_fails(*cols.T)
            share = np.array(share, float)
            arrays = [*batch.columns[: len(own)], *(pa.array(cols[:, i]) for i in range(5)), pa.array(failed), pa.array(share), pa.array(~failed & (share >= CONTENT_SHARE))]
            yield pa.record_batch(arrays, names=[*own, *OUT[1:]])

    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*rows.drop("__text").schema.fields, *(T.StructField(n, k) for n, k in zip(OUT[1:], kinds, strict=True))])
    return rows.mapInArrow(run, schema)


OUT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return assess(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE_SQL: dict[str, str] = {}
