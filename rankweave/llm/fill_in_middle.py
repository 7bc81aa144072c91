"""Fill-in-middle transformation (operator 13): texts cut into prefix, middle and suffix, and put in the order a causal model fills gaps in.

Cuts are drawn in code points, texts lie in memory as UTF-8 bytes. A sparse index
has only the characters of more than one byte; between them a code point's byte
is a matter of addition, so texts of ASCII cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
OUT = "n long, form string, prefix_chars long, middle_chars long, output string"
#: Bytes of text that are rearranged at a time.
PART = 16 << 20


class CharIndex:
    """Converts between byte and code-point places in UTF-8 ``data`` by the places and excess bytes of its multibyte characters."""

    def __init__(self, data: np.ndarray):
        self.at_bytes = np.flatnonzero(data >= 0xC0)  # first bytes of multibyte characters
        lead = data[self.at_bytes]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])  # of all characters before
        self.at_chars = self.at_bytes - self.excess[:-1]

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Code-point places of byte places, which must be starts of characters."""
        return at - self.excess[np.searchsorted(self.at_bytes, at)]

    def bytes(self, at: np.ndarray) -> np.ndarray:
        """Byte places of code-point places."""
        return at + self.excess[np.searchsorted(self.at_chars, at)]


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:doc_id``, as unsigned integers; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _arrange(texts: pa.Array, draws: list[np.ndarray], rate: int, spm_rate: int) -> list[pa.Array]:
    """Columns of OUT for a few texts."""
    marked = np.asarray(pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}"))
    raw = texts.cast(pa.binary())
    starts = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    whole = raw.buffers()[2] or pa.py_buffer(b"")
    index = CharIndex(np.frombuffer(whole, np.uint8)[starts[0] : starts[-1]])
    starts, base = starts - starts[0], int(starts[0])
    places = index.chars(starts)
    n = np.diff(places)
    h1, h2, h3, h4 = draws
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
    at = index.bytes(places[:-1] + cuts)
    plain = (n == 0) | marked | (h3 % 100 >= rate)
    form = np.where(plain, "plain", np.where(h4 % 100 < spm_rate, "spm", "psm"))
    data, (p, s, m), out = memoryview(whole)[base:], (x.encode() for x in SENTINELS), []
    for a, x, y, b, kind in zip(starts[:-1].tolist(), *at.tolist(), starts[1:].tolist(), form.tolist(), strict=True):
        if kind == "plain":
            out.append(data[a:b])
        elif kind == "psm":
            out += (p, data[a:x], s, data[y:b], m, data[x:y])
        else:
            out += (s, data[y:b], p, data[a:x], m, data[x:y])
    ends = np.concatenate([[0], np.cumsum(np.diff(starts) + np.where(plain, 0, len(p) + len(s) + len(m)))]).astype(np.int32)
    output = pa.StringArray.from_buffers(len(n), pa.py_buffer(ends), pa.py_buffer(b"".join(out)))
    return [pa.array(n), pa.array(form), pa.array(cuts[0], mask=plain), pa.array(cuts[1] - cuts[0], mask=plain), output]


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``n, form, prefix_chars, middle_chars, output`` for ``text``; other columns stay, those named like an output give way.

    Both cuts and the form are drawn from a hash of ``seed:doc_id``, so that a run can
    be repeated and rows of one id get equal draws. A text is rearranged in ``rate``
    of 100 draws, and of those in ``spm_rate`` of 100 with the suffix first. Null and
    empty texts, and texts that hold a sentinel, are left as they are (``plain``,
    without cuts). Texts go whole, whatever their length; each row is worked on alone.
    """
    made = [c.split()[0] for c in OUT.split(", ")]
    keep = [c for c in docs.columns if c not in (*made, "text")]
    named = [F.col(f"`{c}`") for c in keep]
    schema = docs.select(*named).schema
    for field in docs.sparkSession.createDataFrame([], OUT).schema:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(len(keep)), "").cast(pa.string())
            draws = [np.asarray(c) for c in batch.columns[len(keep) + 1 :]]
            size = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)) // PART
            edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a < b:
                    columns = _arrange(texts.slice(a, b - a), [d[a:b] for d in draws], rate, spm_rate)
                    yield pa.record_batch([*batch.slice(a, b - a).columns[: len(keep)], *columns], names=schema.names)

    inputs = [*named, F.col("text"), *_draws(F.col("doc_id"), seed)]
    return docs.select(*(c.alias(f"__{i}") for i, c in enumerate(inputs))).mapInArrow(run, schema)  # places for names, which may clash


def restore(output: Column, form: Column) -> Column:
    """The text before the transformation, from the transformed one and its form alone."""
    body = F.substr(output, F.lit(1 + len(PREFIX)))
    first, second = ({k: F.split_part(body, F.lit(s), F.lit(i)) for k, s in (("psm", SUFFIX), ("spm", PREFIX))} for i in (1, 2))

    def after(kind: str, i: int) -> Column:
        return F.split_part(second[kind], F.lit(MIDDLE), F.lit(i))

    return (
        F.when(form == "psm", F.concat(first["psm"], after("psm", 2), after("psm", 1)))
        .when(form == "spm", F.concat(after("spm", 1), after("spm", 2), first["spm"]))
        .otherwise(output)
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {"op13_fill_in_middle": op13_fill_in_middle}
ORACLE_SQL = {
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
r AS (SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
x AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(p || m || s) AS restored_sha256 FROM x""",
}
