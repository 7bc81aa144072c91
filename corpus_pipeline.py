"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, SentencePiece ids.

Each stage takes (spark, docs, sf_dir), works on every document that the stage
before kept, and is written as Parquet before the next one reads it. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import decontaminate, pii, quality, sentencepiece_lattice, simhash
from rankweave.llm.common import few_rows, stage, table, text_key, unstage

#: Texts that a Python worker cuts and encodes at a time in the last stage: it comes when the executors' heaps have grown full.
CODED_ROWS = 500


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; columns that are named like a verdict's keep their values."""
    few_rows(spark)  # whoever writes the result
    named = docs.withColumnsRenamed({c: f"__own {c}" for c in docs.columns if c in quality.OUT[1:]})
    judged = quality.assess(named, quality.train(docs, table(spark, sf_dir, "labels")), carry=named.columns)
    return judged.where("kept").select(*named.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one of smallest doc_id, null ids last.

    Rows are told apart by their texts and places, not by ids: distinct texts that
    share an id, or have none, stay. Of rows of one group that also share their id,
    one stays, chosen by a hash of all its columns.
    """
    names = {c: f"__own {c}" for c in docs.columns}
    rows = docs.withColumnsRenamed(names)
    grouped = simhash.similar_groups(rows.withColumnRenamed(names["text"], "text")).withColumnRenamed("text", names["text"])
    doc_id, own = F.col(f"`{names['doc_id']}`"), [F.col(f"`{c}`") for c in names.values()]
    each = grouped.groupBy("group", doc_id.alias("doc_id")).agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")
    several = each.groupBy("group").agg(F.min(order).alias("first"), F.sum("n").alias("rows")).where("rows > 1")
    several = stage(several.select("group", "first"), "groups")
    placed = grouped.join(several, "group", "left")
    is_first = F.col("first").isNull() | (doc_id.eqNullSafe(F.col("first.doc_id")) & (F.col("first.n") == 1))
    kept = placed.where(is_first).select(*own)
    if not several.where("first.n > 1").isEmpty():
        tied = placed.where(doc_id.eqNullSafe(F.col("first.doc_id")) & (F.col("first.n") > 1))
        once = tied.groupBy("group").agg(F.min_by(F.struct(*own), F.xxhash64(*own)).alias("row"))
        kept = kept.unionByName(once.select("row.*"))
    return kept.toDF(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; texts are found by their own key, so that rows which share an id, or have none, are judged apart."""
    names = {c: f"__own {c}" for c in docs.columns}
    rows = docs.withColumnsRenamed(names)
    key = text_key(F.col(f"`{names['text']}`")).alias("doc_id")
    texts = rows.select(key, F.col(f"`{names['text']}`").alias("text"))
    found = decontaminate.contaminated(texts, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    left = rows.withColumn("doc_id", key).join(stage(found, "contaminated"), "doc_id", "left_anti")
    return left.select(*(f"`{c}`" for c in names.values())).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    masked = pii.mask_pii(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as ``doc_id, lang, source, n_ids, ids``."""
    few_rows(spark, CODED_ROWS)
    pieces = sentencepiece_lattice.read_model(sentencepiece_lattice.model_path())
    coded = sentencepiece_lattice.encode(docs.select("doc_id", "lang", "source", "text"), pieces, text=False, rows=CODED_ROWS)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", sentencepiece_ids),
]

#: A CRF, a trie join, slot consistency and merges can't be said in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``, each written to the shared folder and read back."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        unstage(*before)
        before = [docs]
    return docs
