"""The corpus pipeline: language ID, near-duplicates, PII, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it gets. All but
the last return the columns of ``docs``; the last returns the pieces of packed
sequences. Rows without a ``doc_id`` pass the stages as documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecast.llm import coordjoin, langid, mixing, packing, sanitise
from scorecast.llm.shared import scratch
from scorecast.session import ensure_workers_can_import

SIMILARITY = 0.8  # of five-word shingles
LEAST_SHARE = 0.3  # of the probability that the predicted language must hold


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language; a missing label takes the prediction.

    The model and the range learn from all labelled documents. A text is recognised if its log-probability
    per byte lies within the range of its language's labelled texts, so texts in a language that
    was not learned, or of random letters, go. Without any label nothing
    can be recognised and nothing is dropped.
    """
    ensure_workers_can_import(spark)
    labelled = docs.select("text", "lang", "doc_id")
    model = langid.fit(labelled, key=F.col("doc_id"), per_language=None)
    if not model.languages:
        return docs
    usual = langid.usual_text(labelled, model, key=F.col("doc_id"))
    judged = langid.predict(docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").cast("string").alias("text")), model, usual=usual)
    kept = judged.where(langid.accepted(F.col("lang_pred"), F.col("score"), F.col("far"), LEAST_SHARE))
    lang = F.coalesce(F.col("doc.lang"), F.col("lang_pred"))
    return kept.select(*[(lang if c == "lang" else F.col("doc")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of each near-duplicate group.

    Groups are of rows, not of ids: of rows that share an id, those with unlike texts all stay.
    """
    ensure_workers_can_import(spark)
    rows = scratch(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    named = rows.where("doc_id IS NOT NULL")
    groups = coordjoin.near_duplicates(named.select(F.col("__row").alias("doc_id"), "text"), similarity=SIMILARITY)
    ids = named.select("__row", F.struct(F.col("doc_id").cast("long").alias("id"), F.col("__row").alias("row")).alias("at"))
    first = groups.select(F.col("doc_id").alias("__row"), "component_id").join(ids, "__row").groupBy("component_id").agg(F.min("at").alias("at"))
    kept = named.join(first.select(F.col("at.row").alias("__row")), "__row", "left_semi")
    return kept.unionByName(rows.where("doc_id IS NULL")).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and terms that disclose it."""
    ensure_workers_can_import(spark)
    return sanitise.sanitised(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents until every source has its target's words."""
    ensure_workers_can_import(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack into sequences of 1024 tokens; one row per piece, with its token ids: the stage texts are scratch and copies share an id."""
    ensure_workers_can_import(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("pii", pii), ("mixing", mix), ("packing", pack)]

#: Language models, rounding by coin and the tokenizer have no SQL; tests/llm checks every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared scratch folder for the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
