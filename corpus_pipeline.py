"""A training-corpus pipeline over ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes every stage's result as Parquet into the shared folder and hands the
stored table to the next one. All stages but the last return the columns of
``documents``. Rows with a null id take part row by row (quality, secrets,
mixing) and are kept by the stages that compare documents; other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm import decontaminate, minhash_dedup, mixing, quality, secrets
from panelkit.llm.common import stored, table
from panelkit.llm.queries import KEEP_SCORE, MIX_TARGETS, language_labels, quality_model

_NEW, _SHARED = "panelkit_stage_value", "panelkit_stage_mark"  # column names of our own, dropped again


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (op 1); empty and null texts are scored as empty ones."""
    scored = quality.score(docs, quality_model(spark, sf_dir), docs.columns, score_col=_NEW)
    return scored.where(F.col(_NEW) >= KEEP_SCORE).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays (op 9).

    An id that stands for several different texts is several documents here,
    each judged by its own text. Of rows that repeat id and text the first by
    their other columns stays; rows with a null id all stay.
    """
    named = docs.where("doc_id IS NOT NULL")
    spot = F.xxhash64("text")
    shared = stored(named.groupBy("doc_id").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).where("a <> b")
                    .select("doc_id", F.lit(True).alias(_SHARED)), "shared-ids")
    own = F.lit(-1) - F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62))
    keyed = named.join(shared, "doc_id", "left").withColumn(_NEW, F.when(F.col(_SHARED), own).otherwise(F.col("doc_id")))
    keep = minhash_dedup.near_duplicates(keyed, id_col=_NEW).where("kept").select(F.col("doc_id").alias(_NEW))
    order = [F.col(c).asc_nulls_first() for c in docs.columns if c not in ("doc_id", "text")]
    first = F.row_number().over(Window.partitionBy(_NEW).orderBy(*(order or [F.col(_NEW)])))
    return (keyed.join(keep, _NEW, "left_semi").withColumn(_SHARED, first).where(F.col(_SHARED) == 1)
            .select(*docs.columns).unionByName(docs.where("doc_id IS NULL")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised ones too, go (op 6); empty and null texts and rows
    with a null id stay."""
    leaked = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, encoded ones too, are replaced by a mark (op 4); n_chars follows the text.

    A null text stays null, an empty one empty; every text is scanned whole.
    """
    done = secrets.redact(docs, docs.columns, out_col=_NEW).withColumn("text", F.col(_NEW))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(),
                                                 F.length("text").cast(docs.schema["n_chars"].dataType)))
    return done.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's sampling rate and copies for the target mix of languages (op 10); empty texts have no tokens."""
    labelled = language_labels(docs, table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled, MIX_TARGETS, docs.columns)


STAGES = [
    ("quality_classifier", quality_filter),
    ("minhash_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_redaction),
    ("source_mixing", source_mixing),
]

# Compression, graph closure, decoding and an iterative fit have no SQL form;
# tests/llm/test_pipeline.py holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
