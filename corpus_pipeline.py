"""A corpus, cleaned in five stages; each reads what its predecessor wrote, and begins with heaps that hold nothing of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probata.llm import decontaminate, jaccard, langid, linededup, pieces
from probata.llm.common import collected, staged, table
from probata.llm.queries import piece_model

#: As many ids of dropped documents are sent to all executors at most; beyond that, they are joined by a shuffle.
MOST_SENT = 1 << 20


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns of these names, in any case, under others, and what to rename to undo it."""
    taken = {c.lower() for c in docs.columns}
    moved = {}
    for c in docs.columns:
        if c.lower() in names:
            new = f"kept_{c}"
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            moved[c] = new
    return docs.withColumnsRenamed(moved), {v: k for k, v in moved.items()}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without text or without any letter go; a missing lang is filled in."""
    collected(spark)
    train = docs.filter(langid.remainder() != 1).select("text", "lang")
    rows, back = _aside(docs, "lang_pred", "score")
    out = langid.identified(rows, train).filter(F.col("lang_pred") != langid.UNKNOWN)
    out = out.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return out.withColumnsRenamed(back).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that loses lines and has no word left goes."""
    collected(spark)
    rows, back = _aside(docs, "n_lines", "n_removed")
    out = linededup.deduplicated(rows)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"\S")
    out = out.filter(F.coalesce(left, F.lit(True))).withColumn("n_chars", F.length("text").cast("long")).drop("n_lines", "n_removed")
    return out.withColumnsRenamed(back).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id; rows without doc_id stay."""
    collected(spark)
    gone = staged(jaccard.near_duplicates(docs).filter("component_id <> doc_id").select("doc_id").distinct())
    few = gone.count() <= MOST_SENT
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    collected(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number and the digest of its pieces, and the digest of what they decode to."""
    collected(spark)
    return pieces.encoded(docs, piece_model())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL cannot express the language model, the edit distances or the pieces; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents in sf_dir: of those that all stages before kept, the pieces.

    Null and empty texts go in the first stage, as do texts without a letter. Repeated rows are one to each stage's operator as its docstring
    says; further columns pass through, whatever they are called. An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = staged(docs)
    return docs
