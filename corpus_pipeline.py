"""A training-data pipeline in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from limitlens.llm import pii, toxicity
from limitlens.llm.exact_dedup import exact_duplicates
from limitlens.llm.near_dup import near_duplicates
from limitlens.llm.packing import pack
from limitlens.llm.tables import keep, recorded, table, whole_text
from limitlens.storage import drop_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# SQL cannot train the toxicity model nor run the tokenizer: tested against brute force instead.
ORACLE_SQL = None

# Scratch tables of the stage before. Its result has been written when the next stage begins.
_left: list[str] = []


def _stage(function: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            drop_folder(spark, _left.pop().rpartition("/")[0])
        with recorded() as made:
            out = function(spark, docs, sf_dir)
        _left.extend(made)
        return out

    run_stage.__name__, run_stage.__doc__ = function.__name__, function.__doc__
    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go; the model learns from the labelled ones.

    Null texts are scored as empty ones, rows that repeat get one score, texts of any length are scored as a
    whole. Without labels of both classes all go or none. Other columns may have any name.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    scored = model.score(docs.select(row, whole_text().alias("_text")))
    return scored.where("_score < 0.5").select("_doc.*")


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z the one with the largest doc_id stays.

    Rows that repeat id and text are copies as well: one of them stays.
    """
    stays = (
        exact_duplicates(docs).where("kept").select(
            F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest_kept")
        ).distinct()
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_own"), F.sha2(F.translate(whole_text(), upper, lower), 256).alias("_digest"), row
    )
    kept = rows.join(
        stays, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_digest_kept"))
    )
    first = F.row_number().over(Window.partitionBy("_own", "_digest").orderBy(F.lit(1)))
    return kept.withColumn("_first", first).where("_first = 1").select("_doc.*")


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles the smallest doc_id stays (rows without one last).

    Rows are told apart by a hash of id and text, so rows without an id or with a repeated one are decided
    each for itself; only rows that repeat both share a decision (the stage before leaves one of them). Null and empty texts
    are linked with nothing and stay. Texts of any length are compared as a whole. Other columns may have any name.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    own = F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), whole_text())
    found = keep(near_duplicates(docs.select(own.alias("doc_id"), "text"), words=5, percent=80), "near-decisions")
    ids = docs.select(own.alias("_own"), F.col("doc_id").cast("long").alias("_id"))
    linked = found.select(F.col("doc_id").alias("_own"), F.col("component_id").alias("_component")).distinct()
    first = F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_own")))
    stays = ids.join(linked, "_own").groupBy("_component").agg(first.alias("_first")).select(F.col("_first._own").alias("_own"))
    return docs.select(own.alias("_own"), row).join(stays, "_own", "left_semi").select("_doc.*")


@_stage
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars is counted again.

    Every row stays; null texts stay null, texts of any length are searched as a whole.
    """
    out = pii.masked(docs)
    if "n_chars" not in docs.columns:
        return out
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes pieces of sequences of 1024 tokens.

    Null and empty texts are one end id; rows that repeat are packed each for itself; a text of any length is cut into pieces.
    """
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result but the last is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
