"""A corpus pipeline of five stages, from raw documents to the order of training.

Each stage is given its predecessor's rows, read again from Parquet, and returns all
columns of ``documents``; the last returns one row per copy that the mix takes.

Defined cases, for all stages: further columns of any name go through unchanged, as
fields of one ``row`` that no name of an operator can clash with; null and empty texts
have no letter and go in the first stage; rows without an id are documents of their own;
rows that repeat an id with the same text are one document to the near-duplicate stage,
which keeps one, and those that repeat it with another text are different documents
there and to the stage after it, while the contamination stage drops all rows of an id
that is found; a text of any length is the work of one task in each stage, which needs up
to 100 bytes for each of its bytes; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacefold.llm import decontaminate, language, mixing, near_dedup, suffix_dedup
from pacefold.llm.folders import documents, workspace
from pacefold.session import workers_find_package

#: Near duplicates share this much of their five-word shingles, or more.
SIMILAR_PERCENT = 80


def _packed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text``, further columns and all others as fields of ``row``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *more, F.struct(*others).alias("row")
    )


def _unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    changed = {"text": F.col("text"), **changed}
    return rows.select(
        *(
            changed.get(f.name, F.col(f"row.`{f.name}`")).cast(f.dataType).alias(f.name)
            for f in docs.schema
        )
    )


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those with text that has a letter."""
    workers_find_package(spark)
    told = language.identify(_packed(docs, "lang"))
    return _unpacked(told.where(F.col("lang_pred") != language.UNDETERMINED), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group; documents without an id stay as they are."""
    workers_find_package(spark)
    marked = suffix_dedup.with_copies(_packed(docs))
    # Texts under one id are told apart by keys of their own, below all ids in use.
    digest = F.xxhash64("doc_id", "text")
    own = F.least(digest, F.bitwise_not(digest))
    keyed = marked.withColumn("key", F.when(F.col("copy") == 0, F.col("doc_id")).otherwise(own))
    kept = near_dedup.near_duplicates(
        keyed.where(F.col("doc_id").isNotNull()).select(F.col("key").alias("doc_id"), "text"),
        SIMILAR_PERCENT,
    ).where("kept")
    firsts = keyed.join(kept.select(F.col("doc_id").alias("key")), "key", "left_semi")
    return _unpacked(firsts.dropDuplicates(["key"]), docs).union(
        docs.where(F.col("doc_id").isNull())
    )


def remove_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that repeat; those of nothing else go."""
    workers_find_package(spark)
    cut = suffix_dedup.cut_documents(docs)
    left = cut.where((F.col("n_removed") == 0) | (F.btrim("kept_text", F.lit(" \t\n\r")) != ""))
    kept = F.col("kept_text")
    return _unpacked(left, docs, text=kept, n_chars=F.char_length(kept))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents up to its target, in the order of training.

    One row per copy, without the texts, which stay in the stage before.
    """
    return mixing.training_order(mixing.mix(docs))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_text", remove_repeated_text),
    ("contamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL cannot express language identification and the removal of repeated text.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what they write in between is removed before this returns.

    The last stage has by then read what it needs of its documents: ids and sizes.
    """
    docs = documents(spark, sf_dir)
    with workspace(spark, "pipeline") as store:
        for name, stage in STAGES[:-1]:
            docs = store(stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
