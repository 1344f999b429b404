"""The operators of this subpackage as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pacefold.llm import (
    chat,
    decontaminate,
    language,
    language_model,
    mixing,
    near_dedup,
    neighbours,
    packing,
    periodic_runs,
    quality,
    suffix_dedup,
    token_counts,
    whitening,
)
from pacefold.llm.folders import documents
from pacefold.session import workers_find_package

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry() -> dict[str, Query]:
    return {name: _prepared(query) for name, query in _QUERIES.items()}


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_decontamination": lambda spark, sf_dir: decontaminate.op1(
        documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")
    ),
    "op2_language_model": _on_documents(language_model.op2),
    "op3_token_counts": _on_documents(token_counts.op3),
    "op4_chat": lambda spark, sf_dir: chat.op4(_table(spark, sf_dir, "conversations")),
    "op5_near_duplicates": _on_documents(near_dedup.op5),
    "op6_language": _on_documents(language.op6),
    "op7_neighbours": lambda spark, sf_dir: neighbours.op7(_table(spark, sf_dir, "embeddings")),
    "op8_mixing": _on_documents(mixing.op8),
    "op9_suffix_dedup": _on_documents(suffix_dedup.op9),
    "op10_quality": lambda spark, sf_dir: quality.op10(
        documents(spark, sf_dir), _table(spark, sf_dir, "labels")
    ),
    "op11_periodic_runs": _on_documents(periodic_runs.op11),
    "op12_whitening": lambda spark, sf_dir: whitening.op12(_table(spark, sf_dir, "embeddings")),
    "op13_packing": _on_documents(packing.op13),
}
