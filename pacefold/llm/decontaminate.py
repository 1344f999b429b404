"""Benchmark decontamination: test items contained in documents.

An item is contained in a document if the document has at least 80 % of the item's
distinct five-word shingles (A-Z in lower case; a text of fewer words is one shingle,
its whole sequence), wherever in the document they stand.

Items are short and documents long, so similarity of whole sets says nothing. Items
are therefore partitioned by size, and each partition's items are sketched by their
smallest shingle hashes (MinHash, bottom k). With at most ``u`` shingles in the
partition, an item can lack no more than ``u - ceil(0.8 u)`` of them; a sketch of one
more must share a value with every document that contains the item, so the search
finds all of them. Candidates are then verified on the shingles themselves.

Only built-in functions are used. The sketches are broadcast if they have at most
``BROADCAST_ROWS`` rows and joined by shuffle otherwise; documents are never compared
with one another.

Defined cases: null and wordless texts contain nothing, and such items are contained in
nothing; rows without an id are left out; rows that repeat an id must hold the same text
and are one document (or item); a share just at the threshold counts; further columns
are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacefold.llm.folders import lower_ascii, of_ids, stored

WIDTH = 5
#: Part of an item's shingles, in percent, that a document must have.
PERCENT = 80
#: Largest sketch table that is sent whole to every executor (16 bytes a row).
BROADCAST_ROWS = 1_000_000

_SPACES = r"[\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    """Words of a text; empty for null."""
    found = F.split(F.btrim(lower_ascii(text), F.lit(" \t\n\x0b\x0c\r")), _SPACES)
    return F.when(F.coalesce(found[0], F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        found
    )


def _starts(words: str) -> Column:
    """Where shingles of a non-empty word list begin, from 1."""
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - WIDTH + 1))


def shingle_texts(words: str) -> Column:
    """Distinct shingles of a column of words, as text."""
    every = F.transform(_starts(words), lambda i: F.array_join(F.slice(words, i, F.lit(WIDTH)), " "))
    return F.when(F.size(words) > 0, F.array_distinct(every)).otherwise(
        F.array().cast("array<string>")
    )


def shingle_hashes(words: str) -> Column:
    """Hashes of the same shingles, copies included."""
    return F.when(
        F.size(words) > 0,
        F.transform(_starts(words), lambda i: F.xxhash64(F.slice(words, i, F.lit(WIDTH)))),
    ).otherwise(F.array().cast("array<bigint>"))


def needed(size: Column) -> Column:
    """Shingles of an item of this size that a document must have."""
    return F.ceil(size * PERCENT / F.lit(100)).cast("int")


def sketches(items: DataFrame) -> DataFrame:
    """``item_id, sketch``: each item's smallest hashes, as many as its partition needs."""
    sized = items.withColumn("hashes", F.array_distinct(shingle_hashes("words"))).withColumn(
        "n", F.size("hashes")
    )
    # Partitions end at powers of two.
    largest = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int")
    return (
        sized.where("n > 0")
        .withColumn("largest", largest)
        .withColumn("keep", F.col("largest") - needed(F.col("largest")) + 1)
        .select("item_id", F.explode(F.slice(F.sort_array("hashes"), F.lit(1), F.col("keep"))).alias("sketch"))
        .distinct()
    )


def candidates(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_ids`` of documents that share a sketch value with items."""
    wanted = stored(sketches(items).groupBy("sketch").agg(F.collect_set("item_id").alias("item_ids")), "sketches")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    hashes = documents.select("doc_id", word_list(F.col("text")).alias("words")).select(
        "doc_id", F.explode(shingle_hashes("words")).alias("sketch")
    )
    return (
        hashes.join(wanted, "sketch")
        .select("doc_id", F.explode("item_ids").alias("item_id"))
        .distinct()
    )


def contained(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` of all contained items."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), word_list(F.col("text")).alias("words")
    )
    texts = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    found = stored(candidates(texts, items), "candidates")
    item_sets = items.select("item_id", shingle_texts("words").alias("item_shingles"))
    doc_sets = (
        of_ids(texts, found.select("doc_id").distinct(), "doc_id")
        .select("doc_id", word_list(F.col("text")).alias("words"))
        .select("doc_id", shingle_texts("words").alias("doc_shingles"))
    )
    shared = F.size(F.array_intersect("item_shingles", "doc_shingles")).cast("long")
    verified = (
        found.join(item_sets, "item_id")
        .join(doc_sets, "doc_id")
        .select("doc_id", "item_id", F.size("item_shingles").cast("long").alias("n_shingles"), shared.alias("n_shared"))
        .where(F.col("n_shared") * 100 >= F.col("n_shingles") * PERCENT)
    )
    return (
        verified.groupBy("doc_id", "item_id", "n_shingles")
        .agg(F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item."""
    dirty = contained(documents, benchmark).select(F.col("doc_id").alias("_dirty")).distinct()
    return documents.join(dirty, documents["doc_id"] == F.col("_dirty"), "left_anti")


def op1(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contained(documents, benchmark)
