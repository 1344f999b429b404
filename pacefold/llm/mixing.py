"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time ``t`` from 0 to 1: its demand at
``t`` is ``target * (1 + slope * (2t - 1))``, whose integral over the whole run is the
target. A source's documents lie one behind the other in a fixed pseudo-random order,
once per pass over the source; a copy that begins after ``c`` words of its source's
stream is read when the source's cumulative demand reaches ``c``. Inverting the
cumulative demand gives the copy's position, and a range sort by position the order of
training.

Defined cases: null text has size 0; null sources form one source, ordered last; a
source of size 0 gets target 0; documents of size 0 are never taken; rows that repeat a
``doc_id`` are documents of their own; further columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacefold.llm.folders import stored

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: No source is read more often than this.
MOST_PASSES = 3
#: Change of the sources' demand over training, repeating like the weights.
SLOPES = (0.5, 0.0, -0.5)
#: Documents of a source that one task puts in order, on average.
SLICE_ROWS = 1_000


def word_count(text: Column) -> Column:
    """Words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``source_size``, ``weight``, ``slope``, ``target``.

    ``sizes`` has one row per source. Targets are a water level: a source stops at
    ``MOST_PASSES`` times its size once the level times its weight is above that. The
    sources that stop first are those with the smallest size per weight, so the level
    follows from running sums in that order.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name) - 1)

    def turn(values: tuple) -> Column:
        choice = F.pmod("_rank", F.lit(len(values)))
        return F.element_at(F.array(*map(F.lit, values)), (choice + 1).cast("int"))

    weighed = ranked.select(
        "source", "source_size", "n_docs", turn(WEIGHTS).alias("weight"), turn(SLOPES).alias("slope")
    ).withColumn("_cap", F.col("source_size") * MOST_PASSES)
    fullness = F.col("_cap") / F.col("weight")
    order = Window.orderBy(fullness, F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    ) / F.sum("weight").over(onward)
    levels = weighed.withColumn("_level", level).withColumn("_full", fullness)
    water = F.min(F.when(F.col("_full") >= F.col("_level"), F.struct("_full", "_level"))).over(
        everything
    )["_level"]
    target = F.least(F.col("_cap").cast("double"), F.coalesce(water, F.lit(0.0)) * F.col("weight"))
    return levels.withColumn("target", target).select(
        "source", "source_size", "n_docs", "weight", "slope", "target"
    )


def mix(documents: DataFrame) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``slope``, ``begin`` and ``taken``.

    ``begin`` is where the document starts in its source's stream. A document is taken
    once per whole pass, and in the last, partial pass as far as the target reaches; the
    one document there that the target cuts gives its first words only, so the source's
    taken words equal the rounded target.
    """
    sized = documents.withColumn("size", word_count(F.col("text"))).withColumn(
        "_order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    )
    light = stored(sized.select("source", "doc_id", "size", "_order"), "mix-sizes")
    targets = stored(
        source_targets(
            light.groupBy("source").agg(
                F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
            )
        ),
        "mix-targets",
    )
    return _placed(light, targets)


def _placed(light: DataFrame, targets: DataFrame) -> DataFrame:
    # A source may hold most rows: it is cut into slices by the leading digits of the
    # order, and only the slices' sums are added up over the whole source.
    slices = F.least(F.ceil(F.col("n_docs") / SLICE_ROWS), F.lit(1 << 28)).cast("long")
    leading = F.conv(F.substring("_order", 1, 7), 16, 10).cast("long")
    known = targets.withColumnRenamed("source", "_source")
    cut = light.join(known, light["source"].eqNullSafe(known["_source"])).drop("_source")
    cut = cut.withColumn("_slice", F.floor(leading * slices / F.lit(1 << 28)).cast("long"))
    sums = cut.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("_source"),
        F.col("_slice").alias("_base_slice"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_base"),
    )
    inside = (
        Window.partitionBy("source", "_slice")
        .orderBy("_order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begun = cut.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = begun.join(
        bases, begun["source"].eqNullSafe(bases["_source"]) & (F.col("_slice") == F.col("_base_slice"))
    ).withColumn("begin", F.col("_base") + F.col("_inside"))
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    rest = goal - passes * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("begin")))
    taken = passes * F.col("size") + partial
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "slope", "begin",
        taken.cast("long").alias("taken"),
    )


def position(cumulative: Column, target: Column, slope: Column) -> Column:
    """Training time at which a source's cumulative demand reaches ``cumulative``.

    The demand up to ``t`` is ``target * ((1 - slope) t + slope t^2)``.
    """
    share = F.when(target > 0, cumulative / target).otherwise(F.lit(0.0))
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((root - (1 - slope)) / (2 * slope))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, range-sorted by ``position``.

    ``copy`` counts a document's passes from 0; ``words`` is how many of its words the
    copy gives, all but for the one document per source that the target cuts.
    """
    copies = (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int")
    read = mixed.where(F.col("taken") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), copies))
    )
    cumulative = F.col("begin") + F.col("copy") * F.col("source_size")
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    return (
        read.withColumn("words", words)
        .withColumn("position", position(cumulative, F.col("target"), F.col("slope")))
        .drop("begin", "slope")
        .repartitionByRange("position", "doc_id")
        .sortWithinPartitions("position", "doc_id")
    )


def op8(documents: DataFrame) -> DataFrame:
    """What the copies in the order of training give of each document, 0 if there are none."""
    mixed = stored(mix(documents), "mix-placed")
    # Where a document with words begins tells it from all others of its source, even
    # from those with the same id or none.
    ordered = stored(training_order(mixed.withColumn("_at", F.col("begin"))), "mix-order")
    given = ordered.groupBy(F.col("source").alias("_source"), "_at").agg(
        F.sum("words").alias("_given")
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("begin") == F.col("_at"))
    return mixed.join(given, same & (F.col("size") > 0), "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("_given", F.lit(0)).cast("long").alias("taken"),
    )
