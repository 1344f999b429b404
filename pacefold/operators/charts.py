"""Data behind the six charts, aggregated in Spark.

Each numeric chart first counts equal values. That step combines copies inside
the map tasks, so a value that holds most rows costs one row per task, and every
later step works on distinct values. Spark runs the repeated use of the counts as
one scan and one shuffle, provided that each use needs the counts too: extremes
alone it would take from a second scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType
from pyspark.sql.window import Window

from pacefold.functions.measures import row_count
from pacefold.functions.totals import ROWS, totals

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

#: How exact quantiles narrow down the value range: slices per step, and steps.
SLICES_PER_STEP = 65536
ZOOM_STEPS = 2


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value: ``key``, ``count``; commonest first.

    The frame may hold totals (:mod:`pacefold.functions.totals`) of finer groups.
    """
    return (
        totals(frame.where(F.col(column).isNotNull()), [column])
        .select(F.col(column).alias("key"), F.col(ROWS).alias("count"))
        .orderBy(F.desc("count"), "key")
    )


def point_counts(frame: DataFrame, x: str, y: str) -> DataFrame:
    """Scatter data: rows per distinct ``(x, y)``, points with a null left out."""
    return (
        frame.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
        .agg(row_count("count"))
    )


def histogram(frame: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram from the lowest to the highest value; nulls and NaN left out.

    The last bin includes its right edge, empty bins are listed, and a constant
    column gets a range one unit wide around its value.
    """
    counts = distinct_values(frame, column)
    low, high = F.min("v"), F.max("v")
    margin = F.when(low == high, 0.5).otherwise(0.0)
    scale = counts.agg(
        F.struct(
            (low - margin).alias("start"),
            ((high + margin) - (low - margin)).alias("width"),
            F.sum("n").alias("rows"),
        )
    ).scalar()

    place = F.floor((F.col("v") - F.col("scale.start")) * bins / F.col("scale.width"))
    filled = counts.withColumn("scale", scale).select(
        F.least(F.lit(bins - 1), place).cast("int").alias("bin"), "n"
    )
    empty = frame.sparkSession.range(0, bins, 1, numPartitions=1).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).cast("long").alias("n")
    )

    def edge(number: Column) -> Column:
        return F.col("scale.start") + number * F.col("scale.width") / bins

    return (
        filled.unionByName(empty)
        .groupBy("bin")
        .agg(F.sum("n").alias("count"))
        .withColumn("scale", scale)
        .select(
            "bin",
            edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"),
            "count",
        )
        .orderBy("bin")
    )


def quartiles(frame: DataFrame, column: str, accuracy: int | None = None) -> DataFrame:
    """One row ``q1, median, q3``; exact, with linear interpolation between values.

    ``accuracy`` switches to Spark's approximate percentiles of that accuracy.
    """
    if accuracy:
        points = F.percentile_approx(column, list(QUARTILES.values()), accuracy)
        return frame.agg(points.alias("p")).select(
            *(
                F.col("p")[place].cast("double").alias(name)
                for place, name in enumerate(QUARTILES)
            )
        )
    return _exact_quantiles(distinct_values(frame, column), QUARTILES)


def boxplot(frame: DataFrame, column: str, accuracy: int | None = None) -> DataFrame:
    """Quartiles, and whiskers at the extreme values within 1.5 IQR of the box.

    ``accuracy`` switches to approximate quartiles.
    """
    box = quartiles(frame, column, accuracy) if accuracy else None
    return boxplot_of(distinct_values(frame, column), box)


def boxplot_of(counts: DataFrame, box: DataFrame | None = None) -> DataFrame:
    """The same from counted values ``v``, ``n``, and from quartiles if known."""
    if box is None:
        box = _exact_quantiles(counts, QUARTILES)
    low, high = _fences()
    edges = box.select(F.struct(*QUARTILES, low, high)).scalar()
    value = F.col("v")
    return (
        counts.agg(
            F.min(F.when(value >= edges.getField("low_fence"), value)).alias("lowest"),
            F.max(F.when(value <= edges.getField("high_fence"), value)).alias("highest"),
            F.sum("n").alias("rows"),
        )
        # Always true; keeps the counts in use, see above.
        .where(F.col("rows").isNull() | (F.col("rows") > 0))
        .withColumn("box", edges)
        .select(
            "box.q1",
            "box.median",
            "box.q3",
            F.least("lowest", "box.q1").alias("whisker_low"),
            F.greatest("highest", "box.q3").alias("whisker_high"),
        )
    )


def boxplot_outliers(
    frame: DataFrame, column: str, accuracy: int | None = None
) -> DataFrame:
    """The rows whose value lies beyond the fences of the box plot."""
    return beyond_fences(frame, column, quartiles(frame, column, accuracy))


def beyond_fences(frame: DataFrame, column: str, box: DataFrame) -> DataFrame:
    """Rows beyond the fences of a one-row frame with ``q1`` and ``q3``."""
    fences = box.select(F.struct(*_fences())).scalar()
    low, high = fences.getField("low_fence"), fences.getField("high_fence")
    beyond = frame.where((F.col(column) < low) | (F.col(column) > high))
    if isinstance(frame.schema[column].dataType, DoubleType | FloatType):
        return beyond.where(~F.isnan(column))
    return beyond


def distinct_values(frame: DataFrame, column: str) -> DataFrame:
    """Values ``v`` of a numeric column, each with its row count ``n``.

    Nulls are left out, and so is NaN, which has no place among the numbers.
    """
    numbers = frame.where(F.col(column).isNotNull())
    if isinstance(frame.schema[column].dataType, DoubleType | FloatType):
        numbers = numbers.where(~F.isnan(column))
    return numbers.groupBy(F.col(column).cast("double").alias("v")).agg(row_count("n"))


def _fences() -> tuple[Column, Column]:
    reach = (F.col("q3") - F.col("q1")) * 1.5
    low, high = F.col("q1") - reach, F.col("q3") + reach
    return low.alias("low_fence"), high.alias("high_fence")


def _exact_quantiles(counts: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles from distinct values ``v`` and their counts ``n``.

    A quantile lies between the values at two neighbouring ranks. The value range
    is cut into 65536 slices; slice totals show which slice holds each rank; only
    those slices are cut again. The last slices are 2**-32 of the range wide, so
    ranking the values inside them is a small task: at most one whole number each
    for 32-bit values (for fractions that crowd into a tiny part of their range,
    ``accuracy`` is the way). One task orders at most 65536 totals, and at most two
    slices per quantile are broadcast.
    """
    whole = counts.agg(
        F.struct(
            F.min("v").alias("low"),
            (F.max("v") - F.min("v")).alias("width"),
            (F.sum("n") - 1).alias("last_rank"),
        )
    ).scalar()
    slices = SLICES_PER_STEP**ZOOM_STEPS
    place = F.when(F.col("whole.width") == 0, F.lit(0)).otherwise(
        F.floor((F.col("v") - F.col("whole.low")) / F.col("whole.width") * slices)
    )
    digits = [f"slice_{step}" for step in range(ZOOM_STEPS)]
    placed = (
        counts.withColumn("whole", whole)
        .select(
            "v",
            "n",
            F.col("whole.last_rank").alias("last_rank"),
            F.least(F.lit(slices - 1), place).alias("place"),
        )
        .select("v", "n", "last_rank", *_digits(F.col("place"), digits))
    )

    ranks = [
        rank(F.col("last_rank") * F.lit(share)).cast("long")
        for share in shares.values()
        for rank in (F.floor, F.ceil)
    ]
    inside = placed.withColumn("rows_below", F.lit(0).cast("long"))
    for step in range(ZOOM_STEPS):
        outer, here = digits[:step], digits[: step + 1]
        before = Window.partitionBy(*outer).orderBy(digits[step])
        totals = inside.groupBy(*here, "rows_below", "last_rank").agg(
            F.sum("n").alias("rows")
        )
        chosen = totals.withColumn(
            "rows_below",
            F.col("rows_below")
            + F.coalesce(
                F.sum("rows").over(before.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        ).where(
            reduce(
                lambda left, right: left | right,
                [
                    (F.col("rows_below") <= rank)
                    & (rank < F.col("rows_below") + F.col("rows"))
                    for rank in ranks
                ],
            )
        )
        inside = placed.join(F.broadcast(chosen.select(*here, "rows_below")), here)

    up_to = F.sum("n").over(Window.partitionBy(*digits).orderBy("v"))
    ranked = inside.withColumn("rows_up_to", F.col("rows_below") + up_to)
    found = ranked.agg(
        F.max("last_rank").alias("last_rank"),
        F.array(
            *(F.min(F.when(F.col("rows_up_to") > rank, F.col("v"))) for rank in ranks)
        ).alias("at"),
    )
    results = []
    for number, (name, share) in enumerate(shares.items()):
        position = F.col("last_rank") * F.lit(share)
        below, above = F.col("at")[2 * number], F.col("at")[2 * number + 1]
        fraction = position - F.floor(position)
        results.append((below + (above - below) * fraction).alias(name))
    return found.select(*results)


def _digits(place: Column, names: list[str]) -> list[Column]:
    """A slice number as its digits to base ``SLICES_PER_STEP``, highest first.

    Digits are declared never null: joins on them then add no filter that Spark
    would push below the counting of values, which it could no longer share.
    """
    powers = range(len(names) - 1, -1, -1)
    return [
        F.coalesce(
            F.floor(place / SLICES_PER_STEP**power % SLICES_PER_STEP).cast("int"), F.lit(0)
        ).alias(name)
        for power, name in zip(powers, names, strict=True)
    ]
