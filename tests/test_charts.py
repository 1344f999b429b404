"""Chart data against numpy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pacefold.operators import charts

SLOW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, kind="double"):
    return spark.createDataFrame([(value,) for value in values], f"x {kind}")


def bins_of(frame):
    return [(row.bin, row["count"]) for row in frame.collect()]


@SLOW
@given(st.lists(st.integers(0, 300), min_size=2, max_size=60))
def test_histogram_is_numpys(spark, values):
    counts, edges = np.histogram(values, 20)
    got = charts.histogram(column(spark, [*values, None], "int"), "x").collect()
    assert [row["count"] for row in got] == counts.tolist()
    assert [row.bin_start for row in got] == pytest.approx(edges[:-1].tolist())
    assert [row.bin_end for row in got] == pytest.approx(edges[1:].tolist())


def test_constant_column_fills_the_middle_bin(spark):
    got = dict(bins_of(charts.histogram(column(spark, [5.0] * 4), "x")))
    assert got == {number: 4 if number == 10 else 0 for number in range(20)}


def test_histogram_of_nothing_is_empty_bins(spark):
    assert bins_of(charts.histogram(column(spark, [None]), "x")) == [
        (number, 0) for number in range(20)
    ]


def test_histogram_reads_its_input_once(spark, tmp_path):
    column(spark, range(100), "int").write.parquet(str(tmp_path / "t"))
    frame = charts.histogram(spark.read.parquet(str(tmp_path / "t")), "x")
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final


def check_box(spark, values, kind):
    data = np.array(values, dtype=float)
    q1, median, q3 = np.percentile(data, [25, 50, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside_low, inside_high = data[data >= low], data[data <= high]
    frame = column(spark, [*values, None], kind)
    got = charts.boxplot(frame, "x").first()
    assert (got.q1, got.median, got.q3) == pytest.approx((q1, median, q3))
    assert got.whisker_low == pytest.approx(min(inside_low.min(), q1))
    assert got.whisker_high == pytest.approx(max(inside_high.max(), q3))
    outliers = [row.x for row in charts.boxplot_outliers(frame, "x").collect()]
    assert sorted(outliers) == sorted(v for v in values if v < low or v > high)


@SLOW
@given(st.lists(st.integers(-1000, 100_000), min_size=1, max_size=60))
def test_box_of_whole_numbers(spark, values):
    check_box(spark, values, "int")


@settings(SLOW, max_examples=4)
@given(st.lists(st.integers(0, 10**6).map(lambda n: n / 64), min_size=1, max_size=40))
def test_box_of_fractions(spark, values):
    check_box(spark, values, "double")


def test_box_with_one_value_far_away(spark):
    check_box(spark, [*range(200), 10**12], "bigint")


def test_box_with_a_value_that_holds_most_rows(spark):
    check_box(spark, [7] * 500 + list(range(100)), "int")


def test_constant_column_has_no_outliers(spark):
    check_box(spark, [4] * 9, "int")


def test_box_of_nothing_is_null(spark):
    assert tuple(charts.boxplot(column(spark, [None]), "x").first()) == (None,) * 5


def test_approximate_box_is_close(spark):
    frame = column(spark, range(1001), "int")
    got = charts.quartiles(frame, "x", accuracy=10_000).first()
    assert tuple(got) == pytest.approx((250, 500, 750), abs=1)
    assert charts.boxplot(frame, "x", accuracy=10_000).first().whisker_high == 1000


def test_points_and_values_leave_nulls_out(spark):
    rows = [(1, 2.0), (1, 2.0), (1, None), (None, 2.0), (3, 4.0)]
    frame = spark.createDataFrame(rows, "a int, b double")
    points = charts.point_counts(frame, "a", "b").collect()
    assert sorted(map(tuple, points)) == [(1, 2.0, 2), (3, 4.0, 1)]
    values = charts.value_counts(frame, "a").collect()
    assert [tuple(row) for row in values] == [(1, 3), (3, 1)]


def test_nan_is_no_value(spark):
    values = [1.0, 2.0, 3.0, 10.0, float("nan"), None, float("nan")]
    plain = [v for v in values if v is not None and v == v]
    with_nan, without = column(spark, values), column(spark, plain)
    assert bins_of(charts.histogram(with_nan, "x")) == bins_of(charts.histogram(without, "x"))
    assert charts.boxplot(with_nan, "x").collect() == charts.boxplot(without, "x").collect()
    found = charts.boxplot_outliers(with_nan, "x").collect()
    assert found == charts.boxplot_outliers(without, "x").collect()
