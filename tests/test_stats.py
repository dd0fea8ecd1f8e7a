"""Fences, statistics and newest limits: edge cases, and large groups against plain ones."""

import math
import random
import statistics
from dataclasses import replace
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from limitlens.config import Settings
from limitlens.functions.quantiles import large_group_quantiles
from limitlens.operators import heat, stats

ALL = Settings(min_points=1)


def one(df):
    (row,) = df.collect()
    return row


def series(make_readings, values, spec="s"):
    return make_readings(
        [("e", spec, v, f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}") for i, v in enumerate(values)]
    )


def test_outlier_is_rejected(make_readings):
    row = one(stats.spec_stats(series(make_readings, [1.0, 2.0, 3.0, 4.0, 1000.0]), settings=ALL))
    assert row.n_points == 4 and row.mean == 2.5
    assert (row.lower_bound, row.upper_bound) == (-1.0, 7.0)


def test_fences_include_their_ends(make_readings):
    # Quartiles 1 and 2 give fences -0.5 and 3.5.
    row = one(stats.spec_stats(series(make_readings, [1.0, 1.0, 1.0, 2.0, 3.5]), settings=ALL))
    assert row.n_points == 5 and row.upper_bound == 3.5


def test_one_point_has_no_deviation(make_readings):
    row = one(stats.spec_stats(series(make_readings, [5.0]), settings=ALL))
    assert (row.n_points, row.mean, row["std"], row.cv) == (1, 5.0, None, None)


def test_mean_zero_has_no_variation(make_readings):
    row = one(stats.spec_stats(series(make_readings, [-1.0, 0.0, 1.0]), settings=ALL))
    assert row["std"] == 1.0 and row.cv is None


def test_null_and_nan_values_are_left_out(make_readings):
    row = one(stats.spec_stats(series(make_readings, [1.0, None, float("nan"), 3.0]), settings=ALL))
    assert (row.n_points, row.mean) == (2, 2.0) and not math.isnan(row["std"])


def test_too_few_points_drop_the_spec(make_readings):
    readings = series(make_readings, [1.0, 2.0, 3.0])
    assert stats.spec_stats(readings, settings=Settings(min_points=4)).isEmpty()
    assert not stats.spec_stats(readings, settings=Settings(min_points=3)).isEmpty()


def test_empty_window(make_readings):
    assert stats.spec_stats(make_readings([]), settings=ALL).isEmpty()
    assert stats.outlier_bounds(make_readings([])).isEmpty()


def test_newest_limits_come_from_one_reading(make_readings):
    readings = make_readings(
        [
            ("e", "s", 1.0, "2024-01-02T00:00:00", 7.0, 1),
            ("e", "s", 1.0, "2024-01-03T00:00:00", 9.0, 2),
            ("e", "s", 1.0, "2024-01-03T00:00:00", 8.0, 3),
            ("e", "s", 1.0, "2024-01-01T00:00:00", 5.0, 4),
        ]
    )
    assert one(stats.latest_limits(readings)).upper_spec == 8.0
    assert one(stats.spec_stats(readings, settings=ALL)).upper_spec == 8.0


def test_spread_matches_numpy(make_readings):
    rng = random.Random(7)
    values = [rng.gauss(50, 5) for _ in range(200)]
    row = one(stats.spec_stats(series(make_readings, values), settings=ALL, spread=True))
    kept = np.array([v for v in values if row.lower_bound <= v <= row.upper_bound])
    assert row.n_points == len(kept)
    assert row.median == pytest.approx(np.median(kept))
    assert row.mad == pytest.approx(np.median(np.abs(kept - np.median(kept))))
    assert row.p_low == pytest.approx(np.quantile(kept, 0.00135))
    assert row.p_high == pytest.approx(np.quantile(kept, 0.99865))
    assert row["std"] == pytest.approx(kept.std(ddof=1))


@pytest.fixture
def skewed(make_readings):
    """One spec holds most rows; values repeat, and the extremes are far out."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        spec = "hot" if rng.random() < 0.6 else f"s{rng.randrange(40)}"
        value = rng.choice([round(rng.gauss(20, 3), 1), round(rng.gauss(20, 3), 6), 20.0, 1e9, -1e9])
        rows.append(("e", spec, value, f"2024-01-{1 + i % 28:02d}T00:00:{i % 60:02d}", float(i % 7)))
    return make_readings(rows)


@pytest.mark.parametrize("hot_rows", [0, 40, 200])
def test_large_groups_give_the_same_numbers(skewed, hot_rows):
    def table(settings, **more):
        found = stats.spec_stats(skewed, settings=settings, spread=True, **more).collect()
        return {r.spec_id: r.asDict() for r in found}

    plain, split = table(ALL), table(replace(ALL, hot_rows=hot_rows))
    assert plain.keys() == split.keys() and len(plain) == 41
    for spec, row in plain.items():
        for name, value in row.items():
            other = split[spec][name]
            assert other == value or other == pytest.approx(value, rel=1e-12), (spec, name)


@pytest.mark.parametrize("limit", [0, 1000])
def test_many_large_groups(skewed, monkeypatch, limit):
    """Keys of large groups as a table, with and without a broadcast of it."""
    monkeypatch.setattr(heat, "MAX_LISTED_GROUPS", 2)
    assert heat.split_by_heat(skewed, ["spec_id"], 20, broadcast_rows=limit).few == (limit > 0)
    split = stats.spec_stats(skewed, settings=replace(ALL, hot_rows=20, broadcast_rows=limit), spread=True).collect()
    plain = stats.spec_stats(skewed, settings=ALL, spread=True).collect()
    assert {(r.spec_id, r.n_points, r.median, r.mad, r.upper_spec) for r in split} == {
        (r.spec_id, r.n_points, r.median, r.mad, r.upper_spec) for r in plain
    }


def test_the_way_a_group_goes_does_not_change_it(make_readings, spark):
    """One spec on a tool with many and on one with few readings: two rows, however they are split."""
    rows = [("big", "s", float(i % 10), f"2024-01-01T00:{i % 60:02d}:00") for i in range(60)]
    rows += [("small", "s", 50.0 + i % 10, f"2024-01-01T01:{i % 60:02d}:00") for i in range(30)]
    readings = make_readings(rows)
    suspects = spark.createDataFrame([("big",)], "eqp_id STRING")
    for settings, among in ((ALL, None), (replace(ALL, hot_rows=50), suspects), (replace(ALL, hot_rows=0), None)):
        found = stats.spec_stats(readings, settings=settings, spread=True, suspects=among).collect()
        assert {(r.eqp_id, r.n_points, round(r.mean, 9), r.median) for r in found} == {
            ("big", 60, 4.5, 4.5), ("small", 30, 54.5, 54.5)
        }


def test_the_newest_reading_is_found_by_hashing(make_readings):
    readings = make_readings([("e", "s", 1.0, "2024-01-01T00:00:00", 5.0, 1), ("e", "s", 1.0, "2024-01-01T00:00:00", 7.0, 2)])
    found = stats.latest_limits(readings)
    assert found.first().upper_spec == 7.0
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_large_group_bounds(skewed):
    plain = {r.spec_id: r for r in stats.outlier_bounds(skewed).collect()}
    split = stats.outlier_bounds(skewed, settings=replace(ALL, hot_rows=100)).collect()
    assert {r.spec_id: r for r in split} == plain


def test_suspects_limit_the_profile(skewed, spark):
    settings = replace(ALL, hot_rows=200)
    plain = sorted(stats.spec_stats(skewed, settings=ALL).collect())
    nobody = spark.createDataFrame([], "eqp_id STRING")
    everyone = spark.createDataFrame([("e",)], "eqp_id STRING")
    assert sorted(stats.spec_stats(skewed, settings=settings, suspects=nobody).collect()) == plain
    found = sorted(stats.spec_stats(skewed, settings=settings, suspects=everyone).collect())
    assert [r.spec_id for r in found] == [r.spec_id for r in plain]
    assert [r.mean for r in found] == pytest.approx([r.mean for r in plain])


def test_row_order_and_partitions_do_not_matter(skewed):
    def table(df):
        found = stats.spec_stats(df, settings=ALL, spread=True)
        return sorted(
            tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in found.collect()
        )

    assert table(skewed) == table(skewed.repartition(5).orderBy(F.rand(1)))


_RNG = random.Random(4)
VALUES = {
    "mixed": lambda i: _RNG.choice([_RNG.random(), 0.5, -3.0]),
    "all equal": lambda i: 7.25,
    "two values": lambda i: float(i % 2),
    "sorted": lambda i: float(i),
    "sorted down": lambda i: -float(i),
    "nearly all equal": lambda i: 1e300 if i == 1999 else -0.0,
    "infinite": lambda i: float("inf") if i % 3 else float("-inf"),
}


@pytest.mark.parametrize("kind", VALUES)
def test_quantiles_equal_percentile(spark, kind):
    rows = [(k, VALUES[kind](i)) for k in ("a", "b") for i in range(2000)]
    rows += [("c", 1.0)] * 1001 + [("d", 2.0), ("d", None), ("e", None), ("f", 1.0), ("f", 4.0)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(7)
    probs = (0.0, 0.00135, 0.25, 0.5, 0.75, 0.99865, 1.0)
    found = large_group_quantiles(df, ["k"], F.col("v"), probs, "q")
    plain = df.where("v is not null").groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q"))
    texts = lambda df: {r.k: [str(x + 0.0) for x in r.q] for r in df.collect()}  # noqa: E731  NaN equals itself, -0.0 is 0.0
    assert texts(found) == texts(plain)


def test_quantiles_gather_no_group(spark):
    """Ranks are found by counts of partitions: no sketch, no error bound, no window over a whole group's values."""
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    plan = large_group_quantiles(df, ["k"], F.col("v"), (0.5,), "q")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "raise_error" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line and "_v#" in line.split("windowspecdefinition", 1)[1]]
    assert windows and all("_p#" in line.split("specifiedwindowframe")[0] for line in windows)


def test_heat_lists_only_large_groups(skewed):
    found = heat.split_by_heat(skewed, ["spec_id"], 500)
    assert [r.spec_id for r in found.hot.select("spec_id").distinct().collect()] == ["hot"]
    assert found.hot.count() + found.cold.count() == skewed.count()
    assert heat.split_by_heat(skewed, ["spec_id"], 10_000).hot is None


def test_one_shuffle_for_ordinary_groups(skewed):
    """Fences, spread and aggregate share one exchange and one sort of the readings."""
    df = stats.spec_stats(skewed, settings=ALL, spread=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "Python" not in plan


# --- runs of equal values -----------------------------------------------------------------


def close(found, wanted, *columns):
    found, wanted = ({(r.eqp_id, r.spec_id): r for r in df.collect()} for df in (found, wanted))
    assert found.keys() == wanted.keys()
    for key, row in wanted.items():
        for c in columns:
            assert found[key][c] == (row[c] if row[c] is None else pytest.approx(row[c], rel=1e-9, abs=1e-9)), (key, c)


ALL_STATS = ("n_points", "mean", "std", "cv", "lower_bound", "upper_bound", "upper_spec", "lower_spec", "p_low", "median", "p_high", "mad")


@pytest.mark.parametrize("hot_rows", [10**6, 40])
def test_runs_give_the_same_as_readings(make_readings, hot_rows):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        spec = "big" if i % 3 else f"s{i % 7}"
        value = rng.choice([1e4 + rng.randint(0, 9), rng.gauss(1e4, 2.0)]) if spec == "big" else float(rng.randint(0, 4))
        rows.append(("e", spec, value, f"2024-01-{1 + i % 5:02d}T00:{i // 60:02d}:{i % 60:02d}", 90.0 + i % 11, i))
    readings = make_readings(rows)
    settings = replace(ALL, hot_rows=hot_rows)
    wanted = stats.spec_stats(readings, settings=settings, spread=True)
    runs = stats.value_runs(readings)
    assert runs.count() < readings.count()
    close(stats.spec_stats(runs, settings=settings, spread=True, runs=True), wanted, *ALL_STATS)


def test_deviation_of_runs_far_from_zero(make_readings):
    """Moments about the middle of the fences keep the digits that sums of squares would lose."""
    rng = random.Random(5)
    values = [round(rng.uniform(1e9, 1e9 + 9), 2) for _ in range(500)]
    runs = stats.value_runs(series(make_readings, values))
    row = one(stats.spec_stats(runs, settings=ALL, runs=True))
    assert row.n_points == 500
    assert row["std"] == pytest.approx(statistics.stdev(map(Fraction, values)), rel=1e-12)
    assert row.mean == pytest.approx(statistics.fmean(values), rel=1e-15)


def test_runs_of_odd_values(make_readings):
    at = "2024-01-01T00:00:0"
    readings = make_readings([
        ("e", "equal", 0.1, at + "1"), ("e", "equal", 0.1, at + "2"), ("e", "equal", 0.1, at + "3"),
        ("e", "one", 5.0, at + "1"), ("e", "zero", -1.0, at + "1"), ("e", "zero", 1.0, at + "2"),
        ("e", "none", None, at + "1"), ("e", "none", float("nan"), at + "2"),
        ("e", "signs", 0.0, at + "1"), ("e", "signs", -0.0, at + "2"), (None, "signs", 1.0, at + "1"),
    ])
    runs = stats.value_runs(readings)
    assert {r.n_values for r in runs.where("spec_id in ('equal', 'signs')").collect()} == {2, 3}
    wanted = stats.spec_stats(readings, settings=ALL, spread=True)
    found = stats.spec_stats(runs, settings=ALL, spread=True, runs=True)
    close(found, wanted, *ALL_STATS)
    assert {r.spec_id: r["std"] for r in found.collect()} == {"equal": 0.0, "one": None, "zero": pytest.approx(2**0.5), "signs": 0.0}
    assert stats.spec_stats(stats.value_runs(make_readings([])), settings=ALL, runs=True).isEmpty()


def test_runs_are_combined_before_the_shuffle(skewed):
    plan = stats.value_runs(skewed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_one_shuffle_for_runs(skewed):
    found = stats.value_runs(skewed)
    runs = skewed.sparkSession.createDataFrame(found.collect(), found.schema)
    plan = stats.spec_stats(runs, settings=ALL, spread=True, runs=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
