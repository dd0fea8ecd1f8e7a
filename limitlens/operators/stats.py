"""Statistics per tool and spec with robust outlier rejection.

Groups of ordinary size share one shuffle and one sort: the fences, the survivors' spread
and the final aggregate all run over the same partitioning. Large groups are never brought
together: their rows are written once and go through map-side combined passes, which give
the same numbers.

The rows may also be runs: equal values of a key and day as one row with their number. Runs of
closed days never change, so they can be kept and added to, and the statistics of a moving window need
only the readings of its new days.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from limitlens.config import TAIL_HIGH, TAIL_LOW, Settings
from limitlens.functions.quantiles import large_group_quantiles
from limitlens.operators.heat import Heat, broadcast_if_small, split_by_heat
from limitlens.storage import scratch_table, stored

SPEC = ("eqp_id", "spec_id")
_QUARTILES = (0.25, 0.75)
_SPREAD = (TAIL_LOW, 0.5, TAIL_HIGH)
_VALUE = "param_value"
_TIMES, _NEWEST = "n_values", "newest"


def _doubles(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def usable_readings(readings: DataFrame, keys: Sequence[str] = SPEC) -> DataFrame:
    """Readings with a key and a real number; one NaN would spoil every mean."""
    kept = readings.where(F.col(_VALUE).isNotNull() & ~F.isnan(_VALUE))
    for key in keys:
        kept = kept.where(F.col(key).isNotNull())
    return kept


def _fences(quartiles: Column, k: float) -> list[Column]:
    reach = F.lit(k) * (quartiles[1] - quartiles[0])
    return [
        (quartiles[0] - reach).alias("lower_bound"),
        (quartiles[1] + reach).alias("upper_bound"),
    ]


def outlier_bounds(
    readings: DataFrame, keys: Sequence[str] = SPEC, settings: Settings = Settings()
) -> DataFrame:
    """Tukey fences ``Q1 - k*IQR`` and ``Q3 + k*IQR`` for each key."""
    keys = list(keys)
    values = usable_readings(readings, keys).select(*keys, _VALUE)
    heat = split_by_heat(values, keys, settings.hot_rows, broadcast_rows=settings.broadcast_rows)
    quartiles = heat.cold.groupBy(*keys).agg(
        F.percentile(_VALUE, _doubles(_QUARTILES)).alias("_q")
    )
    if heat.hot is not None:
        quartiles = quartiles.unionByName(
            large_group_quantiles(heat.hot, keys, F.col(_VALUE), _QUARTILES, "_q", heat.side)
        )
    q = F.col("_q")
    return quartiles.select(
        *keys, q[0].alias("q1"), q[1].alias("q3"), *_fences(q, settings.fence_k)
    )


def _newest() -> Column:
    """Order of the readings as one number, time first and then ``reading_id``.

    Unlike a struct, a decimal lets the newest reading be found by a hash aggregate, so the
    readings are not sorted for it.
    """
    micros = F.unix_micros(F.col("act_time").cast("timestamp"))
    first = F.coalesce(micros, F.lit(-(1 << 62))).cast("decimal(19,0)")
    tie = F.coalesce("reading_id", F.lit(-(1 << 63))).cast("decimal(19,0)")
    return (first * F.lit(Decimal(10**19)) + tie).cast("decimal(38,0)")


def _newest_limits(newest: str = "_newest") -> list[Column]:
    """Both limits from the one newest reading."""
    return [F.max_by(limit, newest).alias(limit) for limit in ("upper_spec", "lower_spec")]


def latest_limits(readings: DataFrame, keys: Sequence[str] = SPEC) -> DataFrame:
    """The limits on the newest reading of each key."""
    ordered = readings.withColumn("_newest", _newest())
    return ordered.groupBy(*keys).agg(*_newest_limits())


def value_runs(readings: DataFrame, keys: Sequence[str] = ("d", *SPEC)) -> DataFrame:
    """One row for equal values of a key: how many, and the order and limits of the newest of them.

    Combined on the map side. Runs of different days add up to the runs of all days, so ``spec_stats`` with
    ``runs=True`` gives the same over any number of them. Readings that count for no statistic have no run.
    """
    ordered = usable_readings(readings, keys).withColumn(_NEWEST, _newest())
    return ordered.groupBy(*keys, _VALUE).agg(
        F.count("*").alias(_TIMES), F.max(_NEWEST).alias(_NEWEST), *_newest_limits(_NEWEST)
    )


def _percentile(value: Column | str, probs: Column, runs: bool) -> Column:
    return F.percentile(value, probs, F.col(_TIMES)) if runs else F.percentile(value, probs)


def _aggregate(survivors: DataFrame, keys: list[str], extra: list[Column], runs: bool) -> DataFrame:
    bounds = [F.first(b).alias(b) for b in ("lower_bound", "upper_bound")]
    if not runs:
        return survivors.withColumn("_newest", _newest()).groupBy(*keys).agg(
            F.count("*").alias("n_points"), F.avg(_VALUE).alias("mean"), F.stddev_samp(_VALUE).alias("std"),
            *bounds, *_newest_limits(), *extra,
        )
    # Moments about the middle of the fences: no survivor is further from it than the fences, so nothing cancels.
    middle = F.col("lower_bound") / 2 + F.col("upper_bound") / 2
    off, times = F.col(_VALUE) - middle, F.col(_TIMES)
    summed = survivors.groupBy(*keys).agg(
        F.sum(times).alias("n_points"), F.sum(off * times).alias("_off"), F.sum(off * off * times).alias("_off2"),
        *bounds, *_newest_limits(_NEWEST), *extra,
    )
    n, shift = F.col("n_points"), F.col("_off") / F.col("n_points")
    variance = F.greatest(F.col("_off2") - F.col("_off") * shift, F.lit(0.0)) / F.nullif(n - 1, F.lit(0))
    return summed.withColumns({"mean": middle + shift, "std": F.sqrt(variance)}).drop("_off", "_off2")


def _spread_columns() -> list[Column]:
    s = F.col("_s")
    return [s[0].alias("p_low"), s[1].alias("median"), s[2].alias("p_high")]


def _cold_stats(
    readings: DataFrame, keys: list[str], settings: Settings, spread: bool, wanted: Column, runs: bool
) -> DataFrame:
    group = Window.partitionBy(*keys)
    fenced = readings.withColumn(
        "_q", _percentile(_VALUE, _doubles(_QUARTILES), runs).over(group)
    ).select(*readings.columns, *_fences(F.col("_q"), settings.fence_k))
    survivors = fenced.where(F.col(_VALUE).between(F.col("lower_bound"), F.col("upper_bound")))
    if not spread:
        return _aggregate(survivors, keys, [], runs)
    value = F.when(wanted, F.col(_VALUE))
    survivors = survivors.withColumn("_s", _percentile(value, _doubles(_SPREAD), runs).over(group))
    deviation = F.abs(value - F.col("_s")[1])
    survivors = survivors.withColumn("mad", _percentile(deviation, F.lit(0.5), runs).over(group))
    return _aggregate(survivors, keys, [F.first("_s").alias("_s"), F.first("mad").alias("mad")], runs)


def _hot_stats(
    readings: DataFrame,
    keys: list[str],
    settings: Settings,
    spread: bool,
    wanted: Column,
    heat: Heat,
    root: str,
    runs: bool,
) -> DataFrame:
    value, side, times = F.col(_VALUE), heat.side, F.col(_TIMES) if runs else None
    quartiles = large_group_quantiles(readings, keys, value, _QUARTILES, "_q", side, f"{root}/quartiles", times)
    bounds = quartiles.select(*keys, *_fences(F.col("_q"), settings.fence_k))
    survivors = readings.join(heat.side(bounds), keys).where(
        value.between(F.col("lower_bound"), F.col("upper_bound"))
    )
    stats = _aggregate(survivors, keys, [], runs)
    if not spread:
        return stats
    seen = survivors.where(wanted)
    spreads = large_group_quantiles(seen, keys, value, _SPREAD, "_s", side, f"{root}/spreads", times)
    deviations = seen.join(heat.side(spreads), keys).withColumn(
        "_dev", F.abs(value - F.col("_s")[1])
    )
    mads = large_group_quantiles(deviations, keys, F.col("_dev"), (0.5,), "_m", side, f"{root}/deviations", times)
    return (
        stats.join(heat.side(spreads), keys, "left")
        .join(heat.side(mads), keys, "left")
        .withColumn("mad", F.col("_m")[0])
        .drop("_m")
    )


def spec_stats(
    readings: DataFrame,
    keys: Sequence[str] = SPEC,
    settings: Settings = Settings(),
    spread: bool = False,
    spread_where: Column | None = None,
    suspects: DataFrame | None = None,
    hot_root: str | None = None,
    runs: bool = False,
) -> DataFrame:
    """Count, mean, deviation and variation of the points inside the fences, and the newest limits.

    Keys with fewer than ``min_points`` surviving points are dropped. ``spread`` adds the
    survivors' median, tail quantiles and median absolute deviation; ``spread_where`` limits
    that work to some groups. ``suspects`` (tool ids) limits the size profile to tools that
    can hold a large spec; an empty frame means that no reading is scanned for it. Rows of large
    specs are kept at ``hot_root`` (default: a new scratch table) until the result has been used.
    With ``runs`` the rows are those of :func:`value_runs` instead of readings.
    """
    keys = list(keys)
    wanted = F.lit(True) if spread_where is None else spread_where
    needed = usable_readings(readings, keys).select(
        *keys, _VALUE, *((_TIMES, _NEWEST) if runs else ("act_time", "reading_id")), "upper_spec", "lower_spec",
        *([] if suspects is None or "eqp_id" in keys else ["eqp_id"]),
    )
    if suspects is None:
        heat = split_by_heat(needed, keys, settings.hot_rows, broadcast_rows=settings.broadcast_rows)
    elif suspects.isEmpty():
        heat = Heat(needed, None, 0)
    else:
        few = broadcast_if_small(suspects, settings.broadcast_rows)
        heat = split_by_heat(
            needed, keys, settings.hot_rows, needed.join(few, "eqp_id", "left_semi"), settings.broadcast_rows
        )
    cold = heat.cold

    stats = _cold_stats(cold, keys, settings, spread, wanted, runs)
    if heat.hot is not None:
        path = hot_root or scratch_table(readings.sparkSession, "hot_rows")
        hot = stored(heat.hot.select(*cold.columns), f"{path}/rows")
        stats = stats.unionByName(_hot_stats(hot, keys, settings, spread, wanted, heat, path, runs))
    return stats.where(F.col("n_points") >= settings.min_points).select(
        *keys,
        "n_points",
        "mean",
        "std",
        F.try_divide("std", "mean").alias("cv"),
        "lower_bound",
        "upper_bound",
        "upper_spec",
        "lower_spec",
        *([*_spread_columns(), F.col("mad")] if spread else []),
    )
