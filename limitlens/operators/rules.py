"""Control limits, verdict and suppression. The rules are published methods with named parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.config import MAD_SCALE, Settings


def with_control_limits(stats: DataFrame) -> DataFrame:
    """Add ``ucl`` and ``lcl`` by the formula of the spec's behaviour class.

    A: mean +/- 3 deviations; B: median +/- 3 scaled median absolute deviations;
    C: the 0.135 and 99.865 percentiles; D: upper limit only, for sensors that never go below 0.
    """
    pattern, mean, std = F.col("pattern"), F.col("mean"), F.col("std")
    robust = F.lit(3 * MAD_SCALE) * F.col("mad")
    upper = (
        F.when(pattern == "PATTERN_A", mean + 3 * std)
        .when(pattern == "PATTERN_B", F.col("median") + robust)
        .when(pattern == "PATTERN_C", F.col("p_high"))
        .when(pattern == "PATTERN_D", mean + 3 * std)
    )
    lower = (
        F.when(pattern == "PATTERN_A", mean - 3 * std)
        .when(pattern == "PATTERN_B", F.col("median") - robust)
        .when(pattern == "PATTERN_C", F.col("p_low"))
        .when(pattern == "PATTERN_D", F.lit(0.0))
    )
    return stats.withColumn("ucl", upper).withColumn("lcl", lower)


def _threshold(settings: Settings, which: int) -> Column:
    """Threshold of the row's pattern (0 sigma, 1 relative); a literal map needs no join."""
    entries = [
        F.lit(part)
        for pattern, limits in settings.thresholds.items()
        for part in (pattern, float(limits[which]))
    ]
    return F.try_element_at(F.create_map(*entries), F.col("pattern"))


def suppression_reason(settings: Settings, carved_out: Column) -> Column:
    """First reason that applies, or NULL."""
    return (
        F.when(F.col("std").isNull() | (F.col("std") <= settings.min_std), "flatlined")
        .when(F.col("n_points") < settings.few_points_floor, "too_few_points")
        .when(carved_out, "carve_out")
        .when(F.col("upper_spec").isNull() | F.col("lower_spec").isNull(), "no_limits")
    )


def with_verdict(
    stats: DataFrame,
    settings: Settings = Settings(),
    exclusions: DataFrame | None = None,
) -> DataFrame:
    """Add ratios, ``suppress_reason`` and ``cww_fail``.

    A spec fails when its configured window is too loose both against its deviation and
    against its mean. A suppressed spec keeps its row and reason but does not fail.
    """
    joined = stats
    if exclusions is None:
        carved_out = F.lit(False)
    else:
        marked = exclusions.select("spec_id").distinct().withColumn("_excluded", F.lit(True))
        joined = joined.join(marked, "spec_id", "left")
        carved_out = F.coalesce("_excluded", F.lit(False))
    span = F.col("upper_spec") - F.col("lower_spec")
    loose = (F.col("sigma_ratio") > _threshold(settings, 0)) & (
        F.col("relative_ratio") > _threshold(settings, 1)
    )
    judged = (
        joined.withColumn("sigma_ratio", F.try_divide(span, F.col("std")))
        .withColumn("relative_ratio", F.try_divide(span, F.abs("mean")))
        .withColumn("suppress_reason", suppression_reason(settings, carved_out))
        .withColumn(
            "cww_fail", F.when(F.col("suppress_reason").isNull() & loose, 1).otherwise(0)
        )
    )
    return judged.drop("_excluded")
