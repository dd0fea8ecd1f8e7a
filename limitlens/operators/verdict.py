"""From readings to verdicts, and the confirmation against the week before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.config import Settings
from limitlens.operators.catalog import distinct_specs
from limitlens.operators.rules import with_control_limits, with_verdict
from limitlens.operators.stats import SPEC, spec_stats

# Window ids are numbers: they travel with every shuffled reading.
CURRENT, PRIOR = 0, 1

REPORT_DETAILS = (
    "pattern", "grade", "n_points", "mean", "std", "cv", "upper_spec", "lower_spec",
    "ucl", "lcl", "sigma_ratio", "relative_ratio", "suppress_reason", "cww_fail",
)


def calculations(
    readings: DataFrame,
    catalog: DataFrame,
    settings: Settings = Settings(),
    keys: Sequence[str] = SPEC,
    exclusions: DataFrame | None = None,
    spread_where: Column | None = None,
    suspects: DataFrame | None = None,
    hot_root: str | None = None,
    runs: bool = False,
) -> DataFrame:
    """Statistics, catalog join, control limits and verdict for every tool and spec at once.

    The catalog is cut to one row per tool and spec first, so the join cannot multiply rows. A
    spec that several tools read has a verdict for each. ``readings`` may be runs of equal values.
    """
    stats = spec_stats(
        readings,
        keys,
        settings,
        spread=True,
        spread_where=spread_where,
        suspects=suspects,
        hot_root=hot_root,
        runs=runs,
    )
    supported = catalog.where(F.col("pattern").isin(*settings.patterns))
    specs = distinct_specs(
        supported.select("eqp_id", "spec_id", "pattern", "grade"), (), SPEC
    )
    return with_verdict(with_control_limits(stats.join(specs, list(SPEC))), settings, exclusions)


def in_windows(readings: DataFrame, windows: Mapping[int, tuple[str, str]], day: str = "d") -> DataFrame:
    """Tag each reading with every inclusive (first, last) date window that holds it.

    One scan and one shuffle then serve all windows; the date range reaches the scan.
    """
    first = min(start for start, _ in windows.values())
    last = max(end for _, end in windows.values())
    tags = F.array(
        *[
            F.when(
                F.col(day).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))), F.lit(name)
            )
            for name, (start, end) in windows.items()
        ]
    )
    return (
        readings.where(F.col(day).between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
        .withColumn("window_id", F.explode(F.array_compact(tags)))
    )


def prior_flags(verdicts: DataFrame) -> DataFrame:
    """One flag per tool and spec from an earlier week's verdicts; repeated ones take the worst."""
    return verdicts.groupBy(*SPEC).agg(F.max("cww_fail").cast("int").alias("fail_flag"))


def _confirmed() -> Column:
    # A fail counts as the week before did; anything else stays what it is.
    return F.when(F.col("cww_fail") == 1, F.col("pww_fail")).otherwise(F.col("cww_fail"))


def confirm(current: DataFrame, prior: DataFrame | None) -> DataFrame:
    """Add ``pww_fail`` and ``fail``: a first-time failure is not reported yet."""
    if prior is None:
        flagged = current.withColumn("pww_fail", F.lit(0))
    else:
        flagged = (
            current.join(prior.select(*SPEC, "fail_flag"), list(SPEC), "left")
            .withColumn("pww_fail", F.coalesce("fail_flag", F.lit(0)))
            .drop("fail_flag")
        )
    return flagged.withColumn("fail", _confirmed())


def confirm_windows(verdicts: DataFrame) -> DataFrame:
    """As ``confirm``, for verdicts that carry ``window_id``, from one pass."""
    now = F.col("window_id") == CURRENT
    paired = verdicts.groupBy(*SPEC).agg(
        F.max(F.when(now, F.struct(*REPORT_DETAILS))).alias("_now"),
        F.coalesce(F.max(F.when(~now, F.col("cww_fail"))), F.lit(0)).alias("pww_fail"),
    )
    return (
        paired.where(F.col("_now").isNotNull())
        .select(*SPEC, "_now.*", "pww_fail")
        .withColumn("fail", _confirmed())
    )


def tool_status(catalog: DataFrame, readings: DataFrame, verdicts: DataFrame) -> DataFrame:
    """What came of each catalog tool: ``calculated``, ``no calculations`` or ``no data``."""
    tools = catalog.select("eqp_id").distinct()
    sizes = readings.groupBy("eqp_id").agg(F.count("*").alias("rows"))
    done = verdicts.groupBy("eqp_id").agg(F.count("*").alias("specs"))
    return (
        tools.join(sizes, "eqp_id", "left")
        .join(done, "eqp_id", "left")
        .fillna(0, ["rows", "specs"])
        .withColumn(
            "status",
            F.when(F.col("rows") == 0, "no data")
            .when(F.col("specs") == 0, "no calculations")
            .otherwise("calculated"),
        )
    )


def weekly_report(
    readings: DataFrame,
    catalog: DataFrame,
    windows: Mapping[int, tuple[str, str]],
    settings: Settings = Settings(),
    exclusions: DataFrame | None = None,
) -> DataFrame:
    """Current verdicts confirmed against the prior window, both from one pass over the readings."""
    tagged = in_windows(readings, windows)
    verdicts = calculations(
        tagged,
        catalog,
        settings,
        keys=("window_id", *SPEC),
        exclusions=exclusions,
        spread_where=F.col("window_id") == CURRENT,
    )
    return confirm_windows(verdicts)
