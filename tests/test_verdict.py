"""Rules, suppression, confirmation."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from limitlens.config import Settings
from limitlens.operators import rules, verdict
from limitlens.operators.rules import with_control_limits, with_verdict

COLUMNS = (
    "spec_id STRING, pattern STRING, n_points BIGINT, mean DOUBLE, std DOUBLE, median DOUBLE, "
    "mad DOUBLE, p_low DOUBLE, p_high DOUBLE, upper_spec DOUBLE, lower_spec DOUBLE"
)


def stat(spark, pattern="PATTERN_A", n=10, mean=10.0, std=1.0, upper=100.0):
    row = ("s", pattern, n, mean, std, 9.0, 2.0, 5.0, 15.0, upper, 0.0)
    return spark.createDataFrame([row], COLUMNS)


@pytest.mark.parametrize(
    ("pattern", "ucl", "lcl"),
    [
        ("PATTERN_A", 13.0, 7.0),
        ("PATTERN_B", 9 + 3 * 1.4826 * 2, 9 - 3 * 1.4826 * 2),
        ("PATTERN_C", 15.0, 5.0),
        ("PATTERN_D", 13.0, 0.0),
    ],
)
def test_control_limits(spark, pattern, ucl, lcl):
    (row,) = with_control_limits(stat(spark, pattern)).collect()
    assert (row.ucl, row.lcl) == pytest.approx((ucl, lcl))


def test_fails_only_when_loose_in_both_ways(spark):
    def fail(**facts):
        return with_verdict(stat(spark, **facts)).first().cww_fail

    assert fail() == 1  # 100 deviations, 10 means
    assert fail(mean=50.0) == 0  # 100 deviations, 2 means
    assert fail(std=30.0) == 0  # 3.3 deviations, 10 means
    assert fail(upper=None) == 0
    assert fail(pattern="PATTERN_X") == 0  # no threshold, no verdict


def test_threshold_is_strict(spark):
    assert with_verdict(stat(spark, std=25.0)).first().cww_fail == 0  # exactly 4 deviations


def test_suppression_order(spark):
    settings = Settings(few_points_floor=8, min_std=0.5)
    excluded = spark.createDataFrame([("s",), ("s",)], "spec_id STRING")

    def reason(excl=None, **facts):
        row = with_verdict(stat(spark, **facts), settings, excl).collect()
        assert len(row) == 1
        return row[0].suppress_reason, row[0].cww_fail

    assert reason() == (None, 1)
    assert reason(std=0.5) == ("flatlined", 0)
    assert reason(std=None) == ("flatlined", 0)
    assert reason(n=7) == ("too_few_points", 0)
    assert reason(excl=excluded) == ("carve_out", 0)
    assert reason(excl=excluded, n=7, std=0.1) == ("flatlined", 0)


@pytest.fixture
def current(spark):
    rows = [("both", 1), ("new", 1), ("gone", 0), ("unknown", None), ("nullprior", 1)]
    return spark.createDataFrame([("e", *r) for r in rows], "eqp_id STRING, spec_id STRING, cww_fail INT")


def flags(df):
    return {r.spec_id: (r.pww_fail, r.fail) for r in df.collect()}


def test_confirmation(spark, current):
    rows = [("e", "both", 1), ("e", "new", 0), ("e", "gone", 1), ("e", "nullprior", None), ("other", "new", 1)]
    prior = spark.createDataFrame(rows, "eqp_id STRING, spec_id STRING, fail_flag INT")
    assert flags(verdict.confirm(current, prior)) == {
        "both": (1, 1),
        "new": (0, 0),
        "gone": (1, 0),
        "unknown": (0, None),
        "nullprior": (0, 0),
    }


def test_no_prior_week(spark, current):
    empty = spark.createDataFrame([], "eqp_id STRING, spec_id STRING, fail_flag INT")
    assert flags(verdict.confirm(current, None)) == flags(verdict.confirm(current, empty))
    assert all(pww == 0 for pww, _ in flags(verdict.confirm(current, None)).values())


def test_prior_flags_are_unique(spark):
    rows = [("e", "a", 0), ("e", "a", 1), ("f", "a", 0), ("e", "b", 0), ("e", "c", None)]
    prior = verdict.prior_flags(spark.createDataFrame(rows, "eqp_id STRING, spec_id STRING, cww_fail INT"))
    found = {(r.eqp_id, r.spec_id): r.fail_flag for r in prior.collect()}
    assert found == {("e", "a"): 1, ("f", "a"): 0, ("e", "b"): 0, ("e", "c"): None}


def test_catalog_join_does_not_multiply(make_readings, make_catalog):
    readings = make_readings([("e", "s", float(i), f"2024-01-01T00:00:{i:02d}") for i in range(9)])
    catalog = make_catalog(
        [("e", "s", "PATTERN_A", "G1", "U1"), ("e", "s", "PATTERN_A", "G1", "U2"),
         ("e", "other", "PATTERN_A", "G1", "U1")]
    )
    (row,) = verdict.calculations(readings, catalog).collect()
    assert row.n_points == 9 and row.eqp_id == "e"


def weekly_inputs(make_readings, make_catalog):
    rows = []
    for spec, days, value in [
        ("both", range(1, 30), 10.0), ("now", range(24, 31), 10.0), ("then", range(1, 8), 10.0)
    ]:
        for day in days:
            for hour in range(2):
                rows.append(("e", spec, value + hour + day / 100, f"2024-01-{day:02d}T0{hour}:00:00"))
    catalog = make_catalog([("e", s, "PATTERN_A", "G1", "U1") for s in ("both", "now", "then")])
    return make_readings(rows), catalog


WINDOWS = {0: ("2024-01-08", "2024-01-30"), 1: ("2024-01-01", "2024-01-23")}


def test_weekly_report(make_readings, make_catalog):
    readings, catalog = weekly_inputs(make_readings, make_catalog)
    found = verdict.weekly_report(readings, catalog, WINDOWS).collect()
    assert {r.spec_id: (r.cww_fail, r.pww_fail, r.fail) for r in found} == {
        "both": (1, 1, 1), "now": (1, 0, 0),
    }


def test_one_pass_equals_two(make_readings, make_catalog):
    """Both windows at once give what each window gives alone."""
    readings, catalog = weekly_inputs(make_readings, make_catalog)

    def alone(window):
        first, last = WINDOWS[window]
        return verdict.calculations(readings.where(F.col("d").between(first, last)), catalog)

    two = verdict.confirm(alone(0), verdict.prior_flags(alone(1)))
    once = verdict.weekly_report(readings, catalog, WINDOWS)
    names = once.columns
    assert sorted(two.select(names).collect()) == sorted(once.collect())


def test_fail_implies_current_fail(spark):
    from limitlens.queries.registry import QUERIES

    report = QUERIES["weekly_report"](spark, "/root/testdata/sf0.001")
    counts = {(r.cww_fail, r.pww_fail): r["count"] for r in report.groupBy("cww_fail", "pww_fail").count().collect()}
    assert counts == {(0, 0): 13, (0, 1): 12, (1, 0): 10, (1, 1): 11}
    assert report.where("fail = 1 and cww_fail <> 1").isEmpty()


def test_large_groups_do_not_change_the_report(spark):
    from limitlens.queries import fixtures as fx

    catalog = fx.graded(fx.registrations(spark, "/root/testdata/sf0.001"))
    readings = fx.readings(spark, "/root/testdata/sf0.001")

    def report(settings):
        found = verdict.weekly_report(readings, catalog, fx.WINDOWS, settings).collect()
        return {r.spec_id: (r.n_points, round(r.ucl, 8), r.suppress_reason, r.fail) for r in found}

    assert report(replace(fx.SETTINGS, hot_rows=6)) == report(fx.SETTINGS)


def test_missing_limits_are_a_reason_not_a_pass(spark):
    row = ("s", "PATTERN_A", 9, 10.0, 1.0, None, 1.0)
    stats = spark.createDataFrame(
        [row], "spec_id STRING, pattern STRING, n_points BIGINT, mean DOUBLE, std DOUBLE, upper_spec DOUBLE, lower_spec DOUBLE"
    )
    found = rules.with_verdict(stats).first()
    assert (found.suppress_reason, found.cww_fail) == ("no_limits", 0)
