"""Catalog assembly, profiles and work units."""

from dataclasses import replace
from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from limitlens import schemas
from limitlens.config import Settings
from limitlens.operators import catalog as cat
from limitlens.operators import profile, run_log
from limitlens.plans import spec_stage
from limitlens.sinks.tables import write_catalog
from limitlens.sources.catalog import load_sources, scan_catalog
from limitlens.sources.readings import readings_filtered, tool_window_scan

RUN = F.lit
SETTINGS = Settings(excluded_areas=("TRANSPORT",))
DAY = date(2024, 1, 30)


@pytest.fixture
def sources(spark):
    old, new = date(2023, 12, 30), date(2024, 1, 20)
    limit = lambda p, e, s, u="U1", used=new, n=3, hi="10", flag="fixed": (p, e, s, u, hi, "1", "F", flag, used, n)
    return cat.CatalogSources(
        parameters=spark.createDataFrame(
            [(1, "u", "Gas Flow", "G1"), (2, "u", "rf-power", "G5"), (3, "u", "Temp", "G2"), (4, "u", "Vent", "G2")],
            schemas.PARAMETERS,
        ),
        limits=spark.createDataFrame(
            [
                limit(1, "a", "s1", "U1", date(2024, 1, 10)),
                limit(1, "a", "s1", "U2", new, hi="20"),
                limit(1, "t", "s2"),  # transport tool
                limit(2, "a", "s3"),  # lowest grade
                limit(3, "a", "s4", used=old),  # not used recently
                limit(3, "a", "s5", n=0),  # never used
                limit(3, "a", "s6", hi="n/a"),
                limit(3, "a", "s7", flag="auto"),
                limit(4, "a", "s8"),  # unsupported pattern
                limit(3, "nowhere", "s9"),  # no such tool
                limit(3, "b", "s10", used=date(2023, 12, 31)),  # oldest day that counts
            ],
            schemas.SPEC_LIMITS,
        ),
        tool_config=spark.createDataFrame([("a", "ETCH", "M"), ("b", "ETCH", "M"), ("t", "TRANSPORT", "M")], schemas.TOOL_CONFIG),
        equipment_names=spark.createDataFrame([("a", "Tool A")], schemas.EQUIPMENT_NAMES),
        pattern_definitions=spark.createDataFrame(
            [("GAS_FLOW", 1), ("rf power", 2), (" temp ", 3), ("vent", 9)], schemas.PATTERN_DEFINITIONS
        ),
        overrides=spark.createDataFrame([(1, "PATTERN_D"), (77, "PATTERN_B")], schemas.PATTERN_OVERRIDES),
    )


def test_assembly(sources):
    found = {r.spec_id: r for r in cat.assemble_catalog(sources, F.lit(DAY), SETTINGS).collect()}
    assert found.keys() == {"s1", "s6", "s7", "s10"}
    assert (found["s1"].process_unit, found["s1"].upper_text) == ("U2", "20")  # the newer registration
    assert (found["s1"].pattern, found["s6"].pattern) == ("PATTERN_D", "PATTERN_C")
    assert (found["s1"].eqp_name, found["s10"].eqp_name) == ("Tool A", None)


def test_no_overrides_is_no_change(sources, spark):
    from dataclasses import replace

    for overrides in (None, spark.createDataFrame([], schemas.PATTERN_OVERRIDES)):
        found = cat.assemble_catalog(replace(sources, overrides=overrides), F.lit(DAY), SETTINGS)
        assert found.where("spec_id = 's1'").first().pattern == "PATTERN_A"


def test_split_and_union(sources):
    found = {r.spec_id: r for r in spec_stage.build(sources, F.lit(DAY), "now", SETTINGS).collect()}
    assert (found["s1"].type, found["s1"].tolerance, found["s1"].upper_spec) == ("fixed", 1, 20.0)
    assert (found["s6"].tolerance, found["s6"].upper_spec, found["s6"].lower_spec) == (0, None, 1.0)
    assert (found["s7"].type, found["s7"].tolerance, found["s7"].upper_spec) == ("auto", 0, None)
    assert {r.script_run_time for r in found.values()} == {"now"}


def test_publish_and_scan(sources, spark, tmp_path):
    root = str(tmp_path / "catalog")
    assert scan_catalog(spark, root).isEmpty()
    for _ in range(2):  # a second run replaces the first
        spec_stage.run(sources, root, F.lit(DAY), "now", SETTINGS)
    scan = scan_catalog(spark, root)
    assert {r.spec_id for r in scan.collect()} == {"s1", "s6", "s10"}
    assert {r.spec_id for r in scan_catalog(spark, root, "auto").collect()} == {"s7"}
    plan = scan.select("spec_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<spec_id:string>" in plan
    catalog = cat.assemble_catalog(sources, F.lit(DAY), SETTINGS)
    write_catalog(cat.auto_catalog(catalog), root)  # a type without specs is emptied
    assert scan_catalog(spark, root).isEmpty() and scan_catalog(spark, root, "auto").count() == 1
    fixed, auto = cat.fixed_catalog(catalog), cat.auto_catalog(catalog)
    two, one = cat.union_catalogs(fixed, auto, "now"), cat.typed_catalog(catalog, "now")
    assert sorted(map(str, two.select(one.columns).collect())) == sorted(map(str, one.collect()))


def test_a_registration_that_does_not_count_hides_no_other(sources, spark):
    """The newest registration is on an unknown tool; an older one counts."""
    first = sources.limits.where("spec_id = 's1'")
    newer = first.withColumn("eqp_id", F.lit("nowhere")).withColumn("last_used", F.date_add("last_used", 1))
    twice = replace(
        sources,
        limits=sources.limits.unionByName(newer),
        tool_config=sources.tool_config.unionByName(sources.tool_config.withColumn("model", F.lit("A second one"))),
        equipment_names=sources.equipment_names.unionByName(sources.equipment_names),
    )
    found = cat.assemble_catalog(twice, F.lit(DAY), SETTINGS)
    assert sorted(r.spec_id for r in found.collect()) == sorted(
        r.spec_id for r in cat.assemble_catalog(sources, F.lit(DAY), SETTINGS).collect()
    )


def test_load_sources(sources, spark, tmp_path):
    paths = {}
    for name in ("parameters", "limits", "tool_config", "equipment_names", "pattern_definitions"):
        paths[name] = str(tmp_path / name)
        getattr(sources, name).write.parquet(paths[name])
    paths["overrides"] = str(tmp_path / "nowhere")
    loaded = load_sources(spark, paths)
    assert loaded.overrides.isEmpty()
    found = cat.assemble_catalog(loaded, F.lit(DAY), SETTINGS)
    assert {r.spec_id for r in found.collect()} == {"s1", "s6", "s7", "s10"}


def test_distinct_specs_is_deterministic(make_catalog):
    rows = [("e", "s", "PATTERN_A", "G1", f"U{i}") for i in range(9)] + [("e", "t", "PATTERN_B", "G1", "U1")]
    catalog = make_catalog(rows)
    for df in (catalog, catalog.repartition(4)):
        assert rows_of(cat.distinct_specs(df, latest_first=("process_unit",))) == [
            ("e", "s", "PATTERN_A", "G1", "U8"), ("e", "t", "PATTERN_B", "G1", "U1"),
        ]


def test_technode(spark):
    plans = spark.createDataFrame([(1, 10), (2, 99)], "id INT, plan INT")
    nodes = spark.createDataFrame([(10, "N7")], "p INT, node STRING")
    assert rows_of(cat.with_technode(plans, nodes, "plan", "p").select("id", "node")) == [(1, "N7"), (2, None)]


# --- profiles -----------------------------------------------------------------------------


def test_specs_by_tool_has_one_row_per_tool(make_catalog):
    catalog = make_catalog([("big", f"s{i}", "P", "G1", u) for i in range(50) for u in "xy"] + [("one", "s", "P", "G1", "x")])
    whole = {r.eqp_id: r for r in profile.specs_by_tool(catalog).collect()}
    assert whole["big"].n_specs == 50 and whole["one"].spec_ids == ["s"]
    assert whole["big"].spec_ids == sorted(f"s{i}" for i in range(50)) and len(whole) == 2


@pytest.mark.parametrize(("n", "chunks"), [(1, 3), (5, 3), (6, 3), (700, 20), (19, 20)])
def test_chunks_are_near_equal(spark, make_catalog, n, chunks):
    import numpy as np

    catalog = make_catalog([("big", f"s{i}", "P", "G1", "x") for i in range(n)] + [("small", "t", "P", "G1", "x")])
    sizes = spark.createDataFrame([("big", 100), ("small", 5)], "eqp_id STRING, rows BIGINT")
    found = profile.spec_chunks(catalog, sizes, 100, chunks).collect()
    big = [r for r in found if r.eqp_id == "big"]
    assert len({r.spec_id for r in big}) == len(big) == n
    wanted = [len(c) for c in np.array_split(range(n), chunks) if len(c)]
    assert [sum(r.chunk_idx == i for r in big) for i in range(len(wanted))] == wanted
    assert {r.est_rows for r in big} == {100 / chunks}
    assert [(r.chunk_idx, r.est_rows) for r in found if r.eqp_id == "small"] == [(None, 5.0)]


def test_sizes(make_readings, spark):
    readings = make_readings([("a", "a-1", 1.0, "2024-01-01T00:00:00")] * 3 + [("b", "b-1", 1.0, "2024-01-01T00:00:00")])
    assert [tuple(r) for r in profile.tool_size_profile(readings).collect()] == [("a", 3), ("b", 1)]
    only = spark.createDataFrame([("b",), ("c",)], "eqp_id STRING")
    assert rows_of(profile.tool_size_profile(readings, only)) == [("b", 1)]
    assert [r.rows for r in profile.rows_per_spec(readings).collect()] == [3, 1]


def test_run_log(spark):
    units = spark.createDataFrame(
        [("t1", "a", 1, "wrote", 20, 10, 2.0, 1.0), ("t1", "b", 1, "empty", 0, 0, 1.0, 0.0),
         ("t1", "c", 1, "failed", 5, 0, 0.0, 0.0), ("t2", "c", 1, "wrote", 5, 5, 0.0, 0.0),
         ("t1", "d", 1, "wrote", 5, 5, 0.0, 0.0), ("t2", "d", 1, "failed", 5, 0, 0.0, 0.0)],
        "timestamp STRING, eqp_id STRING, d INT, status STRING, est_rows BIGINT, actual_rows BIGINT, fetch_sec DOUBLE, write_sec DOUBLE",
    ).withColumn("stage", F.lit("fetch")).withColumn("error", F.lit("e"))
    log = run_log.run_log(units)
    assert [r.est_over_actual for r in log.orderBy("timestamp", "eqp_id").collect()] == [2.0, None, None, 1.0, 1.0, None]
    (row,) = run_log.run_log_summary(log).collect()
    assert (row.checked, row.uploaded, row.empty, row.failed, row.rows, row.rows_high_water) == (6, 3, 1, 2, 20, 10)
    assert row.files_per_min == pytest.approx(45.0) and row.over_estimated == 1
    assert [r.eqp_id for r in run_log.failed_units(log).collect()] == ["d"]
    (row,) = run_log.run_log_summary(log.where("false")).collect()
    assert (row.checked, row.avg_rows, row.files_per_min) == (0, 0.0, 0.0)


# --- scans --------------------------------------------------------------------------------


def test_window_scan(make_readings, spark):
    readings = make_readings([("a", "a-1", float(i), f"2024-01-{i:02d}T00:00:00") for i in range(10, 0, -1)])
    scan = tool_window_scan(readings, F.lit(date(2024, 1, 9)), 3, sort_by="act_time")
    assert [r.partition_date for r in scan.collect()] == ["2024-01-07", "2024-01-08", "2024-01-09"]
    nobody = spark.createDataFrame([("zz",)], "eqp_id STRING")
    assert tool_window_scan(readings, F.lit(date(2024, 1, 9)), 3, tools=nobody).isEmpty()
    lenient = tool_window_scan(readings, F.lit(date(2024, 1, 9)), 3, columns=("spec_id", "nope"), strict=False,
                               add_partition_date=False, sort_by="nope")
    assert lenient.columns == ["spec_id"]
    with pytest.raises(Exception, match="nope"):
        tool_window_scan(readings, F.lit(date(2024, 1, 9)), 3, columns=("spec_id", "nope")).collect()


@pytest.mark.parametrize("limit", [0, 100])
def test_readings_filtered_with_and_without_broadcast(make_readings, make_catalog, limit):
    readings = make_readings([("a", s, 1.0, f"2024-01-0{i}T00:00:00") for s in ("s1", "s2", "s3") for i in range(1, 6)])
    catalog = make_catalog([("a", "s1", "P", "G1", "x"), ("a", "s1", "P", "G1", "y"), ("a", "s2", "P", "G5", "x"), ("b", "s3", "P", "G1", "x")])
    first, last = F.lit(date(2024, 1, 2)), F.lit(date(2024, 1, 4))
    found = readings_filtered(readings, catalog, first, last, ("G1",), limit)
    assert rows_of(found.select("spec_id", "d")) == [("s1", date(2024, 1, i)) for i in (2, 3, 4)]


def test_catalog_weeks(spark, tmp_path):
    from limitlens.sinks import catalog_weeks as weeks

    root = str(tmp_path / "weeks")

    def specs(*rows):
        return spark.createDataFrame([(*r, "t") for r in rows], "eqp_id STRING, spec_id STRING, type STRING, upper_spec DOUBLE, script_run_time STRING")

    assert weeks.catalog_as_of(spark, root, "2024-01").isEmpty()
    assert weeks.publish_catalog_week(specs(("a", "s", "fixed", 1.0), ("a", "s", "auto", None), ("b", "u", "fixed", 2.0)), root, "2024-01")
    assert weeks.publish_catalog_week(specs(("a", "s", "fixed", 1.0), ("b", "u", "fixed", 3.0), ("c", "n", "fixed", None)), root, "2024-03")
    assert not weeks.publish_catalog_week(specs(), root, "2024-03", replace=False)
    first, second = (weeks.catalog_as_of(spark, root, w) for w in ("2024-02", "2024-03"))
    assert rows_of(first.select("eqp_id", "type", "week")) == [("a", "auto", "2024-01"), ("a", "fixed", "2024-01"), ("b", "fixed", "2024-01")]
    assert weeks.catalog_as_of(spark, root, "2024-02", "auto").count() == 1 and weeks.catalog_as_of(spark, root, "2024-03", "auto").isEmpty()
    changes = weeks.catalog_changes(first, second)
    assert rows_of(changes) == [
        ("a", "s", "auto", "removed", None), ("b", "u", "fixed", "changed", "upper_spec"), ("c", "n", "fixed", "added", None)
    ]
    assert "ShuffledHashJoin" in changes._jdf.queryExecution().executedPlan().toString()
    assert weeks.catalog_changes(second, second).isEmpty()
    # A week without specs is a week: nothing of an earlier one is in force in it.
    assert weeks.publish_catalog_week(specs(), root, "2024-04")
    assert weeks.catalog_as_of(spark, root, "2024-05").isEmpty() and weeks.published_weeks(spark, root) == ["2024-01", "2024-03", "2024-04"]
