"""Sinks and the three weekly jobs from end to end."""

from datetime import date
from types import SimpleNamespace

import pytest
from conftest import SF_DIR, rows_of
from pyspark.sql import functions as F

from limitlens import schemas
from limitlens.operators import catalog as cat
from limitlens.operators.calendar import build_calendar
from limitlens.operators.run_log import failed_units, run_log_summary
from limitlens.operators.verdict import calculations, confirm
from limitlens.config import Settings
from limitlens.operators.cache import content_sum
from limitlens.plans import report_stage, resume, weekly
from limitlens.queries import fixtures as fx
from limitlens.sinks import tables as sinks
from limitlens.sources.cache import cached_readings
from limitlens.sources.reports import prior_week_fails, report_week
from limitlens.sources.tables import read_files, read_run_log, read_table, renamed, stored_files
from limitlens.storage import path_exists, scratch_table, shared_folder


@pytest.fixture
def small_report(spark):
    return spark.createDataFrame([("e", "s1", 1), ("e", "s2", 0)], "eqp_id STRING, spec_id STRING, cww_fail INT")


def test_publish_replaces_only_its_week(spark, small_report, tmp_path):
    root = str(tmp_path / "report")
    assert prior_week_fails(spark, root, "2024-01").isEmpty()
    assert sinks.publish_report(small_report, root, "2024-01")
    assert sinks.publish_report(small_report.where("cww_fail = 1"), root, "2024-02")
    assert not sinks.publish_report(small_report, root, "2024-02", replace=False)
    assert report_week(spark, root, "2024-02").count() == 1
    assert sinks.publish_report(small_report, root, "2024-02")
    assert report_week(spark, root, "2024-02").count() == 2
    assert rows_of(prior_week_fails(spark, root, "2024-01")) == [("e", "s1", 1), ("e", "s2", 0)]
    assert sinks.publish_report(small_report.where("false"), root, "2024-02")
    assert report_week(spark, root, "2024-02").isEmpty() and report_week(spark, root, "2024-01").count() == 2


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_run_log_appends(spark, tmp_path, kind):
    root = str(tmp_path / "log")
    assert read_run_log(spark, root, kind).isEmpty()
    log = spark.createDataFrame([("a", "wrote", 7)], "eqp_id STRING, status STRING, actual_rows BIGINT")
    sinks.append_run_log(log, root, kind)
    sinks.append_run_log(log, root, kind)
    found = read_run_log(spark, root, kind).select("eqp_id", "status", "actual_rows", "error")
    assert rows_of(found) == [("a", "wrote", 7, None)] * 2


def chunk_files(make_readings, source, tools, days, chunk=0):
    rows = [(t, f"{t}-1", float(d), f"2024-01-{d:02d}T00:00:00", 100.0, d) for t in tools for d in days]
    make_readings(rows).withColumn("chunk_idx", F.lit(chunk)).coalesce(2).write.mode("append").partitionBy("chunk_idx").parquet(source)


def held(spark, final):
    found = {}
    for row in sinks.compacted_readings(spark, final).select("eqp_id", "reading_id").collect():
        found.setdefault(row.eqp_id, []).append(row.reading_id)
    return {t: sorted(ids) for t, ids in found.items()}


def test_compaction_keeps_every_row(spark, make_readings, tmp_path):
    source, final = str(tmp_path / "chunks"), str(tmp_path / "final")
    readings = make_readings([(f"t{i % 5}", f"t{i % 5}-1", float(i), f"2024-01-{1 + i % 9:02d}T00:00:00") for i in range(200)])
    readings.withColumn("chunk_idx", F.col("reading_id") % 20).repartition(20).write.partitionBy("chunk_idx").parquet(source)
    before = stored_files(spark, source).count()
    found = sinks.compact_chunks(spark, source, final)
    assert rows_of(found.select("reading_id", "param_value")) == rows_of(readings.select("reading_id", "param_value"))
    assert stored_files(spark, source).isEmpty()
    files = [r.file_path for r in stored_files(spark, f"{final}/data").collect()]
    assert len(files) < before
    assert read_files(spark, files, schemas.READINGS).count() == 200
    # Without chunks nothing happens.
    assert sinks.compact_chunks(spark, source, final).count() == 200
    assert sinks.compact_chunks(spark, str(tmp_path / "none"), final).count() == 200


class Lost(BaseException):
    """The driver is gone."""


@pytest.mark.parametrize("step", ["write", "commit", "delete", "half"])
def test_an_interrupted_compaction_loses_nothing(spark, make_readings, tmp_path, monkeypatch, step):
    from limitlens import versions

    monkeypatch.setattr(sinks, "BUCKET_BYTES", 1 << 60)  # one bucket: all tools share it
    source, final = str(tmp_path / "chunks"), str(tmp_path / "final")
    chunk_files(make_readings, source, ["a", "c"], range(1, 11))
    sinks.compact_chunks(spark, source, final)
    chunk_files(make_readings, source, ["b"], range(1, 8), 1)
    chunk_files(make_readings, source, ["c"], range(20, 23), 2)
    want = {"a": list(range(1, 11)), "b": list(range(1, 8)), "c": [20, 21, 22]}
    deleted = []

    def dies(*_, **__):
        raise Lost

    def dies_later(spark_, path):
        if "chunk_idx" in path and deleted:
            raise Lost
        gone = honest(spark_, path)
        if gone and "chunk_idx" in path:
            deleted.append(path)
        return gone

    honest = versions.drop_folder
    with monkeypatch.context() as patch:
        if step == "write":  # the version is written, its proof is not
            patch.setattr(sinks, "partition_values", dies)
        elif step == "commit":
            patch.setattr(versions.VersionedTable, "commit", dies)
        elif step == "delete":
            patch.setattr(sinks, "compacted_readings", dies)
            patch.setattr(versions.VersionedTable, "clear", lambda self: None)
        else:
            patch.setattr(versions, "drop_folder", dies_later)
        with pytest.raises(Lost):
            sinks.compact_chunks(spark, source, final)
    # Readers have the old state or the new one, whole.
    assert held(spark, final) == (want if step in ("delete", "half") else {"a": list(range(1, 11)), "c": list(range(1, 11))})
    # New chunks come before the run is repeated: they are not taken for used ones.
    chunk_files(make_readings, source, ["d"], [5], 1)
    sinks.compact_chunks(spark, source, final)
    assert held(spark, final) == want | {"d": [5]}
    assert stored_files(spark, source).isEmpty()
    record = sinks.compacted_table(spark, final).record()
    assert {p.name.removeprefix("v=") for p in (tmp_path / "final" / "data").iterdir()} == set(record.parts.values())


def test_old_column_names(spark):
    old = spark.createDataFrame([("a", 1.0)], "eqp_id STRING, sensor_value DOUBLE")
    assert renamed(old, schemas.READINGS_OLD_NAMES).columns == ["eqp_id", "param_value"]


def test_missing_columns_read_as_null(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a",)], "eqp_id STRING").write.parquet(path)
    row = read_table(spark, path, schemas.READINGS).first()
    assert row.eqp_id == "a" and row.param_value is None


def test_scratch_is_on_the_shared_folder(spark):
    first, second = scratch_table(spark, "x"), scratch_table(spark, "x")
    assert first != second and first.startswith(shared_folder(spark))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")


# --- the whole week -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def spec_sources(spark):
    """Catalog sources that describe the specs of the readings."""
    events = fx.table(spark, SF_DIR, "events")
    tool = F.col("user_id").cast("string")
    spec = F.concat_ws("-", tool, "event_type")
    kinds = {"click": 1, "view": 2, "purchase": 3, "signup": 4}
    code = F.try_element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("event_type"))
    number = F.abs(F.xxhash64(spec))
    specs = events.groupBy("user_id", "event_type").agg(F.count("*").alias("used_count"))
    return cat.CatalogSources(
        parameters=specs.select(
            number.alias("param_id"), F.lit("u").alias("unit"), spec.alias("name"),
            F.concat(F.lit("G"), (F.col("user_id") % 5 + 1).cast("string")).alias("grade"),
        ),
        limits=specs.select(
            number.alias("param_id"), tool.alias("eqp_id"), spec.alias("spec_id"), F.lit("U1").alias("process_unit"),
            F.lit("100").alias("upper_text"), F.lit("0").alias("lower_text"), F.lit("F").alias("limit_formula"),
            F.lit("fixed").alias("range_flag"), F.lit(date(2024, 1, 30)).alias("last_used"), "used_count",
        ),
        tool_config=specs.select(tool.alias("eqp_id"), F.lit("ETCH").alias("area"), F.lit("M").alias("model")).distinct(),
        equipment_names=specs.select(tool.alias("eqp_id"), F.lit("n").alias("eqp_name")).distinct(),
        pattern_definitions=specs.select(spec.alias("param_name"), F.coalesce(code, F.lit(9)).alias("type_code")),
    )


def test_two_weeks(spark, spec_sources, tmp_path):
    from dataclasses import replace

    names = ("catalog", "readings", "manifest", "report", "log", "calculations", "catalog_weeks", "runs")
    roots = weekly.Roots(*(str(tmp_path / n) for n in names))
    readings = fx.readings(spark, SF_DIR)
    calendar = build_calendar(readings.agg(F.min("d").alias("first_day"), F.max("d").alias("last_day")))
    settings = replace(fx.SETTINGS, window_days=23)
    weeks = [
        weekly.run(spec_sources, readings.where(F.col("d") <= F.lit(end)), calendar, roots, end, settings)
        for end in (date(2024, 1, 23), date(2024, 1, 30))
    ]
    assert weeks == ["2024-04", "2024-05"]

    # The same two windows straight from the readings.
    catalog = fx.graded(fx.registrations(spark, SF_DIR))

    def window(first, last):
        return calculations(readings.where(F.col("d").between(first, last)), catalog, settings)

    names = ["spec_id", "n_points", "cww_fail", "pww_fail", "fail"]
    prior = window("2024-01-01", "2024-01-23")
    wanted = confirm(window("2024-01-08", "2024-01-30"), prior.select("eqp_id", "spec_id", F.col("cww_fail").alias("fail_flag")))
    published = report_week(spark, roots.report, "2024-05")
    assert rows_of(published.select(*names)) == rows_of(wanted.select(*names))
    assert rows_of(report_week(spark, roots.report, "2024-04").select("spec_id", "cww_fail")) == rows_of(
        prior.select("spec_id", "cww_fail")
    )
    assert {r.days_present for r in published.select("days_present").distinct().collect()} == {23}

    log = read_table(spark, roots.log, schemas.RUN_LOG)
    (summary,) = run_log_summary(log).collect()
    assert summary.rows == cached_readings(spark, roots.readings).count() + readings.where(
        F.col("d") < F.lit(date(2024, 1, 8))
    ).join(catalog, "spec_id", "left_semi").count() + readings.where("d = '2024-01-23'").join(
        catalog, "spec_id", "left_semi"
    ).count()
    assert summary.failed == 0 and failed_units(log).isEmpty()

    # A repeated run changes nothing.
    before = rows_of(published)
    assert weekly.run(spec_sources, readings, calendar, roots, date(2024, 1, 30), settings) == "2024-05"
    assert rows_of(report_week(spark, roots.report, "2024-05")) == before


def test_scratch_needs_a_shared_folder_on_a_cluster():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_published_week_is_not_calculated_again(spark, small_report, tmp_path):
    root = str(tmp_path / "report")
    calendar = build_calendar(spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 5))], "first_day DATE, last_day DATE"))
    sinks.publish_report(small_report, root, "2024-01")
    found = report_stage.run(spark, None, calendar, "nowhere", "nowhere", root, date(2024, 1, 3), replace=False)
    assert found == "2024-01" and report_week(spark, root, "2024-01").count() == 2


def test_calendar_must_cover_the_run_date(spark):
    calendar = build_calendar(spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 5))], "first_day DATE, last_day DATE"))
    assert report_stage.work_weeks(calendar, date(2024, 1, 3)) == ("2024-01", "")
    with pytest.raises(ValueError, match="2025-01-01"):
        report_stage.work_weeks(calendar, date(2025, 1, 1))


# --- a report that is calculated again ------------------------------------------------------


@pytest.fixture
def resumable(spark, make_readings, make_catalog, tmp_path):
    """Runs the verdicts of some tools; ``changed`` tools have one reading more."""
    tools = [f"t{i}" for i in range(6)]
    catalog = make_catalog([(t, f"{t}-1", "PATTERN_A", "G1", "U1") for t in [*tools, "none"]])

    def run(changed=(), settings=None, specs=None):
        days = {t: [*range(1, 9), *([9] if t in changed else [])] for t in tools}
        readings = make_readings([(t, f"{t}-1", float(d % 5), f"2024-01-{d:02d}T00:00:00") for t in tools for d in days[t]])
        content = readings.groupBy("eqp_id", "d").agg(F.count("*").alias("row_count"), content_sum(["eqp_id", "act_time", "param_value"]).alias("content_sum"))
        found = resume.resumable_verdicts(readings, catalog if specs is None else specs(catalog), content, str(tmp_path / "calc"), settings or Settings())
        verdicts = {r.eqp_id: r.n_points for r in found.verdicts.collect()}
        return {r.eqp_id: r.state for r in found.states.collect()}, verdicts, {r.eqp_id: r.error for r in found.states.collect() if r.error}

    return run


def test_only_changed_tools_are_calculated_again(resumable, monkeypatch):
    asked = []
    honest = resume.calculations

    def counted(readings, catalog, *args, **more):
        if more.get("hot_root"):
            asked.append(sorted(r.eqp_id for r in catalog.select("eqp_id").distinct().collect()))
        return honest(readings, catalog, *args, **more)

    monkeypatch.setattr(resume, "calculations", counted)
    states, verdicts, _ = resumable()
    assert states == {**{f"t{i}": "calculated" for i in range(6)}, "none": "no data"}
    assert verdicts == {f"t{i}": 8 for i in range(6)}
    states, again, _ = resumable()
    assert set(states.values()) == {"already processed"} and again == verdicts and len(asked) == 1
    states, changed, _ = resumable(changed=["t2"])
    assert states.pop("t2") == "calculated" and set(states.values()) == {"already processed"}
    assert asked[1:] == [["t2"]] and changed == {**verdicts, "t2": 9}
    # Another rule or another grade of a spec is a change too, a tool that left the catalog is not reported.
    states, _, _ = resumable(changed=["t2"], settings=Settings(min_points=6))
    assert set(states.values()) == {"calculated", "no data"}
    graded = lambda c: c.where("eqp_id <> 't5'").withColumn("grade", F.when(F.col("eqp_id") == "t1", "G2").otherwise(F.col("grade")))
    states, left, _ = resumable(changed=["t2"], settings=Settings(min_points=6), specs=graded)
    assert [t for t, s in states.items() if s == "calculated"] == ["t1"] and "t5" not in states and "t5" not in left


def test_a_tool_that_fails_is_a_state(resumable, monkeypatch):
    honest = resume.calculations

    def fails(readings, catalog, *args, **more):
        if more.get("hot_root") and not readings.where("eqp_id in ('t1', 't4')").isEmpty():
            raise ValueError("cannot be calculated")
        return honest(readings, catalog, *args, **more)

    monkeypatch.setattr(resume, "calculations", fails)
    states, verdicts, errors = resumable()
    assert {t for t, s in states.items() if s == "calculation error"} == {"t1", "t4"} == set(errors)
    assert set(verdicts) == {"t0", "t2", "t3", "t5"} and "cannot be calculated" in errors["t1"]
    monkeypatch.undo()
    states, verdicts, errors = resumable()
    assert {t for t, s in states.items() if s == "calculated"} == {"t1", "t4"} and len(verdicts) == 6 and not errors
