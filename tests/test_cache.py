"""Rolling window: planning, manifest, refresh, retention."""

from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import Window, functions as F

from limitlens import schemas
from limitlens.config import Settings
from limitlens.operators import cache, run_log, stats
from limitlens.plans import fetch_stage
from limitlens.sinks import value_runs as value_runs_sink
from limitlens.sinks.refresh import refresh_window, verify_cache
from limitlens.sinks.tables import purge_expired_days, write_days
from limitlens.sinks.value_runs import cached_runs, refresh_runs
from limitlens.sources.cache import cache_table, cached_manifest, cached_readings, tool_bucket
from limitlens.sources.tables import read_table
from limitlens.versions import VersionedTable
from limitlens.storage import partition_values

END = date(2024, 1, 10)
THREE = Settings(window_days=3, tool_buckets=4)


def manifest(spark, rows):
    full = [(e, n, 1, c, date.fromisoformat(d)) for e, d, n, c in rows]
    return spark.createDataFrame(full, schemas.MANIFEST)


def test_dates_to_fetch(days):
    window = days("2024-01-08", "2024-01-09", "2024-01-10")
    found = cache.dates_to_fetch(window, days("2024-01-09"), F.lit(END))
    assert [str(r.d) for r in found.collect()] == ["2024-01-08", "2024-01-10"]
    assert cache.dates_to_fetch(window, None, F.lit(END)).count() == 3
    week = replace(THREE, prefill=False, current_week_days=2)
    found = cache.dates_to_fetch(window, None, F.lit(END), week)
    assert [str(r.d) for r in found.collect()] == ["2024-01-09", "2024-01-10"]
    assert cache.dates_to_fetch(window, window, F.lit(END)).isEmpty()


def test_fetch_plan(spark):
    tools = spark.createDataFrame([("a",), ("b",), ("a",)], "eqp_id STRING")
    done = manifest(
        spark,
        [("a", "2024-01-08", 5, 1), ("a", "2024-01-09", 0, 1), ("a", "2024-01-10", 5, 0), ("b", "2024-01-01", 5, 1)],
    )
    plan = cache.fetch_plan(tools, done, F.lit(END), THREE)
    # a: the open day again, the empty closed day not; b: everything.
    assert rows_of(plan) == [
        ("a", date(2024, 1, 10)), ("b", date(2024, 1, 8)), ("b", date(2024, 1, 9)), ("b", date(2024, 1, 10)),
    ]
    assert cache.fetch_plan(tools, None, F.lit(END), THREE).count() == 6
    assert "CartesianProduct" not in plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()


def test_manifest_and_empty_days(make_readings, spark):
    readings = make_readings([("a", "a-1", 1.0, "2024-01-09T00:00:00"), ("a", "a-1", None, "2024-01-10T00:00:00")])
    found = cache.day_manifest(readings, F.lit(END))
    # Strings: a, a-1, P1, L1, W1 are 10 bytes; numbers and dates 44, 8 less without a value.
    assert rows_of(found.select("d", "row_count", "byte_size", "day_closed")) == [
        (date(2024, 1, 9), 1, 54, 1), (date(2024, 1, 10), 1, 46, 0),
    ]
    planned = spark.createDataFrame([("a", date(2024, 1, 8)), ("a", date(2024, 1, 9))], "eqp_id STRING, d DATE")
    full = cache.with_empty_days(found, planned, F.lit(END))
    assert rows_of(full.select("d", "row_count", "day_closed")) == [(date(2024, 1, 8), 0, 1), (date(2024, 1, 9), 1, 1)]


def test_verify(spark):
    promised = manifest(spark, [("a", "2024-01-08", 5, 1), ("a", "2024-01-09", 5, 1), ("b", "2024-01-08", 2, 1), ("b", "2024-01-09", 0, 1)])
    stored = manifest(spark, [("a", "2024-01-08", 5, 1), ("a", "2024-01-09", 4, 1), ("c", "2024-01-08", 2, 1)])
    found = {(r.eqp_id, str(r.d)): r.status for r in cache.verify_manifest(promised, stored).collect()}
    assert found == {
        ("a", "2024-01-08"): "ok", ("a", "2024-01-09"): "mismatch",
        ("b", "2024-01-08"): "missing", ("c", "2024-01-08"): "unknown",
    }


def test_expired_files(spark):
    keys = ["r/a/2024-01-07.parquet", "r/a/2024-01-08.parquet", "r/a/old.parquet", "r/a/2023-01-01.csv"]
    files = spark.createDataFrame([(k,) for k in keys], "key STRING")
    assert [r.key for r in cache.expired_files(files, F.lit(END), 3).collect()] == ["r/a/2024-01-07.parquet"]


def test_pending_tools(spark):
    def tools(*ids):
        return spark.createDataFrame([(i,) for i in ids], "eqp_id STRING")

    found = cache.pending_tools(tools("a", "a", "b", "c", "d"), tools("a"), tools("c", "x"))
    assert rows_of(found) == [("b",), ("d",)]


def test_completeness(spark):
    rows = [("a", "2024-01-08", 5, 1), ("a", "2024-01-10", 5, 0), ("a", "2024-01-01", 5, 1)]
    assert rows_of(cache.completeness(manifest(spark, rows), F.lit(END), 3)) == [("a", 2, 1, 3)]


# --- refresh ------------------------------------------------------------------------------


@pytest.fixture
def catalog(make_catalog):
    return make_catalog(
        [("a", "a-1", "PATTERN_A", "G1", "U1"), ("a", "a-1", "PATTERN_A", "G1", "U2"),
         ("b", "b-1", "PATTERN_A", "G2", "U1"), ("b", "b-9", "PATTERN_A", "G5", "U1"),
         ("c", "c-1", "PATTERN_A", "G1", "U1")]
    )


def source_rows(last_day):
    rows = []
    for day in range(6, last_day + 1):
        for tool, spec in [("a", "a-1"), ("b", "b-1"), ("b", "b-9"), ("z", "z-1")]:
            rows.append((tool, spec, float(day), f"2024-01-{day:02d}T08:00:00"))
    return rows


def stored(spark, root):
    return rows_of(cached_readings(spark, root).select("eqp_id", "spec_id", "d", "param_value"))


def entries(spark, manifest_root):
    root = manifest_root.replace("manifest", "readings")
    return rows_of(cached_manifest(spark, root, manifest_root).select("eqp_id", "d", "row_count", "day_closed"))


def files(root):
    """Data files by partition; their names tell which were written anew."""
    out = {}
    for path in Path(root).glob("data/v=*/d=*/b=*/*.parquet"):
        out.setdefault("/".join(path.parts[-3:-1]), set()).add(path.name)
    return out


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "readings"), str(tmp_path / "manifest")


def test_refresh_twice_is_refresh_once(spark, make_readings, catalog, roots):
    source = make_readings(source_rows(10))
    first = refresh_window(source, catalog, *roots, END, THREE)
    assert (first.planned_tool_days, first.rows_written, first.days_dropped) == (9, 6, [])
    assert first.skipped_tool_days == 0
    content, listed = stored(spark, roots[0]), entries(spark, roots[1])
    assert {(t, s) for t, s, *_ in content} == {("a", "a-1"), ("b", "b-1")}
    assert len(listed) == 9 and ("c", date(2024, 1, 9), 0, 1) in listed
    second = refresh_window(source, catalog, *roots, END, THREE)
    # Only the day that was still open is read again.
    assert second.days == [END] and (second.planned_tool_days, second.skipped_tool_days) == (3, 6)
    assert stored(spark, roots[0]) == content and entries(spark, roots[1]) == listed


def test_next_run_completes_the_open_day(spark, make_readings, catalog, roots):
    fetch_stage.run(make_readings(source_rows(10)), catalog, *roots, END, THREE)
    late = source_rows(12) + [("a", "a-1", 99.0, "2024-01-10T23:00:00")]
    result = fetch_stage.run(make_readings(late), catalog, *roots, date(2024, 1, 12), THREE)
    assert result.days == [date(2024, 1, 10), date(2024, 1, 11), date(2024, 1, 12)]
    values = [v for t, _, d, v in stored(spark, roots[0]) if (t, d) == ("a", END)]
    assert sorted(values) == [10.0, 99.0]
    # Days that left the window are gone from both tables.
    assert {p.split("/")[0] for p in files(roots[0])} == {"d=2024-01-10", "d=2024-01-11", "d=2024-01-12"}
    assert min(d for _, d, *_ in entries(spark, roots[1])) == END


def test_source_without_readings(spark, make_readings, catalog, roots):
    result = refresh_window(make_readings([]), catalog, *roots, END, THREE)
    assert (result.planned_tool_days, result.rows_written) == (9, 0)
    assert stored(spark, roots[0]) == [] and len(entries(spark, roots[1])) == 9
    # Closed empty days are not asked for again; the open day is, and its rows arrive.
    later = refresh_window(make_readings(source_rows(10)), catalog, *roots, END, THREE)
    assert later.days == [END] and later.rows_written == 2


def test_catalog_without_tools(spark, make_readings, catalog, roots):
    nothing = catalog.where("false")
    result = refresh_window(make_readings(source_rows(10)), nothing, *roots, END, THREE)
    assert (result.planned_tool_days, result.skipped_tool_days, result.days) == (0, 0, [])


def test_new_tool_keeps_the_cached_rows_of_others(spark, make_readings, make_catalog, catalog, roots):
    source = make_readings(source_rows(10))
    end = date(2024, 1, 11)  # all days closed but the last
    refresh_window(source, catalog, *roots, end, THREE)
    before = stored(spark, roots[0])
    more = catalog.union(make_catalog([("z", "z-1", "PATTERN_A", "G1", "U1")]))
    # The cached tools' source is gone: their rows must come from the cache.
    refresh_window(source.where("eqp_id = 'z'"), more, *roots, end, THREE)
    after = stored(spark, roots[0])
    assert [r for r in after if r[0] != "z"] == before
    assert len([r for r in after if r[0] == "z"]) == 2


def test_new_tool_rewrites_only_its_bucket(spark, make_readings, make_catalog, catalog, roots):
    source, end = make_readings(source_rows(10)), date(2024, 1, 11)
    eight = replace(THREE, tool_buckets=8)
    refresh_window(source, catalog, *roots, end, eight)
    before = files(roots[0])
    more = catalog.union(make_catalog([("z", "z-1", "PATTERN_A", "G1", "U1")]))
    result = refresh_window(source, more, *roots, end, replace(THREE, tool_buckets=3))  # the table keeps its eight
    after = files(roots[0])
    (bucket,) = {r.b for r in spark.range(1).select(F.lit("z").alias("eqp_id")).select(tool_bucket(8).alias("b")).collect()}
    closed = {f"d=2024-01-{day:02d}/b={bucket}" for day in (9, 10)}
    assert closed <= set(result.parts) <= closed | {p for p in result.parts if p.startswith("d=2024-01-11")}
    assert {p: f for p, f in after.items() if p not in result.parts} == {p: f for p, f in before.items() if p not in result.parts}
    assert all(after[p] != before.get(p) for p in closed)
    assert result.source_rows == 2 and result.planned_tool_days == 2 + 4


def test_new_spec_is_read_alone_and_a_dropped_one_not_at_all(spark, make_readings, make_catalog, catalog, roots):
    source, end = make_readings(source_rows(10)), date(2024, 1, 11)
    refresh_window(source, catalog, *roots, end, THREE)
    more = catalog.union(make_catalog([("b", "b-9", "PATTERN_A", "G1", "U1")]))
    grown = refresh_window(source, more, *roots, end, THREE)
    assert grown.source_rows == 2 and grown.rows_written == 4  # the other tool's files stay
    both = stored(spark, roots[0])
    # The same change again has nothing left to do but the open day.
    assert refresh_window(source, more, *roots, end, THREE).source_rows == 0 and stored(spark, roots[0]) == both
    fewer = more.where("spec_id <> 'b-1'")
    shrunk = refresh_window(source, fewer, *roots, end, THREE)
    assert shrunk.source_rows == 0 and {r[1] for r in stored(spark, roots[0])} == {"a-1", "b-9"}
    # A change back reads the readings again, and only those.
    assert refresh_window(source, more, *roots, end, THREE).source_rows == 2
    assert stored(spark, roots[0]) == both


@pytest.mark.parametrize("step", ["commit", "clear"])
def test_run_that_dies_is_repeated(spark, make_readings, catalog, roots, monkeypatch, step):
    source = make_readings(source_rows(10))
    refresh_window(source, catalog, *roots, END, THREE)
    content, listed = stored(spark, roots[0]), entries(spark, roots[1])
    late = make_readings(source_rows(10) + [("a", "a-1", 99.0, "2024-01-10T23:00:00")])

    def dies(*_, **__):
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, step, dies)
    with pytest.raises(KeyboardInterrupt):
        refresh_window(late, catalog, *roots, END, THREE)
    monkeypatch.undo()
    if step == "commit":  # nobody sees anything of it
        assert stored(spark, roots[0]) == content and entries(spark, roots[1]) == listed
    result = refresh_window(late, catalog, *roots, END, THREE)
    assert result.days == [END] and len(stored(spark, roots[0])) == len(content) + 1
    now = cache_table(spark, roots[0]).record()
    for root in roots:
        assert {p.name.removeprefix("v=") for p in (Path(root) / "data").iterdir()} == set(now.parts.values())


def test_one_unreadable_day_does_not_stop_the_others(spark, make_readings, catalog, roots, tmp_path):
    path, log = tmp_path / "source", str(tmp_path / "log")
    make_readings(source_rows(10)).coalesce(1).write.partitionBy("d").parquet(str(path))
    (bad,) = (path / "d=2024-01-09").glob("*.parquet")
    whole = bad.read_bytes()
    bad.write_bytes(b"no parquet at all")
    Path(f"{bad.parent}/.{bad.name}.crc").unlink()
    source = spark.read.schema(schemas.READINGS).parquet(str(path))
    result = refresh_window(source, catalog, *roots, END, THREE, log)
    assert result.days_dropped == [date(2024, 1, 9)] and result.rows_written == 4
    assert {str(r[2]) for r in stored(spark, roots[0])} == {"2024-01-08", "2024-01-10"}
    found = read_table(spark, log, schemas.RUN_LOG)
    failed = run_log.failed_units(found)
    assert {(r.eqp_id, str(r.d), r.stage) for r in failed.collect()} == {(t, "2024-01-09", "fetch") for t in "abc"}
    (summary,) = run_log.run_log_summary(found).collect()
    assert (summary.checked, summary.uploaded, summary.empty, summary.failed_fetch, summary.failed_upload) == (9, 4, 2, 3, 0)
    assert summary.avg_fetch_sec > 0 and summary.avg_write_sec > 0
    bad.write_bytes(whole)
    source = spark.read.schema(schemas.READINGS).parquet(str(path))
    again = refresh_window(source, catalog, *roots, END, THREE, log, attempt=2)
    assert again.days == [date(2024, 1, 9), END] and len(stored(spark, roots[0])) == 6
    assert run_log.failed_units(read_table(spark, log, schemas.RUN_LOG)).isEmpty()
    second = read_table(spark, log, schemas.RUN_LOG).where("attempt = 2")
    assert second.where("status = 'skipped_existing'").count() == 3


@pytest.mark.parametrize("column", ["row_count", "content_sum"])
def test_a_version_that_differs_is_not_used(spark, make_readings, catalog, roots, tmp_path, monkeypatch, column):
    from limitlens.sinks import refresh

    source, log = make_readings(source_rows(10)), str(tmp_path / "log")
    refresh_window(source, catalog, *roots, END, THREE)
    before = stored(spark, roots[0])
    honest = refresh.stored_tool_days
    wrong = F.when(F.col("d") == "2024-01-11", F.col(column) + 1).otherwise(F.col(column))
    monkeypatch.setattr(refresh, "stored_tool_days", lambda *a, **k: honest(*a, **k).withColumn(column, wrong))
    late = make_readings(source_rows(12))
    result = refresh_window(late, catalog, *roots, date(2024, 1, 12), replace(THREE, window_days=4), log)
    assert result.days_dropped == [date(2024, 1, 11)]
    # The other days are stored, and what was there before stays.
    assert {r[2].day for r in stored(spark, roots[0])} == {8, 9, 10, 12} and set(before) <= set(stored(spark, roots[0]))
    failed = run_log.failed_units(read_table(spark, log, schemas.RUN_LOG))
    assert {(r.eqp_id, r.d.day, r.stage) for r in failed.collect()} == {(t, 11, "upload") for t in "abc"}
    monkeypatch.undo()
    assert date(2024, 1, 11) in refresh_window(late, catalog, *roots, date(2024, 1, 12), THREE).days
    assert {r[2].day for r in stored(spark, roots[0])} == {8, 9, 10, 11, 12}


def test_a_removed_file_and_a_changed_value_are_found_and_healed(spark, make_readings, catalog, roots):
    source, end = make_readings(source_rows(11)), date(2024, 1, 12)
    settings = replace(THREE, window_days=5, tool_buckets=2)
    refresh_window(source, catalog, *roots, end, settings)
    content, listed = stored(spark, roots[0]), entries(spark, roots[1])
    assert verify_cache(spark, *roots).isEmpty()
    found = sorted(Path(roots[0]).glob("data/v=*/d=*/b=*/*.parquet"))
    removed, changed = found[0], found[-1]
    lost = {r.eqp_id for r in spark.read.parquet(str(removed)).collect()}
    rows = spark.read.parquet(str(changed)).withColumn("param_value", F.when(F.col("eqp_id") == F.first("eqp_id").over(
        Window.orderBy("eqp_id")), F.col("param_value") + 1).otherwise(F.col("param_value")))
    hit = {(min(r.eqp_id for r in rows.collect()), int(str(changed).split("d=2024-01-")[1][:2]))}
    rows.write.mode("append").parquet(str(changed.parent))
    changed.unlink()
    removed.unlink()
    lost = {(t, int(str(removed).split("d=2024-01-")[1][:2])) for t in lost}
    bad = {(r.eqp_id, r.d.day): r.status for r in verify_cache(spark, *roots).collect()}
    assert set(bad) == lost | hit and all(bad[k] == "mismatch" for k in hit - lost)
    result = refresh_window(source, catalog, *roots, end, settings, verify=True)
    assert result.planned_tool_days == len(lost | hit) + 3  # and the open day
    assert stored(spark, roots[0]) == content and entries(spark, roots[1]) == listed
    assert verify_cache(spark, *roots).isEmpty()


def test_purge(spark, make_readings, tmp_path):
    root = str(tmp_path / "r")
    assert purge_expired_days(spark, root, "2024-01-08") == 0
    write_days(make_readings(source_rows(10)), root)
    assert purge_expired_days(spark, root, "2024-01-08") == 2
    assert partition_values(spark, root, "d") == ["2024-01-08", "2024-01-09", "2024-01-10"]


def test_writing_a_day_leaves_the_others(spark, make_readings, tmp_path):
    root = str(tmp_path / "r")
    write_days(make_readings(source_rows(8)), root)
    write_days(make_readings([("a", "a-1", 1.0, "2024-01-07T00:00:00")]), root)
    counts = {str(r.d): r["count"] for r in read_table(spark, root, schemas.READINGS).groupBy("d").count().collect()}
    assert counts == {"2024-01-06": 4, "2024-01-07": 1, "2024-01-08": 4}


def test_window_read_prunes_days(spark, make_readings, tmp_path):
    root = str(tmp_path / "r")
    write_days(make_readings(source_rows(10)), root)
    scan = read_table(spark, root, schemas.READINGS).where(F.col("d") >= F.lit(date(2024, 1, 9))).select("spec_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "ReadSchema: struct<spec_id:string>" in plan
    assert scan.count() == 8


def test_new_spec_of_a_cached_tool_gets_its_closed_days(spark, make_readings, make_catalog, catalog, roots):
    source, end = make_readings(source_rows(10)), date(2024, 1, 11)
    refresh_window(source, catalog, *roots, end, THREE)
    before = stored(spark, roots[0])
    more = catalog.union(make_catalog([("b", "b-9", "PATTERN_A", "G1", "U1")]))
    result = refresh_window(source, more, *roots, end, THREE)
    after = stored(spark, roots[0])
    assert result.planned_tool_days == 5 and [r for r in after if r[1] != "b-9"] == before
    assert sorted(str(r[2]) for r in after if r[1] == "b-9") == ["2024-01-09", "2024-01-10"]
    assert refresh_window(source, more, *roots, end, THREE).planned_tool_days == 3


# --- runs of equal values, kept by cache partition ----------------------------------------


def run_rows(spark, root):
    return rows_of(cached_runs(spark, root).select("eqp_id", "spec_id", "d", "param_value", "n_values"))


def test_runs_follow_the_cache(spark, make_readings, catalog, roots, tmp_path, monkeypatch):
    runs = str(tmp_path / "runs")
    assert refresh_runs(spark, roots[0], runs) == [] and cached_runs(spark, runs).isEmpty()
    fetch_stage.run(make_readings(source_rows(10)), catalog, *roots, END, THREE)
    assert {p.split("/")[0] for p in refresh_runs(spark, roots[0], runs)} == {"d=2024-01-08", "d=2024-01-09", "d=2024-01-10"}
    first, before = run_rows(spark, runs), files(runs)
    assert refresh_runs(spark, roots[0], runs) == [] and files(runs) == before
    # Two days later: an open day is written again, two are new, two leave.
    late = source_rows(12) + [("a", "a-1", 10.0, "2024-01-10T23:00:00")]
    fetch_stage.run(make_readings(late), catalog, *roots, date(2024, 1, 12), THREE)
    seen = []
    monkeypatch.setattr(value_runs_sink, "value_runs", lambda df, keys: seen.append(df.inputFiles()) or stats.value_runs(df, keys))
    read = refresh_runs(spark, roots[0], runs)
    assert {p.split("/")[0] for p in read} == {"d=2024-01-10", "d=2024-01-11", "d=2024-01-12"}
    assert {"/".join(f.split("/")[-3:-1]) for f in seen[0]} <= set(read)
    found = run_rows(spark, runs)
    assert found != first and {d for _, _, d, *_ in found} == {date(2024, 1, n) for n in (10, 11, 12)}
    assert ("a", "a-1", END, 10.0, 2) in found
    wanted = stats.value_runs(cached_readings(spark, roots[0]))
    assert found == rows_of(wanted.select("eqp_id", "spec_id", "d", "param_value", "n_values"))


def test_a_new_tool_gives_runs_of_its_bucket_only(spark, make_readings, make_catalog, catalog, roots, tmp_path):
    runs, settings = str(tmp_path / "runs"), replace(THREE, tool_buckets=4)
    source = make_readings(source_rows(10))
    fetch_stage.run(source, catalog, *roots, date(2024, 1, 11), settings)
    refresh_runs(spark, roots[0], runs)
    kept = files(runs)
    more = catalog.unionByName(make_catalog([("z", "z-1", "PATTERN_A", "G1", "U1")]))
    written = fetch_stage.run(source, more, *roots, date(2024, 1, 11), settings).parts
    assert set(refresh_runs(spark, roots[0], runs)) == set(written)
    now = files(runs)
    assert all(now[p] == names for p, names in kept.items() if p not in written)
    assert any(t == "z" for t, *_ in run_rows(spark, runs))


@pytest.mark.parametrize("step", ["before", "after"])
def test_runs_of_a_run_that_dies(spark, make_readings, catalog, roots, tmp_path, monkeypatch, step):
    runs = str(tmp_path / "runs")
    fetch_stage.run(make_readings(source_rows(10)), catalog, *roots, END, THREE)
    refresh_runs(spark, roots[0], runs)
    first = run_rows(spark, runs)
    fetch_stage.run(make_readings(source_rows(12)), catalog, *roots, date(2024, 1, 12), THREE)
    commit = VersionedTable.commit

    def dies(self, *args, **more):
        if step == "after":
            commit(self, *args, **more)
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            refresh_runs(spark, roots[0], runs)
    if step == "before":
        assert run_rows(spark, runs) == first
    refresh_runs(spark, roots[0], runs)
    wanted = stats.value_runs(cached_readings(spark, roots[0]))
    assert run_rows(spark, runs) == rows_of(wanted.select("eqp_id", "spec_id", "d", "param_value", "n_values"))
    assert len(list(Path(runs).glob("data/v=*/d=*"))) == 3
