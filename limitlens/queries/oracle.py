"""The SQL twin of each query, written independently of the Spark code (DuckDB dialect)."""

from __future__ import annotations

from limitlens.config import MAD_SCALE, TAIL_HIGH, TAIL_LOW

READINGS = """
readings as (
  select cast(user_id as varchar) as eqp_id,
         cast(user_id as varchar) || '-' || event_type as spec_id,
         value as param_value, event_type as processid, ts as act_time, event_id as reading_id,
         100.0::double + cast(json_extract_string(props, '$.k') as integer) as upper_spec,
         0.0::double as lower_spec,
         'L' || json_extract_string(props, '$.k') as root_lot_id,
         cast(event_id as varchar) as wafer_id,
         cast(ts as date) as d
  from events)
"""

REGISTRATIONS = """
registrations as (
  select distinct cast(user_id as varchar) as eqp_id,
         cast(user_id as varchar) || '-' || event_type as spec_id,
         case event_type when 'click' then 'PATTERN_A' when 'view' then 'PATTERN_B'
              when 'purchase' then 'PATTERN_C' when 'signup' then 'PATTERN_D'
              else 'UNSUPPORTED' end as pattern,
         'G' || cast(user_id % 5 + 1 as varchar) as grade,
         case when cast(json_extract_string(props, '$.k') as integer) < 50 then 'U1' else 'U2' end
           as process_unit
  from events),
graded as (select * from registrations where grade <> 'G5' and pattern <> 'UNSUPPORTED')
"""

CURRENT = "d between date '2024-01-08' and date '2024-01-30'"
PRIOR = "d between date '2024-01-01' and date '2024-01-23'"


def _stats(name: str, window: str) -> str:
    """CTEs up to ``{name}_stats``: fences, survivors, statistics, spread."""
    return f"""
{name}_q as (
  select eqp_id, spec_id, quantile_cont(param_value, 0.25) as q1, quantile_cont(param_value, 0.75) as q3
  from readings where {window} group by eqp_id, spec_id),
{name}_b as (
  select *, q1 - 1.5 * (q3 - q1) as lower_bound, q3 + 1.5 * (q3 - q1) as upper_bound from {name}_q),
{name}_in as (
  select r.*, b.lower_bound, b.upper_bound from readings r join {name}_b b using (eqp_id, spec_id)
  where {window} and r.param_value between b.lower_bound and b.upper_bound),
{name}_s as (
  select eqp_id, spec_id, count(*) as n_points, avg(param_value) as mean, stddev_samp(param_value) as std,
         any_value(lower_bound) as lower_bound, any_value(upper_bound) as upper_bound,
         arg_max(upper_spec, (act_time, reading_id)) as upper_spec,
         arg_max(lower_spec, (act_time, reading_id)) as lower_spec,
         quantile_cont(param_value, {TAIL_LOW}) as p_low, median(param_value) as median,
         quantile_cont(param_value, {TAIL_HIGH}) as p_high
  from {name}_in group by eqp_id, spec_id having count(*) >= 5),
{name}_m as (
  select i.eqp_id, i.spec_id, median(abs(i.param_value - s.median)) as mad
  from {name}_in i join {name}_s s using (eqp_id, spec_id) group by i.eqp_id, i.spec_id),
{name}_stats as (
  select s.*, case when s.mean <> 0 then s.std / s.mean end as cv, m.mad
  from {name}_s s join {name}_m m using (eqp_id, spec_id))
"""


def _verdicts(name: str) -> str:
    """CTE ``{name}_v``: catalog join, control limits, verdict."""
    robust = f"{3 * MAD_SCALE!r} * mad"
    return f"""
{name}_r as (
  select s.*, c.pattern, c.grade,
         (upper_spec - lower_spec) / nullif(std, 0) as sigma_ratio,
         (upper_spec - lower_spec) / nullif(abs(mean), 0) as relative_ratio,
         case pattern when 'PATTERN_A' then mean + 3 * std when 'PATTERN_B' then median + {robust}
              when 'PATTERN_C' then p_high else mean + 3 * std end as ucl,
         case pattern when 'PATTERN_A' then mean - 3 * std when 'PATTERN_B' then median - {robust}
              when 'PATTERN_C' then p_low else 0.0 end as lcl
  from {name}_stats s
  join (select distinct spec_id, eqp_id, pattern, grade from graded) c using (eqp_id, spec_id)),
{name}_v as (
  select *, case when std is null or std <= 0 then 'flatlined' end as suppress_reason,
         case when std > 0 and sigma_ratio > 4.0 and relative_ratio > 3.5 then 1 else 0 end as cww_fail
  from {name}_r)
"""


_BASE = f"with {READINGS}, {REGISTRATIONS}"
_CURRENT_V = f"{_BASE}, {_stats('c', CURRENT)}, {_verdicts('c')}"
_REPORT = f"{_CURRENT_V}, {_stats('p', PRIOR)}, {_verdicts('p')}"

_REPORT_SELECT = """
select c.spec_id, c.eqp_id, c.pattern, c.grade, c.n_points, round(c.mean, 8) as mean,
       round(c.std, 6) as std, round(c.cv, 6) as cv, round(c.upper_spec, 6) as upper_spec,
       round(c.lower_spec, 6) as lower_spec, round(c.ucl, 8) as ucl, round(c.lcl, 8) as lcl,
       c.suppress_reason, c.cww_fail, coalesce(p.cww_fail, 0) as pww_fail,
       case when c.cww_fail = 1 and coalesce(p.cww_fail, 0) = 1 then 1 else 0 end as fail
"""

_MANIFEST_BYTES = """
octet_length(eqp_id::blob) + octet_length(spec_id::blob) + octet_length(processid::blob)
+ octet_length(root_lot_id::blob) + octet_length(wafer_id::blob) + 8 * 5 + 4
"""


def _manifest(where: str, run_date: str) -> str:
    return f"""
  select eqp_id, d, count(*) as row_count, cast(sum({_MANIFEST_BYTES}) as bigint) as byte_size,
         cast(d < date '{run_date}' as integer) as day_closed
  from readings where {where} group by eqp_id, d
"""


_LIMITS = """
first_made as (
  select l_partkey as param_id, l_suppkey as tool,
         cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar) as spec_id,
         l_linestatus as process_unit, max(l_quantity) as hi, min(l_quantity) as lo,
         cast(max(l_shipdate) as date) as last_used, count(*) as used_count, max(l_returnflag) as flag
  from lineitem group by l_partkey, l_suppkey, l_linestatus),
limits as (
  select param_id, eqp_id, spec_id, process_unit,
         case when used_count = 1 and hi < 10 then 'n/a' else ' ' || cast(cast(hi as integer) as varchar) end
           as upper_text,
         cast(cast(lo as integer) as varchar) as lower_text,
         'F' || flag as limit_formula,
         case when flag = 'A' then 'auto' else 'fixed' end as range_flag, last_used, used_count
  from (select param_id, cast(tool as varchar) as eqp_id, spec_id, process_unit, hi, lo, last_used, used_count, flag
        from first_made
        union all
        select case when param_id % 2 = 0 then param_id + 1 else param_id end,
               cast((param_id + tool) % 10 + 1 as varchar), spec_id, process_unit || 'M', hi, lo,
               last_used + 1, used_count, flag
        from first_made where param_id % 7 = 0))
"""

_CATALOG = f"""
{_LIMITS},
used as (
  select * from limits where used_count >= 1 and last_used >= date '2001-11-04' - 1000),
reported as (
  select p_partkey as param_id, p_brand as unit, 'G' || cast(p_size % 5 + 1 as varchar) as grade,
         upper(replace(p_name, ' ', '_')) || '_' || cast(p_partkey as varchar) as param_name,
         case p_type when 'ECONOMY' then 'PATTERN_A' when 'LARGE' then 'PATTERN_B'
              when 'MEDIUM' then 'PATTERN_C' when 'PROMO' then 'PATTERN_D' else 'UNSUPPORTED' end
           as reported_pattern,
         p_size = 50 as corrected
  from part),
registered as (
  select s.*, r.unit, r.grade, r.param_name,
         case when r.corrected then 'PATTERN_A' else r.reported_pattern end as pattern,
         g.r_name as area, n.n_name || case when u.s_suppkey % 3 = 0 then ' B' else '' end as model,
         u.s_name as eqp_name
  from used s join reported r using (param_id)
  join supplier u on s.eqp_id = cast(u.s_suppkey as varchar)
  join nation n on u.s_nationkey = n.n_nationkey join region g on n.n_regionkey = g.r_regionkey
  where r.grade <> 'G5' and r.reported_pattern <> 'UNSUPPORTED' and g.r_name <> 'MIDDLE EAST'),
assembled as (
  select * exclude (n) from (
    select *, row_number() over (partition by spec_id order by last_used desc, process_unit desc) as n
    from registered) where n = 1),
fixed as (
  select * exclude (range_flag, tolerance),
         case when upper_spec is not null and lower_spec is not null then 1 else 0 end as tolerance,
         'fixed' as type
  from (select *, try_cast(trim(upper_text) as double) as upper_spec,
               try_cast(trim(lower_text) as double) as lower_spec, 0 as tolerance
        from assembled where range_flag = 'fixed')),
auto as (
  select * exclude (range_flag), 0 as tolerance, 'auto' as type from assembled where range_flag = 'auto')
"""

_KEYS = """
keys as (
  select distinct 'readings/' || cast(user_id as varchar) || '/' ||
         case event_type when 'error' then 'not-a-date.parquet'
              when 'signup' then cast(cast(ts as date) as varchar) || '.tmp'
              else cast(cast(ts as date) as varchar) || '.parquet' end as key
  from events),
parsed as (
  select key, split_part(key, '/', 2) as eqp_id,
         try_cast(regexp_extract(key, '(\\d{4}-\\d{2}-\\d{2})\\.parquet$', 1) as date) as d
  from keys where regexp_matches(key, '/\\d{4}-\\d{2}-\\d{2}\\.parquet$'))
"""

_DAYS = "days as (select cast(g as date) as d from generate_series(timestamp '2024-01-01', timestamp '2024-01-30', interval 1 day) t(g))"

_LOG = f"""
{READINGS},
{_DAYS},
facts as (
  select eqp_id, d, count(*) as n, sum(param_value) as work, max(param_value) as top
  from readings group by eqp_id, d),
base as (
  select t.eqp_id, days.d, f.n, f.work, coalesce(f.top > 300, false) as bad
  from (select distinct eqp_id from readings) t cross join days
  left join facts f on f.eqp_id = t.eqp_id and f.d = days.d),
log as (
  select cast(d as varchar) as timestamp, eqp_id, d,
         case when n is null then 'empty' when bad then 'failed' else 'wrote' end as status,
         cast(ceil(coalesce(n, 0) / 5.0) * 5 as bigint) as est_rows,
         case when bad then 0 else coalesce(n, 0) end as actual_rows,
         coalesce(work / 1000, 0.0) as fetch_sec,
         case when bad then 0 else coalesce(n, 0) end / 100.0::double as write_sec,
         case when bad then 'fetch' end as stage, case when bad then 'value above 300' end as error
  from base),
done as (
  select *, case when actual_rows > 0 then round(est_rows / actual_rows, 3) end as est_over_actual,
         fetch_sec + write_sec as total_sec
  from log)
"""

_WEEK = """
select w as ww_start_date, w + 6 as ww_end_date,
       cast(year(w + 6) as varchar) || '-' || lpad(cast((dayofyear(w + 6) - 1) // 7 + 1 as varchar), 2, '0')
         as year_ww
"""


def _sundays(table: str, column: str) -> str:
    sunday = "cast({0} as date) - cast(dayofweek(cast({0} as date)) as integer)"
    return f"""
  (select unnest(generate_series(cast(first as timestamp), cast(last as timestamp), interval 7 day))::date as w
   from (select {sunday.format(f'min({column})')} as first, {sunday.format(f'max({column})')} as last
         from {table}))
"""


ORACLE: dict[str, str] = {
    "outlier_bounds": f"""
with {READINGS}, {_stats('c', CURRENT)}
select eqp_id, spec_id, round(q1, 9) as q1, round(q3, 9) as q3, round(lower_bound, 9) as lower_bound,
       round(upper_bound, 9) as upper_bound
from c_b""",
    "latest_limits": f"""
with {READINGS}
select eqp_id, spec_id, upper_spec, lower_spec from (
  select *, row_number() over (partition by eqp_id, spec_id order by act_time desc, reading_id desc) as n
  from readings where {CURRENT}) where n = 1""",
    "spec_stats": f"""
with {READINGS}, {_stats('c', CURRENT)}
select eqp_id, spec_id, n_points, round(mean, 8) as mean, round(std, 6) as std, round(cv, 6) as cv,
       round(lower_bound, 9) as lower_bound, round(upper_bound, 9) as upper_bound,
       upper_spec, lower_spec, round(p_low, 9) as p_low, round(median, 9) as median,
       round(p_high, 9) as p_high, round(mad, 9) as mad
from c_stats""",
    "control_limits": f"""
{_CURRENT_V}
select spec_id, pattern, round(ucl, 8) as ucl, round(lcl, 8) as lcl from c_v""",
    "compliance_verdict": f"""
{_CURRENT_V}
select spec_id, eqp_id, pattern, grade, n_points, round(mean, 8) as mean, round(std, 6) as std,
       round(cv, 6) as cv, upper_spec, lower_spec, round(sigma_ratio, 6) as sigma_ratio,
       round(relative_ratio, 6) as relative_ratio, cww_fail
from c_v""",
    "suppression_reasons": f"""
{_CURRENT_V},
reasons as (
  select spec_id, n_points, sigma_ratio, relative_ratio,
         case when std is null or std <= 25.0 then 'flatlined' when n_points < 8 then 'too_few_points'
              when spec_id in (select spec_id from readings where upper_spec >= 199) then 'carve_out'
         end as suppress_reason
  from c_v)
select spec_id, n_points, suppress_reason,
       case when suppress_reason is null and sigma_ratio > 4.0 and relative_ratio > 3.5 then 1 else 0 end
         as cww_fail
from reasons""",
    "prior_week_fails": f"""
{_BASE}, {_stats('p', PRIOR)}, {_verdicts('p')}
select eqp_id, spec_id, cww_fail as fail_flag from p_v""",
    "weekly_report": f"""
{_REPORT} {_REPORT_SELECT} from c_v c left join p_v p using (eqp_id, spec_id)""",
    "publish_report": f"""
{_REPORT} {_REPORT_SELECT}, '2024-05' as week from c_v c left join p_v p using (eqp_id, spec_id)""",
    "tool_status": f"""
{_BASE}, {_stats('w', "d >= date '2024-01-28'").replace('>= 5', '>= 3')},
specs as (
  select s.eqp_id, count(*) as n from w_stats s
  join (select distinct spec_id, eqp_id from graded) c using (eqp_id, spec_id) group by s.eqp_id),
sizes as (select eqp_id, count(*) as n from readings where d >= date '2024-01-28' group by eqp_id)
select t.eqp_id, coalesce(z.n, 0) as rows, coalesce(s.n, 0) as specs,
       case when z.n is null then 'no data' when s.n is null then 'no calculations' else 'calculated' end
         as status
from (select distinct eqp_id from registrations) t
left join sizes z using (eqp_id) left join specs s using (eqp_id)""",
    "catalog_assemble": f"with {_CATALOG} select * from assembled",
    "catalog_dedup": f"""
with {_LIMITS}
select * exclude (n) from (
  select *, row_number() over (partition by spec_id order by last_used desc, process_unit desc) as n
  from limits) where n = 1""",
    "catalog_fixed": f"with {_CATALOG} select * from fixed",
    "catalog_auto": f"with {_CATALOG} select * from auto",
    "catalog_union": f"""
with {_CATALOG}
select *, '2024-01-30 06:00:00' as script_run_time from (
  select * from fixed union all by name select * from auto)""",
    "spec_catalog_scan": f"""
with {_CATALOG}
select eqp_id, spec_id, pattern, grade, upper_spec, lower_spec, tolerance from fixed""",
    "technode_lookup": """
select c_custkey, c_nationkey as plan_id, n_name as node
from customer left join nation on c_nationkey = n_nationkey""",
    "window_dates": """
select cast(g as date) as d, cast(last - cast(g as date) as integer) as days_back
from (select max(cast(ts as date)) as last from events),
     generate_series(cast(last - 29 as timestamp), cast(last as timestamp), interval 1 day) t(g)""",
    "dates_to_fetch": """
select cast(g as date) as d
from (select max(cast(ts as date)) as last from events),
     generate_series(cast(last - 29 as timestamp), cast(last as timestamp), interval 1 day) t(g)
where cast(g as date) not in (select cast(ts as date) from events where cast(ts as date) < date '2024-01-23')""",
    "fetch_plan": f"""
with {_DAYS}
select cast(t.user_id as varchar) as eqp_id, days.d
from (select distinct user_id from events) t cross join days
where not exists (
  select 1 from events e
  where e.user_id = t.user_id and cast(e.ts as date) = days.d and days.d < date '2024-01-23')""",
    "expired_partitions": f"with {_KEYS} select key, eqp_id, d from parsed where d < date '2024-01-30' - 9",
    "day_manifest": f"with {READINGS} {_manifest('true', '2024-01-30')}",
    "manifest_verify": f"""
with {READINGS},
promised as ({_manifest("d < date '2024-01-30'", '2024-01-30')}),
stored as ({_manifest("processid <> 'error' and d > date '2024-01-01'", '2024-01-30')})
select eqp_id, d, p.row_count as expected_rows, p.byte_size as expected_bytes,
       s.row_count as stored_rows, s.byte_size as stored_bytes,
       case when s.row_count is null then 'missing' when p.row_count is null then 'unknown'
            when p.row_count = s.row_count and p.byte_size = s.byte_size then 'ok' else 'mismatch' end as status
from promised p full join stored s using (eqp_id, d)""",
    "window_completeness": """
select cast(user_id as varchar) as eqp_id, count(distinct cast(ts as date)) as days_present,
       count(distinct case when cast(ts as date) < date '2024-01-30' then cast(ts as date) end) as days_closed,
       30 as days_expected
from events group by user_id""",
    "pending_tools": """
select cast(user_id as varchar) as eqp_id from events group by user_id
having max(cast(ts as date)) < date '2024-01-29'""",
    "key_parse": f"""
with {_KEYS}
select key, eqp_id, d, eqp_id as chunk_tool, eqp_id || '_chunk_3' as clean_name from parsed""",
    "paths_per_tool": f"""
with {_KEYS}
select eqp_id, string_agg(key, ' ' order by key) as paths, count(*) as n_files from parsed group by eqp_id""",
    "fiscal_calendar": f"{_WEEK} from {_sundays('orders', 'o_orderdate')}",
    "work_week_lookup": f"""
with weeks as ({_WEEK} from {_sundays('events', 'ts')})
select e.event_id, e.ts, a.year_ww, b.year_ww as previous_ww
from events e
left join weeks a on cast(e.ts as date) between a.ww_start_date and a.ww_end_date
left join weeks b on cast(e.ts as date) - 7 between b.ww_start_date and b.ww_end_date""",
    "date_helpers": """
select event_id, strftime(ts - interval 30 day, '%Y-%m-%d %H:%M:%S') as past_time,
       strftime(cast(ts as date) - 30, '%Y-%m-%d') as date_from,
       strftime(cast(ts as date), '%Y-%m-%d') as date_to,
       case when event_type = 'error' then date '2024-01-30' else cast(ts as date) end as end_date
from events""",
    "tool_window_scan": f"""
{_BASE}
select eqp_id, spec_id, param_value, processid, act_time, upper_spec, lower_spec, root_lot_id, wafer_id,
       cast(d as varchar) as partition_date
from readings where {CURRENT} and eqp_id in (select eqp_id from graded)""",
    "tool_window_scan_lenient": f"""
with {READINGS}
select eqp_id, act_time as create_time, spec_id, param_value as sensor_value,
       cast(d as varchar) as partition_date
from readings where {CURRENT}""",
    "readings_filtered": f"""
{_BASE}
select r.* from readings r
where {CURRENT} and exists (
  select 1 from registrations c where c.spec_id = r.spec_id and c.eqp_id = r.eqp_id and c.grade <> 'G5')""",
    "specs_by_tool": f"""
{_BASE}
select eqp_id, string_agg('''' || spec_id || '''', ',' order by spec_id) as spec_ids,
       cast(count(*) as integer) as n_specs
from (select distinct eqp_id, spec_id from registrations) group by eqp_id""",
    "rows_per_spec": f"with {READINGS} select spec_id, count(*) as rows from readings group by spec_id",
    "tool_size_profile": f"""
{_BASE}
select eqp_id, count(*) as rows from readings where eqp_id in (select eqp_id from graded) group by eqp_id""",
    "large_tools": """
select cast(user_id as varchar) as eqp_id from events group by user_id having count(*) > 70""",
    "spec_chunks": f"""
{_BASE},
sizes as (select eqp_id, count(*) as rows from readings group by eqp_id),
specs as (select distinct eqp_id, spec_id, rows from registrations join sizes using (eqp_id))
select eqp_id, spec_id,
       case when rows >= 70 then
         cast(ntile(3) over (partition by eqp_id order by md5(spec_id), spec_id) - 1 as integer) end as chunk_idx,
       round(case when rows >= 70 then rows / 3.0::double else rows::double end, 6) as est_rows
from specs""",
    "id_list_text": """
select l_orderkey, l_linenumber,
       '''' || l_returnflag || ''',''' || l_linestatus || '''' as quoted,
       cast(l_partkey as varchar) || ',' || cast(cast(trunc(l_quantity) as bigint) as varchar) || ','
         || cast(cast(trunc(l_extendedprice) as bigint) as varchar) as numbers
from lineitem""",
    "size_text_parse": """
select p_partkey,
       case when p_type = 'LARGE' then 'Output:' || p_partkey || 'row(' || p_size || 'B)'
            else 'Output:' || p_partkey || ' rows(' || p_size || '.5kB) more' end as size_text,
       p_partkey as rows,
       case when p_type = 'LARGE' then p_size::double else p_size + 0.5::double end as size_value,
       case when p_type = 'LARGE' then 'B' else 'kB' end as size_unit
from part where p_type <> 'SMALL'""",
    "run_log_units": f"""
with {_LOG}
select timestamp, eqp_id, d, status, est_rows, actual_rows, round(fetch_sec, 6) as fetch_sec,
       round(write_sec, 6) as write_sec, stage, error, est_over_actual, round(total_sec, 6) as total_sec
from done""",
    "run_log_summary": f"""
with {_LOG}
select d, count(*) as checked, count(*) filter (status = 'wrote') as uploaded,
       count(*) filter (status = 'empty') as empty, count(*) filter (status = 'failed') as failed,
       0::bigint as skipped_existing, count(*) filter (status <> 'failed') as fetched,
       count(*) filter (stage = 'fetch') as failed_fetch, 0::bigint as failed_upload,
       cast(sum(actual_rows) as bigint) as rows, max(actual_rows) as rows_high_water,
       round(coalesce(sum(actual_rows) / nullif(count(*) filter (status = 'wrote'), 0), 0), 6) as avg_rows,
       round(avg(fetch_sec), 6) as avg_fetch_sec, round(avg(write_sec), 6) as avg_write_sec,
       round(coalesce(count(*) filter (status = 'wrote') / nullif(sum(total_sec) / 60, 0), 0), 6)
         as files_per_min,
       count(*) filter (est_over_actual > 1) as over_estimated
from done group by d""",
    "fetch_failures": f"""
with {_LOG} select eqp_id, d, stage, error from done where status = 'failed'""",
    "refresh_window": f"""
{_BASE}, {_DAYS},
kept as (
  select r.* from readings r
  where exists (select 1 from graded c where c.spec_id = r.spec_id)),
content as (
  select eqp_id, d, count(*) as stored_rows, round(sum(param_value), 6) as value_sum,
         max(reading_id) as last_reading
  from kept group by eqp_id, d)
select t.eqp_id, days.d, coalesce(c.stored_rows, 0) as row_count,
       cast(days.d < date '2024-01-30' as integer) as day_closed, c.stored_rows, c.value_sum, c.last_reading
from (select distinct eqp_id from graded) t cross join days
left join content c on c.eqp_id = t.eqp_id and c.d = days.d""",
    "compact_chunks": f"with {READINGS} select * from readings",
}

# The cache after a refresh: every tool of the catalog has each day, all but the last one closed.
def _cache(specs: str, source_rows: str, more: str = "") -> str:
    return f"""
{_BASE},
days as (select cast(g as date) as d from generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day) t(g)),
specs as (select distinct eqp_id, spec_id from {specs}),
kept as (select r.* from readings r join specs using (eqp_id, spec_id)),
content as (
  select eqp_id, d, count(*) as stored_rows, round(sum(param_value), 6) as value_sum, max(reading_id) as last_reading
  from kept group by eqp_id, d)
select t.eqp_id, days.d, coalesce(c.stored_rows, 0) as row_count, cast(days.d < date '2024-01-31' as integer) as day_closed,
       c.stored_rows, c.value_sum, c.last_reading, ({source_rows}) as source_rows {more}
from (select distinct eqp_id from graded) t cross join days
left join content c on c.eqp_id = t.eqp_id and c.d = days.d"""


_RUNS = f"""
{_BASE},
tools as (select distinct eqp_id from graded),
runs(timestamp, first_day, end_day, known_before) as (
  values ('2024-01-23', date '2023-12-25', date '2024-01-23', timestamp '2024-01-23 12:00:00'),
         ('2024-01-30', date '2024-01-01', date '2024-01-30', timestamp '2024-02-01 00:00:00')),
facts as (
  select n.timestamp, r.eqp_id, r.d, count(*) as n
  from readings r join (select distinct eqp_id, spec_id from graded) using (eqp_id, spec_id)
  join runs n on r.act_time < n.known_before group by all),
units as (
  select n.timestamp, t.eqp_id, cast(g.d as date) as d,
         n.timestamp = '2024-01-30' and g.d < date '2024-01-23' as was_there
  from runs n cross join tools t, generate_series(n.first_day::timestamp, n.end_day::timestamp, interval 1 day) g(d)),
logged as (
  select u.*, f.n, case when was_there then 'skipped_existing' when f.n is null then 'empty' else 'wrote' end as status
  from units u left join facts f using (timestamp, eqp_id, d))
"""

ORACLE |= {
    "refresh_new_tool": _cache(
        "graded", "select count(*) from kept where eqp_id = (select max(eqp_id) from graded)"
    ),
    "refresh_new_spec": _cache(
        "(select * from graded where pattern <> 'PATTERN_D')", "select count(*) from kept where processid = 'view'"
    ),
    "refresh_verified": _cache("graded", "select count(*) from kept", ", true as found_exactly, true as healed"),
    "run_log_real": f"""
{_RUNS}
select timestamp, d, count(*) as checked, count(*) filter (status = 'wrote') as uploaded,
       count(*) filter (status = 'empty') as empty, count(*) filter (status = 'skipped_existing') as skipped_existing,
       0::bigint as failed, cast(coalesce(sum(case when was_there then null else coalesce(n, 0) end), null) as bigint) as rows,
       bool_and(not was_there) as has_times
from logged group by timestamp, d""",
    "planned_units": f"""
with {READINGS}, {_DAYS},
closed as (
  select eqp_id, d, count(*) as n from readings where d < date '2024-01-23' group by eqp_id, d),
history as (select eqp_id, sum(n) as total, count(*) as days from closed group by eqp_id)
select t.eqp_id, days.d, cast(round(coalesce(h.total / h.days, (select avg(n) from closed))) as bigint) as est_rows
from (select distinct eqp_id from readings) t cross join days left join history h using (eqp_id)
where not exists (select 1 from closed c where c.eqp_id = t.eqp_id and c.d = days.d)""",
}

# Queries whose results must not depend on the size of a group or on a run before.
_SHARED = _REPORT.replace(
    "cast(user_id as varchar) || '-' || event_type as spec_id",
    "'S-' || cast(user_id // 3 as varchar) || '-' || event_type as spec_id",
)
ORACLE |= {
    "large_spec_stats": ORACLE["spec_stats"],
    "rolling_spec_stats": f"select *, 8 as days_read from ({ORACLE['spec_stats']})",
    "large_weekly_report": ORACLE["weekly_report"],
    "shared_spec_report": f"""
{_SHARED} {_REPORT_SELECT} from c_v c left join p_v p using (eqp_id, spec_id)""",
    "publish_twice": f"""
{_CURRENT_V}
select eqp_id, spec_id, cww_fail, '2024-05' as week from c_v where cww_fail = 1""",
    "catalog_republish": f"""
with {_CATALOG}
select eqp_id, spec_id, pattern, grade, upper_spec, lower_spec, tolerance, type from fixed""",
    "compact_twice": f"""
with {READINGS}
select * from readings
where eqp_id::bigint % 3 <> 0 or processid <> 'error'""",
    "purge_window": f"""
with {READINGS}
select eqp_id, d, count(*) as rows, max(reading_id) as last_reading
from readings where d >= date '2024-01-08' group by eqp_id, d""",
    "retry_failures": f"""
with {_LOG} select eqp_id, d, stage, error from done where status = 'failed' and day(d) % 2 = 0""",
    "file_size_profile": f"""
with {READINGS}
select distinct 'd=' || cast(d as varchar) as folder, true as has_size from readings""",
}
ORACLE["compact_resumed"] = ORACLE["compact_twice"]
ORACLE["weekly_job"] = ORACLE["weekly_report"]
ORACLE["report_resumed"] = f"""
{_BASE}, {_stats('w', "d >= date '2024-01-28'").replace('>= 5', '>= 3')},
specs as (
  select s.eqp_id, count(*) as n, sum(n_points)::bigint as points from w_stats s
  join (select distinct spec_id, eqp_id from registrations where pattern <> 'UNSUPPORTED') c using (eqp_id, spec_id)
  group by s.eqp_id),
sizes as (
  select eqp_id, count(*) as n, count(*) filter (processid = 'error') as errors
  from readings where d >= date '2024-01-28' group by eqp_id),
tools as (
  select t.eqp_id, coalesce(z.n, 0) as rows, s.n as specs, s.points,
         case when t.eqp_id::bigint % 3 = 0 then coalesce(z.errors, 0) else 0 end as lost
  from (select distinct eqp_id from registrations) t left join sizes z using (eqp_id) left join specs s using (eqp_id))
select eqp_id,
       case when rows = 0 then 'no data' when specs is null then 'no calculations' else 'calculated' end as first_state,
       case when lost = 0 then 'already processed' when rows = lost then 'no data'
            when specs is null then 'no calculations' else 'calculated' end as second_state,
       coalesce(specs, 0) as specs, coalesce(points, 0) as points
from tools"""

_SPEC_WEEKS = f"""
with {_CATALOG},
first as (select * from fixed union all by name select * from auto),
second as (
  select * replace (case when upper_spec > 50 then upper_spec + 1 else upper_spec end as upper_spec)
  from first where param_id % 5 <> 0)"""
ORACLE["catalog_as_of"] = f"""
{_SPEC_WEEKS}
select eqp_id, spec_id, type, upper_spec, asked from first, (values ('2024-05'), ('2024-07')) w(asked)
union all
select eqp_id, spec_id, type, upper_spec, '2024-09' from second"""
ORACLE["catalog_changes"] = f"""
{_SPEC_WEEKS},
early as (select * from first where param_id % 7 <> 0)
select coalesce(a.eqp_id, b.eqp_id) as eqp_id, coalesce(a.spec_id, b.spec_id) as spec_id, coalesce(a.type, b.type) as type,
       case when a.spec_id is null then 'added' when b.spec_id is null then 'removed' else 'changed' end as change,
       case when a.spec_id is not null and b.spec_id is not null then 'upper_spec' end as columns
from early a full join second b on a.eqp_id = b.eqp_id and a.spec_id = b.spec_id and a.type = b.type
where a.spec_id is null or b.spec_id is null or a.upper_spec is distinct from b.upper_spec"""
