"""DuckDB SQL for the queries of ``plans.queries``, written apart from their DataFrame form."""

from __future__ import annotations

_TRANSACTIONS = """
t as (
  select event_id as e, cast(floor(user_id / 20.0) as bigint) as space, lpad(cast(user_id as varchar), 8, '0') as key,
         case when event_type = 'error' then 'DELETE' else 'PUT' end as op,
         case when event_type <> 'error' then value end as new,
         lag(value) over (partition by user_id order by event_id) as old
  from events
),
regions as (
  select space + 1 as region_id, lpad(cast(space * 20 as varchar), 8, '0') as start_key, lpad(cast(space * 20 + 20 as varchar), 8, '0') as end_key
  from (select distinct space from t)
)"""

_LOG = (
    _TRANSACTIONS
    + """,
log as (
  select 16 * e + 4 as seq, space + 1 + (case when e % 23 = 0 then 1 else 0 end) as region_id, 'PREWRITE' as log_type, op as op_type, key,
         10 * e + 1 as start_ts, cast(0 as bigint) as commit_ts, new as new_value, old as old_value from t where e % 17 <> 0
  union all
  select 16 * e + 1, space + 1, 'PREWRITE', op, key, 10 * e + 1, 0, null, old from t where e % 13 = 0 and e % 17 <> 0 and e < 196 + 331 * space
  union all
  select case when e % 11 = 0 then 16 * e - 3 else 16 * e + 10 end, space + 1 + (case when e % 23 = 0 then 1 else 0 end), 'COMMIT', op, key,
         10 * e + 1, 10 * e + 3 + e % 5, null, null from t where e % 17 <> 0 and (e % 7 <> 0 or e % 14 = 0)
  union all
  select 16 * e + 7, space + 1 + (case when e % 23 = 0 then 1 else 0 end), 'PREWRITE', op, key, 10 * e + 1, 0, new + 1, old
  from t where e % 17 <> 0 and e % 29 = 0 and e % 7 <> 0 and new is not null
  union all
  select 16 * e + 12, space + 1 + (case when e % 23 = 0 then 1 else 0 end), 'COMMIT', op, key, 10 * e + 1, 10 * e + 3 + e % 5, null, null
  from t where e % 17 <> 0 and e % 19 = 0 and (e % 7 <> 0 or e % 14 = 0)
  union all
  select 16 * e + 6, space + 1, 'ROLLBACK', 'UNKNOWN', key, 10 * e + 1, 0, null, null from t where e % 7 = 0 and e % 17 <> 0
  union all
  select 16 * e + 10, space + 1, 'COMMITTED', op, key, 10 * e + 1, 10 * e + 3 + e % 5, new, old from t where e % 17 = 0
  union all
  select case when space % 2 = 0 then 16 * (196 + 331 * space) + 8
         else 16 * coalesce(min(e) filter (where e % 11 = 0 and e % 7 <> 0 and e % 17 <> 0 and e % 23 <> 0 and e >= 196 + 331 * space), 196 + 331 * space) end,
         space + 1, 'INITIALIZED', 'UNKNOWN', '', 0, 0, null, null from t group by space
)"""
)

_RANGED = (
    _LOG
    + """,
ranged as (
  select l.* from log l join regions r using (region_id)
  where l.log_type = 'INITIALIZED' or (l.key >= r.start_key and l.key < r.end_key)
),
pairs as (
  select c.region_id, c.key, c.start_ts, c.commit_ts, c.op_type, c.seq as c, p.seq as p, i.seq as i, p.new_value, p.old_value, p.new_value is null as fake
  from ranged c
  join ranged p on p.log_type = 'PREWRITE' and p.region_id = c.region_id and p.start_ts = c.start_ts and p.key = c.key
  join ranged i on i.log_type = 'INITIALIZED' and i.region_id = c.region_id
  where c.log_type = 'COMMIT'
),
cased as (
  select *, case when c < i and p < c and not fake then 'A' when c < i and p < i then 'B' when c < i then 'C' when p < c then 'D' else 'E' end as "case"
  from pairs
),
alive as (
  select *, case when "case" in ('A', 'D') then c when "case" = 'B' then i else p end as emit_seq from cased x
  where not ("case" = 'D' and exists (
    select 1 from ranged r where r.log_type = 'ROLLBACK' and r.region_id = x.region_id and r.start_ts = x.start_ts and r.key = x.key
      and ((r.seq > i and r.seq > p and r.seq < c) or (p < i and r.seq < i))))
),
matched as (
  select * from alive qualify row_number() over (partition by region_id, start_ts, key, commit_ts order by emit_seq, fake, case when fake then p else -p end, c) = 1
),
changes as (
  select *, case when op_type = 'PUT' and old_value is not null then 'Update' when op_type = 'PUT' then 'Insert' when op_type = 'DELETE' then 'Delete' else 'Unknown' end as operate_type
  from (
    select emit_seq, region_id, key, start_ts, commit_ts, op_type, new_value, old_value from matched
    union all
    select seq, region_id, key, start_ts, commit_ts, op_type, new_value, old_value from ranged where log_type = 'COMMITTED'
  )
)"""
)

_RESOLVED_PART = """,
resolved as (
  select tick, region_id, 5000 * (tick + 1) - 100 - 7 * region_id - (case when region_id % 4 = 0 and tick % 5 = 4 then 6000 else 0 end) as resolved_ts
  from (select distinct cast(floor(event_id / 500.0) as bigint) as tick from events), (select region_id from regions)
  where not ((region_id * 7 + tick * 3) % 11 = 4 or (region_id % 9 = 2 and tick < 2))
),
progress as (
  select *, max(resolved_ts) over w as effective_ts, max(resolved_ts) over (w rows between unbounded preceding and 1 preceding) as before
  from resolved window w as (partition by region_id order by tick)
),
front as (
  select tick, min(top) as frontier from (
    select t.tick, r.region_id, max(x.resolved_ts) as top
    from (select distinct tick from resolved) t cross join (select distinct region_id from resolved) r
    left join resolved x on x.region_id = r.region_id and x.tick <= t.tick group by t.tick, r.region_id)
  group by tick having count(top) = count(*)
),
topped as (select *, max(frontier) over (order by tick rows between unbounded preceding and 1 preceding) as top from front),
rises as (
  select tick, frontier as resolved_ts, tick - lag(tick) over (order by tick) as ticks_since from topped
  where frontier > 0 and (top is null or frontier > top)
)"""
_RESOLVED = _TRANSACTIONS + _RESOLVED_PART
_BOTH = _RANGED + _RESOLVED_PART

_SPANS = """,
spans as (
  select region_id as span_id, lpad(cast((region_id - 1) * 20 + 10 as varchar), 8, '0') as start_key,
         lpad(cast((region_id + 1) * 20 + 10 as varchar), 8, '0') as end_key from regions
),
divided as (
  select span_id, region_id, greatest(s.start_key, r.start_key) as start_key, least(s.end_key, r.end_key) as end_key
  from spans s join regions r on s.start_key < r.end_key and r.start_key < s.end_key
)"""

_FORWARDS = """,
forwards as (
  select tick * 100000 + region_id as seq, start_key, end_key, resolved_ts as ts from resolved join regions using (region_id)
  union all select 0, '', '~', 0
),
lasts as (select start_key, end_key, arg_max(ts, seq) as ts, max(seq) as seq from forwards group by start_key, end_key),
bounds as (select key, max(seq) as made from (select start_key as key, seq from lasts union all select end_key, seq from lasts) group by key),
stay as (select key from bounds b where not exists (select 1 from lasts f where f.seq > b.made and f.start_key < b.key and b.key < f.end_key)),
segments as (
  select s.key as start_key, coalesce(arg_max(f.ts, f.seq), 9223372036854775807) as ts
  from stay s left join lasts f on f.start_key <= s.key and s.key < f.end_key group by s.key
)"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}{body.strip() if body.lstrip().startswith(chr(44)) else chr(10) + body.strip()}"


def _cases(*cases: str) -> str:
    listed = ", ".join(f"'{c}'" for c in cases)
    return _with(_RANGED, f'select "case", emit_seq, region_id, key, start_ts, commit_ts, new_value from matched where "case" in ({listed})')


_TYPE = "case when op_type = 'PUT' and old_value is not null then 'Update' when op_type = 'PUT' then 'Insert' when op_type = 'DELETE' then 'Delete' else 'Unknown' end"
_ASOF = """
asof_rows as (
  select {columns}, coalesce(r.resolved_ts, -1) as frontier_ts
  from {source} asof left join (select tick * 8000 + 7000 as from_seq, resolved_ts from rises) r on {at} >= r.from_seq
)"""

#: Text in groups of eight bytes, each with a byte that is FF less its padding; ASCII only.
_GROUPS = """array_to_string(list_transform(range(0, length({0}) // 8 + 1), lambda g:
    rpad(hex({0}[8 * g + 1 : 8 * g + 8]), 16, '0') || hex(255 - (8 - length({0}[8 * g + 1 : 8 * g + 8])))), '')"""

ORACLES: dict[str, str] = {
    "op_classify": _with(
        _LOG,
        f"""select seq, region_id, {_TYPE} as operate_type, case {_TYPE} when 'Insert' then 1 when 'Delete' then 2 when 'Update' then 3 else 7 end as operate_code,
        {_TYPE} as operate_name from log where log_type in ('PREWRITE', 'COMMITTED')""",
    ),
    "key_range_filter": _with(_RANGED, "select seq, region_id, log_type, key from ranged"),
    "region_assign": _with(_LOG, "select l.seq, l.key, r.region_id from log l join regions r on l.key >= r.start_key and l.key < r.end_key where l.log_type = 'COMMIT'"),
    "prewrite_commit_match": _cases("A", "D"),
    "early_commit_match": _cases("C", "E"),
    "cached_commit_release": _cases("B"),
    "rollback_anti": _with(_RANGED, """select region_id, count(*) as pairs, max(c) as last_seq from alive where "case" = 'D' group by region_id"""),
    "committed_passthrough": _with(_RANGED, "select seq as emit_seq, region_id, key, commit_ts, new_value, old_value from ranged where log_type = 'COMMITTED'"),
    "fake_prewrite_dedup": _with(
        _LOG,
        """select seq, region_id, key, start_ts, new_value, old_value from log where log_type = 'PREWRITE'
        qualify row_number() over (partition by region_id, start_ts, key order by new_value is null, case when new_value is null then seq else -seq end) = 1""",
    ),
    "changelog_ordered": _with(_RANGED, "select emit_seq, region_id, key, start_ts, commit_ts, new_value, old_value, operate_type from changes order by commit_ts, region_id, key, start_ts"),
    "update_split": _with(
        _RANGED,
        """select emit_seq, region_id, key, commit_ts, operate_type, 'delete' as split_kind, cast(null as double) as new_value, old_value from changes where operate_type = 'Update'
        union all select emit_seq, region_id, key, commit_ts, operate_type, 'insert', new_value, null from changes where operate_type = 'Update'
        union all select emit_seq, region_id, key, commit_ts, operate_type, 'whole', new_value, old_value from changes where operate_type <> 'Update'""",
    ),
    "resolved_max_merge": _with(_RESOLVED, "select region_id, tick, effective_ts from progress"),
    "resolved_regressions": _with(_RESOLVED, "select region_id, tick, resolved_ts, effective_ts from progress where resolved_ts < before"),
    "resolved_accept": _with(
        _RESOLVED,
        """select region_id, case when ok then n else l end as resolved_ts, ok as accepted from (
          select a.region_id, a.resolved_ts as l, b.resolved_ts as n, coalesce(a.region_id % 5 <> 0 and a.region_id % 7 <> 0 and b.resolved_ts >= a.resolved_ts, false) as ok
          from resolved a left join (select * from resolved where tick = 4) b using (region_id) where a.tick = 3)""",
    ),
    "region_frontier": _with(_RESOLVED, "select tick, frontier from front"),
    "frontier_advances": _with(_RESOLVED, "select * from rises"),
    "frontier_segments": _with(_RESOLVED + _FORWARDS, "select * from segments"),
    "slowest_range": _with(
        _RESOLVED + _FORWARDS,
        """select start_key, (select min(start_key) from segments n where n.start_key > s.start_key) as end_key, ts
        from segments s where start_key <> '' order by ts, start_key limit 1""",
    ),
    "late_filter_asof": _with(
        _BOTH + "," + _ASOF.format(columns="c.emit_seq, c.region_id, c.key, c.commit_ts", source="changes c", at="c.emit_seq"),
        "select emit_seq, region_id, key, commit_ts, frontier_ts from asof_rows where commit_ts > frontier_ts",
    ),
    "commit_ts_violations": _with(
        _BOTH + "," + _ASOF.format(columns="c.seq, c.region_id, c.log_type, c.commit_ts", source="(select * from ranged where log_type in ('COMMIT', 'COMMITTED')) c", at="c.seq"),
        """select seq, region_id, log_type, commit_ts, frontier_ts,
        case when log_type = 'COMMITTED' then commit_ts <= frontier_ts else commit_ts < frontier_ts end as violates_resolved from asof_rows""",
    ),
    "end_ts_stop": _with(_RANGED, "select emit_seq, region_id, key, commit_ts from changes where commit_ts <= 50000"),
    "start_rewind": _with(_RANGED, "select emit_seq, region_id, key, commit_ts from changes where commit_ts > 60000 - 20000"),
    "checkpoint_progress": _with(
        _RANGED,
        """select emit_seq, region_id, key, commit_ts, max(commit_ts) over (partition by region_id order by emit_seq, commit_ts, start_ts) as checkpoint_ts from changes""",
    ),
    "range_intersect": _with(_TRANSACTIONS + _SPANS, "select span_id, start_key, end_key from divided where span_id = region_id"),
    "range_compare": _with(
        _TRANSACTIONS + _SPANS,
        """select span_id, case when span_id % 3 = 0 then -1 else sign(case when s.start_key > r.start_key then 1 when s.start_key < r.start_key then -1 else 0 end) end as starts,
        case when span_id % 4 = 0 then 1 else case when s.end_key > r.end_key then 1 when s.end_key < r.end_key then -1 else 0 end end as ends
        from spans s join regions r on span_id = region_id""",
    ),
    "range_contains": _with(
        _TRANSACTIONS,
        """select * from (select region_id as span_id, lpad(cast((region_id - 1) * 20 + region_id % 3 as varchar), 8, '0') as start_key,
          lpad(cast((region_id - 1) * 20 + 19 + region_id % 3 as varchar), 8, '0') as end_key from regions) s
        where exists (select 1 from regions r where r.start_key <= s.start_key and s.end_key <= r.end_key)""",
    ),
    "region_division": _with(_TRANSACTIONS + _SPANS, "select span_id, region_id, start_key, end_key, cast(42 as bigint) as resolved_ts from divided"),
    "epoch_redivide": _with(
        _TRANSACTIONS,
        """select region_id, cast(1 as bigint) as conf_ver, region_id % 3 as version, cast(case when region_id % 5 = 0 then 2 else 1 end as bigint) as new_conf_ver,
        region_id % 3 + (case when region_id % 4 = 0 then 1 else 0 end) as new_version from regions where region_id % 5 = 0 or region_id % 4 = 0""",
    ),
    "restart_min_ts": _with(
        _RESOLVED + _SPANS,
        """select d.span_id as error_id, d.region_id, least(e.resolved_ts, f.first_ts) as restart_ts from divided d
        join (select region_id, arg_max(resolved_ts, tick) as resolved_ts from resolved where tick <= 2 group by region_id) e on e.region_id = d.span_id
        join (select span_id, arg_min(resolved_ts, region_id) as first_ts from divided join (select region_id, arg_max(resolved_ts, tick) as resolved_ts from resolved where tick <= 2 group by region_id) using (region_id) group by span_id) f on f.span_id = d.span_id""",
    ),
    "handle_space_splits": """select i as split,
        case when i > 0 then cast(-9223372036854775808::hugeint + d * i as bigint) end as low,
        case when i < 999 then cast(-9223372036854775808::hugeint + d * (i + 1) as bigint) end as high
        from (select range as i, (18446744073709551614::hugeint // 1000) as d from range(1000))""",
    "stale_request_drop": _with(
        _LOG,
        """select seq, region_id, request_id from (
          select seq, region_id, request_id, max(request_id) over (partition by region_id order by seq) as newest from (
            select seq, region_id, cast(floor(seq / 5000.0) as bigint) + 1 - (case when seq % 29 = 0 then 1 else 0 end) as request_id from log where log_type <> 'INITIALIZED')
        ) where request_id >= newest""",
    ),
    "unknown_region_drop": _with(_LOG, "select seq, region_id, log_type from log where region_id in (select region_id from regions where region_id % 3 <> 0)"),
    "stopped_region_drop": _with(_LOG, "select seq, region_id, log_type from log where region_id not in (select region_id from regions where region_id % 3 = 0)"),
    "table_store_stats": _with(
        _BOTH,
        """select cast(7 as bigint) as table_id, region_id % 3 as store_id, count(distinct region_id) as region_count, max(r) as resolved_ts, max(c) as commit_ts
        from regions left join (select region_id, max(commit_ts) as c from changes group by region_id) using (region_id)
        left join (select region_id, max(resolved_ts) as r from resolved group by region_id) using (region_id) group by region_id % 3""",
    ),
    "flow_units": _with(
        _LOG,
        """select message_id, cast(greatest(1, sum(greatest(1, n))) as bigint) as units from (
          select cast(floor(seq / 640.0) as bigint) as message_id, region_id, count(*) filter (where log_type = 'COMMIT') as n from log group by all) group by message_id""",
    ),
    "message_counts": _with(_LOG, "select log_type, cast(1 as bigint) as kb, count(*) as entries, count(*) filter (where key <> '') as with_key from log group by log_type"),
    "penalty_streak": _with(
        _RESOLVED,
        """select region_id, tick, resolved_ts, row_number() over (partition by region_id, run order by tick) - 1 as penalty from (
          select *, sum(case when before is null or resolved_ts > before then 1 else 0 end) over (partition by region_id order by tick) as run from progress)""",
    ),
    "lag_topk": _with(
        _RESOLVED,
        """select region_id, resolved_ts, 200000 - resolved_ts as lag from (select region_id, arg_max(resolved_ts, tick) as resolved_ts from resolved group by region_id)
        where 200000 - resolved_ts >= 20000 order by lag desc, region_id limit 64""",
    ),
    "stuck_gaps": _with(_RESOLVED, "select * from rises where ticks_since > 1"),
    "backoff_schedule": """select range as failures, cast(case when range <= 1 then 0 when range = 2 then 500 else least(8000, 2000 * (1 << (range - 3))) end as bigint) as least_ms,
        cast(case when range <= 1 then 0 when range = 2 then 999 else least(8000, 2000 * (1 << (range - 3))) end as bigint) as most_ms from range(1, 11)""",
    "slot_bucket": _with(_LOG, "select region_id % 4 as slot, count(*) as entries, count(distinct region_id) as regions from log group by region_id % 4"),
    "clamped_difference": _with(
        _LOG,
        """select seq, region_id, log_type, cast(greatest(-9223372036854775808::hugeint, least(9223372036854775807::hugeint,
          (case when start_ts % 3 = 0 then -9223372036854775808::hugeint + start_ts else start_ts::hugeint end) - start_ts::hugeint * 2)) as bigint) as difference from log""",
    ),
    "prewrite_echo": _with(_RANGED, """select emit_seq, region_id, key, start_ts, new_value from matched where "case" in ('C', 'E')"""),
    "entry_copy": _with(_LOG, "select seq, region_id, log_type, op_type, key, start_ts, commit_ts from log"),
    "table_key_range": _with(
        _TRANSACTIONS,
        "select region_id, '748' || lpad(hex(region_id), 15, '0') || '5F72' as start_key, '748' || lpad(hex(region_id), 15, '0') || '5F73' as end_key from regions",
    ),
    "table_columns": "select cast(row_number() over () - 1 as integer) as position, column_name as name from (describe select * from events)",
    "key_columns_by_place": """select cast(row_number() over (order by nth) - 1 as integer) as position, column_name as name
        from (select row_number() over () as nth, column_name from (describe select * from lineitem)) where column_name in ('l_orderkey', 'l_linenumber')""",
    "id_allocation": _with(_LOG, "select count(*) as entries, count(*) as ids, cast(1 as bigint) as least, count(*) as greatest from log"),
    "resolved_fan_out": _with(
        _TRANSACTIONS,
        "select tick, region_id, cast(35000 as bigint) as resolved_ts from (select distinct cast(floor(event_id / 500.0) as bigint) as tick from events), (select region_id from regions)",
    ),
    "penalty_by_event_time": _with(
        _RESOLVED,
        """, runs as (
          select *, tick * 10 - (case when tick % 3 = 0 then 25 else 0 end) as event_time,
                 sum(case when before is null or resolved_ts > before then 1 else 0 end) over (partition by region_id order by tick) as run from progress
        ), counted as (
          select *, case when event_time > max(event_time) over (partition by region_id, run order by tick rows between unbounded preceding and 1 preceding) then 1 else 0 end as one from runs
        )
        select region_id, tick as seq, resolved_ts, event_time, cast(sum(one) over (partition by region_id, run order by tick) as bigint) as penalty from counted""",
    ),
    "lock_sweep": _with(
        _RESOLVED,
        """select *, case when 2500000 - resolved_ts > 2400000 and 2500000 - event_time > 2400000 then 'reconnect' when penalty >= 10 then 'resolve' else 'wait' end as action
        from (select region_id, max(resolved_ts) as resolved_ts, region_id * 1000 as event_time, region_id % 20 as penalty from resolved group by region_id)
        where 2500000 - resolved_ts >= 20000 order by resolved_ts, region_id limit 64""",
    ),
    "sorted_regions": _with(_TRANSACTIONS, "select * from regions order by region_id"),
    "region_recovery": _with(
        _RESOLVED + _SPANS,
        """, last as (select region_id, min(resolved_ts) as ts from resolved group by region_id),
        moved as (select region_id, region_id % 2 = 0 and region_id % 5 <> 0 and region_id % 4 <> 0 as stays from regions),
        parts as (select d.*, l.ts from divided d join last l using (region_id) join moved m on m.region_id = d.span_id where not m.stays)
        select p.span_id as error_id, 'redivide' as action, p.region_id, p.start_key, p.end_key, least(l.ts, f.ts) as restart_ts
        from parts p join last l on l.region_id = p.span_id join (select span_id, arg_min(ts, region_id) as ts from parts group by span_id) f on f.span_id = p.span_id
        union all
        select s.span_id, 'relocate', s.span_id, s.start_key, s.end_key, l.ts from spans s join moved m on m.region_id = s.span_id join last l on l.region_id = s.span_id where m.stays""",
    ),
    "time_since_event": "select event_id, cast(floor((epoch_us(timestamp '2030-01-01 00:00:00') - epoch_us(ts)) / 1000) as bigint) as ms from events",
    "packed_datetime_decode": "select event_id, regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '') as at from events",
    "pk_string_decode": _with(_LOG, "select seq, key as pk from log where log_type = 'COMMIT'"),
    "memcomparable_hex": _with(
        _TRANSACTIONS,
        """select distinct key, hex(key) || 'FF' || '0000000000000000F7' as encoded, hex(key) || 'FF' || hex(op[1]) || '00000000000000F8' as longer_encoded, key || op[1] as longer from t""",
    ),
    "composite_key_decode": f"""
        with c as (select c_custkey, case when c_custkey % 11 <> 0 then c_mktsegment end as segment, c_name as name, 3 - c_custkey as number, c_custkey % 60 as second from customer)
        select c_custkey,
            coalesce('01' || {_GROUPS.format("segment")}, '00') || '03' || lpad(hex((number::hugeint + 9223372036854775808)::ubigint), 16, '0')
            || '04' || lpad(hex((((((2000 * 13 + 1)::bigint << 5) + 1) << 17) | second) << 24), 16, '0') || '01' || {_GROUPS.format("name")} as encoded,
            segment, number, '2000-01-01 00:00:' || lpad(second::varchar, 2, '0') as at, name
        from c
    """,
    "snapshot_latest": _with(
        _RANGED,
        """select key, new_value, commit_ts from changes qualify row_number() over (partition by key order by commit_ts desc, start_ts desc) = 1 and operate_type <> 'Delete'""",
    ),
    "snapshot_asof": _with(
        _RANGED,
        """select key, new_value, commit_ts from (select * from changes where commit_ts <= 40000)
        qualify row_number() over (partition by key order by commit_ts desc, start_ts desc) = 1 and operate_type <> 'Delete'""",
    ),
    "change_counts": _with(_RANGED, "select cast(floor(commit_ts / 10000.0) as bigint) as window, operate_type, count(*) as n, round(sum(new_value), 3) as total from changes group by all"),
}
