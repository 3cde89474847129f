"""DuckDB SQL that states the registered queries anew, over the same tables."""

from __future__ import annotations

import json
import re

from strandflow.plans.driver_views import ACT, DAY_US, OBS, PROFILE as P
from strandflow.profile import METRICS

KEYS = "session_id, episode_id"
EP = f"partition by {KEYS}"
DT, GAP = P.dt_us, P.max_gap_us
Q, DQ, A = ["q_0", "q_1", "q_2"], ["dq_0", "dq_1", "dq_2"], ["act_q_0", "act_q_1", "act_q_2"]
CH = [*Q, "grip", *A]
QUAT = ["ee_qx", "ee_qy", "ee_qz", "ee_qw"]
HELD = [*Q, *DQ, *QUAT, "grip", *A]


def _join(items, by=", "):
    return by.join(items)


def _slope(x: str) -> str:
    return f"case when rn = 1 then lead({x}) over e - {x} when rn = n then {x} - lag({x}) over e else (lead({x}) over e - lag({x}) over e) / 2.0 end"


def _value(c: str) -> str:
    return f"case when g = t_us or t2 is null then {c} when t2 - t_us > {GAP} then null else {c} + (n_{c} - {c}) * ((g - t_us) / (t2 - t_us)) end as {c}"


def _penalty(m: str) -> str:
    a = P.anchors[m]
    return f"least(greatest(({m} - {a.good}) / ({a.bad} - {a.good}), 0.0), 1.0)"


_RAW = f"""
ev as (select event_id, user_id, cast((day(ts) - 1) // 10 as int) as block, epoch_us(ts) as t_us, value, event_type, cast(json_extract_string(props, '$.k') as double) as k,
  cast(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) as double) - 1 as code from events),
raw1 as (select event_id, user_id, t_us, case when user_id % 9 = 4 then 7.0::double when user_id % 9 = 5 then 3.7::double else 4.0::double end as rate, case when event_type = 'error' and event_id % 25 = 0 then null else value end as q_0, k as q_1, code as q_2, k / 100 as grip,
  cast((event_id * 7) % 41 - 20 as double) as act_q_0, k - 50 as act_q_1, code - 2 as act_q_2,
  'episode_' || block || case (user_id + block) % 10 when 0 then '_fail' when 1 then '_ABORT' else '_ok' end as stem,
  unnest(case when user_id % 10 = 3 then ['', 'c'] else [''] end) as copy from ev),
raw as (select *, cast(user_id as varchar) || copy as session_id, cast(user_id as varchar) || copy || '__' || stem as episode_id from raw1)"""
# every grid point by its number, matched with the last sample at or before it
_GRID = f"""{_RAW},
w as (select *, lead(t_us) over e as t2, {_join(f"lead({c}) over e as n_{c}" for c in CH)} from raw window e as ({EP} order by t_us, event_id)),
ends as (select {KEYS}, min(t_us) as t0, max(t_us) as tn, min(rate) as hz from raw group by all),
pts as (select *, unnest(range(cast(ceil((tn - t0) * hz / {DAY_US}) as bigint) + 2)) as k from ends),
gp as (select *, t0 + cast(floor(k * {DAY_US}.0::double / hz + 0.001) as bigint) as g from pts),
gq as (select * from gp where g < tn + {DAY_US}.0::double / hz / 2),
grid as (select gq.session_id, gq.episode_id, cast(k as int) as step, g - t0 as t_us, {_join(map(_value, CH))},
  case when t2 is null then g - w.t_us else least(g - w.t_us, t2 - g) end > {DAY_US}.0::double / hz / 2 as off_grid
  from gq asof join w on gq.session_id = w.session_id and gq.episode_id = w.episode_id and gq.g >= w.t_us)"""
_STEPS = f"""{_GRID},
s0 as (select *, row_number() over ({EP} order by t_us, step) as rn, count(*) over ({EP}) as n from grid),
s1 as (select * exclude (rn, n), cast(replace(session_id, 'c', '') as int) % 13 as kind, {_join(f"({_slope(q)}) / nullif(({_slope('t_us')}) / 1e6, 0) as {d}" for q, d in zip(Q, DQ, strict=True))} from s0 window e as ({EP} order by t_us, step)),
steps as (select * replace (case when kind = 7 and step = 5 then null when kind = 8 and step = 9 then t_us - {10 * DAY_US} else t_us end as t_us, case when kind = 9 then grip + 0.5 else grip end as grip,
  case when kind = 10 then act_q_1 * 3 else act_q_1 end as act_q_1), case when kind = 11 then 0.6::double end as ee_qx, case when kind = 11 then 0.0::double end as ee_qy, case when kind = 11 then 0.0::double end as ee_qz, case when kind = 11 then 1.0::double end as ee_qw from s1)"""
_EPISODES = f"""{_STEPS},
meta as (select {KEYS}, min(user_id) as user_id, min(stem) as stem from raw group by all),
d0 as (select {KEYS}, cast(t_us - lag(t_us) over ({EP} order by t_us, event_id) as double) as dt from raw),
timing as (select {KEYS}, count(*) as n_raw, case when count(*) >= 3 then coalesce(stddev_pop(dt) / nullif(avg(dt), 0), 0) else 0.0 end as raw_dt_jitter,
  case when count(*) >= 3 then coalesce(sum(case when dt > {GAP} then dt else 0 end) / nullif(sum(dt), 0), 0) else 0.0 end as raw_gap_fraction from d0 group by all),
made as (select {KEYS}, count(*) as n_steps, avg(cast(off_grid as double)) as interp_fraction, max(t_us) / 1e6 as duration_s from grid group by all),
episodes as (select {KEYS}, n_raw, raw_dt_jitter, raw_gap_fraction, n_steps, interp_fraction, duration_s, 'op' || user_id % 4 as operator_id, 'task' || user_id % 5 as task_id,
  not regexp_matches(stem, '(?i)(fail|bad|abort)') as success from meta join timing using ({KEYS}) join made using ({KEYS}))"""
_METRICS = f"""{_EPISODES},
m0 as (select *, {_join(f"abs({a} - lag({a}) over e) as j{i}, abs(lead({q}) over e - {q} - {a}) as d{i}" for i, (q, a) in enumerate(zip(Q, A, strict=True)))},
  row_number() over ({EP} order by grip is null, step) as gr from steps window e as ({EP} order by step)),
m1 as (select *, {_join(f"median(j{i}) over ({EP}) as m{i}" for i in range(3))}, case when grip is null then null when gr = 1 then cast(grip > 0.5 as int) when grip > 0.6 then 1 when grip < 0.4 then 0 end as mark from m0),
m2 as (select *, {_join(f"1.4826 * median(abs(j{i} - m{i})) over ({EP}) as s{i}" for i in range(3))},
  last_value(mark ignore nulls) over ({EP} order by step rows between unbounded preceding and 1 preceding) as held from m1),
sm as (select {KEYS}, count(*) as n_steps, avg(cast({_join((f"{c} is null" for c in [*Q, *DQ, *A]), " or ")} as double)) as dropped,
  coalesce(1 - ({_join((f"count({c})" for c in HELD), " + ")}) / nullif(count(*) * ({_join((f"cast(count({c}) > 0 as int)" for c in HELD), " + ")}), 0), 1.0) as nan_fraction,
  avg(cast(sqrt({_join((f"coalesce({d}, 0) ** 2" for d in DQ), " + ")}) < {P.idle_speed_eps} as double)) as idle_fraction,
  coalesce(avg(case when coalesce({_join(A)}) is not null then cast(greatest({_join(f"abs({a})" for a in A)}) >= {0.98 * P.action_limit} as double) end), 0.0) as action_saturation,
  case when count(*) < 3 then 0.0 else sum(cast({_join((f"coalesce(s{i} > 0 and j{i} > m{i} + {P.jerk_spike_k} * s{i}, false)" for i in range(3)), " or ")} as double)) / (count(*) - 1) end as jerk_spike_rate,
  case when count(grip) < 2 then 0 else count(*) filter (where mark <> held) end as grip_changes,
  case when count(*) < 2 then 0.0 else coalesce(({_join((f"coalesce(sum(d{i}), 0)" for i in range(3)), " + ")}) / nullif({_join((f"count(d{i})" for i in range(3)), " + ")}, 0), 0.0) end as tracking_error
  from m2 group by all)"""


def _zabs(keys: str, name: str) -> str:
    return f"""{name}0 as (select *, median(duration_s) over (partition by {keys}) as mid, count(duration_s) over (partition by {keys}) as size from episodes),
{name} as (select * exclude (mid, size, sc), case when size < 3 or sc <= 0 then 0.0 else abs(duration_s - mid) / nullif(sc, 0) end as duration_zabs
  from (select *, coalesce(1.4826 * median(abs(duration_s - mid)) over (partition by {keys}), 0) as sc from {name}0))"""


def _quality(keys: str) -> str:
    w = sum(P.anchors[m].weight for m in METRICS)
    flags = _join(f"case when {m} >= {P.anchors[m].flag_at} then '{m}' end" for m in METRICS)
    return f"""{_METRICS}, {_zabs(keys, "z")},
mm as (select z.*, greatest(dropped, raw_gap_fraction) as dropped_frame_rate, raw_dt_jitter as timing_jitter, nan_fraction, idle_fraction, action_saturation, jerk_spike_rate,
  case when duration_s > 0 then grip_changes / nullif(duration_s, 0) else 0.0 end as gripper_chatter_hz, tracking_error from z join sm using ({KEYS})),
q0 as (select *, 100 * (1 - ({_join((f"{float(P.anchors[m].weight)} * {_penalty(m)}" for m in METRICS), " + ")}) / {w}) as score,
  list_filter([{flags}], lambda x: x is not null) as flags,
  list_filter([case when nan_fraction > {P.hard_max_nan} then 'nan_fraction' end, case when dropped_frame_rate > {P.hard_max_dropped} then 'dropped_frame_rate' end, case when n_steps < {P.hard_min_steps} then 'n_steps' end], lambda x: x is not null) as reasons from mm),
quality as (select *, case when len(reasons) > 0 then 'reject' when score >= {P.gold} then 'gold' when score >= {P.silver} then 'silver' else 'reject' end as tier from q0)"""


_Q = _quality("task_id")


def _validation(base: str) -> str:
    excess = _join(f"{lo} - {q}, {q} - {up}" for q, lo, up in zip(Q, P.lower, P.upper, strict=True))
    nan = f"1 - ({_join((f'count({c})' for c in HELD), ' + ')}) / nullif(count(*) * ({_join((f'cast(count({c}) > 0 as int)' for c in HELD), ' + ')}), 0)"
    rules = [
        ("too_short", f"n < {P.min_steps}", "error"), ("too_long", f"n > {P.max_steps}", "error"), ("nonfinite_time", "n >= 2 and no_time > 0", "error"),
        ("time_not_increasing", "n >= 2 and no_time = 0 and not_inc > 0", "error"), ("dt_mismatch", f"n >= 2 and no_time = 0 and not_inc = 0 and abs(mean_dt - {DT}) / {DT} > {P.max_mean_dt_error}", "error"),
        ("columns_absent", "n >= 2", "warning"), ("excess_nan", f"n >= 2 and nan_share > {P.max_nan_fraction}", "error"),
        ("joint_limit_violation", f"n >= 2 and excess > {P.limit_tolerance}", "error"), ("joint_limit_grazed", f"n >= 2 and excess > 0 and excess <= {P.limit_tolerance}", "warning"),
        ("quaternion_not_unit", "n >= 2 and quat_off > 0.05", "warning"),
        ("gripper_out_of_range", "n >= 2 and (min_grip < -0.01 or max_grip > 1.01)", "warning"), ("action_over_limit", f"n >= 2 and peak > {1.05 * P.action_limit}", "warning"),
    ]
    union = " union all ".join(f"select {KEYS}, '{c}' as code, '{s}' as severity from measured where {w}" for c, w, s in rules)
    return f"""{base},
v0 as (select *, cast(t_us - lag(t_us) over ({EP} order by step) as double) as dt from steps),
measured as (select {KEYS}, count(*) as n, count(*) filter (where t_us is null) as no_time, max(abs(sqrt(ee_qx ** 2 + ee_qy ** 2 + ee_qz ** 2 + ee_qw ** 2) - 1)) as quat_off, count(*) filter (where dt <= 0) as not_inc, avg(dt) as mean_dt, {nan} as nan_share, coalesce(max(greatest({excess}, 0.0)), 0) as excess,
  min(grip) as min_grip, max(grip) as max_grip, max(greatest({_join(f"abs({a})" for a in A)})) as peak from v0 group by all),
issues as ({union}),
validation as (select {KEYS}, n >= 2 and not exists (select 1 from issues i where i.session_id = m.session_id and i.episode_id = m.episode_id and severity = 'error') as ok,
  exists (select 1 from issues i where i.session_id = m.session_id and i.episode_id = m.episode_id) as any_issue from measured m)"""


_V, _QV = _validation(_STEPS), _validation(_Q)
_cell = lambda c: f"coalesce(cast(cast(round({c} * 1e6) as bigint) as varchar), '-')"


def _line(step: str, channels: list[str]) -> str:
    return " || ',' || ".join([f"coalesce(cast({c} as varchar), '-')" for c in (step, "t_us")] + [_cell(c) if c in HELD else "'-'" for c in channels])


def _summed(name: str, rows: str, step: str, channels: list[str]) -> str:
    """(keys, content): the sum of the rows' md5 modulo 2^128."""
    line = _line(step, channels)
    words = _join(f"sum(cast('0x' || substr(d, {8 * i + 1}, 8) as hugeint)) as w{i}" for i in range(4))
    carry = "".join(f"{name}_{i} as (select * replace (w{i} + w{i + 1} // 4294967296 as w{i}) from {name}_{i + 1}),\n" for i in (2, 1, 0))
    digits = _join(f"cast(w{i} % 4294967296 as bigint)" for i in range(4))
    return f"""{name}_d as (select {KEYS}, md5({line}) as d from {rows}),
{name}_3 as (select {KEYS}, {words} from {name}_d group by all),
{carry}{name} as (select {KEYS}, printf('%08x%08x%08x%08x', {digits}) as content from {name}_0)"""

_SHARE = "cast(('0x' || substr(sha256('{seed}:' || {id}), 1, 8)) as bigint) / 4294967296.0"
_share = lambda x: _SHARE.format(seed=P.seed, id=x)
_side = lambda x: f"case when {_share(x)} < {P.val_fraction} then 'val' else 'train' end"
_GATED = f"""{_QV},
gated as (select q.*, ok, case when not ok then 'invalid' when tier = 'reject' then 'tier:reject' when not success then 'failed' end as exclude_reason from quality q join validation using ({KEYS}))"""


def _build(content: str) -> str:
    return f"""{_GATED},
kept as (select s.* from steps s join gated using ({KEYS}) where exclude_reason is null),
{content},
ranked as (select g.*, content, row_number() over (partition by content order by session_id, episode_id) as cr from gated g left join content using ({KEYS})),
mem0 as (select * exclude (exclude_reason), case when content is not null and cr > 1 then 'duplicate' else exclude_reason end as exclude_reason from ranked),
pa as (select k.*, {_join(f"case when row_number() over e = 1 then {a} else lag({a}) over e end as prev_{a}" for a in A)} from kept k join mem0 using ({KEYS}) where mem0.exclude_reason is null window e as (partition by k.session_id, k.episode_id order by step)),
dense as (select {KEYS}, cast(row_number() over ({EP} order by t_us, step) - 1 as int) as step, t_us, {_join([*Q, "grip", *A, *(f"prev_{a}" for a in A)])}, {_side("session_id")} as split from pa where {_join((f"{c} is not null" for c in [*Q, "grip", *A, *(f"prev_{a}" for a in A)]), " and ")}),
members as (select m.* exclude (exclude_reason), case when exclude_reason is null and d.session_id is null then 'all_nan' else exclude_reason end as exclude_reason,
  case when exclude_reason is null and d.session_id is not null then {_side("m.session_id")} end as split from mem0 m left join (select distinct {KEYS} from dense) d using ({KEYS}))"""


_BUILT = _build(_summed("content", "kept", "step", P.channels()))
_LINE = _line("step", P.channels())
# every step of an episode in order, none of them folded into a sum
_ORDERED = _build(f"content as (select {KEYS}, sha256(string_agg({_LINE}, ';' order by step, {_LINE})) as content from kept group by all)")
H = P.horizon
_FILTERS = json.dumps({"min_tier": P.min_tier, "require_success": P.require_success, "val_fraction": P.val_fraction, "seed": P.seed})
_CHUNKS = f"""{_BUILT},
c0 as (select {KEYS}, split, step, {_join(f"list({a}) over ah as l_{a}, case when row_number() over e = 1 then {a} else lag({a}) over e end as p_{a}" for a in A)} from dense
  window e as ({EP} order by step), ah as ({EP} order by step rows between current row and {H - 1} following)),
chunks as (select * from c0 where len(l_act_q_0) = {H})"""
_LONG = f"""{_CHUNKS},
long as ({" union all ".join(f"select {KEYS}, step, unnest(range({H})) as k, {d} as d, unnest(l_{a}) as truth, p_{a} as persistence from chunks where split = 'val'" for d, a in enumerate(A))}),
tm as ({" union all ".join(f"select {d} as d, avg({a}) as train_mean from dense where split = 'train'" for d, a in enumerate(A))}),
pred as (select long.*, 0.0 as zero, train_mean, (persistence + train_mean) / 2 as policy from long join tm using (d))"""
_PR = ("zero", "train_mean", "persistence")
_mae = lambda p, where="": f"avg(abs({p} - truth)){where}"
_now = " filter (where k = 0)"
_ERRORS = f"{_LONG}, e as ({' union all '.join(f'select {i} as o, {chr(39)}{p}{chr(39)} as best_baseline, {_mae(p, _now)} as n, {_mae(p)} as c from pred' for i, p in enumerate(_PR))}), b as (select * from e order by c, o limit 1)"
_r = lambda x, n=6, name=None: f"round({x}, {n}) as {name or x}"


def _sql(ctes: str, select: str) -> str:
    # each step is computed once, however many read it
    return f"with {re.sub(r'(\w+) as \(select', r'\1 as materialized (select', ctes.strip())}\n{select}"


def oracle_sql() -> dict[str, str]:
    li = "li as (select cast(l_suppkey as varchar) as session_id, cast(year(l_shipdate) as varchar) as episode_id, epoch_us(l_shipdate) as t_us from lineitem)"
    emb = lambda n: _join(f"cast(embedding[{i + 1}] as double) as e{i}" for i in range(n))
    angle = lambda i: f"(q_{i % 3} / 100)"
    drift = " union all ".join(
        f"select {n} as horizon, round(avg(gap), 4) as drift, count(*) as n_rollouts from (select {KEYS}, step, sqrt({_join((f'({q} + {n} * case when row_number() over e = 1 then {a} else lag({a}) over e end - lead({q}, {n}) over e) ** 2' for q, a in zip(Q, A, strict=True)), ' + ')}) as gap, count(*) over ({EP}) as length from dense window e as ({EP} order by step)) "
        f"where length > {n} and list_contains(list_transform(range(5), lambda x: cast(floor(x * (length - {n} - 1) / 4) as bigint)), step)"
        for n in P.rollout_horizons
    )
    return {
        "scan_events": "select event_type, count(*) as n, round(sum(value), 4) as total from events where value > 50 group by 1",
        "session_meta_check": "select case when c_custkey % 7 = 0 then 'empty operator_id' when c_custkey % 11 = 0 then 'control_hz' when c_custkey % 13 = 0 then 'n_joints' else 'ok' end as reason, count(*) as n from customer group by 1",
        "success_label": _sql(_EPISODES, "select success, count(*) as n, min(episode_id) as first_id from episodes group by 1"),
        "canonicalise": _sql(_RAW, f"select session_id, event_id, t_us, {_join(_r(c) for c in CH)} from raw"),
        "resample_grid": _sql(_GRID, f"select {KEYS}, count(*) as n_steps, max(t_us) as last_us from grid group by all"),
        "resample_interp": _sql(_GRID, f"select {KEYS}, step, {_join(_r(c, 5) for c in CH)} from grid"),
        "live_resample": _sql(_GRID, f"select {KEYS}, step, {_join(_r(c, 5) for c in CH)} from grid"),
        "resample_gaps": _sql(_GRID, f"select {KEYS}, count(*) filter (where q_1 is null) as holes from grid group by all"),
        "interp_fraction": _sql(_EPISODES, f"select {KEYS}, {_r('interp_fraction')} from episodes"),
        "raw_timing": _sql(_EPISODES, f"select {KEYS}, n_raw, {_r('raw_dt_jitter')}, {_r('raw_gap_fraction')} from timing"),
        "late_steps": _sql(_RAW, f"select {KEYS}, count(*) filter (where behind > {0.25 * DT}) as late_steps from (select {KEYS}, t_us - min(t_us) over ({EP}) - (row_number() over ({EP} order by t_us, event_id) - 1) * {DT} as behind from raw) group by all"),
        "rebase_time": _sql(_RAW, f"select session_id, event_id, t_us - min(t_us) over ({EP}) as t_us from raw"),
        "derive_velocity": _sql(_STEPS, f"select {KEYS}, step, {_join(_r(d, 8) for d in DQ)} from steps"),
        "derive_action": _sql(_GRID, f"select {KEYS}, step, {_join(f'round(case when lead(1) over e is null then 0.0 else lead({q}) over e - {q} end, 5) as {a}' for q, a in zip(Q, A, strict=True))} from grid window e as ({EP} order by t_us, step)"),
        "coerce_schema": _sql(_STEPS, f"select count(*) as n, {_join(f'count({c}) as n_{c}' for c in HELD)}, {_join(f'cast(0 as bigint) as n_{c}' for c in ['ee_x', 'ee_y', 'ee_z', 'act_grip'])} from steps"),
        "ee_pose": _sql(
            _STEPS,
            f"select {KEYS}, step, round(0.30 + 0.25 * sin({angle(0)}) * cos({angle(1)}), 5) as ee_x, round(0.25 * sin({angle(1)}) * sin({angle(0)}), 5) as ee_y, round(0.40 + 0.20 * cos({angle(1)} + {angle(3)}), 5) as ee_z, "
            f"round(sin({angle(5)} / 2), 5) as ee_qx, case when q_2 is not null then 0.0::double end as ee_qy, case when q_2 is not null then 0.0::double end as ee_qz, round(cos({angle(5)} / 2), 5) as ee_qw from steps",
        ),
        "m_step_metrics": _sql(_METRICS, f"select {KEYS}, n_steps, {_join(_r(c, 5) for c in ('dropped', 'nan_fraction', 'idle_fraction', 'action_saturation', 'jerk_spike_rate'))}, grip_changes, {_r('tracking_error', 5)} from sm"),
        "m_duration_zabs": _sql(f"{_EPISODES}, {_zabs('task_id', 'z')}", f"select {KEYS}, {_r('duration_zabs', 5)} from z"),
        "robust_scale": "with a as (select l_suppkey, l_extendedprice as x, median(l_extendedprice) over (partition by l_suppkey) as m from lineitem) select l_suppkey, round(1.4826 * median(abs(x - m)), 4) as scale from a group by 1",
        "quality_score": _sql(_Q, f"select {KEYS}, {_r('score', 4)}, array_to_string(flags, ',') as flags from quality"),
        "tiering": _sql(_Q, f"select {KEYS}, tier, array_to_string(reasons, ',') as reasons from quality"),
        "session_scoring": _sql(_quality("session_id"), f"select {KEYS}, {_r('duration_zabs', 4)}, {_r('score', 4)} from quality"),
        "penalty": _sql(_Q, " union all ".join(f"select '{m}' as name, round(avg({_penalty(m)}), 5) as mean_penalty, count(*) filter (where {m} >= {P.anchors[m].flag_at}) as flagged from quality" for m in METRICS)),
        "validate_issues": _sql(_V, f"select {KEYS}, code, severity from issues"),
        "validate_ok": _sql(_V, f"select {KEYS}, ok from validation"),
        "v_time_not_increasing": _sql(f"{li}, d as (select *, t_us - lag(t_us) over ({EP} order by t_us) as dt from li)", f"select {KEYS}, count(*) as n, count(*) filter (where dt <= 0) as not_increasing from d group by all"),
        "quarantine_split": _sql(_V, f"select ok, count(*) as n_steps, count(distinct episode_id) as n_episodes from steps join validation using ({KEYS}) group by 1"),
        "corpus_summary": _sql(_Q, "select count(*) as n_episodes, round(avg(score), 4) as mean, round(median(score), 4) as median, round(quantile_cont(score, 0.1), 4) as p10, round(min(score), 4) as min, round(max(score), 4) as max from quality"),
        "tier_counts": _sql(_Q, "select tier, count(quality.tier) as n, round(count(quality.tier) / (select count(*) from quality), 6) as share from (select unnest(['gold', 'silver', 'reject']) as tier) t left join quality using (tier) group by 1"),
        "flag_counts": _sql(_Q, "select flag, count(*) as n, round(count(*) / (select count(*) from quality), 6) as share from (select unnest(flags) as flag from quality) group by 1"),
        "operator_rollup": _sql(
            f"{_Q}, f as (select operator_id, flag, count(*) as n from (select operator_id, unnest(flags) as flag from quality) group by all), t as (select operator_id, flag as top_flag from f qualify row_number() over (partition by operator_id order by n desc, list_position({list(METRICS)}, flag)) = 1)",
            "select operator_id, count(*) as n_episodes, round(avg(score), 4) as mean, count(*) filter (where tier = 'gold') as gold, count(*) filter (where tier = 'reject') as reject, any_value(top_flag) as top_flag from quality left join t using (operator_id) group by 1",
        ),
        "task_rollup": _sql(_Q, "select task_id, count(*) as n_episodes, round(avg(score), 4) as mean, count(*) filter (where tier = 'reject') as reject from quality group by 1"),
        "metric_distributions": _sql(_Q, " union all ".join(f"select '{m}' as name, round(median({m}), 4) as median, round(quantile_cont({m}, 0.9), 4) as p90, round(max({m}), 4) as max, round(avg({_penalty(m)}), 4) as mean_penalty from quality" for m in METRICS)),
        "worst_episodes": _sql(_Q, f"select {KEYS}, round(score, 4) as score, tier from quality order by quality.score, {KEYS} limit 10"),
        "validation_rollup": _sql(_V, "select code, count(*) as n from issues where severity = 'error' group by all"),
        "issue_counts": _sql(_V, "select code, severity, count(*) as n from issues group by all"),
        "validation_summary": _sql(_V, "select count(*) as checked, count(*) filter (where not ok) as failed, count(*) filter (where ok and any_issue) as warned from validation"),
        "drop_rate": _sql(_QV, f"select *, round((quarantined + rejected) / total, 6) as drop_rate, (quarantined + rejected) / total > 0.4 as alarm from (select count(*) as total, count(*) filter (where not ok) as quarantined, count(*) filter (where ok and tier = 'reject') as rejected from validation join quality using ({KEYS}))"),
        "ingest_summary": _sql(_EPISODES, "select session_id, count(*) as n_episodes, round(avg(interp_fraction), 6) as mean_interp from episodes group by 1"),
        "ingest_result": _sql(
            _EPISODES,
            "select (select count(distinct session_id) from episodes) as sessions, (select count(*) from episodes) as episodes, count(*) filter (where copy) as skipped, array_to_string(list_filter([case when count(*) filter (where copy and length(session_id) < 3) > 0 then 'n_joints:' || count(*) filter (where copy and length(session_id) < 3) end, "
            "case when count(*) filter (where copy and length(session_id) >= 3) > 0 then 'unreadable:' || count(*) filter (where copy and length(session_id) >= 3) end], lambda x: x is not null), ',') as reasons, count(*) filter (where length(session_id) >= 3) as pruned from (select distinct session_id, session_id like '%c' as copy from episodes)",
        ),
        "episode_meta": _sql(_EPISODES, f"select {KEYS}, c_mktsegment as robot_id, {_r('duration_s')} from episodes join customer on session_id = cast(c_custkey as varchar)"),
        "episodes_with_quality": _sql(_Q, f"select {KEYS}, n_steps, {_r('score', 4)}, tier, array_to_string(flags, ',') as flags from quality"),
        "project_obs": _sql(_STEPS, f"select {KEYS}, step, {_join(_r(c, 5) for c in ['grip', *Q, *A])} from steps"),
        "gate_reasons": _sql(_GATED, f"select {KEYS}, coalesce(exclude_reason, '') as exclude_reason from gated"),
        "gate_join": _sql(_GATED, "select tier, ok, count(*) as n from gated group by all"),
        "prune_orphans": _sql(_RAW, "select distinct session_id, length(session_id) < 3 or session_id like '%c' as keep from raw"),
        "dedupe_episodes": "select doc_id, row_number() over (partition by text order by doc_id) > 1 as duplicate from documents",
        "content_hash": _sql(f"{_RAW}, r as (select *, row_number() over ({EP} order by t_us, event_id) as step from raw), {_summed('c', 'r', 'step', CH)}", f"select {KEYS}, content as content_hash from c"),
        "assign_split": f"select distinct cast(o_custkey as varchar) as session_id, {_side('cast(o_custkey as varchar)')} as split from orders",
        "prev_action": _sql(_STEPS, f"select {KEYS}, step, {_join(f'round(case when row_number() over e = 1 then {a} else lag({a}) over e end, 5) as prev_{a}' for a in A)} from steps window e as ({EP} order by step)"),
        "dense_steps": _sql(_STEPS, f"select {KEYS}, cast(row_number() over ({EP} order by t_us nulls first, step) - 1 as int) as step, t_us from steps where {_join((f'{c} is not null' for c in ['q_0', 'q_1', *A]), ' and ')}"),
        "norm_stats": _sql(f"e as (select {emb(64)} from embeddings)", " union all ".join(f"select 'e{i}' as \"column\", round(avg(e{i}), 6) as mean, round(greatest(stddev_pop(e{i}), 1e-6), 6) as std from e" for i in range(64))),
        "normalise": "with s as (select avg(l_quantity) as a, stddev_pop(l_quantity) as b, avg(l_tax) as c, stddev_pop(l_tax) as d from lineitem) select l_orderkey, l_linenumber, round((l_quantity - a) / b, 5) as l_quantity, round((l_tax - c) / d, 5) as l_tax from lineitem, s",
        "split_summary": _sql(_BUILT, "select split, count(*) as n_episodes, count(distinct session_id) as n_sessions, cast(sum(n_steps) as bigint) as n_steps, string_agg(distinct operator_id, ',' order by operator_id) as operators, string_agg(distinct task_id, ',' order by task_id) as tasks, count(*) filter (where tier = 'gold') as gold, count(*) filter (where tier = 'silver') as silver, count(*) filter (where tier = 'reject') as reject, round(avg(score), 4) as mean_score from members where split is not null group by 1"),
        "exclusions": _sql(_BUILT, "select exclude_reason, count(*) as n from members where exclude_reason is not null group by 1"),
        "heldout_operators": f"with s as (select o_custkey as operator_id, {_side('cast(o_orderkey as varchar)')} as split from orders) select distinct operator_id from s where split = 'val' and operator_id not in (select operator_id from s where split = 'train')",
        "dataset_hash": _sql(
            f"{_ORDERED}, dg as (select sha256(concat_ws(':', split, session_id, episode_id, content)) as d from members where split is not null), hb as (select substr(d, 1, 4) as b, sha256(string_agg(d, '|' order by d)) as h from dg group by 1)",
            f"select substr(sha256('{_join([*Q, 'grip', *(f'prev_{a}' for a in A), *A], ',')}|' || sha256(string_agg(h, '|' order by h))), 1, 16) as dataset_hash from hb",
        ),
        "manifest": _sql(
            f"{_BUILT}, dg as (select sha256(concat_ws(':', split, session_id, episode_id, content)) as d from members where split is not null), hb as (select substr(d, 1, 4) as b, sha256(string_agg(d, '|' order by d)) as h from dg group by 1)",
            " union all ".join([
                *(f"select '{kind}' as kind, '{c}' as name, {i}.0::double as x, null::double as y, null::double as z" for kind, own in (("observation", OBS), ("action", ACT)) for i, c in enumerate(own)),
                *(f"select 'norm', '{c}', round(avg({c}), 5), round(greatest(stddev_pop({c}), 1e-6), 5), null from dense where split = 'train'" for c in [*OBS, *ACT]),
                "select 'excluded', exclude_reason, count(*), null, null from members where exclude_reason is not null group by 2",
                "select 'split', m.split, count(*), count(distinct m.session_id), (select count(*) from dense d where d.split = m.split) from members m where m.split is not null group by 2",
                f"select 'filters', '{_FILTERS}', null, null, null",
                f"select 'hash', substr(sha256('{json.dumps([OBS, ACT, json.loads(_FILTERS)])}|' || sha256(string_agg(h, '|' order by h))), 1, 16), null, null, null from hb",
            ]),
        ),
        "action_chunks": _sql(_CHUNKS, f"select {KEYS}, count(*) as n_windows, round(sum({_join((f'list_sum(l_{a})' for a in A), ' + ')}), 4) as total from chunks group by all"),
        "conversation_windows": "with c as (select cast(conv_id as varchar) as session_id, turn as \"window\", sum(length(text)) over w as chars, count(*) over w as n from conversations window w as (partition by conv_id order by turn rows between current row and 2 following)) select session_id, \"window\", cast(chars as double) as chars from c where n = 3",
        "baselines": _sql(_LONG, f"select d, cast(k as int) as k, count(*) as n, {_join(f'round(avg({c}), 5) as {c}' for c in ('truth', 'train_mean', 'persistence'))} from pred group by 1, 2"),
        "baseline_errors": _sql(_LONG, " union all ".join(f"select '{p}' as predictor, round({_mae(p, _now)}, 5) as next_step_mae, round({_mae(p)}, 5) as chunk_mae from pred" for p in _PR)),
        "mae_by_offset": _sql(_LONG, f"select cast(k as int) as k, {_join(f'round({_mae(p)}, 5) as {p}' for p in _PR)} from pred group by 1"),
        "policy_errors": _sql(_LONG, f"select round({_mae('policy', _now)}, 5) as mae, round(sqrt(avg((policy - truth) ** 2){_now}), 5) as rmse, round({_mae('policy')}, 5) as chunk_mae, round(avg(abs(policy - truth)) filter (where k = 0 and d = 2), 5) as gripper_mae, round(avg(cast((policy > 0.5) = (truth > 0.5) as double)) filter (where k = 0 and d = 2), 5) as gripper_accuracy, count(*) filter (where k = 0 and d = 0) as n_windows, count(distinct (session_id, episode_id)) as n_episodes from pred"),
        "joint_errors": _sql(_LONG, f"select d, round({_mae('policy')}, 5) as mae from pred where k = 0 group by 1"),
        "skill": _sql(
            f"{_ERRORS}, p as (select {_mae('policy', _now)} as pn, {_mae('policy')} as pc from pred)",
            "select best_baseline, round(1 - pc / nullif(c, 0), 5) as chunk_skill, round(1 - pn / nullif((select min(n) from e), 0), 5) as next_step_skill from b, p",
        ),
        "offset_curve": _sql(
            f"{_ERRORS}, oc as (select cast(k as int) as k, {_mae('policy')} as policy, case (select best_baseline from b) {_join((f'when {chr(39)}{p}{chr(39)} then {_mae(p)}' for p in _PR), ' ')} end as best from pred group by 1)",
            "select k, round(policy, 5) as policy, best_baseline, round(best, 5) as best, case when policy < best then 'policy' else best_baseline end as winner, (select bool_and(policy >= best) from oc) as loses_everywhere from oc, b",
        ),
        "cluster_bootstrap": f"with s as (select row_number() over (order by substr(md5(cast(s_nationkey as varchar)), 1, 2), s_nationkey) - 1 as g, sum(s_acctbal) as s, count(*) as n from supplier group by s_nationkey), z as (select count(*) as size from s), d as (select r, cast('0x' || substr(md5('{P.seed}:' || r || ':' || i), 1, 8) as bigint) % size as g from range({P.bootstrap_samples}) a(r), z, range(1000) b(i) where i < size), m as (select r, sum(s) / sum(n) as mean from d join s using (g) group by 1) select round(quantile_cont(mean, 0.025), 4) as low, round(quantile_cont(mean, 0.975), 4) as high from m",
        "rollout_starts": _sql(f"{_STEPS}, l as (select {KEYS}, count(*) as length from steps group by all)", f"select distinct {KEYS}, cast(unnest(list_transform(range(5), lambda x: floor(x * (length - 9) / 4))) as int) as start from l where length > 8"),
        "persistence_drift": _sql(_BUILT, drift),
        "smooth_l1": "select l_returnflag, round(avg(case when e < 0.1 then e * e / 0.2 else e - 0.05 end), 6) as loss from (select l_returnflag, abs(l_discount - l_tax * 2) as e from lineitem) group by 1",
        "gram": "with v as (select vec_id, list_concat(list_transform(embedding[1:63], lambda z: cast(z as double)), [1.0::double], [cast(embedding[64] as double)]) as x from embeddings), l as (select vec_id, unnest(range(1, 65)) as a, unnest(x[1:64]) as u from v), r as (select vec_id, unnest(range(1, 66)) as b, unnest(x) as w from v) "
        "select case when a = 64 then '1' else 'e' || (a - 1) end as i, case when b = 64 then '1' when b = 65 then 'e63' else 'e' || (b - 1) end as j, round(sum(u * w), 4) as value from l join r using (vec_id) group by a, b",
        "retry_ledger": "select distinct cast(o_custkey as varchar) as session_id from orders where o_orderstatus in ('O', 'P') and o_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT')",
    }
