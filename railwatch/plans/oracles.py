"""SQL with the results the queries must have, written for a second engine over the same tables."""

from __future__ import annotations

from railwatch.operators.health import FEATURES
from railwatch.plans.queries import FILES_OF_RUN, HOT_ORDER, LATE_BEFORE, STREAM_DELAY_DAYS

_METHOD_OF_EVENT = """case event_type when 'click' then 'upi_hdfc' when 'error' then 'upi_axis'
  when 'purchase' then 'upi_sbi' when 'signup' then 'upi_icici' when 'view' then 'card_visa' end"""

_EVENT_TXN = f"""etxn as (
  select cast(event_id as varchar) as transaction_id,
    'merchant_' || (user_id % 100) as merchant_id, 'category_' || (user_id % 5) as merchant_category,
    {_METHOD_OF_EVENT} as payment_method, value as amount_inr,
    case when event_id % 20 = 0 then 'timeout'
         when event_id % 20 = 1 or (event_type = 'error' and event_id % 4 = 1) then 'failed'
         else 'success' end as status,
    cast(floor(value * 10) + 200 as integer) as response_time_ms,
    ts as event_time, cast(ts as date) as event_date, event_id
  from events)"""

_ORDER_TXN = """otxn as (
  select cast(o_orderkey as varchar) as transaction_id, 'merchant_' || (o_custkey % 100) as merchant_id,
    c_mktsegment as merchant_category,
    case o_orderpriority when '1-URGENT' then 'upi_hdfc' when '2-HIGH' then 'upi_axis' when '3-MEDIUM' then 'upi_sbi'
      when '4-NOT SPECIFIED' then 'upi_icici' when '5-LOW' then 'card_visa' end as payment_method,
    case o_orderstatus when 'F' then 'failed' when 'P' then 'timeout' when 'O' then 'success' end as status,
    o_totalprice as amount_inr, cast(200 + (o_orderkey * 37) % 1300 as integer) as response_time_ms,
    o_orderdate as event_time, cast(o_orderdate as date) as event_date
  from orders join customer on o_custkey = c_custkey)"""

_SETTLEMENT = """settlement as (
  select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as settlement_id,
    cast(l_orderkey as varchar) as transaction_id, 'merchant_' || (o_custkey % 100) as merchant_id,
    case when l_linenumber % 5 = 0 then 0.0::double else o_totalprice end as settled_amount_inr,
    case when l_linenumber % 5 = 0 then 'failed' else 'settled' end as settlement_status,
    cast(floor(l_quantity * 10) as integer) as delay_seconds, l_shipdate as event_time
  from lineitem join orders on l_orderkey = o_orderkey)"""

_RATES = """success_count / total_transactions * 100 as success_rate_pct,
    timeout_count / total_transactions * 100 as timeout_rate_pct"""

_COUNTS = """count(*) as total_transactions,
    cast(count(*) filter (where status = 'success') as bigint) as success_count,
    cast(count(*) filter (where status = 'timeout') as bigint) as timeout_count,
    avg(response_time_ms) as avg_response_time_ms"""


def _sliding(source: str, where: str = "true") -> str:
    return f"""counted as (
  select window_start, window_start + interval 5 minute as window_end, payment_method, {_COUNTS}
  from (select *, date_trunc('minute', event_time) - n * interval 1 minute as window_start
        from {source}, range(0, 5) as r(n))
  where {where} group by window_start, payment_method),
silver as (select *, {_RATES} from counted)"""


_SLIDING = _sliding("etxn")

_HOURLY = f"""counted as (
  select date_trunc('hour', event_time) as window_start, date_trunc('hour', event_time) + interval 1 hour as window_end,
    payment_method, {_COUNTS}
  from etxn group by 1, 2, 3),
silver as (select *, {_RATES} from counted)"""

_LATEST = """latest as (
  select s.* from silver s
  join (select payment_method, max(window_end) as newest from silver where payment_method like 'upi%' group by 1) m
    on s.payment_method = m.payment_method and s.window_end = m.newest)"""


def _classify(source: str, key: str) -> str:
    group = f"group by {key}" if key else ""
    lead = f"{key}," if key else ""
    return f"""failing as (
  select {lead} count(*) as n, count(*) filter (where 100 - success_rate_pct >= 20) as bad,
    count(*) filter (where 100 - success_rate_pct >= 20 and avg_response_time_ms >= 3000) as slow,
    coalesce(string_agg(payment_method, ',' order by payment_method) filter (where 100 - success_rate_pct >= 20), '') as banks
  from {source} where payment_method like 'upi%' {group}),
classified as (
  select {lead} case when bad >= 2 then 'NPCI_SIDE_ISSUE' when bad = 1 and slow = 1 then 'PLATFORM_SIDE_ISSUE'
    when bad = 1 then 'BANK_SIDE_ISSUE' else 'HEALTHY' end as classification, banks as affected_banks
  from failing where n > 0)"""


_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"

_HISTORY = f"""with {_EVENT_TXN}, {_HOURLY}, {_classify("silver", "window_start, window_end")},
history as (select *, {_ISO.format("window_end")} as detected_at from classified)"""

_AS_OF_TEXT = "'2024-02-01T00:00:00.000000+00:00'"
_CUTOFF = "timestamp '2024-01-31 23:57:00'"

_RECON = f"with {_ORDER_TXN}, {_SETTLEMENT}, paid as (select * from otxn where status = 'success')"

_OVERDUE = f"""select transaction_id, merchant_id, amount_inr from paid p
  where event_time < {_CUTOFF} and not exists (select 1 from settlement s where s.transaction_id = p.transaction_id)"""
_ORPHANS = """select settlement_id, transaction_id, merchant_id, settled_amount_inr from settlement s
  where not exists (select 1 from paid p where p.transaction_id = s.transaction_id)"""
_AMOUNTS = """select p.transaction_id, p.merchant_id, amount_inr as txn_amount, settled_amount_inr as settled_amount
  from paid p join settlement s on p.transaction_id = s.transaction_id where amount_inr <> settled_amount_inr"""

_LOG = f"""{_RECON}, overdue as ({_OVERDUE}), orphan as ({_ORPHANS}), amounts as ({_AMOUNTS}),
log as (
  select 'SETTLEMENT_DELAYED' as mismatch_type, transaction_id, merchant_id, 'amount_inr=' || amount_inr as detail from overdue
  union all
  select 'ORPHAN_SETTLEMENT', transaction_id, merchant_id, 'settlement_id=' || settlement_id from orphan
  union all
  select 'AMOUNT_MISMATCH', transaction_id, merchant_id, 'txn=' || txn_amount || ' settled=' || settled_amount from amounts)"""

_OPS_MART = """select event_date, payment_method, merchant_category, count(*) as total_transactions,
    cast(count(*) filter (where status = 'success') as bigint) as success_count,
    cast(count(*) filter (where status = 'timeout') as bigint) as timeout_count,
    sum(amount_inr) as total_volume_inr, avg(response_time_ms) as avg_response_time_ms
  from {} group by event_date, payment_method, merchant_category"""
_OPS = f"with {_ORDER_TXN}, mart as ({_OPS_MART.format('otxn')})"
_EVENT_OPS = f"with {_EVENT_TXN}, mart as ({_OPS_MART.format('etxn')})"
_ROUNDED_OPS = "select * replace (round(total_volume_inr, 2) as total_volume_inr) from mart"

_RECON_MART = f"""{_RECON}, mart as (
  select event_date, p.merchant_id, count(*) as total_settled_transactions,
    cast(count(*) filter (where delay_seconds > 180) as bigint) as delayed_count,
    round(sum(amount_inr), 2) as total_txn_amount, round(sum(settled_amount_inr), 2) as total_settled_amount,
    round(sum(amount_inr) - sum(settled_amount_inr), 2) as amount_discrepancy
  from paid p left join settlement s on p.transaction_id = s.transaction_id
  group by event_date, p.merchant_id)"""

_METHOD_KPI = """select payment_method, cast(sum(total_transactions) as bigint) as total_transactions,
    cast(sum(success_count) as bigint) as success_count, round({}, 4) as avg_response_time_ms,
    sum(success_count) / sum(total_transactions) * 100 as success_rate_pct
  from mart group by payment_method"""

_BAD_JSON = """case event_id % 17 when 0 then left(props, length(props) - 1) when 1 then '{}' when 2 then '[1]'
  else props end"""
_IS_BAD = "event_id % 17 in (0, 1, 2)"

_STALE = """select 'user-' || user_id as stream_name,
    case when latest is null then 'NO_CHECKPOINT_FOUND'
         when date_diff('microsecond', latest, timestamp '2024-02-01') / 6e7 > 14400 then 'STALE' else 'HEALTHY' end as status,
    round(date_diff('microsecond', latest, timestamp '2024-02-01') / 6e7, 3) as age_minutes,
    '2024-02-01T00:00:00.000000+00:00' as checked_at
  from (select user_id, max(ts) filter (where event_type = 'purchase') as latest from events group by user_id)"""

_LAG = """lags as (
  select 'part-' || l_partkey as group_id,
    case when l_partkey % 50 = 0 then -1 when l_linenumber = 7 then null else cast(l_quantity as bigint) end as lag
  from lineitem),
totals as (
  select group_id, cast(case when min(lag) < 0 then -1 else coalesce(sum(lag), 0) end as bigint) as total_lag
  from lags group by group_id),
severities as (
  select *, case when total_lag < 0 then 'UNKNOWN' when total_lag > 800 then 'CRITICAL'
    when total_lag > 600 then 'ALERT' else 'OK' end as severity from totals)"""

_CHECKS_OPS = """select 'mart_ops_dashboard_metrics' as "table", c as "check", v as violations, v = 0 as success from (
  select unnest(['payment_method has no nulls', 'merchant_category has no nulls', 'total_transactions is in [0, -]',
      'total_volume_inr is in [0, -]', 'avg_response_time_ms is in [0, 60000]',
      'success_count never exceeds total_transactions']) as c,
    unnest([count(*) filter (where payment_method is null), count(*) filter (where merchant_category is null),
      count(*) filter (where total_transactions < 0), count(*) filter (where total_volume_inr < 0),
      count(*) filter (where avg_response_time_ms < 0 or avg_response_time_ms > 60000),
      count(*) filter (where success_count > total_transactions)]) as v
  from mart)"""
_CHECKS_RECON = """select 'mart_settlement_reconciliation' as "table", c as "check", v as violations, v = 0 as success from (
  select unnest(['merchant_id has no nulls', 'total_settled_transactions is in [0, -]', 'delayed_count is in [0, -]',
      'delayed_count never exceeds total_settled_transactions', 'total_settled_amount has no nulls',
      'amount_discrepancy is in [-, 0]']) as c,
    unnest([count(*) filter (where merchant_id is null), count(*) filter (where total_settled_transactions < 0),
      count(*) filter (where delayed_count < 0), count(*) filter (where delayed_count > total_settled_transactions),
      count(*) filter (where total_settled_amount is null), count(*) filter (where amount_discrepancy > 0)]) as v
  from {})"""

_PIVOT_DAYS = ", ".join(
    f"cast(coalesce(sum(success_count) filter (where event_date = date '2024-01-{d:02}'), 0) as bigint) as \"2024-01-{d:02}\""
    for d in range(1, 31)
)

# All fields of the transaction events, and their JSON.
_FULL_TXN = """full_txn as (
  select *, 'user_' || (event_id % 1000) as user_id, 'INR' as currency,
    case when status = 'success' then '00' else 'U' || (event_id % 90 + 10) end as bank_response_code,
    event_id % 7 = 0 as is_international, case event_id % 3 when 0 then 'ios' when 1 then 'android' end as device_type,
    'city_' || (event_id % 12) as city, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f+00:00') as "timestamp"
  from etxn)"""
_TXN_JSON = """'{"transaction_id":"' || transaction_id || '","merchant_id":"' || merchant_id || '","merchant_category":"'
    || merchant_category || '","payment_method":"' || payment_method || '","amount_inr":' || amount_inr || ',"status":"'
    || status || '","response_time_ms":' || response_time_ms || ',"user_id":"' || user_id || '","currency":"INR","bank_response_code":"'
    || bank_response_code || '","is_international":' || is_international || coalesce(',"device_type":"' || device_type || '"', '')
    || ',"city":"' || city || '","timestamp":"' || "timestamp" || '"}'"""

_SETTLEMENT_JSON_BAD = "(l_orderkey + l_linenumber) % 23"

_WELL_FORMED = "select * from etxn where event_id % 17 not in (0, 1, 2)"

_WINDOW_FEATURES = f"""with {_EVENT_TXN},
        counted as (
          select window_start, payment_method, count(*) as n, count(*) filter (where status = 'success') as good,
            count(*) filter (where status = 'timeout') as late, sum(response_time_ms) as latency
          from (select *, time_bucket(interval 15 minute, event_time) - k * interval 15 minute as window_start
                from etxn, range(0, 4) as r(k))
          group by 1, 2),
        fleet as (
          select window_start, sum(n) as n, sum(good) / sum(n) * 100 as success_rate_pct,
            sum(latency) / sum(n) as avg_response_time_ms, sum(late) / sum(n) * 100 as timeout_rate_pct,
            coalesce(max(100 - good / n * 100) filter (where payment_method like 'upi%'), 0) as max_single_bank_failure_rate
          from counted group by 1),
        baseline as (
          select *, avg(n) over past as mean, stddev_samp(n) over past as spread from fleet
          window past as (order by window_start range between interval 6 hour preceding and interval 1 second preceding))
        select window_start, window_start + interval 1 hour as window_end, success_rate_pct, avg_response_time_ms,
          round(case when spread > 0 then (n - mean) / spread else 0 end, 4) as volume_zscore, timeout_rate_pct,
          max_single_bank_failure_rate
        from baseline"""

_PAYOUT_MART = """select cast(l_shipdate as date) as event_date, l_returnflag as platform,
          l_linestatus as recipient_type, count(*) as total_payouts,
          cast(count(*) filter (where l_quantity > 40) as bigint) as delayed_count,
          cast(count(*) filter (where not l_quantity > 40) as bigint) as paid_count,
          round(sum(l_extendedprice), 2) as total_payout_volume_inr,
          avg(cast(floor(l_quantity * 10) as integer)) as avg_delay_minutes
        from lineitem group by 1, 2, 3"""

# --- the anomaly model -----------------------------------------------------------------------------------------------

_TREES, _SAMPLE, _DEEPEST, _SEED, _CONTAMINATION = 200, 256, 8, 42, 0.03
_PRIME, _RANGE = 2**52 - 47, float(2**52)
_FEATURE_LIST = "[" + ", ".join(f"cast({f} as double)" for f in FEATURES) + "]"


def _hash_number(text: str, part: int = 0) -> str:
    return f"('0x' || substr(md5({text}), {1 + 13 * part}, 13))::bigint"


def _forest(train: str) -> str:
    """Samples and nodes of the forest over a relation of key and x (a list of features), level by level."""
    out = [
        f"""need as (select least({_SAMPLE}, count(distinct key)) as need from {train}),
samples as materialized (
  select t, x, draw, key from (
    select *, row_number() over (partition by t order by draw, key) as place from (
      select t, x, key, (a + t * b) % {_PRIME} as draw
      from (select *, {_hash_number(f"key || ':{_SEED}'")} % {_PRIME} as a, {_hash_number(f"key || ':{_SEED}'", 1)} % {_PRIME} as b
            from {train}), range(0, {_TREES}) as r(t)))
  where place <= (select need from need)),
level0 as (select t, x, 1::bigint as node, true as open from samples)"""
    ]
    lows = ", ".join(f"min(x[{i}]) over w" for i in range(1, len(FEATURES) + 1))
    highs = ", ".join(f"max(x[{i}]) over w" for i in range(1, len(FEATURES) + 1))
    places = list(range(1, len(FEATURES) + 1))
    text = f"'{_SEED}:' || t || ':' || node"
    for d in range(_DEEPEST + 1):
        is_leaf = "true" if d == _DEEPEST else "len(usable) = 0"
        out.append(
            f"""seen{d} as (
  select *, count(*) over w as n, [{lows}] as low, [{highs}] as high from level{d} window w as (partition by t, node)),
chosen{d} as (
  select *, case when {is_leaf} then -1
      else usable[1 + cast(floor({_hash_number(text)} / {_RANGE} * len(usable)) as bigint)] - 1 end as feature
  from (select *, list_filter({places}, lambda i: high[i] > low[i]) as usable from seen{d})),
cut{d} as materialized (
  select t, x, node, open, n, feature, case when feature = -1 then 0.0 when between_ <= low[feature + 1] then high[feature + 1]
      else between_ end as split
  from (select *, high[feature + 1] - {_hash_number(text, 1)} / {_RANGE} * (high[feature + 1] - low[feature + 1]) as between_
        from chosen{d})),
nodes{d} as (select distinct t, node, feature, split, n, {d} as depth from cut{d} where open),
level{d + 1} as (
  select t, x, case when feature = -1 then node else 2 * node + cast(x[feature + 1] >= split as bigint) end as node,
    open and feature <> -1 as open from cut{d})"""
        )
    out.append("nodes as materialized (" + " union all ".join(f"select * from nodes{d}" for d in range(_DEEPEST + 1)) + ")")
    return ",\n".join(out)


def _mean_path(n: str) -> str:
    return f"case when {n} > 2 then 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n} when {n} = 2 then 1.0 else 0.0 end"


def _forest_scores(rows: str, name: str) -> str:
    """Relation ``name``: the relation with its score, every row walked through the nodes of all trees."""
    out = [
        f"{name}_in as materialized (select row_number() over () as id, * from {rows})",
        f"{name}_0 as (select id, x, t, 1::bigint as node from {name}_in, range(0, {_TREES}) as r(t))",
    ]
    for d in range(_DEEPEST):
        out.append(
            f"""{name}_{d + 1} as materialized (
  select w.id, w.x, w.t, case when feature = -1 then w.node else 2 * w.node + cast(w.x[feature + 1] >= split as bigint) end as node
  from {name}_{d} w join nodes on nodes.t = w.t and nodes.node = w.node)"""
        )
    out.append(
        f"""{name}_sums as (
  select id, sum(cast(round((depth + {_mean_path("n")}) / 1e-9) as bigint)) as total
  from {name}_{_DEEPEST} w join nodes on nodes.t = w.t and nodes.node = w.node group by id),
{name} as materialized (
  select i.*, round(pow(2.0, -(cast(total as double) / {_TREES} * 1e-9) / (select {_mean_path("need")} from need)), 6) as score
  from {name}_in i join {name}_sums using (id))"""
    )
    return ",\n".join(out)


_THRESHOLD = f"""threshold as (
  select min(score) as threshold from (
    select score, row_number() over (order by score) as place, count(*) over () as n from scored)
  where place >= n * (1.0::double - {_CONTAMINATION}::double))"""

_MODEL_FEATURES = f"""features as materialized (
  select cast(window_start as varchar) as key, {_FEATURE_LIST} as x, * from (
    select window_start, window_end, {", ".join(f"round({f}, 4) as {f}" for f in FEATURES)} from ({_WINDOW_FEATURES})))"""
_SCORED = f"""with {_MODEL_FEATURES}, {_forest("features")}, {_forest_scores("features", "scored")}, {_THRESHOLD}"""

_PLANTED = """[success_rate_pct * 0.5, avg_response_time_ms * 5, volume_zscore, timeout_rate_pct + 40, 100.0]"""
_EVALUATED = f"""with {_MODEL_FEATURES},
parts as (select *, {_hash_number(f"key || ':{_SEED}'")} / {_RANGE} >= 0.2 as is_train from features),
train as materialized (select * from parts where is_train),
labelled as materialized (
  select x, 0 as label from parts where not is_train union all select {_PLANTED}, 1 from parts where not is_train),
{_forest("train")}, {_forest_scores("train", "scored")}, {_THRESHOLD}, {_forest_scores("labelled", "judged")},
flags as (select label, score > (select threshold from threshold) as flagged from judged),
counts as (
  select count(*) filter (where flagged and label = 1) as tp, count(*) filter (where flagged and label = 0) as fp,
    count(*) filter (where not flagged and label = 1) as fn from flags)
select tp, fp, fn, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as "precision",
  case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
  case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1 from counts"""


ORACLES: dict[str, str] = {
    "json_parse_typed": f"with {_EVENT_TXN}, {_FULL_TXN} select * exclude (event_id) from full_txn where not {_IS_BAD}",
    "dlq_split": f"""select case when {_IS_BAD} then 'dlq' else 'valid' end as route,
        case when not {_IS_BAD} then cast(regexp_extract(props, '[0-9]+') as integer) end as k,
        case when {_IS_BAD} then {_BAD_JSON} end as json_value, ts as kafka_timestamp from events""",
    "bronze_envelope": "select cast(event_id as varchar) as key, props as value, ts as kafka_timestamp from events",
    "window_health_metrics": f"with {_EVENT_TXN}, {_SLIDING} select * from silver",
    "window_health_tumbling": f"with {_EVENT_TXN}, {_HOURLY} select * from silver",
    "bank_health_hourly": f"""with {_EVENT_TXN}
        select payment_method as bank, date_trunc('hour', event_time) as hour_bucket, count(*) as total_transactions,
          cast(count(*) filter (where status = 'success') as bigint) as success_count,
          count(*) filter (where status = 'success') / count(*) * 100 as success_rate_pct,
          avg(response_time_ms) as avg_response_time_ms,
          quantile_disc(response_time_ms, 0.5) as p50_response_time_ms,
          quantile_disc(response_time_ms, 0.95) as p95_response_time_ms
        from etxn group by 1, 2""",
    "bank_health_daily": f"""with {_EVENT_TXN}
        select payment_method as bank, date_trunc('day', event_time) as bucket, count(*) as total_transactions,
          cast(count(*) filter (where status = 'success') as bigint) as success_count,
          count(*) filter (where status = 'success') / count(*) * 100 as success_rate_pct,
          avg(response_time_ms) as avg_response_time_ms, true as p50_within, true as p95_within
        from etxn group by 1, 2""",
    "latest_window_per_method": f"""with {_EVENT_TXN}, {_SLIDING}, {_LATEST}
        select window_start, window_end, payment_method, total_transactions, success_rate_pct, avg_response_time_ms,
          timeout_rate_pct from latest""",
    "failure_attribution_snapshot": f"""with {_EVENT_TXN}, {_SLIDING}, {_LATEST}, {_classify("latest", "")}
        select *, {_AS_OF_TEXT} as detected_at from classified""",
    "failure_attribution_history": f"{_HISTORY} select * from history",
    "alert_feed": f"""{_HISTORY} select classification, affected_banks, detected_at,
          ':rotating_light: *' || classification || '* detected' || chr(10) || 'Affected: '
            || replace(affected_banks, ',', ', ') || chr(10) || 'Time: ' || detected_at as message
        from history where classification <> 'HEALTHY'""",
    "severity_lookup": f"""{_HISTORY} select detected_at, classification,
          case classification when 'NPCI_SIDE_ISSUE' then 'critical' when 'PLATFORM_SIDE_ISSUE' then 'high'
            when 'BANK_SIDE_ISSUE' then 'medium' when 'HEALTHY' then 'ok' else 'unknown' end as severity,
          case when affected_banks = '' then 'none' else affected_banks end as affected_display
        from history""",
    "mart_correlation_summary": f"{_HISTORY} select classification, affected_banks, detected_at from history",
    "recent_classifications": f"""{_HISTORY} select detected_at, detected_at || ': ' || classification || ' (banks: '
          || case when affected_banks = '' then 'none' else affected_banks end || ')' as line
        from history order by detected_at desc, classification, affected_banks limit 5""",
    "latest_record": f"""{_HISTORY} select classification, affected_banks, detected_at from history
        order by detected_at desc, classification, affected_banks limit 1""",
    "events_text": f"""{_HISTORY}, newest as (
          select * from history order by detected_at desc, classification, affected_banks limit 5)
        select 'all events' as "of", string_agg(detected_at || ': ' || classification || ' (banks: '
          || case when affected_banks = '' then 'none' else affected_banks end || ')', chr(10)
          order by detected_at desc, classification, affected_banks) as "text" from newest
        union all select 'no events', 'No correlation events recorded.'""",
    "classification_history": f"""{_HISTORY} select classification, affected_banks, detected_at from history
        order by detected_at desc, classification, affected_banks""",
    "payment_enriched": f"""{_RECON} select p.transaction_id, p.merchant_id, payment_method, amount_inr, status,
          p.event_time as transaction_time, settlement_id, settled_amount_inr, settlement_status, delay_seconds,
          coalesce(delay_seconds > 180, false) as is_delayed, event_date
        from paid p left join settlement s on p.transaction_id = s.transaction_id""",
    "settlement_delayed": f"{_RECON} {_OVERDUE}",
    "orphan_settlements": f"{_RECON} {_ORPHANS}",
    "amount_mismatch": f"{_RECON} {_AMOUNTS}",
    "settlement_mismatches": f"{_LOG} select *, {_AS_OF_TEXT} as detected_at from log",
    "mismatch_counts": f"{_LOG} select mismatch_type, count(*) as mismatches from log group by mismatch_type",
    "mart_ops_metrics": f"{_OPS} {_ROUNDED_OPS}",
    "mart_settlement_recon": f"{_RECON_MART} select * from mart",
    "mart_settlement_recon_rows": f"{_RECON_MART} select * from mart",
    "mart_payout_health": _PAYOUT_MART,
    "kpi_ops": f"""{_OPS} select cast(sum(total_transactions) as bigint) as total_transactions,
          cast(sum(success_count) as bigint) as success_count, round(sum(total_volume_inr), 2) as total_volume_inr,
          sum(success_count) / sum(total_transactions) * 100 as success_rate_pct from mart""",
    "ops_summary_text": f"""{_OPS} select 'Total transactions: ' || sum(total_transactions) || ', success rate: '
          || format('{{:.2f}}', sum(success_count) / sum(total_transactions) * 100) || '%, total volume: ₹'
          || format('{{:,}}', cast(round(sum(total_volume_inr)) as bigint)) as summary from mart""",
    "kpi_by_method": f"{_OPS} {_METHOD_KPI.format('avg(avg_response_time_ms)')}",
    "kpi_by_method_weighted": f"""{_OPS} {_METHOD_KPI.format(
        'sum(avg_response_time_ms * total_transactions) / sum(total_transactions)')}""",
    "success_bands": f"""{_EVENT_OPS} select *, case when success_rate_pct >= 95 then 'green'
          when success_rate_pct >= 90 then 'yellow' else 'red' end as band
        from (select payment_method, sum(success_count) / sum(total_transactions) * 100 as success_rate_pct
              from mart group by payment_method)""",
    "volume_by_category": f"""{_OPS} select merchant_category, round(sum(total_volume_inr), 2) as total_volume_inr
        from mart group by merchant_category""",
    "bank_health_pivot": f"""{_EVENT_OPS} select payment_method, {_PIVOT_DAYS} from mart
        where payment_method like 'upi%' group by payment_method""",
    "kpi_settlement": f"""{_RECON_MART} select *, (total_settled_transactions - delayed_count) / total_settled_transactions * 100
            as match_rate_pct, delayed_count / total_settled_transactions * 100 as delay_rate_pct
        from (select cast(sum(total_settled_transactions) as bigint) as total_settled_transactions,
                cast(sum(delayed_count) as bigint) as delayed_count,
                round(sum(amount_discrepancy), 2) as amount_discrepancy from mart)""",
    "settlement_summary_text": f"""{_RECON_MART} select 'Total settled: ' || sum(total_settled_transactions) || ', delayed: '
          || sum(delayed_count) || ' (' || format('{{:.1f}}', sum(delayed_count) / sum(total_settled_transactions) * 100)
          || '%), amount discrepancy: ₹' || format('{{:,}}', cast(round(sum(amount_discrepancy)) as bigint)) as summary
        from mart""",
    "top_discrepancy_merchants": f"""{_RECON_MART} select merchant_id, round(coalesce(sum(amount_discrepancy), 0), 2)
            as amount_discrepancy
        from mart group by merchant_id order by amount_discrepancy desc, merchant_id limit 15""",
    "sql_path_scan": "select event_type, count(*) as n, max(event_id) as newest from events group by 1",
    "sql_views": f"""{_RECON} select payment_method, count(*) as payments,
          cast(count(*) filter (where delay_seconds > 180) as bigint) as delayed, count(settlement_id) as settlements
        from paid p left join settlement s on p.transaction_id = s.transaction_id group by payment_method""",
    "latest_report": f"""{_RECON_MART} select 'Total settled: ' || sum(total_settled_transactions) || ', delayed: '
          || sum(delayed_count) || ' (' || format('{{:.1f}}', sum(delayed_count) / sum(total_settled_transactions) * 100)
          || '%), amount discrepancy: ₹' || format('{{:,}}', cast(round(sum(amount_discrepancy)) as bigint)) as report,
          '2024-02-01 00:00:00' as generated_at from mart""",
    "dq_ops_mart": f"{_OPS} {_CHECKS_OPS}",
    "dq_recon_mart": f"{_RECON_MART} {_CHECKS_RECON.format('mart')}",
    "dq_summary": f"""{_RECON_MART}, recon as (select * from mart), ops as ({_OPS_MART.format('otxn')})
        select "table", cast(count(*) filter (where success) as bigint) as passed, count(*) as checks
        from ({_CHECKS_OPS.replace('from mart)', 'from ops)')} union all {_CHECKS_RECON.format('recon')}) group by "table\"""",
    "dlq_health": f"""select 'dlq_transactions' as "table", count(*) as malformed,
          case when count(*) = 0 then 'PASS' else 'ATTENTION' end as status from events where {_IS_BAD}
        union all select 'dlq_settlements', null, 'SKIP'""",
    "missing_table_read": f"{_EVENT_OPS} {_ROUNDED_OPS}",
    "lag_severity": f"with {_LAG} select * from severities",
    "lag_alerts": f"""with {_LAG} select *, case severity
          when 'CRITICAL' then ':rotating_light: CRITICAL Kafka lag on `' || group_id || '`: ' || total_lag
            || ' messages. Restarting `' || group_id || '` with increased parallelism.'
          else ':warning: Elevated Kafka lag on `' || group_id || '`: ' || total_lag || ' messages.' end as message
        from severities where severity in ('ALERT', 'CRITICAL')""",
    "staleness_alerts": f"""select *, ':rotating_light: Streaming job `' || stream_name || '` appears ' || status || ' (last checkpoint '
          || coalesce(cast(age_minutes as varchar), 'None') || ' min ago). Attempting automatic restart.' as message
        from ({_STALE}) where status <> 'HEALTHY'""",
    "stream_health": """select 'landed_events' as stream_name, 'HEALTHY' as status, 0::bigint as total_lag, 'OK' as severity,
          null::varchar as message, 1::bigint as batches
        union all select 'landed_nothing', 'NO_CHECKPOINT_FOUND', -1, 'UNKNOWN', ':rotating_light: Streaming job `landed_nothing` appears'
          || ' NO_CHECKPOINT_FOUND (last checkpoint None min ago). Attempting automatic restart.', null""",
    "checkpoint_staleness": _STALE,
    "window_features": _WINDOW_FEATURES,
    "window_sample": f"""select * from ({_WINDOW_FEATURES})
        order by md5(cast(window_start as varchar) || ':42'), window_start limit 1000""",
    "iforest_fit": f"""with {_MODEL_FEATURES}, {_forest("features")}
        select cast(t as integer) as tree_id, cast(node as integer) as node_id, cast(feature as integer) as feature,
          round(split, 6) as split, cast(n as integer) as "rows", depth from nodes""",
    "iforest_score": f"""{_SCORED}
        select window_start, window_end, {", ".join(FEATURES)}, score,
          case when score > (select threshold from threshold) then 1 else 0 end as is_anomaly from scored""",
    "iforest_saved": f"""{_SCORED}
        select 'older' as version, window_start, score,
          case when score > (select threshold from threshold) then 1 else 0 end as is_anomaly from scored
        union all select 'newest', window_start, score, 1 from scored""",
    "iforest_evaluate": _EVALUATED,
    "stream_bronze": f"""with {_EVENT_TXN}, {_FULL_TXN}, json as (select *, {_TXN_JSON} as body from full_txn)
        select transaction_id as key, event_time as kafka_timestamp, case event_id % 17 when 0 then left(body, length(body) - 1)
          when 1 then '{{}}' when 2 then '[1]' else body end as value from json""",
    "stream_settlements": f"""select 'valid' as route, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
          as settlement_id, cast(l_orderkey as varchar) as transaction_id, 'merchant_' || (l_suppkey % 100) as merchant_id,
          case when l_linenumber % 5 = 0 then 0.0::double else l_extendedprice end as settled_amount_inr,
          case when l_linenumber % 5 = 0 then 'failed' else 'settled' end as settlement_status,
          'ref' || l_partkey as bank_reference_number, cast(floor(l_quantity * 10) as integer) as delay_seconds,
          l_shipdate as event_time, cast(l_shipdate as date) as event_date, null::varchar as json_value
        from lineitem where {_SETTLEMENT_JSON_BAD} > 1
        union all select 'dlq', null, null, null, null, null, null, null, null, null,
          case {_SETTLEMENT_JSON_BAD} when 0 then '[' || l_orderkey || ']' else '{{' end
        from lineitem where {_SETTLEMENT_JSON_BAD} <= 1""",
    "stream_dlq": f"select {_BAD_JSON} as json_value, ts as kafka_timestamp from events where {_IS_BAD}",
    "stream_silver_rows": f"""select cast(regexp_extract(props, '[0-9]+') as integer) as k, ts as kafka_timestamp
        from events where not {_IS_BAD}""",
    "stream_silver_windows": f"""with {_EVENT_TXN}, good as ({_WELL_FORMED}), {_sliding("good")}
        select * from silver where window_end <= (select max(event_time) - interval 60 second from good)""",
    "stream_newest_windows": f"""with {_EVENT_TXN}, good as ({_WELL_FORMED}), {_sliding("good")},
        closed as (select * from silver where window_end <= (select max(event_time) - interval 60 second from good))
        select s.window_start, s.window_end, s.payment_method, total_transactions, success_rate_pct, avg_response_time_ms,
          timeout_rate_pct from closed s
        join (select payment_method, max(window_end) as newest from closed where payment_method like 'upi%' group by 1) m
          on s.payment_method = m.payment_method and s.window_end = m.newest""",
    "stream_typed_rows": f"""with {_EVENT_TXN}, good as ({_WELL_FORMED}),
        mart as ({_OPS_MART.format("good")}) {_ROUNDED_OPS}""",
    "stream_restart": f"""with {_EVENT_TXN}, good as ({_WELL_FORMED})
        select 'typed' as "table", cast(event_date as varchar) as part, count(*) as n from good group by event_date
        union all select 'bronze', 'all', count(*) from events
        union all select 'dlq', 'all', count(*) from events where {_IS_BAD}
        union all select 'batches', 'run ' || i, {list(FILES_OF_RUN)}[i + 1] from range(0, {len(FILES_OF_RUN)}) as r(i)""",
    "stream_late": f"""with {_EVENT_TXN},
        good as (select * from ({_WELL_FORMED}) where not (event_time < timestamp '{LATE_BEFORE}' and event_id % 50 = 7)),
        {_sliding("good")}
        select * from silver where window_end <= (select max(event_time) - interval 60 second from good)""",
    "stream_payout_mart": _PAYOUT_MART,
    "stream_recon_join": f"""with t as (
          select cast(o_orderkey as varchar) as transaction_id, 'merchant_' || (o_custkey % 100) as merchant_id,
            o_totalprice as amount_inr, case when o_orderkey % 101 <> 0 then o_orderdate end as txn_time
          from orders where o_orderstatus = 'O'),
        s as (
          select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as settlement_id,
            case when l_suppkey % 10 = 0 then '{HOT_ORDER}' when l_partkey % 89 <> 0 then cast(l_orderkey as varchar) end as transaction_id,
            l_extendedprice as settled_amount_inr, case when l_partkey % 97 <> 0 then l_shipdate end as settled_time
          from lineitem),
        watermark as (select least((select max(txn_time) from t), (select max(settled_time) from s)) - interval 60 second as w),
        pair as (
          select t.transaction_id, merchant_id, amount_inr, txn_time, settlement_id, settled_amount_inr, settled_time
          from t join s on s.transaction_id = t.transaction_id
            and settled_time between txn_time - interval 1 minute and txn_time + interval {STREAM_DELAY_DAYS} day)
        select 'MATCHED' as kind, * from pair
        union all
        select 'OVERDUE', transaction_id, merchant_id, amount_inr, txn_time, null, null, null from t
        where txn_time + interval {STREAM_DELAY_DAYS} day < (select w from watermark)
          and not exists (select 1 from pair where pair.transaction_id = t.transaction_id)
        union all
        select 'ORPHAN', transaction_id, null, null, null, settlement_id, settled_amount_inr, settled_time from s
        where settled_time + interval 1 minute < (select w from watermark)
          and not exists (select 1 from t where t.transaction_id = s.transaction_id
            and settled_time between txn_time - interval 1 minute and txn_time + interval {STREAM_DELAY_DAYS} day)
        union all
        select 'UNTIMED', transaction_id, merchant_id, amount_inr, null, null, null, null from t where txn_time is null
        union all
        select 'UNTIMED', transaction_id, null, null, null, settlement_id, settled_amount_inr, null from s where settled_time is null""",
    "csv_export_roundtrip": f"{_OPS} {_ROUNDED_OPS}",
    "append_log_roundtrip": f"""{_HISTORY} select classification, affected_banks, detected_at, null::varchar as severity from history
        union all select classification, affected_banks, detected_at,
          case classification when 'NPCI_SIDE_ISSUE' then 'critical' when 'PLATFORM_SIDE_ISSUE' then 'high'
            when 'BANK_SIDE_ISSUE' then 'medium' when 'HEALTHY' then 'ok' else 'unknown' end from history""",
    "json_log_roundtrip": _STALE,
    "typed_by_date": f"""with {_EVENT_TXN} select event_date, count(*) as transactions from etxn
        where event_date >= date '2024-01-16' group by 1""",
    "mart_write_counted": f"{_OPS} select count(*) as rows_read, count(*) as rows_written from mart",
}
