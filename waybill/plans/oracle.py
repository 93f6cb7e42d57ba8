"""DuckDB SQL with the results the registered queries must have.

Each text is one statement over the data folder's tables. The parts below are chained as common
table expressions; `after` gathers those a query needs.
"""

from __future__ import annotations

RAW_LABELS = """
with b as (select o_orderkey k, o_custkey ck, o_orderdate created, o_orderkey % 20 c20,
  cast(floor(o_orderkey/20) as bigint) % 10 chg, cast(floor(o_orderkey/200) as bigint) % 10 ex, cast(floor(o_orderkey/2000) as bigint) % 10 fr from orders),
c as (select *, case when c20<10 then 'USPS' when c20<16 then 'UPS' when c20<19 then 'FEDEX' else 'DHL_ECOM' end carrier from b),
s as (select *, case carrier when 'USPS' then case when ex=0 then 'USPS_PRIORITY' else 'USPS_STANDARD' end
  when 'UPS' then case when ex=0 then 'UPS_2ND_DAY' else 'UPS_GROUND' end
  when 'FEDEX' then case when ex=0 then 'FEDEX_2_DAY' else 'FEDEX_NORMAL' end
  else case when ex=0 then 'DHL_ECOM_EXPRESS' else 'DHL_ECOM_FLEX' end end sc,
  case when carrier='USPS' then case when ex=0 then 3 else 5 end when carrier in ('UPS','FEDEX') then case when ex=0 then 2 else 7 end else case when ex=0 then 3 else 5 end end sla from c),
base as (select concat('lbl_', lpad(cast(k as string),24,'0')) label_id, concat('cust_', lpad(cast(ck as string),12,'0')) customer_id, carrier, sc service_class,
  lpad(cast(ck*61 % 99999 + 1 as string),5,'0') origin_zip, case when k % 211=0 then null else lpad(cast(k*7 % 99999 + 1 as string),5,'0') end dest_zip,
  cast(case when k*37 % 1180 + 1 > 1120 then 1000 + k % 121 else k*37 % 1180 + 1 end as int) weight_oz,
  cast(case when k % 7 <> 0 then null when k % 133 = 0 then 0 else 5000 + k*11 % 45001 end as int) declared_value_cents,
  created label_created_at, created + sla * interval '1' day carrier_promised_delivery_at, k, chg, fr, sla from s),
ver as (select *, 0 v from base union all select *, 1 v from base where chg in (0,1,2) union all select *, 2 v from base where chg = 2)
select label_id, customer_id, carrier, case when v=1 and chg in (1,2) then concat(carrier,'_EXTRA') else service_class end service_class, origin_zip, dest_zip, weight_oz, declared_value_cents,
  label_created_at, carrier_promised_delivery_at,
  case when v=1 and chg=0 then case when fr=0 then label_created_at + 3 * interval '1' day else label_created_at + (k % 60 + 1) * interval '1' minute end end voided_at,
  case when v=0 then label_created_at when chg=0 then case when fr=0 then label_created_at + 3 * interval '1' day else label_created_at + (k % 60 + 1) * interval '1' minute end
   else label_created_at + (5*v + k % 7) * interval '1' hour end last_updated_at
from ver
"""

RAW_EVENTS = """
with b as (select k, sla, carrier, created, l_linenumber ln, l_partkey pk, l_suppkey sk, cast(l_quantity as bigint) q from (
  select o_orderkey k, o_orderdate created, case when o_orderkey % 20<10 then 'USPS' when o_orderkey % 20<16 then 'UPS' when o_orderkey % 20<19 then 'FEDEX' else 'DHL_ECOM' end carrier,
   case when o_orderkey % 20 between 10 and 18 then case when cast(floor(o_orderkey/200) as bigint) % 10=0 then 2 else 7 end else case when cast(floor(o_orderkey/200) as bigint) % 10=0 then 3 else 5 end end sla from orders) o
  join lineitem on l_orderkey = k),
s as (select *, case when ln>=4 then 4 else ln end st from b),
t as (select *, case when st=4 and (pk+sk) % 33=0 then created + (sla*24 + 6 + q % 43) * interval '1' hour
   else created + (cast(floor(sla*24*(case st when 1 then 15 when 2 then 40 when 3 then 75 else 95 end)/100) as bigint) + q % 5 - 2) * interval '1' hour end at0 from s),
u as (select *, at0 + (case when pk % 13=0 then 2 + q % 7 else 0 end) * interval '1' day rc,
   case when carrier='USPS' then -5 when carrier='DHL_ECOM' then case q % 9 when 0 then -5 when 1 then -4 when 2 then -6 when 3 then -5 when 4 then -7 when 5 then -6 when 6 then -8 when 7 then -7 else 0 end else 0 end off from t),
w as (select *, replace(substr(cast(at0 + off * interval '1' hour as string),1,19),' ','T') loc from u)
select concat('ev_', cast(k as string), '_', cast(ln as string)) event_id, concat('lbl_', lpad(cast(k + case when pk % 499=0 then 100000000 else 0 end as string),24,'0')) label_id, carrier,
  case when pk % 97=0 then null when carrier='USPS' then case st when 1 then '0300' when 2 then '0301' when 3 then '0310' else '0320' end
       when carrier='DHL_ECOM' then case st when 1 then 'PU' when 2 then 'IT' when 3 then 'OFD' else 'DL' end end event_code,
  case when pk % 97=0 then null when carrier in ('UPS','FEDEX') then case st when 1 then 'PICKUP' when 2 then 'IN_TRANSIT' when 3 then 'OUT_FOR_DELIVERY' when 4 then case when pk % 89=0 then 'RETURNED' else 'DELIVERED' end end end event_type,
  case when pk % 500=13 then 'not-a-time' when pk % 100=7 then case q % 3 when 0 then replace(replace(loc,'-',''),':','') when 1 then substr(loc,1,10) else replace(loc,'-','/') end
       when carrier='USPS' then concat(loc,'-05:00') when carrier='UPS' then concat(loc,'Z') when carrier='FEDEX' then loc
       else concat(loc,' ', case q % 9 when 0 then 'EST' when 1 then 'EDT' when 2 then 'CST' when 3 then 'CDT' when 4 then 'MST' when 5 then 'MDT' when 6 then 'PST' when 7 then 'PDT' else 'AKST' end) end event_at,
  rc event_received_at, case when sk % 5=0 then null else lpad(cast(pk % 99999 + 1 as string),5,'0') end location_zip, cast(null as string) raw_payload
from w
"""

LABELS_NOW = """
select * exclude (n) from (
  select *, row_number() over (partition by label_id order by
    last_updated_at desc nulls last, customer_id desc nulls last, carrier desc nulls last,
    service_class desc nulls last, origin_zip desc nulls last, dest_zip desc nulls last,
    weight_oz desc nulls last, declared_value_cents desc nulls last,
    label_created_at desc nulls last, carrier_promised_delivery_at desc nulls last,
    voided_at desc nulls last) n
  from raw_labels) where n = 1
"""

VOID_FLAG = (
    "coalesce(epoch_us(voided_at) - epoch_us(label_created_at) > 24 * 3600 * 1000000::bigint, false)"
)

SILVER_LABELS = f"""
select *,
  coalesce(weight_oz >= 1000 and weight_oz <= 1120, false) can_be_weight_fraud,
  {VOID_FLAG} can_be_void_fraud,
  coalesce(declared_value_cents = 0, false) can_be_insurance_anomaly,
  origin_zip is null or dest_zip is null can_be_missing_zip
from labels_now
"""

DEDUPED = """
select * exclude (n) from (
  select *, row_number() over (partition by event_id order by
    event_received_at desc nulls last, event_at desc nulls last,
    coalesce(event_code, event_type, '') desc, coalesce(location_zip, '') desc,
    label_id desc nulls last, carrier desc nulls last, event_code desc nulls last,
    event_type desc nulls last, raw_payload desc nulls last) n
  from raw_events) where n = 1
"""

ZONES = """
select * from (values ('EST', '-05:00'), ('EDT', '-04:00'), ('CST', '-06:00'), ('CDT', '-05:00'),
  ('MST', '-07:00'), ('MDT', '-06:00'), ('PST', '-08:00'), ('PDT', '-07:00')) z(abbr, diff)
"""

STAGES = """
select * from (values ('0300', 'picked_up'), ('PICKUP', 'picked_up'), ('PU', 'picked_up'),
  ('0301', 'in_transit'), ('IN_TRANSIT', 'in_transit'), ('IT', 'in_transit'),
  ('0310', 'out_for_delivery'), ('OUT_FOR_DELIVERY', 'out_for_delivery'),
  ('OFD', 'out_for_delivery'),
  ('0320', 'delivered'), ('DELIVERED', 'delivered'), ('DL', 'delivered')) s(sent, stage)
"""


def repaired(source: str) -> str:
    """Rows of `source` with zone, shape, normalized_iso, parsed_at and is_malformed_timestamp."""
    return f"""
select *, parsed_at is null or shape in ('compact', 'slashed', 'date_only') is_malformed_timestamp
from (select *, timezone('UTC', try_cast(normalized_iso as timestamptz)) parsed_at
from (select s.* exclude (abbr, diff), case shape
    when 'zone_name' then regexp_replace(event_at, ' [A-Z]{{2,4}}$', '') || coalesce(diff, 'Z')
    when 'compact' then strftime(strptime(event_at, '%Y%m%dT%H%M%S'), '%Y-%m-%dT%H:%M:%SZ')
    when 'slashed' then replace(event_at, '/', '-') || 'Z'
    when 'date_only' then event_at || 'T00:00:00Z'
    when 'no_zone' then event_at || 'Z'
    else event_at end normalized_iso
from (select r.*, abbr, diff, case
    when zone <> '' then 'zone_name'
    when regexp_matches(event_at, 'T\\d\\d:\\d\\d:\\d\\d([+-]\\d\\d:\\d\\d|Z)$') then 'offset'
    when regexp_full_match(event_at, '\\d{{8}}T\\d{{6}}') then 'compact'
    when regexp_matches(event_at, '^\\d{{4}}/\\d\\d/\\d\\d') then 'slashed'
    when regexp_full_match(event_at, '\\d{{4}}-\\d\\d-\\d\\d') then 'date_only'
    when regexp_full_match(event_at, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d') then 'no_zone'
    else 'other' end shape
from (select *, regexp_extract(event_at, ' ([A-Z]{{2,4}})$', 1) zone from {source}) r
left join zones on zone = abbr) s))
"""


SILVER_EVENTS = """
select c.event_id, c.label_id, c.carrier, c.event_code, c.event_type,
  coalesce(stage, 'unknown') event_name, parsed_at event_at, c.event_received_at, c.location_zip,
  c.raw_payload, is_malformed_timestamp,
  event_code is null and event_type is null is_missing_event_type,
  coalesce(l.voided_at is not null, false) is_event_on_voided_label
from conformed c
left join stages on sent = coalesce(event_code, event_type)
left join silver_labels l on l.label_id = c.label_id
"""

DELIVERIES = """
select label_id, max(event_at) actual_delivery_at from silver_events
where event_name = 'delivered' group by label_id
"""

GOLD = """
select label_id, customer_id, carrier, service_class, origin_zip, dest_zip, label_created_at,
  carrier_promised_delivery_at, actual_delivery_at,
  actual_delivery_at is not null is_delivered,
  coalesce(actual_delivery_at <= carrier_promised_delivery_at, false) is_delivered_on_time
from silver_labels left join deliveries using (label_id)
"""

LATE = """
select *, date_diff('day', carrier_promised_delivery_at::date, actual_delivery_at::date)::int days_late
from gold
"""

PARTS = {
    "raw_labels": (RAW_LABELS, []),
    "raw_events": (RAW_EVENTS, []),
    "labels_now": (LABELS_NOW, ["raw_labels"]),
    "silver_labels": (SILVER_LABELS, ["labels_now"]),
    "zones": (ZONES, []),
    "stages": (STAGES, []),
    "deduped": (DEDUPED, ["raw_events"]),
    "repaired_raw": (repaired("raw_events"), ["raw_events", "zones"]),
    "conformed": (repaired("deduped"), ["deduped", "zones"]),
    "silver_events": (SILVER_EVENTS, ["conformed", "stages", "silver_labels"]),
    "deliveries": (DELIVERIES, ["silver_events"]),
    "gold": (GOLD, ["silver_labels", "deliveries"]),
    "late": (LATE, ["gold"]),
}


def after(parts: str, body: str) -> str:
    """`body` behind the named parts and everything they build on."""
    chain: dict[str, str] = {}

    def add(name: str) -> None:
        text, needs = PARTS[name]
        for need in needs:
            add(need)
        chain.setdefault(name, text)

    for part in parts.split():
        add(part)
    if not chain:
        return body
    listed = ",\n".join(f"{name} as materialized ({text})" for name, text in chain.items())
    return f"with {listed}\n{body}"


def pct(part: str, whole: str) -> str:
    return f"(100 * ({part})::double / nullif({whole}, 0)::double)"


ON_TIME = f"""
count(*) labels, count(*) filter (is_delivered) delivered,
count(*) filter (is_delivered_on_time) on_time,
{pct("count(*) filter (is_delivered_on_time)", "count(*)")} pct_on_time,
{pct("count(*) filter (is_delivered_on_time)", "count(*) filter (is_delivered)")}
  pct_on_time_of_delivered
"""

_IS_LATE = "is_delivered and not is_delivered_on_time"

DELAYS = f"""
count(*) labels, count(*) filter (is_delivered) delivered, count(*) filter ({_IS_LATE}) late,
{pct(f"count(*) filter ({_IS_LATE})", "count(*) filter (is_delivered)")} pct_late_of_delivered,
(sum(days_late) filter ({_IS_LATE}))::double / nullif(count(*) filter ({_IS_LATE}), 0)
  avg_days_late
"""


def delays_by(dimension: str, value: str) -> str:
    return f"select '{dimension}' dimension, {value} as cluster, {DELAYS} from late group by {value}"


LABELS_REQUIRED = (
    "label_id customer_id carrier service_class origin_zip dest_zip weight_oz "
    "label_created_at carrier_promised_delivery_at last_updated_at"
)

EVENTS_REQUIRED = "event_id label_id carrier event_at event_received_at"


def nulls(table: str, columns: str) -> str:
    return "\nunion all\n".join(
        f"""select '{c}' column_name, count(*) as rows, count(*) - count({c}) nulls,
        count(*) > 0 and count(*) = count({c}) passed from {table}"""
        for c in columns.split()
    )


def metrics(table: str, prefix: str, total: str = "count(*)", **figures: str) -> str:
    return "\nunion all\n".join(
        f"""select '{prefix}.{name}' metric, ({figure})::bigint n, ({total})::bigint total,
        {pct(figure, total)} pct from {table}"""
        for name, figure in figures.items()
    )


def rules(**conditions: str) -> str:
    return "\nunion all\n".join(
        f"""select '{name}' rule, count(*) filter ({bad}) broken, count(*) total,
        {pct(f"count(*) filter ({bad})", "count(*)")} pct_broken from raw_labels"""
        for name, bad in conditions.items()
    )


def gate(**figures: tuple[str, str, str]) -> str:
    """Name -> (observed, condition on x, threshold)."""
    return "\nunion all\n".join(
        f"""select '{name}' check_name, coalesce({condition}, false) passed, x observed,
        '{threshold}' threshold from (select ({observed})::double x)"""
        for name, (observed, condition, threshold) in figures.items()
    )


def _failures(model: str, column: str, test: str, count: str) -> str:
    return f"""select '{model}' model, '{column}' column_name, '{test}' test,
    f::bigint failures, f = 0 passed from (select ({count}) f)"""


def _keyed(model: str, table: str, key: str) -> list[str]:
    repeated = f"select {key} from {table} where {key} is not null group by 1 having count(*) > 1"
    return [
        _failures(model, key, "unique", f"select count(*) from ({repeated})"),
        _failures(model, key, "not_null", f"select count(*) from {table} where {key} is null"),
    ]


_NO_LABEL = "label_id not in (select label_id from silver_labels)"
_GOLD_SHARE = "(select {0} from gold)"
_ON_TIME, _DONE = "count(*) filter (is_delivered_on_time)", "count(*) filter (is_delivered)"

SCD2 = """
select *, {ts} valid_from, nxt valid_to, nxt is null is_current from (
  select *, lead({ts}) over (partition by {key} order by {ts}) nxt from (
    select * exclude (n) from (select *, row_number() over (
      partition by {key}, {ts} order by {ties}) n from {source}) where n = 1))
"""

_LABEL_TIES = ", ".join(
    f"{c} desc nulls last"
    for c in (
        "customer_id carrier service_class origin_zip dest_zip weight_oz declared_value_cents "
        "label_created_at carrier_promised_delivery_at voided_at"
    ).split()
)

_BEFORE = """
select *, lag(carrier) over w prev_carrier, lag(service_class) over w prev_service_class,
  lag(voided_at) over w prev_voided_at, row_number() over w nr
from raw_labels window w as (partition by label_id order by last_updated_at,
  customer_id nulls first, carrier nulls first, service_class nulls first, origin_zip nulls first,
  dest_zip nulls first, weight_oz nulls first, declared_value_cents nulls first,
  label_created_at nulls first, carrier_promised_delivery_at nulls first, voided_at nulls first)
"""

_SLA = """
(values ('USPS_PRIORITY', 3), ('USPS_STANDARD', 5), ('UPS_2ND_DAY', 2), ('UPS_GROUND', 7),
('FEDEX_2_DAY', 2), ('FEDEX_NORMAL', 7), ('DHL_ECOM_EXPRESS', 3), ('DHL_ECOM_FLEX', 5))
sla(service_class, sla_days)
"""

_SCAN_KEY = """label_id, event_code, event_type, event_at,
case when event_at is null then event_id end"""

_STAGE_ROWS = """
(select label_id, carrier, voided_at, coalesce(a, false) picked_up, coalesce(b, false) in_transit,
  coalesce(c, false) out_for_delivery, coalesce(d, false) delivered
from silver_labels left join (select label_id, bool_or(event_name = 'picked_up') a,
  bool_or(event_name = 'in_transit') b, bool_or(event_name = 'out_for_delivery') c,
  bool_or(event_name = 'delivered') d from silver_events group by 1) using (label_id))
"""

_SEQUENCE = f"""
(select label_id, carrier, picked_up, in_transit, out_for_delivery, delivered,
  picked_up::int + in_transit::int + out_for_delivery::int + delivered::int stages_seen,
  case when delivered then 'delivered' when out_for_delivery then 'out_for_delivery'
    when in_transit then 'in_transit' when picked_up then 'picked_up' else 'none' end
    furthest_stage,
  picked_up and in_transit and out_for_delivery and delivered is_complete,
  voided_at is null and not delivered is_stuck
from {_STAGE_ROWS})
"""

_TIMED = """
(select *, date_diff('microsecond', event_at, event_received_at) // 1000000 latency_seconds
from silver_events)
"""

ORACLES: dict[str, str] = {
    # ---- raw
    "raw_labels": after("raw_labels", "select * from raw_labels"),
    "raw_events": after("raw_events", "select * from raw_events"),
    "land_contract_labels": after("raw_labels", nulls("raw_labels", LABELS_REQUIRED)),
    "land_contract_events": after("raw_events", nulls("raw_events", EVENTS_REQUIRED)),
    "ingestion_metadata": after(
        "raw_events",
        "select 'batch-1' _ingestion_batch_id, count(*) as rows, count(*) timed from raw_events",
    ),
    # ---- latest row per key
    "collapse_latest": after("labels_now", "select * from labels_now"),
    "collapse_latest_users": """
        select * exclude (n) from (select *, row_number() over (
          partition by user_id order by ts desc nulls last, event_id desc) n from events)
        where n = 1""",
    "dedup_events": after("deduped", "select * from deduped"),
    "dedup_lineitem": """
        select * exclude (n) from (select *, row_number() over (
          partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc,
          l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc,
          l_returnflag desc, l_linestatus desc) n from lineitem) where n = 1""",
    "dedup_logical": after(
        "silver_events",
        f"""select * exclude (n) from (select *, row_number() over (partition by {_SCAN_KEY}
        order by event_received_at desc nulls last, event_id desc) n from silver_events)
        where n = 1""",
    ),
    "logical_duplicates": after(
        "silver_events",
        """select label_id, event_code, event_type, event_at, count(*) copies from silver_events
        where event_at is not null group by all having count(*) > 1""",
    ),
    "merge_latest": after("labels_now", "select * from labels_now"),
    "scd2": after(
        "raw_labels",
        "select * exclude (nxt) from ("
        + SCD2.format(key="label_id", ts="last_updated_at", ties=_LABEL_TIES, source="raw_labels")
        + ")",
    ),
    "scd2_users": "select * exclude (nxt) from ("
    + SCD2.format(
        key="user_id",
        ts="ts",
        ties="event_type desc nulls last, event_id desc",
        source="(select user_id, ts, event_type, event_id from events)",
    )
    + ")",
    # ---- flags and times
    "flag_weight": after(
        "raw_labels",
        """select label_id, weight_oz,
        coalesce(weight_oz >= 1000 and weight_oz <= 1120, false) can_be_weight_fraud
        from raw_labels""",
    ),
    "flag_void": after(
        "raw_labels", f"select label_id, voided_at, {VOID_FLAG} can_be_void_fraud from raw_labels"
    ),
    "flag_insurance": after(
        "raw_labels",
        """select label_id, declared_value_cents,
        coalesce(declared_value_cents = 0, false) can_be_insurance_anomaly from raw_labels""",
    ),
    "flag_missing_zip": after(
        "raw_labels",
        """select label_id, origin_zip, dest_zip,
        origin_zip is null or dest_zip is null can_be_missing_zip from raw_labels""",
    ),
    "abbr_to_offset": after(
        "repaired_raw",
        """select zone, coalesce(diff, 'Z') zone_offset, count(*) events
        from repaired_raw left join zones on zone = abbr where zone <> '' group by all""",
    ),
    "normalize_event_at": after(
        "repaired_raw", "select event_id, event_at, normalized_iso from repaired_raw"
    ),
    "parse_event_at": after(
        "repaired_raw", "select event_id, event_at, parsed_at from repaired_raw"
    ),
    "parse_event_at_with_fallback": after(
        "repaired_raw",
        """select event_id, event_at, coalesce(parsed_at, event_received_at) parsed_at
        from repaired_raw""",
    ),
    "flag_malformed": after(
        "repaired_raw", "select event_id, event_at, is_malformed_timestamp from repaired_raw"
    ),
    "time_shapes": after(
        "repaired_raw", "select carrier, shape, count(*) events from repaired_raw group by all"
    ),
    "flag_missing_type": after(
        "raw_events",
        """select event_id, label_id, event_code is null and event_type is null
        is_missing_event_type from raw_events""",
    ),
    "canonical_event_name": after(
        "raw_events stages",
        """select event_id, event_code, event_type, coalesce(stage, 'unknown') event_name
        from raw_events left join stages on sent = coalesce(event_code, event_type)""",
    ),
    "parse_payload": """
        select event_id, try_cast(json_extract_string(try_cast(props as json), '$.k') as bigint) k,
        props is not null and try_cast(props as json) is null is_unparsable_payload from events""",
    # ---- silver
    "silver_labels": after("silver_labels", "select * from silver_labels"),
    "silver_events": after("silver_events", "select * from silver_events"),
    "flag_on_voided": after(
        "raw_events silver_labels",
        """select event_id, e.label_id, l.voided_at is not null is_event_on_voided_label
        from raw_events e left join silver_labels l on l.label_id = e.label_id""",
    ),
    "stamp": after(
        "labels_now", "select label_id, timestamp '2024-01-01 00:00:00' inserted_at from labels_now"
    ),
    "orphaned_events": after("silver_events", f"select * from silver_events where {_NO_LABEL}"),
    "drop_orphans": after("silver_events", f"select * from silver_events where not ({_NO_LABEL})"),
    # ---- gold
    "latest_delivery": after("deliveries", "select * from deliveries"),
    "delivery_performance": after("gold", "select * from gold"),
    "on_time_summary": after("gold", f"select {ON_TIME} from gold"),
    "on_time_by_carrier": after("gold", f"select carrier, {ON_TIME} from gold group by carrier"),
    "on_time_by_carrier_service": after(
        "gold", f"select carrier, service_class, {ON_TIME} from gold group by all"
    ),
    "on_time_rollup": after(
        "gold",
        f"""select carrier, service_class, 2 as level, {ON_TIME} from gold group by carrier, service_class
        union all select carrier, 'ALL', 1, {ON_TIME} from gold group by carrier
        union all select 'ALL', 'ALL', 0, {ON_TIME} from gold""",
    ),
    "days_late": after("late", "select label_id, actual_delivery_at, days_late from late"),
    "delivery_details": after(
        "late",
        """select late.*, date_diff('day', l.label_created_at::date, first_event_at::date)::int
          days_to_first_scan,
          coalesce(event_count, 0) event_count, coalesce(scans, 0) logical_event_count,
          coalesce(flagged, false) or can_be_weight_fraud or can_be_void_fraud
            or can_be_insurance_anomaly or can_be_missing_zip has_data_quality_issues
        from late join silver_labels l using (label_id)
        left join (select label_id, min(event_at) first_event_at, count(*) event_count,
          bool_or(is_malformed_timestamp or is_missing_event_type or is_event_on_voided_label)
            flagged from silver_events group by 1) using (label_id)
        left join (select label_id, count(*) scans from (select distinct """
        + _SCAN_KEY
        + " from silver_events) group by 1) using (label_id)",
    ),
    "delay_analysis": after(
        "late",
        f"""select carrier, service_class, substr(origin_zip, 1, 3) origin_region, {DELAYS}
        from late group by all""",
    ),
    "delay_clusters": after(
        "late",
        "\nunion all\n".join(
            [
                delays_by("origin_region", "substr(origin_zip, 1, 3)"),
                delays_by("lane", "substr(origin_zip, 1, 3) || '>' || substr(dest_zip, 1, 3)"),
                delays_by("weekday", "isodow(label_created_at)::varchar"),
                delays_by("service_class", "service_class"),
            ]
        ),
    ),
    "data_freshness": after(
        "silver_labels silver_events",
        f"""select age_bucket, count(*) labels, count(last_event_at) tracked,
          count(*) filter (is_recent) recent, {pct("count(last_event_at)", "count(*)")} pct_tracked,
          {pct("count(*) filter (is_recent)", "count(*)")} pct_recent
        from (select case when age < 1 then '0: under 1 day' when age < 3 then '1: 1-2 days'
            when age < 7 then '2: 3-6 days' when age < 14 then '3: 7-13 days'
            when age < 30 then '4: 14-29 days' else '5: 30 days or more' end age_bucket,
          last_event_at, last_event_at >= now_at - interval '72' hour is_recent
          from (select *, date_diff('second', label_created_at, now_at) // 86400 age
            from silver_labels l cross join
              (select max(event_received_at) now_at from silver_events) t
            left join (select label_id label, max(event_at) last_event_at from silver_events
              group by 1) e on label = l.label_id
            where label_created_at <= now_at))
        group by 1""",
    ),
    # ---- profiles
    "dq_profile": after(
        "raw_labels raw_events repaired_raw silver_labels silver_events",
        "\nunion all\n".join(
            [
                metrics(
                    "(select label_id, count(*) images from raw_labels group by 1)",
                    "raw_labels",
                    changed="count(*) filter (images > 1)",
                ),
                metrics(
                    "silver_labels",
                    "silver_labels",
                    voided="count(voided_at)",
                    insured="count(declared_value_cents)",
                    weight_flag="count(*) filter (can_be_weight_fraud)",
                    void_flag="count(*) filter (can_be_void_fraud)",
                    insurance_flag="count(*) filter (can_be_insurance_anomaly)",
                    missing_zip="count(*) filter (can_be_missing_zip)",
                ),
                metrics(
                    "repaired_raw left join zones on zone = abbr",
                    "raw_events",
                    repeated_id="count(*) - count(distinct event_id)",
                    unknown_zone="count(*) filter (zone <> '' and abbr is null)",
                    no_location="count(*) filter (location_zip is null)",
                ),
                metrics(
                    "silver_events",
                    "silver_events",
                    missing_event_type="count(*) filter (is_missing_event_type)",
                    unknown_event_name="count(*) filter (event_name = 'unknown')",
                    malformed_timestamp="count(*) filter (is_malformed_timestamp)",
                    unreadable_timestamp="count(*) filter (event_at is null)",
                    delivery_unreadable=(
                        "count(*) filter (event_name = 'delivered' and event_at is null)"
                    ),
                    on_voided_label="count(*) filter (is_event_on_voided_label)",
                    late_arrival=(
                        "count(*) filter (event_received_at >= event_at + interval '2' day)"
                    ),
                    orphan=f"count(*) filter ({_NO_LABEL})",
                ),
            ]
        ),
    ),
    "out_of_order": after(
        "silver_events",
        """select *, event_rank <> arrival_rank is_out_of_order from (
        select event_id, label_id, carrier, event_at, event_received_at,
          row_number() over (partition by label_id order by event_at, event_received_at, event_id)
            event_rank,
          row_number() over (partition by label_id order by event_received_at, event_at, event_id)
            arrival_rank
        from silver_events where event_at is not null)""",
    ),
    "arrival_latency": after(
        "silver_events",
        f"""select carrier, count(*) events,
          count(*) filter (latency_seconds >= 172800) late,
          {pct("count(*) filter (latency_seconds >= 172800)", "count(*)")} pct_late,
          sum(latency_seconds)::double / count(*) avg_seconds,
          quantile_disc(latency_seconds, 0.5) p50_seconds,
          quantile_disc(latency_seconds, 0.95) p95_seconds, max(latency_seconds) max_seconds
        from {_TIMED} where latency_seconds is not null group by 1""",
    ),
    "late_arrivals": after(
        "silver_events",
        f"""select event_id, label_id, latency_seconds,
          event_received_at >= carrier_promised_delivery_at + interval '3' day is_late_arrival
        from {_TIMED} left join silver_labels using (label_id)""",
    ),
    "sequence_completeness": after("silver_events", f"select * from {_SEQUENCE}"),
    "stage_summary": after(
        "silver_events",
        f"""select carrier, furthest_stage, count(*) labels, count(*) filter (is_complete) complete,
        count(*) filter (is_stuck) stuck from {_SEQUENCE} group by all""",
    ),
    "promise_audit": after(
        "silver_labels",
        f"""select service_class, sla_days, count(*) labels, count(*) filter (p = e) kept_to_sla,
          count(*) filter (p < e) tighter, count(*) filter (p > e) looser,
          sla_days is not null has_sla
        from (select service_class, sla_days, carrier_promised_delivery_at p,
            label_created_at + sla_days * interval '1' day e
          from silver_labels left join {_SLA} using (service_class)) group by 1, 2""",
    ),
    "change_history": after(
        "raw_labels",
        f"""select label_id, last_updated_at, carrier, service_class, voided_at, prev_carrier,
          prev_service_class, prev_voided_at,
          nr > 1 and carrier is distinct from prev_carrier changed_carrier,
          nr > 1 and service_class is distinct from prev_service_class changed_service_class,
          nr > 1 and voided_at is distinct from prev_voided_at changed_voided_at, nr = 1 is_first,
          1::bigint copies
        from ({_BEFORE})""",
    ),
    "void_profile": after(
        "silver_events",
        """select void_kind, count(*) labels, coalesce(sum(n), 0)::bigint scans,
          coalesce(sum(a), 0)::bigint scans_after_void,
          count(*) filter (a > 0) labels_scanned_after_void
        from (select label_id, voided_at, case when voided_at <= label_created_at
            + interval '1' hour then 'immediate' else 'late' end void_kind
          from silver_labels where voided_at is not null) v
        left join (select label_id, count(*) n, count(*) filter (event_at > voided_at) a
          from silver_events join silver_labels using (label_id) where voided_at is not null
          group by 1) using (label_id)
        group by 1""",
    ),
    "mix_check": after(
        "silver_labels",
        f"""select *, abs(pct - target_pct) <= 2 within_tolerance from (
          select carrier, coalesce(c.labels, 0) labels, coalesce(target_pct, 0) target_pct,
            {pct("coalesce(c.labels, 0)", "(select count(*) from silver_labels)")} pct
          from (select carrier, count(*) labels from silver_labels group by 1) c
          full join (select * from (values ('USPS', 50::double), ('UPS', 30::double),
            ('FEDEX', 15::double), ('DHL_ECOM', 5::double)) t(carrier, target_pct)) t
          using (carrier))""",
    ),
    "format_contract": after(
        "raw_labels",
        rules(
            label_id="not regexp_full_match(label_id, 'lbl_[0-9a-f]{24}')",
            customer_id="not regexp_full_match(customer_id, 'cust_[0-9a-f]{12}')",
            carrier="carrier not in ('USPS', 'UPS', 'FEDEX', 'DHL_ECOM')",
            service_class=f"service_class not in (select service_class from {_SLA})",
            service_class_of_carrier="not starts_with(service_class, carrier || '_')",
            origin_zip="not regexp_full_match(origin_zip, '[0-9]{5}')",
            dest_zip="not regexp_full_match(dest_zip, '[0-9]{5}')",
            weight_oz="weight_oz not between 1 and 1120",
            declared_value_cents="declared_value_cents < 0",
            promise_after_creation="carrier_promised_delivery_at <= label_created_at",
            update_after_creation="last_updated_at < label_created_at",
        ),
    ),
    # ---- quality
    "unique": after(
        "raw_events",
        "select event_id, count(*) as rows from raw_events group by 1 having count(*) > 1",
    ),
    "unique_orders": (
        "select o_orderkey, count(*) as rows from orders group by 1 having count(*) > 1"
    ),
    "not_null": after("raw_labels", "select * from raw_labels where dest_zip is null"),
    "relationships": after(
        "raw_events silver_labels", f"select * from raw_events where {_NO_LABEL}"
    ),
    "relationships_orders": """
        select * from orders where not exists (
          select 1 from customer where c_custkey = o_custkey)""",
    "accepted_values": """
        select event_type, count(*) as rows from events
        where event_type not in ('click', 'view', 'purchase') group by 1""",
    "model_tests": after(
        "gold silver_events",
        "\nunion all\n".join(
            [
                *_keyed("silver_labels", "silver_labels", "label_id"),
                *_keyed("silver_events", "silver_events", "event_id"),
                *_keyed("gold", "gold", "label_id"),
                _failures(
                    "silver_events",
                    "label_id",
                    "relationships",
                    f"select count(*) from silver_events where {_NO_LABEL}",
                ),
                _failures(
                    "gold",
                    "label_id",
                    "relationships",
                    f"select count(*) from gold where {_NO_LABEL}",
                ),
                _failures(
                    "silver_events",
                    "event_name",
                    "accepted_values",
                    """select count(distinct event_name) from silver_events where event_name
                    not in (select stage from stages union all select 'unknown')""",
                ),
                _failures(
                    "gold",
                    "is_delivered_on_time",
                    "not_null",
                    "select count(*) from gold where is_delivered_on_time is null",
                ),
            ]
        ),
    ),
    "dq_gate": after(
        "gold silver_events",
        gate(
            **{
                "1a event names canonical": (
                    """select count(*) from silver_events where event_name
                    not in (select stage from stages union all select 'unknown')""",
                    "x = 0",
                    "= 0",
                ),
                "1b all stages per carrier": (
                    """select count(*) from (select carrier from silver_events
                    where event_name <> 'unknown' group by 1
                    having count(distinct event_name) < 4)""",
                    "x = 0",
                    "= 0",
                ),
                "1c share parsed": (
                    f"select {pct('count(event_at)', 'count(*)')} from silver_events",
                    "x >= 99",
                    ">= 99",
                ),
                "1d share malformed": (
                    f"""select {pct("count(*) filter (is_malformed_timestamp)", "count(*)")}
                    from silver_events""",
                    "x < 3",
                    "< 3",
                ),
                "2a event id unique": (
                    "select count(*) - count(distinct event_id) from silver_events",
                    "x = 0",
                    "= 0",
                ),
                "2b no orphan events": (
                    f"select count(*) from silver_events where {_NO_LABEL}",
                    "x = 0",
                    "= 0",
                ),
                "2c one row per label": (
                    "select count(*) - count(distinct label_id) from silver_labels",
                    "x = 0",
                    "= 0",
                ),
                "3a no delivery before creation": (
                    """select count(*) from silver_events join silver_labels using (label_id)
                    where event_name = 'delivered' and event_at < label_created_at""",
                    "x = 0",
                    "= 0",
                ),
                "4a mart one row per label": (
                    """select abs(count(*) - count(distinct label_id)) + abs(count(distinct label_id)
                    - (select count(distinct label_id) from silver_labels)) from gold""",
                    "x = 0",
                    "= 0",
                ),
                "4b on time of all": (
                    _GOLD_SHARE.format(pct(_ON_TIME, "count(*)")),
                    "x between 80 and 99",
                    "in [80, 99]",
                ),
                "4c on time of delivered": (
                    _GOLD_SHARE.format(pct(_ON_TIME, _DONE)),
                    "x between 80 and 99.9",
                    "in [80, 99.9]",
                ),
                "4d late of delivered": (
                    _GOLD_SHARE.format(pct(f"{_DONE} - {_ON_TIME}", _DONE)),
                    "x > 0 and x < 15",
                    "in (0, 15)",
                ),
                "4e no impossible states": (
                    """select count(*) filter (not is_delivered and actual_delivery_at is not null)
                    + count(*) filter (not is_delivered and is_delivered_on_time)
                    + count(*) filter (is_delivered_on_time
                      and actual_delivery_at > carrier_promised_delivery_at) from gold""",
                    "x = 0",
                    "= 0",
                ),
                "4f no carrier at an extreme": (
                    f"""select count(*) from (select {pct(_ON_TIME, "count(*)")} p
                    from gold group by carrier) where p <= 1 or p >= 99.5""",
                    "x = 0",
                    "= 0",
                ),
            }
        ),
    ),
    "idempotency_snapshot": after(
        "gold", f"select count(*) as rows, {_ON_TIME} on_time from gold"
    ),
    "parity": after(
        "gold",
        """select count(*) differing_rows, coalesce(sum(1), 0)::bigint differences from (
        select * from gold except all select * from gold)""",
    ),
    # ---- tables, incremental loads, streaming
    "land_and_validate": after(
        "raw_labels raw_events",
        f"""select landed, n as rows, case when (select bool_and(passed) from (
            {nulls("raw_labels", LABELS_REQUIRED)} union all
            {nulls("raw_events", EVENTS_REQUIRED)}))
          then 'success' else 'success_with_warnings' end status
        from (select 'labels' landed, count(*) n from raw_labels
          union all select 'events', count(*) from raw_events)""",
    ),
    "full_refresh": after("gold", "select * from gold"),
    "incremental_silver_events": after("silver_events", "select * from silver_events"),
    "incremental_delivery_performance": after("gold", "select * from gold"),
    "stream_silver_events": after("silver_events", "select * from silver_events"),
    "stream_delivery_performance": after("gold", "select * from gold"),
    "stream_dedup_events": after("raw_events", "select distinct event_id from raw_events"),
    "stream_dedup_recent": after("raw_events", "select distinct event_id from raw_events"),
    "stream_late_events": after(
        "raw_events",
        """select event_id, max(event_received_at) event_received_at
        from (select *, split_part(event_id, '_', 2)::bigint % 4 part from raw_events) join (
          select a.part, max(b.newest) - interval '8 days' mark
          from (select split_part(event_id, '_', 2)::bigint % 4 part, max(event_received_at) newest
            from raw_events group by 1) b
          join (values (1), (2), (3)) a(part) on b.part < a.part group by 1) using (part)
        group by event_id having max(event_received_at) < max(mark)""",
    ),
    "stream_with_batch_ids": after("gold", "select * from gold"),
    "replayed_batches": after(
        "gold raw_events silver_events",
        """select 'raw_labels' as name, count(*) as rows from raw_labels
        union all select 'raw_events', count(*) from raw_events
        union all select 'silver_labels', count(*) from silver_labels
        union all select 'silver_events', count(*) from silver_events
        union all select 'gold', count(*) from gold""",
    ),
    "orphans_over_time": after(
        "silver_events raw_events",
        """select s.event_id, s.label_id, timestamp '2024-01-01' +
          case when f.event_id is null then interval '1 day' else interval '0 day' end detected_at
        from silver_events s
        left join (select distinct event_id from raw_events where event_received_at < '1998-07-01') f
          using (event_id)
        where s.label_id not in (select label_id from silver_labels)""",
    ),
    "parity_altered": after(
        "gold",
        """select count(*) differing_rows, count(*)::bigint differences from (
          select * from gold where carrier = 'FEDEX' union all
          select * replace (not is_delivered_on_time as is_delivered_on_time) from gold
          where carrier = 'FEDEX')""",
    ),
    "idempotency_two_builds": after(
        "gold",
        f"""select count(*) as rows, {_ON_TIME} on_time, 0::bigint differing_rows,
          0::bigint differences from gold""",
    ),
    "change_history_repeated": after(
        "raw_labels",
        f"""select label_id, last_updated_at, carrier, service_class, voided_at, prev_carrier,
          prev_service_class, prev_voided_at,
          nr > 1 and carrier is distinct from prev_carrier changed_carrier,
          nr > 1 and service_class is distinct from prev_service_class changed_service_class,
          nr > 1 and voided_at is distinct from prev_voided_at changed_voided_at, nr = 1 is_first,
          case when weight_oz % 3 = 0 then 2 else 1 end::bigint copies
        from ({_BEFORE})""",
    ),
    "appended_and_ignored": after(
        "raw_labels",
        """select mode, n * landed landed, n * stored stored
        from (select count(*) n from raw_labels),
          (values ('overwrite', 1, 1), ('ignore', 0, 1), ('append', 1, 2)) m(mode, landed, stored)""",
    ),
    "preview_events": "select event_id, user_id from events order by ts, event_id limit 10",
}


def _verdict(build: str, known_only: bool) -> str:
    """The gate's summary of a build, from the SQL of its checks."""
    rows = (
        f"select model || '.' || column_name || '.' || test as name, passed from ({ORACLES['model_tests']})"
        f" union all select check_name, passed from ({ORACLES['dq_gate']})"
    )
    if known_only:
        sent = f"raw_events as materialized ({RAW_EVENTS})"
        known = f"select * from ({RAW_EVENTS}) where substr(label_id, 5)::bigint < 100000000"
        rows = rows.replace(sent, f"raw_events as materialized ({known})")
    return f"""select '{build}' build,
      case when bool_and(passed) then 'success' else 'failed' end status, count(*) checks,
      coalesce(string_agg(name, ', ' order by name) filter (not passed), '') failed,
      bool_and(passed) published from ({rows})"""


ORACLES |= {
    "gated_builds": f"{_verdict('as sent', False)} union all {_verdict('without orphans', True)}",
    "published_delay_analysis": ORACLES["delay_analysis"],
    "published_data_freshness": ORACLES["data_freshness"],
    "partials_delay_analysis": ORACLES["delay_analysis"],
    "partials_on_time_rollup": ORACLES["on_time_rollup"],
    "sketched_scans": after(
        "silver_events",
        f"""select carrier, count(*) scans, count(latency_seconds) timed, count(distinct label_id) labels,
          true labels_hold, true p50_holds, true p95_holds, true p99_holds
        from {_TIMED} group by 1""",
    ),
}
