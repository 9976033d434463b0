"""ANSI SQL that gives the same rows as the query of the same name.

Queries without an entry have no SQL counterpart (64-bit hashes of the engine,
sketches and clustering); their tests compare them with brute force instead.
"""

from __future__ import annotations

import re

from tidemill.plans import location
from tidemill.plans.stand_in import location_expressions

LISTED = """select distinct c_custkey as id from customer where c_acctbal < 0 and c_acctbal >= -900"""

SMALL = """user_id, max(ts) as ts, min(value) as min_value, max(event_type) as event_type,
    count(*) filter (where event_type = 'purchase') as purchases, count(*) as n"""


def _location_source(drop: tuple[str, ...] = ()) -> str:
    columns = ", ".join(
        f'{text} as "{name}"' for name, text in location_expressions().items() if name not in drop
    )
    return f"select {columns} from events"


_SMALLEST = re.compile(r"^(osId|locationAccuracy|(cellS|s)ignalLevel[1-5]?)$")
_CODES = {"simMCC", "simMNC", "cellMCC", "cellMNC"}
_MACS = re.compile(r"^bssid[1-5]?$")
_GROUPED = (
    "userId sourceIp latitude longitude publisherTypeId packageId productId bssid networkTypeId"
).split()


def _full_rollup() -> str:
    columns = []
    for name, kind in location.OUTPUT_TYPES:
        if name == "loadTs":
            continue
        if name == "biRunId":
            text = "cast(12345 as bigint)"
        elif name == "numBidRequests":
            text = "cast(sum(case when eventTypeId = 102 then 1 else 0 end) as bigint)"
        elif name == "numEvents":
            text = "count(*)"
        else:
            text = name if name in _GROUPED else f"{'min' if _SMALLEST.match(name) else 'max'}({name})"
            if name in _CODES:
                text = f"nullif({text}, -9999)"
            if _MACS.match(name):
                text = f"nullif({text}, -1)"
            text = {
                location.INT: f"cast({text} as bigint)",
                location.PLACE: f"cast({text} as double)",
                location.TIME: f"cast({text} as timestamp)",
            }.get(kind, text)
        columns.append(f'{text} as "{name}"')
    return f"""
    with src as ({_location_source()})
    select {", ".join(columns)} from src
    where loadTs > timestamp '2024-01-02' and loadTs <= timestamp '2024-01-29'
      and eDate >= date '2024-01-02' - interval 30 day
      and publisherTypeId in (1, 2, 7) and isValidAdvertisingId = 1 and country in ('US')
      and not exists (select 1 from ({LISTED}) l where l.id = coalesce(src.userId, 0))
    group by {", ".join(_GROUPED)}, date_trunc('minute', ts)"""


def _reduced_rollup() -> str:
    missing = ("networkTypeId", "cityId", "userAgent")
    types = dict(location.OUTPUT_TYPES)
    by = ["userId", "sourceIp", "publisherTypeId", "packageId", "productId"]
    columns = [f'cast({k} as bigint) as "{k}"' for k in by]
    columns.append("cast(date_trunc('minute', ts) as timestamp) as time_slice_minute")
    for name in location.REDUCED_OUTPUTS:
        if name in missing:
            continue
        text = f"{'min' if name == 'osId' else 'max'}({name})"
        kind = types[name]
        if kind == location.PLACE:
            text = f"cast({text} as double)"
        elif kind == location.INT:
            text = f"cast({text} as bigint)"
        elif kind == location.TIME:
            text = f"cast({text} as timestamp)"
        columns.append(f'{text} as "{name}"')
    columns.append("cast(12345 as bigint) as biRunId")
    columns.append("count(*) filter (where eventTypeId = 102) as numBidRequests")
    columns.append("count(*) as numEvents")
    for name in location.REDUCED_PLACEHOLDERS:
        kind = {location.PLACE: "double", location.TEXT: "varchar"}.get(types[name], types[name])
        columns.append(f'cast(null as {kind}) as "{name}"')
    return f"""
    with src as ({_location_source(missing)})
    select {", ".join(columns)} from src
    where isValidAdvertisingId = 1 and publisherTypeId in (1, 2, 7)
    group by {", ".join(by)}, date_trunc('minute', ts)"""


# One row per document of the topic records: offset, pos, kind, key, body.
_DOCS = """
    select event_id as "offset", user_id, cast(0 as integer) as pos, cast(user_id as varchar) as key,
      case event_type when 'signup' then 'gadget' when 'view' then 'in/valid' when 'click' then 'unknown'
        else concat('widget-', cast(user_id % 7 as varchar)) end as kind,
      case event_type when 'click' then props else concat('n', cast(event_id as varchar)) end as body
    from events where event_type <> 'error'
    union all
    select event_id, user_id, 1, cast(user_id as varchar), 'unknown', concat('n', cast(event_id as varchar))
    from events where event_type = 'signup'"""

_SESSIONS = """
    select concat('S', cast(o_custkey as varchar)) as CSID,
      case when o_orderstatus <> 'P' then o_totalprice / 5100 end as score,
      cast(o_totalprice as decimal(18,2)) as amount,
      o_orderpriority as f1, concat('status ', o_orderstatus) as f2,
      case when o_orderstatus <> 'F' then concat('C', cast(o_custkey % 25 as varchar)) end as country,
      concat('State ', cast(o_orderkey % 50 as varchar)) as state
    from orders"""

_FLAGGED = f"""
    select CSID, max(score) as score, sum(amount) as amount, count(*) as n
    from ({_SESSIONS}) s group by CSID having max(score) > 80"""

_REPORT = f"""
    select 'flagged' as section, cast(count(*) as varchar) as item,
      cast(coalesce(sum(amount), 0) as double) as amount from ({_FLAGGED}) f
    union all
    select 'critical', CSID, max(score) from (
      select CSID, score from ({_SESSIONS}) s where score is not null order by score desc, CSID limit 5) t
    group by CSID
    union all
    select distinct kind, element, cast(null as double) from (
      select CSID, 'country' as kind, lower(country) as element from ({_SESSIONS}) s where country is not null
      union all select CSID, 'country', 'home' from ({_SESSIONS}) s where country is not null
      union all select CSID, 'state', lower(state) from ({_SESSIONS}) s
      union all select CSID, 'factor', f1 from ({_SESSIONS}) s
      union all select CSID, 'factor', f2 from ({_SESSIONS}) s) e
    where CSID in (select CSID from ({_FLAGGED}) f)"""


def _crc16(key: str) -> str:
    m = "xor(crc >> 8, b)"
    m = f"xor({m}, ({m}) >> 4)"
    step = f"xor(xor(xor(crc << 8, ({m}) << 12), ({m}) << 5), {m}) & 65535"
    return f"""list_reduce(list_transform(string_split({key}, ''), lambda c: cast(ord(c) as bigint)),
        lambda crc, b: {step}, cast(0 as bigint))"""


_CENTRES = """
    pieces as (select label, unnest(embedding) as x, generate_subscripts(embedding, 1) as pos from embeddings),
    means as (select label, pos, avg(cast(x as double)) as x from pieces group by label, pos),
    q as (select label as query_id, list(x order by pos) as q from means group by label),
    scored as (
      select query_id, vec_id as neighbour_id, round(list_dot_product(q, cast(embedding as double[])) /
        (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(cast(embedding as double[]),
          cast(embedding as double[]))) + 1e-9), 12) as score
      from q, embeddings),
    ranked as (
      select *, cast(row_number() over (partition by query_id order by score desc, neighbour_id) as integer)
        as "rank" from scored)"""

_TAGS = """
    select conv_id, turn,
      concat_ws(',', case when contains(lower(text), 'that') or contains(lower(text), 'this') then 'A' end,
        case when contains(lower(text), 'from') then 'B' end) as alerts,
      (case when contains(lower(text), 'that') or contains(lower(text), 'this') then 1 else 0 end)
        + (case when contains(lower(text), 'from') then 1 else 0 end) as k,
      case when contains(lower(text), 'with') then 's1,s2' when contains(lower(text), 'the') then 's3' end
        as suggestions,
      case when contains(lower(text), 'with') then 'n1,n2' end as next_steps
    from conversations"""

_COUNTS = " union all ".join(
    f"select count(*) as \"Count\", '{name}' as TableName from {name}"
    for name in (
        "region nation customer supplier part orders lineitem events documents embeddings pages"
        " benchmark labels conversations"
    ).split()
)

_LINES = """
    select event_id, user_id, event_type, value, concat_ws(chr(9), cast(event_id as varchar),
      case when event_type = 'click' then '' else concat('u-', cast(user_id as varchar)) end,
      concat('10.', cast(user_id % 300 as varchar), '.0.1'),
      case when event_type = 'error' and user_id % 2 = 0 then 'n/a' else cast(value as varchar) end,
      case when event_type = 'view' then null else event_type end,
      case when event_type = 'error' and user_id % 2 = 1 then 'surplus' end) as line
    from events"""

_RANKED_VALUE = """
    select {by}, {value} as p99 from (
      select {by}, {value}, row_number() over (partition by {by} order by {value}) as i,
        count(*) over (partition by {by}) as n from {source}) r
    where i = floor(n * 0.99) + 1"""


def _summary(source: str, by: str, value: str) -> str:
    ranked = _RANKED_VALUE.format(by=by, value=value, source=source)
    return f"""
    select b.{by} as {by}, n, fastest, average, p99, slowest from (
      select {by}, count({value}) as n, min({value}) as fastest, avg({value}) as average,
        max({value}) as slowest from {source} group by {by}) b
    join ({ranked}) p on b.{by} = p.{by}"""


_LINE_SUMMARY = _summary(
    "(select * from lineitem where l_returnflag in ('A', 'R')) x", "l_returnflag", "l_extendedprice"
)


def _ratio(measure: str) -> str:
    return (
        f"round(max(case when l_returnflag = 'A' then {measure} end) /"
        f" greatest(max(case when l_returnflag = 'R' then {measure} end), 0.001), 6) as {measure}_ratio"
    )


ORACLES: dict[str, str] = {
    "minute_rollup": f"""
        select {SMALL} from events
        group by user_id, date_trunc('minute', ts)""",
    "location_rollup": _full_rollup(),
    "reduced_rollup": _reduced_rollup(),
    "rollup_excluding_users": f"""
        select {SMALL} from events e where event_type in ('view', 'click', 'purchase')
          and not exists (select 1 from ({LISTED}) l where l.id = coalesce(e.user_id, 0))
        group by user_id, date_trunc('minute', ts)""",
    "date_floor": """
        select o_orderkey, o_orderdate from orders
        where o_orderdate >= date '2000-06-01' - interval 30 day""",
    "load_window": """
        select o_orderkey, o_orderdate from orders
        where o_orderdate > timestamp '1996-01-01' and o_orderdate <= timestamp '1999-01-01'""",
    "incremental_window": """
        select o_orderkey, o_custkey, o_orderdate from orders
        where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1999-01-01'
          and o_orderstatus <> 'P'""",
    "conformed_customers": """
        select c_custkey as "ID", c_name as "CUSTOMER_NAME",
          case when c_acctbal >= 0 then c_acctbal end as "C_ACCTBAL", cast(null as varchar) as "CHANNEL",
          cast(null as double) as "SCORE", cast(c_nationkey as bigint) as "C_NATIONKEY"
        from customer""",
    "iso_times": """
        select event_id, case when event_type = 'view' then date_trunc('second', ts) - interval 2 hour
          else date_trunc('second', ts) end as utc from events""",
    "run_columns": """
        select user_id, count(*) filter (where event_type = 'purchase') as bids, count(*) as events,
          cast(7 as bigint) as run from events group by user_id""",
    "latest_per_key": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
          l_tax, l_returnflag, l_linestatus, l_shipdate from (
          select *, row_number() over (partition by l_orderkey order by l_shipdate desc nulls first,
            l_partkey desc nulls first, l_suppkey desc nulls first, l_linenumber desc nulls first,
            l_quantity desc nulls first, l_extendedprice desc nulls first, l_discount desc nulls first,
            l_tax desc nulls first, l_returnflag desc nulls first, l_linestatus desc nulls first) as rn
          from lineitem) t where rn = 1""",
    "merge_upsert": """
        select o_orderkey, o_custkey, case when o_orderdate >= timestamp '1998-01-01'
          then lower(o_orderstatus) else o_orderstatus end as o_orderstatus, o_totalprice, o_orderdate,
          o_orderpriority from orders""",
    "incremental_load_replay": """
        select o_orderkey as "ORDER_ID", o_custkey as "CUSTOMER_ID",
          cast(cast(o_totalprice as decimal(18,2)) as double) as "AMOUNT", o_orderstatus as "STATUS",
          o_orderdate as "CREATED" from orders where o_orderdate < timestamp '1999-12-31 23:50:00'""",
    "change_only": """
        select event_id, user_id, ts, event_type from (
          select *, lag(event_type) over w as p, row_number() over w as i from events
          window w as (partition by user_id order by ts, event_id)) t
        where i = 1 or event_type is distinct from p""",
    "keyed_lookup": """
        select key, p_name, p_retailprice from (
          select concat('part:', lpad(cast(p_partkey as varchar), 7, '0')) as key, p_name, p_retailprice
          from part) k order by md5(concat('7:', key)), key limit 200""",
    "delete_by_pattern": """
        with k as (select concat_ws(':', p_brand, p_name) as key from part),
        hit as (select case when key like 'Brand#1:%' then 'Brand#1:*' when key like 'Brand#1_:%'
          then 'Brand#1?:*' when key like '%:red widget' then '*:red widget' end as pattern from k)
        select p.pattern, count(hit.pattern) as deleted from (
          select unnest(['Brand#1:*', 'Brand#1?:*', '*:red widget', 'none:*']) as pattern) p
        left join hit on hit.pattern = p.pattern group by p.pattern""",
    "kept_after_delete": """
        select p_partkey, concat_ws(':', p_brand, p_name) as key from part
        where not (p_brand = 'Brand#1' or p_brand like 'Brand#1_' or p_name = 'red widget')""",
    "ipv4_numbers": """
        select c_custkey, case when c_custkey % 300 <= 255 then (c_custkey % 300) * 16777216
          + c_nationkey * 65536 + c_custkey % 7 end as ip from customer""",
    "mac_numbers": """
        select c_custkey, case when c_nationkey = 0 then -1
          else cast(6699 as bigint) * 16777216 + c_custkey % 16777216 end as mac from customer""",
    "sql_functions": """
        select c_custkey, (c_custkey % 300) * 16777216 + c_nationkey * 65536 + c_custkey % 7 as ip,
          cast(6699 as bigint) * 16777216 + c_nationkey as mac, true as is_hash, true as in_range,
          abs(round(c_acctbal, 2)) as amount
        from customer where c_custkey % 300 <= 255""",
    "stored_quantiles": """
        select date_trunc('month', ts) as month, event_type, rank, count(value) as n, true as within,
          true as share_within
        from events, (values (cast(0.5 as double)), (cast(0.9 as double)), (cast(0.99 as double))) r(rank)
        group by 1, 2, 3""",
    "stored_distinct": """
        select date_trunc('month', ts) as month, event_type, count(distinct user_id) as users, true as within
        from events group by 1, 2""",
    "delimited_scan": """
        select event_id, concat('"', event_type, '\\ "x') as text, value from events""",
    "stream_batch_metrics": """
        select count(*) as n, cast(sum(length(event_type)) as bigint) as chars, max(cast(user_id as varchar)) as last,
          true as equal, true as five_batches from events""",
    "hashed_user_facts": """
        select c_mktsegment, count(*) filter (where c_nationkey <> 0) as users,
          count(*) filter (where c_nationkey = 0) as blank, cast(0 as bigint) as out_of_range,
          count(distinct c_name) as distinct_hashes from customer group by c_mktsegment""",
    "money_amounts": """
        select c_custkey, case when c_nationkey <> 0 then abs(round(c_acctbal, 2)) end as amount
        from customer""",
    "int_lists": """
        select l_suppkey, cast(sum(l_orderkey + l_linenumber + l_partkey) as bigint) as total,
          count(*) * 3 as n from lineitem group by l_suppkey""",
    "bulk_load": f"""
        select event_id, case when user_id % 300 <= 255 then 167772161 + (user_id % 300) * 65536 end as ip, value,
          case when event_type <> 'view' then event_type end as event_type,
          event_type <> 'click' as has_user
        from ({_LINES}) t where event_type <> 'error'""",
    "bulk_load_rejects": f"""
        select line, case when user_id % 2 = 1 then 'surplus fields' else 'bad value' end as reject_reason
        from ({_LINES}) t where event_type = 'error'""",
    "delimited_round_trip": """
        select c_custkey as id, case c_custkey % 6 when 0 then '' when 1 then 'say "hi"' when 2 then concat('a', chr(9), 'b')
            when 3 then concat('c', chr(10), 'd\\') when 4 then c_name end as name, c_nationkey as nation, c_acctbal as balance,
          c_mktsegment as extra_4 from customer""",
    "safe_export": """
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
          o_orderstatus, cast(o_totalprice as varchar) as o_totalprice,
          strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority,
          cast(null as varchar) as note from orders""",
    "json_rows": "select c_custkey, c_name, c_nationkey from customer",
    "json_field": """
        select event_id, case when event_type <> 'error' then lower(json_extract_string(props, '$.k'))
          else 'unknown' end as k, 'unknown' as absent from events""",
    "typed_messages": """
        select event_id,
          case event_type
            when 'view' then concat('{"ProductType":"', event_type, ' ', cast(user_id as varchar), '"}')
            when 'click' then concat('{"ProductType":', cast(user_id as varchar), '}')
            when 'error' then null else props end as "originalValue",
          case event_type when 'view' then concat(event_type, ' ', cast(user_id as varchar)) end
            as "productType",
          case when event_type <> 'error' then 1 end as version
        from events""",
    "route_documents": f"""
        select "offset", pos, concat('prd_', kind) as alias,
          sha256(concat_ws(':', 'events', cast(user_id % 2 as varchar), cast("offset" as varchar),
            cast(pos as varchar))) as doc_id
        from ({_DOCS}) d where kind <> 'in/valid'""",
    "dlq_split": """
        select event_id as "offset", cast(user_id as varchar) as key,
          case event_type when 'error' then concat('not json: ', props)
            else concat('{"product_type":"in/valid","n":', cast(event_id as varchar), '}') end
            as original_message,
          case event_type when 'error' then 'value is not valid JSON'
            else 'invalid document type: in/valid' end as error
        from events where event_type in ('error', 'view')""",
    "documents_by_index": """
        select concat('docs_', kind, '_00001') as index, count(*) as n, cast(sum(n_chars) as bigint) as chars
        from (select lower(concat_ws('-', lang, source)) as kind, n_chars from documents) d
        where regexp_matches(kind, '^[a-z0-9_-]+$') group by kind""",
    "topic_routing": f"""
        select concat('prd_', kind) as alias, count(*) as n from ({_DOCS}) d
        where kind <> 'in/valid' group by kind
        union all
        select 'dead letters', count(*) from events where event_type in ('error', 'view')""",
    "topic_offsets": """
        select cast(event_id % 4 as integer) as "partition",
          row_number() over (partition by event_id % 4 order by event_id) - 1 as "offset",
          cast(event_id as varchar) as key, event_type as value, true as five_batches
        from events""",
    "item_failures": """
        with r as (select *, user_id % 4 as part,
          row_number() over (partition by user_id % 4 order by event_id) - 1 as pos from events),
        good as (select * from r where event_id % 11 <> 0)
        select 'prd_event' as alias, cast(part as integer) as "partition", pos as "offset",
          concat('{"n":', event_id, ',"product_type":"event"}') as content from good
        union all
        select 'prd_user', cast(part as integer), pos, concat('{"n":', user_id, ',"product_type":"user"}')
        from good where event_id % 13 <> 0 and event_id % 7 <> 0
        union all
        select 'dead letters', cast(part as integer), pos,
          case when event_id % 11 = 0 then 'value is not valid JSON'
            when event_id % 13 = 0 then 'invalid document type: in/valid' else 'field n is no bigint' end
        from r where event_id % 11 = 0 or event_id % 13 = 0 or event_id % 7 = 0""",
    "stream_keyed_state": """
        with r as (select cast(user_id % 4 as integer) as "partition",
          row_number() over (partition by user_id % 4 order by event_id) - 1 as "offset",
          cast(user_id as varchar) as key, event_type as value from events),
        c as (select *, lag(value) over w as p, row_number() over w as i from r
          window w as (partition by key order by "offset"))
        select "partition", "offset", key, value from c where i = 1 or value is distinct from p""",
    "topic_upsert": """
        with d as (select concat('prd_widget-', user_id % 3) as alias, cast(user_id as varchar) as doc_id,
          event_id as "offset", concat('{"n":', event_id // 3 % 2, ',"product_type":"widget-', user_id % 3, '"}') as body
          from events),
        c as (select *, lag(body) over w as p, row_number() over w as i from d
          window w as (partition by alias, doc_id order by "offset"))
        select alias, doc_id, max("offset") as "offset", arg_max(body, "offset") as document from c
        where i = 1 or body is distinct from p group by alias, doc_id""",
    "stream_change_only": """
        select event_id, user_id, ts, event_type from (
          select *, lag(event_type) over w as p, row_number() over w as i from events
          window w as (partition by user_id order by ts, event_id)) t
        where i = 1 or event_type is distinct from p""",
    "stream_minute_rollup": f"""
        with e as (select * from events
          where not exists (select 1 from ({LISTED}) l where l.id = coalesce(user_id, 0)))
        select {SMALL} from e
        group by user_id, date_trunc('minute', ts)""",
    "stream_alert_counts": """
        select date_trunc('hour', ts) as window_start,
          case when value > 100 then 'high' when value < 10 then 'low' end as label, count(*) as n
        from events
        group by 1, 2""",
    "flagged_sessions": f"""
        select CSID as "CSID", round(score, 6) as score, cast(amount as double) as amount, n
        from ({_FLAGGED}) f""",
    "semi_flagged": f"""
        select CSID as "CSID", round(score, 6) as score, cast(amount as double) as "TOTAL_AMOUNT"
        from ({_SESSIONS}) s where CSID in (select CSID from ({_SESSIONS}) x where score > 80)""",
    "risk_report": f"select section, item, round(amount, 4) as amount from ({_REPORT}) r",
    "risk_sentence": f"""
        with r as ({_REPORT}),
        f as (select *, (row_number() over (partition by section order by item) - 1) // 100 as block from r)
        select section, block, count(item) as n_items, string_agg(item, ', ' order by item) as items, sum(amount) as amount
        from f group by section, block""",
    "risk_bands": f"""
        select count(*) filter (where score > 80) as high_risk,
          count(*) filter (where score > 50 and score <= 80) as medium_risk,
          count(*) filter (where score <= 50) as low_risk from ({_SESSIONS}) s""",
    "factor_frequency": f"""
        select factor, count(*) as n from (
          select f1 as factor from ({_SESSIONS}) s union all select f2 from ({_SESSIONS}) s) f
        group by factor""",
    "session_locations": f"""
        select case when country is null then '' else concat(country, ',Home') end as countries,
          state as states, count(*) as n from ({_SESSIONS}) s group by 1, 2""",
    "tag_range_search": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, matches from (
          select *, count(*) over () as matches, row_number() over (order by l_orderkey, l_linenumber,
            l_partkey, l_suppkey, l_extendedprice) as i
          from lineitem where l_returnflag = 'R' and l_quantity >= 45) t where i <= 500""",
    "sorted_table_search": """
        select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, matches from (
          select *, count(*) over () as matches, row_number() over (order by p_partkey) as i from part
          where p_brand = 'Brand#2' and p_retailprice >= 950) t where i <= 50""",
    "matches_per_tag": """
        select event_type, count(*) filter (where value >= 100) as matches from events group by event_type""",
    "prefix_scan": """
        select concat_ws(':', p_type, cast(p_partkey as varchar)) as key, p_retailprice from part
        where p_type = 'ECONOMY' and p_brand = 'Brand#2' and p_size <> 10 and p_retailprice >= 950""",
    "result_page": """
        select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey
        limit 50 offset 100""",
    "attribution_totals": """
        select event_type, json_extract_string(props, '$.k') as campaign, count(*) as n,
          cast(sum(cast(value as decimal(18,2))) as double) as revenue, round(avg(value / 10.0), 6) as mean_roas,
          cast(sum(length(props) * 2) as double) as spend,
          round(cast(sum(cast(value as decimal(18,2))) as double)
            / cast(sum(length(props) * 2) as double), 6) as return_on_spend
        from events group by 1, 2""",
    "latency_summary": f"""
        select event_type, n, fastest, round(average, 6) as average, p99, slowest
        from ({_summary("events", "event_type", "value")}) s""",
    "latency_summary_sketched": """
        select event_type, count(value) as n, min(value) as fastest, round(avg(value), 6) as average,
          max(value) as slowest, true as p99_within
        from events group by event_type""",
    "knn_approx": """
        select label as query_id, cast(r as integer) as rank, true as exists, true as is_cosine
        from (select distinct label from embeddings where label is not null) l, range(1, 6) t(r)""",
    "recall_at_k": "select true as reached",
    "slo_share": """
        select event_type, round(100.0 * count(*) filter (where value < 50) / count(value), 6) as percent
        from events group by event_type""",
    "value_histogram": """
        with e as (select min(value) as lo, max(value) as hi from events),
        b as (select unnest(generate_series(0, 29)) as bin),
        c as (select least(cast(floor((value - lo) * 30 / (hi - lo)) as bigint), 29) as bin, count(*) as n
          from events, e where value is not null group by 1)
        select cast(b.bin as bigint) as bin, round(lo + b.bin * ((hi - lo) / 30), 6) as bin_from,
          round(lo + (b.bin + 1) * ((hi - lo) / 30), 6) as bin_to, coalesce(n, 0) as n
        from b cross join e left join c on c.bin = b.bin""",
    "value_cdf": """
        select value, row_number() over (order by value) as i,
          round(row_number() over (order by value) / cast(count(*) over () as double), 9) as fraction
        from events where value is not null""",
    "scenario_ratio": f"""
        select {_ratio("average")}, {_ratio("p99")}, {_ratio("slowest")} from ({_LINE_SUMMARY}) s""",
    "hot_keys": """
        select l_suppkey, n, round(share, 9) as share from (
          select l_suppkey, count(*) as n, count(*) / cast((select count(*) from lineitem) as double) as share
          from lineitem group by l_suppkey) t where share >= 0.0005""",
    "salted_totals": """
        select l_returnflag, count(*) as n,
          cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price
        from lineitem group by l_returnflag""",
    "salted_distinct": """
        select l_returnflag, count(distinct l_partkey) as distinct_values from lineitem
        group by l_returnflag""",
    "key_slots": f"""
        select c_custkey, cast(s % 16384 as integer) as slot, cast((s % 16384) * 12 // 16384 as integer) as shard,
          cast(g % 16384 as integer) as tag_slot from (
          select c_custkey, {_crc16("c_name")} as s, {_crc16("c_mktsegment")} as g from customer) t""",
    "shard_counts": f"""
        select cast(b.shard as integer) as shard, count(k.shard) as n
        from (select unnest(generate_series(0, 11)) as shard) b
        left join (select (({_crc16("c_name")}) % 16384) * 12 // 16384 as shard from customer) k
          on k.shard = b.shard group by b.shard""",
    "vector_norms": """
        select vec_id, round(l / (l + 1e-9), 6) as length, round(m / (n * n + 1e-9), 6) as mirror from (
          select vec_id, 3 * sqrt(list_dot_product(e, e)) as l, sqrt(list_dot_product(e, e)) as n,
            list_dot_product(e, list_reverse(e)) as m
          from (select vec_id, cast(embedding as double[]) as e from embeddings) x) t""",
    "knn_exact": f"""
        with {_CENTRES}
        select query_id, neighbour_id, round(score, 6) as score, "rank" from ranked where "rank" <= 5""",
    "audience_lookup": f"""
        with {_CENTRES}
        select query_id, neighbour_id, "rank", label,
          concat('persona_', cast(neighbour_id as varchar)) as persona_name
        from ranked join embeddings on vec_id = neighbour_id where "rank" <= 5""",
    "threshold_counters": """
        select case when value > 100 then 'high' else 'low' end as label, count(*) as alerts from events
        where value > 100 or value < 10 group by 1""",
    "gauges": """
        select event_type, count(*) as readings, last(value order by ts, event_id) as last_value
        from events group by event_type""",
    "group_average": """
        select p_brand, round(avg(p_retailprice), 6) as average_value from part group by p_brand""",
    "conversation_tags": f"select conv_id, turn, alerts, suggestions, next_steps from ({_TAGS}) t",
    "running_alerts": f"""
        select conv_id, turn, alerts, cast(sum(k) over w as bigint) as alerts_so_far,
          last_value(suggestions ignore nulls) over w as current_suggestions,
          last_value(next_steps ignore nulls) over w as current_next_steps
        from ({_TAGS}) t window w as (partition by conv_id order by turn
          rows between unbounded preceding and current row)""",
    "alert_log": f"""
        select conv_id, turn, row_number() over (partition by conv_id order by turn, alert) as alert_no, alert
        from (select conv_id, turn, unnest(string_split(alerts, ',')) as alert
          from ({_TAGS}) t where alerts <> '') a""",
    "inventory_profile": f"""
        select TableName as "TableName", "Count", round("Count" / cast(sum("Count") over () as double), 9) as share,
          "Count" = 0 as is_empty from ({_COUNTS}) c""",
    "inventory_summary": f"""
        select count(*) as tables, count(*) filter (where "Count" = 0) as empty_tables,
          cast(sum("Count") as bigint) as total_rows, max("Count") as largest from ({_COUNTS}) c""",
    "ledger_balance": """
        select owner, cast(sum(amount) as double) as balance from (
          select concat('order-', cast(l_orderkey as varchar)) as owner,
            -cast(l_extendedprice as decimal(18,2)) as amount from lineitem
          union all
          select concat('supplier-', cast(l_suppkey as varchar)), cast(l_extendedprice as decimal(18,2))
          from lineitem) m group by owner""",
    "ledger_links": """
        with b as (select o_orderkey as height, o_orderstatus as status, sha256(concat_ws('|',
          cast(o_orderkey as varchar), o_orderstatus, cast(o_custkey as varchar))) as hash from orders),
        c as (select b.height, b.status, coalesce(p.hash, '') as real_prev from b
          left join b p on p.height + 1 = b.height)
        select height, case when status = 'P' then 'tampered' else real_prev end as prev_hash,
          real_prev as expected_prev, status <> 'P' as link_ok from c""",
    "ledger_hashes": """
        select o_orderkey as height, o_orderstatus <> 'P'
          and sha256(concat('{"id":', o_orderkey, ',"status":"', o_orderstatus, '"}')) like '0%' as hash_ok from orders""",
    "load_control": """
        with w as (select timestamp '1998-12-31 23:50:00' as upper, timestamp '1997-12-31 23:50:00' - interval 30 day as lower)
        select 'orders' as "JOB_NAME", any_value(upper) as "LAST_CREATED_TS", count(*) as "LAST_ROWS_READ",
          count(distinct o_orderkey) as "LAST_ROWS_MERGED"
        from orders, w where o_orderdate >= lower and o_orderdate < upper""",
    "created_from_text": """
        select o_orderkey, date_trunc('second', o_orderdate) - interval 2 hour as created from orders""",
    "deleted_by_pattern": """
        select concat_ws(':', p_brand, p_name, p_partkey) as key, p_partkey from part
        where not (p_brand = 'Brand#1' or (length(p_brand) = 8 and starts_with(p_brand, 'Brand#1')) or p_name = 'red widget')""",
    "header_csv": "select * from supplier",
    "inferred_delimited": """
        select p_partkey as key, p_name as name, p_retailprice as price, p_size as extra_3 from part""",
    "connector_copy": "select c_custkey as id, c_nationkey, c_mktsegment from customer",
}
