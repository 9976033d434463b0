"""Inputs derived from the TPC-H-like tables: wide location events, topic records, sessions, ...

Every frame has one row (or more) per row of its table, so work grows with the data.
The column expressions are SQL text both Spark and an ANSI database understand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans import location
from tidemill.session import apply_settings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{folder}/{name}.parquet")


# -- wide location events ------------------------------------------------------

_GIVEN = {
    "ts": "date_trunc('hour', ts)",
    "loadTs": "ts",
    "eDate": "cast(ts as date)",
    "userId": "case when user_id % 10 = 3 then null else user_id end",
    "sourceIp": "user_id * 65537",
    "latitude": "cast(user_id % 90 as decimal(13,8))",
    "longitude": "cast(user_id % 180 as decimal(13,8))",
    "publisherTypeId": "case event_type when 'view' then 1 when 'click' then 2 when 'error' then 5 else 7 end",
    "packageId": "user_id % 3",
    "productId": "user_id % 2",
    "bssid": "case when user_id % 4 = 0 then -1 else user_id * 1000 end",
    "networkTypeId": "user_id % 5",
    "isValidAdvertisingId": "case event_type when 'signup' then null when 'view' then 1 else 1 end",
    "eventTypeId": "case event_type when 'purchase' then 102 else 7 end",
    "country": "case when user_id % 6 = 0 then 'DE' else 'US' end",
    "advertisingId": "concat('ad-', cast(user_id as string))",
}
_MAYBE_MISSING = {"simMCC", "simMNC", "cellMCC", "cellMNC"}
_MAYBE_NO_MAC = {f"bssid{i}" for i in range(1, 6)}


def location_expressions() -> dict[str, str]:
    """SQL text of every input column of the roll-up, from the events table."""
    result = {}
    for i, (name, kind) in enumerate(location.INPUT_TYPES):
        number = f"(event_id * {2 * i + 3} + user_id) % {97 + i}"
        if name in _GIVEN:
            text = _GIVEN[name]
        elif name in _MAYBE_MISSING:
            text = f"case when event_type <> 'click' then -9999 else {number} end"
        elif name in _MAYBE_NO_MAC:
            text = f"case when event_type <> 'click' then -1 else {number} end"
        elif kind == location.TEXT:
            text = f"concat('{name}-', cast({number} as string))"
        elif kind == location.TIME:
            text = "date_trunc('minute', ts)"
        elif kind == location.PLACE:
            text = f"cast({number} as decimal(13,8))"
        else:
            text = number
        result[name] = text
    return result


def location_events(spark: SparkSession, folder: str) -> DataFrame:
    texts = location_expressions()
    columns = [f"cast({texts[name]} as {kind}) as `{name}`" for name, kind in location.INPUT_TYPES]
    return table(spark, folder, "events").selectExpr(*columns)


def listed_users(spark: SparkSession, folder: str) -> DataFrame:
    """Exclusion list: customers in debt; the deepest in debt have lost their number."""
    customer = table(spark, folder, "customer").filter("c_acctbal < 0")
    return customer.select(F.expr("case when c_acctbal >= -900 then c_custkey end").alias("userId"))


# -- topic records -------------------------------------------------------------

RECORD_VALUE = """
    case event_type
      when 'error' then concat('not json: ', props)
      when 'signup' then concat('[{"product_type":"Gadget","n":', cast(event_id as string),
                                '},{"n":', cast(event_id as string), '}]')
      when 'view' then concat('{"product_type":"in/valid","n":', cast(event_id as string), '}')
      when 'click' then props
      else concat('{"product_type":"WIDGET-', cast(user_id % 7 as string), '","n":',
                  cast(event_id as string), '}')
    end"""


def topic_records(events: DataFrame) -> DataFrame:
    """Records of two partitions from events, batch or streaming."""
    return events.selectExpr(
        "'events' as topic",
        "cast(user_id % 2 as int) as partition",
        "event_id as offset",
        "cast(user_id as string) as key",
        f"{RECORD_VALUE} as value",
    )


def mapped_records(events: DataFrame) -> DataFrame:
    """Records of four partitions with two documents each, some of them text where a number belongs.

    Every seventh event's second document has its type's name as ``n``, every eleventh record isn't
    JSON, every thirteenth has a second document of no valid type.
    """
    return events.selectExpr(
        "event_id",
        "cast(user_id % 4 as int) as partition",
        "cast(user_id as string) as key",
        """case when event_id % 11 = 0 then concat('not json: ', event_type) else
             concat('[{"product_type":"event","n":', event_id, '},{"product_type":"',
               if(event_id % 13 = 0, 'in/valid', 'user'), '","n":',
               if(event_id % 7 = 0, concat('"', event_type, '"'), cast(user_id as string)), '}]')
           end as value""",
    )


def repeating_records(events: DataFrame) -> DataFrame:
    """Records whose documents repeat and return to earlier values: two per key."""
    return events.selectExpr(
        "'events' as topic",
        "cast(user_id % 2 as int) as partition",
        "event_id as offset",
        "cast(user_id as string) as key",
        """concat('{"n":', cast(event_id div 3 % 2 as string), ',"product_type":"widget-',
                  cast(user_id % 3 as string), '"}') as value""",
    )


# -- sessions --------------------------------------------------------------------


def raw_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Session rows in text form: one per order, the customer being the session id."""
    return table(spark, folder, "orders").select(
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("CSID"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 5100).alias("ATO_SCORE"),
        F.format_string("['%s', 'status %s']", "o_orderpriority", "o_orderstatus").alias("RISK_FACTORS"),
        F.when(F.col("o_orderstatus") == "F", F.lit("unknown")).otherwise(
            F.format_string('["C%d", "Home"]', F.col("o_custkey") % 25)
        ).alias("COUNTRY"),
        F.format_string("['State %d']", F.col("o_orderkey") % 50).alias("GEO_IP_STATE"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("TOTAL_AMOUNT"),
        F.lit('{"score": 1}').alias("THREAT_INDICATORS"),
        F.col("o_orderdate").cast("string").alias("STARTTIME"),
    )


# -- ledger ----------------------------------------------------------------------


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Each order line as a payment of its customer's order to the supplier."""
    amount = "cast(l_extendedprice as decimal(18,2))"
    return table(spark, folder, "lineitem").selectExpr(
        f"array(named_struct('uuid', concat('order-', cast(l_orderkey as string)), 'amount', {amount})) as inputs",
        f"array(named_struct('uuid', concat('supplier-', cast(l_suppkey as string)), 'amount', {amount})) as outputs",
    )


def block_chain(spark: SparkSession, folder: str) -> DataFrame:
    """One block per order; blocks of status P store a wrong predecessor hash."""
    body = "concat_ws('|', cast({0} as string), o_orderstatus, cast(o_custkey as string))"
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey as height", "o_orderstatus as status",
        f"sha2({body.format('o_orderkey')}, 256) as hash",
    )
    previous = orders.selectExpr("height + 1 as height", "hash as real_prev")
    return orders.join(previous, "height", "left").selectExpr(
        "height", "hash",
        "case when status = 'P' then 'tampered' else coalesce(real_prev, '') end as prev_hash",
    )


# -- text lines --------------------------------------------------------------------


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Tab separated lines: views lack their last field, errors have a bad number or one field more."""
    return table(spark, folder, "events").selectExpr(
        """concat_ws('\\t', cast(event_id as string),
             case when event_type = 'click' then '' else concat('u-', cast(user_id as string)) end,
             concat('10.', cast(user_id % 300 as string), '.0.1'),
             case when event_type = 'error' and user_id % 2 = 0 then 'n/a' else cast(value as string) end,
             case when event_type = 'view' then null else event_type end,
             case when event_type = 'error' and user_id % 2 = 1 then 'surplus' end) as value"""
    )
