"""The catalogue of queries over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from tidemill.functions import clean, json, keys, vector
from tidemill.functions.sql import register_functions
from tidemill.operators import (
    counters,
    dedupe,
    inventory,
    knn,
    ledger,
    predicates,
    risk,
    schema,
    search,
    sketches,
    skew,
    slots,
    stats,
    tags,
)
from tidemill.functions.ledger import record_hash
from tidemill.operators.rollup import Output, rollup
from tidemill.plans import location, stand_in
from tidemill.plans.incremental import IncrementalLoad, LoadSettings
from tidemill.plans.stand_in import table
from tidemill.session import shared_folder, written
from tidemill.sinks import files, keyed
from tidemill.sinks.snapshot import SnapshotTable
from tidemill.sources import delimited, tables, topic_folder
from tidemill.streaming import topic, windows
from tidemill.streaming.change import ChangeSink, changes_only
from tidemill.streaming.metrics import MeasuredSink
from tidemill.streaming.route import MappedSink, RouteSink, UpsertSink, dead_letters, good_documents, parsed

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone and decimals as doubles, for comparing results."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        columns.append(c)
    return df.select(*columns)


# -- roll-ups ------------------------------------------------------------------

_SMALL_ROLLUP = [
    Output("user_id", "key"),
    Output("ts", "max"),
    Output("min_value", "min", "value"),
    Output("event_type", "max"),
    Output("purchases", "count_equal", "event_type", value="purchase"),
    Output("n", "count"),
]


@query
def minute_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollup(table(spark, folder, "events"), _SMALL_ROLLUP, ["user_id"])


LOAD_FROM, LOAD_TO = datetime(2024, 1, 2), datetime(2024, 1, 29)


@query
def location_rollup(spark: SparkSession, folder: str) -> DataFrame:
    events = location.select_events(
        stand_in.location_events(spark, folder), LOAD_FROM, LOAD_TO, [1, 2, 7], ["US"],
        stand_in.listed_users(spark, folder),
    )
    return _naive(location.roll_up(events, 12345).drop("loadTs"))


@query
def reduced_rollup(spark: SparkSession, folder: str) -> DataFrame:
    events = stand_in.location_events(spark, folder).drop("networkTypeId", "cityId", "userAgent")
    events = predicates.filter_existing(
        events,
        {
            "isValidAdvertisingId": predicates.is_valid("isValidAdvertisingId"),
            "publisherTypeId": predicates.one_of("publisherTypeId", [1, 2, 7]),
            "userAgent": predicates.one_of("userAgent", ["never"]),
        },
    )
    return _naive(location.roll_up_reduced(events, 12345).drop("loadTs"))


@query
def rollup_excluding_users(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").filter(
        predicates.one_of("event_type", ["view", "click", "purchase"])
    )
    kept = predicates.exclude_listed(
        events, "user_id", stand_in.listed_users(spark, folder), "userId"
    )
    return rollup(kept, _SMALL_ROLLUP, ["user_id"])


# -- filters, schemas ------------------------------------------------------------


@query
def date_floor(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    recent = orders.filter(predicates.date_floor(orders, "o_orderdate", datetime(2000, 6, 1), 30))
    return recent.select("o_orderkey", "o_orderdate")


@query
def load_window(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    window = predicates.load_window(orders, "o_orderdate", datetime(1996, 1, 1), datetime(1999, 1, 1))
    return orders.filter(window).select("o_orderkey", "o_orderdate")


@query
def incremental_window(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_increment(
        table(spark, folder, "orders"), "o_orderdate", datetime(1996, 1, 1), datetime(1999, 1, 1),
        ["o_orderkey", "o_custkey", "o_orderdate"], "o_orderstatus <> 'P'",
    )


@query
def conformed_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    )
    prefixed = customer.toDF(*[f"customer.{c}" for c in customer.columns])
    mapped = schema.map_column_names(prefixed, {"C_NAME": "customer_name", "c_custkey": "id"})
    target = T.StructType.fromDDL(
        "ID bigint, CUSTOMER_NAME string, C_ACCTBAL double, CHANNEL string, SCORE double, C_NATIONKEY bigint"
    )
    return schema.conform(schema.clear_nans(mapped), target)


@query
def iso_times(spark: SparkSession, folder: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.when(F.col("event_type") == "view", "+02:00").when(F.col("event_type") == "click", "Z")
    events = table(spark, folder, "events").withColumn("text", F.concat(text, F.coalesce(zone, F.lit(""))))
    return events.select("event_id", clean.iso_to_utc(F.col("text")).alias("utc"))


@query
def run_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn(
        "eventTypeId", F.when(F.col("event_type") == "purchase", 102)
    )
    return schema.add_run_columns(events, 7).groupBy("user_id").agg(
        F.sum("numBidRequests").alias("bids"), F.sum("numEvents").alias("events"),
        F.max("biRunId").alias("run"),
    )


# -- keyed loads -----------------------------------------------------------------


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey"], ["l_shipdate"])


_ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)


@query
def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    target = SnapshotTable(spark, shared_folder(spark, "merge"), _ORDERS, ["o_orderkey"], buckets=8)
    target.merge(orders.filter("o_orderdate < timestamp_ntz'2000-01-01'"))
    changes = orders.filter("o_orderdate >= timestamp_ntz'1998-01-01'")
    target.merge(changes.withColumn("o_orderstatus", F.lower("o_orderstatus")))
    return target.read()


@query
def incremental_load_replay(spark: SparkSession, folder: str) -> DataFrame:
    settings = LoadSettings(
        job="orders", keys=["ORDER_ID"], created="o_orderdate", target_created="CREATED",
        target=T.StructType.fromDDL(
            "ORDER_ID decimal(19,0), CUSTOMER_ID decimal(19,0), AMOUNT decimal(18,2),"
            " STATUS string, CREATED timestamp_ntz"
        ),
        columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate"],
        renames={
            "o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "amount",
            "o_orderstatus": "status", "o_orderdate": "created",
        },
        bucket_by="ORDER_ID div 50000",
    )
    load = IncrementalLoad(spark, settings, shared_folder(spark, "load"))
    orders = table(spark, folder, "orders")
    for now in (datetime(1998, 1, 1), datetime(2000, 1, 1), datetime(2000, 1, 1)):
        load.run(orders, now)
    rows = load.target.read()
    return _naive(
        rows.withColumns({c: F.col(c).cast("bigint") for c in ("ORDER_ID", "CUSTOMER_ID")})
    )


@query
def load_control(spark: SparkSession, folder: str) -> DataFrame:
    """The control row after three runs, with what the last one read and merged."""
    settings = LoadSettings(
        job="orders", keys=["ID"], created="o_orderdate", target_created="CREATED",
        target=T.StructType.fromDDL("ID bigint, CREATED timestamp_ntz"),
        columns=["o_orderkey", "o_orderdate"], renames={"o_orderkey": "id", "o_orderdate": "created"},
        lookback_minutes=60 * 24 * 30, buckets=8,
    )
    load = IncrementalLoad(spark, settings, shared_folder(spark, "control"))
    orders = table(spark, folder, "orders")
    for now in (datetime(1997, 1, 1), datetime(1998, 1, 1), datetime(1999, 1, 1)):
        load.run(orders, now)
    return load.target.control().select(
        "JOB_NAME", "LAST_CREATED_TS", "LAST_ROWS_READ", "LAST_ROWS_MERGED"
    )


@query
def created_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """Created times that arrive as ISO text of another zone."""
    text = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    rows = table(spark, folder, "orders").select("o_orderkey", text.alias("created"))
    return schema.normalise_created(rows, "created")


@query
def change_only(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    return dedupe.keep_changes(
        events, ["user_id"], ["ts", "event_id"], F.col("event_type")
    )


@query
def keyed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        F.format_string("part:%07d", "p_partkey").alias("key"), "p_name", "p_retailprice"
    )
    store = SnapshotTable(
        spark, shared_folder(spark, "keyed"), "key string, p_name string, p_retailprice double",
        ["key"], buckets=8,
    )
    store.merge(parts)
    return store.lookup(search.sample_keys(parts, "key", 200, seed=7))


@query
def delete_by_pattern(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(F.concat_ws(":", "p_brand", "p_name").alias("key"))
    return keyed.count_by_glob(parts, "key", ["Brand#1:*", "Brand#1?:*", "*:red widget", "none:*"])


@query
def deleted_by_pattern(spark: SparkSession, folder: str) -> DataFrame:
    """What a keyed table holds after the keys that match a pattern are deleted."""
    parts = table(spark, folder, "part").select(
        F.concat_ws(":", "p_brand", "p_name", "p_partkey").alias("key"), "p_partkey"
    )
    store = SnapshotTable(spark, shared_folder(spark, "globs"), "key string, p_partkey bigint", ["key"], buckets=8)
    store.merge(parts)
    keyed.delete_by_globs(store, "key", ["Brand#1:*", "Brand#1?:*", "*:red widget:*", "none:*"])
    return store.read()


@query
def kept_after_delete(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        "p_partkey", F.concat_ws(":", "p_brand", "p_name").alias("key")
    )
    return keyed.without_globs(parts, "key", ["Brand#1:*", "Brand#1?:*", "*:red widget", "none:*"])


# -- text clean-up -----------------------------------------------------------------


@query
def ipv4_numbers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    text = F.concat_ws(
        ".", (F.col("c_custkey") % 300).cast("string"), F.col("c_nationkey").cast("string"),
        F.lit("0"), (F.col("c_custkey") % 7).cast("string"),
    )
    return customer.select("c_custkey", clean.ipv4_to_long(text).alias("ip"))


@query
def mac_numbers(spark: SparkSession, folder: str) -> DataFrame:
    def octet(shift: int):
        return F.lpad(F.hex(F.shiftright("c_custkey", shift).bitwiseAND(F.lit(255))), 2, "0")

    separator = F.when(F.col("c_nationkey") == 0, "-").otherwise(":")
    text = F.concat(
        F.lit("00:1a:2b"), separator, octet(16), F.lit(":"), octet(8), F.lit(":"), octet(0)
    )
    return table(spark, folder, "customer").select("c_custkey", clean.mac_to_long(text).alias("mac"))


@query
def hashed_users(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("c_nationkey") == 0, "  ").otherwise(F.col("c_name"))
    return table(spark, folder, "customer").select(
        "c_custkey", clean.hashed_user_id(name).alias("user"), clean.hash64(name).alias("hash")
    )


@query
def hashed_user_facts(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("c_nationkey") == 0, "  ").otherwise(F.col("c_name"))
    user = clean.hashed_user_id(name)
    return table(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count(user).alias("users"),
        F.count_if(user.isNull()).alias("blank"),
        F.count_if((user < 0) | (user >= 10**8)).alias("out_of_range"),
        F.countDistinct(clean.hash64(F.col("c_name"))).alias("distinct_hashes"),
    )


@query
def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """The text functions, called by SQL text only."""
    register_functions(spark)
    return spark.sql(
        """
        select c_custkey, ipv4_to_long(address) as ip, mac_to_long(concat('00:1a:2b:00:00:', lpad(hex(c_nationkey), 2, '0'))) as mac,
          hash64(c_name) = xxhash64(c_name) as is_hash, hashed_user_id(c_name) between 0 and 99999999 as in_range,
          cast(money_to_decimal(concat('$', format_number(c_acctbal, 2))) as double) as amount
        from (select *, concat_ws('.', c_custkey % 300, c_nationkey, 0, c_custkey % 7) as address from {customer})
        where ipv4_to_long(address) is not null
        """,
        customer=table(spark, folder, "customer"),
    )


@query
def money_amounts(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("c_nationkey") == 0, "n/a").otherwise(
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2))
    )
    amounts = table(spark, folder, "customer").select(
        "c_custkey", clean.money_to_decimal(text).alias("amount")
    )
    return _naive(amounts)


@query
def int_lists(spark: SparkSession, folder: str) -> DataFrame:
    numbers = clean.int_list(F.concat_ws(",", "l_orderkey", "l_linenumber", "l_partkey"))
    total = F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return (
        table(spark, folder, "lineitem").groupBy("l_suppkey")
        .agg(F.sum(total).alias("total"), F.sum(F.size(numbers)).alias("n"))
    )


_LINE = [
    delimited.RawField("event_id", "bigint"),
    delimited.RawField("user_hash", compute=clean.hash64),
    delimited.RawField("ip", compute=clean.ipv4_to_long),
    delimited.RawField("value", "double"),
    delimited.RawField("event_type"),
    delimited.RawField("note"),
]


@query
def bulk_load(spark: SparkSession, folder: str) -> DataFrame:
    rows = delimited.accepted(
        delimited.parse_lines(stand_in.event_lines(spark, folder), _LINE[:5])
    )
    return rows.withColumn("has_user", F.col("user_hash").isNotNull()).drop("user_hash")


@query
def bulk_load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return delimited.rejected(
        delimited.parse_lines(stand_in.event_lines(spark, folder), _LINE[:5])
    )


@query
def delimited_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    # Names with every text that a delimited file can spoil.
    odd = F.element_at(
        F.array(F.lit(""), F.lit('say "hi"'), F.lit("a\tb"), F.lit("c\nd\\"), F.col("c_name"), F.lit(None)),
        (F.col("c_custkey") % 6 + 1).cast("int"),
    )
    customer = table(spark, folder, "customer").withColumn("c_name", odd)
    path = shared_folder(spark, "delimited")
    delimited.write_delimited(customer, path)
    as_read = delimited.read_written(spark, path, customer.schema)
    return delimited.name_by_position(as_read, ["id", "name", "nation", "balance"])


@query
def delimited_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of text with quotes and backslashes in them, read as they are by a declared schema."""
    lines = table(spark, folder, "events").select(
        F.concat_ws("\t", "event_id", F.concat(F.lit('"'), "event_type", F.lit('\\ "x')), "value").alias("value")
    )
    path = shared_folder(spark, "lines")
    lines.write.text(path)
    kinds = T.StructType.fromDDL("event_id bigint, text string, value double")
    return delimited.read_delimited(spark, path, kinds)


@query
def safe_export(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("note", F.lit(None))
    path = files.safe_export(orders, shared_folder(spark, "export"))
    return spark.read.option("header", True).csv(path)


@query
def header_csv(spark: SparkSession, folder: str) -> DataFrame:
    supplier, path = table(spark, folder, "supplier"), shared_folder(spark, "header")
    files.write_csv(supplier, path)
    return delimited.read_with_header(spark, path, supplier.schema)


@query
def inferred_delimited(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    path = shared_folder(spark, "inferred")
    delimited.write_delimited(lines, path)
    read = delimited.read_delimited_inferred(spark, path)
    return delimited.name_by_position(read, ["key", "name", "price"]).withColumns(
        {"key": F.col("key").cast("bigint"), "extra_3": F.col("extra_3").cast("int")}
    )


@query
def connector_copy(spark: SparkSession, folder: str) -> DataFrame:
    """A table through a connector by its name, renamed on the way; written as JSON and Parquet too."""
    path = shared_folder(spark, "connector")
    nations = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    files.write_connector(nations, "orc", {"c_custkey": "id"}, path=f"{path}/orc")
    copied = tables.read_connector(spark, "orc", path=f"{path}/orc")
    files.write_json(copied, f"{path}/json")
    again = spark.read.schema(copied.schema).json(f"{path}/json")
    files.write_parquet(again, f"{path}/parquet", ["c_mktsegment"])
    return spark.read.parquet(f"{path}/parquet").select("id", "c_nationkey", "c_mktsegment")


@query
def json_rows(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "customer").select("c_custkey", F.struct("c_name", "c_nationkey").alias("who"))
    rows = files.json_rows(nation)
    record = "struct<c_custkey:bigint,who:struct<c_name:string,c_nationkey:int>>"
    return tables.read_json_rows(rows, "value", record).select("c_custkey", "who.*")


# -- topic records -----------------------------------------------------------------


@query
def json_field(spark: SparkSession, folder: str) -> DataFrame:
    value = F.try_parse_json(F.when(F.col("event_type") != "error", F.col("props")))
    return table(spark, folder, "events").select(
        "event_id",
        json.document_type(value, "k").alias("k"),
        json.document_type(value, "absent").alias("absent"),
    )


@query
def typed_messages(spark: SparkSession, folder: str) -> DataFrame:
    value = F.expr("""case event_type
        when 'view' then concat('{"ProductType":"', event_type, ' ', cast(user_id as string), '"}')
        when 'click' then concat('{"ProductType":', cast(user_id as string), '}')
        when 'error' then 'not json' else props end""")
    messages = table(spark, folder, "events").select("event_id", value.alias("value"))
    typed = topic.with_message(messages, lambda v: json.with_constant(json.typed_message(v), "version", 1))
    return typed.select("event_id", "message.*")


@query
def route_documents(spark: SparkSession, folder: str) -> DataFrame:
    records = stand_in.topic_records(table(spark, folder, "events"))
    return good_documents(parsed(records), "prd_").select("offset", "pos", "alias", "doc_id")


@query
def dlq_split(spark: SparkSession, folder: str) -> DataFrame:
    records = stand_in.topic_records(table(spark, folder, "events"))
    letters = dead_letters(parsed(records))
    return letters.select(
        "offset", "key",
        F.get_json_object("value", "$.original_message").alias("original_message"),
        F.get_json_object("value", "$.error").alias("error"),
    )


@query
def documents_by_index(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    kind = F.lower(F.concat_ws("-", "lang", "source"))
    routed = documents.filter(json.is_valid_type(kind)).withColumn(
        "index", keys.index_name("docs_", kind)
    )
    return routed.groupBy("index").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


def _event_stream(spark: SparkSession, folder: str, bytes_per_trigger: int | None = None) -> DataFrame:
    # A pattern, because a stream takes a folder or a pattern but not a single file.
    path = f"{folder}/events*.parquet"
    schema_ = table(spark, folder, "events").schema
    return topic.read_files(spark, path, schema_, bytes_per_trigger=bytes_per_trigger)


@query
def topic_routing(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "routing")
    sink = RouteSink(spark, f"{base}/out", "prd_")
    # Routing does not depend on order, so a large backlog is worked off in batches.
    stream = _event_stream(spark, folder, bytes_per_trigger=256 << 30)
    topic.run_to_end(stand_in.topic_records(stream), f"{base}/progress", sink)
    written = sink.documents().groupBy("alias").agg(F.count(F.lit(1)).alias("n"))
    letters = sink.letters().agg(F.lit("dead letters").alias("alias"), F.count(F.lit(1)).alias("n"))
    return written.unionByName(letters)


@query
def topic_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """All events as a topic, read in batches by offsets; the third batch fails and is run again."""
    base = shared_folder(spark, "topic")
    events = table(spark, folder, "events")
    key = F.col("event_id").cast("string")
    topic_folder.publish(
        events.select((F.col("event_id") % 4).cast("int").alias("partition"), key.alias("key"), F.col("event_type").alias("value"), "event_id"),
        f"{base}/topic", ["event_id"],
    )
    limit = -(-events.count() // 6)
    failed = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("a batch that fails once")

    for _ in range(2):
        stream = topic_folder.read_topic_folder(spark, f"{base}/topic", f"{base}/progress", records=limit)
        try:
            topic_folder.run_batches(stream, f"{base}/progress", write)
        except StreamingQueryException:
            continue
    rows = spark.read.parquet(f"{base}/out")
    batches = rows.agg(F.count_distinct("batch")).scalar()
    return rows.select("partition", "offset", "key", "value", (batches >= 5).alias("five_batches"))


def _published(spark: SparkSession, base: str, records: DataFrame) -> DataFrame:
    """Records (event_id, partition, key, value) as a topic, and its stream in some six batches."""
    topic_folder.publish(records, f"{base}/topic", ["event_id"])
    limit = max(1, -(-records.count() // 6))
    return topic_folder.read_topic_folder(spark, f"{base}/topic", f"{base}/progress", records=limit, topic="events")


@query
def stream_batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of the batches of all events, added up, and whether each is that of the rows written."""
    base = shared_folder(spark, "metrics")
    events = table(spark, folder, "events").selectExpr(
        "event_id", "cast(event_id % 4 as int) as partition", "cast(user_id as string) as key", "event_type as value"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    figures = {"n": F.count(F.lit(1)), "chars": F.sum(F.length("value")), "last": F.max("key")}
    sink = MeasuredSink(spark, write, f"{base}/figures", figures)
    topic_folder.run_batches(_published(spark, base, events), f"{base}/progress", sink)
    out = spark.read.parquet(f"{base}/out").withColumn("batch", F.col("batch").cast("long"))
    true = out.groupBy("batch").agg(*[c.alias(f"true_{n}") for n, c in figures.items()])
    equal = F.lit(True)
    for n in figures:
        equal &= F.col(n).eqNullSafe(F.col(f"true_{n}"))
    return sink.rows().join(true, "batch", "full").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.max("last").alias("last"),
        F.bool_and(equal).alias("equal"), (F.count(F.lit(1)) >= 5).alias("five_batches"),
    )


@query
def item_failures(spark: SparkSession, folder: str) -> DataFrame:
    """All events through a sink that refuses single documents: what it wrote, and its dead letters."""
    base = shared_folder(spark, "items")
    stream = _published(spark, base, stand_in.mapped_records(table(spark, folder, "events")))
    sink = MappedSink(spark, f"{base}/out", "prd_", mapping={"n": "bigint"})
    topic_folder.run_batches(stream, f"{base}/progress", sink)
    documents = sink.documents().select("alias", "partition", "offset", F.col("document").alias("content"))
    error = F.get_json_object("value", "$.error")
    letters = sink.letters().select(
        F.lit("dead letters").alias("alias"), "partition", "offset", error.alias("content")
    )
    return documents.unionByName(letters)


@query
def stream_keyed_state(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose type differs from their user's last one, which the stream keeps as keyed state."""
    base = shared_folder(spark, "state")
    events = table(spark, folder, "events").selectExpr(
        "event_id", "cast(user_id % 4 as int) as partition", "cast(user_id as string) as key", "event_type as value"
    )
    # A key stays in its partition, so that offsets order its records.
    changed = changes_only(_published(spark, base, events), "key", "value", ["partition", "offset"])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    topic_folder.run_batches(changed, f"{base}/progress", write)
    return spark.read.schema(changed.schema).parquet(f"{base}/out").select("partition", "offset", "key", "value")


@query
def topic_upsert(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "upsert")
    sink = UpsertSink(spark, f"{base}/out", "prd_", changes_only=True)
    topic.run_to_end(
        stand_in.repeating_records(_event_stream(spark, folder)), f"{base}/progress", sink
    )
    return sink.documents().select("alias", "doc_id", "offset", "document")


@query
def stream_change_only(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "changes")
    rows = _event_stream(spark, folder).select("event_id", "user_id", "ts", "event_type")
    sink = ChangeSink(spark, f"{base}/out", "user_id", "event_type", ["ts", "event_id"])
    topic.run_to_end(rows, f"{base}/progress", sink)
    return sink.rows(rows.schema)


@query
def stream_minute_rollup(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "rollup")
    kept = predicates.exclude_listed(
        _event_stream(spark, folder), "user_id", stand_in.listed_users(spark, folder), "userId"
    )
    rolled = windows.streaming_rollup(kept, _SMALL_ROLLUP, ["user_id"], emit_minute="minute")
    topic.update_to_end(rolled, f"{base}/out", f"{base}/progress")
    whole = topic.updated(spark, f"{base}/out", rolled.schema, ["user_id", "minute"])
    return _naive(whole.drop("minute"))


@query
def stream_alert_counts(spark: SparkSession, folder: str) -> DataFrame:
    base = shared_folder(spark, "alerts")
    counted = windows.windowed_alerts(
        _event_stream(spark, folder), "ts", "value", "1 hour", "10 minutes", 100.0, 10.0
    )
    topic.update_to_end(counted, f"{base}/out", f"{base}/progress")
    return _naive(topic.updated(spark, f"{base}/out", counted.schema, ["window_start", "label"]))


# -- session risk --------------------------------------------------------------------


def _sessions(spark: SparkSession, folder: str) -> DataFrame:
    return risk.clean_sessions(stand_in.raw_sessions(spark, folder))


@query
def flagged_sessions(spark: SparkSession, folder: str) -> DataFrame:
    flagged = risk.flagged_sessions(_sessions(spark, folder))
    return _naive(flagged).withColumn("score", F.round("score", 6))


@query
def semi_flagged(spark: SparkSession, folder: str) -> DataFrame:
    rows = risk.rows_of_flagged(_sessions(spark, folder))
    return _naive(rows.select("CSID", F.round("ATO_SCORE", 6).alias("score"), "TOTAL_AMOUNT"))


@query
def risk_report(spark: SparkSession, folder: str) -> DataFrame:
    return risk.report_lines(_sessions(spark, folder)).withColumn("amount", F.round("amount", 4))


@query
def risk_sentence(spark: SparkSession, folder: str) -> DataFrame:
    lines = written(risk.report_lines(_sessions(spark, folder)), "risk")
    return risk.report_sections(lines)


@query
def risk_bands(spark: SparkSession, folder: str) -> DataFrame:
    return risk.score_bands(_sessions(spark, folder))


@query
def factor_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return risk.factor_frequency(_sessions(spark, folder))


@query
def session_locations(spark: SparkSession, folder: str) -> DataFrame:
    place = risk.locations(F.col("COUNTRY"), F.col("GEO_IP_STATE"))
    rows = _sessions(spark, folder).select("CSID", place.alias("p"))
    return rows.groupBy(
        F.array_join("p.countries", ",").alias("countries"),
        F.array_join("p.states", ",").alias("states"),
    ).agg(F.count(F.lit(1)).alias("n"))


# -- search and attribution ------------------------------------------------------------


@query
def tag_range_search(spark: SparkSession, folder: str) -> DataFrame:
    hits = search.tag_range_search(
        table(spark, folder, "lineitem"), "l_returnflag", "R", "l_quantity", 45.0,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    )
    return hits.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "matches")


@query
def sorted_table_search(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "search")
    search.write_searchable(table(spark, folder, "part"), path, "p_brand", "p_retailprice")
    return search.tag_range_search(
        spark.read.parquet(path), "p_brand", "Brand#2", "p_retailprice", 950.0, ["p_partkey"], 0, 50
    )


@query
def matches_per_tag(spark: SparkSession, folder: str) -> DataFrame:
    return search.matches_per_tag(table(spark, folder, "events"), "event_type", "value", 100.0)


@query
def prefix_scan(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").withColumn("key", F.concat_ws(":", "p_type", "p_partkey"))
    measure = F.when(F.col("p_size") != 10, F.col("p_retailprice"))
    found = tables.prefix_scan(parts, "key", "ECONOMY:", F.col("p_brand"), "Brand#2", measure, 950.0)
    return found.select("key", "p_retailprice")


@query
def result_page(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return search.page(orders, [F.desc("o_totalprice"), "o_orderkey"], 100, 50)


@query
def attribution_totals(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("campaign", F.get_json_object("props", "$.k"))
    value = F.col("value").cast("decimal(18,2)")
    spend = (F.length("props") * F.lit(2)).cast("decimal(18,2)")
    totals = search.attribution_totals(
        events, ["event_type", "campaign"], value, spend, F.col("value") / 10.0
    )
    return _naive(totals).withColumns(
        {c: F.round(c, 6) for c in ("mean_roas", "return_on_spend")}
    )


# -- statistics --------------------------------------------------------------------------


@query
def latency_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = stats.latency_summary(table(spark, folder, "events"), "value", ["event_type"])
    return summary.withColumn("average", F.round("average", 6))


@query
def latency_summary_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """The sketched summary, with whether its p99 lies within the sketch's rank error."""
    events = table(spark, folder, "events")
    summary = written(stats.latency_summary_approx(events, "value", ["event_type"]), "sketched")
    at = events.join(F.broadcast(summary.select("event_type", "p99")), "event_type").groupBy("event_type").agg(
        F.count_if(F.col("value") <= F.col("p99")).alias("upto"), F.count_if(F.col("value") < F.col("p99")).alias("below"),
    )
    slack = F.col("n") / 10_000 + 1
    within = (F.col("upto") >= 0.99 * F.col("n") - slack) & (F.col("below") <= 0.99 * F.col("n") + slack)
    return summary.join(at, "event_type").select(
        "event_type", "n", "fastest", F.round("average", 6).alias("average"), "slowest", within.alias("p99_within"),
    )


def _monthly_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of events stored by day in two runs that share a day, united by month and type."""
    path = shared_folder(spark, "sketches")
    events = table(spark, folder, "events")
    for window in ("ts < '2024-01-16'", "ts >= '2024-01-15'"):
        days = sketches.window_sketches(events.where(window), "ts", ["event_type"], "value", "user_id")
        sketches.store_days(days, path)
    month = F.date_trunc("month", "day").cast("timestamp_ntz").alias("month")
    return written(sketches.merged(sketches.stored(spark, path), [month, "event_type"]), "months")


def _monthly_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("month", F.date_trunc("month", "ts").cast("timestamp_ntz"))


@query
def stored_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of the quantiles, and the share up to 50, from sketches by day, held against all rows."""
    ranks, slack = (0.5, 0.9, 0.99), 0.01
    months = _monthly_sketches(spark, folder).select(
        "month", "event_type", sketches.count().alias("n"), sketches.share_up_to(50.0).alias("share"),
        F.explode(F.array(*[F.struct(F.lit(r).alias("rank"), sketches.quantile(r).alias("at")) for r in ranks])).alias("q"),
    ).select("*", "q.rank", "q.at").drop("q")
    value = F.col("value")
    held = _monthly_events(spark, folder).join(months, ["month", "event_type"]).groupBy("month", "event_type", "rank").agg(
        F.max("n").alias("n"), F.avg((value <= F.col("at")).cast("int")).alias("upto"),
        F.avg((value < F.col("at")).cast("int")).alias("below"), F.avg((value <= 50).cast("int")).alias("true_share"),
        F.max("share").alias("share"),
    )
    within = (F.col("upto") >= F.col("rank") - slack) & (F.col("below") <= F.col("rank") + slack)
    return held.select(
        "month", "event_type", "rank", "n", within.alias("within"),
        (F.abs(F.col("share") - F.col("true_share")) <= slack).alias("share_within"),
    )


@query
def stored_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Users a month and type from sketches by day, held against the exact number (four standard errors)."""
    months = _monthly_sketches(spark, folder).select("month", "event_type", sketches.distinct().alias("about"))
    exact = _monthly_events(spark, folder).groupBy("month", "event_type").agg(F.countDistinct("user_id").alias("users"))
    off = F.abs(F.col("about") - F.col("users"))
    return exact.join(months, ["month", "event_type"]).select(
        "month", "event_type", "users", (off <= 0.033 * F.col("users") + 1).alias("within"),
    )


@query
def slo_share(spark: SparkSession, folder: str) -> DataFrame:
    share = stats.share_under(F.col("value"), 50.0)
    return table(spark, folder, "events").groupBy("event_type").agg(F.round(share, 6).alias("percent"))


@query
def value_histogram(spark: SparkSession, folder: str) -> DataFrame:
    bins = stats.histogram(table(spark, folder, "events"), "value", 30)
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_from", "bin_to")})


@query
def value_cdf(spark: SparkSession, folder: str) -> DataFrame:
    steps = stats.empirical_cdf(table(spark, folder, "events"), "value")
    return steps.withColumn("fraction", F.round("fraction", 9))


@query
def scenario_ratio(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    summary = stats.latency_summary(lines, "l_extendedprice", ["l_returnflag"])
    ratios = stats.scenario_ratio(summary, "l_returnflag", "A", "R")
    return ratios.select(*[F.round(c, 6).alias(c) for c in ratios.columns])


@query
def hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    shares = skew.key_shares(table(spark, folder, "lineitem"), "l_suppkey", 0.0005)
    return shares.withColumn("share", F.round("share", 9))


@query
def salted_totals(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return _naive(
        skew.salted_totals(
            table(spark, folder, "lineitem"), ["l_returnflag"], {"price": price},
            ["l_orderkey", "l_linenumber"],
        )
    )


@query
def salted_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return skew.salted_distinct(table(spark, folder, "lineitem"), ["l_returnflag"], "l_partkey")


@query
def key_slots(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").withColumn(
        "key", F.concat(F.lit("{"), "c_mktsegment", F.lit("}:"), "c_name")
    )
    plain = slots.with_slots(customer, "c_name", 12)
    return plain.select("c_custkey", "slot", "shard", keys.key_slot(F.col("key")).alias("tag_slot"))


@query
def shard_counts(spark: SparkSession, folder: str) -> DataFrame:
    tagged = table(spark, folder, "customer").select(
        F.concat(F.lit("{"), "c_name", F.lit("}:evt_sample")).alias("key")
    )
    return slots.keys_per_shard(tagged, "key", 12)


# -- similarity -----------------------------------------------------------------------------

DIM = 64


def _audience(spark: SparkSession, folder: str) -> DataFrame:
    """One query vector per label: the mean of its members."""
    members = table(spark, folder, "embeddings")
    return knn.group_centres(members, "label", "embedding", DIM, "query").withColumnRenamed(
        "label", "query_id"
    )


@query
def vector_norms(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("embedding")
    unit = vector.l2_normalise(F.transform(e, lambda x: x * 3))
    return table(spark, folder, "embeddings").select(
        "vec_id", F.round(vector.norm(unit), 6).alias("length"),
        F.round(vector.cosine(e, F.reverse(e)), 6).alias("mirror"),
    )


@query
def knn_exact(spark: SparkSession, folder: str) -> DataFrame:
    found = knn.knn_exact(
        _audience(spark, folder), table(spark, folder, "embeddings"), 5, DIM
    )
    return found.withColumn("score", F.round("score", 6))


@query
def audience_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = knn.knn_exact(_audience(spark, folder), table(spark, folder, "embeddings"), 5, DIM)
    members = table(spark, folder, "embeddings").select(
        "vec_id", "label", F.format_string("persona_%d", "vec_id").alias("persona_name")
    )
    return knn.with_attributes(found.select("query_id", "neighbour_id", "rank"), members)


# A trial query finds itself, so more is asked of it than of others.
TRIAL_RECALL = 0.98


def _index_and_probes(spark: SparkSession, folder: str) -> tuple[knn.CellIndex, int]:
    """Cells of the corpus, and the probes that reach the trial recall against all rows.

    Trial queries are all vectors with ids divisible by 20.
    """
    corpus = table(spark, folder, "embeddings")
    index = knn.build_cells(corpus, None, DIM)
    trials = written(
        knn.usable(corpus, "embedding", DIM).filter("vec_id % 20 = 0")
        .select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")),
        "trials",
    )
    exact = written(knn.knn_exact(trials, corpus, 5, DIM), "trials-exact")
    return index, knn.probes_for_recall(trials, index, exact, 5, TRIAL_RECALL)


def _approximate(spark: SparkSession, folder: str) -> DataFrame:
    """The search both queries are about: label means, which no trial used."""
    index, probes = _index_and_probes(spark, folder)
    return knn.knn_approx(_audience(spark, folder), index, 5, probes)


@query
def knn_approx_rows(spark: SparkSession, folder: str) -> DataFrame:
    """query_id, neighbour_id, score and rank of the approximate search."""
    return _approximate(spark, folder)


@query
def knn_approx(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of the approximate search: every neighbour exists and has its cosine as score."""
    queries, corpus = _audience(spark, folder), table(spark, folder, "embeddings")
    checked = _approximate(spark, folder).join(queries, "query_id").join(
        corpus.select(F.col("vec_id").alias("neighbour_id"), "embedding"), "neighbour_id", "left"
    )
    cosine = vector.cosine(F.col("query"), F.col("embedding"))
    return checked.select(
        "query_id", "rank", F.col("embedding").isNotNull().alias("exists"),
        (F.abs(F.col("score") - cosine) < 1e-6).alias("is_cosine"),
    )


@query
def recall_at_k(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the approximate search reaches the recall on queries that didn't choose its probes."""
    exact = knn.knn_exact(_audience(spark, folder), table(spark, folder, "embeddings"), 5, DIM)
    found = knn.mean_recall(exact, _approximate(spark, folder))
    return found.select((F.col("mean_recall") >= 0.95).alias("reached"))


# -- small jobs -------------------------------------------------------------------------------


@query
def threshold_counters(spark: SparkSession, folder: str) -> DataFrame:
    return counters.alert_counts(table(spark, folder, "events"), "value", 100.0, 10.0)


@query
def gauges(spark: SparkSession, folder: str) -> DataFrame:
    return counters.gauges(table(spark, folder, "events"), "value", ["ts", "event_id"], ["event_type"])


@query
def group_average(spark: SparkSession, folder: str) -> DataFrame:
    means = counters.group_average(table(spark, folder, "part"), "p_brand", "p_retailprice")
    return means.withColumn("average_value", F.round("average_value", 6))


ALERTS = [tags.AlertRule(("that", "this"), "A"), tags.AlertRule(("from",), "B")]
SUGGESTIONS = [
    tags.SuggestionRule("with", ("s1", "s2"), ("n1", "n2")),
    tags.SuggestionRule("the", ("s3",)),
]


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return tags.tag_turns(turns, "text", ALERTS, SUGGESTIONS).drop("text")


def _joined(df: DataFrame) -> DataFrame:
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: F.array_join(c, ",") for c in arrays})


@query
def conversation_tags(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(_tagged(spark, folder))


@query
def running_alerts(spark: SparkSession, folder: str) -> DataFrame:
    state = tags.running_state(_tagged(spark, folder), "conv_id", "turn")
    return _joined(state.drop("suggestions", "next_steps"))


@query
def alert_log(spark: SparkSession, folder: str) -> DataFrame:
    state = tags.running_state(_tagged(spark, folder), "conv_id", "turn")
    return tags.alert_log(state, "conv_id", "turn")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.count_tables({name: table(spark, folder, name) for name in TABLES})


@query
def inventory_profile(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.profile(_inventory(spark, folder)).withColumn("share", F.round("share", 9))


@query
def inventory_summary(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.summary(_inventory(spark, folder))


@query
def ledger_balance(spark: SparkSession, folder: str) -> DataFrame:
    return _naive(ledger.balances(stand_in.transactions(spark, folder)))


@query
def ledger_links(spark: SparkSession, folder: str) -> DataFrame:
    audited = ledger.link_audit(stand_in.block_chain(spark, folder), "height", "hash", "prev_hash")
    return audited.select("height", "prev_hash", "expected_prev", "link_ok")


@query
def ledger_hashes(spark: SparkSession, folder: str) -> DataFrame:
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    blocks = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("height"), record_hash(record).alias("computed"),
        F.when(F.col("o_orderstatus") == "P", "x").otherwise("").alias("change"),
    ).withColumn("stored", F.concat("computed", "change"))
    audited = ledger.hash_audit(blocks, F.col("stored"), F.col("computed"), F.lit(1))
    return audited.select("height", "hash_ok")
