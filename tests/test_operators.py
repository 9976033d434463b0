import gzip
import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators import counters, dedupe, inventory, ledger, predicates, risk, schema, search
from tidemill.operators import skew, slots, stats, tags
from tidemill.operators.rollup import Output, reduced_rollup, rollup
from tidemill.plans import location
from tidemill.sources import delimited, tables


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- roll-up ---------------------------------------------------------------------


def events(spark, rows):
    base = {n: None for n, _ in location.INPUT_TYPES}
    schema_ = location.input_schema()
    return spark.createDataFrame([tuple({**base, **r}[n] for n in schema_.names) for r in rows], schema_)


T0 = datetime(2025, 9, 8, 10, 0, 1)
GOOD = dict(ts=T0, loadTs=datetime(2025, 9, 8, 12), eDate=date(2025, 9, 8), publisherTypeId=1,
            isValidAdvertisingId=1, country="US", userId=5, bssid=-1, eventTypeId=102)


def select(spark, rows, **kw):
    return location.select_events(
        events(spark, rows), datetime(2025, 9, 8), datetime(2025, 9, 8, 12), [1, 2, 7],
        **{"countries": ["US"], **kw})


def test_full_rollup(spark):
    rows = [
        {**GOOD, "simMCC": -9999, "cellMCC": -9999, "osId": 3, "signalLevel2": 4, "bssid1": -1, "sessionId": 8},
        {**GOOD, "ts": T0.replace(second=59), "simMCC": -9999, "cellMCC": 310, "osId": 2, "eventTypeId": 7,
         "signalLevel2": 2, "signalLevel3": 9, "bssid1": 77, "sessionId": 9},
        {**GOOD, "ts": T0.replace(minute=1)},
    ]
    out = location.roll_up(select(spark, rows), 42)
    assert out.columns == location.target_schema().names and len(out.columns) == 182
    conformed = schema.conform(out, location.target_schema()).dtypes
    assert conformed == [(f.name, f.dataType.simpleString()) for f in location.target_schema()]
    first, second = out.orderBy("ts").collect()
    assert (first.numEvents, first.numBidRequests, first.biRunId) == (2, 1, 42)
    assert first.ts == T0.replace(second=59) and first.osId == 2 and first.sessionId == 9
    assert (first.simMCC, first.cellMCC, first.bssid, first.bssid1) == (None, 310, None, 77)
    assert (first.signalLevel2, first.signalLevel3) == (2, 9)
    assert (second.numEvents, second.numBidRequests) == (1, 1)


def test_rollup_has_one_exchange_and_no_python(spark):
    text = executed(location.roll_up(select(spark, [GOOD]), 1))
    assert text.count("Exchange hashpartitioning") == 1 and "Python" not in text


def test_event_selection(spark):
    rows = [
        GOOD,
        {**GOOD, "loadTs": datetime(2025, 9, 8)},  # exactly at "from": out
        {**GOOD, "eDate": date(2025, 8, 9)},  # exactly at the floor: in
        {**GOOD, "eDate": date(2025, 8, 8)},
        {**GOOD, "isValidAdvertisingId": 0}, {**GOOD, "isValidAdvertisingId": None},
        {**GOOD, "publisherTypeId": 3}, {**GOOD, "country": "DE"},
        {**GOOD, "userId": 9}, {**GOOD, "userId": None},
    ]
    listed = spark.createDataFrame([(9,), (None,)], "userId bigint")
    with_zero = spark.createDataFrame([(9,), (0,)], "userId bigint")
    assert select(spark, rows, excluded_users=listed).count() == 3
    assert select(spark, rows, excluded_users=with_zero).count() == 2
    assert select(spark, rows, excluded_users=listed, countries=[]).count() == 4


def test_reduced_rollup_uses_what_exists(spark):
    df = spark.createDataFrame([(1, T0, 102), (1, T0, 7), (2, T0, 7)], "userId bigint, ts timestamp, eventTypeId int")
    out = location.roll_up_reduced(df, 1)
    assert {(r.userId, r.numEvents, r.numBidRequests) for r in out.collect()} == {(1, 2, 1), (2, 1, 0)}
    assert dict(out.dtypes)["ssid"] == "string" and dict(out.dtypes)["simMCC"] == "bigint"
    total = reduced_rollup(df.drop("userId"), [Output("n", "count")], ["userId"]).collect()
    assert [tuple(r) for r in total] == [(3,)]


def test_bulk_line_to_rollup(spark, folder):
    names = [f.name for f in location.bulk_fields()]
    assert len(names) == len(set(names)) and set(names) - {"_line_load_ts", "releaseVersionId"} <= set(
        dict(location.OUTPUT_TYPES))
    values = dict(ts="2025-09-08 10:00:01", sessionId="s", userId="u", sourceIp="1.2.3.4", country="US",
                  eDate="2025-09-08", publisherTypeId="1", isValidAdvertisingId="1", eventTypeId="102",
                  bssid="00:1A:2b:3c:4d:5e", bssid1="nothing", simMCC="-9999", _line_load_ts="2000-01-01")
    line = "\t".join(values.get(n, "") for n in names)
    with gzip.open(f"{folder}/a.gz", "wt") as f:
        f.write(line + "\n" + line.replace("10:00:01", "10:00:59") + "\n" + line.replace("2025-09-08\t", "bad\t", 1) + "\n")
    rows, rejects = delimited.bulk_load(spark, folder, location.bulk_fields())
    assert [r.reject_reason for r in rejects.collect()] == ["bad eDate"]
    now = datetime.now()
    chosen = location.select_events(
        location.staged(rows.drop("_line_load_ts")), datetime(2025, 9, 10), datetime(now.year + 1, 1, 1), [1], ["US"])
    location.write_by_day(location.roll_up(chosen, 3), f"{folder}/out")
    row = spark.read.parquet(f"{folder}/out").first()
    assert (row.numEvents, row.numBidRequests, row.sourceIp, row.bssid) == (2, 2, 16909060, 112394521950)
    assert row.bssid1 is None and row.simMCC is None and row.userId is not None and str(row.eDate) == "2025-09-08"


def test_exports_are_staged(spark):
    export = spark.createDataFrame([], location.EXPORT_SCHEMA)
    assert len(export.columns) == 78 == len(location.POSITIONAL_NAMES)
    assert location.staged(export).schema.names == location.input_schema().names
    df = spark.createDataFrame([("9", "10.5", "x")], "simMNC string, localTZoneId string, bssid1 string")
    row = location.staged(df).first()
    assert (row.simMNC, row.bssid1, row.productId) == (9, None, None)
    location.roll_up(location.staged(export), 1).collect()


def test_clean_identity(spark):
    row = location.clean_identity(
        spark.createDataFrame([("a", "1.2.3.4"), (" ", "x")], "advertisingId string, sourceIp string")
    ).collect()
    assert row[0].sourceIp == 16909060 and 0 <= row[0].userId < 10**8
    assert row[1].sourceIp is None and row[1].userId is None


# -- schema and predicates ----------------------------------------------------------


def test_names():
    assert schema.check_table_name("a.b") == "a.b"
    for bad in ("a.b.c", "a b", "1a", ""):
        with pytest.raises(schema.DataValidationError):
            schema.check_table_name(bad)


def test_conform_and_void(spark):
    df = spark.sql("select 1 as A, null as v")
    out = schema.conform(df, T.StructType.fromDDL("v bigint, a string, missing decimal(5,2)"))
    assert out.dtypes == [("v", "bigint"), ("a", "string"), ("missing", "decimal(5,2)")]
    assert dict(schema.fill_void(df).dtypes)["v"] == "string"


def test_run_columns_and_preflight(spark):
    df = spark.createDataFrame([(102,), (None,)], "eventTypeId int")
    rows = schema.add_run_columns(df, 7).collect()
    assert [(r.numBidRequests, r.numEvents, r.biRunId) for r in rows] == [(1, 1, 7), (0, 1, 7)]
    df.createOrReplaceTempView("preflight_view")
    schema.preflight(spark, "preflight_view", ["EVENTTYPEID"])
    with pytest.raises(schema.DataValidationError, match="missing columns"):
        schema.preflight(spark, "preflight_view", ["x"])
    with pytest.raises(schema.DataValidationError, match="not found"):
        schema.preflight(spark, "no_such_table", ["x"])


def test_filter_existing_and_lists(spark):
    df = spark.range(5)
    kept = predicates.filter_existing(df, {"ID": F.col("id") > 2, "other": F.col("other") == 1})
    assert kept.count() == 2
    assert df.filter(predicates.one_of("id", None)).count() == 5


def test_time_filters_are_pushed(spark, folder):
    df = spark.sql("select timestamp_ntz'2026-01-01' as t, 1 as v")
    df.write.parquet(f"{folder}/t")
    read = spark.read.parquet(f"{folder}/t")
    window = predicates.load_window(read, "t", datetime(2025, 12, 31), datetime(2026, 1, 1))
    out = read.filter(window).select("v")
    text = plan(out)
    assert "GreaterThan(t," in text and "LessThanOrEqual(t," in text and out.count() == 1


def test_heavy_keys_of_filter_joins_are_split(spark, folder):
    spark.range(0, 600_000, 1, 8).selectExpr(
        "id", "case when id % 3 = 0 then null else id end as k", "cast(xxhash64(id) as string) as pad"
    ).write.parquet(f"{folder}/rows")
    listed = spark.range(0, 2000).selectExpr("id * 2 + 1 as u")
    split = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in split}
    try:
        for k, v in split.items():
            spark.conf.set(k, v)
        kept = predicates.exclude_listed(spark.read.parquet(f"{folder}/rows"), "k", listed, "u")
        total = kept.agg(F.count("pad").alias("n"), F.max("pad"))
        gone = sum(1 for u in range(1, 4000, 2) if u % 3)
        assert total.collect()[0].n == 600_000 - gone
        final = executed(total).split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# -- change-only -----------------------------------------------------------------------


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k", "l", None]), st.sampled_from(["A", "B", None])), min_size=1, max_size=40),
       st.integers(1, 9))
def test_keep_changes_equals_loop(spark, rows, width):
    last, expected = {}, []
    for i, (k, v) in enumerate(rows):
        if k not in last or last[k] != v:
            expected.append(i)
        last[k] = v
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "o int, k string, v string")
    got = dedupe.keep_changes(df, ["k"], ["o"], F.col("v"), F.floor(F.col("o") / width), least_rows=0)
    assert sorted(r.o for r in got.collect()) == expected


def test_keep_changes_shuffles_rows_once(spark, folder):
    spark.range(1000).selectExpr("id as o", "id % 7 as k", "id % 2 as v").write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    out = dedupe.keep_changes(df, ["k"], ["o"], F.col("v"), F.floor(F.col("o") / 10), least_rows=0)
    text = executed(out).split("== Initial Plan ==")[0]
    # the rows; the key counts; the summaries by piece and by key
    assert text.count("Exchange hashpartitioning") <= 5 and "SortMergeJoin" not in text
    assert out.count() == 1000


# -- statistics ---------------------------------------------------------------------------


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=250))
def test_ranks_equal_sorted_list(spark, values):
    df = spark.createDataFrame([(float(v), "g") for v in values], "v double, g string")
    ordered = sorted(values)
    p99 = stats.value_at_rank(df, "v", 0.99).first().at_rank
    assert p99 == ordered[int(len(ordered) * 0.99)]
    steps = stats.empirical_cdf(df, "v", block=7).orderBy("i").collect()
    assert [(r.v, r.i) for r in steps] == [(v, i + 1) for i, v in enumerate(ordered)]
    assert math.isclose(steps[-1].fraction, 1.0)


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,1)"])
def test_ranks_keep_the_columns_type(spark, kind):
    big = [2**53 + i for i in range(9)]
    df = spark.createDataFrame([(v,) for v in big], "v bigint").selectExpr(f"cast(v as {kind}) as v")
    assert stats.value_at_rank(df, "v", 0.5).first().at_rank == big[4]
    assert [int(r.v) for r in stats.empirical_cdf(df, "v").orderBy("i").collect()] == big


@pytest.mark.parametrize("n", [1, 100, 200])
def test_p99_rank(spark, n):
    df = spark.range(n).selectExpr("cast(id as double) as v", "'a' as g")
    row = stats.latency_summary(df, "v", ["g"]).first()
    assert (row.n, row.fastest, row.slowest) == (n, 0.0, n - 1.0)
    assert row.p99 == min(n - 1, int(n * 0.99))
    approx = stats.latency_summary_approx(df, "v", ["g"]).first()
    assert abs(approx.p99 - row.p99) <= 1


def test_summary_of_one_heavy_group(spark):
    df = spark.range(3000).selectExpr(
        "case when id < 2000 then 'hot' else cast(id % 3 as string) end as g", "cast(id % 1000 as double) as v")
    rows = {r.g: r for r in stats.latency_summary(df, "v", ["g"]).collect()}
    assert rows["hot"].n == 2000 and rows["hot"].p99 == 990.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.5,), (10.0,), (None,)], "v double")
    rows = stats.histogram(df, "v", 4).orderBy("bin").collect()
    assert [(r.bin_from, r.bin_to, r.n) for r in rows] == [
        (0.0, 2.5, 2), (2.5, 5.0, 1), (5.0, 7.5, 0), (7.5, 10.0, 1)]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in stats.histogram(same, "v", 3).orderBy("bin").collect()] == [2, 0, 0]
    assert (stats.recall_bins(2), stats.recall_bins(9)) == (5, 9)


def test_share_and_ratio(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (None,)], "v double")
    assert df.agg(stats.share_under(F.col("v"), 1.0)).first()[0] == pytest.approx(100 / 3)
    got = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double").select(
        stats.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r.r for r in got] == pytest.approx([1000.0, 2.0])
    summary = spark.createDataFrame(
        [("hot", 4.0, 8.0, 9.0), ("tag", 2.0, 0.0, 3.0)], "s string, average double, p99 double, slowest double")
    assert tuple(stats.scenario_ratio(summary, "s", "hot", "tag").first()) == pytest.approx((2.0, 8000.0, 3.0))


# -- skew, slots, search ---------------------------------------------------------------------


def test_skew(spark):
    df = spark.range(100).selectExpr("case when id < 40 then 'hot' else cast(id as string) end as k", "id")
    assert [(r.k, r.n, r.share) for r in skew.key_shares(df, "k", 0.3).collect()] == [("hot", 40, 0.4)]
    totals = {r.k: (r.n, r.s) for r in skew.salted_totals(df, ["k"], {"s": F.col("id")}, ["id"], 4).collect()}
    assert totals["hot"] == (40, sum(range(40))) and len(totals) == 61
    distinct = {r.k: r.distinct_values for r in skew.salted_distinct(df, ["k"], "id").collect()}
    assert distinct["hot"] == 40


def test_shards_include_empty_ones(spark):
    df = spark.createDataFrame([("brand_id:123",), ("{brand_id:123}:evt_1",)], "key string")
    rows = {r.shard: r.n for r in slots.keys_per_shard(df, "key", 12).collect()}
    assert len(rows) == 12 and sum(rows.values()) == 2 and rows[14256 * 12 // 16384] == 2


def test_search(spark):
    df = spark.createDataFrame(
        [(i, "fb" if i % 2 else "go", None if i == 9 else i / 2) for i in range(20)], "id int, p string, roas double")
    hits = search.tag_range_search(df, "p", "fb", "roas", 4.5, ["id"], size=3).collect()
    assert [(r.id, r.matches) for r in hits] == [(11, 5), (13, 5), (15, 5)]
    at = search.tag_range_search(df, "p", "fb", "roas", 5.5, ["id"]).count()
    assert at == 5  # 11/2 is on the floor and counts
    assert [r.id for r in search.page(df, ["id"], 4, 2).collect()] == [4, 5]
    assert {r.p: r.matches for r in search.matches_per_tag(df, "p", "roas", 100).collect()} == {"fb": 0, "go": 0}
    sample = [r.id for r in search.sample_keys(df, "id", 5, 3).collect()]
    assert len(set(sample)) == 5 == len(sample)
    assert sample == [r.id for r in search.sample_keys(df.repartition(7), "id", 5, 3).collect()]
    assert search.sample_keys(df, "id", 200).count() == 20
    found = tables.prefix_scan(df.withColumn("k", F.concat(F.lit("c:"), "id")), "k", "c:1", F.col("p"), "fb", F.col("roas"), 0.0)
    assert sorted(r.id for r in found.collect()) == [1, 11, 13, 15, 17, 19]
    assert tables.prefix_scan(df.withColumn("k", F.lit("c:")), "k", "c:", F.col("p"), "fb", F.col("roas"), 0.0).count() == 10


def test_searchable_table_prunes(spark, folder):
    df = spark.range(5000).selectExpr("id", "case when id % 3 = 0 then 'hot' else concat('t', id % 9) end as tag",
                                      "cast(id % 1000 as double) as roas")
    search.write_searchable(df, folder, "tag", "roas")
    read = spark.read.parquet(folder)
    hits = search.tag_range_search(read, "tag", "hot", "roas", 990.0, ["id"])
    assert hits.count() == df.filter("tag = 'hot' and roas >= 990").count() == hits.first().matches
    assert "EqualTo(tag,hot)" in plan(read.filter("tag = 'hot' and roas >= 990"))


def test_attribution(spark):
    df = spark.createDataFrame([("a", 10.0, 0.0), ("a", 20.0, 0.0), ("b", 6.0, 3.0)], "p string, r double, s double")
    rows = {r.p: r for r in search.attribution_totals(df, ["p"], F.col("r"), F.col("s"), F.col("r") / 2).collect()}
    assert (rows["a"].revenue, rows["a"].return_on_spend, rows["a"].mean_roas) == (30.0, None, 7.5)
    assert rows["b"].return_on_spend == 2.0


# -- risk ------------------------------------------------------------------------------------


def sessions(spark):
    raw = spark.createDataFrame(
        [
            ("s1", 90.0, "['VPN', 'Bot']", "['US', 'us']", "['CA']", "$1,234.50", '{"a":1}', "2026-01-01"),
            ("s1", 10.0, "['VPN']", "nonsense", None, "100", "{}", "2026-01-02"),
            ("s2", 80.0, "['Clean']", "['FR']", "['P']", "abc", "{}", "2026-01-02"),
            ("s3", 80.1, None, '["De"]', "[]", "5", None, "2026-01-02"),
            ("s4", None, "['VPN']", "['XX']", "['X']", "7", "{}", "2026-01-02"),
            ("s5", 50.0, "[]", "['XX']", "['X']", "7", "{}", "2026-01-02"),
            ("s6", 50.5, "[]", "['XX']", "['X']", "7", "{}", "2026-01-02"),
        ],
        "CSID string, ATO_SCORE double, RISK_FACTORS string, COUNTRY string, GEO_IP_STATE string,"
        " TOTAL_AMOUNT string, THREAT_INDICATORS string, STARTTIME string")
    return risk.clean_sessions(raw)


def test_risk(spark):
    df = sessions(spark).cache()
    flagged = {r.CSID: float(r.amount) for r in risk.flagged_sessions(df).collect()}
    assert flagged == {"s1": 1334.5, "s3": 5.0}
    assert risk.rows_of_flagged(df).count() == 3
    assert tuple(risk.score_bands(df).first()) == (2, 2, 2)
    assert {r.factor: r.n for r in risk.factor_frequency(df).collect()} == {"VPN": 3, "Bot": 1, "Clean": 1}
    elements = {(r.kind, r.element) for r in risk.flagged_elements(df).collect()}
    assert elements == {("country", "us"), ("country", "de"), ("state", "ca"), ("factor", "VPN"), ("factor", "Bot")}
    assert {r.CSID for r in risk.critical_ids(df, 3).collect()} == {"s1", "s2", "s3"}
    assert {r.CSID for r in risk.critical_ids(df).collect()} == {"s1", "s2", "s3", "s5", "s6"}
    lines = risk.report_lines(df)
    report = {(r.section, r.block): (r.n_items, r["items"], r.amount) for r in risk.report_sections(lines).collect()}
    assert report["flagged", 0] == (1, "2", 1339.5) and report["critical", 0][1] == "s1, s2, s3, s5, s6"
    assert report["factor", 0][:2] == (2, "Bot, VPN") and report["country", 0][:2] == (2, "de, us")
    assert report["state", 0][:2] == (1, "ca")
    # More items than a block holds go on in the next one, and none is left out.
    blocks = [r for r in risk.report_sections(lines, 1).collect() if r.section == "factor"]
    assert sorted((r.block, r["items"]) for r in blocks) == [(0, "Bot"), (1, "VPN")]
    many = spark.range(250).select(F.lit("state").alias("section"), F.format_string("s%03d", "id").alias("item"), F.lit(None).cast("double").alias("amount"))
    assert [r.n_items for r in risk.report_sections(many).orderBy("block").collect()] == [100, 100, 50]
    place = df.select(risk.locations(F.col("COUNTRY"), F.col("GEO_IP_STATE")).alias("p")).collect()
    assert tuple(place[1].p) == ([], [])
    df.unpersist()


def test_nobody_flagged(spark):
    lines = risk.report_lines(sessions(spark).filter("ATO_SCORE < 5")).collect()
    assert [tuple(r) for r in lines] == [("flagged", "0", 0.0)]


# -- tags ------------------------------------------------------------------------------------


ALERTS = [
    tags.AlertRule(("medical", "injury"), "health: ask for consent"),
    tags.AlertRule(("lawsuit", "attorney"), "law: call the lead"),
]
SUGGESTIONS = [
    tags.SuggestionRule("claim", ("open a case", "look a case up"), ("ask when", "ask where")),
    tags.SuggestionRule("coverage", ("read out the policy",)),
]


def test_tags_and_running_state(spark):
    turns = spark.createDataFrame(
        [(1, 0, "I need to file a CLAIM about coverage"), (1, 1, "no idea"), (1, 2, "Medical lawsuit, an attorney"),
         (1, 3, "my coverage"), (1, 4, "an injury"), (2, 0, None)], "call int, turn int, text string")
    tagged = tags.tag_turns(turns, "text", ALERTS, SUGGESTIONS)
    state = tags.running_state(tagged, "call", "turn", turns_per_piece=2, least_rows=0)
    rows = {(r.call, r.turn): r for r in state.collect()}
    claim, coverage = (list(r.suggestions) for r in SUGGESTIONS)
    steps = list(SUGGESTIONS[0].next_steps)
    assert [rows[1, t].alerts_so_far for t in range(5)] == [0, 0, 2, 2, 3]
    assert [rows[1, t].current_suggestions for t in range(5)] == [claim, claim, claim, coverage, coverage]
    assert [rows[1, t].current_next_steps for t in range(5)] == [steps] * 5
    assert rows[2, 0].current_suggestions is None and rows[2, 0].alerts == []
    log = sorted((r.alert_no, r.alert.split()[0]) for r in tags.alert_log(state, "call", "turn").collect())
    assert log == [(1, "health:"), (2, "law:"), (3, "health:")]


# -- ledger, inventory, counters -----------------------------------------------------------------


def test_ledger(spark):
    record = spark.sql(
        "select array(named_struct('uuid','a','amount',cast(5 as decimal(18,2)))) inputs,"
        " array(named_struct('uuid','b','amount',cast(3 as decimal(18,2))),"
        "       named_struct('uuid','a','amount',cast(2 as decimal(18,2)))) outputs")
    got = {r.owner: float(r.balance) for r in ledger.balances(record.unionAll(record)).collect()}
    assert got == {"a": -6.0, "b": 6.0}
    mint = spark.sql("select cast(array() as array<struct<uuid:string,amount:decimal(18,2)>>) inputs,"
                     " array(named_struct('uuid','n','amount',cast(1 as decimal(18,2)))) outputs")
    assert [tuple(r) for r in ledger.balances(mint).collect()] == [("n", 1)]
    blocks = spark.createDataFrame(
        [(1, "h1", ""), (2, "h2", "h1"), (3, "h3", "bad"), (5, "h5", "h3")], "height long, hash string, prev string")
    ok = {r.height: r.link_ok for r in ledger.link_audit(blocks, "height", "hash", "prev").collect()}
    assert ok == {1: True, 2: True, 3: False, 5: False}
    text = spark.createDataFrame(
        [('{"header":{"prev_hash":"","difficulty":1},"body":{"txns":[{"inputs":[],"outputs":[{"uuid":"n","amount":1}],"timestamp":1.5}]}}',)],
        "value string")
    parsed = tables.read_json_rows(text, "value", ledger.BLOCK_SCHEMA)
    assert ledger.balances(ledger.transactions(parsed)).first().owner == "n"


def test_inventory(spark):
    df = spark.createDataFrame([(0, "a"), (30, "b"), (10, "c")], inventory.INVENTORY_SCHEMA)
    assert tuple(inventory.summary(df).first()) == (3, 1, 40, 30)
    assert {r.TableName: r.share for r in inventory.profile(df).collect()} == {"a": 0.0, "b": 0.75, "c": 0.25}
    assert [r.TableName for r in inventory.largest(df, 2).collect()] == ["b", "c"]


def test_counters(spark):
    df = spark.createDataFrame([(1, 28.0), (2, 28.1), (3, 22.0), (4, 21.9), (5, None)], "t int, v double")
    assert {r.label: r.alerts for r in counters.alert_counts(df, "v").collect()} == {"high": 1, "low": 1}
    assert tuple(counters.gauges(df.filter("t < 5"), "v", ["t"]).first()) == (4, 21.9)
    mean = counters.group_average(spark.createDataFrame([("A", 1), ("A", 2)], "g string, v int"), "g", "v")
    assert [tuple(r) for r in mean.collect()] == [("A", 1.5)]


def test_simple_rollup_keys_appear_once(spark):
    df = spark.createDataFrame([(1, T0)], "k int, ts timestamp")
    out = rollup(df, [Output("k", "key"), Output("ts", "max")], ["k"])
    assert out.columns == ["k", "ts"] and out.select("k").first().k == 1


def test_a_key_is_cut_into_as_many_pieces_as_it_fills(spark):
    from tidemill.operators.prefix import _cuts

    rows = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    heavy = spark.createDataFrame([("hot", 200)], "_heavy_k string, _pieces int")
    cuts = _cuts(rows, ["k"], "at", heavy).first()["_cuts"]
    assert len(cuts) == 199 and max(b - a for a, b in zip(cuts, cuts[1:])) < 200
