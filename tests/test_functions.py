import binascii

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import clean, json, keys, ledger, vector


def column(spark, values, type_="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")


def evaluate(spark, values, make, type_="string"):
    rows = column(spark, values, type_).select("i", make(F.col("x")).alias("y")).orderBy("i")
    return [row.y for row in rows.collect()]


def test_ipv4(spark):
    given_ = ["1.2.3.4", "255.255.255.255", "0.0.0.0", "01.002.3.4",
              "999.1.1.1", "1.2.3", "1.2.3.4.5", "256.1.1.1", "x", "", None]
    assert evaluate(spark, given_, clean.ipv4_to_long) == [
        16909060, 4294967295, 0, 16909060, None, None, None, None, None, None, None]


def test_mac(spark):
    given_ = ["00:1A:2b:3c:4d:5e", "00-1A-2b-3c-4d-5e", "00:1A-2b:3c:4d:5e",
              "001A2b3c4d5e", None, "ff:ff:ff:ff:ff:ff"]
    assert evaluate(spark, given_, clean.mac_to_long) == [
        112394521950, 112394521950, -1, -1, -1, 281474976710655]


def test_hashed_user_id(spark):
    got = evaluate(spark, ["abc", "", "   ", None], clean.hashed_user_id)
    signed = xxhash.xxh64_intdigest(b"abc", seed=42)
    signed -= 2**64 if signed >= 2**63 else 0
    assert got == [abs(signed) % 10**8, None, None, None]
    assert evaluate(spark, ["abc", None], clean.hash64) == [signed, None]


def test_money_and_lists(spark):
    got = evaluate(spark, ["$1,234.50", "abc", "12", None], clean.money_to_decimal)
    assert [None if v is None else float(v) for v in got] == [1234.5, None, 12.0, None]
    lists = ["['a', 'b']", '["a", "it\'s"]', "[]", "nonsense", None, "['a', None]"]
    assert evaluate(spark, lists, clean.list_literal_to_array) == [
        ["a", "b"], ["a", "it's"], [], None, None, ["a", None]]


def test_int_list(spark):
    assert evaluate(spark, ["1,3,5,9", "7"], clean.int_list) == [[1, 3, 5, 9], [7]]
    for bad in ("bad input", "1-3,12-15"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            evaluate(spark, [bad], clean.int_list)


def test_iso_to_utc(spark):
    got = evaluate(
        spark,
        ["2026-05-03T10:15:30Z", "2026-05-03T10:15:30", "2026-05-03T12:15:30+02:00"],
        clean.iso_to_utc,
    )
    assert {str(v) for v in got} == {"2026-05-03 10:15:30"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        evaluate(spark, ["yesterday"], clean.iso_to_utc)


def test_nan_and_sentinel(spark):
    assert evaluate(spark, [1.0, float("nan"), None], clean.nan_to_null, "double") == [
        1.0, None, None]
    assert evaluate(spark, [-9999, 310, None], lambda c: clean.sentinel_to_null(c, -9999), "int") == [
        None, 310, None]


def test_hash_tag(spark):
    given_ = ["plain", "{tag}:x", "{}:x", "{open", "a{b}{c}", "x}{y}", "{a{b}"]
    assert evaluate(spark, given_, keys.hash_tag) == [
        "plain", "tag", "{}:x", "{open", "b", "y", "a{b"]


def test_known_slots(spark):
    given_ = ["brand_id:123", "brand_id:456", "brand_id:789", "{brand_id:123}:evt_1", ""]
    assert evaluate(spark, given_, keys.key_slot) == [14256, 5490, 2961, 14256, 0]
    assert evaluate(spark, [0, 16383, 1366], lambda c: keys.slot_to_shard(c, 12), "int") == [0, 11, 1]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=30).filter(lambda s: "\x00" not in s), min_size=1, max_size=40))
def test_crc_matches_reference_implementation(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert evaluate(spark, texts, keys.crc16) == [
        binascii.crc_hqx(t.encode("utf-8"), 0) for t in texts]


def test_index_name(spark):
    assert evaluate(spark, ["widget"], lambda c: keys.index_name("test_", c)) == ["test_widget_00001"]
    assert evaluate(spark, [12], keys.event_key, "int") == ["evt_0000012"]


def test_documents_and_types(spark):
    given_ = ['{"product_type":"Widget"}', '[{"product_type":"A"},{"x":1},{"product_type":null}]',
              "42", "[]", "this is not json", None, '{"product_type":5}']
    got = evaluate(
        spark, given_,
        lambda c: F.transform(json.documents(c), lambda d: json.document_type(d)))
    assert got == [["widget"], ["a", "unknown", "unknown"], ["unknown"], [], None, None, ["5"]]


def test_valid_type(spark):
    given_ = ["widget", "a-b_1", "widget#123@", "invalid/product", "", None, "Upper"]
    assert evaluate(spark, given_, json.is_valid_type) == [
        True, True, False, False, False, False, False]


def test_typed_message(spark):
    whole = '{"name":"My Product","price":19.99,"ProductType":"Electronics"}'
    got = evaluate(spark, [whole, '{"ProductType":7}', "nope", None], json.typed_message)
    assert [None if g is None else tuple(g) for g in got] == [
        (whole, "Electronics"), ('{"ProductType":7}', None), None, None]


def test_constant_field(spark):
    got = evaluate(spark, ["{}", "nope"], lambda c: json.with_constant(json.typed_message(c), "version", 1))
    assert got[0].version == 1 and got[1] is None


def test_vectors(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])],
        "a array<float>, b array<float>")
    got = [r.c for r in df.select(vector.cosine(F.col("a"), F.col("b")).alias("c")).collect()]
    assert got == pytest.approx([1.0, 0.0, 0.0], abs=1e-6)
    length = evaluate(spark, ["p", "q"], lambda c: vector.norm(vector.pseudo_embedding(c, 64)))
    assert length == pytest.approx([1.0, 1.0], abs=1e-6)


def test_record_hash(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    hashes = [r.h for r in df.select(ledger.record_hash(F.struct("id", "v")).alias("h")).collect()]
    assert hashes[0] == hashes[1] != hashes[2] and len(hashes[0]) == 64
    got = spark.createDataFrame([("00ab", 2), ("00ab", 3)], "h string, d int").select(
        ledger.meets_difficulty(F.col("h"), F.col("d")).alias("ok")).collect()
    assert [r.ok for r in got] == [True, False]
