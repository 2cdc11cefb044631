"""Payload encoding, codecs, packing and error policies."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shardlog.functions import payloads as p
from shardlog.operators.packing import batch_status, pack_batches, split_by_flag, typed_by_owner, typed_payload, unpack_batches

encode, decode = p._compress.func, p._decompress.func


@pytest.mark.parametrize("codec", ["gzip", "zstd"])
@given(st.binary(max_size=5000))
def test_codecs_give_back_what_they_got(codec, data):
    assert decode(encode(data, codec), codec) == data


@pytest.mark.parametrize("codec", ["gzip", "zstd"])
def test_cut_and_foreign_bytes_are_refused(codec):
    whole = encode(b"abc" * 1000, codec)
    assert decode(whole[:-3], codec) is None
    assert decode(b"not compressed", codec) is None


def records(spark):
    rows = [
        (1, b, i, f"k{i}", "RAW" if i % 2 else "JSON", {"a": str(i)} if i else None, bytearray([i, 0, 255, b]) if i != 2 else None)
        for b in (1, 2, 3)
        for i in range(b + 1)
    ]
    df = spark.createDataFrame(
        rows, "shard_id bigint, batch_id bigint, batch_index int, key string, flag string, attributes map<string,string>, payload binary"
    )
    return df.withColumn("publish_time", F.lit("2024-01-01").cast("timestamp_ntz"))


@pytest.mark.parametrize("codec", ["none", "gzip", "zstd"])
def test_unpack_of_pack_is_the_input(spark, codec):
    df = records(spark)
    good, bad = unpack_batches(pack_batches(df, ["shard_id"], codec), ["shard_id"])
    assert sorted(map(str, good.select(df.columns).collect())) == sorted(map(str, df.collect()))
    assert bad.count() == 0


def test_unknown_codec(spark):
    with pytest.raises(ValueError):
        pack_batches(records(spark), ["shard_id"], "lz4")


def broken(spark):
    packed = pack_batches(records(spark), ["shard_id"], "zstd")
    return packed.withColumn(
        "batch_size", F.when(F.col("batch_id") == 1, F.col("batch_size") + 1).otherwise(F.col("batch_size"))
    ).withColumn("payload", F.when(F.col("batch_id") == 2, F.lit("junk").cast("binary")).otherwise(F.col("payload")))


def test_skip_sets_bad_batches_aside(spark):
    good, bad = unpack_batches(broken(spark), ["shard_id"])
    assert {r["batch_id"] for r in good.collect()} == {3}
    assert {r["batch_id"]: r["status"] for r in bad.collect()} == {1: "data contaminated", 2: "decompress error"}


def test_fail_raises(spark):
    with pytest.raises(PySparkException, match="data contaminated|decompress error"):
        unpack_batches(broken(spark), ["shard_id"], on_error="fail")[0].collect()


def test_missing_payload_is_no_records(spark):
    packed = pack_batches(records(spark), ["shard_id"]).withColumn("payload", F.lit(None).cast("binary"))
    assert {r["status"] for r in batch_status(packed).collect()} == {"no records"}


def test_unknown_and_missing_flags_are_quarantined(spark):
    df = spark.createDataFrame([(1, "RAW"), (2, "JSON"), (3, "XML"), (4, None)], "id bigint, flag string")
    good, bad = split_by_flag(df)
    assert {r["id"] for r in good.collect()} == {1, 2}
    assert {(r["id"], r["error"]) for r in bad.collect()} == {(3, "unknown record type"), (4, "unknown record type")}


def test_json_payload_keeps_nulls_and_encodes_bytes(spark):
    df = spark.createDataFrame([(None, bytearray(b"hi"), 2**53 + 1)], "a string, b binary, n bigint")
    plain = df.select(p.json_payload([F.col(c) for c in df.columns]).alias("v")).first()["v"]
    assert json.loads(bytes(plain)) == {"a": None, "b": "aGk=", "n": 2**53 + 1}
    struct = df.select(p.json_payload([], True, df.schema).alias("v")).first()["v"]
    assert json.loads(bytes(struct))["n"] == float(2**53)


def test_typed_payload_hides_fields_and_quarantines(spark):
    schema = {
        "type": "struct",
        "fields": [
            {"name": "k", "type": "long", "nullable": False, "metadata": {}},
            {"name": "secret", "type": "string", "nullable": True, "metadata": {"hidden": True}},
        ],
    }
    rows = [(1, '{"k": 1, "secret": "x"}'), (2, '{"k": "one"}'), (3, "{}"), (4, "not json"), (5, None)]
    good, bad = typed_payload(spark.createDataFrame(rows, "id bigint, payload string"), json.dumps(schema))
    assert [r.asDict() for r in good.collect()] == [{"id": 1, "k": 1}]
    assert {r["id"] for r in bad.collect()} == {2, 3, 4, 5}


def test_each_owner_has_its_own_schema(spark):
    fields = [("a", "n", "bigint", True, False), ("a", "s", "string", False, True), ("b", "x y", "double", False, False), ("b", "t", "boolean", True, False)]
    schemas = spark.createDataFrame(fields, "stream string, field string, kind string, required boolean, hidden boolean")
    sent = [
        (1, "a", '{"n": 5, "s": "q", "more": [1]}'), (2, "a", '{"n": "5"}'), (3, "a", '{"s": "q"}'), (4, "a", '{"n": null}'), (5, "a", '{"n": 5, "s": 1}'),
        (6, "b", '{"x y": 1, "t": true}'), (7, "b", '{"x y": 1.5, "t": false}'), (8, "b", '{"t": true}'), (9, "b", '{"t": 1}'),
        (10, "c", "{}"), (11, None, "{}"), (12, "a", "not json"), (13, "a", None), (14, "a", "[5]"), (15, "b", '{"x y": [1], "t": true}'),
    ]
    good, bad = typed_by_owner(spark.createDataFrame(sent, "id int, stream string, payload string"), schemas, "stream")
    got = {r["id"]: json.loads(r["fields"]) for r in good.select("id", F.to_json("fields").alias("fields")).collect()}
    assert got == {1: {"n": 5}, 6: {"x y": 1, "t": True}, 7: {"x y": 1.5, "t": False}, 8: {"t": True}}
    errors = {r["id"]: r["error"] for r in bad.collect()}
    assert {i for i, e in errors.items() if e == "no schema"} == {10, 11}
    assert set(errors) == set(range(1, 16)) - set(got)
    assert bad.where("payload is not null").count() == len(errors) - 1


@pytest.mark.parametrize("body", ["junk", "[]", "{}", "", '[{"batch_index": 0}', "[1, 2]"])
def test_undecodable_and_short_payloads_are_set_aside(spark, body):
    packed = pack_batches(records(spark), ["shard_id"])
    packed = packed.withColumn("payload", F.when(F.col("batch_id") == 2, F.lit(body).cast("binary")).otherwise(F.col("payload")))
    good, bad = unpack_batches(packed, ["shard_id"])
    assert {r["batch_id"] for r in good.collect()} == {1, 3}
    assert {r["batch_id"]: r["status"] for r in bad.collect()} == {2: "decode error"}
    with pytest.raises(PySparkException, match="decode error"):
        unpack_batches(packed, ["shard_id"], on_error="fail")[0].collect()


def test_struct_numbers_are_doubles_at_any_depth(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('b', 2, 'c', array(3, null)) AS s, map('k', 4L) AS m, 'x' AS t")
    text = df.select(p.json_payload([], as_struct_numbers=True, schema=df.schema).cast("string")).first()[0]
    assert text == '{"a":1.0,"s":{"b":2.0,"c":[3.0,null]},"m":{"k":4.0},"t":"x"}'
