"""Queries on sharding, batching, packing and appending."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shardlog.functions.ids import record_id_text
from shardlog.functions.payloads import attribute, json_field, json_payload, raw_payload, raw_text
from shardlog.functions.shards import assign_shards, hash_key, shards_frame
from shardlog.model import ERROR_CONTAMINATED, ERROR_UNKNOWN_TYPE, FLAG_JSON, FLAG_RAW, ID_COLUMNS
from shardlog.operators.batching import Rule, batch_by_count, cut_batches
from shardlog.operators.packing import batch_status, batch_summary, pack_batches, split_by_flag, typed_by_owner, typed_payload, unpack_batches
from shardlog.plans.registry import query
from shardlog.plans.relations import (
    NUMBERED_SQL, REC_SQL, SHARDS5, SHARDS500, log, records, rid, shard_values, sharded, table,
)
from shardlog.session import scratch_path, store, use_utc
from shardlog.sources.append import SINGLE, append
from shardlog.sources.cursors import advance, create_subscription, fetch
from shardlog.sources.export import export_records, import_records
from shardlog.sources.record_log import append_results, shard_profile

# Limits of the bytes and time queries, small enough to close many batches.
BYTES_RULE = Rule(count=100, n_bytes=500)
TIMEOUT_RULE = Rule(count=10, timeout_us=3_600_000_000)
DOCUMENT_RULE = Rule(count=50, n_bytes=65_536)
FAIL_TEXT = "append failed"


def fold_sql(source: str, order_sql: str, count: int, n_bytes: int | None, timeout_us: int, cols: str, parts: str = "shard_id") -> str:
    """A record-at-a-time walk over ``source`` as a recursive query."""
    full = f"held + 1 >= {count}" + (f" OR size + n_bytes >= {n_bytes}" if n_bytes else "")
    ticked = f"us >= t0 + {timeout_us}" if timeout_us else "false"
    grid = f"t0 + {timeout_us} * ((us - t0) // {timeout_us})" if timeout_us else "t0"
    return f"""
seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY {parts} ORDER BY {order_sql}) AS rn FROM {source}),
fold AS (
  SELECT {parts}, rn, CAST(1 AS BIGINT) AS batch_id, CAST(0 AS BIGINT) AS at_index,
         CASE WHEN {full.replace('held', '0').replace('size', '0')} THEN 0 ELSE 1 END::BIGINT AS held,
         CASE WHEN {full.replace('held', '0').replace('size', '0')} THEN 0 ELSE n_bytes END::BIGINT AS size,
         us AS t0
  FROM seq WHERE rn = 1
  UNION ALL
  SELECT {parts}, rn, batch_id + CASE WHEN held = 0 THEN 1 ELSE 0 END, held,
         CASE WHEN {full} THEN 0 ELSE held + 1 END, CASE WHEN {full} THEN 0 ELSE size + n_bytes END,
         CASE WHEN {full} THEN us ELSE t0 END
  FROM (
    SELECT s.{parts}, s.rn, f.batch_id, s.n_bytes, s.us,
           CASE WHEN {ticked} THEN 0 ELSE f.held END AS held,
           CASE WHEN {ticked} THEN 0 ELSE f.size END AS size,
           CASE WHEN {ticked} THEN {grid} ELSE f.t0 END AS t0
    FROM fold f JOIN seq s ON s.{parts} = f.{parts} AND s.rn = f.rn + 1)),
cut AS (
  SELECT {cols}, fold.batch_id, CAST(fold.at_index AS INTEGER) AS batch_index
  FROM fold JOIN seq ON fold.{parts} = seq.{parts} AND fold.rn = seq.rn)"""


@query("shard_hash_key", "SELECT event_id, md5(CAST(user_id AS VARCHAR)) AS hash_key FROM events")
def _(spark, sf):
    """the 128-bit hash of each record's key."""
    return records(spark, sf).select("event_id", "hash_key")


@query("shard_assign", f"{REC_SQL} SELECT event_id, shard_id FROM rec")
def _(spark, sf):
    """J1 with few shards: floor lookup as an expression."""
    return sharded(spark, sf).select("event_id", "shard_id")


@query(
    "shard_assign_prefix",
    f"""WITH sh(shard_id, start_key) AS (VALUES {shard_values(SHARDS500)}),
    ev AS (SELECT event_id, md5(CAST(user_id AS VARCHAR)) AS h FROM events)
    SELECT event_id, shard_id FROM ev ASOF JOIN sh ON ev.h >= sh.start_key""",
)
def _(spark, sf):
    """J1 with many shards: equality on a hash prefix, then the range."""
    return assign_shards(records(spark, sf).select("event_id", "hash_key"), SHARDS500).select("event_id", "shard_id")


@query(
    "shard_assign_lineitem",
    f"""WITH sh(shard_id, start_key) AS (VALUES {shard_values(SHARDS500)}),
    li AS (SELECT l_orderkey, l_linenumber, md5(CAST(l_orderkey AS VARCHAR)) AS h FROM lineitem)
    SELECT shard_id, count(*) AS n, sum(l_linenumber)::BIGINT AS lines
    FROM li ASOF JOIN sh ON li.h >= sh.start_key GROUP BY shard_id""",
)
def _(spark, sf):
    """J1 over the largest table: lines of each of 500 shards, keyed by order."""
    li = table(spark, sf, "lineitem").select("l_linenumber", hash_key(F.col("l_orderkey").cast("string")).alias("hash_key"))
    return assign_shards(li, SHARDS500).groupBy("shard_id").agg(
        F.count("*").alias("n"), F.sum("l_linenumber").alias("lines")
    )


@query(
    "shard_profile",
    f"""WITH sh(shard_id, start_key) AS (VALUES {shard_values(SHARDS500)}),
    ev AS (SELECT md5(CAST(user_id AS VARCHAR)) AS h, strlen(props) AS b FROM events),
    a AS (SELECT shard_id, count(*) AS records, sum(b)::BIGINT AS bytes FROM ev ASOF JOIN sh ON ev.h >= sh.start_key GROUP BY 1)
    SELECT sh.shard_id, sh.start_key, coalesce(records, 0) AS records, coalesce(bytes, 0)::BIGINT AS bytes,
           (coalesce(records, 0) + 99) // 100 AS batches
    FROM sh LEFT JOIN a USING (shard_id) ORDER BY start_key""",
)
def _(spark, sf):
    """What each of 500 shards holds, in key order, empty ones too."""
    rows = assign_shards(records(spark, sf).select("hash_key", "n_bytes"), SHARDS500)
    return shard_profile(rows, shards_frame(spark, SHARDS500), 100).select(
        "shard_id", "start_key", "records", "bytes", "batches"
    )


@query("batch_by_count", f"{NUMBERED_SQL} SELECT event_id, shard_id, batch_id, batch_index FROM numbered")
def _(spark, sf):
    """Batches of 100."""
    return batch_by_count(sharded(spark, sf).select("event_id", "ts", "shard_id"), ["shard_id"], ["ts", "event_id"], 100).select(
        "event_id", "shard_id", "batch_id", "batch_index"
    )


_SIZED = "(SELECT *, epoch_us(ts) AS us FROM rec)"
BYTES_SQL = f"""{REC_SQL}, {fold_sql(_SIZED, 'ts, event_id', 100, 500, 0, 'event_id, seq.shard_id')}
SELECT event_id, shard_id, batch_id, batch_index FROM cut"""


@query("batch_by_bytes", BYTES_SQL)
def _(spark, sf):
    """A batch closes at 100 records or 500 bytes."""
    rows = sharded(spark, sf).select("event_id", "ts", "shard_id", "n_bytes")
    return cut_batches(rows, ["shard_id"], "ts", ["event_id"], "n_bytes", BYTES_RULE).records.select(
        "event_id", "shard_id", "batch_id", "batch_index"
    )


@query(
    "batch_by_timeout",
    f"""{REC_SQL}, {fold_sql(_SIZED, 'ts, event_id', 10, None, 3_600_000_000, 'event_id, seq.shard_id')}
    SELECT event_id, shard_id, batch_id, batch_index FROM cut""",
)
def _(spark, sf):
    """A batch closes at 10 records or when the hourly timer runs out."""
    rows = sharded(spark, sf).select("event_id", "ts", "shard_id", "n_bytes")
    return cut_batches(rows, ["shard_id"], "ts", ["event_id"], "n_bytes", TIMEOUT_RULE).records.select(
        "event_id", "shard_id", "batch_id", "batch_index"
    )


_DOCS = """docs AS (
  SELECT d.*, s.shard_id FROM (
    SELECT doc_id, source AS key, strlen(text)::BIGINT AS n_bytes, text, CAST(0 AS BIGINT) AS us, md5(source) AS h FROM documents) d
  ASOF JOIN sh s ON d.h >= s.start_key)"""
DOCS_SQL = f"WITH RECURSIVE sh(shard_id, start_key) AS (VALUES {shard_values(SHARDS5)}), {_DOCS}"


def document_records(spark, sf):
    """Documents as raw records, keyed by source: few keys, uneven payloads."""
    d = table(spark, sf, "documents").select(
        "doc_id",
        F.col("source").alias("key"),
        F.lit(FLAG_RAW).alias("flag"),
        F.lit(None).cast("map<string,string>").alias("attributes"),
        raw_payload(F.col("text")).alias("payload"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        hash_key(F.col("source")).alias("hash_key"),
    )
    return assign_shards(d, SHARDS5)


@query(
    "batch_by_bytes_documents",
    f"""{DOCS_SQL}, {fold_sql('docs', 'doc_id', 50, 65536, 0, 'doc_id, seq.shard_id')}
    SELECT doc_id, shard_id, batch_id, batch_index FROM cut""",
)
def _(spark, sf):
    """W3 on texts of very uneven size: 50 records or 64 KiB."""
    rows = document_records(spark, sf).select("doc_id", "shard_id", "n_bytes")
    return cut_batches(rows, ["shard_id"], None, ["doc_id"], "n_bytes", DOCUMENT_RULE).records.select(
        "doc_id", "shard_id", "batch_id", "batch_index"
    )


@query("record_ids", f"{NUMBERED_SQL} SELECT event_id, shard_id, batch_id, batch_index, rid FROM numbered")
def _(spark, sf):
    """Ids of all records, with their text form."""
    return log(spark, sf).select("event_id", "shard_id", "batch_id", "batch_index", rid())


@query("records_sorted", f"{NUMBERED_SQL} SELECT event_id, shard_id, batch_id, batch_index FROM numbered ORDER BY batch_id, batch_index")
def _(spark, sf):
    """All records in id order; the shard plays no part."""
    return log(spark, sf).select("event_id", "shard_id", "batch_id", "batch_index").orderBy("batch_id", "batch_index")


BATCH_SUMMARY_SQL = f"""{NUMBERED_SQL}
SELECT shard_id, batch_id, count(*) AS batch_size, sum(n_bytes)::BIGINT AS bytes, max(ts) AS publish_time
FROM numbered GROUP BY shard_id, batch_id"""


@query("batch_summary", BATCH_SUMMARY_SQL)
def _(spark, sf):
    """A2: records, bytes and publish time of each batch."""
    return batch_summary(log(spark, sf))


def flagship(spark, sf):
    """Sharding, batching and the batch summary end to end, from the raw table."""
    use_utc(spark)
    rows = sharded(spark, sf).select("event_id", "ts", "shard_id", "n_bytes")
    return batch_summary(batch_by_count(rows, ["shard_id"], ["ts", "event_id"], 100))


@query("ingest_summary", BATCH_SUMMARY_SQL)
def _(spark, sf):
    """F1, J1, W2, A2 in one job."""
    return flagship(spark, sf)


# --- packing ----------------------------------------------------------------

_PACK_SQL = f"""{NUMBERED_SQL}
SELECT shard_id, batch_id, count(*) AS batch_size, sum(n_bytes)::BIGINT AS bytes, max(ts) AS publish_time,
       md5(string_agg(props, '' ORDER BY batch_index)) AS payload_md5
FROM numbered GROUP BY shard_id, batch_id"""


@query("pack_batches", _PACK_SQL)
def _(spark, sf):
    """A1: one serialized payload per batch, checked through its own content."""
    packed = pack_batches(log(spark, sf), ["shard_id"])
    kind = "array<struct<payload: binary>>"
    payloads = F.transform(F.from_json(F.col("payload").cast("string"), kind), lambda r: r["payload"].cast("string"))
    text = F.array_join(payloads, "")
    return packed.select(
        "shard_id", "batch_id", "batch_size",
        F.octet_length(text).cast("bigint").alias("bytes"),
        "publish_time",
        F.md5(text).alias("payload_md5"),
    )


_ROUND_TRIP_SQL = f"{NUMBERED_SQL} SELECT rid, key, props AS payload, event_type AS type, publish_time FROM numbered"


def _round_trip(spark, sf, compression):
    packed = pack_batches(log(spark, sf), ["shard_id"], compression)
    good, _ = unpack_batches(packed, ["shard_id"])
    return good.select(
        rid(), "key", F.col("payload").cast("string").alias("payload"), attribute(F.col("attributes"), "type").alias("type"), "publish_time"
    )


@query("unpack_batches", _ROUND_TRIP_SQL)
def _(spark, sf):
    """Records and ids out of uncompressed batches."""
    return _round_trip(spark, sf, "none")


@query("pack_gzip", _ROUND_TRIP_SQL)
def _(spark, sf):
    """the same through gzip."""
    return _round_trip(spark, sf, "gzip")


@query("pack_zstd", _ROUND_TRIP_SQL)
def _(spark, sf):
    """the same through zstd."""
    return _round_trip(spark, sf, "zstd")


@query(
    "pack_zstd_documents",
    f"""{DOCS_SQL}, {fold_sql('docs', 'doc_id', 50, 65536, 0, 'doc_id, seq.shard_id, key, text')}
    SELECT concat_ws('-', shard_id, batch_id, batch_index) AS rid, key, md5(text) AS payload_md5 FROM cut""",
)
def _(spark, sf):
    """Whole texts batched, compressed and read back."""
    cut = cut_batches(document_records(spark, sf), ["shard_id"], None, ["doc_id"], "n_bytes", DOCUMENT_RULE)
    stamped = cut.records.withColumn("publish_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    good, _ = unpack_batches(pack_batches(stamped, ["shard_id"], "zstd"), ["shard_id"], on_error="fail")
    return good.select(rid(), "key", F.md5("payload").alias("payload_md5"))


@query(
    "batch_integrity",
    f"""{NUMBERED_SQL}
    SELECT shard_id, batch_id, CASE WHEN batch_id % 10 = 0 THEN '{ERROR_CONTAMINATED}' ELSE 'ok' END AS status
    FROM numbered GROUP BY shard_id, batch_id""",
)
def _(spark, sf):
    """Integrity rule: every tenth batch claims one record more than it has ids."""
    packed = pack_batches(log(spark, sf), ["shard_id"])
    broken = packed.withColumn("batch_size", F.col("batch_size") + F.when(F.col("batch_id") % 10 == 0, 1).otherwise(0))
    return batch_status(broken).select("shard_id", "batch_id", "status")


# --- appending --------------------------------------------------------------

@query(
    "append_single",
    f"""{REC_SQL}
    SELECT event_id, concat_ws('-', shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY ts, event_id), 0) AS rid FROM rec""",
)
def _(spark, sf):
    """K1: each record a batch of its own."""
    done = append(records(spark, sf), scratch_path(spark, "append-single"), SHARDS5, SINGLE)
    return done.select("event_id", "rid")


_LATER = "ts >= TIMESTAMP '2024-01-10'"


_TWICE_SQL = f"""{REC_SQL},
    ord AS (SELECT *, {_LATER} AS later, row_number() OVER (PARTITION BY shard_id, {_LATER} ORDER BY ts, event_id) - 1 AS place FROM rec),
    before AS (SELECT shard_id, max(place // 100) + 1 AS batches FROM ord WHERE NOT later GROUP BY shard_id),
    twice AS (
      SELECT event_id, later,
             concat_ws('-', shard_id, place // 100 + 1 + CASE WHEN later THEN coalesce(batches, 0) ELSE 0 END, place % 100) AS rid
      FROM ord LEFT JOIN before USING (shard_id))"""


@query("append_twice", f"{_TWICE_SQL} SELECT event_id, later, rid FROM twice")
def _(spark, sf):
    """K2: two appends to one log. Ids go on, and each returns its own records only."""
    path, later = scratch_path(spark, "append-twice"), F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")
    both = [
        store(append(records(spark, sf).where(part), path, SHARDS5, Rule(count=100)).select("event_id", later.alias("later"), "rid"), "appended")
        for part in (~later, later)
    ]
    return both[0].unionAll(both[1])


@query("sub_stored_start", f"{_TWICE_SQL} SELECT event_id, rid FROM twice WHERE later")
def _(spark, sf):
    """ST1, S7: a subscription made between two appends, its start stored; it fetches the
    records of the second, and by its stored position nothing once it is done with them."""
    path, later = scratch_path(spark, "subscribed"), F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")
    append(records(spark, sf).where(~later), path, SHARDS5, Rule(count=100))
    create_subscription(spark, path, "s1")
    schema = append(records(spark, sf).where(later), path, SHARDS5, Rule(count=100)).drop("rid", "error").schema
    got = store(fetch(spark, path, "s1", schema).select("event_id", *ID_COLUMNS), "fetched")
    advance(spark, path, "s1", got)
    again = fetch(spark, path, "s1", schema).select("event_id", *ID_COLUMNS)
    return got.unionAll(again).select("event_id", rid())


@query("append_batched", f"{NUMBERED_SQL} SELECT event_id, rid, n_bytes, publish_time FROM numbered")
def _(spark, sf):
    """K2: shard, batch, number and write; read back from the written log."""
    done = append(records(spark, sf), scratch_path(spark, "append-batched"), SHARDS5, Rule(count=100))
    return done.select("event_id", "rid", "n_bytes", "publish_time")


@query(
    "append_results",
    f"""{NUMBERED_SQL}
    SELECT event_id, CASE WHEN batch_id % 10 <> 7 THEN rid END AS rid,
           CASE WHEN batch_id % 10 = 7 THEN '{FAIL_TEXT} ' || batch_id END AS error FROM numbered""",
)
def _(spark, sf):
    """K3: an id per record, or the error of its batch (batches ending in 7 fail)."""
    rows = log(spark, sf)
    failed = batch_summary(rows).where("batch_id % 10 = 7").select(
        "shard_id", "batch_id", F.concat_ws(" ", F.lit(FAIL_TEXT), "batch_id").alias("error")
    )
    done = append_results(rows, failed)
    return done.select("event_id", F.when(F.col("error").isNull(), record_id_text()).alias("rid"), "error")


# --- payloads ---------------------------------------------------------------

@query("encode_raw", f"SELECT event_id, CAST(user_id AS VARCHAR) AS key, '{FLAG_RAW}' AS flag, props AS field, strlen(props)::BIGINT AS n_bytes FROM events")
def _(spark, sf):
    """Key and bytes."""
    e = table(spark, sf, "events")
    raw = e.select("event_id", F.col("user_id").cast("string").alias("key"), F.lit(FLAG_RAW).alias("flag"), raw_payload(F.col("props")).alias("payload"))
    return raw.select("event_id", "key", "flag", raw_text(F.col("payload"), F.col("flag")).alias("field"), F.octet_length("payload").cast("bigint").alias("n_bytes"))


@query("encode_json", f"SELECT event_id, CAST(user_id AS VARCHAR) AS key, '{FLAG_JSON}' AS flag, event_type AS type, user_id FROM events")
def _(spark, sf):
    """Columns into one JSON payload, read back field by field."""
    e = table(spark, sf, "events")
    body = json_payload([F.col("event_type"), F.col("user_id"), F.col("props").cast("binary").alias("bytes")])
    rows = e.select("event_id", F.col("user_id").cast("string").alias("key"), F.lit(FLAG_JSON).alias("flag"), body.alias("payload"))
    field = lambda f: json_field(F.col("payload"), F.col("flag"), f)
    return rows.select("event_id", "key", "flag", field("event_type").alias("type"), field("user_id").cast("bigint").alias("user_id"))


def _flagged(spark, sf):
    """Records of three flags: even ids JSON, odd raw, every fiftieth unknown."""
    flag = F.when(F.col("event_id") % 50 == 0, "OTHER").when(F.col("event_id") % 2 == 0, FLAG_JSON).otherwise(FLAG_RAW)
    return records(spark, sf).withColumn("flag", flag)


_FLAG_SQL = "CASE WHEN event_id % 50 = 0 THEN 'OTHER' WHEN event_id % 2 = 0 THEN 'JSON' ELSE 'RAW' END"


@query(
    "decode_by_flag",
    f"""SELECT event_id, {_FLAG_SQL} AS flag, CASE WHEN event_id % 2 = 1 THEN props ELSE json_extract_string(props, '$.k') END AS field
    FROM events WHERE event_id % 50 <> 0""",
)
def _(spark, sf):
    """Raw records as text, JSON records by field."""
    good, _ = split_by_flag(_flagged(spark, sf))
    text = F.coalesce(raw_text(F.col("payload"), F.col("flag")), json_field(F.col("payload"), F.col("flag"), "k"))
    return good.select("event_id", "flag", text.alias("field"))


@query("quarantine", f"SELECT event_id, 'OTHER' AS flag, '{ERROR_UNKNOWN_TYPE}' AS error FROM events WHERE event_id % 50 = 0")
def _(spark, sf):
    """Records of unknown type, set aside."""
    _, bad = split_by_flag(_flagged(spark, sf))
    return bad.select("event_id", "flag", "error")


_PROPS_SCHEMA = {
    "type": "struct",
    "fields": [
        {"name": "k", "type": "long", "nullable": False, "metadata": {}},
        {"name": "note", "type": "string", "nullable": True, "metadata": {"hidden": True}},
    ],
}


@query("typed_payload", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def _(spark, sf):
    """A stored schema applied to JSON payloads, its hidden field left out."""
    good, _ = typed_payload(records(spark, sf), json.dumps(_PROPS_SCHEMA))
    return good.select("event_id", "k")


# Fields by stream: name, kind, required, hidden. Errors have no schema.
_OWN_SCHEMAS = {
    "click": [("k", "bigint", True, False), ("user_id", "bigint", False, False)],
    "view": [("amount", "double", True, False), ("k", "bigint", False, True)],
    "purchase": [("amount", "bigint", True, False)],
    "signup": [("name", "string", True, False), ("k", "bigint", True, False)],
}


@query(
    "typed_by_owner",
    """WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n FROM events),
    f AS (SELECT event_id, event_type, user_id, NULLIF(n, 7) AS k, COALESCE(n % 2 = 0, false) AS even,
                 CASE WHEN n % 2 = 0 THEN CAST(user_id AS DOUBLE) ELSE value END AS amount FROM e),
    j AS (SELECT *, CASE event_type WHEN 'click' THEN k IS NOT NULL WHEN 'signup' THEN k IS NOT NULL
                                    WHEN 'view' THEN amount IS NOT NULL
                                    WHEN 'purchase' THEN even AND amount IS NOT NULL END AS fits FROM f)
    SELECT event_id, event_type AS owner,
           CASE WHEN fits IS NULL THEN 'no schema' WHEN NOT fits THEN 'payload does not fit the schema' END AS error,
           CASE WHEN fits AND event_type IN ('click', 'signup') THEN k END AS k,
           CASE WHEN fits AND event_type = 'click' THEN user_id END AS user_id,
           CASE WHEN fits AND event_type IN ('view', 'purchase') THEN amount END AS amount,
           CASE WHEN fits AND event_type = 'signup' THEN event_type END AS name
    FROM j""",
)
def _(spark, sf):
    """Payloads of five streams by the schema that each stream has, misfits set aside."""
    events = table(spark, sf, "events")
    n = F.get_json_object("props", "$.k").cast("bigint")
    amounts = {"user_id": n % 2 == 0, "value": F.coalesce(n % 2 != 0, F.lit(True))}
    rest = [F.nullif(n, F.lit(7)).alias("k"), F.col("user_id"), F.col("event_type").alias("name")]
    payload = F.coalesce(*[F.when(when, F.to_json(F.struct(*rest, F.col(c).alias("amount")))) for c, when in amounts.items()])
    sent = events.select("event_id", F.col("event_type").alias("owner"), payload.alias("payload"))
    rows = [(o, *f) for o, fields in _OWN_SCHEMAS.items() for f in fields]
    schemas = spark.createDataFrame(rows, "owner string, field string, kind string, required boolean, hidden boolean")
    good, bad = typed_by_owner(sent, schemas, "owner")
    kinds = {"k": "bigint", "user_id": "bigint", "amount": "double", "name": "string"}
    typed = good.select("event_id", "owner", *[F.try_variant_get(F.col("fields")[c], F.lit("$"), kind).alias(c) for c, kind in kinds.items()])
    return typed.unionByName(bad.select("event_id", "owner", "error"), allowMissingColumns=True)


@query("filter_attributes", "SELECT event_id, event_type AS k FROM events WHERE event_type = 'click'")
def _(spark, sf):
    """Records by attribute."""
    type_ = attribute(F.col("attributes"), "type")
    return records(spark, sf).where(type_ == "click").select("event_id", type_.alias("k"))


@query("export_records", f"{NUMBERED_SQL} SELECT rid, key, props AS payload, publish_time FROM numbered")
def _(spark, sf):
    """The log copied to JSON files and read back."""
    rows = log(spark, sf).select(rid(), "key", raw_payload(F.col("payload")).alias("payload"), "publish_time")
    out = scratch_path(spark, "export")
    export_records(rows, out, "json")
    return import_records(spark, out, rows.schema, "json").withColumn("payload", F.col("payload").cast("string"))


@query(
    "append_sized",
    f"""{REC_SQL}, {fold_sql(_SIZED, 'ts, event_id', 100, 500, 0, 'event_id, seq.shard_id, ts')}
    SELECT event_id, concat_ws('-', shard_id, batch_id, batch_index) AS rid,
           max(ts) OVER (PARTITION BY shard_id, batch_id) AS publish_time
    FROM cut""",
)
def _(spark, sf):
    """K2 with the bytes limit: batches of up to 100 records or 500 bytes, written and read back."""
    done = append(records(spark, sf), scratch_path(spark, "append-sized"), SHARDS5, BYTES_RULE)
    return done.select("event_id", "rid", "publish_time")
