"""Packed batches: many records in one payload, and back."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.functions.payloads import compress, decompress, known_flag
from shardlog.model import ERROR_CONTAMINATED, ERROR_NO_RECORDS, ERROR_UNKNOWN_TYPE, check_compression
from shardlog.session import store

RECORD = "struct<batch_index: int, key: string, flag: string, attributes: map<string,string>, payload: binary>"
ERROR_DECOMPRESS = "decompress error"
ERROR_DECODE = "decode error"


def batch_summary(records: DataFrame, parts: list[str] = ["shard_id"], ts: str = "ts", n_bytes: Column | str = "n_bytes") -> DataFrame:  # noqa: B006
    """Records, payload bytes (before compression, keys not counted) and publish
    time of each batch. The publish time belongs to the batch: its latest record's.
    A stored size spares reading the payloads; else give ``octet_length`` of them."""
    return records.groupBy(*parts, "batch_id").agg(
        F.count("*").alias("batch_size"),
        F.coalesce(F.sum(n_bytes), F.lit(0)).cast("bigint").alias("bytes"),
        F.max(ts).alias("publish_time"),
    )


def pack_batches(records: DataFrame, parts: list[str], compression: str = "none") -> DataFrame:
    """One row per batch. A batch is bounded by its count and bytes limits, so
    the list built here is too, whatever the size of its shard."""
    check_compression(compression)
    fields = F.struct("batch_index", "key", "flag", "attributes", F.col("payload").cast("binary").alias("payload"))
    packed = records.groupBy(*parts, "batch_id").agg(
        F.array_sort(F.collect_list(fields), lambda a, b: a["batch_index"] - b["batch_index"]).alias("_records"),
        F.max("publish_time").alias("publish_time"),
    )
    ids = F.transform(
        "_records",
        lambda r: F.struct(F.col("shard_id").alias("shard_id"), F.col("batch_id").alias("batch_id"), r["batch_index"].alias("batch_index")),
    )
    body = F.to_json("_records", {"ignoreNullFields": "false"}).cast("binary")
    return packed.select(
        *parts,
        "batch_id",
        F.size("_records").cast("bigint").alias("batch_size"),
        F.lit(compression).alias("compression"),
        "publish_time",
        ids.alias("record_ids"),
        compress(body, compression).alias("payload"),
    )


def batch_status(packed: DataFrame) -> DataFrame:
    """Add ``status``: ok, or why the batch cannot be read."""
    return packed.withColumn(
        "status",
        F.when(F.col("payload").isNull(), ERROR_NO_RECORDS)
        .when(F.col("batch_size") != F.size("record_ids"), ERROR_CONTAMINATED)
        .otherwise("ok"),
    )


def unpack_batches(packed: DataFrame, parts: list[str], on_error: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Records of packed batches, the i-th id going to the i-th record, and the
    batches that could not be read with their ``status``.

    ``on_error="fail"`` raises in the job instead of setting bad batches aside.
    """
    checked = batch_status(packed).withColumn("_body", decompress(F.col("payload"), F.col("compression")))
    status = F.when((F.col("status") == "ok") & F.col("_body").isNull(), ERROR_DECOMPRESS).otherwise(F.col("status"))
    # Parsed once: the lambda holds the records while their number is checked.
    parsed = F.array(F.from_json(F.col("_body").cast("string"), f"array<{RECORD}>", {"mode": "PERMISSIVE"}))
    pair = lambda rid, rec: F.struct(rid.alias("id"), rec.alias("rec"))
    pairs = F.transform(parsed, lambda rs: F.when(F.size(rs) == F.size("record_ids"), F.zip_with("record_ids", rs, pair)))[0]

    opened = checked.withColumn("status", status)
    if on_error == "fail":
        stop = lambda text: F.raise_error(F.concat(F.lit("batch: "), text))
        opened = opened.where(F.when(F.col("status") == "ok", True).otherwise(stop(F.col("status")).cast("boolean")))
        pairs = F.coalesce(pairs, stop(F.lit(ERROR_DECODE)))
    elif on_error != "skip":
        raise ValueError(f"on_error must be skip or fail, got {on_error!r}")
    zipped = opened.where("status = 'ok'").select(*parts, "batch_id", "publish_time", F.explode(pairs).alias("r"))
    records = zipped.select(
        *parts,
        "batch_id",
        F.col("r.id.batch_index").alias("batch_index"),
        F.col("r.rec.key").alias("key"),
        F.col("r.rec.flag").alias("flag"),
        F.col("r.rec.attributes").alias("attributes"),
        F.col("r.rec.payload").alias("payload"),
        "publish_time",
    )
    undecoded = F.when((F.col("status") == "ok") & pairs.isNull(), ERROR_DECODE).otherwise(F.col("status"))
    return records, opened.withColumn("status", undecoded).where("status <> 'ok'").drop("_body")


def split_by_flag(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that can be decoded, and the rest with an ``error`` text."""
    ok = known_flag(F.col("flag"))
    return records.where(ok), records.where(~ok).withColumn("error", F.lit(ERROR_UNKNOWN_TYPE))


def typed_payload(records: DataFrame, schema_json: str) -> tuple[DataFrame, DataFrame]:
    """Apply a stored schema (``StructType`` as JSON) to JSON payloads.

    Fields with metadata ``{"hidden": true}`` are left out. Rows whose payload
    does not fit, or lacks a field that may not be null, come back apart with
    ``error``.
    """
    schema = T.StructType.fromJson(json.loads(schema_json))
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema] + [T.StructField("_corrupt", T.StringType())])
    parsed = records.withColumn(
        "_typed",
        F.from_json(F.col("payload").cast("string"), loose, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}),
    )
    fits = F.col("_typed").isNotNull() & F.col("_typed._corrupt").isNull()
    for f in schema:
        if not f.nullable:
            fits = fits & F.col(f"_typed.{f.name}").isNotNull()
    shown = [F.col(f"_typed.{f.name}").alias(f.name) for f in schema if not f.metadata.get("hidden")]
    rest = [c for c in records.columns if c != "payload"]
    return (
        parsed.where(fits).select(*rest, *shown),
        parsed.where(~fits).drop("_typed").withColumn("error", F.lit("payload does not fit the schema")),
    )


# JSON kinds, as ``schema_of_variant`` names them, that fit a field of a kind.
_FITTING = {"bigint": r"^BIGINT$", "double": r"^(BIGINT|DOUBLE|DECIMAL\(.*)$", "boolean": r"^BOOLEAN$", "string": r"^STRING$"}


def typed_by_owner(records: DataFrame, schemas: DataFrame, owner: str) -> tuple[DataFrame, DataFrame]:
    """Apply to each JSON payload the schema of its owner, a stream say.

    ``schemas`` is a table of fields: owner, ``field`` (no quotes in it, once per owner),
    ``kind`` (bigint, double, boolean or string), ``required`` and ``hidden``. Records that fit come back with
    ``fields``, a map of their schema's fields that are there and not hidden to VARIANT
    values; fields beyond the schema are left out. Records without a schema, or whose
    payload is no JSON object, lacks a required field or has one of another kind come back
    apart with ``error``. A null owner has no schema.
    """
    # An owner's fields on one row; written, so that the join is planned by their true size.
    listed = store(schemas.groupBy(owner).agg(F.collect_list(F.struct("field", "kind", "required", "hidden")).alias("_schema")), "schemas")
    body = F.col("_body")

    def value(field: Column) -> Column:
        return F.try_variant_get(body, F.concat(F.lit("$['"), field, F.lit("']")), "variant")

    def fits(f: Column) -> Column:
        kind = F.coalesce(F.schema_of_variant(value(f["field"])), F.lit("VOID"))
        right = F.lit(False)
        for name, pattern in _FITTING.items():
            right = right | ((f["kind"] == name) & kind.rlike(pattern))
        return F.when(kind == "VOID", ~f["required"]).otherwise(right)

    parsed = records.join(listed, owner, "left").withColumn("_body", F.try_parse_json(F.col("payload").cast("string")))
    whole = F.coalesce(F.schema_of_variant(body).startswith("OBJECT"), F.lit(False))
    error = F.when(F.col("_schema").isNull(), F.lit("no schema")).when(~whole | ~F.forall("_schema", fits), F.lit("payload does not fit the schema"))
    judged = parsed.withColumn("error", error)
    shown = F.filter("_schema", lambda f: ~f["hidden"])
    entries = F.filter(F.transform(shown, lambda f: F.struct(f["field"].alias("key"), value(f["field"]).alias("value"))), lambda e: e["value"].isNotNull())
    good = judged.where("error is null").withColumn("fields", F.map_from_entries(entries))
    return good.drop("payload", "error", "_schema", "_body"), judged.where("error is not null").drop("_schema", "_body")
