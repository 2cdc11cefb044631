"""Record payloads: encoding, decoding by flag, attributes, codecs."""

from __future__ import annotations

import gzip
import zlib

import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlog.model import FLAG_JSON, FLAG_RAW


def raw_payload(value: Column) -> Column:
    """Bytes of a raw record (flag RAW)."""
    return value.cast("binary")


def json_payload(fields: list[Column], as_struct_numbers: bool = False, schema: T.StructType | None = None) -> Column:
    """Bytes of a JSON record (flag JSON); nulls are kept, binary becomes base64.

    ``as_struct_numbers`` makes every number a double, as a protobuf Struct does, also
    inside structs, arrays and maps; integers beyond 2^53 then lose digits. It needs
    the fields' ``schema``.
    """
    if as_struct_numbers:
        fields = [F.col(f.name).cast(_with_doubles(f.dataType)).alias(f.name) for f in schema]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary")


def _with_doubles(kind: T.DataType) -> T.DataType:
    """The type with a double for every number in it; map keys stay, as JSON has them as text."""
    if isinstance(kind, T.NumericType):
        return T.DoubleType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_doubles(f.dataType), f.nullable) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_doubles(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _with_doubles(kind.valueType), kind.valueContainsNull)
    return kind


def known_flag(flag: Column) -> Column:
    return F.coalesce(flag.isin(FLAG_RAW, FLAG_JSON), F.lit(False))


def json_field(payload: Column, flag: Column, field: str) -> Column:
    """A field of a JSON payload as text; null for other records."""
    return F.when(flag == FLAG_JSON, F.get_json_object(payload.cast("string"), f"$.{field}"))


def raw_text(payload: Column, flag: Column) -> Column:
    return F.when(flag == FLAG_RAW, payload.cast("string"))


def attribute(attributes: Column, name: str) -> Column:
    return attributes[name]


# The codecs run once per packed batch, not per record, on batches of up to a
# megabyte. A plain UDF hands Python about a hundred of them at a time, where an
# Arrow batch would put ten thousand, gigabytes, into one worker's memory. They
# are marked as not deterministic so that Catalyst, which copies an expression to
# each place that uses it, runs them once per batch.
@F.udf(T.BinaryType())
def _compress(payload, codec):
    if payload is None:
        return None
    data = bytes(payload)
    return gzip.compress(data, mtime=0) if codec == "gzip" else zstandard.ZstdCompressor().compress(data)


@F.udf(T.BinaryType())
def _decompress(payload, codec):
    if payload is None:
        return None
    try:
        data = bytes(payload)
        if codec == "gzip":
            return gzip.decompress(data)
        if codec == "zstd":
            reader = zstandard.ZstdDecompressor().decompressobj()
            out = reader.decompress(data)
            return out if reader.eof else None
    except (OSError, EOFError, zlib.error, zstandard.ZstdError):
        pass
    return None


def compress(payload: Column, codec: str) -> Column:
    return payload if codec == "none" else _compress.asNondeterministic()(payload, F.lit(codec))


def decompress(payload: Column, codec: Column) -> Column:
    """Null when the bytes are not a whole payload of that codec. Uncompressed
    payloads stay out of Python."""
    plain = codec == "none"
    return F.coalesce(_decompress.asNondeterministic()(F.when(~plain, payload), codec), F.when(plain, payload))
