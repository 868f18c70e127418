"""Text expressions: byte decoding, masking, truncation, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utf8(column: Column) -> Column:
    """Binary to text; each malformed sequence becomes U+FFFD."""
    return F.make_valid_utf8(column.cast("string"))


def bytes_to_text(column: Column, data_type: T.DataType) -> Column:
    """Decode every binary value inside a column, at any depth, keys included."""
    if not _has_binary(data_type):
        return column
    if isinstance(data_type, T.BinaryType):
        return utf8(column)
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: bytes_to_text(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        decoded = column
        if _has_binary(data_type.valueType):
            decoded = F.transform_values(decoded, lambda _, v: bytes_to_text(v, data_type.valueType))
        if _has_binary(data_type.keyType):
            decoded = F.transform_keys(decoded, lambda k, _: bytes_to_text(k, data_type.keyType))
        return decoded
    fields = [bytes_to_text(column[f.name], f.dataType).alias(f.name) for f in data_type.fields]
    return F.when(column.isNotNull(), F.struct(*fields))


def _has_binary(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.BinaryType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_binary(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _has_binary(data_type.keyType) or _has_binary(data_type.valueType)
    if isinstance(data_type, T.StructType):
        return any(_has_binary(f.dataType) for f in data_type.fields)
    return False


def as_json(column: Column, data_type: T.DataType) -> Column:
    """JSON text of a value whose bytes are shown as text, not base64."""
    return F.to_json(bytes_to_text(column, data_type), {"ignoreNullFields": "false"})


def body_text(column: Column, data_type: T.DataType) -> Column:
    """Message payload as text."""
    return utf8(column) if isinstance(data_type, T.BinaryType) else column.cast("string")


def mask_secret(column: Column) -> Column:
    """``***`` and the last four characters; short secrets are hidden whole."""
    return F.when(F.length(column) > 4, F.concat(F.lit("***"), F.right(column, F.lit(4)))).otherwise("***")


def mask_connection(column: Column, parameter: str = "token") -> Column:
    """Connection text with everything after the first ``?`` replaced by a starred token."""
    return F.concat(F.substring_index(column, "?", 1), F.lit(f"?{parameter}=***"))


def truncated(column: Column, length: int) -> Column:
    """First characters, for audit columns only."""
    return F.substring(column, 1, length)


def error_signature(error_type: Column, message: Column) -> Column:
    """Error type and the first 100 characters of its message."""
    return F.concat(error_type, F.lit(":"), truncated(message, 100))


def channel_name(hub: Column, client: Column, environment: str = "dev", region: str = "default") -> Column:
    """``hub-environment-region-client`` (P10)."""
    return F.concat(hub, F.lit(f"-{environment}-{region}-"), client)


def channel_label(namespace: Column, hub: Column) -> Column:
    """``namespace/hub``."""
    return F.concat(namespace, F.lit("/"), hub)


def mapping_label(source: Column, target: Column) -> Column:
    """``source->target``."""
    return F.concat(source, F.lit("->"), target)
