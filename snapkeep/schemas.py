"""Record schemas: the fixed topic envelope, and entity schemas given by the caller."""

from __future__ import annotations

import json
import os

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType, "boolean": T.BooleanType, "date": T.DateType,
    "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType,
    "int": T.IntegerType, "bigint": T.LongType, "double": T.DoubleType, "binary": T.BinaryType,
}


def struct(spec: str) -> T.StructType:
    """``"a string, b bigint"`` -> StructType of nullable flat fields (no session needed)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ.lower()]()))
    return T.StructType(fields)


# Fixed schema of a message-topic batch read (the connector's envelope).
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def load_schema(text_or_path: str) -> T.StructType:
    """A record schema from a DDL string, or from a file holding DDL or the
    JSON form of a StructType; every field of it is landed."""
    text = text_or_path
    if os.path.exists(text_or_path):
        with open(text_or_path, encoding="utf-8") as f:
            text = f.read()
    text = text.strip()
    if text.startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    return T.StructType.fromDDL(" ".join(text.split()))
