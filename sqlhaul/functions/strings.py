"""Column expressions that turn any Spark type into text for an all-string target.

All of these are built-in JVM expressions, so a stringify projection stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_time(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_time(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_time(dtype.keyType) or _has_time(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_has_time(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def _exact(col: Column, dtype: T.DataType) -> Column:
    """Nested timestamps as text: ``to_json`` would cut them to milliseconds."""
    if not _has_time(dtype):
        return col
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _exact(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(_exact(e["key"], dtype.keyType).alias("key"), _exact(e["value"], dtype.valueType).alias("value")),
        )
        return F.map_from_entries(entries)
    if isinstance(dtype, T.StructType):
        fields = [_exact(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    return col.cast("string")


def as_text(name: str, dtype: T.DataType) -> Column:
    """Text form of one column; nulls stay null.

    * atomic types, dates and timestamps: ``CAST(x AS STRING)`` (timestamps keep
      microseconds, unlike Spark's CSV writer, which cuts to milliseconds);
    * arrays, maps, structs: ``to_json`` with null fields and nested
      timestamps' microseconds kept (a CSV sink refuses them otherwise);
    * variant: its JSON text;
    * binary: base64.
    """
    col = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(dtype, T.StringType):
        out = col
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        out = F.to_json(_exact(col, dtype), {"ignoreNullFields": "false"})
    elif isinstance(dtype, T.BinaryType):
        out = F.base64(col)
    else:
        out = col.cast("string")
    return out.alias(name)
