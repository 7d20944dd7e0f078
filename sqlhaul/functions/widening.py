"""The narrowest type that holds the values of several."""

from __future__ import annotations

from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of ``a`` and ``b`` without loss where there
    is one (whole numbers, decimals of up to 38 digits, float in double, date in
    timestamp); text otherwise."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    exact = (*_WHOLE, T.DecimalType)
    if isinstance(a, exact) and isinstance(b, exact):
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    # a double holds a float and whole numbers of up to 53 bits
    small = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
    if isinstance(a, small) and isinstance(b, small):
        return T.DoubleType()
    if {type(a), type(b)} in ({T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}):
        return b if isinstance(a, T.DateType) else a
    return T.StringType()


def widest(schemas: list[T.StructType]) -> T.StructType:
    """One schema for all, in the order of the first; all have its names."""
    out = []
    for f in schemas[0].fields:
        kind = f.dataType
        for s in schemas[1:]:
            kind = wider(kind, s[f.name].dataType)
        out.append(T.StructField(f.name, kind, True))
    return T.StructType(out)
