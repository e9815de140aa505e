"""Schema reconciliation: the one type that holds a table's old and new data.

Fields are matched by name, without case, at any depth of structs, arrays and
maps. A field that only one side has stays (its values are NULL on the other).
Types widen along the conversions that Parquet and ORC readers can also make
when they read an old file under the new type: byte, short, int, long; float
or int to double; a decimal to one with room for both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def reconcile(old: T.DataType, new: T.DataType, widen: bool = True, at: str = "") -> T.DataType:
    """The type that holds both; ``old`` where they are equal. Without
    ``widen`` only fields may differ. ValueError if there is none."""
    if old == new:
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        theirs = {f.name.lower(): f for f in new.fields}
        mine = {f.name.lower() for f in old.fields}
        fields = []
        for f in old.fields:
            other = theirs.get(f.name.lower())
            kind = f.dataType if other is None else reconcile(f.dataType, other.dataType, widen, f"{at}.{f.name}".lstrip("."))
            fields.append(T.StructField(f.name, kind, True, f.metadata))
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in new.fields if f.name.lower() not in mine])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(reconcile(old.elementType, new.elementType, widen, f"{at}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        # Keys decide what is the same entry, so they keep their type.
        key = reconcile(old.keyType, new.keyType, False, f"{at}.key")
        return T.MapType(key, reconcile(old.valueType, new.valueType, widen, f"{at}.value"), True)
    wide = _wider(old, new) if widen else None
    if wide is None:
        raise ValueError(f"{at}: {old.simpleString()} in the table, {new.simpleString()} in the data")
    return wide


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    small = (T.FloatType, T.ByteType, T.ShortType, T.IntegerType)  # a double holds all their values
    if isinstance(a, (*small, T.DoubleType)) and isinstance(b, (*small, T.DoubleType)) and T.DoubleType in (type(a), type(b)):
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def fit(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of type ``have`` as ``want``, which ``reconcile`` gave: fields
    by name, missing ones NULL, a NULL struct stays NULL."""
    if have == want:
        return column
    if isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            mine = own.get(f.name.lower())
            value = F.lit(None).cast(f.dataType) if mine is None else fit(column.getField(mine.name), mine.dataType, f.dataType)
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: fit(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(column, lambda _, v: fit(v, have.valueType, want.valueType))
    return column.cast(want)
