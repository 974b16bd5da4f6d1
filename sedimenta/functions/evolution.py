"""One schema for two that differ, at any depth, and the casts that bring either side to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
)

# Whole-number types, the narrowest first, and the digits each needs.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_KINDS = list(_WHOLE)
# The whole numbers that a fraction type holds without loss.
_EXACT_IN = {FloatType: (ByteType, ShortType), DoubleType: (ByteType, ShortType, IntegerType)}
_MOST_DIGITS = 38


def merged_type(older: DataType, newer: DataType, name: str = "") -> DataType:
    """The type that holds every value of both, digits included.

    Structs get the fields of both (names compare without case, the older side's
    spelling and order first), arrays and maps merge what they hold, whole numbers widen to
    the wider one or to a decimal or fraction that holds them, decimals to enough digits on both
    sides of the point.  Types without a common one are refused with the field's full name.
    """
    if older == newer or isinstance(newer, NullType):
        return older
    if isinstance(older, NullType):
        return newer
    if isinstance(older, StructType) and isinstance(newer, StructType):
        return _merged_struct(older, newer, name)
    if isinstance(older, ArrayType) and isinstance(newer, ArrayType):
        inner = merged_type(older.elementType, newer.elementType, f"{name}[]")
        return ArrayType(inner, older.containsNull or newer.containsNull)
    if isinstance(older, MapType) and isinstance(newer, MapType):
        return MapType(
            merged_type(older.keyType, newer.keyType, f"{name} key"),
            merged_type(older.valueType, newer.valueType, f"{name}{{}}"),
            older.valueContainsNull or newer.valueContainsNull,
        )
    found = _wider(older, newer)
    if found is None:
        raise TypeError(f"{name or 'the value'}: {older.simpleString()} and {newer.simpleString()} have no common type")
    return found


def _merged_struct(older: StructType, newer: StructType, name: str) -> StructType:
    theirs = {f.name.lower(): f for f in newer.fields}
    if len(theirs) < len(newer.fields) or len({f.name.lower() for f in older.fields}) < len(older.fields):
        raise TypeError(f"{name or 'the row'}: fields that differ in case only")
    fields = []
    for f in older.fields:
        other = theirs.pop(f.name.lower(), None)
        inner = f"{name}.{f.name}".lstrip(".")
        kind = f.dataType if other is None else merged_type(f.dataType, other.dataType, inner)
        fields.append(StructField(f.name, kind, f.nullable or other is None or other.nullable))
    return StructType([*fields, *(StructField(f.name, f.dataType, True) for f in newer.fields if f.name.lower() in theirs)])


def _wider(a: DataType, b: DataType) -> DataType | None:
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max((a, b), key=lambda t: _KINDS.index(type(t)))
    if {type(a), type(b)} == {FloatType, DoubleType}:
        return DoubleType()
    for whole, other in ((a, b), (b, a)):
        if type(whole) in _WHOLE and type(other) in _EXACT_IN:
            if type(whole) in _EXACT_IN[type(other)]:
                return other
            return DoubleType() if type(whole) in _EXACT_IN[DoubleType] else None
    places = [(_WHOLE[type(t)], 0) if type(t) in _WHOLE else (t.precision - t.scale, t.scale) for t in (a, b) if type(t) in _WHOLE or isinstance(t, DecimalType)]
    if len(places) == 2:
        before, after = (max(p[i] for p in places) for i in (0, 1))
        return DecimalType(before + after, after) if before + after <= _MOST_DIGITS else None
    return None


def conformed(value: Column, have: DataType, want: DataType) -> Column:
    """A value of type ``have`` as one of ``want`` (made by :func:`merged_type`): fields it lacks are
    NULL, a NULL struct, array or map stays NULL."""
    if have == want:
        return value
    if isinstance(want, StructType) and isinstance(have, StructType):
        mine = {f.name.lower(): f for f in have.fields}

        def field(f: StructField) -> Column:
            own = mine.get(f.name.lower())
            made = F.lit(None).cast(f.dataType) if own is None else conformed(value.getField(own.name), own.dataType, f.dataType)
            return made.alias(f.name)

        return F.when(value.isNotNull(), F.struct(*[field(f) for f in want.fields]))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(value, lambda x: conformed(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        keyed = value
        if have.keyType != want.keyType:
            keyed = F.transform_keys(keyed, lambda k, _: conformed(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: conformed(v, have.valueType, want.valueType))
    return value.cast(want)


def _as(df: DataFrame, schema: StructType) -> DataFrame:
    mine = {f.name.lower(): f for f in df.schema.fields}

    def column(f: StructField) -> Column:
        own = mine.get(f.name.lower())
        if own is None:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return conformed(F.col("`" + own.name.replace("`", "``") + "`"), own.dataType, f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def aligned(older: DataFrame, newer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames in their merged schema, ready for a union, an upsert or a write."""
    schema = merged_type(older.schema, newer.schema)
    return _as(older, schema), _as(newer, schema)


def union_nested(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Union by name in the merged schema: built-in expressions on either side, no shuffle."""
    first, second = aligned(older, newer)
    return first.unionByName(second)
