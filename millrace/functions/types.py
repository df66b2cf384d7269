"""Mapping of feed types to declared types, and casts that never fail a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)

# Feed type -> declared type.
SCALARS = {
    T.StringType: T.StringType(),
    T.ByteType: T.LongType(),
    T.ShortType: T.LongType(),
    T.IntegerType: T.LongType(),
    T.LongType: T.LongType(),
    T.BooleanType: T.BooleanType(),
    T.FloatType: T.DoubleType(),
    T.DoubleType: T.DoubleType(),
    T.DateType: T.DateType(),
    T.TimestampType: T.TimestampType(),
    T.TimestampNTZType: T.TimestampType(),
    T.DecimalType: NUMERIC,
    T.VariantType: T.VariantType(),
}


class UnmappedType(TypeError):
    """A feed type that has no declared counterpart."""


def declared_type(feed_type: T.DataType) -> T.DataType:
    """The declared type of a feed type, through structs and arrays."""
    if isinstance(feed_type, T.MapType):
        if feed_type.keyType != T.StringType():
            raise UnmappedType(f"map key must be a string: {feed_type.simpleString()}")
        return T.VariantType()
    if isinstance(feed_type, T.StructType):
        return T.StructType([T.StructField(f.name, declared_type(f.dataType)) for f in feed_type.fields])
    if isinstance(feed_type, T.ArrayType):
        return T.ArrayType(declared_type(feed_type.elementType))
    try:
        return SCALARS[type(feed_type)]
    except KeyError:
        raise UnmappedType(feed_type.simpleString()) from None


def text_type(declared: T.DataType) -> T.DataType:
    """The shape of a declared type with every leaf read as text.

    Text feeds are read this way, so that one bad value leaves its neighbours readable. A
    semi-structured value is read as a map of text.
    """
    if isinstance(declared, T.StructType):
        return T.StructType([T.StructField(f.name, text_type(f.dataType)) for f in declared.fields])
    if isinstance(declared, T.ArrayType):
        return T.ArrayType(text_type(declared.elementType))
    if isinstance(declared, T.VariantType):
        return T.MapType(T.StringType(), T.StringType())
    return T.StringType()


def to_variant(value: Column, feed_type: T.DataType) -> Column:
    """A map becomes a semi-structured object, NULL when it has a key twice; text is parsed as JSON,
    NULL when it is not JSON."""
    if isinstance(feed_type, T.VariantType):
        return value
    if isinstance(feed_type, T.StringType):
        return F.try_parse_json(value)
    return F.when(_distinct_keys(value, feed_type), F.to_variant_object(value))


def _distinct_keys(value: Column, feed_type: T.DataType) -> Column:
    """False where a map inside the value has a key twice, which no object can have."""
    if isinstance(feed_type, T.MapType):
        keys = F.map_keys(value)
        distinct = F.size(keys) == F.size(F.array_distinct(keys))
        inner = F.forall(F.map_values(value), lambda item: _distinct_keys(item, feed_type.valueType))
        return F.coalesce(distinct & inner, F.lit(True))
    if isinstance(feed_type, T.ArrayType):
        return F.coalesce(F.forall(value, lambda item: _distinct_keys(item, feed_type.elementType)), F.lit(True))
    if isinstance(feed_type, T.StructType):
        fields = [_distinct_keys(value[f.name], f.dataType) for f in feed_type.fields]
        return _all(fields)
    return F.lit(True)


def _all(parts: list[Column]) -> Column:
    result = F.lit(True)
    for part in parts:
        result = result & part
    return result


def cast_to(value: Column, feed_type: T.DataType, declared: T.DataType) -> Column:
    """``value`` in its declared type; a leaf that does not fit becomes NULL, its neighbours stay.

    Struct fields are matched by name. Spark's own cast matches them by position, so it is used only
    where the names are the same in the same order.
    """
    if feed_type == declared:
        return value
    if isinstance(declared, T.VariantType):
        return to_variant(value, feed_type)
    if _same_names(feed_type, declared):
        return value.try_cast(declared)
    if isinstance(declared, T.ArrayType):
        return F.transform(value, lambda item: cast_to(item, feed_type.elementType, declared.elementType))
    delivered = _field_types(feed_type)
    fields = [
        cast_to(value[f.name], delivered[f.name], f.dataType)
        if f.name in delivered
        else F.lit(None).cast(f.dataType)
        for f in declared.fields
    ]
    named = [c.alias(f.name) for c, f in zip(fields, declared.fields)]
    return F.when(value.isNotNull(), F.struct(*named))


def _field_types(struct: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in struct.fields}


def _same_names(feed_type: T.DataType, declared: T.DataType) -> bool:
    """Whether a positional cast is right: equal field names throughout, and no nested map."""
    if isinstance(declared, T.StructType) and isinstance(feed_type, T.StructType):
        if feed_type.fieldNames() != declared.fieldNames():
            return False
        return all(_same_names(a.dataType, b.dataType) for a, b in zip(feed_type.fields, declared.fields))
    if isinstance(declared, T.ArrayType) and isinstance(feed_type, T.ArrayType):
        return _same_names(feed_type.elementType, declared.elementType)
    return not isinstance(declared, T.VariantType)


def cast_failed(value: Column, cast: Column, feed_type: T.DataType, declared: T.DataType) -> Column | None:
    """True where a value was present before the cast and is NULL after it, at any depth.

    Returns None when the cast cannot fail.
    """
    if feed_type == declared or isinstance(declared, T.StringType):
        return None
    if isinstance(declared, T.StructType):
        delivered = _field_types(feed_type)
        parts = [
            cast_failed(value[f.name], cast[f.name], delivered[f.name], f.dataType)
            for f in declared.fields
            if f.name in delivered
        ]
        parts = [p for p in parts if p is not None]
        return F.coalesce(_any(parts), F.lit(False)) if parts else None
    if isinstance(declared, T.ArrayType):

        def item_failed(before: Column, after: Column) -> Column | None:
            return cast_failed(before, after, feed_type.elementType, declared.elementType)

        if item_failed(F.lit(None), F.lit(None)) is None:
            return None
        failures = F.zip_with(value, cast, item_failed)
        return F.coalesce(F.exists(failures, lambda failed: failed), F.lit(False))
    return value.isNotNull() & cast.isNull()


def _any(parts: list[Column]) -> Column:
    result = parts[0]
    for part in parts[1:]:
        result = result | part
    return result
