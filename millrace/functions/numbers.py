"""Tests and clean-up for double values, and exact sums of declared decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INFINITY = float("inf")


def is_infinite(value: Column) -> Column:
    """True for both infinities. NaN sorts above infinity in Spark, so this compares for equality."""
    return F.abs(value) == F.lit(INFINITY)


def is_negative_zero(value: Column) -> Column:
    return (value == F.lit(0.0)) & (value.cast("string") == F.lit("-0.0"))


def normalize_zero(value: Column, data_type: T.DataType) -> Column:
    """-0.0 becomes 0.0 in a double or in the doubles nested inside a value."""
    if isinstance(data_type, T.DoubleType):
        return value + F.lit(0.0)
    if isinstance(data_type, T.StructType) and has_double(data_type):
        fields = [normalize_zero(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType) and has_double(data_type):
        return F.transform(value, lambda item: normalize_zero(item, data_type.elementType))
    return value


def has_double(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(has_double(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return has_double(data_type.elementType)
    return isinstance(data_type, T.DoubleType)


SCALE = 9
UNIT = 10**SCALE


def billionths(value: Column) -> Column:
    """A DECIMAL(38,9) as a whole number of billionths.

    Spark cuts decimals when the digits of a sum or product could be more than 38, whatever the
    values are; whole numbers of 38 digits are cut nowhere and give NULL when they do not fit.
    """
    whole = F.floor(value).cast("decimal(38,0)")
    part = (F.pmod(value, F.lit(1).cast("decimal(1,0)")) * F.lit(UNIT).cast("decimal(10,0)")).cast("decimal(10,0)")
    return F.try_add(F.try_multiply(whole, F.lit(UNIT).cast("decimal(10,0)")).cast("decimal(38,0)"), part).cast("decimal(38,0)")


def with_decimal(frame: DataFrame, name: str, number: Column) -> DataFrame:
    """The frame with the DECIMAL(38,9) of a whole number of billionths as a column.

    It is put together as text. What is used more than once on the way is a column of its own: Spark
    computes such a column once a row, while a nested expression is computed wherever it stands.
    """
    counted, digits = f"{name}_billionths", f"{name}_digits"
    frame = frame.withColumn(counted, number)
    frame = frame.withColumn(digits, F.lpad(F.abs(counted).cast("string"), 38, "0"))
    sign = F.when(F.col(counted) < 0, "-").otherwise("")
    text = F.concat(sign, F.substring(digits, 1, 38 - SCALE), F.lit("."), F.substring(digits, 39 - SCALE, SCALE))
    return frame.withColumn(name, text.try_cast("decimal(38,9)")).drop(counted, digits)
