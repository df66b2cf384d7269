"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def total_order(
    df: DataFrame, first: list[Column], known: list[str], descending: bool = True
) -> list[Column]:
    """``first``, then every other column that can be ordered, so that ties cannot depend on how
    rows happen to be spread over tasks. ``known`` are columns that cannot break a tie: those in
    ``first`` and the key itself."""
    rest: list[Column] = []
    for field in df.schema.fields:
        if field.name in known:
            continue
        if isinstance(field.dataType, T.VariantType):
            rest.append(F.to_json(F.col(field.name)))
        elif _orderable(field.dataType):
            rest.append(F.col(field.name))
    return [*first, *[c.desc_nulls_last() if descending else c.asc_nulls_first() for c in rest]]


def first_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key.

    Spark keeps only the first row per key in each input task before the shuffle, so a key with
    very many rows sends one row per task, not its whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def has_key(keys: list[str]) -> Column:
    """True where every column of the key is present."""
    present = F.col(keys[0]).isNotNull()
    for name in keys[1:]:
        present = present & F.col(name).isNotNull()
    return present


def without_key(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows that cannot be told apart by their key, in the form of the quarantine."""
    missing = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))
    return df.where(~has_key(keys)).select(
        F.lit(table).alias("table_name"),
        missing.alias("failed_columns"),
        F.to_json(F.struct(*df.columns)).alias("original"),
    )


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """The newest row of each key, by the given columns and then by all others.

    Rows without a key are not versions of one another and must be split off before.
    """
    order = total_order(df, [F.col(c).desc_nulls_last() for c in newest_first], [*newest_first, *keys])
    return first_per_key(df, [F.col(k) for k in keys], order)


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (T.VariantType, T.MapType))
