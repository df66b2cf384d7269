"""Data checks that run next to the loads. Each returns a small report as a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Contract
from millrace.functions.numbers import is_infinite, is_negative_zero
from millrace.operators.conform import BAD_RECORD, FAILED, Landing
from millrace.operators.layout import (
    partition_column,
    partition_value,
    read_table,
    stored_table,
    write_table,
)
from millrace.session import written


def _long_form(wide: DataFrame, names: list[str], label: str, measures: list[str]) -> DataFrame:
    """One row of ``<measure>_<i>`` columns to one row per name."""
    rows = [
        F.struct(F.lit(name).alias(label), *[F.col(f"{m}_{i}").alias(m) for m in measures])
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows)))


def cast_report(landing: Landing) -> DataFrame:
    """Per declared column: rows, and rows whose value did not fit its type."""
    names = landing.contract.names
    failed = [F.count_if(F.array_contains(FAILED, n)).alias(f"failed_{i}") for i, n in enumerate(names)]
    rows = [F.count(F.lit(1)).alias("rows_0")]
    wide = landing.checked.agg(*rows, *failed)
    for i in range(1, len(names)):
        wide = wide.withColumn(f"rows_{i}", F.col("rows_0"))
    return _long_form(wide, names, "column_name", ["rows", "failed"])


def column_drift(feed: DataFrame, contract: Contract) -> DataFrame:
    """Columns the feed lacks and columns the contract does not know, with how many rows fill them."""
    expected = contract.delivered_columns.fieldNames() + list(contract.feed.delivered)
    expected = list(dict.fromkeys(expected))
    present = [c for c in feed.columns if c != BAD_RECORD]
    names = expected + [c for c in present if c not in expected]
    counts = [
        (F.count(F.col(n)) if n in present else F.lit(0).cast("bigint")).alias(f"filled_{i}")
        for i, n in enumerate(names)
    ]
    findings = [
        F.lit("missing" if n not in present else "declared" if n in expected else "unexpected").alias(
            f"finding_{i}"
        )
        for i, n in enumerate(names)
    ]
    wide = feed.agg(*counts).select("*", *findings)
    return _long_form(wide, names, "column_name", ["finding", "filled"])


def record_drift(feed: DataFrame, contract: Contract, by: list[str]) -> DataFrame:
    """Per load: records, records with too few, too many or unreadable fields, and among those the
    ones whose last field stayed empty, which is how short records show."""
    last = F.col(contract.delivered_columns.fieldNames()[-1])
    return feed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        F.count(BAD_RECORD).alias("malformed"),
        F.count_if(F.col(BAD_RECORD).isNotNull() & last.isNull()).alias("short"),
    )


def json_key_drift(lines: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Keys of JSON lines outside the contract, with the number of lines that carry them."""
    known = contract.delivered_columns.fieldNames()
    return (
        lines.select(F.explode(F.json_object_keys(value)).alias("key_name"))
        .where(~F.col("key_name").isin(known))
        .groupBy("key_name")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def json_key_drift_by_load(lines: DataFrame, contract: Contract, load: list[str], value: str = "value") -> DataFrame:
    """Per load and key: lines that carry a key outside the contract, one level of nesting included
    (``outer.inner``). Objects that the contract declares as semi-structured may hold any key."""
    declared = {f.name: f.dataType for f in contract.delivered_columns.fields}
    nested = {n: t.fieldNames() for n, t in declared.items() if isinstance(t, T.StructType)}
    known = [*declared, *[f"{n}.{part}" for n, parts in nested.items() for part in parts]]
    text = F.col(value)

    def keys(text: Column, prefix: str) -> Column:
        found = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
        return F.transform(found, lambda part: F.concat(F.lit(prefix), part))

    top = keys(text, "")
    inner = [keys(F.get_json_object(text, f"$.{name}"), f"{name}.") for name in nested]
    return (
        lines.select(*load, F.explode(F.array_distinct(F.concat(top, *inner))).alias("key_name"))
        .where(~F.col("key_name").isin(known))
        .groupBy(*load, "key_name")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def file_column_drift(parts: list[DataFrame], contract: Contract) -> DataFrame:
    """Columns that the files of a drop lack, have besides, or hold in another type than declared.

    ``parts`` are frames with the schemas the files have, such as single files or groups of files
    that agree; one row comes out per part and difference, with the part's rows.
    """
    declared = {f.name: f.dataType for f in contract.delivered_columns.fields}
    reports = []
    for number, part in enumerate(parts):
        own = {f.name: f.dataType for f in part.schema.fields if f.name not in contract.feed.delivered}
        found = [(n, "missing") for n in declared if n not in own]
        found += [(n, "added") for n in own if n not in declared]
        found += [(n, own[n].simpleString()) for n in own if n in declared and own[n] != declared[n]]
        rows = [F.struct(F.lit(n).alias("column_name"), F.lit(what).alias("difference")) for n, what in found]
        if rows:
            counted = part.groupBy().agg(F.count(F.lit(1)).alias("rows"))
            reports.append(counted.select(F.lit(number).alias("part"), F.inline(F.array(*rows)), "rows"))
    if not reports:
        schema = "part int, column_name string, difference string, rows bigint"
        return parts[0].sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, reports)


def key_report(stored: DataFrame, contract: Contract, expected: Column | None = None) -> DataFrame:
    """Per stored partition: rows, rows stored under another key than recomputed, NULL keys."""
    part = partition_column(contract.key)
    value = partition_value(contract.key) if expected is None else expected
    return stored.groupBy(F.col(part).cast("string").alias("partition_value")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col(part).eqNullSafe(value)).alias("misplaced"),
        F.count_if(F.col(contract.key.column).isNull()).alias("null_keys"),
    )


def cluster_report(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Per stored partition: files, and files whose range of the cluster columns overlaps an earlier
    file's. The columns are compared in their order, so files of one value in the first may be told apart
    by the next. Files touching in one value of all are not counted; a hot value may fill several."""
    part, ordered = partition_column(contract.key), F.struct(*contract.cluster)
    files = (
        stored_table(spark, path, contract)
        .groupBy(F.col(part).alias("_part"), F.col("_metadata.file_path").alias("_file"))
        .agg(F.min(ordered).alias("_low"), F.max(ordered).alias("_high"))
    )
    in_order = Window.partitionBy("_part").orderBy("_low", "_high", "_file")
    reached = F.max("_high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        files.withColumn("_overlap", F.col("_low") < reached)
        .groupBy(F.col("_part").cast("string").alias("partition_value"))
        .agg(F.count(F.lit(1)).alias("files"), F.count_if("_overlap").alias("overlapping"))
    )


def comparable(df: DataFrame) -> DataFrame:
    """Semi-structured and map columns as text, which can be grouped and hashed."""
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.VariantType, T.MapType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def parity_report(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Per key value: row counts and content sums of both sides, in one shuffle.

    The sums are decimals, because a sum of 64-bit hashes does not fit 64 bits.
    """
    columns = source.columns
    sides = []
    for side, df in (("source", source), ("target", target)):
        flat = comparable(df.select(*columns))
        # A hash over columns passes over NULLs, so each is hashed with a mark of whether it is one.
        hashed = F.xxhash64(*[v for c in columns for v in (F.col(c).isNull(), F.col(c))]).cast("decimal(20,0)")
        sides.append(
            flat.select(
                F.col(key).cast("string").alias("key_value"),
                F.lit(side == "source").alias("is_source"),
                hashed.alias("content"),
            )
        )
    both = sides[0].unionByName(sides[1])
    mine, theirs = F.col("is_source"), ~F.col("is_source")
    nothing = F.lit(0).cast("decimal(30,0)")
    report = both.groupBy("key_value").agg(
        F.count_if(mine).alias("source_rows"),
        F.count_if(theirs).alias("target_rows"),
        F.coalesce(F.sum(F.when(mine, F.col("content"))), nothing).alias("_source_sum"),
        F.coalesce(F.sum(F.when(theirs, F.col("content"))), nothing).alias("_target_sum"),
    )
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("_source_sum") == F.col("_target_sum"))
    return report.select("key_value", "source_rows", "target_rows", same.alias("passed"))


def row_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other, with both counts."""
    columns = source.columns
    sides = [
        comparable(df.select(*columns)).select("*", F.lit(n).cast("bigint").alias("_s"), F.lit(1 - n).cast("bigint").alias("_t"))
        for df, n in ((source, 1), (target, 0))
    ]
    return (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*columns)
        .agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"))
        .where(F.col("source_rows") != F.col("target_rows"))
    )


#: Buckets per key value, and differing buckets up to which their list is sent to all tasks.
PARTS, FEW = 1024, 100_000


def differing_buckets(source: DataFrame, target: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """(_key, _bucket) of the rows of both sides whose counts or content sums differ.

    Rows are dealt to buckets by their content, so equal rows of both sides meet; what is shuffled is a
    sum per bucket and task, not the rows. Two hashes with different seeds are summed.
    """
    sides = []
    for n, df in ((1, source), (-1, target)):
        rows = _bucketed(df.select(*source.columns), key, parts)
        sides.append(rows.select("_key", "_bucket", F.lit(n).alias("_n"), *[(F.col(h) * n).alias(h) for h in ("_h1", "_h2")]))
    sums = sides[0].unionByName(sides[1]).groupBy("_key", "_bucket").agg(*[F.sum(c).alias(c) for c in ("_n", "_h1", "_h2")])
    return sums.where((F.col("_n") != 0) | (F.col("_h1") != 0) | (F.col("_h2") != 0)).select("_key", "_bucket")


def _bucketed(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Comparable rows with their key value as text, bucket and hashes; each NULL is hashed with a mark."""
    flat = comparable(df)
    marked = [v for c in df.columns for v in (F.col(c).isNull(), F.col(c))]
    hashes = [F.xxhash64(F.lit(seed), *marked).cast("decimal(20,0)").alias(f"_h{seed}") for seed in (1, 2)]
    bucket = F.pmod(F.xxhash64(F.lit(3), *marked), F.lit(parts)).alias("_bucket")
    return flat.select("*", F.col(key).cast("string").alias("_key"), bucket, *hashes)


def row_differences_pruned(source: DataFrame, target: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """As ``row_differences``, but only rows of buckets that differ are shuffled.

    Both sides are read twice. The list of differing buckets is written; up to ``FEW`` of them it is sent to all
    tasks, so that rows of equal buckets go nowhere; beyond that most rows have to be compared anyway.
    """
    apart = written(differing_buckets(source, target, key, parts), "differing-buckets")
    if apart.count() > FEW:
        return row_differences(source, target)
    listed = F.broadcast(apart.withColumnsRenamed({"_key": "_k", "_bucket": "_b"}))
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_bucket") == F.col("_b"))
    columns = source.columns
    kept = [_bucketed(df.select(*columns), key, parts).join(listed, same, "left_semi").select(*columns) for df in (source, target)]
    return row_differences(*kept)


def round_trip_report(spark: SparkSession, df: DataFrame, path: str, contract: Contract) -> DataFrame:
    """Store rows, read them back, and compare both sides per key value."""
    declared = df.select(*contract.names)
    write_table(declared, path, contract)
    return parity_report(declared, read_table(spark, path, contract), contract.key.column)


def precision_profile(df: DataFrame, names: list[str], precision: int, scale: int) -> DataFrame:
    """Per decimal column: values, and values that a narrower DECIMAL(precision, scale) would change."""
    narrow = f"decimal({precision},{scale})"
    measures: list[Column] = []
    for i, name in enumerate(names):
        column = F.col(name)
        changed = column.isNotNull() & ~column.eqNullSafe(column.try_cast(narrow).cast(df.schema[name].dataType))
        measures += [F.count(column).alias(f"filled_{i}"), F.count_if(changed).alias(f"changed_{i}")]
    return _long_form(df.agg(*measures), names, "column_name", ["filled", "changed"])


def double_profile(df: DataFrame, names: list[str]) -> DataFrame:
    """Per double column: values, NaN, infinities and negative zeros."""
    measures: list[Column] = []
    for i, name in enumerate(names):
        column = F.col(name)
        measures += [
            F.count(column).alias(f"filled_{i}"),
            F.count_if(F.isnan(column)).alias(f"nan_{i}"),
            F.count_if(is_infinite(column)).alias(f"infinite_{i}"),
            F.count_if(is_negative_zero(column)).alias(f"negative_zero_{i}"),
        ]
    return _long_form(df.agg(*measures), names, "column_name", ["filled", "nan", "infinite", "negative_zero"])


def verdicts(report: DataFrame, check: str, passed: Column) -> DataFrame:
    """Any report reduced to (check_name, passed) rows."""
    return report.select(F.lit(check).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"))


def totals(reports: list[DataFrame]) -> DataFrame:
    """Passed and failed counts per check."""
    both = reduce(DataFrame.unionByName, reports)
    return both.groupBy("check_name").agg(
        F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed")
    )
