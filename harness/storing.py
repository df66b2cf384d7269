"""Landing of every feed from files, and the partitioned and clustered table writers.

Each query writes the whole driver table in the feed's own format to a new folder under the shared
scratch folder, and lands it from there. The feed columns are filled by type, the same way for every
feed, so that one rule gives the feed, and one gives its oracle.
"""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.tables import MICRO, SECOND, money, raw_shaped, second_text, shaped, table, text
from millrace.contracts import RAW, STAGING, Contract
from millrace.functions.types import text_type
from millrace.operators.layout import read_table, stored_table, write_table
from millrace.session import scratch_path
from millrace.sources.landing import LANDERS
from millrace.sources.readers import FIELD_SEPARATOR, ITEM_SEPARATOR, PART_SEPARATOR

# By simple type: the value written to the feed, how a query shows it, and the same in SQL.
WRITTEN = {
    "string": lambda i: F.concat(F.col("event_type"), F.lit(f" {i}")),
    "bigint": lambda i: F.col("event_id") + i,
    "boolean": lambda i: F.col("value") > 100,
    "double": lambda i: F.col("value"),
    "decimal(38,9)": lambda i: F.col("value").cast("decimal(12,2)"),
    "timestamp": lambda i: F.col("ts"),
    "date": lambda i: F.to_date("ts"),
    "variant": lambda i: F.create_map(F.lit("kind"), F.col("event_type")),
}
SHOWN = {
    "string": F.col,
    "bigint": F.col,
    "boolean": F.col,
    "double": F.col,
    "decimal(38,9)": money,
    "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "date": text,
    "variant": lambda c: F.try_variant_get(c, "$.kind", "string"),
}
EXPECTED = {
    "string": "event_type || ' {i}'",
    "bigint": "event_id + {i}",
    "boolean": "value > 100",
    "double": "value",
    "decimal(38,9)": "CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)",
    "timestamp": f"strftime(ts, {MICRO})",
    "date": "strftime(ts, '%Y-%m-%d')",
    "variant": "event_type",
}

# How the folder columns of a feed are written, and what the partition key must come to in SQL.
FOLDERS = {
    "hour_text": {"date_ts": lambda: F.date_format("ts", "yyyyMMdd")},
    "date_parts": {
        "year": lambda: F.date_format("ts", "yyyy"),
        "month": lambda: F.date_format("ts", "MM"),
        "day": lambda: F.date_format("ts", "dd"),
    },
    "month_parts": {},
    "date_text": {},
    "date_and_hour": {
        "event_date": lambda: F.date_format("ts", "yyyyMMdd"),
        "hour_bucket": lambda: F.when(F.hour("ts") < 12, "0").otherwise("12"),
    },
    "native": {"snapshot_date": lambda: F.date_format("ts", "yyyy-MM-dd")},
}
DAY = f"strftime(date_trunc('day', ts), {MICRO})"
KEYS = {
    "hour_text": DAY,
    "date_parts": EXPECTED["date"],
    "month_parts": "'2024-01-01'",
    "date_and_hour": f"strftime(date_trunc('day', ts) + INTERVAL 12 HOUR * (hour(ts) // 12), {MICRO})",
    "native": EXPECTED["date"],
}
PROMOTED = ("carrier_partition", "warehouse_id_partition")


def _kind(data_type: T.DataType) -> str:
    return data_type.simpleString()


def _feed_value(field: T.StructField, i: int) -> Column:
    data_type = field.dataType
    if isinstance(data_type, T.StructType):
        return F.struct(*[_feed_value(f, i).alias(f.name) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return F.array(_feed_value(T.StructField("item", data_type.elementType), i))
    return WRITTEN[_kind(data_type)](i)


def _leaves(contract: Contract) -> list[tuple[str, str, str, int]]:
    """(output name, path in the landed row, type, position) of every leaf."""
    found = []
    for i, field in enumerate(contract.schema.fields):
        data_type, path = field.dataType, field.name
        if isinstance(data_type, T.ArrayType):
            data_type, path = data_type.elementType, f"{path}[0]"
        if isinstance(data_type, T.StructType):
            for part in data_type.fields:
                leaf = f"{field.name}_{part.name}"
                found.append((leaf, f"{path}.{part.name}", _kind(part.dataType), i))
        else:
            found.append((field.name, path, _kind(data_type), i))
    return found


def feed_frame(spark: SparkSession, sf_dir: str, contract: Contract) -> DataFrame:
    """The feed's columns and folder columns from ``events``, as the feed would carry them."""
    events = table(spark, sf_dir, "events")
    position = {name: i for i, name in enumerate(contract.names)}
    data = [_feed_value(f, position[f.name]).alias(f.name) for f in contract.delivered_columns.fields]
    folders = [value().alias(name) for name, value in FOLDERS[contract.feed.rule].items()]
    promoted = [F.col("event_type").alias(n) for n in contract.feed.delivered if n in PROMOTED]
    return events.select(*data, *folders, *promoted)


def _as_text(frame: DataFrame, contract: Contract) -> DataFrame:
    """Data columns in the text form of the declared type."""
    wanted = {f.name: f.dataType for f in text_type(contract.delivered_columns).fields}
    return frame.select(
        *[
            _micro(frame, name).alias(name) if name in wanted else F.col(name)
            for name in frame.columns
        ]
    )


def _micro(frame: DataFrame, name: str) -> Column:
    if isinstance(frame.schema[name].dataType, T.TimestampType):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.col(name)


def _write_feed(frame: DataFrame, contract: Contract, path: str) -> None:
    folders = [c for c in frame.columns if c in contract.feed.delivered]
    data = [c for c in frame.columns if c not in folders]
    file_format = contract.feed.format
    if file_format == "parquet":
        frame.write.partitionBy(*folders).parquet(path)
        return
    frame = _as_text(frame, contract)
    if file_format in ("csv", "tsv"):
        sep = "\t" if file_format == "tsv" else ","
        frame.write.partitionBy(*folders).csv(path, sep=sep, nullValue="\\N")
    elif file_format == "json":
        frame.write.partitionBy(*folders).json(path)
    elif file_format == "regex":
        line = F.concat_ws("|", *data).alias("value")
        frame.select(line, *folders).write.partitionBy(*folders).text(path)
    elif file_format == "sequence":
        lines = frame.select(_sequence_line(frame, data).alias("line"))
        lines.rdd.map(lambda row: (None, row[0])).saveAsSequenceFile(path)
    else:
        raise ValueError(f"no writer for {file_format}")


def _joined_item(item: Column, fields: list[str]) -> Column:
    return F.concat_ws(PART_SEPARATOR, *[item[f].cast("string") for f in fields])


def _sequence_line(frame: DataFrame, data: list[str]) -> Column:
    parts = []
    for name in data:
        data_type = frame.schema[name].dataType
        if isinstance(data_type, T.ArrayType):
            fields = data_type.elementType.fieldNames()
            items = F.transform(name, lambda item: _joined_item(item, fields))
            parts.append(F.array_join(items, ITEM_SEPARATOR))
        else:
            parts.append(text(name))
    return F.concat_ws(FIELD_SEPARATOR, *parts)


def land(feed: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = RAW[feed]
    path = scratch_path(spark, f"land_{feed}")
    _write_feed(feed_frame(spark, sf_dir, contract), contract, path)
    values = {"feed_year": "2024", "feed_month": "1"} if feed == "supplier_invoices" else None
    landed = LANDERS[feed](spark, path, values).rows
    leaves = landed.select(*[F.expr(path).alias(name) for name, path, _, _ in _leaves(contract)])
    return leaves.select(*[SHOWN[kind](name).alias(name) for name, _, kind, _ in _leaves(contract)])


def land_oracle(feed: str) -> str:
    contract = RAW[feed]
    columns = []
    for name, _, kind, i in _leaves(contract):
        if name == contract.key.column:
            sql = KEYS[contract.feed.rule]
        elif name in PROMOTED:
            sql = "event_type"
        else:
            sql = EXPECTED[kind].format(i=i)
        columns.append(f"{sql} AS {name}")
    return f"SELECT {', '.join(columns)} FROM events"


# Avro has no writer in a plain Spark build, and RCFile needs a catalog with Hive support: the tests
# cover those feeds.
LANDED = [name for name, c in RAW.items() if c.feed.format not in ("avro", "rcfile")]


# Writers: the table is written, read back through its contract, and summed per stored partition.


def events_as_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_shaped(
        table(spark, sf_dir, "events"),
        "mobile_events",
        event_id=text("event_id"),
        event_ts=F.col("ts"),
        user_id=text("user_id"),
        platform=F.col("event_type"),
        properties=F.try_parse_json("props"),
        event_timestamp=F.date_trunc("HOUR", "ts"),
    )


def _per_partition(spark: SparkSession, path: str, contract: Contract, *measures: Column) -> DataFrame:
    return stored_table(spark, path, contract).groupBy(F.col("_p").alias("stored_under")).agg(
        F.count(F.lit(1)).alias("row_count"), *measures
    )


def write_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = RAW["pos_transactions"], scratch_path(spark, "write_hour")
    sales = raw_shaped(
        table(spark, sf_dir, "events"),
        "pos_transactions",
        txn_id=F.col("event_id"),
        gross_amount=F.col("value").cast("decimal(12,2)"),
        partition_ts=F.date_trunc("HOUR", "ts"),
    )
    write_table(sales, path, contract)
    return _per_partition(spark, path, contract, money(F.sum("gross_amount")).alias("amount"))


def write_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = RAW["mobile_events"], scratch_path(spark, "write_cluster")
    write_table(events_as_app(spark, sf_dir), path, contract)
    kinds = F.countDistinct("platform").alias("platforms")
    marks = F.sum(F.try_variant_get("properties", "$.k", "bigint")).alias("k_sum")
    return _per_partition(spark, path, contract, kinds, marks)


def write_cluster_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = STAGING["dedup_clickstream"], scratch_path(spark, "write_cluster_two")
    clicks = shaped(
        table(spark, sf_dir, "events"),
        contract,
        session_id=text("event_id"),
        user_id=text("user_id"),
        event_ts=F.col("ts"),
        country_partition=F.upper("event_type"),
        event_date=F.to_date("ts"),
    )
    write_table(clicks, path, contract)
    read = read_table(spark, path, contract)
    return read.groupBy(text("event_date").alias("event_date"), "country_partition", "user_id").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def write_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = RAW["fraud_signals"], scratch_path(spark, "write_day")
    signals = raw_shaped(
        table(spark, sf_dir, "events"),
        "fraud_signals",
        customer_id=text("user_id"),
        score=F.when(F.col("event_type") == "signup", F.lit("-0.0").cast("double")).otherwise(F.col("value")),
        reason_codes=F.array("event_type"),
        signal_ts=F.col("ts"),
    )
    write_table(signals, path, contract)
    # Other events may have the value zero from the start.
    written_negative = F.array_contains("reason_codes", "signup")
    zeros = F.count_if(written_negative & (F.col("score").cast("string") == "0.0")).alias("plain_zeros")
    return _per_partition(spark, path, contract, zeros)


def _invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_shaped(
        table(spark, sf_dir, "orders"),
        "supplier_invoices",
        invoice_no=text("o_orderkey"),
        supplier_id=text("o_custkey"),
        total_amount=F.col("o_totalprice").cast("decimal(14,2)"),
        feed_date=F.trunc("o_orderdate", "MONTH"),
    )


def write_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = RAW["supplier_invoices"], scratch_path(spark, "write_month")
    write_table(_invoices(spark, sf_dir), path, contract)
    return _per_partition(spark, path, contract, money(F.sum("total_amount")).alias("amount"))


def write_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = RAW["returns_cdc"], scratch_path(spark, "write_date")
    changes = raw_shaped(
        table(spark, sf_dir, "events"),
        "returns_cdc",
        return_id=F.col("event_id"),
        op=F.col("event_type"),
        snapshot_date=F.to_date("ts"),
    )
    write_table(changes, path, contract)
    read = read_table(spark, path, contract)
    return read.groupBy(text("snapshot_date").alias("snapshot_date"), "op").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def write_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load everything, then load the months of 1996 again with other amounts."""
    contract, path = RAW["supplier_invoices"], scratch_path(spark, "write_partitions")
    invoices = _invoices(spark, sf_dir)
    write_table(invoices, path, contract)
    again = invoices.where(F.year("feed_date") == 1996).withColumn("total_amount", F.lit(1).cast("decimal(38,9)"))
    write_table(again, path, contract, mode="partitions")
    return _per_partition(spark, path, contract, money(F.sum("total_amount")).alias("amount"))


def read_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of hours read back, with the bounds on both the key and the stored partition."""
    contract, path = RAW["mobile_events"], scratch_path(spark, "read_pruned")
    write_table(events_as_app(spark, sf_dir), path, contract)
    read = read_table(spark, path, contract, datetime(2024, 1, 5, 6), datetime(2024, 1, 9))
    return read.select("event_id", "user_id", "platform", second_text("event_timestamp").alias("event_timestamp"))


QUERIES = {f"land_{feed}": partial(land, feed) for feed in LANDED}
QUERIES |= {
    f.__name__: f
    for f in (
        write_hour, write_day, write_month, write_date, write_cluster, write_cluster_two,
        write_partitions, read_pruned,
    )
}

ORACLES = {f"land_{feed}": land_oracle(feed) for feed in LANDED}
ORACLES |= {
    "write_hour": """
        SELECT strftime(ts, '%Y%m%d%H') AS stored_under, count(*) AS row_count,
               CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS amount
        FROM events GROUP BY ALL""",
    "write_day": """
        SELECT strftime(ts, '%Y%m%d') AS stored_under, count(*) AS row_count,
               count(*) FILTER (WHERE event_type = 'signup') AS plain_zeros
        FROM events GROUP BY ALL""",
    "write_month": """
        SELECT strftime(o_orderdate, '%Y%m') AS stored_under, count(*) AS row_count,
               CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS amount
        FROM orders GROUP BY ALL""",
    "write_date": """
        SELECT strftime(ts, '%Y-%m-%d') AS snapshot_date, event_type AS op, count(*) AS row_count
        FROM events GROUP BY ALL""",
    "write_cluster": """
        SELECT strftime(ts, '%Y%m%d%H') AS stored_under, count(*) AS row_count,
               count(DISTINCT event_type) AS platforms,
               CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
        FROM events GROUP BY ALL""",
    "write_cluster_two": """
        SELECT strftime(ts, '%Y-%m-%d') AS event_date, upper(event_type) AS country_partition,
               CAST(user_id AS VARCHAR) AS user_id, count(*) AS row_count
        FROM events GROUP BY ALL""",
    "write_partitions": """
        SELECT strftime(o_orderdate, '%Y%m') AS stored_under, count(*) AS row_count,
               CAST(sum(CASE WHEN year(o_orderdate) = 1996 THEN 1
                        ELSE CAST(o_totalprice AS DECIMAL(14,2)) END) AS DOUBLE) AS amount
        FROM orders GROUP BY ALL""",
    "read_pruned": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               event_type AS platform, strftime(date_trunc('hour', ts), {SECOND}) AS event_timestamp
        FROM events
        WHERE date_trunc('hour', ts) >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09'""",
}
