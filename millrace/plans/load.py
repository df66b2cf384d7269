"""Loading one drop of a feed into the warehouse."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import RAW, Contract
from millrace.operators.conform import DROP, ORIGINAL
from millrace.operators.layout import drop_folders, replace_folders, write_drops
from millrace.sources.landing import land
from millrace.sources.readers import Values


def table_path(warehouse: str, contract: Contract) -> str:
    return f"{warehouse.rstrip('/')}/{contract.layer}/{contract.name}"


def load_feed(
    spark: SparkSession,
    feed: str,
    path: str,
    warehouse: str,
    quarantine: str,
    partition_values: Values = None,
    **options,
) -> int:
    """Land a drop and replace all it brought before: its rows, in whichever partitions they lie, and
    its list of rows that did not fit. Returns how many those are. Other drops stay as they are, also
    those of the same hour or day.

    With no values given, all drops found in folders under ``path`` are loaded, each under its own
    name. Whether any row did not fit is observed while the table is written, so the drop is read a
    second time only if there is something to list. The observed number itself is not used, since it
    counts a row twice when a task is run again or a clustered write samples its rows.
    """
    contract = RAW[feed]
    landing = land(spark, feed, path, partition_values, **options)
    seen = Observation()
    observed = landing.checked.observe(seen, F.count(F.col(ORIGINAL)).alias("unfit"))
    named = None
    if partition_values:
        named = "&".join(f"{n}={partition_values[n]}" for n in contract.feed.delivered if n in partition_values)
    filled = write_drops(observed.select(DROP, *contract.names), table_path(warehouse, contract), contract, named)

    listed = landing.unfit.select(DROP, "table_name", "failed_columns", "original")
    # Of an empty drop nothing is observed.
    if not filled or not seen.get["unfit"]:
        listed = spark.createDataFrame([], listed.schema)
    target = f"{quarantine.rstrip('/')}/{feed}"
    came = sorted({*filled, *drop_folders(listed, named)})
    bad = [f"{target}/{name}" for name in replace_folders(listed, target, [DROP], came)]
    schema = T.StructType(list(listed.schema.fields)[1:])
    return spark.read.schema(schema).parquet(*bad).count() if bad else 0
