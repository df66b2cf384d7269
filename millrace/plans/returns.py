"""The change feed of returns folded into a snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import STAGING
from millrace.operators.latest import has_key, latest_per_key, without_key
from millrace.operators.layout import finish_loads, replace_folders
from millrace.session import written

CHANGED = "change_date"
NEWEST_FIRST = [CHANGED, "return_ts", "is_deleted"]
#: Folder level of the state on disk: the number of the bucket of a return, and of how many.
BUCKET, BUCKETS = "_bucket", 64
DATA = [c for c in STAGING["merged_returns_cdc"].names if c != "snapshot_date"]


def returns_state(
    changes: DataFrame, previous: DataFrame | None = None, delete_ops: tuple[str, ...] = ("D",)
) -> DataFrame:
    """The newest version of each return with the date of its change.

    Newest is by change date, then time, then deletion, then all columns. The declared snapshot holds
    no change date, so this state is kept beside it: without the date, a change that arrives after a
    later snapshot would look older than it is. Changes are reduced to one row per return before
    they meet the state of the load before, which is unique already and so is shuffled and sorted
    only once. Changes without a return are left out; ``unkeyed_returns`` lists them.
    """
    marked = changes.withColumn("is_deleted", F.coalesce(F.upper("op").isin(*delete_ops), F.lit(False)))
    dated = marked.where(has_key(["return_id"])).withColumnRenamed("snapshot_date", CHANGED)
    newest = latest_per_key(dated.select(*DATA, CHANGED), ["return_id"], NEWEST_FIRST)
    return newest if previous is None else _newer_of(previous.select(*DATA, CHANGED), newest)


def returns_snapshot(state: DataFrame, snapshot_date: date) -> DataFrame:
    """The declared table of a state. A deleted return stays as a marked row, and a later change
    brings it back."""
    today = F.lit(snapshot_date.isoformat()).cast("date")
    return state.withColumn("snapshot_date", today).select(*STAGING["merged_returns_cdc"].names)


def merged_returns_cdc(
    changes: DataFrame,
    snapshot_date: date,
    previous: DataFrame | None = None,
    delete_ops: tuple[str, ...] = ("D",),
) -> DataFrame:
    """The snapshot of a date; ``previous`` is the ``returns_state`` of the load before."""
    return returns_snapshot(returns_state(changes, previous, delete_ops), snapshot_date)


def fold_returns(
    changes: DataFrame, path: str, buckets: int = BUCKETS, delete_ops: tuple[str, ...] = ("D",)
) -> list[str]:
    """Fold changes into the state under ``path``, and return the buckets that were rewritten.

    The state lies in folders by a hash of the return. Only buckets with changes are read and written again;
    the files of all others stay. Set ``buckets`` so that one is a few gigabytes; it stays as it was first set.
    """
    spark = changes.sparkSession
    finish_loads(spark, path)
    number = F.pmod(F.xxhash64("return_id"), F.lit(buckets)).cast("string")
    bucket = F.concat(number, F.lit(f"of{buckets}"))
    newest = written(returns_state(changes, None, delete_ops).withColumn(BUCKET, bucket), "returns-new")
    touched = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())  # at most as many as buckets
    previous = read_returns(spark, path)
    other = previous.where(~F.col(BUCKET).endswith(f"of{buckets}")).select(BUCKET).first()
    if other is not None:
        raise ValueError(f"the state under {path} is in another number of buckets: {other[0]}")
    folded = _newer_of(previous.where(F.col(BUCKET).isin(touched)), newest).withColumn(BUCKET, bucket)
    return replace_folders(folded.hint("rebalance", BUCKET), path, [BUCKET], [])


def read_returns(spark: SparkSession, path: str) -> DataFrame:
    """The state under ``path`` with its bucket; without rows where nothing was folded yet."""
    kinds = {f.name: f.dataType for f in STAGING["merged_returns_cdc"].schema.fields}
    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in DATA], T.StructField(CHANGED, T.DateType()), T.StructField(BUCKET, T.StringType())])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def unkeyed_returns(changes: DataFrame) -> DataFrame:
    """Changes without a return, in the form of the quarantine."""
    return without_key(changes, STAGING["merged_returns_cdc"].table, ["return_id"])


def _newer_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """For each return of either side, the version that sorts later."""
    rank = F.struct(*NEWEST_FIRST, *[c for c in DATA if c not in NEWEST_FIRST])
    left = old.select(F.col("return_id").alias("_old_id"), rank.alias("_old"))
    right = new.select(F.col("return_id").alias("_new_id"), rank.alias("_new"))
    both = left.join(right, F.col("_old_id") == F.col("_new_id"), "full")
    newer = F.when(F.col("_new").isNull() | (F.col("_old") > F.col("_new")), F.col("_old")).otherwise(F.col("_new"))
    return both.select(newer.alias("_row")).select("_row.*").select(*DATA, CHANGED)
