"""Writing and reading tables partitioned by their key and ordered by their cluster columns."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Contract, Key
from millrace.functions.numbers import has_double, normalize_zero
from millrace.operators.conform import DROP

PART = "_p"

# How a grain is written in folder names. Times are written in UTC.
GRAIN_FORMATS = {"hour": "%Y%m%d%H", "day": "%Y%m%d", "month": "%Y%m"}
SECONDS = {"hour": 3600, "day": 86_400}


def partition_column(key: Key) -> str:
    return key.column if key.grain == "date" else PART


def partition_columns(contract: Contract) -> list[str]:
    """The folders of a table: its key, and below it the drop where drops share a key's partition,
    so that loading one drop again cannot replace rows of another."""
    return [partition_column(contract.key), *([contract.drop] if contract.drop else [])]


def partition_value(key: Key) -> Column:
    """The stored partition value recomputed from the key column, the same in any session zone."""
    if key.grain == "date":
        return F.col(key.column)
    if key.grain == "month":
        return F.date_format(F.col(key.column), "yyyyMM")
    seconds = F.unix_seconds(F.col(key.column))
    day = F.floor(seconds / 86_400).cast("int")
    text = F.date_format(F.date_from_unix_date(day), "yyyyMMdd")
    hour = F.floor(F.pmod(seconds, F.lit(86_400)) / 3600).cast("string")
    return F.concat(text, F.lpad(hour, 2, "0")) if key.grain == "hour" else text


def place(df: DataFrame, contract: Contract, above: tuple[str, ...] = ()) -> DataFrame:
    """Bring rows of one partition together without putting a hot partition into one task.

    Without cluster columns, a rebalance by key lets AQE cut large partitions and merge small ones
    from the sizes of the shuffle itself. With cluster columns, rows are split by ranges of (key,
    cluster columns, row hash): the hash cuts ranges inside one hot value, and being computed from
    the row it comes out the same when a lost task is run again.
    """
    part = partition_column(contract.key)
    if contract.key.grain != "date":
        df = df.withColumn(PART, partition_value(contract.key))
    if not _ordered(contract, above):
        return df.hint("rebalance", *above, *partition_columns(contract))
    hashed = [f.name for f in contract.schema.fields if not isinstance(f.dataType, T.VariantType)]
    order = [*above, part, *contract.cluster]
    return df.repartitionByRange(*order, F.xxhash64(*hashed)).sortWithinPartitions(*order)


def _ordered(contract: Contract, above: tuple[str, ...] = ()) -> bool:
    """Whether files have an order: within a drop, a column that its folder gives has one value and needs none."""
    given = set(contract.feed.delivered) if above and contract.feed else set()
    return not set(contract.cluster) <= given


#: Folders whose files a task keeps open side by side.
OPEN_FILES = 100


@contextmanager
def files_kept_open(spark: SparkSession, ordered: bool = False) -> Iterator[None]:
    """While this lasts, a task writes rows to their folders as they come, instead of first sorting all its
    rows by folder; it sorts only what belongs to more than ``OPEN_FILES`` folders.

    Rows of one folder compress so well in a shuffle that a task's share of it can take 25 times as much memory
    when sorted. Rows whose order within a file matters are written as before.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "0" if ordered else str(OPEN_FILES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_table(
    df: DataFrame, path: str, contract: Contract, mode: str = "replace", max_records_per_file: int = 0
) -> None:
    """Write declared columns under ``path``.

    ``mode="replace"`` replaces the table, ``mode="partitions"`` only the partitions in ``df``.
    """
    overwrite = {"replace": "static", "partitions": "dynamic"}[mode]
    with files_kept_open(df.sparkSession, _ordered(contract)):
        (
            place(df.select(*_stored_columns(contract)), contract)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*partition_columns(contract))
            .parquet(path)
        )


def _stored_columns(contract: Contract) -> list[Column]:
    return [
        normalize_zero(F.col(f.name), f.dataType).alias(f.name) if has_double(f.dataType) else F.col(f.name)
        for f in contract.schema.fields
    ]


def write_drops(df: DataFrame, path: str, contract: Contract, named: str | None = None) -> list[str]:
    """Replace all rows of the drops that ``df`` holds in its column ``_drop``, and no others.

    A drop is the first folder level, above the key, so siblings of one hour and days that a drop no
    longer has cannot be confused. ``named`` is a drop that came even if it has no row. Returns the
    folder names of the drops that have rows.
    """
    rows = place(df.select(DROP, *_stored_columns(contract)), contract, (DROP,))
    folders = [DROP, *partition_columns(contract)]
    return replace_folders(rows, path, folders, drop_folders(rows, named), _ordered(contract, (DROP,)))


def drop_folders(df: DataFrame, named: str | None) -> list[str]:
    """The folder name of a drop, escaped as Spark does."""
    if named is None:
        return []
    catalog = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog
    return [f"{DROP}={catalog.ExternalCatalogUtils.escapePathName(named)}"]


#: In the folder of a load whose rows are all written: the folders that came without rows.
READY = "_ready.json"


def replace_folders(rows: DataFrame, path: str, folders: list[str], came: list[str], ordered: bool = False) -> list[str]:
    """Write rows below ``path`` by folder columns, and replace the folders of the first column that
    were written or came. Returns the names of the folders written.

    Rows are written aside and marked as ready; then each folder's old files are set aside and the new
    ones put in their place. A load that stops before the mark has changed nothing; one that stops after it
    is finished by the next load, or by ``finish_loads``.
    """
    spark = rows.sparkSession
    finish_loads(spark, path)
    aside = f"{path.rstrip('/')}/_loading-{uuid.uuid4().hex}"
    with files_kept_open(spark, ordered):
        rows.write.partitionBy(*folders).parquet(aside)
    paths, files = _files(spark, aside)
    done = [f.getName() for f in _value_folders(files, paths(aside))]
    out = files.create(paths(aside, READY))
    out.write(bytearray(json.dumps([name for name in came if name not in done]).encode()))
    out.close()
    _put_in_place(spark, path, aside)
    return sorted(done)


def finish_loads(spark: SparkSession, path: str) -> None:
    """Finish loads that stopped while folders were put in place, and drop what others left unfinished."""
    paths, files = _files(spark, path)
    if not files.exists(paths(path)):
        return
    left = [s.getPath() for s in files.listStatus(paths(path)) if s.getPath().getName().startswith("_loading-")]
    for aside in sorted(left, key=lambda p: p.getName()):
        if files.exists(paths(aside, READY)):
            _put_in_place(spark, path, aside.toString())
        else:
            files.delete(aside, True)


def _files(spark: SparkSession, path: str):
    paths = spark._jvm.org.apache.hadoop.fs.Path
    return paths, paths(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _value_folders(files, path) -> list:
    return [s.getPath() for s in files.listStatus(path) if s.isDirectory() and "=" in s.getPath().getName()]


def _put_in_place(spark: SparkSession, path: str, aside: str) -> None:
    """Swap in the folders that are still aside; each step can be done again after a stop."""
    paths, files = _files(spark, path)
    size = files.getFileStatus(paths(aside, READY)).getLen()
    source = files.open(paths(aside, READY))
    gone = json.loads(bytes(source.readNBytes(size)).decode())
    source.close()
    for name in gone:
        files.delete(paths(path, name), True)
    for folder in _value_folders(files, paths(aside)):
        target = paths(path, folder.getName())
        if files.exists(target):
            _move(files, target, paths(aside, f"_old-{uuid.uuid4().hex}"))
        _move(files, folder, target)
    files.delete(paths(aside), True)


def _move(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source} cannot be moved to {target}")


def stored_table(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The files as stored, with the partition value as text."""
    schema = T.StructType(list(contract.schema.fields))
    if contract.key.grain != "date":
        schema = schema.add(PART, T.StringType())
    return spark.read.schema(schema).parquet(path)


def between(df: DataFrame, key: Key, since: date | None, until: date | None) -> DataFrame:
    """Rows with ``since <= key < until``. Bounds without a zone are in UTC.

    The same bounds go on the stored partition value, because Spark cannot see that it is computed
    from the key; with them the scan lists only matching folders.
    """
    column_type = "date" if key.grain in ("date", "month") else "timestamp"
    for bound, keep_key, keep_part in (
        (since, lambda c, b: c >= b, lambda c, b: c >= b),
        (until, lambda c, b: c < b, lambda c, b: c <= b),
    ):
        if bound is None:
            continue
        df = df.where(keep_key(F.col(key.column), F.lit(_literal(bound, column_type)).cast(column_type)))
        if key.grain != "date":
            df = df.where(keep_part(F.col(PART), F.lit(_utc(bound).strftime(GRAIN_FORMATS[key.grain]))))
    return df


def _utc(bound: date) -> date:
    aware = isinstance(bound, datetime) and bound.tzinfo is not None
    return bound.astimezone(timezone.utc).replace(tzinfo=None) if aware else bound


def _literal(bound: date, column_type: str) -> str:
    bound = _utc(bound)
    if column_type == "date":
        return bound.strftime("%Y-%m-%d")
    moment = bound if isinstance(bound, datetime) else datetime(bound.year, bound.month, bound.day)
    return f"{moment.isoformat(sep=' ')}+00:00"


def read_table(
    spark: SparkSession,
    path: str,
    contract: Contract,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Declared columns of a stored table, pruned to a range of its key when one is given."""
    stored = between(stored_table(spark, path, contract), contract.key, since, until)
    return stored.select(*contract.names)
