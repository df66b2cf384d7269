"""Readers for the eight delivered formats.

Each returns the feed's columns, its folder columns as text, and the text of any malformed record.
Nothing is inferred from the data. All formats but two are read by Spark's own file sources; Avro
and SequenceFile have none in a plain Spark build, so they come through their Hadoop input formats
as lines of text and are taken apart by built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Contract
from millrace.functions.types import text_type
from millrace.operators.conform import BAD_RECORD

# Separators and NULL mark of delimited text inside sequence files.
FIELD_SEPARATOR, ITEM_SEPARATOR, PART_SEPARATOR, NULL_MARK = "\x01", "\x02", "\x03", "\\N"

# Seven fields between bars; the last one may hold bars itself.
LOYALTY_PATTERN = r"^([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*)$"

Values = dict[str, str] | None


def read_feed(
    spark: SparkSession, contract: Contract, path: str, partition_values: Values = None, **options: str
) -> DataFrame:
    """Read one drop, or with no ``partition_values`` all drops found in folders under ``path``."""
    reader = READERS[contract.feed.format]
    feed = reader(spark, contract, path, partition_values, **options)
    for name, value in (partition_values or {}).items():
        feed = feed.withColumn(name, F.lit(value).cast("string"))
    return feed


def read_parts(
    spark: SparkSession, contract: Contract, path: str, partition_values: Values = None, **options: str
) -> list[DataFrame]:
    """The drop as one frame, or as several where its files disagree on the types of columns."""
    if contract.feed.format != "parquet":
        return [read_feed(spark, contract, path, partition_values, **options)]
    added = {n: F.lit(v).cast("string") for n, v in (partition_values or {}).items()}
    return [part.withColumns(added) for part in parquet_parts(spark, contract, path, partition_values, **options)]


def _text_schema(contract: Contract) -> T.StructType:
    return text_type(contract.delivered_columns)


def _with_folders(schema: T.StructType, contract: Contract, values: Values) -> T.StructType:
    """Folder columns are part of the schema only when Spark is to read them from folder names."""
    folders = [] if values else [T.StructField(n, T.StringType()) for n in contract.feed.delivered]
    return T.StructType(schema.fields + folders)


def _file_schema(schema: T.StructType, contract: Contract, values: Values) -> T.StructType:
    with_bad = T.StructType(schema.fields + [T.StructField(BAD_RECORD, T.StringType())])
    return _with_folders(with_bad, contract, values)


def read_delimited(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, **options: str
) -> DataFrame:
    """CSV or TSV. Short lines are padded, long lines cut, and both are reported as malformed."""
    tab = contract.feed.format == "tsv"
    settings = {
        "sep": "\t" if tab else ",",
        "quote": "" if tab else '"',
        "escape": "\\" if tab else '"',  # a quote inside quotes is doubled
        "nullValue": NULL_MARK,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_RECORD,
        "columnPruning": "false",
        **options,
    }
    schema = _file_schema(_text_schema(contract), contract, values)
    return spark.read.schema(schema).options(**settings).csv(path)


def read_json_lines(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, **options: str
) -> DataFrame:
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD, **options}
    schema = _file_schema(_text_schema(contract), contract, values)
    return spark.read.schema(schema).options(**settings).json(path)


def read_parquet(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, **options: str
) -> DataFrame:
    """A drop whose files agree."""
    (part,) = parquet_parts(spark, contract, path, values, **options)
    return part


def parquet_parts(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, every: bool = False, **options: str
) -> list[DataFrame]:
    """A drop with the types its files have; casts to declared types come later and list what fails.

    A job over the footers merges the schemas. Where types disagree and cannot be merged, files are
    grouped by schema: tasks read the footers, and the driver reads one file of each schema. With
    ``every``, columns beside the declared ones are read too.
    """
    names = set(contract.delivered_columns.fieldNames())

    def read(schema: T.StructType, *files: str) -> DataFrame:
        own = T.StructType([f for f in schema.fields if (f.name in names or every) and f.name not in contract.feed.delivered])
        reader = spark.read.schema(_with_folders(own, contract, values)).options(**options)
        return reader.option("basePath", path).parquet(*files) if files else reader.parquet(path)

    try:
        merged = spark.read.options(**options).option("mergeSchema", "true").parquet(path).schema
        return [read(merged)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    parts: dict[str, tuple[T.StructType, list[str]]] = {}
    for row in file_groups(spark, path).collect():
        schema = spark.read.options(**options).parquet(row["paths"][0]).schema
        parts.setdefault(schema.json(), (schema, []))[1].extend(row["paths"])
    return [read(schema, *files) for schema, files in parts.values()]


def file_groups(spark: SparkSession, path: str) -> DataFrame:
    """(footer, paths): the Parquet files below a path by the schema in their footers, which tasks read.

    The tasks open footers with ``pyarrow.fs``: local paths, HDFS, S3 and GCS. A row per schema is returned, in the
    order of the first paths.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array([footer(p) for p in paths])], names=["path", "footer"])

    each = found.load(path).select("path").mapInArrow(read, "path string, footer string")
    return each.groupBy("footer").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy(F.col("paths")[0])


def footer(path: str) -> str:
    """The schema of a Parquet file as its footer has it, with the schema that Spark wrote into it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        files, name = pa.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        host, _, name = rest.removeprefix("//").partition("/")
        scheme = "s3" if scheme in ("s3a", "s3n") else scheme
        files, root = pa.fs.FileSystem.from_uri(f"{scheme}://{host}/")
        name = f"{root.rstrip('/')}/{name}"
    with files.open_input_file(name) as source:
        known = pq.ParquetFile(source)
        own = (known.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
        columns = [known.schema.column(i) for i in range(len(known.schema))]
        kinds = [f"{c.path} {c.physical_type} {c.logical_type} {c.length} {c.max_definition_level} {c.max_repetition_level}" for c in columns]
        return "\n".join([*kinds, own.decode()])


def read_pattern_lines(
    spark: SparkSession,
    contract: Contract,
    path: str,
    values: Values = None,
    pattern: str = LOYALTY_PATTERN,
    **options: str,
) -> DataFrame:
    """One row per line, one column per group; a line that does not match is malformed."""
    schema = _with_folders(T.StructType([T.StructField("value", T.StringType())]), contract, values)
    lines = spark.read.schema(schema).options(**options).text(path)
    line = F.col("value")
    matches = line.rlike(pattern)
    groups = [
        F.when(matches, F.regexp_extract(line, pattern, i)).alias(name)
        for i, name in enumerate(contract.delivered_columns.fieldNames(), start=1)
    ]
    folders = [] if values else list(contract.feed.delivered)
    return lines.select(*groups, F.when(~matches, line).alias(BAD_RECORD), *folders)


def read_avro(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, **options: str
) -> DataFrame:
    """Avro records, which the Avro input format hands over as JSON text."""
    _need_values(contract, values)
    text = "org.apache.hadoop.io.Text"
    records = spark.sparkContext.hadoopFile(
        path, "org.apache.avro.mapred.AvroAsTextInputFormat", text, text
    ).keys()
    lines = spark.createDataFrame(records, "string", verifySchema=False)
    record = F.from_json("value", _text_schema(contract))
    return lines.select(record.alias("record")).select("record.*")


def read_sequence(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, **options: str
) -> DataFrame:
    """Sequence files whose values are delimited text."""
    _need_values(contract, values)
    records = spark.sparkContext.sequenceFile(path).values()
    lines = spark.createDataFrame(records, "string", verifySchema=False)
    schema = _text_schema(contract)
    parts = F.split("value", FIELD_SEPARATOR, -1)
    fields = [
        _delimited_value(F.get(parts, F.lit(i)), f.dataType).alias(f.name)
        for i, f in enumerate(schema.fields)
    ]
    malformed = F.when(F.size(parts) != len(schema.fields), F.col("value"))
    return lines.select(*fields, malformed.alias(BAD_RECORD))


def _delimited_value(text: Column, data_type: T.DataType) -> Column:
    present = F.when(text != NULL_MARK, text)
    if isinstance(data_type, T.ArrayType):
        items = F.when(present != "", F.split(present, ITEM_SEPARATOR, -1))
        element = data_type.elementType
        if isinstance(element, T.StructType):
            return F.transform(items, lambda item: _delimited_struct(item, element))
        return items
    return present


def _delimited_struct(item: Column, data_type: T.StructType) -> Column:
    parts = F.split(item, PART_SEPARATOR, -1)
    fields = [F.get(parts, F.lit(i)) for i in range(len(data_type.fields))]
    return F.struct(
        *[F.when(p != NULL_MARK, p).alias(f.name) for p, f in zip(fields, data_type.fields)]
    )


def read_catalog_table(
    spark: SparkSession, contract: Contract, path: str, values: Values = None, **options: str
) -> DataFrame:
    """A table of the session's catalog; RCFile needs one with Hive support. ``path`` is its name."""
    table = spark.table(path)
    names = contract.delivered_columns.fieldNames() + ([] if values else list(contract.feed.delivered))
    return table.select(*[F.col(n) for n in names if n in table.columns])


def _need_values(contract: Contract, values: Values) -> None:
    missing = set(contract.feed.delivered) - set(values or {})
    if missing:
        raise ValueError(f"{contract.table} is landed drop by drop; give {sorted(missing)}")


READERS = {
    "csv": read_delimited,
    "tsv": read_delimited,
    "json": read_json_lines,
    "parquet": read_parquet,
    "regex": read_pattern_lines,
    "avro": read_avro,
    "sequence": read_sequence,
    "rcfile": read_catalog_table,
}
