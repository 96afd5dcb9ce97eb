"""Bulk conversion of CSV files to Parquet, one output for each input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby, islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.functions import file_stem
from trendmark.schemas import CORRUPT
from trendmark.session import durable
from trendmark.sources.csv_headers import header_lines
from trendmark.sources.csv_snapshots import read_csv_inferred
from trendmark.sources.folders import path_exists

FILES_PER_JOB = 10_000
#: How a job says that it ended because of a file, in reading and in type inference.
BROKEN_FILE = ("FAILED_READ_FILE", "TextParsingException")


def list_csv_files(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV file below ``path`` with its header line and the name its output gets.

    Only the first line of a file is read. The output is named after the file. Files of one name in different folders are
    named after their whole path, so that none replaces another. Empty files have no header and are left out.
    """
    named = header_lines(spark, path).withColumn("stem", file_stem(F.col("source")))
    shared = named.groupBy("stem").agg((F.count("*") > 1).alias("shared"))
    return named.join(shared, "stem").select(
        "source", "header", "shared", _output_name(F.col("source"), F.col("shared")).alias("dest")
    )


def _output_name(source: Column, shared: Column) -> Column:
    whole = F.regexp_replace(F.regexp_replace(source, r"^[a-z0-9]+:/*", ""), r"\.[^./]*$", "")
    return F.when(shared, F.regexp_replace(whole, "/", "__")).otherwise(file_stem(source))


def _layouts(files: DataFrame) -> Iterator[tuple[str, bool, list[str]]]:
    """Files of one layout and naming at a time, never more than a bounded number of paths."""
    listed = files.orderBy("header", "shared", "source").toLocalIterator()
    for (header, shared), rows in groupby(listed, key=lambda row: (row.header, row.shared)):
        while paths := [row.source for row in islice(rows, FILES_PER_JOB)]:
            yield header, shared, paths


def _inferred(spark: SparkSession, paths: list[str], multi_line: bool) -> T.StructType:
    """Types of a group of files; columns without any value have none."""
    rows = read_csv_inferred(spark, paths, multi_line)
    texts = [name for name, kind in rows.dtypes if kind == "string"]
    if not texts:
        return rows.schema
    used = rows.agg(*[F.count(F.col(f"`{name}`")).alias(str(i)) for i, name in enumerate(texts)]).first()
    unknown = {name for i, name in enumerate(texts) if not used[i]}
    return T.StructType([T.StructField(f.name, T.NullType()) if f.name in unknown else f for f in rows.schema])


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that inference knows for values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if kinds <= {T.IntegerType, T.LongType, T.DecimalType, T.DoubleType}:
        if T.DoubleType in kinds:
            return T.DoubleType()
        if T.DecimalType not in kinds:
            return T.LongType()
        whole = [x.precision - x.scale if isinstance(x, T.DecimalType) else 19 for x in (a, b)]
        scale = max(x.scale if isinstance(x, T.DecimalType) else 0 for x in (a, b))
        return T.DecimalType(max(whole) + scale, scale) if max(whole) + scale <= 38 else T.DoubleType()
    return T.StringType()


def _apart(action: Callable[[list[str]], None], paths: list[str], failed: dict[str, str]) -> None:
    """Run ``action`` on files together; where one of them cannot be read, on halves of them, down to that file.

    The others go on, and ``failed`` says why each unreadable file was left out. A bad file costs as many runs more as a list
    can be halved.
    """
    try:
        action(paths)
    except (PySparkException, Py4JJavaError) as error:
        if not any(sign in str(error) for sign in BROKEN_FILE):
            raise
        if len(paths) == 1:
            failed[paths[0]] = _reason(error)
            return
        middle = len(paths) // 2
        _apart(action, paths[:middle], failed)
        _apart(action, paths[middle:], failed)


def _reason(error: Exception) -> str:
    """The first line that names a cause."""
    lines = [line.strip() for line in str(error).splitlines()]
    return next((line for line in lines if line.startswith("Caused by")), lines[0])[:500]


def _layout_schemas(spark: SparkSession, files: DataFrame, multi_line: bool, failed: dict[str, str]) -> dict[str, T.StructType]:
    """One schema for each header line, wide enough for all of its files however many groups they are read in.

    Inference reads every file, and so finds those that cannot be read.
    """
    found: dict[str, T.StructType] = {}
    for header, _, paths in _layouts(files):

        def widen(some: list[str], header: str = header) -> None:
            new = _inferred(spark, some, multi_line)
            old = found.get(header, new)
            found[header] = T.StructType([T.StructField(n.name, wider(o.dataType, n.dataType)) for o, n in zip(old, new)])

        _apart(widen, paths, failed)
    text = lambda kind: T.StringType() if isinstance(kind, T.NullType) else kind
    return {h: T.StructType([T.StructField(f.name, text(f.dataType)) for f in schema]) for h, schema in found.items()}


def _convert(spark: SparkSession, paths: list[str], schema: T.StructType, shared: bool, dest: str, multi_line: bool) -> None:
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(paths)
    )
    (
        rows.withColumn("source_name", _output_name(F.col("_metadata.file_path"), F.lit(shared)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("source_name")
        .parquet(dest)
    )


def convert_csv(spark: SparkSession, path: str, dest: str, multi_line: bool = True) -> DataFrame:
    """Convert every CSV file below ``path`` to ``dest/source_name=<name>`` and return the manifest.

    Files are read together with the others of their layout (the same header line), not one by one, in groups of
    bounded size; types hold for all files of a layout, also over several groups.
    Rows that do not fit are kept whole in the corrupt column. A file that cannot be read is left out, and the manifest says
    why; the others are converted.
    """
    files = durable(list_csv_files(spark, path))
    failed: dict[str, str] = {}
    schemas = _layout_schemas(spark, files, multi_line, failed)
    for header, shared, paths in _layouts(files):
        readable = [source for source in paths if source not in failed]
        if readable:
            _apart(lambda some: _convert(spark, some, schemas[header], shared, dest, multi_line), readable, failed)  # noqa: B023
    errors = spark.createDataFrame(list(failed.items()), "source string, error string")
    files = files.join(errors, "source", "left")
    if not path_exists(spark, dest):
        return files.select("source", "dest", F.lit(0).cast("bigint").alias("rows"), _status(), "error")
    return conversion_manifest(files, spark.read.parquet(dest))


def _status() -> Column:
    return F.when(F.col("error").isNull(), "converted").otherwise("failed").alias("status")


def conversion_manifest(files: DataFrame, converted: DataFrame) -> DataFrame:
    """One row for each file: source, output name, rows written, and whether it was converted or why not."""
    rows = converted.groupBy(F.col("source_name").alias("dest")).agg(F.count("*").alias("rows"))
    written = F.when(F.col("error").isNull(), F.coalesce("rows", F.lit(0))).otherwise(0).cast("bigint").alias("rows")
    return files.join(rows, "dest", "left").select("source", "dest", written, _status(), "error")
