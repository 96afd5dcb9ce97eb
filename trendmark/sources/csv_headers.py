"""Header lines of CSV files, and rows by header name where files differ in their columns."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmark.session import scratch_path

CSV_GLOB = "*.[cC][sS][vV]"
# With these every file is one task's, unsplit and alone, and its reader hands over few lines at a time.
_ONE_FILE_A_TASK = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def header_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source`` and ``header``, the first line that is not blank, of every CSV file at any depth below ``path``.

    A file's task stops after that line, so the cost grows with the number of files and not with their size. Files
    without such a line are left out.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, line in enumerate(batch.column("value").to_pylist()):
                if line and line.strip("﻿ \t\r"):
                    yield batch.slice(i, 1)
                    return

    peek = spark.newSession()
    for key, value in _ONE_FILE_A_TASK.items():
        peek.conf.set(key, value)
    lines = peek.read.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB).text(path)
    found = lines.select(F.col("_metadata.file_path").alias("source"), "value").mapInArrow(first, "source string, value string")
    target = scratch_path(spark, "headers")
    found.withColumnRenamed("value", "header").write.parquet(target)
    return spark.read.schema("source string, header string").parquet(target)


def header_names(header: Column) -> Column:
    """Names in a header line: quotes and blanks around them removed, in lower case."""
    cells = F.split(F.regexp_replace(header, "[﻿\r]", ""), r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(cells, lambda cell: F.lower(F.trim(F.regexp_replace(F.trim(cell), r'^"|"$', ""))))


def place_of(names: Column, name: str) -> Column:
    """Where a column stands in a header, from 0; -1 where it does not."""
    return (F.array_position(names, F.lit(name.lower())) - 1).cast("int")


#: The text of a record that has more or fewer cells than the schema it was read with.
RECORD = "_record"


def with_further_cells(rows: DataFrame, expected: int, width: int, options: dict[str, str]) -> DataFrame:
    """Rows read as ``expected`` cells, with ``further``: the cells after these, up to ``c<width>``, where a row may have more.

    Spark's reader raises and catches an error for each cell that a row lacks, which costs more than all cells it has. So
    only records with more cells are parsed again, as few cells as their commas allow.
    """
    commas = F.length(RECORD) - F.length(F.translate(RECORD, ",", ""))
    sizes = sorted({min(size, width + 1) for size in (expected + 4, 2 * expected, width + 1) if expected <= width})
    records, further = {}, []
    for least, size in zip([expected, *sizes], sizes):
        fits = (commas >= least) if size == sizes[-1] else (commas >= least) & (commas < size)
        name, cells = f"_cells{size}", ", ".join(f"c{i} string" for i in range(size))
        records[name] = F.when(fits, F.from_csv(RECORD, cells, options))
        further.append(F.when(F.col(name).isNotNull(), F.array(*(F.col(f"{name}.c{i}") for i in range(expected, size)))))
    none = F.lit(None).cast("array<string>")
    return rows.withColumns(records).withColumn("further", F.coalesce(none, *further)).drop(RECORD, *records)


_TRIMMED = "\ufeff \t"


def cells_by_name(rows: DataFrame, expected: int, wanted: Sequence[str], width: int) -> DataFrame:
    """Rows of whole files, each beginning with its header row, as the wanted columns by name.

    Cells come in the columns ``c0`` up to ``c<expected - 1>``, those after them in ``further``, the file in ``source``; other
    columns are kept. A task's rows are those of its files, one file after the other and in order.

    Python sees rows that may be a header, and says where each file's columns stand; all cells stay with Spark.
    """
    cells = [f"c{i}" for i in range(expected)]
    named = [name.lower() for name in wanted]
    plain = list(range(len(wanted))) if len(wanted) == expected else None

    def is_name(cell: Column) -> Column:
        return F.lower(F.trim(cell, F.lit(_TRIMMED))).isin(named)

    def places(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """For each row where the wanted columns stand: NULL if in the order wanted; an empty list for a header."""
        kind, last, own = pa.list_(pa.int32()), None, None
        for files, headers in batches:
            files, parts = files.to_numpy(zero_copy_only=False), []
            edges = [0, *((files[1:] != files[:-1]).nonzero()[0] + 1).tolist(), len(files)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if last is None or files[a] != last:
                    last = files[a]
                    names = [(name or "").strip(_TRIMMED).lower() for name in json.loads(headers[a].as_py() or "[]")][: width + 1]
                    found = [names.index(name) if name in names else -1 for name in named]
                    own = None if found == plain else found
                    parts.append(pa.array([[]], kind))
                    a += 1
                if own is None:
                    parts.append(pa.nulls(b - a, kind))
                else:
                    ends = pa.array(range(0, len(own) * (b - a) + 1, len(own)), pa.int32())
                    parts.append(pa.ListArray.from_arrays(ends, pa.array(own * (b - a), pa.int32())))
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    # Annotated here, as the types of a function's text would not be found.
    places.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    placed = F.arrow_udf(places, "array<int>").asNondeterministic()
    kept = [name for name in rows.columns if name not in (*cells, "further")]
    every = F.concat(F.array(*cells), F.coalesce("further", F.array().cast("array<string>")))
    may_be = reduce(Column.__or__, (F.coalesce(is_name(F.col(cell)), F.lit(False)) for cell in cells))
    may_be = may_be | F.coalesce(F.exists("further", is_name), F.lit(False))
    # As text: Spark sizes up a batch after each row, which for lists costs more the more rows it has.
    found = rows.withColumn("_places", placed(F.xxhash64("source"), F.when(may_be, F.to_json(every))))
    found = found.filter(F.coalesce(F.size("_places") != 0, F.lit(True)))
    found = found.withColumn("_every", F.when(F.col("_places").isNotNull(), every))
    too_many = F.concat("source", F.lit(f" has more than {width} columns; read it with a larger width"))
    beyond = F.get("further", F.lit(width - expected)) if expected <= width else F.col(f"c{width}")
    columns = []
    for i, name in enumerate(wanted):
        column = F.get("_every", F.get("_places", F.lit(i)))
        column = F.when(F.col("_places").isNull(), F.col(cells[i])).otherwise(column) if plain else column
        columns.append(F.when(beyond.isNotNull(), F.raise_error(too_many).cast("string")).otherwise(column).alias(name))
    return found.select(*columns, *kept)
