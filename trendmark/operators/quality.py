"""Data quality: each table is aggregated once, and the checks are rows made from that one row."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmark.config import QualityRules, TableRules
from trendmark.functions import parse_timestamp
from trendmark.schemas import CHECK_ROW, COUNTERS
from trendmark.sources.tables import sample

_TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or not-a-number in a floating column."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _check(check: str, table: str, passed: Column, message: Column, **details: Column | None) -> Column:
    """One check row; fields not given are NULL."""
    given = {"check": F.lit(check), "table": F.lit(table), "passed": passed, "message": message, **details}
    fields = []
    for field in CHECK_ROW.fields:
        value = given.get(field.name)
        fields.append((F.lit(None) if value is None else value).cast(field.dataType).alias(field.name))
    return F.struct(*fields)


class TableChecks:
    """The checks of one table: aggregates to compute, and check rows over the result."""

    def __init__(self, df: DataFrame, table: str, rules: QualityRules, as_of: datetime | None = None):
        self.df = df
        self.table = table
        self.rules = rules
        self.known = table in rules.tables
        self.expected = rules.tables.get(table, TableRules(()))
        self.as_of = as_of or datetime.now(timezone.utc)
        self._aggregates: dict[str, Column] = {"rows": F.count("*")}

    def _aggregate(self, name: str, column: Column) -> Column:
        self._aggregates[name] = column
        return F.col(name)

    def row_count(self) -> list[Column]:
        rows, least = F.col("rows"), self.rules.min_rows
        message = F.format_string(f"%d rows, at least {least} wanted", rows)
        return [_check("row_count", self.table, rows >= least, message, value=rows, threshold=F.lit(least))]

    def null_percentage(self) -> list[Column]:
        checks = []
        for index, name in enumerate(self.expected.critical_columns):
            if name not in self.df.columns:
                message = F.lit(f"column {name} is not in the table")
                checks.append(_check("null_pct", self.table, F.lit(False), message, column=F.lit(name)))
                continue
            nulls = self._aggregate(f"nulls_{index}", F.count_if(is_missing(self.df, name)))
            share = F.when(F.col("rows") > 0, nulls * 100.0 / F.when(F.col("rows") > 0, F.col("rows"))).otherwise(0.0)
            checks.append(
                _check(
                    "null_pct",
                    self.table,
                    share <= self.rules.max_null_pct,
                    F.format_string(f"{name} is NULL in %.2f %% of rows, at most {self.rules.max_null_pct} allowed", share),
                    column=F.lit(name),
                    value=F.round(share, 2),
                    threshold=F.lit(self.rules.max_null_pct),
                )
            )
        return checks

    def schema(self) -> list[Column]:
        missing = sorted(set(self.expected.critical_columns) - set(self.df.columns))
        if not self.known:
            message = "no rules are configured for this table"
        elif missing:
            message = "missing columns: " + ", ".join(missing)
        else:
            message = "all expected columns are present"
        listed = F.array([F.lit(name) for name in missing]).cast("array<string>")
        passed = F.lit(self.known and not missing)
        return [_check("schema", self.table, passed, F.lit(message), missing_columns=listed)]

    def value_ranges(self) -> list[Column]:
        checks = []
        for index, bounds in enumerate(self.expected.ranges):
            if bounds.column not in self.df.columns:
                continue
            value = F.col(bounds.column)
            below = self._aggregate(f"below_{index}", F.count_if(value < bounds.low))
            above = self._aggregate(f"above_{index}", F.count_if(value > bounds.high))
            message = F.format_string(f"{bounds.column}: %d below {bounds.low}, %d above {bounds.high}", below, above)
            checks.append(
                _check(
                    "value_range",
                    self.table,
                    (below == 0) & (above == 0),
                    message,
                    column=F.lit(bounds.column),
                    negative_count=below,
                    extreme_count=above,
                )
            )
        return checks

    def freshness(self) -> list[Column]:
        """The newest timestamp is recent enough.

        A table without such a column passes, as does one whose timestamps are all unreadable text; a
        table without any timestamp value fails.
        """
        name = next((name for name in self.rules.freshness_columns if name in self.df.columns), None)
        if name is None:
            return [_check("freshness", self.table, F.lit(True), F.lit("no timestamp column, not checked"))]
        stated = self._aggregate("stated", F.count(name))
        latest = self._aggregate("latest", F.max(parse_timestamp(F.col(name))))
        cutoff = F.lit(self.as_of - timedelta(hours=self.rules.freshness_hours)).cast("timestamp")
        unreadable = latest.isNull() & (stated > 0)
        latest_text, cutoff_text = F.date_format(latest, _TIME_TEXT), F.date_format(cutoff, _TIME_TEXT)
        message = F.when(unreadable, F.lit("no timestamp could be read, not checked")).otherwise(
            F.format_string("latest record %s, cutoff %s", F.coalesce(latest_text, F.lit("none")), cutoff_text)
        )
        return [
            _check(
                "freshness",
                self.table,
                unreadable | F.coalesce(latest >= cutoff, F.lit(False)),
                message,
                column=F.lit(name),
                latest_record=latest_text,
                cutoff=cutoff_text,
            )
        ]

    def rows(self, *checks: list[Column]) -> DataFrame:
        """Check rows, from one pass over the table."""
        listed = [check for group in checks for check in group]
        totals = self.df.agg(*[column.alias(name) for name, column in self._aggregates.items()])
        return totals.select(F.inline(F.array(*listed)))

    def all(self) -> DataFrame:
        return self.rows(
            self.row_count(), self.null_percentage(), self.schema(), self.value_ranges(), self.freshness()
        )


def unreadable_table(spark: SparkSession, table: str, reason: str) -> DataFrame:
    check = _check("read_table", table, F.lit(False), F.lit(reason))
    return spark.range(1).select(F.inline(F.array(check)))


def run_checks(
    spark: SparkSession,
    readers: Mapping[str, Callable[[], DataFrame]],
    rules: QualityRules | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Check rows of all tables; a table that cannot be resolved or read fails and the others go on.

    Each table is aggregated by a job of its own, so that broken files of one spoil nothing else; only its check
    rows come to the driver. Failures that are not about reading the table end the run.
    """
    rules = rules or QualityRules()
    results = []
    for table, reader in readers.items():
        try:
            df = sample(reader(), rules.sample_rows)
            found = TableChecks(df, table, rules, as_of).all().select(*CHECK_ROW.fieldNames()).collect()
            results.append(spark.createDataFrame(found, CHECK_ROW))
        except AnalysisException as error:
            results.append(unreadable_table(spark, table, error.getCondition() or str(error)))
        except (PySparkException, Py4JJavaError) as error:
            if "FAILED_READ_FILE" not in str(error):
                raise
            results.append(unreadable_table(spark, table, "FAILED_READ_FILE"))
    if not results:
        return spark.createDataFrame([], CHECK_ROW)
    combined = results[0]
    for other in results[1:]:
        combined = combined.unionByName(other)
    return combined


def verdict(checks: DataFrame) -> DataFrame:
    """One row: whether every check passed, the counts, and all check rows."""
    return checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if("passed").cast("int").alias("checks_passed"),
        F.count("*").cast("int").alias("checks_total"),
        F.collect_list(F.struct(*CHECK_ROW.fieldNames())).alias("details"),
    )


def failures(checks: DataFrame) -> DataFrame:
    return checks.filter(~F.col("passed"))


def inline_null_counts(df: DataFrame, columns: tuple[str, ...] = ("video_id", "title", "channel_title", "views")) -> DataFrame:
    """NULLs of each column as rows, from one aggregate. Run it before counters are filled."""
    totals = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return totals.unpivot([], list(columns), "column_name", "null_count")


def inline_negative_views(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("views") < 0).alias("negative_views"))


def warning_metrics(columns: list[str]) -> list[Column]:
    """The same counts as one set of observed metrics."""
    return [
        *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in columns],
        *[F.count_if(F.col(name) < 0).alias(f"negative_{name}") for name in COUNTERS],
    ]
