"""Growth rate of a table in rows per month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions import fixed_values as fixed
from dqloom.functions.naming import first_label
from dqloom.functions.text import quoted
from dqloom.functions.timewindow import elapsed_seconds, has_window, window_bound
from dqloom.functions.numbers import months_inclusive
from dqloom.operators.keyed import union_all


def timestamp_columns(frame: DataFrame) -> list[str]:
    """Date and timestamp columns whose name tells of a time, sorted."""
    return sorted(
        f.name
        for f in frame.schema.fields
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        and any(part in f.name.lower() for part in fixed.TIMESTAMP_NAME_PARTS)
    )


def best_timestamp_column(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The candidate with the most values; the first one wins a tie."""
    columns = timestamp_columns(frame) if columns is None else list(columns)
    counted = frame.agg(*[F.count(F.col(quoted(c))).alias(f"n{i}") for i, c in enumerate(columns)])
    most = _most([F.col(f"n{i}") for i in range(len(columns))])
    best = first_label((F.col(f"n{i}") == most, c) for i, c in enumerate(columns))
    return counted.select(
        F.lit(schema).alias("schema_name"),
        F.lit(table).alias("table_name"),
        best.alias("best_column"),
        most.alias("value_count"),
    )


def _most(counts: list[Column]) -> Column:
    return counts[0] if len(counts) == 1 else F.greatest(*counts)


def growth_rate(
    frame: DataFrame,
    schema: str,
    table: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows per month by the best timestamp column, with the reason when there is none.

    Counts, bounds and in-window counts of all candidates come from one aggregate. A
    window needs both bounds and ``end > start``; otherwise the column's own span is used.
    """
    columns = timestamp_columns(frame) if columns is None else list(columns)
    labels = [F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name")]
    if not columns:
        return frame.sparkSession.range(1).select(
            *labels,
            F.lit(None).cast("bigint").alias("growth"),
            F.lit("NO_TIMESTAMP").alias("note"),
            F.lit("").alias("time_info"),
        )
    lower = window_bound(F.lit(None if start is None else str(start)))
    upper = window_bound(F.lit(None if end is None else str(end)), is_end=True)
    windowed = has_window(lower, upper)
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for i, c in enumerate(columns):
        column = F.col(quoted(c))
        aggregates += [
            F.count(column).alias(f"n{i}"),
            F.min(column).alias(f"lo{i}"),
            F.max(column).alias(f"hi{i}"),
            F.count_if(column.cast("timestamp_ntz").between(lower, upper)).alias(f"in{i}"),
        ]
    most = _most([F.col(f"n{i}") for i in range(len(columns))])
    cases = []
    for i, c in enumerate(columns):
        data_type = frame.schema[c].dataType
        is_date, with_zone = isinstance(data_type, T.DateType), isinstance(data_type, T.TimestampType)
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        months = (
            F.datediff(high, low) / F.lit(fixed.DAYS_PER_MONTH)
            if is_date
            else elapsed_seconds(low, high, with_zone) / F.lit(float(fixed.SECONDS_PER_MONTH))
        )
        cases.append(
            F.struct(
                F.lit(c).alias("name"),
                F.col(f"n{i}").alias("n"),
                F.when(windowed, F.col(f"in{i}")).otherwise(F.col(f"n{i}")).alias("period_rows"),
                F.when(windowed, months_inclusive(lower, upper)).otherwise(months).alias("months"),
                (~windowed & (low == high)).alias("same"),
                F.when(windowed, lower.cast("string")).otherwise(low.cast("string")).alias("since"),
            )
        )
    chosen = None
    for i, case in enumerate(cases):
        hit = F.col(f"n{i}") == most
        chosen = F.when(hit, case) if chosen is None else chosen.when(hit, case)
    best = frame.agg(*aggregates).select("row_count", chosen.alias("b"))

    def noted(code: str) -> Column:
        return F.concat(F.lit(f"{code}("), F.col("b.name"), F.lit(")"))

    empty = F.col("row_count") == 0
    all_null = F.col("b.n") == 0
    short = F.col("b.months") < fixed.SHORTEST_SPAN_MONTHS
    blocked = empty | all_null | F.col("b.same") | short
    rate = F.rint(F.try_divide(F.col("b.period_rows").cast("double"), F.col("b.months")))
    return best.select(
        *labels,
        F.when(~blocked, rate.cast("bigint")).alias("growth"),
        F.when(empty, F.lit("EMPTY_TABLE"))
        .when(all_null, noted("ALL_NULL"))
        .when(F.col("b.same"), noted("MIN_EQUALS_MAX"))
        .when(short, F.lit("SPAN_TOO_SHORT"))
        .otherwise(F.when(windowed, noted("WINDOW")).otherwise(noted("MIN_TO_MAX")))
        .alias("note"),
        F.when(empty, F.lit(""))
        .otherwise(
            F.concat(F.col("b.name"), F.lit(", start_date: "),
                     F.coalesce(F.col("b.since"), F.lit("")))
        )
        .alias("time_info"),
    )


def growth_rates(registry, keys, start=None, end=None) -> DataFrame:
    """Growth of several tables."""
    return union_all([growth_rate(registry.table(s, t), s, t, start, end) for s, t in keys])
