"""Completeness: placeholders, NULL warnings, NULL by condition, table fill."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions import naming
from dqloom.functions.numbers import fixed_text, share
from dqloom.functions.text import quoted
from dqloom.operators.keyed import union_all
from dqloom.sources.registry import TableKey, TableRegistry


def dirty_cells(frame: DataFrame, by_value: bool = False) -> DataFrame:
    """``column_name, value, n``: placeholder values by column, plus the row count of the
    table under a NULL column name. One scan; only placeholder cells leave a task.
    """
    row = F.struct(F.lit(None).cast("string").alias("column_name"),
                   F.lit(None).cast("string").alias("value"))
    cells = []
    for f in frame.schema.fields:
        column = F.col(quoted(f.name))
        condition = naming.is_dirty(column, f.dataType.simpleString(), by_value)
        if condition is not None:
            cells.append(
                F.when(condition, F.struct(F.lit(f.name).alias("column_name"),
                                           column.cast("string").alias("value")))
            )
    dirty = F.array_compact(F.array(row, *cells))
    return (
        frame.select(F.inline(dirty))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def dirty_values(
    frame: DataFrame, schema: str, table: str, by_value: bool = False
) -> DataFrame:
    """``Pass`` or ``Failed: n value(s), m row(s) (share%)`` for every column of the table.

    The values are rows of :func:`dirty_value_counts`: dates match by their day, so a column may
    have any number of them.
    """
    per_column = dirty_cells(frame, by_value).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_count"), F.sum("n").alias("n")
    )
    # at most one row per column from here on; the NULL name carries the row count
    listed = per_column.groupBy().agg(
        F.max(F.when(F.col("column_name").isNull(), F.col("n"))).alias("total"),
        F.collect_list(F.struct("column_name", "distinct_count", "n")).alias("columns"),
    )
    names = F.array(*[F.lit(c) for c in frame.columns])
    rows = listed.select(F.explode(names).alias("column_name"), "total", "columns").select(
        "column_name",
        "total",
        F.expr("get(filter(columns, c -> c.column_name = column_name), 0)").alias("found"),
    )
    count, n = F.col("found.distinct_count"), F.col("found.n")
    failed = F.concat(
        F.lit("Failed: "), count.cast("string"), F.lit(" value(s), "), n.cast("string"),
        F.lit(" row(s) ("), fixed_text(share(n, F.col("total")), 2), F.lit("%)"),
    )
    return rows.select(
        F.lit(schema).alias("schema_name"),
        F.lit(table).alias("table_name"),
        "column_name",
        F.when(F.col("found").isNull(), F.lit("Pass")).otherwise(failed).alias("dirty_value_check"),
    )


def dirty_value_counts(registry: TableRegistry, keys: Iterable[TableKey], by_value: bool = False) -> DataFrame:
    """Every placeholder value with its count: ``schema_name, table_name, column_name, value, n``."""
    return union_all([
        dirty_cells(registry.table(s, t), by_value)
        .filter(F.col("column_name").isNotNull())
        .select(F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "column_name", "value", "n")
        for s, t in keys
    ])


def dirty_values_of(registry: TableRegistry, keys: Iterable[TableKey]) -> DataFrame:
    return union_all([dirty_values(registry.table(s, t), s, t) for s, t in keys])


def with_null_warning(columns: DataFrame, tiers: DataFrame) -> DataFrame:
    """Add the table's tier and the NULL warning to columns that carry ``null_pct``."""
    tier = tiers.select("schema_name", "table_name", F.col("tier").alias("table_tier"))
    return columns.join(tier, ["schema_name", "table_name"], "left").withColumn(
        "null_warning", naming.null_warning(F.col("null_pct"), F.col("table_tier"))
    )


def warned(columns: DataFrame) -> DataFrame:
    """Columns that need a NULL classification."""
    return columns.filter(F.col("null_warning").isin("CRITICAL", "SUSPECT"))


def classify_columns(
    columns: DataFrame, not_null_rules: DataFrame, null_rules: DataFrame, dirty: DataFrame
) -> DataFrame:
    """Add confirmed not-null and NULL-class rules and the placeholder check."""
    by = ["schema_name", "table_name", "column_name"]
    confirmed = F.col("status") == "confirmed"
    not_null = not_null_rules.filter(confirmed).select(*by, "not_nullable")
    classes = null_rules.filter(confirmed).select(*by, "null_classify")
    return (
        columns.join(not_null, by, "left")
        .join(classes, by, "left")
        .join(dirty.select(*by, "dirty_value_check"), by, "left")
        .na.fill({"not_nullable": "", "null_classify": "", "dirty_value_check": "Pass"})
    )


def fill_class(row_counts: DataFrame, small: int = 1000) -> DataFrame:
    """EMPTY, SMALL (fewer than ``small`` rows) or POPULATED per table."""
    n = F.col("row_count")
    return row_counts.withColumn(
        "fill_class",
        F.when(n == 0, F.lit("EMPTY")).when(n < small, F.lit("SMALL")).otherwise("POPULATED"),
    )


def null_by_condition(frame: DataFrame, target: str, condition: str) -> DataFrame:
    """How the NULLs of ``target`` spread over the values of ``condition``."""
    return (
        frame.filter(F.col(target).isNull())
        .groupBy(F.col(condition).alias("condition_value"))
        .agg(F.count(F.lit(1)).alias("null_count"))
    )
