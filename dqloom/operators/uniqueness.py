"""Uniqueness: technical duplicates, UNIQUE recheck, duplicates by normalised key."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions import naming
from dqloom.functions.numbers import pct
from dqloom.operators import shared
from dqloom.operators.inventory import UNIQUE, composite_keys
from dqloom.operators.keyed import all_not_null, group_sizes, grouping_keys, union_all

TABLE = ["schema_name", "table_name"]


def scope(columns: DataFrame, tiers: DataFrame) -> DataFrame:
    """Tier-1 tables that are not infrastructure, with their business columns in order."""
    first = tiers.filter(naming.is_tier_one(F.col("tier"))).select(*TABLE)
    business = columns.filter(~naming.is_excluded_table(F.col("table_name"))).filter(
        ~naming.is_technical_column(F.col("column_name"), F.col("data_type"), F.col("pk"))
    )
    in_scope = business.join(first, TABLE, "left_semi")
    return composite_keys(in_scope, TABLE, "position", ["column_name"]).withColumnRenamed(
        "column_name", "columns"
    )


def unique_scope(constraints: DataFrame, tables: DataFrame) -> DataFrame:
    """Declared UNIQUE constraints of the tables in scope, columns in key order."""
    declared = constraints.filter(F.col("constraint_type") == UNIQUE).filter(
        ~naming.is_excluded_table(F.col("table_name"))
    )
    kept = declared.join(tables.select(*TABLE), TABLE, "left_semi")
    grouped = composite_keys(kept, [*TABLE, "constraint_name"], "ordinal_position", ["column_name"])
    return grouped.withColumnRenamed("column_name", "columns")


def out_of_scope(tiers: DataFrame, scoped: DataFrame) -> DataFrame:
    """Tier-1 tables that the scan leaves out, with the reason."""
    first = tiers.filter(naming.is_tier_one(F.col("tier"))).select(*TABLE)
    return first.join(scoped, TABLE, "left_anti").withColumn(
        "reason",
        F.when(naming.is_excluded_table(F.col("table_name")), F.lit("INFRASTRUCTURE")).otherwise(
            F.lit("NO_BUSINESS_COLUMN")
        ),
    )


def duplicate_counts(sizes: DataFrame) -> DataFrame:
    """Checked rows, duplicate groups, rows in them and their share, from group sizes."""
    n = F.col("record_count")
    counted = sizes.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("checked_count"),
        F.count_if(n > 1).alias("duplicate_group_count"),
        F.coalesce(F.sum(F.when(n > 1, n).otherwise(F.lit(0))), F.lit(0)).alias(
            "duplicate_row_count"
        ),
    )
    return counted.withColumn(
        "duplicate_pct", pct(F.col("duplicate_row_count"), F.col("checked_count"))
    )


def duplicates(
    frame: DataFrame, schema: str, table: str, columns: Sequence[str], constraint: str | None = None
) -> DataFrame:
    """Rows that share all values of ``columns``; rows with a NULL among them are left out."""
    if not columns:
        raise ValueError("columns must not be empty")
    labels = [F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name")]
    if constraint is not None:
        labels.append(F.lit(constraint).alias("constraint_name"))
    return duplicate_counts(group_sizes(frame, columns)).select(
        *labels, F.lit(", ".join(columns)).alias("columns"), "*"
    )


def duplicates_of(registry, scoped: Sequence[tuple[str, str, Sequence[str]]]) -> DataFrame:
    """:func:`duplicates` of several (schema, table, columns)."""
    return union_all([duplicates(registry.table(s, t), s, t, c) for s, t, c in sorted(scoped)])


def unique_checks(registry, declared: Sequence[tuple[str, str, str, Sequence[str]]]) -> DataFrame:
    """Rows that break each declared (schema, table, constraint, columns).

    All constraints share one plan that scans each table once.
    """
    labels = registry.spark.createDataFrame(
        [(i, s, t, name, ", ".join(c)) for i, (s, t, name, c) in enumerate(declared)],
        "check int, schema_name string, table_name string, constraint_name string, columns string",
    )
    tables = {(s, t): registry.table(s, t) for s, t, _, _ in declared}
    return shared.duplicate_counts(tables, [((s, t), c) for s, t, _, c in declared], labels)


def _accent_map() -> tuple[str, str]:
    """Lower-case letters with a mark and their base letters, from the Unicode tables."""
    pairs = {"đ": "d", "ø": "o", "ł": "l"}
    for code in [*range(0x00E0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.islower():
            pairs[chr(code)] = base
    return "".join(pairs), "".join(pairs.values())


def unaccented(value: Column) -> Column:
    """Lower case, accents removed, runs of blanks made one: for comparing names.

    A letter with a combining mark and the ready-made letter compare equal: marks are
    dropped, ready-made letters are mapped to their base letter.
    """
    lowered = F.lower(value)
    bare = F.translate(F.regexp_replace(lowered, r"[\u0300-\u036f]", ""), *_accent_map())
    plain = F.when(lowered.rlike(r"[^\x00-\x7f]"), bare).otherwise(lowered)
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def business_key_duplicates(
    frame: DataFrame, schema: str, table: str, keys: Mapping[str, Column]
) -> DataFrame:
    """Duplicates of normalised key expressions, given as name -> expression."""
    keyed = frame.select(*[expression.alias(name) for name, expression in keys.items()])
    return duplicates(keyed, schema, table, list(keys))


def duplicate_impact(frame: DataFrame, columns: Sequence[str], period: Column) -> DataFrame:
    """Rows in duplicate groups per period, and their share of the period.

    Rows are counted per (key, period) before the key's total is looked up, so a hot key
    arrives as one row per period.
    """
    kept = frame.filter(all_not_null(columns))
    keyed = kept.select(*grouping_keys(kept, columns), period.alias("period"))
    names = keyed.columns[:-1]
    per_period = keyed.groupBy(*names, "period").agg(F.count(F.lit(1)).alias("n"))
    totals = per_period.groupBy(*names).agg(F.sum("n").alias("group_rows"))
    joined = per_period.join(totals, names)
    repeated = F.when(F.col("group_rows") > 1, F.col("n")).otherwise(F.lit(0))
    return joined.groupBy("period").agg(
        F.sum("n").alias("checked_count"), F.sum(repeated).alias("duplicate_row_count")
    ).withColumn("duplicate_pct", pct(F.col("duplicate_row_count"), F.col("checked_count")))
