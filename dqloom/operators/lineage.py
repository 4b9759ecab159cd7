"""Lineage: where rows come from, and quality per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions import naming
from dqloom.functions.numbers import pct
from dqloom.operators.keyed import with_presence

SOURCE_NAME_PARTS = ("created_by", "source", "data_source", "origin", "import_batch")
SOURCE_RULES = (
    ("migration", ("migration", "legacy", "import")),
    ("device", ("device", "sensor", "monitor")),
    ("api", ("api", "http", "feed")),
    ("manual", ("user", "manual", "form")),
)


def source_columns(columns: DataFrame, parts: Sequence[str] = SOURCE_NAME_PARTS) -> DataFrame:
    """Inventory columns whose name tells where a row came from."""
    return columns.filter(naming.has_part(F.col("column_name"), parts))


def entry_source(value: Column, rules=SOURCE_RULES, default: str = "other") -> Column:
    """Kind of source by substring of its name."""
    return naming.first_label(((naming.has_part(value, words), kind) for kind, words in rules),
                              default)


def quality_by_source(
    frame: DataFrame,
    source: Column,
    checked_column: str,
    valid: Column,
    parent: DataFrame | None = None,
    pairs: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Rows, NULL, placeholder, invalid and orphan shares per source, in one grouping."""
    value = F.col(checked_column)
    dirty = naming.is_dirty(value, frame.schema[checked_column].dataType.simpleString())
    rows = frame
    orphan = F.lit(False)
    if parent is not None:
        rows = with_presence(frame, parent, pairs, "_known")
        complete = F.lit(True)
        for key, _ in pairs:
            complete = complete & F.col(key).isNotNull()
        orphan = complete & ~F.col("_known")
    counted = rows.groupBy(source.alias("source")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(value.isNull()).alias("_null"),
        F.count_if(F.lit(False) if dirty is None else dirty).alias("_dirty"),
        F.count_if(~valid).alias("_invalid"),
        F.count_if(orphan).alias("_orphan"),
    )
    total = F.col("row_count")
    return counted.select(
        "source",
        "row_count",
        *[pct(F.col(f"_{kind}"), total).alias(f"{kind}_pct")
          for kind in ("null", "dirty", "invalid", "orphan")],
    )
