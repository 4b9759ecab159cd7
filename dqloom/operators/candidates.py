"""Rule candidates from names, types and keys, and the gates before a check may run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions import fixed_values as fixed
from dqloom.functions import naming
from dqloom.operators.completeness import warned
from dqloom.operators.inventory import composite_keys

TABLE = ["schema_name", "table_name"]
COLUMN = [*TABLE, "column_name"]


def _pending(rule_id: Column, dimension: str, step: str, pattern: str) -> list[Column]:
    return [
        rule_id.alias("id"),
        F.lit(dimension).alias("dimension"),
        F.lit(step).alias("step"),
        F.lit("need_check").alias("status"),
        F.lit("data-owner").alias("owner"),
        F.lit(pattern).alias("pattern"),
    ]


def prepare_tiers(tables: DataFrame, rules: DataFrame) -> DataFrame:
    """One tier rule per table: a valid assigned tier, else the suggestion, else pending."""
    known = (
        rules.filter(F.col("schema_name").isNotNull() & F.col("table_name").isNotNull())
        .groupBy(*TABLE)
        .agg(F.max(F.struct("id", "owner", "tier")).alias("r"))
    )
    joined = tables.select(*TABLE).join(known, TABLE, "left")
    assigned = naming.normalized_tier(F.col("r.tier"))
    suggested = naming.suggested_tier(F.col("table_name"))
    owner_if_none = F.when(F.col("r").isNull(), F.lit("data-owner")).otherwise(F.col("r.owner"))
    tier = F.coalesce(assigned, suggested)
    return joined.select(
        F.coalesce("r.id", F.concat_ws("-", *TABLE, F.lit("tier"))).alias("id"),
        F.when(tier.isNotNull(), F.lit("confirmed")).otherwise(F.lit("need_check")).alias("status"),
        F.when(assigned.isNotNull(), F.col("r.owner"))
        .when(suggested.isNotNull(), F.lit("system"))
        .otherwise(owner_if_none)
        .alias("owner"),
        *TABLE,
        tier.alias("tier"),
    )


def tables_without_tier(tables: DataFrame, rules: DataFrame) -> DataFrame:
    """Tables that have no valid tier yet; the tier gate is open when there is none."""
    assigned = rules.filter(naming.normalized_tier(F.col("tier")).isNotNull()).select(*TABLE)
    return tables.select(*TABLE).join(assigned, TABLE, "left_anti")


def classify_tables(tables: DataFrame, tiers: DataFrame) -> DataFrame:
    """Add the confirmed tier, ``need_check`` where there is none."""
    named = tiers.select(*TABLE, F.col("tier").cast("string").alias("classification"))
    return tables.join(named, TABLE, "left").na.fill({"classification": "need_check"})


def _with_class(rules: DataFrame) -> DataFrame:
    if "classification" not in rules.columns:
        return rules
    named = F.when(F.trim("null_classify") != "", F.col("null_classify"))
    return rules.withColumn("null_classify", F.coalesce(named, "classification"))


def prepare_null_rules(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """One NULL-class rule per warned column: assigned, suggested by name, or pending.

    ``classification`` is read where a rule has no ``null_classify``.
    """
    known = (
        _with_class(rules).filter(F.col("schema_name").isNotNull() & F.col("column_name").isNotNull())
        .groupBy(*COLUMN)
        .agg(F.max(F.struct("id", "owner", "null_classify")).alias("r"))
    )
    joined = warned(columns).select(*COLUMN).join(known, COLUMN, "left")
    trimmed = F.trim("r.null_classify")
    assigned = F.when(trimmed != "", trimmed)
    suggested = naming.null_class(F.col("column_name"))
    value = F.coalesce(assigned, suggested)
    owner_if_none = F.when(F.col("r").isNull(), F.lit("data-owner")).otherwise(F.col("r.owner"))
    return joined.select(
        F.coalesce("r.id", F.concat_ws("-", F.lit("auto"), *COLUMN)).alias("id"),
        F.when(value.isNotNull(), F.lit("confirmed")).otherwise(F.lit("need_check")).alias(
            "status"
        ),
        F.when(assigned.isNotNull(), F.col("r.owner"))
        .when(suggested.isNotNull(), F.lit("system"))
        .otherwise(owner_if_none)
        .alias("owner"),
        *COLUMN,
        value.alias("null_classify"),
    )


def columns_without_class(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """Warned columns without a NULL class; the gate is open when there is none."""
    named = _with_class(rules).filter(F.trim("null_classify") != "").select(*COLUMN)
    return warned(columns).select(*COLUMN).join(named, COLUMN, "left_anti")


def unknown_null_classes(rules: DataFrame) -> DataFrame:
    """Rules whose NULL class is none of the known ones."""
    return rules.filter(
        F.col("null_classify").isNotNull() & ~F.col("null_classify").isin(*fixed.NULL_CLASSES)
    )


def date_order_candidates(columns: DataFrame) -> DataFrame:
    """Every start-like date column with every end-like date column of the same table."""
    dates = columns.filter(naming.is_type(F.col("data_type"), fixed.DATE_TYPES))
    name = F.col("column_name")
    starts = dates.filter(naming.has_token(name, fixed.START_TOKENS)).select(
        *TABLE, name.alias("start_column")
    )
    ends = dates.filter(naming.has_token(name, fixed.END_TOKENS)).select(
        *TABLE, name.alias("end_column")
    )
    rule_id = F.concat_ws(
        "-", F.lit("auto"), *TABLE, "start_column", "end_column", F.lit("date-order")
    )
    return starts.join(ends, TABLE).select(
        *_pending(rule_id, "consistency", "pattern_check", "date_order"),
        F.concat_ws(".", *TABLE).alias("table"),
        "start_column",
        "end_column",
        F.lit("<").alias("operator"),
    )


def status_candidates(columns: DataFrame) -> DataFrame:
    """A latest-status rule to fill in for every status-like column."""
    found = columns.filter(naming.has_token(F.col("column_name"), fixed.STATUS_TOKENS))
    rule_id = F.concat_ws("-", F.lit("auto"), *COLUMN, F.lit("status"))
    return found.select(
        *_pending(rule_id, "consistency", "pattern_check", "status_terminal"),
        F.concat_ws(".", *TABLE).alias("table"),
        F.col("column_name").alias("status_column"),
    )


def total_detail_placeholder(columns: DataFrame) -> DataFrame:
    """The one total-against-detail rule that people must fill in."""
    return columns.sparkSession.range(1).select(
        *_pending(F.lit("business-total-detail"), "consistency", "pattern_check", "total_detail")
    )


def pattern_candidates(columns: DataFrame) -> DataFrame:
    """Date-order and status candidates and the total placeholder."""
    return (
        date_order_candidates(columns)
        .unionByName(status_candidates(columns), allowMissingColumns=True)
        .unionByName(total_detail_placeholder(columns), allowMissingColumns=True)
    )


def enum_candidates(columns: DataFrame) -> DataFrame:
    """An enumeration rule with an empty value list for every enumeration-like column."""
    found = columns.filter(naming.has_token(F.col("column_name"), fixed.ENUM_TOKENS))
    return found.select(
        *_pending(
            F.concat_ws("-", F.lit("auto"), *COLUMN, F.lit("enum")),
            "consistency", "enum_check", "enum",
        ),
        F.concat_ws(".", *COLUMN).alias("column"),
        F.array().cast("array<string>").alias("allowed_values"),
    )


def cross_table_candidates(columns: DataFrame, edges: DataFrame) -> DataFrame:
    """Same-named columns of a child and its parent, the child's key columns left out."""
    sides = ["from_schema", "from_table", "to_schema", "to_table"]
    by = ["constraint_name", *sides]
    keys = composite_keys(edges, by, "column_position", ["from_column", "to_column"])
    child = columns.select(
        F.col("schema_name").alias("from_schema"),
        F.col("table_name").alias("from_table"),
        "column_name",
    )
    parent = columns.select(
        F.col("schema_name").alias("to_schema"),
        F.col("table_name").alias("to_table"),
        "column_name",
    )
    shared = (
        keys.join(child, ["from_schema", "from_table"])
        .join(parent, ["to_schema", "to_table", "column_name"])
        .filter(~F.array_contains("from_column", F.col("column_name")))
    )
    pairs = F.zip_with(
        "to_column",
        "from_column",
        lambda to, frm: F.struct(
            F.concat_ws(".", "to_schema", "to_table", to).alias("source"),
            F.concat_ws(".", "from_schema", "from_table", frm).alias("target"),
        ),
    )
    rule_id = F.concat_ws(
        "-", F.lit("auto"), "from_schema", "from_table", "to_table", "column_name",
        F.lit("cross-table"),
    )
    return shared.select(
        *_pending(rule_id, "consistency", "cross_table_check", "duplicated_value"),
        F.concat_ws(".", "to_schema", "to_table", "column_name").alias("source"),
        F.concat_ws(".", "from_schema", "from_table", "column_name").alias("target"),
        pairs.alias("join"),
        F.lit("exclude_if_either_null").alias("null_policy"),
    )
