"""Business rules as a table: reading, selecting, validating, gating, merging."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.functions.text import reference_error

RULE_FIELDS = {
    "id": "string", "dimension": "string", "step": "string", "status": "string",
    "owner": "string", "pattern": "string", "note": "string",
    # date_order, status_terminal
    "table": "string", "start_column": "string", "end_column": "string", "operator": "string",
    "status_column": "string", "entity_columns": "array<string>", "event_time_column": "string",
    "tie_breakers": "array<string>", "terminal_values": "array<string>",
    "require_terminal": "boolean",
    # total_detail
    "total_table": "string", "total_column": "string", "detail_table": "string",
    "detail_column": "string", "join_columns": "array<struct<total:string,detail:string>>",
    "tolerance": "double",
    # enum
    "column": "string", "allowed_values": "array<string>",
    # duplicated_value
    "source": "string", "target": "string",
    "join": "array<struct<source:string,target:string>>", "null_policy": "string",
}
RULE_SCHEMA = ", ".join(f"`{name}` {kind}" for name, kind in RULE_FIELDS.items())
TIER_SCHEMA = (
    "id string, status string, owner string, schema_name string, table_name string, tier string"
)
NULL_RULE_SCHEMA = (
    "id string, status string, owner string, schema_name string, table_name string, "
    "column_name string, null_classify string"
)
NOT_NULL_RULE_SCHEMA = (
    "id string, status string, owner string, schema_name string, table_name string, "
    "column_name string, not_nullable string"
)
NULL_POLICIES = ("exclude_if_either_null", "nulls_are_different")


def read_rules(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Rule table from JSON lines or Parquet; absent fields are NULL."""
    return spark.read.schema(RULE_SCHEMA).format(fmt).load(path)


def rules_frame(spark: SparkSession, rules: list[dict[str, Any]]) -> DataFrame:
    """Rule table from literals, kept to the rule schema."""
    rows = [tuple(rule.get(name) for name in RULE_FIELDS) for rule in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def confirmed(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("status") == "confirmed")


def references(rules: DataFrame) -> DataFrame:
    """``rule_id, schema_name, table_name, column_name``: the columns that rules compare."""

    def within(table: str, *columns: str) -> list[Column]:
        return [F.concat_ws(".", table, c) for c in columns]

    by_pattern = {
        "date_order": within("table", "start_column", "end_column"),
        "status_terminal": within("table", "status_column", "event_time_column"),
        "total_detail": [
            *within("total_table", "total_column"), *within("detail_table", "detail_column")
        ],
        "enum": [F.col("column")],
        "duplicated_value": [F.col("source"), F.col("target")],
    }
    named = F.array()
    for pattern, columns in by_pattern.items():
        named = F.when(F.col("pattern") == pattern, F.array(*columns)).otherwise(named)
    parts = rules.select(F.col("id").alias("rule_id"), F.explode(named).alias("name")).select(
        "rule_id", F.split("name", r"\.").alias("part")
    )
    return parts.filter(F.size("part") == 3).select(
        "rule_id",
        F.get("part", F.lit(0)).alias("schema_name"),
        F.get("part", F.lit(1)).alias("table_name"),
        F.get("part", F.lit(2)).alias("column_name"),
    )


def unknown_references(rules: DataFrame, columns: DataFrame) -> DataFrame:
    """``rule_id, error`` for every column a rule names that the inventory does not have."""
    by = ["schema_name", "table_name", "column_name"]
    lost = references(rules).join(columns.select(*by), by, "left_anti")
    return lost.select(
        "rule_id", F.concat(F.lit("unknown column "), F.concat_ws(".", *by)).alias("error")
    )


def planned(rules: DataFrame, columns: DataFrame | None = None) -> list[dict[str, Any]]:
    """Confirmed, valid rules ordered by id, for building one check each.

    With the column inventory, rules that name unknown columns are left out.
    """
    if columns is not None:
        lost = unknown_references(rules, columns).select(F.col("rule_id").alias("id"))
        rules = rules.join(lost, "id", "left_anti").select(*rules.columns)
    return [rule for group in planned_groups(rules, 1000) for rule in group]


def planned_groups(rules: DataFrame, size: int) -> Iterator[list[dict[str, Any]]]:
    """The planned rules in groups of at most ``size``, fetched group by group.

    A run over very many rules plans and writes one group after the other, so that no plan
    grows with their number.
    """
    valid = confirmed(rules)
    valid = valid.join(validation_errors(rules), valid["id"] == F.col("rule_id"), "left_anti")
    group: list[dict[str, Any]] = []
    for row in valid.orderBy("id").toLocalIterator():
        group.append(row.asDict(recursive=True))
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name)) == "")


def _empty(name: str) -> Column:
    return F.col(name).isNull() | (F.size(name) == 0)


def _has_null(name: str) -> Column:
    return F.coalesce(F.exists(name, lambda item: item.isNull()), F.lit(False))


def _bad_pair(name: str, left: str, right: str) -> Column:
    def bad(pair: Column) -> Column:
        return F.coalesce((pair[left] == "") | (pair[right] == ""), F.lit(True))

    return F.coalesce(F.exists(name, bad), F.lit(False))


def validation_errors(rules: DataFrame) -> DataFrame:
    """``rule_id, error``: one row per thing wrong with a rule; valid rules give none."""

    def when(pattern: str, *checks: tuple[Column, str]) -> list[Column]:
        return [
            F.when((F.col("pattern") == pattern) & condition, F.lit(message))
            for condition, message in checks
        ]

    def missing(pattern: str, *names: str) -> list[Column]:
        return when(pattern, *[(_blank(name), f"missing {name}") for name in names])

    def misshaped(pattern: str, name: str, parts: int) -> Column:
        return F.when(
            (F.col("pattern") == pattern) & ~_blank(name), reference_error(F.col(name), parts)
        )

    def bad_join_reference() -> Column:
        return F.coalesce(
            F.exists("join", lambda pair: reference_error(pair["source"], 3).isNotNull()
                     | reference_error(pair["target"], 3).isNotNull()),
            F.lit(False),
        )

    errors = [
        F.when(_blank("id"), F.lit("missing id")),
        F.when(_blank("pattern"), F.lit("missing pattern")),
        F.when(
            ~F.col("pattern").isin(
                "date_order", "total_detail", "status_terminal", "enum", "duplicated_value"
            ),
            F.lit("unsupported pattern"),
        ),
        *missing("date_order", "table", "start_column", "end_column"),
        misshaped("date_order", "table", 2),
        *when("date_order",
              (F.coalesce(~F.col("operator").isin("<", "<="), F.lit(False)),
               "unsupported operator")),
        *missing("total_detail", "total_table", "total_column", "detail_table", "detail_column"),
        misshaped("total_detail", "total_table", 2),
        misshaped("total_detail", "detail_table", 2),
        *when("total_detail",
              (_empty("join_columns"), "missing join_columns"),
              (_bad_pair("join_columns", "total", "detail"), "invalid join_columns"),
              (F.coalesce(F.isnan("tolerance"), F.lit(False)), "tolerance is not a number")),
        *missing("status_terminal", "table", "status_column", "event_time_column"),
        misshaped("status_terminal", "table", 2),
        *when("status_terminal",
              (_empty("entity_columns"), "missing entity_columns"),
              (_empty("terminal_values"), "missing terminal_values"),
              (_has_null("terminal_values"), "NULL in terminal_values"),
              (F.col("require_terminal").isNull(), "require_terminal is not a boolean")),
        *missing("enum", "column"),
        misshaped("enum", "column", 3),
        *when("enum",
              (_empty("allowed_values"), "missing allowed_values"),
              (_has_null("allowed_values"), "NULL in allowed_values")),
        *missing("duplicated_value", "source", "target"),
        misshaped("duplicated_value", "source", 3),
        misshaped("duplicated_value", "target", 3),
        *when("duplicated_value",
              (_empty("join"), "missing join"),
              (_bad_pair("join", "source", "target"), "invalid join"),
              (~_bad_pair("join", "source", "target") & bad_join_reference(),
               "invalid join reference"),
              (F.coalesce(~F.col("null_policy").isin(*NULL_POLICIES), F.lit(False)),
               "unsupported null_policy")),
    ]
    return rules.select(
        F.col("id").alias("rule_id"), F.explode(F.array_compact(F.array(*errors))).alias("error")
    )


def merge_new(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Existing rules plus the candidates whose id is new."""
    fresh = candidates.dropDuplicates(["id"]).join(existing.select("id"), "id", "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def document_status(rules: DataFrame, by: list[str]) -> DataFrame:
    """A rule set is ``confirmed`` as soon as one of its rules is, else ``draft``."""
    any_confirmed = F.coalesce(F.bool_or(F.col("status") == "confirmed"), F.lit(False))
    return rules.groupBy(*by).agg(
        F.when(any_confirmed, F.lit("confirmed")).otherwise(F.lit("draft")).alias("status")
    )


def readiness(rules: DataFrame, steps: DataFrame) -> DataFrame:
    """Gate rows per ``(dimension, step)``.

    ``may_start``: there is at least one confirmed rule. ``all_confirmed``: none is pending.
    """
    by = ["dimension", "step"]
    is_confirmed = F.col("status") == "confirmed"
    counted = rules.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rule_count"), F.count_if(is_confirmed).alias("confirmed_count")
    )
    joined = steps.select(*by).join(counted, by, "left").na.fill(0)
    return joined.withColumn("may_start", F.col("confirmed_count") > 0).withColumn(
        "all_confirmed", F.col("confirmed_count") == F.col("rule_count")
    )


def tier_conflicts(tiers: DataFrame) -> DataFrame:
    """Confirmed tier rules that cannot be used: a missing field, or two different tiers."""
    rules = confirmed(tiers)
    blank = _blank("schema_name") | _blank("table_name") | _blank("tier")
    incomplete = rules.filter(blank).select(
        "schema_name", "table_name", F.lit("INCOMPLETE").alias("problem")
    )
    conflicting = (
        rules.filter(~blank)
        .groupBy("schema_name", "table_name")
        .agg(F.count_distinct("tier").alias("tiers"))
        .filter(F.col("tiers") > 1)
        .select("schema_name", "table_name", F.lit("CONFLICT").alias("problem"))
    )
    return incomplete.unionByName(conflicting)


def table_tiers(tiers: DataFrame) -> DataFrame:
    """Confirmed tiers, one row per table; raises when a rule is incomplete or contradicts."""
    problem = tier_conflicts(tiers).first()
    if problem is not None:
        raise ValueError(
            f"Tier rule {problem['problem']}: {problem['schema_name']}.{problem['table_name']}"
        )
    return confirmed(tiers).groupBy("schema_name", "table_name").agg(F.max("tier").alias("tier"))
