"""The uniform result table, verdicts and report files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqloom.functions.numbers import verdict

RESULT_SCHEMA = (
    "dimension string, step int, check_id string, kind string, schema_name string, "
    "table_name string, columns string, checked_count bigint, violation_count bigint, "
    "violation_pct double, status string, details string"
)


def _result(
    frame: DataFrame, dimension: str, step: int, *, check_id: Column, kind: Column,
    schema: Column, table: Column, columns: Column, violations: str, share: str, details: Column,
) -> DataFrame:
    return frame.select(
        F.lit(dimension).alias("dimension"),
        F.lit(step).alias("step"),
        check_id.alias("check_id"),
        kind.alias("kind"),
        schema.alias("schema_name"),
        table.alias("table_name"),
        columns.alias("columns"),
        F.col("checked_count").cast("bigint").alias("checked_count"),
        F.col(violations).cast("bigint").alias("violation_count"),
        F.col(share).alias("violation_pct"),
        verdict(F.col(violations)).alias("status"),
        details.alias("details"),
    )


def orphan_results(checked: DataFrame) -> DataFrame:
    return _result(
        checked, "consistency", 2,
        check_id=F.col("constraint_name"), kind=F.lit("orphan"),
        schema=F.col("child_schema"), table=F.col("child_table"), columns=F.col("fk_column"),
        violations="orphan_count", share="orphan_pct",
        details=F.concat_ws(
            ".", "parent_schema", "parent_table", "parent_column"
        ),
    )


def pattern_results(checked: DataFrame, rules: DataFrame) -> DataFrame:
    """Pattern results with the columns compared and the reason of a failure."""
    named = rules.select(
        F.col("id").alias("rule_id"),
        F.split(F.coalesce("table", "total_table"), r"\.").alias("_table"),
        F.when(F.col("pattern") == "date_order", F.concat_ws(", ", "start_column", "end_column"))
        .when(
            F.col("pattern") == "total_detail",
            F.concat_ws(
                ", ",
                F.concat_ws(".", "total_table", "total_column"),
                F.concat_ws(".", "detail_table", "detail_column"),
            ),
        )
        .otherwise(F.col("status_column"))
        .alias("_columns"),
        F.array_join("terminal_values", ", ").alias("_terminal"),
    )
    count = F.col("violation_count").cast("string")
    reason = (
        F.when(F.col("violation_count") == 0, F.lit(""))
        .when(F.col("pattern") == "date_order", F.concat(count, F.lit(" record(s) start >= end")))
        .when(
            F.col("pattern") == "total_detail",
            F.concat(count, F.lit(" record(s) total differs from details")),
        )
        .otherwise(
            F.concat(count, F.lit(" entity(ies) latest status not in "), F.col("_terminal"))
        )
    )
    joined = checked.join(named, "rule_id")
    return _result(
        joined, "consistency", 3,
        check_id=F.col("rule_id"), kind=F.col("pattern"),
        schema=F.get("_table", F.lit(0)), table=F.get("_table", F.lit(1)),
        columns=F.col("_columns"), violations="violation_count", share="violation_pct",
        details=reason,
    )


def enum_results(checked: DataFrame) -> DataFrame:
    parts = F.split("column", r"\.")
    return _result(
        checked, "consistency", 4,
        check_id=F.col("rule_id"), kind=F.lit("enum"),
        schema=F.get(parts, F.lit(0)), table=F.get(parts, F.lit(1)), columns=F.get(parts, F.lit(2)),
        violations="invalid_count", share="invalid_pct",
        details=F.when(
            F.col("invalid_count") > 0,
            F.concat(F.col("invalid_distinct_count").cast("string"), F.lit(" invalid value(s)")),
        ).otherwise(F.lit("")),
    )


def cross_table_results(checked: DataFrame) -> DataFrame:
    source, target = F.split("source", r"\."), F.col("target")
    return _result(
        checked, "consistency", 5,
        check_id=F.col("rule_id"), kind=F.col("pattern"),
        schema=F.get(source, F.lit(0)), table=F.get(source, F.lit(1)),
        columns=F.get(source, F.lit(2)), violations="violation_count", share="violation_pct",
        details=target,
    )


def duplicate_results(checked: DataFrame) -> DataFrame:
    """Technical duplicates (step 2), or UNIQUE rechecks (step 4) if a constraint is named."""
    unique = "constraint_name" in checked.columns
    return _result(
        checked, "uniqueness", 4 if unique else 2,
        check_id=F.col("constraint_name") if unique
        else F.concat_ws(".", "schema_name", "table_name"),
        kind=F.lit("unique" if unique else "technical_duplicate"),
        schema=F.col("schema_name"), table=F.col("table_name"), columns=F.col("columns"),
        violations="duplicate_row_count", share="duplicate_pct",
        details=F.concat(F.col("duplicate_group_count").cast("string"), F.lit(" group(s)")),
    )


def skipped_results(pending: DataFrame) -> DataFrame:
    """Rules that are not confirmed or not valid, so that a run shows what it left out."""
    return pending.select(
        "dimension",
        F.lit(None).cast("int").alias("step"),
        F.col("id").alias("check_id"),
        F.col("pattern").alias("kind"),
        F.lit(None).cast("string").alias("schema_name"),
        F.lit(None).cast("string").alias("table_name"),
        F.lit(None).cast("string").alias("columns"),
        F.lit(0).cast("bigint").alias("checked_count"),
        F.lit(0).cast("bigint").alias("violation_count"),
        F.lit(0.0).alias("violation_pct"),
        F.lit("SKIPPED").alias("status"),
        F.col("reason").alias("details"),
    )


def write_results(
    results: DataFrame, path: str, fmt: str = "parquet", steps: Sequence[tuple[str, int]] = ()
) -> None:
    """Replace the results of the dimensions and steps in ``results``, keep all others.

    ``steps`` are (dimension, step) pairs that this run covered: those without a result now,
    as all their rules were withdrawn, are cleared. Rows must have the uniform schema. The checks run once: what was
    written is counted while it is written.
    """
    wanted = StructType.fromDDL(RESULT_SCHEMA)
    found = {f.name: f.dataType for f in results.schema}
    if found != {f.name: f.dataType for f in wanted}:
        raise ValueError(f"results have the columns {results.schema.simpleString()}")
    covered = sorted(set(steps))
    written = Observation()
    rows = results.select(*wanted.names)
    if covered:
        rows = rows.observe(written, *[
            F.count_if((F.col("dimension") == d) & (F.col("step") == s)).alias(f"n{i}") for i, (d, s) in enumerate(covered)
        ])
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dimension", "step")
        .format(fmt)
        .save(path)
    )
    spark = results.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for i, (dimension, step) in enumerate(covered):
        if written.get[f"n{i}"]:
            continue
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            f"{path}/dimension={dimension}/step={step}"
        )
        place.getFileSystem(hadoop).delete(place, True)


def write_completeness(found: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Write the table, column and pending reports of a completeness run, replacing the last."""
    for name, report in found.items():
        report.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
