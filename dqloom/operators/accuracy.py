"""Accuracy: codes outside a reference list, stratified samples, coverage of the checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqloom.operators.keyed import key_presence


def unknown_codes(
    frame: DataFrame, reference: DataFrame, column: str, reference_column: str
) -> DataFrame:
    """Codes that the reference list lacks, with the rows that use them."""
    used = key_presence(frame, reference, [(column, reference_column)])
    return used.filter(~F.col("known")).select(
        F.col("k0").alias("code"), F.col("uses").alias("affected_rows")
    )


def stratified_sample(
    frame: DataFrame, strata: Sequence[Column], row_id: Sequence[str], size: int, seed: int = 0
) -> DataFrame:
    """``size`` rows per stratum in random but repeatable order.

    The order is a digest of the row id and a seed. Each task keeps its best ``size`` rows
    per stratum before the shuffle, so a hot stratum does not gather.
    """
    names = [f"_s{i}" for i in range(len(strata))]
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in row_id], F.lit(str(seed))))
    order = Window.partitionBy(*names).orderBy("_digest", *row_id)
    return (
        frame.select("*", *[s.alias(n) for s, n in zip(strata, names)], digest.alias("_digest"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= size)
        .drop(*names, "_digest", "_rank")
    )


def coverage_note(gates: DataFrame, results: DataFrame) -> DataFrame:
    """Per step: how many checks ran on how many rows, or why none did."""
    by = ["dimension", "step"]
    ran = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("checks_run"), F.sum("checked_count").alias("rows_checked")
    )
    joined = gates.join(ran, by, "left").na.fill(0)
    return joined.select(
        *by,
        "checks_run",
        "rows_checked",
        F.when(F.col("checks_run") > 0, F.lit("CHECKED"))
        .when(F.col("rule_count") == 0, F.lit("NO_RULES"))
        .when(~F.col("may_start"), F.lit("NOT_CONFIRMED"))
        .otherwise(F.lit("NOT_RUN"))
        .alias("coverage"),
    )
