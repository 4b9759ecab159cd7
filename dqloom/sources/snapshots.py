"""Saved profiles: writing, reading back, ageing, reconciling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions import fixed_values as fixed
from dqloom.functions.timewindow import elapsed_seconds


def shared_folder(spark: SparkSession, unset: str | None = None) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    ``unset`` is taken only where the cluster names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or unset
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set")
    return folder


def save_snapshot(profile: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a profile, replacing the one before."""
    profile.write.mode("overwrite").format(fmt).save(path)
    return path


def load_snapshot(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    refresh: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """The saved profile if there is one and no refresh is asked for, else a new one.

    Age does not matter here; see :func:`freshness` for what is due.
    """
    if not refresh:
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException as problem:
            if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    save_snapshot(build(), path, fmt)
    return spark.read.format(fmt).load(path)


def nested_profile(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per table with its columns as an array, the shape of a saved profile."""
    by = ["schema_name", "table_name"]
    others = [c for c in columns.columns if c not in (*by, "position")]
    listed = columns.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("position", *others))).alias("columns")
    )
    return tables.join(listed, by, "left")


def freshness(
    statistics: DataFrame, now: Column, max_age_days: int = fixed.MAX_AGE_DAYS
) -> DataFrame:
    """Age of the statistics of each table and whether they are due.

    ``last_analyze`` is the later of the manual and the automatic run; never analysed, or
    older than ``max_age_days``, means due. ``now`` has the type of these columns; times
    without zone are UTC on both sides.
    """
    if max_age_days < 0:
        raise ValueError("max_age_days must not be negative")
    last = F.greatest("last_manual", "last_auto")
    with_zone = isinstance(statistics.schema["last_manual"].dataType, T.TimestampType)
    age = elapsed_seconds(last, now, with_zone) / F.lit(86_400.0)
    return statistics.select(
        "schema_name",
        "table_name",
        last.alias("last_analyze"),
        age.alias("age_days"),
        (last.isNull() | (age > max_age_days)).alias("needs_analyze"),
    )


def reconcile(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: new rows are added, changed rows replaced, absent rows kept.

    ``change`` says NEW, CHANGED, SAME or ABSENT. Columns that only ``existing`` has would be
    lost, so they are an error.
    """
    lost = [c for c in existing.columns if c not in incoming.columns]
    if lost:
        raise ValueError(f"incoming rows lack the columns {', '.join(lost)}")
    values = [c for c in incoming.columns if c not in keys]
    old = existing.select(*keys, F.struct(*values).alias("_old"))
    new = incoming.select(*keys, F.struct(*values).alias("_new"))
    joined = old.join(new, list(keys), "full_outer")
    kept = F.coalesce("_new", "_old")
    return joined.select(
        *keys,
        *[kept.getField(v).alias(v) for v in values],
        F.when(F.col("_old").isNull(), F.lit("NEW"))
        .when(F.col("_new").isNull(), F.lit("ABSENT"))
        .when(F.col("_old").eqNullSafe(F.col("_new")), F.lit("SAME"))
        .otherwise(F.lit("CHANGED"))
        .alias("change"),
    )


