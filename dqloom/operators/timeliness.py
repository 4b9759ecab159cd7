"""Timeliness: activity of tables, entry latency, history coverage, unusual frequency."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions.timewindow import elapsed_seconds


def table_activity(
    frame: DataFrame, schema: str, table: str, time: str, as_of: str,
    active_days: int = 30, doubtful_days: int = 365,
) -> DataFrame:
    """ACTIVE, DOUBTFUL or ABANDONED by the age of the newest row at ``as_of``."""
    newest = frame.agg(F.max(time).cast("timestamp_ntz").alias("newest"))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("newest").cast("date"))
    return newest.select(
        F.lit(schema).alias("schema_name"),
        F.lit(table).alias("table_name"),
        F.col("newest").cast("string").alias("newest"),
        age.alias("age_days"),
        F.when(F.col("newest").isNull(), F.lit("EMPTY"))
        .when(age <= active_days, F.lit("ACTIVE"))
        .when(age <= doubtful_days, F.lit("DOUBTFUL"))
        .otherwise(F.lit("ABANDONED"))
        .alias("activity"),
    )


DIGIT_BITS = 16


def exact_percentiles(
    frame: DataFrame, value: Column, shares: dict[str, float], times: Column | None = None
) -> DataFrame:
    """Exact percentiles of a whole number: the smallest value with enough rows up to it.

    A row counts once, or as often as ``times`` says.

    Radix selection: values minus the least one are counted by their highest ``DIGIT_BITS`` bits, then, among those that
    begin like a wanted value, by the next bits, until a value is left for each share. The range decides the
    number of passes, four at most; a pass brings the driver at most 2**DIGIT_BITS counts a share. No
    window and no task sees more than its own rows, however many values there are. Without rows there are none.
    """
    rows = F.count(F.lit(1)) if times is None else F.sum("times")
    weight = [] if times is None else [times.cast("bigint").alias("times")]
    values = frame.select(value.cast("bigint").alias("value"), *weight).filter(F.col("value").isNotNull())
    least, most, total = values.agg(F.min("value"), F.max("value"), rows).first()
    spark, schema = frame.sparkSession, "name string, value bigint"
    if not total:
        return spark.createDataFrame([], schema)
    # a decimal share: 100 * 0.07 is a little more than 7 in doubles
    ranks = {name: max(1, math.ceil(total * Decimal(str(share)))) for name, share in shares.items()}
    passes = -(-(most - least).bit_length() // DIGIT_BITS)
    begin = dict.fromkeys(shares, 0)  # the bits found so far
    # decimals, as the distance of two whole numbers may not fit into one
    apart = (F.col("value").cast("decimal(20,0)") - F.lit(Decimal(least))).cast("decimal(20,0)")
    for k in reversed(range(passes)):
        unit = F.lit(Decimal(2 ** (DIGIT_BITS * k))).cast("decimal(20,0)")
        head = F.floor((apart - apart % unit) / unit).cast("decimal(20,0)")
        digit = (head % 2**DIGIT_BITS).cast("int")
        before = ((head - digit) / 2**DIGIT_BITS).cast("decimal(20,0)")
        held = ["times"] if weight else []
        counted = values.select(before.alias("before"), digit.alias("digit"), *held).filter(
            F.col("before").isin([Decimal(x) for x in set(begin.values())])
        ).groupBy("before", "digit").agg(rows.alias("n"))
        counts: dict[int, list] = defaultdict(list)
        for row in counted.collect():
            counts[int(row["before"])].append((row["digit"], row["n"]))
        for name in shares:
            for digit_found, n in sorted(counts[begin[name]]):
                if ranks[name] <= n:
                    begin[name] = (begin[name] << DIGIT_BITS) + digit_found
                    break
                ranks[name] -= n
    return spark.createDataFrame([(name, least + begin[name]) for name in shares], schema)


def latency_seconds(frame: DataFrame, event: str, recorded: str) -> Column:
    """Whole seconds from one column to the other, rounded down."""
    with_zone = isinstance(frame.schema[event].dataType, T.TimestampType)
    return F.floor(elapsed_seconds(F.col(event), F.col(recorded), with_zone))


def entry_latency(frame: DataFrame, event: str, recorded: str) -> DataFrame:
    """Mean, quartiles, maximum and outliers of the time from event to recording.

    An outlier is later than the third quartile by more than 1.5 quartile distances. The frame is read once, for
    the number of rows of each latency; all else comes from these, which are kept for that long.
    """
    both = frame.filter(F.col(event).isNotNull() & F.col(recorded).isNotNull())
    seconds = latency_seconds(frame, event, recorded).alias("delay")
    delays = both.groupBy(seconds).agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        return _latency_summary(delays)
    finally:
        delays.unpersist()


def _latency_summary(delays: DataFrame) -> DataFrame:
    """The one row of :func:`entry_latency` from each ``delay`` and its number of rows ``n``."""
    delay, n = F.col("delay"), F.col("n")
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = {row["name"]: row["value"] for row in exact_percentiles(delays, delay, shares, n).collect()}
    fence = quartiles["q3"] + 1.5 * (quartiles["q3"] - quartiles["q1"]) if quartiles else None

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    counted = delays.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("checked_count"),
        F.sum(delay * n).alias("_sum"),
        F.max(delay).alias("max_seconds"),
        rows_where(delay < 0).alias("negative_count"),
        rows_where(delay > F.lit(fence).cast("double")).alias("outlier_count"),
    )
    found = counted.select(
        "checked_count",
        F.round(F.try_divide(F.col("_sum").cast("double"), F.col("checked_count")), 3).alias(
            "mean_seconds"
        ),
        F.lit(quartiles.get("median")).cast("bigint").alias("median_seconds"),
        "max_seconds",
        "negative_count",
        "outlier_count",
    )
    return delays.sparkSession.createDataFrame([found.first()], found.schema)


def coverage_gaps(
    frame: DataFrame, time: str, entity: Sequence[str] = (), longest_gap: int = 1
) -> DataFrame:
    """Oldest and newest day, days with data, and gaps of more than ``longest_gap`` days.

    Rows become distinct days before anything is ordered: a few thousand per history.
    """
    days = (
        frame.filter(F.col(time).isNotNull())
        .select(*entity, F.col(time).cast("date").alias("day"))
        .distinct()
    )
    order = Window.partitionBy(*entity).orderBy("day")
    gap = F.datediff(F.lead("day").over(order), F.col("day"))
    return days.withColumn("gap", gap).groupBy(*entity).agg(
        F.min("day").cast("string").alias("oldest"),
        F.max("day").cast("string").alias("newest"),
        F.count(F.lit(1)).alias("days_with_data"),
        F.count_if(F.col("gap") > longest_gap).alias("gap_count"),
        F.coalesce(F.max(F.when(F.col("gap") > longest_gap, F.col("gap"))), F.lit(0)).alias(
            "longest_gap_days"
        ),
    )


def frequency_outliers(
    frame: DataFrame, time: str, unit: str = "month", deviations: float = 2.0
) -> DataFrame:
    """Periods whose row count is far from the mean, in standard deviations."""
    counted = (
        frame.filter(F.col(time).isNotNull())
        .groupBy(F.date_trunc(unit, F.col(time)).alias("period"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    summary = counted.agg(
        F.struct(F.avg("row_count").alias("mean"), F.stddev_samp("row_count").alias("dev"))
        .alias("s")
    ).scalar()
    away = F.col("row_count") - summary["mean"]
    limit = deviations * summary["dev"]
    return counted.select(
        F.date_format("period", "yyyy-MM-dd").alias("period"),
        "row_count",
        F.when(away > limit, F.lit("HIGH")).when(away < -limit, F.lit("LOW"))
        .otherwise(F.lit("USUAL")).alias("frequency"),
    )


