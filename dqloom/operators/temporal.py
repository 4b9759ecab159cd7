"""Temporal consistency: versions, overlapping intervals, state transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.functions.numbers import pct
from dqloom.functions.text import quoted
from dqloom.operators.keyed import key_presence, scanned, spread_left_join


def _columns(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    return frame.select(*[quoted(name) for name in dict.fromkeys(names)])


def ordered_versions(
    frame: DataFrame, entity: Sequence[str], time: str, tie: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Every row with its version number and the values of the version before it."""
    rows = _columns(frame, [*entity, time, *tie, *values])
    return scanned(rows, entity, [time, *tie], previous=values, version=True)


def interval_problems(
    frame: DataFrame, entity: Sequence[str], start: str, end: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Intervals that start before an earlier one of the entity ends, and reversed ones.

    Earlier is by start, then ``tie``, then end: of two intervals with one start the shorter
    is first, and an interval of length zero overlaps nothing that starts with it.
    """
    begins, ends = F.col(quoted(start)), F.col(quoted(end))
    kept = _columns(frame.filter(begins.isNotNull() & ends.isNotNull()), [*entity, start, end, *tie])
    reached = scanned(kept, entity, [start, *tie, end], running_max=end)
    counted = reached.agg(
        F.count(F.lit(1)).alias("checked_count"),
        F.count_if(begins < F.col("max_before")).alias("overlap_count"),
        F.count_if(begins > ends).alias("reversed_count"),
    )
    return counted.withColumn("overlap_pct", pct(F.col("overlap_count"), F.col("checked_count")))


def _stated(
    frame: DataFrame, entity: Sequence[str], time: str, tie: Sequence[str], status: str
) -> DataFrame:
    """Rows that have a status and a time."""
    stated = frame.filter(F.col(quoted(status)).isNotNull() & F.col(quoted(time)).isNotNull())
    return _columns(stated, [*entity, time, *tie, status])


def transitions(
    frame: DataFrame, entity: Sequence[str], time: str, tie: Sequence[str], status: str
) -> DataFrame:
    """``from_status, to_status, transition_count`` over consecutive rows of an entity."""
    rows = _stated(frame, entity, time, tie, status)
    steps = scanned(rows, entity, [time, *tie], previous=[status])
    before = F.col(quoted(f"prev_{status}"))
    return (
        steps.filter(before.isNotNull())
        .groupBy(before.alias("from_status"), F.col(quoted(status)).alias("to_status"))
        .agg(F.count(F.lit(1)).alias("transition_count"))
    )


def illegal_transitions(counted: DataFrame, allowed: DataFrame) -> DataFrame:
    """Transitions that are not in the allowed ``from_status, to_status`` pairs."""
    return counted.join(allowed, ["from_status", "to_status"], "left_anti")


def returns_to_old_state(
    frame: DataFrame, entity: Sequence[str], time: str, tie: Sequence[str], status: str
) -> DataFrame:
    """Changes of state, and those that go back to a state the entity was in before."""
    rows = _stated(frame, entity, time, tie, status)
    order = F.struct(*[F.col(quoted(c)).alias(f"o{i}") for i, c in enumerate([time, *tie])])
    first = rows.groupBy(*map(quoted, (*entity, status))).agg(F.min(order).alias("_first"))
    changes = scanned(rows, entity, [time, *tie], previous=[status]).filter(
        F.col(quoted(f"prev_{status}")) != F.col(quoted(status))
    )
    joined = spread_left_join(changes, first, [*entity, status], hot_from=rows)
    counted = joined.agg(
        F.count(F.lit(1)).alias("change_count"),
        F.count_if(F.col("_first") < order).alias("return_count"),
    )
    return counted.withColumn("return_pct", pct(F.col("return_count"), F.col("change_count")))


def missing_companions(
    frame: DataFrame, companion: DataFrame, pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """Rows whose required companion event does not exist: checked, missing, share."""
    counted = key_presence(frame, companion, pairs).agg(
        F.coalesce(F.sum("uses"), F.lit(0)).alias("checked_count"),
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("uses"))), F.lit(0)).alias("missing_count"),
    )
    return counted.withColumn("missing_pct", pct(F.col("missing_count"), F.col("checked_count")))
