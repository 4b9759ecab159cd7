"""Many key checks in one plan: each table is scanned once, all keys meet in one aggregate.

A row of a table hands on one (check, key) for every check that uses the table, as child or as
parent. Keys have one slot per type and place, so keys of any types share a shuffle; equal keys
of a check are added up in every task first. Nothing is joined but the names of the checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions.numbers import pct
from dqloom.functions.text import compact_key, quoted
from dqloom.operators.keyed import KeyPairs, all_not_null, union_all
from dqloom.sources.registry import TableKey

Tables = Mapping[TableKey, DataFrame]
Slot = tuple[T.DataType, int]


@dataclass(frozen=True)
class KeyUse:
    """The key that a check takes from a table: columns, and the types they are compared as.

    ``counted`` rows are those under test, the others are what is looked for.
    """

    check: int
    table: TableKey
    columns: tuple[str, ...]
    types: tuple[T.DataType, ...]
    counted: bool = True

    def slots(self) -> list[Slot]:
        """Type and number among the key's columns of that type."""
        return [(t, self.types[:i].count(t)) for i, t in enumerate(self.types)]


def key_types(frame: DataFrame, columns: Sequence[str]) -> list[T.DataType]:
    found = frame.select(*[F.col(quoted(c)) for c in columns]).schema
    return [field.dataType for field in found]


def common_types(child: DataFrame, parent: DataFrame, pairs: KeyPairs) -> tuple[T.DataType, ...]:
    """The types in which Spark compares the two sides of a key."""
    own, other = key_types(child, [c for c, _ in pairs]), key_types(parent, [p for _, p in pairs])
    if own != other:
        names = [f"k{i}" for i in range(len(pairs))]
        left = child.select(*[F.col(quoted(c)).alias(n) for (c, _), n in zip(pairs, names)])
        right = parent.select(*[F.col(quoted(p)).alias(n) for (_, p), n in zip(pairs, names)])
        own = [field.dataType for field in left.union(right).schema]
    return tuple(own)


def _row(use: KeyUse, frame: DataFrame, names: Mapping[Slot, str]) -> list[Column]:
    held = {}
    for slot, column, own in zip(use.slots(), use.columns, key_types(frame, use.columns)):
        value = F.col(quoted(column))
        value = value if own == slot[0] else value.cast(slot[0])
        held[slot] = compact_key(value, isinstance(slot[0], T.StringType))
    return [
        F.lit(use.check).alias("check"),
        F.lit(int(use.counted)).cast("bigint").alias("uses"),
        F.lit(not use.counted).alias("known"),
        *[held.get(slot, F.lit(None).cast(slot[0])).alias(name) for slot, name in names.items()],
    ]


def _emitted(frame: DataFrame, uses: Sequence[KeyUse], names: Mapping[Slot, str]) -> DataFrame:
    if len(uses) == 1:  # a plain filter reaches the files
        return frame.filter(all_not_null(uses[0].columns)).select(*_row(uses[0], frame, names))
    rows = F.array(*[
        F.when(all_not_null(use.columns), F.struct(*_row(use, frame, names))) for use in uses
    ])
    return frame.select(F.inline(rows)).filter(F.col("check").isNotNull())


def key_sizes(tables: Tables, uses: Sequence[KeyUse]) -> DataFrame:
    """Per check and complete key: counted rows (``uses``) and whether the other side has it (``known``)."""
    slots = sorted({slot for use in uses for slot in use.slots()}, key=lambda s: (s[0].json(), s[1]))
    names = {slot: f"k{i}" for i, slot in enumerate(slots)}
    by_table: dict[TableKey, list[KeyUse]] = {}
    for use in dict.fromkeys(uses):
        by_table.setdefault(use.table, []).append(use)
    emitted = union_all([_emitted(tables[key], group, names) for key, group in by_table.items()])
    return emitted.groupBy("check", *names.values()).agg(
        F.sum("uses").alias("uses"), F.max("known").alias("known")
    )


def _named(labels: DataFrame, counted: DataFrame, part: str) -> DataFrame:
    """All checks with their counts and the share of ``part``; a check without keys counts 0."""
    counts = [c for c in counted.columns if c != "check"]
    found = labels.join(counted, "check", "left").select(
        *[F.col(c) for c in labels.columns if c != "check"],
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
    )
    return found.withColumn(
        part.replace("_count", "_pct").replace("_row", ""), pct(F.col(part), F.col("checked_count"))
    )


def presence_counts(
    tables: Tables, checks: Sequence[tuple[TableKey, TableKey, KeyPairs]], labels: DataFrame,
    missing: str = "orphan_count",
) -> DataFrame:
    """For each (child, parent, pairs): child rows with a complete key and those without a parent row.

    ``labels`` has a row for each check, numbered from 0 in the column ``check``.
    """
    uses = []
    for i, (child, parent, pairs) in enumerate(checks):
        types = common_types(tables[child], tables[parent], pairs)
        uses.append(KeyUse(i, child, tuple(c for c, _ in pairs), types))
        uses.append(KeyUse(i, parent, tuple(p for _, p in pairs), types, counted=False))
    lost = F.when(~F.col("known"), F.col("uses")).otherwise(F.lit(0))
    counted = key_sizes(tables, uses).groupBy("check").agg(
        F.sum("uses").alias("checked_count"), F.sum(lost).alias(missing)
    )
    return _named(labels, counted, missing)


def duplicate_counts(
    tables: Tables, checks: Sequence[tuple[TableKey, Sequence[str]]], labels: DataFrame
) -> DataFrame:
    """For each (table, columns): rows with a complete key, groups of equal keys and the rows in them."""
    uses = [
        KeyUse(i, key, tuple(columns), tuple(key_types(tables[key], columns)))
        for i, (key, columns) in enumerate(checks)
    ]
    repeated = F.col("uses") > 1
    counted = key_sizes(tables, uses).groupBy("check").agg(
        F.sum("uses").alias("checked_count"),
        F.count_if(repeated).alias("duplicate_group_count"),
        F.sum(F.when(repeated, F.col("uses")).otherwise(F.lit(0))).alias("duplicate_row_count"),
    )
    return _named(labels, counted, "duplicate_row_count")
