"""Integrity: chains of foreign keys, broken links, complete chains."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.functions.numbers import pct
from dqloom.operators import shared
from dqloom.operators.keyed import KeyPairs, key_presence, union_all, with_presence
from dqloom.sources.registry import TableKey


def _links(edges: DataFrame, columns: DataFrame) -> DataFrame:
    """Distinct links child, parent, mandatory. A link is mandatory when no column of some key may be NULL."""
    nullable = columns.select(
        F.col("schema_name").alias("from_schema"),
        F.col("table_name").alias("from_table"),
        F.col("column_name").alias("from_column"),
        "nullable",
    )
    return (
        edges.join(nullable, ["from_schema", "from_table", "from_column"], "left")
        .groupBy("constraint_name", "from_schema", "from_table", "to_schema", "to_table")
        .agg(F.bool_and(~F.coalesce("nullable", F.lit(True))).alias("mandatory"))
        .select(
            F.concat_ws(".", "from_schema", "from_table").alias("child"),
            F.concat_ws(".", "to_schema", "to_table").alias("parent"),
            "mandatory",
        )
        .groupBy("child", "parent")
        .agg(F.bool_or("mandatory").alias("mandatory"))
    )


def _held(frame: DataFrame, path: str) -> DataFrame:
    """A frame as a written table, so that a level does not repeat those before it."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def foreign_key_chains(edges: DataFrame, columns: DataFrame, folder: str, start: str | None = None) -> DataFrame:
    """Every chain child -> parent -> .. of any length, cycles cut; of one table if ``start`` names it.

    Works on the edge list, which has one row per declared key column, and goes on until no
    chain gets longer; as no table occurs twice in a chain, it ends. A chain is mandatory when all
    its links are. Chains can be exponentially many where keys are dense: :func:`foreign_key_reach`
    says the same of every pair of tables and stays small. Levels are written below ``folder``.
    """
    links = _held(_links(edges, columns), f"{folder}/links")
    first = links if start is None else links.filter(F.col("child") == start)
    level = first.select(
        F.array("child", "parent").alias("path"), "parent", F.col("mandatory").alias("all_mandatory")
    )
    levels = []
    while not level.isEmpty():
        levels.append(level)
        longer = (
            level.withColumnRenamed("parent", "child")
            .join(links, "child")
            .filter(~F.array_contains("path", F.col("parent")))
            .select(
                F.concat("path", F.array("parent")).alias("path"),
                "parent",
                (F.col("all_mandatory") & F.col("mandatory")).alias("all_mandatory"),
            )
        )
        level = _held(longer, f"{folder}/level-{len(levels)}")
    return union_all(levels or [level]).select(
        F.array_join("path", " -> ").alias("chain"),
        (F.size("path") - 1).alias("links"),
        "all_mandatory",
    )


def foreign_key_reach(edges: DataFrame, columns: DataFrame, folder: str) -> DataFrame:
    """Pairs of tables of which the first leads to the second along declared keys, of any number of links.

    ``links`` is the fewest links, ``mandatory_links`` the fewest of a way of mandatory links alone
    (NULL: none). A table on a cycle leads to itself. Every level adds the pairs that are one link
    further and not known yet, so a pair is made once for each link into its second table and nothing
    depends on the number of ways. Levels are written below ``folder``; nothing is collected.
    """
    links = _held(_links(edges, columns), f"{folder}/links")
    kinds = F.when(F.col("mandatory"), F.array(F.lit("any"), F.lit("mandatory"))).otherwise(F.array(F.lit("any")))
    links = links.select(F.explode(kinds).alias("kind"), "child", "parent")
    pair = ["kind", "from_table", "to_table"]
    levels = f"{folder}/pairs"
    new = links.select("kind", F.col("child").alias("from_table"), F.col("parent").alias("to_table"))
    steps = 1
    while True:
        frontier = _held(new, f"{levels}/links={steps}")
        if frontier.isEmpty():
            break
        known = links.sparkSession.read.parquet(levels).select(*pair)
        further = frontier.join(links.withColumnRenamed("child", "to_table"), ["kind", "to_table"])
        further = further.select("kind", "from_table", F.col("parent").alias("to_table")).distinct()
        new = further.join(known, pair, "left_anti")
        steps += 1
    found = links.sparkSession.read.schema(
        "kind string, from_table string, to_table string, links int"
    ).parquet(levels)
    return found.groupBy("from_table", "to_table").agg(
        F.min("links").alias("links"),
        F.min(F.when(F.col("kind") == "mandatory", F.col("links"))).alias("mandatory_links"),
    )


def foreign_key_cycles(reach: DataFrame) -> DataFrame:
    """Tables that lead back to themselves: the smallest table of each one's cycle and how many it has.

    Two tables share a cycle when each leads to the other; every such group counts as one, however
    its links run inside.
    """
    both = reach.filter(F.col("from_table") != F.col("to_table")).groupBy(
        F.least("from_table", "to_table").alias("a"), F.greatest("from_table", "to_table").alias("b")
    ).agg(F.count(F.lit(1)).alias("ways")).filter("ways = 2")
    mutual = both.select("a", "b").union(both.select("b", "a")).union(
        reach.filter("from_table = to_table").select("from_table", "to_table")
    )
    return mutual.groupBy(F.col("a").alias("table_name")).agg(
        F.min("b").alias("cycle"), F.count(F.lit(1)).alias("tables")
    )


def broken_links(frame: DataFrame, following: DataFrame, pairs: KeyPairs) -> DataFrame:
    """Rows with no row in the mandatory next table: checked, broken, share."""
    counted = key_presence(frame, following, pairs).agg(
        F.coalesce(F.sum("uses"), F.lit(0)).alias("checked_count"),
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("uses"))), F.lit(0)).alias("broken_count"),
    )
    return counted.withColumn("broken_pct", pct(F.col("broken_count"), F.col("checked_count")))


def broken_link_checks(
    registry, links: Sequence[tuple[TableKey, TableKey, KeyPairs]]
) -> DataFrame:
    """:func:`broken_links` of several (table, mandatory next table, pairs); each table is scanned once."""
    labels = registry.spark.createDataFrame(
        [(i, ".".join(a), ".".join(b), ", ".join(f"{c} = {d}" for c, d in pairs))
         for i, (a, b, pairs) in enumerate(links)],
        "check int, from_table string, to_table string, key string",
    )
    tables = {key: registry.table(*key) for a, b, _ in links for key in (a, b)}
    return shared.presence_counts(tables, links, labels, missing="broken_count")


@dataclass(frozen=True)
class Link:
    """The next table of a chain and the key columns (previous, next) that connect it."""

    table: DataFrame
    pairs: tuple[tuple[str, str], ...]


def chain_completeness(start: DataFrame, links: Sequence[Link]) -> DataFrame:
    """Rows of the first table from which every link of the chain can be followed.

    Built from the far end: a row is complete when a complete row of the next table has
    its key. Each step passes on only the distinct keys of complete rows.
    """
    tables = [start, *[link.table for link in links]]
    complete = tables[-1]
    for i in range(len(links) - 1, -1, -1):
        pairs = links[i].pairs
        needed = {a for a, _ in pairs} | ({b for _, b in links[i - 1].pairs} if i else set())
        previous = tables[i].select(*sorted(needed))
        flagged = with_presence(previous, complete, pairs, "_complete")
        if i == 0:
            counted = flagged.agg(
                F.count(F.lit(1)).alias("record_count"),
                F.count_if("_complete").alias("complete_count"),
            )
            broken = F.col("record_count") - F.col("complete_count")
            return counted.withColumn("broken_count", broken).withColumn(
                "broken_pct", pct(broken, F.col("record_count"))
            )
        complete = flagged.filter("_complete")
    raise ValueError("A chain has at least one link")
