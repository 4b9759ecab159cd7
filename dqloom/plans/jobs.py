"""The five end-to-end jobs.

Each returns lazy tables and nothing runs until they are written, unless a
:class:`~dqloom.plans.runs.GroupedRun` is given: then tables and rules are worked out in groups, written
below its folder and read back, and one that fails becomes a note.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.functions import naming
from dqloom.operators import (
    candidates,
    completeness,
    consistency,
    growth,
    inventory,
    profile,
    uniqueness,
)
from dqloom.operators.keyed import union_all
from dqloom.plans import report
from dqloom.plans.runs import GroupedRun, each_table
from dqloom.sources import rules as rule_source
from dqloom.sources import snapshots
from dqloom.sources.registry import TableKey, TableRegistry

TABLE = ["schema_name", "table_name"]
COLUMN = [*TABLE, "column_name"]


def _each(
    registry: TableRegistry, keys: Sequence[TableKey] | None, build,
    run: GroupedRun | None = None, name: str = "",
) -> DataFrame:
    keys = registry.keys() if keys is None else keys

    def of(group: Sequence[TableKey]) -> DataFrame:
        return union_all([build(registry.table(s, t), s, t) for s, t in group])

    return of(keys) if run is None else run.rows(name, each_table(keys), of)


def metadata_profile(
    registry: TableRegistry, constraints: DataFrame, keys: Sequence[TableKey] | None = None,
    sizes: bool = True, run: GroupedRun | None = None,
) -> dict[str, DataFrame]:
    """Table and column inventories with exact NULL and distinct counts, and schema sums.

    With a ``run``, tables that can't be opened are left out and tables that can't be
    read have no counts; its notes say why.
    """
    counts = total_bytes = None
    if run is not None:
        keys = run.opened(registry, keys)
        units = each_table(keys)
        counts = run.rows("row_counts", units, lambda group: inventory.row_counts(registry, group))
        counts = _all_tables(registry, keys, counts)
        if sizes:
            total_bytes = run.rows("bytes", units, lambda group: inventory.file_sizes(registry, group))
    tables = inventory.table_inventory(registry, constraints, keys, sizes, counts, total_bytes)
    columns = inventory.key_flags(inventory.column_inventory(registry, keys), constraints)
    counted = _each(registry, keys, profile.value_counts, run, "value_counts")
    columns = columns.join(counted, COLUMN, "left")
    return {"tables": tables, "columns": columns, "schemas": inventory.schema_summary(tables)}


def _all_tables(registry: TableRegistry, keys: Sequence[TableKey], found: DataFrame) -> DataFrame:
    """``found`` with a row of NULLs for each table it lacks."""
    listed = registry.spark.createDataFrame(list(keys), "schema_name string, table_name string")
    return listed.join(found, TABLE, "left")


def metadata_job(
    registry: TableRegistry, constraints: DataFrame, folder: str,
    existing: DataFrame | None = None, refresh: bool = False, run: GroupedRun | None = None,
) -> dict[str, DataFrame]:
    """Profile every schema, save it below ``folder`` and reconcile the schema list."""
    parts = None

    def part(name: str) -> DataFrame:
        nonlocal parts
        parts = parts or metadata_profile(registry, constraints, run=run)
        return parts[name]

    def kept(name: str, build) -> DataFrame:
        return snapshots.load_snapshot(registry.spark, f"{folder}/{name}", build, refresh)

    saved = {name: kept(name, lambda name=name: part(name)) for name in ("tables", "columns")}
    # from the saved tables, which are counted once
    saved["schemas"] = kept("schemas", lambda: inventory.schema_summary(saved["tables"]))
    if existing is not None:
        saved["schemas"] = snapshots.reconcile(existing, saved["schemas"], ["schema_name"])
    return saved


def completeness_job(
    registry: TableRegistry,
    tables: DataFrame,
    columns: DataFrame,
    tier_rules: DataFrame,
    null_rules: DataFrame,
    not_null_rules: DataFrame,
    keys: Sequence[TableKey] | None = None,
    run: GroupedRun | None = None,
) -> dict[str, DataFrame]:
    """Tables with tiers; columns with NULL warning, NULL class and placeholder check.

    Pending tiers and classes do not stop the run: they come back as ``pending`` rows.
    """
    prepared = candidates.prepare_tiers(tables, tier_rules)
    tiers = prepared.filter(F.col("status") == "confirmed")
    classified = candidates.classify_tables(tables, tiers)
    warned = completeness.with_null_warning(columns, tiers)
    null_classes = candidates.prepare_null_rules(warned, null_rules)
    if run is not None:
        keys = run.opened(registry, keys)
    dirty = _each(registry, keys, completeness.dirty_values, run, "dirty_values")
    pending = prepared.filter(F.col("status") != "confirmed").select("id", F.lit("tier").alias("kind"))
    pending = pending.unionByName(
        null_classes.filter(F.col("status") != "confirmed").select(
            "id", F.lit("null_class").alias("kind")
        )
    )
    return {
        "tables": classified,
        "columns": completeness.classify_columns(warned, not_null_rules, null_classes, dirty),
        "pending": pending,
    }


def consistency_job(
    registry: TableRegistry,
    columns: DataFrame,
    constraints: DataFrame,
    tiers: DataFrame,
    rules: DataFrame,
    run: GroupedRun | None = None,
) -> dict[str, DataFrame]:
    """All confirmed consistency checks as uniform results; the other rules as SKIPPED.

    With a ``run``, a key or rule whose check fails is SKIPPED too, the failure as its reason.
    """
    edges = inventory.tier_one_edges(inventory.foreign_key_edges(constraints), tiers)
    proposed = (
        candidates.pattern_candidates(columns)
        .unionByName(candidates.enum_candidates(columns), allowMissingColumns=True)
        .unionByName(candidates.cross_table_candidates(columns, edges), allowMissingColumns=True)
    )
    merged = rule_source.merge_new(rules, proposed)
    planned = rule_source.planned(rules, columns)
    of_rules = consistency.of_pattern
    checks = {
        "orphan": (
            {f"{k[0]['from_schema']}.{k[0]['from_table']}/{k[0]['constraint_name']}": k
             for k in consistency.declared_keys(edges)},
            lambda keys: report.orphan_results(consistency.orphan_checks(registry, keys)),
        ),
        "pattern": (
            _by_table(of_rules(planned, "date_order", "total_detail", "status_terminal")),
            lambda some: report.pattern_results(consistency.pattern_checks(registry, some), rules),
        ),
        "enum": (
            _by_table(of_rules(planned, "enum")),
            lambda some: report.enum_results(consistency.enum_checks(registry, some)),
        ),
        "duplicated_value": (
            _by_table(of_rules(planned, "duplicated_value")),
            lambda some: report.cross_table_results(consistency.cross_table_checks(registry, some)),
        ),
    }
    results = []
    for kind, (units, build) in checks.items():
        if not units:
            continue
        if run is None:
            results.append(build(list(units.values())))
        else:
            results.append(run.rows(kind, units, build))
    results.append(report.skipped_results(skipped_rules(merged, columns)))
    if run is not None:
        failed = run.notes().filter(F.col("name").isin(*checks)).select(
            F.lit("consistency").alias("dimension"),
            F.regexp_replace("unit", "^[^/]*/", "").alias("id"),
            F.col("name").alias("pattern"),
            F.col("failure").alias("reason"),
        )
        results.append(report.skipped_results(failed))
    return {"results": union_all(results), "rules": merged}


def _by_table(planned: Sequence[consistency.Rule]) -> dict[str, consistency.Rule]:
    """Rules as units of a run, named so that those of a table follow each other and share its scan."""
    def place(rule: consistency.Rule) -> str:
        named = [rule.get(k) for k in ("table", "total_table", "column", "source")]
        return ".".join(next(n for n in named if n).split(".")[:2])

    return {f"{place(rule)}/{rule['id']}": rule for rule in planned}


def skipped_rules(rules: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Rules that do not run, with the reason: not confirmed, or the first validation error.

    With the column inventory, that a rule names an unknown column is such an error.
    """
    ready = rule_source.confirmed(rules)
    errors = rule_source.validation_errors(ready)
    if columns is not None:
        errors = errors.unionByName(rule_source.unknown_references(ready, columns))
    wrong = (
        errors
        .groupBy(F.col("rule_id").alias("id"))
        .agg(F.min("error").alias("reason"))
    )
    open_rules = rules.filter(~F.col("status").eqNullSafe(F.lit("confirmed"))).select(
        "dimension", "id", "pattern", F.lit("not confirmed").alias("reason")
    )
    invalid = rules.join(wrong, "id").select("dimension", "id", "pattern", "reason")
    return open_rules.unionByName(invalid)


def uniqueness_job(
    registry: TableRegistry, columns: DataFrame, constraints: DataFrame, tiers: DataFrame
) -> DataFrame:
    """Technical duplicates and UNIQUE rechecks of the tables in scope, uniform results."""
    scoped = uniqueness.scope(columns, tiers)
    tables = [tuple(row) for row in scoped.select(*TABLE, "columns").collect()]
    results = []
    if tables:
        results.append(report.duplicate_results(uniqueness.duplicates_of(registry, tables)))
    declared = uniqueness.unique_scope(constraints, scoped).collect()
    if declared:
        checks = [
            (r["schema_name"], r["table_name"], r["constraint_name"], r["columns"]) for r in declared
        ]
        results.append(report.duplicate_results(uniqueness.unique_checks(registry, checks)))
    left_out = uniqueness.out_of_scope(tiers, scoped).select(
        F.lit("uniqueness").alias("dimension"),
        F.concat_ws(".", *TABLE).alias("id"),
        F.lit("technical_duplicate").alias("pattern"),
        "reason",
    )
    results.append(report.skipped_results(left_out))
    return union_all(results)


def profile_report(
    registry: TableRegistry,
    constraints: DataFrame,
    tokens: Sequence[str] = (),
    start: str | None = None,
    end: str | None = None,
    extra_pii: Sequence[str] = (),
    labels: Sequence[tuple[str, Sequence[str]]] = (),
    exact: bool = True,
    run: GroupedRun | None = None,
    analyzed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The exporter's report: tables with growth, columns with statistics, keys, counters.

    ``analyzed`` adds the time of each table's last analysis to its columns' statistics. ``exact=False`` takes column statistics from sketches in one pass over each table. With a
    ``run``, a table that can't be opened, or whose growth can't be worked out, has the failure as its note.
    """
    profiled = profile.column_profile if exact else profile.approximate_profile
    edges = inventory.foreign_key_edges(constraints)
    opened = None if run is None else run.opened(registry)
    columns = inventory.key_flags(inventory.column_inventory(registry, opened), constraints)
    scoped = inventory.scope_report(
        tokens, registry.tables(), columns,
        inventory.implicit_foreign_keys(columns, constraints), edges,
    )
    inventory.require_match(scoped, tokens)
    keys = [tuple(row) for row in scoped["tables"].select(*TABLE).collect()]
    counts = None
    if run is None:
        grown = growth.growth_rates(registry, keys, start, end)
    else:
        chosen, keys = keys, [key for key in keys if key in set(opened)]
        units = each_table(keys)
        counts = run.rows("row_counts", units, lambda group: inventory.row_counts(registry, group))
        counts = _all_tables(registry, keys, counts)
        grown = run.rows(
            "growth", units, lambda group: growth.growth_rates(registry, group, start, end)
        )
        failed = run.notes().filter(F.col("name").isin("growth", "open"))
        named = F.concat_ws(".", *TABLE)
        grown = _all_tables(registry, chosen, grown).join(failed, named == F.col("unit"), "left").select(
            *TABLE, "growth",
            F.coalesce("note", F.concat(F.lit("ERROR: "), "failure")).alias("note"), "time_info",
        )
    tables = inventory.table_inventory(registry, constraints, keys, counts=counts)
    if run is not None:
        tables = _all_tables(registry, chosen, tables)
    tables = tables.join(grown, TABLE, "left").withColumn(
        "label", naming.table_label(F.col("table_name"), labels)
    )
    statistics = _each(
        registry, keys, lambda f, s, t: profiled(f, s, t, extra_pii=extra_pii), run, "statistics"
    )
    return {
        "tables": tables,
        "schemas": scoped["schemas"].withColumn(
            "purpose", naming.schema_purpose(F.col("schema_name"))
        ),
        "columns": scoped["columns"].withColumn(
            "pii_phi",
            naming.is_personal(F.col("schema_name"), F.col("table_name"), F.col("column_name"),
                               extra=extra_pii),
        ),
        "statistics": profile.stats_lookup(scoped["columns"], statistics, tables, analyzed),
        "implicit_keys": scoped["implicit"],
        "edges": scoped["edges"],
        "summary": inventory.run_summary(
            scoped["tables"], scoped["columns"], scoped["edges"], scoped["implicit"], extra_pii
        ),
    }
