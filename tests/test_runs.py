"""Runs in groups: failures become notes, results are written once, a broken run goes on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dqloom.operators import inventory, profile
from dqloom.operators.keyed import union_all
from dqloom.plans import jobs, runs
from dqloom.sources import rules as rule_source
from dqloom.sources.registry import TableRegistry


def frames_of(spark, built):
    def build(group):
        built.append(list(group))
        return union_all([
            spark.range(n).agg(F.count(F.lit(1)).alias("n")).withColumn("unit", F.lit(n)) for n in group
        ])
    return build


def test_every_unit_once_and_only_once(spark, tmp_path, rows):
    built = []
    run = runs.GroupedRun(spark, str(tmp_path), size=3)
    units = {f"u{n}": n for n in range(8)}
    assert rows(run.rows("counts", units, frames_of(spark, built))) == [(n, n) for n in range(8)]
    assert built == [[0, 1, 2], [3, 4, 5], [6, 7]]
    assert rows(run.rows("counts", units, frames_of(spark, built))) == [(n, n) for n in range(8)]
    assert len(built) == 3 and run.notes().isEmpty()  # read back


def test_a_broken_run_goes_on_after_the_last_group(spark, tmp_path, rows):
    run = runs.GroupedRun(spark, str(tmp_path), size=2)
    units = {f"u{n}": n for n in range(6)}
    built = []
    plain = frames_of(spark, built)

    def stopped(group):
        if 2 in group:
            raise KeyboardInterrupt
        return plain(group)

    with pytest.raises(KeyboardInterrupt):
        run.rows("counts", units, stopped)
    # rows that no note names, as a run leaves them that dies between the two writes
    spark.range(1).write.parquet(f"{tmp_path}/rows/counts/half-written")
    assert rows(run.rows("counts", units, plain)) == [(n, n) for n in range(6)]
    assert built == [[0, 1], [2, 3], [4, 5]]


def test_a_failing_unit_is_one_note_and_tried_again(spark, tmp_path, rows):
    run = runs.GroupedRun(spark, str(tmp_path), size=8)
    units = {f"u{n}": n for n in range(8)}
    good = frames_of(spark, [])

    def late(group):  # fails when rows are read, and once when the plan is built
        if 6 in group:
            raise ValueError("no plan\nand more")
        return good(group).withColumn("n", F.when(F.col("unit") == 5, F.raise_error(F.lit("bad page"))).otherwise(F.col("n")))

    kept = [(n, n) for n in (0, 1, 2, 3, 4, 7)]
    assert rows(run.rows("counts", units, late)) == kept
    noted = {r["unit"]: r["failure"] for r in run.notes().collect()}
    assert set(noted) == {"u5", "u6"} and "bad page" in noted["u5"] and noted["u6"] == "no plan"
    built = []
    assert rows(run.rows("counts", units, frames_of(spark, built))) == [(n, n) for n in range(8)]
    assert built == [[5, 6]] and run.notes().isEmpty()


def test_all_units_fail_and_other_units(spark, tmp_path):
    run = runs.GroupedRun(spark, str(tmp_path))

    def bad(group):
        raise ValueError("nothing works")

    with pytest.raises(ValueError, match="nothing works"):
        run.rows("x", {"a": 1}, bad)
    with pytest.raises(ValueError, match="Nothing to run"):
        run.rows("x", {}, bad)
    run.rows("y", {"a": 1}, frames_of(spark, []))
    with pytest.raises(ValueError, match="other units"):
        run.rows("y", {"b": 1}, frames_of(spark, []))


@pytest.fixture
def registry(spark, tmp_path):
    folder = str(tmp_path / "tables")
    spark.range(40).select(
        "id", (F.col("id") % 7).alias("fk"), F.concat(F.lit("n"), "id").alias("name"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("status"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id)").alias("created_at"),
    ).write.parquet(f"{folder}/t")
    found = TableRegistry(spark).add_files("s", {
        "t": f"{folder}/t", "u": f"{folder}/t", "gone": f"{folder}/gone",
    })
    # can be opened and counted, not read
    return found.add("s", "bad", spark.read.parquet(f"{folder}/t").select(
        F.col("id"), F.raise_error(F.lit("bad page")).cast("string").alias("status"),
        F.when(F.col("id") >= 0, F.raise_error(F.lit("bad time"))).cast("timestamp_ntz").alias("created_at"),
    ))


def test_jobs_go_on_without_the_table_that_fails(spark, registry, tmp_path):
    constraints = inventory.constraints_frame(spark, [
        *inventory.key_rows("pk_t", inventory.PRIMARY_KEY, "s", "t", ["id"]),
        *inventory.key_rows("fk_u", inventory.FOREIGN_KEY, "s", "u", ["fk"], ("s", "pk_t")),
    ])
    run = runs.GroupedRun(spark, str(tmp_path / "run"), size=2)
    found = jobs.metadata_job(registry, constraints, str(tmp_path / "saved"), run=run)
    assert {r["table_name"]: r["row_count"] for r in found["tables"].collect()} == {"t": 40, "u": 40, "bad": 40}
    counts = {(r["table_name"], r["column_name"]): r["distinct_count"] for r in found["columns"].collect()}
    assert counts[("u", "fk")] == 7 and counts[("bad", "id")] is None and len(counts) == 13
    assert found["schemas"].first()["table_count"] == 3
    noted = {(r["name"], r["unit"]) for r in run.notes().collect()}
    assert noted == {("open", "s.gone"), ("value_counts", "s.bad")}

    reported = jobs.profile_report(registry, constraints, run=run, exact=False)
    notes = {r["table_name"]: r["note"] for r in reported["tables"].collect()}
    assert notes["t"] == "MIN_TO_MAX(created_at)" and notes["bad"].startswith("ERROR: ")
    assert notes["gone"].startswith("ERROR: ") and "gone" in notes["gone"]
    assert {r["table_name"] for r in reported["statistics"].collect()} >= {"t", "u"}


def test_rules_go_on_without_the_rule_that_fails(spark, registry, tmp_path):
    common = dict(dimension="consistency", step="enum_check", status="confirmed", owner="o",
                  pattern="enum", allowed_values=["A"])
    rules = rule_source.rules_frame(spark, [
        dict(common, id="good", column="s.t.status"), dict(common, id="v1.bad", column="s.bad.status"),
    ])
    del registry.openers[("s", "gone")]
    constraints = inventory.constraints_frame(spark, [
        *inventory.key_rows("pk_t", inventory.PRIMARY_KEY, "s", "t", ["id"]),
        *inventory.key_rows("fk_u", inventory.FOREIGN_KEY, "s", "u", ["fk"], ("s", "pk_t")),
    ])
    tiers = spark.createDataFrame(
        [("s", t, "1") for t in ("t", "u")], "schema_name string, table_name string, tier string"
    )
    run = runs.GroupedRun(spark, str(tmp_path / "run"))
    columns = inventory.key_flags(inventory.column_inventory(registry), constraints)
    found = jobs.consistency_job(registry, columns, constraints, tiers, rules, run)["results"]
    by_id = {r["check_id"]: r for r in found.collect() if r["status"] != "SKIPPED" or "bad" in r["check_id"]}
    assert by_id["good"]["violation_count"] == 20 and by_id["fk_u"]["violation_count"] == 0
    assert by_id["v1.bad"]["status"] == "SKIPPED" and "bad page" in by_id["v1.bad"]["details"]


def test_many_tables(spark, tmp_path):
    """Views on a few files; every group is a plan of its own, whatever the number of tables."""
    path = str(tmp_path / "file")
    spark.range(10).select("id", (F.col("id") % 3).alias("v")).coalesce(1).write.parquet(path)
    base = spark.read.parquet(path)
    registry = TableRegistry(spark)
    for i in range(100):
        registry.add("s", f"t{i:03d}", lambda i=i: base.filter(F.col("id") >= i % 10))
    registry.add("s", "t034", spark.range(1).select(F.raise_error(F.lit("bad")).cast("int").alias("id")))
    run = runs.GroupedRun(spark, str(tmp_path / "run"), size=20)
    groups = []

    def build(group):
        groups.append(len(group))
        return union_all([profile.null_share(registry.table(s, t), s, t) for s, t in group])

    found = run.rows("nulls", runs.each_table(registry.keys()), build)
    assert found.agg(F.sum("total_rows")).first()[0] == 2 * (10 * 55 - 6)
    assert [r["unit"] for r in run.notes().collect()] == ["s.t034"]
    assert max(groups) == 20 and groups.count(20) == 5
