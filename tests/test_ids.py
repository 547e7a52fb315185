"""Ids that a run gives or repairs: distinct, of the target's type, and the same on every run."""

from rowferry import LookupSpec, MigrationSpec, TableSpec
from rowferry.operators import filters, quality
from rowferry.plans.migrate import apply_run, plan_run
from rowferry.plans.repair import repair


def test_repeated_and_blank_ids_end_distinct(spark):
    rows = [("x", 1), ("x", 2), ("x", 2), (" ", 1), (" ", 1), (None, 1), ("y ", 5), ("", 9)]
    df = spark.createDataFrame(rows, "id string, v int")
    spec = MigrationSpec((TableSpec("t", "id", ("id",), ("v",), "Upsert"),))
    ids = [r["id"] for r in repair(spec, {"t": df}).tables["t"].collect()]
    assert len(ids) == len(set(ids)) == len(rows) and {"x", "y"} <= set(ids) and all(ids)
    again = [r["id"] for r in repair(spec, {"t": df.repartition(3)}).tables["t"].collect()]
    assert set(again) == set(ids)


def test_a_new_id_that_is_taken_is_made_again(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2)], "id string, o int")
    made = next(r["id"] for r in quality.repair_ids(df, "t", "id", ["o"]).collect() if r["id"] != "x")
    ids = [r["id"] for r in quality.repair_ids(df.union(spark.createDataFrame([(made, 3)], df.schema)), "t", "id", ["o"]).collect()]
    assert len(set(ids)) == 3 and {"x", made} <= set(ids)


def test_int_ids_continue_after_the_largest(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    children = spark.createDataFrame([(1, "k", 3), (2, "l", 1), (3, "m", 2)], "id bigint, name string, parent int")
    targets = {
        "p": spark.createDataFrame([(2_000_000_000, "b")], "id int, name string"),
        "c": spark.createDataFrame([(7, "l", None)], "id smallint, name string, parent int"),
    }
    spec = MigrationSpec((TableSpec("p", "id", ("name",), ("name",), "Upsert"), TableSpec("c", "id", ("name",), ("name", "parent"), "Upsert", (LookupSpec("parent", "p"),))))
    after = apply_run(plan_run(spec, {"p": parents, "c": children}, targets), targets)
    assert sorted(map(tuple, after["p"].collect())) == [(2_000_000_000, "b"), (2_000_000_001, "a"), (2_000_000_002, "c")]
    assert sorted(map(tuple, after["c"].collect())) == [(7, "l", 2_000_000_001), (8, "k", 2_000_000_002), (9, "m", 2_000_000_000)]
    assert [f.dataType.simpleString() for f in after["c"].schema] == ["smallint", "string", "int"]
    again = plan_run(spec, {"p": parents, "c": children}, after)
    assert {r["action"] for r in again["c"].plan.collect()} == {"skip"}


def test_a_condition_on_bad_values_does_not_end_the_job(spark):
    df = spark.createDataFrame([("5", 1), ("x", 0), (None, 2), ("-1", 0)], "t string, n int")
    kept = lambda c: sorted(r["t"] or "" for r in filters.source_records_filter(df, c).collect())
    assert kept("cast(t as int) > 0") == ["5"]
    assert kept("10 / n > 4 or t = 'x'") == ["", "5", "x"]
    assert kept("no_such(t)") == ["", "-1", "5", "x"]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
