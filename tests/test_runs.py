"""Runs that delete first, insert whatever is there, or rename a deferred lookup."""

from rowferry import LookupSpec, MigrationSpec, TableSpec
from rowferry.plans.migrate import apply_run, plan_run


def _tables(spark, rows, schema="id string, name string, v int"):
    return spark.createDataFrame(rows, schema)


def test_delete_then_upsert_keeps_unchanged_rows(spark):
    source = _tables(spark, [("s1", "a", 1), ("s2", "b", 2)])
    target = _tables(spark, [("t1", "a", 1), ("t2", "b", 9), ("t3", "z", 0)])
    spec = MigrationSpec((TableSpec("x", "id", key=("name",), columns=("name", "v"), operation="Upsert", delete_old_data=True),))
    runs = plan_run(spec, {"x": source}, {"x": target})
    left = apply_run(runs, {"x": target})["x"]
    assert sorted((r["name"], r["v"]) for r in left.collect()) == [("a", 1), ("b", 2)]


def test_insert_ignores_the_target(spark):
    source, target = _tables(spark, [("s1", "a", 1)]), _tables(spark, [("t1", "a", 1)])
    spec = MigrationSpec((TableSpec("x", "id", key=("name",), columns=("name", "v"), operation="Insert"),))
    runs = plan_run(spec, {"x": source}, {"x": target})
    assert [r["action"] for r in runs["x"].plan.collect()] == ["insert"]
    assert apply_run(runs, {"x": target})["x"].count() == 2


def test_deferred_lookup_under_a_new_name(spark):
    source = _tables(spark, [("s1", "a", "s2"), ("s2", "b", None)], "id string, name string, p string")
    target = _tables(spark, [("t2", "b", None)], "id string, name string, parent string")
    table = TableSpec("x", "id", key=("name",), columns=("name", "p"), operation="Upsert", rename={"p": "parent"}, lookups=(LookupSpec("p", "x"),))
    runs = plan_run(MigrationSpec((table,)), {"x": source}, {"x": target})
    left = {r["name"]: r["parent"] for r in apply_run(runs, {"x": target})["x"].collect()}
    assert left == {"a": "t2", "b": None}
