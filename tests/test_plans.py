"""Plans and whole runs: every row gets one outcome, and an applied plan leaves nothing to do."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators import matching, stats
from rowferry.plans import apply as A
from rowferry.plans import migrate, persons, upsert
from rowferry.spec import LookupSpec, MigrationSpec, MockField, TableSpec, ValueRule


def people_spec(**options):
    return MigrationSpec(
        (
            TableSpec("team", "Id", ("Name",), ("Name", "LeadId"), "Upsert", (LookupSpec("LeadId", "person"),)),
            TableSpec(
                "person", "Id", ("Email",), ("Email", "TeamId", "BossId", "Grade"), "Upsert",
                (LookupSpec("TeamId", "team"), LookupSpec("BossId", "person")), **options,
            ),
        )
    )


def people(spark):
    sources = {
        "team": spark.createDataFrame([("t1", "Red", "p2"), ("t2", "Blue", None)], "Id string, Name string, LeadId string"),
        "person": spark.createDataFrame(
            [("p1", "a@x", "t1", None, 1), ("p2", "b@x", "t1", "p1", 2), ("p3", "c@x", "t9", "p2", 3), ("p4", "c@x", "t2", "p3", 4)],
            "Id string, Email string, TeamId string, BossId string, Grade int",
        ),
    }
    targets = {
        "team": spark.createDataFrame([("T1", "Red", None)], "Id string, Name string, LeadId string"),
        "person": spark.createDataFrame(
            [("P1", "a@x", "T1", None, 1), ("P2", "b@x", None, None, 2), ("P9", "z@x", None, None, 9)],
            "Id string, Email string, TeamId string, BossId string, Grade int",
        ),
    }
    return sources, targets


def test_two_pass_run_is_complete_and_repeatable(spark):
    spec = people_spec()
    sources, targets = people(spark)
    runs = migrate.plan_run(spec, sources, targets)
    plan = {r["Id"]: r for r in runs["person"].plan.collect()}
    assert {i: (r["action"], r["skip_reason"]) for i, r in plan.items()} == {
        "p1": ("skip", "same_data"),
        "p2": ("update", None),
        # A repeated key links the last row only; the earlier one counts as new.
        "p3": ("insert", None),
        "p4": ("insert", None),
    }
    assert plan["p2"]["TeamId"] == "T1" and plan["p3"]["TeamId"] is None
    missing = runs["person"].missing.collect()
    assert [(r["Record Id"], r["Missing parent External Id value"]) for r in missing] == [("p3", "t9")]
    deferred = {r["Id"]: (r["action"], r["BossId"]) for r in runs["person"].deferred.collect()}
    assert deferred == {
        "p1": ("skip", None),
        "p2": ("update", "P1"),
        "p3": ("update", "P2"),
        "p4": ("update", plan["p3"]["target_id"]),
    }
    after = migrate.apply_run(runs, targets)
    people_after = {r["Id"]: r for r in after["person"].collect()}
    assert len(people_after) == 5 and people_after["P2"]["BossId"] == "P1" and people_after["P9"]["Grade"] == 9
    lead = {r["Name"]: r["LeadId"] for r in after["team"].collect()}
    assert lead == {"Red": "P2", "Blue": None}
    # Without the repeated key, planning again after the run finds nothing to do.
    unique = {**sources, "person": sources["person"].where("Id <> 'p3'")}
    unique["person"] = unique["person"].withColumn("BossId", F.when(F.col("BossId") != "p3", F.col("BossId")))
    first = migrate.plan_run(spec, unique, targets)
    again = migrate.plan_run(spec, unique, migrate.apply_run(first, targets))
    left = migrate.summary(again).where("action <> 'skip'").count()
    assert left == 0


def test_dry_run_ids_equal_real_ids(spark):
    spec, (sources, targets) = people_spec(), people(spark)
    ids = [
        sorted(r["target_id"] for r in migrate.plan_run(spec, sources, targets)["person"].plan.where("action = 'insert'").collect())
        for _ in range(2)
    ]
    assert ids[0] == ids[1] and all(len(i) == 18 for i in ids[0])


def test_stored_run_equals_lazy_run(spark, tmp_path):
    spec, (sources, targets) = people_spec(), people(spark)
    lazy = migrate.plan_run(spec, sources, targets)
    stored = migrate.plan_run(spec, sources, targets, store=str(tmp_path))
    for name in lazy:
        for part in ("plan", "deferred"):
            a, b = getattr(lazy[name], part), getattr(stored[name], part)
            assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(a.columns).collect()), key=repr)
    assert {p.name for p in (tmp_path / "person").iterdir()} == {"plan", "pairs", "deferred"}


def test_external_sink_gets_written_rows_only(spark, tmp_path):
    plan = spark.createDataFrame([("1", "insert"), ("2", "skip"), ("3", "delete")], "target_id string, action string")
    folder = str(tmp_path)

    def send(rows):
        for row in rows:
            with open(f"{folder}/{row['target_id']}", "w") as file:
                file.write(row["action"])

    A.write_external(plan, send)
    assert {p.name: p.read_text() for p in tmp_path.iterdir()} == {"1": "insert", "3": "delete"}


def test_options_reach_the_rows(spark):
    spec = people_spec(
        mock=(MockField("Grade", "c_set_value(7)", excluded="^1$"),),
        value_rules=(ValueRule("person", "Email", "/@x$/", "@y"),),
        prepared_filter="Email <> 'c@x'",
    )
    sources, targets = people(spark)
    plan = {r["Id"]: r for r in migrate.plan_run(spec, sources, targets)["person"].plan.collect()}
    assert set(plan) == {"p1", "p2"}
    assert plan["p1"]["Grade"] == 1 and plan["p2"]["Grade"] == 7 and plan["p2"]["Email"] == "b@y"


def test_rename_and_hook_see_source_names(spark):
    seen = []

    def hook(df):
        seen.append(sorted(df.columns))
        return df.withColumn("Name", F.upper("Name"))

    spec = MigrationSpec((TableSpec("team", "Id", ("Name",), ("Name",), "Upsert", rename={"Name": "Title"}, before_update=hook),))
    source = spark.createDataFrame([("t1", "Red")], "Id string, Name string")
    target = spark.createDataFrame([("T1", "Red")], "Id string, Title string")
    plan = migrate.plan_run(spec, {"team": source}, {"team": target})["team"].plan.collect()
    assert seen == [["Id", "Name"]]
    assert [(r["Title"], r["action"], r["target_id"]) for r in plan] == [("RED", "update", "T1")]


def test_selection_follows_parents_children_and_self_references(spark):
    spec = MigrationSpec(
        (
            TableSpec("a", "Id", ("Id",), ("Id",), source_filter="Id = 'a1'"),
            TableSpec("b", "Id", ("Id",), ("Id",), lookups=(LookupSpec("A", "a"), LookupSpec("Up", "b")), master=False),
        )
    )
    a = spark.createDataFrame([("a1",), ("a2",)], "Id string")
    b = spark.createDataFrame([("b1", "a1", "b2"), ("b2", "a2", "b3"), ("b3", "a2", None), ("b4", "a2", None)], "Id string, A string, Up string")
    chosen = migrate.select_sources(spec, {"a": a, "b": b})
    assert sorted(r["Id"] for r in chosen["b"].collect()) == ["b1", "b2", "b3"]


def test_repeated_and_blank_ids(spark):
    spec = MigrationSpec((TableSpec("t", "Id", ("Name",), ("Name",), "Insert", order_by=("o",), unique_id=False),))
    source = spark.createDataFrame([("1", "late", 2), ("1", "early", 1), (" ", "blank", 3), (None, "none", 4)], "Id string, Name string, o int")
    target = spark.createDataFrame([], "Id string, Name string")
    plan = migrate.plan_run(spec, {"t": source}, {"t": target})["t"].plan.collect()
    assert [(r["Id"], r["Name"], r["action"]) for r in plan] == [("1", "early", "insert")]


def test_skip_counts(spark):
    source = spark.createDataFrame([("s1", "A"), ("s2", "B")], "Id string, Name string")
    links = spark.createDataFrame([("s1", "T1", "A")], "source_id string, target_id string, _t_Name string")
    plan = upsert.classify(source, links, "Id", {"Name": T.StringType()}, "Update")
    assert stats.skip_counts(plan).collect() == [(1, 1, 0)]
    assert plan.where("action <> 'skip'").count() == 0


@pytest.mark.parametrize("operation", ["Insert", "Update", "Upsert"])
@pytest.mark.parametrize("backward", [False, True])
def test_every_row_has_one_outcome(spark, operation, backward):
    source = spark.createDataFrame([(f"s{i}", f"v{i % 3}") for i in range(9)], "Id string, Name string")
    links = spark.createDataFrame([(f"s{i}", f"t{i}", "v0") for i in range(5)], "source_id string, target_id string, _t_Name string")
    plan = upsert.classify(source, links, "Id", {"Name": T.StringType()}, operation, backward=backward).collect()
    assert len(plan) == 9
    assert all((r["action"] == "skip") == (r["skip_reason"] is not None) for r in plan)


def test_nested_key(spark):
    nested = "Id string, Parent struct<Name:string>"
    source = spark.createDataFrame([("s1", ("Acme",)), ("s2", None)], nested)
    target = spark.createDataFrame([("t1", ("Acme",)), ("t2", ("acme",))], nested)
    assert matching.match(source, target, "Id", "Id", ["Parent.Name"]).collect() == [("s1", "t1")]


def test_apply_respects_barred_columns(spark):
    target = spark.createDataFrame([("T1", "a", "b")], "Id string, x string, y string")
    plan = spark.createDataFrame([("T1", "n", "n", "update"), ("T2", "n", "n", "insert")], "target_id string, x string, y string, action string")
    out = A.apply_plan(target, plan, "Id", ["x", "y"], not_insertable=["x"], not_updateable=["y"])
    assert sorted(out.collect()) == [("T1", "n", "b"), ("T2", None, "n")] or sorted(map(tuple, out.collect()), key=repr) == [("T1", "n", "b"), ("T2", None, "n")]


def test_all_or_none(spark, tmp_path):
    path = str(tmp_path / "table")
    old, new = spark.range(3), spark.range(5)
    A.replace_table(old, path)
    assert A.apply_all_or_none(new, spark.range(1), path) is False
    assert spark.read.parquet(path).count() == 3
    assert A.apply_all_or_none(new, spark.range(0), path) is True
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["table"]


def test_person_split(spark):
    df = spark.createDataFrame(
        [("1", "Biz Account", "Ann", None, False), ("2", "Jane Doe", None, None, True), ("3", None, "Jo", "Roe", False)],
        "Id string, Name string, FirstName string, LastName string, IsPersonAccount boolean",
    )
    business, person = persons.passes(df, "IsPersonAccount", "Id")
    assert business.columns == ["Id", "Name"] and person.columns == ["Id", "FirstName", "LastName"]
    assert sorted(map(tuple, business.collect())) == [("1", "Biz Account"), ("3", "Jo Roe")]
    assert person.collect() == [("2", "Jane", "Doe")]


def test_unknown_operation():
    with pytest.raises(ValueError):
        TableSpec("t", "Id", ("Id",), (), "Merge")


@pytest.mark.parametrize("flag", [None, "gone"])
def test_phases_equal_one_plan_after_the_other(spark, rows, flag):
    draw = random.Random(8)

    def plan(actions, values):
        picked = [(str(i), draw.choice(actions), *draw.choices([None, 1, 2, 3], k=values)) for i in draw.sample(range(40), 25)]
        return spark.createDataFrame(picked, ", ".join(["target_id string, action string", *["a int", "`b.c` int"][:values]]))

    target = spark.createDataFrame([(str(i), i, -i, i % 5 == 0) for i in range(25)], "id string, a int, `b.c` int, gone boolean")
    phases = [
        A.Phase(plan(["delete", "hard_delete"], 0), []),
        A.Phase(plan(["insert", "update", "skip"], 2), ["a", "b.c"], ["a"], ["b.c"]),
        A.Phase(plan(["update"], 1), ["a"]),
    ]
    expected = target
    for phase in phases:
        expected = A.apply_phases(expected, [phase], "id", flag)
    got = A.apply_phases(target, phases, "id", flag)
    assert rows(got) == rows(expected) and got.count() > 20
    plan_text = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("Join FullOuter") == 1


def test_phases_keep_rows_without_an_id(spark):
    target = spark.createDataFrame([("1", 1)], "id string, a int")
    new = spark.createDataFrame([(None, "insert", 5), (None, "insert", 6)], "target_id string, action string, a int")
    again = new.limit(0)
    got = A.apply_phases(target, [A.Phase(new, ["a"]), A.Phase(again, ["a"])], "id")
    assert sorted(r["a"] for r in got.collect()) == [1, 5, 6]
