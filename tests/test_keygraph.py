"""Keys that reach through parents: junction rows, paths over two parents, rings, renamed columns."""

import time

import pytest

from rowferry import LookupSpec, MigrationSpec, TableSpec
from rowferry.plans import keygraph
from rowferry.plans.migrate import apply_run, plan_run
from rowferry.session import settled


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def actions(runs, name):
    return {r[runs[name].spec.target_id]: (r["action"], r["target_id"] if r["action"] != "insert" else None) for r in runs[name].plan.collect()}


def test_junction_and_paths_over_two_parents(spark):
    spec = MigrationSpec(
        (
            TableSpec("land", "id", ("code",), ("code",), "Upsert"),
            TableSpec("city", "id", ("name", "land"), ("name", "land"), "Upsert", (LookupSpec("land", "land"),)),
            TableSpec("shop", "id", ("city.land.code", "city", "no"), ("city", "no"), "Upsert", (LookupSpec("city", "city"),)),
        )
    )
    sources = {
        "land": frame(spark, "id string, code string", ("l1", "DE"), ("l2", "US")),
        "city": frame(spark, "id string, name string, land string", ("c1", "Paris", "l2"), ("c2", "Bonn", "l1"), ("c3", "Paris", None)),
        "shop": frame(spark, "id string, city string, no string", ("s1", "c1", "1"), ("s2", "c2", "1"), ("s3", "c3", "1"), ("s4", None, None), ("s5", "c9", "7")),
    }
    targets = {
        "land": frame(spark, "id string, code string", ("L1", "DE"), ("L2", "US")),
        "city": frame(spark, "id string, name string, land string", ("C1", "Paris", "L2"), ("C3", "Paris", None)),
        "shop": frame(spark, "id string, city string, no string", ("S1", "C1", "1"), ("S3", "C3", "1"), ("S7", None, "7"), ("S4", None, None)),
    }
    runs = plan_run(spec, sources, targets)
    assert actions(runs, "city") == {"c1": ("skip", "C1"), "c2": ("insert", None), "c3": ("skip", "C3")}
    # a missing parent is an empty part; a row without any part matches nothing
    assert actions(runs, "shop") == {"s1": ("skip", "S1"), "s2": ("insert", None), "s3": ("skip", "S3"), "s4": ("insert", None), "s5": ("skip", "S7")}
    after = apply_run(runs, targets)
    again = plan_run(spec, sources, after)
    assert {a for a, _ in actions(again, "city").values()} == {"skip"}
    assert {k for k, (a, _) in actions(again, "shop").items() if a == "insert"} == {"s4"}


def ring(**options):
    return MigrationSpec(
        (
            TableSpec("team", "id", ("name", "lead"), ("name", "lead"), "Upsert", (LookupSpec("lead", "person"),)),
            TableSpec("person", "id", ("name", "team"), ("name", "team", "boss"), "Upsert", (LookupSpec("team", "team"), LookupSpec("boss", "person")), **options),
        )
    )


def test_keys_in_a_ring(spark):
    """Teams are told apart by their leads and persons by their teams; two leads lead each other's team."""
    team, person = "id string, name string, lead string", "id string, name string, team string, boss string"

    def side(m):
        return {
            "team": frame(spark, team, (m + "t1", "Red", m + "p1"), (m + "t2", "Red", m + "p2"), (m + "t3", "Blue", m + "p4"), (m + "t4", "Red", None)),
            "person": frame(spark, person, (m + "p1", "Ann", m + "t2", None), (m + "p2", "Bob", m + "t1", None), (m + "p3", "Ann", m + "t4", None), (m + "p4", "Cy", m + "t3", None), (m + "p5", "Cy", m + "t1", None)),
        }

    runs = plan_run(ring(), side("s"), side("g"))
    for name in ("team", "person"):
        assert {r["source_id"]: r["target_id"] for r in runs[name].links.collect()} == {i: "g" + i[1:] for i in [r["id"] for r in side("s")[name].collect()]}
    changed = side("g")
    changed["person"] = frame(spark, person, ("gp1", "Zoe", "gt2", None), ("gp2", "Bob", "gt1", None))
    runs = plan_run(ring(), side("s"), changed)
    # t1 is led by another person there, and through p2 that reaches t2 and p1 as well
    assert {r["source_id"] for r in runs["team"].links.collect()} == {"st4"}
    assert {r["source_id"] for r in runs["person"].links.collect()} == set()


def test_a_key_through_its_own_table(spark):
    """Folders named alike are told apart by the folders above, ten levels deep."""
    spec = MigrationSpec((TableSpec("folder", "id", ("name", "parent"), ("name", "parent"), "Upsert", (LookupSpec("parent", "folder"),)),))
    rows = [(f"a{i}", "x", f"a{i - 1}" if i else None) for i in range(10)] + [(f"b{i}", "x", f"b{i - 1}" if i else None) for i in range(1, 7)] + [("b0", "y", None)]
    source = frame(spark, "id string, name string, parent string", *rows)
    target = frame(spark, "id string, name string, parent string", *[(i.upper(), n, p and p.upper()) for i, n, p in rows if i != "b3"])
    links = {r["source_id"]: r["target_id"] for r in plan_run(spec, {"folder": source}, {"folder": target})["folder"].links.collect()}
    # below the folder that is gone nothing is where it was: b4 has no parent there and reads like a0
    assert links == {i: i.upper() for i, *_ in rows if i[0] == "a" or i in ("b0", "b1", "b2")} | {"a0": links["a0"], "a1": links["a1"], "a2": links["a2"]}
    assert {links[i] for i in ("a0", "a1", "a2")} <= {"A0", "A1", "A2", "B4", "B5", "B6"}


def test_renamed_id_and_key_columns(spark):
    spec = MigrationSpec(
        (
            TableSpec("land", "id", ("code",), ("code",), "Upsert", rename={"id": "land_id", "code": "iso"}),
            TableSpec("city", "id", ("name", "land.code"), ("name", "land", "twin"), "Upsert", (LookupSpec("land", "land"), LookupSpec("twin", "city")), rename={"id": "city_id", "land": "country", "twin": "sister"}),
        )
    )
    sources = {"land": frame(spark, "id bigint, code string", (1, "DE")), "city": frame(spark, "id bigint, name string, land bigint, twin bigint", (1, "Bonn", 1, 2), (2, "Ulm", 1, None))}
    targets = {"land": frame(spark, "land_id bigint, iso string", (11, "DE")), "city": frame(spark, "city_id bigint, name string, country bigint, sister bigint", (21, "Bonn", 11, None), (22, "Bonn", None, None))}
    runs = plan_run(spec, sources, targets)
    assert actions(runs, "city") == {1: ("skip", 21), 2: ("insert", None)}
    after = apply_run(runs, targets)["city"].collect()
    ulm = next(r for r in after if r["name"] == "Ulm")
    assert {(r["city_id"], r["country"], r["sister"]) for r in after if r["name"] == "Bonn"} == {(21, 11, ulm["city_id"]), (22, None, None)} and ulm["country"] == 11


def test_parts_are_read(spark):
    spec = ring()
    assert keygraph.part_of(spec, spec.table("team"), "lead.team.name").column == "name"
    assert [h.column for h in keygraph.part_of(spec, spec.table("team"), "lead.boss").hops] == ["lead", "boss"]
    assert keygraph.part_of(spec, spec.table("team"), "Account.Name") == keygraph.Part((), "Account.Name")


@pytest.mark.parametrize("operation", ["Update", "Readonly", "Delete", "DeleteHierarchy"])
def test_other_operations_use_the_key_too(spark, operation):
    spec = MigrationSpec((TableSpec("land", "id", ("code",), ("code",), "Upsert"), TableSpec("city", "id", ("name", "land"), ("name", "land"), operation, (LookupSpec("land", "land"),))))
    sources = {"land": frame(spark, "id string, code string", ("l1", "DE")), "city": frame(spark, "id string, name string, land string", ("c1", "Bonn", "l1"))}
    targets = {"land": frame(spark, "id string, code string", ("L1", "DE")), "city": frame(spark, "id string, name string, land string", ("C0", "Bonn", None), ("C1", "Bonn", "L1"))}
    assert [(r["source_id"], r["target_id"]) for r in plan_run(spec, sources, targets)["city"].links.collect()] == [("c1", "C1")]


def test_rows_do_not_meet_their_keys_by_id(spark):
    """Rows go through the joins to their parents; keys are no table that is joined by id."""
    spec = MigrationSpec((
        TableSpec("head", "h_id", ("h_ref",), ("h_ref",), "Upsert"),
        TableSpec("line", "l_id", ("l_head", "n"), ("l_head", "n", "q"), "Upsert", (LookupSpec("l_head", "head"),)),
    ))
    heads = spark.createDataFrame([(1, "a"), (2, "b")], "h_id bigint, h_ref string")
    lines = spark.createDataFrame([("x", 1, 1, 5.0), ("y", 2, 1, 6.0), ("z", None, 1, 7.0)], "l_id string, l_head bigint, n int, q double")
    there = {
        "head": spark.createDataFrame([(101, "a"), (102, "b")], "h_id bigint, h_ref string"),
        # two rows with one id keep their own keys
        "line": spark.createDataFrame([("X", 101, 1, 5.0), ("X", 102, 1, 9.0)], "l_id string, l_head bigint, n int, q double"),
    }
    plan = plan_run(spec, {"head": heads, "line": lines}, there)["line"].plan
    assert {r["l_id"]: r["action"] for r in plan.collect()} == {"x": "skip", "y": "update", "z": "insert"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = [keys(rows) for keys, rows in zip(keygraph.natural_keys(spec, {"head": heads, "line": lines}, there)["line"], (lines, there["line"]))]
        assert [sorted(r[keygraph.NATURAL] for r in k.collect()) for k in keyed] == [["1", "a;1", "b;1"], ["a;1", "b;1"]]
        text = plan_run(spec, {"head": heads, "line": lines}, there)["line"].plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") <= 13  # 17 where keys are a table of their own


def shuffled(spark):
    """What lies on disk of all that was shuffled."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines()
    return {f for f in files if "shuffle_" in f and f.endswith(".data")}


def test_shuffles_of_a_step_are_removed_before_the_next_one(spark):
    """Links of a table that is keyed through parents are there when the plan is; nothing shuffled for them is left."""
    spec = MigrationSpec(
        (
            TableSpec("city", "id", ("name",), ("name",), "Upsert"),
            TableSpec("shop", "id", ("city", "no"), ("city", "no", "size"), "Upsert", (LookupSpec("city", "city"),)),
        )
    )
    city, shop = "id string, name string", "id string, city string, no string, size int"
    sources = {"city": frame(spark, city, ("c1", "Bonn"), ("c2", "Rome")), "shop": frame(spark, shop, ("s1", "c1", "1", 5), ("s2", "c2", "1", 6), ("s3", "c9", None, 7))}
    targets = {"city": frame(spark, city, ("C1", "Bonn"), ("C2", "Rome")), "shop": frame(spark, shop, ("S1", "C1", "1", 5), ("S2", "C2", "1", 8), ("S2", "C2", "1", 8))}
    before = shuffled(spark)
    runs = plan_run(spec, sources, targets)
    assert runs["shop"].links.inputFiles()
    for _ in range(50):  # Spark removes files a little later
        if not (left := shuffled(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert actions(runs, "shop") == {"s1": ("skip", "S1"), "s2": ("update", "S2"), "s3": ("insert", None)}


def test_settled_keeps_rows_names_and_types(spark, rows):
    df = spark.sql("SELECT 1 AS `a.b`, 'x' AS A, CAST(NULL AS int) AS a, map('k', 0D) AS m, array(struct(1 AS s)) AS l").union(spark.sql("SELECT NULL, NULL, 2, NULL, NULL"))
    kept = settled(df, "kept")
    assert kept.inputFiles() and kept.columns == df.columns and kept.dtypes == df.dtypes and rows(kept) == rows(df)
    assert settled(df.where("false"), "kept").count() == 0
    void = spark.sql("SELECT 1 AS i, NULL AS nothing")
    assert rows(settled(void, "kept")) == [(1, None)] and settled(void, "kept").dtypes == void.dtypes
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
