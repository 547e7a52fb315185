"""Lookups, closure, pairing, formulas."""

import datetime as dt
import functools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowferry.operators import closure, formula, lookups, pairing
from rowferry.plans import repair
from rowferry.spec import LookupSpec, MigrationSpec, TableSpec


def test_conflict_prefers_the_id(spark):
    parents = spark.createDataFrame([("a1", "Acme One"), ("a2", "Acme Two")], "Id string, Name string")
    child = spark.createDataFrame(
        [("c1", "a1", "Acme Two"), ("c2", "zz", "Acme Two"), ("c3", "zz", "none"), ("c4", None, "Acme One"), ("c5", "a2", "Acme Two")],
        "Id string, AccountId string, `Account.Name` string",
    )
    keys = lookups.parent_keys(parents, "Id", ["Name"], ["Id"])
    out = lookups.repair_conflicts(child, "AccountId", "Account.Name", keys, "state")
    assert {r["Id"]: (r["AccountId"], r["Account.Name"], r["state"]) for r in out.collect()} == {
        "c1": ("a1", "Acme One", "reference_fixed"),
        "c2": ("a2", "Acme Two", "id_fixed"),
        "c3": ("zz", "none", "conflict"),
        "c4": (None, "Acme One", "blank"),
        "c5": ("a2", "Acme Two", "ok"),
    }
    issues = lookups.conflict_issues(child, "Child", "AccountId", "Account.Name", "Name", keys).collect()
    assert [(r["Field value"], r["Parent field value"], r["Error"]) for r in issues] == [("zz", "none", "LOOKUP ID/REFERENCE CONFLICT")]


def repaired(tables, ids_excluded=False, legacy=None):
    spec = MigrationSpec(
        (
            TableSpec("Parent", "Id", ("Name",), ()),
            TableSpec("Child", "Id", ("Title",), ("Title",), lookups=(LookupSpec("ParentId", "Parent", "Parent.Name"),), order_by=("Title",)),
        )
    )
    return repair.repair(spec, tables, ids_excluded, legacy)


def test_repair_generates_parents_when_ids_are_excluded(spark):
    parent = spark.createDataFrame([("p1", "A")], "Id string, Name string")
    child = spark.createDataFrame([("x", "A"), ("y", "B"), ("z", "B"), ("w", None)], "title string, `Parent.Name` string")
    out = repaired({"Parent": parent, "Child": child}, ids_excluded=True)
    parents = {r["Name"]: r["Id"] for r in out.tables["Parent"].collect()}
    assert set(parents) == {"A", "B"} and parents["A"] == "p1"
    children = {r["Title"]: r for r in out.tables["Child"].collect()}
    assert children["x"]["ParentId"] == "p1" and children["y"]["ParentId"] == children["z"]["ParentId"] == parents["B"]
    assert children["w"]["ParentId"] is None
    assert len({r["Id"] for r in children.values()}) == 4
    assert out.issues.count() == 0


def test_repair_reports_orphans(spark):
    parent = spark.createDataFrame([("p1", "A")], "Id string, Name string")
    child = spark.createDataFrame([("c1", "x", "p1"), ("c1", "y", "p7"), (" ", "z", None)], "ID string, Title string, ParentId string")
    out = repaired({"Parent": parent, "Child": child})
    rows = {r["Title"]: r for r in out.tables["Child"].collect()}
    assert rows["x"]["Parent.Name"] == "A" and rows["y"]["Parent.Name"] is None
    assert rows["x"]["Id"] == "c1" and len({r["Id"] for r in rows.values()}) == 3
    assert [(r["Field value"], r["Error"]) for r in out.issues.collect()] == [("p7", "MISSING PARENT LOOKUP RECORD")]


def test_polymorphic_lookup(spark):
    child = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "Id string, OwnerId string")
    users = spark.createDataFrame([("x", "U")], "source_id string, target_id string")
    groups = spark.createDataFrame([("x", "G"), ("y", "H")], "source_id string, target_id string")
    both = lookups.polymorphic(child, "OwnerId", users, groups, "o")
    assert {r["Id"]: r["o"] for r in both.collect()} == {"1": "U", "2": "H", "3": None}
    assert {r["Id"]: r["o"] for r in lookups.polymorphic(child, "OwnerId", None, groups, "o").collect()} == {"1": "G", "2": "H", "3": None}


@pytest.mark.parametrize("chosen", [1, 4, 60])
@pytest.mark.parametrize("early, share", [(0, 0.05), (2, 1.0), (6, 0.05), (100, 1.0)])
def test_self_references_equal_brute_force(spark, monkeypatch, chosen, early, share):
    draw = random.Random(chosen)
    up = {i: draw.choice([None, i - 1, i - 1, i - 1, draw.randrange(300), 999]) for i in range(300)}
    up.update({10: 9, 9: 8, 8: 10, 20: 20})  # a ring, a row that points to itself
    start = draw.sample(range(300), chosen)
    expected, todo = set(), list(start)
    while todo:
        if (row := todo.pop()) in up and row not in expected:
            expected.add(row)
            todo.append(up[row])
    monkeypatch.setattr(closure, "EARLY_HOPS", early)
    monkeypatch.setattr(closure, "LARGE_SHARE", share)
    table = spark.createDataFrame([*up.items(), (None, 3)], "id int, up int")
    got = closure.with_self_references(table, "id", "up", table.where(F.col("id").isin(start)))
    assert sorted(r["id"] for r in got.collect()) == sorted(expected)


def test_self_reference_goes_to_the_end(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(20)], "id int, up int")
    start = chain.where("id = 10")
    assert closure.with_self_references(chain, "id", "up", start).count() == 11
    assert sorted(r["id"] for r in closure.with_self_references(chain, "id", "up", start, max_hops=3).collect()) == [7, 8, 9, 10]
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "id int, up int")
    assert closure.with_self_references(ring, "id", "up", ring.where("id = 1")).count() == 3


def test_word_lists_mean_the_same_at_any_length(spark):
    from rowferry.operators import filters

    df = spark.createDataFrame([("İstanbul",), ("ſtone",), ("other",)], "t string")
    short = ["istanbul", "stone"]
    few = {r["t"] for r in filters.keep_words(df, ["t"], short).collect()}
    many = {r["t"] for r in filters.keep_words(df, ["t"], [*short, *[f"word{i}" for i in range(90)]]).collect()}
    assert few == many


def test_pairing_in_order(spark, rows):
    left = spark.createDataFrame([("X", 1), ("X", 2), ("Y", 3), (None, 4)], "k string, i int")
    right = spark.createDataFrame([("X", 10), ("Y", 11), ("Y", 12), (None, 13)], "k string, i int")
    got = rows(pairing.pair_by_key(left, right, "k", "i", "i", ["i"], ["i"]), "left_id", "right_id")
    assert got == [(1, 10), (2, None), (3, 11), (4, 13)]


@pytest.mark.parametrize("op", ["<=", "<", ">=", ">"])
@pytest.mark.parametrize("keyed", [True, False])
def test_comparison_lookup_equals_brute_force(spark, op, keyed):
    draw = random.Random(5)
    ours = [(i, draw.choice("aab"), draw.choice([None, *range(30)])) for i in range(300)]
    theirs = [(i, draw.choice("aab"), draw.choice([None, *range(30)])) for i in range(60)]
    test = {"<=": int.__le__, "<": int.__lt__, ">=": int.__ge__, ">": int.__gt__}[op]
    expected = {
        i: next((j for j, k2, w in theirs if (not keyed or k == k2) and None not in (v, w) and test(w, v)), None)
        for i, k, v in ours
    }
    df = spark.createDataFrame(ours, "i int, k string, v int")
    other = spark.createDataFrame(theirs, "j int, k2 string, w int")
    on = [("k", "k2")] if keyed else []
    got = formula.by_comparison(df, other, on, ("w", op, "v"), "j", ["j"], "found", cells=64).collect()
    assert {r["i"]: r["found"] for r in got} == expected and len(got) == len(ours)


OPS = {"=": lambda a, b: a == b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}
LARGE = 2**60  # neighbours that a double cannot tell apart
KINDS = {
    "bigint": lambda n: LARGE + n,
    "date": lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n),
    "string": lambda n: f"w{n:03d}",
    "decimal(30,2)": lambda n: Decimal(10**25) + Decimal(n) / 100,
}
CONDITIONS = {
    "our point in their range": [("lo", "<=", "x"), ("hi", ">", "x")],
    "their point in our range": [("lo", ">", "x"), ("lo", "<", "y")],
    "key and range": [("k", "=", "k"), ("lo", "<", "x"), ("hi", ">=", "x")],
    "overlap": [("lo", "<=", "y"), ("hi", ">=", "x")],
    "one side": [("lo", ">=", "x")],
    "key alone": [("k", "=", "k")],
}


MIXES = [("bigint", c) for c in CONDITIONS] + [(k, c) for k in KINDS for c in list(CONDITIONS)[:2] if k != "bigint"]


@pytest.mark.parametrize("kind, condition", MIXES)
@pytest.mark.parametrize("with_rest", [False, True])
def test_conditions_equal_brute_force(spark, kind, condition, with_rest):
    draw, terms = random.Random(11), CONDITIONS[condition]

    def some():
        return draw.choice([None, *map(KINDS[kind], range(40))])

    ours = [(i, draw.choice(["a", "a", "b", None]), some(), some(), draw.choice([None, 0, 1, 2])) for i in range(120)]
    theirs = [(i, draw.choice(["a", "a", "b", None]), some(), some(), i % 3) for i in range(50)]
    left, right = ("i", "k", "x", "y", "r"), ("j", "k", "lo", "hi", "s")

    def holds(a, b):
        pairs = [(b[t], a[o], op) for t, op, o in terms] + ([(b["s"], a["r"], "=")] if with_rest else [])
        return all(None not in (p, q) and OPS[op](p, q) for p, q, op in pairs)

    expected = {}
    for a in (dict(zip(left, row)) for row in ours):
        expected[a["i"]] = max((b["j"] for b in (dict(zip(right, row)) for row in theirs) if holds(a, b)), default=None)
    df = spark.createDataFrame(ours, f"i int, k string, x {kind}, y {kind}, r int")
    other = spark.createDataFrame(theirs, f"j int, k string, lo {kind}, hi {kind}, s int").withColumn("back", -F.col("j"))
    rest = (lambda their: their["s"] == F.col("r")) if with_rest else None
    got = formula.by_condition(df, other, terms, "j", ["back"], "found", rest, ["r"] if with_rest else []).collect()
    assert {r["i"]: r["found"] for r in got} == expected and len(got) == len(ours)


def test_conditions_on_empty_tables_mixed_types_and_nan(spark):
    df = spark.createDataFrame([(1, 2.5), (2, float("nan")), (3, None), (3, None)], "id int, v double")
    other = spark.createDataFrame([(7, 2), (8, 3)], "id int, w int")
    find = functools.partial(formula.by_condition, terms=[("w", "<=", "v")], value="id", order_by=["id"], name="found")
    assert sorted((r["id"], r["found"]) for r in find(df, other).collect() if r["found"]) == [(1, 7), (2, 7)]
    assert [r["found"] for r in find(df, other.limit(0)).collect()] == [None] * 4
    assert find(df.limit(0), other).count() == 0
    with pytest.raises(ValueError):
        find(df, other, terms=[])


def test_comparison_lookup_tells_large_numbers_apart(spark):
    df = spark.createDataFrame([(LARGE + n,) for n in range(6)], "v bigint")
    other = spark.createDataFrame([(LARGE + 2,), (LARGE + 4,)], "w bigint").withColumn("back", -F.col("w"))
    got = formula.by_comparison(df, other, [], ("w", "<=", "v"), "w", ["back"], "found").orderBy("v").collect()
    assert [r["found"] and r["found"] - LARGE for r in got] == [None, None, 2, 2, 4, 4]


def test_last_filled_lookup_wins(spark):
    parent = spark.createDataFrame([("a", "A"), ("b", "B")], "pid string, v string")
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", None), (3, "a", "zz"), (4, None, None)], "i int, l1 string, l2 string")
    got = formula.from_parent(df, ["l1", "l2"], parent, "pid", "v", "x").collect()
    assert {r["i"]: r["x"] for r in got} == {1: "B", 2: "A", 3: None, 4: None}
