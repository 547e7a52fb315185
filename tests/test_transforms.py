"""Value mapping, mocking, projections, checks, sinks."""

import pytest
from pyspark.sql import functions as F

from rowferry.operators import filters, mapping, mocking, project, quality
from rowferry.sources import scan, sinks
from rowferry.spec import MockField, ValueRule


def test_value_mapping(spark):
    schema = "Id string, Type string, Status string, Flag string, Expr string, Fallback string, Plain string"
    df = spark.createDataFrame([("1", "Customer A", "NA", "1", "Enterprise", "raw", None), ("2", " Other ", "x", "0", "Small", "raw", "p")], schema)
    rules = [
        ValueRule("Account", "Type", "/customer/", "Client"),
        ValueRule("Account", "Status", "NA", "#N/A"),
        ValueRule("Account", "Flag", "1", "true"),
        ValueRule("Account", "Flag", "0", "FALSE"),
        ValueRule("Account", "Expr", "Enterprise", "eval(concat(RAW_VALUE, '-X'))"),
        ValueRule("Account", "Fallback", "raw", "eval(nothing_like(RAW_VALUE))"),
        ValueRule("Other", "Plain", "p", "q"),
    ]
    first, second = mapping.map_values(df, "Account", rules).orderBy("Id").collect()
    assert tuple(first) == ("1", "Client A", None, "true", "Enterprise-X", "raw", None)
    assert tuple(second) == ("2", "Other", "x", "false", "Small", "raw", "p")


def test_last_regex_counts_and_result_is_looked_up(spark):
    df = spark.createDataFrame([("ab",), ("cd",), (None,)], "v string")
    rules = [ValueRule("t", "v", "/zz/", "no"), ValueRule("t", "v", "/a(b)/", "$1x"), ValueRule("t", "v", "bx", "found"), ValueRule("t", "v", "", "empty")]
    assert sorted(r["v"] for r in mapping.map_values(df, "t", rules).collect()) == ["cd", "empty", "found"]


def test_rule_table_size_is_checked(spark):
    table = spark.range(5).select(F.lit("t").alias("ObjectName"), F.lit("f").alias("FieldName"), F.col("id").cast("string").alias("RawValue"), F.lit(" v ").alias("Value"))
    assert mapping.rules_from_table(table)[0].value == "v"
    with pytest.raises(ValueError):
        mapping.rules_from_table(table, limit=4)


def test_mock_sequences_count_masked_rows_only(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else "") for i in range(6)], "Id int, v string")
    got = mocking.apply(df, [MockField("v", "c_seq_number('N', 0, 3)", included="*")], "Id", ["Id"]).orderBy("Id").collect()
    assert [r["v"] for r in got] == ["", "N1", "", "N4", "", "N7"]


def test_mock_is_stable_and_leaves_ids(spark):
    df = spark.createDataFrame([(i, "a", "b") for i in range(20)], "Id int, v string, w string")
    mocks = [MockField("all", "name", exclude_names=("w",))]
    runs = [mocking.apply(df.repartition(n), mocks, "Id", ["Id"]).orderBy("Id").collect() for n in (1, 5)]
    assert runs[0] == runs[1]
    assert [r["Id"] for r in runs[0]] == list(range(20)) and {r["w"] for r in runs[0]} == {"b"} and "a" not in {r["v"] for r in runs[0]}


@pytest.mark.parametrize("kind", ["email", "phone", "city", "address", "zip", "company_name", "sentence", "title", "username", "url"])
def test_generators(spark, kind):
    values = [r[0] for r in spark.range(5).select(mocking.generated(kind, [F.col("id")], "f").cast("string")).collect()]
    assert all(values)


def test_keyword_choice_and_names(spark):
    df = spark.createDataFrame([(1, "a", "b")], "Id int, `name ` string, NAME string")
    fixed = project.repair_names(df, ["Id", "Name"])
    assert fixed.columns == ["Id", "Name"]
    assert project.rename(spark.createDataFrame([(1, 2, 3)], "`A__r.X` int, `A__r` int, `B$User` int"), {"A__r": "C__r", "B": "D"}).columns == ["C__r.X", "C__r", "D$User"]
    assert project.ordered_columns(["b", "Errors", "Old Id", "a", "Id"]) == ["Id", "Old Id", "a", "b", "Errors"]
    assert project.expand_compounds(["BillingAddress", "x"])[-2:] == ["BillingStreet", "x"]
    assert project.rename_map([("t", "", "U"), ("T", "a", "b"), ("t", "a", "c")], "t") == ("U", {"a": "b"})


def test_contract_names():
    assert quality.has_column(["'Account.Name'", "Id"], "name") and quality.has_column(["NAME"], "Name")
    assert quality.missing_columns(["Id", "Acc.Name"], ["Id", "Type"], [("AccId", "Acc.Name")]) == ["Type", "AccId"]
    assert quality.missing_columns(["Acc.Name"], ["Id"], [("AccId", "Acc.Name")], True, ["Id", "AccId"]) == []
    assert quality.has_column(["First", "Last"], "$$First$Last")


def test_bad_words(spark):
    df = spark.createDataFrame([("Bad foo", None), ("Good", "food"), (None, "FOO!")], "Name string, Description string")
    kept = filters.keep_words(df, ["Name", "Description"], ["foo"], mark=True).collect()
    assert sorted(map(tuple, kept), key=repr) == [("Bad ***foo***", None), (None, "***FOO***!")]
    accents = spark.createDataFrame([("DU ÈÉONX",), ("xÉON.",), ("éon",)], "t string")
    assert [r[0] for r in accents.select(filters.word_match(["t"], ["éon"])).collect()] == [False, True, False]
    many = [f"w{i}" for i in range(100)] + ["foo", "naïve"]
    texts = spark.createDataFrame([("a foo b",), ("food",), ("w7",), ("naive x",), ("so naïve.",), (None,)], "t string")
    long_list = [r[0] for r in texts.select(filters.word_match(["t"], many)).collect()]
    pattern = [r[0] for r in texts.select(F.coalesce(F.col("t"), F.lit("")).rlike(__import__("rowferry.functions.text", fromlist=["x"]).words_pattern(many))).collect()]
    assert long_list == pattern == [True, False, True, True, True, False]


def test_broken_filter_keeps_rows(spark):
    df = spark.range(4)
    assert filters.source_records_filter(df, "nope = 1").count() == 4
    assert filters.target_records_filter(df, "id > 1").count() == 2
    assert filters.target_records_filter(df, "  ").count() == 4


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    df = spark.createDataFrame([("1", 'a "q", b', None), ("2", "", "z")], "Id string, b string, a string")
    sinks.write_csv(df, path)
    back = scan.read_csv(spark, path, {})
    assert back.columns == ["Id", "a", "b"]
    assert sorted(map(tuple, back.collect()), key=repr) == [("1", None, 'a "q", b'), ("2", "z", None)]
    sinks.write_csv(df.where("false"), path)
    assert scan.read_text_csv(spark, path).columns == ["Id", "a", "b"]


def test_csv_line_breaks_and_damaged_records(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    cells = [("1", "one\ntwo"), ("2", 'a\r\n"b",\n\nc'), ("3", "plain")]
    sinks.write_csv(spark.createDataFrame(cells, "Id string, a string"), path)
    back = scan.read_text_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == cells and back.count() == back.select("a").count() == 3
    (tmp_path / "y.csv").write_text('Id,_corrupt_record\n1,x\n2\n3,y,z\n,\n"4","p\nq"\n')
    damaged = scan.read_text_csv(spark, str(tmp_path / "y.csv"))
    assert damaged.columns == ["Id", "_corrupt_record"] and ("4", "p\nq") in set(map(tuple, damaged.collect()))
    assert damaged.count() == damaged.select("Id").count() == len(damaged.collect()) == 3


def test_binary_bodies(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x00\x01abc")
    (tmp_path / "b.txt").write_bytes(b"no")
    rows = scan.read_bodies(spark, str(tmp_path), "*.bin").collect()
    assert [(r["size"], r["body"]) for r in rows] == [(5, "AAFhYmM=")]


def test_snapshot_reads_the_first_result(spark, tmp_path):
    first = scan.snapshot(spark, str(tmp_path), "q", lambda: spark.range(3))
    second = scan.snapshot(spark, str(tmp_path), "q", lambda: spark.range(9))
    assert first.count() == second.count() == 3
    assert scan.snapshot(spark, str(tmp_path), "other", lambda: spark.range(9)).count() == 9


def test_descending_order_as_keys(spark):
    from rowferry.operators import ordering

    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "i int, v int")
    for order, expected in {"v DESC": [3, 1, 2], "v": [2, 1, 3], "v ASC NULLS LAST": [1, 3, 2], "v DESC NULLS FIRST": [2, 3, 1]}.items():
        keyed, names = ordering.order_keys(df, order)
        assert [r["i"] for r in keyed.orderBy(*names).collect()] == expected
        assert [r["i"] for r in ordering.order_rows(df, order).collect()] == expected


def test_user_group_split(spark):
    df = spark.createDataFrame([("005x", "u"), ("00Gy", "g"), ("001z", "a"), (" ", "b"), (None, "c")], "Id string, Name string")
    parts = scan.split_by_prefix(df, "Id")
    assert {n: [r["Name"] for r in p.collect()] for n, p in parts.items()} == {"User": ["u"], "Group": ["g"]}


def test_rule_table_equals_rule_list(spark):
    """Later rules, empty values, regexes, typed words and expressions, from a table and from a list."""
    rules = [
        ("x", "v", "a", "first"), ("x", "v", " a ", "last"), ("x", "v", "b", "TRUE"), ("x", "v", "c", "null"), ("x", "v", "d", ""), ("x", "v", "/old(.)/", "unused"),
        ("x", "v", "/n(\\d+)/", "m$1-$2$$"), ("x", "v", "m7-$2$", "hit"), ("x", "v", "e", "eval(upper(RAW_VALUE))"), ("x", "v", "f", "eval(upper(RAW_VALUE))"), ("x", "w", "a", "other"), ("y", "v", "z", "no"),
    ]
    df = spark.createDataFrame([(v, "a", i) for i, v in enumerate(["a", "b", "c", "d", "n7", "xn12", "e", "f", "z", "", None, " a "])], "v string, w string, i int")
    table = spark.createDataFrame([(*r, n) for n, r in enumerate(rules)], "ObjectName string, FieldName string, RawValue string, Value string, line int")
    listed = [ValueRule(*r) for r in rules]
    by_table = mapping.map_values(df, "x", mapping.RuleTable(table, ("line",)), hits=True)
    by_list = mapping.map_values(df, "x", listed, hits=True)
    of = lambda out: [(r["v"], r["w"], r["v__rules"], r["w__rules"]) for r in out.orderBy("i").collect()]
    assert of(by_table) == of(by_list)
    assert [r[0] for r in of(by_table)][:9] == ["last", "true", None, "d", "hit", "xm12-$2$", "E", "F", "z"]
    counts = lambda rules: sorted(tuple(r) for r in mapping.rule_hits(df, "x", rules, ["v", "w"]).collect())
    assert counts(mapping.RuleTable(table, ("line",))) == counts(listed)


def test_rule_table_with_many_rules(spark):
    rules = spark.range(200_000).selectExpr("'x' AS ObjectName", "'v' AS FieldName", "cast(id AS string) AS RawValue", "concat('r', id) AS Value", "id AS line")
    df = spark.range(0, 400_000, 1000).selectExpr("cast(id AS string) AS v", "id")
    got = {r["id"]: r["v"] for r in mapping.map_values(df, "x", mapping.RuleTable(rules, ("line",)), ["v"]).collect()}
    assert got == {i: f"r{i}" if i < 200_000 else str(i) for i in range(0, 400_000, 1000)}


def test_replacements_are_text_but_for_groups():
    assert mapping.replacement_text("a(b)", r"x\y $1 $2 $& $$ $") == r"x\\y $1 \$2 $0 \$ \$"
    assert mapping.replacement_text("ab", "$1") == r"\$1"


def test_dollar_and_backslash_in_replacements(spark):
    df = spark.createDataFrame([("cost 5",)], "v string")
    for value, out in (("$", "$ 5"), ("C:\\x", "C:\\x 5"), ("$9", "$9 5"), ("<$1>", "<cost> 5"), ("eval(concat('$1', chr(92)))", "$1\\ 5")):
        assert mapping.map_values(df, "x", [ValueRule("x", "v", "/(cost)/", value)]).first()["v"] == out


def test_zero_and_false_are_no_values(spark):
    df = spark.createDataFrame([(1, 0, False, float("nan"), "0"), (2, 5, True, 1.5, ""), (3, None, None, 0.0, "false")], "id int, n int, b boolean, d double, s string")
    for expression, expected in (("*", [(2, "n"), (2, "b"), (2, "d"), (1, "s"), (3, "s")]), ("^*", [(1, "n"), (1, "b"), (1, "d"), (2, "s"), (3, "n"), (3, "b"), (3, "d")])):
        got = [(r["id"], c) for c in "nbds" for r in df.where(mocking.test(expression, F.col(c), df.schema[c].dataType)).collect()]
        assert sorted(got) == sorted(expected)
