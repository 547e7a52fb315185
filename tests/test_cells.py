"""Cells, keys and texts with literal cases."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions import cells, keys, text
from rowferry.sources import scan


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_typed_csv(spark, tmp_path):
    folder = tmp_path / "typed.csv"
    folder.write_text(
        "Id,ISACTIVE,employees,AnnualRevenue,Name,NullToken,DateValue,DateTimeValue,Toggle,Bad\n"
        "001,TRUE,42,12345.67,Acme,NULL,31/12/2025,31.12.2025 14:05:06,yes,N/A\n"
        "\n"
        "002,0,-3,1e3,\"A, \"\"B\"\"\",x,01.02.26,01-02-26 7:8,off,7\n"
    )
    kinds = {
        "IsActive": "boolean", "Employees": "int", "annualrevenue": "currency", "DATEVALUE": "date",
        "datetimevalue": "datetime", "toggle": "boolean", "bad": "int", "Name": "string",
    }
    df = scan.read_csv(spark, str(folder), kinds, european_dates=True)
    first, second = sorted(df.collect(), key=lambda r: r["Id"])
    assert (first["ISACTIVE"], first["employees"], first["AnnualRevenue"], first["Name"]) == (True, 42, 12345.67, "Acme")
    assert first["NullToken"] is None and first["Toggle"] is True
    assert first["DateValue"] == datetime.date(2025, 12, 31)
    assert first["DateTimeValue"] == datetime.datetime(2025, 12, 31, 14, 5, 6)
    assert (first["Bad"], first["Bad__raw"]) == (None, "N/A")
    assert (second["ISACTIVE"], second["employees"], second["AnnualRevenue"]) == (False, -3, 1000.0)
    assert second["Name"] == 'A, "B"' and second["DateValue"] == datetime.date(2026, 2, 1)
    assert second["DateTimeValue"] == datetime.datetime(2026, 2, 1, 7, 8)
    assert (second["Bad"], second["Bad__raw"]) == (7, None)


def test_missing_file_is_empty(spark, tmp_path):
    df = scan.read_csv(spark, str(tmp_path / "none.csv"), {"Id": "string", "n": "int"})
    assert df.count() == 0 and df.columns[:2] == ["Id", "n"]


def test_dates(spark):
    cases = {"31/12/69": "2069-12-31", "1.1.70": "1970-01-01", "29.02.2023": "29.02.2023", "29-02-2024": "2024-02-29", "x": "x", "1.1.": "1.1."}
    for raw, expected in cases.items():
        assert one(spark, cells.european_date_text(F.lit(raw))) == expected
    assert one(spark, cells.european_datetime_text(F.lit("31.12.2025 14:05:06"))) == "2025-12-31T14:05:06.000Z"
    assert one(spark, cells.european_datetime_text(F.lit("31.12.2025 24:00"))) == "31.12.2025 24:00"


def test_numbers(spark):
    for raw, expected in {"12": 12.0, " -1.5e2 ": -150.0, "12d": None, "NaN": None, "1e999": None, ".5": 0.5, "": None}.items():
        assert one(spark, cells.to_number(F.lit(raw))) == expected
    assert one(spark, cells.to_integer(F.lit("9007199254740993"))) == 9007199254740993


def test_null_tokens(spark):
    for raw in ("#N/A", " null", "Undefined", "#ERROR!", "#value!\r", "  "):
        assert one(spark, cells.normalize_cell(F.lit(raw))) is None
    assert one(spark, cells.normalize_cell(F.lit(" a \r\r"))) == " a "
    assert one(spark, cells.normalize_cell(F.lit(" "), blank_as_null=False)) == ""
    assert one(spark, cells.normalize_cell(F.lit("#N/A\r"), keep_null_tokens=True)) == "#N/A"


def test_loose_inequality(spark):
    null = F.lit(None).cast("string")
    assert one(spark, cells.differs(F.lit("1"), F.lit(1), T.IntegerType())) is False
    assert one(spark, cells.differs(F.lit(1), F.lit(True), T.BooleanType())) is False
    assert one(spark, cells.differs(null, null, T.StringType())) is False
    assert one(spark, cells.differs(F.lit(""), null, T.StringType())) is True
    assert one(spark, cells.differs(F.lit("b"), F.lit("a"), T.StringType())) is True


def test_composite_key(spark):
    key = keys.key_text([F.lit("A"), F.lit(""), F.lit(None).cast("string"), F.lit("B")])
    assert one(spark, key) == "A;B"
    assert one(spark, keys.key_text([F.lit(""), F.lit(None).cast("string")])) is None
    assert one(spark, keys.key_text([F.lit("A"), F.lit("")], strict=True)) == "A;"


def test_row_hash_normalises(spark):
    left = spark.createDataFrame([("TRUE", "1.0", " a b", None)], "t string, n string, s string, e string")
    right = spark.createDataFrame([(True, 1, "ab", "")], "t boolean, n int, s string, e string")
    assert left.select(keys.row_digest(left)).first() == right.select(keys.row_digest(right)).first()


def test_names(spark):
    first, last = text.split_name(F.lit("  Jane   Doe Smith "))
    assert (one(spark, first), one(spark, last)) == ("Jane", "Doe")
    assert one(spark, text.join_name(F.lit(" A "), F.lit(None).cast("string"))) == "A"


def test_words():
    assert text.expand_words(["éa", "b"]) == ["éa", "b", "ea"]
    assert text.plain_words(["Foo", "é"]) == (["e", "foo"], ["é"])


def test_ascii_boundaries(spark):
    df = spark.createDataFrame([("éfoo",), ("foo",), ("xfoo",), ("foo_",), ("éa b",), ("xéa b",)], "t string")
    hit = F.col("t").rlike(text.words_pattern(["foo"]))
    assert [r[0] for r in df.select(hit).collect()] == [True, True, False, False, False, False]
    accented = F.col("t").rlike(text.words_pattern(["éa"]))
    # As with ASCII word boundaries elsewhere: a boundary before é needs a word character there.
    assert [r[0] for r in df.select(accented).collect()] == [False, False, False, False, False, True]


def test_base64_and_errors(spark):
    assert one(spark, text.as_base64(F.lit("QUJDREVGR0hJSktM"))) == "QUJDREVGR0hJSktM"
    assert one(spark, text.as_base64(F.lit("plain"))) == "cGxhaW4="
    assert one(spark, text.safe_file_name(F.lit(' a/b:c?"'))) == "a_b_c__"
    assert one(spark, text.safe_file_name(F.lit("  "))) == "file"
    assert one(spark, text.url_domain(F.lit("HTTPS://a.b.c/x"))) == "a.b.c"
    assert one(spark, text.url_domain(F.lit("ftp://a.b.c/x"))) is None
