"""Person and business passes over one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.cells import strip
from rowferry.functions.keys import row_id
from rowferry.functions.text import join_name, split_name
from rowferry.operators.filters import person_side
from rowferry.operators.project import clone

# Columns a pass must not write.
NOT_FOR_BUSINESS = ("FirstName", "LastName", "IsPersonAccount", "Salutation", "MiddleName", "Suffix")
NOT_FOR_PERSON = ("IsPersonAccount", "Name")


def person_names(df: DataFrame, id_column: str, name: str = "Name", first: str = "FirstName", last: str = "LastName") -> DataFrame:
    """K14, persons: without first and last name, the words of the name are used, else an id."""
    empty = (F.coalesce(F.col(first), F.lit("")) == "") & (F.coalesce(F.col(last), F.lit("")) == "")
    one, two = split_name(F.col(name))
    one = F.when((one == "") & (two == ""), row_id("name", id_column, length=10)).otherwise(one)
    return df.withColumns(
        {first: F.when(empty, one).otherwise(F.col(first)), last: F.when(empty, two).otherwise(F.col(last))}
    )


def business_names(df: DataFrame, id_column: str, name: str = "Name", first: str = "FirstName", last: str = "LastName") -> DataFrame:
    """K14, business: a blank name is put together from first and last name, else an id."""
    composed = F.nullif(join_name(F.col(first), F.col(last)), F.lit(""))
    made = F.coalesce(composed, row_id("name", id_column, length=10))
    blank = F.coalesce(strip(F.col(name)), F.lit("")) == ""
    return df.withColumn(name, F.when(blank, made).otherwise(F.col(name)))


def passes(df: DataFrame, flag: str, id_column: str) -> tuple[DataFrame, DataFrame]:
    """(business rows, person rows), each with its own columns and name rule."""
    business = business_names(person_side(df, flag, False), id_column)
    person = person_names(person_side(df, flag, True), id_column)
    return clone(business, exclude_=NOT_FOR_BUSINESS), clone(person, exclude_=NOT_FOR_PERSON)


def both_passes(df: DataFrame, flag: str, id_column: str, columns: Sequence[str]) -> DataFrame:
    """M15 as one plan, the pass named in ``pass``; columns a pass leaves out are null."""
    business, person = passes(df, flag, id_column)
    both = business.withColumn("pass", F.lit("business")).unionByName(
        person.withColumn("pass", F.lit("person")), allowMissingColumns=True
    )
    return both.select(*columns, "pass")
