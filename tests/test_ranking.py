"""Row order. Ordinals are checked against brute force, with and without hot keys."""

import datetime
import random

import numpy as np
import pytest
from rowferry.operators import batches, ranking


def skewed(n=3000, seed=1):
    """A third of the rows has one key, some keys are null, the order has outliers."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if draw.random() < 0.4 else draw.choice([None, "a", "b", f"k{draw.randrange(300)}"])
        out.append((key, draw.choice([i, i * 7, i + 10**12 if i % 500 == 0 else i]), i))
    return out


def brute(rows, key, order):
    seen, out = {}, {}
    for row in sorted(rows, key=order):
        seen[key(row)] = seen.get(key(row), 0) + 1
        out[row[2]] = seen[key(row)]
    return out


@pytest.mark.parametrize("hot_rows", [10**6, 200, 0])
def test_rank_with_hot_key(spark, hot_rows):
    data = skewed()
    df = spark.createDataFrame(data, "k string, o long, i long")
    got = ranking.rank_rows(df, ["k"], ["o", "i"], "rn", hot_rows=hot_rows).collect()
    assert {r["i"]: r["rn"] for r in got} == brute(data, lambda r: r[0], lambda r: (r[1], r[2]))
    assert len(got) == len(data)


def test_rank_over_all_rows(spark):
    data = skewed()
    df = spark.createDataFrame(data, "k string, o long, i long")
    got = {r["i"]: r["rn"] for r in ranking.rank_rows(df, [], ["o", "i"], "rn").collect()}
    assert got == brute(data, lambda r: 0, lambda r: (r[1], r[2]))


@pytest.mark.parametrize("kind", ["string", "timestamp", "date", "double"])
def test_rank_by_other_types(spark, kind):
    start = datetime.datetime(2024, 1, 1)
    make = {
        "string": lambda i: f"same-prefix-{i:05d}",
        "timestamp": lambda i: start + datetime.timedelta(seconds=i),
        "date": lambda i: (start + datetime.timedelta(days=i)).date(),
        "double": lambda i: i / 3 - 50,
    }[kind]
    order = list(range(400))
    random.Random(2).shuffle(order)
    df = spark.createDataFrame([("k", make(i), i) for i in order], f"k string, o {kind}, i long")
    got = ranking.rank_rows(df, ["k"], ["o"], "rn", hot_rows=10).collect()
    assert all(r["rn"] == r["i"] + 1 for r in got)


def test_first_last_and_flags(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, "w")], "k string, o int, v string")
    assert rows(ranking.first_per_key(df, ["k"], ["o"]), "k", "v") == [("a", "y"), (None, "w")]
    assert rows(ranking.last_per_key(df, ["k"], ["o"]), "k", "v") == [("a", "x"), (None, "z")]
    assert rows(ranking.flag_first(df, ["k"], ["o"], "f"), "v", "f") == [("w", True), ("x", False), ("y", True), ("z", False)]
    assert rows(ranking.flag_last(df, ["k"], ["o"], "f"), "v", "f") == [("w", False), ("x", True), ("y", False), ("z", True)]


def test_duplicate_names(spark, rows):
    df = spark.createDataFrame([("X", 1), ("Y", 2), ("X", 3), ("X", 4)], "name string, i int")
    got = rows(ranking.duplicate_names(df, "name", ["i"], "u"), "i", "u")
    assert got == [(1, "X"), (2, "Y"), (3, "X_0"), (4, "X_1")]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, o long")
    assert ranking.rank_rows(df, [], ["o"]).count() == 0
    assert ranking.chunks(df, ["o"], 3).count() == 0


def greedy(sizes, limit):
    out, batch, fill = [], 0, None
    for size in sizes:
        size = max(size or 0, 0)
        if fill is not None and fill + size > limit:
            batch, fill = batch + 1, 0
        fill = (fill or 0) + size
        out.append(batch)
    return out


def size_lists(rng):
    return {
        "equal": [10] * 300,
        "random": rng.integers(0, 60, 400).tolist(),
        "oversized": [int(x) for x in rng.choice([0, 0, 5, 99, 100, 101, 500], 300)],
        "zeros": [0] * 200 + [101] + [0] * 50 + [3] * 100,
        "one": [7],
        "none": [None, 40, None, -5, 70, None],
        "at the limit": [50, 50, 1, 99, 1, 100, 100, 0, 1] * 20,
    }


@pytest.mark.parametrize("block, kind", [(16, "int"), (7, "double"), (1, "bigint"), (1 << 16, "bigint")])
def test_size_batches_equal_the_loop(spark, block, kind):
    rng = np.random.default_rng(1)
    lists = size_lists(rng)
    rows = [(g, int(i), s if s is None or kind != "double" else float(s)) for g, sizes in lists.items() for i, s in enumerate(sizes)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    df = spark.createDataFrame(rows, f"g string, o bigint, size {kind}")
    got = batches.size_batches(df, ["g"], ["o"], "size", 100, block=block).collect()
    for g, sizes in lists.items():
        assert [r["batch"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["o"])] == greedy(sizes, 100), g


def test_size_batches_without_groups_and_with_null_groups(spark):
    sizes = np.random.default_rng(2).integers(1, 30, 500).tolist()
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "o bigint, size bigint")
    got = batches.size_batches(df, [], ["o"], "size", 100, block=32).orderBy("o").collect()
    assert [r["batch"] for r in got] == greedy(sizes, 100)
    assert batches.size_batches(df.limit(0), [], ["o"], "size", 100).count() == 0
    odd = spark.createDataFrame([(None, 1, 60), (None, 2, 60), ("", 3, 60), ("a|b", 4, 60)], "g string, o bigint, size bigint")
    assert sorted(r["batch"] for r in batches.size_batches(odd, ["g"], ["o"], "size", 100).collect()) == [0, 0, 0, 1]


def test_paths_of_a_block():
    link = np.array([2, 3, 5, 4, 9, 6, 9])
    last, steps = batches.last_starts(link)
    assert last.tolist() == [6, 4, 6, 4, 4, 6, 6] and steps.tolist() == [3, 2, 2, 1, 0, 1, 0]
    assert batches.starts_from(link, 0).tolist() == [True, False, True, False, False, True, True]


def test_size_batches_per_group(spark):
    draw = random.Random(3)
    data = [("hot" if i % 3 else f"g{i % 5}", i, draw.randrange(0, 50)) for i in range(900)]
    df = spark.createDataFrame(data, "g string, o long, size long")
    got = batches.size_batches(df, ["g"], ["o"], "size", 100, block=64).collect()
    assert len(got) == len(data)
    for group in {row[0] for row in data}:
        mine = sorted((r for r in got if r["g"] == group), key=lambda r: r["o"])
        assert [r["batch"] for r in mine] == greedy([r["size"] for r in mine], 100)


def test_rank_rows_with_ties_nan_and_nulls(spark):
    """A constant first order column, NaN and null values, and rows that are equal throughout."""
    nan, inf = float("nan"), float("inf")
    values = [1.0] * 500 + [nan] * 30 + [None] * 20 + [inf, -inf, 2.0, -3.0]
    rows = [("k", v, i) for i, v in enumerate(values)] + [("k", 1.0, 7)] * 5
    df = spark.createDataFrame(rows, "k string, v double, i int")

    def place(row):
        v = row["v"]
        return (0 if v is None else 1, inf if v is not None and v != v else v or 0, v is not None and v != v, row["i"])

    for keys, hot in (([], 10), (["k"], 10), (["k"], 10**6)):
        got = sorted(ranking.rank_rows(df, keys, ["v", "i"], "rn", cells=8, hot_rows=hot).collect(), key=lambda r: r["rn"])
        assert [r["rn"] for r in got] == list(range(1, len(rows) + 1))
        assert [place(r) for r in got] == sorted(place(r) for r in got)


def test_tied_orders_fill_all_ranges(spark):
    df = spark.range(20_000).selectExpr("1 AS c", "id")
    dealt = ranking._rank_by_ranges(df, {}, ["c"], "rn", 16)
    assert [r["rn"] for r in dealt.select("rn").orderBy("rn").collect()] == list(range(1, 20_001))
    sizes = [r["count"] for r in ranking.deal_by_range(df, {}, ["c"], 16).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_dealing_does_not_buffer_the_rows_of_a_map_task(spark):
    """Ranges are as few as map tasks write to without sorting what they read."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(0, 3_000, 1, 1).selectExpr("cast(id % 7 AS string) AS c", "id")
        assert ranking.deal_by_range(df, {}, ["id"]).rdd.getNumPartitions() <= 200
        assert ranking.with_cells(df, ["c", "id"]).rdd.getNumPartitions() <= 200
        got = ranking.rank_rows(df, [], ["id"], "rn").orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["rn"] for r in got] == list(range(1, 3_001))
