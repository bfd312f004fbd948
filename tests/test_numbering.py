"""Running numbers in groups that are cut into many ranges, against a plain count."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stopover.operators.numbering import in_ranges, running_number


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small partitions stay as they are, so that there is more than one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain(rows, weighted):
    """Sum of rows (or weights) before each, by (key, order)."""
    def rank(value):
        return (value is not None, value)

    out, before = [], defaultdict(int)
    for key, at, weight in sorted(rows, key=lambda r: (rank(r[0]), rank(r[1]), r[2])):
        out.append((key, at, weight, before[key]))
        before[key] += weight if weighted else 1
    return out


def made(kind):
    dice = random.Random(kind)
    if kind == "hot":
        return [("hot" if dice.random() < 0.7 else f"k{dice.randrange(50)}", n, 1 + n % 3)
                for n in range(3000)]
    if kind == "one group":
        return [("only", n // 7, 2) for n in range(2000)]
    if kind == "equal rows":
        return [("a", 1, 5)] * 1500 + [("b", 2, 3)] * 1500
    if kind == "nulls":
        return [(dice.choice([None, "a", "b"]), dice.choice([None, *range(400)]), 1)
                for _ in range(2500)]
    return [(f"k{n}", 0, n % 4) for n in range(1000)]


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("kind", ["hot", "one group", "equal rows", "nulls", "small groups"])
def test_numbers(spark, kind, weighted):
    rows = made(kind)
    df = spark.createDataFrame(rows, "key string, at int, w int").repartition(5)
    # Rows alike in key and order come in any order: their weights are made alike here.
    if weighted:
        rows = [(k, a, 1 + (a or 0) % 3) for k, a, _ in rows]
        df = spark.createDataFrame(rows, "key string, at int, w int").repartition(5)
    got = running_number(df, ["key"], ["at"], "n", "w" if weighted else None)
    assert got.columns == ["key", "at", "w", "n"]
    want = plain(rows, weighted)
    drop = (lambda r: tuple(r)) if weighted else (lambda r: (r[0], r[1], r[3]))
    assert sorted(map(drop, got.collect()), key=repr) == sorted(map(drop, want), key=repr)


def test_no_rows(spark):
    df = spark.createDataFrame([], "key string, at int")
    assert running_number(df, ["key"], ["at"], "n").collect() == []


def test_no_task_holds_a_hot_group(spark):
    """A group of equal rows is dealt to all ranges, and numbered through."""
    df = spark.range(40_000).select(F.lit("hot").alias("key"), F.lit(1).alias("at"))
    sizes = [r["count"] for r in in_ranges(df.repartition(5), ["key"], ["at"]).groupBy(
        "_range").count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 10_000
    numbers = running_number(df.repartition(5), ["key"], ["at"], "n").agg(
        F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(numbers) == (40_000, 0, 39_999)
