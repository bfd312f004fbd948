"""Distinct rows by packed columns, and what a staging leaves behind."""

import datetime
import math
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from stopover import session
from stopover.operators import distinct
from stopover.operators.distinct import distinct_rows
from stopover.operators.summary import distinct_segments
from stopover.plans import nested_orders
from stopover.schema import SEGMENT_COLUMNS
from tests.test_queries import odd_orders

DAY = datetime.datetime(1995, 5, 5)
ODD = [
    ("a", "b", 1, 1.5, True, DAY, b"x"), ("ab", "", 1, 1.5, True, DAY, b"x"),
    ("", "ab", 1, 1.5, True, DAY, b"x"), (None, "ab", 1, 1.5, True, DAY, b"x"),
    ("ab", None, 1, 1.5, True, DAY, b"x"), ("₹ ü", "b", None, None, None, None, None),
    (None,) * 7, ("", "", 0, 0.0, False, DAY, b""), ("", "", 0, float("nan"), False, DAY, b""),
    ("x" * 5000, "b", -(1 << 62), 1.5, True, DAY, b"\x00\xff"),
]
KINDS = "t string, u string, n bigint, x double, b boolean, d timestamp, y binary"


def plain(rows):
    return sorted((tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r)
                   for r in rows), key=repr)


@pytest.mark.parametrize("at_once", [1, 32 << 20])
def test_distinct_rows_are_those_of_spark(spark, monkeypatch, at_once):
    monkeypatch.setattr(distinct, "PACKED_AT_ONCE", at_once)
    df = spark.createDataFrame(ODD * 40, KINDS).repartition(5)
    found = distinct_rows(df, ["d", "t"])
    assert found.schema == df.schema
    assert plain(found.collect()) == plain(df.distinct().collect()) == plain(ODD)
    assert distinct_rows(df.where("false")).collect() == []


def shuffled(df):
    """Bytes that the plan of ``df`` has shuffled."""
    df.collect()
    nodes, total = [df._jdf.queryExecution().executedPlan().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        while node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            total += node.metrics().get("shuffleBytesWritten").get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_distinct_segments_shuffle_packed_rows(spark):
    n = F.col("id")
    text = {"fetch_date": F.lit("1995-01-01"), "duration": n % 4 * 90,
            "flightNumber": (n * 7919 % 20_000).cast("string"),
            "marketingCarrier": F.concat(F.lit("Supplier#"), F.lpad((n % 997).cast("string"), 9, "0")),
            "departure": F.concat(F.date_add(F.lit(DAY), (n / 4 % 900).cast("int")), F.lit("T00:00:00")),
            "formattedPrice": F.floor(n / 4).cast("string")}
    rows = spark.range(40_000, numPartitions=4).select(
        *[text.get(c, F.concat(F.lit(c), n % 25)).alias(c) for c in SEGMENT_COLUMNS])
    twice = rows.unionByName(rows)
    assert distinct_segments(twice, SEGMENT_COLUMNS).count() == 40_000
    assert 3 * shuffled(distinct_segments(twice, SEGMENT_COLUMNS)) < 2 * shuffled(twice.distinct())


def shuffle_files(spark):
    folder = spark.conf.get("spark.local.dir", None) or "/tmp"
    return {f for top, _, names in os.walk(folder) if "blockmgr-" in top
            for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_staging_leaves_the_landing_and_the_store_only(spark, monkeypatch, tmp_path):
    """Tables and shuffles on the way go when what is read from them is written."""
    odd_orders(spark, str(tmp_path))
    monkeypatch.setattr(nested_orders, "_staged", {})
    for module in (session, nested_orders):
        monkeypatch.setattr(
            module, "fresh_path", lambda s, what: f"{tmp_path}/made/{what}-{uuid.uuid4().hex}")
    before = shuffle_files(spark)
    store = nested_orders.merged(spark, str(tmp_path))
    until = time.time() + 20  # executors delete in their own time
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sorted(f.split("-")[0] for f in os.listdir(tmp_path / "made")) == ["landing", "merged"]
    assert store.count() == 5
    assert spark.conf.get(session._FREE_SHUFFLES) == "false"


def test_a_failed_staging_leaves_nothing(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "fresh_path", lambda s, what: f"{tmp_path}/{what}")
    with pytest.raises(RuntimeError), session.passing(spark):
        kept = session.staged_from(spark, lambda: session.staged(spark.range(3), "inner"), "outer")
        assert os.listdir(tmp_path) == ["outer"] and kept.count() == 3
        raise RuntimeError
    assert os.listdir(tmp_path) == []
