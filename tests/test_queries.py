"""Every registered query against its SQL, on the smallest tables."""

import datetime
import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows
from stopover.plans import catalog, nested_orders
from stopover.plans.catalog import QUERIES
from stopover.plans.nested_orders import order_envelopes
from stopover.plans.oracle import ORACLE
from stopover.sources.snapshots import list_versions

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def views(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def db():
    return views(SF)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of the line items in one order, and copies of one line."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        source = f"{SF}/{name}.parquet"
        if name == "lineitem":
            query = f"""
                with l as (select *, row_number() over () as n from '{source}')
                select * exclude n replace (
                    case when n % 3 = 0 then (select min(o_orderkey) from '{SF}/orders.parquet')
                    else l_orderkey end as l_orderkey) from l
                union all
                select l.* exclude n from l, range(1500) where n = 1"""
        else:
            query = f"select * from '{source}'"
        duckdb.execute(f"copy ({query}) to '{folder}/{name}.parquet' (format parquet)")
    return folder


def compare(spark, folder, db, name):
    df = queries()[name](spark, folder)
    got = rows([tuple(r) for r in df.collect()], df.columns)
    result = db.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(result.fetchall(), columns)
    assert got


@needs_data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, db, name):
    compare(spark, SF, db, name)


# What reads line items, or the nested records made of them.
FROM_LINES = sorted(set(QUERIES) - {
    "union_by_name", "id_list_scan", "incremental_ingest", "snapshot_replace", "literal_column",
    "rename_column", "format_message", "record_count", "lead_next", "timestamp_parse",
    "date_partition_key", "path_part", "preview_limit"})


@needs_data
@pytest.mark.parametrize("name", FROM_LINES)
def test_query_equals_sql_on_skewed_tables(spark, skewed, name):
    compare(spark, skewed, views(skewed), name)


def many_lines(lines, like):
    """20,000 lines of one order: unlike in ``like`` only, and copies."""
    numbers = lines.sparkSession.range(20_000)
    kind = {f.name: f.dataType for f in lines.schema}
    n = F.col("id")
    changed = {
        "numbers": {"l_linenumber": n},
        "dates and quantities": {"l_shipdate": F.date_add("l_shipdate", (n % 700).cast("int")),
                                 "l_quantity": n % 50},
        "equal sums": {"l_partkey": n + 1, "l_suppkey": 30_000 - n},
        "copies": {},
        "nulls": {"l_quantity": F.when(n % 2 == 0, n), "l_shipdate": F.lit(None),
                  "l_extendedprice": F.lit(None)},
    }[like]
    rows = lines.limit(1).crossJoin(numbers)
    return rows.withColumns({c: v.cast(kind[c]) for c, v in changed.items()}).drop("id")


@needs_data
@pytest.mark.parametrize(
    "like", ["numbers", "dates and quantities", "equal sums", "copies", "nulls"])
def test_legs_stay_small_whatever_one_order_holds(spark, tmp_path, like):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    many_lines(lines, like).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    records = order_envelopes(spark, str(tmp_path))
    itineraries = records.select(F.explode("data.itineraries").alias("i"))
    assert itineraries.agg(F.max(F.size("i.legs"))).first()[0] == 8
    legs = itineraries.select(F.explode("i.legs").alias("leg"))
    row = legs.agg(F.sum(F.size("leg.segments")).alias("all"),
                   F.min(F.size("leg.segments")).alias("least"),
                   F.max(F.size("leg.segments")).alias("most"),
                   F.count_distinct("leg.id").alias("ids")).first()
    assert (row["all"], row["least"], row["most"], row["ids"]) == (20_000, 4, 4, 5_000)


@needs_data
def test_record_lists_stay_small_whatever_one_key_holds(spark, tmp_path):
    """A third of the customers, and 2,000 copies of one, under one key."""
    folder = str(tmp_path)
    duckdb.execute(f"""copy (
        select * replace (case when c_custkey % 3 = 0 then 7 else c_custkey end as c_custkey)
        from '{SF}/customer.parquet'
        union all
        select c.* from '{SF}/customer.parquet' c, range(2000) where c_custkey = 1
        ) to '{folder}/customer.parquet' (format parquet)""")
    for name in set(TABLES) - {"customer"}:
        os.symlink(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
    for name in ("record_count", "format_message"):
        compare(spark, folder, views(folder), name)
    counts = queries()["record_count"](spark, folder)
    assert counts.agg(F.max("listed")).first()[0] == 500


@needs_data
def test_summary_reads_lines_once(spark):
    plan = queries()["itinerary_summary"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber#") and plan.count("Relation [l_orderkey") == 1


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(oracle_sql()) <= set(queries())


def plan_of(df):
    """The plan that ran, with its shuffles."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@needs_data
def test_no_wide_row_is_grouped_or_sorted(spark):
    """Records are cut from sorted lines; lists are gathered by no aggregation, which would sort them."""
    plan = plan_of(order_envelopes(spark, SF))
    assert "collect_list" not in plan and "MapInArrow" in plan


@needs_data
def test_landed_files_are_packed(spark):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    files = list_versions(spark, nested_orders.landing(spark, SF), "*")
    text = nested_orders.envelopes(spark, SF).agg(
        F.sum(F.length(nested_orders.envelope_text()))).first()[0]
    assert files.where(~F.col("file_path").endswith(".json.gz")).isEmpty()
    assert 3 * files.agg(F.sum("length")).first()[0] < text
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


@needs_data
def test_files_of_the_store_are_small(spark, monkeypatch):
    """A task of a scan takes few of them, and so few exploded rows."""
    monkeypatch.setattr(nested_orders, "RECORDS_PER_STORED_FILE", 3)
    monkeypatch.setattr(nested_orders, "_staged", {})
    store = nested_orders.merged(spark, SF)
    sizes = store.groupBy(F.col("_metadata.file_path")).count()
    assert sizes.agg(F.max("count")).first()[0] == 3


def odd_orders(spark, folder):
    """Orders twice, without a key, a price or a date, and lines of none."""
    day = datetime.datetime(1995, 5, 5)
    heads = [(1, 10.5, day), (1, 10.5, day), (2, None, day), (3, 7.0, None), (None, 1.0, day),
             (None, 1.0, day), (70, 8.0, day), (71, 9.0, day), (71, 9.5, day)]
    lines = [(key, n, n + 1, n % 3, 1.0, 5.0, "F", day) for key in (1, 2, 3, 71, 99, None)
             for n in range(37)] + [(1, None, None, None, None, None, None, None)]
    spark.createDataFrame(
        heads, "o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice "
        "double, l_quantity double, l_linestatus string, l_shipdate timestamp_ntz"
    ).write.parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_records_are_whole_whatever_a_batch_holds(spark, tmp_path, rows):
    odd_orders(spark, str(tmp_path))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        found = order_envelopes(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(name, before)
    shape = sorted((r.message, r.fetch_date or "", [(i.id, i.price.raw, [
        (leg.id, len(leg.segments), leg.durationInMinutes) for leg in i.legs])
        for i in r.data.itineraries]) for r in found)

    def legs(key, numbers, sizes=None):
        return [(f"{key}-{n}", s, s * 90) for n, s in zip(
            numbers, sizes or [4] * len(numbers), strict=True)]

    year = "1995-01-01"
    page = [*range(8)]
    assert shape == sorted([
        # 38 lines of an order that is there twice: each leg has each line twice
        ("0-0", year, [("1", 10.5, legs(1, page, [8] * 8)), ("2", None, legs(2, page))]),
        ("0-1", year, [("1", 10.5, legs(1, [8, 9], [8, 4])), ("2", None, legs(2, [8, 9], [4, 1]))]),
        ("0-0", "", [("3", 7.0, legs(3, page))]), ("0-1", "", [("3", 7.0, legs(3, [8, 9], [4, 1]))]),
        ("1-0", year, [("70", 8.0, []), ("71", 9.0, legs(71, page)), ("71", 9.5, legs(71, page))]),
        ("1-1", year, [("71", p, legs(71, [8, 9], [4, 1])) for p in (9.0, 9.5)]),
        ("0", year, [(None, 1.0, [])])])


@needs_data
def test_leg_summary_shuffles_once(spark):
    plan = plan_of(queries()["itinerary_summary_by_leg"](spark, SF))
    final = plan.split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1


@needs_data
@pytest.mark.parametrize("name, label", [
    ("merged_json_roundtrip", "merged_json"), ("json_sink_roundtrip", "json"),
    ("multiline_json_scan", "multiline")])
def test_written_text_is_packed(spark, monkeypatch, tmp_path, name, label):
    monkeypatch.setattr(nested_orders, "_staged", {})
    for module in (nested_orders, catalog):
        monkeypatch.setattr(module, "fresh_path", lambda s, what: f"{tmp_path}/{what}-{uuid.uuid4().hex}")
    assert queries()[name](spark, SF).count()
    found = list_versions(spark, f"{tmp_path}/{label}-*", "part-*")
    assert found.count() and found.where(~F.col("file_path").endswith(".gz")).isEmpty()


@needs_data
def test_lines_are_shuffled_without_what_follows_from_them(spark):
    """Day, block and page of a line are made behind the shuffle."""
    plan = order_envelopes(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    for name in ("fetch_date", "block", "page"):
        assert f" AS {name}#" in above and f" AS {name}#" not in below
