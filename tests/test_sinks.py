from pyspark.sql import functions as F

from stopover.sources import sinks


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_keeps_empty_and_null_apart(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(1, ""), (2, None), (3, " padded "), (4, 'a "quoted", part'), (5, "back\\slash"),
            (6, "₹ 73,673"), (7, "\\"), (8, '"')]
    df = spark.createDataFrame(rows, "k int, layover string").repartition(3)
    sinks.write_csv(df, path)
    assert values(sinks.read_csv(spark, path, df.schema)) == sorted(rows, key=repr)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 3


def test_csv_with_line_breaks(spark, tmp_path):
    path, rows = str(tmp_path / "csv"), [(1, "a\nb"), (2, "c")]
    df = spark.createDataFrame(rows, "k int, t string")
    sinks.write_csv(df, path)
    assert values(sinks.read_csv(spark, path, df.schema, multi_line=True)) == rows


def test_json_round_trip_keeps_null_fields(spark, tmp_path):
    path = str(tmp_path / "json")
    df = spark.createDataFrame([(1, None, []), (2, "x", ["a", None])],
                               "k int, t string, l array<string>")
    sinks.write_json(df, path)
    sinks.write_json(df, path)
    assert values(sinks.read_json(spark, path, df.schema)) == values(df)


def test_times_keep_their_microseconds(spark, tmp_path):
    df = spark.sql("select 1 k, timestamp_ntz'2024-01-01 00:00:07.179575' a, "
                   "timestamp'2024-01-01 00:00:07.000001' b, date'2024-02-29' c "
                   "union all select 2, timestamp_ntz'2024-01-01 00:00:00', null, null")
    for name, write, read in (("json", sinks.write_json, sinks.read_json),
                              ("csv", sinks.write_csv, sinks.read_csv)):
        path = str(tmp_path / name)
        write(df, path)
        assert values(read(spark, path, df.schema)) == values(df)


def test_partitioned_table_prunes(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.range(100).select("id", F.when(F.col("id") < 40, "2031-07-24").otherwise(
        "2031-07-25").alias("search_date"))
    sinks.write_partitioned(df, path, "search_date")
    back = spark.read.parquet(path)
    assert back.schema["search_date"].dataType.simpleString() == "date"
    day = back.where("search_date = date'2031-07-24'")
    assert day.count() == 40
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(search_date" in plan


def test_replacing_a_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "days")
    first = spark.createDataFrame(
        [("a", 1, "2025-01-01"), ("b", 2, "2025-01-02")], "n string, v int, fetch_date string")
    sinks.replace_snapshots(first, path)
    again = spark.createDataFrame([("b", 3, "2025-01-02"), ("c", 4, "2025-01-03")], first.schema)
    for _ in range(2):
        sinks.replace_snapshots(again, path)
    assert values(spark.read.parquet(path).select("n", "v")) == [("a", 1), ("b", 3), ("c", 4)]
