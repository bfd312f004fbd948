"""One query per operator, on the test tables or on snapshots made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopover.functions.stops import (
    intermediate_stops, layover_text, stop_count, stop_count_from_text,
)
from stopover.functions.text import crew_message, path_part
from stopover.functions.times import date_key, local_time
from stopover.operators.flatten import (
    explode_itineraries, explode_legs, explode_records, explode_segments, flatten_segments,
    with_record_count,
)
from stopover.operators.gaps import (
    flight_gaps, lead_in_order, leg_connections, segment_connections,
)
from stopover.operators.numbering import running_number
from stopover.operators.summary import (
    LEG_KEYS, PRICE_KEYS, distinct_segments, first_by_position, last_by_position, ordered_codes,
    summarise_groups, summarise_legs, summarise_segments,
)
from stopover.plans import nested_orders as nested
from stopover.plans.nested_orders import (
    LANDED_FILES, code, fetch_date, iso_text, price_text, table, whole,
)
from stopover.plans.snapshot_job import itinerary_summary as summary_of_envelopes
from stopover.schema import (
    ENVELOPE, SEGMENT_COLUMNS, SUMMARY_COLUMNS, align_to, describe_paths, has_path,
)
from stopover.session import fresh_path, staged
from stopover.sources import sinks
from stopover.sources.batches import land, landed_files, open_landed, read_apart, unread
from stopover.sources.drift import record_shapes, schema_drift, shape_paths
from stopover.sources.manifest import discovered, extend_manifest
from stopover.sources.snapshots import (
    accepted, discover_snapshots, list_versions, merge_report, outcome, read_id_lists,
    read_snapshots, snapshot_states, union_by_name,
)
from stopover.streaming.ingest import ingest_new_files, sync_days

#: Order of an order's line items.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]

IDS_PER_LIST = 500
PREVIEW_ROWS = 1000
TEXT_FILES, PACKED_TEXTS = "*.txt", "*.txt.gz"


# ---- inputs made from the tables ----

def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_snapshots(spark, nested.landing(spark, sf_dir), files=LANDED_FILES)


def _legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_legs(explode_itineraries(nested.merged(spark, sf_dir)))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_segments(nested.merged(spark, sf_dir))


def _line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as flat segments, the order being the group."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        *LINE_ORDER,
        F.col("l_partkey").cast("string").alias("flightNumber"),
        F.col("l_quantity").cast("bigint").alias("duration"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
        .alias("marketingCarrier"),
        F.concat(F.lit("Operator "), F.col("l_linestatus")).alias("operatingCarrier"),
        code(F.col("l_suppkey")).alias("originCode"),
        code(F.col("l_partkey")).alias("destinationCode"),
    )


def _days(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """One row per order year: a day of it, as a fetch date."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return years.select(F.concat(F.col("year").cast("string"), F.lit(day)).alias("fetch_date"))


def _failed_days(spark: SparkSession, sf_dir: str) -> str:
    """Snapshots of failed searches, on the day after each full one."""
    def write(path: str) -> None:
        body = F.struct(
            F.struct(F.lit("failure").alias("status"), F.lit(0).alias("totalResults"))
            .alias("context"),
            F.array().cast("array<string>").alias("itineraries"))
        days = _days(spark, sf_dir, "-01-02").withColumns({"status": F.lit(True), "data": body})
        days.write.partitionBy("fetch_date").json(path)
    return nested.once(spark, sf_dir, "failed", write)


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they land: the time is text, the day is the folder."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value",
        date_key(F.col("ts")).alias("fetch_date"))


# ---- sources ----

def snapshot_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover_snapshots(spark, nested.landing(spark, sf_dir), LANDED_FILES)
    return found.where("fetch_date is not null").select("fetch_date")


def _record_rows(snapshots: DataFrame) -> DataFrame:
    return accepted(snapshots).select(
        "fetch_date",
        F.col("message").alias("record_id"),
        "status",
        F.col("data.context.totalResults").alias("total_results"),
        F.array_size("data.itineraries").alias("itineraries"),
    )


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_rows(_landing(spark, sf_dir))


def multiline_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = nested.multiline_landing(spark, sf_dir)
    return _record_rows(read_snapshots(spark, base, multi_line=True, files=PACKED_TEXTS))


def snapshot_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_itineraries(accepted(_landing(spark, sf_dir)))
    return rows.select("fetch_date", "itinerary_id", "formattedPrice")


def empty_snapshot_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full days, empty days and days on which nothing landed."""
    paths = [nested.landing(spark, sf_dir), _failed_days(spark, sf_dir)]
    found = accepted(read_snapshots(spark, paths, files=LANDED_FILES))
    expected = union_by_name([_days(spark, sf_dir, d) for d in ("-01-01", "-01-02", "-01-03")])
    return snapshot_states(expected, found)


def _cut_records(spark: SparkSession, sf_dir: str) -> str:
    """Every record once more, broken off half-way, in the folder of its day."""
    def write(path: str) -> None:
        cut = F.left("value", (F.length("value") / 2).cast("int"))
        nested.write_days(
            nested.landed_lines(spark, sf_dir).select("fetch_date", cut.alias("value")),
            "text", path)
    return nested.once(spark, sf_dir, "cut", write)


def _stray_records(spark: SparkSession, sf_dir: str) -> str:
    """Every record once more, in a folder that is not a date."""
    def write(path: str) -> None:
        nested.landed_lines(spark, sf_dir).select("value").write.option(
            "compression", "gzip").option(
            "maxRecordsPerFile", nested.RECORDS_PER_FILE).text(f"{path}/undated")
    return nested.once(spark, sf_dir, "stray", write)


def _unreadable_files(spark: SparkSession, sf_dir: str) -> str:
    """Files that say they are compressed and are not: two for each order year."""
    def write(path: str) -> None:
        days = _days(spark, sf_dir, "-01-04").unionByName(_days(spark, sf_dir, "-01-05"))
        texts = days.select("fetch_date", F.concat(nested.envelope_line(), "fetch_date"))
        texts.repartition("fetch_date").write.partitionBy("fetch_date").text(f"{path}/plain")
        files = spark.sparkContext._jvm.org.apache.hadoop.fs
        root = files.Path(f"{path}/plain")
        system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.globStatus(files.Path(f"{path}/plain/fetch_date=*/*.txt")):
            folder = files.Path(path, status.getPath().getParent().getName())
            system.mkdirs(folder)
            system.rename(status.getPath(), files.Path(folder, "broken.json.gz"))
        system.delete(root, True)
    return nested.once(spark, sf_dir, "unreadable", write)


_ANY_FILE = "*.{json,txt,gz}"


def fault_isolated_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by day and outcome, and the files that could not be read, whole, as one each.

    One scan: files that cannot be read are those that are listed and gave no row.
    """
    paths = [f(spark, sf_dir) for f in (
        nested.landing, _stray_records, _cut_records, _unreadable_files)]
    rows = read_apart(spark, paths, files=_ANY_FILE)
    found = staged(rows.groupBy("file_path", "fetch_date", "is_record", outcome().alias("outcome"))
                   .agg(F.count("*").alias("records")), "outcomes")
    lost = unread(list_versions(spark, paths, _ANY_FILE), found).select(
        "fetch_date", F.lit("file cannot be read").alias("outcome"), F.lit(1).alias("records"))
    known = found.where("is_record").select("fetch_date", "outcome", "records")
    return known.unionByName(lost).groupBy(
        F.coalesce("fetch_date", F.lit("none")).alias("fetch_date"), "outcome",
    ).agg(F.sum("records").alias("records"))


def _landed_batches(spark: SparkSession, sf_dir: str) -> str:
    """Two landings with a run after each, small batches, and a run that finds nothing new."""
    def write(path: str) -> None:
        store, log = f"{path}/store", f"{path}/log"
        early = [f(spark, sf_dir) for f in (nested.landing, _unreadable_files)]
        everything = [*early, _failed_days(spark, sf_dir)]
        for base in (early, everything, everything):
            land(spark, base, store, log, ENVELOPE, files=_ANY_FILE, most=1000, most_files=20)
    return nested.once(spark, sf_dir, "batches", write)


def batch_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by day and outcome from the store that the batches filled."""
    path = _landed_batches(spark, sf_dir)
    rows = open_landed(spark, f"{path}/store", f"{path}/log")
    return rows.groupBy("fetch_date", "outcome").agg(
        F.count("*").alias("records"),
        F.sum(F.coalesce(F.array_size("data.itineraries"), F.lit(0))).alias("itineraries"))


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's last word by day: whether all of its files were read, and their records."""
    path = _landed_batches(spark, sf_dir)
    return landed_files(spark, f"{path}/log").groupBy("fetch_date").agg(
        F.min("state").alias("state"), F.sum("records").alias("records"))


_OPERATING = (
    "fetch_date string, data struct<itineraries:array<struct<id:string,"
    "legs:array<struct<id:string,stopCount:bigint,"
    "carriers:struct<operating:array<struct<name:string>>>>>>>>"
)


def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store has no operating carriers on its legs; aligned, they are null."""
    path = "data.itineraries.legs.carriers.operating"
    store = nested.merged(spark, sf_dir)
    aligned = align_to(store, T.StructType.fromDDL(_OPERATING))
    legs = aligned.select("fetch_date", F.explode("data.itineraries").alias("i")).select(
        "fetch_date", F.col("i.id").alias("itinerary_id"), F.explode("i.legs").alias("leg"))
    return legs.select(
        "fetch_date", "itinerary_id",
        F.col("leg.id").alias("leg_id"),
        F.col("leg.stopCount").alias("stop_count"),
        F.col("leg.carriers.operating").isNull().alias("operating_is_null"),
        F.lit(has_path(store, path)).alias("path_before"),
        F.lit(has_path(aligned, path)).alias("path_after"),
    )


def union_by_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"))
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))
    return union_by_name([customers, suppliers, nations])


def empty_input_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records lie in a folder that is no date: nothing to merge, no summary rows."""
    # parsed once; the report and the summary read the table
    snapshots = staged(read_snapshots(
        spark, _stray_records(spark, sf_dir), files=PACKED_TEXTS), "records")
    report = merge_report(snapshots).select(F.inline(F.array(
        F.struct(F.lit("kept").alias("measure"), F.col("kept").alias("value")),
        F.struct(F.lit("rejected").alias("measure"), F.col("rejected").alias("value")),
    )))
    rows = summary_of_envelopes(accepted(snapshots)).agg(F.count("fetch_date").alias("value"))
    return union_by_name([report, rows.withColumn("measure", F.lit("summary rows"))])


def schema_introspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_paths(nested.merged(spark, sf_dir).select("status", "message", "data"))


def id_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of document ids, as lines of text."""
    def write(path: str) -> None:
        ids = table(spark, sf_dir, "documents").select("doc_id").distinct()
        lists = ids.groupBy(whole(F.col("doc_id"), IDS_PER_LIST).alias("list")).agg(
            F.sort_array(F.collect_list("doc_id")).alias("ids"))
        lists.select(F.to_json("ids").alias("value")).write.text(path)
    return read_id_lists(spark, nested.once(spark, sf_dir, "ids", write))


# ---- sinks ----

def _leg_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_legs(_legs(spark, sf_dir), ["itinerary_id", "leg_id"])


def json_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, path = _leg_summary(spark, sf_dir), fresh_path(spark, "json")
    sinks.write_json(summary, path, packed=True)
    return sinks.read_json(spark, path, summary.schema)


def merged_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged nested records as JSON, read back and flattened."""
    store, path = nested.merged(spark, sf_dir), fresh_path(spark, "merged_json")
    sinks.write_json(store, path, packed=True)
    return flatten_segments(sinks.read_json(spark, path, store.schema)).select(
        "itinerary_id", "leg_id", "leg_pos", "seg_pos", *SEGMENT_COLUMNS,
        "seg_departure", "seg_arrival")


def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, path = _leg_summary(spark, sf_dir), fresh_path(spark, "csv")
    sinks.write_csv(summary, path)
    return sinks.read_csv(spark, path, summary.schema)


def parquet_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, path = _leg_summary(spark, sf_dir), fresh_path(spark, "parquet")
    sinks.write_parquet(summary, path)
    return spark.read.parquet(path)


def partitioned_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, path = _leg_summary(spark, sf_dir), fresh_path(spark, "by_date")
    sinks.write_partitioned(summary.withColumnRenamed("fetch_date", "search_date"),
                            path, "search_date")
    return spark.read.parquet(path).withColumn("search_date", date_key(F.col("search_date")))


_EVENT = "event_id bigint, ts string, user_id bigint, event_type string, value double"


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings with a run after each, and a last run that finds nothing new."""
    base, target, checkpoint = (fresh_path(spark, n) for n in ("land", "stored", "progress"))
    events = _event_lines(spark, sf_dir)
    early = F.coalesce(F.dayofmonth(F.col("fetch_date").cast("date")) <= 15, F.lit(False))

    def run() -> None:
        ingest_new_files(spark, base, target, checkpoint, _EVENT,
                         lambda s: s.select("event_id", "ts", "user_id", "value", "fetch_date"))

    for landed in (events.where(early), events.where(~early)):
        landed.write.mode("append").partitionBy("fetch_date").json(base)
        run()
    run()
    return spark.read.parquet(target).select(
        "event_id", local_time(F.col("ts")).alias("ts"), "user_id", "value",
        date_key(F.col("fetch_date")).alias("fetch_date"))


def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days are landed with a wrong value, then the later ones once more with the right one."""
    path = fresh_path(spark, "replaced")
    events = _event_lines(spark, sf_dir).select("event_id", "user_id", "value", "fetch_date")
    late = F.dayofmonth(F.col("fetch_date").cast("date")) > 15
    sinks.replace_snapshots(events.withColumn("value", F.lit(-1.0)), path)
    sinks.replace_snapshots(events.where(late), path)
    return spark.read.parquet(path).withColumn("fetch_date", date_key(F.col("fetch_date")))


FILES_PER_DAY = 4


def _land_files(events: DataFrame, base: str) -> None:
    """Four files a day at fixed paths, in place of those that are there."""
    spark, fresh = events.sparkSession, fresh_path(events.sparkSession, "landing")
    slots = events.withColumn("slot", F.pmod("event_id", F.lit(FILES_PER_DAY)))
    slots.repartition("fetch_date", "slot").write.partitionBy("fetch_date", "slot").json(fresh)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = files.Path(fresh).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.globStatus(files.Path(f"{fresh}/*/*/*.json")):
        slot = status.getPath().getParent()
        target = files.Path(f"{base}/{slot.getParent().getName()}/{slot.getName()}.json")
        system.mkdirs(target.getParent())
        system.delete(target, False)
        system.rename(status.getPath(), target)


def _replaced_files(spark: SparkSession, sf_dir: str) -> str:
    """Days land, are replaced under their paths, removed and added, with a run after each."""
    def write(path: str) -> None:
        events = _event_lines(spark, sf_dir)
        day = F.dayofmonth(F.col("fetch_date").cast("date"))
        wrong = events.where(day % 5 != 0).withColumn("value", F.lit(-1.0))
        right = events.where(((day > 15) | (day % 5 == 0)) & (day % 7 != 0))
        gone = [row[0] for row in events.where(day % 7 == 0).select(
            "fetch_date").distinct().collect()]

        def run(number: int) -> None:
            changes = sync_days(
                spark, f"{path}/landed", f"{path}/days", f"{path}/manifest", _EVENT,
                lambda rows: rows.select("event_id", "user_id", "value", "fetch_date"))
            changes.withColumn("run", F.lit(number)).write.mode("append").parquet(
                f"{path}/changes")

        _land_files(wrong, f"{path}/landed")
        run(1)
        _land_files(right, f"{path}/landed")
        sinks.drop_days(spark, f"{path}/landed", gone)
        run(2)
        run(3)
    return nested.once(spark, sf_dir, "replaced", write)


def replaced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the files that are there in the end."""
    rows = spark.read.parquet(f"{_replaced_files(spark, sf_dir)}/days")
    return rows.withColumn("fetch_date", date_key(F.col("fetch_date")))


def manifest_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by day as the manifest has them, and the run that listed the day last.

    Days land in two parts with a run after each; the second lists the new days, and
    the newest of the others once more, which has got further files meanwhile.
    """
    base, manifest = (fresh_path(spark, n) for n in ("landing", "manifest"))
    events = _event_lines(spark, sf_dir)
    day = F.dayofmonth(F.col("fetch_date").cast("date"))
    first = events.where((day % 2 == 1) & (day < 20) & ((day != 19) | (F.col("event_id") % 2 == 0)))
    _land_files(first, base)
    runs = [extend_manifest(spark, base, manifest)]
    _land_files(events.where((day % 2 == 0) | (day >= 19)), base)
    runs.append(extend_manifest(spark, base, manifest))
    last = {d: number for number, days in enumerate(runs, 1) for d in days}
    listed = spark.createDataFrame([*last.items()], "fetch_date string, listed_in int")
    return discovered(spark, manifest).drop("bytes").join(listed, "fetch_date")


def _drifting_events(spark: SparkSession, sf_dir: str) -> str:
    """Events whose fields change with the day: new ones, one that is left out, one of another type."""
    def write(path: str) -> None:
        day = F.dayofmonth(F.col("fetch_date").cast("date"))
        events = _event_lines(spark, sf_dir).withColumns({
            "device": F.when(day > 10, F.struct(
                F.col("event_type").alias("kind"), F.array(F.struct("user_id")).alias("users"))),
            "user_id": F.when(day % 4 != 0, F.col("user_id")),
            "tags": F.when(F.col("event_id") % 3 == 0, F.array("event_type"))})
        fields = ["event_id", "user_id", "event_type", "device", "tags"]
        late = F.to_json(F.struct(*fields, F.concat(F.lit("v"), "value").alias("value")))
        early = F.to_json(F.struct(*fields, "value"))
        lines = events.select("fetch_date", F.when(day > 20, late).otherwise(early).alias("line"))
        lines.hint("rebalance", "fetch_date").write.partitionBy("fetch_date").text(path)
    return nested.once(spark, sf_dir, "drifting", write)


def schema_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the records have, or lack, beside those that are read."""
    shapes = record_shapes(spark, _drifting_events(spark, sf_dir), files=TEXT_FILES)
    return schema_drift(shape_paths(shapes), _EVENT)


def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run found: files by day and kind of change; the last run none."""
    return spark.read.parquet(f"{_replaced_files(spark, sf_dir)}/changes").groupBy(
        "run", "fetch_date", "change").agg(F.count("*").alias("files"))


# ---- projections ----

def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("departure"),
        F.col("l_orderkey").alias("itinerary"),
        F.col("l_linenumber").alias("segment"),
        F.col("l_partkey").cast("string").alias("flight_number"),
        F.col("l_extendedprice").alias("price"),
    )


def nested_field_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted paths down to ``segment.marketingCarrier.name``."""
    store = nested.merged(spark, sf_dir)
    itineraries = store.select(
        F.col("data.context.sessionId").alias("record_id"),
        F.explode("data.itineraries").alias("itinerary"))
    legs = itineraries.select(
        "record_id", F.col("itinerary.id").alias("itinerary_id"),
        F.col("itinerary.price.raw").alias("price_raw"), F.explode("itinerary.legs").alias("leg"))
    segments = legs.select(
        "record_id", "itinerary_id", "price_raw", F.col("leg.id").alias("leg_id"),
        F.posexplode("leg.segments").alias("seg_pos", "segment"))
    return segments.select(
        "record_id", "itinerary_id", "price_raw", "leg_id", "seg_pos",
        F.col("segment.marketingCarrier.name").alias("marketing"),
        F.col("segment.origin.displayCode").alias("origin"),
    )


def literal_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit("2025-03-06").alias("fetch_date"),
        F.lit(None).cast("string").alias("operating"),
        F.lit(0).alias("layover"),
    )
    return orders.withColumn("operating", F.coalesce("operating", F.lit("unknown")))


def derived_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_orderkey", "l_discount")
    return lines.withColumn(
        "net", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4),
    ).withColumn("l_linenumber", F.col("l_linenumber") - 1)


def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return orders.withColumnRenamed("o_orderdate", "departure").withColumnRenamed(
        "o_totalprice", "price")


def conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leg_summary(spark, sf_dir).select(
        "itinerary_id", "leg_id", "layover",
        stop_count_from_text(F.col("layover")).alias("stops"),
        F.col("origin").eqNullSafe(F.col("destination")).alias("is_round"),
    )


# ---- generators ----

def explode_level1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_itineraries(nested.merged(spark, sf_dir)).select(
        "fetch_date", "itinerary_id", "formattedPrice", F.size("legs").alias("legs"))


def explode_level2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _legs(spark, sf_dir).select(
        "fetch_date", "itinerary_id", "formattedPrice", "leg_id", "leg_pos", "departure",
        "arrival", "duration", F.size("segments").alias("segments"))


def explode_level3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_segments(_legs(spark, sf_dir)).select(
        "fetch_date", "itinerary_id", "leg_id", "leg_pos", "seg_pos", "departure", "duration",
        F.col("segment.flightNumber").alias("flightNumber"))


def flatten_segments_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir).select(
        "itinerary_id", "leg_id", "leg_pos", "seg_pos", *SEGMENT_COLUMNS,
        "seg_departure", "seg_arrival")


def explode_drops_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legs of every itinerary; one without legs is told as dropped."""
    itineraries = explode_itineraries(nested.merged(spark, sf_dir))
    return explode_legs(itineraries, outer=True).select(
        "itinerary_id", F.coalesce("leg_id", F.lit("none")).alias("leg_id"),
        F.col("leg_pos").isNull().alias("dropped"))


def _crew_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record lists of at most 500 customers each, with their declared number.

    Customers are numbered within a block of keys, and the lists are cut by number: no
    list grows with the rows of one key.
    """
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    people = customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        whole(F.col("c_custkey"), IDS_PER_LIST).alias("response"), "c_custkey",
        F.col("n_name").alias("craft"), F.col("c_name").alias("name"))
    numbered = running_number(people, ["response"], ["c_custkey", "name", "craft"], "number")
    return numbered.groupBy("response", whole(F.col("number"), IDS_PER_LIST).alias("part")).agg(
        F.count("*").alias("number"), F.collect_list(F.struct("craft", "name")).alias("people"))


def format_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = explode_records(_crew_responses(spark, sf_dir))
    return people.select(
        "name", "craft", crew_message(F.col("name"), F.col("craft")).alias("message"))


def record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_record_count(_crew_responses(spark, sf_dir)).select(
        "response", "part", "number", "listed")


# ---- aggregations ----

def itinerary_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as itineraries. Line items are grouped before the join, so that no
    order brings more than one row to it."""
    grouped = summarise_groups(
        _line_segments(spark, sf_dir), ["l_orderkey"], LINE_ORDER,
        ["duration", "marketingCarrier", "operatingCarrier", "flightNumber"])
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fetch_date(F.col("o_orderdate")).alias("fetch_date"),
        price_text(F.col("o_totalprice")).alias("formattedPrice"),
        iso_text(F.col("o_orderdate")).alias("departure"),
    )
    return grouped.join(orders, grouped.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("itinerary_id"), *SUMMARY_COLUMNS)


def itinerary_summary_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leg_summary(spark, sf_dir)


def itinerary_summary_by_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_segments(_segments(spark, sf_dir), LEG_KEYS, ["seg_pos"]).select(
        "itinerary_id", "leg_id", *SUMMARY_COLUMNS)


def itinerary_summary_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_segments(
        _segments(spark, sf_dir), PRICE_KEYS, ["itinerary_id", "leg_id", "seg_pos"])


def dedupe_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = _segments(spark, sf_dir)
    return distinct_segments(segments.unionByName(segments), SEGMENT_COLUMNS)


def first_by_position_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_by_position(
        _line_segments(spark, sf_dir), ["l_orderkey"], "originCode", LINE_ORDER, "origin")


def last_by_position_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_by_position(
        _line_segments(spark, sf_dir), ["l_orderkey"], "destinationCode", LINE_ORDER,
        "destination")


def ordered_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_codes(_segments(spark, sf_dir)).select(
        "itinerary_id", "leg_id", F.size("layovers").alias("n"),
        layover_text(F.col("layovers")).alias("layovers"))


# ---- gaps ----

def lead_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return lead_in_order(
        events, ["user_id"], ["ts", "event_id"], {"next_ts": "ts", "next_value": "value"})


def gap_minutes_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = flight_gaps(
        _segments(spark, sf_dir), ["departure", "arrival", "itinerary_id", "leg_id", "seg_pos"])
    return gaps.select(
        "flightNumber", "itinerary_id", "leg_id", "seg_pos", "next_departure", "next_arrival",
        F.round("layover_duration", 6).alias("layover_duration"))


def connection_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leg_connections(_legs(spark, sf_dir)).drop("leg_pos")


def connection_minutes_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_connections(_segments(spark, sf_dir)).drop("leg_pos")


# ---- order and limit ----

def order_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leg_summary(spark, sf_dir).orderBy("fetch_date", "itinerary_id", "leg_id")


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_by_snapshot(spark, sf_dir).limit(PREVIEW_ROWS)


# ---- functions ----

def _visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.col("segments.destination.displayCode")
    return _legs(spark, sf_dir).select(
        "itinerary_id", "leg_id", codes.alias("visited"),
        F.get("segments", F.lit(0))["origin"]["displayCode"].alias("origin"),
        F.element_at(codes, -1).alias("destination"))


def array_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = intermediate_stops(F.col("visited"), F.col("origin"), F.col("destination"))
    return _visited(spark, sf_dir).select(
        "itinerary_id", "leg_id", F.concat_ws("|", stops).alias("stops"),
        stop_count(stops).alias("n"))


def array_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _visited(spark, sf_dir).select(
        "itinerary_id", "leg_id", layover_text(F.col("visited")).alias("visited"))


def split_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leg_summary(spark, sf_dir).select(
        "itinerary_id", "leg_id", "layover", F.size(F.split("layover", ", ")).alias("parts"))


def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text becomes a time; text that is no time becomes null, not an error."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        local_time(iso_text(F.col("o_orderdate"))).alias("departure"),
        local_time(F.col("o_orderpriority")).isNull().alias("priority_is_no_time"),
    )


def date_partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(date_key(F.col("o_orderdate")).alias("search_date")).agg(
        F.count("*").alias("orders"))


def path_part_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", F.lit("prices"), date_key(F.col("o_orderdate")),
                       F.concat(F.col("o_orderkey").cast("string"), F.lit(".json")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", path_part(path, -2).alias("fetch_date"), path_part(path, -1).alias("file"))


QUERIES = {
    "snapshot_discovery": snapshot_discovery,
    "json_scan": json_scan,
    "multiline_json_scan": multiline_json_scan,
    "snapshot_lineage": snapshot_lineage,
    "empty_snapshot_guard": empty_snapshot_guard,
    "fault_isolated_read": fault_isolated_read,
    "batch_landing": batch_landing,
    "batch_log": batch_log,
    "schema_align": schema_align,
    "union_by_name": union_by_name_query,
    "empty_input_result": empty_input_result,
    "schema_introspection": schema_introspection,
    "id_list_scan": id_list_scan,
    "json_sink_roundtrip": json_sink_roundtrip,
    "merged_json_roundtrip": merged_json_roundtrip,
    "csv_sink_roundtrip": csv_sink_roundtrip,
    "parquet_sink_roundtrip": parquet_sink_roundtrip,
    "partitioned_parquet_sink": partitioned_parquet_sink,
    "incremental_ingest": incremental_ingest,
    "snapshot_replace": snapshot_replace,
    "replaced_files": replaced_files,
    "changed_files": changed_files,
    "schema_drift": schema_drift_query,
    "manifest_discovery": manifest_discovery,
    "project_columns": project_columns,
    "nested_field_access": nested_field_access,
    "literal_column": literal_column,
    "derived_column": derived_column,
    "rename_column": rename_column,
    "conditional": conditional,
    "explode_level1": explode_level1,
    "explode_level2": explode_level2,
    "explode_level3": explode_level3,
    "flatten_segments": flatten_segments_query,
    "explode_drops_empty": explode_drops_empty,
    "format_message": format_message,
    "record_count": record_count,
    "itinerary_summary": itinerary_summary,
    "itinerary_summary_nested": itinerary_summary_nested,
    "itinerary_summary_by_leg": itinerary_summary_by_leg,
    "itinerary_summary_by_price": itinerary_summary_by_price,
    "dedupe_segments": dedupe_segments,
    "first_by_position": first_by_position_query,
    "last_by_position": last_by_position_query,
    "ordered_collect": ordered_collect,
    "lead_next": lead_next,
    "gap_minutes_as_written": gap_minutes_as_written,
    "connection_minutes": connection_minutes,
    "connection_minutes_flat": connection_minutes_flat,
    "order_by_snapshot": order_by_snapshot,
    "preview_limit": preview_limit,
    "array_except": array_except,
    "array_join": array_join,
    "split_size": split_size,
    "timestamp_parse": timestamp_parse,
    "date_partition_key": date_partition_key,
    "path_part": path_part_query,
}
